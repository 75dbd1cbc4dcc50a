import pytest
from pyspark.sql import functions as F

from barweave.operators import features, score
from barweave.schema import FEATURES
from barweave.sources.bars import ordered_daily
from tests.helpers import price_rows, same_rows


@pytest.fixture(scope="module")
def rules(spark):
    return {
        "lr": score.rule(F.col("close") > F.col("sma5")),
        "rf": score.rule(F.col("ret1") > 0),
        "gbt": score.rule(F.col("ret5") > 0),
    }


COLUMNS = ["symbol", "date", "target", "lr_pred", "rf_pred", "gbt_pred"]


@pytest.fixture(scope="module")
def table(spark):
    closes = [10.0, 12.0, 11.0, 11.0, 9.0, 5.0, 7.5, 7.0]
    bars = price_rows(spark, closes).union(price_rows(spark, closes[::-1], "b"))
    return features.add_features(ordered_daily(bars)).rows().cache()


def test_join_and_chain_agree(table, rules):
    chained = score.chain(table, rules).select(*COLUMNS)
    assert same_rows(chained, score.join_predictions(table, rules))


def test_repeated_dates_multiply_in_the_join_only(table, rules):
    one = table.where("symbol = 'a'").orderBy("date").limit(5)
    doubled = one.union(one.orderBy("date").limit(2))
    joined = score.join_predictions(doubled, rules, on=("date",))
    assert joined.count() == 3 + 2 * 2**3
    assert score.chain(doubled, rules).count() == 7


def test_missing_keys_vanish_in_the_join_only(table, rules):
    holes = table.withColumn("date", F.when(F.col("symbol") == "a", F.col("date")))
    assert score.join_predictions(holes, rules).count() == 8
    assert score.chain(holes, rules).count() == 16


def test_flags(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 1), (1.0, None)], "lr_pred double, target int")
    assert [r.lr_correct for r in score.with_flags(df, ["lr"]).collect()] == [True, False, None]


def test_long_form(table, rules):
    long = score.long_predictions(score.chain(table, rules), list(rules))
    assert long.count() == 48
    assert long.columns == ["symbol", "date", "actual", "model", "predicted"]


def test_incomplete_rows_fail(table, rules):
    holes = table.withColumn("volume", F.when(F.col("symbol") == "a", F.col("volume"))).withColumn(
        "sma5", F.when(F.dayofmonth("date") == 3, F.lit(float("nan"))).otherwise(F.col("sma5"))
    )
    scored = holes.transform(score.score_with(rules["rf"]))
    assert scored.drop("prediction").columns == holes.columns
    assert same_rows(scored.drop("prediction"), holes)
    bad = (F.col("symbol") == "b") | F.isnan("sma5")
    assert scored.where(bad).select("prediction").distinct().collect() == [(-1,)]
    assert scored.where(~bad & ~F.col("prediction").isin(0, 1)).isEmpty()


def test_routing(table, rules):
    names = F.element_at(F.array(F.lit("log"), F.lit("rf"), F.lit("zzz"), F.lit(None)), F.pmod(F.dayofmonth("date"), F.lit(4)) + 1)
    requests = table.withColumn("model", names)
    scorers = {"log": score.score_with(rules["lr"]), "rf": score.score_with(rules["rf"])}
    routed = score.route(requests, scorers, default="log")
    assert routed.count() == 16
    assert routed.where("model = 'zzz' and prediction <> -1").isEmpty()
    up = (F.col("close") > F.col("sma5")).cast("int")
    assert routed.where(F.coalesce("model", F.lit("log")) == "log").where(F.col("prediction") != up).isEmpty()
    undirected = score.route(requests, scorers)
    assert undirected.where("model is null").select("prediction").distinct().collect() == [(-1,)]
    assert undirected.count() == 16
    assert set(FEATURES) <= set(routed.columns)
