import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barweave.functions import columns as C
from barweave.operators import clean, features
from barweave.plans.preprocess import prepare, prepare_raw
from barweave.schema import DERIVED_COLUMNS, FEATURES
from barweave.sources.bars import ordered_daily
from tests.helpers import column, day, price_rows, same_rows

CLOSES = [10.0, 12.0, 11.0, 11.0, 0.0, 5.0, 7.5, 7.0, 9.0, 12.0, 8.0, 8.0]


def test_features_match_pandas(spark):
    rows = features.add_features(ordered_daily(price_rows(spark, CLOSES))).rows()
    close = pd.Series(CLOSES)
    back = lambda k: (close / close.shift(k) - 1).replace(math.inf, 0).fillna(0)
    want = {
        "sma5": close.rolling(5, min_periods=1).mean(),
        "sma10": close.rolling(10, min_periods=1).mean(),
        "ret1": back(1),
        "ret5": back(5),
        "target": (close.shift(-1) > close).astype(int),
    }
    for name, values in want.items():
        assert column(rows, name) == pytest.approx(list(values)), name


def test_input_order_does_not_matter(spark):
    bars = price_rows(spark, CLOSES)
    mixed = bars.repartition(3, F.rand(1)).orderBy(F.rand(2))
    one = features.add_features(ordered_daily(bars)).rows()
    assert same_rows(one, features.add_features(ordered_daily(mixed)).rows())


def test_symbols_do_not_touch(spark):
    bars = price_rows(spark, [1.0, 2.0]).union(price_rows(spark, [5.0, 4.0], "b"))
    rows = features.add_features(ordered_daily(bars)).rows().orderBy("symbol", "date")
    assert [r.ret1 for r in rows.collect()] == pytest.approx([0, 1, 0, -0.2])
    assert [r.target for r in rows.collect()] == [1, 0, 0, 0]


@pytest.mark.parametrize("closes", [[], [3.0]])
def test_short_input(spark, closes):
    rows = features.add_features(ordered_daily(price_rows(spark, closes))).rows().collect()
    assert [(r.sma5, r.ret1, r.target) for r in rows] == [(c, 0.0, 0) for c in closes]


def test_open_tail(spark):
    rows = features.add_target(ordered_daily(price_rows(spark, [1.0, 2.0])), tail="null").rows()
    assert column(rows, "target") == [1, None]
    with pytest.raises(ValueError):
        features.add_target(ordered_daily(rows), tail="drop")


def test_scaling(spark):
    bars = price_rows(spark, [1.0, 3.0, 2.0]).withColumn(
        "low", F.when(F.col("date") > F.lit(day(0)), F.col("low"))
    )
    rows = features.scale(ordered_daily(bars), ["close", "low", "volume"]).rows()
    assert column(rows, "close") == [0.0, 1.0, 0.5]
    assert column(rows, "low") == [None, 1.0, 0.0]
    assert column(rows, "volume") == [0.0, 0.0, 0.0]  # constant


def test_scaling_from_some_rows(spark):
    rows = features.scale(
        ordered_daily(price_rows(spark, [1.0, 3.0, 5.0])), ["close"], F.col("date") < F.lit(day(2))
    ).rows()
    assert column(rows, "close") == [0.0, 1.0, 2.0]


def test_stored_scaler_equals_direct_scaling(spark):
    bars = price_rows(spark, CLOSES).union(price_rows(spark, [4.0, 4.0, 2.0], "b"))
    params = features.scaler_params(bars, ["close", "volume"])
    assert params.count() == 4
    direct = features.scale(ordered_daily(bars), ["close", "volume"]).rows()
    assert same_rows(direct, features.scale_with(bars, params, ["close", "volume"]))
    unknown = features.scale_with(price_rows(spark, [1.0], "c"), params, ["close"])
    assert column(unknown, "close") == [None]


def test_fill(spark):
    closes = [None, None, 3.0, None, 5.0, None]
    filled = clean.fill_gaps(ordered_daily(price_rows(spark, closes)), ["close"]).rows()
    assert column(filled, "close") == [3.0, 3.0, 3.0, 3.0, 5.0, 5.0]
    forward = clean.fill_gaps(ordered_daily(price_rows(spark, closes)), ["close"], leading=False)
    assert column(forward.rows(), "close") == [None, None, 3.0, 3.0, 5.0, 5.0]
    empty = clean.fill_gaps(ordered_daily(price_rows(spark, [None, None])), ["close"]).rows()
    assert column(empty, "close") == [None, None]


def test_nan_and_null_are_both_missing(spark):
    bars = price_rows(spark, [1.0, math.nan, None, 4.0])
    assert clean.drop_incomplete(bars).count() == 2
    rows = clean.normalise_nan(bars, ["close"])
    assert column(rows, "close") == [1.0, None, None, 4.0]
    filled = clean.fill_gaps(ordered_daily(rows), ["close"]).rows()
    assert column(filled, "close") == [1.0, 1.0, 1.0, 4.0]


def test_dates(spark):
    texts = ["2024-02-29", "29-02-2024", "02/29/2024", "2024-02-29 10:00:00", "2023-02-29", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "date string")
    assert clean.coerce_dates(rows).groupBy("date").count().collect()[0]["count"] == 4
    assert clean.coerce_dates(rows).select("date").distinct().count() == 1


def test_derived_defaults(spark):
    row = spark.createDataFrame(
        [(None, None, math.nan, 0.5, None)], "close double, sma5 double, sma10 double, ret1 double, ret5 double"
    )
    got = clean.default_derived(row).first()
    assert (got.close, got.sma5, got.ret1, got.ret5) == (None, 0.0, 0.5, 0.0)
    assert math.isnan(got.sma10)


def test_threshold(spark):
    rows = spark.createDataFrame([(0.5,), (0.51,), (0.0,), (math.nan,), (None,)], "p double")
    assert [r[0] for r in rows.select(C.over_threshold(F.col("p"))).collect()] == [0, 1, 0, 0, None]


def test_latency_crosses_a_second(spark):
    rows = spark.sql(
        "select timestamp'2024-01-01 00:00:00.999' a, timestamp'2024-01-01 00:00:02.955' b"
    )
    assert rows.select(C.latency_ms(F.col("a"), F.col("b"))).first()[0] == 1956


def test_prepare(spark):
    closes = [None, 10.0, 12.0, None, 11.0, 13.0, 9.0, 8.0, 12.0, 14.0]
    table = prepare(ordered_daily(price_rows(spark, closes)))
    assert table.count() == 10
    train = table.where("is_train")
    assert train.count() == 9
    bounds = train.agg(*[F.min(c).alias(f"a{c}") for c in FEATURES], *[F.max(c).alias(f"b{c}") for c in FEATURES])
    assert all(v is not None and -1e-9 <= v <= 1 + 1e-9 for v in bounds.first())
    everything = prepare(ordered_daily(price_rows(spark, closes)), fit_on="all")
    assert everything.agg(F.max("close")).first()[0] == 1.0
    with pytest.raises(ValueError):
        prepare(ordered_daily(price_rows(spark, closes)), fit_on="test")


def test_prepare_raw(spark):
    raw = price_rows(spark, [1.0, math.nan, 3.0, 2.0]).withColumn(
        "date", F.when(F.col("close") == 3.0, F.lit("junk")).otherwise(F.col("date").cast("string"))
    )
    table = prepare_raw(raw.repartition(3), scaled=False)
    assert column(table, "close") == [1.0, 1.0, 2.0]
    assert column(table, "target") == [0, 1, 0]
    assert set(DERIVED_COLUMNS) <= set(table.columns)
