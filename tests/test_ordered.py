"""Heavy keys give what the plain window gives."""

import pytest
from pyspark.sql import functions as F

from barweave.operators import features, ordered, sequences, split
from barweave.operators.ordered import OrderedRows
from barweave.schema import MAX_DAILY_ROWS
from tests.helpers import same_rows


@pytest.fixture(scope="module")
def ticks(spark):
    """1,000 rows, two thirds of one key, some of no key, holes at the start, shuffled."""
    n = F.col("id")
    key = (
        F.when(n % 3 != 0, F.lit("hot")).when(n % 2 == 0, (n % 5).cast("string")).otherwise(F.lit(None))
    )
    price = F.when((n > 60) & (n % 7 > 2), F.round(100 + 10 * F.sin(n.cast("double")), 2))
    rows = spark.range(1000).select(key.alias("symbol"), n.alias("seq"), price.alias("price"))
    return rows.repartition(7, F.rand(5)).cache()


def both(ticks, slab_rows=64):
    plain = OrderedRows.arrange(ticks, ("symbol",), ("seq",))
    cut = OrderedRows.arrange(ticks, ("symbol",), ("seq",), slab_rows=slab_rows)
    assert plain.heavy is None
    assert cut.heavy is not None and cut.heavy_rows > 600
    return plain, cut


@pytest.mark.parametrize("slab_rows", [20, 165])
def test_features_agree(ticks, slab_rows):
    plain, cut = both(ticks.na.fill(1.0, ["price"]), slab_rows)
    add = lambda rows: features.add_features(rows, price="price").rows()
    assert same_rows(add(plain), add(cut))


@pytest.mark.parametrize("leading", [True, False])
def test_fill_agrees(ticks, leading):
    plain, cut = both(ticks, 40)
    a = plain.fill(["price"], leading=leading).rows()
    assert same_rows(a, cut.fill(["price"], leading=leading).rows())
    hot = a.where("symbol = 'hot' and price is null").count()
    assert (hot == 0) == leading


def test_positions_and_split_agree(ticks):
    plain, cut = both(ticks)
    a, b = plain.positions("at", "n").rows(), cut.positions("at", "n").rows()
    assert same_rows(a, b)
    hot = b.where("symbol = 'hot'")
    assert [r.at for r in hot.orderBy("seq").collect()] == list(range(1, hot.count() + 1))
    assert same_rows(split.chronological(plain).rows(), split.chronological(cut).rows())


def test_key_values_agree(ticks):
    plain, cut = both(ticks)
    values = {"lo": F.min("price"), "hi": F.max("price")}
    assert same_rows(plain.key_values(**values).rows(), cut.key_values(**values).rows())


@pytest.mark.parametrize("current", [True, False])
def test_sequences_agree(ticks, current):
    plain, cut = both(ticks.na.fill(1.0, ["price"]), 30)
    add = lambda rows: sequences.add_sequences(rows, 5, ["price", "seq"], include_current=current).rows()
    assert same_rows(add(plain), add(cut))


def test_chained_operators_agree(ticks):
    plain, cut = both(ticks, 50)

    def chain(rows):
        rows = features.add_features(rows.fill(["price"]), price="price")
        rows = split.chronological(rows)
        return features.scale(rows, ["price", "sma5"], F.col("is_train")).rows()

    assert same_rows(chain(plain), chain(cut))


def test_rows_are_whole(ticks):
    _, cut = both(ticks, 20)
    moved = cut.framed(9, 3, lambda df, w: df).rows()
    assert same_rows(ticks, moved)


def test_frame_must_fit(ticks):
    _, cut = both(ticks, 20)
    with pytest.raises(ValueError):
        cut.framed(20, 0, lambda df, w: df)


def test_a_proven_bound_saves_the_measurement(spark, ticks):
    bounded = OrderedRows.arrange(ticks, ("symbol",), ("seq",), rows_bound=MAX_DAILY_ROWS)
    assert bounded.heavy is None
    plan = bounded.rows()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_all_features_use_one_exchange(spark):
    ticks = spark.range(50).selectExpr("id % 3 symbol", "id seq", "cast(id as double) price")
    rows = features.add_features(
        OrderedRows.arrange(ticks, ("symbol",), ("seq",), rows_bound=1), price="price"
    ).rows()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_short_slabs_need_no_task_each(spark, ticks, monkeypatch):
    parts, number = [], ordered._number

    def counted(heavy, key, by, keys, n):
        parts.append(n)
        return number(heavy, key, by, keys, n)

    monkeypatch.setattr(ordered, "_number", counted)
    plain, cut = both(ticks, 5)
    assert parts == [min(134, spark.sparkContext.defaultParallelism)]
    assert same_rows(plain.positions("at", "n").rows(), cut.positions("at", "n").rows())
