import pytest
from pyspark.sql import functions as F

from barweave.operators import sequences, split
from barweave.sources.bars import ordered_daily
from tests.helpers import column, price_rows


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 23])
@pytest.mark.parametrize("k", [5, 10])
def test_number_of_sequences(spark, n, k):
    rows = sequences.add_sequences(ordered_daily(price_rows(spark, [float(i) for i in range(n)])), k, ["close"])
    assert sequences.complete_sequences(rows.rows()).count() == max(n - k, 0)


def test_sequence_content(spark):
    bars = ordered_daily(price_rows(spark, [float(i) for i in range(7)]))
    before = sequences.add_sequences(bars, 3, ["close", "volume"]).rows()
    assert column(before, "sequence")[2:4] == [None, [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]]
    through = sequences.add_sequences(bars, 3, ["close"], include_current=True).rows()
    assert column(through, "sequence")[1:4] == [None, [[0.0], [1.0], [2.0]], [[1.0], [2.0], [3.0]]]


def test_flat_and_back(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],), (None,)], "s array<array<double>>")
    flat = df.withColumn("f", sequences.flat(F.col("s")))
    assert flat.first().f == [1.0, 2.0, 3.0, 4.0]
    again = flat.select(sequences.unflattened(F.col("f"), 2, 2)).collect()
    assert [r[0] for r in again] == [[[1.0, 2.0], [3.0, 4.0]], None]


@pytest.mark.parametrize("n", [1, 9, 10, 11, 57])
def test_chronological_split(spark, n):
    bars = price_rows(spark, [1.0] * n).union(price_rows(spark, [2.0] * 10, "b"))
    rows = split.chronological(ordered_daily(bars)).rows()
    train, test = split.train_rows(rows), split.test_rows(rows)
    assert train.count() + test.count() == n + 10
    assert train.where("symbol = 'a'").count() == int(n * 0.9)
    last = train.groupBy("symbol").agg(F.max("date").alias("last"))
    assert test.join(last, "symbol").where(F.col("date") <= F.col("last")).isEmpty()
    counts = {r.symbol: (r.n_rows, r.n_train, r.n_test) for r in split.counts(rows).collect()}
    assert counts["b"] == (10, 9, 1)


def test_split_of_sequences_keeps_dates(spark):
    n, k = 25, 5
    bars = ordered_daily(price_rows(spark, [float(i) for i in range(n)]))
    rows = split.chronological(sequences.add_sequences(bars, k, ["close"]), skip=k).rows()
    marks = column(rows, "is_train")
    assert marks[:k] == [None] * k
    assert marks.count(True) == int((n - k) * 0.9)
    assert rows.where("is_train is null and sequence is not null").isEmpty()


def test_random_part_is_repeatable(spark):
    rows = spark.range(20000).withColumn("part", split.random_part(F.col("id")))
    again = rows.select("id").repartition(5).withColumn("part", split.random_part(F.col("id")))
    assert rows.exceptAll(again).isEmpty()
    share = rows.agg(F.avg(F.col("part").cast("int"))).first()[0]
    assert 0.89 < share < 0.91
    other = rows.select(split.random_part(F.col("id"), seed=7).alias("p"), "part")
    assert not other.where("p <> part").isEmpty()
