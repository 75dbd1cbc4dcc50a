"""Keyed state of streams: sequences and features over restarts, running totals."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave import storage
from barweave.operators import features, sequences
from barweave.operators.ordered import OrderedRows
from barweave.schema import message_schema, to_internal
from barweave.sources import messages
from barweave.sources.bars import ordered_daily
from barweave.streaming import keyed, scoring, sinks
from tests.helpers import START, price_rows, same_rows

DRAIN = sinks.trigger(drain=True)
SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), *message_schema().fields])


def in_batches(spark, batches, follow):
    """Each batch published and drained by a query of its own with one checkpoint."""
    topic, sink, progress = (storage.new_path(spark, n) for n in ("topic", "sink", "progress"))
    for rows in batches:
        messages.publish_folder(messages.as_messages(rows), topic)
        parsed = to_internal(messages.parse(messages.folder_stream(spark, topic), SCHEMA))
        stream = follow(parsed.withColumn("date", F.to_date("date")))
        sinks.drained(sinks.to_files(stream, sink, progress, **DRAIN))
    return spark.read.parquet(sink), progress


def bars(spark):
    rng = random.Random(3)
    rows = price_rows(spark, [rng.choice([0.0, 1.5, 2.0, 7.25, rng.random()]) for _ in range(40)], "a")
    rows = rows.unionByName(price_rows(spark, [5.0, 6.0, 4.0], "b"))
    rows = rows.unionByName(price_rows(spark, [3.0], "c"))
    return rows.unionByName(price_rows(spark, [float(i % 7) for i in range(25)], "d")).cache()


@pytest.fixture(scope="module")
def parts(spark):
    """The bars in three batches; a symbol is absent from some of them."""
    rows = bars(spark)
    cut = F.datediff("date", F.lit("2024-01-01"))
    return rows, [rows.where(cut < 2), rows.where((cut >= 2) & (cut < 13)), rows.where(cut >= 13)]


def test_features_of_a_stream_are_those_of_the_table(spark, parts):
    rows, batches = parts
    found, _ = in_batches(spark, batches, keyed.bar_features)
    table = features.add_features(ordered_daily(rows)).rows()
    newest = rows.groupBy("symbol").agg(F.max("date").alias("last"))
    wanted = table.join(newest, "symbol").where("date < last").select(found.columns)
    digits = {c: F.round(c, 9) for c in ("sma5", "sma10", "ret1", "ret5")}
    assert found.count() == rows.count() - 4
    assert same_rows(found.withColumns(digits), wanted.withColumns(digits))


@pytest.mark.parametrize("length", [1, 3])
def test_sequences_of_a_stream_are_those_of_the_table(spark, parts, length):
    rows, batches = parts
    columns = ["close", "volume"]
    found, _ = in_batches(spark, batches, lambda s: keyed.sequences(s, length, columns))
    wanted = sequences.add_sequences(ordered_daily(rows), length, columns, include_current=True)
    assert same_rows(found, wanted.rows().select(found.columns))


def test_state_is_bounded_and_restored(spark, parts):
    """A batch of one symbol writes that symbol's few rows, however many the stream has seen."""
    rows, batches = parts
    found, progress = in_batches(
        spark, [*batches, price_rows(spark, [9.0], "b").withColumn("date", F.lit("2025-01-01").cast("date"))],
        lambda s: keyed.sequences(s, 3, ["close"]),
    )
    last = found.where("symbol = 'b'").orderBy(F.desc("date")).first()
    assert last["sequence"] == [[6.0], [4.0], [9.0]]
    state = spark.read.format("statestore").option("path", progress).option("stateVarName", "last").load()
    kept = {r["key"]["symbol"]: len(r["list_element"] if isinstance(r["list_element"], list) else [1])
            for r in state.collect()} if "list_element" in state.columns else None
    if kept is not None:
        assert set(kept) == {"a", "b", "c", "d"} and state.count() <= 8


def test_gaps_and_late_rows(spark):
    rows = price_rows(spark, [1.0, 2.0, 3.0, 4.0], "a").withColumn("close", F.when(F.col("close") != 2, F.col("close")))
    found, _ = in_batches(spark, [rows.where("close = 3"), rows.where("close IS NULL OR close != 3")],
                          lambda s: keyed.sequences(s, 2, ["close"]))
    got = {str(r["date"]): r["sequence"] for r in found.collect()}
    # The earlier rows arrive late and stand behind the one of the first batch.
    assert got == {"2024-01-03": None, "2024-01-01": [[3.0], [1.0]], "2024-01-02": [[1.0], [None]], "2024-01-04": [[None], [4.0]]}


def test_running_totals(spark):
    rng = random.Random(4)
    rows = [("lr", rng.choice([0, 1, None]), rng.randrange(2), rng.random() ** 3 * 100) for _ in range(3000)]
    df = spark.createDataFrame(rows, "model string, actual int, predicted int, latency_ms double")
    folder, path = storage.new_path(spark, "long"), storage.new_path(spark, "totals")
    df.repartition(6).write.parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    totals = scoring.running_totals(stream)
    progress = storage.new_path(spark, "progress")
    sinks.drained(sinks.each_batch(totals, lambda b, i: sinks.write_batch(b, path, i), progress, mode="complete", **DRAIN))
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    row = scoring.read_totals(stored.where("batch_id = 2")).first()
    known = [r for r in rows if r[1] is not None]
    assert (row["n_rows"], row["n_labelled"]) == (3000, len(known))
    assert row["accuracy"] == pytest.approx(sum(r[1] == r[2] for r in known) / len(known))
    values = sorted(r[3] for r in rows)
    for q in (50, 90, 99):
        rank = sum(v <= row[f"p{q}"] for v in values) / len(values)
        assert abs(rank - q / 100) <= 0.02


def test_heavy_symbols_keep_the_other_way(spark):
    """Both ways to remember rows agree; the one for heavy symbols stays in the library."""
    rows = price_rows(spark, [float(i) for i in range(9)], "a")
    bars_ = OrderedRows.arrange(rows, ("symbol",), ("date",))
    wanted = sequences.add_sequences(bars_, 2, ["close"], include_current=True).rows()
    found, _ = in_batches(spark, [rows], lambda s: keyed.sequences(s, 2, ["close"]))
    assert same_rows(found, wanted.select(found.columns))


def test_columns_are_worked_out_as_row_by_row():
    """Sums as ``sum`` gives them, absent and zero prices, remembered rows behind gaps."""
    rng = np.random.default_rng(1)
    prices = rng.choice([0.0, np.nan, 1e16, 1.0, -1e16, 3.7], 200)
    known = [None if v != v else v for v in prices.tolist()]
    for back in (4, 9):
        own = [[v for v in known[max(0, i - back) : i + 1] if v is not None] for i in range(200)]
        expected = [sum(o) / len(o) if o else np.nan for o in own]
        np.testing.assert_array_equal(keyed._averages(prices, back), expected)
    for k in (1, 5):
        pairs = [(known[i], known[i - k] if i >= k else None) for i in range(200)]
        expected = [a / b - 1 if a is not None and b else 0.0 for a, b in pairs]
        np.testing.assert_array_equal(keyed._ratios(prices, k), expected)
    mixed = keyed._behind([None, 2.0], pd.Series([np.nan, 3.0])).tolist()
    assert [v if v == v else None for v in mixed] == [None, 2.0, None, 3.0]
    assert keyed._behind([START], pd.Series([None, START])).tolist() == [START, None, START]
