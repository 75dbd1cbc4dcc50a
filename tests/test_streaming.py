import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave import storage
from barweave.operators import score, sequences
from barweave.plans import stream_queries
from barweave.schema import message_schema, to_internal
from barweave.sources import messages
from barweave.sources.bars import ordered_daily
from barweave.streaming import batches, scoring, sinks
from barweave.streaming.state import windows_of
from tests.helpers import price_rows, same_rows

DRAIN = sinks.trigger(drain=True)
SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), *message_schema().fields])


@pytest.fixture
def topic(spark, tmp_path):
    """Publish rows or texts to a new folder, one file per call."""
    path = str(tmp_path / "topic")

    def publish(data):
        if isinstance(data, list):
            data = spark.createDataFrame([(t,) for t in data], "value string")
        messages.publish_folder(data.coalesce(1), path)
        return path

    return publish


def feature_rows(spark, closes, symbol="a"):
    zero = {c: F.lit(0.0) for c in ("sma5", "sma10", "ret1", "ret5")}
    return price_rows(spark, closes, symbol).withColumns(zero).withColumn("target", F.lit(1))


def rules():
    return {"lr": score.rule(F.col("close") > 1.5), "rf": score.rule(F.col("close") > 2.5)}


def test_triggers():
    assert sinks.trigger() == {"processingTime": "0 seconds"}
    assert sinks.trigger("1 second") == {"processingTime": "1 second"}
    assert DRAIN == {"availableNow": True}


def test_files_pace_the_batches(spark, topic):
    for i in range(5):
        path = topic([f"message {i}"])
    stream = messages.folder_stream(spark, path, files_per_trigger=2)
    sizes = []
    query = sinks.each_batch(
        stream, lambda b, i: sizes.append(b.count()), storage.new_path(spark, "p"), **DRAIN
    )
    sinks.drained(query)
    assert sizes == [2, 2, 1]


def test_console(spark, topic):
    stream = messages.folder_stream(spark, topic(["hello"]))
    query = sinks.to_console(stream, storage.new_path(spark, "p"), **DRAIN)
    sinks.drained(query)
    assert "Console" in query.recentProgress[0].sink.description
    assert query.recentProgress[0].numInputRows == 1


def test_failures_are_passed_on(spark, topic):
    def fail(batch, batch_id):
        raise ValueError("boom")

    query = sinks.each_batch(
        messages.folder_stream(spark, topic(["x"])), fail, storage.new_path(spark, "p"), **DRAIN
    )
    with pytest.raises(Exception, match="boom"):
        sinks.drained(query)


def test_empty_batches_are_skipped(spark, topic):
    path = topic(["x"])
    seen = []
    nothing = messages.folder_stream(spark, path).where("value = 'y'")
    sinks.drained(
        sinks.each_batch(nothing, lambda b, i: seen.append(i), storage.new_path(spark, "p"), **DRAIN)
    )
    assert seen == []


def test_restart_reads_every_message_once(spark, topic):
    sink, progress = storage.new_path(spark, "sink"), storage.new_path(spark, "p")

    def drain():
        stream = messages.folder_stream(spark, path)
        sinks.drained(sinks.to_files(stream, sink, progress, **DRAIN))

    path = topic(["a", "b"])
    drain()
    drain()
    topic(["c"])
    drain()
    assert sorted(r.value for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_a_replayed_batch_replaces_itself(spark):
    path = storage.new_path(spark, "sink")
    for rows in (3, 3, 5):
        sinks.write_batch(spark.range(rows), path, 7)
    sinks.write_batch(spark.range(2), path, 8)
    counts = spark.read.parquet(path).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counts} == {7: 5, 8: 2}


def test_scoring(spark, topic):
    good = messages.as_messages(feature_rows(spark, [1.0, 2.0, 3.0]))
    topic(good)
    path = topic(["broken", '{"Date": "2024-01-01", "Close": 5.0}'])
    out = {n: storage.new_path(spark, n) for n in ("rows", "dead", "metrics")}
    write = scoring.scoring_writer(
        lambda df: score.chain(df, rules()), ["lr", "rf"], out["rows"],
        dead_letters=out["dead"], metrics=out["metrics"],
    )
    stream = scoring.bars_from_messages(messages.folder_stream(spark, path, files_per_trigger=1))
    sinks.drained(sinks.each_batch(stream, write, storage.new_path(spark, "p"), **DRAIN))

    rows = batches.read(spark, out["rows"])
    assert rows.columns == ["date", "lr_pred", "rf_pred", "target", "latency_ms", "batch_id"]
    got = sorted((r.date, r.lr_pred, r.rf_pred) for r in rows.collect())
    assert got == [("2024-01-01", 0, 0), ("2024-01-02", 1, 0), ("2024-01-03", 1, 1)]
    assert rows.where("latency_ms < 0 or latency_ms is null").isEmpty()
    dead = batches.read(spark, out["dead"])
    assert {r.value for r in dead.collect()} == {"broken", '{"Date": "2024-01-01", "Close": 5.0}'}
    totals = {r.model: r for r in scoring.running_metrics(batches.read(spark, out["metrics"])).collect()}
    assert (totals["lr"].n_rows, totals["lr"].n_correct) == (3, 2)
    assert totals["rf"].accuracy == pytest.approx(1 / 3)


def test_ingest_time_is_one_per_batch(spark, topic):
    path = topic(messages.as_messages(feature_rows(spark, [1.0, 2.0])))
    sink = storage.new_path(spark, "sink")
    stream = scoring.bars_from_messages(messages.folder_stream(spark, path))
    sinks.drained(sinks.to_files(stream, sink, storage.new_path(spark, "p"), **DRAIN))
    assert spark.read.parquet(sink).select("ingest_time").distinct().count() == 1


def test_sequences_survive_a_restart(spark, topic):
    rows = feature_rows(spark, [float(i) for i in range(9)]).union(
        feature_rows(spark, [5.0, 6.0, 7.0], "b")
    )
    cut = F.dayofmonth("date") <= 4
    sink, progress = storage.new_path(spark, "sink"), storage.new_path(spark, "p")
    windows = windows_of(storage.new_path(spark, "state"), 3, ["close", "volume"], slab_rows=4)

    def write(rows, batch_id):
        # A replay of the batch changes nothing.
        for _ in range(2):
            found = windows(rows, batch_id).select("symbol", "date", "sequence")
            sinks.write_batch(found, sink, batch_id)

    def drain():
        parsed = to_internal(messages.parse(messages.folder_stream(spark, path), SCHEMA))
        stream = parsed.withColumn("date", F.to_date("date"))
        sinks.drained(sinks.each_batch(stream, write, progress, **DRAIN))

    path = topic(messages.as_messages(rows.where(cut).orderBy(F.desc("date"))))
    drain()
    topic(messages.as_messages(rows.where(~cut).orderBy(F.desc("date"))))
    drain()
    batch = sequences.add_sequences(
        ordered_daily(rows), 3, ["close", "volume"], include_current=True
    ).rows()
    want = batch.select("symbol", "date", "sequence")
    assert same_rows(want, spark.read.parquet(sink).drop("batch_id"))


def test_console_and_scores_from_any_source(spark):
    """The batch parser and the stream parser are the same function."""
    df = spark.createDataFrame([('{"Date": "d", "Close": 1}',)], "value string")
    row = scoring.bars_from_messages(df).first()
    assert (row.date, row.close, row.value) == ("d", 1.0, '{"Date": "d", "Close": 1}')
    assert row.ingest_time is not None


def test_local_progress_is_renamed_without_processes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    key, seen = "spark.sql.streaming.checkpointFileManagerClass", []

    def write(batch, batch_id):
        seen.append((batch.count(), batch.sparkSession.conf.get(key, None)))

    stream = spark.readStream.text(str(tmp_path / "in"))
    sinks.drained(sinks.each_batch(stream, write, str(tmp_path / "c"), **sinks.trigger(drain=True)))
    assert seen[0][0] == 2 and seen[0][1].endswith(".FileSystemBasedCheckpointFileManager")
    assert spark.conf.get(key, None) is None


def test_windows_in_halves_keep_no_copies(spark):
    rows = feature_rows(spark, [1.0, 2.0, 3.0, 4.0]).withColumn("symbol", F.lit(7).cast("long"))
    os.makedirs(storage.run_dir(spark), exist_ok=True)
    before = set(os.listdir(storage.run_dir(spark)))
    rows = storage.hand_over(rows, "features")
    windows = windows_of(storage.new_path(spark, "state"), 2, ["close"])
    found = stream_queries._windows_in_halves(spark, rows, F.col("close") < 3, windows)
    steps = [r.sequence for r in found.orderBy("date").collect()]
    assert steps == [None, [[1.0], [2.0]], [[2.0], [3.0]], [[3.0], [4.0]]]
    new = set(os.listdir(storage.run_dir(spark))) - before
    assert {n.split("-")[0] for n in new} == {"progress", "sink", "state", "topic"}
