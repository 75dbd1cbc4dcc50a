"""Registered queries that run a stream over messages made from whole tables.

Each publishes its messages into a new folder, drains them and returns what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave import storage
from barweave.operators import (
    features,
    logistic_by_key,
    models,
    score,
    sequences,
    split,
    trees_by_key,
)
from barweave.plans import keyed_models
from barweave.plans.queries import (
    TYPE_SLAB_ROWS,
    feature_rows,
    feature_table,
    keyed_messages,
    publish,
    publish_more,
    query,
    rounded_features,
    rule_models,
)
from barweave.schema import FEATURES, message_schema, to_internal
from barweave.sources import messages
from barweave.sources.bars import event_types, ordered_daily, supplier_bars, table
from barweave.sources.replay import replay_stream, store_in_order
from barweave.streaming import batches, keyed, scoring, sinks
from barweave.streaming.state import Windows, windows_of

DRAIN = sinks.trigger(drain=True)

# Messages of a batch in the queries that replay.
REPLAY_ROWS = 10_000

SYMBOL_SCHEMA = T.StructType([T.StructField("symbol", T.LongType()), *message_schema().fields])


def run(
    spark: SparkSession, start: Callable[[str, str], object], checkpoint: str | None = None
) -> str:
    """Start a draining query on fresh sink and checkpoint folders; the sink's path."""
    path = storage.new_path(spark, "sink")
    sinks.drained(start(path, checkpoint or storage.new_path(spark, "progress")))
    return path


def written(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("date"))


@query
def stream_ingest(spark, sf):
    topic = publish(messages.as_messages(rounded_features(spark, sf)), "topic")
    stream = messages.folder_stream(spark, topic)
    path = run(spark, lambda p, c: sinks.to_files(stream, p, c, **DRAIN))
    return dated(to_internal(messages.parse(written(spark, path), SYMBOL_SCHEMA)))


@query
def stream_parse(spark, sf):
    """The batch parser on a stream, broken messages included."""
    topic = publish(keyed_messages(spark, sf), "topic")
    stream = scoring.bars_from_messages(messages.folder_stream(spark, topic))
    path = run(spark, lambda p, c: sinks.to_files(stream, p, c, **DRAIN))
    return written(spark, path).drop("value", "ingest_time")


@query
def stream_restart(spark, sf):
    """Two runs over a growing topic with one checkpoint: every message exactly once."""
    rows = storage.hand_over(rounded_features(spark, sf), "features", "zstd")
    early = F.year("date") < 1998
    topic = publish(messages.as_messages(rows.where(early)), "topic")
    sink, progress = storage.new_path(spark, "sink"), storage.new_path(spark, "progress")

    def drain() -> None:
        stream = messages.folder_stream(spark, topic)
        sinks.drained(sinks.to_files(stream, sink, progress, **DRAIN))

    drain()
    publish_more(messages.as_messages(rows.where(~early)), topic)
    drain()
    return dated(to_internal(messages.parse(written(spark, sink), SYMBOL_SCHEMA)))


@query
def paced_replay(spark, sf):
    """A replay of so many messages per batch arrives whole."""
    path = storage.new_path(spark, "sink")
    stream = _replayed(spark, sf).select("value")
    sinks.caught_up(sinks.to_files(stream, path, storage.new_path(spark, "progress")))
    return dated(to_internal(messages.parse(written(spark, path), SYMBOL_SCHEMA)))


def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    """All messages in the order of their days and symbols, ``REPLAY_ROWS`` in a batch."""
    whole = rounded_features(spark, sf).withColumn("day", F.col("date"))
    keyed_rows = messages.as_messages(whole.withColumn("key", F.col("symbol")), keep=("day", "key"))
    path = storage.new_path(spark, "replay")
    store_in_order(keyed_rows, path, ("day", "key"), REPLAY_ROWS)
    return replay_stream(spark, path, REPLAY_ROWS)


@query
def stream_replay_batches(spark, sf):
    """What every batch of a replay held: so many rows, the next ones in order. The query is
    stopped after its first batch and started again."""
    path, progress = storage.new_path(spark, "sink"), storage.new_path(spark, "progress")
    stream = _replayed(spark, sf)

    def first_only(batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            raise InterruptedError("stopped")
        batches.commit(batch, path, batch_id)

    cut_off = sinks.each_batch(stream, first_only, progress, filled=True)
    try:
        sinks.caught_up(cut_off)
    except StreamingQueryException as error:
        if "stopped" not in str(error):
            raise
    rest = sinks.each_batch(
        stream, lambda b, i: batches.commit(b, path, i), progress, filled=True
    )
    sinks.caught_up(rest)
    key = F.col("key").cast("long")
    place = F.datediff("day", F.lit("1970-01-01")).cast("long")
    return batches.read(spark, path).groupBy("batch_id").agg(
        F.count("*").alias("n_rows"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.sum(key).alias("symbols"),
        F.sum(place * key).alias("days_and_symbols"),
    )


def _scored(spark: SparkSession, sf: str) -> dict[str, str]:
    """Run the scoring stream with the rule models; where its three outputs are."""
    topic = publish(keyed_messages(spark, sf), "topic")
    out = {n: storage.new_path(spark, n) for n in ("predictions", "dead", "metrics")}
    names = list(rule_models())
    write = scoring.scoring_writer(
        lambda df: score.chain(df, rule_models()),
        names,
        out["predictions"],
        flags=True,
        dead_letters=out["dead"],
        metrics=out["metrics"],
    )
    texts = scoring.spread(messages.folder_stream(spark, topic, files_per_trigger=4))
    stream = scoring.bars_from_messages(texts)
    progress = storage.new_path(spark, "progress")
    sinks.drained(sinks.each_batch(stream, write, progress, **DRAIN))
    return out


@query
def stream_score(spark, sf):
    rows = batches.read(spark, _scored(spark, sf)["predictions"])
    return rows.withColumn("timed", F.col("latency_ms") >= 0).drop("latency_ms", "batch_id")


@query
def stream_dead_letters(spark, sf):
    rows = batches.read(spark, _scored(spark, sf)["dead"])
    whole = F.get_json_object("value", "$.Target")
    return rows.agg(F.count("*").alias("n_dead"), F.count(whole).alias("n_readable"))


@query
def stream_metrics(spark, sf):
    totals = scoring.running_metrics(batches.read(spark, _scored(spark, sf)["metrics"]))
    return totals.drop("max_latency_ms").withColumn("accuracy", F.round("accuracy", 6))


def _windows_in_halves(
    spark: SparkSession, rows: DataFrame, early: Column, windows: Windows
) -> DataFrame:
    """Drain a topic of the early rows, add the late ones and drain again; all rows of the sink.
    ``rows``, a table handed over, is deleted once all of them are messages."""
    topic = publish(messages.as_messages(rows.where(early)), "topic")
    sink, progress = storage.new_path(spark, "sink"), storage.new_path(spark, "progress")

    def write(batch: DataFrame, batch_id: int) -> None:
        with storage.temporary(spark):
            sinks.write_batch(windows(batch, batch_id), sink, batch_id)

    def drain() -> None:
        parsed = messages.parse(messages.folder_stream(spark, topic), SYMBOL_SCHEMA)
        sinks.drained(sinks.each_batch(dated(to_internal(parsed)), write, progress, **DRAIN))

    drain()
    publish_more(messages.as_messages(rows.where(~early)), topic)
    storage.drop(rows)
    drain()
    return written(spark, sink)


@query
def stream_sequences(spark, sf):
    """The last five feature rows per symbol, remembered over a restart between two halves."""
    rows = storage.hand_over(rounded_features(spark, sf), "features", "zstd")
    early = F.year("date") < 1998
    windows = windows_of(storage.new_path(spark, "state"))
    found = _windows_in_halves(spark, rows, early, windows)
    text = sequences.as_text(F.col("sequence"))
    return found.select("symbol", "date", text.alias("sequence"))


def _in_halves(spark: SparkSession, early: DataFrame, late: DataFrame, follow) -> DataFrame:
    """Drain a topic of the early rows through a stateful stream, add the late ones, start again
    from the checkpoint; all rows of the sink."""
    topic = publish(messages.as_messages(early), "topic")
    sink, progress = storage.new_path(spark, "sink"), storage.new_path(spark, "progress")

    def drain() -> None:
        parsed = messages.parse(messages.folder_stream(spark, topic), SYMBOL_SCHEMA)
        sinks.drained(sinks.to_files(follow(dated(to_internal(parsed))), sink, progress, **DRAIN))

    drain()
    publish_more(messages.as_messages(late), topic)
    drain()
    return written(spark, sink)


@query
def stream_keyed_sequences(spark, sf):
    """The last five feature rows per symbol from the engine's state store, over a restart."""
    rows = storage.hand_over(rounded_features(spark, sf), "features", "zstd")
    early = F.year("date") < 1998
    found = _in_halves(spark, rows.where(early), rows.where(~early), keyed.sequences)
    text = sequences.as_text(F.col("sequence"))
    return found.select("symbol", "date", text.alias("sequence"))


@query
def stream_bar_features(spark, sf):
    """Averages, returns and labels of raw prices that arrive as messages, over a restart: what the
    table of bars gives, but for the last bar of a symbol, whose label is not known yet."""
    rows = storage.hand_over(supplier_bars(spark, sf), "bars", "zstd")
    early = F.year("date") < 1998
    found = _in_halves(spark, rows.where(early), rows.where(~early), keyed.bar_features)
    return found.withColumns({c: F.round(c, 6) for c in ("sma5", "sma10")})


@query
def stream_running_metrics(spark, sf):
    """Counts and quantiles per model as state of the stream; the quantiles of the close against the
    ranks that all closes give them."""
    table_ = storage.hand_over(rounded_features(spark, sf), "features", "zstd")
    topic = publish(messages.as_messages(table_), "topic")
    stream = to_internal(
        messages.parse(messages.folder_stream(spark, topic, files_per_trigger=2), SYMBOL_SCHEMA)
    )
    scored = score.chain(stream, rule_models())
    long = score.long_predictions(scored, list(rule_models()), keep=("close",))
    path = storage.new_path(spark, "totals")
    totals = scoring.running_totals(long, "close")
    progress = storage.new_path(spark, "progress")
    sinks.drained(
        sinks.each_batch(
            totals, lambda b, i: sinks.write_batch(b, path, i), progress, mode="complete", **DRAIN
        )
    )
    stored = written(spark, path)
    newest = stored.where(F.col("batch_id") == stored.agg(F.max("batch_id")).first()[0])
    read = scoring.read_totals(newest)
    ranks = [F.avg((F.col("close") <= F.col(f"p{p}")).cast("double")).alias(f"r{p}") for p in (50, 90, 99)]
    each = score.long_predictions(
        score.chain(table_, rule_models()), list(rule_models()), keep=("close",)
    ).select("model", "close")
    found = each.join(read.select("model", "p50", "p90", "p99"), "model").groupBy("model").agg(*ranks)
    near = F.lit(True)
    for p in (50, 90, 99):
        near = near & (F.abs(F.col(f"r{p}") - p / 100) <= 0.02)
    return read.join(found, "model").select(
        "model", "n_rows", "n_correct", F.round("accuracy", 6).alias("accuracy"), near.alias("near")
    )


@query
def stream_hot_sequences(spark, sf):
    """Windows of three prices over all events under their few types, which count as heavy keys."""
    kinds = F.array(*[F.lit(t) for t in event_types(spark, sf)])
    rows = table(spark, sf, "events").select(
        F.array_position(kinds, F.col("event_type")).alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_id").cast("double").alias("open"),
        F.col("value").alias("close"),
    )
    rows = storage.hand_over(rows, "events")
    early = F.col("open") < rows.agg(F.avg("open")).first()[0]
    windows = windows_of(
        storage.new_path(spark, "state"), 3, ["close"], ["open"], slab_rows=TYPE_SLAB_ROWS
    )
    found = _windows_in_halves(spark, rows, early, windows)
    return found.select(
        F.element_at(kinds, F.col("symbol").cast("int")).alias("symbol"),
        F.col("open").cast("long").alias("seq"),
        sequences.as_text(F.col("sequence")).alias("sequence"),
    )


@query
def stream_prediction_json(spark, sf):
    """Bars in, predictions out, both as JSON; read back from the sink."""
    topic = publish(keyed_messages(spark, sf), "topic")
    names = {"LR": "lr_pred", "RF": "rf_pred", "XGB": "gbt_pred", "LSTM": "lstm_pred"}

    def predict(df: DataFrame) -> DataFrame:
        return score.chain(df, rule_models()).withColumn("lstm_pred", F.lit(None).cast("int"))

    stream = scoring.json_predictions(messages.folder_stream(spark, topic), predict, names)
    path = run(spark, lambda p, c: sinks.to_files(stream, p, c, **DRAIN))
    fields = [T.StructField("Date", T.StringType())]
    fields += [T.StructField(f"{n}_Prediction", T.IntegerType()) for n in names]
    parsed = messages.parse(written(spark, path), T.StructType(fields))
    return parsed.withColumnsRenamed({c: c.lower() for c in parsed.columns})


@query
def stream_sequence_score(spark, sf):
    """Serving a sequence model: stored scaling, remembered rows, fitted net. Every row gets what
    the table gets: nothing before the fifth row of a symbol, then the net's answer."""
    bars = storage.hand_over(feature_table(spark, sf), "features", "zstd")
    params = storage.hand_over(features.scaler_params(bars), "scaler")
    scaled = features.scale_with(bars, params)
    windows = storage.hand_over(
        sequences.add_sequences(ordered_daily(scaled), 5, include_current=True)
        .rows()
        .select("symbol", "date", "sequence", F.col("target").cast("double").alias("target")),
        "windows",
        "zstd",
    )
    training = models.sequence_vectors(sequences.complete_sequences(windows))
    net = models.sequence_net()
    fitted = models.fit_all(training, {"lstm": net}, stages=list)["lstm"]
    width = 5 * len(FEATURES)

    topic = publish(messages.as_messages(bars), "topic")
    storage.drop(bars)
    parsed = dated(to_internal(messages.parse(messages.folder_stream(spark, topic), SYMBOL_SCHEMA)))
    windows_for = windows_of(storage.new_path(spark, "state"))
    path = storage.new_path(spark, "sink")

    def write(batch: DataFrame, batch_id: int) -> None:
        scaled_batch = features.scale_with(batch, params)
        with storage.temporary(spark):
            rows = windows_for(scaled_batch, batch_id)
            found = models.predict_sequences(rows, "lstm", fitted, width)
            sinks.write_batch(found.drop("sequence"), path, batch_id)

    sinks.drained(sinks.each_batch(parsed, write, storage.new_path(spark, "progress"), **DRAIN))
    batch = models.predict_sequences(windows, "lstm", fitted, width)
    batch = batch.select("symbol", "date", F.col("lstm_pred").alias("batch_pred"))
    both = written(spark, path).join(batch, ["symbol", "date"], "full")
    return both.select(
        "symbol",
        "date",
        F.col("lstm_pred").isNotNull().alias("answered"),
        F.col("lstm_pred").eqNullSafe(F.col("batch_pred")).alias("same"),
    )


@query
def stream_score_map(spark, sf):
    """A fitted pipeline applied to the stream agrees with the same pipeline on the table."""
    rows = storage.hand_over(split.chronological(feature_rows(spark, sf)).rows(), "marked")
    fitted = models.fit_all(
        models.training_rows(split.train_rows(rows)), {"rf": models.random_forest()}
    )
    test = split.test_rows(rows)
    topic = publish(messages.as_messages(test), "topic")
    parsed = messages.parse(messages.folder_stream(spark, topic), SYMBOL_SCHEMA)
    stream = models.predict(dated(to_internal(parsed)), fitted).select("symbol", "date", "rf_pred")
    path = run(spark, lambda p, c: sinks.to_files(stream, p, c, **DRAIN))
    again = models.predict(test, fitted).select("symbol", "date", F.col("rf_pred").alias("batch_pred"))
    both = written(spark, path).join(again, ["symbol", "date"], "full")
    return both.select("symbol", "date", F.col("rf_pred").eqNullSafe(F.col("batch_pred")).alias("same"))


@query
def stream_score_fitted(spark, sf):
    """Three fitted models in one chain inside ``foreachBatch``; every prediction with its symbol
    equals the one for the table."""
    rows = storage.hand_over(split.chronological(feature_rows(spark, sf)).rows(), "marked")
    recipes = {
        "lr": models.logistic(),
        "rf": models.random_forest(),
        "gbt": models.boosted_trees(),
    }
    fitted = models.fit_all(models.training_rows(split.train_rows(rows)), recipes)
    test = split.test_rows(rows)
    topic = publish(messages.as_messages(test), "topic")
    sink = storage.new_path(spark, "predictions")
    write = scoring.scoring_writer(
        lambda df: models.predict(df, fitted), list(recipes), sink, keep=("symbol", "date")
    )
    texts = scoring.spread(messages.folder_stream(spark, topic, files_per_trigger=2))
    stream = scoring.bars_from_messages(texts, SYMBOL_SCHEMA)
    sinks.drained(sinks.each_batch(stream, write, storage.new_path(spark, "progress"), **DRAIN))
    batch = models.predict(test, fitted).select(
        "symbol", "date", *[F.col(f"{n}_pred").alias(f"{n}_batch") for n in recipes]
    )
    both = dated(batches.read(spark, sink)).join(batch, ["symbol", "date"], "full")
    same = F.lit(True)
    for n in recipes:
        same = same & F.col(f"{n}_pred").isin(0.0, 1.0) & (F.col(f"{n}_pred") == F.col(f"{n}_batch"))
    return both.select("symbol", "date", "target", F.coalesce(same, F.lit(False)).alias("same"))


@query
def stream_score_by_symbol(spark, sf):
    """One stream with the messages of all suppliers, each scored by its own models, which are
    tables keyed by symbol; a planted label."""
    marked = split.chronological(feature_rows(spark, sf)).rows()
    rows = storage.hand_over(
        marked.withColumn("target", (F.col("ret1") > 0).cast("int")), "marked"
    )
    root, out = storage.new_path(spark, "models"), storage.new_path(spark, "live")
    training = split.train_rows(rows)
    keyed_models.save(logistic_by_key.fit_by_key(training, l2=0.001), root, "lr")
    keyed_models.save(trees_by_key.forest_by_key(training, trees=10, depth=4), root, "rf")
    topic = publish(messages.as_messages(split.test_rows(rows).drop("is_train")), "topic")
    stream = messages.folder_stream(spark, topic)
    progress = storage.new_path(spark, "progress")
    sinks.drained(
        keyed_models.score_stream(stream, root, ["lr", "rf"], out, progress, symbol="long", **DRAIN)
    )
    live = batches.read(spark, f"{out}/predictions")
    long = score.long_predictions(live, ["lr", "rf"])
    right = (F.col("predicted") == F.col("actual")).cast("double")
    return long.groupBy("model").agg(
        F.count("*").alias("n_rows"),
        F.sum("actual").alias("n_up"),
        F.bool_and(F.col("predicted").isin(0, 1)).alias("classes"),
        (F.avg(right) >= 0.9).alias("learned"),
    )
