"""Scoring message streams."""

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.functions import columns as C
from barweave.operators.clean import split_valid
from barweave.operators.score import long_predictions, with_flags
from barweave.schema import FEATURES, to_internal
from barweave.sources.messages import parse, prediction_messages
from barweave.storage import temporary
from barweave.streaming.batches import commit
from barweave.streaming.sinks import BatchWriter, stamped


def bars_from_messages(messages: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Parse, flatten, stamp: the start of every scoring stream, usable on a batch frame too.

    The message text stays in ``value`` for the dead-letter table.
    """
    kept = messages.withColumn("text", F.col("value").cast("string"))
    return stamped(to_internal(parse(kept, schema)).withColumnRenamed("text", "value"))


def spread(messages: DataFrame) -> DataFrame:
    """The messages of a batch dealt out to all cores. A packed file is read by one task, so a batch
    of few files would otherwise be parsed and scored by as few."""
    tasks = messages.sparkSession.sparkContext.defaultParallelism
    return messages.repartition(tasks, F.xxhash64("value"))


def json_predictions(
    stream: DataFrame, predict: Callable[[DataFrame], DataFrame], names: dict[str, str]
) -> DataFrame:
    """Message by message from bar to prediction, both as JSON; nothing is kept between rows.

    ``names`` maps the JSON prefix to a prediction column; a model without an answer writes null.
    """
    good, _ = split_valid(bars_from_messages(stream).drop("value"))
    return prediction_messages(predict(good), names).select("value")


def scoring_writer(
    predict: Callable[[DataFrame], DataFrame],
    models: Sequence[str],
    path: str,
    *,
    dead_letters: str | None = None,
    metrics: str | None = None,
    flags: bool = False,
    keep: Sequence[str] = ("date",),
    required: Sequence[str] = FEATURES,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> BatchWriter:
    """Score one batch and write predictions, unusable messages and per-model counts.

    ``flags`` adds whether each model was right. ``prepare`` changes the usable rows of a batch,
    given its id, before they are scored.
    The parsed batch is stored while it feeds the outputs. Every output is a table of committed
    batches, to be read with ``batches.read``; what a batch hands over is deleted at its end.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with temporary(batch.sparkSession):
                outputs(batch, batch_id)
        finally:
            batch.unpersist()

    def outputs(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_valid(batch, required)
        if prepare is not None:
            good = prepare(good, batch_id)
        scored = predict(good).withColumn(
            "latency_ms", C.latency_ms(F.col("ingest_time"), F.current_timestamp())
        )
        columns = [*keep, *[f"{m}_pred" for m in models], "target", "latency_ms"]
        if flags:
            scored = with_flags(scored, models)
            columns += [f"{m}_correct" for m in models]
        commit(scored.select(*columns), path, batch_id)
        if dead_letters:
            commit(bad.select("value", "ingest_time"), dead_letters, batch_id)
        if metrics:
            commit(batch_metrics(scored, models), metrics, batch_id)

    return write


def batch_metrics(scored: DataFrame, models: Sequence[str]) -> DataFrame:
    """Per model: rows, rows with a label, correct ones, largest latency. Sums of these over
    batches give the running accuracy."""
    return (
        long_predictions(scored, models, keep=("latency_ms",))
        .groupBy("model")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("actual").alias("n_labelled"),
            F.count_if(F.col("predicted") == F.col("actual")).alias("n_correct"),
            F.max("latency_ms").alias("max_latency_ms"),
        )
    )


def running_metrics(batches: DataFrame) -> DataFrame:
    """Totals over the batch rows written so far."""
    return batches.groupBy("model").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_correct").alias("n_correct"),
        F.try_divide(F.sum("n_correct").cast("double"), F.sum("n_labelled").cast("double")).alias(
            "accuracy"
        ),
        F.max("max_latency_ms").alias("max_latency_ms"),
    )


def running_totals(long: DataFrame, measure: str = "latency_ms") -> DataFrame:
    """Totals per model over a whole stream of long predictions, as a streaming aggregation.

    The engine keeps one row of state for each model: counts, and a KLL sketch of ``measure`` that
    tasks merge, whose quantiles are within about 1.7 % of the rank. Write it in complete mode.
    """
    right = F.col("predicted") == F.col("actual")
    return long.groupBy("model").agg(
        F.count("*").alias("n_rows"),
        F.count("actual").alias("n_labelled"),
        F.count_if(right).alias("n_correct"),
        F.max(measure).alias(f"max_{measure}"),
        F.kll_sketch_agg_double(F.col(measure).cast("double")).alias("sketch"),
    )


def read_totals(totals: DataFrame, shares: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Accuracy and quantiles from the rows of ``running_totals``; quantiles p50, p90 and so on."""
    quantiles = {
        f"p{round(100 * q)}": F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for q in shares
    }
    accuracy = F.try_divide(F.col("n_correct").cast("double"), F.col("n_labelled").cast("double"))
    return totals.withColumns({"accuracy": accuracy, **quantiles}).drop("sketch")
