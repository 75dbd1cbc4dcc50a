"""Running streams and writing their batches."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]

_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_BY_FILE_SYSTEM = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)


@contextmanager
def _own_progress(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """For queries started inside whose progress is on a local file system: renames there go through
    its own interface. The usual one starts a process for every rename, several for each batch. The
    files are the same; a manager that the session names stays."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme != "file" or spark.conf.get(_MANAGER, None):
        yield
        return
    spark.conf.set(_MANAGER, _BY_FILE_SYSTEM)
    try:
        yield
    finally:
        spark.conf.unset(_MANAGER)


def _started(writer: DataStreamWriter, stream: DataFrame, checkpoint: str) -> StreamingQuery:
    with _own_progress(stream.sparkSession, checkpoint):
        return writer.option("checkpointLocation", checkpoint).start()


def trigger(every: str | None = None, *, drain: bool = False) -> dict:
    """Keyword for ``writer.trigger``: a fixed interval, or drain the input and stop. Without
    either, batches follow each other as fast as they can."""
    if drain:
        return {"availableNow": True}
    return {"processingTime": every or "0 seconds"}


def paced(rows_per_second: float, seconds: int = 1) -> tuple[int, dict]:
    """(rows per trigger, trigger) that replay at most this many rows per second; rates below one
    count as one."""
    return int(max(rows_per_second, 1) * seconds), trigger(f"{seconds} seconds")


def show_batch(batch: DataFrame, batch_id: int) -> None:
    """Print the first twenty rows of a batch in full, a writer for ``each_batch``."""
    print(f"batch {batch_id}")
    batch.show(20, truncate=False)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch under its id. A batch replayed after a failure replaces itself."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}", compression="zstd")


def each_batch(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    *,
    mode: str = "append",
    filled: bool = False,
    **when: object,
) -> StreamingQuery:
    """Hand every non-empty micro-batch to ``write``; in complete mode all results so far.

    ``filled`` says that every batch of the source has rows, as those of a replay do, which saves
    the job that looks for one.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if filled or not batch.isEmpty():
            write(batch, batch_id)

    writer = stream.writeStream.foreachBatch(guarded).outputMode(mode)
    return _started(writer.trigger(**(when or trigger())), stream, checkpoint)


def to_files(
    stream: DataFrame, path: str, checkpoint: str, **when: object
) -> StreamingQuery:
    """Append to a parquet folder; Spark's file log makes this exactly-once."""
    writer = stream.writeStream.format("parquet").option("path", path).option("compression", "zstd")
    writer = writer.outputMode("append").trigger(**(when or trigger()))
    return _started(writer, stream, checkpoint)


def to_console(stream: DataFrame, checkpoint: str, rows: int = 20, **when: object) -> StreamingQuery:
    """Print the first rows of every batch, untruncated."""
    return (
        stream.writeStream.format("console")
        .option("truncate", False)
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(when or trigger()))
        .start()
    )


def drained(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself and pass on its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def caught_up(query: StreamingQuery) -> None:
    """Wait until a query has taken in all that its source has now, then stop it; pass on its
    failure."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def stamped(messages: DataFrame) -> DataFrame:
    """Add the time a row was taken in, the same for all rows of a batch."""
    return messages.withColumn("ingest_time", F.current_timestamp())
