"""JSON messages: topics, text folders and the publisher.

Every source yields a ``value`` column; every sink takes one. Kafka needs the
``spark-sql-kafka-0-10`` package on the class path, text folders need nothing.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.functions import columns as C
from barweave.schema import DERIVED_COLUMNS, EXTERNAL_NAMES, FEATURES, message_schema, to_external


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting: str = "latest",
    group_id: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Source options. ``starting`` counts only for a query without a checkpoint, and progress is
    kept in the checkpoint, not in the consumer group."""
    if starting not in ("latest", "earliest"):
        raise ValueError("starting is 'latest' or 'earliest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load().select("value")


def folder_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text files as a message stream; a file limit paces the replay."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def topic_snapshot(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The whole topic from its first to its current last message, as a bounded table."""
    options = kafka_options(servers, topic, starting="earliest") | {"endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load().select("value")


def folder_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse(messages: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Bytes or text to typed columns. Text that is no JSON object gives a row of NULLs.

    The same function serves batch and stream. Other columns of ``messages`` are kept. The struct is
    flattened by a generator, because a later filter on several fields would otherwise be pushed
    below the flattening with one parse per field.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema or message_schema())
    kept = [c for c in messages.columns if c != "value"]
    return messages.select(*kept, F.inline_outer(F.array(parsed)))


def as_messages(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column of ``df`` in one JSON object per row, NULLs written out."""
    body = to_external(df.drop(*keep))
    return to_external(df).select(
        *keep,
        F.to_json(F.struct(*body.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def as_typed_messages(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ten-field message: date as text, numbers as double.

    A derived column the table lacks is 0; a NULL in a present column stays NULL.
    """
    missing = [c for c in DERIVED_COLUMNS if c not in df.columns]
    full = df.withColumns({c: F.lit(0.0) for c in missing}) if missing else df
    fields = [F.col("date").cast("string").alias(EXTERNAL_NAMES["date"])]
    fields += [F.col(c).cast("double").alias(EXTERNAL_NAMES[c]) for c in FEATURES]
    return full.select(
        *keep, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    )


def publish_topic(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_folder(
    messages: DataFrame, path: str, mode: str = "append", compression: str = "none"
) -> None:
    """``compression`` names a codec that Spark's text reader knows by the files' suffix, as gzip."""
    messages.select("value").write.mode(mode).option("compression", compression).text(path)


def prediction_messages(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Prediction rows as JSON; ``names`` maps the JSON prefix to the prediction column."""
    return df.withColumn(
        "value", C.prediction_json(F.col("date"), {k: F.col(v) for k, v in names.items()})
    )
