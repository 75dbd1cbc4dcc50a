"""Bar files: readers chosen by suffix, CSV sink, several symbols side by side."""

from collections.abc import Mapping
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.schema import RAW_BARS


def read_bars(
    spark: SparkSession, path: str, schema: T.StructType | None = RAW_BARS
) -> DataFrame:
    """Read a bar file or folder; its suffix names the format.

    ``schema=None`` keeps all columns and lets Spark infer the types. Otherwise columns are matched
    by name, in any order and case, whatever types the file has; a value that does not fit its
    type becomes NULL. Inferring types, and finding the fields of JSON, cost a pass over the data.
    """
    suffix = PurePosixPath(path).suffix.lower().removeprefix(".")
    if suffix not in ("csv", "parquet", "json"):
        raise ValueError("Unsupported file format")
    if suffix == "csv":
        table = spark.read.csv(path, header=True, inferSchema=schema is None)
    elif suffix == "json":
        table = spark.read.json(path, primitivesAsString=schema is not None)
    else:
        table = spark.read.parquet(path)
    return table if schema is None else _typed(table, schema)


def _typed(table: DataFrame, schema: T.StructType) -> DataFrame:
    known = {c.lower(): F.col(f"`{c}`") for c in table.columns}
    return table.select(
        *[
            known.get(f.name.lower(), F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """A folder of CSV parts with headers, replacing what was there."""
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)


def union_symbols(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Put the data sets of several symbols into one table with a ``symbol`` column."""
    if not frames:
        raise ValueError("no symbols given")
    tagged = [df.withColumn("symbol", F.lit(symbol)) for symbol, df in frames.items()]
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def read_symbols(
    spark: SparkSession, paths: Mapping[str, str], schema: T.StructType | None = RAW_BARS
) -> DataFrame:
    return union_symbols({s: read_bars(spark, p, schema) for s, p in paths.items()})
