"""Bars derived from transaction tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.operators.ordered import OrderedRows
from barweave.schema import MAX_DAILY_ROWS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _packed(high: Column, low: Column) -> Column:
    """Two non-negative bigints as one DECIMAL that sorts like the pair.

    ``min_by`` over a struct forces sort-based aggregation of the raw rows. A decimal is a
    fixed-width buffer, so the same aggregate hashes, and nineteen digits hold any bigint.
    """
    digits = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    return (high.cast("decimal(19,0)") * digits + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def daily_bars(trades: DataFrame) -> DataFrame:
    """Open, high, low, close and volume per symbol and day.

    ``trades`` has symbol, date, price, amount and ``order``, which ranks the trades of a day.
    """
    return trades.groupBy("symbol", "date").agg(
        F.min_by("price", "order").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "order").alias("close"),
        F.sum("amount").alias("volume"),
    )


def event_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per event type, ordered by (ts, event_id); volume is the number of events."""
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.date_part(F.lit("SECOND"), "ts")
    micros = (seconds * 1_000_000).cast("long")
    trades = table(spark, folder, "events").select(
        F.col("event_type").alias("symbol"),
        F.to_date("ts").alias("date"),
        F.col("value").alias("price"),
        F.lit(1.0).alias("amount"),
        _packed(micros, F.col("event_id")).alias("order"),
    )
    return daily_bars(trades)


def supplier_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per supplier; the price is the extended price, the volume the quantity.

    A day's trades are ordered by (l_orderkey, l_linenumber, price). Rows of one order line are
    reduced to their lowest and highest price first, so any price ranks exactly and both
    aggregations hash.
    """
    trades = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("amount"),
        _packed(F.col("l_orderkey"), F.col("l_linenumber").cast("long")).alias("order"),
    )
    return line_bars(trades)


def line_bars(trades: DataFrame) -> DataFrame:
    """Daily bars of trades that may share an ``order``; the price decides among those."""
    lines = trades.groupBy("symbol", "date", "order").agg(
        F.min("price").alias("low"), F.max("price").alias("high"), F.sum("amount").alias("amount")
    )
    return lines.groupBy("symbol", "date").agg(
        F.min_by("low", "order").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("high", "order").alias("close"),
        F.sum("amount").alias("volume"),
    )


def ordered_daily(bars: DataFrame) -> OrderedRows:
    """Daily bars are unique per (symbol, date) by their group-by, which bounds a symbol's rows."""
    return OrderedRows.arrange(bars, ("symbol",), ("date",), rows_bound=MAX_DAILY_ROWS)


def event_types(spark: SparkSession, folder: str) -> list[str]:
    """The event types of the table, which name data sets a person configures."""
    names = table(spark, folder, "events").where("event_type is not null").select("event_type")
    return sorted(r.event_type for r in names.distinct().toLocalIterator())


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Single events as a price series per user."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("symbol"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
    )


def ordered_ticks(rows: DataFrame) -> OrderedRows:
    """Ticks have no bound per symbol: the key sizes are measured."""
    return OrderedRows.arrange(rows, ("symbol",), ("ts", "seq"))
