"""Small frames for the tests."""

import datetime as dt

from pyspark.sql import functions as F

START = dt.date(2024, 1, 1)


def day(i):
    return START + dt.timedelta(days=i)


def price_rows(spark, closes, symbol="a"):
    """Bars of one symbol with these closes on consecutive days."""
    rows = [(symbol, day(i), c) for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    return df.select(
        "symbol",
        "date",
        *[F.col("close").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"),
    )


def column(df, name, by="date"):
    return [r[0] for r in df.orderBy(by).select(name).collect()]


def same_rows(a, b):
    """Equal as multisets, duplicates counted."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
