"""Cleaning: dates, gaps, incomplete rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.functions import columns as C
from barweave.operators.ordered import OrderedRows
from barweave.schema import DERIVED_COLUMNS, FEATURES, PRICE_COLUMNS


def coerce_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """Turn text into dates and drop rows whose text is no date."""
    return df.withColumn(column, C.coerce_date(F.col(column))).where(F.col(column).isNotNull())


def normalise_nan(df: DataFrame, columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """NaN becomes NULL, so that one notion of 'missing' holds from here on."""
    return df.withColumns({c: C.nan_to_null(F.col(c)) for c in columns})


def fill_gaps(
    bars: OrderedRows, columns: Sequence[str] = PRICE_COLUMNS, *, leading: bool = True
) -> OrderedRows:
    """Forward fill per key; with ``leading`` the gap at the start takes the first known value."""
    return bars.fill(columns, leading=leading)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without NULL or NaN."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def default_derived(df: DataFrame) -> DataFrame:
    """Missing derived features become 0; missing prices stay missing."""
    return df.withColumns({c: C.default_zero(F.col(c)) for c in DERIVED_COLUMNS})


def drop_label_and_date(df: DataFrame) -> DataFrame:
    """Everything but the date and the label."""
    return df.drop("target", "date")


def routed(df: DataFrame, required: Sequence[str] = FEATURES) -> DataFrame:
    """One pass: ``route`` says whether a row can be scored or belongs to the dead letters."""
    route = F.when(C.complete(required), F.lit("scored")).otherwise(F.lit("dead letter"))
    return df.withColumn("route", route)


def split_valid(df: DataFrame, required: Sequence[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """(rows that can be scored, rows for the dead-letter table)."""
    ok = C.complete(required)
    return df.where(ok), df.where(~ok)
