"""Column expressions. All stay inside Catalyst and none throws on bad data under ANSI mode."""

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from barweave.schema import FAILED, FEATURES, MATCH_TEXT, MISMATCH_TEXT, RESULT_DATE_FORMAT

# Accepted spellings of a date, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss")


def coerce_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date from text in any accepted format; NULL when none fits."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def moving_average(value: Column, rows: int, w: WindowSpec) -> Column:
    """Mean of the last ``rows`` rows, of fewer at the start."""
    return F.avg(value).over(w.rowsBetween(1 - rows, 0))


def pct_change(value: Column, rows: int, w: WindowSpec) -> Column:
    """Relative change against ``rows`` rows earlier; 0 where there is no such row or it is 0."""
    return F.coalesce(F.try_divide(value, F.lag(value, rows).over(w)) - 1, F.lit(0.0))


def next_is_higher(value: Column, w: WindowSpec) -> Column:
    """1 if the next row is higher, 0 if not, NULL on the last row."""
    return (F.lead(value, 1).over(w) > value).cast("int")


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Linear map of [low, high] to [0, 1]; a constant column maps to 0, NULL stays NULL."""
    return F.when(value.isNotNull() & (low == high), F.lit(0.0)).otherwise(
        F.try_divide(value - low, high - low)
    )


def default_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def complete(columns: Sequence[str] = FEATURES) -> Column:
    """True when every column holds a number."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return ok


def or_failed(ok: Column, prediction: Column) -> Column:
    """The prediction for rows that can be scored, the failure mark for the others."""
    return F.when(ok, prediction.cast("int")).otherwise(F.lit(FAILED))


def over_threshold(probability: Column, threshold: float = 0.5) -> Column:
    """1 if strictly above the threshold. NaN never is, although Spark sorts it above all."""
    return F.when(F.isnan(probability), F.lit(0)).otherwise(
        (probability > threshold).cast("int")
    )


def agrees(prediction: Column, actual: Column) -> Column:
    return prediction == actual


def match_text(actual: Column, predicted: Column) -> Column:
    return F.when(actual == predicted, F.lit(MATCH_TEXT)).otherwise(F.lit(MISMATCH_TEXT))


def result_date(date: Column) -> Column:
    return F.date_format(date, RESULT_DATE_FORMAT)


def latency_ms(start: Column, end: Column) -> Column:
    """Elapsed milliseconds, not whole seconds times 1000."""
    return F.unix_millis(end) - F.unix_millis(start)


def prediction_json(date: Column, predictions: dict[str, Column]) -> Column:
    """One JSON object per prediction row, with explicit nulls."""
    fields = [date.cast("string").alias("Date")]
    fields += [p.alias(f"{name}_Prediction") for name, p in predictions.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
