"""Moving averages, returns, label and per-key min-max scaling."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barweave.functions import columns as C
from barweave.operators.ordered import OrderedRows
from barweave.schema import FEATURES

# Rows behind and ahead that the features and the label look at.
_BACK, _AHEAD = 9, 1


def add_averages(bars: OrderedRows, price: str = "close") -> OrderedRows:
    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        p = F.col(price)
        return df.withColumns(
            {"sma5": C.moving_average(p, 5, w), "sma10": C.moving_average(p, 10, w)}
        )

    return bars.framed(9, 0, compute)


def add_returns(bars: OrderedRows, price: str = "close") -> OrderedRows:
    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        p = F.col(price)
        return df.withColumns({"ret1": C.pct_change(p, 1, w), "ret5": C.pct_change(p, 5, w)})

    return bars.framed(5, 0, compute)


def _label(price: Column, w: WindowSpec, tail: str) -> Column:
    if tail not in ("zero", "null"):
        raise ValueError("tail is 'zero' or 'null'")
    label = C.next_is_higher(price, w)
    return F.coalesce(label, F.lit(0)) if tail == "zero" else label


def add_target(bars: OrderedRows, price: str = "close", tail: str = "zero") -> OrderedRows:
    """1 when the next bar closes higher. The last bar has no next one: 0, or NULL on request."""
    return bars.framed(
        0, 1, lambda df, w: df.withColumn("target", _label(F.col(price), w, tail))
    )


def add_features(bars: OrderedRows, price: str = "close", tail: str = "zero") -> OrderedRows:
    """All four derived features and the label over one window, hence one exchange."""

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        p = F.col(price)
        return df.withColumns(
            {
                "sma5": C.moving_average(p, 5, w),
                "sma10": C.moving_average(p, 10, w),
                "ret1": C.pct_change(p, 1, w),
                "ret5": C.pct_change(p, 5, w),
                "target": _label(p, w, tail),
            }
        )

    return bars.framed(_BACK, _AHEAD, compute)


def scaler_params(
    df: DataFrame, columns: Sequence[str] = FEATURES, key: str = "symbol"
) -> DataFrame:
    """Fitted scaler as a table: one row per (key, column). Partial aggregation before the shuffle
    keeps a heavy key at one row per task."""
    low_high = [f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    per_key = df.groupBy(key).agg(*low_high)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_lo_{c}").alias("min"),
            F.col(f"_hi_{c}").alias("max"),
        )
        for c in columns
    ]
    return per_key.select(key, F.inline(F.array(*entries)))


def scale(
    bars: OrderedRows, columns: Sequence[str] = FEATURES, fit_when: Column | None = None
) -> OrderedRows:
    """Map every column to [0, 1] with the minimum and maximum of its key.

    ``fit_when`` restricts the rows the bounds are taken from (training rows only, say); the
    default fits on all rows.
    """

    def fitted(c: str) -> Column:
        return F.col(c) if fit_when is None else F.when(fit_when, F.col(c))

    bounds = {f"_lo_{c}": F.min(fitted(c)) for c in columns}
    bounds |= {f"_hi_{c}": F.max(fitted(c)) for c in columns}
    scaled = {c: C.min_max(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in columns}
    return bars.key_values(**bounds).map(lambda df: df.withColumns(scaled).drop(*bounds))


def scale_with(
    df: DataFrame, params: DataFrame, columns: Sequence[str] = FEATURES, key: str = "symbol"
) -> DataFrame:
    """Apply a stored scaler (see ``scaler_params``) to new rows.

    No hint: the stored table has file statistics, so Catalyst broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise merges, with skewed keys split by AQE.
    """
    wide = params.groupBy(key).agg(
        *[
            F.max(F.when(F.col("column") == c, F.col(n))).alias(f"_{n}_{c}")
            for c in columns
            for n in ("min", "max")
        ]
    )
    scratch = [f"_{n}_{c}" for c in columns for n in ("min", "max")]
    return (
        df.join(wide, key, "left")
        .withColumns({c: C.min_max(F.col(c), F.col(f"_min_{c}"), F.col(f"_max_{c}")) for c in columns})
        .drop(*scratch)
    )
