"""Row-order work (lags, rolling frames, fills, positions) that survives heavy keys.

``Window.partitionBy(symbol)`` puts a whole symbol into one task. That is the best plan while
every symbol is of moderate size: one exchange serves all frames. A symbol that holds a large part
of the table would stall it, so ``OrderedRows`` measures the key sizes once (unless the caller can
prove a bound) and treats the two kinds of keys apart:

* light keys use the plain window;
* heavy keys are spread by a range exchange on (key, order), numbered with exact positions and cut
  into slabs of equal length. Frames run per (key, slab) with copies of the few border rows a frame
  can reach, unbounded fills carry one value per slab. Results equal the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barweave.storage import freeze, hand_over

# Rows of one key that a single task sorts and windows without trouble. Above MAX_DAILY_ROWS, so
# unique daily bars never need the measurement.
SLAB_ROWS = 4_000_000

# Rows of a task that numbers heavy keys; shorter slabs do not need a task each.
PART_ROWS = 250_000

# Bounds for broadcast sides of this module, checked against exact counts.
BROADCAST_ROWS = 1_000_000

_POS, _TOTAL, _SLAB, _HOME = "_pos", "_total", "_slab", "_home"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the lower 33 bits


def _lookup(df: DataFrame, side: DataFrame, on: Sequence[str], rows: int) -> DataFrame:
    """Left join on null-safe keys; ``rows`` is the checked size of ``side``."""
    renamed = side.withColumnsRenamed({c: f"_r_{c}" for c in on})
    if rows <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    match = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return df.join(renamed, match, "left").drop(*[f"_r_{c}" for c in on])


@dataclass(frozen=True)
class OrderedRows:
    """Rows with a total order ``by`` inside each ``key``."""

    key: tuple[str, ...]
    by: tuple[str, ...]
    light: DataFrame
    heavy: DataFrame | None = None
    heavy_keys: int = 0
    heavy_rows: int = 0
    slab_rows: int = SLAB_ROWS

    @classmethod
    def arrange(
        cls,
        df: DataFrame,
        key: Sequence[str] = ("symbol",),
        by: Sequence[str] = ("date",),
        *,
        rows_bound: int | None = None,
        slab_rows: int = SLAB_ROWS,
    ) -> OrderedRows:
        """Decide per key how to run.

        ``rows_bound`` states a proven maximum of rows per key and saves the measuring job, which
        otherwise reads the key columns only and returns one row to the driver.
        """
        key, by = tuple(key), tuple(by)
        if rows_bound is not None and rows_bound <= slab_rows:
            return cls(key, by, df, slab_rows=slab_rows)
        sizes = df.groupBy(*key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > slab_rows)
        keys, rows = sizes.agg(F.count("*"), F.coalesce(F.sum("_rows"), F.lit(0))).first()
        if keys == 0:
            return cls(key, by, df, slab_rows=slab_rows)
        tagged = _lookup(df, freeze(sizes), key, keys)
        light = tagged.where(F.col("_rows").isNull()).drop("_rows")
        heavy = tagged.where(F.col("_rows").isNotNull()).drop("_rows")
        enough = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / PART_ROWS))
        heavy = _number(heavy, key, by, keys, min(math.ceil(rows / slab_rows), enough))
        return cls(key, by, light, heavy, keys, rows, slab_rows)

    # -- row order -----------------------------------------------------------------------------

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy(*self.by)

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> OrderedRows:
        """Row-wise change. ``fn`` may drop rows only if no frame is applied afterwards."""
        return replace(self, light=fn(self.light), heavy=self.heavy and fn(self.heavy))

    def framed(
        self, back: int, ahead: int, fn: Callable[[DataFrame, WindowSpec], DataFrame]
    ) -> OrderedRows:
        """Apply ``fn(rows, window)`` whose frames reach ``back`` rows behind and ``ahead`` on."""
        if max(back, ahead) >= self.slab_rows:
            raise ValueError("frame does not fit into a slab")
        light = fn(self.light, self.window())
        if self.heavy is None:
            return replace(self, light=light)
        size = F.lit(self.slab_rows)
        at = F.col(_POS) - 1
        home = F.floor(at / size)
        inner = F.pmod(at, size)
        targets = F.array_compact(
            F.array(
                home,
                F.when(inner >= size - back, home + 1),
                F.when((inner < ahead) & (home > 0), home - 1),
            )
        )
        spread = (
            self.heavy.withColumn("_at", home)
            .withColumn(_SLAB, F.explode(targets))
            .withColumn(_HOME, F.col(_SLAB) == F.col("_at"))
            .drop("_at")
        )
        heavy = fn(spread, Window.partitionBy(*self.key, _SLAB).orderBy(_POS))
        return replace(self, light=light, heavy=heavy.where(F.col(_HOME)).drop(_SLAB, _HOME))

    def positions(self, position: str, total: str) -> OrderedRows:
        """Exact 1-based position of each row in its key and the number of rows of the key."""
        light = self.light.withColumns(
            {
                position: F.row_number().over(self.window()).cast("long"),
                total: F.count("*").over(Window.partitionBy(*self.key)),
            }
        )
        heavy = self.heavy and self.heavy.withColumns(
            {position: F.col(_POS), total: F.col(_TOTAL)}
        )
        return replace(self, light=light, heavy=heavy)

    def key_values(self, **aggregates: Column) -> OrderedRows:
        """Attach aggregates over the whole key to every row."""
        w = Window.partitionBy(*self.key)
        light = self.light.withColumns({n: a.over(w) for n, a in aggregates.items()})
        if self.heavy is None:
            return replace(self, light=light)
        per_key = self.heavy.groupBy(*self.key).agg(*[a.alias(n) for n, a in aggregates.items()])
        heavy = _lookup(self.heavy, per_key, self.key, self.heavy_keys)
        return replace(self, light=light, heavy=heavy)

    def fill(self, columns: Sequence[str], *, leading: bool = True) -> OrderedRows:
        """Carry the last known value forward; with ``leading`` also fill the start of each key.

        After the forward pass only rows before the first known value are empty, so the backward
        pass is the first known value of the key: a whole-key frame instead of a quadratic one.
        """
        w = self.window()
        forward = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

        def filled(c: str) -> Column:
            known = F.last(c, ignorenulls=True).over(forward)
            return F.coalesce(known, F.first(c, ignorenulls=True).over(whole)) if leading else known

        light = self.light.withColumns({c: filled(c) for c in columns})
        if self.heavy is None:
            return replace(self, light=light)
        return replace(self, light=light, heavy=self._fill_heavy(columns, leading))

    def _fill_heavy(self, columns: Sequence[str], leading: bool) -> DataFrame:
        rows = self.heavy.withColumn(_SLAB, F.floor((F.col(_POS) - 1) / F.lit(self.slab_rows)))
        seen = {c: F.when(F.col(c).isNotNull(), F.col(_POS)) for c in columns}
        per_slab = rows.groupBy(*self.key, _SLAB).agg(
            *[F.max_by(c, seen[c]).alias(f"_last_{c}") for c in columns],
            *[F.min_by(c, seen[c]).alias(f"_first_{c}") for c in columns],
        )
        order = Window.partitionBy(*self.key).orderBy(_SLAB)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carried = per_slab.select(
            *self.key,
            _SLAB,
            *[F.last(f"_last_{c}", True).over(before).alias(f"_carry_{c}") for c in columns],
            *[F.first(f"_first_{c}", True).over(whole).alias(f"_start_{c}") for c in columns],
        )
        slabs = self.heavy_keys + math.ceil(self.heavy_rows / self.slab_rows)
        inside = (
            Window.partitionBy(*self.key, _SLAB)
            .orderBy(_POS)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        joined = _lookup(
            rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns}),
            carried,
            [*self.key, _SLAB],
            slabs,
        )
        values = {
            c: F.coalesce(
                F.col(c), F.col(f"_carry_{c}"), *([F.col(f"_start_{c}")] if leading else [])
            )
            for c in columns
        }
        scratch = [f"{p}{c}" for p in ("_carry_", "_start_") for c in columns]
        return joined.withColumns(values).drop(_SLAB, *scratch)

    # -- back to a frame -----------------------------------------------------------------------

    def rows(self) -> DataFrame:
        if self.heavy is None:
            return self.light
        return self.light.unionByName(self.heavy.drop(_POS, _TOTAL))


def _number(
    heavy: DataFrame, key: tuple[str, ...], by: tuple[str, ...], keys: int, parts: int
) -> DataFrame:
    """Exact positions for heavy keys without gathering a key in one task.

    The range exchange balances on (key, order) values; the row index inside each sorted partition
    comes from the generated id. The table written here freezes it, so that a lost executor cannot
    change it, and lets the next step read the key columns alone. One summary row per (key, partition) then turns local indexes into positions.
    """
    ids = hand_over(
        heavy.repartitionByRange(parts, *key, *by)
        .sortWithinPartitions(*key, *by)
        .withColumn("_id", F.monotonically_increasing_id()),
        "heavy",
    ).withColumn("_part", F.shiftright("_id", _ROW_BITS))
    runs = ids.groupBy(*key, "_part").agg(
        F.count("*").alias("_len"), F.min("_id").alias("_first_id")
    )
    order = Window.partitionBy(*key).orderBy("_part")
    starts = runs.select(
        *key,
        "_part",
        "_first_id",
        (F.sum("_len").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_len")).alias(
            "_start"
        ),
        F.sum("_len").over(Window.partitionBy(*key)).alias(_TOTAL),
    )
    located = _lookup(ids, starts, [*key, "_part"], parts + keys)
    return located.withColumn(
        _POS, F.col("_start") + F.col("_id") - F.col("_first_id") + 1
    ).drop("_id", "_part", "_first_id", "_start")
