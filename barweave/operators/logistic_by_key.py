"""Logistic regressions of all keys at once.

Keys of up to ``FEW_ROWS`` rows meet their rows once, many keys to a task, which takes all Newton
steps there. For the others, which are few for their rows, a Newton step of every key is one grouped
aggregation: the loss, its gradient and its curvature are sums over the key's rows, so a key on most
rows is summed in the tasks that hold them; their state is broadcast and their rows stay where they
are. The small systems of equations are solved in numpy. The number of jobs is that of the steps and
does not depend on the number of keys; keys that have converged leave the aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.schema import FEATURES
from barweave.storage import hand_over

MOST_STEPS = 60
#: A key is done when no scaled derivative exceeds this, for each of its rows.
CLOSE = 1e-9
#: Up to this many keys their state is broadcast to the rows, beyond it the two are shuffled.
FEW_KEYS = 50_000
#: A key of more rows is summed by aggregations over all tasks.
FEW_ROWS = 20_000
#: Rows of a task that takes all steps of its keys.
TASK_ROWS = 100_000
#: From so many rows a key on, curvatures are products of matrices, key by key.
LOOP_ROWS = 16


def _moments(rows: DataFrame, key: str, columns: Sequence[str], label: str) -> DataFrame:
    sums = [F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("ups")]
    for i, c in enumerate(columns):
        sums += [F.avg(c).alias(f"mean{i}"), F.stddev_pop(c).alias(f"scale{i}")]
    return rows.groupBy(key).agg(*sums)


def _with_state(rows: DataFrame, state: DataFrame, key: str) -> DataFrame:
    few = state.count() <= FEW_KEYS
    return rows.join(F.broadcast(state) if few else state, key)


def fit_by_key(
    rows: DataFrame,
    key: str = "symbol",
    columns: Sequence[str] = FEATURES,
    label: str = "target",
    l2: float = 1.0,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """(key, n_rows, intercept, coefficients, steps, converged), one row for each key.

    Minimises the summed logistic loss plus ``l2`` / 2 times the squared coefficients, without the
    intercept: the unit penalty common elsewhere. Rows with a gap or without a key are left out. A
    key with one label only has no finite minimum; it gets zero coefficients and the log odds of
    its rows with half a row of each label added.
    """
    p = len(columns)
    names = [f"x{i}" for i in range(p)]
    needed = [F.col(c).cast("double").alias(n) for c, n in zip(columns, names)]
    kept = rows.select(key, *needed, F.col(label).cast("double").alias("y")).na.drop("any")
    kept = hand_over(kept, "rows")
    state = hand_over(_begin(_moments(kept, key, names, "y"), key, p, l2), "state")
    small = (F.col("n") <= few_rows) & ~F.col("done")
    large = state.where(~small)
    some = kept.join(_small_enough(large.select(key)), key, "left_anti")
    state = hand_over(large.unionByName(_in_tasks(some, state.where(small), key, p, l2)), "state")
    step = 0
    while step < MOST_STEPS:
        open_ = state.where("NOT done")
        if open_.isEmpty():
            break
        step += 1
        active = open_.select(key, "means", "scales", "tried")
        sums = _sums(_with_state(kept, active, key), key, p)
        moved = _solved(open_.join(sums, key), key, p, l2, step)
        state = hand_over(moved.unionByName(state.where("done")), "state")
    # Back from scaled columns: z = (x - mean) / scale.
    weights = F.zip_with(
        F.slice("held", 2, p), "scales", lambda w, s: F.when(s > 0, w / s).otherwise(0.0)
    )
    shift = F.aggregate(
        F.zip_with("coefficients", "means", lambda w, m: w * m), F.lit(0.0), lambda a, x: a + x
    )
    return state.withColumn("coefficients", weights).select(
        key,
        F.col("n").alias("n_rows"),
        (F.element_at("held", 1) - shift).alias("intercept"),
        "coefficients",
        "steps",
        "converged",
    )


def _small_enough(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def _in_tasks(rows: DataFrame, state: DataFrame, key: str, p: int, l2: float) -> DataFrame:
    """The state after all steps of keys with few rows; a task holds all rows of its keys."""
    total = state.agg(F.sum("n")).first()[0] or 0
    share = F.pmod(F.xxhash64(key), F.lit(math.ceil(total / TASK_ROWS) or 1)).alias("_share")
    names = [f"x{i}" for i in range(p)]

    def fit(_, rows: pa.Table, state: pa.Table) -> pa.Table:
        state = state.drop_columns("_share").combine_chunks()
        k = state.num_rows
        place = pc.index_in(rows[key], value_set=state[key].combine_chunks())
        rows = rows.append_column("_place", place).filter(pc.is_valid(place)).sort_by("_place")
        owner = rows["_place"].to_numpy()
        x = np.stack([rows[n].to_numpy() for n in names], axis=1)
        y = rows["y"].to_numpy()
        grid = {
            c: state[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(k, width)
            for c, width in (("means", p), ("scales", p), ("held", p + 1), ("tried", p + 1))
        }
        now = {c: state[c].to_numpy().copy() for c in ("n", "loss", "steps", "done", "converged")}
        held, tried = grid["held"].copy(), grid["tried"].copy()
        # Spark, which sums the larger keys, holds NaN to be above 0.
        used = (grid["scales"] > 0) | np.isnan(grid["scales"])
        with np.errstate(all="ignore"):
            z = np.where(used[owner], (x - grid["means"][owner]) / grid["scales"][owner], 0.0)
            z = np.concatenate([np.ones((len(y), 1)), z], axis=1)
            step = 0
            while step < MOST_STEPS and not now["done"].all():
                step += 1
                at = np.flatnonzero(~now["done"])
                own = ~now["done"][owner]
                sums = _sums_here(z[own], y[own], tried[owner[own]], owner[own])
                held[at], tried[at], now["loss"][at], ends = _moved(
                    now["n"][at], grid["scales"][at], held[at], tried[at], now["loss"][at], sums, l2
                )
                now["steps"][at], now["done"][at], now["converged"][at] = step, ends, ends
        out = {key: state[key], "n": state["n"], "means": state["means"], "scales": state["scales"]}
        out |= {"held": _lists(held), "tried": _lists(tried)}
        return pa.table(out | {c: pa.array(now[c]) for c in ("loss", "steps", "done", "converged")})

    both = rows.select("*", share).groupBy("_share").cogroup(
        state.select("*", share).groupBy("_share")
    )
    return both.applyInArrow(fit, state.schema)


def _sums_here(z: np.ndarray, y: np.ndarray, tried: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """What ``_sums`` gives, for rows in the order of their keys: a row for each key."""
    margin = (z * tried).sum(axis=1)
    chance = 1 / (1 + np.exp(-margin))
    loss = np.maximum(margin, 0.0) + np.log1p(np.exp(-np.abs(margin))) - y * margin
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    low = np.tril_indices(z.shape[1])
    weighed = (chance * (1 - chance))[:, None] * z
    if len(y) >= LOOP_ROWS * len(starts):
        # Keys of many rows: a product of small matrices for each.
        ends = np.append(starts[1:], len(y))
        curve = np.stack([weighed[i:j].T @ z[i:j] for i, j in zip(starts, ends)])[:, low[0], low[1]]
    else:
        curve = np.add.reduceat(weighed[:, low[0]] * z[:, low[1]], starts, axis=0)
    cells = [loss[:, None], (chance - y)[:, None] * z]
    return np.concatenate([*[np.add.reduceat(c, starts, axis=0) for c in cells], curve], axis=1)


def _begin(moments: DataFrame, key: str, p: int, l2: float) -> DataFrame:
    """State of every key: what is held so far, what is tried next, and the loss of what is held."""
    one = (F.col("ups") == 0) | (F.col("ups") == F.col("n"))
    odds = F.log((F.col("ups") + F.when(one, 0.5).otherwise(0.0)) / (
        F.col("n") - F.col("ups") + F.when(one, 0.5).otherwise(0.0)))
    first = F.concat(F.array(odds), F.array_repeat(F.lit(0.0), p))
    return moments.select(
        key,
        "n",
        F.array(*[F.col(f"mean{i}") for i in range(p)]).alias("means"),
        F.array(*[F.col(f"scale{i}") for i in range(p)]).alias("scales"),
        first.alias("held"),
        first.alias("tried"),
        F.lit(float("inf")).alias("loss"),
        F.lit(0).alias("steps"),
        one.alias("done"),
        one.alias("converged"),
    )


def _sums(rows: DataFrame, key: str, p: int) -> DataFrame:
    """Loss, gradient and curvature of what is tried, summed over the rows of each key."""
    scaled: list[Column] = []
    for i in range(p):
        scale = F.col("scales")[i]
        scaled.append(F.when(scale > 0, (F.col(f"x{i}") - F.col("means")[i]) / scale).otherwise(0.0))
    rows = rows.select(
        key, "y", "tried", *[z.alias(f"z{i + 1}") for i, z in enumerate(scaled)], F.lit(1.0).alias("z0")
    )
    margin = sum((F.col("tried")[i] * F.col(f"z{i}") for i in range(1, p + 1)), F.col("tried")[0])
    rows = rows.withColumn("m", margin).withColumn("c", 1 / (1 + F.exp(-F.col("m"))))
    # log(1 + exp(m)) - y m, without overflow.
    loss = F.greatest(F.col("m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m")
    z = [F.col(f"z{i}") for i in range(p + 1)]
    curve = F.col("c") * (1 - F.col("c"))
    sums = [F.sum(loss)] + [F.sum((F.col("c") - F.col("y")) * v) for v in z]
    sums += [F.sum(curve * z[i] * z[j]) for i in range(p + 1) for j in range(i + 1)]
    return rows.groupBy(key).agg(F.array(*sums).alias("sums"))


def _solved(state: DataFrame, key: str, p: int, l2: float, step: int) -> DataFrame:
    """Newton's step for every key, halved as long as the loss has not fallen."""
    columns = [key, "n", "means", "scales", "held", "tried", "loss", "steps", "done", "converged"]
    # Written out, since a cast of many derivatives of one frame would lose which is which.
    schema = T.StructType([f for c in columns for f in state.schema.fields if f.name == c])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_rows
            if not k:
                continue
            grid = {
                c: np.array(batch.column(c).flatten().to_numpy(zero_copy_only=False)).reshape(k, -1)
                for c in ("scales", "held", "tried", "sums")
            }
            n, before = batch.column("n").to_numpy(), batch.column("loss").to_numpy()
            after_held, after_tried, loss, ends = _moved(
                n, grid["scales"], grid["held"], grid["tried"], before, grid["sums"], l2
            )
            out = {c: batch.column(c) for c in (key, "n", "means", "scales")}
            out["held"], out["tried"] = (_lists(x) for x in (after_held, after_tried))
            out["loss"] = pa.array(loss)
            out["steps"] = pa.array(np.full(k, step), pa.int32())
            out["done"], out["converged"] = pa.array(ends), pa.array(ends)
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return state.select(*columns, "sums").mapInArrow(solve, schema)


def _moved(n, scales, held, tried, before, sums, l2: float):
    """What is held and tried after a step, its loss, and which keys are done."""
    k, p = scales.shape
    low = np.tril_indices(p + 1)
    used = np.concatenate([np.ones((k, 1), bool), scales > 0], axis=1)
    # The penalty of a coefficient, in terms of the coefficient of the scaled column.
    penalty = np.zeros((k, p + 1))
    penalty[:, 1:] = l2 / np.where(used[:, 1:], scales, 1.0) ** 2
    loss = sums[:, 0] + (penalty * tried**2).sum(axis=1) / 2
    by = np.where(used, sums[:, 1 : p + 2] + penalty * tried, 0.0)
    curve = np.zeros((k, p + 1, p + 1))
    curve[:, low[0], low[1]] = sums[:, p + 2 :]
    curve[:, low[1], low[0]] = sums[:, p + 2 :]
    spot = np.arange(p + 1)
    curve[:, spot, spot] += penalty + np.where(used, 1e-12 * n[:, None], 1.0)
    good = (loss <= before + 1e-12 * np.abs(before)) | np.isinf(before)
    close = good & (np.abs(by).max(axis=1) <= CLOSE * n)
    moved = tried - np.linalg.solve(curve, by[:, :, None])[:, :, 0]
    stuck = ~good & (np.abs(tried - held).max(axis=1) < 1e-12)
    after_held = np.where(good[:, None], tried, held)
    after_tried = np.where(good[:, None], moved, (held + tried) / 2)
    return after_held, after_tried, np.where(good, loss, before), close | stuck


def _lists(rows: np.ndarray) -> pa.ListArray:
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(rows.ravel()))


def predict_by_key(
    rows: DataFrame,
    models: DataFrame,
    key: str = "symbol",
    columns: Sequence[str] = FEATURES,
    name: str = "lr",
) -> DataFrame:
    """``<name>_pred`` and ``<name>_probability``; NULL where the key has no model or a value is
    missing."""
    few = models.count() <= FEW_KEYS
    own = models.select(key, F.col("intercept").alias("_b"), F.col("coefficients").alias("_w"))
    joined = rows.join(F.broadcast(own) if few else own, key, "left")
    margin = sum((F.col("_w")[i] * F.col(c) for i, c in enumerate(columns)), F.col("_b"))
    chance = 1 / (1 + F.exp(-margin))
    return joined.withColumn(f"{name}_probability", chance).select(
        *rows.columns,
        (F.col(f"{name}_probability") > 0.5).cast("double").alias(f"{name}_pred"),
        f"{name}_probability",
    )
