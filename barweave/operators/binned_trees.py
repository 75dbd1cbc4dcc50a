"""Forests and boosted trees of two classes over packed rows, for tables of many rows.

Every feature of a row becomes one byte, the number of its bin between quantiles of the whole
column, and the rows are kept as blocks of bytes: some ten bytes a row instead of the half kilobyte
that objects with a hundred bootstrap counts take. A level of all trees is one job: tasks count
their blocks into histograms by tree, node, feature and bin. In a forest one shuffle adds these up and
picks the splits, and the driver gets the splits; boosting has one tree at a time, whose histograms
the driver keeps, so that of two siblings only the one of fewer rows is counted. Bootstrap counts and drawn rows come from generators seeded
by block, hence from no stored column. Sums are whole numbers, so a rerun grows the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
BLOCK_ROWS = 16_384

# Rank error of the quantiles, as a share of the rows.
_RANK_ERROR = 0.001
# Residuals are at most 4; sums of their multiples of this are whole, up to two thousand million rows.
_UNIT = 2.0**-30
_LEAST_GAIN = 1e-12
# All rows go left: a node that is not split.
_NO_CUT = BINS
# Histograms of so many tasks are added up by the driver; those of more meet in tasks first.
_AT_ONCE = 64
# Rounds after which the margins are worked out from the first rows again, which keeps plans short.
_FRESH_ROUNDS = 25

# Number, codes (features, rows) and classes of a block; boosting adds the margins.
Block = tuple[int, np.ndarray, np.ndarray]


# -- packed rows -------------------------------------------------------------------------------


def coded(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins (features, rows) of values (rows, features): how many cuts lie below a value."""
    return np.stack([np.searchsorted(c, x[:, j]).astype(np.uint8) for j, c in enumerate(cuts)])


def _column_cuts(values: Sequence[float]) -> np.ndarray:
    """At most ``BINS - 1`` cuts. A value that equals a cut lies left of it."""
    return np.unique(np.asarray(values, dtype=float))


@dataclass(frozen=True)
class Packed:
    """Rows as blocks of bins, kept by the executors until ``release``."""

    cuts: list[np.ndarray]
    blocks: RDD
    parallelism: int

    def release(self) -> None:
        self.blocks.unpersist()


def pack(rows: DataFrame, features: str = "features", label: str = "target") -> Packed:
    """The vectors and labels 0 or 1 of ``rows``, which is read twice."""
    arrays = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    first = arrays.select(F.size("x").alias("n")).head()
    if first is None:
        raise ValueError("no rows to train on")
    n = first["n"]
    columns = arrays.select(*[F.col("x")[i].alias(f"x{i}") for i in range(n)])
    # The least value too: a column of few values may keep to one of them at every other rank.
    shares = [i / (BINS - 1) for i in range(BINS - 1)]
    found = columns.approxQuantile(columns.columns, shares, _RANK_ERROR)
    cuts = [_column_cuts(v) for v in found]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0

        def block() -> pa.RecordBatch:
            x, y = (np.concatenate(part) for part in zip(*kept, strict=True))
            if not np.isin(y, (0, 1)).all():
                raise ValueError("labels are 0 or 1")
            parts = [coded(x, cuts).tobytes(), y.astype(np.uint8).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["codes", "y"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                x = some.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                kept.append((x, some.column("y").to_numpy(zero_copy_only=False)))
                held += some.num_rows
                if held >= BLOCK_ROWS:
                    yield block()
                    kept, held = [], 0
        if kept:
            yield block()

    def numbered(part: int, found: Iterator) -> Iterator[Block]:
        for i, row in enumerate(found):
            codes = np.frombuffer(bytes(row["codes"]), np.uint8).reshape(n, -1)
            yield (part << 32) + i, codes, np.frombuffer(bytes(row["y"]), np.uint8)

    stored = arrays.mapInArrow(blocks, "codes binary, y binary").rdd
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    # Dealt out evenly over all cores, so that no core waits while another has a second task.
    parts = tasks * math.ceil(stored.getNumPartitions() / tasks)
    dealt = (
        stored.mapPartitionsWithIndex(numbered)
        .map(lambda b: ((b[0] >> 32) + (b[0] & 0xFFFFFFFF), b))
        .partitionBy(parts, lambda k: k)
        .values()
    )
    return Packed(cuts, dealt.persist(StorageLevel.MEMORY_AND_DISK), tasks)


# -- trees -------------------------------------------------------------------------------------


class Tree:
    """Nodes numbered from the root, the children of ``i`` being ``2i + 1`` and ``2i + 2``. A row
    whose bin is above the cut goes right. A node without a split hands its value down the left."""

    def __init__(self, depth: int):
        inner = 2**depth - 1
        self.depth = depth
        self.feature, self.cut = np.zeros(inner, np.int64), np.full(inner, _NO_CUT, np.uint8)
        self.value = np.zeros(2 * inner + 1)
        self.alive = [0]

    def level(self, d: int) -> np.ndarray:
        """The nodes of a level that may split, from 0 in their level."""
        return np.array([i - (2**d - 1) for i in self.alive], np.int64)

    def split(self, nodes: list[int], found: list[tuple]) -> None:
        self.alive = []
        for node, (feature, cut, own, left, right) in zip(nodes, found, strict=True):
            self.value[node] = own
            if feature is not None:
                self.feature[node], self.cut[node] = feature, cut
                self.value[2 * node + 1], self.value[2 * node + 2] = left, right
                self.alive += [2 * node + 1, 2 * node + 2]

    def leaves(self) -> np.ndarray:
        """Values of the lowest level."""
        for i in range(len(self.feature)):
            if self.cut[i] == _NO_CUT:
                self.value[2 * i + 1] = self.value[i]
        return self.value[len(self.feature) :]


def places(
    codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int, at: np.ndarray
) -> np.ndarray:
    """For the rows ``at`` their nodes at ``depth``, from 0 in that level."""
    if not depth:
        return np.zeros(len(at), np.int64)
    flat, start = codes.ravel(), feature * codes.shape[1]
    node = 1 + (codes[feature[0]][at] > cut[0]).astype(np.int64)
    for _ in range(depth - 1):
        right = flat[start[node] + at] > cut[node]
        node *= 2
        node += 1
        node += right
    return node - (2**depth - 1)


def _drawn(seed: int, tree: int, node: int, n: int, some: int) -> np.ndarray:
    """The features a node may split by, in order."""
    if some >= n:
        return np.arange(n)
    return np.sort(np.random.default_rng([seed, 1, tree, node]).choice(n, some, replace=False))


def best_splits(counts: np.ndarray, drawn: np.ndarray, gini: bool) -> list[tuple]:
    """For histograms (nodes, features, bins, 2): feature, cut, value of node, left and right child;
    no feature where nothing is gained.

    With ``gini`` the two numbers of a bin count the rows of the classes, else they are the number
    of rows and the sum of their targets in units.
    """

    def size(s: np.ndarray) -> np.ndarray:
        return s.sum(axis=-1) if gini else s[..., 0]

    def score(s: np.ndarray) -> np.ndarray:
        squares = (s * s).sum(axis=-1) if gini else s[..., 1] ** 2
        return squares / np.maximum(size(s), 1)

    def value(s: np.ndarray) -> float:
        return float(s[1] / max(size(s), 1))

    sums = counts.cumsum(axis=2).astype(float)
    if not gini:
        sums[..., 1] *= _UNIT
    left, total = sums[:, :, :-1], sums[:, :, -1:]
    right = total - left
    gain = (score(left) + score(right) - score(total)) / np.maximum(size(total), 1)
    gain = np.where((size(left) >= 1) & (size(right) >= 1), gain, -1.0)
    out = []
    for i, each in enumerate(gain):
        k, cut = np.unravel_index(each.argmax(), each.shape)
        own = value(total[i, 0, 0])
        if each[k, cut] <= _LEAST_GAIN:
            out.append((None, None, own, None, None))
        else:
            out.append((int(drawn[i, k]), int(cut), own, value(left[i, k, cut]), value(right[i, k, cut])))
    return out


def _grown_level(histograms: RDD, trees: dict[int, Tree], d: int, drawn: dict, gini: bool, parts: int) -> None:
    """Add up histograms by tree and split the nodes of level ``d``."""
    splits = (
        histograms.reduceByKey(np.add, parts)
        .map(lambda kv: (kv[0], best_splits(kv[1], drawn[kv[0]], gini)))
        .collect()
    )
    for t, found in splits:
        trees[t].split(list(trees[t].alive), found)


# -- forests -----------------------------------------------------------------------------------

# A row counts once for every threshold that a uniform 32-bit number reaches: Poisson with mean 1.
_BELOW = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_THRESHOLDS = [np.uint32(b * 2**32) for b in _BELOW if b * 2**32 < 2**32 - 1]


def bootstrap(seed: int, block: int, tree: int, n: int) -> np.ndarray:
    """How often each of ``n`` rows counts in a tree."""
    u = np.random.default_rng([seed, 0, block, tree]).integers(0, 2**32, n, np.uint32)
    times = np.zeros(n, np.uint8)
    for least in _THRESHOLDS:
        times += u >= least
    return times


def forest(packed: Packed, *, trees: int, depth: int, columns: int, seed: int) -> BinnedTreesModel:
    """Gini trees over bootstrapped rows, ``columns`` features drawn for each node."""
    n = len(packed.cuts)
    grown = {t: Tree(depth) for t in range(trees)}
    for d in range(depth):
        open_ = {t: g for t, g in grown.items() if g.alive}
        if not open_:
            break
        drawn = {
            t: np.array([_drawn(seed, t, i, n, columns) for i in g.alive]) for t, g in open_.items()
        }
        plans = [(t, g.feature[: 2**d - 1], g.cut[: 2**d - 1], g.level(d)) for t, g in open_.items()]

        def work(blocks: Iterator[Block], d=d, plans=plans, drawn=drawn) -> Iterator:
            sums = {t: np.zeros((2**d, columns, BINS, 2)) for t, *_ in plans}
            # Nodes that do not split any more count nowhere, whatever feature they look at.
            asked = {}
            for t, _, _, level in plans:
                asked[t] = np.zeros((columns, 2**d), np.int64)
                asked[t][:, level] = drawn[t].T
            for number, codes, y in blocks:
                m, flat = len(y), codes.ravel()
                for t, feature, cut, _ in plans:
                    times = bootstrap(seed, number, t, m)
                    at = np.flatnonzero(times)
                    times = times[at].astype(float)
                    node = places(codes, feature, cut, d, at)
                    first = node * (columns * BINS * 2)
                    first += y[at]
                    cells = sums[t].reshape(-1)
                    for k in range(columns):
                        where = (asked[t][k] * m)[node]
                        where += at
                        cell = flat[where].astype(np.int64)
                        cell *= 2
                        cell += first
                        cell += k * BINS * 2
                        cells += np.bincount(cell, times, len(cells))
            for t, _, _, level in plans:
                yield t, sums[t][level].astype(np.int64)

        _grown_level(
            packed.blocks.mapPartitions(work), grown, d, drawn, True, min(len(plans), packed.parallelism)
        )
    return _model(packed, list(grown.values()), depth, False, [1 / trees] * trees)


# -- boosting ----------------------------------------------------------------------------------


def _margins(codes: np.ndarray, trees: Sequence[tuple], margins: np.ndarray) -> np.ndarray:
    """``margins`` after further trees, each (feature, cut, leaves, weight, depth)."""
    at = np.arange(codes.shape[1])
    for feature, cut, leaves, weight, depth in trees:
        margins = margins + weight * leaves[places(codes, feature, cut, depth, at)]
    return margins


def _added(histograms: RDD) -> np.ndarray:
    """The sum of the histograms of all tasks, whole numbers in any order."""
    if histograms.getNumPartitions() > _AT_ONCE:
        return histograms.treeReduce(np.add)
    return np.sum(histograms.collect(), axis=0)


def _with_siblings(counted: np.ndarray, parents: np.ndarray | None, right: np.ndarray) -> np.ndarray:
    """Histograms of all nodes of a level, of which one of two siblings was counted, the right one
    where ``right`` is 1. The other has what is left of the parent."""
    if parents is None:
        return counted
    both = np.stack([counted, parents - counted], axis=1)
    return np.where(right[:, None, None, None, None] == 1, both[:, ::-1], both).reshape(-1, *counted.shape[1:])


def _smaller(whole: np.ndarray, found: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Histograms of the nodes that were split, and 1 where the right child has fewer rows."""
    split = [i for i, (feature, *_) in enumerate(found) if feature is not None]
    left = [whole[i, found[i][0], : found[i][1] + 1, 0].sum() for i in split]
    total = whole[split, 0, :, 0].sum(axis=1)
    return whole[split], (2 * np.array(left, np.int64) > total).astype(np.int64)


def boosted(
    packed: Packed, *, rounds: int, depth: int, step: float, share: float, columns: int, seed: int
) -> BinnedTreesModel:
    """Regression trees on the gradient of the logistic loss ``log(1 + exp(-2 y F))`` with labels -1
    and 1. The first tree, on the labels, counts whole, the others by ``step``. Each round draws
    ``share`` of the rows, each node ``columns`` of the features."""
    n = len(packed.cuts)
    done: list[tuple] = []
    grown: list[Tree] = []
    state = packed.blocks.map(lambda b: (*b, np.zeros(len(b[2]))))
    held = None
    try:
        for r in range(rounds):
            tree = Tree(depth)
            if r:
                if r % _FRESH_ROUNDS:
                    some, source = done[-1:], state
                else:
                    some, source = list(done), packed.blocks.map(lambda b: (*b, np.zeros(len(b[2]))))
                state = source.map(
                    lambda b, some=some: (b[0], b[1], b[2], _margins(b[1], some, b[3]))
                ).persist(StorageLevel.MEMORY_AND_DISK)
            parents, right = None, np.zeros(0, np.int64)
            for d in range(depth):
                if not tree.alive:
                    break
                # Siblings stand together, the left one first.
                level = tree.level(d)
                counted = level[::2] + right if d else level
                drawn = np.array([_drawn(seed, r, i, n, columns) for i in tree.alive])
                plan = tree.feature[: 2**d - 1], tree.cut[: 2**d - 1]

                def work(blocks, r=r, d=d, plan=plan, counted=counted) -> Iterator:
                    counts, sums = np.zeros((2, n, 2**d * BINS))
                    asked = np.zeros(2**d, bool)
                    asked[counted] = True
                    for number, codes, y, margins in blocks:
                        at = np.arange(len(y))
                        if share < 1:
                            rng = np.random.default_rng([seed, 2, number, r])
                            at = np.flatnonzero(rng.random(len(y)) < share)
                        node = places(codes, *plan, d, at)
                        if d:
                            own = asked[node]
                            at, node = at[own], node[own]
                        sign = 2.0 * y[at] - 1
                        target = sign if not r else 4 * sign / (1 + np.exp(2 * sign * margins[at]))
                        target = np.rint(target / _UNIT)
                        node *= BINS
                        for j in range(n):
                            cell = node + codes[j][at]
                            counts[j] += np.bincount(cell, minlength=2**d * BINS)
                            sums[j] += np.bincount(cell, target, 2**d * BINS)
                    both = np.stack([counts, sums], axis=-1).reshape(n, 2**d, BINS, 2)
                    yield both.transpose(1, 0, 2, 3)[counted].astype(np.int64)

                whole = _with_siblings(_added(state.mapPartitions(work)), parents, right)
                found = best_splits(whole[np.arange(len(level))[:, None], drawn], drawn, False)
                tree.split(list(tree.alive), found)
                parents, right = _smaller(whole, found)
                if not d:
                    # The margins of this round are kept by now; those before can go.
                    if held is not None:
                        held.unpersist()
                    held = state if r else None
            grown.append(tree)
            done.append((tree.feature, tree.cut, tree.leaves(), step if r else 1.0, depth))
    finally:
        if held is not None:
            held.unpersist()
    return _model(packed, grown, depth, True, [t[3] for t in done])


# -- models ------------------------------------------------------------------------------------


class BinnedTreesModel(
    Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Class, probabilities and votes or margins of vectors; a row without a vector gets NULL."""

    boosting = Param(
        Params._dummy(), "boosting", "whether values add up to a margin", TypeConverters.toBoolean
    )
    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "of the trees", TypeConverters.toListFloat)
    cuts = Param(Params._dummy(), "cuts", "of the features", TypeConverters.toListListFloat)
    splitFeatures = Param(
        Params._dummy(), "splitFeatures", "by tree and node", TypeConverters.toListInt
    )
    splitCuts = Param(Params._dummy(), "splitCuts", "by tree and node", TypeConverters.toListInt)
    leafValues = Param(Params._dummy(), "leafValues", "by tree and leaf", TypeConverters.toListFloat)

    def getNumTrees(self) -> int:
        return len(self.getOrDefault("weights"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, depth = self.getOrDefault("weights"), self.getOrDefault("depth")
        boosting, n = self.getOrDefault("boosting"), len(weights)
        trees = list(
            zip(
                np.array(self.getOrDefault("splitFeatures")).reshape(n, -1),
                np.array(self.getOrDefault("splitCuts"), np.uint8).reshape(n, -1),
                np.array(self.getOrDefault("leafValues")).reshape(n, -1),
                weights,
                [depth] * n,
                strict=True,
            )
        )
        cuts = [np.array(c) for c in self.getOrDefault("cuts")]
        shared = dataset.sparkSession.sparkContext.broadcast((cuts, trees))

        @F.arrow_udf("double")
        def total(values: pa.Array) -> pa.Array:
            cuts, trees = shared.value
            known = values.is_valid().to_numpy(zero_copy_only=False)
            x = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
            out = np.full(len(values), np.nan)
            found = [
                _margins(coded(x[i : i + BLOCK_ROWS], cuts), trees, np.zeros(len(x[i : i + BLOCK_ROWS])))
                for i in range(0, len(x), BLOCK_ROWS)
            ]
            out[known] = np.concatenate([np.zeros(0), *found])
            return pa.array(out, pa.float64(), mask=~known)

        vector, scratch = F.col(self.getFeaturesCol()), f"_total_{self.uid}"
        s = F.col(scratch)
        if boosting:
            p, raw, up = 1 / (1 + F.exp(-2 * s)), F.array(-s, s), s > 0
        else:
            p, raw, up = s, F.array((1 - s) * n, s * n), s > 0.5
        return (
            dataset.withColumn(scratch, total(F.when(vector.isNotNull(), vector_to_array(vector))))
            .withColumns(
                {
                    self.getRawPredictionCol(): F.when(s.isNotNull(), array_to_vector(raw)),
                    self.getProbabilityCol(): F.when(s.isNotNull(), array_to_vector(F.array(1 - p, p))),
                    self.getPredictionCol(): up.cast("double"),
                }
            )
            .drop(scratch)
        )


def _model(
    packed: Packed, trees: list[Tree], depth: int, boosting: bool, weights: list[float]
) -> BinnedTreesModel:
    return BinnedTreesModel()._set(
        boosting=boosting,
        depth=depth,
        weights=weights,
        cuts=[c.tolist() for c in packed.cuts],
        splitFeatures=np.concatenate([t.feature for t in trees]).tolist(),
        splitCuts=np.concatenate([t.cut for t in trees]).tolist(),
        leafValues=np.concatenate([t.leaves() for t in trees]).tolist(),
    )
