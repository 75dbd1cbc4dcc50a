"""Feed-forward nets over packed rows, for tables of many rows.

Spark's own net keeps every row as doubles, with its one-hot label, which spills some 370 bytes for a
window of five steps. Rows are kept here as packed blocks instead: a window that follows the one
before it in its block adds its last step alone, bit by bit the same values again when unpacked.
Net, loss and first weights are those of Spark's ``MultilayerPerceptronClassifier`` (sigmoids, then
softmax and cross-entropy), steps are L-BFGS over all rows, one job for each value of the loss, and
the result is Spark's own model. Sums are added in the order of the partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384
# Rows that go through the net at a time.
_ROWS_AT_A_TIME = 4096
# Corrections that L-BFGS remembers, and values of the loss that tell whether it still falls.
_CORRECTIONS, _VALUES = 10, 20
# Conditions of a step: the loss falls by a share of what its slope promises, and the slope itself.
_FALL, _FLATTER = 1e-4, 0.9
_TRIALS = 20

# (rows, width, step, which rows follow the one before, classes, values packed)
Block = tuple[int, int, int, bytes, bytes, bytes]
# From weights to loss and gradient.
Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


# -- packed rows -------------------------------------------------------------------------------


def _follows(x: np.ndarray, step: int) -> np.ndarray:
    """Which rows are the row before without its first ``step`` values and with as many new ones."""
    bits = np.ascontiguousarray(x).view(np.int64)
    out = np.zeros(len(x), bool)
    if step < x.shape[1]:
        out[1:] = (bits[1:, :-step] == bits[:-1, step:]).all(axis=1)
    return out


def packed_block(x: np.ndarray, y: np.ndarray) -> Block:
    n, width = x.shape
    some = x[:256]
    steps = [s for s in range(1, width + 1) if width % s == 0]
    step = min(steps, key=lambda s: np.where(_follows(some, s), s, width).sum())
    after = _follows(x, step)
    kept = np.ones(x.shape, bool)
    kept[after, : width - step] = False
    # Like bytes of the values stand together, which packs better.
    planes = x[kept].view(np.uint8).reshape(-1, 8).T.tobytes()
    values = pa.compress(planes, "zstd", asbytes=True)
    return n, width, step, np.packbits(after).tobytes(), y.astype(np.uint8).tobytes(), values


def unpacked(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The rows and classes of a block."""
    n, width, step, after, y, values = block
    follows = np.unpackbits(np.frombuffer(after, np.uint8), count=n).astype(bool)
    lengths = np.where(follows, step, width)
    ends = np.cumsum(lengths)
    planes = pa.decompress(values, int(ends[-1]) * 8, "zstd", asbytes=True)
    flat = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(float).ravel()
    x = np.lib.stride_tricks.sliding_window_view(flat, width)[ends - width]
    return x, np.frombuffer(y, np.uint8)


def pack(rows: DataFrame, features: str, label: str, classes: int) -> RDD:
    """The vectors and classes of ``rows`` as blocks, kept by the executors until ``unpersist``."""
    arrays = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                if some.column("x").null_count:
                    raise ValueError("a row has no vector")
                y = some.column("y").to_numpy(zero_copy_only=False)
                x = some.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
                if not np.isin(y, np.arange(classes)).all():
                    raise ValueError(f"labels are 0 to {classes - 1}")
                if not np.isfinite(x).all():
                    raise ValueError("a vector has NaN or infinite values")
                cells = packed_block(x, y)
                yield pa.RecordBatch.from_pylist([dict(zip(names, cells, strict=True))], kind)

    names = ["n", "width", "step", "after", "y", "v"]
    kind = pa.schema([(c, pa.int64()) for c in names[:3]] + [(c, pa.binary()) for c in names[3:]])
    schema = "n long, width long, step long, after binary, y binary, v binary"
    stored = arrays.mapInArrow(blocks, schema).rdd.map(
        lambda r: (*r[:3], *(bytes(c) for c in r[3:]))
    )
    parts, tasks = stored.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism
    if parts < tasks:
        # Few files: their blocks are dealt out, so that no core is idle in every step.
        stored = (
            stored.mapPartitionsWithIndex(
                lambda part, found: ((part + i * parts, b) for i, b in enumerate(found))
            )
            .partitionBy(tasks, lambda k: k)
            .mapPartitions(lambda found: (b for _, b in sorted(found, key=lambda kb: kb[0])))
        )
    return stored.persist(StorageLevel.MEMORY_AND_DISK)


# -- the net -----------------------------------------------------------------------------------


def layers_of(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights (in, out) and bias of every layer as views of one flat array, laid out as Spark's."""
    out, at = [], 0
    for i, o in zip(layers, layers[1:]):
        out.append((flat[at : at + i * o].reshape(i, o), flat[at + i * o : at + i * o + o]))
        at += i * o + o
    return out


def loss_sums(flat: np.ndarray, x: np.ndarray, y: np.ndarray, layers: Sequence[int]) -> tuple:
    """Summed cross-entropy of rows, and its gradient by the weights."""
    net = layers_of(flat, layers)
    held = [x]
    for w, b in net[:-1]:
        held.append(1 / (1 + np.exp(-np.clip(held[-1] @ w + b, -700, 700))))
    raw = held[-1] @ net[-1][0] + net[-1][1]
    raw -= raw.max(axis=1, keepdims=True)
    logs = raw - np.log(np.exp(raw).sum(axis=1, keepdims=True))
    at = np.arange(len(y))
    loss = -logs[at, y].sum()
    off = np.exp(logs)
    off[at, y] -= 1
    gradient = np.zeros_like(flat)
    for i in range(len(net) - 1, -1, -1):
        by_w, by_b = layers_of(gradient, layers)[i]
        by_w += held[i].T @ off
        by_b += off.sum(axis=0)
        if i:
            off = (off @ net[i][0].T) * held[i] * (1 - held[i])
    return loss, gradient


def _loss_over(blocks: RDD, layers: Sequence[int]) -> Loss:
    def loss(flat: np.ndarray) -> tuple[float, np.ndarray]:
        shared = blocks.context.broadcast(flat)

        def work(part: Iterator[Block]) -> Iterator[np.ndarray]:
            sums, gradient, seen = 0.0, np.zeros(len(shared.value)), 0
            for block in part:
                x, y = unpacked(block)
                for i in range(0, len(y), _ROWS_AT_A_TIME):
                    some = slice(i, i + _ROWS_AT_A_TIME)
                    own, by = loss_sums(shared.value, x[some], y[some], layers)
                    sums += own
                    gradient += by
                seen += len(y)
            yield np.concatenate([[seen, sums], gradient])

        total = np.sum(blocks.mapPartitions(work).collect(), axis=0)
        shared.destroy()
        return total[1] / total[0], total[2:] / total[0]

    return loss


# -- steps -------------------------------------------------------------------------------------


def _direction(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Where to go: the two loops of L-BFGS."""
    d, shares = -gradient, []
    for s, y in reversed(pairs):
        share = (s @ d) / (s @ y)
        d = d - share * y
        shares.append(share)
    if pairs:
        s, y = pairs[-1]
        d = d * ((s @ y) / (y @ y))
    for (s, y), share in zip(pairs, reversed(shares)):
        d = d + s * (share - (y @ d) / (s @ y))
    return d


def _searched(loss: Loss, x, value, gradient, d, step) -> tuple | None:
    """(x, value, gradient) after a step along ``d`` that meets the strong Wolfe conditions, the best
    one tried if none does; None where the loss does not fall."""
    slope, low, high, best = gradient @ d, 0.0, None, None
    for _ in range(_TRIALS):
        at = x + step * d
        now, by = loss(at)
        if not np.isfinite(now) or now > value + _FALL * step * slope:
            high = step
        else:
            if best is None or now < best[1]:
                best = at, now, by
            if abs(by @ d) <= -_FLATTER * slope:
                return at, now, by
            low, high = (low, step) if by @ d > 0 else (step, high)
        step = 2 * step if high is None else (low + high) / 2
    return best


def minimised(loss: Loss, x: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    value, gradient = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    seen = [value]
    for _ in range(steps):
        if np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            break
        d = _direction(gradient, pairs)
        step = 1.0 if pairs else 1 / np.linalg.norm(d)
        found = _searched(loss, x, value, gradient, d, step)
        if found is None:
            if not pairs:
                break
            pairs = []
            continue
        after, value, by = found
        if (after - x) @ (by - gradient) > 0:
            pairs = [*pairs, (after - x, by - gradient)][-_CORRECTIONS:]
        x, gradient = after, by
        if max(seen[-_VALUES:]) - value <= tolerance * abs(value):
            break
        seen.append(value)
    return x


def fit(net: MultilayerPerceptronClassifier, rows: DataFrame) -> MultilayerPerceptronClassificationModel:
    """What ``net.fit`` fits, over packed rows. ``rows`` is read once."""
    layers = net.getLayers()
    one = rows.sparkSession.createDataFrame(
        [(Vectors.dense([0.0] * layers[0]), 0.0)], [net.getFeaturesCol(), net.getLabelCol()]
    )
    begin = net.copy({net.maxIter: 0}).fit(one).weights.toArray()
    blocks = pack(rows, net.getFeaturesCol(), net.getLabelCol(), layers[-1])
    try:
        flat = minimised(_loss_over(blocks, layers), begin, net.getMaxIter(), net.getTol())
    finally:
        blocks.unpersist()
    # Spark's own model around these weights.
    model = net.copy({net.maxIter: 0, net.initialWeights: Vectors.dense(flat)}).fit(one)
    return model._set(maxIter=net.getMaxIter())
