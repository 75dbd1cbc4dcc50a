import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from barweave.operators import models, packed_nets


def windows(n, seed=1, length=5, width=9):
    """Overlapping windows of two series, and whether the first value rises."""
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(2):
        steps = rng.uniform(size=(n // 2 + length - 1, width))
        found += [steps[i : i + length] for i in range(n // 2)]
    x = np.stack(found)
    return x.reshape(n, -1), (x[:, -1, 0] > x[:, 0, 0]).astype(int)


@pytest.mark.parametrize("kind", ["windows", "single rows", "equal rows", "one row"])
def test_blocks_unpack_to_the_same_bits(kind):
    x, y = windows(400)
    if kind == "single rows":
        x = x[np.random.default_rng(2).permutation(len(x))]
    elif kind == "equal rows":
        x[:] = -0.0
    elif kind == "one row":
        x, y = x[:1], y[:1]
    block = packed_nets.packed_block(x, y)
    again, classes = packed_nets.unpacked(block)
    assert again.tobytes() == x.tobytes() and classes.tolist() == y.tolist()
    if kind == "windows":
        assert len(block[-1]) < x.nbytes / 4


def test_gradient_is_that_of_the_loss():
    x, y = windows(20)
    layers = [45, 4, 3, 2]
    size = sum((i + 1) * o for i, o in zip(layers, layers[1:]))
    flat = np.random.default_rng(3).normal(size=size)
    _, by = packed_nets.loss_sums(flat, x, y, layers)
    for i in range(0, size, 7):
        off = np.zeros(size)
        off[i] = 1e-6
        up, down = (packed_nets.loss_sums(flat + s * off, x, y, layers)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - by[i]) < 1e-5


def test_large_tables_fit_what_spark_fits(spark, monkeypatch):
    x, y = windows(3000)
    rows = [(Vectors.dense(v), float(t)) for v, t in zip(x, y, strict=True)]
    table = spark.createDataFrame(rows, ["features", "target"]).repartition(3)
    fitted, loss = {}, {}
    flat = {}
    for most in (10_000, 1000):
        monkeypatch.setattr(models, "PACKED_ROWS", most)
        monkeypatch.setattr(packed_nets, "BLOCK_ROWS", 400)
        net = models.sequence_net(epochs=30)
        found = models.fit_all(table, {"lstm": net}, stages=list)["lstm"]
        assert isinstance(found.stages[-1], MultilayerPerceptronClassificationModel)
        assert found.stages[-1].getMaxIter() == 30
        flat[most] = found.stages[-1].weights.toArray()
        loss[most] = packed_nets.loss_sums(flat[most], x, y, [45, 32, 2])[0] / len(y)
        scored = models.predict_probability(table, "lstm", found)
        right = F.avg((F.col("lstm_pred") == F.col("target")).cast("double"))
        fitted[most] = scored.agg(right).first()[0]
    begin = models.sequence_net(epochs=0).fit(table).weights.toArray()
    first = packed_nets.loss_sums(begin, x, y, [45, 32, 2])[0] / len(y)
    # Both fell alike from the same weights; the steps of the two searches differ.
    assert max(loss.values()) < first / 2 and abs(loss[1000] - loss[10_000]) < first / 10
    assert min(fitted.values()) >= 0.9
    assert not np.array_equal(flat[1000], flat[10_000])


def test_rows_without_values_are_refused(spark, monkeypatch):
    monkeypatch.setattr(models, "PACKED_ROWS", 1)
    for v, label in (([1.0] * 44 + [float("nan")], 0.0), ([1.0] * 45, 2.0)):
        table = spark.createDataFrame([(Vectors.dense(v), label)] * 3, ["features", "target"])
        with pytest.raises(Exception, match="NaN|labels"):
            models.fit_all(table, {"lstm": models.sequence_net()}, stages=list)


def test_few_files_are_dealt_out(spark):
    x, y = windows(50_000)
    rows = [(Vectors.dense(v), float(t)) for v, t in zip(x[:, :9], y, strict=True)]
    table = spark.createDataFrame(rows, ["features", "target"]).coalesce(1)
    blocks = packed_nets.pack(table, "features", "target", 2)
    sizes = [n for n in blocks.map(lambda b: b[0]).glom().map(sum).collect() if n]
    assert sum(sizes) == 50_000 and len(sizes) == spark.sparkContext.defaultParallelism
    again = np.concatenate([packed_nets.unpacked(b)[0] for b in blocks.collect()])
    assert sorted(map(bytes, again)) == sorted(map(bytes, np.ascontiguousarray(x[:, :9])))
    blocks.unpersist()
