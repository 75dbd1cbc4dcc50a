"""The recurrent classifier: cell, training regime and distributed fit."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from barweave.operators import models, recurrent


def some(n=7, steps=4, width=3, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, steps, width)), rng.integers(0, 2, n).astype(float)


def plain_probability(flat, x, units):
    """One sequence, one step, one unit at a time."""
    wi, wh, b, wo, bo = recurrent.unpacked(flat, x.shape[2], units)
    sig = lambda v: 1 / (1 + np.exp(-v))
    out = []
    for row in x:
        h, c = [0.0] * units, [0.0] * units
        for step in row:
            z = [
                sum(step[i] * wi[i, k] for i in range(len(step))) + sum(h[j] * wh[j, k] for j in range(units)) + b[k]
                for k in range(4 * units)
            ]
            c = [sig(z[units + j]) * c[j] + sig(z[j]) * np.tanh(z[2 * units + j]) for j in range(units)]
            h = [sig(z[3 * units + j]) * np.tanh(c[j]) for j in range(units)]
        out.append(sig(sum(h[j] * wo[j] for j in range(units)) + bo[0]))
    return out


def test_cell_against_plain_loops():
    x, _ = some()
    flat = np.random.default_rng(1).normal(size=recurrent.initial(3, 5, 0).size)
    assert recurrent.probability(flat, x, 5) == pytest.approx(plain_probability(flat, x, 5), abs=1e-12)


def test_gradient_is_finite_differences():
    x, y = some()
    flat = np.random.default_rng(2).normal(size=recurrent.initial(3, 4, 0).size) * 0.7
    got = recurrent.gradient(flat, x, y, 4)
    for i in range(flat.size):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        up, down = (recurrent.losses(flat + s * step, x, y, 4).mean() for s in (1, -1))
        assert got[i] == pytest.approx((up - down) / 2e-6, abs=1e-7)


def test_initial_weights():
    wi, wh, b, wo, bo = recurrent.unpacked(recurrent.initial(9, 8, 3), 9, 8)
    assert wh @ wh.T == pytest.approx(np.eye(8), abs=1e-9)
    assert b.tolist() == [0] * 8 + [1] * 8 + [0] * 16 and bo[0] == 0 and np.ptp(wi) > 0


def follow(losses):
    """A run whose state after k epochs is k."""
    return lambda state, epoch, train: (losses[epoch], np.array([epoch + 1.0]) if train else state)


@pytest.mark.parametrize(
    ("losses", "epochs", "patience", "restore", "kept", "seen"),
    [
        ([5, 4, 3, 3.5, 3.6, 3.7, 1], 6, 3, True, 2, 6),  # turns after epoch 2, stops 3 later
        ([5, 4, 3, 3.5, 3.6, 3.7, 1], 6, 3, False, 5, 6),
        ([5, 4, 3, 3.5, 2, 3.7, 3.8, 3.9], 7, 3, True, 4, 8),
        ([5, 4, 3, 3.5, 3.6, 3.7, 1], 6, None, True, 6, 7),
        ([5, 4, 3], 2, 3, True, 2, 3),
        ([None] * 4, 3, 2, True, 3, 0),
    ],
)
def test_patience(losses, epochs, patience, restore, kept, seen):
    state, history = recurrent.with_patience(np.zeros(1), follow(losses), epochs, patience, restore)
    assert state[0] == kept and len(history) == seen


def order_rows(spark, n=1500):
    """Pairs of sequences with the same steps in another order and the other label."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(n // 2):
        steps = rng.random((4, 2))
        rising = steps[np.argsort(steps[:, 0])]
        for order, label in ((rising, 1.0), (rising[::-1], 0.0)):
            rows.append((order.ravel().tolist(), label))
    df = spark.createDataFrame(rows, "x array<double>, target double")
    return df.select(array_to_vector("x").alias("features"), "target", (F.rand(3) < 0.2).alias("held"))


def net(**more):
    return models.recurrent_net(**{"length": 4, "units": 8, "epochs": 8, "step": 0.01, **more})


def test_learns_order_and_keeps_best(spark, tmp_path):
    rows = order_rows(spark).cache()
    fitted = net(patience=3).setValidationIndicatorCol("held").fit(rows)
    scored = fitted.transform(rows)
    assert scored.agg(F.avg((F.col("lstm_pred") == F.col("target")).cast("int"))).first()[0] >= 0.9
    history = fitted.getOrDefault("history")
    assert history[-1] < history[0] and len(history) <= 9
    again = net(patience=3).setValidationIndicatorCol("held").fit(rows)
    assert again.getOrDefault("weights") == fitted.getOrDefault("weights")
    path = models.save(PipelineModel(stages=[fitted]), str(tmp_path), "a", "lstm")
    loaded = models.load(str(tmp_path), "a", "lstm")
    assert path.endswith("lstm") and loaded.stages[-1].getLength() == 4
    both = loaded.transform(rows.withColumn("n", F.monotonically_increasing_id())).select("n", F.col("lstm_pred").alias("p"))
    same = scored.withColumn("n", F.monotonically_increasing_id()).join(both, "n").where("p = lstm_pred")
    assert same.count() == rows.count()


def test_one_partition_is_plain_training(spark):
    """With one task and one batch an epoch is one Adam step on the mean gradient."""
    rows = order_rows(spark, 20).coalesce(1)
    classifier = net(epochs=1, batch=100)
    classifier._stored = lambda d: d.select(
        vector_to_array("features").alias("x"), F.col("target").alias("y"), F.lit(False).alias("held")
    )
    fitted = classifier.fit(rows)
    x = np.array([r["features"].toArray() for r in rows.collect()]).reshape(-1, 4, 2)
    y = np.array([r["target"] for r in rows.collect()])
    adam = recurrent.Adam(recurrent.Adam.begin(recurrent.initial(2, 8, 42)), 0.01)
    adam.move(recurrent.gradient(adam.weights, x, y, 8))
    assert fitted.getOrDefault("weights") == pytest.approx(adam.weights.tolist(), abs=1e-9)


def test_gaps_and_validation_share(spark):
    rows = order_rows(spark, 300)
    fitted = net(epochs=2, validation=0.2).fit(rows)
    assert len(fitted.getOrDefault("history")) == 3
    holes = rows.withColumn("features", F.when(F.col("target") == 1, F.col("features")))
    scored = fitted.transform(holes)
    assert scored.where("(lstm_pred IS NULL) != (features IS NULL)").isEmpty()
    assert fitted.transform(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        net().fit(rows.limit(0))
