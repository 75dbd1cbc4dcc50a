import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barweave.operators import binned_trees, models
from barweave.schema import FEATURES
from tests.helpers import same_rows


@pytest.fixture(scope="module")
def table(spark):
    """Rows of few values per column, so that every gap between values is a cut; a noisy label."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (3000, len(FEATURES))).astype(float) * rng.uniform(0.5, 2, len(FEATURES))
    y = (x[:, 0] + x[:, 3] * x[:, 4] / 10 + rng.normal(0, 3, len(x)) > 12).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    kinds = ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(rows, f"date int, {kinds}, target int").repartition(3).cache()


@pytest.fixture
def packed_from(monkeypatch):
    monkeypatch.setattr(models, "PACKED_ROWS", 1000)
    monkeypatch.setattr(binned_trees, "BLOCK_ROWS", 400)


def fit(table, **recipes):
    return models.fit_all(models.training_rows(table), recipes)


def share_right(df, name):
    return df.agg(F.avg((F.col(f"{name}_pred") == F.col("target")).cast("double"))).first()[0]


def test_boosting_equals_spark(table, packed_from, monkeypatch):
    recipe = models.boosted_trees(rounds=6)
    ours = fit(table, gbt=recipe)["gbt"]
    monkeypatch.setattr(models, "PACKED_ROWS", 10_000)
    spark_own = fit(table, gbt=recipe)["gbt"]
    assert isinstance(ours.stages[-1], binned_trees.BinnedTreesModel)
    assert isinstance(spark_own.stages[-1], GBTClassificationModel)
    a, b = (models.predict_probability(table, "gbt", m) for m in (ours, spark_own))
    both = a.join(b.select("date", F.col("gbt_pred").alias("p"), F.col("gbt_probability").alias("q")), "date")
    assert both.count() == 3000
    assert both.where("gbt_pred <> p or abs(gbt_probability - q) > 1e-6").isEmpty()


def test_margins_are_the_same_after_a_fresh_start(table, packed_from, monkeypatch):
    recipe = models.sampled_boosted_trees(rounds=5, depth=3)
    one = fit(table, xgb=recipe)
    monkeypatch.setattr(binned_trees, "_FRESH_ROUNDS", 2)
    two = fit(table, xgb=recipe)
    assert same_rows(models.predict(table, one), models.predict(table, two))
    weights = one["xgb"].stages[-1].getOrDefault("weights")
    assert weights == [1.0] + 4 * [0.05]


def test_forest(table, packed_from, tmp_path):
    recipe = models.random_forest(trees=30)
    fitted = fit(table, rf=recipe, lr=models.logistic(max_iter=5))
    model = fitted["rf"].stages[-1]
    assert isinstance(model, binned_trees.BinnedTreesModel) and model.getNumTrees() == 30
    scored = models.predict_probability(table, "rf", fitted["rf"])
    assert share_right(scored, "rf") > 0.8
    wrong = (F.col("rf_pred") == 1) != (F.col("rf_probability") > 0.5)
    assert scored.where(wrong | ~F.col("rf_probability").between(0, 1)).isEmpty()
    assert same_rows(models.predict(table, fitted), models.predict(table, fit(table, rf=recipe, lr=models.logistic(max_iter=5))))
    models.save(fitted["rf"], str(tmp_path), "a", "rf")
    again = models.load(str(tmp_path), "a", "rf")
    assert same_rows(models.predict(table, {"rf": again}), models.predict(table, {"rf": fitted["rf"]}))


def test_bootstrap_counts():
    times = binned_trees.bootstrap(42, 7, 3, 200_000)
    shares = np.bincount(times, minlength=4)[:4] / len(times)
    assert np.abs(shares - np.exp(-1) / np.array([1, 1, 2, 6])).max() < 0.005
    assert abs(times.mean() - 1) < 0.01
    assert (times == binned_trees.bootstrap(42, 7, 3, 200_000)).all()
    assert (times != binned_trees.bootstrap(42, 7, 4, 200_000)).any()


def test_one_class_and_other_labels(table, packed_from):
    only = table.withColumn("target", F.lit(1))
    fitted = fit(only, rf=models.random_forest(trees=3), gbt=models.boosted_trees(rounds=2))
    assert models.predict(only, fitted).where("rf_pred <> 1 or gbt_pred <> 1").isEmpty()
    with pytest.raises(Exception, match="labels are 0 or 1"):
        fit(table.withColumn("target", F.lit(2)), rf=models.random_forest(trees=3))


def test_settings_that_packed_trees_do_not_know_stay_with_spark(table, packed_from):
    deep = models.random_forest(trees=2).setMinInstancesPerNode(5)
    assert not models._packs(deep) and models._packs(models.sampled_boosted_trees())
    assert not models._packs(models.logistic())


def test_rows_without_a_vector(spark, table, packed_from):
    model = fit(table, gbt=models.boosted_trees(rounds=2))["gbt"].stages[-1]
    vectors = models.assembler().transform(table).select("date", "features")
    holes = vectors.withColumn("features", F.when(F.col("date") % 2 == 0, F.col("features")))
    scored = model.transform(holes)
    assert scored.where("(gbt_pred is null) <> (date % 2 <> 0)").isEmpty()
    assert scored.where("(gbt_raw is null) <> (date % 2 <> 0)").isEmpty()
    known = scored.where("gbt_raw is not null").select(vector_to_array("gbt_raw").alias("r"))
    assert known.where("r[0] <> -r[1]").isEmpty()


def test_of_two_siblings_the_smaller_is_counted():
    rng = np.random.default_rng(1)
    nodes = rng.integers(0, 9, (4, 3, binned_trees.BINS, 2))
    parents = nodes.reshape(2, 2, *nodes.shape[1:]).sum(axis=1)
    for right in ([0, 1], [1, 0], [0, 0], [1, 1]):
        counted = nodes[np.array([0, 2]) + right]
        assert (binned_trees._with_siblings(counted, parents, np.array(right)) == nodes).all()
    whole = np.zeros((2, 1, binned_trees.BINS, 2), np.int64)
    whole[0, 0, [0, 5], 0] = 3, 4
    whole[1, 0, [0, 5], 0] = 5, 4
    kept, right = binned_trees._smaller(whole, [(0, 2, 0.0, 0.0, 0.0)] * 2)
    assert (kept == whole).all() and right.tolist() == [0, 1]
    kept, right = binned_trees._smaller(whole, [(None, None, 0.0, None, None)] * 2)
    assert not len(kept) and not len(right)


def test_many_partitions_grow_the_same_trees(table, packed_from, monkeypatch):
    recipe = models.sampled_boosted_trees(rounds=3, depth=4)
    one = fit(table, xgb=recipe)
    monkeypatch.setattr(binned_trees, "_AT_ONCE", 1)
    assert same_rows(models.predict(table, one), models.predict(table, fit(table, xgb=recipe)))
