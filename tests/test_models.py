import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barweave.operators import models, score, sequences
from barweave.schema import FEATURES
from barweave.sources.bars import ordered_daily
from tests.helpers import price_rows, same_rows


@pytest.fixture(scope="module")
def table(spark):
    """300 rows whose label follows the first feature."""
    n = F.col("id")
    noise = [(F.pmod(n * (k + 3), F.lit(17)) / 17.0).alias(c) for k, c in enumerate(FEATURES[1:])]
    signal = F.pmod(n * 7, F.lit(10)) / 10.0
    rows = spark.range(300).select(
        F.when(n % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("symbol"),
        n.alias("date"),
        signal.alias(FEATURES[0]),
        *noise,
        (signal > 0.55).cast("int").alias("target"),
    )
    return rows.coalesce(1).cache()


@pytest.fixture(scope="module")
def fitted(table):
    recipes = {
        "lr": models.logistic(max_iter=30),
        "rf": models.random_forest(trees=10),
        "gbt": models.boosted_trees(rounds=3),
        "xgb": models.sampled_boosted_trees(rounds=3),
    }
    return models.fit_all(models.training_rows(table), recipes, parallelism=2)


def test_models_find_the_signal(table, fitted):
    scored = models.predict(table, fitted)
    assert scored.columns == [*table.columns, "lr_pred", "rf_pred", "gbt_pred", "xgb_pred"]
    for name in fitted:
        share = scored.agg(F.avg((F.col(f"{name}_pred") == F.col("target")).cast("int"))).first()[0]
        assert share > 0.9, name
        assert scored.where(~F.col(f"{name}_pred").isin(0.0, 1.0)).isEmpty()


def test_logistic_by_hand(table, fitted):
    lr = fitted["lr"].stages[-1]
    z = F.lit(float(lr.intercept))
    for c, w in zip(FEATURES, lr.coefficients):
        z = z + F.col(c) * float(w)
    scored = models.predict_probability(table, "lr", fitted["lr"])
    wrong = F.abs(F.col("lr_probability") - 1 / (1 + F.exp(-z))) > 1e-9
    assert scored.where(wrong | ((z > 0).cast("double") != F.col("lr_pred"))).isEmpty()


def test_same_seed_same_model(table, fitted):
    again = models.fit_all(models.training_rows(table), {"rf": models.random_forest(trees=10)})
    assert same_rows(models.predict(table, {"rf": fitted["rf"]}), models.predict(table, again))


def test_combined_equals_single(table, fitted):
    combined = models.predict(table, fitted)
    for name, model in fitted.items():
        assert same_rows(combined.select("date", f"{name}_pred"), models.predict(table, {name: model}).select("date", f"{name}_pred"))
    assert len(models.combine(fitted).stages) == 1 + len(fitted)


def test_reload(table, fitted, tmp_path):
    path = models.save(fitted["rf"], str(tmp_path), "a", "rf")
    assert path.endswith("/a/rf")
    models.save(fitted["rf"], str(tmp_path), "a", "rf")  # replaces
    again = models.load(str(tmp_path), "a", "rf")
    assert same_rows(models.predict(table, {"rf": fitted["rf"]}), models.predict(table, {"rf": again}))


def test_every_symbol():
    seen = []
    models.for_each_symbol((str(i) for i in range(100)), lambda n, s: seen.append((n, s)), 3)
    assert sorted(seen) == [(i, str(i)) for i in range(100)]
    with pytest.raises(ZeroDivisionError):
        models.for_each_symbol(["a"], lambda n, s: 1 / 0)


def test_recipes():
    rf = models.random_forest(trees=300, depth=8)
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getSeed()) == (300, 8, 42)
    assert models.random_forest().getNumTrees() == 100
    assert models.boosted_trees().getMaxIter() == 20
    xgb = models.sampled_boosted_trees()
    assert (xgb.getMaxIter(), xgb.getMaxDepth(), xgb.getStepSize()) == (300, 6, 0.05)
    assert (xgb.getSubsamplingRate(), xgb.getFeatureSubsetStrategy()) == (0.8, "0.8")
    plain, penalised = models.logistic(), models.logistic(max_iter=400, l2_rows=200)
    assert (plain.getMaxIter(), plain.getRegParam(), plain.getStandardization()) == (100, 0.0, True)
    assert (penalised.getRegParam(), penalised.getStandardization()) == (0.005, False)
    assert models.sequence_net(length=10, units=64, epochs=15).getLayers() == [90, 64, 2]


def test_sequence_net(spark):
    closes = [float(i % 4) for i in range(120)]
    rows = sequences.add_sequences(ordered_daily(price_rows(spark, closes)), 4, ["close"]).rows()
    label = (F.element_at("sequence", 1)[0] > 1.5).cast("double")
    windows = sequences.complete_sequences(rows).withColumn("target", label)
    vectors = models.sequence_vectors(windows)
    net = models.sequence_net(length=4, units=4, epochs=50, n_features=1)
    fitted = models.fit_all(vectors, {"lstm": net}, stages=list)
    scored = models.predict_probability(vectors, "lstm", fitted["lstm"])
    assert scored.agg(F.avg((F.col("lstm_pred") == F.col("target")).cast("int"))).first()[0] > 0.9
    assert scored.where(~F.col("lstm_probability").between(0, 1)).isEmpty()


def test_scaled_stages(table):
    with_flat = table.withColumn("flat", F.lit(3.0))
    recipes = {"lr": models.logistic(max_iter=5)}
    columns = [*FEATURES, "flat"]
    fitted = models.fit_all(
        models.training_rows(with_flat, columns), recipes, stages=lambda: models.scaled_stages(columns)
    )
    values = fitted["lr"].transform(with_flat).select(vector_to_array("features").alias("v"))
    ends = values.select(F.array_min("v").alias("a"), F.array_max("v").alias("b"), F.col("v")[9].alias("f"))
    assert ends.agg(F.min("a"), F.max("b"), F.min("f"), F.max("f")).first() == (0.0, 1.0, 0.5, 0.5)


def test_fitted_pipelines_as_predictors(spark, table):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    pipe = Pipeline(stages=[models.assembler(), LogisticRegression(labelCol="target", maxIter=5)])
    model = pipe.fit(table)
    wide = score.chain(table, {"x": score.fitted(model), "y": score.fitted(model)})
    assert wide.columns == [*table.columns, "x_pred", "y_pred"]
    assert wide.where("x_pred <> y_pred").isEmpty()
    holes = table.withColumn("open", F.when(F.col("date") > 10, F.col("open")))
    scored = holes.transform(score.score_with(score.fitted(model)))
    assert scored.where("prediction = -1").count() == 11


def test_a_fit_holds_few_rows_in_a_task(table, monkeypatch):
    class Counter:
        def fit(self, vectors):
            per_task = vectors.groupBy(F.spark_partition_id()).count().collect()
            seen.append((len(per_task), sum(r["count"] for r in per_task)))
            return self

    seen, rows = [], models.training_rows(table)
    models.fit_all(rows, {"one": Counter()})
    monkeypatch.setattr(models, "TASK_ROWS", 60)
    models.fit_all(rows, {"one": Counter()})
    assert seen == [(1, 300), (5, 300)]
