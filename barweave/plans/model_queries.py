"""Registered queries that fit models on whole tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from barweave import storage
from barweave.operators import (
    evaluate,
    features,
    logistic_by_key,
    models,
    score,
    sequences,
    split,
    trees_by_key,
)
from barweave.plans import programs
from barweave.plans.queries import feature_rows, feature_table, gapped, query, rounded_features
from barweave.schema import FEATURES, MODEL_TITLES
from barweave.sources import bars as B


def marked_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Features with the chronological mark, as a table: training and scoring both read it."""
    return storage.hand_over(split.chronological(feature_rows(spark, sf)).rows(), "marked")


def fitted_and_scored(
    spark: SparkSession, sf: str, recipes: Mapping[str, Estimator]
) -> DataFrame:
    """Fit on the training rows, predict the test rows."""
    rows = marked_rows(spark, sf)
    fitted = models.fit_all(models.training_rows(split.train_rows(rows)), recipes)
    scored = models.predict(split.test_rows(rows), fitted)
    return scored.select("symbol", "date", "target", *[f"{n}_pred" for n in recipes])


def standard_recipes() -> dict[str, Estimator]:
    return {
        "lr": models.logistic(),
        "rf": models.random_forest(),
        "gbt": models.boosted_trees(),
    }


@query
def train_lr(spark, sf):
    return fitted_and_scored(spark, sf, {"lr": models.logistic()})


@query
def train_rf(spark, sf):
    return fitted_and_scored(spark, sf, {"rf": models.random_forest()})


@query
def train_gbt(spark, sf):
    return fitted_and_scored(spark, sf, {"gbt": models.boosted_trees()})


@query
def train_gbt_sampled(spark, sf):
    return fitted_and_scored(spark, sf, {"xgb": models.sampled_boosted_trees()})


@query
def train_sequence(spark, sf):
    """Windows of five scaled feature rows, scaling and net fitted on the training part."""
    marked = split.chronological(feature_rows(spark, sf), skip=5)
    scaled = features.scale(marked, FEATURES, F.coalesce("is_train", F.lit(True)))
    windows = sequences.complete_sequences(sequences.add_sequences(scaled, 5).rows())
    columns = ("symbol", "date", "target", "sequence", "is_train")
    rows = storage.hand_over(windows.select(*columns), "windows", "zstd")
    vectors = models.sequence_vectors(rows).select("symbol", "date", "target", "features", "is_train")
    training = split.train_rows(vectors).withColumn("target", F.col("target").cast("double"))
    net = {"lstm": models.sequence_net()}
    fitted = models.fit_all(training, net, stages=list)
    scored = models.predict_probability(split.test_rows(vectors), "lstm", fitted["lstm"])
    return scored.select("symbol", "date", "target", "lstm_pred", "lstm_probability")


@query
def train_all(spark, sf):
    """All models of every event type, then their test rows as long predictions."""
    rows = split.chronological(
        features.add_features(B.ordered_daily(B.event_bars(spark, sf)))
    ).rows()
    path = storage.new_path(spark, "bars")
    rows.write.partitionBy("symbol").parquet(path)
    table = spark.read.parquet(path)
    out = storage.new_path(spark, "predictions")

    def one(number: int, symbol: str) -> None:
        own = table.where(F.col("symbol") == symbol)
        training = models.training_rows(split.train_rows(own))
        fitted = models.fit_all(training, standard_recipes())
        scored = models.predict(split.test_rows(own), fitted)
        long = score.long_predictions(scored, list(standard_recipes()))
        long.write.parquet(f"{out}/part={number}")

    models.for_each_symbol(programs.symbols_of(table), one)
    return spark.read.parquet(out).drop("part")


@query
def train_planted(spark, sf):
    """Row models learn a label planted in one feature: whether the bar rose. Counts of the test
    rows, whether all answers are classes, and whether nine in ten are right."""
    rows = marked_rows(spark, sf).withColumn("target", (F.col("ret1") > 0).cast("int"))
    fitted = models.fit_all(models.training_rows(split.train_rows(rows)), standard_recipes())
    scored = models.predict(split.test_rows(rows), fitted)
    right = (F.col("predicted") == F.col("actual")).cast("double")
    return score.long_predictions(scored, list(fitted)).groupBy("model").agg(
        F.count("*").alias("n_rows"),
        F.sum("actual").alias("n_up"),
        F.bool_and(F.col("predicted").isin(0, 1)).alias("classes"),
        (F.avg(right) >= 0.9).alias("learned"),
    )


def _learned(long: DataFrame) -> DataFrame:
    """Counts of long predictions by model, whether all are classes and nine in ten right."""
    right = (F.col("predicted") == F.col("actual")).cast("double")
    return long.groupBy("model").agg(
        F.count("*").alias("n_rows"),
        F.sum("actual").alias("n_up"),
        F.bool_and(F.col("predicted").isin(0, 1)).alias("classes"),
        (F.avg(right) >= 0.9).alias("learned"),
    )


@query
def train_recurrent(spark, sf):
    """An LSTM learns a label planted in the order of the rows: whether the close rose from the
    first bar of a window to the last. The same rows the other way round have the other label.
    Training ends when the loss on the last tenth of the training windows stops falling."""

    def rising(df: DataFrame, w: WindowSpec) -> DataFrame:
        up = F.lag("close", 1).over(w) > F.lag("close", 5).over(w)
        return df.withColumn("target", up.cast("int"))

    marked = split.chronological(feature_rows(spark, sf).framed(5, 0, rising), skip=5)
    share = split.TRAIN_SHARE * split.TRAIN_SHARE
    marked = split.chronological(marked, share, skip=5, name="is_fit")
    scaled = features.scale(marked, FEATURES, F.coalesce("is_train", F.lit(True)))
    windows = sequences.complete_sequences(sequences.add_sequences(scaled, 5).rows())
    valid = (~F.col("is_fit")).alias("is_valid")
    columns = ("symbol", "date", "target", "sequence", "is_train", valid)
    vectors = models.sequence_vectors(storage.hand_over(windows.select(*columns), "windows"))
    training = split.train_rows(vectors).withColumn("target", F.col("target").cast("double"))
    net = models.recurrent_net(units=16, epochs=40, batch=32, patience=4, step=0.01)
    net.setValidationIndicatorCol("is_valid")
    fitted = models.fit_all(training, {"lstm": net}, stages=list, keep=["is_valid"])
    scored = models.predict(split.test_rows(vectors), fitted)
    return _learned(score.long_predictions(scored, ["lstm"]))


@query
def train_boosted(spark, sf):
    """Second-order boosting over the whole table learns a planted label: whether the bar rose."""
    rows = marked_rows(spark, sf).withColumns(
        {"target": (F.col("ret1") > 0).cast("int"), "all": F.lit(1)}
    )
    training = split.train_rows(rows).select("all", *FEATURES, "target")
    trees = trees_by_key.boost_by_key(training, "all", rounds=5, depth=3, step=0.5)
    scored = trees.predict(split.test_rows(rows), "xgb")
    return _learned(score.long_predictions(scored, ["xgb"]))


@query
def train_all_symbols(spark, sf):
    """Logistic regression, forest and boosting for every supplier at once; a planted label."""
    rows = marked_rows(spark, sf).withColumn("target", (F.col("ret1") > 0).cast("int"))
    training = split.train_rows(rows)
    lr = logistic_by_key.fit_by_key(training, l2=0.001)
    rf = trees_by_key.forest_by_key(training, trees=10, depth=4)
    xgb = trees_by_key.boost_by_key(training, rounds=3, depth=3, step=0.5)
    scored = logistic_by_key.predict_by_key(split.test_rows(rows), lr)
    scored = xgb.predict(rf.predict(scored, "rf"), "xgb")
    return _learned(score.long_predictions(scored, ["lr", "rf", "xgb"]))


@query
def train_lr_optimum(spark, sf):
    """Every supplier's regression against the condition of its optimum, worked out from the rows:
    the summed derivative of loss and penalty is 0 by the intercept and by every coefficient."""
    rows = split.train_rows(marked_rows(spark, sf))
    fitted = logistic_by_key.fit_by_key(rows)
    scored = logistic_by_key.predict_by_key(rows, fitted)
    off = F.col("lr_probability") - F.col("target")
    sums = [F.sum(off * F.col(c)).alias(f"by_{c}") for c in FEATURES]
    size = [F.sum(F.abs(F.col(c))).alias(f"size_{c}") for c in FEATURES]
    found = scored.groupBy("symbol").agg(
        F.count("*").alias("n_rows"), F.sum("target").alias("n_up"), F.sum(off).alias("by"), *sums, *size
    ).join(fitted.select("symbol", "coefficients"), "symbol")
    flat = F.abs("by") <= 1e-6 * F.col("n_rows")
    for i, c in enumerate(FEATURES):
        slope = F.col(f"by_{c}") + F.col("coefficients")[i]
        flat = flat & (F.abs(slope) <= 1e-6 * F.greatest(F.col(f"size_{c}"), F.lit(1.0)))
    one = F.col("n_up").isin(0) | (F.col("n_up") == F.col("n_rows"))
    return found.select("symbol", "n_rows", "n_up", (flat | one).alias("optimal"))


@query
def evaluate_all(spark, sf):
    """Three models on the test rows: one scoring pass, one aggregation."""
    scored = fitted_and_scored(spark, sf, standard_recipes())
    long = score.long_predictions(scored, list(standard_recipes()))
    return evaluate.comparison_table(long, weighted=True).replace(MODEL_TITLES, subset=["model"])


@query
def batch_predict(spark, sf):
    """Class and probability of the test rows, against the logistic function of the stored
    coefficients worked out from the columns."""
    rows = marked_rows(spark, sf)
    fitted = models.fit_all(
        models.training_rows(split.train_rows(rows)), {"lr": models.logistic()}
    )
    scored = models.predict_probability(split.test_rows(rows), "lr", fitted["lr"])
    stage = fitted["lr"].stages[-1]
    margin = F.lit(float(stage.intercept))
    for name, weight in zip(FEATURES, stage.coefficients.toArray(), strict=True):
        margin = margin + F.col(name) * F.lit(float(weight))
    worked_out = 1 / (1 + F.exp(-margin))
    same = F.abs(worked_out - F.col("lr_probability")) < 1e-9
    agrees = same & (F.col("lr_pred") == (worked_out > 0.5).cast("double"))
    return scored.select("symbol", "date", "target", agrees.alias("consistent"))


@query
def model_roundtrip(spark, sf):
    """A stored and reloaded pipeline predicts what the original predicts."""
    rows = marked_rows(spark, sf)
    fitted = models.fit_all(
        models.training_rows(split.train_rows(rows)), {"rf": models.random_forest()}
    )
    root = storage.new_path(spark, "models")
    models.save(fitted["rf"], root, "all", "rf")
    again = models.load(root, "all", "rf").transform(models.predict(
        split.test_rows(rows), fitted).withColumnRenamed("rf_pred", "first_pred"))
    same = F.col("first_pred") == F.col("rf_pred")
    return again.select("symbol", "date", same.alias("same"))


@query
def multi_model_chain(spark, sf):
    """Fitted models in one chain give the rows and values that joined branches give."""
    rows = marked_rows(spark, sf)
    recipes = standard_recipes()
    fitted = models.fit_all(models.training_rows(split.train_rows(rows)), recipes)
    test = split.test_rows(rows)
    branches = {n: _branch(n, m) for n, m in fitted.items()}
    joined = score.join_predictions(test, branches).drop("target")
    joined = joined.withColumnsRenamed({f"{n}_pred": f"{n}_joined" for n in recipes})
    both = models.predict(test, fitted).join(joined, ["symbol", "date"], "full")
    same = F.lit(True)
    for n in recipes:
        same = same & F.col(f"{n}_pred").eqNullSafe(F.col(f"{n}_joined"))
    return both.select("symbol", "date", same.alias("same"))


def _branch(name: str, model) -> score.Predictor:
    return lambda df, column: models.predict(df, {name: model}).withColumnRenamed(
        f"{name}_pred", column
    )


@query
def udf_score(spark, sf):
    """In-engine scoring of rows with gaps: absent averages count as 0, absent prices fail."""
    rows = marked_rows(spark, sf)
    fitted = models.fit_all(
        models.training_rows(split.train_rows(rows)), {"lr": models.logistic()}
    )
    holes = gapped(split.test_rows(rows)).fillna(0.0, subset=["sma5", "sma10", "ret1", "ret5"])
    scored = holes.transform(score.score_with(_branch("lr", fitted["lr"])))
    known = F.when(F.col("prediction") >= 0, F.col("prediction").isin(0, 1))
    return scored.select("symbol", "date", known.alias("scored"))


@query
def route_by_model(spark, sf):
    """Each request goes to the model it names: none means the default, unknown ones fail."""
    names = F.array(*[F.lit(n) for n in ("log", "rf", "xgb", "lstm", "other")], F.lit(None))
    turn = F.pmod(F.dayofyear("date"), F.lit(6)) + 1
    table = rounded_features(spark, sf).withColumn("model", F.element_at(names, turn))
    requests = storage.hand_over(table, "requests")
    rules = {
        "log": F.col("close") > F.col("sma5"),
        "rf": F.col("ret1") > 0,
        "xgb": F.col("ret5") > 0,
        "lstm": F.col("close") > F.col("sma10"),
    }
    scorers = {n: score.score_with(score.rule(r)) for n, r in rules.items()}
    routed = score.route(requests, scorers, default="log")
    return routed.select("symbol", "date", "model", "prediction")


@query
def minmax_stage(spark, sf):
    """Scaling inside the pipeline: over all rows, a constant column gives one half."""
    table = storage.hand_over(feature_table(spark, sf).withColumn("flat", F.lit(7.0)), "features")
    columns = [*FEATURES, "flat"]
    scaled = Pipeline(stages=models.scaled_stages(columns)).fit(table).transform(table)
    values = scaled.withColumn("_v", vector_to_array("features"))
    return values.select(
        "symbol", "date", *[F.round(F.col("_v")[i], 6).alias(c) for i, c in enumerate(columns)]
    )
