"""Training, storing and combining Spark ML classifiers."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.operators import binned_trees, packed_nets
from barweave.operators.recurrent import RecurrentClassifier
from barweave.operators.sequences import flat
from barweave.schema import FEATURES

SEED = 42

# Rows of a task in a fit. A forest of a hundred trees keeps half a kilobyte for each, and a task
# reads all of its rows again for every level.
TASK_ROWS = 500_000

# Rows beyond which ``fit_all`` fits trees and feed-forward nets over packed rows. Spark's own trees
# keep every row as an object with its bootstrap counts, its nets keep every window as doubles; both
# outgrow the memory and are read in whole for every level or step.
PACKED_ROWS = 500_000


def _named(classifier: Estimator, name: str) -> Estimator:
    """Own output columns per model, so that several models fit into one pass over the rows."""
    return (
        classifier.setFeaturesCol("features")
        .setLabelCol("target")
        .setPredictionCol(f"{name}_pred")
        .setRawPredictionCol(f"{name}_raw")
        .setProbabilityCol(f"{name}_probability")
    )


def logistic(name: str = "lr", *, max_iter: int = 100, l2_rows: int | None = None) -> Estimator:
    """Logistic regression. ``l2_rows`` gives the unit L2 penalty common elsewhere: 1/n on
    unstandardised features, n being the number of training rows."""
    penalty = {"regParam": 1.0 / l2_rows, "standardization": False} if l2_rows else {}
    return _named(LogisticRegression(maxIter=max_iter, **penalty), name)


def random_forest(
    name: str = "rf", *, trees: int = 100, depth: int = 5, seed: int = SEED
) -> Estimator:
    return _named(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed), name)


def boosted_trees(name: str = "gbt", *, rounds: int = 20, seed: int = SEED) -> Estimator:
    return _named(GBTClassifier(maxIter=rounds, seed=seed), name)


def sampled_boosted_trees(
    name: str = "xgb",
    *,
    rounds: int = 300,
    depth: int = 6,
    step: float = 0.05,
    rows: float = 0.8,
    features: float = 0.8,
    seed: int = SEED,
) -> Estimator:
    """Boosting with shrinkage, sampling rows per round and features per node."""
    boosted = GBTClassifier(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=rows,
        featureSubsetStrategy=str(features),
        seed=seed,
    )
    return _named(boosted, name)


def recurrent_net(
    name: str = "lstm",
    *,
    length: int = 5,
    units: int = 32,
    epochs: int = 30,
    batch: int = 16,
    patience: int = 0,
    validation: float = 0.0,
    step: float = 0.001,
    seed: int = SEED,
) -> RecurrentClassifier:
    """An LSTM over the steps of the window. ``patience`` ends training when the loss on held-out
    rows has not fallen for so many epochs; the best weights are kept."""
    net = RecurrentClassifier(
        length=length,
        units=units,
        epochs=epochs,
        batch=batch,
        patience=patience,
        validation=validation,
        stepSize=step,
        seed=seed,
    )
    net.setFeaturesCol("features").setLabelCol("target")
    return net.setPredictionCol(f"{name}_pred").setProbabilityCol(f"{name}_probability")


def sequence_net(
    name: str = "lstm",
    *,
    length: int = 5,
    units: int = 32,
    epochs: int = 30,
    n_features: int = len(FEATURES),
    seed: int = SEED,
) -> Estimator:
    """A feed-forward net over the flattened window; quicker than ``recurrent_net``."""
    net = MultilayerPerceptronClassifier(
        layers=[n_features * length, units, 2], maxIter=epochs, seed=seed
    )
    return _named(net, name)


def assembler(columns: Sequence[str] = FEATURES, output: str = "features") -> VectorAssembler:
    """Nine columns to one vector; a gap is an error, incomplete rows are kept away before."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def scaled_stages(columns: Sequence[str] = FEATURES) -> list:
    """Assembling plus min-max scaling over all rows (a constant column maps to 0.5 there)."""
    return [
        assembler(columns, "features_raw"),
        MinMaxScaler(inputCol="features_raw", outputCol="features"),
    ]


def feature_array(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """The assembled vector as an array column ``features``."""
    assembled = assembler(columns, "_vector").transform(df)
    return assembled.withColumn("features", vector_to_array("_vector")).drop("_vector")


def sequence_vectors(df: DataFrame) -> DataFrame:
    """``sequence`` as the vector column ``features``."""
    return df.withColumn("features", array_to_vector(flat(F.col("sequence"))))


def training_rows(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Only what a fit reads, without gaps, the label as double."""
    needed = df.select(*columns, F.col("target").cast("double").alias("target"))
    return needed.na.drop("any")


def _dealt(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` as they are, or in more partitions where one would hold too many."""
    parts = math.ceil(count / TASK_ROWS)
    return rows if parts <= rows.rdd.getNumPartitions() else rows.repartition(parts)


_NAMED = {"featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol", "seed"}
_FOREST = _NAMED | {"numTrees", "maxDepth"}
_BOOSTING = _NAMED | {"maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy"}
_NET = _NAMED | {"layers", "maxIter", "tol"}


def _packs(recipe: Estimator) -> bool:
    """Whether packed rows can grow these trees: every setting is one that they know."""
    known = {RandomForestClassifier: _FOREST, GBTClassifier: _BOOSTING}.get(type(recipe))
    if known is None or recipe.getMaxDepth() > 10:
        return False
    return {p.name for p in recipe.params if recipe.isSet(p)} <= known


def _packs_net(recipe: Estimator) -> bool:
    """Whether packed rows can fit this net: every setting is one that they know."""
    if not isinstance(recipe, MultilayerPerceptronClassifier):
        return False
    return {p.name for p in recipe.params if recipe.isSet(p)} <= _NET


def _drawn_columns(strategy: str, n: int, all_: str) -> int:
    """Features of a node, as Spark counts them."""
    if strategy in ("auto", "all"):
        return n if all_ == "all" or strategy == "all" else math.ceil(math.sqrt(n))
    return math.ceil(float(strategy) * n)


def _fit_packed(recipe: Estimator, packed: binned_trees.Packed) -> Transformer:
    n, seed, depth = len(packed.cuts), recipe.getSeed(), recipe.getMaxDepth()
    if isinstance(recipe, RandomForestClassifier):
        columns = _drawn_columns(recipe.getFeatureSubsetStrategy(), n, "sqrt")
        model = binned_trees.forest(
            packed, trees=recipe.getNumTrees(), depth=depth, columns=columns, seed=seed
        )
    else:
        model = binned_trees.boosted(
            packed,
            rounds=recipe.getMaxIter(),
            depth=depth,
            step=recipe.getStepSize(),
            share=recipe.getSubsamplingRate(),
            columns=_drawn_columns(recipe.getFeatureSubsetStrategy(), n, "all"),
            seed=seed,
        )
    names = ("featuresCol", "predictionCol", "rawPredictionCol", "probabilityCol")
    return model._set(**{c: recipe.getOrDefault(c) for c in names})


def fit_all(
    rows: DataFrame,
    recipes: Mapping[str, Estimator],
    stages: Callable[[], list] = lambda: [assembler()],
    parallelism: int = 1,
    keep: Sequence[str] = (),
) -> dict[str, PipelineModel]:
    """Fit every recipe on the same rows, assembled and stored once.

    ``keep`` names further columns that a recipe reads, such as the mark of its validation rows.
    Each fit is a distributed job series; ``parallelism`` lets several share the cluster. Forests,
    boosting and feed-forward nets over more than ``PACKED_ROWS`` rows are fitted over packed rows; a
    net then takes the rows as they come, since windows pack best behind the one before. For other
    models tables whose files would give a task more than ``TASK_ROWS`` are dealt out to more tasks.
    """
    count = rows.count()
    over_bins = {n for n, e in recipes.items() if count > PACKED_ROWS and _packs(e)}
    nets = {n for n, e in recipes.items() if count > PACKED_ROWS and _packs_net(e)}
    others = [e for n, e in recipes.items() if n not in over_bins | nets]
    # Regression keeps its rows in blocks, which need no more tasks.
    if not over_bins | nets or any(not isinstance(e, LogisticRegression) for e in others):
        rows = _dealt(rows, count)
    prepared = Pipeline(stages=stages()).fit(rows)
    vectors = prepared.transform(rows).select("features", "target", *keep)
    if others:
        vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    packed = binned_trees.pack(vectors) if over_bins else None

    def fit(name: str) -> Transformer:
        recipe = recipes[name]
        if name in nets:
            return packed_nets.fit(recipe, vectors)
        return _fit_packed(recipe, packed) if name in over_bins else recipe.fit(vectors)

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = pool.map(fit, recipes)
            return {
                name: PipelineModel(stages=[*prepared.stages, model])
                for name, model in zip(recipes, models)
            }
    finally:
        if others:
            vectors.unpersist()
        if packed is not None:
            packed.release()


def for_each_symbol(
    symbols: Iterable[str], work: Callable[[int, str], None], parallelism: int = 4
) -> None:
    """Run ``work(number, symbol)`` for every symbol, a few at a time.

    The loop is over models to build; every job inside is distributed. ``work`` stores what it
    makes, so nothing grows on the driver with the number of symbols.
    """
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for some in itertools.batched(enumerate(symbols), 16 * parallelism):
            for _ in pool.map(lambda item: work(*item), some):
                pass


def _preparation(stage: Transformer) -> tuple:
    """What a preparing stage does, without the name it happens to have."""
    settings = {p.name: stage.getOrDefault(p) for p in stage.params if stage.isDefined(p)}
    return type(stage).__name__, *[f"{k}={v}" for k, v in sorted(settings.items())]


def combine(models: Mapping[str, PipelineModel]) -> PipelineModel:
    """One pipeline with all classifiers behind a single preparation.

    The models must share their preparing stages, as those of one ``fit_all`` call do.
    """
    first = next(iter(models.values()))
    plans = {tuple(map(_preparation, m.stages[:-1])) for m in models.values()}
    if len(plans) > 1:
        raise ValueError("these models prepare their rows differently: score them apart")
    return PipelineModel(stages=[*first.stages[:-1], *[m.stages[-1] for m in models.values()]])


def predict(df: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """``<name>_pred`` per model; no join, no shuffle, the vector built once."""
    scored = combine(models).transform(df)
    return scored.select(*df.columns, *[F.col(f"{name}_pred") for name in models])


def predict_sequences(df: DataFrame, name: str, model: PipelineModel, width: int) -> DataFrame:
    """``<name>_pred`` from ``sequence``, NULL where there is none yet.

    ``width`` is the number of values in a sequence. Rows without one are scored on zeros and the
    result is discarded, which keeps one pass and works on streams.
    """
    zeros = F.array_repeat(F.lit(0.0), width)
    values = F.coalesce(flat(F.col("sequence")), zeros)
    scored = model.transform(df.withColumn("features", array_to_vector(values)))
    known = F.when(F.col("sequence").isNotNull(), F.col(f"{name}_pred"))
    return scored.select(*df.columns, known.alias(f"{name}_pred"))


def predict_probability(df: DataFrame, name: str, model: PipelineModel) -> DataFrame:
    """``<name>_pred`` and the probability of class 1."""
    scored = model.transform(df)
    probability = vector_to_array(F.col(f"{name}_probability"))[1]
    return scored.select(
        *df.columns, F.col(f"{name}_pred"), probability.alias(f"{name}_probability")
    )


def model_path(root: str, symbol: str, name: str) -> str:
    return f"{root.rstrip('/')}/{symbol}/{name}"


def save(model: PipelineModel, root: str, symbol: str, name: str) -> str:
    path = model_path(root, symbol, name)
    model.write().overwrite().save(path)
    return path


def load(root: str, symbol: str, name: str) -> PipelineModel:
    return PipelineModel.load(model_path(root, symbol, name))
