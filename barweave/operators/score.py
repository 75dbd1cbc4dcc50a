"""Applying fitted models to rows, and combining what several models say."""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.functions import columns as C
from barweave.schema import FAILED, FEATURES
from barweave.storage import new_path

# A model for the functions below: adds the named prediction column and nothing else.
Predictor = Callable[[DataFrame, str], DataFrame]


def rule(expression: Column) -> Predictor:
    """A predictor from a boolean expression."""
    return lambda df, name: df.withColumn(name, expression.cast("int"))


def fitted(model: PipelineModel) -> Predictor:
    """A predictor from a fitted pipeline; its vector columns do not reach the result."""

    def predict(df: DataFrame, name: str) -> DataFrame:
        return model.transform(df).select(*df.columns, F.col("prediction").alias(name))

    return predict


def chain(df: DataFrame, models: Mapping[str, Predictor]) -> DataFrame:
    """All models on the same rows, one after the other: no join, no shuffle.

    Adds ``<name>_pred`` per model.
    """
    return reduce(lambda acc, m: m[1](acc, f"{m[0]}_pred"), models.items(), df)


def join_predictions(
    df: DataFrame, models: Mapping[str, Predictor], on: Sequence[str] = ("symbol", "date")
) -> DataFrame:
    """Each model on its own branch, branches joined on ``on``.

    For models that cannot run on the same rows. NULL keys vanish and repeated keys multiply, as
    an inner join does; ``chain`` has neither problem.
    """
    first, *others = (
        (name, predict(df, f"{name}_pred")) for name, predict in models.items()
    )
    result = first[1].select(*on, "target", f"{first[0]}_pred")
    for name, branch in others:
        result = result.join(branch.select(*on, f"{name}_pred"), list(on))
    return result


def with_flags(df: DataFrame, models: Sequence[str], label: str = "target") -> DataFrame:
    """``<name>_correct`` per model; NULL where the label is."""
    return df.withColumns(
        {f"{m}_correct": C.agrees(F.col(f"{m}_pred"), F.col(label)) for m in models}
    )


def long_predictions(
    df: DataFrame, models: Sequence[str], keep: Sequence[str] = ("symbol", "date")
) -> DataFrame:
    """Wide to long: one row per input row and model, produced without a shuffle."""
    entries = [
        F.struct(F.lit(m).alias("model"), F.col(f"{m}_pred").cast("int").alias("predicted"))
        for m in models
    ]
    return df.select(
        *keep, F.col("target").cast("int").alias("actual"), F.inline(F.array(*entries))
    )


def score_with(
    predict: Predictor, name: str = "prediction", required: Sequence[str] = FEATURES
) -> Callable[[DataFrame], DataFrame]:
    """For ``df.transform``: score rows with complete features, mark the others as failed.

    Incomplete rows are scored on zeros, so that the model never sees a gap, and the result is
    discarded; that keeps one pass over the rows and their order.
    """

    def apply(df: DataFrame) -> DataFrame:
        kept = {f"_in_{c}": F.col(c) for c in required}
        safe = {c: F.when(F.col("_ok"), F.col(c)).otherwise(F.lit(0.0)) for c in required}
        scored = predict(
            df.withColumn("_ok", C.complete(required)).withColumns(kept).withColumns(safe), "_raw"
        )
        return (
            scored.withColumns({c: F.col(f"_in_{c}") for c in required})
            .withColumn(name, C.or_failed(F.col("_ok"), F.col("_raw")))
            .drop("_ok", "_raw", *kept)
        )

    return apply


def route(
    requests: DataFrame,
    models: Mapping[str, Callable[[DataFrame], DataFrame]],
    default: str | None = None,
) -> DataFrame:
    """Score each row with the model its ``model`` column names.

    A missing name means ``default``; an unknown name gives the failure mark. ``requests`` are
    stored by the model they go to, so that each branch reads its own files only.
    """
    known = F.col("model").isNull() | F.col("model").isin(*models)
    goes_to = F.when(known, F.coalesce(F.col("model"), F.lit(default)))
    path = new_path(requests.sparkSession, "requests")
    requests.withColumn("_goes_to", goes_to).write.partitionBy("_goes_to").parquet(path)
    schema = T.StructType([*requests.schema.fields, T.StructField("_goes_to", T.StringType())])
    stored = requests.sparkSession.read.schema(schema).parquet(path)
    parts = [
        stored.where(F.col("_goes_to") == m).drop("_goes_to").transform(score)
        for m, score in models.items()
    ]
    unknown = stored.where(F.col("_goes_to").isNull()).drop("_goes_to")
    return reduce(DataFrame.unionByName, [*parts, unknown.withColumn("prediction", F.lit(FAILED))])


def unknown_models(requests: DataFrame, models: Sequence[str]) -> DataFrame:
    """How many requests name each model that does not exist."""
    unknown = requests.where(F.col("model").isNotNull() & ~F.col("model").isin(*models))
    return unknown.groupBy("model").agg(F.count("*").alias("n_requests"))
