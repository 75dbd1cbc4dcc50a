"""Quality of predictions, always as aggregates over a long table (keys, actual, predicted)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barweave.functions import columns as C

_KEYS = ("symbol", "model")


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole with 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def binary_metrics(predictions: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1. Rows without a label do not count."""
    actual, predicted = F.col("actual"), F.col("predicted")
    counts = (
        predictions.where(actual.isNotNull() & predicted.isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("_n"),
            F.count_if(actual == predicted).alias("_hit"),
            F.count_if((actual == 1) & (predicted == 1)).alias("_tp"),
            F.count_if(predicted == 1).alias("_pp"),
            F.count_if(actual == 1).alias("_ap"),
        )
    )
    precision = _ratio(F.col("_tp"), F.col("_pp"))
    recall = _ratio(F.col("_tp"), F.col("_ap"))
    return counts.select(
        *keys,
        _ratio(F.col("_hit"), F.col("_n")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def class_metrics(predictions: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """Precision, recall, F1 and support of each class that occurs as label or prediction.

    The rows shrink to one confusion cell per (keys, actual, predicted) before anything else; each
    cell then counts for its actual and for its predicted class.
    """
    cells = (
        predictions.where(F.col("actual").isNotNull() & F.col("predicted").isNotNull())
        .groupBy(*keys, F.col("actual").cast("int"), F.col("predicted").cast("int"))
        .agg(F.count("*").alias("_n"))
    )
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("_n")).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"),
            F.col("_n").alias("_actual"),
            zero.alias("_predicted"),
            hit.alias("_tp"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            zero.alias("_actual"),
            F.col("_n").alias("_predicted"),
            zero.alias("_tp"),
        ),
    )
    per_class = (
        cells.select(*keys, F.inline(sides))
        .groupBy(*keys, "label")
        .agg(*[F.sum(c).alias(c) for c in ("_actual", "_predicted", "_tp")])
    )
    precision = _ratio(F.col("_tp"), F.col("_predicted"))
    recall = _ratio(F.col("_tp"), F.col("_actual"))
    return per_class.select(
        *keys,
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
        F.col("_actual").alias("support"),
        F.col("_tp").alias("hits"),
    )


def _weighted(c: str) -> Column:
    return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))


def weighted_metrics(predictions: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over the classes by support."""
    return (
        class_metrics(predictions, keys)
        .groupBy(*keys)
        .agg(
            _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
            _weighted("precision").alias("precision"),
            _weighted("recall").alias("recall"),
            _weighted("f1").alias("f1"),
        )
    )


def classification_report(predictions: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """One row per class and three summary rows: accuracy, macro avg and weighted avg.

    As in the printed report, the accuracy row shows its value in the F1 column only. The list
    per key holds one entry per class.
    """
    nothing = F.lit(None).cast("double")
    one_class = F.struct(
        F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support"
    )
    summary = class_metrics(predictions, keys).groupBy(*keys).agg(
        F.collect_list(one_class).alias("_classes"),
        F.sum("support").alias("_support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("_accuracy"),
        *[F.avg(c).alias(f"_macro_{c}") for c in ("precision", "recall", "f1")],
        *[_weighted(c).alias(f"_weighted_{c}") for c in ("precision", "recall", "f1")],
    )

    def line(label: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("_support").alias("support"),
        )

    def averages(kind: str) -> list[Column]:
        return [F.col(f"_{kind}_{c}") for c in ("precision", "recall", "f1")]

    lines = F.array(
        line("accuracy", nothing, nothing, F.col("_accuracy")),
        line("macro avg", *averages("macro")),
        line("weighted avg", *averages("weighted")),
    )
    return summary.select(*keys, F.inline(F.concat("_classes", lines)))


def comparison_table(
    predictions: DataFrame, *, weighted: bool = False, digits: int = 4
) -> DataFrame:
    """One row per model: accuracy, precision, recall, F1, rounded."""
    metrics = (weighted_metrics if weighted else binary_metrics)(predictions, ("model",))
    return metrics.select(
        "model",
        *[F.round(c, digits).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
    )


def result_rows(predictions: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Date as text, actual, predicted and whether they match."""
    return predictions.select(
        *keys,
        C.result_date(F.col("date")).alias("date"),
        "actual",
        "predicted",
        C.match_text(F.col("actual"), F.col("predicted")).alias("match"),
    )


def last_rows(df: DataFrame, n: int = 10, key: Sequence[str] = ("symbol",)) -> DataFrame:
    """The ``n`` latest rows of each key.

    Rows of one date are ordered by their other columns, so repeated dates give the same rows on
    every run. Spark limits the rows per key before the exchange, so a task sends at most ``n``
    rows per key.
    """
    rest = [c for c in df.columns if c not in (*key, "date")]
    newest = Window.partitionBy(*key).orderBy(F.col("date").desc(), *rest)
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")
