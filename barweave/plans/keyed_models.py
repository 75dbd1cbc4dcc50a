"""Models of all symbols in tables keyed by symbol: trained together, served by one stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barweave.operators import clean, features, score, split
from barweave.operators.logistic_by_key import fit_by_key, predict_by_key
from barweave.operators.trees_by_key import Trees, boost_by_key, forest_by_key
from barweave.schema import message_schema
from barweave.streaming import scoring, sinks

Model = DataFrame | Trees

# The models a run can name.
RECIPES: dict[str, Callable[..., Model]] = {
    "lr": fit_by_key,
    "rf": forest_by_key,
    "xgb": boost_by_key,
}


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/by_symbol/{name}"


def save(model: Model, root: str, name: str) -> None:
    """Store a model of all symbols under ``root``, in place of one of the same name."""
    if isinstance(model, Trees):
        model.save(_path(root, name))
    else:
        model.write.mode("overwrite").parquet(_path(root, name))


def load(spark: SparkSession, root: str, name: str) -> Model:
    if name == "lr":
        return spark.read.parquet(_path(root, name))
    return Trees.load(spark, _path(root, name))


def predict(rows: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """``<name>_pred`` and ``<name>_probability`` by every model; NULL for symbols without one."""
    for name, model in models.items():
        rows = (
            model.predict(rows, name)
            if isinstance(model, Trees)
            else predict_by_key(rows, model, name=name)
        )
    return rows


def train(
    table: DataFrame,
    root: str,
    names: Sequence[str],
    settings: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """Fit the named models for all symbols of a feature table in the same jobs, store them and
    return long predictions of the test rows. ``settings`` overrides options of a model."""
    settings = settings or {}
    unknown = set(names) - set(RECIPES)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    training, test = split.train_rows(table), split.test_rows(table)
    parts = []
    for name in names:
        save(RECIPES[name](training, **settings.get(name, {})), root, name)
        scored = predict(test, {name: load(table.sparkSession, root, name)})
        parts.append(score.long_predictions(scored, [name]))
    return reduce(DataFrame.unionByName, parts)


def score_stream(
    stream: DataFrame,
    root: str,
    names: Sequence[str],
    out: str,
    checkpoint: str,
    *,
    flags: bool = False,
    scaler: str | None = None,
    symbol: str = "string",
    **when: object,
) -> StreamingQuery:
    """Score messages of any number of symbols, each row by the models of its own symbol.

    Messages name their symbol in a field ``symbol`` of the type given; without it, and for a symbol
    without models, predictions are NULL. Outputs are those of ``programs.score_stream``,
    tables of committed batches under ``out``. ``scaler`` names stored bounds of scaled training.
    """
    spark = stream.sparkSession
    stored = {n: load(spark, root, n) for n in names}
    schema = T.StructType.fromDDL(f"symbol {symbol}")
    schema = T.StructType([*schema.fields, *message_schema().fields])

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame:
        rows = clean.default_derived(batch)
        return rows if scaler is None else features.scale_with(rows, spark.read.parquet(scaler))

    write = scoring.scoring_writer(
        lambda rows: predict(rows, stored),
        names,
        f"{out}/predictions",
        dead_letters=f"{out}/dead_letters",
        metrics=f"{out}/metrics",
        flags=flags,
        keep=("symbol", "date"),
        required=("open", "high", "low", "close", "volume"),
        prepare=prepare,
    )
    return sinks.each_batch(scoring.bars_from_messages(stream, schema), write, checkpoint, **when)
