"""What a user runs: files to tables, tables to models, models to reports and streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barweave import storage
from barweave.operators import clean, evaluate, features, models, score, sequences, split
from barweave.operators.ordered import OrderedRows
from barweave.plans.preprocess import prepare_raw
from barweave.schema import FEATURES, MODEL_TITLES, PRICE_COLUMNS
from barweave.sources import files, messages
from barweave.streaming import scoring, sinks, state

# The models a run can name, with their default settings.
RECIPES: dict[str, Callable[[], Estimator]] = {
    "lr": models.logistic,
    "rf": models.random_forest,
    "gbt": models.boosted_trees,
    "xgb": models.sampled_boosted_trees,
}
SEQUENCE_LENGTH = 5
Settings = Mapping[str, Mapping[str, float]]


def preprocess(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: str,
    *,
    scaler: str | None = None,
    fit_on: str = "train",
    scaled: bool = False,
) -> None:
    """Bar files of several symbols to one feature table, stored by symbol.

    ``scaler`` also stores the scaling bounds of the training rows, one row per symbol and column.
    """
    raw = files.read_symbols(spark, paths)
    if not scaler:
        table = prepare_raw(raw, fit_on=fit_on, scaled=scaled)
        table.write.mode("overwrite").partitionBy("symbol").parquet(out)
        return
    # The bounds come from the rows before scaling; serving applies the same ones.
    plain = storage.hand_over(prepare_raw(raw, scaled=False), "unscaled")
    fitted = plain if fit_on == "all" else plain.where("is_train")
    features.scaler_params(fitted).write.mode("overwrite").parquet(scaler)
    if scaled:
        plain = features.scale_with(plain, spark.read.parquet(scaler))
    plain.write.mode("overwrite").partitionBy("symbol").parquet(out)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A feature table; symbols that look like numbers stay text."""
    return spark.read.parquet(path).withColumn("symbol", F.col("symbol").cast("string"))


def symbols_of(table: DataFrame) -> Iterator[str]:
    """The symbols of a table in order, fetched piece by piece."""
    names = table.select("symbol").distinct().orderBy("symbol")
    return (r.symbol for r in names.toLocalIterator())


def sequence_scaler(table: DataFrame, length: int) -> DataFrame:
    """Scaling bounds for windows: from the rows that no test window has as its label."""
    bars = OrderedRows.arrange(table.drop("is_train"), ("symbol",), ("date", *PRICE_COLUMNS))
    marked = split.chronological(bars, skip=length).rows()
    return features.scaler_params(marked.where(F.coalesce("is_train", F.lit(True))))


def sequence_table(
    table: DataFrame, scaler: DataFrame, length: int = SEQUENCE_LENGTH
) -> DataFrame:
    """Windows of scaled features with their own chronological mark."""
    bars = OrderedRows.arrange(table.drop("is_train"), ("symbol",), ("date", *PRICE_COLUMNS))
    marked = split.chronological(bars, skip=length)
    # The last tenth of the training windows tells when a recurrent net should stop.
    fitting = split.TRAIN_SHARE * split.TRAIN_SHARE
    marked = split.chronological(marked, fitting, skip=length, name="is_fit").rows()
    by = ("date", *PRICE_COLUMNS)
    scaled = features.scale_with(marked, scaler)
    windows = sequences.add_sequences(OrderedRows.arrange(scaled, ("symbol",), by), length).rows()
    return models.sequence_vectors(
        sequences.complete_sequences(windows).select(
            "symbol", "date", "target", "sequence", "is_train", (~F.col("is_fit")).alias("is_valid")
        )
    ).drop("sequence")


def scaler_path(root: str) -> str:
    """Where the scaling bounds of a run's sequence models are kept."""
    return f"{root.rstrip('/')}/sequence_scaler"


def window_length(model: PipelineModel) -> int:
    """Rows in the windows of a stored sequence model."""
    return model.stages[-1].getLayers()[0] // len(FEATURES)


def _one_symbol(
    rows: DataFrame,
    windows: DataFrame | None,
    names: Sequence[str],
    settings: Settings,
    root: str,
    symbol: str,
) -> DataFrame:
    """Fit and store the models of one symbol; long predictions of its test rows."""
    parts = []
    plain = {n: RECIPES[n](**settings.get(n, {})) for n in names if n != "lstm"}
    if plain:
        fitted = models.fit_all(models.training_rows(split.train_rows(rows)), plain)
        scored = models.predict(split.test_rows(rows), fitted)
        parts.append(score.long_predictions(scored, list(plain)))
        for name, model in fitted.items():
            models.save(model, root, symbol, name)
    if windows is not None:
        training = split.train_rows(windows).withColumn("target", F.col("target").cast("double"))
        net = models.recurrent_net(**settings.get("lstm", {}))
        if net.getOrDefault("patience"):
            net.setValidationIndicatorCol("is_valid")
        fitted = models.fit_all(training, {"lstm": net}, stages=list, keep=["is_valid"])
        scored = models.predict(split.test_rows(windows), fitted)
        parts.append(score.long_predictions(scored, ["lstm"]))
        models.save(fitted["lstm"], root, symbol, "lstm")
    return reduce(DataFrame.unionByName, parts)


def train(
    spark: SparkSession,
    table_path: str,
    root: str,
    names: Sequence[str],
    symbols: Sequence[str] | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """Train the named models for every symbol, store them under ``root/<symbol>/<model>`` and
    return long predictions of the test rows, themselves stored.

    ``settings`` overrides options of a model's recipe, such as ``{"rf": {"trees": 300}}``.
    """
    settings = settings or {}
    unknown = set(names) - set(RECIPES) - {"lstm"}
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    table = read_table(spark, table_path)
    length = settings.get("lstm", {}).get("length", SEQUENCE_LENGTH)
    windows = None
    if "lstm" in names:
        sequence_scaler(table, length).write.mode("overwrite").parquet(scaler_path(root))
        scaler = spark.read.parquet(scaler_path(root))
        windows = storage.hand_over(sequence_table(table, scaler, length), "windows")
    out = storage.new_path(spark, "predictions")

    def one(number: int, symbol: str) -> None:
        own = F.col("symbol") == symbol
        own_windows = None if windows is None else windows.where(own)
        found = _one_symbol(table.where(own), own_windows, names, settings, root, symbol)
        found.write.parquet(f"{out}/part={number}")

    models.for_each_symbol(symbols or symbols_of(table), one)
    return spark.read.parquet(out).drop("part")


def report(predictions: DataFrame, out: str) -> DataFrame:
    """Write the result tables: last ten rows, per-class report, both kinds of metrics."""
    keys = ("symbol", "model")
    last = evaluate.last_rows(predictions, 10, keys)
    named = evaluate.result_rows(last, keys)
    files.write_csv(named, f"{out}/last_rows")
    files.write_csv(evaluate.classification_report(predictions, keys), f"{out}/classes")
    files.write_csv(evaluate.binary_metrics(predictions, keys), f"{out}/binary")
    files.write_csv(evaluate.weighted_metrics(predictions, keys), f"{out}/weighted")
    return evaluate.comparison_table(predictions).replace(MODEL_TITLES, subset=["model"])


def evaluate_stored(
    spark: SparkSession, table_path: str, root: str, symbol: str, names: Sequence[str]
) -> DataFrame:
    """Support-weighted comparison of stored models on the test rows of one symbol; sequence models
    on their test windows."""
    table = read_table(spark, table_path).where(F.col("symbol") == symbol)
    stored = {n: models.load(root, symbol, n) for n in names}
    plain = {n: m for n, m in stored.items() if n != "lstm"}
    parts = []
    if plain:
        scored = models.predict(split.test_rows(table), plain)
        parts.append(score.long_predictions(scored, list(plain)))
    if "lstm" in stored:
        scaler = spark.read.parquet(scaler_path(root))
        windows = sequence_table(table, scaler, window_length(stored["lstm"]))
        scored = models.predict(split.test_rows(windows), {"lstm": stored["lstm"]})
        parts.append(score.long_predictions(scored, ["lstm"]))
    long = reduce(DataFrame.unionByName, parts)
    return evaluate.comparison_table(long, weighted=True).replace(MODEL_TITLES, subset=["model"])


def publish(
    spark: SparkSession,
    table_path: str,
    symbol: str | None = None,
    *,
    folder: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    typed: bool = False,
) -> None:
    """The rows of a symbol as messages, into a text folder or a topic; without a symbol those of
    all symbols, in untyped messages that name it."""
    rows = read_table(spark, table_path).drop("is_train")
    if symbol is not None:
        rows = rows.where(F.col("symbol") == symbol).drop("symbol")
    body = messages.as_typed_messages(rows) if typed else messages.as_messages(rows)
    if folder:
        messages.publish_folder(body, folder)
    else:
        messages.publish_topic(body, servers, topic)


def score_stream(
    stream: DataFrame,
    root: str,
    symbol: str,
    names: Sequence[str],
    out: str,
    checkpoint: str,
    *,
    flags: bool = False,
    scaler: str | None = None,
    **when: object,
) -> StreamingQuery:
    """Score messages of one symbol with its stored models.

    Predictions, dead letters and per-batch metrics are tables of committed batches under ``out``
    (``batches.read``). ``scaler`` names
    the bounds stored by ``preprocess`` for models trained on scaled rows. Sequence models get the
    last rows scaled with their own bounds, remembered under ``out``; they answer NULL until there
    are enough.
    """
    spark = stream.sparkSession
    stored = {n: models.load(root, symbol, n) for n in names}
    plain = {n: m for n, m in stored.items() if n != "lstm"}
    net = stored.get("lstm")
    own = {c: f"_own_{c}" for c in FEATURES}

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame:
        rows = clean.default_derived(batch).withColumn("symbol", F.lit(symbol))
        bounds = None if scaler is None else spark.read.parquet(scaler)
        if net is None:
            return rows if bounds is None else features.scale_with(rows, bounds)
        if bounds is not None:
            rows = features.scale_with(rows, bounds)
        # The windows take columns of their own, so that the other models see theirs.
        kept = rows.withColumns({f"_in_{c}": F.col(c) for c in FEATURES})
        scaled = features.scale_with(kept, spark.read.parquet(scaler_path(root)))
        scaled = scaled.withColumns({own[c]: F.col(c) for c in FEATURES})
        scaled = scaled.withColumns({c: F.col(f"_in_{c}") for c in FEATURES})
        return remember(scaled.drop(*[f"_in_{c}" for c in FEATURES]), batch_id)

    length = SEQUENCE_LENGTH if net is None else window_length(net)
    remember = state.windows_of(f"{out}/remembered", length, list(own.values()))

    def predict(df: DataFrame) -> DataFrame:
        found = models.predict(df, plain) if plain else df
        if net is not None:
            found = models.predict_sequences(found, "lstm", net, length * len(FEATURES))
        return found

    write = scoring.scoring_writer(
        predict,
        names,
        f"{out}/predictions",
        dead_letters=f"{out}/dead_letters",
        metrics=f"{out}/metrics",
        flags=flags,
        keep=("symbol", "date"),
        required=("open", "high", "low", "close", "volume"),
        prepare=prepare,
    )
    return sinks.each_batch(scoring.bars_from_messages(stream), write, checkpoint, **when)
