"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave import storage
from barweave.functions import columns as C
from barweave.operators import clean, evaluate, features, models, score, sequences, split
from barweave.operators.ordered import OrderedRows
from barweave.plans.preprocess import prepare
from barweave.schema import (
    MODEL_TITLES,
    PRICE_COLUMNS,
    message_schema,
    to_external,
    to_internal,
)
from barweave.sources import bars as B
from barweave.sources import files, messages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Sums depend on the order of addition in the last digits, so averages are rounded before a
# comparison. Everything else is compared to the last bit.
AVERAGES = ("sma5", "sma10")

# Rows of a slab in the queries over event types, whose few keys hold the whole table.
TYPE_SLAB_ROWS = 500


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- shared inputs -----------------------------------------------------------------------------


def supplier_rows(spark: SparkSession, sf: str) -> OrderedRows:
    return B.ordered_daily(B.supplier_bars(spark, sf))


def feature_rows(spark: SparkSession, sf: str) -> OrderedRows:
    return features.add_features(supplier_rows(spark, sf))


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return feature_rows(spark, sf).rows()


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


def rounded_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feature_table(spark, sf), *AVERAGES)


def gapped(df: DataFrame) -> DataFrame:
    """Holes by rule: the close where the day is divisible by 5, the averages where by 3."""
    day = F.dayofmonth("date")
    return df.withColumns(
        {
            "close": F.when(day % 5 != 0, F.col("close")),
            "sma5": F.when(day % 3 != 0, F.col("sma5")),
            "ret5": F.when(day % 3 != 0, F.col("ret5")),
        }
    )


def rule_models() -> dict[str, score.Predictor]:
    """Predictors without training, so that everything around a model has an exact answer."""
    return {
        "lr": score.rule(F.col("close") > F.col("sma5")),
        "rf": score.rule(F.col("ret1") > 0),
        "gbt": score.rule(F.col("ret5") > 0),
    }


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Long predictions (symbol, date, actual, model, predicted) of the three rules."""
    wide = score.chain(rounded_features(spark, sf), rule_models())
    return score.long_predictions(wide, list(rule_models()))


def publish(df: DataFrame, label: str) -> str:
    """Write rows as JSON messages into a new folder."""
    path = storage.new_path(df.sparkSession, label)
    publish_more(df, path)
    return path


def publish_more(df: DataFrame, topic: str) -> None:
    """Add messages to a folder; they repeat their field names, so packed they take far less disk."""
    messages.publish_folder(df, topic, compression="gzip")


def keyed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows as messages beside their key; by rule some are cut in half, hence broken."""
    whole = messages.as_messages(
        rounded_features(spark, sf).withColumn("day", F.col("date")), keep=("symbol", "day")
    )
    broken = F.pmod(F.col("symbol") + F.dayofyear("day"), F.lit(17)) == 0
    half = F.expr("substring(value, 1, cast(length(value) / 2 as int))")
    return whole.withColumn("value", F.when(broken, half).otherwise(F.col("value")))


# -- bars and features -------------------------------------------------------------------------


@query
def event_bars(spark, sf):
    return B.event_bars(spark, sf).withColumn("volume", F.col("volume").cast("long"))


@query
def supplier_bars(spark, sf):
    return B.supplier_bars(spark, sf)


@query
def bar_features(spark, sf):
    return rounded_features(spark, sf)


@query
def event_features(spark, sf):
    bars = B.ordered_daily(B.event_bars(spark, sf))
    return rounded(features.add_features(bars).rows(), *AVERAGES)


@query
def tick_features(spark, sf):
    rows = features.add_features(B.ordered_ticks(B.ticks(spark, sf)), price="price").rows()
    return rounded(rows, *AVERAGES).drop("ts")


def _event_type_ticks(spark: SparkSession, sf: str) -> OrderedRows:
    """Events as one price series per event type: a handful of keys hold everything.

    The short slab makes these keys count as heavy at any scale.
    """
    rows = B.table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
    )
    return OrderedRows.arrange(rows, ("symbol",), ("ts", "seq"), slab_rows=TYPE_SLAB_ROWS)


@query
def hot_key_features(spark, sf):
    rows = features.add_features(_event_type_ticks(spark, sf), price="price").rows()
    return rounded(rows, *AVERAGES).drop("ts")


@query
def hot_key_fill(spark, sf):
    known = F.when(F.col("seq") % 7 >= 3, F.col("price"))
    rows = _event_type_ticks(spark, sf).map(lambda df: df.withColumn("price", known))
    return clean.fill_gaps(rows, ["price"]).rows().drop("ts")


@query
def hot_key_split(spark, sf):
    rows = split.chronological(_event_type_ticks(spark, sf)).rows()
    return rows.select("symbol", "seq", "is_train")


@query
def hot_key_scaled(spark, sf):
    return features.scale(_event_type_ticks(spark, sf), ["price"]).rows().drop("ts")


@query
def hot_key_sequences(spark, sf):
    rows = sequences.add_sequences(_event_type_ticks(spark, sf), 5, ["price"]).rows()
    text = sequences.as_text(F.col("sequence"))
    return sequences.complete_sequences(rows).select("symbol", "seq", text.alias("sequence"))


@query
def sma(spark, sf):
    rows = features.add_averages(supplier_rows(spark, sf)).rows()
    return rounded(rows.select("symbol", "date", "sma5", "sma10"), "sma5", "sma10")


@query
def returns(spark, sf):
    rows = features.add_returns(supplier_rows(spark, sf)).rows()
    return rows.select("symbol", "date", "ret1", "ret5")


@query
def target(spark, sf):
    return features.add_target(supplier_rows(spark, sf)).rows().select("symbol", "date", "target")


@query
def target_open_tail(spark, sf):
    rows = features.add_target(supplier_rows(spark, sf), tail="null").rows()
    return rows.where(F.col("target").isNotNull()).select("symbol", "date", "target")


@query
def scaler_params(spark, sf):
    return features.scaler_params(rounded_features(spark, sf))


@query
def minmax_scaled(spark, sf):
    rows = features.scale(feature_rows(spark, sf)).rows()
    return rounded(rows.drop("target"), *AVERAGES)


@query
def minmax_stored(spark, sf):
    """Fit, store the parameters as a table, read them back and apply them."""
    table = storage.hand_over(feature_table(spark, sf), "features")
    params = storage.hand_over(features.scaler_params(table), "scaler")
    return rounded(features.scale_with(table, params).drop("target"), *AVERAGES)


@query
def prepared_table(spark, sf):
    """Fill, features, label, split and scaling fitted on the training rows, in one go."""
    holes = B.supplier_bars(spark, sf).withColumn(
        "close", F.when(F.dayofmonth("date") % 5 != 0, F.col("close"))
    )
    return rounded(prepare(B.ordered_daily(holes)), *AVERAGES)


# -- cleaning ----------------------------------------------------------------------------------


def _gapped_ticks(spark, sf):
    known = F.when(F.col("seq") % 7 >= 3, F.col("price"))
    return B.ordered_ticks(B.ticks(spark, sf).withColumn("price", known))


@query
def ffill(spark, sf):
    rows = clean.fill_gaps(_gapped_ticks(spark, sf), ["price"], leading=False).rows()
    return rows.drop("ts")


@query
def ffill_bfill(spark, sf):
    return clean.fill_gaps(_gapped_ticks(spark, sf), ["price"]).rows().drop("ts")


@query
def date_coerce(spark, sf):
    day = F.to_date("ts")
    text = (
        F.when(F.col("event_id") % 13 == 0, F.lit("not a date"))
        .when(F.col("event_id") % 11 == 0, F.date_format(day, "dd-MM-yyyy"))
        .otherwise(day.cast("string"))
    )
    dirty = B.table(spark, sf, "events").select("event_id", text.alias("date"))
    return clean.coerce_dates(dirty)


@query
def drop_any_null(spark, sf):
    day = F.dayofmonth("date")
    holes = gapped(rounded_features(spark, sf)).withColumn(
        "volume", F.when(day % 7 == 0, F.lit("NaN").cast("double")).otherwise(F.col("volume"))
    )
    return clean.drop_incomplete(holes)


@query
def nan_to_null(spark, sf):
    odd = F.when(F.col("seq") % 7 == 0, F.lit("NaN").cast("double")).otherwise(F.col("price"))
    rows = B.ticks(spark, sf).select("seq", odd.alias("price"))
    return clean.normalise_nan(rows, ["price"])


@query
def null_defaults(spark, sf):
    return clean.default_derived(gapped(rounded_features(spark, sf)))


@query
def drop_columns(spark, sf):
    return clean.drop_label_and_date(rounded_features(spark, sf))


@query
def feature_vector(spark, sf):
    rows = models.feature_array(rounded_features(spark, sf))
    text = sequences.as_text(F.array("features"))
    return rows.select("symbol", "date", text.alias("features"))


# -- split and sequences -----------------------------------------------------------------------


@query
def chrono_split(spark, sf):
    return split.chronological(supplier_rows(spark, sf)).rows().select("symbol", "date", "is_train")


@query
def chrono_split_ticks(spark, sf):
    rows = split.chronological(B.ordered_ticks(B.ticks(spark, sf))).rows()
    return rows.select("symbol", "seq", "is_train")


@query
def split_counts(spark, sf):
    return split.counts(split.chronological(supplier_rows(spark, sf)).rows())


@query
def random_split(spark, sf):
    rows = rounded_features(spark, sf)
    part = split.random_part(F.col("symbol"), F.col("date"))
    return rows.select("symbol", "date", part.alias("is_train"))


def _sequence_text(rows: OrderedRows) -> DataFrame:
    table = sequences.complete_sequences(rows.rows())
    return table.select("symbol", "date", "target", sequences.as_text(F.col("sequence")).alias("sequence"))


@query
def sequences_5(spark, sf):
    return _sequence_text(sequences.add_sequences(feature_rows(spark, sf), 5))


@query
def sequences_10(spark, sf):
    return _sequence_text(sequences.add_sequences(feature_rows(spark, sf), 10))


@query
def sequence_split(spark, sf):
    rows = split.chronological(feature_rows(spark, sf), skip=5).rows()
    return rows.where(F.col("is_train").isNotNull()).select("symbol", "date", "target", "is_train")


# -- predictions and their quality -------------------------------------------------------------


@query
def rule_scores(spark, sf):
    return rule_predictions(spark, sf)


@query
def multi_model_join(spark, sf):
    table = storage.hand_over(rounded_features(spark, sf), "features")
    return score.join_predictions(table, rule_models())


@query
def multi_model_rules(spark, sf):
    wide = score.chain(rounded_features(spark, sf), rule_models())
    return wide.select("symbol", "date", "target", "lr_pred", "rf_pred", "gbt_pred")


@query
def correct_flags(spark, sf):
    wide = score.chain(rounded_features(spark, sf), rule_models())
    flagged = score.with_flags(wide, list(rule_models()))
    return flagged.select("symbol", "date", "lr_correct", "rf_correct", "gbt_correct")


@query
def match_label(spark, sf):
    text = C.match_text(F.col("actual"), F.col("predicted"))
    return rule_predictions(spark, sf).withColumn("match", text)


@query
def metrics_binary(spark, sf):
    return evaluate.binary_metrics(rule_predictions(spark, sf))


@query
def metrics_weighted(spark, sf):
    return evaluate.weighted_metrics(rule_predictions(spark, sf))


@query
def classification_report(spark, sf):
    return evaluate.classification_report(rule_predictions(spark, sf))


@query
def model_comparison(spark, sf):
    table = evaluate.comparison_table(rule_predictions(spark, sf))
    return table.replace(MODEL_TITLES, subset=["model"])


@query
def model_comparison_weighted(spark, sf):
    table = evaluate.comparison_table(rule_predictions(spark, sf), weighted=True)
    return table.replace(MODEL_TITLES, subset=["model"])


@query
def last_n_results(spark, sf):
    """The ten latest test rows per symbol as a result table."""
    rows = split.chronological(feature_rows(spark, sf)).rows()
    scored = score.chain(rounded(split.test_rows(rows), "sma5"), {"lr": rule_models()["lr"]})
    last = evaluate.last_rows(scored.select("symbol", "date", "target", "lr_pred"))
    named = last.withColumnsRenamed({"target": "actual", "lr_pred": "predicted"})
    return evaluate.result_rows(named)


@query
def threshold(spark, sf):
    p = F.col("price") / (F.col("price") + 10)
    return B.ticks(spark, sf).select("seq", C.over_threshold(p).alias("label"))


@query
def latency_ms(spark, sf):
    start = F.col("ts").cast("timestamp")
    end = start + F.make_dt_interval(secs=F.col("seq") * F.lit(0.037))
    return B.ticks(spark, sf).select("seq", C.latency_ms(start, end).alias("latency_ms"))


@query
def sentinel(spark, sf):
    holes = gapped(rounded_features(spark, sf))
    scored = holes.transform(score.score_with(rule_models()["rf"]))
    return scored.select("symbol", "date", "prediction")


@query
def prediction_json(spark, sf):
    """Prediction rows written as JSON and parsed again; the sequence model has said nothing."""
    wide = score.chain(rounded_features(spark, sf), rule_models())
    wide = wide.withColumn("lstm_pred", F.lit(None).cast("int"))
    names = {"LR": "lr_pred", "RF": "rf_pred", "XGB": "gbt_pred", "LSTM": "lstm_pred"}
    text = messages.prediction_messages(wide, names).select("symbol", "value")
    fields = [T.StructField("Date", T.StringType())]
    fields += [T.StructField(f"{n}_Prediction", T.IntegerType()) for n in names]
    parsed = messages.parse(text, T.StructType(fields))
    return parsed.withColumnsRenamed({c: c.lower() for c in parsed.columns})


# -- files and messages ------------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf):
    path = storage.new_path(spark, "features") + ".csv"
    table = rounded_features(spark, sf)
    files.write_csv(table, path)
    return files.read_bars(spark, path, table.schema)


@query
def read_dispatch(spark, sf):
    """The same bars through each file format, chosen by suffix."""
    bars = storage.hand_over(B.supplier_bars(spark, sf), "bars", "zstd")
    paths = {s: storage.new_path(spark, "bars") + f".{s}" for s in ("csv", "json", "parquet")}
    files.write_csv(bars, paths["csv"], compression="gzip")
    bars.write.json(paths["json"], compression="gzip")
    bars.write.parquet(paths["parquet"], compression="zstd")
    read = {s: files.read_bars(spark, p, bars.schema) for s, p in paths.items()}
    tagged = {s: df.withColumnRenamed("symbol", "supplier") for s, df in read.items()}
    return files.union_symbols(tagged).withColumnRenamed("symbol", "format")


@query
def union_symbols(spark, sf):
    """One data set for each event type, all under their own names."""
    events = B.table(spark, sf, "events").select(
        F.to_date("ts").alias("date"), F.col("value").alias("price"), "event_type"
    )
    total = {
        name: events.where(F.col("event_type") == name)
        .groupBy("date")
        .agg(F.max("price").alias("close"), F.count("*").alias("volume"))
        for name in B.event_types(spark, sf)
    }
    return files.union_symbols(total)


@query
def publish_json(spark, sf):
    path = publish(messages.as_messages(rounded_features(spark, sf).drop("symbol")), "topic")
    return to_internal(messages.parse(messages.folder_snapshot(spark, path)))


@query
def publish_typed(spark, sf):
    """Bars without derived columns; the message carries zeros for those."""
    path = publish(messages.as_typed_messages(B.supplier_bars(spark, sf)), "topic")
    snapshot = messages.folder_snapshot(spark, path)
    return to_internal(messages.parse(snapshot, message_schema(with_target=False)))


@query
def topic_snapshot(spark, sf):
    """All messages read back from the start, counted and summed per date."""
    path = publish(messages.as_messages(rounded_features(spark, sf).drop("symbol")), "topic")
    rows = to_internal(messages.parse(messages.folder_snapshot(spark, path)))
    return rows.groupBy("date").agg(
        F.count("*").alias("n_messages"),
        F.round(F.sum("volume"), 2).alias("volume"),
        F.sum("target").alias("n_up"),
    )


@query
def parse_messages(spark, sf):
    """Broken messages give rows of NULLs."""
    return to_internal(messages.parse(keyed_messages(spark, sf)))


@query
def dead_letter(spark, sf):
    parsed = to_internal(messages.parse(keyed_messages(spark, sf)))
    return clean.routed(parsed).select("symbol", "day", "route")
