"""The command-line steps one after the other on two small files."""

import math
import sys

import pytest
from pyspark.sql import functions as F

from barweave import __main__ as command
from barweave.operators import features, models, sequences
from barweave.operators.ordered import OrderedRows
from barweave.plans import keyed_models, programs
from barweave.sources import messages
from barweave.streaming import batches, sinks


def write_file(path, n, shift):
    lines = ["Volume,Date,Close,Open,High,Low,Extra"]
    for i in range(n):
        close = round(100 + 10 * math.sin(i / 3 + shift), 2)
        date = f"2023-{1 + i // 28:02d}-{1 + i % 28:02d}"
        if i == 7:
            date = "unknown"
        lines.append(f"{1000 + i},{date},{'' if i % 11 == 3 else close},{close},{close + 1},{close - 1},x")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("programs")
    paths = {s: write_file(base / f"{s}.csv", 120, k) for k, s in enumerate(("AA", "BB"))}
    programs.preprocess(spark, paths, f"{base}/table", scaler=f"{base}/scaler")
    return base


def test_preprocess(spark, work):
    table = programs.read_table(spark, f"{work}/table")
    assert table.count() == 2 * 119
    assert table.where("close is null or sma10 is null").isEmpty()
    assert table.where("is_train").count() == 2 * 107
    scaler = spark.read.parquet(f"{work}/scaler")
    assert scaler.count() == 2 * 9
    assert list(programs.symbols_of(table)) == ["AA", "BB"]


def test_train_report_evaluate_and_stream(spark, work, monkeypatch, capsys):
    def run(*words):
        monkeypatch.setattr(sys, "argv", ["barweave", *words])
        command.main()
        return capsys.readouterr().out

    table, stored = f"{work}/table", f"{work}/models"
    common = ["--table", table, "--models", stored]
    options = ["--set", "lr.max_iter=40", "--set", "lstm.length=4", "--set", "lstm.units=6"]
    out = run("train", *common, "--names", "lr,lstm", "--reports", f"{work}/reports", *options)
    assert models.load(stored, "AA", "lr").stages[-1].getMaxIter() == 40
    assert models.load(stored, "BB", "lstm").stages[-1].getLayers() == [36, 6, 2]
    assert "Logistic Regression" in out and "LSTM" in out
    last = spark.read.csv(f"{work}/reports/last_rows", header=True)
    assert last.groupBy("symbol", "model").count().where("count <> 10").isEmpty()
    assert last.columns == ["symbol", "model", "date", "actual", "predicted", "match"]
    classes = spark.read.csv(f"{work}/reports/classes", header=True)
    assert classes.where("label = 'weighted avg'").count() == 4

    assert "Logistic Regression" in run("evaluate", *common, "--symbol", "AA", "--names", "lr")
    out = run("evaluate", *common, "--symbol", "AA", "--names", "lr,lstm")
    assert "Logistic Regression" in out and "LSTM" in out

    run("publish", "--table", table, "--symbol", "AA", "--folder", f"{work}/topic")
    run(
        "score", "--models", stored, "--symbol", "AA", "--names", "lr", "--folder", f"{work}/topic",
        "--out", f"{work}/live", "--checkpoint", f"{work}/progress", "--drain", "--flags",
    )
    rows = batches.read(spark, f"{work}/live/predictions")
    assert rows.count() == 119
    assert rows.where("lr_correct <> (lr_pred = target)").isEmpty()
    assert rows.where(~F.col("lr_pred").isin(0.0, 1.0)).isEmpty()
    assert batches.read(spark, f"{work}/live/metrics").first().n_rows == 119


def test_stream_of_row_and_sequence_models(spark, work, tmp_path):
    """Both kinds on one stream in two runs; the net answers what it answers for the table."""
    table, stored = f"{work}/table", f"{tmp_path}/models"
    programs.train(
        spark, table, stored, ["lr", "lstm"], ["BB"], {"lstm": {"length": 4}, "lr": {"max_iter": 20}}
    )
    own = programs.read_table(spark, table).where("symbol = 'BB'")
    for early in (True, False):
        half = own.where((F.col("date") < "2023-03-01") == F.lit(early))
        half.write.mode("overwrite").partitionBy("symbol").parquet(f"{tmp_path}/half{early}")
        programs.publish(spark, f"{tmp_path}/half{early}", "BB", folder=f"{tmp_path}/topic")
        stream = messages.folder_stream(spark, f"{tmp_path}/topic")
        query = programs.score_stream(
            stream, stored, "BB", ["lr", "lstm"], f"{tmp_path}/live", f"{tmp_path}/p",
            **sinks.trigger(drain=True),
        )
        sinks.drained(query)
    live = batches.read(spark, f"{tmp_path}/live/predictions")
    rows = {str(r.date): r for r in live.collect()}
    assert len(rows) == own.count() and {r.symbol for r in rows.values()} == {"BB"}
    known = sorted(d for d, r in rows.items() if r.lstm_pred is not None)
    assert known == sorted(rows)[3:]
    scaler = spark.read.parquet(programs.scaler_path(stored))
    scaled = features.scale_with(own, scaler)
    bars = OrderedRows.arrange(scaled, ("symbol",), ("date",))
    windows = sequences.add_sequences(bars, 4, include_current=True).rows()
    net = models.load(stored, "BB", "lstm")
    batch = models.predict_sequences(windows, "lstm", net, 36).collect()
    assert all(rows[str(r.date)].lstm_pred == r.lstm_pred for r in batch)


def test_all_symbols_together(spark, work, monkeypatch):
    """Models of both symbols from the same jobs, served by one stream to messages of both and of a
    symbol that has none."""

    def run(*words):
        monkeypatch.setattr(sys, "argv", ["barweave", *words])
        command.main()

    table, stored, names = f"{work}/table", f"{work}/together", ["--names", "lr,rf"]
    options = ["--set", "rf.trees=3", "--set", "rf.depth=2"]
    run("train", "--together", "--table", table, "--models", stored, "--reports", f"{work}/all", *names, *options)
    run("publish", "--table", table, "--folder", f"{work}/all_topic")
    other = programs.read_table(spark, table).where("symbol = 'AA'").limit(2).withColumn("symbol", F.lit("CC"))
    messages.publish_folder(messages.as_messages(other.drop("is_train")), f"{work}/all_topic")
    run(
        "score", "--models", stored, *names, "--folder", f"{work}/all_topic", "--drain", "--flags",
        "--out", f"{work}/all_live", "--checkpoint", f"{work}/all_progress",
    )
    live = batches.read(spark, f"{work}/all_live/predictions")
    assert {r.symbol: r["count"] for r in live.groupBy("symbol").count().collect()} == {
        "AA": 119, "BB": 119, "CC": 2,
    }
    assert live.where("symbol = 'CC' and (lr_pred is not null or rf_pred is not null)").isEmpty()
    known = programs.read_table(spark, table)
    fitted = {n: keyed_models.load(spark, stored, n) for n in ("lr", "rf")}
    batch = keyed_models.predict(known, fitted).select("symbol", F.col("date").cast("string"), "lr_pred", "rf_pred")
    served = live.where("symbol <> 'CC'").select("symbol", "date", "lr_pred", "rf_pred")
    assert batch.exceptAll(served).isEmpty() and served.count() == batch.count()


def test_models_that_prepare_differently_do_not_combine(spark, work):
    table = programs.read_table(spark, f"{work}/table")
    rows = models.training_rows(table)
    one = models.fit_all(rows, {"lr": models.logistic(max_iter=2)})
    two = models.fit_all(
        rows, {"b": models.logistic("b", max_iter=2)}, stages=models.scaled_stages
    )
    with pytest.raises(ValueError, match="prepare"):
        models.predict(table, one | two)


def test_unknown_model(spark, work):
    with pytest.raises(ValueError, match="unknown models"):
        programs.train(spark, f"{work}/table", f"{work}/models", ["svm"])


def test_any_number_of_symbols(spark):
    many = spark.range(1001).select(F.col("id").cast("string").alias("symbol"))
    assert len(list(programs.symbols_of(many))) == 1001


def test_bounds_come_from_rows_before_scaling(spark, work, tmp_path):
    paths = {"AA": f"{work}/AA.csv"}
    programs.preprocess(spark, paths, f"{tmp_path}/t", scaler=f"{tmp_path}/s", scaled=True)
    bounds = spark.read.parquet(f"{tmp_path}/s").where("column = 'volume'").first()
    assert (bounds["min"], bounds["max"]) == (1000.0, 1107.0)
    rows = programs.read_table(spark, f"{tmp_path}/t").where("is_train")
    assert rows.agg(F.min("volume"), F.max("volume")).first() == (0.0, 1.0)


def test_repeated_dates_in_any_order(spark, work, tmp_path):
    lines = (work / "AA.csv").read_text().splitlines()
    twice = lines[:1] + sorted(lines[1:] + [x.replace("100", "101") for x in lines[40:60]])
    found = []
    for n, body in enumerate((twice[1:], twice[:0:-1])):
        (tmp_path / f"{n}.csv").write_text("\n".join([twice[0], *body]) + "\n")
        programs.preprocess(spark, {"AA": f"{tmp_path}/{n}.csv"}, f"{tmp_path}/t{n}")
        table = programs.read_table(spark, f"{tmp_path}/t{n}")
        windows = programs.sequence_table(table, programs.sequence_scaler(table, 3), 3)
        rows = [(r.date, r.target, tuple(r.features.toArray())) for r in windows.collect()]
        found.append(sorted(rows, key=repr))
    assert found[0] == found[1]
