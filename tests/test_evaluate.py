import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from barweave.operators import evaluate
from barweave.schema import MATCH_TEXT, MISMATCH_TEXT

# Published last-ten results: symbol, date, actual, then three models' predictions.
RESULTS = """
AAPL 15-12-2023 0 1 0 1
AAPL 18-12-2023 1 1 0 1
AAPL 19-12-2023 1 1 0 1
AAPL 20-12-2023 0 1 0 1
AAPL 21-12-2023 0 1 1 1
AAPL 22-12-2023 0 1 1 1
AAPL 26-12-2023 0 1 1 1
AAPL 27-12-2023 1 1 1 1
AAPL 28-12-2023 0 1 1 1
AAPL 29-12-2023 0 1 1 1
MSFT 14-09-2004 0 0 0 0
MSFT 13-09-2004 1 0 1 0
MSFT 10-09-2004 0 0 0 0
MSFT 09-09-2004 0 0 0 0
MSFT 08-09-2004 1 0 0 0
MSFT 07-09-2004 0 0 0 0
MSFT 03-09-2004 1 0 1 0
MSFT 02-09-2004 0 0 1 0
MSFT 01-09-2004 0 0 0 0
MSFT 31-08-2004 0 0 0 0
"""


@pytest.fixture(scope="module")
def results(spark):
    rows = []
    for line in RESULTS.split("\n"):
        if line:
            symbol, date, actual, *predicted = line.split()
            rows += [(symbol, date, m, int(actual), int(p)) for m, p in zip(("lr", "xgb", "lstm"), predicted)]
    df = spark.createDataFrame(rows, "symbol string, date string, model string, actual int, predicted int")
    return df.withColumn("date", F.to_date("date", "dd-MM-yyyy")).cache()


def test_published_results(results):
    table = evaluate.result_rows(results.where("model = 'xgb'"))
    assert table.columns == ["symbol", "date", "actual", "predicted", "match"]
    assert table.where("date = '15-12-2023'").first().match == MATCH_TEXT
    assert table.where("date = '18-12-2023'").first().match == MISMATCH_TEXT
    hits = {
        (r.symbol, r.model): round(10 * r.accuracy) for r in evaluate.binary_metrics(results).collect()
    }
    assert hits == {
        ("AAPL", "lr"): 3, ("MSFT", "lr"): 7, ("AAPL", "xgb"): 3,
        ("MSFT", "xgb"): 8, ("AAPL", "lstm"): 3, ("MSFT", "lstm"): 7,
    }


def test_weighted_equals_the_evaluator(results):
    ours = evaluate.weighted_metrics(results)
    for row in ours.collect():
        part = results.where((F.col("symbol") == row.symbol) & (F.col("model") == row.model)).select(
            F.col("actual").cast("double"), F.col("predicted").cast("double")
        )
        names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
        for column, metric in names.items():
            evaluator = MulticlassClassificationEvaluator(
                labelCol="actual", predictionCol="predicted", metricName=metric
            )
            assert row[column] == pytest.approx(evaluator.evaluate(part)), (row, metric)


def frame(spark, pairs):
    rows = [("a", "m", a, p) for a, p in pairs]
    return spark.createDataFrame(rows, "symbol string, model string, actual int, predicted int")


def test_zero_division(spark):
    nothing_predicted = evaluate.binary_metrics(frame(spark, [(1, 0), (1, 0), (0, 0)])).first()
    assert nothing_predicted[2:] == (pytest.approx(1 / 3), 0.0, 0.0, 0.0)
    nothing_there = evaluate.binary_metrics(frame(spark, [(0, 1), (0, 0)])).first()
    assert nothing_there[2:] == (0.5, 0.0, 0.0, 0.0)


def test_missing_labels_do_not_count(spark):
    row = evaluate.binary_metrics(frame(spark, [(1, 1), (None, 1), (1, None)])).first()
    assert row.accuracy == 1.0


def test_report(spark):
    report = evaluate.classification_report(frame(spark, [(1, 1), (1, 0), (0, 0), (0, 0), (2, 0)]))
    lines = {r.label: r for r in report.collect()}
    assert set(lines) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert (lines["0"].precision, lines["0"].recall, lines["0"].support) == (0.5, 1.0, 2)
    assert (lines["1"].precision, lines["1"].recall) == (1.0, 0.5)
    assert (lines["2"].precision, lines["2"].recall, lines["2"].f1) == (0.0, 0.0, 0.0)
    assert (lines["accuracy"].precision, lines["accuracy"].f1, lines["accuracy"].support) == (None, 0.6, 5)
    assert lines["macro avg"].recall == pytest.approx(0.5)
    assert lines["weighted avg"].precision == pytest.approx((2 * 0.5 + 2 * 1.0) / 5)


def test_predicted_class_that_never_occurs(spark):
    report = evaluate.classification_report(frame(spark, [(0, 0), (0, 1)]))
    line = report.where("label = '1'").first()
    assert (line.precision, line.recall, line.support) == (0.0, 0.0, 0)


def test_comparison_is_rounded(results):
    table = evaluate.comparison_table(results)
    assert table.count() == 3
    assert {r.model: r.accuracy for r in table.collect()} == {"lr": 0.5, "xgb": 0.55, "lstm": 0.5}
    assert evaluate.comparison_table(results, weighted=True).columns == table.columns


def test_last_rows(results):
    last = evaluate.last_rows(results.where("model = 'lr'"), 3)
    assert sorted(str(r.date) for r in last.collect() if r.symbol == "AAPL") == [
        "2023-12-27", "2023-12-28", "2023-12-29",
    ]
    # The limit per key sits below the exchange, so a heavy key sends few rows.
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0
