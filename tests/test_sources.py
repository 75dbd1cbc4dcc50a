import json
import math
import os

import pytest
from pyspark.sql import functions as F

from barweave import storage
from barweave.plans import queries
from barweave.schema import RAW_BARS, message_schema, to_external, to_internal
from barweave.sources import bars, files, messages
from tests.helpers import price_rows, same_rows


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [("2024-01-01", 1.0, 2.5, 0.5, None, 100.0), ("bad", 1.1, 2.0, 0.7, 1.5, 7.0)], RAW_BARS
    )


@pytest.mark.parametrize("suffix", ["csv", "json", "parquet"])
def test_reader_follows_the_suffix(spark, raw, tmp_path, suffix):
    path = str(tmp_path / f"bars.{suffix}")
    if suffix == "csv":
        files.write_csv(raw, path)
        files.write_csv(raw, path)  # replaces
    else:
        raw.write.format(suffix).save(path)
    assert same_rows(raw, files.read_bars(spark, path))


def test_types_can_be_inferred(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text("Date,Close,Volume\n2024-01-02,1.5,3\n")
    df = files.read_bars(spark, str(path), None)
    assert [t for _, t in df.dtypes] == ["date", "double", "int"]
    assert to_internal(df).columns == ["date", "close", "volume"]
    assert to_external(to_internal(df)).columns == df.columns


@pytest.mark.parametrize("path", ["bars.txt", "bars", "csv", "dir.csv/bars"])
def test_unknown_suffix(spark, path):
    with pytest.raises(ValueError, match="Unsupported file format"):
        files.read_bars(spark, path)


def test_workbooks_are_no_format(spark):
    with pytest.raises(ValueError, match="Unsupported"):
        files.read_bars(spark, "bars.xlsx")


def test_json_and_parquet_of_other_spelling_and_types(spark, tmp_path):
    """Published spelling in JSON, dates and whole numbers in parquet."""
    (tmp_path / "a.json").write_text(
        '{"Date": "2024-01-02", "Open": 1, "HIGH": 2.5, "low": "0.5", "Close": "x", "Volume": 7}\n'
    )
    row = tuple(files.read_bars(spark, str(tmp_path / "a.json")).first())
    assert row == ("2024-01-02", 1.0, 2.5, 0.5, None, 7.0)
    typed = spark.sql(
        "SELECT DATE'2024-01-02' AS Date, 1 AS Open, CAST(2.5 AS DECIMAL(9,2)) AS High, "
        "CAST(0.5 AS FLOAT) AS Low, 1.5D AS Close, CAST(7 AS BIGINT) AS Volume, 'x' AS Other"
    )
    typed.write.parquet(str(tmp_path / "b.parquet"))
    row = tuple(files.read_bars(spark, str(tmp_path / "b.parquet")).first())
    assert row == ("2024-01-02", 1.0, 2.5, 0.5, 1.5, 7.0)


def test_any_price_ranks_in_an_order_line(spark):
    rows = [("s", "d", 1, p, 1.0) for p in (3e7, 2e7, 5e7, 4e7)] + [("s", "d", 2, 1.0, 1.0)]
    trades = spark.createDataFrame(rows, "symbol string, date string, order int, price double, amount double")
    trades = trades.withColumn("order", F.col("order").cast("decimal(38,0)"))
    bar = bars.line_bars(trades).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (2e7, 5e7, 1.0, 1.0, 5.0)
    bar = bars.line_bars(trades.where("order = 1")).first()
    assert (bar.open, bar.close) == (2e7, 5e7)


def test_symbols_side_by_side(spark, raw, tmp_path):
    paths = {}
    for s in ("x", "y"):
        paths[s] = str(tmp_path / f"{s}.parquet")
        raw.write.parquet(paths[s])
    df = files.read_symbols(spark, paths)
    assert {r.symbol: r["count"] for r in df.groupBy("symbol").count().collect()} == {"x": 2, "y": 2}
    with pytest.raises(ValueError):
        files.union_symbols({})


def test_kafka_options():
    options = messages.kafka_options("h:1", "prices")
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "prices", "startingOffsets": "latest",
    }
    options = messages.kafka_options("h:1", "t", starting="earliest", group_id="g", max_per_trigger=9)
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.group.id"] == "g"
    assert options["maxOffsetsPerTrigger"] == "9"
    with pytest.raises(ValueError):
        messages.kafka_options("h:1", "t", starting="yesterday")


def test_messages_spell_out_nulls(spark):
    df = price_rows(spark, [None]).drop("symbol").withColumn("target", F.lit(1))
    assert json.loads(messages.as_messages(df).first().value) == {
        "Date": "2024-01-01", "Open": None, "High": None, "Low": None, "Close": None,
        "Volume": 1.0, "Target": 1,
    }


def test_typed_messages(spark):
    df = price_rows(spark, [2.0]).withColumn("sma5", F.lit(None).cast("double"))
    message = json.loads(messages.as_typed_messages(df).first().value)
    assert list(message) == ["Date", "Open", "High", "Low", "Close", "Volume", "SMA5", "SMA10", "Ret1", "Ret5"]
    assert message["SMA5"] is None  # present but unknown
    assert message["SMA10"] == 0.0  # absent
    assert message["Close"] == 2.0


def parsed(spark, text, schema=None):
    return to_internal(messages.parse(spark.createDataFrame([(text,)], "value string"), schema)).first()


def test_parse_edge_cases(spark):
    good = '{"Date": "2024-01-01", "Close": 1.5, "Target": 1, "Extra": [1]}'
    row = parsed(spark, good)
    assert (row.date, row.close, row.target, row.open) == ("2024-01-01", 1.5, 1, None)
    assert "extra" not in row.asDict()
    assert set(parsed(spark, "not json").asDict().values()) == {None}
    assert set(parsed(spark, good[:20]).asDict().values()) == {None}
    assert set(parsed(spark, None).asDict().values()) == {None}
    assert math.isnan(parsed(spark, '{"Close": NaN}').close)
    assert parsed(spark, '{"Close": 2, "Target": 1.0}').target is None
    assert "target" not in parsed(spark, good, message_schema(with_target=False)).asDict()


def test_parse_bytes_and_keep_columns(spark):
    df = spark.createDataFrame([(7, bytearray(b'{"Close": 3}'))], "offset long, value binary")
    row = messages.parse(df).first()
    assert (row.offset, row.Close) == (7, 3.0)


def test_messages_are_parsed_once(spark):
    df = messages.parse(spark.createDataFrame([("{}",)], "value string"))
    narrow = df.where("Open > 0 and Close > 0 and High > 0")
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_publish_and_snapshot(spark, tmp_path):
    path = str(tmp_path / "topic")
    df = price_rows(spark, [1.0, 2.0]).drop("symbol")
    messages.publish_folder(messages.as_messages(df), path)
    messages.publish_folder(messages.as_messages(df), path)
    assert messages.folder_snapshot(spark, path).count() == 4
    messages.publish_folder(messages.as_messages(df), path, mode="overwrite")
    assert messages.folder_snapshot(spark, path).count() == 2


def test_packed_messages_and_bars(spark, tmp_path):
    df = price_rows(spark, [1.0, 2.0])
    topic = queries.publish(messages.as_messages(df), "topic")
    queries.publish_more(messages.as_messages(df), topic)
    names = [n for n in os.listdir(topic) if n.startswith("part-")]
    assert names and all(n.endswith(".gz") for n in names)
    assert same_rows(messages.folder_snapshot(spark, topic), messages.as_messages(df.unionAll(df)))
    path = str(tmp_path / "bars.csv")
    files.write_csv(df.select(RAW_BARS.names), path, compression="gzip")
    assert any(n.endswith(".csv.gz") for n in os.listdir(path))
    assert files.read_bars(spark, path).count() == 2
    kept = storage.hand_over(df, "packed", "zstd")
    assert same_rows(kept, df) and all(".zstd." in f for f in kept.inputFiles())


def test_prediction_messages(spark):
    df = price_rows(spark, [1.0]).withColumns({"a": F.lit(1), "b": F.lit(None).cast("int")})
    value = messages.prediction_messages(df, {"LR": "a", "LSTM": "b"}).first().value
    assert json.loads(value) == {"Date": "2024-01-01", "LR_Prediction": 1, "LSTM_Prediction": None}


def test_shared_folder(spark):
    folder = storage.shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")
    table = storage.hand_over(spark.range(3).toDF("n"))
    assert table.count() == 3


def test_released_tables_are_gone(spark):
    kept = storage.hand_over(spark.range(3))
    assert kept.count() == 3
    storage.release(spark)
    with pytest.raises(Exception, match="(?i)not.*exist|PATH_NOT_FOUND|FAILED_READ"):
        storage.hand_over(spark.range(3)).unionByName(kept).collect()
