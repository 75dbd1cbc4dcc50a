"""Column names, schemas and fixed values shared by every module."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The feature order every model and message relies on.
PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]
DERIVED_COLUMNS = ["sma5", "sma10", "ret1", "ret5"]
FEATURES = PRICE_COLUMNS + DERIVED_COLUMNS

# Spelling used in CSV files and JSON messages.
EXTERNAL_NAMES = {
    "date": "Date",
    "open": "Open",
    "high": "High",
    "low": "Low",
    "close": "Close",
    "volume": "Volume",
    "sma5": "SMA5",
    "sma10": "SMA10",
    "ret1": "Ret1",
    "ret5": "Ret5",
    "target": "Target",
}

# Text of the result tables.
MATCH_TEXT = "✔ Correct"
MISMATCH_TEXT = "❌ Incorrect"
RESULT_DATE_FORMAT = "dd-MM-yyyy"
MODEL_TITLES = {
    "lr": "Logistic Regression",
    "rf": "Random Forest",
    "gbt": "Gradient Boosted Trees",
    "xgb": "XGBoost",
    "lstm": "LSTM",
}

# Fixed value: what a scorer reports when it cannot score a row.
FAILED = -1

# A DATE column has at most this many distinct values (0001-01-01..9999-12-31), so a key whose
# (key, date) pairs are unique never holds more rows than this.
MAX_DAILY_ROWS = 3_652_059

RAW_BARS = T.StructType(
    [T.StructField("date", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS]
)

FEATURE_BARS = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES]
    + [T.StructField("target", T.IntegerType())]
)


def message_schema(with_target: bool = True) -> T.StructType:
    """JSON message: date text, nine doubles and, in the labelled variant, an int target."""
    fields = [T.StructField(EXTERNAL_NAMES["date"], T.StringType())]
    fields += [T.StructField(EXTERNAL_NAMES[c], T.DoubleType()) for c in FEATURES]
    if with_target:
        fields.append(T.StructField(EXTERNAL_NAMES["target"], T.IntegerType()))
    return T.StructType(fields)


def to_external(df: DataFrame) -> DataFrame:
    """Rename known columns to the spelling of files and messages."""
    return df.withColumnsRenamed({k: v for k, v in EXTERNAL_NAMES.items() if k in df.columns})


def to_internal(df: DataFrame) -> DataFrame:
    """Rename file and message columns to the lower-case spelling used inside the package."""
    return df.withColumnsRenamed({v: k for k, v in EXTERNAL_NAMES.items() if v in df.columns})
