"""Raw bar files to model-ready tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.operators import clean, features, split
from barweave.operators.ordered import OrderedRows
from barweave.schema import FEATURES, PRICE_COLUMNS


def prepare(bars: OrderedRows, *, fit_on: str = "train", scaled: bool = True) -> DataFrame:
    """Fill, features, label, split mark, scaling. All windows share one exchange and one sort.

    ``fit_on='train'`` takes the scaling bounds from training rows, ``'all'`` from every row.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on is 'train' or 'all'")
    rows = clean.fill_gaps(bars, PRICE_COLUMNS)
    rows = split.chronological(features.add_features(rows))
    if scaled:
        fit_when = F.col("is_train") if fit_on == "train" else None
        rows = features.scale(rows, FEATURES, fit_when)
    return clean.drop_incomplete(rows.rows(), FEATURES)


def prepare_raw(raw: DataFrame, **options: object) -> DataFrame:
    """The same for bars as read from files: text dates, NaN, any number of rows per symbol.

    Rows of one day keep a fixed order through their values, so a repeated date gives the same
    result on every run.
    """
    dated = clean.normalise_nan(clean.coerce_dates(raw))
    bars = OrderedRows.arrange(dated, ("symbol",), ("date", *PRICE_COLUMNS))
    return prepare(bars, **options)
