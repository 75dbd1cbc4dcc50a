"""Training and test rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.operators.ordered import OrderedRows

TRAIN_SHARE = 0.9


def chronological(
    bars: OrderedRows, share: float = TRAIN_SHARE, *, skip: int = 0, name: str = "is_train"
) -> OrderedRows:
    """Mark the first ``share`` of the rows of each key, in order, as training rows.

    ``skip`` leaves out that many leading rows before the share is taken (rows without a complete
    sequence); they get NULL.
    """
    place = F.col("_place") - skip
    kept = F.floor((F.col("_rows") - skip) * F.lit(share))
    mark = F.when(place > 0, place <= kept)
    return bars.positions("_place", "_rows").map(
        lambda df: df.withColumn(name, mark).drop("_place", "_rows")
    )


def train_rows(df: DataFrame, name: str = "is_train") -> DataFrame:
    return df.where(F.col(name)).drop(name)


def test_rows(df: DataFrame, name: str = "is_train") -> DataFrame:
    return df.where(~F.col(name)).drop(name)


def counts(df: DataFrame, key: str = "symbol", name: str = "is_train") -> DataFrame:
    """Rows per key, in total and in each part."""
    return df.groupBy(key).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(name)).alias("n_train"),
        F.count_if(~F.col(name)).alias("n_test"),
    )


def random_part(*key: Column, share: float = TRAIN_SHARE, seed: int = 42) -> Column:
    """True for about ``share`` of the rows, decided by a hash of the key.

    Unlike a sampled split it does not depend on the partitioning and needs no sort, so a retried
    task or a second run puts every row on the same side.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])
    digits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return digits < round(share * 2**32)
