"""Integer names for the distinct values of some columns, in sorted order and without collisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.storage import hand_over

#: A value on more than this part of all rows is spread over several tasks. There are at most so
#: many such values, whatever the data, which bounds what is broadcast.
HEAVY_PART = 4096
LEAST_HEAVY = 1000


def name_pairs(rows: DataFrame, columns: Sequence[str], name: str, least: int = 1) -> DataFrame:
    """Add ``name``: the place of the row's values among all distinct ones, sorted.

    For narrow columns (numbers, short keys). Distinct values are combined before they are
    shuffled, sorted by range and numbered by place; a written table fixes the numbers. The join
    back may be split by Spark wherever one value has many rows. Nulls are values. Rows of values
    that occur less than ``least`` times are left out.
    """
    values = rows.groupBy(*columns).agg(F.count("*").alias("_rows")).where(F.col("_rows") >= least)
    ordered = values.repartitionByRange(*columns).sortWithinPartitions(*columns)
    names = hand_over(
        ordered.select(*columns, "_rows", F.monotonically_increasing_id().alias(name)), "names"
    )
    keyed = names.withColumnsRenamed({c: f"_n_{c}" for c in columns})
    match = [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in columns]
    return rows.join(keyed, match).drop(*[f"_n_{c}" for c in columns])


def name_blocks(
    rows: DataFrame, block: str, tie: Sequence[str], name: str, total: int
) -> DataFrame:
    """Replace the wide column ``block`` by an integer ``name``; equal blocks, equal names.

    Every block is shuffled once, to the task that sorts the blocks of its hash; the first row of
    a run of equal blocks names the run. A block on very many rows is first spread over several
    salts, whose first rows alone meet again. ``total`` is the number of rows. The result is a
    written table.
    """
    hashed = rows.withColumn("_h", F.xxhash64(block))
    sizes = (
        hashed.groupBy("_h")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > LEAST_HEAVY)
    )
    sizes = hand_over(sizes, "sizes")
    least = max(LEAST_HEAVY, total // HEAVY_PART)
    heavy = sizes.where(F.col("_n") > least).select(
        "_h", F.ceil(F.col("_n") / F.lit(least)).cast("int").alias("_salts")
    )
    if heavy.isEmpty():
        salted = hashed.withColumns({"_salt": F.lit(0), "_spread": F.lit(False)})
    else:
        salted = hashed.join(F.broadcast(heavy), "_h", "left").withColumns(
            {
                "_spread": F.col("_salts").isNotNull(),
                "_salt": F.coalesce(F.pmod(F.xxhash64(*tie), F.col("_salts")), F.lit(0)),
            }
        )
    run = Window.partitionBy("_h", "_salt", block)
    named = (
        salted.repartition("_h", "_salt")
        .sortWithinPartitions("_h", "_salt", block, *tie)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_run", F.min("_at").over(run))
        .withColumn("_head", F.when(F.col("_spread") & (F.col("_at") == F.col("_run")), F.col(block)))
    )
    others = [c for c in rows.columns if c != block]
    named = hand_over(named.select(*others, F.col("_run").alias(name), "_spread", "_head"), "blocks")
    if heavy.isEmpty():
        return named.drop("_spread", "_head")
    heads = named.where(F.col("_head").isNotNull()).select(F.col(name).alias("_run"), "_head")
    one = heads.groupBy("_head").agg(F.min("_run").alias("_one"))
    merged = heads.join(one, "_head").select(F.col("_run").alias(name), "_one")
    spread = named.where("_spread").join(merged, name)
    return named.where(~F.col("_spread")).select(*others, name).unionByName(
        spread.select(*others, F.col("_one").alias(name))
    )
