"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task turns into arrays at a time.
CHUNK_BYTES = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def id_fold(name: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))) % folds


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece have about ``size`` bytes; one text stays whole."""
    for batch in batches:
        lengths = batch.column(column).to_pylist() if batch.num_rows <= 1 else None
        if lengths is not None:
            if batch.num_rows:
                yield batch
            continue
        import numpy as np
        import pyarrow.compute as pc

        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def stay(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` named by ``chosen`` (_id, _digest = sha2-256 of the text), one for each.

    Rows that repeat an id and its text come out once. All columns of ``docs`` are kept.
    """
    digest, key, mark = (fresh(docs, n) for n in ("_digest_", "_key_", "_number_"))
    left = docs.withColumns({digest: F.sha2(text_or_empty(text_col), 256), key: id_key(id_col)})
    right = chosen.select(id_key("_id").alias(key), F.col("_digest").alias(digest)).distinct()
    from pyspark.sql import Window

    joined = left.join(right.hint("merge"), [key, digest], "left_semi")
    # The join leaves rows dealt out by (key, digest), which is all that the window needs.
    same = Window.partitionBy(key, digest).orderBy(digest)
    return (
        joined.withColumn(mark, F.row_number().over(same))
        .where(F.col(mark) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def id_key(name: str) -> Column:
    """The id as text that tells a null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit(""))


def digest(name: str) -> Column:
    """sha2-256 of a text, as 32 bytes."""
    return F.unhex(F.sha2(text_or_empty(name), 256))


def numbered_copies(rows: DataFrame) -> DataFrame:
    """Add _copy: numbers rows (_row, _key, _digest) that repeat both id and text, from 1."""
    from pyspark.sql import Window

    same = Window.partitionBy("_key", "_digest").orderBy("_row")
    return rows.withColumn("_copy", F.row_number().over(same))


def with_results(docs: DataFrame, results: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text, results...) for every row of ``docs``; ``results`` has _key, _digest, _copy.

    Results grow with the documents, so they are merged at every size and never broadcast. Texts
    are shuffled once. Only where rows repeat id and text are the copies told apart.
    """
    from pyspark.sql import Window

    left = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        text_or_empty(text_col).alias("_text"),
        id_key(id_col).alias("_key"),
        digest(text_col).alias("_digest"),
    )
    on = ["_key", "_digest"]
    if not results.where("_copy > 1").isEmpty():
        same = Window.partitionBy(*on).orderBy("_digest")
        left, on = left.withColumn("_copy", F.row_number().over(same)), [*on, "_copy"]
        return left.join(results.hint("merge"), on, "left").drop(*on)
    return left.join(results.drop("_copy").hint("merge"), on, "left").drop(*on)


def running_sums(rows: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add to each row, for new name -> column, the column's sum over all rows before it.

    ``order`` names columns that order all rows, nulls first; rows equal in all of them may come in
    any order. Rows are dealt out by range and stored; only the sums of the partitions, one row for
    each, meet in a task and are broadcast.
    """
    from pyspark.sql import Window

    from barweave.storage import hand_over

    part = fresh(rows, "_part")
    dealt = rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    dealt = hand_over(dealt, "ordered")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = {name: f"_{name}_before" for name in sums}
    totals = dealt.groupBy(part).agg(*[F.sum(c).alias(base[n]) for n, c in sums.items()])
    totals = totals.select(
        part, *[F.coalesce(F.sum(b).over(before), F.lit(0)).alias(b) for b in base.values()]
    )
    own = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    added = {n: F.col(base[n]) + F.coalesce(F.sum(c).over(own), F.lit(0)) for n, c in sums.items()}
    return dealt.join(F.broadcast(totals), part).withColumns(added).drop(part, *base.values())
