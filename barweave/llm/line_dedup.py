"""Repeated runs of lines, by distributed prefix doubling, in DataFrame operations only.

Every line that is not blank has an integer id in sorted order. Prefix doubling ranks the runs of
1, 2, 4, ... lines that start at each place: the rank of a run of twice the length is that of the
pair of ranks of its halves. Places whose run occurs once leave at once, so a round costs as much
as the text that still repeats, and the rounds end when no run repeats. Together the ranks are the
suffix array of the line ids as far as suffixes agree: places with one rank are a
longest-common-prefix interval. In each interval all places but the first are later copies; a
place keeps the longest of its runs, and overlapping ones join to maximal runs, which are deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.common import digest, id_key, numbered_copies, text_or_empty, with_results
from barweave.llm.naming import name_pairs
from barweave.storage import hand_over

#: A run of so many lines, or one line of so many words, is deleted where it occurs again.
LEAST_LINES, LEAST_WORDS = 2, 20
#: A word, for the second number.
WORD = r"[^\x20\x09-\x0D]+"


def _ranked(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(_row, _n, _rank) of the rows whose values occur more than once."""
    named = name_pairs(rows, columns, "_rank", least=2)
    return hand_over(named.drop(*columns, "_rows"), "ranks")


def _ahead(ranks: DataFrame, lines: int) -> DataFrame:
    """Pairs of the rank at each place and the one ``lines`` further in the same document."""
    after = ranks.select("_row", (F.col("_n") - lines).alias("_n"), F.col("_rank").alias("_b"))
    return ranks.withColumnRenamed("_rank", "_a").join(after, ["_row", "_n"])


def _later(ranks: DataFrame, documents: DataFrame, lines: int) -> DataFrame:
    """(_row, _n, _lines) of the places whose run of ``lines`` lines occurs before.

    Documents come in order of their ids; rows that share an id as they were read. Only the first
    place of each rank is looked up, by place, so that no rank brings its rows to one task.
    """
    starts = ranks.join(documents.select("_row", "_id"), "_row")
    firsts = starts.groupBy("_rank").agg(F.min(F.struct("_id", "_row", "_n")).alias("_least"))
    firsts = firsts.select("_least._row", "_least._n")
    later = ranks.select("_row", "_n").join(firsts, ["_row", "_n"], "left_anti")
    return later.withColumn("_lines", F.lit(lines))


def repeated_runs(
    docs: DataFrame, id_col: str, text_col: str, least_lines: int, least_words: int | None
) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): _row, _key, _digest, _copy; and _row, _first, _last of deleted runs."""
    lines = F.split(text_or_empty(text_col), "\n")
    kept = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda s: s["x"].rlike(r"\S"),
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        id_key(id_col).alias("_key"),
        digest(text_col).alias("_digest"),
        kept.alias("_lines"),
    ).select("_row", "_id", "_key", "_digest", F.posexplode_outer("_lines").alias("_n", "_line"))
    first = F.coalesce(F.col("_n"), F.lit(0)) == 0
    long = F.lit(False)
    if least_words is not None:
        long = F.regexp_count("_line.x", F.lit(WORD)) >= least_words
    placed = hand_over(
        rows.select(
            "_row",
            *[F.when(first, F.col(c)).alias(c) for c in ("_id", "_key", "_digest")],
            "_n",
            F.col("_line.i").alias("_at"),
            long.alias("_long"),
            F.unhex(F.sha2(F.col("_line.x"), 256)).alias("_value"),
        ),
        "lines",
    )
    documents = hand_over(
        numbered_copies(
            placed.where(F.coalesce(F.col("_n"), F.lit(0)) == 0).select(
                "_row", "_id", "_key", "_digest"
            )
        ),
        "documents",
    )
    single = placed.where("_n is not null").select("_row", "_n", "_long", "_value")
    ranks = _ranked(single, ("_value",))
    found = [_later(ranks.where("_long").drop("_long"), documents, 1)]
    ranks, length = ranks.drop("_long"), 1
    while 2 * length <= least_lines:
        ranks = _ranked(_ahead(ranks, length), ("_a", "_b"))
        length *= 2
    if length < least_lines:
        # Two overlapping runs of ``length`` lines make one of ``least_lines``.
        ranks = _ranked(_ahead(ranks, least_lines - length), ("_a", "_b"))
        length = least_lines
    while not ranks.isEmpty():
        found.append(_later(ranks, documents, length))
        ranks = _ranked(_ahead(ranks, length), ("_a", "_b"))
        length *= 2
    longest = reduce(DataFrame.unionByName, found)
    longest = longest.groupBy("_row", "_n").agg(F.max("_lines").alias("_lines"))
    # Runs that overlap or touch are one.
    before = Window.partitionBy("_row").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.max(F.col("_n") + F.col("_lines")).over(before)
    begins = (F.coalesce(upto, F.lit(-1)) < F.col("_n")).cast("int")
    order = Window.partitionBy("_row").orderBy("_n")
    joined = longest.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(order))
    runs = joined.groupBy("_row", "_run").agg(
        F.min("_n").alias("_low"), F.max(F.col("_n") + F.col("_lines") - 1).alias("_high")
    )
    ends = runs.select("_row", "_run", F.explode(F.array("_low", "_high")).alias("_n"))
    ends = ends.join(placed.select("_row", "_n", "_at"), ["_row", "_n"]).groupBy("_row", "_run")
    return documents, ends.agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_lines: int = LEAST_LINES,
    least_words: int | None = LEAST_WORDS,
) -> DataFrame:
    """One row per document: id, n_lines, n_removed, n_runs, kept_text.

    A run of at least ``least_lines`` lines that also occurs earlier (in a document with a smaller
    id, or before in the same one) is deleted, with blank lines inside it, and so is one line of at
    least ``least_words`` words (None: no single lines); occurrences are judged on the input.
    Deleted lines that follow each other, blank ones aside, are one run. Blank lines alone never
    form a run. Null texts count as empty (one blank line); null ids sort first; rows that repeat
    an id and its text are documents one after another. An empty table gives no rows; other columns
    of the table play no part, whatever their names.
    """
    documents, runs = repeated_runs(docs, id_col, text_col, least_lines, least_words)
    per_row = runs.groupBy("_row").agg(F.collect_list(F.struct("_first", "_last")).alias("_runs"))
    results = documents.select("_row", "_key", "_digest", "_copy").join(per_row, "_row")
    results = hand_over(results.drop("_row"), "runs")
    rows = with_results(docs, results, id_col, text_col)
    lines = F.split("_text", "\n")
    left = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda s: ~F.exists("_runs", lambda r: s["i"].between(r["_first"], r["_last"])),
    )
    kept = F.when(F.col("_runs").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(left, lambda s: s["x"]), "\n")
    )
    removed = F.aggregate(
        "_runs", F.lit(0), lambda n, r: n + r["_last"] - r["_first"] + F.lit(1)
    )
    return rows.select(
        F.col("_id").alias(id_col),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("_runs"), F.lit(0)).cast("long").alias("n_runs"),
        kept.alias("kept_text"),
    )
