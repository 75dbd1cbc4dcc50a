"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Texts are cut into blocks of a fixed number of characters. Sorting the distinct blocks gives each
an integer name; then adjacent pairs of names are named in the same way, level by level, until a
text has a single name. Two texts are equal if and only if they finish on the same level with the
same name. Names come from sorting the values themselves, so no hash collision can join two texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import text_or_empty
from barweave.llm.naming import name_blocks, name_pairs
from barweave.storage import hand_over

BLOCK_CHARS = 1024


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK_CHARS
) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; of rows that also repeat the id, exactly
    one. A null text counts as empty, and empty texts are equal. A null id sorts below all others;
    a group of null ids alone has a null keep_id. Other columns are ignored. Row numbers are taken
    while ``docs`` is read, so it should be a stored table, whose scan gives the same rows again
    if an executor is lost.
    """
    text = text_or_empty(text_col)
    rows = (
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(f"`{id_col}`").alias("_id"),
            text.alias("_text"),
        )
        .select(
            "_row",
            "_id",
            F.sha2("_text", 256).alias("_sha"),
            F.when(F.length("_text") == 0, F.array(F.lit("")))
            .otherwise(F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))
            .alias("_cut"),
        )
        .select(
            "_row",
            "_id",
            "_sha",
            F.size("_cut").alias("_left"),
            F.posexplode("_cut").alias("_pos", "_block"),
        )
        # The id and digest travel with the first block only.
        .withColumns({c: F.when(F.col("_pos") == 0, F.col(c)) for c in ("_id", "_sha")})
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.length(text) / F.lit(block)))
    total = docs.agg(F.coalesce(F.sum(blocks), F.lit(0))).first()[0]
    named = name_blocks(rows, "_block", ("_row", "_pos"), "_name", total)
    base = named.where(F.col("_pos") == 0).select("_row", "_id", "_sha")
    ends, level = [], 0
    while True:
        head = named.where(F.col("_left") == 1)
        ends.append(head.select("_row", "_name", F.lit(level).alias("_level")))
        more = named.where(F.col("_left") > 1)
        if more.isEmpty():
            break
        second = F.pmod("_pos", F.lit(2)) == 1
        pairs = more.groupBy("_row", F.shiftright("_pos", 1).alias("_half")).agg(
            F.max(F.when(~second, F.col("_name"))).alias("_a"),
            F.max(F.when(second, F.col("_name"))).alias("_b"),
            F.max("_left").alias("_left"),
        )
        pairs = hand_over(
            pairs.select(
                "_row",
                "_a",
                "_b",
                F.col("_half").alias("_pos"),
                F.shiftright(F.col("_left") + 1, 1).alias("_left"),
            ),
            "pairs",
        )
        named = name_pairs(pairs, ("_a", "_b"), "_name").drop("_a", "_b", "_rows")
        named = hand_over(named, "named")
        level += 1
    found = hand_over(reduce(DataFrame.unionByName, ends).join(base, "_row"), "identities")
    groups = found.groupBy("_level", "_name").agg(
        F.max(F.struct("_id", "_row")).alias("_keep"), F.count("*").alias("group_size")
    )
    return found.join(groups, ["_level", "_name"]).select(
        F.col("_id").alias(id_col),
        F.col("_keep._id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
