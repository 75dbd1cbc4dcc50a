"""Mix sources to target weights by a low-discrepancy schedule, with DataFrame operations only.

Every source's documents are shuffled, laid end to end and cut into blocks of equally many words.
Its target gives it a number of slots, one for a block. The slots of all sources are the integers
of one row of intervals, that is the cumulative weights in units of a slot; the van der Corput
sequence (bits of the slot's time reversed) visits them so that any stretch of time holds slots of
each source nearly in proportion. Slots are ranked within their source by time, and the k-th one
takes the source's block k, beginning again after the last.

Sources, shuffled documents and slots are each cut further (by range, by the first digits of the
hash, by time), so that a source on most rows does not meet in one task. What grows with the input
is merged at every size and never broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.common import running_sums
from barweave.storage import hand_over

#: Weights of the sources in order of their names, again from the first after the last.
WEIGHTS = (5, 2, 1)
#: A source gives no more than so many times its words.
REPEATS = 3
#: Words of a block, fewer for a source whose target has less than so many blocks.
BLOCK, LEAST_BLOCKS = 1024, 64
SEED = 7

#: A word is what lies between blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"
#: Shuffled documents and slots of a source are numbered in cells: hexadecimal digits, bits.
_CELL_DIGITS, _CELL_BITS = 3, 12
_SLOTS_A_ROW = 4096
#: Sources up to this number are broadcast, more of them are joined by a shuffle.
_FEW_SOURCES = 20_000
_SWAPS = [
    (1, 0x5555555555555555),
    (2, 0x3333333333333333),
    (4, 0x0F0F0F0F0F0F0F0F),
    (8, 0x00FF00FF00FF00FF),
    (16, 0x0000FFFF0000FFFF),
    (32, 0x00000000FFFFFFFF),
]


@dataclass(frozen=True)
class Mixture:
    """``documents``: id, size, source, source_size, target, taken, one row for each document.
    ``slots``: slot (time), _source, rank, block. ``pieces``: _source, block, id, words: which
    documents a block consists of, and how many of their words."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def reversed_bits(value: Column, bits: int) -> Column:
    """The lowest ``bits`` bits of an integer below 2**bits in reversed order."""
    for shift, mask in _SWAPS:
        low = F.shiftleft(value.bitwiseAND(F.lit(mask)), shift)
        value = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(mask)).bitwiseOR(low)
    return F.shiftrightunsigned(value, 64 - bits) if bits else F.lit(0).cast("long")


def _with_targets(sources: DataFrame, repeats: int) -> DataFrame:
    """Add target to (weight, source_size): shares by weight, none above ``repeats`` sizes.

    What a source cannot take is shared out again. Each turn is one aggregation to a row of two
    numbers: the words left to the sources under their limit, and the weights of those.
    """
    whole = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).head()
    words, weight = whole["words"] or 0, whole["weight"] or 1
    exact = "decimal(38,0)"
    while True:
        share = F.col("weight").cast(exact) * F.lit(words).cast(exact)
        over = share > F.col("source_size").cast(exact) * F.lit(repeats * weight).cast(exact)
        full = sources.where(over).agg(
            F.sum("source_size").alias("words"), F.sum("weight").alias("weight")
        ).head()
        left = (whole["words"] or 0) - repeats * (full["words"] or 0)
        free = (whole["weight"] or 1) - (full["weight"] or 0)
        if (left, free) == (words, weight):
            break
        words, weight = left, free
    shared = (F.col("weight") * F.lit(words).cast("long")).cast("double") / F.lit(float(weight))
    return sources.withColumn(
        "target", F.when(over, (repeats * F.col("source_size")).cast("double")).otherwise(shared)
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK,
    least_blocks: int = LEAST_BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> Mixture:
    """A schedule of all documents in which sources have their shares of words by weight.

    Sources are ordered by code point, null last, and share as many words as all texts have. A
    source takes its target to within about a block, and no word more than ``repeats`` times. A
    null text has no words, a null source is a source, a null id is shuffled like an empty one.
    Rows that repeat an id are documents of their own; if they repeat the text too, which of them
    stands first does not show. An empty table gives empty tables. Only the three columns named are
    read, so names of others cannot clash.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    sized = (
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0))
            .cast("long")
            .alias("size"),
        )
        .withColumn("_place", F.substring(digest, 1, 16))
        .withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    )
    sized = hand_over(sized, "sized")
    sources = _blocks(sized, weights, repeats, block, least_blocks)
    documents = _laid_out(sized, sources)
    inside = documents.where("size > 0")
    piece = F.col("block") * F.col("_block")
    end = F.col("_start") + F.col("size")
    last = F.expr("(_start + size - 1) div _block")
    pieces = inside.withColumn(
        "block", F.explode(F.sequence(F.expr("_start div _block"), last))
    ).withColumn(
        "words",
        F.least(end, piece + F.col("_block")) - F.greatest(F.col("_start"), piece),
    )
    slots = hand_over(_slots(sources), "slots")
    times = slots.groupBy("_source", "block").agg(F.count("*").alias("_times"))
    used = pieces.join(times.hint("merge"), ["_source", "block"], "left")
    columns = ["id", "size", "source", "source_size", "target"]
    taken = (
        used.groupBy("_source", "_start", *columns)
        .agg(F.sum(F.col("words") * F.coalesce("_times", F.lit(0))).alias("taken"))
        .select(*columns, "taken")
    )
    nothing = documents.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    return Mixture(taken.unionAll(nothing), slots, pieces.select("_source", "block", "id", "words"))


def _blocks(sized: DataFrame, weights, repeats: int, block: int, least_blocks: int) -> DataFrame:
    """Sources with their targets, blocks, slots and where their slots begin."""
    sources = sized.groupBy("_key", "source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumns({"_one": F.lit(1).cast("long"), "_last": F.col("source").isNull()})
    sources = running_sums(sources, ["_last", "source"], {"_source": "_one"})
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weight = F.element_at(cycle, (F.col("_source") % len(weights) + 1).cast("int"))
    # The last column is kept, so that _source is the number of a source from 0 in their order.
    sources = hand_over(sources.withColumn("weight", weight), "sources")
    sources = _with_targets(sources, repeats)
    size = F.floor(F.col("target") / least_blocks)
    sources = sources.withColumn("_block", F.greatest(F.lit(1), F.least(F.lit(block), size)))
    blocks = F.ceil(F.col("source_size") / F.col("_block"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    full = F.coalesce(full, F.lit(0))
    rest = F.floor((F.col("target") - full * F.col("source_size")) / F.col("_block") + 0.5)
    sources = sources.withColumns({"_blocks": blocks, "_slots": full * blocks + F.least(rest, blocks)})
    return hand_over(running_sums(sources, ["_source"], {"_first": "_slots"}), "targets")


def _laid_out(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with their source's figures and _start, the words before them in the source."""
    figures = sources.select("_key", "_source", "source_size", "target", "_block")
    few = figures.count() <= _FEW_SOURCES
    rows = sized.join(F.broadcast(figures) if few else figures, "_key")
    rows = rows.withColumn("_cell", F.substring("_place", 1, _CELL_DIGITS))
    cells = rows.groupBy("_source", "_cell").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "_source", "_cell", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_words")
    )
    own = (
        Window.partitionBy("_source", "_cell")
        .orderBy("_place", F.col("id").cast("string").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_words") + F.coalesce(F.sum("size").over(own), F.lit(0))
    return rows.join(cells.hint("merge"), ["_source", "_cell"]).withColumn("_start", start)


def _slots(sources: DataFrame) -> DataFrame:
    """(slot, _source, rank, block) of every slot."""
    used = sources.where("_slots > 0")
    last = used.agg(F.max(F.col("_first") + F.col("_slots"))).head()[0] or 1
    bits = (last - 1).bit_length()
    rows = used.withColumn(
        "_row", F.explode(F.sequence(F.lit(0), F.expr(f"(_slots - 1) div {_SLOTS_A_ROW}")))
    ).repartition("_source", "_row")
    low = F.col("_row") * _SLOTS_A_ROW
    slots = rows.withColumn(
        "_at", F.explode(F.sequence(low, F.least(low + _SLOTS_A_ROW, F.col("_slots")) - 1))
    ).select(
        "_source",
        "_blocks",
        reversed_bits((F.col("_first") + F.col("_at")).cast("long"), bits).alias("slot"),
    )
    slots = slots.withColumn("_cell", F.shiftright("slot", max(0, bits - _CELL_BITS)))
    counts = slots.groupBy("_source", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "_source", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n")
    )
    own = Window.partitionBy("_source", "_cell").orderBy("slot")
    rank = F.col("_n") + F.row_number().over(own) - 1
    return (
        slots.join(counts.hint("merge"), ["_source", "_cell"])
        .withColumn("rank", rank)
        .select("slot", "_source", "rank", (F.col("rank") % F.col("_blocks")).alias("block"))
    )
