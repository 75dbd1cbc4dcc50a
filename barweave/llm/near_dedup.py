"""Near duplicates by ProbMinHash signatures, banding and exact verification.

The elements of a document are its five-word shingles, weighted by how often each occurs. Every
element is a Poisson process of arrivals whose rate is its weight; an arrival falls on one of the
registers, and a register remembers the element that arrived first. Two documents agree on a
register with the probability Jaccard similarity of their weighted sets. Arrivals are followed
only up to a time by which all registers are expected to be filled; documents with an empty
register after that are followed further. So long documents cost little more than a pass over
their elements.

Rows with the same weighted set form a class first. Classes that agree on all registers of a band
meet in a bucket. Links are sought where they can still join components: first each class is
compared with the least class of all its buckets, then with the least class of each bucket that
is not in its component. Buckets that still hold several components are searched in blocks of
bounded size inside tasks, by signatures: pairs of different components whose registers agree
as often as similar ones do (three deviations below the level) are compared there, unless links
of the block already join them; so a block gives fewer links than it has members. Each comparison
of sets is exact. Groups are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import chunks, text_or_empty
from barweave.llm.words import counted, mix, shingle_hashes, word_hashes
from barweave.storage import hand_over

SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band with probability 0.000003.
BANDS, ROWS = 42, 6
#: Members of a bucket that a task compares with so many others at a time.
BLOCK = 1000
#: Text bytes of the members of a block.
BLOCK_BYTES = 8_000_000
#: Text bytes that a task signs or compares at a time; one text stays whole.
PIECE_BYTES = 500_000
_U = np.uint64


def _arrival(element: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Exponential waiting times, a function of element and turn."""
    bits = mix(element + turn * _U(0x9E3779B97F4A7C15), 11)
    return -np.log1p(-(bits >> _U(11)).astype(np.float64) * 2.0**-53)


def prob_minhash(
    element: np.ndarray, weight: np.ndarray, doc: np.ndarray, n: int, registers: int
) -> np.ndarray:
    """(n, registers) elements that arrived first; entries are sorted by doc, each doc has some."""
    total = np.bincount(doc, weight, minlength=n)
    limit = registers * (np.log(registers) + 2) / total
    best = np.full(n * registers, np.inf)
    held = np.zeros(n * registers, np.uint64)
    time = _arrival(element, np.zeros(len(element), np.uint64)) / weight
    turn = np.zeros(len(element), np.uint64)
    open_docs = np.ones(n, bool)
    while open_docs.any():
        live = np.flatnonzero(open_docs[doc] & (time <= limit[doc]))
        while live.size:
            own, when = element[live], time[live]
            place = (mix(own ^ (turn[live] * _U(0xD1342543DE82EF95)), 12) >> _U(33)) % _U(registers)
            slot = doc[live] * registers + place.astype(np.int64)
            early = np.flatnonzero(when < best[slot])
            early = early[np.argsort(-when[early], kind="stable")]
            # Of several writes to a slot the last, which is the earliest arrival, remains.
            best[slot[early]] = when[early]
            held[slot[early]] = own[early]
            turn[live] += _U(1)
            time[live] += _arrival(own, turn[live]) / weight[live]
            live = live[time[live] <= limit[doc[live]]]
        open_docs = np.isinf(best.reshape(n, registers)).any(axis=1)
        limit[open_docs] *= 1.5
    return held.reshape(n, registers)


def signatures(texts: list[str], bands: int = BANDS, rows: int = ROWS):
    """(fingerprints, band keys, registers) per text; None for texts without words.

    A fingerprint is a 128-bit sum over the weighted set: equal sets, equal fingerprints.
    """
    shingles, doc, _ = shingle_hashes(*word_hashes(texts))
    found, doc, count = counted(shingles, doc)
    with_words, place = np.unique(doc, return_inverse=True)
    prints: list[bytes | None] = [None] * len(texts)
    keys: list[np.ndarray | None] = [None] * len(texts)
    registers: list[bytes | None] = [None] * len(texts)
    if not len(with_words):
        return prints, keys, registers
    starts = np.searchsorted(place, np.arange(len(with_words)))
    sums = [
        np.add.reduceat(mix(found + mix(count.astype(np.uint64), s), s), starts) for s in (21, 22)
    ]
    held = prob_minhash(found, count.astype(float), place, len(with_words), bands * rows)
    held = held.reshape(len(with_words), bands, rows)
    band = np.broadcast_to(np.arange(bands, dtype=np.uint64), held.shape[:2])
    for r in range(rows):
        band = mix(band * _U(0xD1342543DE82EF95) + held[:, :, r], 23)
    both = np.stack(sums, axis=1)
    short = (mix(held, 24) >> _U(48)).astype("<u2")
    for i, at in enumerate(with_words.tolist()):
        prints[at] = both[i].tobytes()
        keys[at] = band[i].view(np.int64)
        registers[at] = short[i].tobytes()
    return prints, keys, registers


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets, given as sorted elements and counts."""
    both, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1][at].astype(float), b[1][bt].astype(float)
    only_x = float(a[1].sum()) - x.sum()
    only_y = float(b[1].sum()) - y.sum()
    ratio, which = np.unique(y / x, return_inverse=True)
    mass = np.bincount(which, x)
    total = 0.0
    for r, m in zip(ratio, mass, strict=True):
        total += m / (only_x + only_y / r + np.maximum(x, y / r).sum())
    return total


def _sets(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    found, doc, count = counted(*shingle_hashes(*word_hashes(texts))[:2])
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [(found[a:b], count[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, own = None, None
    for piece in chunks(batches, "text_b", PIECE_BYTES):
        other = _sets(piece.column("text_b").to_pylist())
        value = []
        for i, key in enumerate(piece.column("a").to_pylist()):
            if key != last:
                last, own = key, _sets([piece.column("text_a")[i].as_py()])[0]
            value.append(similarity(own, other[i]))
        yield pa.RecordBatch.from_arrays(
            [piece.column("a"), piece.column("b"), pa.array(value, pa.float64())], ["a", "b", "sim"]
        )


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact similarity of each pair (a, b); ``texts`` has node and text. A stored table."""
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    rows = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return hand_over(rows.mapInArrow(_compare, "a long, b long, sim double"), "compared")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component of the links (a, b).

    Large-star and small-star steps: every step links nodes to the least neighbour, until nothing
    changes. Each step is a stored table; only a count and a checksum reach the driver.
    """
    # A link joins the greater node to the smaller one.
    edges = hand_over(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v")
        .distinct(),
        "edges",
    )
    sign = None
    while True:
        turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        all_ways = edges.unionByName(turned)
        least = all_ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = all_ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = hand_over(large.where("u != v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v")))
        edges = hand_over(small.where("u != v").distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return ends.unionByName(roots)


def labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Add the component of a node; one without links is its own."""
    known = labels.select(F.col("node").alias(node), F.col("label").alias(name))
    return rows.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def mixed_links(
    members: DataFrame,
    labels: DataFrame,
    heads: DataFrame,
    texts: DataFrame,
    bands: int,
    rows: int,
    level: float,
    block: int,
) -> DataFrame:
    """Links (a, b) that join different components which meet in a bucket.

    A bucket of more than two blocks of members is searched as pairs of blocks, each a task's
    worth. Members with some pair whose registers agree often enough get their texts, and the
    pairs are compared, each in one bucket and the most alike first.
    """
    placed = labelled(members, labels, "node", "label")
    spans = placed.groupBy("key").agg(
        F.min("label").alias("_a"),
        F.max("label").alias("_b"),
        F.count("*").alias("_n"),
        F.sum("size").alias("_size"),
    )
    # The two members of a bucket of two have been compared.
    blocks = F.ceil(F.greatest(F.col("_n") / block, F.col("_size") / BLOCK_BYTES))
    wide = spans.where("_a != _b and _n > 2").select(
        "key", F.least(blocks, F.col("_n")).cast("int").alias("_blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    spread = (
        placed.join(wide, "key")
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(
            "key",
            F.least("_own", "_other").alias("_low"),
            F.greatest("_own", "_other").alias("_high"),
            "_own",
            "band",
            "node",
            "label",
            (F.col("node") == F.col("pivot")).alias("_first"),
        )
    )
    known = heads.select(F.col("_row").alias("node"), "registers")
    rows_of = spread.join(known, "node")
    least = level - 3 * (level * (1 - level) / (bands * rows)) ** 0.5

    def agreeing(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the pairs to compare, and how often their registers agree."""
        node, label = (table.column(c).to_numpy() for c in ("node", "label"))
        side = table.column("_own").to_numpy()
        first = table.column("_first").to_numpy()
        band = table.column("band")[0].as_py()
        low, high = table.column("_low")[0].as_py(), table.column("_high")[0].as_py()
        shape = (len(node), bands, rows)
        held = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(shape)
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        for i in range(len(node)):
            if side[i] != low or first[i]:
                continue
            other = label != label[i]
            other &= (node > node[i]) if low == high else side == high
            at = np.flatnonzero(other & ~first)
            if not len(at):
                continue
            same = held[at] == held[i]
            share = same.reshape(len(at), -1).mean(axis=1)
            # Of all buckets that a pair shares only the first one compares it.
            often = (share >= least) & (same.all(axis=2).argmax(axis=1) == band)
            at = at[often]
            found.append((np.full(len(at), i), at, share[often]))
        one, two, share = (np.concatenate(part) for part in zip(*found, strict=True))
        return one, two, share

    def search(table: pa.Table) -> pa.Table:
        one, two, _ = agreeing(table)
        return table.take(pa.array(np.union1d(one, two)))

    def verify(table: pa.Table) -> pa.Table:
        one, two, share = agreeing(table)
        order = np.argsort(-share, kind="stable")
        sets = []
        for piece in chunks(table.combine_chunks().to_batches(), "text", PIECE_BYTES):
            sets += _sets(piece.column("text").to_pylist())
        node = table.column("node").to_pylist()
        label = table.column("label").to_pylist()
        above: dict[int, int] = {}

        def root(name: int) -> int:
            while name in above:
                if above[name] in above:
                    above[name] = above[above[name]]
                name = above[name]
            return name

        found: list[tuple[int, int]] = []
        for i, j in zip(one[order].tolist(), two[order].tolist(), strict=True):
            a, b = root(label[i]), root(label[j])
            if a != b and similarity(sets[i], sets[j]) >= level:
                above[max(a, b)] = min(a, b)
                found.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table(
            {
                "a": pa.array([f[0] for f in found], pa.int64()),
                "b": pa.array([f[1] for f in found], pa.int64()),
            }
        )

    part = ["key", "_low", "_high"]
    some = rows_of.groupBy(*part).applyInArrow(search, rows_of.schema)
    return some.join(texts, "node").groupBy(*part).applyInArrow(verify, "a long, b long")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    level: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``id_col``, class_id, class_size, kept and text_sha256.

    Documents whose weighted sets of five-word shingles have a probability Jaccard similarity of
    at least ``level`` are linked; a class is a connected component. class_id is its least id, and
    that row is kept (of rows that repeat the id, exactly one; null ids sort first). A text of
    fewer than five words has one shingle of all its words. A null text counts as empty; a text
    without words is alone. An empty table gives no rows.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text", PIECE_BYTES):
            prints, keys, registers = signatures(piece.column("text").to_pylist(), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_row"),
                    piece.column("_id"),
                    piece.column("_sha"),
                    pa.array(prints, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(registers, pa.binary()),
                    pc.binary_length(piece.column("text")).cast(pa.int64()),
                ],
                ["_row", "_id", "_sha", "print", "bands", "registers", "size"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("_sha"),
        text_or_empty(text_col).alias("text"),
    )
    signed = hand_over(
        read.mapInArrow(
            sign, f"_row long, _id {id_type}, _sha binary, print binary, bands array<long>, "
            "registers binary, size long",
        ),
        "signed",
    )
    # A class of equal sets is named by one of its rows.
    classes = hand_over(
        signed.where(F.col("print").isNotNull())
        .groupBy("print")
        .agg(F.min("_row").alias("node")),
        "classes",
    )
    heads = signed.join(classes.select(F.col("node").alias("_row")), "_row", "left_semi")
    keys = heads.select(
        F.col("_row").alias("node"), "size", F.posexplode("bands").alias("band", "key")
    )
    buckets = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("_last"))
    buckets = buckets.where("pivot != _last").drop("_last")
    members = hand_over(keys.join(buckets, "key"), "members")
    in_some = members.select("node").distinct()
    shas = heads.select(F.col("_row").alias("node"), "_id", "_sha").join(in_some, "node", "left_semi")
    source = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("_sha"),
        text_or_empty(text_col).alias("text"),
    )
    same = source["_id"].eqNullSafe(shas["_id"]) & (source["_sha"] == shas["_sha"])
    texts = source.join(shas.hint("merge"), same).select("node", "text")
    if not signed.groupBy("_id", "_sha").count().where("count > 1").isEmpty():
        # Rows that repeat both id and text all meet the one node; it has its text once.
        texts = texts.dropDuplicates(["node"])
    texts = hand_over(texts, "texts")
    stars = members.where("node != pivot").select("pivot", "node")
    nearest = stars.groupBy("node").agg(F.min("pivot").alias("pivot"))
    links, labels = None, None
    for pairs in (nearest, stars.distinct()):
        if labels is not None:
            pairs = labelled(labelled(pairs, labels, "pivot", "_a"), labels, "node", "_b")
            pairs = pairs.where("_a != _b").select("pivot", "node")
            pairs = pairs.join(nearest, ["pivot", "node"], "left_anti")
        found = compare(pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b")), texts)
        found = found.where(F.col("sim") >= level).select("a", "b")
        links = found if links is None else links.unionByName(found)
        labels = hand_over(components(links), "labels")
    found = mixed_links(members, labels, heads, texts, bands, rows, level, block)
    found = hand_over(found, "links")
    if not found.isEmpty():
        old = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = hand_over(components(old.unionByName(found)), "labels")
    named = classes.join(labels, "node", "left").select(
        "print", F.coalesce("label", "node").alias("_label")
    )
    placed = signed.select("_row", "_id", "_sha", "print").join(named, "print", "left")
    placed = placed.select("_row", "_id", "_sha", F.coalesce("_label", "_row").alias("_label"))
    placed = hand_over(placed, "placed")
    groups = placed.groupBy("_label").agg(
        F.min(F.struct("_id", "_row")).alias("_first"), F.count("*").alias("class_size")
    )
    return placed.join(groups, "_label").select(
        F.col("_id").alias(id_col),
        F.col("_first._id").alias("class_id"),
        "class_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
