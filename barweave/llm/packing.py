"""Packing of token sequences by best fit and swap-based local search.

Documents are cut into pieces only where they are longer than a sequence. Full pieces are
sequences by themselves; the others are dealt into groups of bounded size by a hash and packed
there: best fit first, then moves and exchanges (one for one, two for one, one for two) between
underfull bins that increase the sum of squared fills, until the emptiest bins are empty or no
such exchange is left. Bins that stay far from full are opened again and their pieces meet in the
next round with those of other groups, so that groups cost no sequences. A round that makes more
bins than it was given is not used. Once a round saves less than a bin a group, as where pieces
just do not fill a sequence, the fuller half of the open bins is closed at any fill, so rounds end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import chunks, text_or_empty
from barweave.llm.tokens import encoder
from barweave.storage import hand_over

CAPACITY = 2048
GROUP = 8192
#: A bin with less of its capacity used is opened again for the next round.
CLOSED = 0.98
#: An exchange is sought with so many bins, those with the most room.
NEIGHBOURS = 256
#: After an exchange so many of the emptiest bins are tried again.
WOKEN = 4


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places in ``lengths``: longest first, each to the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        room -= size
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins


def _exchange(source: list[int], lengths, table, rooms) -> tuple[int, list[int], list[int]] | None:
    """The exchange of pieces of ``source`` with another bin that fills that bin most.

    ``table`` has (bin, total, first piece, second piece) of every nothing, piece and pair of the
    other bins. Returns (bin, pieces that go there, pieces that come back).
    """
    gives = [([i], lengths[i]) for i in source]
    gives += [
        ([i, j], lengths[i] + lengths[j])
        for n, i in enumerate(source)
        for j in source[n + 1 :]
    ]
    best, result = 0, None
    owner, total, one, two = table
    for given, size in gives:
        gain = size - total
        good = (gain > best) & (gain <= rooms[owner])
        if len(given) == 2:
            good &= two < 0  # two for two is no move of this search
        if good.any():
            at = int(np.where(good, gain, 0).argmax())
            best = int(gain[at])
            result = int(owner[at]), given, [int(x[at]) for x in (one, two) if x[at] >= 0]
    return result


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty bins by moves and exchanges; each one increases the sum of squared fills."""
    least = -(-sum(lengths) // capacity)
    fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
    filled = len(bins)
    waiting = fill < capacity
    known: dict[int, np.ndarray] = {}

    def entries(b: int) -> np.ndarray:
        if b not in known:
            own = bins[b]
            rows = [(b, 0, -1, -1), *[(b, lengths[i], i, -1) for i in own]]
            rows += [
                (b, lengths[i] + lengths[j], i, j) for n, i in enumerate(own) for j in own[n + 1 :]
            ]
            known[b] = np.array(rows, np.int64)
        return known[b]

    while filled > least and waiting.any():
        source = int(np.where(waiting, fill, capacity + 1).argmin())
        others = np.flatnonzero((fill < capacity) & (fill >= fill[source]))
        others = others[others != source]
        if len(others) > NEIGHBOURS:
            others = others[np.argsort(fill[others], kind="stable")[:NEIGHBOURS]]
        found = None
        if len(others):
            table = np.concatenate([entries(b) for b in others.tolist()]).T
            found = _exchange(bins[source], lengths, table, capacity - fill)
        if found is None:
            waiting[source] = False
            continue
        target, there, back = found
        bins[source] = [i for i in bins[source] if i not in there] + back
        bins[target] = [i for i in bins[target] if i not in back] + there
        gain = sum(lengths[i] for i in there) - sum(lengths[i] for i in back)
        fill[target] += gain
        fill[source] -= gain
        for b in (source, target):
            known.pop(b, None)
            waiting[b] = 0 < fill[b] < capacity
        if not bins[source]:
            filled -= 1
            fill[source] = capacity  # an empty bin takes no part any more
        emptiest = np.argpartition(fill, WOKEN)[:WOKEN] if len(fill) > WOKEN else slice(None)
        waiting[emptiest] = fill[emptiest] < capacity
    return [b for b in bins if b]


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """A stored table of the pieces: number, id, piece, start, length, ids_crc32 (and ids)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for part in chunks(batches):
            rows, owner = [], []
            for n, ids in enumerate(code.encode(part.column("text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for p, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    rows.append((p, at, len(own), zlib.crc32(own.tobytes()), own))
                    owner.append(n)
            kinds = [pa.int32(), *[pa.int64()] * 3]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            if with_ids:
                columns.append(pa.array([r[4].astype(np.int64) for r in rows], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [part.column("_id").take(pa.array(owner, pa.int32())), *columns], names
            )

    schema = f"_id {id_type}, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(text_col).alias("text"))
    found = rows.mapInArrow(cut, schema + ", ids array<long>" * with_ids)
    return hand_over(found.withColumn("_number", F.monotonically_increasing_id()), "pieces")


def _fills(placed: DataFrame) -> dict[int, tuple[int, int]]:
    """(bins, pieces) for each fill, at most as many as the capacity."""
    first = F.count(F.when(F.col("offset") == 0, 1)).alias("bins")
    rows = placed.groupBy("fill").agg(first, F.count("*").alias("pieces")).collect()
    return {r["fill"]: (r["bins"], r["pieces"]) for r in rows}


def _bins(fills: dict[int, tuple[int, int]]) -> int:
    return sum(n for n, _ in fills.values())


def _level(fills: dict[int, tuple[int, int]], level: float, stuck: bool) -> float:
    """Bins of at least this fill are closed: when ``stuck``, the fuller half at any fill."""
    if stuck:
        seen, half = 0, _bins(fills) / 2
        for fill in sorted(fills, reverse=True):
            seen += fills[fill][0]
            if seen >= half:
                return min(level, fill)
    return level


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is the ids of its whole text (null: empty) and ``end_id``; so an empty text is one
    piece of one id. A sequence is named by the least number of its pieces. Rows that repeat an
    id are documents of their own. An empty table gives no rows.
    """
    cut = pieces(docs, tokenizer, end_id, id_col, text_col, capacity, with_ids)
    full = cut.where(F.col("length") == capacity).select(
        "_number", F.col("_number").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    def deal(key, table):
        order = table.sort_by("_number")
        number = order.column("_number").to_numpy()
        lengths = order.column("length").to_pylist()
        place = {n: np.zeros(len(number), np.int64) for n in ("sequence_id", "offset", "fill")}
        for own in pack(lengths, capacity):
            sizes = np.array([lengths[i] for i in own])
            place["sequence_id"][own] = number[own].min()
            place["offset"][own] = np.cumsum(sizes) - sizes
            place["fill"][own] = sizes.sum()
        columns = {"_number": number, "length": np.array(lengths, np.int64)} | place
        return pa.table(columns)

    schema = "_number long, length long, sequence_id long, offset long, fill long"
    waiting = cut.where(F.col("length") < capacity).select("_number", "length")
    rows, bins, number, placed = waiting.count(), None, 0, [full]
    while rows:
        groups = max(1, round(rows / group))
        share = F.pmod(F.xxhash64("_number", F.lit(number)), F.lit(groups))
        dealt = waiting.select("_number", "length").withColumn("_group", share)
        round_ = hand_over(dealt.groupBy("_group").applyInArrow(deal, schema), "packed")
        found = _fills(round_)
        stuck = bins is not None and _bins(bins) - _bins(found) < groups
        if bins is None or _bins(found) <= _bins(bins):
            waiting, bins = round_, found
        level = _level(bins, CLOSED * capacity, stuck) if groups > 1 else 0
        placed.append(waiting.where(F.col("fill") >= level).select("_number", "sequence_id", "offset"))
        waiting = waiting.where(F.col("fill") < level)
        bins = {fill: n for fill, n in bins.items() if fill < level}
        rows, number = sum(n for _, n in bins.values()), number + 1
    where = placed[0]
    for more in placed[1:]:
        where = where.unionByName(more)
    return cut.join(where, "_number").select(
        F.col("_id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
        *["ids"] * with_ids,
    )
