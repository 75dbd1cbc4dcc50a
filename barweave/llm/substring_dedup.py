"""Repeated byte strings across documents, by prefix-free parsing.

A rolling hash over grams of GRAM bytes sets triggers: in every string of LENGTH bytes the gram of
least hash is one, so equal strings have the same trigger at the same place and no string is
without one. Triggers cut the corpus into phrases; the strings whose trigger is the same
occurrence form one entry of the parse, with the fingerprint of all the bytes they cover. What is
compared is corpus order to a depth of LENGTH bytes, as only that decides which strings are equal:

* the parse is sorted by (trigger, entry, document, place). Of equal entries all but the first
  repeat earlier text as a whole, whatever text that is, and are done;
* only where a trigger has different entries, at the borders of repeated passages, are the
  strings inside told apart: the first of each distinct entry is sorted string by string.

Both sorts are dealt out by trigger. Before they leave a task, entries that repeat inside it are
combined, so that a passage copied any number of times arrives once from each task. Entries are
compared by trigger hash and 64-bit fingerprint, strings by 128-bit fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import chunks, digest, id_key, numbered_copies, text_or_empty, with_results
from barweave.llm.words import mix
from barweave.storage import hand_over

LENGTH, GRAM = 100, 24
#: Bytes of a long text that are parsed at a time; neighbouring parts overlap by LENGTH - 1.
PART = 1_000_000
#: Entries that a task gathers before it combines and sends them.
GATHERED = 700_000
#: A trigger with more different entries than this in a bucket has its strings dealt out by
#: themselves instead of by trigger.
HOT = 20_000
NO_ID = -(2**63)
_U = np.uint64
_PLACE_BITS = 30
_TABLES = [mix(np.arange(256, dtype=np.uint64), s) for s in (41, 42)]
_BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _powers or len(_powers[which][0]) < n:
        found = []
        for base in (_BASES[which], pow(_BASES[which], -1, 2**64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps))
        _powers[which] = found[0], found[1]
    up, down = _powers[which]
    return up[:n], down[:n]


class Rolled:
    """Fingerprints of any stretch of some bytes from sums of their prefixes."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _power(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[which][data] * up[:-1], out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last] - self.sums[first]) * self.down[first], 43)


def parse(data: np.ndarray, ends: np.ndarray):
    """Entries of the parse of texts that end at ``ends``: (first start, strings, trigger, print)."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    rolled = Rolled(data)
    n = len(data) - GRAM + 1
    grams = mix((rolled.sums[GRAM:] - rolled.sums[:n]) * rolled.down[:n], 44)
    keys = (grams >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | np.arange(n, dtype=np.uint64)
    size, width = 1, LENGTH - GRAM + 1
    least = keys
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: size - width], least[width - size :])
    trigger = (least & _U(2**_PLACE_BITS - 1)).astype(np.int64)
    # ``least`` has one value for each string; those that reach over the end of a text go.
    whole = np.ones(len(trigger), bool)
    for back in range(1, LENGTH):
        at = ends - LENGTH + back
        whole[at[(at >= 0) & (at < len(whole))]] = False
    start = np.flatnonzero(whole)
    if not start.size:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    trigger = trigger[start]
    new = np.flatnonzero(
        np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (start[1:] != start[:-1] + 1)])
    )
    count = np.diff(np.concatenate([new, [len(start)]]))
    first = start[new]
    place = trigger[new]
    prints = rolled.of(first, first + count + LENGTH - 1)
    prints = mix(prints ^ ((place - first) * 256 + count).astype(np.uint64), 45)
    return first, count, grams[place], prints


def _parts(rows: list[int], texts: list[bytes]) -> Iterator[tuple]:
    """(rows, offsets, data, ends): texts side by side, long ones in overlapping parts."""
    owner, offset, own, size = [], [], [], 0
    for row, text in zip(rows, texts, strict=True):
        for at in range(0, max(1, len(text) - LENGTH + 1), PART):
            part = text[at : at + PART + LENGTH - 1]
            if own and size + len(part) > 2 * PART:
                yield _joined(owner, offset, own)
                owner, offset, own, size = [], [], [], 0
            owner.append(row)
            offset.append(at)
            own.append(part)
            size += len(part)
    if own:
        yield _joined(owner, offset, own)


def _joined(owner, offset, own):
    ends = np.cumsum([len(x) for x in own])
    return np.array(owner), np.array(offset), np.frombuffer(b"".join(own), np.uint8), ends


def _sorted_firsts(columns: list[np.ndarray], keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by all columns, and which rows in that order are the first of their ``keys`` columns."""
    order = np.lexsort(columns[::-1])
    first = np.zeros(len(order), bool)
    first[:1] = True
    for c in columns[:keys]:
        own = c[order]
        first[1:] |= own[1:] != own[:-1]
    return order, first


_KINDS = ("<u8", "<u8", "<i8", "<i8", "<u4", "<u1")  # two keys, document id, row, place, strings
_SENT = "bucket int, base_id long, base_row long, wide boolean, data binary, kind int, sha binary"
_SENT_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("base_id", pa.int64()),
        ("base_row", pa.int64()),
        ("wide", pa.bool_()),
        ("data", pa.binary()),
        ("kind", pa.int32()),
        ("sha", pa.binary()),
    ]
)
ENTRIES, DOCUMENT, LATER, BORDER, STRETCHES = range(5)


def _packed(columns: list[np.ndarray]) -> dict:
    """One row: the columns side by side; ids and rows relative to the least where they fit."""
    base_id, base_row = int(columns[2].min()), int(columns[3].min())
    wide = int(columns[2].max()) - base_id >= 2**32 or int(columns[3].max()) - base_row >= 2**32
    if wide:
        base_id = base_row = 0
    kinds = [k.replace("i8", "i8" if wide else "u4") for k in _KINDS]
    shifted = [columns[0], columns[1], columns[2] - base_id, columns[3] - base_row, *columns[4:]]
    data = b"".join(c.astype(k).tobytes() for c, k in zip(shifted, kinds, strict=True))
    return {"base_id": base_id, "base_row": base_row, "wide": wide, "data": data}


def _unpacked(rows: list[dict]) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in _KINDS]
    for row in rows:
        kinds = [np.dtype(k.replace("i8", "i8" if row["wide"] else "u4")) for k in _KINDS]
        n, at = len(row["data"]) // sum(k.itemsize for k in kinds), 0
        for i, kind in enumerate(kinds):
            own = np.frombuffer(row["data"], kind, n, at)
            at += n * kind.itemsize
            if i in (2, 3):
                own = own.astype(np.int64) + row["base_id" if i == 2 else "base_row"]
            parts[i].append(own)
    return [np.concatenate(p) for p in parts]


def _send(columns: list[np.ndarray], bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Combine equal keys, send the first ones by bucket and report the others as later copies."""
    order, first = _sorted_firsts(columns, 2)
    columns, bucket = [c[order] for c in columns], bucket[order]
    rows = []
    if not first.all():
        rows.append({"bucket": -1, "kind": LATER} | _packed([c[~first] for c in columns]))
    columns, bucket = [c[first] for c in columns], bucket[first]
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for own in np.split(order, edges[1:]):
        packed = _packed([c[own] for c in columns])
        rows.append({"bucket": int(bucket[own[0]]), "kind": ENTRIES} | packed)
    for row in rows:
        row["sha"] = None
        # Later copies need no sorting with others and go anywhere.
        row["bucket"] = row["bucket"] if row["bucket"] >= 0 else row["base_row"] % 1_000_003
        yield pa.RecordBatch.from_pylist([row], _SENT_ARROW)


def _read(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in chunks(batches, "_text"):
            rows = piece.column("_row").to_pylist()
            ids = piece.column("_id").fill_null(NO_ID).to_pylist()
            yield pa.RecordBatch.from_pylist(
                [
                    {"bucket": r % 1_000_003, "base_id": i, "base_row": r, "kind": DOCUMENT, "sha": s}
                    for r, i, s in zip(rows, ids, piece.column("_digest").to_pylist(), strict=True)
                ],
                _SENT_ARROW,
            )
            by_row = dict(zip(rows, ids, strict=True))
            texts = piece.column("_text").cast(pa.binary()).to_pylist()
            for owner, offset, data, ends in _parts(rows, texts):
                first, count, trigger, prints = parse(data, ends)
                text = np.searchsorted(ends, first, "right")
                row = owner[text] if len(first) else np.zeros(0, np.int64)
                begin = (ends - np.diff(ends, prepend=0))[text]
                document = np.array([by_row[r] for r in owner.tolist()], np.int64)[text]
                place = first - begin + offset[text]
                held.append([trigger, prints, document, row, place, count])
                size += len(first)
            if size >= GATHERED:
                columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                yield from _send(columns, (columns[0] % _U(buckets)).astype(np.int64))
                held, size = [], 0
        if size:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            yield from _send(columns, (columns[0] % _U(buckets)).astype(np.int64))

    return run


_FOUND = "kind int, bucket int, trigger long, id long, row long, place long, strings long, sha binary"
_FOUND_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("bucket", pa.int32()),
        ("trigger", pa.int64()),
        ("id", pa.int64()),
        ("row", pa.int64()),
        ("place", pa.int64()),
        ("strings", pa.int64()),
        ("sha", pa.binary()),
    ]
)


def _found(kind: int, bucket: int | np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    n = len(columns[0])
    return pa.table(
        [
            pa.array(np.full(n, kind, np.int32)),
            pa.array(np.broadcast_to(np.asarray(bucket, np.int32), n)),
            pa.array(columns[0].view(np.int64)),
            pa.array(columns[2]),
            pa.array(columns[3]),
            pa.array(columns[4].astype(np.int64)),
            pa.array(columns[5].astype(np.int64)),
            pa.nulls(n, pa.binary()),
        ],
        schema=_FOUND_ARROW,
    )


def _documents(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(
        [
            {"kind": DOCUMENT, "id": r["base_id"], "row": r["base_row"], "sha": r["sha"]}
            for r in rows
        ],
        _FOUND_ARROW,
    )


def _sort_parse(table: pa.Table, hot: int) -> pa.Table:
    rows = table.to_pylist()
    out = [_documents([r for r in rows if r["kind"] == DOCUMENT])]
    known = [r for r in rows if r["kind"] == LATER]
    if known:
        out.append(_found(LATER, 0, _unpacked(known)))
    sent = [r for r in rows if r["kind"] == ENTRIES]
    if sent:
        columns = _unpacked(sent)
        order, first = _sorted_firsts(columns, 2)
        columns = [np.ascontiguousarray(c[order]) for c in columns]
        out.append(_found(LATER, 0, [c[~first] for c in columns]))
        heads = [c[first] for c in columns]
        same = heads[0][1:] == heads[0][:-1]
        many = (np.concatenate([[False], same]) | np.concatenate([same, [False]]))[: len(heads[0])]
        borders = [c[many] for c in heads]
        _, kind, size = np.unique(borders[0], return_inverse=True, return_counts=True)
        bucket = np.where(size[kind] > hot, -1, sent[0]["bucket"]) if len(kind) else 0
        out.append(_found(BORDER, bucket, borders))
    return pa.concat_tables(out)


def _numbered(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each entry, ``count`` of them."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _strings(buckets: int):
    """What the borders cover: stretches of text to the buckets of their triggers, or, of a hot
    trigger, the fingerprints of all its strings to buckets of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches, hot, size = [], [], 0

        def send():
            if stretches:
                columns = [np.array(c, np.int64) for c in list(zip(*stretches))[:5]]
                own = [s[5] for s in stretches]
                order = np.argsort(columns[0], kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(columns[0][order])) + 1):
                    zero = np.zeros(len(group), np.uint64)
                    row = _packed([zero, zero, *[c[group] for c in columns[1:]]])
                    row |= {"bucket": int(columns[0][group[0]]), "kind": STRETCHES}
                    row["sha"] = b"".join(own[i] for i in group.tolist())
                    yield pa.RecordBatch.from_pylist([row], _SENT_ARROW)
            if hot:
                columns = [np.concatenate(c) for c in zip(*hot, strict=True)]
                yield from _send(columns, (columns[0] % _U(buckets)).astype(np.int64))

        for piece in chunks(batches, "_text"):
            for document in piece.to_pylist():
                text = document["_text"].encode()
                where = document["_order"], document["_row"]
                for b in document["_borders"]:
                    own = text[b["place"] : b["place"] + b["strings"] + LENGTH - 1]
                    if b["bucket"] >= 0:
                        stretches.append((b["bucket"], *where, b["place"], b["strings"], own))
                        size += 10
                        continue
                    columns = [np.array([x]) for x in (*where, b["place"], b["strings"])]
                    hot.append(_told(columns, own))
                    size += b["strings"]
            if size >= GATHERED:
                yield from send()
                stretches, hot, size = [], [], 0
        yield from send()

    return run


def _told(columns: list[np.ndarray], data: bytes) -> list[np.ndarray]:
    """Every string of some stretches: two fingerprints, document id, row, place, one string."""
    order, row, place, count = columns
    data = np.frombuffer(data, np.uint8)
    length = count + LENGTH - 1
    first = _numbered(np.cumsum(length) - length, count)
    prints = [Rolled(data, which).of(first, first + LENGTH) for which in (0, 1)]
    where = [np.repeat(order, count), np.repeat(row, count), _numbered(place, count)]
    return [*prints, *where, np.ones(len(first), np.int64)]


def _runs(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Strings that start at consecutive places of a document, as one row each."""
    order = np.lexsort((columns[4], columns[3]))
    row, place = columns[3][order], columns[4][order].astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(row)]]))
    zero = np.zeros(len(at), np.uint64)
    return [zero, zero, zero.view(np.int64), row[at], place[at], count]


def _sort_strings(key, table):
    rows = table.to_pylist()
    out = [_found(LATER, 0, _runs(_unpacked([r]))) for r in rows if r["kind"] == LATER]
    told = [
        _told([c.astype(np.int64) for c in _unpacked([r])[2:]], r["sha"])
        for r in rows
        if r["kind"] == STRETCHES
    ]
    sent = [r for r in rows if r["kind"] == ENTRIES]
    if sent:
        told.append(_unpacked(sent))
    if told:
        columns = [np.concatenate(c) for c in zip(*told, strict=True)]
        order, first = _sorted_firsts(columns, 2)
        out.append(_found(LATER, 0, _runs([c[order][~first] for c in columns])))
    return pa.concat_tables(out)


def repeated_strings(docs: DataFrame, id_col: str, text_col: str, hot: int) -> DataFrame:
    """_key, _digest, _copy of documents with repeated strings, and _starts: (place, strings)."""
    spark = docs.sparkSession
    parts = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        digest(text_col).alias("_digest"),
        text_or_empty(text_col).alias("_text"),
    )
    sent = rows.mapInArrow(_read(4 * parts), _SENT)
    parsed = hand_over(sent.groupBy("bucket").applyInArrow(lambda t: _sort_parse(t, hot), _FOUND), "parse")
    ids = F.when(F.col("id") != NO_ID, F.col("id"))
    documents = parsed.where(F.col("kind") == DOCUMENT).select(
        F.col("row").alias("_row"), ids.alias("_id"), F.col("sha").alias("_digest")
    )
    documents = hand_over(
        numbered_copies(documents.withColumn("_key", id_key("_id"))), "documents"
    )
    borders = (
        parsed.where(F.col("kind") == BORDER)
        .groupBy("row")
        .agg(F.collect_list(F.struct("place", "strings", "bucket")).alias("_borders"))
    )
    asked = hand_over(
        documents.join(borders.withColumnRenamed("row", "_row"), "_row").select(
            "_row",
            F.coalesce("_id", F.lit(NO_ID)).alias("_order"),
            "_key",
            "_digest",
            "_copy",
            "_borders",
        ),
        "borders",
    )
    texts = with_results(docs, asked, id_col, text_col).where(F.col("_borders").isNotNull())
    strings = texts.select("_row", "_order", "_text", "_borders").mapInArrow(_strings(4 * parts), _SENT)
    told = hand_over(strings.groupBy("bucket").applyInArrow(_sort_strings, _FOUND), "strings")
    later = parsed.where(F.col("kind") == LATER).select("row", "place", "strings")
    starts = (
        later.unionByName(told.select("row", "place", "strings"))
        .groupBy(F.col("row").alias("_row"))
        .agg(F.collect_list(F.struct("place", "strings")).alias("_starts"))
    )
    found = documents.join(starts, "_row").select("_key", "_digest", "_copy", "_starts")
    return hand_over(found, "starts")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in chunks(batches, "_text"):
        removed, spans, sha, where = [], [], [], []
        texts = piece.column("_text").cast(pa.binary()).to_pylist()
        for text, starts in zip(texts, piece.column("_starts").to_pylist(), strict=True):
            own: list[tuple[int, int]] = []
            for s in sorted(starts or [], key=lambda s: s["place"]):
                first, last = s["place"], s["place"] + s["strings"] + LENGTH - 1
                if own and first <= own[-1][1]:
                    own[-1] = own[-1][0], max(own[-1][1], last)
                else:
                    own.append((first, last))
            kept, at = hashlib.sha256(), 0
            for first, last in own:
                kept.update(text[at:first])
                at = last
            kept.update(text[at:])
            removed.append(sum(b - a for a, b in own))
            spans.append(len(own))
            sha.append(kept.hexdigest())
            where.append([{"start": a, "end": b} for a, b in own])
        sizes = [len(t) for t in texts]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("_id"),
                *[pa.array(v, pa.int64()) for v in (sizes, removed, spans)],
                pa.array(sha, pa.string()),
                pa.array(where, kind),
            ],
            ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes (null: empty), matches never cross documents. Every byte is removed that
    a string of 100 bytes covers which also starts earlier: in a document with a smaller id, or
    further ahead in the same one. Strings are judged on the input. spans are the longest removed
    runs (start, end). Null ids sort first; rows that share an id follow one another as read; ids
    are integers. Texts under 100 bytes stay whole.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = with_results(docs, repeated_strings(docs, id_col, text_col, hot), id_col, text_col)
    schema = (
        f"_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,end:long>>"
    )
    cut = rows.select("_id", "_text", "_starts").mapInArrow(_cut, schema)
    return cut.withColumnRenamed("_id", id_col)
