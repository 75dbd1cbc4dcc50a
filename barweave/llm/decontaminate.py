"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, verification.

A document is compared with every benchmark item in windows of the item's own number of words.
The SimHash of a window and that of an item differ in few bits when their weighted shingles are
similar. The search is exact within its radius: fingerprints are cut into four blocks of 16 bits,
and two fingerprints within the radius differ in at most a quarter of it in some block, so every
item is entered under all block values that near. What is found is verified by the exact weighted
Jaccard similarity of the shingles (sum of the smaller over sum of the greater counts).

Windows that cannot be similar enough are not fingerprinted: if fewer than ``level`` of a window's
shingles occur in any item at all, its similarity with each item is below ``level``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import chunks, fresh, text_or_empty
from barweave.llm.words import SHINGLE, counted, mix, shingle_hashes, word_hashes

SIMILARITY = 0.8
#: Bits in which fingerprints may differ. Weighted similarity 0.8 is an angle of about 0.48, so
#: 9.7 of 64 bits are expected to differ with a deviation of 2.9; this is 3.2 deviations more.
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
#: Text of the items in one index; of more, several indexes are used one after another.
INDEX_BYTES = 2_000_000
FOUND = "array<struct<item_id:long,start:long,words:long,similarity:double>>"


def simhash(shingles: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of shingles; each occurrence counts."""
    bits = np.unpackbits(mix(shingles, 31).view(np.uint8).reshape(*shingles.shape, 8), axis=-1)
    votes = 2 * bits.sum(axis=1, dtype=np.int32) - shingles.shape[1]
    return np.packbits(votes > 0, axis=-1).view(np.uint64)[:, 0]


@lru_cache(maxsize=1)
def _masks(radius: int) -> np.ndarray:
    """All block values with at most ``radius`` bits."""
    masks = [0]
    for n in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in itertools.combinations(range(BLOCK_BITS), n)]
    return np.array(masks, np.int64)


@dataclass
class Items:
    """Items with shingles of one size; ``tables`` are built where they are used."""

    size: int
    ids: np.ndarray
    words: np.ndarray
    prints: np.ndarray
    shingles: list[np.ndarray]

    def __post_init__(self):
        self.known = np.unique(np.concatenate(self.shingles))
        self.sets = [counted(s, np.zeros(len(s), np.int64))[::2] for s in self.shingles]
        self.tables = None

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``prints``, item) of all pairs within the radius."""
        if self.tables is None:
            masks, self.tables = _masks(RADIUS // BLOCKS), []
            for b in range(BLOCKS):
                key = (self.prints >> np.uint64(BLOCK_BITS * b)).astype(np.int64) & 0xFFFF
                entries = (key[:, None] ^ masks).ravel()
                order = np.argsort(entries, kind="stable")
                starts = np.searchsorted(entries[order], np.arange(2**BLOCK_BITS + 1))
                self.tables.append((starts, (order // len(masks)).astype(np.int32)))
        pairs = []
        for b, (starts, item) in enumerate(self.tables):
            key = (prints >> np.uint64(BLOCK_BITS * b)).astype(np.int64) & 0xFFFF
            count = starts[key + 1] - starts[key]
            who = np.repeat(np.arange(len(prints)), count)
            place = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            found = item[starts[key][who] + place]
            close = np.bitwise_count(prints[who] ^ self.prints[found]) <= RADIUS
            pairs.append(who[close] * len(self.ids) + found[close])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.ids), both % len(self.ids)


def index_items(ids: list[int], texts: list[str]) -> list[Items]:
    """Items by the size of their shingles: five words, or all words of a shorter item.

    Items without words match nothing.
    """
    words, doc = word_hashes(texts)
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    count = np.diff(starts)
    result = []
    for size in sorted(set(np.minimum(count[count > 0], SHINGLE).tolist())):
        own = np.flatnonzero(np.minimum(count, SHINGLE) == size)
        shingles = []
        for i in own.tolist():
            w = words[starts[i] : starts[i + 1]]
            shingles.append(shingle_hashes(w, np.zeros(len(w), np.int64), size, short=False)[0])
        prints = np.array([simhash(s[None, :])[0] for s in shingles], np.uint64)
        result.append(Items(size, np.array(ids, np.int64)[own], count[own], prints, shingles))
    return result


def _weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)[1:]
    least = int(np.minimum(a[1][at], b[1][bt]).sum())
    return least / (int(a[1].sum()) + int(b[1].sum()) - least)


def _match(items: Items, texts: list[str], level: float) -> dict[int, dict[int, tuple]]:
    """Per text the best window of each matching item: (similarity, -start, words)."""
    words, doc = word_hashes(texts)
    shingles, owner, at = shingle_hashes(words, doc, items.size, short=False)
    found: dict[int, dict[int, tuple]] = {}
    if not len(shingles):
        return found
    place = np.minimum(np.searchsorted(items.known, shingles), len(items.known) - 1)
    hit = items.known[place] == shingles
    # Only texts with a hit go on.
    some = np.zeros(len(texts), bool)
    some[owner[hit]] = True
    on = some[owner]
    shingles, owner, at, hit = shingles[on], owner[on], at[on], hit[on]
    if not len(shingles):
        return found
    first = np.searchsorted(doc, np.arange(len(texts)))
    sums = np.concatenate([[0], np.cumsum(hit)])
    ends = np.searchsorted(owner, owner, "right")
    opens = np.searchsorted(owner, owner, "left")
    here = np.arange(len(shingles))
    for length in np.unique(items.words).tolist():
        n = length - items.size + 1
        # A text that is shorter than the item is one window.
        stop = np.where((here == opens) & (ends - here < n), ends, here + n)
        fits = np.flatnonzero(stop <= ends)
        held = sums[stop[fits]] - sums[fits]
        fits = fits[held >= level * n - 1e-9]
        for width in np.unique(stop[fits] - fits).tolist():
            own = fits[stop[fits] - fits == width]
            for cut in range(0, len(own), 2000):
                starts = own[cut : cut + 2000]
                rows = shingles[starts[:, None] + np.arange(width)]
                who, item = items.near(simhash(rows))
                right = items.words[item] == length
                for w, i in zip(who[right].tolist(), item[right].tolist(), strict=True):
                    window = counted(rows[w], np.zeros(width, np.int64))[::2]
                    value = _weighted_jaccard(window, items.sets[i])
                    if value >= level:
                        s = int(starts[w])
                        text = int(owner[s])
                        best = (value, -int(at[s] - first[text]), width + items.size - 1)
                        mine = found.setdefault(text, {})
                        key = int(items.ids[i])
                        mine[key] = max(best, mine.get(key, best))
    return found


def matches_column(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    level: float = SIMILARITY,
) -> Column:
    """For rows of ``docs``: the items that each whole text contains, by id.

    An entry has item_id, start (words before the window), words and similarity of the best, then
    first window. Null and empty texts contain nothing; items with a null id or text are left out.
    Items are read in slices of about two megabytes of text, one index and pass of the tasks for
    each, so no index grows with the benchmark.
    """
    known = items.select(
        F.col(f"`{item_id}`").cast("long").alias("_item"), F.col(f"`{item_text}`").alias("_text")
    ).dropna()
    size = known.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    slices = size // INDEX_BYTES + 1
    context, columns = docs.sparkSession.sparkContext, []
    for n in range(slices):
        part = known.where(F.pmod(F.xxhash64("_item", "_text"), F.lit(slices)) == n).collect()
        shared = context.broadcast(index_items([r[0] for r in part], [r[1] for r in part]))
        columns.append(_search(shared, level)(text_or_empty(text_col)))
    return columns[0] if slices == 1 else F.concat(*columns)


def _search(shared, level: float):
    @F.pandas_udf(FOUND)
    def search(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for part in parts:
            result, base = [[] for _ in range(len(part))], 0
            batch = pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"])
            for piece in chunks([batch]):
                texts = piece.column("text").to_pylist()
                for items in index:
                    for text, own in _match(items, texts, level).items():
                        result[base + text] += [
                            {"item_id": i, "start": -s, "words": n, "similarity": v}
                            for i, (v, s, n) in sorted(own.items())
                        ]
                base += len(texts)
            yield pd.Series(result)

    return search


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document and item it contains: id, item_id, start, words, similarity."""
    name = fresh(docs, "_found")
    rows = docs.withColumn(name, matches_column(docs, items, text_col))
    return rows.select(F.col(f"`{id_col}`"), F.inline(name))
