"""Runs of words that repeat with a period, by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at
least ``least`` words and ``POWER`` periods that no neighbouring word extends. Equal words mean
equal bytes; all comparisons that decide a run are made on the words themselves.

* Periods up to ``DIRECT``: every lag is scanned.
* Longer ones: a scale covers the periods in (v, w]. Its grams are w words long, so that inside a
  run two grams are equal only at multiples of the period. In any 2v - w + 3 neighbouring grams the
  one of least hash is a minimizer. A run of three periods is long enough for some such window and
  the one a period later, hence it holds two equal minimizers a period apart with none between:
  each pair of neighbouring equal minimizers whose distance the scale covers is extended both ways.
* A text without any two equal minimizers at a scale repeats nothing long enough for a longer
  period, and leaves the search.

Work is proportional to the words for each scale a text takes part in, and the scales grow by half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import chunks
from barweave.llm.words import mix

#: Words of a run, and periods in it, at least. The scales above rest on three periods.
LEAST, POWER = 24, 3
#: Periods up to this are found by comparing all words so far apart.
DIRECT = 8
#: Text bytes that a task searches at a time; one text stays whole.
PIECE_BYTES = 1_000_000

_STEP = np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Found:
    """Runs in a flat row of words: text, first word in that text, words, period."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def names(texts: list[list[bytes]]) -> np.ndarray:
    """For each word of all texts the place of its first occurrence in its text: equal words of a
    text, and no others, have equal names."""
    parts, base = [], 0
    for words in texts:
        first: dict[bytes, int] = {}
        n = len(words)
        parts.append(np.fromiter(map(first.setdefault, words, range(base, base + n)), np.int64, n))
        base += n
    return np.concatenate([np.zeros(0, np.int64), *parts])


def find(texts: list[list[bytes]], least: int = LEAST) -> Found:
    """All runs of each text, a list of words, by text and start."""
    sizes = np.array([len(t) for t in texts], np.int64)
    whole = names(texts)
    doc = np.repeat(np.arange(len(texts)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    rows = [np.zeros((0, 4), np.int64)]
    for lag in range(1, DIRECT + 1):
        a, b = _stretches(whole[:-lag] == whole[lag:], max(least, POWER * lag) - lag)
        if a.size:
            rows.append(np.stack([doc[a], a - first[doc[a]], b - a + lag, np.full(a.size, lag)], 1))
    rows += _by_scales(whole, doc, sizes, least)
    found = np.concatenate(rows)
    # The same words under a multiple of their period count once, under the least.
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[new]
    found = found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]
    return Found(*found.T)


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretches of True that have ``least`` entries or more."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    a, b = edge[::2], edge[1::2]
    long = b - a >= least
    return a[long], b[long]


def _by_scales(whole, doc, sizes, least) -> Iterator[np.ndarray]:
    words, owner = whole, doc
    reach, width = DIRECT, DIRECT * 3 // 2
    alive = sizes >= POWER * (reach + 1)
    grams = _Grams(words)
    while alive.any():
        use = alive[owner]
        if np.count_nonzero(use) < 0.7 * len(words):
            words, owner = words[use], owner[use]
            grams = _Grams(words)
        i, j = _pairs(grams.of(width), 2 * reach - width + 3)
        same = owner[i] == owner[j]
        i, j = i[same], j[same]
        seen = np.zeros(len(sizes), bool)
        seen[owner[i]] = True
        fits = (j - i > reach) & (j - i <= width)
        begin = np.searchsorted(owner, np.arange(len(sizes)))
        for s, e, d in _extended(words, i[fits], (j - i)[fits]):
            if e - s >= max(least, POWER * d):
                yield np.array([[owner[s], s - begin[owner[s]], e - s, d]])
        reach, width = width, width * 3 // 2
        alive &= seen & (sizes >= POWER * (reach + 1))


class _Grams:
    """Hashes of the grams of any length, from those of half the length.

    Each step mixes the bits, so no pattern of words makes different grams equal, as it can with
    sums of powers.
    """

    def __init__(self, words: np.ndarray):
        self._size, self._hash = 1, mix(words.astype(np.uint64), 11)

    def of(self, width: int) -> np.ndarray:
        while self._size * 2 <= width:
            self._hash = self._joined(self._size)
            self._size *= 2
        return self._joined(width - self._size) if width > self._size else self._hash

    def _joined(self, shift: int) -> np.ndarray:
        left, right = self._hash[:-shift], self._hash[shift:]
        return mix(left * _STEP + right, 12) if left.size else left


def _pairs(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of neighbouring equal minimizers of windows of so many hashes."""
    if len(hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lowest = _over(np.minimum, hashes, window)
    # A hash is a minimizer if it is the least of a window it belongs to.
    padded = np.concatenate([np.zeros(window - 1, np.uint64), lowest, np.zeros(window - 1, np.uint64)])
    at = np.flatnonzero(_over(np.maximum, padded, window) == hashes)
    at = at[np.argsort(hashes[at], kind="stable")]
    equal = hashes[at[1:]] == hashes[at[:-1]]
    return at[:-1][equal], at[1:][equal]


def _over(least_or_most, values: np.ndarray, window: int) -> np.ndarray:
    """The least or greatest of each ``window`` neighbouring values, in steps that double."""
    size = 1
    while size < window:
        step = min(size, window - size)
        values = least_or_most(values[:-step], values[step:])
        size += step
    return values


def _extended(words: np.ndarray, at: np.ndarray, lag: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The stretch around each place whose words equal those ``lag`` later, once for each."""
    order = np.lexsort((at, lag))
    known = (0, 0)
    for i, d in zip(at[order].tolist(), lag[order].tolist()):
        if d == known[0] and i < known[1]:
            continue
        end, size = i, 64
        while end + d < len(words):
            differ = words[end : end + size][: len(words) - end - d] != words[end + d : end + d + size]
            if differ.any():
                end += int(differ.argmax())
                break
            end += len(differ)
            size *= 2
        start, size = i, 64
        while start > 0:
            low = max(0, start - size)
            differ = words[low:start] != words[low + d : start + d]
            if differ.any():
                start -= int(differ[::-1].argmax())
                break
            start = low
            size *= 2
        known = (d, end)
        yield start, end + d, d


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """(id, n_words, runs array<start, length, period> by start then period, collapsed) of each row.

    Words are what lies between blanks, tabs and line ends. ``collapsed`` joins by one blank the
    words that stay when of each run only the first period is kept. A null text counts as empty:
    no words, no runs, an empty text. Repeated rows and ids, also null ones, come out once for each
    row; columns other than the two named are not read, so their names cannot clash. Every text is
    searched whole in one task, which needs memory for its words.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text", PIECE_BYTES):
            texts = [(t or b"").split() for t in pc.cast(piece.column("text"), pa.binary()).to_pylist()]
            found = find(texts, least)
            ends = np.searchsorted(found.doc, np.arange(len(texts) + 1))
            kept = []
            for words, a, b in zip(texts, ends, ends[1:]):
                if a < b:
                    stays = np.ones(len(words), bool)
                    for k in range(a, b):
                        start = found.start[k]
                        stays[start + found.period[k] : start + found.length[k]] = False
                    words = [words[i] for i in np.flatnonzero(stays)]
                kept.append(b" ".join(words))
            runs = pa.StructArray.from_arrays(
                [pa.array(x) for x in (found.start, found.length, found.period)],
                ["start", "length", "period"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                    pc.cast(pa.array(kept, pa.binary()), pa.string()),
                ],
                [id_col, "n_words", "runs", "collapsed"],
            )

    read = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [
            T.StructField(id_col, read.schema["_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return read.mapInArrow(search, schema)
