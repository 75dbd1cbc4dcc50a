"""Hashes of words and word shingles for many texts at once, in numpy.

A word is a longest run of letters, digits or underscores in the lower-cased text. All arrays of a
batch are flat; ``doc`` tells which text an entry belongs to.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SHINGLE = 5

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = _U(0xD1342543DE82EF95)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit integers (a permutation for each seed)."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a zero, and where each text starts and ends."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    joined = "\x00".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(lengths)])


@lru_cache(maxsize=2)
def _known(letters_only: bool) -> np.ndarray:
    test = str.isalpha if letters_only else (lambda c: c.isalnum() or c == "_")
    return np.fromiter((test(chr(i)) for i in range(0x10000)), bool, 0x10000)


def in_words(points: np.ndarray, letters_only: bool = False) -> np.ndarray:
    """Which code points belong to words."""
    table = _known(letters_only)
    if points.size and points.max() >= 0x10000:
        found = table[np.minimum(points, 0xFFFF)]
        far = points >= 0x10000
        kinds, which = np.unique(points[far], return_inverse=True)
        test = str.isalpha if letters_only else str.isalnum
        found[far] = np.array([test(chr(k)) for k in kinds])[which]
        return found
    return table[points]


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class _Words:
    """Where the words of some texts lie, and sums from which the hash of any stretch follows."""

    def __init__(self, texts: list[str]):
        points, starts = codes([t.lower() for t in texts])
        inside = in_words(points)
        at = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.first, self.last = at[::2], at[1::2]
        self.doc = np.searchsorted(starts, self.first, "right") - 1
        power, self._inverse = _powers(len(points))
        spread = mix(points.astype(np.uint64))
        spread *= power
        self._sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(spread, out=self._sums[1:])

    def hashes(self, prefix: int = 0) -> np.ndarray:
        """Of every word in order; with ``prefix``, of the words' first characters."""
        first = self.first
        last = np.minimum(self.last, first + prefix) if prefix else self.last
        found = (self._sums[last] - self._sums[first]) * self._inverse[first]
        return mix(found ^ ((last - first).astype(np.uint64) * _STEP), 1)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of every word, in order."""
    words = _Words(texts)
    return words.hashes(), words.doc


def stem_hashes(texts: list[str], prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, hash of the first ``prefix`` characters, doc) of every word, in order."""
    words = _Words(texts)
    return words.hashes(), words.hashes(prefix), words.doc


def shingle_hashes(
    words: np.ndarray, doc: np.ndarray, size: int = SHINGLE, short: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, doc, place of the first word) of every run of ``size`` words inside a text.

    With ``short`` a text of fewer words has one shingle of all its words.
    """
    step = [_U(pow(0xD1342543DE82EF95, i + 1, 2**64)) for i in range(size)]
    n = len(words)
    found = np.zeros(max(0, n - size + 1), np.uint64)
    for i in range(size if n >= size else 0):
        found += words[i : n - size + 1 + i] * step[i]
    whole = doc[: len(found)] == doc[size - 1 :] if n >= size else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    found, owner = mix(found[at], 2), doc[at]
    if not short or not n:
        return found, owner, at
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    few = np.flatnonzero(count < size)
    if few.size:
        extra = []
        for i in few.tolist():
            own = words[first[i] : first[i] + count[i]]
            extra.append(np.sum(own * np.array(step[: count[i]]), dtype=np.uint64))
        more = mix(np.array(extra, np.uint64) + count[few].astype(np.uint64), 3)
        found = np.concatenate([found, more])
        owner = np.concatenate([owner, doc[first[few]]])
        at = np.concatenate([at, first[few]])
        order = np.argsort(at, kind="stable")
        found, owner, at = found[order], owner[order], at[order]
    return found, owner, at


def counted(found: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, doc, count) of the distinct hashes of each text, sorted by (doc, hash)."""
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.flatnonzero(
        np.concatenate([[True], (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])])[: len(found)]
    )
    return found[new], doc[new], np.diff(np.concatenate([new, [len(found)]]))
