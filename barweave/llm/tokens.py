"""Token ids of whole texts by a public tokenizer, computed in tasks.

A text whose only white space is the space and the line feed and whose letters are plain Latin
ones is cut where the tokenizer itself always starts a new word, and words are looked up in a
bounded memory of each worker; every other text goes through the library in one call. Both give
the library's ids, which tests compare.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np

#: Words that a worker remembers; when full, it starts anew.
MEMORY_WORDS = 600_000

# A text with one of these is not cut: characters above Latin letters may compose over a cut, other
# white space may join a run of it, raised digits and fractions belong to numbers, and one capital
# turns into two characters.
_ODD = re.compile("[^\x00-˿]|[^\\S \n]|[²³¹¼-¾İ]|<\\|")
# Among plain ASCII texts these tell the same.
_ODD_ASCII = [*"\t\v\f\r\x1c\x1d\x1e\x1f", "<|"]
_LETTERS = r"[^\W\d_]+"
_REST = r"(?:[^\w \n]|[\d_])[^ \n]*"


def _odd(text: str) -> bool:
    if text.isascii():
        return any(x in text for x in _ODD_ASCII)
    return _ODD.search(text) is not None


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _visible_bytes() -> dict[int, str]:
    """Byte-level BPE writes each byte as one printable character; the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Encodes texts; ``words`` tells that the tokenizer drops white space and lowers case."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        plan = json.loads(self.tokenizer.to_str())
        self.words = plan["normalizer"] is not None
        self.size = self.tokenizer.get_vocab_size()
        self._model = self.tokenizer.model
        self._table = str.maketrans(_visible_bytes())
        self._memory: dict[str, bytes] = {}
        self._cut = re.compile(
            f"{_LETTERS}|{_REST}"
            if self.words
            else rf" ?{_LETTERS}| ?{_REST}|[ \n]+(?![^ \n])|[ \n]+"
        )

    def _direct(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def _learn(self, words: set[str]) -> None:
        rest, cut = [], []
        memory, tokenize = self._memory, self._model.tokenize
        for word in words:
            letters = word.isalpha() if self.words else word.lstrip(" ").isalpha()
            if letters and self.words and word.isascii():
                memory[word] = _packed([t.id for t in tokenize(word.lower())])
            elif letters and (word.isascii() or max(word) <= "\xff"):
                seen = (word.lower() if self.words else word).encode().decode("latin-1")
                memory[word] = _packed([t.id for t in tokenize(seen.translate(self._table))])
            elif self.words and len(parts := self._cut.findall(word)) > 1:
                cut.append((word, *parts))
            else:
                rest.append(word)
        if rest:
            self._memory.update(zip(rest, self._direct(rest), strict=True))
        if cut:
            new = {p for _, *parts in cut for p in parts if p not in memory}
            if new:
                self._learn(new)
            for word, first, second in cut:
                memory[word] = memory[first] + memory[second]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """An array of unsigned 32-bit ids for each text."""
        if len(self._memory) > MEMORY_WORDS:
            self._memory.clear()
        # Without white space, what stands between it is remembered whole.
        pieces = str.split if self.words else self._cut.findall
        cut = [None if _odd(t) else pieces(t) for t in texts]
        self._learn(set().union(*[c for c in cut if c]).difference(self._memory))
        odd = iter(self._direct([t for t, c in zip(texts, cut, strict=True) if c is None]))
        get = self._memory.__getitem__
        raw = [next(odd) if c is None else b"".join(map(get, c)) for c in cut]
        return [np.frombuffer(r, np.uint32) for r in raw]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process, kept between its tasks."""
    return Encoder(path)
