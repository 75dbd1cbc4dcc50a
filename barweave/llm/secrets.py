"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests finds random.

Three patterns give the base spans. Beside them, every long run of key characters is a candidate.
Its encoding (decimal, hexadecimal, base32, base36, base62, base64) is inferred from its
characters; then three tests ask whether it could be uniform noise in that encoding: chi-squared
of the alphabet's cells, runs above and below the middle, serial correlation of neighbours. A
candidate must pass all three. Passing is easy for short strings, so each also needs evidence
against ordinary writing of its own length; Benjamini and Hochberg's rule over all candidates of
the corpus controls the part of false finds.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import text_or_empty
from barweave.storage import hand_over

# The base patterns, their kinds in order, and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Candidates: runs of key characters of at least this length with a digit among them or mixed case.
LEAST_RANDOM = 20
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_SIDES = re.compile(r"[^=]+(?:=+\Z)?")
_CUTS = [re.compile(f"[^{x}]{{20,}}") for x in ("_-", "/+", "/_-")]

# The alphabets, smallest first.
ENCODINGS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_PLACES = [(name, {c: i for i, c in enumerate(chars)}) for name, chars in ENCODINGS]

#: Level of each randomness test, and of the false finds among all finds.
TEST_LEVEL = 0.001
FALSE_FINDS = 0.01
#: How far writing is from uniform over its own alphabet: A * sum(q^2) - 1 of letters in prose is
#: above 0.7; words, numbers and paths in a wider alphabet are further away.
WRITING = 0.7


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns in code points, leftmost and apart for each kind."""
    found = []
    folded = text.casefold()
    if any(k in folded for k in _KEYWORDS):
        found += [
            (*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN
        ]
    if "AKIA" in text:
        found += [
            (*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS
        ]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the cube-root approximation."""
    if x <= 0:
        return 1.0
    s = 2 / (9 * df)
    return _normal_tail(((x / df) ** (1 / 3) - (1 - s)) / math.sqrt(s))


def encoding(token: str) -> tuple[str, np.ndarray] | None:
    """The smallest alphabet that holds every character, and the characters' places in it."""
    body = token.rstrip("=")
    for name, place in _PLACES:
        if all(c in place for c in body):
            return name, np.array([place[c] for c in body])
    return None


def battery(values: np.ndarray, size: int) -> tuple[float, float, float]:
    """p-values of uniformity (chi-squared), runs and serial correlation under uniform noise."""
    n = len(values)
    cells = max(2, min(size, n // 5))
    counts = np.bincount(values * cells // size, minlength=cells)
    # Cells may hold unequal parts of the alphabet.
    share = np.bincount(np.arange(size) * cells // size, minlength=cells) / size
    chi = float((((counts - n * share) ** 2) / (n * share)).sum())
    high = values >= size / 2
    runs, ones = 1 + int((high[1:] != high[:-1]).sum()), int(high.sum())
    mean = 1 + 2 * ones * (n - ones) / n
    var = (mean - 1) * (mean - 2) / max(1, n - 1)
    run_p = 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0.0
    spread = values - values.mean()
    power = float((spread**2).sum())
    serial = float((spread[1:] * spread[:-1]).sum()) / power if power else 1.0
    serial_p = 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n)) if power else 0.0
    return _chi2_tail(chi, cells - 1), run_p, serial_p


def against_writing(token: str) -> float:
    """p-value of the hypothesis that the string is writing: how few repeated characters it has.

    Under it the chi-squared statistic over the characters' own classes (a digit, a small or a
    capital letter) has a noncentral law whose centre grows with the length, so the same evenness
    weighs more in a longer string. Few digits among letters, or the reverse, is how words with a
    number look, and weighs against randomness too.
    """
    classes = ([c for c in token if c.isdigit()], 10), (
        [c for c in token if c.islower()],
        26,
    ), ([c for c in token if c.isupper()], 26)
    stat = mean = var = 0.0
    for own, size in classes:
        n = len(own)
        if n < 2:
            continue
        counts = np.unique(np.array(own), return_counts=True)[1]
        stat += float((counts.astype(float) ** 2).sum()) * size / n - n
        mean += size - 1 + n * WRITING
        var += 2 * (size - 1) + 4 * n * WRITING
    changes = sum(
        (a.isdigit(), a.isupper()) != (b.isdigit(), b.isupper())
        for a, b in zip(token, token[1:], strict=False)
    )
    # Writing changes its class at the starts of words and numbers only: at most one place in five.
    n = len(token) - 1
    jump = (changes - n / 5) / math.sqrt(n * 0.16)
    even = (mean - stat) / math.sqrt(var) if var else 0.0
    return _normal_tail((even + jump) / math.sqrt(2))


def _known(token: str) -> tuple[str, np.ndarray] | None:
    """The encoding of a candidate long enough to test, unless letters alone spell it as a word."""
    if token.isalpha() and (token.islower() or token[1:].islower() or token.isupper()):
        return None
    known = encoding(token)
    return known if known and len(known[1]) >= LEAST_RANDOM else None


def _tested(token: str, known: tuple[str, np.ndarray]) -> float:
    size = len(dict(ENCODINGS)[known[0]])
    return against_writing(token) if min(battery(known[1], size)) >= TEST_LEVEL else 1.0


def _least(
    cuts: dict[tuple[int, int], float], lists: list[list[tuple[int, int]]]
) -> Iterator[tuple[int, int, float]]:
    """Of spans that overlap the one of least p-value, times the number of spans it overlaps.

    The spans of a list do not overlap and are in order, so those that meet another span lie side
    by side, and all lists together are gone through a bounded number of times.
    """
    ends, gone = [[b for _, b in own] for own in lists], set()
    for a, b in sorted(cuts, key=lambda x: (cuts[x], x)):
        if (a, b) in gone:
            continue
        near = set()
        for own, last in zip(lists, ends, strict=True):
            i = bisect_right(last, a)
            while i < len(own) and own[i][0] < b:
                near.add(own[i])
                i += 1
        near -= gone
        yield a, b, min(1.0, cuts[a, b] * len(near))
        gone |= near


def random_strings(text: str) -> list[tuple[int, int, float]]:
    """(start, end, p-value against writing) of candidates that pass the battery.

    A run is cut at each '=' that is not padding at its end. Where no alphabet holds a part, it is
    cut at '-' and '_', at '/' and '+', and at '/', '-' and '_'. Of cuts that overlap, the one of
    least p-value counts, times their number, so that more ways to cut give no more false finds.
    """
    found = []
    for run in _CANDIDATE.finditer(text):
        for m in _SIDES.finditer(run[0]):
            at, token = run.start() + m.start(), m[0]
            if encoding(token) is not None:
                if known := _known(token):
                    found.append((at, at + len(token), _tested(token, known)))
                continue
            cuts, lists = {}, []
            for cut in _CUTS:
                own = []
                for c in cut.finditer(token):
                    if known := _known(c[0]):
                        cuts[c.span()] = _tested(c[0], known)
                        own.append(c.span())
                lists.append(own)
            found += [(at + a, at + b, p) for a, b, p in _least(cuts, lists)]
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, base and tested: arrays of (start, end, kind) and p-values.

    A null text counts as empty and has no spans. Repeated rows are treated one by one.
    """
    span = "struct<start:long,end:long,kind:string>"
    schema = f"doc_id long, base array<{span}>, tested array<struct<start:long,end:long,p:double>>"
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("base", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))),
            ("tested", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))),
        ]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "end", "kind"), ("start", "end", "p")
        for batch in batches:
            base, tested = [], []
            for value in batch.column("text"):
                text = value.as_py()
                base.append([dict(zip(names[0], s, strict=True)) for s in base_spans(text)])
                tested.append([dict(zip(names[1], s, strict=True)) for s in random_strings(text)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(base, kinds.field("base").type),
                    pa.array(tested, kinds.field("tested").type),
                ],
                schema=kinds,
            )

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    return rows.mapInArrow(find, schema)


def threshold(scanned: DataFrame, level: float = FALSE_FINDS) -> float:
    """Benjamini and Hochberg's limit for the p-values of all candidates.

    p-values are counted in steps of a hundredth of their logarithm, rounded up, so that a table
    of bounded size serves any number of candidates and no find rests on rounding.
    """
    steps = 100
    p = F.greatest(F.col("t.p"), F.lit(1e-300))
    rows = (
        scanned.select(F.explode("tested").alias("t"))
        .groupBy(F.ceil(F.log10(p) * steps).alias("step"))
        .agg(F.count("*").alias("n"))
        .collect()  # at most 30,001 rows
    )
    total, seen, limit = sum(r["n"] for r in rows), 0, 0.0
    for row in sorted(rows, key=lambda r: r["step"]):
        seen += row["n"]
        p_value = 10 ** (row["step"] / steps)
        if p_value <= level * seen / total:
            limit = p_value
    return limit


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and spans, an array of (start, end, kind) by start and kind.

    Kinds are assign, access, hex and random, in this order where starts are equal. Spans are in
    code points, end exclusive. Empty and null texts have none; an empty table gives no rows.
    """
    scanned = hand_over(scan(docs, id_col, text_col), "secrets")
    limit = threshold(scanned)
    more = F.transform(
        F.filter("tested", lambda t: t["p"] <= limit),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit("random").alias("kind")),
    )
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        F.concat("base", more),
        lambda s: F.struct(s["start"], F.array_position(order, s["kind"]), s["end"], s["kind"].alias("kind")),
    )
    return scanned.select(
        F.col("doc_id").alias(id_col),
        F.transform(
            F.array_sort(keyed),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        ).alias("spans"),
    )
