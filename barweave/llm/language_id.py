"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Counts of all learning texts are summed per language and bucket in the tasks and then in a
shuffle; the logarithms form one matrix of fixed height (buckets) and one column for each language
that is broadcast. Scoring gathers the rows of a text's n-grams and adds them up in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import chunks, text_or_empty
from barweave.llm.words import codes, in_words, mix

BUCKETS = 2**16
SIZES = (1, 2, 3)
UNKNOWN = "und"
#: Languages beyond this many would make the matrix large; fitting then refuses.
MOST_LANGUAGES = 1000


def ngram_buckets(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, doc) of every character n-gram of the lower-cased letters.

    Everything but letters counts as one blank between words; n-grams reach over word ends but
    not over texts, and a blank alone is not counted. A text without letters has none.
    """
    points, starts = codes([t.lower() for t in texts])
    letter = in_words(points, letters_only=True)
    value = np.where(letter, points, 32).astype(np.uint64)
    # One blank stays of a run of them; the zero after each text always stays as its end.
    value[starts[1:] - 1] = 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts[1:] - 1] = True
    value, letter = value[keep], letter[keep]
    doc = np.searchsorted(starts, np.flatnonzero(keep), "right") - 1
    found, owner = [], []
    rolled = np.zeros(len(value), np.uint64)
    for size in range(1, max(SIZES) + 1):
        n = len(value) - size + 1
        if n <= 0:
            break
        rolled = rolled[:n] * np.uint64(0x110000) + value[size - 1 :]
        if size in SIZES:
            same = doc[:n] == doc[size - 1 :]
            some = letter[:n] if size == 1 else letter[:n] | letter[size - 1 :]
            at = np.flatnonzero(same & some)
            found.append((mix(rolled[at], size) % np.uint64(buckets)).astype(np.int64))
            owner.append(doc[at])
    return np.concatenate(found), np.concatenate(owner)


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS
) -> tuple[list[str], np.ndarray]:
    """(languages, matrix of log probabilities) from all rows with a language, whole texts.

    Add-one smoothing; the prior of a language is its part of the rows. Null texts count as empty
    and null languages are left out. Without any row the list is empty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in chunks(batches):
            langs = np.array(piece.column("lang").to_pylist(), object)
            for lang in set(langs.tolist()):
                own = np.flatnonzero(langs == lang)
                texts = piece.column("text").take(pa.array(own)).to_pylist()
                total = sums.setdefault(lang, np.zeros(buckets + 1, np.int64))
                total[:buckets] += np.bincount(ngram_buckets(texts, buckets)[0], minlength=buckets)
                total[buckets] += len(own)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                ["lang", "bucket", "n"],
            )

    known = docs.where(F.col(f"`{lang_col}`").isNotNull()).select(
        text_or_empty(text_col).alias("text"), F.col(f"`{lang_col}`").alias("lang")
    )
    sums = known.mapInArrow(count, "lang string, bucket long, n long")
    rows = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MOST_LANGUAGES} are learned")
    counts = np.zeros((buckets + 1, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[rows["bucket"].to_numpy(int), rows["lang"].map(place).to_numpy(int)] = rows["n"]
    grams, texts = counts[:buckets] + 1, counts[buckets]
    matrix = np.vstack([np.log(grams / grams.sum(axis=0)), np.log(texts / max(1, texts.sum()))])
    return languages, matrix.astype(np.float32)


def predict(
    docs: DataFrame,
    languages: list[str],
    matrix: np.ndarray,
    text_col: str = "text",
    lang_out: str = "lang_pred",
    score_out: str = "score",
) -> DataFrame:
    """Add the most probable language and its posterior probability to every row.

    A null text, one without letters and every text of an empty model get ``und`` and 0. Ties go
    to the first language in alphabetical order.
    """
    shared = docs.sparkSession.sparkContext.broadcast((languages, matrix))

    @F.pandas_udf(f"{lang_out} string, {score_out} double")
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, logs = shared.value
        labels = np.array([*names, UNKNOWN], object)
        for part in parts:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(part.fillna(""), pa.string())], ["text"]
            )
            picked, chance = [np.zeros(0, int)], [np.zeros(0)]
            for piece in chunks([batch]):
                bucket, doc = ngram_buckets(piece.column("text").to_pylist(), len(logs) - 1)
                sums = np.zeros((piece.num_rows, len(names)))
                for k in range(len(names)):
                    sums[:, k] = np.bincount(
                        doc, logs[bucket, k].astype(np.float64), minlength=piece.num_rows
                    )
                seen = np.bincount(doc, minlength=piece.num_rows) > 0
                if not names:
                    picked.append(np.zeros(piece.num_rows, int))
                    chance.append(np.zeros(piece.num_rows))
                    continue
                sums += logs[-1]
                best = sums.argmax(axis=1)
                odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                picked.append(np.where(seen, best, len(names)))
                chance.append(np.where(seen, 1 / odds.sum(axis=1), 0.0))
            yield pd.DataFrame(
                {lang_out: labels[np.concatenate(picked)], score_out: np.concatenate(chance)}
            )

    from barweave.llm.common import fresh

    both = fresh(docs, "_guess")
    return docs.withColumn(both, guess(F.col(f"`{text_col}`"))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (lang_out, score_out)],
        F.col(f"{both}.{lang_out}"),
        F.col(f"{both}.{score_out}"),
    )
