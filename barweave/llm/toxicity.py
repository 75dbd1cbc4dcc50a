"""Toxic texts by a factorization machine over hashed terms.

Each term has a weight and a short vector; the product of two terms' vectors is the weight of
their pair, so that an insult beside a mention of a group can count for more than both alone,
which a linear model cannot express. A model is fitted on a bounded sample of labelled rows, whose
terms are found in tasks; scoring covers every row inside the scan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import chunks, id_fold, text_or_empty
from barweave.llm.words import mix, stem_hashes
from barweave.storage import hand_over

#: Labelled rows that a fit uses at most; of more, those with the smallest hash of their id. Fewer
#: if their distinct terms are more than the second number, which bounds what the driver gets.
MOST_ROWS, MOST_ENTRIES = 20_000, 16_000_000
FACTORS = 4
BATCH = 64
#: Passes over the sample, more of them if these make fewer steps than the second number.
EPOCHS, LEAST_STEPS = 10, 2500
STEP, VECTOR_STEP = 0.3, 0.1
#: Weights shrink towards 0 by so many deviations of the gradient that a term has by chance; the
#: fold decides which. Vectors shrink by ``VECTOR_SHRINK``, since each takes part in hundreds of
#: pairs, but not below ``FLOOR``: from 0 no pair could grow.
SHRINKS, VECTOR_SHRINK, FLOOR = (0.25, 0.5, 1.0), 3.0, 1e-4
#: One learning row in so many is the inner fold. Vectors stay if they lower its loss by this part;
#: learning them ends when so many steps brought no further such part, or after the last number.
FOLD, GAIN, PATIENCE, MOST_VECTOR_STEPS = 5, 0.02, 400, 1000
#: A fold with fewer rows of a label decides nothing: the second shrinkage holds, without vectors.
LEAST_FOLD = 8
#: Terms in fewer labelled rows than this carry no weight.
LEAST_ROWS = 5
LEVEL = 0.5
#: Characters of a word's beginning that form a term of their own, for inflected words.
STEM = 5
#: Text bytes that a task cuts into terms at a time; one text stays whole.
PIECE_BYTES = 500_000


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit term, doc) of the distinct hashed words and word beginnings of each text, by doc."""
    whole, stem, doc = stem_hashes(texts, STEM)
    high, keys = np.uint64(32), doc.astype(np.uint64) << np.uint64(32)
    keys = np.unique(np.concatenate([keys | (mix(whole) >> high), keys | (mix(stem, 1) >> high)]))
    return keys.astype(np.uint32), (keys >> high).astype(np.int64)


@dataclass(frozen=True)
class Machine:
    """bias + sum of weights + sum over pairs of terms of the product of their vectors.

    Terms are places in ``weights``; ``known`` has the hashed terms in these places, sorted.
    """

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    known: np.ndarray | None = None

    def places(self, term: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, doc) of those hashed terms that the machine knows."""
        if not len(self.known):
            return np.zeros(0, np.int64), doc[:0]
        at = np.minimum(np.searchsorted(self.known, term), len(self.known) - 1)
        found = self.known[at] == term
        return at[found], doc[found]

    def score(self, term: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Probability of the positive label for ``n`` rows; a row without terms has the bias."""
        return _chance(self.raw(term, doc, n))

    def raw(self, term: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(doc, self.weights[term], minlength=n)
        pairs = np.zeros(n)
        for k in range(self.vectors.shape[1]):
            own = self.vectors[term, k].astype(np.float64)
            pairs += np.bincount(doc, own, minlength=n) ** 2
            pairs -= np.bincount(doc, own**2, minlength=n)
        return self.bias + linear + pairs / 2


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass(frozen=True)
class Batch:
    """Some rows: their labels, the distinct terms in them, and for each entry its row and which
    of these terms it is."""

    label: np.ndarray
    used: np.ndarray
    doc: np.ndarray
    which: np.ndarray


def batches_of(rows: list[np.ndarray], labels: np.ndarray, order: np.ndarray) -> list[Batch]:
    out = []
    for at in range(0, len(order), BATCH):
        own = order[at : at + BATCH]
        doc = np.repeat(np.arange(len(own), dtype=np.uint8), [len(rows[i]) for i in own])
        used, which = np.unique(np.concatenate([rows[i] for i in own]), return_inverse=True)
        # Small types: all batches are held at once.
        small = np.uint16 if len(used) <= 2**16 else np.int32
        out.append(Batch(labels[own], used.astype(np.int32), doc, which.astype(small)))
    return out


def gradients(bias: float, weights: np.ndarray, vectors: np.ndarray | None, batch: Batch):
    """(off, by bias, by weights, by vectors, sums): the mean logistic loss of a batch by its
    parameters, where ``weights`` and ``vectors`` are those of the batch's distinct terms, ``off``
    is prediction minus label and ``sums`` holds the sum of each row's vectors."""
    n, width = len(batch.label), len(batch.used)
    raw = bias + np.bincount(batch.doc, weights[batch.which], minlength=n)
    sums = None
    if vectors is not None:
        own = vectors[batch.which]
        sums = np.stack([np.bincount(batch.doc, x, minlength=n) for x in own.T], axis=1)
        squares = np.bincount(batch.doc, (vectors**2).sum(axis=1)[batch.which], minlength=n)
        raw += ((sums**2).sum(axis=1) - squares) / 2
    off = _chance(raw) - batch.label
    each = off[batch.doc]
    by_weight = np.bincount(batch.which, each, minlength=width) / n
    by_vector = None
    if vectors is not None:
        beside = [np.bincount(batch.which, each * s[batch.doc], minlength=width) for s in sums.T]
        by_vector = np.stack(beside, axis=1) / n - by_weight[:, None] * vectors
    return off, off.mean(), by_weight, by_vector, sums


class _Learner:
    """Stochastic gradient steps on the logistic loss, with a step size for each parameter."""

    def __init__(self, batches: list[Batch], df: np.ndarray, n: int, rate: float, shrink: float):
        terms = len(df)
        self.batches, self.random, self.shrink = batches, np.random.default_rng(7), shrink
        # The gradient's deviation by chance; a step changes only terms of its batch.
        chance = np.sqrt(df * rate * (1 - rate)) / n
        self.chance = chance / np.maximum(1 - (1 - np.minimum(df / n, 1)) ** min(BATCH, n), 1e-9)
        self.bias, self.weights = float(np.log(rate / (1 - rate))), np.zeros(terms)
        self.seen_b, self.seen_w = 1e-6, np.full(terms, 1e-2)
        self.vectors = self.seen_v = None
        self.spread = 0.0

    def add_vectors(self) -> None:
        shape = (len(self.weights), FACTORS)
        self.vectors, self.seen_v = self.random.normal(0, 0.01, shape), np.full(shape, 1e-2)

    def step_through(self) -> None:
        for at in self.random.permutation(len(self.batches)):
            self.step(self.batches[at])

    def step(self, batch: Batch) -> None:
        used = batch.used
        vectors = None if self.vectors is None else self.vectors[used]
        off, by_bias, by_weight, by_vector, sums = gradients(
            self.bias, self.weights[used], vectors, batch
        )
        chance = self.chance[used]
        self.seen_w[used] += by_weight**2
        rate = STEP / np.sqrt(self.seen_w[used])
        moved = self.weights[used] - rate * by_weight
        self.weights[used] = np.sign(moved) * np.maximum(np.abs(moved) - rate * self.shrink * chance, 0)
        if vectors is not None:
            # By chance a vector's gradient is that of the weight times what it is paired with.
            spread = float(np.sqrt((sums**2).mean()))
            self.spread = 0.95 * self.spread + 0.05 * spread if self.spread else spread
            self.seen_v[used] += by_vector**2
            rate = VECTOR_STEP / np.sqrt(self.seen_v[used])
            moved = vectors - rate * by_vector
            less = np.abs(moved) - rate * (VECTOR_SHRINK * self.spread * chance)[:, None]
            self.vectors[used] = np.copysign(np.maximum(less, FLOOR), moved)
        self.seen_b += by_bias**2
        self.bias -= STEP * by_bias / np.sqrt(self.seen_b)

    def machine(self) -> Machine:
        vectors = self.vectors
        if vectors is None:
            vectors = np.zeros((len(self.weights), 0))
        return Machine(self.bias, self.weights.astype(np.float32), vectors.astype(np.float32))


def _loss(learner: _Learner, batches: list[Batch]) -> float:
    """The mean logistic loss of some rows."""
    total = 0.0
    for batch in batches:
        vectors = None if learner.vectors is None else learner.vectors[batch.used]
        off = gradients(learner.bias, learner.weights[batch.used], vectors, batch)[0]
        total -= np.log1p(-np.minimum(np.abs(off), 1 - 1e-15)).sum()
    return total / max(1, sum(len(batch.label) for batch in batches))


def _passes(steps: int, batches: int) -> int:
    return -(-steps // max(1, batches))


def learn(rows: list[np.ndarray], labels: np.ndarray, terms: int | None = None) -> Machine:
    """A machine from rows of terms (places from 0 on) and labels 0 and 1, both of which occur.

    First weights alone, then weights and vectors from there. How strongly weights shrink, how long
    vectors are learned and whether they stay is decided by the loss on an inner fold of the rows;
    then the same is done with all rows.
    """
    if terms is None:
        terms = 1 + max((int(row.max()) for row in rows if len(row)), default=0)
    df = np.zeros(terms, np.int64)
    for row in rows:
        df[row] += 1  # the terms of a row are distinct
    common = df >= LEAST_ROWS
    if not common[df > 0].all():
        df = np.where(common, df, 0)
        rows = [row[common[row]] for row in rows]
    order = np.random.default_rng(7).permutation(len(rows))
    held, own = order[::FOLD], np.setdiff1d(order, order[::FOLD])
    ups, rate = labels[held].sum(), labels.mean()
    inner, fold = batches_of(rows, labels, own), batches_of(rows, labels, held)
    n, n_inner = len(rows), len(own)
    del rows  # the batches hold them
    shrink, vector_passes = SHRINKS[1], 0
    if min(ups, len(held) - ups) >= LEAST_FOLD and 0 < labels[own].mean() < 1:
        shrink, vector_passes = _decide(inner, fold, common, n_inner, labels[own].mean())
    learner = _fitted(inner + fold, df, n, rate, shrink)
    if vector_passes:
        learner.add_vectors()
        for _ in range(vector_passes):
            learner.step_through()
    return learner.machine()


def _fitted(batches: list[Batch], df: np.ndarray, n: int, rate: float, shrink: float) -> _Learner:
    learner = _Learner(batches, df, n, rate, shrink)
    for _ in range(max(EPOCHS, _passes(LEAST_STEPS, len(batches)))):
        learner.step_through()
    return learner


def _decide(inner: list[Batch], fold: list[Batch], common, n: int, rate: float) -> tuple[float, int]:
    """Shrinkage of the weights and passes for the vectors, by the loss on the fold."""
    df = np.zeros(len(common), np.int64)
    for batch in inner:
        df[batch.used] += np.bincount(batch.which, minlength=len(batch.used))
    least, shrink, learner = np.inf, SHRINKS[1], None
    for each in SHRINKS:
        tried = _fitted(inner, df, n, rate, each)
        loss = _loss(tried, fold)
        if loss < least:
            least, shrink, learner = loss, each, tried
    best, passes, best_passes = least * (1 - GAIN), 0, 0
    learner.add_vectors()
    patience = max(2, _passes(PATIENCE, len(inner)))
    most = max(EPOCHS // 2, _passes(MOST_VECTOR_STEPS, len(inner)))
    while passes < min(most, best_passes + patience):
        learner.step_through()
        passes += 1
        loss = _loss(learner, fold)
        if loss < best:
            best, best_passes = loss * (1 - GAIN), passes
    return shrink, best_passes


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_rows: int = MOST_ROWS,
) -> Machine | None:
    """A model from labelled documents, or None unless both labels occur.

    Rows of ``labels`` with a null id or label are left out; of contradicting ones, toxic wins. Of
    documents that repeat an id the one with the least digest of its text teaches. Whole texts are
    read in tasks, which also count in how many rows a term occurs; the driver gets the common
    terms of at most ``most_rows`` rows and ``MOST_ENTRIES`` entries.
    """
    known = (
        labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull())
        .groupBy("_id")
        .agg(F.max("_y").cast("long").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text", PIECE_BYTES):
            term, doc = terms_of(piece.column("text").to_pylist())
            ends = np.searchsorted(doc, np.arange(piece.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(term.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in ("_id", "digest", "label")), lists],
                ["_id", "digest", "label", "terms"],
            )

    joined = texts.join(F.broadcast(chosen), "_id")
    joined = joined.select("_id", "text", F.sha2("text", 256).alias("digest"), "label")
    kind = joined.schema["_id"].dataType.simpleString()
    found = joined.mapInArrow(cut, f"_id {kind}, digest string, label long, terms array<long>")
    rows = found.groupBy("_id").agg(F.min(F.struct("digest", "terms", "label")).alias("row"))
    rows = hand_over(
        rows.select(F.xxhash64("_id").alias("place"), "_id", "row.terms", "row.label"), "labelled"
    )
    sizes = rows.select("place", F.size("terms").alias("n")).orderBy("place").toPandas()
    within = sizes["n"].cumsum() <= MOST_ENTRIES
    if not within.all():
        rows = rows.where(F.col("place") < int(sizes["place"][~within].iloc[0]))
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
    common = counts.where(F.col("count") >= LEAST_ROWS).select("term").toPandas()
    terms = np.sort(common["term"].to_numpy().astype(np.uint32))
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(0.0, np.zeros(0), np.zeros((0, 0)), shared.value)
        for batch in batches:
            packed = []
            for row in batch.column("terms"):
                term = row.values.to_numpy().astype(np.uint32)
                at = machine.places(term, term)[0]
                packed.append(at.astype("<i4").tobytes())
            columns = [batch.column("place"), batch.column("label"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "label", "terms"])

    sent = [_sample(rows.mapInArrow(placed, "place long, label long, terms binary").toArrow())]
    if len(np.unique(sent[0][1])) < 2:
        return None
    learned = learn(*sent.pop(), len(terms))
    shared.destroy()
    pa.default_memory_pool().release_unused()  # the rows that were collected
    return replace(learned, known=terms)


def _sample(sent: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of terms and their labels in an order that does not depend on the tasks. The rows are
    views of Arrow's buffers, so that the driver has them once."""
    cells = [cell.as_buffer() for part in sent.column("terms").chunks for cell in part]
    order = np.lexsort(([zlib.crc32(cell) for cell in cells], sent.column("place").to_numpy()))
    labels = sent.column("label").to_numpy()[order].astype(float)
    return [np.frombuffer(cells[i], "<i4") for i in order], labels


def score_column(docs: DataFrame, model: Machine | None, text_col: str = "text") -> Column:
    """The probability that a text is toxic, for rows of ``docs``; without a model it is 0.

    Null and empty texts have no terms and get the model's bias. A column that depends on the text
    alone: repeated rows get the same value, and the caller names it, so that no name can clash.
    """
    if model is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = shared.value
        for part in parts:
            batch = pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"])
            found = [np.zeros(0)]
            for piece in chunks([batch], "text", PIECE_BYTES):
                term = machine.places(*terms_of(piece.column("text").to_pylist()))
                found.append(machine.score(*term, piece.num_rows))
            yield pd.Series(np.concatenate(found))

    return chance(text_or_empty(text_col))


def held_out(id_col: str = "doc_id") -> Column:
    """One row in five, by the crc32 of the id as text, never teaches a model."""
    return id_fold(id_col, 5) == 0
