"""Draw the documents that look most like a target text, by hashed features and Gumbel noise.

Features are runs of one to three words, hashed into buckets. A bucket's gain is the logarithm of
how much likelier it is in the target than in the documents; the gains live in one array, and a
document's weight is the sum over its features, found in numpy. The weight plus noise that depends
on the id alone is the score, and the highest scores are drawn.

Which score is just high enough is found without sorting: in each turn random pivots are drawn, the
rows before, at and after each are counted exactly, and only the rows between the two pivots around
the wanted place go on. Then the winners alone are sorted and numbered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import chunks, running_sums
from barweave.storage import hand_over

BUCKETS = 10_000
#: Words of a feature at most.
RUN = 3
#: Documents of fewer words are scored, but not drawn.
LEAST_WORDS = 20
#: Percent of the documents with enough words that are drawn.
PERCENT = 5
SEED = 42
#: Random rows that a turn of the search compares all others with.
PIVOTS = 15
#: Text bytes that a task turns into features at a time; longer texts are cut between words.
PIECE_BYTES = 500_000

#: Bytes of words, capitals made small; all others separate words. Other code points than ASCII
#: consist of bytes from 0x80 on.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
#: Words up to this length are appended to a checksum by table.
_TABLED = 64


def _tables() -> np.ndarray:
    """[n, k, b]: the change of a crc32 whose byte k is b when n zero bytes are appended."""
    one = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    # A checksum of one byte holds the conditioning of the empty one; without it the map is linear.
    step = one ^ one[0]
    at = [(np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)]
    tables = [np.stack(at)]
    for _ in range(_TABLED + 1):
        now = tables[-1]
        tables.append(step[now & np.uint32(255)] ^ (now >> np.uint32(8)))
    return np.stack(tables)


_APPEND = _tables()
_BLANK = np.uint32(zlib.crc32(b" "))


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksum's part in that of a text with ``length`` more bytes."""
    out = _APPEND[length, 0, crc & np.uint32(255)]
    for k in range(1, 4):
        out ^= _APPEND[length, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def words_of(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, about ``PIECE_BYTES`` at a time: (words, how many of them were in the
    piece before). The last words of a piece begin the next, so that no run is lost."""
    text = text.translate(_BYTES)
    at, kept = 0, []
    while at < len(text) or not at:
        end = at + PIECE_BYTES
        if end < len(text):
            end = text.find(b" ", end)
        end = len(text) if end < 0 else end
        words = kept + text[at:end].split()
        yield words, len(kept)
        kept = words[-(RUN - 1) :]
        at = end + 1


def features(pieces: list[tuple[list[bytes], int]], buckets: int = BUCKETS):
    """(bucket, piece) of every feature that ends in a piece's own words."""
    flat = [w for words, _ in pieces for w in words]
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(words) for words, _ in pieces])
    piece = np.repeat(np.arange(len(pieces)), sizes)
    first = np.cumsum(sizes) - sizes
    own = np.arange(n) >= (first + np.array([k for _, k in pieces]))[piece]
    alone = np.fromiter(map(zlib.crc32, flat), np.uint32, n)
    length = np.fromiter(map(len, flat), np.int64, n)
    far = np.flatnonzero(length > _TABLED)
    near = np.minimum(length, _TABLED)
    after_blank = _shifted(np.full(n, _BLANK), near) ^ alone
    found, where = [alone[own]], [piece[own]]
    crc = alone
    for size in range(2, min(RUN, n) + 1):
        # crc[i] covers the run of size - 1 words at i; the word after it is appended.
        left, k = crc[: n - size + 1], size - 1
        crc = _shifted(left, near[k:] + 1) ^ after_blank[k:]
        for i in far[far >= k].tolist():
            crc[i - k] = zlib.crc32(b" " + flat[i], int(left[i - k]))
        whole = (piece[k:] == piece[: n - k]) & own[k:]
        found.append(crc[whole])
        where.append(piece[k:][whole])
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), np.concatenate(where)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[list[bytes], int]], np.ndarray]]:
    """Pieces of the texts of a batch, a bounded number of bytes at a time, and whose they are."""
    held, owner, size = [], [], 0
    for row, text in enumerate(pc.cast(batch.column("text"), pa.binary())):
        for words, kept in words_of(text.as_py() or b""):
            held.append((words, kept))
            owner.append(row)
        size += len(held[-1][0]) * 8
        if size > PIECE_BYTES:
            yield held, np.array(owner)
            held, owner, size = [], [], 0
    if held:
        yield held, np.array(owner)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts; the driver gets a row for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chunks(batches, "text", PIECE_BYTES):
            for pieces, _ in _pieces(batch):
                total += np.bincount(features(pieces, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    read = texts.select(F.col(f"`{text_col}`").alias("text"))
    counted = read.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    in_docs, in_target = float(docs.sum() + len(docs)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * in_docs / ((s + 1) * in_target)))
            for s, t in zip(docs.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in chunks(batches, "text", PIECE_BYTES):
            words, number, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for pieces, owner in _pieces(batch):
                np.add.at(words, owner, [len(w) - kept for w, kept in pieces])
                bucket, piece = features(pieces, len(gain))
                row = owner[piece]
                order = np.argsort(row, kind="stable")
                row, bucket = row[order], bucket[order]
                at = np.flatnonzero(np.diff(row, prepend=-1))
                if at.size:
                    number[row[at]] += np.diff(np.append(at, len(row)))
                    weight[row[at]] += np.add.reduceat(gain[bucket], at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, (words, number, weight))],
                ["id", "n_words", "n_features", "weight"],
            )

    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("id", read.schema["id"].dataType)])
    for name in ("n_words", "n_features", "weight"):
        schema.add(name, T.LongType())
    return read.mapInArrow(weigh, schema)


def noise(id_col: str, seed: int) -> Column:
    """Thousandths of a Gumbel variable that the seed and the id decide, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def kth(rows: DataFrame, key: str, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th least (from 1) of a column of structs, all different; None if there are fewer.

    Each turn takes random rows for pivots, counts the rows before and at each of them, and keeps
    those between the two around the k-th as a table. Only pivots and counts reach the driver.
    """
    kind = rows.schema[key].dataType
    held, turn = rows.select(key), 0
    while k >= 1:
        picked = held.orderBy(F.xxhash64(F.lit(turn), key), key).limit(pivots).collect()
        if not picked:
            return None
        points = [F.lit(None).cast(kind) if r[0] is None else _literal(r[0], kind) for r in picked]
        counts = held.agg(
            *[F.count(F.when(F.col(key) < p, 1)).alias(f"b{i}") for i, p in enumerate(points)],
            *[F.count(F.when(F.col(key) == p, 1)).alias(f"e{i}") for i, p in enumerate(points)],
            F.count("*").alias("n"),
        ).head()
        if k > counts["n"]:
            return None
        low = high = None
        for i in sorted(range(len(points)), key=lambda i: counts[f"b{i}"]):
            before, upto = counts[f"b{i}"], counts[f"b{i}"] + counts[f"e{i}"]
            if before < k <= upto:
                return tuple(picked[i][0])
            if upto < k:
                low = (i, upto)
            elif high is None:
                high = i
        if low is not None:
            held = held.where(F.col(key) > points[low[0]])
            k -= low[1]
        if high is not None:
            held = held.where(F.col(key) < points[high])
        held = hand_over(held, "between")
        turn += 1
    return None


def _literal(value, kind: T.StructType) -> Column:
    fields = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, kind.fields)]
    return F.struct(*fields)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of each row; rank counts the drawn ones from 1.

    Drawn are the rows of ``least_words`` words or more with the highest scores, ties to the
    smaller id (null last); rows equal in that too are ordered by their features, then as stored.
    A null text has no words, a null id the noise of an empty one. Rows that repeat an id or a text
    count each. An empty table of documents gives an empty result, an empty target draws by the
    documents' own rarity. Only the two columns named are read, so names of others cannot clash.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    scored = weighed(docs, gain, id_col, text_col).withColumn(
        "score", F.col("weight") + noise("id", seed)
    )
    # The stored number makes every key different, however often rows repeat.
    scored = scored.withColumn("_row", F.monotonically_increasing_id())
    scored = hand_over(scored, "scored")
    last = F.col("id").isNull().alias("last")
    key = F.struct((-F.col("score")).alias("score"), last, "id", "n_features", "_row")
    scored = scored.withColumn("_key", key)
    able = F.col("n_words") >= least_words
    number = scored.where(able).count() * percent // 100
    bound = kth(scored.where(able), "_key", number)
    columns = ["id", "n_features", "weight", "score"]
    if bound is None:
        out = scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    else:
        drawn = able & (F.col("_key") <= _literal(bound, scored.schema["_key"].dataType))
        winners = scored.where(drawn).select(
            *columns,
            (-F.col("score")).alias("_a"),
            F.col("id").isNull().alias("_b"),
            "_row",
            F.lit(1).cast("long").alias("_one"),
        )
        winners = running_sums(winners, ["_a", "_b", "id", "n_features", "_row"], {"_n": "_one"})
        out = winners.select(*columns, (F.col("_n") + 1).alias("rank")).unionAll(
            scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
        )
    return out.withColumnRenamed("id", id_col)
