"""Fixtures shared by the tests of this folder."""

import random

from pyspark.sql import types as T

#: documents, with columns whose names clash with ones that operators use or return.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("_id", T.StringType()),
        T.StructField("_row", T.StringType()),
        T.StructField("_digest_", T.StringType()),
        T.StructField("_text", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


def words(seed: int, n: int, size: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}x" for _ in range(n)]


def prose(seed: int, n: int) -> str:
    """Lines of ten words each."""
    own = words(seed, n)
    return "\n".join(" ".join(own[i : i + 10]) for i in range(0, n, 10))


SAME = prose(1, 60)
LONG = prose(2, 40_000)

EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\n \n"),
    (4, "one two"),
    (5, LONG),
    (6, SAME),
    (6, SAME),
    (9, SAME),
    (None, SAME),
    (None, "a text without an id, of some more words than five"),
    (None, None),
    (7, "Straße Ñandú é 😀 \U00010400\U00010401 ﬁn 一二三 1 2\t3 don't <|endoftext|> é"),
    (8, "one two"),
    (8, "another text under a repeated id"),
    (10, "a" * 450),
]


def table(spark, path, rows):
    """A stored table of documents: (doc_id, text[, lang])."""
    full = [(*r, *["en"][len(r) - 2 :], "s", 0, "x", "x", "x", "x", "x", "x") for r in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def near_copy(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    own = text.split(" ")
    for at in rng.sample(range(len(own)), changes):
        own[at] = f"changed{rng.randrange(10**6)}"
    return " ".join(own)
