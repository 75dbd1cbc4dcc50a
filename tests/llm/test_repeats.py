"""Long runs and repeated rows cost no more than in proportion."""

import random
import time

from pyspark.sql import functions as F
from support import near_copy, prose, table

from barweave.llm import near_dedup, secrets
from barweave.llm.common import stay


def plain_least(cuts):
    """Span after span by p-value, each taking away all that overlap it."""
    out, left = [], sorted(cuts, key=lambda x: (cuts[x], x))
    while left:
        a, b = left[0]
        near = [x for x in left if x[0] < b and a < x[1]]
        out.append((a, b, min(1.0, cuts[a, b] * len(near))))
        left = [x for x in left if x not in near]
    return out


def test_overlapping_cuts_against_plain_version():
    rng = random.Random(1)
    for _ in range(200):
        lists, cuts = [], {}
        for _ in range(3):
            at, own = 0, []
            for _ in range(rng.randrange(9)):
                a = at + rng.randrange(4)
                at = a + rng.randrange(1, 12)
                own.append((a, at))
                cuts.setdefault((a, at), rng.choice([0.001, 0.01, 0.2, 1.0]))
            lists.append(own)
        assert list(secrets._least(cuts, lists)) == plain_least(cuts)


def test_a_megabyte_in_one_run():
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    parts = ["".join(rng.choices(letters, k=40)) for _ in range(25_000)]
    text = "".join(p + rng.choice("/_") for p in parts)
    begin = time.process_time()
    few = secrets.random_strings(text[: len(text) // 8])
    middle = time.process_time()
    many = secrets.random_strings(text)
    took = time.process_time() - middle
    assert len(many) > 7 * len(few) > 1000
    assert took < 20 * (middle - begin)


def test_repeated_rows_are_compared_once(spark, tmp_path, monkeypatch):
    base = prose(3, 100)
    rows = [(1, base)] * 60 + [(2, near_copy(base, 4, 1))] * 60 + [(None, base)] * 20 + [(3, "other text")]
    docs = table(spark, tmp_path / "t", rows)
    compared = []

    def count(pairs, texts, compare=near_dedup.compare):
        found = compare(pairs, texts)
        compared.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "compare", count)
    got = near_dedup.near_groups(docs).collect()
    assert sum(compared) <= 2
    assert sorted(r["class_size"] for r in got) == [1] + [140] * 140
    assert sum(r["kept"] for r in got) == 2


def test_stay_moves_texts_once(spark, tmp_path):
    rows = [(1, "a")] * 3 + [(1, "b"), (None, "a"), (None, "a"), (None, "c"), (2, None), (2, "")]
    docs = table(spark, tmp_path / "t", rows)
    text = F.coalesce("text", F.lit(""))
    chosen = docs.where("text != 'c' OR text IS NULL").select(
        F.col("doc_id").alias("_id"), F.sha2(text, 256).alias("_digest")
    )
    kept = stay(docs, chosen, "doc_id", "text")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # Texts, and the rows that are chosen.
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect())
    assert got == [("1", "a"), ("1", "b"), ("2", ""), ("None", "a")]
