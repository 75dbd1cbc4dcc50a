"""The pipeline of the repository's top folder, and the registered queries of the package."""

import random

import corpus_pipeline
import pytest
import public_tokenizers
from support import EDGES, LONG, near_copy, prose, table, words
from test_dedup import low, plain_near
from test_rest import plain_matches
from tokenizers import Tokenizer

import __spark_entry__
from barweave.llm import queries, toxicity


def write(spark, folder, rows, labels, items):
    docs = table(spark, folder / "documents.parquet", rows)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(folder / "labels.parquet")
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        str(folder / "benchmark.parquet")
    )
    return docs


def test_stages_against_plain_versions(spark, tmp_path):
    rng = random.Random(2)
    rows = [r for r in EDGES if r[1] is not LONG]
    rows += [
        (1000 + i, " ".join(words(i, 60, 200)) + " stupid lowlife" * (i % 4 == 0))
        for i in range(500)
    ]
    rows += [(100 + i, prose(i, 80)) for i in range(120)]
    rows += [(400 + i, near_copy(prose(i, 80), i, i % 3)) for i in range(1, 40)]
    items = [(i, prose(7000 + i, 30)) for i in range(5)]
    rows += [(500 + i, f"{prose(300 + i, 40)} {items[i % 5][1]}") for i in range(15)]
    labels = [(i, 1, int("stupid" in (t or ""))) for i, t in rows if i and rng.random() < 0.8]
    write(spark, tmp_path, rows, labels, items)
    docs, names = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    kept = [(i, t or "") for i, t in rows]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        names.append(name)
        if name == "pack":
            break
        assert docs.columns == columns
        got = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (low(r[0]), r[1]))
        if name == "toxicity":
            wanted = [r for r in kept if "stupid" not in r[1]]
            # A few hundred labelled rows teach most of it.
            assert len(set(wanted) ^ set(got)) <= 0.06 * len(kept)
            wanted = got
        elif name == "exact_dedup":
            best = {}
            for i, t in kept:
                best[t] = max(best.get(t, i), i, key=low)
            wanted = [(i, t) for t, i in best.items()]
        elif name == "near_dedup":
            left = sorted(i for i, *_, first in plain_near(kept).elements() if first and i is not None)
            assert sorted(i for i, _ in got if i is not None) == left
            wanted = got
        else:
            wanted = [r for r in kept if not any(plain_matches(r[1], x) >= 0.8 for _, x in items)]
        assert got == sorted(wanted, key=lambda r: (low(r[0]), r[1]))
        kept = got
    code = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(code.encode(t, add_special_tokens=False).ids) + 1 for _, t in kept)
    assert sum(r["length"] for r in docs.collect()) == total
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "pack"]


def test_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    found = queries.QUERIES[name](spark, folder)
    base = duckdb.connect()
    base.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    columns = sorted(found.columns)
    wanted = base.sql(queries.ORACLE[name]).df()[columns]
    got = found.toPandas()[columns]
    rows = [sorted(tuple(map(str, r)) for r in x.itertuples(index=False)) for x in (got, wanted)]
    assert rows[0] == rows[1]


def test_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and toxicity.MOST_ROWS == 20_000
