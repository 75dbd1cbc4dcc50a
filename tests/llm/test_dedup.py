"""Exact, near, line and substring deduplication against plain versions."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from support import EDGES, LONG, SAME, near_copy, prose, table

from barweave.llm import exact_dedup, line_dedup, naming, near_dedup, substring_dedup, words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(i):
    return -1 if i is None else i


def plain_exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=low)
        kept = False
        for i in sorted(ids, key=low, reverse=True):
            out[(i, keep, len(ids), not kept, sha(text))] += 1
            kept = True
    return out


def exact(docs, **options):
    return Counter(tuple(r) for r in exact_dedup.exact_groups(docs, **options).collect())


@pytest.mark.parametrize("block", [1024, 7])
def test_exact(spark, tmp_path, block):
    rows = EDGES + [(100 + i, "x" * i) for i in range(40)] + [(200 + i, "x" * i) for i in range(40)]
    rows = [(i, t) for i, t in rows if block > 100 or t is not LONG]
    assert exact(table(spark, tmp_path / "t", rows), block=block) == plain_exact(rows)


def test_exact_empty(spark, tmp_path):
    assert not exact(table(spark, tmp_path / "t", []))


def test_exact_hot_blocks(spark, tmp_path, monkeypatch):
    """Blocks above the limit are salted; their names must meet again."""
    monkeypatch.setattr(naming, "LEAST_HEAVY", 3)
    monkeypatch.setattr(naming, "HEAVY_PART", 10)
    rows = [(i, "hot " * 30 + str(i % 5)) for i in range(60)] + [(100 + i, str(i)) for i in range(60)]
    assert exact(table(spark, tmp_path / "t", rows), block=20) == plain_exact(rows)


# -- lines -------------------------------------------------------------------------------------


def plain_lines(rows, least, words=None):
    """(id, lines, removed, runs, kept) by looking at every run of ``least`` lines in order, and at
    every line of so many words."""
    seen, out = set(), Counter()
    for i, text in sorted(((i, t or "") for i, t in rows), key=lambda r: low(r[0])):
        lines = text.split("\n")
        solid = [n for n, x in enumerate(lines) if x.strip(" \t")]
        gone = set()
        for k in range(len(solid) - least + 1):
            run = tuple(lines[n] for n in solid[k : k + least])
            if run in seen:
                gone.update(range(k, k + least))
            seen.add(run)
        for k, n in enumerate(solid):
            if words is not None and len(re.findall(r"[^\x20\x09-\x0D]+", lines[n])) >= words:
                if lines[n] in seen:
                    gone.add(k)
                seen.add(lines[n])
        runs, kept = [], []
        for k in sorted(gone):
            if k - 1 in gone:
                runs[-1][1] = solid[k]
            else:
                runs.append([solid[k], solid[k]])
        kept = [x for n, x in enumerate(lines) if not any(a <= n <= b for a, b in runs)]
        out[(i, len(lines), len(lines) - len(kept), len(runs), "\n".join(kept) if runs else text)] += 1
    return out


@pytest.mark.parametrize("least", [1, 2, 3])
def test_lines(spark, tmp_path, least):
    rng = random.Random(least)
    rows = [r for r in EDGES if r[0] is not None or r[1] != SAME] + [
        (20 + i, "\n".join(rng.choice("abcdefgh  ") for _ in range(rng.randrange(12))))
        for i in range(60)
    ]
    docs = table(spark, tmp_path / "t", rows)
    found = Counter(tuple(r) for r in line_dedup.dedup_lines(docs, least_lines=least, least_words=None).collect())
    # Rows that share an id come in the order they are read; here they have equal texts or none in common.
    assert found == plain_lines(rows, least)


@pytest.mark.parametrize(("least", "words"), [(2, 3), (3, 2), (4, 4)])
def test_single_long_lines(spark, tmp_path, least, words):
    """Lines of enough words go wherever they occur again, beside runs that repeat at any depth."""
    rng = random.Random(words)
    block = [f"{i} of a block" for i in range(21)]
    pool = ["a", "b c", "d e f", "g h i j", "k l\tm\u00a0n o p", "", " ", "x\u3000y z"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(50)]
    rows += [(50 + i, "\n".join(["q"] * i + block[i % 3 :] + ["r"] * (i % 4))) for i in range(12)]
    rows += [(70, "x\n" * 40), (71, "x\n" * 40)]
    docs = table(spark, tmp_path / "t", rows)
    got = line_dedup.dedup_lines(docs, least_lines=least, least_words=words)
    assert Counter(tuple(r) for r in got.collect()) == plain_lines(rows, least, words)


def test_a_long_line_with_other_neighbours_goes(spark, tmp_path):
    passage = " ".join(prose(5, 60).split())
    rows = [(i, f"before {i}\n{passage}\nafter {i}") for i in range(5)]
    got = line_dedup.dedup_lines(table(spark, tmp_path / "t", rows)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(0, 0)] + [(i, 1) for i in range(1, 5)]
    assert sum(passage in r["kept_text"] for r in got) == 1


def test_lines_empty(spark, tmp_path):
    assert line_dedup.dedup_lines(table(spark, tmp_path / "t", [])).count() == 0


# -- substrings --------------------------------------------------------------------------------


def plain_substrings(rows):
    seen, out = set(), Counter()
    for i, text in sorted(((i, t or "") for i, t in rows), key=lambda r: low(r[0])):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            own = data[at : at + 100]
            if own in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(own)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for n in range(len(gone)) if gone[n] and not (n and gone[n - 1]))
        out[(i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def substrings(docs):
    found = substring_dedup.dedup_substrings(docs).drop("spans").collect()
    return Counter(tuple(r) for r in found)


@pytest.mark.parametrize("hot", [20_000, 0])
def test_substrings(spark, tmp_path, hot):
    rng = random.Random(5)
    shared = [prose(50 + i, 30) for i in range(4)]
    rows = EDGES + [(20, "ab" * 300), (21, "x" + "ab" * 200), (22, "é" * 200), (23, "zé" + "é" * 150)]
    for i in range(40):
        parts = [prose(1000 + i * 10 + k, rng.randrange(1, 25)) for k in range(3)]
        parts.insert(1, rng.choice(shared)[rng.randrange(60) :])
        rows.append((30 + i, "".join(parts)))
    rows = [r for r in rows if r[1] is not LONG] + [(90, LONG[:60_000]), (91, LONG[20_000:90_000])]
    docs = table(spark, tmp_path / "t", rows)
    found = Counter(tuple(r) for r in substring_dedup.dedup_substrings(docs, hot=hot).drop("spans").collect())
    assert found == plain_substrings(rows)


def test_substrings_in_parts_and_flushes(spark, tmp_path, monkeypatch):
    """Long texts in overlapping parts, and tasks that send what they gathered several times."""
    data = np.frombuffer((SAME * 3).encode(), np.uint8)
    whole = substring_dedup.parse(data, np.array([len(data)]))
    starts = np.concatenate([f + np.arange(n) for f, n in zip(*whole[:2], strict=True)])
    assert starts.tolist() == list(range(len(data) - 99))
    monkeypatch.setattr(substring_dedup, "PART", 150)
    parts = list(substring_dedup._parts([7], [data.tobytes()]))
    covered = []
    for _, offset, own, ends in parts:
        first, count, _, _ = substring_dedup.parse(own, ends)
        begin = np.concatenate([[0], ends])
        for f, n in zip(first, count, strict=True):
            part = int(np.searchsorted(ends, f, "right"))
            covered += (f + np.arange(n) - begin[part] + offset[part]).tolist()
    assert sorted(covered) == list(range(len(data) - 99))
    columns = [np.array(c) for c in ([5, 5, 3], [1, 1, 2], [4, 2, 9], [1, 0, 2], [7, 8, 9], [1, 1, 1])]
    columns[:2] = [c.astype(np.uint64) for c in columns[:2]]
    sent = [b.to_pylist()[0] for b in substring_dedup._send(columns, np.array([1, 1, 0]))]
    assert sorted(r["kind"] for r in sent) == [0, 0, 2]
    later = substring_dedup._unpacked([r for r in sent if r["kind"] == 2])
    assert [c.tolist() for c in later] == [[5], [1], [4], [1], [7], [1]]


def test_substrings_empty(spark, tmp_path):
    assert not substrings(table(spark, tmp_path / "t", []))


# -- near duplicates -----------------------------------------------------------------------------


def shingles(text):
    own = "".join(c if c.isalnum() or c == "_" else " " for c in (text or "").lower()).split()
    if not own:
        return Counter()
    size = min(5, len(own))
    return Counter(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def plain_similarity(x, y):
    return sum(
        1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys()
    )


def plain_near(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a].keys() & sets[b].keys() and plain_similarity(sets[a], sets[b]) >= 0.8:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    out = Counter()
    for g in set(group):
        own = sorted((rows[i] for i in range(len(rows)) if group[i] == g), key=lambda r: low(r[0]))
        for n, (i, text) in enumerate(own):
            # Rows that repeat an id are told apart by where they were read; texts are left out.
            out[(i, own[0][0], len(own), n == 0)] += 1
    return out


def test_similarity_and_signature():
    rng = np.random.default_rng(1)
    a = Counter({int(k): int(rng.integers(1, 4)) for k in range(200)})
    b = Counter({int(k): int(rng.integers(1, 4)) for k in range(30, 220)})
    arrays = [
        (np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (a, b)
    ]
    exact_value = near_dedup.similarity(*arrays)
    assert exact_value == pytest.approx(plain_similarity(a, b))
    held = near_dedup.prob_minhash(
        np.concatenate([x[0] for x in arrays]),
        np.concatenate([x[1] for x in arrays]).astype(float),
        np.repeat([0, 1], [200, 190]),
        2,
        4000,
    )
    assert (held[0] == held[1]).mean() == pytest.approx(exact_value, abs=0.04)


def test_words_are_hashed_alike_everywhere():
    found, doc = words.word_hashes(["Ab cd", "", "cd, AB_", "\U00010400x"])
    assert doc.tolist() == [0, 0, 2, 2, 3]
    assert found[1] == found[2] and len(set(found.tolist())) == 4


def test_near(spark, tmp_path):
    base = [prose(300 + i, 100).replace("\n", " ") for i in range(3)]
    rows = [r for r in EDGES if r[1] is not LONG]
    for n, text in enumerate(base):
        rows += [(100 * (n + 1) + k, near_copy(text, n * 50 + k, k % 5)) for k in range(25)]
    # A chain whose ends are far apart, and texts that share one passage only.
    chain = base[0].replace("w", "v")
    for k in range(8):
        rows.append((600 + k, chain))
        chain = near_copy(chain, 900 + k, 2)
    rows += [(700 + k, base[1][:250] + " " + prose(2000 + k, 60)) for k in range(20)]
    found = near_dedup.near_groups(table(spark, tmp_path / "t", rows)).collect()
    got = Counter((r["doc_id"], r["class_id"], r["class_size"], r["kept"]) for r in found)
    assert got == plain_near(rows)
    assert {r["text_sha256"] for r in found} == {sha(t or "") for _, t in rows}


def test_near_compares_members_that_the_pivot_does_not_link(spark, tmp_path):
    """A passage in all texts puts groups into one bucket; later rounds must tell them apart."""
    passage = prose(1, 200).replace("\n", " ")
    rows = []
    for group in range(6):
        text = passage + " " + prose(70 + group, 150).replace("\n", " ")
        rows += [(10 * group + k, near_copy(text, group * 9 + k, k)) for k in range(4)]
    docs = table(spark, tmp_path / "t", rows)
    found = near_dedup.near_groups(docs, bands=60, rows=1, block=5).collect()
    got = Counter((r["doc_id"], r["class_id"], r["class_size"], r["kept"]) for r in found)
    assert got == plain_near(rows)


def test_near_empty(spark, tmp_path):
    assert near_dedup.near_groups(table(spark, tmp_path / "t", [])).count() == 0


def test_near_search_gives_fewer_links_than_members(spark, tmp_path, monkeypatch):
    """Copies that are alike by pairs, none of which the pivot links: links, not pairs, come out."""
    made = []
    store = near_dedup.hand_over

    def counting(df, label):
        stored = store(df, label)
        if label in ("compared", "links"):
            made.append(stored.count())
        return stored

    monkeypatch.setattr(near_dedup, "hand_over", counting)
    base = prose(31, 403).replace("\n", " ")
    # The rows read first are far from all others.
    rows = [(k, near_copy(base, 60 + k, 30)) for k in range(4)]
    rows += [(10 + k, near_copy(base, 80 + k, 6)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_dedup.near_groups(docs, bands=60, rows=1).collect()
    got = Counter((r["doc_id"], r["class_id"], r["class_size"], r["kept"]) for r in found)
    assert got == plain_near(rows)
    assert 0 < made[-1] < len(rows)
