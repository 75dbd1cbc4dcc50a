"""Models of all keys at once against single fits and plain searches."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barweave.operators import logistic_by_key, trees_by_key

COLUMNS = ("u", "v", "w")


def rows_of(spark, n, keys=("a", "b", "c"), seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = keys[i % len(keys)]
        u, v, w = rng.gauss(100, 20), rng.random(), float(rng.randrange(4))
        chance = 1 / (1 + math.exp(-((u - 100) / 20 * (1 if k == "a" else -1) + 2 * v - 1)))
        rows.append((k, u, v, w, int(rng.random() < chance)))
    return spark.createDataFrame(rows, "symbol string, u double, v double, w double, target int"), rows


def test_logistic_equals_single_fits(spark):
    df, rows = rows_of(spark, 900)
    fitted = logistic_by_key.fit_by_key(df, columns=COLUMNS).collect()
    assert {r["symbol"] for r in fitted} == {"a", "b", "c"} and all(r["converged"] for r in fitted)
    vectors = VectorAssembler(inputCols=list(COLUMNS), outputCol="features").transform(df)
    for r in fitted:
        own = vectors.where(F.col("symbol") == r["symbol"])
        single = LogisticRegression(
            labelCol="target", regParam=1 / own.count(), standardization=False, tol=1e-14, maxIter=500
        ).fit(own)
        assert np.allclose(r["coefficients"], single.coefficients.toArray(), atol=1e-6)
        assert r["intercept"] == pytest.approx(single.intercept, abs=1e-4)
        # The optimality condition in full: the gradient of the penalised loss is 0.
        x = np.array([q[1:4] for q in rows if q[0] == r["symbol"]])
        y = np.array([q[4] for q in rows if q[0] == r["symbol"]])
        off = 1 / (1 + np.exp(-(x @ r["coefficients"] + r["intercept"]))) - y
        assert abs(off.sum()) < 1e-6 and np.abs(x.T @ off + r["coefficients"]).max() < 1e-4


def test_logistic_odd_keys(spark):
    """One label, a constant column, a separable key, gaps, an empty table."""
    rows = [("one", float(i), 1.0, 2.0, 1) for i in range(10)]
    rows += [("flat", float(i), 5.0, 0.0, i % 2) for i in range(20)]
    rows += [("apart", float(i), 0.0, 1.0, int(i > 9)) for i in range(20)]
    rows += [("gap", None, 1.0, 1.0, 1), (None, 1.0, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "symbol string, u double, v double, w double, target int")
    found = {r["symbol"]: r for r in logistic_by_key.fit_by_key(df, columns=COLUMNS).collect()}
    assert set(found) == {"one", "flat", "apart"} and all(r["converged"] for r in found.values())
    assert found["one"]["coefficients"] == [0, 0, 0]
    assert found["one"]["intercept"] == pytest.approx(math.log(10.5 / 0.5))
    assert found["flat"]["coefficients"][1:] == [0, 0] and found["apart"]["coefficients"][0] > 0.5
    scored = logistic_by_key.predict_by_key(df, logistic_by_key.fit_by_key(df, columns=COLUMNS), columns=COLUMNS)
    assert scored.where("symbol = 'apart' AND lr_pred != target").isEmpty()
    assert scored.where("lr_pred IS NULL").count() == 2
    assert logistic_by_key.fit_by_key(df.limit(0), columns=COLUMNS).count() == 0


def test_logistic_of_small_keys_reads_their_rows_once(spark, monkeypatch):
    """Keys of few rows take all steps in one task, with the results of steps by aggregations."""
    df, _ = rows_of(spark, 900, ("a", "b", "c", "d"))
    df = df.union(df.where("symbol = 'a'").withColumn("symbol", F.lit("e")).withColumn("target", F.lit(1)))
    df = df.union(df.where("symbol = 'b'").withColumn("symbol", F.lit("f")).withColumn("w", F.lit(2.0)))
    summed = []
    sums = logistic_by_key._sums
    monkeypatch.setattr(
        logistic_by_key, "_sums", lambda *a: summed.append(1) or sums(*a)
    )
    found = [logistic_by_key.fit_by_key(df, columns=COLUMNS).collect()]
    assert not summed
    found += [logistic_by_key.fit_by_key(df, columns=COLUMNS, few_rows=n).collect() for n in (0, 225)]
    assert summed
    here, *others = ({r["symbol"]: r for r in rows} for rows in found)
    assert set(here) == set("abcdef")
    for other in others:
        for k, r in here.items():
            assert r["n_rows"] == other[k]["n_rows"] and r["converged"] == other[k]["converged"]
            assert np.allclose(r["coefficients"], other[k]["coefficients"], atol=1e-9)
            assert r["intercept"] == pytest.approx(other[k]["intercept"], abs=1e-7)
            assert abs(r["steps"] - other[k]["steps"]) <= 1


def test_logistic_jobs_do_not_grow_with_keys(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs(keys):
        df, _ = rows_of(spark, 400, keys)
        spark.sparkContext.setJobGroup(f"fit{len(keys)}", "")
        logistic_by_key.fit_by_key(df, columns=COLUMNS)
        return len(tracker.getJobIdsForGroup(f"fit{len(keys)}"))

    try:
        few, many = jobs("ab"), jobs([f"k{i}" for i in range(40)])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many <= 3 * few


# -- trees ---------------------------------------------------------------------------------------


def plain_bins(values, bins):
    """Cuts by rank as a quantile of the sorted values, and how many lie below each value."""
    ordered = sorted(values)
    cuts = []
    for i in range(1, bins):
        cut = ordered[max(0, math.ceil(i / bins * len(ordered)) - 1)]
        if cut not in cuts:
            cuts.append(cut)
    return [sum(c < v for c in cuts) for v in values]


def plain_tree(table, a, b, score, depth, least, node=1):
    """Best cut over all columns and bins, node by node: node -> (column, bin, sum a, sum b)."""
    own = range(len(a))
    out = {node: (None, None, sum(a), sum(b))}
    best = None
    for c in range(len(table)) if depth else ():
        for cut in sorted(set(table[c])):
            left = [i for i in own if table[c][i] <= cut]
            right = [i for i in own if table[c][i] > cut]
            la, lb = sum(a[i] for i in left), sum(b[i] for i in left)
            ra, rb = sum(a[i] for i in right), sum(b[i] for i in right)
            if min(lb, rb) < least or not left or not right:
                continue
            gain = round(score(la, lb) + score(ra, rb) - score(la + ra, lb + rb), 9)
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = (gain, c, cut, left, right)
    if best:
        _, c, cut, left, right = best
        out[node] = (c, cut, sum(a), sum(b))
        for some, child in ((left, 2 * node), (right, 2 * node + 1)):
            out |= plain_tree(
                [[col[i] for i in some] for col in table], [a[i] for i in some], [b[i] for i in some],
                score, depth - 1, least, child,
            )
    return out


def nodes_of(trees, key, tree=0):
    rows = trees.nodes.where((F.col("symbol") == key) & (F.col("tree") == tree)).collect()
    return {r["node"]: (r["at"], r["bin"], r["a"], r["b"]) for r in rows}


def test_forest_tree_equals_plain_search(spark):
    df, rows = rows_of(spark, 240)
    trees = trees_by_key.forest_by_key(
        df, columns=COLUMNS, trees=2, depth=3, per_node=3, bootstrap=False, bins=8
    )
    gini = lambda a, b: (a * a + (b - a) ** 2) / b
    for key in "abc":
        own = [r for r in rows if r[0] == key]
        table = [plain_bins([r[1 + c] for r in own], 8) for c in range(3)]
        wanted = plain_tree(table, [r[4] for r in own], [1] * len(own), gini, 3, 1)
        assert nodes_of(trees, key) == wanted == nodes_of(trees, key, 1)
        assert len(wanted) > 6


def test_boosted_tree_equals_plain_search(spark):
    df, rows = rows_of(spark, 240)
    trees = trees_by_key.boost_by_key(
        df, columns=COLUMNS, rounds=2, depth=2, step=0.3, row_share=1.0, column_share=1.0, bins=8
    )
    unit = trees_by_key.UNIT
    score = lambda a, b: (a / unit) ** 2 / (b / unit + 1)
    for key in "abc":
        own = [r for r in rows if r[0] == key]
        table = [plain_bins([r[1 + c] for r in own], 8) for c in range(3)]
        margin = [0.0] * len(own)
        for tree in range(2):
            chance = [1 / (1 + math.exp(-m)) for m in margin]
            a = [round((p - r[4]) * unit) for p, r in zip(chance, own)]
            b = [round(p * (1 - p) * unit) for p in chance]
            wanted = plain_tree(table, a, b, score, 2, unit)
            got = nodes_of(trees, key, tree)
            assert {n: x[:2] for n, x in got.items()} == {n: x[:2] for n, x in wanted.items()}
            for n, (_, _, ga, gb) in got.items():
                assert (ga, gb) == pytest.approx(wanted[n][2:], abs=1 + 1e-6 * unit)
            for i in range(len(own)):
                node = 1
                while wanted[node][0] is not None:
                    node = 2 * node + (table[wanted[node][0]][i] > wanted[node][1])
                margin[i] -= 0.3 * (wanted[node][2] / unit) / (wanted[node][3] / unit + 1)
        # The answers for rows are the sums of the leaves they fall into.
        scored = trees.predict(df.where(F.col("symbol") == key), "xgb").collect()
        assert len(scored) == len(own)
    assert scored[0].asDict().keys() >= {"xgb_pred", "xgb_probability"}


def test_trees_learn_and_rerun_alike(spark):
    df, _ = rows_of(spark, 600, seed=3)
    df = df.withColumn("target", ((F.col("u") > 100) != (F.col("v") > 0.5)).cast("int"))
    forest, again = (
        trees_by_key.forest_by_key(df, columns=COLUMNS, trees=9, depth=4) for _ in range(2)
    )
    assert forest.predict(df, "rf").where("rf_pred != target").count() < 60
    runs = [sorted(map(str, f.nodes.drop("gain").collect())) for f in (forest, again)]
    assert runs[0] == runs[1]
    whole = df.withColumn("symbol", F.lit("all"))
    boosted = trees_by_key.boost_by_key(whole, columns=COLUMNS, rounds=3, depth=3, step=0.7)
    assert boosted.predict(whole, "xgb").where("xgb_pred != target").count() < 90
    # Columns are drawn for each tree of boosting, for each node of a forest.
    used = {(r["tree"], r["node"]): r["at"] for r in forest.nodes.where("symbol = 'a' AND node = 1").collect()}
    assert len(set(used.values())) > 1
    assert forest.predict(df.withColumn("symbol", F.lit("new")), "rf").where("rf_pred IS NOT NULL").isEmpty()


@pytest.mark.parametrize("boosted", [False, True])
def test_trees_in_tasks_are_those_over_all_tasks(spark, monkeypatch, boosted):
    df, _ = rows_of(spark, 900, seed=5)
    df = df.unionByName(df.where("v > 0.8")).unionByName(df.withColumn("w", F.lit(None).cast("double")))
    monkeypatch.setattr(trees_by_key, "ENTRIES", 700)
    if boosted:
        fit, settings = trees_by_key.boost_by_key, {"rounds": 3, "depth": 3, "step": 0.5}
    else:
        fit, settings = trees_by_key.forest_by_key, {"trees": 5, "depth": 4}
    found = {}
    for few in (0, 450, 20_000):  # no key, some keys and all keys in tasks
        trees = fit(df, columns=COLUMNS, bins=8, few_rows=few, **settings)
        nodes = trees.nodes.select("symbol", "tree", "node", "at", "bin", "gain", "a", "b").collect()
        found[few] = sorted((tuple(r) for r in nodes), key=lambda r: r[:3])
    assert len(found[0]) > 60
    for few in (450, 20_000):
        assert [r[:5] for r in found[few]] == [r[:5] for r in found[0]]
        for some, other in zip(found[few], found[0]):
            assert some[6:] == pytest.approx(other[6:], abs=64)


def test_few_jobs_for_trees_of_small_keys_and_dealt_out_rows(spark, monkeypatch):
    df, _ = rows_of(spark, 300)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("trees-here", "")
    try:
        trees = trees_by_key.boost_by_key(df, columns=COLUMNS, rounds=12, depth=5)
        jobs = len(tracker.getJobIdsForGroup("trees-here"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20
    # Rows of a key that has many are walked in several tasks.
    pick = ("u", "v", "w", "symbol", "xgb_probability")
    once = sorted(map(str, trees.predict(df, "xgb").select(*pick).collect()))
    monkeypatch.setattr(trees_by_key, "TASK_ROWS", 30)
    assert sorted(map(str, trees.predict(df, "xgb").select(*pick).collect())) == once


def test_trees_of_nothing(spark):
    df, _ = rows_of(spark, 30)
    none = df.limit(0)
    forest = trees_by_key.forest_by_key(none, columns=COLUMNS, trees=2, depth=2)
    assert forest.nodes.isEmpty() and forest.predict(df, "rf").where("rf_pred IS NULL").count() == 30
    one = df.withColumn("target", F.lit(1))
    forest = trees_by_key.forest_by_key(one, columns=COLUMNS, trees=2, depth=2)
    assert {r["node"] for r in forest.nodes.collect()} == {1}
    assert forest.predict(one, "rf").where("rf_probability != 1").isEmpty()


