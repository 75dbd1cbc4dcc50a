"""Histogram trees of all keys at once: random forests and second-order boosting.

Every column is cut into quantile bins, for each key its own. Keys of up to ``FEW_ROWS`` rows meet
their rows once, many keys to a task, which grows all their trees (``trees_here``). For the others a
level of all trees is one aggregation of two sums by (key, tree, node, column, bin); running sums
over the bins of a node give the gain of every cut, and the best one splits the node. Their rows
carry the node they are in, so a level is a join with the new splits (broadcast while they are few).
The number of jobs depends on depth and rounds alone, not on the number of keys or trees. Both ways
grow the same trees.

The two sums are whole numbers: rows and rows of class 1 for a forest, first and second derivative
of the loss in units of 2**-30 for boosting. They do not depend on the order of addition, and a
rerun grows the same trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.operators import trees_here
from barweave.schema import FEATURES
from barweave.storage import hand_over

BINS = 32
UNIT = 2**30
#: Up to this many nodes a level's splits are broadcast, beyond it they are joined by a shuffle.
FEW_NODES = 100_000
#: A key of more rows is summed by aggregations over all tasks.
FEW_ROWS = 20_000
#: Rows of a task that grows all trees of its keys, or walks through them.
TASK_ROWS = 100_000
#: Entries, which are rows in trees, that a task looks at together.
ENTRIES = 500_000
#: Columns drawn for each node are listed ahead for trees of up to this depth.
LISTED_DEPTH = 8
_PARTS = 2**40
#: Trees of which a forest row is part at most so many times (a Poisson draw with mean 1).
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)) for n in range(8)]


@dataclass(frozen=True)
class Rule:
    """What makes a split good: ``kind`` gini or loss, the least second sum of a child, the penalty
    on leaf values, and how many columns a tree or node may use, chosen by a hash."""

    kind: str
    depth: int
    least: float
    l2: float = 0.0
    columns: int | None = None
    per_node: bool = False
    seed: int = 42

    def score(self, a: Column, b: Column) -> Column:
        if self.kind == "gini":
            a, b = a.cast("double"), b.cast("double")
            return (a * a + (b - a) * (b - a)) / b
        a, b = a / F.lit(float(UNIT)), b / F.lit(float(UNIT))
        return a * a / (b + self.l2)

    def score_here(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``score`` of arrays."""
        if self.kind == "gini":
            return (a * a + (b - a) * (b - a)) / b
        a, b = a / UNIT, b / UNIT
        return a * a / (b + self.l2)

    @property
    def least_sum(self) -> int:
        return math.ceil(self.least * (1 if self.kind == "gini" else UNIT))


def quantile_cuts(
    rows: DataFrame, key: str, columns: Sequence[str] = FEATURES, bins: int = BINS
) -> DataFrame:
    """(key, cuts): for every column the distinct values that end its bins, in order.

    Exact for keys of up to ten thousand rows, else within a ten-thousandth of the rank.
    """
    return rows.groupBy(key).agg(_cuts(columns, bins))


def _cuts(columns: Sequence[str], bins: int) -> Column:
    shares = [i / bins for i in range(1, bins)]
    found = [F.array_distinct(F.percentile_approx(c, shares, 10_000)) for c in columns]
    return F.array(*found).alias("cuts")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW_NODES else df


def binned(
    rows: DataFrame, cuts: DataFrame, key: str, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """``rows`` with ``bins``: for every column, how many of its cuts lie below the value."""

    def below(i: int, c: str) -> Column:
        value = F.col(c).cast("double")
        return F.size(F.filter(F.col("cuts")[i], lambda cut: cut < value)).cast("short")

    joined = rows.join(_few(cuts), key)
    return joined.withColumn("bins", F.array(*[below(i, c) for i, c in enumerate(columns)])).drop("cuts")


def _draws_columns(rule: Rule, width: int) -> bool:
    return rule.columns is not None and rule.columns < width


def _columns_of(rule: Rule, width: int, key: str, tree: Column, node: Column) -> Column:
    """The columns that a node may be split by, as an array of their numbers."""
    every = F.sequence(F.lit(0), F.lit(width - 1))
    if not _draws_columns(rule, width):
        return every
    node = node if rule.per_node else F.lit(0)
    drawn = F.transform(
        every, lambda i: F.struct(F.xxhash64(F.lit(rule.seed), F.col(key), tree, node, i), i.alias("i"))
    )
    return F.transform(F.slice(F.sort_array(drawn), 1, rule.columns), lambda x: x["i"])


def _splits(state: DataFrame, nodes: DataFrame, key: str, rule: Rule, width: int) -> DataFrame:
    """For every node its sums, and the column and bin of its best cut, NULL if none gains.

    ``state`` has (key, tree, node, bins, a, b), where a and b are the row's two numbers, and
    ``nodes`` all (key, tree, node) of it, for which columns are drawn, not for every row.
    """
    at = [key, "tree", "node"]
    columns = _columns_of(rule, width, key, F.col("tree"), F.col("node"))
    if _draws_columns(rule, width):
        state, columns = state.join(_few(nodes.withColumn("columns", columns)), at), F.col("columns")
    each = state.withColumn("at", F.explode(columns))
    cells = each.groupBy(*at, "at", F.col("bins")[F.col("at")].alias("bin")).agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    own = Window.partitionBy(*at, "at")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.select(
        *at, "at", "bin",
        F.sum("a").over(upto).alias("la"), F.sum("b").over(upto).alias("lb"),
        F.sum("a").over(own).alias("ta"), F.sum("b").over(own).alias("tb"),
    )
    right_a, right_b = F.col("ta") - F.col("la"), F.col("tb") - F.col("lb")
    gain = (
        rule.score(F.col("la"), F.col("lb"))
        + rule.score(right_a, right_b)
        - rule.score(F.col("ta"), F.col("tb"))
    )
    allowed = (F.col("lb") >= rule.least_sum) & (right_b >= rule.least_sum) & (right_b > 0)
    gain = F.when(allowed & (F.col("lb") > 0), gain)
    # Of equal gains the first column and cut; a gain within rounding is none.
    best = F.max(
        F.when(gain > 1e-9, F.struct(F.round(gain, 9).alias("gain"), (-F.col("at")).alias("at"), (-F.col("bin")).alias("bin")))
    )
    found = cells.groupBy(*at).agg(best.alias("best"), F.max("ta").alias("a"), F.max("tb").alias("b"))
    return found.select(
        *at, (-F.col("best.at")).alias("at"), (-F.col("best.bin")).alias("bin"), "best.gain", "a", "b"
    )


def _grown(state: DataFrame, key: str, rule: Rule, width: int) -> DataFrame:
    """The nodes of all trees of ``state``, level by level: (key, tree, node, at, bin, gain, a, b).

    Node n has the children 2 n and 2 n + 1; rows whose bin is above the cut go to the second.
    """
    levels = []
    at = hand_over(state.select(key, "tree", "node").distinct(), "at")
    for _ in range(rule.depth):
        found = hand_over(_splits(state, at, key, rule, width), "splits")
        levels.append(found)
        cut = found.where("at IS NOT NULL")
        if cut.isEmpty():
            break
        state = hand_over(_descended(state, cut, key, "inner"), "nodes")
        child = F.explode(F.array(2 * F.col("node"), 2 * F.col("node") + 1)).alias("node")
        at = cut.select(key, "tree", child)
    else:
        ends = state.groupBy(key, "tree", "node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        levels.append(ends)
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level, allowMissingColumns=True)
    return hand_over(nodes, "trees")


def _descended(state: DataFrame, splits: DataFrame, key: str, how: str) -> DataFrame:
    """Rows one level further down; with ``how`` left, rows at a leaf stay there."""
    cut = splits.select(key, "tree", "node", "at", "bin")
    joined = state.join(_few(cut), [key, "tree", "node"], how)
    right = (F.col("bins")[F.col("at")] > F.col("bin")).cast("long")
    below = F.coalesce(2 * F.col("node") + right, "node")
    return joined.withColumn("node", below).select(*state.columns)


def _settled(rows: DataFrame, nodes: DataFrame, key: str, depth: int) -> DataFrame:
    """(key, row, tree, node) rows moved down to their leaves, with the sums of the leaf."""
    inner = nodes.where("at IS NOT NULL")
    for _ in range(depth):
        rows = _descended(rows, inner, key, "left")
    return rows.join(_few(nodes.select(key, "tree", "node", "a", "b")), [key, "tree", "node"])


@dataclass(frozen=True)
class Trees:
    """Fitted trees of all keys. ``nodes``: (key, tree, node, at, bin, gain, a, b); ``cuts``: the
    bins of every key."""

    nodes: DataFrame
    cuts: DataFrame
    key: str
    columns: tuple[str, ...]
    rule: Rule
    trees: int
    step: float = 1.0

    def predict(self, rows: DataFrame, name: str) -> DataFrame:
        """``<name>_pred`` and ``<name>_probability``, NULL for keys without trees.

        Rows meet the trees of their key in a task; the answers come back by a row number, so that
        rows that repeat stay apart.
        """
        numbered = hand_over(rows.withColumn("_row", F.monotonically_increasing_id()), "to_score")
        found = self._answers(numbered, f"{name}_probability")
        scored = numbered.join(found, "_row", "left")
        label = (F.col(f"{name}_probability") > 0.5).cast("double").alias(f"{name}_pred")
        return scored.select(*rows.columns, label, f"{name}_probability")

    def _answers(self, rows: DataFrame, name: str) -> DataFrame:
        """(_row, chance) of the rows whose key has a tree for them. A task holds rows and models of
        its keys; rows of a key that has many are dealt out, its model to each share."""
        key, columns, trees, rule, step = self.key, self.columns, self.trees, self.rule, self.step
        value = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
        own = rows.select(key, "_row", *value).where(F.col(key).isNotNull())
        node = F.struct("tree", "node", F.coalesce("at", F.lit(-1)).alias("at"),
                        F.coalesce("bin", F.lit(0)).cast("int").alias("bin"), "a", "b")
        grouped = self.nodes.groupBy(key).agg(F.collect_list(node).alias("nodes"))
        sizes = own.groupBy(key).agg(F.ceil(F.count("*") / TASK_ROWS).cast("int").alias("parts"), F.count("*").alias("n"))
        models = self.cuts.join(grouped, key).join(sizes, key)
        models = hand_over(models, "models")
        some = _few(models.where("parts > 1").select(key, "parts"))
        part = F.pmod(F.xxhash64("_row"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
        own = own.join(some, key, "left").select(*own.columns, part)
        models = models.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        total = models.agg(F.sum(F.col("n") / F.col("parts"))).first()[0] or 0
        share = _share(total, key, "part")

        def walk(_, rows: pa.Table, models: pa.Table) -> pa.Table:
            owner, rows = _owned(rows, models, key)
            bins = trees_here.bins_of(_values(rows, len(columns)), models["cuts"].to_pylist(), owner)
            lists = models["nodes"].combine_chunks()
            flat = lists.flatten()
            nodes = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("tree", "node", "at", "bin", "a", "b")}
            of = np.repeat(np.arange(len(models)), lists.value_lengths().to_numpy())
            nodes["tree"] = of * trees + nodes["tree"]
            order = np.argsort(trees_here.codes(nodes["tree"], nodes["node"], rule.depth))
            nodes = {f: v[order] for f, v in nodes.items()}
            with np.errstate(all="ignore"):
                if rule.kind == "gini":
                    leaf = nodes["a"] / nodes["b"]
                else:
                    leaf = -step * (nodes["a"] / UNIT) / (nodes["b"] / UNIT + rule.l2)
            sums, seen = np.zeros(len(owner)), np.zeros(len(owner), np.int64)
            row = np.arange(len(owner))
            for tree in range(trees):
                place = trees_here.leaves(bins, row, owner * trees + tree, nodes, rule.depth)
                there = place >= 0
                sums[there] += leaf[place[there]]
                seen += there
            has = seen > 0
            with np.errstate(over="ignore"):
                chance = sums[has] / seen[has] if rule.kind == "gini" else 1 / (1 + np.exp(-sums[has]))
            return pa.table({"_row": rows["_row"].filter(pa.array(has)), name: pa.array(chance)})

        both = own.select("*", share).groupBy("_share").cogroup(models.select("*", share).groupBy("_share"))
        return both.applyInArrow(walk, f"_row long, `{name}` double")

    def save(self, path: str) -> None:
        """Write the nodes, the bins and the settings as tables below ``path``."""
        about = {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("nodes", "cuts")}
        about["rule"] = asdict(self.rule)
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.cuts.write.mode("overwrite").parquet(f"{path}/cuts")
        said = spark.createDataFrame([(json.dumps(about),)], "about string")
        said.write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trees:
        about = json.loads(spark.read.parquet(f"{path}/about").first().about)
        about |= {"rule": Rule(**about["rule"]), "columns": tuple(about["columns"])}
        return cls(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/cuts"), **about)


def _prepared(rows: DataFrame, key: str, columns: Sequence[str], label: str, bins: int):
    """Numbered rows with values x0, x1 and so on, and (key, cuts, n)."""
    needed = rows.select(key, *columns, F.col(label).cast("long").alias("y")).na.drop("any")
    needed = hand_over(needed, "training")
    about = needed.groupBy(key).agg(_cuts(columns, bins), F.count("*").alias("n"))
    return needed.withColumn("row", F.monotonically_increasing_id()), hand_over(about, "cuts")


def _share(rows: float, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(math.ceil(rows / TASK_ROWS) or 1)).alias("_share")


def _values(rows: pa.Table, width: int) -> list[np.ndarray]:
    """The columns x0, x1 and so on; a missing value lies below every cut."""
    return [pc.fill_null(rows[f"x{i}"], -math.inf).to_numpy() for i in range(width)]


def _owned(rows: pa.Table, keys: pa.Table, key: str) -> tuple[np.ndarray, pa.Table]:
    """The rows whose key, and part of it, is in ``keys``, and its place there."""
    if not keys.num_rows:
        return np.zeros(0, np.int64), rows.slice(0, 0)
    own, known = rows[key], keys[key].combine_chunks()
    names = pc.unique(known)
    place = pc.index_in(own, value_set=names)
    if "part" in keys.column_names:
        most = pc.max(keys["part"]).as_py() + 1
        code = pc.add(pc.multiply(pc.index_in(known, value_set=names), most), keys["part"].combine_chunks())
        place = pc.index_in(pc.add(pc.multiply(place, most), rows["part"]), value_set=code)
    there = pc.is_valid(place)
    return place.filter(there).to_numpy().astype(np.int64), rows.filter(there)


def _grown_in_tasks(
    rows: DataFrame, keys: DataFrame, key: str, columns: Sequence[str], rule: Rule, trees: int, draws: Column,
    grow: Callable[..., dict[str, np.ndarray]],
) -> DataFrame:
    """The nodes of all trees of ``keys`` (key, cuts, n); a task holds all rows of its keys.

    ``draws`` says for every tree how often a row is in it, and ``grow`` makes of (y, bins, draws,
    keys of the rows, columns allowed) the nodes, whose trees are numbered through over the keys.
    """
    total = keys.agg(F.sum("n")).first()[0] or 0
    share, width, depth = _share(total, key), len(columns), rule.depth
    value = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    rows = rows.select(key, "y", *value, draws.alias("draws"), "row", share)
    listed, wanted = (2**depth - 1 if rule.per_node else 1), rule.columns or width
    keys = keys.select(key, "cuts", share)
    if _draws_columns(rule, width):
        every = F.sequence(F.lit(0), F.lit(trees - 1))
        at = F.sequence(F.lit(1).cast("long"), F.lit(listed).cast("long"))
        own = lambda t: F.transform(at, lambda n: _columns_of(rule, width, key, t, n))
        keys = keys.withColumn("allowed", F.flatten(F.flatten(F.transform(every, own))))
    fields_ = "tree int, node long, at int, bin short, gain double, a long, b long"
    schema = T.StructType([rows.schema[key], *T.StructType.fromDDL(fields_).fields])

    def fit(_, rows: pa.Table, keys: pa.Table) -> pa.Table:
        owner, rows = _owned(rows.sort_by("row"), keys, key)
        bins = trees_here.bins_of(_values(rows, width), keys["cuts"].to_pylist(), owner)
        times = rows["draws"].combine_chunks().flatten().to_numpy().reshape(len(owner), trees)
        if "allowed" in keys.column_names:
            drawn = keys["allowed"].combine_chunks().flatten().to_numpy()
            drawn = drawn.reshape(keys.num_rows * trees, listed, wanted)
            allowed = lambda tree, node: drawn[tree, node - 1 if rule.per_node else 0]
        else:
            allowed = lambda tree, node: np.tile(np.arange(width), (len(tree), 1))
        found = grow(rows["y"].to_numpy(), bins, times, owner, allowed)
        none = found["at"] < 0
        columns = {key: keys[key].combine_chunks().take(pa.array(found["tree"] // trees))}
        columns["tree"] = pa.array(found["tree"] % trees, pa.int32())
        columns["node"] = pa.array(found["node"], pa.int64())
        columns["at"] = pa.array(found["at"], pa.int32(), mask=none)
        columns["bin"] = pa.array(found["bin"], pa.int16(), mask=none)
        columns["gain"] = pa.array(found["gain"], pa.float64(), mask=none)
        columns |= {n: pa.array(found[n], pa.int64()) for n in ("a", "b")}
        return pa.table(columns)

    both = rows.groupBy("_share").cogroup(keys.groupBy("_share"))
    return hand_over(both.applyInArrow(fit, schema), "trees")


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def _fitted(
    rows: DataFrame, keys: DataFrame, key: str, columns: Sequence[str], rule: Rule,
    few_rows: int, in_tasks: Callable[[DataFrame, DataFrame], DataFrame], over_all: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Nodes of the keys of few rows by ``in_tasks``, of the others by ``over_all``."""
    if rule.per_node and rule.depth > LISTED_DEPTH:
        few_rows = -1
    small = F.col("n") <= few_rows
    n_large, n_small = keys.select(F.count_if(~small), F.count_if(small)).first()
    if not n_large:
        return in_tasks(rows, keys.where(small))
    large = keys.where(~small).select(key, "cuts")
    held = hand_over(binned(rows, large, key, columns).select(key, "y", "bins", "row"), "binned")
    nodes = over_all(held)
    if n_small:
        others = rows.join(_few(large.select(key)), key, "left_anti")
        nodes = nodes.unionByName(in_tasks(others, keys.where(small)))
    return hand_over(nodes, "trees")


def _drawn(*what: object) -> Column:
    """A number in [0, 1) that a hash decides."""
    return _drawn_part(*what) / F.lit(float(_PARTS))


def _drawn_part(*what: object) -> Column:
    """The same in whole parts, of which 1 has ``_PARTS``."""
    parts = [w if isinstance(w, Column) else F.lit(w) for w in what]
    return F.pmod(F.xxhash64(*parts), F.lit(_PARTS))


def _for_each(trees: int, f: Callable[[Column], Column]) -> Column:
    """An array of ``f`` of every tree's number; written out while it is short, which runs compiled."""
    if trees <= 32:
        return F.array(*[f(F.lit(t)) for t in range(trees)])
    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), f)


def forest_by_key(
    rows: DataFrame,
    key: str = "symbol",
    columns: Sequence[str] = FEATURES,
    label: str = "target",
    *,
    trees: int = 20,
    depth: int = 5,
    per_node: int | None = None,
    bootstrap: bool = True,
    bins: int = BINS,
    seed: int = 42,
    few_rows: int = FEW_ROWS,
) -> Trees:
    """Random forests of all keys. A row is in a tree as often as a Poisson draw with mean 1 says,
    a node tries the square root of the columns unless ``per_node`` says otherwise."""
    prepared, about = _prepared(rows, key, columns, label, bins)
    width = len(columns)
    wanted = per_node or max(1, round(math.sqrt(width)))
    rule = Rule("gini", depth, 1, columns=wanted, per_node=True, seed=seed)
    every = F.sequence(F.lit(0), F.lit(trees - 1))

    def times(tree: Column) -> Column:
        if not bootstrap:
            return F.lit(1)
        u, count = _drawn_part(seed, F.col("row"), tree), F
        for n, p in enumerate(_POISSON):
            count = count.when(u < F.lit(math.ceil(p * _PARTS)), n)
        return count.otherwise(len(_POISSON))

    def grow(y, bins, times, owner, allowed):
        # So many trees at a time that their entries stay few.
        some, found = max(1, ENTRIES // max(1, len(owner))), []
        for first in range(0, trees, some):
            row, tree = np.nonzero(times[:, first : first + some])
            b = times[row, first + tree].astype(np.int64)
            found.append(trees_here.grown(bins, row, owner[row] * trees + first + tree, b * y[row], b,
                                          allowed, rule.score_here, depth, rule.least_sum))
        return _joined(found)

    def in_tasks(rows: DataFrame, keys: DataFrame) -> DataFrame:
        drawn = _for_each(trees, lambda t: times(t).cast("byte"))
        return _grown_in_tasks(rows, keys, key, columns, rule, trees, drawn, grow)

    def over_all(held: DataFrame) -> DataFrame:
        state = held.withColumn("tree", F.explode(every))
        state = state.withColumn("b", times(F.col("tree")).cast("long")).where("b > 0")
        state = state.select(key, "tree", F.lit(1).cast("long").alias("node"), "bins",
                             (F.col("b") * F.col("y")).alias("a"), "b")
        return _grown(state, key, rule, width)

    nodes = _fitted(prepared, about, key, columns, rule, few_rows, in_tasks, over_all)
    return Trees(nodes, about.select(key, "cuts"), key, tuple(columns), rule, trees)


def boost_by_key(
    rows: DataFrame,
    key: str = "symbol",
    columns: Sequence[str] = FEATURES,
    label: str = "target",
    *,
    rounds: int = 300,
    depth: int = 6,
    step: float = 0.05,
    row_share: float = 0.8,
    column_share: float = 0.8,
    l2: float = 1.0,
    least: float = 1.0,
    bins: int = BINS,
    seed: int = 42,
    few_rows: int = FEW_ROWS,
) -> Trees:
    """Second-order boosting of the logistic loss, for all keys in the same rounds.

    A round draws rows and columns for each tree, grows it on the derivatives at the margins so
    far, and adds ``step`` times the leaf value -G / (H + l2). For one model of a whole table give
    a key that is the same in all rows.
    """
    prepared, about = _prepared(rows, key, columns, label, bins)
    width = len(columns)
    wanted = max(1, round(column_share * width))
    rule = Rule("loss", depth, least, l2, wanted, seed=seed)

    def grow(y, bins, times, owner, allowed):
        margin, row, found = np.zeros(len(y)), np.arange(len(y)), []
        for tree in range(rounds):
            chance = 1 / (1 + np.exp(-margin[row]))
            used, own = times[row, tree] > 0, owner[row] * rounds + tree
            a = (chance - y[row]) * UNIT
            a = (np.sign(a) * np.floor(np.abs(a) + 0.5)).astype(np.int64)
            b = np.floor(chance * (1 - chance) * UNIT + 0.5).astype(np.int64)
            nodes = trees_here.grown(bins, row[used], own[used], a[used], b[used],
                                     allowed, rule.score_here, depth, rule.least_sum)
            found.append(nodes)
            place = trees_here.leaves(bins, row, own, nodes, depth)
            # As in the large, rows without a leaf take no part any more.
            row, place = row[place >= 0], place[place >= 0]
            margin[row] += -step * (nodes["a"][place] / UNIT) / (nodes["b"][place] / UNIT + l2)
        return _joined(found)

    def in_tasks(rows: DataFrame, keys: DataFrame) -> DataFrame:
        drawn = _for_each(rounds, lambda t: (_drawn(seed, F.col("row"), t) < row_share).cast("byte"))
        return _grown_in_tasks(rows, keys, key, columns, rule, rounds, drawn, grow)

    def over_all(held: DataFrame) -> DataFrame:
        return _boosted(held, key, width, rule, rounds, step, row_share)

    nodes = _fitted(prepared, about, key, columns, rule, few_rows, in_tasks, over_all)
    return Trees(nodes, about.select(key, "cuts"), key, tuple(columns), rule, rounds, step)


def _boosted(
    held: DataFrame, key: str, width: int, rule: Rule, rounds: int, step: float, row_share: float
) -> DataFrame:
    """The nodes of boosting over binned rows of large keys, round by round."""
    seed = rule.seed
    held, grown = held.withColumn("margin", F.lit(0.0)), []
    unit = F.lit(float(UNIT))
    for tree in range(rounds):
        chance = 1 / (1 + F.exp(-F.col("margin")))
        used = held.withColumns({"tree": F.lit(tree), "node": F.lit(1).cast("long")})
        state = used.where(_drawn(seed, F.col("row"), tree) < row_share).select(
            key, "tree", "node", "bins",
            F.round((chance - F.col("y")) * unit).cast("long").alias("a"),
            F.round(chance * (1 - chance) * unit).cast("long").alias("b"),
        )
        nodes = _grown(state, key, rule, width)
        grown.append(nodes)
        if tree + 1 < rounds:
            settled = _settled(used, nodes, key, rule.depth)
            kept = [c for c in held.columns if c != "margin"]
            moved = F.col("margin") + _leaf_value(rule, step)
            held = hand_over(settled.select(*kept, moved.alias("margin")), "margins")
    nodes = grown[0]
    for more in grown[1:]:
        nodes = nodes.unionByName(more, allowMissingColumns=True)
    return hand_over(nodes, "trees")


def _leaf_value(rule: Rule, step: float) -> Column:
    """What a leaf adds to the log odds."""
    a, b = F.col("a") / F.lit(float(UNIT)), F.col("b") / F.lit(float(UNIT))
    return -step * a / (b + rule.l2)
