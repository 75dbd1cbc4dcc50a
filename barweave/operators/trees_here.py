"""Growing and walking histogram trees over the rows that one task holds, for ``trees_by_key``.

Entries are rows in trees. Trees have numbers from 0, nodes are numbered as in ``trees_by_key``, and
a node is looked up by its code, which puts both into one whole number.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Nodes whose cuts are tried at a time.
BLOCK_NODES = 2048

# (tree, node) -> the columns that each node may be split by, a row of numbers for each.
Allowed = Callable[[np.ndarray, np.ndarray], np.ndarray]


def bins_of(values: list[np.ndarray], cuts: list[list], owner: np.ndarray) -> np.ndarray:
    """For every row and column, how many cuts of the row's key lie below the value.

    ``cuts`` has a list of ends for each key and column. A NaN lies above every number.
    """
    out = np.empty((len(owner), len(values)), np.int16)
    for c, x in enumerate(values):
        own = [k[c] for k in cuts]
        width = max([len(o) for o in own], default=0)
        ends = np.full((len(own), width), np.nan)
        for i, o in enumerate(own):
            ends[i, : len(o)] = o
        count, missing = np.zeros(len(owner), np.int16), np.isnan(x)
        for j in range(width):
            end = ends[owner, j]
            count += (end < x) | (missing & ~np.isnan(end))
        out[:, c] = count
    return out


def grown(
    bins: np.ndarray,
    row: np.ndarray,
    tree: np.ndarray,
    a: np.ndarray,
    b: np.ndarray,
    allowed: Allowed,
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    depth: int,
    least: int,
) -> dict[str, np.ndarray]:
    """The nodes of all trees, by code: tree, node, at (-1 if none gains), bin, gain, a, b."""
    node, levels, n_bins = np.ones(len(tree), np.int64), [], int(bins.max(initial=0)) + 1
    for level in range(depth + 1):
        if not len(tree):
            break
        code = tree << (depth + 1) | node
        order = np.argsort(code, kind="stable")
        code, row, tree, node, a, b = (v[order] for v in (code, row, tree, node, a, b))
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        ends = np.append(starts[1:], len(code))
        found = {
            "tree": tree[starts], "node": node[starts],
            "at": np.full(len(starts), -1), "bin": np.zeros(len(starts), np.int64),
            "gain": np.full(len(starts), np.nan),
            "a": np.add.reduceat(a, starts), "b": np.add.reduceat(b, starts),
        }
        levels.append(found)
        if level == depth:
            break
        for first in range(0, len(starts), BLOCK_NODES):
            own = slice(first, first + BLOCK_NODES)
            rows = slice(starts[first], ends[own][-1])
            place = np.repeat(np.arange(len(starts[own])), (ends - starts)[own])
            columns = np.sort(allowed(found["tree"][own], found["node"][own]), axis=1)
            cut = _best(bins, row[rows], place, a[rows], b[rows], columns, n_bins, score, least)
            for name, values in zip(("at", "bin", "gain"), cut, strict=True):
                found[name][own] = values
        place = np.repeat(np.arange(len(starts)), ends - starts)
        at, end = found["at"][place], found["bin"][place]
        goes = at >= 0
        row, tree, a, b, at, end = (v[goes] for v in (row, tree, a, b, at, end))
        node = 2 * node[goes] + (bins[row, at] > end)
    if not levels:
        empty = np.zeros(0, np.int64)
        return {n: empty for n in ("tree", "node", "at", "bin", "a", "b")} | {"gain": np.zeros(0)}
    whole = {n: np.concatenate([x[n] for x in levels]) for n in levels[0]}
    order = np.argsort(codes(whole["tree"], whole["node"], depth), kind="stable")
    return {n: v[order] for n, v in whole.items()}


def _best(bins, row, place, a, b, columns, n_bins, score, least):
    """Column, bin and gain of every node's best cut; of equal gains the first column and bin."""
    m, w = columns.shape
    la, lb = np.empty((m, w, n_bins)), np.empty((m, w, n_bins))
    for j in range(w):
        cell = place * n_bins + bins[row, columns[place, j]]
        for sums, v in ((la, a), (lb, b)):
            cells = np.bincount(cell, v, m * n_bins).reshape(m, n_bins)
            sums[:, j] = cells.cumsum(axis=1)
    ta, tb = la[:, :, -1:], lb[:, :, -1:]
    ra, rb = ta - la, tb - lb
    with np.errstate(all="ignore"):
        gain = score(la, lb) + score(ra, rb) - score(ta, tb)
    good = (lb >= least) & (rb >= least) & (rb > 0) & (lb > 0) & (gain > 1e-9)
    gain = np.where(good, np.round(gain, 9), -np.inf).reshape(m, -1)
    best = gain.argmax(axis=1)
    most = gain[np.arange(m), best]
    has = most > -np.inf
    at = np.where(has, columns[np.arange(m), best // n_bins], -1)
    return at, np.where(has, best % n_bins, 0), np.where(has, most, np.nan)


def codes(tree: np.ndarray, node: np.ndarray, depth: int) -> np.ndarray:
    return tree.astype(np.int64) << (depth + 1) | node


def leaves(
    bins: np.ndarray, row: np.ndarray, tree: np.ndarray, nodes: dict[str, np.ndarray], depth: int
) -> np.ndarray:
    """The place in ``nodes``, which are in the order of their codes, of the leaf of each entry; -1
    where its tree has no node there."""
    known = codes(nodes["tree"], nodes["node"], depth)
    if not len(known):
        return np.full(len(row), -1)
    node = np.ones(len(row), np.int64)

    def looked_up() -> tuple[np.ndarray, np.ndarray]:
        code = codes(tree, node, depth)
        place = np.minimum(np.searchsorted(known, code), len(known) - 1)
        return place, known[place] == code

    for _ in range(depth):
        place, there = looked_up()
        at = nodes["at"][place]
        right = bins[row, np.maximum(at, 0)] > nodes["bin"][place]
        node = np.where(there & (at >= 0), 2 * node + right, node)
    place, there = looked_up()
    return np.where(there, place, -1)
