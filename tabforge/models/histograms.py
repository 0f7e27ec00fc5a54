"""Distributed growth of regression trees from binned features.

Spark ML has no extra-trees regressor and its boosting has no second-order regularisation, so
both are grown here. A node with more than ``LOCAL_ROWS`` rows is split where its rows are: a
level is one Spark job in which each task adds its rows into one array of (feature, bin) cells per
node, the arrays of a node meet in one shuffle, and what they sum to decides the split. A node
with fewer rows is finished by itself: its rows, one byte per feature, go to one task that grows
the subtree below it, many nodes and trees at a time on the cluster. Trees that are small from
their root share the rows that a task has received. Both ways use the same rules, cells and random
draws, which follow from the tree's number and the node's path, so they grow the same trees.

Only the chosen splits - a number fixed by the tree count and depth - reach the driver. Row
sampling hashes the key, so a model does not depend on how the table is partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..functions import fitting as fit
from ..functions.hashing import key_hash
from ..schema import q_col
from ..session import spark_cores

CELL_BYTES = 64 << 20  # histogram memory per task and pass
LOCAL_ROWS = 1 << 20  # rows of a node that one task finishes: at most this many times features + 16 bytes
LOCAL_VECTORS = 1 << 20  # different vectors of bins whose sums one task grows a tree from
PACKED_ROWS = 1 << 20  # rows that a task of that layout orders at once
CHUNK_ROWS = 1 << 16  # rows of one packed chunk of the layout by vector
DRAWN_ROWS = 1 << 14
MIN_GAIN = 1e-9
SPLITS = "tree int, path long, feature int, bin int, gain double, wl double, gl double, wr double, gr double"
SPLIT_NAMES = ("tree", "path", "feature", "bin", "gain", "wl", "gl", "wr", "gr")


@dataclass
class GrowthRules:
    max_depth: int
    min_split: float = 2.0
    min_leaf: float = 1.0
    random_cuts: bool = False
    l2: float = 0.0
    l1: float = 0.0
    gamma: float = 0.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in creation order; a leaf points to itself and its cut is never exceeded."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [255])
    left: list[int] = field(default_factory=lambda: [0])
    total: list[tuple[float, float]] = field(default_factory=lambda: [(0.0, 0.0)])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, cut: int, gain: float, sides) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for i, side in enumerate(sides):
            self.feature.append(0)
            self.cut.append(255)
            self.left.append(first + i)
            self.total.append(side)
            self.gain.append(0.0)
        return first, first + 1

    def is_leaf(self, node: int) -> bool:
        return self.left[node] == node

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature, np.int64), np.array(self.cut, np.int16), np.array(self.left, np.int64)


def place(bins: np.ndarray, arrays, depth: int) -> np.ndarray:
    """Node of every row after ``depth`` comparisons."""
    feature, cut, left = arrays
    n, width = bins.shape
    flat, base, node = bins.ravel(), np.arange(n) * width, np.zeros(n, np.int64)
    for _ in range(depth):
        node = left[node] + (flat[base + feature[node]] > cut[node])
    return node


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row hashes and a salt (the splitmix64 finaliser)."""
    z = h.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


# Cumulative Poisson(1) probabilities; a bootstrap draws each row that often.
POISSON_STEPS = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(12)])


def row_weights(h: np.ndarray, salt: int, sampling: str, rate: float) -> np.ndarray | None:
    """Multiplicity of each row in one tree; None for all ones."""
    if sampling != "bootstrap" and (sampling != "subsample" or rate >= 1.0):
        return None
    out = np.zeros(len(h))
    for first in range(0, len(h), DRAWN_ROWS):  # few enough for the arrays of a draw to stay in a core's cache
        drawn, some = mixed(h[first : first + DRAWN_ROWS], salt), out[first : first + DRAWN_ROWS]
        if sampling == "subsample":
            some[:] = drawn < rate
            continue
        for step in POISSON_STEPS:  # a few comparisons: nine rows of ten are below the third step
            above = drawn >= step
            if not above.any():
                break
            some += above
    return out


def feature_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Cut values per feature: midpoints of neighbouring values while these are few, else quantiles."""
    doubles = df.select(*[q_col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    names = doubles.columns
    levels, over = fit.sorted_levels(doubles, names, max_bins)
    edges = {n: [(a + b) / 2 for a, b in zip(v, v[1:])] for n, v in levels.items()}
    if over:
        grid = [i / max_bins for i in range(1, max_bins)]
        row = doubles.agg(*[F.percentile_approx(F.col(n), grid, 10_000).alias(n) for n in over]).first()
        edges.update({n: sorted(set(row[n])) for n in over})
    return [edges[n] for n in names]


ROWS_PER_TASK = 20_000


def binned(
    df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], edges: list[list[float]], base: float,
    seed: int, rows: int, tasks: int,
) -> DataFrame:
    """(h, r, bins): row hash, label minus ``base``, and one byte per feature.

    A table that arrives in fewer tasks than there are cores is spread by its row hash; one that
    already fills the cluster stays where it is.
    """
    grids = [np.array(e) for e in edges]

    def to_bytes(batches):
        for batch in batches:
            columns = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(grids))]
            packed = np.empty((batch.num_rows, len(grids)), np.uint8)
            for i, (grid, x) in enumerate(zip(grids, columns)):
                packed[:, i] = np.searchsorted(grid, x.astype(float), side="left")
            width = len(grids)
            offsets = pa.py_buffer(np.arange(0, (batch.num_rows + 1) * width, width, dtype=np.int32))
            blob = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(packed.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blob], ["h", "r", "bins"])

    wide = df.select(
        key_hash(key, seed).alias("h"),
        (q_col(label).cast("double") - F.lit(base)).alias("r"),
        *[q_col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)],
    )
    compact = wide.mapInArrow(to_bytes, "h long, r double, bins binary")
    wanted = min(spark_cores(df.sparkSession), max(1, rows // ROWS_PER_TASK))
    return compact.repartition(wanted, "h") if tasks < wanted else compact


def unpack(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blob = batch.column(2)
    offsets = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
    data = np.frombuffer(blob.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return (
        batch.column(0).to_numpy(zero_copy_only=False),
        batch.column(1).to_numpy(zero_copy_only=False),
        data.reshape(len(blob), width),
    )


def draws(number: int, paths: np.ndarray, features: np.ndarray, seed: int) -> np.ndarray:
    """One uniform number per node and feature, by the tree's number and the node's path (1 at the root, 2 p and 2 p + 1 below)."""
    node = mixed(paths.astype(np.uint64), seed * 1_000_003 + number)
    bits = (node * float(1 << 53)).astype(np.uint64)
    return np.stack([mixed(bits, 7919 + int(f)) for f in features], axis=1)


def _strength(g: np.ndarray, w: np.ndarray, rules: GrowthRules) -> np.ndarray:
    """Squared (shrunk) gradient sum over regularised weight."""
    shrunk = np.maximum(np.abs(g) - rules.l1, 0.0) if rules.l1 else g
    below = w + rules.l2
    return np.divide(shrunk * shrunk, below, out=np.zeros_like(below), where=below > 0)


def feature_splits(w: np.ndarray, g: np.ndarray, rules: GrowthRules, grid: np.ndarray, draw: np.ndarray):
    """(gain, bin, wl, gl, wr, gr) per node for one feature, from cells (node, bin); gain is -1 where no cut is admissible.

    Ties go to the lower bin. With random cuts there is one cut per node, at ``draw`` of the span of its values; the
    outermost bins are open and count as wide as their neighbours.
    """
    wl, gl = np.cumsum(w, axis=1), np.cumsum(g, axis=1)
    wt, gt = wl[:, -1:], gl[:, -1:]
    if rules.random_cuts:
        if not len(grid):
            none = np.zeros(len(w))
            return none - 1, none.astype(int), none, none, none, none
        filled = w > 0
        first = filled.argmax(axis=1)
        last = w.shape[1] - 1 - filled[:, ::-1].argmax(axis=1)
        low = np.where(first > 0, grid[np.maximum(first, 1) - 1], grid[0] * 2 - grid[min(1, len(grid) - 1)])
        high = np.where(last < len(grid), grid[np.minimum(last, len(grid) - 1)], grid[-1] * 2 - grid[max(len(grid) - 2, 0)])
        cut = np.searchsorted(grid, low + draw * (high - low), side="left")
        at = np.maximum(np.minimum(cut, last - 1), first)[:, None]
        wl, gl = np.take_along_axis(wl, at, 1), np.take_along_axis(gl, at, 1)
    wr, gr = wt - wl, gt - gl
    gain = _strength(gl, wl, rules) + _strength(gr, wr, rules) - _strength(gt, wt, rules)
    gain = np.where((wl >= rules.min_leaf) & (wr >= rules.min_leaf) & (wl > 0) & (wr > 0) & (gain > MIN_GAIN), gain, -1.0)
    best = gain.argmax(axis=1)[:, None]
    take = lambda x: np.take_along_axis(x, best, 1)[:, 0]
    return take(gain), (at if rules.random_cuts else best)[:, 0], take(wl), take(gl), take(wr), take(gr)


def choose(cells, usable: Sequence[int], rules: GrowthRules, grids: list[np.ndarray], number: int, paths: np.ndarray) -> dict[str, np.ndarray]:
    """The best split of every node; ``cells(f)`` gives (weights, sums) of feature f, by (node, bin). Ties go to the lower feature."""
    draw = draws(number, paths, np.array(usable), rules.seed) if rules.random_cuts else np.zeros((len(paths), len(usable)))
    best = None
    for i, f in enumerate(usable):
        found = feature_splits(*cells(f), rules, grids[f], draw[:, i])
        if best is None:
            best = {"feature": np.full(len(paths), f), **dict(zip(("gain", "bin", "wl", "gl", "wr", "gr"), found))}
        else:
            better = found[0] > best["gain"]
            best["feature"] = np.where(better, f, best["feature"])
            for name, value in zip(("gain", "bin", "wl", "gl", "wr", "gr"), found):
                best[name] = np.where(better, value, best[name])
    return {"path": paths, **best}


def opened(found: dict[str, np.ndarray], rules: GrowthRules) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The splits that the rules allow, and for each whether its left and right child may be split again."""
    good = (found["gain"] > 0) & (found["wl"] + found["wr"] >= rules.min_split)
    kept = {k: v[good] for k, v in found.items()}
    least = max(rules.min_split, 2 * rules.min_leaf)
    return kept, np.stack((kept["wl"], kept["wr"]), axis=1) >= least


def grow_rows(
    columns: list[np.ndarray], w: np.ndarray | None, g: np.ndarray, rules: GrowthRules, grids: list[np.ndarray], number: int,
    usable: Sequence[int], path: int = 1, level: int = 0,
) -> list[dict[str, np.ndarray]]:
    """Splits of the subtree at ``path``, level by level, from the bins (one column per feature), weights and sums of its rows."""
    n_bins = max(map(len, grids)) + 1
    paths, at, out = np.array([path]), np.zeros(len(g), np.int64), []
    for _ in range(level, rules.max_depth):
        if not len(paths) or not len(g):
            break
        parts = []
        # nodes are taken in blocks whose cells stay within the memory of a pass
        most = max(1, CELL_BYTES // (n_bins * 64))
        for first in range(0, len(paths), most):
            k = min(most, len(paths) - first)
            here = None if len(paths) <= most else np.flatnonzero((at >= first) & (at < first + k))
            pick = (lambda x: x) if here is None else (lambda x, here=here: x[here])
            base, sums, weight = (pick(at) - first) * n_bins, pick(g), None if w is None else pick(w)

            def cells(f):
                code = base + pick(columns[f])
                return np.bincount(code, weight, k * n_bins).astype(float).reshape(k, n_bins), np.bincount(code, sums, k * n_bins).reshape(k, n_bins)

            parts.append(choose(cells, usable, rules, grids, number, paths[first : first + k]))
        found = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
        kept, going = opened(found, rules)
        out.append(kept)
        # children that may be split again get the next numbers, rows of all others go
        child = np.full((len(paths), 2), -1)
        node = np.searchsorted(paths, kept["path"])
        numbers = np.cumsum(going.ravel()).reshape(going.shape) - 1
        child[node] = np.where(going, numbers, -1)
        feature, cut = found["feature"][at], found["bin"][at]
        value = columns[usable[0]].copy()
        for f in usable[1:]:
            np.copyto(value, columns[f], where=feature == f)
        at = child[at, (value > cut).astype(np.int64)]
        stay = at >= 0
        columns = [c[stay] for c in columns]
        at, g, w = at[stay], g[stay], None if w is None else w[stay]
        paths = (kept["path"][:, None] * 2 + np.arange(2))[going]
    return out


def tree_of(splits: dict[str, np.ndarray]) -> Tree:
    """The tree of all its splits; children are numbered in the order of their parents' paths."""
    order = np.argsort(splits["path"])
    s = {k: np.asarray(v)[order] for k, v in splits.items()}
    m = len(order)
    tree = Tree()
    if not m:
        return tree
    node = np.where(s["path"] == 1, 0, 2 * np.searchsorted(s["path"], s["path"] // 2) + 1 + s["path"] % 2)
    feature, cut, left, gain = np.zeros(2 * m + 1, int), np.full(2 * m + 1, 255), np.arange(2 * m + 1), np.zeros(2 * m + 1)
    feature[node], cut[node], left[node], gain[node] = s["feature"], s["bin"], 2 * np.arange(m) + 1, s["gain"]
    weight, total = np.empty(2 * m + 1), np.empty(2 * m + 1)
    weight[0], total[0] = s["wl"][0] + s["wr"][0], s["gl"][0] + s["gr"][0]
    weight[1::2], weight[2::2], total[1::2], total[2::2] = s["wl"], s["wr"], s["gl"], s["gr"]
    tree.feature, tree.cut, tree.left, tree.gain = feature.tolist(), cut.tolist(), left.tolist(), gain.tolist()
    tree.total = list(zip(weight.tolist(), total.tolist()))
    tree.depth = int(s["path"][-1]).bit_length()
    return tree


def _table(number: int, found: dict[str, np.ndarray]) -> pa.RecordBatch:
    columns = {"tree": np.full(len(found["path"]), number), **found}
    kinds = {"tree": pa.int32(), "path": pa.int64(), "feature": pa.int32(), "bin": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds.get(c, pa.float64())) for c in SPLIT_NAMES], names=list(SPLIT_NAMES))


NO_SPLITS = _table(0, {c: np.zeros(0) for c in SPLIT_NAMES[1:]})


def level_splits(
    data: DataFrame, trees: list[tuple[int, Tree, list[int], list[int], list[int]]], grids: list[np.ndarray], rules: GrowthRules,
    sampling: str, rate: float, recent: list[tuple],
) -> DataFrame:
    """One row per open node that can be split.

    ``trees`` lists (tree number, tree, open nodes, their paths, usable features); ``recent`` holds (arrays, depth, leaf
    values) of trees whose output is not yet part of the residual column.
    """
    width, n_bins = len(grids), max(map(len, grids)) + 1
    jobs = []
    for number, tree, open_nodes, paths, usable in trees:
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[open_nodes] = np.arange(len(open_nodes))
        jobs.append((number, tree.arrays(), tree.depth, slot, paths, usable))
    shared = data.sparkSession.sparkContext.broadcast((jobs, recent))  # sized by the model settings

    def add_up(batches):
        jobs, recent = shared.value
        sums = [np.zeros((2, len(paths), width, n_bins)) for *_, paths, _ in jobs]
        for batch in batches:
            if not batch.num_rows:
                continue
            h, r, bins = unpack(batch, width)
            for arrays, depth, value in recent:
                r = r - value[place(bins, arrays, depth)]
            for (number, arrays, depth, slot, paths, usable), total in zip(jobs, sums):
                at = slot[place(bins, arrays, depth)]
                weight = row_weights(h, rules.seed * 1_000_003 + number, sampling, rate)
                inside = at >= 0 if weight is None else (at >= 0) & (weight > 0)
                rows, here = bins[inside], at[inside] * n_bins
                w = None if weight is None else weight[inside]
                g = r[inside] if w is None else r[inside] * w
                for f in usable:
                    cell, n = here + rows[:, f], len(paths) * n_bins
                    total[0, :, f, :] += np.bincount(cell, w, n).reshape(-1, n_bins)
                    total[1, :, f, :] += np.bincount(cell, g, n).reshape(-1, n_bins)
        for (number, *_, paths, _), total in zip(jobs, sums):
            blobs = [pa.array([x.tobytes() for x in part], pa.binary()) for part in total]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(paths), number, np.int32)), pa.array(paths, pa.int64()), *blobs], names=["tree", "path", "w", "g"])

    def decide(batches):
        usable_of = {number: usable for number, *_, usable in shared.value[0]}
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for number, path, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                both = np.stack([np.frombuffer(x).reshape(width, n_bins) for x in blobs])
                sums[(number, path)] = sums[(number, path)] + both if (number, path) in sums else both
        for (number, path), both in sums.items():
            found = choose(lambda f: both[:, None, f, :], usable_of[number], rules, grids, number, np.array([path]))  # noqa: B023
            yield _table(number, opened(found, rules)[0])

    # every task sends its cells once, so the number of tasks decides the shuffle volume
    cells = data.coalesce(2 * spark_cores(data.sparkSession)).mapInArrow(add_up, "tree int, path long, w binary, g binary")
    return cells.repartition("tree", "path").mapInArrow(decide, SPLITS)


def finished(
    data: DataFrame, units: list[tuple[int, Tree, list[int], list[int]]], usable: dict[int, list[int]], grids: list[np.ndarray],
    rules: GrowthRules, sampling: str, rate: float, recent: list[tuple],
) -> DataFrame:
    """Splits below nodes of at most ``LOCAL_ROWS`` rows; ``units`` lists (tree number, tree so far, nodes, their paths).

    The rows of a node go to one group, as packed arrays. Trees without a split share groups: each gets the table once and
    grows several trees from it.
    """
    width = len(grids)
    whole = [u for u in units if u[2] == [0]]
    n_groups = min(len(whole), spark_cores(data.sparkSession))
    parts = max(n_groups, spark_cores(data.sparkSession))
    group_ids = _one_key_each(data.sparkSession, parts)[:n_groups]
    alone = [(number, tree.arrays(), tree.depth, list(zip(nodes, paths))) for number, tree, nodes, paths in units if nodes != [0]]
    work = {unit: [(number, 1) for number, *_ in whole[i::n_groups]] for i, unit in enumerate(group_ids)}
    keys: dict[tuple[int, int], int] = {}
    following = max(group_ids, default=-1) + 1
    for number, _, _, own in alone:
        for _, path in own:
            keys[(number, path)] = following + len(keys)
            work[keys[(number, path)]] = [(number, path)]
    shared = data.sparkSession.sparkContext.broadcast((work, alone, keys, recent))  # sized by the model settings

    def send(batches):
        _, alone, keys, recent = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            h, r, bins = unpack(batch, width)
            for arrays, depth, value in recent:
                r = r - value[place(bins, arrays, depth)]
            out = [(i, h.tobytes(), r.tobytes(), bins.tobytes()) for i in group_ids]
            for number, arrays, depth, own in alone:
                at = place(bins, arrays, depth)
                if sampling != "all":
                    weight = row_weights(h, rules.seed * 1_000_003 + number, sampling, rate)
                    at = at if weight is None else np.where(weight > 0, at, -1)
                for node, path in own:
                    rows = np.flatnonzero(at == node)
                    if len(rows):
                        out.append((keys[(number, path)], h[rows].tobytes(), r[rows].tobytes(), bins[rows].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i] for o in out], pa.binary()) for i in (1, 2, 3)]], names=["unit", "h", "r", "bins"])

    def finish(key, table):
        parts = list(zip(*(table.column(i).to_pylist() for i in (1, 2, 3))))
        h, r = (np.concatenate([np.frombuffer(p[i], kind) for p in parts]) for i, kind in ((0, np.int64), (1, np.float64)))
        bins = np.concatenate([np.frombuffer(p[2], np.uint8).reshape(-1, width) for p in parts])
        columns, w, g = [bins[:, f].astype(np.int64) for f in range(width)], None, r
        if sampling == "all":  # rows with the same bins count as one
            columns, w, g = combined(columns, r, grids)
        grown = []
        for number, path in shared.value[0][key[0].as_py()]:
            own, weight, sums = columns, w, g
            if sampling != "all":
                weight = row_weights(h, rules.seed * 1_000_003 + number, sampling, rate)
                if weight is not None:
                    inside = weight > 0
                    own, weight, sums = [c[inside] for c in columns], weight[inside], (r * weight)[inside]
            grown += [_table(number, found) for found in grow_rows(own, weight, sums, rules, grids, number, usable[number], path, path.bit_length() - 1)]
        return pa.Table.from_batches(grown, NO_SPLITS.schema)

    sent = data.mapInArrow(send, "unit int, h binary, r binary, bins binary")
    return sent.repartition(parts, "unit").groupBy("unit").applyInArrow(finish, SPLITS)


def _one_key_each(spark, parts: int) -> list[int]:
    """For each of so many shuffle partitions a number that hashes to it, so that equal work is dealt out evenly."""
    ids = spark.range(parts * 64).select(F.col("id").cast("int").alias("unit"))
    dealt = ids.groupBy(F.pmod(F.hash("unit"), F.lit(parts)).alias("part")).agg(F.min("unit").alias("unit"))
    return sorted(r["unit"] for r in dealt.collect())


def combined(columns: list[np.ndarray], r: np.ndarray, grids: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct bin vectors with the number of their rows and the sum of their residuals."""
    code, room = np.zeros(len(r), np.int64), 1
    for c, grid in zip(columns, grids):
        room *= len(grid) + 1
        if room > 1 << 62:
            return columns, None, r
        code = code * (len(grid) + 1) + c
    _, first, which, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    return [c[first] for c in columns], n.astype(float), np.bincount(which, r, len(first))


def grow(
    data: DataFrame, rows: int, numbers: Sequence[int], usable: dict[int, list[int]], edges: list[list[float]], rules: GrowthRules,
    sampling: str, rate: float, recent: Sequence[tuple] = (),
) -> dict[int, Tree]:
    """Trees of the given numbers on a table of ``rows`` rows.

    Nodes above ``LOCAL_ROWS`` are split level by level, in passes that the cell memory allows: several trees, or a part of
    the open nodes of one tree. What remains is finished in one job.
    """
    grids = [np.array(e, float) for e in edges]
    width, n_bins = len(edges), max(len(e) for e in edges) + 1
    splits: dict[int, list[dict[str, np.ndarray]]] = {n: [] for n in numbers}
    trees = {n: Tree() for n in numbers}
    large = {n: [1] for n in numbers if rows > LOCAL_ROWS}
    small: dict[int, list[int]] = {n: [1] for n in numbers if rows <= LOCAL_ROWS}
    most = max(1, CELL_BYTES // (width * n_bins * 16))  # nodes of one pass
    for _ in range(rules.max_depth):
        waiting = [(n, paths[at : at + most]) for n, paths in large.items() for at in range(0, len(paths), most)]
        following: dict[int, list[int]] = {}
        while waiting:
            batch: dict[int, list[int]] = {}
            while waiting and waiting[0][0] not in batch and sum(map(len, batch.values())) + len(waiting[0][1]) <= most:
                batch.update([waiting.pop(0)])
            jobs = [(n, trees[n], _nodes(splits[n], paths), paths, usable[n]) for n, paths in batch.items()]
            for n, found in _by_tree(level_splits(data, jobs, grids, rules, sampling, rate, list(recent))):
                splits[n].append(found)
                kept, going = opened(found, rules)
                weights = np.stack((kept["wl"], kept["wr"]), axis=1)
                # weights bound the rows of a sample up to the draws of a bootstrap
                for path, (w2, go) in zip(kept["path"].tolist(), zip(weights.tolist(), going.tolist())):
                    for side in (0, 1):
                        if go[side]:
                            (following if w2[side] > LOCAL_ROWS else small).setdefault(n, []).append(2 * path + side)
        large = following
        for n in numbers:
            if splits[n]:
                trees[n] = tree_of(_joined(splits[n]))
        if not large:
            break
    units = []
    for n, paths in small.items():
        paths = sorted(p for p in paths if p.bit_length() <= rules.max_depth)
        if paths:
            units.append((n, trees[n], _nodes(splits[n], paths), paths))
    if units:
        for n, found in _by_tree(finished(data, units, usable, grids, rules, sampling, rate, list(recent))):
            splits[n].append(found)
    return {n: tree_of(_joined(splits[n])) if splits[n] else Tree() for n in numbers}


def vector_counts(data: DataFrame) -> tuple[DataFrame, int, int]:
    """(rows per vector of bins, number of vectors, rows of the most frequent one) of a binned table."""
    counts = data.groupBy("bins").agg(F.count("*").alias("n"))
    row = counts.agg(F.count("*").alias("k"), F.max("n").alias("most")).first()
    return counts, row["k"], row["most"] or 0


def by_vector(data: DataFrame, rows: int, width: int, counts: DataFrame, most: int) -> DataFrame:
    """(h, r, n, bins): chunks of rows ordered by their bins; ``bins`` has one entry per vector, ``n`` its rows in the chunk.

    The rows of a vector go to one task; those of one too frequent for that are dealt out by their hash.
    """
    parts = max(spark_cores(data.sparkSession), rows // PACKED_ROWS + 1)
    share = PACKED_ROWS // 4
    salt = F.lit(0)
    if most > share:  # fewer vectors than tasks
        frequent = counts.where(F.col("n") > share).select("bins", F.expr(f"n div {share} + 1").alias("_ways"))
        data = data.join(F.broadcast(frequent), "bins", "left")
        salt = F.coalesce(F.pmod("h", "_ways"), F.lit(0))

    def pack(batches):
        held = [unpack(b, width) for b in batches if b.num_rows]
        if not held:
            return
        h, r, bins = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((r, h, *bins.T[::-1]))  # sums do not depend on how the rows arrived
        h, r, bins = h[order], r[order], bins[order]
        for at in range(0, len(h), CHUNK_ROWS):
            here = bins[at : at + CHUNK_ROWS]
            start = np.flatnonzero(np.concatenate(([True], (here[1:] != here[:-1]).any(axis=1))))
            n = np.diff(np.append(start, len(here))).astype(np.int32)
            blobs = (h[at : at + CHUNK_ROWS], r[at : at + CHUNK_ROWS], n, here[start])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in blobs], names=["h", "r", "n", "bins"])

    laid = data.select("h", "r", "bins", salt.alias("_salt")).repartition(parts, "bins", "_salt").select("h", "r", "bins")
    return laid.mapInArrow(pack, "h binary, r binary, n binary, bins binary")


def chunks(batches, width: int):
    """(h, r, n, start, bins) of every packed chunk; ``start`` is where the rows of each vector begin."""
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            h, r, n = (np.frombuffer(x, kind) for x, kind in zip(row, (np.int64, np.float64, np.int32)))
            yield h, r, n, np.cumsum(n) - n, np.frombuffer(row[3], np.uint8).reshape(-1, width)


def vector_sums(h, r, n, start, salt: int, sampling: str, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and weighted sums of each vector of a chunk in one tree's sample."""
    weight = row_weights(h, salt, sampling, rate)
    if weight is None:
        return n.astype(float), np.add.reduceat(r, start)
    return np.add.reduceat(weight, start), np.add.reduceat(r * weight, start)


def merge_order(bins: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal vectors stand together, whatever the order of arrival, and where each begins in it."""
    order = np.lexsort((g, *bins.T[::-1]))
    ordered = bins[order]
    return order, np.flatnonzero(np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1))))


def _code(columns: list[np.ndarray], grids: list[np.ndarray], used: Sequence[int]) -> np.ndarray:
    code = np.zeros(len(columns[0]), np.int64)
    for f in used:
        code = code * (len(grids[f]) + 1) + columns[f]
    return code


def _every(grids: list[np.ndarray], used: Sequence[int]) -> list[np.ndarray]:
    """Bins of every combination of the used features, one column per feature; the others are zeros."""
    sizes = [len(grids[f]) + 1 for f in used]
    found = dict(zip(used, np.indices(sizes).reshape(len(sizes), -1)))
    return [found[f] if f in found else np.zeros(math.prod(sizes), np.int64) for f in range(len(grids))]


def combinations(
    columns: list[np.ndarray], w: np.ndarray, g: np.ndarray, grids: list[np.ndarray], usable: Sequence[int]
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The rows added up by the bins of the usable features, where these have fewer combinations than there are rows."""
    room = math.prod(len(grids[f]) + 1 for f in usable)
    if room >= len(w):
        return columns, w, g
    code = _code(columns, grids, usable)
    return _every(grids, usable), np.bincount(code, w, room), np.bincount(code, g, room)


def place_vectors(columns: list[np.ndarray], grids: list[np.ndarray], tree: Tree) -> np.ndarray:
    """Node of every vector; a tree of few features is followed once per combination of their bins."""
    used = sorted({tree.feature[node] for node in range(len(tree.left)) if not tree.is_leaf(node)})
    if not used:
        return np.zeros(len(columns[0]), np.int64)
    if math.prod(len(grids[f]) + 1 for f in used) >= len(columns[0]):
        return place(np.stack(columns, axis=1), tree.arrays(), tree.depth)
    return place(np.stack(_every(grids, used), axis=1), tree.arrays(), tree.depth)[_code(columns, grids, used)]


def grow_by_vector(
    packed: DataFrame, numbers: Sequence[int], usable: dict[int, list[int]], edges: list[list[float]], rules: GrowthRules,
    sampling: str, rate: float,
) -> dict[int, Tree]:
    """Trees of the given numbers from the packed chunks of :func:`by_vector`.

    A tree's sums go to one task that grows it; trees on all rows share the sums that a task has received.
    """
    grids, width = [np.array(e, float) for e in edges], len(edges)
    numbers, cores = list(numbers), spark_cores(packed.sparkSession)
    n_groups = min(len(numbers), cores) if sampling == "all" else len(numbers)
    parts = max(n_groups, 1)
    work = {unit: numbers[i::n_groups] for i, unit in enumerate(_one_key_each(packed.sparkSession, parts)[:n_groups])}

    def send(batches):
        for h, r, n, start, bins in chunks(batches, width):
            if sampling == "all":
                found = [(unit, *vector_sums(h, r, n, start, 0, sampling, rate)) for unit in list(work)[:1]]
                found += [(unit, *found[0][1:]) for unit in list(work)[1:]]
            else:
                found = [(unit, *vector_sums(h, r, n, start, rules.seed * 1_000_003 + own[0], sampling, rate)) for unit, own in work.items()]
            out = [(unit, bins[w > 0].tobytes(), w[w > 0].tobytes(), g[w > 0].tobytes()) for unit, w, g in found]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i] for o in out], pa.binary()) for i in (1, 2, 3)]], names=["unit", "bins", "w", "g"])

    def finish(key, table):
        bins, w, g = (
            np.frombuffer(b"".join(table.column(i).to_pylist()), kind) for i, kind in ((1, np.uint8), (2, np.float64), (3, np.float64))
        )
        if not len(w):
            return NO_SPLITS.schema.empty_table()
        bins = bins.reshape(-1, width)
        order, start = merge_order(bins, g)
        bins, w, g = bins[order[start]], np.add.reduceat(w[order], start), np.add.reduceat(g[order], start)
        columns = [bins[:, f].astype(np.int64) for f in range(width)]
        grown = [_table(number, found) for number in work[key[0].as_py()] for found in grow_rows(columns, w, g, rules, grids, number, usable[number])]
        return pa.Table.from_batches(grown, NO_SPLITS.schema)

    sent = packed.mapInArrow(send, "unit int, bins binary, w binary, g binary")
    grown = dict(_by_tree(sent.repartition(parts, "unit").groupBy("unit").applyInArrow(finish, SPLITS)))
    return {n: tree_of(grown[n]) if n in grown else Tree() for n in numbers}


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in SPLIT_NAMES[1:]}


def _nodes(parts: list[dict[str, np.ndarray]], paths: list[int]) -> list[int]:
    """Node numbers of open paths, as :func:`tree_of` gives them."""
    if not parts:
        return [0] * len(paths)
    known = np.sort(np.concatenate([p["path"] for p in parts]))
    at = np.array(paths)
    return (2 * np.searchsorted(known, at // 2) + 1 + at % 2).tolist()


def _by_tree(splits: DataFrame):
    """(tree number, splits) of a table whose size follows the model settings."""
    table = splits.toArrow().to_pandas()
    for number, own in table.groupby("tree"):
        yield int(number), {k: own[k].to_numpy() for k in SPLIT_NAMES[1:]}


def prune(tree: Tree, gamma: float) -> None:
    """Undo splits into two leaves whose gain is below ``gamma``, from the bottom up."""
    for node in reversed(range(len(tree.feature))):
        if not tree.is_leaf(node) and tree.gain[node] < gamma:
            a = tree.left[node]
            if tree.is_leaf(a) and tree.is_leaf(a + 1):
                tree.left[node], tree.cut[node], tree.feature[node], tree.gain[node] = node, 255, 0, 0.0


def keep(data: DataFrame) -> DataFrame:
    return data.persist(StorageLevel.MEMORY_AND_DISK)
