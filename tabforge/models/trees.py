"""Tree ensembles grown by :mod:`histograms`: extra trees, bagged forests, regularised boosting."""

from __future__ import annotations

import copy
import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import key_hash
from ..schema import q_col
from ..session import stored
from ..sources.writers import read_json_record, write_json_record
from . import histograms as hg

REFRESH = 10  # boosting rounds after which residuals are stored anew
MEMO_CELLS = 1 << 22  # cells between the cuts of an ensemble whose predictions a worker keeps: 9 bytes each
WALK_ROWS = 1 << 12
NODES = "tree int, node int, feature int, threshold double, left_child int, value double, gain double, weight double"
NODE_FIELDS = pa.schema([(c, pa.int32() if kind == "int" else pa.float64()) for c, kind in (x.split(" ") for x in NODES.split(", "))])


@dataclass
class _Packed:
    """Nodes of all trees in a row: a row's place among the cuts of ``feature`` is at most ``cut`` on the way to ``left``, else to the
    node after it. A leaf is its own left child and its cut is never exceeded. ``trees`` lists (root, depth)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    trees: list[tuple[int, int]]

    def walk(self, places: np.ndarray) -> np.ndarray:
        """Sums of leaf values, row by row."""
        total = np.zeros(len(places))
        for first in range(0, len(places), WALK_ROWS):  # few enough for the arrays of a step to stay in a core's cache
            some = places[first : first + WALK_ROWS]
            flat, row = some.ravel(), np.arange(len(some)) * places.shape[1]
            for root, depth in self.trees:
                node = np.full(len(some), root)
                for _ in range(depth):
                    node = self.left[node] + (flat[row + self.feature[node]] > self.cut[node])
                total[first : first + WALK_ROWS] += self.value[node]
        return total

    def table_steps(self, shape: list[int]) -> int:
        """What :meth:`table` costs, in steps of a row in :meth:`walk`."""
        axes = sum(n > 1 for n in shape)
        return len(self.trees) * math.prod(shape) * (axes + 2) // 2 + (len(self.left) << axes)

    def table(self, shape: list[int]) -> np.ndarray:
        """The same sums for every combination of places: each leaf fills a box.

        Corners of the boxes get plus or minus the number of the leaf; running sums along all axes then number every place exactly.
        """
        axes = [f for f, n in enumerate(shape) if n > 1] or [0]
        low, high = np.zeros((len(self.left), len(shape)), np.int32), np.empty((len(self.left), len(shape)), np.int32)
        level = np.array([root for root, _ in self.trees])
        high[level] = shape
        is_leaf = self.left == np.arange(len(self.left))
        while len(level := level[~is_leaf[level]]):
            child, f, at = self.left[level], self.feature[level], self.cut[level] + 1
            for side in (child, child + 1):
                low[side], high[side] = low[level], high[level]
            # a cut outside its node's box leaves one child empty
            high[child, f] = np.minimum(high[child, f], at)
            low[child + 1, f] = np.maximum(low[child + 1, f], at)
            level = np.concatenate((child, child + 1))
        filled = is_leaf & (low < high).all(axis=1)
        room = [shape[f] + 1 for f in axes]
        inner, total, leaf = tuple(slice(n - 1) for n in room), np.zeros([n - 1 for n in room]), np.zeros(room, np.int32)
        for (root, _), end in zip(self.trees, [*(r for r, _ in self.trees[1:]), len(self.left)]):
            own = np.flatnonzero(filled[root:end])
            at, sign = np.zeros((len(own), 1), np.int64), np.ones(1)
            for f, n in zip(axes, room):
                sides = np.stack((low[root + own, f], high[root + own, f]), axis=1)
                at, sign = (at[:, :, None] * n + sides[:, None, :]).reshape(len(own), -1), np.outer(sign, (1.0, -1.0)).ravel()
            leaf[...] = 0
            np.add.at(leaf.ravel(), at.ravel(), np.outer(own, sign).ravel().astype(np.int32))
            for axis in range(len(axes) - 1):  # whole slices at a time
                along = np.moveaxis(leaf, axis, 0)
                for i in range(1, len(along)):
                    along[i] += along[i - 1]
            np.cumsum(leaf, axis=-1, dtype=np.int32, out=leaf)
            total += self.value[root:end].take(leaf[inner])
        return total.ravel()


@dataclass
class TreeEnsemble:
    """Fitted trees as a table of nodes; prediction = ``base`` + ``share`` x sum of leaf values."""

    features: list[str]
    nodes: pd.DataFrame
    base: float
    share: float
    averaged_gain: bool = False
    settings: dict = field(default_factory=dict)
    _sent: tuple | None = field(default=None, init=False, repr=False, compare=False)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        context = df.sparkSession.sparkContext
        if self._sent is None or self._sent[0] is not context:
            # once per model, so that every table it scores uses the same memo; size fixed by the model settings, not by the data
            self._sent = (context, context.broadcast((*self._packed(), {})))
        shared, most = self._sent[1], MEMO_CELLS
        base, share = self.base, self.share

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            packed, cuts, memo = shared.value
            # a row's way through the trees depends only on where its values stand among the cuts: a missing one stands above all
            cell = [np.searchsorted(c, v.to_numpy(float), side="left") for c, v in zip(cuts, columns)]
            places, shape = np.stack(cell, axis=1), [len(c) + 1 for c in cuts]
            if math.prod(shape) > most:
                return pd.Series(base + share * packed.walk(places))
            at = np.zeros(len(places), np.int64)
            for n, place in zip(shape, cell):
                at = at * n + place
            if "known" not in memo:
                memo["known"], memo["total"], memo["walked"] = np.zeros(math.prod(shape), bool), np.empty(math.prod(shape)), 0
            new = ~memo["known"][at]
            fresh, first = np.unique(at[new], return_index=True)
            memo["walked"] += len(fresh)
            if len(fresh) and memo["walked"] * sum(depth for _, depth in packed.trees) > packed.table_steps(shape):
                memo["total"] = packed.table(shape)
                memo["known"][:] = True
            elif len(fresh):
                memo["total"][fresh] = packed.walk(places[new][first])
                memo["known"][fresh] = True
            return pd.Series(base + share * memo["total"][at])

        return df.withColumn(out, predict(*[q_col(c).cast("double") for c in self.features]))

    def __getstate__(self):
        return {**self.__dict__, "_sent": None}  # a broadcast belongs to its session

    def _packed(self) -> tuple[_Packed, list[np.ndarray]]:
        """All trees in one row of nodes, and the cuts of each feature."""
        nodes = self.nodes.sort_values(["tree", "node"])
        sizes = nodes.groupby("tree", sort=True).size().to_numpy()
        root = np.cumsum(sizes) - sizes
        own = nodes["left_child"].to_numpy(np.int64)
        left = own + np.repeat(root, sizes)
        split, feature, threshold = left != np.arange(len(left)), nodes["feature"].to_numpy(np.int64), nodes["threshold"].to_numpy(float)
        cuts = [np.unique(threshold[split & (feature == f)]) for f in range(len(self.features))]
        cut = np.full(len(left), np.iinfo(np.int64).max)
        for f, c in enumerate(cuts):
            here = split & (feature == f)
            cut[here] = np.searchsorted(c, threshold[here])
        trees = [(int(r), _depth(own[r : r + n])) for r, n in zip(root, sizes)]
        return _Packed(feature, cut, left, nodes["value"].to_numpy(float), trees), cuts

    def importances(self) -> dict[str, float]:
        """Shares that sum to 1: mean impurity decrease per tree, or mean gain per split for boosting."""
        splits = self.nodes[self.nodes["left_child"] != self.nodes["node"]]
        total = np.zeros(len(self.features))
        if self.averaged_gain:
            for f, gains in splits.groupby("feature")["gain"]:
                total[int(f)] = gains.mean()
        else:
            for _, one in splits.groupby("tree"):
                if one["gain"].sum() > 0:
                    part = one.groupby("feature")["gain"].sum() / one["gain"].sum()
                    total[part.index.to_numpy(int)] += part.to_numpy()
        whole = total.sum()
        return {c: float(v / whole) if whole else 0.0 for c, v in zip(self.features, total)}

    def save(self, spark: SparkSession, path: str) -> str:
        spark.createDataFrame(self.nodes, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        record = {
            "features": self.features,
            "base": self.base,
            "share": self.share,
            "averaged_gain": self.averaged_gain,
            "settings": self.settings,
        }
        return write_json_record(spark, record, f"{path}/record")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeEnsemble":
        record = read_json_record(spark, f"{path}/record")
        return TreeEnsemble(nodes=spark.read.parquet(f"{path}/nodes").toPandas(), **record)


def _depth(left: np.ndarray) -> int:
    depth, level = 0, np.zeros(min(len(left), 1), np.int64)
    while True:
        inner = level[left[level] != level]
        if not len(inner):
            return depth
        depth, level = depth + 1, np.concatenate((left[inner], left[inner] + 1))


def _node_table(trees: dict[int, hg.Tree], values: dict[int, np.ndarray], edges: list[list[float]]) -> pd.DataFrame:
    # cut values of all features in a row
    begin = np.cumsum([0, *map(len, edges)])
    flat = np.array([x for e in edges for x in e] + [0.0])
    parts = []
    for number, t in trees.items():
        left, feature = np.array(t.left, np.int32), np.array(t.feature, np.int32)
        split = left != np.arange(len(left))
        at = np.where(split, begin[feature] + np.array(t.cut), len(flat) - 1)
        parts.append(
            pd.DataFrame(
                {
                    "tree": np.int32(number),
                    "node": np.arange(len(left), dtype=np.int32),
                    "feature": feature,
                    "threshold": flat[at],
                    "left_child": left,
                    "value": values[number],
                    "gain": t.gain,
                    "weight": [w for w, _ in t.total],
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def _label_summary(df: DataFrame, label: str) -> tuple[float, dict[str, int]]:
    """Mean label, and the size of the table as :func:`histograms.binned` wants it."""
    seen = df.select(q_col(label).alias("y"), F.spark_partition_id().alias("task"))
    row = seen.agg(F.count("y").alias("n"), F.avg("y").alias("m"), F.count_distinct("task").alias("t")).first()
    if not row["n"]:
        raise ValueError("no training rows")
    return float(row["m"]), {"rows": row["n"], "tasks": row["t"]}


def _by_vector(data: DataFrame, rows: int, width: int) -> tuple[DataFrame, int] | None:
    """The layout by vector of bins for a table with many rows and few vectors, and their number; None for others."""
    if rows <= hg.LOCAL_ROWS:
        return None
    counts, vectors, most = hg.vector_counts(data)
    return (hg.by_vector(data, rows, width, counts, most), vectors) if vectors <= min(hg.LOCAL_VECTORS, rows // 2) else None


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    *,
    n_estimators: int,
    max_depth: int,
    min_samples_split: int = 2,
    min_samples_leaf: int = 1,
    random_cuts: bool = False,
    bootstrap: bool = False,
    max_bins: int = 64,
    seed: int = 42,
) -> TreeEnsemble:
    """Averaged trees: random cuts on all rows (extra trees), or best cuts on bootstrap samples.

    A bootstrap weighs each row by a Poisson(1) draw from its key hash; the ``min_samples``
    rules count weighted rows.
    """
    mean, size = _label_summary(df, label)
    edges = hg.feature_edges(df, features, min(max_bins, 255))
    rules = hg.GrowthRules(max_depth, min_samples_split, min_samples_leaf, random_cuts, seed=seed)
    data = hg.keep(hg.binned(df, features, label, key, edges, mean, seed, **size))
    try:
        usable = {i: list(range(len(features))) for i in range(n_estimators)}
        how = (usable, edges, rules, "bootstrap" if bootstrap else "all", 1.0)
        packed = _by_vector(data, size["rows"], len(features))
        if packed is None:
            trees = hg.grow(data, size["rows"], range(n_estimators), *how)
        else:
            trees = hg.grow_by_vector(packed[0], range(n_estimators), *how)
    finally:
        data.unpersist()
    # a node's value is its mean residual; a tree without a split predicts the overall mean
    values = {i: np.array([g / w if w else 0.0 for w, g in t.total]) for i, t in trees.items()}
    settings = {"n_estimators": n_estimators, "max_depth": max_depth, "min_samples_split": min_samples_split,
                "min_samples_leaf": min_samples_leaf, "max_bins": max_bins}
    return TreeEnsemble(list(features), _node_table(trees, values, edges), mean, 1.0 / n_estimators, settings=settings)


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    *,
    n_estimators: int,
    max_depth: int,
    learning_rate: float,
    subsample: float = 1.0,
    colsample_bytree: float = 1.0,
    min_child_weight: float = 1.0,
    gamma: float = 0.0,
    reg_lambda: float = 1.0,
    reg_alpha: float = 0.0,
    early_stopping_rounds: int | None = None,
    validation_size: float = 0.2,
    max_bins: int = 128,
    seed: int = 42,
) -> TreeEnsemble:
    """Second-order boosting for squared error.

    With gradient sums G and row counts H, a leaf is worth -soft(G, alpha) / (H + lambda) and a
    split gains the increase of soft(G, alpha)^2 / (H + lambda), compared un-halved with gamma;
    splits under gamma are pruned bottom-up. ``early_stopping_rounds`` holds back a key-hashed
    share of the rows and stops when their error has not improved for that many rounds.

    A table of at most ``histograms.LOCAL_ROWS`` rows is boosted by one task, all rounds in a row. Of a larger one with at most
    ``histograms.LOCAL_VECTORS`` different vectors of bins, one task boosts ``REFRESH`` rounds or more at a time from the sums of the
    vectors in these rounds' samples; any other is boosted where its rows are, a round at a time. Rounds, trees and errors
    are the same.
    """
    mean, size = _label_summary(df, label)
    held = None
    if early_stopping_rounds:
        threshold = int(validation_size * 2**52)
        is_held = key_hash(key, seed + 1) < threshold
        held, df = df.where(is_held), df.where(~is_held)
    edges = hg.feature_edges(df, features, min(max_bins, 255))
    rules = hg.GrowthRules(max_depth, 0.0, min_child_weight, False, reg_lambda, reg_alpha, gamma, seed)
    plan = _Rounds(n_estimators, learning_rate, max(1, int(colsample_bytree * len(features))), len(features), early_stopping_rounds, rules)
    own = hg.binned(df, features, label, key, edges, mean, seed, **size)
    aside = hg.binned(held, features, label, key, edges, mean, seed, **size) if held is not None else None
    boost = _boosted_in_a_task if size["rows"] <= hg.LOCAL_ROWS else _boosted_large
    nodes = boost(own, aside, size["rows"], plan, edges, subsample)
    settings = {"n_estimators": int(nodes["tree"].max()) + 1, "max_depth": max_depth, "learning_rate": learning_rate, "max_bins": max_bins}
    return TreeEnsemble(list(features), nodes, mean, 1.0, averaged_gain=True, settings=settings)


@dataclass
class _Progress:
    trees: dict[int, hg.Tree] = field(default_factory=dict)
    leaf: dict[int, np.ndarray] = field(default_factory=dict)
    best_error: float = float("inf")
    best_round: int = -1
    stopped: bool = False


@dataclass(frozen=True)
class _Rounds:
    n_estimators: int
    learning_rate: float
    used: int
    width: int
    patience: int | None
    rules: hg.GrowthRules

    def run(self, grow, after, so_far: _Progress | None = None, most: int | None = None) -> _Progress:
        """Up to ``most`` further rounds; ``grow(number, usable)`` gives a round's tree, ``after(number, tree, leaf)`` the held-back error, if any."""
        state = so_far or _Progress()
        rng = np.random.default_rng(self.rules.seed)
        draws = [sorted(rng.choice(self.width, self.used, replace=False).tolist()) for _ in range(self.n_estimators)]
        for number in self.following(state, most):
            tree = grow(number, draws[number])
            hg.prune(tree, self.rules.gamma)
            # residuals are minus the gradient, so leaves move towards them
            w, g = np.array(tree.total).T
            soft = np.sign(g) * np.maximum(np.abs(g) - self.rules.l1, 0.0)
            safe = np.where(w + self.rules.l2 > 0, w + self.rules.l2, 1.0)
            state.trees[number], state.leaf[number] = tree, self.learning_rate * soft / safe
            error = after(number, tree, state.leaf[number])
            if self.patience and error is not None:
                if error < state.best_error:
                    state.best_error, state.best_round = error, number
                elif number - state.best_round >= self.patience:
                    state.stopped = True
                    break
        return state

    def following(self, state: _Progress, most: int | None = None) -> range:
        first = len(state.trees)
        return range(first, first if state.stopped else min(self.n_estimators, first + (most or self.n_estimators)))


def _kept(state: _Progress) -> tuple[dict[int, hg.Tree], dict[int, np.ndarray]]:
    """Trees up to the best round, and leaf values."""
    last = state.best_round if state.best_round >= 0 else len(state.trees) - 1
    return {i: t for i, t in state.trees.items() if i <= last}, state.leaf


def _boosted_in_a_task(own: DataFrame, aside: DataFrame | None, rows: int, plan: _Rounds, edges: list[list[float]], rate: float) -> pd.DataFrame:
    width, grids, rules = plan.width, [np.array(e, float) for e in edges], plan.rules
    table = own.withColumn("held", F.lit(False))
    if aside is not None:
        table = table.unionByName(aside.withColumn("held", F.lit(True)))

    def boost(batches):
        parts = [(*hg.unpack(b, width), b.column(3).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        h, r, bins, held = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(h, kind="stable")  # sums do not depend on how the rows arrived
        h, r, bins, held = h[order], r[order], bins[order], held[order].astype(bool)
        watch, watch_bins = r[held].copy(), bins[held]
        h, r, bins = h[~held], r[~held].copy(), bins[~held]
        columns = [bins[:, f].astype(np.int64) for f in range(width)]

        def grow(number, usable):
            weight = hg.row_weights(h, rules.seed * 1_000_003 + number, "subsample", rate)
            if weight is None:
                found = hg.grow_rows(columns, None, r, rules, grids, number, usable)
            else:
                at = np.flatnonzero(weight)
                found = hg.grow_rows([c[at] for c in columns], None, r[at], rules, grids, number, usable)
            return hg.tree_of({k: np.concatenate([p[k] for p in found]) for k in hg.SPLIT_NAMES[1:]}) if found else hg.Tree()

        def after(_, tree, leaf):
            np.subtract(r, leaf[hg.place(bins, tree.arrays(), tree.depth)], out=r)
            if len(watch):
                np.subtract(watch, leaf[hg.place(watch_bins, tree.arrays(), tree.depth)], out=watch)
                return float(np.mean(watch * watch))

        yield pa.RecordBatch.from_pandas(_node_table(*_kept(plan.run(grow, after)), edges), NODE_FIELDS)

    return table.repartition(1).mapInArrow(boost, NODES).toPandas()


def _boosted_large(own: DataFrame, aside: DataFrame | None, rows: int, plan: _Rounds, edges: list[list[float]], rate: float) -> pd.DataFrame:
    kept = [hg.keep(d) for d in (own, aside) if d is not None]
    try:
        packed = [_by_vector(d, rows, plan.width) for d in kept]
        if any(p is None for p in packed):
            return _boosted_in_place(own, aside, rows, plan, edges, rate)
        rounds = REFRESH * max(1, hg.LOCAL_VECTORS // max(vectors for _, vectors in packed))
        packed = [stored(p) for p, _ in packed]
    finally:
        for d in kept:
            d.unpersist()
    return _boosted_by_vector(packed[0], packed[1] if aside is not None else None, plan, edges, rate, rounds)


def _boosted_by_vector(own: DataFrame, aside: DataFrame | None, plan: _Rounds, edges: list[list[float]], rate: float, rounds: int) -> pd.DataFrame:
    """Boosting from the packed chunks of :func:`histograms.by_vector`, so many ``rounds`` a job.

    Which rows a round samples does not depend on the rounds before it, and what a tree adds to a residual depends on the
    vector alone: the sums of several rounds are taken at once, and the task that boosts takes from them what it has grown.
    A round that uses few features grows its tree from the sums of their combinations, which may be far fewer than the vectors.
    """
    width, grids, rules = plan.width, [np.array(e, float) for e in edges], plan.rules
    context, schema = own.sparkSession.sparkContext, "held boolean, bins binary, w binary, g binary, q double"
    state = _Progress()
    while plan.following(state, rounds):
        shared, numbers = context.broadcast(state), list(plan.following(state, rounds))  # sized by the model settings

        def send(batches, held, shared=shared, numbers=numbers):
            done = shared.value
            for h, r, n, start, bins in hg.chunks(batches, width):
                before = np.zeros(len(bins))
                for number, tree in done.trees.items():
                    before += done.leaf[number][hg.place(bins, tree.arrays(), tree.depth)]
                r = r - np.repeat(before, n)
                if held:
                    w, g = n.astype(float), np.add.reduceat(r, start)
                    # spread of the residuals around the mean of their vector
                    sums, q = [(w, g)], float(np.square(r - np.repeat(g / w, n)).sum())
                else:
                    sums = [hg.vector_sums(h, r, n, start, rules.seed * 1_000_003 + number, "subsample", rate) for number in numbers]
                    q = 0.0
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (bins, np.stack([w for w, _ in sums]), np.stack([g for _, g in sums]))]
                yield pa.RecordBatch.from_arrays([pa.array([held]), *blobs, pa.array([q])], names=["held", "bins", "w", "g", "q"])

        def boost(batches, shared=shared, numbers=numbers):
            held_rows, own_rows = [], []
            for batch in batches:
                for held, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    (held_rows if held else own_rows).append(row)
            bins, w, g = _vectors(own_rows, width)
            order, start = hg.merge_order(bins, g[0])
            bins = bins[order[start]]
            columns = [bins[:, f].astype(np.int64) for f in range(width)]
            added = np.zeros(len(bins))
            watch, spread, watched = None, 0.0, None
            if held_rows:
                watch, watched, sums = _vectors(held_rows, width)
                at = np.lexsort((sums[0], *watch.T[::-1]))
                watch, watched, sums = watch[at], watched[0][at], sums[0][at]
                watch_columns = [watch[:, f].astype(np.int64) for f in range(width)]
                off, spread = sums / watched, sum(sorted(row[3] for row in held_rows))

            def grow(number, usable):
                i = number - numbers[0]
                weight = np.add.reduceat(w[i][order], start)
                rest = np.add.reduceat(g[i][order], start) - weight * added
                own, weight, rest = hg.combinations(columns, weight, rest, grids, usable)
                inside = weight > 0
                found = hg.grow_rows([c[inside] for c in own], weight[inside], rest[inside], rules, grids, number, usable)
                return hg.tree_of({k: np.concatenate([p[k] for p in found]) for k in hg.SPLIT_NAMES[1:]}) if found else hg.Tree()

            def after(_, tree, leaf):
                np.add(added, leaf[hg.place_vectors(columns, grids, tree)], out=added)
                if watch is not None:
                    np.subtract(off, leaf[hg.place_vectors(watch_columns, grids, tree)], out=off)
                    return float((spread + (watched * off * off).sum()) / watched.sum())

            grown = plan.run(grow, after, copy.deepcopy(shared.value), rounds)  # a task that is tried again starts from the same rounds
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(grown)], pa.binary())], names=["state"])

        sums = own.mapInArrow(lambda batches, send=send: send(batches, False), schema)
        if aside is not None:
            sums = sums.unionByName(aside.mapInArrow(lambda batches, send=send: send(batches, True), schema))
        state = pickle.loads(bytes(sums.repartition(1).mapInArrow(boost, "state binary").first()["state"]))
    return _node_table(*_kept(state), edges)


def _vectors(rows: list[list], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, and weights and sums by (round, vector), of the messages of all chunks."""
    bins = np.concatenate([np.frombuffer(row[0], np.uint8).reshape(-1, width) for row in rows])
    w, g = (np.concatenate([np.frombuffer(row[i]).reshape(-1, len(row[0]) // width) for row in rows], axis=1) for i in (1, 2))
    return bins, w, g


def _boosted_in_place(own: DataFrame, aside: DataFrame | None, rows: int, plan: _Rounds, edges: list[list[float]], rate: float) -> pd.DataFrame:
    state = {"data": stored(own), "watch": stored(aside) if aside is not None else None, "recent": []}

    def grow(number, usable):
        return hg.grow(state["data"], rows, [number], {number: usable}, edges, plan.rules, "subsample", rate, state["recent"])[number]

    def after(number, tree, leaf):
        state["recent"].append((tree.arrays(), tree.depth, leaf))
        if len(state["recent"]) >= REFRESH and number + 1 < plan.n_estimators:
            # only the new trees are applied: the residuals so far are in the stored table
            for name in ("data", "watch"):
                if state[name] is not None:
                    state[name] = stored(_subtracted(state[name], state["recent"], plan.width))
            state["recent"] = []
        if state["watch"] is not None:
            return _subtracted(state["watch"], state["recent"], plan.width).agg(F.avg(F.col("r") * F.col("r"))).first()[0]

    return _node_table(*_kept(plan.run(grow, after)), edges)


def _subtracted(data: DataFrame, grown: list[tuple], width: int) -> DataFrame:
    """The table with residuals after the given further trees."""

    def subtract(batches):
        for batch in batches:
            if batch.num_rows:
                _, r, bins = hg.unpack(batch, width)
                for arrays, depth, value in grown:
                    r = r - value[hg.place(bins, arrays, depth)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(r), batch.column(2)], ["h", "r", "bins"])

    return data.mapInArrow(subtract, "h long, r double, bins binary")
