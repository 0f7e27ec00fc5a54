"""Isolation forest on one column.

Trees grow on samples of at most 256 rows, so their size does not depend on the table. On a
single column the average path length is a step function; the fitted forest is that function
(sorted break points and one level per interval), evaluated by binary search.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import HASH_RANGE, key_hash
from ..schema import q_col

TREES = 100
SAMPLE_ROWS = 256
EULER_GAMMA = 0.5772156649015329


def average_path(n: int) -> float:
    """Expected depth of an unsuccessful search in a binary tree of ``n`` keys."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


@dataclass
class IsolationSteps:
    """``score[i]`` holds for values in (``breaks[i-1]``, ``breaks[i]``]; missing values take ``fill``."""

    breaks: np.ndarray
    score: np.ndarray
    fill: float

    def anomaly(self, x: Column) -> Column:
        breaks, score = self.breaks, self.score

        @F.pandas_udf("double")
        def evaluate(v: pd.Series) -> pd.Series:
            return pd.Series(score[np.searchsorted(breaks, v.to_numpy(), side="left")])

        return evaluate(F.coalesce(x.cast("double"), F.lit(self.fill)))

    def outlier(self, x: Column, threshold: float = 0.5) -> Column:
        return self.anomaly(x) > threshold


def _tree_intervals(values: np.ndarray, rng: np.random.Generator, depth_limit: int):
    """Leaves of one random tree from left to right as (upper bound, path length)."""
    leaves: list[tuple[float, float]] = []
    pending = [(np.sort(values), 0, math.inf)]
    while pending:
        v, depth, upper = pending.pop()
        if depth >= depth_limit or len(v) < 2 or v[0] == v[-1]:
            leaves.append((upper, depth + average_path(len(v))))
            continue
        cut = rng.uniform(v[0], v[-1])
        at = int(np.searchsorted(v, cut, side="right"))
        pending.append((v[at:], depth + 1, upper))  # popped after the left part
        pending.append((v[:at], depth + 1, cut))
    return leaves


def fit_isolation(
    df: DataFrame, column: str, *, key: Sequence[str] = (), seed: int = 42, trees: int = TREES
) -> IsolationSteps:
    """Fit on mean-filled values. ``key`` names the columns whose hash picks the samples."""
    if not key:
        raise ValueError("isolation sampling needs key columns, so that the sample does not depend on partitioning")
    base = df.agg(F.count("*").alias("n"), F.avg(q_col(column)).alias("mean")).first()
    if not base["n"] or base["mean"] is None:
        return IsolationSteps(np.array([]), np.array([0.0]), 0.0)
    # every tree draws from all rows: those whose hash with the tree's number is lowest. The threshold lets
    # through twice the sample and more in expectation, so the sample is the same as without it.
    share = min(1.0, (2 * SAMPLE_ROWS + 128) / base["n"])
    rows = df.select(
        F.coalesce(q_col(column).cast("double"), F.lit(base["mean"])).alias("x"), key_hash(key, seed).alias("h")
    )
    draw = lambda t: F.pmod(F.xxhash64("h", t), F.lit(int(HASH_RANGE)))
    picked = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < int(share * HASH_RANGE))
    drawn = rows.select(F.explode(picked).alias("tree"), "x", "h").withColumn(
        "at", F.row_number().over(Window.partitionBy("tree").orderBy(draw(F.col("tree")), "h", "x"))
    )
    sample = drawn.where(F.col("at") <= SAMPLE_ROWS)
    size = min(SAMPLE_ROWS, base["n"])
    depth_limit = math.ceil(math.log2(max(size, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        leaves = _tree_intervals(pdf["x"].to_numpy(), rng, depth_limit)
        return pd.DataFrame({"tree": tree, "upper": [u for u, _ in leaves], "path": [p for _, p in leaves]})

    grown = sample.select("tree", "x").groupBy("tree").applyInPandas(grow, "tree int, upper double, path double")
    # at most trees x 256 rows
    steps = grown.toPandas().sort_values(["tree", "upper"])
    breaks = np.unique(steps.loc[np.isfinite(steps["upper"]), "upper"].to_numpy())
    total = np.zeros(len(breaks) + 1)
    probes = np.append(breaks, math.inf)
    for _, one in steps.groupby("tree"):
        total += one["path"].to_numpy()[np.searchsorted(one["upper"].to_numpy(), probes, side="left")]
    n_trees = steps["tree"].nunique()
    score = 2.0 ** (-(total / n_trees) / max(average_path(size), 1e-12))
    return IsolationSteps(breaks, score, float(base["mean"]))
