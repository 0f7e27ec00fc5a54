"""Train/test splits and folds that depend on keys, never on partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.buckets import order_value
from ..functions.hashing import HASH_RANGE, key_hash
from ..functions.ordered import row_numbers
from ..functions.quantiles import order_statistics
from ..schema import q_col
from .scale import apply_scaling, fit_scaling, scale_plan


def train_test_split(
    df: DataFrame,
    key: Sequence[str] | str,
    *,
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = True,
    hashed: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test), both plain filters of ``df``.

    ``exact``: the ceil(test_size x rows) rows with the smallest key hash are the test side;
    the hash of that rank is found by bracket passes, nothing is sorted. Otherwise a fixed
    hash threshold gives the fraction in expectation, with no job at all. Rows that share a
    key always stay on one side. ``hashed`` names a column of ``df`` that holds the key hash of
    this seed, for a table that many passes read; it is on neither side.
    """
    is_test = test_side(df, key, test_size=test_size, seed=seed, exact=exact, hashed=hashed)
    sides = df.where(~is_test), df.where(is_test)
    return tuple(side.drop(q_col(hashed)) for side in sides) if hashed else sides


def test_side(
    df: DataFrame, key: Sequence[str] | str, *, test_size: float, seed: int, exact: bool, hashed: str | None = None
) -> Column:
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    h = q_col(hashed) if hashed else key_hash(key, seed)
    if not exact:
        return h < int(test_size * HASH_RANGE)
    hashed = df.select(h.alias("h"))
    rows = hashed.count()
    wanted = math.ceil(test_size * rows)
    if wanted == 0:
        return F.lit(False)
    last = order_statistics(hashed, {"h": [wanted - 1]}, {"h": rows})["h"][wanted - 1]
    return h <= int(last)


def with_split_tag(train: DataFrame, test: DataFrame, out: str = "split") -> DataFrame:
    """Stack both sides, columns matched by name, with a tag."""
    return train.withColumn(out, F.lit("train")).unionByName(test.withColumn(out, F.lit("test")))


def contiguous_folds(df: DataFrame, order_by: Sequence[str], k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled folds of the ordered table; the first ``rows % k`` folds have one row more.

    With one unique numeric or time order column the fold edges are order statistics, and the
    fold is an expression. With more columns, or text, rows are numbered in distributed order. Rows
    without a leading order value come last: they all lie in the last fold where there is one
    column, beside the ``n / k`` known rows of that fold.
    """
    single = len(order_by) == 1 and not isinstance(df.schema[order_by[0]].dataType, T.StringType)
    if single:
        position = order_value(df, order_by[0])
        position = F.when(~F.isnan(position), position)
        rows = df.agg(F.count(position)).first()[0]
    else:
        rows = df.count()
    sizes = [rows // k + (1 if i < rows % k else 0) for i in range(k)]
    starts = [sum(sizes[:i]) for i in range(1, k)]
    if single:
        inner = [s for s in starts if s < rows]
        edges = order_statistics(df.select(position.alias("p")), {"p": inner}, {"p": rows})["p"] if inner else {}
        fold = F.lit(0)
        for s in starts:
            fold = fold + (F.when(position >= edges[s], 1).otherwise(0) if s in edges else 0)
        return df.withColumn(out, F.when(position.isNull(), k - 1).otherwise(fold).cast("int"))
    numbered = row_numbers(df, order_by, "_rn")
    fold = F.lit(0)
    for s in starts:
        fold = fold + F.when(F.col("_rn") >= s, 1).otherwise(0)
    return numbered.withColumn(out, fold.cast("int")).drop("_rn")


def hash_folds(df: DataFrame, key: Sequence[str] | str, k: int = 5, *, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds from the key hash: no pass over the table, balanced in expectation."""
    return df.withColumn(out, (key_hash(key, seed) % k).cast("int"))


def prepare_data(
    df: DataFrame, target: str, key: Sequence[str] | str, *, test_size: float = 0.2, seed: int = 42, scale: bool = False
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, feature names); with ``scale``, standardised by training statistics."""
    keys = [key] if isinstance(key, str) else list(key)
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the table")
    features = [c for c in df.columns if c != target and c not in keys]
    train, test = train_test_split(df, keys, test_size=test_size, seed=seed)
    if scale:
        fitted = fit_scaling(train, scale_plan(train, "standard", columns=features))
        train, test = apply_scaling(train, fitted), apply_scaling(test, fitted)
    return train, test, features
