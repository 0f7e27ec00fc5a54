"""Outlier rows: interquartile, z-score and isolation-forest rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fitting as fit
from ..schema import column_roles, known
from .isolation import fit_isolation

DEFAULT_THRESHOLD = {"iqr": 1.5, "zscore": 3.0, "iforest": 0.5}
ALIASES = {"isolation_forest": "iforest"}


def outlier_flag(
    df: DataFrame, column: str, method: str, threshold: float | None = None, *, key: Sequence[str] = (), seed: int = 42
) -> Column:
    """A never-null flag from bounds fitted on ``df``; missing values are not outliers."""
    method = ALIASES.get(method.lower(), method.lower())
    if method not in DEFAULT_THRESHOLD:
        raise ValueError(f"unknown outlier method {method!r}")
    limit = DEFAULT_THRESHOLD[method] if threshold is None else threshold
    x = known(df, column)
    if method == "iqr":
        q1, q3 = fit.column_statistics(df, {}, {column: [0.25, 0.75]})[column]["quantiles"]
        if q1 is None:
            return F.lit(False)
        low, high = q1 - limit * (q3 - q1), q3 + limit * (q3 - q1)
        return F.coalesce((x < low) | (x > high), F.lit(False))
    if method == "zscore":
        stats = fit.column_statistics(df, {column: ["mean", "std_pop"]})[column]
        if not stats["std_pop"]:
            return F.lit(False)
        return F.coalesce(F.abs((x - stats["mean"]) / stats["std_pop"]) > limit, F.lit(False))
    return fit_isolation(df, column, key=key, seed=seed).outlier(x, limit)


def remove_outliers(
    df: DataFrame,
    rules: Mapping[str, str] | str = "iqr",
    *,
    threshold: float | None = None,
    simultaneous: bool = False,
    key: Sequence[str] = (),
    seed: int = 42,
) -> DataFrame:
    """Remove outlier rows by ``{column: method}``, or one method for every numeric column.

    By default each column's bounds see the rows that earlier columns left, one pass per
    column; ``simultaneous`` fits all on the whole table. Fitted bounds are literals, so the
    passes add predicates to the scan and no lineage.
    """
    numeric = column_roles(df).numeric
    if isinstance(rules, str):
        rules = {c: rules for c in numeric}
    current = df
    for column, method in rules.items():
        if column not in numeric:
            continue
        flag = outlier_flag(df if simultaneous else current, column, method, threshold, key=key, seed=seed)
        current = current.where(~flag)
    return current
