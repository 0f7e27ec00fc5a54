"""Scaling: centre and spread per column, fitted exactly and applied as literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fitting as fit
from ..schema import binary_columns, column_roles, q_col

METHODS = ("standard", "minmax", "robust", "maxabs", "normalize")
NEEDS = {"standard": ["mean", "std_pop"], "minmax": ["min", "max"], "maxabs": ["max_abs"], "robust": [], "normalize": []}


@dataclass(frozen=True)
class ColumnScale:
    column: str
    method: str
    centre: float = 0.0
    spread: float = 1.0

    def expression(self) -> Column:
        x = q_col(self.column).cast("double")
        if self.method == "normalize":
            return F.signum(x)
        return (x - F.lit(self.centre)) / F.lit(self.spread)


def scale_plan(
    df: DataFrame,
    method: str = "standard",
    *,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    rules: Mapping[str, str] | None = None,
    skip_binary: bool = False,
) -> dict[str, str]:
    """Which numeric column gets which scaler: its own rule, else ``method``."""
    numeric = column_roles(df).numeric
    chosen = [c for c in (columns if columns is not None else numeric) if c in numeric and c not in exclude]
    if skip_binary:
        flags = set(binary_columns(df, chosen))
        chosen = [c for c in chosen if c not in flags]
    plan = {c: method for c in chosen}
    plan.update({c: m for c, m in (rules or {}).items() if c in numeric and c not in exclude})
    unknown = sorted(set(plan.values()) - set(METHODS))
    if unknown:
        raise ValueError(f"unknown scaling method {unknown}")
    return plan


def fit_scaling(df: DataFrame, plan: Mapping[str, str]) -> list[ColumnScale]:
    """Fit every scaler in one aggregate, plus quantile passes for robust ones. No spread counts as 1."""
    stats = fit.column_statistics(
        df,
        {c: NEEDS[m] for c, m in plan.items()},
        {c: [0.25, 0.5, 0.75] for c, m in plan.items() if m == "robust"},
    )
    fitted = []
    for c, method in plan.items():
        s = stats[c]
        if not s["count"] or method == "normalize":
            centre, spread = 0.0, 1.0
        elif method == "standard":
            centre, spread = s["mean"], s["std_pop"]
        elif method == "minmax":
            centre, spread = s["min"], s["max"] - s["min"]
        elif method == "maxabs":
            centre, spread = 0.0, s["max_abs"]
        else:
            q1, centre, q3 = s["quantiles"]
            spread = q3 - q1
        fitted.append(ColumnScale(c, method, float(centre), float(spread) or 1.0))
    return fitted


def apply_scaling(df: DataFrame, fitted: Sequence[ColumnScale]) -> DataFrame:
    by_name = {s.column: s for s in fitted}
    return df.select(*[by_name[c].expression().alias(c) if c in by_name else q_col(c) for c in df.columns])


def normalize_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide the vector formed by ``columns`` by its Euclidean length; a zero vector stays zero."""
    length = F.sqrt(sum((q_col(c).cast("double") * q_col(c) for c in columns), F.lit(0.0)))
    return df.select(
        *[
            F.when(length > 0, q_col(c) / length).otherwise(q_col(c).cast("double")).alias(c) if c in columns else q_col(c)
            for c in df.columns
        ]
    )
