"""Derived columns; every operator is one narrow projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import numeric as num, text as tx
from ..schema import q_col

DIVIDE_GUARD = 1e-6
OPERATION_NAMES = {"multiply": "x", "add": "plus", "subtract": "minus", "divide": "div"}


def ratio_feature(
    df: DataFrame,
    out: str,
    numerator: str,
    denominator: str,
    *,
    unit: float = 1.0,
    digits: int | None = None,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """``numerator / (denominator / unit)``, 0 unless the denominator is positive.

    With bounds, rows whose ratio lies outside are removed; a missing ratio stays.
    """
    if numerator not in df.columns or denominator not in df.columns:
        return df
    base = q_col(denominator) / F.lit(float(unit))
    value = F.when(base > 0, F.try_divide(q_col(numerator).cast("double"), base)).otherwise(F.lit(0.0))
    if digits is not None:
        value = num.half_even(value, digits)
    result = df.withColumn(out, value)
    if low is None and high is None:
        return result
    return result.where(F.coalesce(num.in_range(q_col(out), low, high), F.lit(True)))


def speed_feature(df: DataFrame, distance: str, minutes: str, *, low: float = 0.0, high: float = 150.0) -> DataFrame:
    """Speed per hour from distance and minutes, to two digits, limited to a plausible range."""
    return ratio_feature(df, "Speed_kmh", distance, minutes, unit=60.0, digits=2, low=low, high=high)


def datetime_parts(
    df: DataFrame,
    column: str,
    parts: Sequence[str] = ("hour", "day", "month", "dayofweek"),
    *,
    drop_original: bool = False,
) -> DataFrame:
    """``{column}_{part}`` columns; text is parsed, unparseable text gives NULL; Monday is 0."""
    if column not in df.columns:
        return df
    known = {
        "hour": F.hour,
        "day": F.dayofmonth,
        "month": F.month,
        "year": F.year,
        "dayofweek": F.weekday,
        "quarter": F.quarter,
    }
    raw = q_col(column)
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    moment = F.try_to_timestamp(raw) if is_text else raw
    kept = [q_col(c) for c in df.columns if c != column]
    if not drop_original:
        kept = [moment.alias(c) if c == column else q_col(c) for c in df.columns]
    return df.select(*kept, *[known[p](moment).alias(f"{column}_{p}") for p in parts if p in known])


def interactions(
    df: DataFrame, pairs: Sequence[tuple[str, str]], operations: Sequence[str] = ("multiply",)
) -> DataFrame:
    """Pairwise products, sums, differences and guarded quotients; incomplete pairs are skipped."""
    added = {}
    for left, right in pairs:
        if left not in df.columns or right not in df.columns:
            continue
        a, b = q_col(left), q_col(right)
        results = {
            "multiply": a * b,
            "add": a + b,
            "subtract": a - b,
            "divide": F.try_divide(a.cast("double"), b + F.lit(DIVIDE_GUARD)),
        }
        for operation in operations:
            if operation in results:
                added[f"{left}_{OPERATION_NAMES[operation]}_{right}"] = results[operation]
    return df.withColumns(added) if added else df


def map_levels(df: DataFrame, column: str, levels: Mapping, out: str | None = None) -> DataFrame:
    """Replace text levels by the given numbers; levels without a number become NULL."""
    return df.withColumn(out or column, tx.lookup(q_col(column), levels))
