"""Cleaning that needs no statistics: duplicates, text, value constraints, record validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric as num, text as tx
from ..schema import column_roles, numeric_columns, q_col, to_number


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of every set of fully equal rows (nulls are equal); copies collapse before the shuffle."""
    return df.dropDuplicates()


def unify_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    rules: Mapping[str, Mapping[str, str]] | None = None,
    *,
    missing_as_level: bool = True,
) -> DataFrame:
    """Lower-case and strip categorical columns, then apply ``rules[column][old] -> new``."""
    wanted = set(column_roles(df).categorical if columns is None else columns)
    rules = rules or {}
    return df.select(
        *[
            tx.replaced(tx.unified(q_col(c), missing_as_level), rules.get(c, {})).alias(c) if c in wanted else q_col(c)
            for c in df.columns
        ]
    )


def replace_values(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    return df.select(
        *[tx.replaced(q_col(c), rules[c]).alias(c) if c in rules else q_col(c) for c in df.columns]
    )


def apply_constraints(
    df: DataFrame,
    rules: Mapping[str, Mapping[str, Any]],
    *,
    mean_action: str = "reference",
    keep_nulls: bool = False,
    actions: Sequence[str] = ("clip", "drop", "mean"),
    drop_unparsable: bool = True,
) -> DataFrame:
    """Enforce ``{column: {dtype, min, max, action}}`` in one filter and one projection.

    ``dtype`` int/float: text must parse as a number, rows with unparseable text go (or the cell
    becomes missing, without ``drop_unparsable``).
    ``clip`` bounds values; ``drop`` (the default) keeps rows inside the range, nulls only with
    ``keep_nulls``; ``mean`` does nothing in ``"reference"`` mode and blanks violations for a
    later imputation in ``"null_out"`` mode. Rules for absent columns are skipped.
    """
    if mean_action not in ("reference", "null_out"):
        raise ValueError(f"unknown mean_action {mean_action!r}")
    values: dict[str, Column] = {}
    keep: Column | None = None
    numeric = set(numeric_columns(df))
    for name, rule in rules.items():
        if name not in df.columns or not isinstance(rule, Mapping):
            continue
        raw = value = q_col(name)
        if rule.get("dtype") in ("int", "float") and name not in numeric:
            value = to_number(raw.cast("string"))
            if drop_unparsable:
                keep = _and(keep, value.isNotNull() | raw.isNull())
        low, high = rule.get("min"), rule.get("max")
        action = rule.get("action", "drop")
        if (low is not None or high is not None) and action in actions:
            if action == "clip":
                value = num.clipped(value, low, high)
            elif action == "drop":
                inside = num.in_range(value, low, high)
                keep = _and(keep, F.coalesce(inside, F.lit(True)) if keep_nulls else inside)
            elif action == "mean" and mean_action == "null_out":
                value = F.when(num.in_range(value, low, high), value)
        values[name] = value
    kept = df if keep is None else df.where(keep)
    return kept.select(*[values[c].alias(c) if c in values else q_col(c) for c in df.columns])


def _and(left: Column | None, right: Column) -> Column:
    return right if left is None else left & right


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns)) if columns else df.na.drop()


def validate_rows(df: DataFrame, rules: Mapping[str, Mapping[str, Any]], out: str = "violations") -> DataFrame:
    """Check every record against ``{column: {min, max} | {options}}``.

    Options match without regard to case and are rewritten to their canonical spelling;
    ``out`` lists the columns that are missing, unparseable, out of range or unknown.
    """
    values: dict[str, Column] = {}
    problems: list[Column] = []
    numeric = set(numeric_columns(df))
    for name, rule in rules.items():
        if name not in df.columns:
            problems.append(F.lit(name))
            continue
        raw = q_col(name)
        if "options" in rule:
            canonical = tx.lookup(F.lower(F.trim(raw)), {o.lower(): o for o in rule["options"]})
            values[name] = F.coalesce(canonical, raw)
            valid = canonical.isNotNull()
        else:
            value = raw if name in numeric else to_number(raw.cast("string"))
            values[name] = value
            valid = value.isNotNull() & F.coalesce(num.in_range(value, rule.get("min"), rule.get("max")), F.lit(False))
        problems.append(F.when(~valid, F.lit(name)))
    found = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
    return df.select(*[values[c].alias(c) if c in values else q_col(c) for c in df.columns], found.alias(out))
