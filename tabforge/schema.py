"""Column roles and column-list algebra. Everything here reads the schema only."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOATING = (T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class Roles:
    numeric: list[str]
    categorical: list[str]
    datetime: list[str]
    boolean: list[str]


def column_roles(df: DataFrame) -> Roles:
    """Numeric, datetime and boolean by type; whatever is left is categorical."""
    roles = Roles([], [], [], [])
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, T.NumericType):
            roles.numeric.append(field.name)
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            roles.datetime.append(field.name)
        elif isinstance(kind, T.BooleanType):
            roles.boolean.append(field.name)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise ValueError(f"column {field.name!r} has type {kind.simpleString()}; only flat columns are supported")
        else:
            roles.categorical.append(field.name)
    return roles


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns of any table, nested columns or not."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def existing_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    role: str | None = None,
    target: str | None = None,
) -> list[str]:
    """The requested columns that exist, in request order, without the target.

    With no request: every column, or every column of ``role``.
    """
    if columns is None:
        chosen = list(df.columns) if role is None else list(getattr(column_roles(df), role))
    else:
        chosen = [c for c in columns if c in df.columns]
    return [c for c in chosen if c != target]


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the table")
    return df.drop(target), df.select(target)


def usable_subset(wanted: Iterable[str] | None, available: Sequence[str]) -> list[str]:
    """Known names out of ``wanted``; all available names when none is left."""
    kept = [c for c in wanted or [] if c in available]
    return kept or list(available)


def align_columns(df: DataFrame, columns: Sequence[str], fill: float = 0) -> DataFrame:
    """Bring a table to a fitted column list: reorder, drop extras, add absent ones as ``fill``."""
    return df.select(*[F.col(q(c)) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Floating NaN becomes NULL, so that one notion of "missing" is left."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *[
            F.when(~F.isnan(q_col(f.name)), q_col(f.name)).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, FLOATING)
            else q_col(f.name)
            for f in df.schema.fields
        ]
    )


def known(df: DataFrame, name: str) -> Column:
    """The column with floating NaN as NULL."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(q_col(name)), q_col(name))
    return q_col(name)


def numeric_like(df: DataFrame, columns: Sequence[str]) -> dict[str, bool]:
    """Numeric by type, or text whose every non-null value parses as a number (one pass)."""
    numeric = set(column_roles(df.select(*columns)).numeric)
    text = [c for c in columns if c not in numeric]
    answer = {c: True for c in numeric}
    if text:
        parts = []
        for i, c in enumerate(text):
            parts += [F.count(q_col(c)).alias(f"n{i}"), F.count(to_number(q_col(c).cast("string"))).alias(f"p{i}")]
        row = df.agg(*parts).first()
        for i, c in enumerate(text):
            answer[c] = row[f"n{i}"] > 0 and row[f"n{i}"] == row[f"p{i}"]
    return {c: answer[c] for c in columns}


def to_number(text: Column) -> Column:
    """Parse text as a double; unparseable text, NaN and Java literals such as ``1d`` give NULL."""
    # few numbers hold such a letter: the others need no regular expression
    lettered = text.contains("d") | text.contains("f") | text.contains("D") | text.contains("F")
    value = F.when(~(lettered & text.rlike(r"[0-9]\.?[dDfF]\s*$")), text).try_cast("double")
    return F.when(~F.isnan(value), value)


def binary_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns holding nothing but 0 and 1 (nulls aside); they are left unscaled."""
    columns = existing_columns(df, columns) if columns is not None else column_roles(df).numeric
    columns = [c for c in columns if c in column_roles(df).numeric]
    if not columns:
        return []
    row = df.agg(*[F.bool_and(q_col(c).isin(0, 1)).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"b{i}"] is not False]


def safe_name(name: str, default: str = "column") -> str:
    """Runs of anything but letters, digits, ``_`` and ``-`` become one ``_``."""
    return re.sub(r"[^A-Za-z0-9_-]+", "_", name).strip("_") or default


def safe_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    names = [(renames or {}).get(c, safe_name(c)) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("two columns would get the same safe name")
    return df.toDF(*names)


def q(name: str) -> str:
    """Quote a column name, so that one-hot names with dots or spaces resolve."""
    return "`" + name.replace("`", "``") + "`"


def q_col(name: str) -> Column:
    return F.col(q(name))
