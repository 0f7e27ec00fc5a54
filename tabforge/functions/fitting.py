"""Statistics that fitted operators need, gathered in as few passes as possible."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window, functions as F

from ..schema import known, q_col
from ..session import cut_lineage
from .quantiles import exact_quantiles

# how each statistic is written as an aggregate
AGGREGATES = {
    "rows": lambda c: F.count("*"),
    "count": lambda c: F.count(c),
    "mean": lambda c: F.avg(c),
    "std_pop": lambda c: F.stddev_pop(c),
    "std": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "max_abs": lambda c: F.max(F.abs(c)),
}


def column_statistics(
    df: DataFrame,
    needs: dict[str, Iterable[str]],
    probabilities: dict[str, Sequence[float]] | None = None,
    *,
    direct_rows: int | None = None,
) -> dict[str, dict[str, Any]]:
    """``needs[column]`` names aggregates; ``probabilities[column]`` adds a ``quantiles`` list.

    One aggregate job for everything decomposable, then the quantile passes.
    """
    probabilities = {c: list(p) for c, p in (probabilities or {}).items() if p}
    wanted = {c: sorted({*names, "count"}) for c, names in needs.items()}
    for c in probabilities:
        wanted.setdefault(c, ["count"])
    if not wanted:
        return {}
    columns = list(wanted)
    df = df.select(*[known(df, c).alias(c) for c in columns])  # one notion of "missing"
    parts = [
        AGGREGATES[name](q_col(c)).alias(f"{name}_{i}") for i, c in enumerate(columns) for name in wanted[c]
    ]
    row = df.agg(*parts).first()
    stats = {c: {name: row[f"{name}_{i}"] for name in wanted[c]} for i, c in enumerate(columns)}
    if probabilities:
        options = {} if direct_rows is None else {"direct_rows": direct_rows}
        counts = {c: stats[c]["count"] for c in probabilities}
        for c, values in exact_quantiles(df, probabilities, counts=counts, **options).items():
            stats[c]["quantiles"] = values
    return stats


def by_type(df: DataFrame, columns: Sequence[str]) -> list[list[str]]:
    """Columns in groups of equal type, so that they can be unpivoted without a cast."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    return list(groups.values())


def value_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for columns of one type; one scan, counted before the shuffle."""
    return (
        df.select(*[q_col(c) for c in columns])
        .unpivot([], [q_col(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent non-null value per column, the smallest among equals; None when all are null."""
    found: dict[str, Any] = {c: None for c in columns}
    for same_type in by_type(df, columns):
        rows = (
            value_table(df, same_type)
            .where(F.col("value").isNotNull())
            .groupBy("column")
            .agg(F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("best"))
            .collect()  # one row per column
        )
        found.update({r["column"]: r["best"]["value"] for r in rows})
    return found


def clearly_over(df: DataFrame, columns: Sequence[str], limit: int) -> set[str]:
    """Columns whose sketched distinct count is far above ``limit``; one pass, nothing is shuffled.

    The sketch errs by a few percent, so "far" (double) leaves no doubt; columns near the limit
    are for an exact count to decide.
    """
    if not columns:
        return set()
    row = df.agg(*[F.approx_count_distinct(q_col(c), 0.05).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return {c for i, c in enumerate(columns) if row[f"d{i}"] > 2 * limit}


def level_counts(df: DataFrame, columns: Sequence[str], limit: int) -> tuple[dict[str, dict], list[str]]:
    """``{column: {value: rows}}`` of the non-null values in order, and the columns with more than ``limit``.

    A column beyond the limit yields no values. Wide columns are recognised by a sketch, so their
    values are never shuffled; the others have at most about twice the limit.
    """
    if not 0 < limit < 1000:
        raise ValueError("limit must be between 1 and 999")
    wide = clearly_over(df, columns, limit)
    narrow = [c for c in columns if c not in wide]
    found: dict[str, list] = {c: [] for c in narrow}
    for same_type in by_type(df, narrow):
        in_order = Window.partitionBy("column").orderBy("value")
        rows = (
            value_table(df, same_type)
            .where(F.col("value").isNotNull())
            .withColumn("at", F.row_number().over(in_order))
            .where(F.col("at") <= limit + 1)
            .select("column", "value", "n")
            .collect()  # at most columns x (limit + 1) rows
        )
        for r in rows:
            found[r["column"]].append((r["value"], r["n"]))
    over = [c for c in columns if c in wide or len(found[c]) > limit]
    return {c: dict(sorted(v)) for c, v in found.items() if c not in over}, over


def sorted_levels(df: DataFrame, columns: Sequence[str], limit: int) -> tuple[dict[str, list], list[str]]:
    """Distinct non-null values per column in order, and the columns that have more than ``limit``."""
    counts, over = level_counts(df, columns, limit)
    return {c: list(v) for c, v in counts.items()}, over


def sorted_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code, n): every distinct non-null value with its 0-based place, for any number of values.

    The sorted values are written once, so that the place of a row in its partition is a fact
    and not something a recomputation could change; partition sizes then give the offsets.
    """
    counted = df.select(q_col(column).alias("value")).where(F.col("value").isNotNull()).groupBy("value")
    ordered = cut_lineage(counted.agg(F.count("*").alias("n")).orderBy("value"))
    place = F.monotonically_increasing_id()  # partition number above bit 33, place in the partition below
    placed = ordered.withColumn("_id", place).select(
        "value", "n", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(2**33 - 1).alias("_at")
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").select("value", (F.col("_offset") + F.col("_at")).alias("code"), "n")
