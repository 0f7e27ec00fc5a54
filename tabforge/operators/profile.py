"""Table and column profiles. Results are small tables; the data stays where it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fitting as fit, numeric as num
from ..functions.quantiles import exact_quantiles
from ..schema import column_roles, q_col

HIGH_MISSING_TABLE = 10.0
HIGH_MISSING_COLUMN = 50.0
HIGH_SKEW = 1.0
RARE_SHARE = 0.05


def _missing(c: str) -> Column:
    return F.count_if(q_col(c).isNull())


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Every different row with its number of ``_copies``; copies collapse before the shuffle."""
    return df.groupBy(*[q_col(c) for c in df.columns]).agg(F.count("*").alias("_copies"))


def _missing_copies(c: str) -> Column:
    return F.coalesce(F.sum(F.when(q_col(c).isNull(), F.col("_copies"))), F.lit(0))


def table_snapshot(df: DataFrame) -> DataFrame:
    """Rows, columns, duplicate rows, missing cells and their share, with an alert from 10 %.

    Everything follows from the table of distinct rows and their copies, so one shuffle does.
    """
    width = len(df.columns)
    share = num.half_even(num.percent(F.col("total_missing"), F.col("rows") * width), 2)
    return (
        _distinct_rows(df)
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
            sum((_missing_copies(c) for c in df.columns), F.lit(0)).cast("long").alias("total_missing"),
        )
        .select(
            "rows",
            F.lit(width).cast("long").alias("columns"),
            "duplicates",
            "total_missing",
            F.coalesce(share, F.lit(0.0)).alias("missing_pct"),
            F.coalesce(share >= HIGH_MISSING_TABLE, F.lit(False)).cast("int").alias("high_missing"),
        )
    )


def dtype_counts(df: DataFrame) -> DataFrame:
    """Per type: how many columns have it, and how many values and gaps they hold."""
    by_type: dict[str, list[str]] = {}
    for f in df.schema.fields:
        by_type.setdefault(f.dataType.simpleString(), []).append(f.name)
    totals = df.agg(
        *[sum((F.count(q_col(c)) for c in cs), F.lit(0)).alias(f"v{i}") for i, cs in enumerate(by_type.values())],
        F.count("*").alias("n"),
    )
    rows = [
        F.struct(
            F.lit(t).alias("dtype"),
            F.lit(len(cs)).cast("long").alias("n_columns"),
            F.col(f"v{i}").cast("long").alias("n_values"),
            (F.col("n") * len(cs) - F.col(f"v{i}")).cast("long").alias("n_missing"),
        )
        for i, (t, cs) in enumerate(by_type.items())
    ]
    return totals.select(F.inline(F.array(*rows)))


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, top_n: int | None = None, *, exact: bool = True
) -> DataFrame:
    """Type, missing count and share, distinct values and alerts per column, most gaps first.

    Distinct values are counted per column and value type before they are counted once more, so the rows are
    read once and not expanded by Spark's several-distinct rewrite. ``exact=False`` takes a sketch
    (within a few percent) and shuffles nothing.
    """
    columns = list(columns or df.columns)
    parts = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        parts.append(_missing(c).alias(f"m{i}"))
        if not exact:
            parts.append(F.approx_count_distinct(q_col(c), 0.02).alias(f"d{i}"))
    share = [num.half_even(num.percent(F.col(f"m{i}"), F.col("n")), 2) for i in range(len(columns))]
    distinct = distinct_counts(df, columns) if exact else {}
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.col(f"m{i}").alias("missing"),
            share[i].alias("missing_pct"),
            (F.col(f"d{i}") if not exact else F.lit(distinct[c])).cast("long").alias("unique"),
            ((F.col(f"d{i}") if not exact else F.lit(distinct[c])) <= 1).cast("int").alias("constant"),
            F.coalesce(share[i] > HIGH_MISSING_COLUMN, F.lit(False)).cast("int").alias("high_missing"),
        )
        for i, c in enumerate(columns)
    ]
    profile = df.agg(*parts).select(F.inline(F.array(*rows)))
    if top_n is None:
        return profile
    return profile.orderBy(F.desc_nulls_last("missing_pct"), "column").limit(top_n)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Distinct non-null values per column: one grouped pass per value type."""
    found = {c: 0 for c in columns}
    for same_type in fit.by_type(df, columns):
        values = fit.value_table(df, same_type).where(F.col("value").isNotNull())
        found.update({r["column"]: r["count"] for r in values.groupBy("column").count().collect()})  # a row per column
    return found


def missing_table(df: DataFrame, *, only_missing: bool = True) -> DataFrame:
    """Missing count and share per column, without the cost of distinct counts."""
    parts = [F.count("*").alias("n"), *[_missing(c).alias(f"m{i}") for i, c in enumerate(df.columns)]]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m{i}").alias("missing"),
            num.half_even(num.percent(F.col(f"m{i}"), F.col("n")), 2).alias("missing_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    table = df.agg(*parts).select(F.inline(F.array(*rows)))
    if only_missing:
        table = table.where(F.col("missing") > 0)
    return table.orderBy(F.desc("missing"), "column")


def data_overview(df: DataFrame) -> DataFrame:
    """One row: shape, role counts, columns with gaps, missing cells and duplicate rows."""
    roles = column_roles(df)
    gaps = [F.col(f"m{i}") for i in range(len(df.columns))]
    counts = _distinct_rows(df).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
        *[_missing_copies(c).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    sizes = {
        "columns": len(df.columns),
        "numeric_columns": len(roles.numeric),
        "categorical_columns": len(roles.categorical),
        "datetime_columns": len(roles.datetime),
        "boolean_columns": len(roles.boolean),
    }
    return counts.select(
        "rows",
        *[F.lit(n).cast("long").alias(name) for name, n in sizes.items()],
        sum(((g > 0).cast("long") for g in gaps), F.lit(0).cast("long")).alias("columns_with_missing"),
        sum(gaps, F.lit(0).cast("long")).alias("total_missing"),
        "duplicates",
    )


def table_summary(df: DataFrame, steps: Sequence[str] = ()) -> dict:
    """Shape, role counts, missing cells and the steps applied, as plain values."""
    roles = column_roles(df)
    row = df.agg(F.count("*").alias("n"), *[_missing(c).alias(f"m{i}") for i, c in enumerate(df.columns)]).first()
    return {
        "shape": (row["n"], len(df.columns)),
        "n_numeric_cols": len(roles.numeric),
        "n_categorical_cols": len(roles.categorical),
        "total_missing": sum(row[f"m{i}"] for i in range(len(df.columns))),
        "preprocessing_steps": list(steps),
    }


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict, quantiles: dict[str, list]) -> DataFrame:
    """One row per column out of one wide aggregate, beside quantiles that are already known."""
    parts = [make(q_col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, make in measures.items()]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{name}_{i}").alias(name) for name in measures],
            *[F.lit(value).cast("double").alias(name) for name, value in quantiles[c]],
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, deviation, extremes, exact median, small-sample skewness and its alert."""
    columns = list(columns or column_roles(df).numeric)
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    summary = _per_column(
        df,
        columns,
        {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "skewness": num.unbiased_skewness},
        {c: [("median", medians[c][0])] for c in columns},
    )
    return summary.withColumn("skewed", F.coalesce(F.abs("skewness") > HIGH_SKEW, F.lit(False)).cast("int"))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles."""
    columns = list(columns or column_roles(df).numeric)
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    return _per_column(
        df,
        columns,
        {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
        {c: list(zip(("q1", "median", "q3"), quartiles[c])) for c in columns},
    )


def value_counts(
    df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 10, *, include_null: bool = True
) -> DataFrame:
    """The ``top_n`` most frequent values per categorical column; ties in value order."""
    counts = _text_counts(df, columns)
    if not include_null:
        counts = counts.where(F.col("value").isNotNull())
    first = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    # the filter stands on the bare row number, so each task keeps its own top rows before the shuffle
    top = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top_n)
    return top.withColumn("rank", F.col("rank").cast("long"))


def top_categories(
    df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 10, *, max_levels: int = 50
) -> DataFrame:
    """Value counts without nulls, for columns of at most ``max_levels`` distinct values."""
    columns = list(columns or column_roles(df).categorical)
    return value_counts(df, low_cardinality(df, columns, max_levels), top_n, include_null=False)


def low_cardinality(df: DataFrame, columns: Sequence[str], limit: int = 50) -> list[str]:
    """Columns with at most ``limit`` distinct non-null values; counted exactly unless clearly wide."""
    wide = fit.clearly_over(df, columns, limit)
    close = [c for c in columns if c not in wide]
    if not close:
        return []
    row = df.agg(*[F.count_distinct(q_col(c)).alias(f"d{i}") for i, c in enumerate(close)]).first()
    return [c for i, c in enumerate(close) if row[f"d{i}"] <= limit]


def rare_categories(df: DataFrame, columns: Sequence[str] | None = None, share: float = RARE_SHARE) -> DataFrame:
    """Values (null counted as one) that hold less than ``share`` of the rows."""
    total = df.agg(F.count("*")).scalar()
    part = F.try_divide(F.col("n").cast("double"), total)
    return (
        _text_counts(df, columns)
        .select("column", "value", "n", part.alias("share"))
        .where(F.col("share") < share)
    )


def _text_counts(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    columns = list(columns if columns is not None else column_roles(df).categorical)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, n long")
    return fit.value_table(df.select(*[q_col(c).cast("string").alias(c) for c in columns]), columns)


def overview(df: DataFrame, top_n: int = 10) -> dict[str, DataFrame]:
    """The standard first look at a table, part by part; every part is lazy or small."""
    from .correlation import top_pairs

    roles = column_roles(df)
    parts = {
        "snapshot": table_snapshot(df),
        "dtype_counts": dtype_counts(df),
        "column_profile": column_profile(df, top_n=top_n),
    }
    if roles.numeric:
        parts["numeric_summary"] = numeric_summary(df)
    if roles.categorical:
        parts["value_counts"] = value_counts(df, top_n=top_n)
        parts["rare_categories"] = rare_categories(df)
    if len(roles.numeric) > 1:
        parts["top_correlations"] = top_pairs(df, top_n=top_n)
    return parts
