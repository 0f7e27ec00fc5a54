"""Pearson, Spearman and Kendall correlation over pairwise complete rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import buckets as bk
from ..functions.lookups import attach
from ..functions.ordered import BEFORE, average_ranks, join_null_safe, running_sums
from ..schema import column_roles, q_col

FEW_PAIRS = 20
METHODS = ("pearson", "spearman", "kendall")
DIGIT_BITS = 3  # ranks are compared digit by digit, this many bits at a time
DIGIT = 1 << DIGIT_BITS


def pearson_expression(a: Column, b: Column) -> Column:
    """Co-moment over spreads; NULL, not an error, when either side is constant."""
    a, b = a.cast("double"), b.cast("double")
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], method: str = "pearson") -> DataFrame:
    """(column_a, column_b, corr) per pair; NULL where undefined."""
    if method not in METHODS:
        raise ValueError(f"unknown correlation method {method!r}")
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    if method == "pearson":
        return _pearson_block(df, pairs) if len(pairs) <= FEW_PAIRS else _pearson_by_products(df, pairs)
    if method == "spearman":
        return _spearman(df, pairs)
    return reduce(DataFrame.unionByName, [_named(kendall(df, a, b), a, b) for a, b in pairs])


def _pearson_block(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    wide = df.agg(*[pearson_expression(q_col(a), q_col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _pearson_by_products(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """All pairs of a wide table in one pass.

    Thousands of aggregate expressions would not compile into one loop. Each task multiplies its
    centred batches into column-by-column sums instead; Spark adds the sums per pair.
    """
    columns = sorted({c for pair in pairs for c in pair})
    doubles = df.select(*[q_col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    means = np.array([m or 0.0 for m in doubles.agg(*[F.avg(c) for c in doubles.columns]).first()])
    place = {c: i for i, c in enumerate(columns)}
    left, right = (np.array([place[p[side]] for p in pairs], np.int32) for side in (0, 1))

    def products(batches):
        total = np.zeros((6, len(left)))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(means))])
            known = np.isfinite(x).astype(float)
            x = np.where(known > 0, x - means, 0.0)
            sums, squares = x.T @ known, (x * x).T @ known
            parts = ((known.T @ known)[left, right], sums[left, right], sums[right, left],
                     squares[left, right], squares[right, left], (x.T @ x)[left, right])
            total += np.array(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(left), dtype=np.int32)), *map(pa.array, total)], ["pair", "n", "sa", "sb", "saa", "sbb", "sab"]
        )

    names = ["n", "sa", "sb", "saa", "sbb", "sab"]
    partial = doubles.mapInArrow(products, "pair int, " + ", ".join(f"{n} double" for n in names))
    sums = partial.groupBy("pair").agg(*[F.sum(n).alias(n) for n in names])
    spread = [F.greatest(F.col(f"s{c}{c}") - F.try_divide(F.col(f"s{c}") * F.col(f"s{c}"), F.col("n")), F.lit(0.0)) for c in "ab"]
    # what rounding leaves of a constant column's spread does not count
    flat = (spread[0] <= F.col("saa") * 1e-14) | (spread[1] <= F.col("sbb") * 1e-14)
    moment = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n"))
    corr = F.when(~flat, F.try_divide(moment, F.sqrt(spread[0]) * F.sqrt(spread[1])))
    labels = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, column_a string, column_b string")
    return F.broadcast(labels).join(sums, "pair", "left").select("column_a", "column_b", corr.alias("corr"))


def _named(one: DataFrame, a: str, b: str) -> DataFrame:
    return one.select(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), "corr")


def matrix(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """Upper triangle in long form; at least two numeric columns."""
    columns = list(columns or column_roles(df).numeric)
    if len(columns) < 2:
        raise ValueError("correlation needs at least two numeric columns")
    return correlations(df, list(combinations(columns, 2)), method)


def top_pairs(df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 10, method: str = "pearson") -> DataFrame:
    """Strongest pairs by absolute correlation."""
    pairs = matrix(df, columns, method).select("column_a", "column_b", F.abs("corr").alias("abs_corr"))
    return (
        pairs.where(F.col("abs_corr").isNotNull()).orderBy(F.desc("abs_corr"), "column_a", "column_b").limit(top_n)
    )


def with_target(df: DataFrame, target: str, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """(feature, corr) of every numeric feature against the target."""
    numeric = column_roles(df).numeric
    features = [c for c in (columns or numeric) if c in numeric and c != target]
    pairs = correlations(df, [(c, target) for c in features], method)
    return pairs.select(F.col("column_a").alias("feature"), "corr")


def top_target_correlations(df: DataFrame, target: str, top_n: int = 10, method: str = "pearson") -> DataFrame:
    strength = F.abs("corr")
    return with_target(df, target, method=method).where(strength.isNotNull()).orderBy(strength.desc(), "feature").limit(top_n)


def select_features(df: DataFrame, target: str, threshold: float = 0.1, method: str = "spearman") -> list[str]:
    """Numeric features with absolute correlation of at least ``threshold``, in column order."""
    numeric = column_roles(df).numeric
    if target not in numeric:
        return []
    found = {r["feature"]: r["corr"] for r in with_target(df, target, method=method).collect()}  # one row per feature
    return [c for c in df.columns if found.get(c) is not None and abs(found[c]) >= threshold]


def _spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson on average ranks. Without gaps every column is ranked once, else once per pair."""
    columns = sorted({c for pair in pairs for c in pair})
    row = df.agg(F.count("*").alias("n"), *[F.count(q_col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    gaps = {c for i, c in enumerate(columns) if row[f"n{i}"] < row["n"]}
    plain = [p for p in pairs if not gaps.intersection(p)]
    answers = [_pearson_of_ranks(df, plain)] if plain else []
    for a, b in pairs:
        if gaps.intersection((a, b)):
            answers.append(_pearson_of_ranks(df.where(q_col(a).isNotNull() & q_col(b).isNotNull()), [(a, b)]))
    return reduce(DataFrame.unionByName, answers)


def _pearson_of_ranks(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    columns = sorted({c for pair in pairs for c in pair})
    ranked = average_ranks(df.select(*[q_col(c) for c in columns]), columns, "_rank")
    ranks = ranked.select(*[F.col(f"_rank{i}").alias(c) for i, c in enumerate(columns)])
    return correlations(ranks, pairs, "pearson")


def _joint_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return (
        df.where(q_col(a).isNotNull() & q_col(b).isNotNull())
        .select(q_col(a).alias("_x"), q_col(b).alias("_y"))
        .groupBy("_x", "_y")
        .agg(F.count("*").alias("_n"))
    )


def kendall(df: DataFrame, a: str, b: str, *, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """One row ``corr``: tau-b, exact, without comparing rows pairwise.

    Rows are reduced to distinct (x, y) with counts. Two rows with different x ranks differ
    first at some base-8 digit and share the digits above it. So, per digit position, the rows
    of one prefix are walked in y order and every row asks how many earlier rows have a smaller
    or larger digit - a windowed running count, spread over y buckets with per-bucket offsets.
    The work is rows x digits, in one job.
    """
    joint = _joint_counts(df, a, b)
    size = joint.agg(F.count("*").alias("m"), F.sum("_n").alias("n"), F.count_distinct("_x").alias("dx")).first()
    if not size["n"] or size["n"] < 2:
        return df.sparkSession.range(1).select(F.lit(None).cast("double").alias("corr"))
    distinct_x = joint.groupBy("_x").agg(F.lit(1).alias("_one"), F.count("*").alias("_m"))
    dense = running_sums(distinct_x, "_x", ["_one"]).select("_x", F.col("_one_before").alias("_r"), "_m")
    coded = attach(joint, dense, "_x", rows=size["m"], weight="_m")
    n_buckets = max(1, min(bk.MAX_BUCKETS, size["m"] // rows_per_bucket + 1))
    edges = bk.cut_points(coded, [bk.order_value(coded, "_y")], n_buckets)[0] if n_buckets > 1 else []
    coded = bk.with_bucket(coded, bk.order_value(coded, "_y"), edges, "_yb").persist()
    try:
        return _tau_b(coded, size, n_buckets, df)
    finally:
        coded.unpersist()


def _tau_b(coded: DataFrame, size, n_buckets: int, df: DataFrame) -> DataFrame:
    if size["n"] >= 2**31:  # products of counts need more than 64 bits
        coded = coded.withColumn("_n", F.col("_n").cast("decimal(18,0)"))
    digits, reach = 0, 1
    while reach < size["dx"]:
        digits, reach = digits + 1, reach * DIGIT
    agree = differ = 0
    if digits:
        counts = _ordered_pairs(coded, digits, n_buckets).first()
        agree, differ = int(counts["agree"]), int(counts["differ"])

    def ties(*sides: str) -> DataFrame:
        """Pairs of rows that are equal on the given sides."""
        return coded.groupBy(*sides).agg(F.sum("_n").alias("n")).agg(F.sum(F.expr("CAST(n AS DECIMAL(19,0)) * (n - 1)").cast("decimal(38,0)")).alias("t"))

    x_ties, y_ties, both = (int(r["t"]) // 2 for r in ties("_x").union(ties("_y")).union(ties("_x", "_y")).collect())
    pairs = size["n"] * (size["n"] - 1) // 2
    if agree + differ != pairs - x_ties - y_ties + both:
        raise ArithmeticError("pair counts do not add up: the table changed between passes")
    scale = (pairs - x_ties) ** 0.5 * (pairs - y_ties) ** 0.5
    value = (agree - differ) / scale if scale else None
    return df.sparkSession.range(1).select(F.lit(value).cast("double").alias("corr"))


def _ordered_pairs(coded: DataFrame, n_digits: int, n_buckets: int) -> DataFrame:
    """One row: pairs with equal order (``agree``) and opposite order (``differ``) of x and y.

    Every row appears once per digit position, in the group of the rows that share its x rank
    above that digit; pairs of one group are those that first differ there.
    """
    digits = range(DIGIT)
    rows = coded.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_digits - 1))).alias("_at"), "_r", "_y", "_yb", "_n"
    ).selectExpr(
        "_at", f"shiftright(_r, {DIGIT_BITS} * (_at + 1)) AS _g", f"shiftright(_r, {DIGIT_BITS} * _at) & {DIGIT - 1} AS _d",
        "_y", "_yb", "_n",
    )
    # one row per (prefix, y), with the number of rows per digit
    per_y = rows.groupBy("_at", "_g", "_yb", "_y").agg(
        *[F.sum(F.when(F.col("_d") == d, F.col("_n")).otherwise(0)).alias(f"_n{d}") for d in digits]
    )
    smaller_y = Window.partitionBy("_at", "_g", "_yb").orderBy("_y").rowsBetween(*BEFORE)
    counted = per_y.select("*", *[F.coalesce(F.sum(f"_n{d}").over(smaller_y), F.lit(0)).alias(f"_b{d}") for d in digits])
    if n_buckets > 1:
        totals = per_y.groupBy("_at", "_g", "_yb").agg(*[F.sum(f"_n{d}").alias(f"_t{d}") for d in digits])
        across = Window.partitionBy("_at", "_g").orderBy("_yb").rowsBetween(*BEFORE)  # one row per bucket
        offsets = totals.select(
            "_at", "_g", "_yb", *[F.coalesce(F.sum(f"_t{d}").over(across), F.lit(0)).alias(f"_o{d}") for d in digits]
        )
        counted = join_null_safe(counted, offsets, ["_at", "_g", "_yb"])
        counted = counted.withColumns({f"_b{d}": F.col(f"_b{d}") + F.col(f"_o{d}") for d in digits})
    # against the rows of smaller y: a smaller digit agrees with the order, a larger one does not
    agree = " + ".join(f"_n{d} * ({' + '.join(f'_b{e}' for e in digits if e < d)})" for d in digits if d > 0)
    differ = " + ".join(f"_n{d} * ({' + '.join(f'_b{e}' for e in digits if e > d)})" for d in digits if d < DIGIT - 1)
    return counted.agg(F.sum(F.expr(agree).cast("decimal(38,0)")).alias("agree"), F.sum(F.expr(differ).cast("decimal(38,0)")).alias("differ"))
