"""Order-dependent kernels without a one-task window: running totals, row numbers, fills.

All three share one shape: bucket the order key, reduce each bucket to a summary row, turn
the summaries into what precedes each bucket, and finish inside the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..schema import q_col
from ..session import stored
from . import buckets as bk

BEFORE = (Window.unboundedPreceding, -1)
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the left copies of the keys are kept."""
    renamed = right.select(*[q_col(c).alias(f"_r_{c}") if c in keys else q_col(c) for c in right.columns])
    match = F.lit(True)
    for k in keys:
        match = match & q_col(k).eqNullSafe(q_col(f"_r_{k}"))
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])


def running_sums(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    *,
    groups: Sequence[str] = (),
    n_buckets: int | None = None,
) -> DataFrame:
    """For a table with one row per (groups, value): ``{s}_before``, the total of each ``s`` at smaller values."""
    edges = bk.cut_points(df, [bk.order_value(df, value)], n_buckets or bk.default_buckets(df))[0]
    cut = bk.with_bucket(df, bk.order_value(df, value), edges, "_b")
    totals = cut.groupBy(*groups, "_b").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    # one row per bucket and group: the only window that can span a whole group
    across = Window.partitionBy(*groups).orderBy("_b").rowsBetween(*BEFORE)
    offsets = totals.select(
        *groups, "_b", *[F.coalesce(F.sum(f"_t_{s}").over(across), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    inside = Window.partitionBy(*groups, "_b").orderBy(value).rowsBetween(*BEFORE)
    return (
        join_null_safe(cut, offsets, [*groups, "_b"])
        .select(
            *[q_col(c) for c in df.columns],
            *[(F.col(f"_o_{s}") + F.coalesce(F.sum(s).over(inside), F.lit(0))).alias(f"{s}_before") for s in sums],
        )
    )


def with_order_bucket(
    df: DataFrame, order_by: Sequence[str], out: str = "_ob", n_buckets: int | None = None
) -> DataFrame:
    """Bucket number consistent with the lexicographic order of ``order_by``, missing values last in each column.

    With text among the order columns Spark ranges the rows by all of them (:func:`_ranged`). Else, where one value of the first column fills a bucket alone, and where it is missing, that bucket is
    cut again by the second column, so equal leading keys do not pile up in one task.
    """
    n = n_buckets or bk.default_buckets(df)
    lead = order_by[0]
    if any(isinstance(df.schema[c].dataType, T.StringType) for c in order_by):
        return _ranged(df, order_by, out, n)
    values = [bk.order_value(df, lead)]
    if len(order_by) > 1:
        values.append(bk.order_value(df, order_by[1]))
    cuts = bk.cut_points(df, values, n)
    cut = bk.with_bucket(df, values[0], cuts[0], out)
    if len(order_by) == 1:
        return cut
    hot = [len(cuts[0]) + 1]  # the bucket of rows without a leading value
    if all(abs(e) < bk.EXACT_DOUBLE for e in cuts[0]):
        hot += bk.single_valued(cuts[0])
    # about four pieces per ordinary bucket in all, however many values are hot
    step = max(1, len(cuts[1]) * len(hot) // (4 * n))
    finer = cuts[1][::step]
    cut = bk.with_bucket(cut, values[1], finer, out + "2")
    width = len(finer) + 2
    return cut.withColumn(
        out, F.col(out) * width + F.when(F.col(out).isin(hot), F.col(out + "2")).otherwise(0)
    ).drop(out + "2")


def _ranged(df: DataFrame, order_by: Sequence[str], out: str, n: int) -> DataFrame:
    """The bucket is the range that Spark's range partitioning puts a row into, by whole texts and all order columns.

    The ranges come from a sample of each task, so the rows are written with their bucket: a lost task, or a second
    pass, finds the same ones. Rows that agree in all order columns share a bucket.
    """
    return stored(df.repartitionByRange(n, *[q_col(c).asc_nulls_last() for c in order_by]).withColumn(out, F.spark_partition_id()))


def row_numbers(
    df: DataFrame, order_by: Sequence[str], out: str = "row_number", n_buckets: int | None = None
) -> DataFrame:
    """Global 0-based row number in the order of ``order_by`` (which should be unique)."""
    cut = with_order_bucket(df, order_by, n_buckets=n_buckets)
    counts = cut.groupBy("_ob").agg(F.count("*").alias("_n"))
    offsets = counts.select(
        "_ob", F.coalesce(F.sum("_n").over(Window.orderBy("_ob").rowsBetween(*BEFORE)), F.lit(0)).alias("_o")
    )
    inside = Window.partitionBy("_ob").orderBy(*[q_col(c).asc_nulls_last() for c in order_by])
    # the table of offsets has a row per bucket; Spark broadcasts it while it is small
    return cut.join(offsets, "_ob").select(
        *[q_col(c) for c in df.columns], (F.col("_o") + F.row_number().over(inside) - 1).cast("long").alias(out)
    )


def fill_along(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    *,
    groups: Sequence[str] = (),
    backward: bool = False,
    n_buckets: int | None = None,
) -> DataFrame:
    """Carry the last known value forward (or the next one backward) into missing cells."""
    cut = with_order_bucket(df, order_by, n_buckets=n_buckets)
    keys = [q_col(c).desc_nulls_first() if backward else q_col(c).asc_nulls_last() for c in order_by]
    bucket_key = F.col("_ob").desc() if backward else F.col("_ob").asc()
    nearest = F.min_by if backward else F.max_by
    # a single plain key keeps this a hash aggregate; several are one struct, in which a missing key comes last
    lead = q_col(order_by[0])
    position_key = lead if len(order_by) == 1 else F.struct(*[e for k in order_by for e in (q_col(k).isNull().alias(f"n_{k}"), q_col(k).alias(k))])

    def held(c: str) -> Column:
        value = nearest(q_col(c), F.when(q_col(c).isNotNull(), position_key))
        # rows without the only key share one bucket, in no order
        return value if len(order_by) > 1 else F.coalesce(value, F.max(F.when(lead.isNull(), q_col(c))))

    summary = cut.groupBy(*groups, "_ob").agg(*[held(c).alias(f"_s_{i}") for i, c in enumerate(columns)])
    across = Window.partitionBy(*groups).orderBy(bucket_key).rowsBetween(*BEFORE)
    carried = summary.select(
        *groups, "_ob", *[F.last(f"_s_{i}", ignorenulls=True).over(across).alias(f"_c_{i}") for i in range(len(columns))]
    )
    inside = Window.partitionBy(*groups, "_ob").orderBy(*keys).rowsBetween(*UP_TO_HERE)
    position = {c: i for i, c in enumerate(columns)}

    def filled(c: str) -> Column:
        if c not in position:
            return q_col(c)
        return F.coalesce(F.last(q_col(c), ignorenulls=True).over(inside), F.col(f"_c_{position[c]}")).alias(c)

    return join_null_safe(cut, carried, [*groups, "_ob"]).select(*[filled(c) for c in df.columns])


FEW_LEVELS = 500
LITERAL_RANKS = 16


def average_ranks(df: DataFrame, columns: Sequence[str], prefix: str = "_rank") -> DataFrame:
    """The table plus ``{prefix}{i}``: 1-based rank of every non-null value, ties at their average.

    A column with few distinct values is ranked through a broadcast table of those values. Any
    other is cut into buckets and ranked inside them. A value frequent enough to fill a bucket
    alone needs no ranking there: its rows only pass through, spread by the task they came from.
    The number of passes over the table does not depend on the number of columns.
    """
    from .fitting import level_counts

    few, many = level_counts(df, columns, FEW_LEVELS)
    cuts = dict(zip(many, _bucket_counts(df, many))) if many else {}
    ranked = df
    for i, c in enumerate(columns):
        out = f"{prefix}{i}"
        ranked = _rank_few(ranked, c, few[c], out) if c in few else _rank_many(ranked, c, *cuts[c], out)
    return ranked


def _rank_few(df: DataFrame, column: str, counts: dict, out: str) -> DataFrame:
    rows, before = [], 0
    for value, n in counts.items():
        rows.append((value, before + (n + 1) / 2.0))
        before += n
    if len(rows) <= LITERAL_RANKS:
        rank = F.lit(None).cast("double")
        for value, r in rows:
            rank = F.when(q_col(column) == F.lit(value), r).otherwise(rank)
        return df.withColumn(out, rank)
    schema = T.StructType([T.StructField(column, df.schema[column].dataType), T.StructField(out, T.DoubleType())])
    table = df.sparkSession.createDataFrame(rows, schema)  # at most FEW_LEVELS rows
    return join_null_safe(df, F.broadcast(table), [column], "left")


def _bucket_counts(df: DataFrame, columns: Sequence[str]) -> list[tuple[list[float], list[tuple[int, int, int]]]]:
    """Per column: bucket edges, and (bucket, rows, rows before) - a sketching and a counting pass for all."""
    values = [bk.order_value(df, c) for c in columns]
    edges = bk.cut_points(df, values, bk.default_buckets(df))
    cut = df.select(*[q_col(c) for c in columns])
    for i, c in enumerate(columns):
        cut = bk.with_bucket(cut, bk.order_value(df, c), edges[i], f"_b{i}")
    entries = [
        F.struct(F.lit(i).alias("i"), F.when(q_col(c).isNotNull(), F.col(f"_b{i}")).alias("b")) for i, c in enumerate(columns)
    ]
    counts = (
        cut.select(F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e.b").isNotNull())
        .groupBy("e.i", "e.b")
        .agg(F.count("*").alias("n"))
        .collect()  # at most columns x MAX_BUCKETS rows
    )
    offsets: list[list[tuple[int, int, int]]] = [[] for _ in columns]
    for r in sorted(counts, key=lambda r: (r["i"], r["b"])):
        mine = offsets[r["i"]]
        mine.append((r["b"], r["n"], mine[-1][1] + mine[-1][2] if mine else 0))
    return list(zip(edges, offsets))


def _rank_many(df: DataFrame, column: str, edges: list[float], counts: list[tuple[int, int, int]], out: str) -> DataFrame:
    hot = bk.single_valued(edges)
    offsets = df.sparkSession.createDataFrame(counts, "_b int, _n long, _o long")  # a row per bucket
    cut = bk.with_bucket(df, bk.order_value(df, column), edges, "_b").join(offsets, "_b", "left")
    alone = F.col("_b").isin(hot) if hot else F.lit(False)
    # missing values share the bucket after the last; they pass through like the hot ones
    passing = alone | q_col(column).isNull()
    cut = cut.withColumn("_via", F.when(passing, F.spark_partition_id()).otherwise(-1))
    inside = Window.partitionBy("_b", "_via").orderBy(q_col(column))
    ties = F.count("*").over(Window.partitionBy("_b", "_via", q_col(column)))
    here = F.when(alone, F.col("_o") + (F.col("_n") + 1) / 2.0).otherwise(
        F.col("_o") + F.rank().over(inside) + (ties - 1) / 2.0
    )
    return cut.withColumn(out, F.when(q_col(column).isNotNull(), here)).drop("_b", "_via", "_n", "_o")
