"""Equal-depth value buckets: the way a global order is spread over tasks.

A window over a whole table runs in one task. Here the order column is first cut into
ranges of roughly equal row count (cut points from a bounded quantile sketch), so every
later window has a bucket in its partition list. A value that alone fills several ranges
gets a bucket of its own.
"""

from __future__ import annotations

import math
from bisect import bisect_right

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import q_col

MAX_BUCKETS = 1 << 17  # edges that a task and the driver hold as doubles: one megabyte
EXACT_DOUBLE = float(2**53)


def default_buckets(df: DataFrame) -> int:
    """A few buckets per shuffle task, so that buckets follow the size that the cluster was set up for."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(MAX_BUCKETS, 4 * tasks))


def order_value(df: DataFrame, column: str) -> Column:
    """A double that never decreases when the order column grows."""
    kind = df.schema[column].dataType
    c = q_col(column)
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    raise ValueError(f"order column {column!r} must be numeric, a date or a timestamp, not {kind.simpleString()}")


def cut_points(df: DataFrame, values: list[Column], buckets: int) -> list[list[float]]:
    """Inner bucket edges per value expression, from one pass of bounded sketches."""
    grid = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 10 * buckets)
    row = df.agg(*[F.percentile_approx(v, grid, accuracy).alias(f"e{i}") for i, v in enumerate(values)]).first()
    return [_edges(row[f"e{i}"] or []) for i in range(len(values))]


def _edges(points: list[float]) -> list[float]:
    edges: list[float] = []
    for i, p in enumerate(points):
        if not edges or p > edges[-1]:
            edges.append(p)
        elif p == points[i - 1] and math.isfinite(p):
            after = math.nextafter(p, math.inf)
            if edges[-1] != after:
                edges.append(after)
    return edges


def single_valued(edges: list[float]) -> list[int]:
    """Numbers of the buckets that can hold one value only."""
    return [i + 1 for i in range(len(edges) - 1) if edges[i + 1] == math.nextafter(edges[i], math.inf)]


def with_bucket(df: DataFrame, value: Column, edges: list[float], out: str) -> DataFrame:
    """Add the bucket number of ``value``; missing values get the number after the last."""
    if not edges:
        return df.withColumn(out, F.when(value.isNull(), 1).otherwise(0))
    probe = out + "_v"
    cutter = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol=probe, outputCol=out + "_d", handleInvalid="keep"
    )
    cut = cutter.transform(df.withColumn(probe, value))
    return cut.withColumn(out, F.coalesce(F.col(out + "_d").cast("int"), F.lit(len(edges) + 1))).drop(probe, out + "_d")


def bucket_of(value: float, edges: list[float]) -> int:
    return bisect_right(edges, value)
