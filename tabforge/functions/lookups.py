"""Attach a keyed value table to a large table whose key may be badly skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import q_col
from .ordered import join_null_safe

HEAVY_SHARE = 1000
BROADCAST_BYTES = 16 << 20  # of keys and payload as text; beyond it both sides are shuffled


def measured_bytes(table: DataFrame) -> int:
    """The size of a table of flat columns, each value as text; one job over the table."""
    width = sum((F.coalesce(F.octet_length(q_col(c).cast("string")), F.lit(1)) + 16 for c in table.columns), F.lit(0))
    return table.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def attach(
    df: DataFrame, table: DataFrame, key: str, *, rows: int, weight: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join on ``key``; ``table`` has one row per key value and its frequency ``weight`` in ``df``.

    A table whose measured size is at most ``broadcast_bytes`` goes to every task, and ``df`` stays where it is.

    Otherwise keys that hold more than a thousandth of ``rows`` are joined by broadcast - there are fewer
    than a thousand of them. Their rows pass the shuffled join for the rest under a salted key
    that matches nothing, so no task receives a whole hot key and ``df`` is read once.
    """
    limit = max(1, rows // HEAVY_SHARE)
    payload = [c for c in table.columns if c not in (key, weight)]
    if broadcast_bytes and measured_bytes(table) <= broadcast_bytes:
        return join_null_safe(df, F.broadcast(table.drop(weight)), [key], "left").select(*[q_col(c) for c in (*df.columns, *payload)])
    heavy = table.where(F.col(weight) > limit).select(
        q_col(key), F.lit(True).alias("_heavy"), *[q_col(c).alias(f"_h_{c}") for c in payload]
    )
    light = table.where(F.col(weight) <= limit).select(q_col(key), F.lit(-1).alias("_salt"), *[q_col(c) for c in payload])
    marked = join_null_safe(df, F.broadcast(heavy), [key], "left")
    # the number of the task that read the row: stable when the task runs again
    salted = marked.withColumn("_salt", F.when(F.col("_heavy"), F.spark_partition_id()).otherwise(-1))
    joined = join_null_safe(salted, light, [key, "_salt"], "left")
    return joined.select(
        *[q_col(c) for c in df.columns],
        *[F.when(F.col("_heavy"), q_col(f"_h_{c}")).otherwise(q_col(c)).alias(c) for c in payload],
    )
