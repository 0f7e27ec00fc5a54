"""Exact dedup by skew-safe combining.

Copies are combined in three stages, each of which groups by digest and whole content, so texts with equal
digests but different contents never meet: within the task that reads them (Spark's partial aggregation),
within one of several salts per digest, and over the salts. A hot text therefore arrives at any task only as
one row per reading task of its salt, then as one row per salt.

What stays is then attached to every document by digest. Digests that hold more than a thousandth of the
rows are joined by broadcast (there are fewer than a thousand), the others by a salted join; digests that
stand for several contents are joined with their contents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lookups import attach
from ..session import stored
from .words import unused

SALTS = 16


def normalised(text: str) -> Column:
    """The text with every run of white space (space, U+0009 to U+000D) as one space; missing is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def exact_copies(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = SALTS
) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space normalisation. The row with the smallest ``doc_id``
    stays (missing ids come last); of rows that repeat an id and a text all count in ``group_size`` and all
    are marked kept. Missing texts equal empty ones. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("_content")).withColumn("_digest", digest(F.col("_content")))
    kept = stored(_combined(rows, salts).select("_digest", "keep_id", "group_size"))
    clashing = stored(kept.groupBy("_digest").agg(F.count("*").alias("_n")).where("_n > 1").select("_digest"))
    total = kept.agg(F.sum("group_size")).first()[0] or 0
    keyed = rows.select("doc_id", "_digest", sha256(F.col("_content")).alias("text_sha256"))
    weighted = kept.withColumn("_w", F.col("group_size"))
    if clashing.isEmpty():
        found = attach(keyed, weighted, "_digest", rows=total, weight="_w", broadcast_bytes=0)
    else:
        apart = rows.join(clashing, "_digest", "left_semi")
        ids = apart.groupBy("_digest", "_content", "doc_id").agg(F.count("*").alias("_times"))
        whole = ids.join(_combined(apart, salts), ["_digest", "_content"]).withColumn("_copy", F.explode(F.expr("sequence(1, _times)")))
        found = attach(
            keyed.join(clashing, "_digest", "left_anti"), weighted.join(clashing, "_digest", "left_anti"), "_digest", rows=total, weight="_w", broadcast_bytes=0
        ).unionByName(whole.select("doc_id", "_digest", sha256(F.col("_content")).alias("text_sha256"), "keep_id", "group_size"))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """_digest, _content, keep_id, group_size of each distinct content."""
    # the reading task decides the salt: all copies that it reads become one row before the shuffle
    salted = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    by_salt = salted.groupBy("_digest", "_content", "_salt").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return by_salt.groupBy("_digest", "_content").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def without_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, in full."""
    (own,) = unused(docs.columns, "_keep")
    ids = exact_copies(docs, doc_id=doc_id, text=text).where("kept").select(F.col("keep_id").alias(own))
    return docs.join(ids, F.col(doc_id).eqNullSafe(F.col(own)), "left_semi")
