"""Named queries over the driver tables, each beside its SQL statement where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Tables with gaps: the test tables have no missing values, so both sides blank cells by key.
ORDERS_GAPS = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
    "o_orderstatus",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
)
LINES_GAPS = (
    "l_quantity",
    "l_extendedprice",
    "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount",
    "l_tax",
    "l_linenumber",
)
EVENTS_GAPS = (
    "event_id",
    "user_id",
    "event_type",
    "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.selectExpr(*columns) if columns else df


def source(name: str, columns: tuple[str, ...]) -> str:
    """The same projection as a sub-select."""
    return f"(SELECT {', '.join(columns)} FROM {name})"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def union_all(parts) -> str:
    return " UNION ALL ".join(parts)
