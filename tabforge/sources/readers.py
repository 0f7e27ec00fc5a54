"""CSV, JSON and Parquet tables with one notion of "missing"."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import Roles, column_roles, nan_to_null, q_col, to_number

# Text that stands for a missing value in CSV files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Spellings of the two truth values.
TRUE_TOKENS, FALSE_TOKENS = ("True", "TRUE", "true"), ("False", "FALSE", "false")
EXTENSIONS = {".csv": "csv", ".json": "json", ".jsonl": "jsonl", ".parquet": "parquet"}


def table_format(path: str) -> str:
    """Format by file extension; anything unknown is an error."""
    for extension, name in EXTENSIONS.items():
        if path.rstrip("/").lower().endswith(extension):
            return name
    raise ValueError(f"unsupported file type: {path!r}; known are {sorted(EXTENSIONS)}")


def load(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None, **options: Any
) -> tuple[DataFrame, Roles]:
    """Read a table and detect its column roles. A missing path raises Spark's PATH_NOT_FOUND."""
    df = read_table(spark, path, fmt, schema, **options)
    return df, column_roles(df)


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None, **options: Any
) -> DataFrame:
    fmt = fmt or table_format(path)
    if fmt == "csv":
        return read_csv(spark, path, schema, **options)
    if fmt in ("json", "jsonl"):
        return read_json(spark, path, schema, lines=fmt == "jsonl", **options)
    if fmt == "parquet":
        return nan_to_null(spark.read.options(**options).parquet(path))
    raise ValueError(f"unsupported format {fmt!r}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """CSV with a header. Missing-value tokens become NULL before any cast.

    With a schema nothing is scanned ahead and unparseable cells are NULL. Without one, each
    column's type comes from one pass over its values: integer, double (also for integers with
    gaps), boolean, else text.
    """
    reader = spark.read.options(header=True, **options)
    if schema is not None:
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        raw = reader.schema(text).csv(path)
        # no token parses as a number, and NaN is missing: numbers need no look at the tokens
        raw = _without_tokens(raw, [f.name for f in schema.fields if not isinstance(f.dataType, T.NumericType)])
        return raw.select(*[_parsed(q_col(f.name), f.dataType).alias(f.name) for f in schema.fields])
    raw = reader.csv(path)
    raw = _without_tokens(raw, raw.columns)
    types = _inferred(raw)
    return raw.select(*[_parsed(q_col(c), types[c]).alias(c) for c in raw.columns])


def _without_tokens(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    return raw.select(*[F.when(~q_col(c).isin(*NA_TOKENS), q_col(c)).alias(c) if c in columns else q_col(c) for c in raw.columns])


def _parsed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return to_number(text).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(text)
    return text.try_cast(kind)


def _inferred(raw: DataFrame) -> dict[str, T.DataType]:
    parts = [F.count("*").alias("n")]
    for i, c in enumerate(raw.columns):
        v = q_col(c)
        parts += [
            F.count(v).alias(f"v{i}"),
            F.count(F.when(v.rlike(r"^\s*[+-]?[0-9]+\s*$"), v).try_cast("long")).alias(f"i{i}"),
            F.count(to_number(v)).alias(f"d{i}"),
            F.count_if(v.isin(*TRUE_TOKENS, *FALSE_TOKENS)).alias(f"b{i}"),
        ]
    row = raw.agg(*parts).first()

    def kind(i: int) -> T.DataType:
        values = row[f"v{i}"]
        if values == 0:
            return T.DoubleType()
        if row[f"i{i}"] == values == row["n"]:
            return T.LongType()
        if row[f"d{i}"] == values:
            return T.DoubleType()
        if row[f"b{i}"] == values == row["n"]:
            return T.BooleanType()
        return T.StringType()

    return {c: kind(i) for i, c in enumerate(raw.columns)}


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, lines: bool = False, **options: Any
) -> DataFrame:
    """An array of records, or one record per line (which splits over tasks; prefer it for large files)."""
    reader = spark.read.options(multiLine=not lines, **options)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    return nan_to_null(df)
