"""Writing tables, metric records and run metadata. Every sink is a Spark write."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.split import with_split_tag
from ..schema import q_col
from .readers import table_format

RESULT_SCHEMA = (
    "model string, train_rmse double, test_rmse double, test_mae double, test_r2 double, hyperparams map<string,string>"
)


def write_table(df: DataFrame, path: str, fmt: str | None = None, *, partition_by: Sequence[str] = ()) -> str:
    """Write a directory of CSV (with header), JSON lines or Parquet parts."""
    fmt = fmt or table_format(path)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt in ("json", "jsonl"):
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def write_json_arrays(df: DataFrame, path: str, key: Sequence[str], files: int) -> str:
    """A folder of ``files`` JSON documents, each one array of the rows whose key hashes to it.

    A reader parses a document in one task, so ``files`` should grow with the table; the writer holds one batch
    of rows at a time. An empty table writes an empty folder, which reads back with a given schema only.
    """
    record = F.to_json(F.struct(*[q_col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")

    def lines(batches):
        lead = "["
        for batch in batches:
            if not batch.num_rows:
                continue
            leads = pa.array([lead] + [","] * (batch.num_rows - 1))
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(leads, batch.column(0), "")], names=["value"])
            lead = ","
        if lead == ",":
            yield pa.RecordBatch.from_pydict({"value": ["]"]})

    spread = df.repartition(files, *[q_col(c) for c in key]).select(record).mapInArrow(lines, "value string")
    # one task writes one file, whatever limit of records the session sets
    spread.write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)
    return path


def write_processed(train: DataFrame, test: DataFrame, path: str, fmt: str | None = None) -> str:
    """Both sides with a ``split`` tag, one folder per side, so a reader of one side skips the other."""
    return write_table(with_split_tag(train, test), path, fmt or "parquet", partition_by=["split"])


def results_frame(spark: SparkSession, results: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """One row per model from ``{model: {train_rmse, test_rmse, test_mae, test_r2, hyperparams}}``."""
    rows = [
        (
            name,
            *[None if r[m] is None else float(r[m]) for m in ("train_rmse", "test_rmse", "test_mae", "test_r2")],
            {k: str(v) for k, v in r["hyperparams"].items()},
        )
        for name, r in results.items()
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def write_results(spark: SparkSession, results: Mapping[str, Mapping[str, Any]], path: str) -> str:
    return write_table(results_frame(spark, results).coalesce(1), path, "json")


def write_metadata(
    spark: SparkSession,
    path: str,
    *,
    transformer_path: str,
    target: str,
    n_features: int,
    results: Mapping[str, Mapping[str, Any]],
    model_paths: Mapping[str, str],
    best_model: str | None,
) -> str:
    """The record that a later scoring run starts from."""
    metrics = ("train_rmse", "test_rmse", "test_mae", "test_r2")
    best = results.get(best_model) if best_model else None
    record = {
        "generated_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "transformer": {"path": transformer_path, "target_column": target, "n_features": n_features},
        "models": {
            name: {
                "path": model_paths.get(name),
                "metrics": {m: r[m] for m in metrics},
                "hyperparams": {k: str(v) for k, v in r["hyperparams"].items()},
            }
            for name, r in results.items()
        },
        "best_model": best_model,
        "best_model_path": model_paths.get(best_model) if best_model else None,
        "best_metrics": {m: best[m] for m in metrics[1:]} if best else None,
    }
    return write_json_record(spark, record, path)


def write_json_record(spark: SparkSession, record: Mapping[str, Any], path: str) -> str:
    """One JSON document as a one-line text dataset, on whatever file system the path names."""
    spark.range(1).select(F.lit(json.dumps(record, ensure_ascii=False, default=str)).alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path


def read_json_record(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path, wholetext=False).first()["value"])
