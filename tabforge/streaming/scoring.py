"""Scoring a stream: the fitted plan and the model are narrow, so batch code runs unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..models.registry import SavedModel
from ..plans.fitted import FittedPlan
from ..plans.scoring import PREDICTED, score


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Files arriving in a folder; the schema must be given."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def score_stream(stream: DataFrame, fitted: FittedPlan, model: SavedModel, out: str = PREDICTED) -> DataFrame:
    return score(stream, fitted, model, out)


def start_scoring(
    stream: DataFrame, fitted: FittedPlan, model: SavedModel, output: str, checkpoint: str, *, available_now: bool = False
) -> StreamingQuery:
    """Append scored rows as Parquet; the checkpoint folder must be on shared storage."""
    writer = score_stream(stream, fitted, model).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)
