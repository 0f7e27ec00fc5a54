"""Batch scoring with a saved plan and a saved model."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..models.registry import SavedModel
from ..operators.evaluate import score_summary
from ..schema import q_col
from ..session import stored
from ..sources.readers import read_table
from ..sources.writers import read_json_record, write_table
from .fitted import FittedPlan

PREDICTED = "Predicted_Price"  # fixed value: the name of the prediction column
CARRIED = "_given"


def score(df: DataFrame, fitted: FittedPlan, model: SavedModel, out: str = PREDICTED) -> DataFrame:
    """The given columns (without the target) plus the prediction.

    The original columns travel beside the features as one struct: no join, and the same code
    runs on a stream.
    """
    given = df.drop(fitted.target) if fitted.target in df.columns else df
    carried = given.withColumn(CARRIED, F.struct(*[q_col(c) for c in given.columns]))
    return model.transform(features_beside(carried, fitted), out).select(f"{CARRIED}.*", q_col(out))


def features_beside(carried: DataFrame, fitted: FittedPlan) -> DataFrame:
    """Feature columns of ``carried``, with the struct of original columns kept."""
    from dataclasses import replace

    keeping = replace(fitted, columns=[*fitted.columns, CARRIED], key=[*fitted.key, CARRIED])
    return keeping.transform(carried)


def score_file(
    spark: SparkSession,
    input_path: str,
    run_folder: str,
    *,
    model_name: str | None = None,
    output_path: str | None = None,
    out: str = PREDICTED,
    **options: Any,
) -> tuple[DataFrame, DataFrame]:
    """(scored table, summary) for a file, with a model of a saved run (its best by default)."""
    record = read_json_record(spark, f"{run_folder}/run")
    name = model_name or record["best_model"]
    if name not in record["models"]:
        raise ValueError(f"model {name!r} is not part of the run; available: {sorted(record['models'])}")
    fitted = FittedPlan.load(spark, record["transformer"]["path"])
    model = SavedModel.load(spark, record["models"][name]["path"])
    # scored once: the output file, the summary and the caller all read the stored rows
    scored = stored(score(read_table(spark, input_path, **options), fitted, model, out))
    if output_path:
        write_table(scored, output_path)
    return scored, score_summary(scored, out)
