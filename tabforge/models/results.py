"""Metric tables: comparison, ranking, importances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .registry import SavedModel


def comparison(results: DataFrame) -> DataFrame:
    """Models by falling test R2, with the signed and absolute train-test gap."""
    gap = F.col("test_rmse") - F.col("train_rmse")
    return results.withColumns({"gap": gap, "abs_gap": F.abs(gap)}).orderBy(F.desc_nulls_last("test_r2"), "model")


def best_model(results: DataFrame, order: str | None = None) -> DataFrame:
    """The row with the highest test R2. Undefined values never win; ``order`` (then the name) settles ties."""
    valid = results.where(F.col("test_r2").isNotNull() & ~F.isnan("test_r2"))
    return valid.orderBy(F.desc("test_r2"), *([order] if order else []), "model").limit(1)


def best_per_metric(results: DataFrame) -> DataFrame:
    """One row: which model is best by R2, by RMSE and by MAE."""
    return results.agg(
        F.max_by("model", "test_r2").alias("best_r2"),
        F.min_by("model", "test_rmse").alias("best_rmse"),
        F.min_by("model", "test_mae").alias("best_mae"),
    )


def importance_table(spark: SparkSession, model: SavedModel, top_n: int | None = 10) -> DataFrame | None:
    """(feature, importance), highest first; None for models without importances."""
    shares = model.importances()
    if shares is None:
        return None
    table = spark.createDataFrame(list(shares.items()), "feature string, importance double")
    table = table.orderBy(F.desc("importance"), "feature")
    return table.limit(top_n) if top_n else table


def compare_importances(spark: SparkSession, models: Mapping[str, SavedModel], top_n: int = 10) -> DataFrame:
    """The top features of every model that has importances, side by side; needs at least two."""
    rows = [
        (name, feature, share)
        for name, model in models.items()
        for feature, share in (model.importances() or {}).items()
    ]
    names = sorted({name for name, _, _ in rows})
    if len(names) < 2:
        raise ValueError("comparing importances needs at least two models that have them")
    table = spark.createDataFrame(rows, "model string, feature string, importance double")
    first = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    top = table.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top_n)
    return top.groupBy("feature").pivot("model", names).agg(F.first("importance"))
