"""Evaluation of predictions: regression errors, confusion counts, ROC, scoring summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.ordered import running_sums
from ..schema import q_col


def regression_metrics(df: DataFrame, actual: str, predicted: str, prefix: str = "test") -> DataFrame:
    """``{prefix}_rmse``, ``_mae`` and ``_r2`` in one pass; no spread gives 1 for a perfect fit, else 0."""
    y, error = q_col(actual).cast("double"), q_col(actual) - q_col(predicted)
    squared = F.avg(error * error)
    spread = F.var_pop(y)
    r2 = F.when(spread > 0, 1.0 - F.try_divide(squared, spread)).when(squared == 0, 1.0).otherwise(0.0)
    return df.where(q_col(actual).isNotNull() & q_col(predicted).isNotNull()).agg(
        F.sqrt(squared).alias(f"{prefix}_rmse"), F.avg(F.abs(error)).alias(f"{prefix}_mae"), r2.alias(f"{prefix}_r2")
    )


def residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The table with ``residual`` = actual - predicted."""
    return df.withColumn("residual", q_col(actual) - q_col(predicted))


def combined_predictions(scored: Mapping[str, DataFrame], actual: str, predicted: str) -> DataFrame:
    """(model, actual, predicted, residual) of several scored tables, stacked."""
    parts = [
        residuals(df, actual, predicted).select(
            F.lit(name).alias("model"), q_col(actual).alias("actual"), q_col(predicted).alias("predicted"), "residual"
        )
        for name, df in scored.items()
    ]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def error_table(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Absolute and percent error per row; percent is 0 where the actual value is 0."""
    absolute = F.abs(q_col(actual) - q_col(predicted))
    return df.withColumns(
        {
            "abs_error": absolute,
            "pct_error": F.when(q_col(actual) != 0, F.try_divide(absolute, q_col(actual).cast("double")) * 100).otherwise(0.0),
        }
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, *, dense_classes: int = 0) -> DataFrame:
    """(actual, predicted, n) of the pairs that occur.

    ``dense_classes`` asks for every pair of occurring classes, zeros included, and bounds their number: more
    classes are an error, since the grid has their square.
    """
    counts = df.groupBy(q_col(label).alias("actual"), q_col(prediction).alias("predicted")).agg(F.count("*").alias("n"))
    if not dense_classes:
        return counts.where("actual is not null and predicted is not null")
    met = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).where("c is not null").distinct()
    if met.limit(dense_classes + 1).count() > dense_classes:
        raise ValueError(f"more than {dense_classes} classes: a dense confusion matrix would have their square")
    classes = met.agg(F.array_sort(F.collect_set("c")).alias("all"))
    grid = classes.select(F.explode("all").alias("actual"), "all").select("actual", F.explode("all").alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").na.fill(0, ["n"])


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tpr, fpr, tp, fp) per distinct score, highest first, ties as one step.

    Rows collapse to distinct scores before anything is ordered; rates are NULL where a
    class is absent.
    """
    steps = (
        df.where(q_col(label).isNotNull() & q_col(score).isNotNull())
        .groupBy((-q_col(score).cast("double")).alias("_s"))
        .agg(F.count_if(q_col(label) == 1).alias("pos"), F.count_if(q_col(label) != 1).alias("neg"))
    )
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return running_sums(steps, "_s", ["pos", "neg"]).select(
        (-F.col("_s")).alias("threshold"),
        F.try_divide(tp.cast("double"), steps.agg(F.sum("pos")).scalar()).alias("tpr"),
        F.try_divide(fp.cast("double"), steps.agg(F.sum("neg")).scalar()).alias("fpr"),
        tp.alias("tp"),
        fp.alias("fp"),
        "pos",
        "neg",
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``auc`` (NULL unless both classes occur): trapezoids over the tie-correct curve."""
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    return roc_curve(df, label, score).agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )


def evaluate_model(model, df: DataFrame, target: str, *, prefix: str = "test") -> tuple[DataFrame, DataFrame]:
    """(metrics, rows with ``prediction``, residual and errors) of a fitted model on a table that has the target."""
    scored = model.transform(df.where(q_col(target).isNotNull()))
    return regression_metrics(scored, target, "prediction", prefix), error_table(residuals(scored, target, "prediction"), target, "prediction")


def score_summary(df: DataFrame, predicted: str) -> DataFrame:
    """Number, mean and extremes of the predictions."""
    p = q_col(predicted)
    return df.agg(F.count("*").alias("n"), F.avg(p).alias("mean"), F.min(p).alias("min"), F.max(p).alias("max"))


def first_rows(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 10) -> DataFrame:
    """A look at ``n`` rows in a stated order, with those of ``columns`` that exist."""
    return df.orderBy(*[q_col(c) for c in order_by]).limit(n).select(*[q_col(c) for c in columns if c in df.columns])
