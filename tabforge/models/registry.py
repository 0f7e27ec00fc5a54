"""The four regressors behind one interface, open for more."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import q_col
from ..sources.writers import read_json_record, write_json_record
from . import histograms as hg, trees
from .gram import ridge_fold_errors
from .linear import fit_polynomial_ridge
from .ml_forest import fit_by_vector


class Regressor(Protocol):
    def transform(self, df: DataFrame) -> DataFrame: ...


@dataclass
class SavedModel:
    """A fitted regressor with what scoring needs to know about it."""

    name: str
    model: Any
    features: list[str]
    hyperparams: dict[str, Any] = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        if isinstance(self.model, trees.TreeEnsemble):
            return self.model.transform(df, out)
        scored = self.model.transform(df)
        # expansion and assembly are stages of the model; their vectors are not part of the result
        return scored.select(*[q_col(c) for c in df.columns if c != out], F.col("prediction").alias(out))

    def gathered(self, df: DataFrame) -> DataFrame:
        """The same rows; those that go alike through Spark ML's trees stand together in a task, so that it finds their nodes in a core's cache."""
        if isinstance(self.model, trees.TreeEnsemble) or not isinstance(self.model.stages[-1], RandomForestRegressionModel):
            return df
        share = self.importances()
        return df.sortWithinPartitions(*[q_col(c) for c in sorted(self.features, key=lambda c: (share[c], c))])  # what splits most comes last

    def importances(self) -> dict[str, float] | None:
        """Per-feature shares; None where the model has none."""
        if isinstance(self.model, trees.TreeEnsemble):
            return self.model.importances()
        last = self.model.stages[-1]
        if not hasattr(last, "featureImportances"):
            return None
        return {c: float(last.featureImportances[i]) for i, c in enumerate(self.features)}

    def save(self, spark: SparkSession, path: str) -> str:
        kind = "ensemble" if isinstance(self.model, trees.TreeEnsemble) else "pipeline"
        if kind == "ensemble":
            self.model.save(spark, f"{path}/model")
        else:
            self.model.write().overwrite().save(f"{path}/model")
        record = {"name": self.name, "kind": kind, "features": self.features, "hyperparams": self.hyperparams}
        return write_json_record(spark, record, f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SavedModel":
        about = read_json_record(spark, f"{path}/about")
        model = (
            trees.TreeEnsemble.load(spark, f"{path}/model")
            if about["kind"] == "ensemble"
            else PipelineModel.load(f"{path}/model")
        )
        return SavedModel(about["name"], model, about["features"], about["hyperparams"])


@dataclass(frozen=True)
class Param:
    """One search dimension: integers or floats between two bounds, evenly or on a log scale."""

    low: float
    high: float
    integer: bool = False
    log: bool = False


@dataclass(frozen=True)
class Trainer:
    """How to fit one kind of model, its defaults and its search space."""

    name: str
    fit: Callable[..., Any]
    defaults: Mapping[str, Any]
    space: Mapping[str, Param]
    trials: int = 20
    seconds: float = 600.0
    has_importance: bool = True
    # errors of many settings and folds at once: (folded, k, features, target, settings) -> per setting and fold
    fold_errors: Callable[..., Any] | None = None

    def train(
        self, df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], *, seed: int = 42, **params: Any
    ) -> SavedModel:
        settings = {**self.defaults, **params}
        model = self.fit(df, list(features), target, list(key), seed=seed, **settings)
        return SavedModel(self.name, model, list(features), settings)


def _ridge(df, features, target, key, *, seed, **params):
    return fit_polynomial_ridge(df, features, target, **params)


FOREST_LAYOUT = 64


def fixed_layout(df: DataFrame, key: Sequence[str], parts: int) -> DataFrame:
    """Rows in a partitioning that follows from the key alone.

    Spark ML draws bootstrap samples per partition; with the same layout a seed gives the same
    forest however the table arrived.
    """
    return df.repartition(parts, *[q_col(k) for k in key]).sortWithinPartitions(*[q_col(k) for k in key])


def _random_forest(df, features, target, key, *, seed, backend="cells", layout=FOREST_LAYOUT, **params):
    """The cell-based forest, or (``backend="ml"``) Spark ML's.

    Spark ML has no ``min_samples_split``; it serves where ``min_samples_leaf`` already implies it. Over more than
    ``histograms.LOCAL_ROWS`` rows its trees grow from sums by vector of bins where :func:`ml_forest.fit_by_vector` can.
    """
    if backend == "cells":
        return trees.fit_forest(df, features, target, key, bootstrap=True, seed=seed, **params)
    if params["min_samples_split"] > 2 * params["min_samples_leaf"]:
        raise ValueError("Spark ML's forest cannot hold min_samples_split above twice min_samples_leaf")
    forest = RandomForestRegressor(
        featuresCol="_features",
        labelCol=target,
        predictionCol="prediction",
        numTrees=params["n_estimators"],
        maxDepth=params["max_depth"],
        minInstancesPerNode=max(params["min_samples_leaf"], 1),
        featureSubsetStrategy="all",
        maxBins=params.get("max_bins", 64),
        maxMemoryInMB=512,
        seed=seed,
    )
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="error")
    rows = fixed_layout(df.select(*[q_col(c) for c in {*features, target, *key}]), key, layout) if key else df
    if key and (n := df.count()) > hg.LOCAL_ROWS:
        rows = hg.keep(rows.select(*[q_col(c) for c in {*features, target}]))  # several passes, without sorting again
        try:
            grown = fit_by_vector(forest, assembler.transform(rows), features, n)
            return PipelineModel([assembler, grown]) if grown is not None else Pipeline(stages=[assembler, forest]).fit(rows)
        finally:
            rows.unpersist()
    return Pipeline(stages=[assembler, forest]).fit(rows)


def _extra_trees(df, features, target, key, *, seed, **params):
    return trees.fit_forest(df, features, target, key, random_cuts=True, seed=seed, **params)


def _boosted(df, features, target, key, *, seed, **params):
    return trees.fit_boosted(df, features, target, key, seed=seed, **params)


# Default settings, search spaces and search budgets per model.
FOREST_SPACE = {
    "n_estimators": Param(50, 300, integer=True),
    "max_depth": Param(5, 20, integer=True),
    "min_samples_split": Param(2, 10, integer=True),
    "min_samples_leaf": Param(1, 5, integer=True),
}
TRAINERS: dict[str, Trainer] = {
    "polynomial": Trainer(
        "polynomial",
        _ridge,
        {"degree": 3, "alpha": 1.0},
        {"degree": Param(2, 5, integer=True), "alpha": Param(1e-3, 10.0, log=True)},
        10,
        300.0,
        has_importance=False,
        fold_errors=ridge_fold_errors,
    ),
    "random_forest": Trainer(
        "random_forest",
        _random_forest,
        {"n_estimators": 100, "max_depth": 10, "min_samples_split": 5, "min_samples_leaf": 2},
        FOREST_SPACE,
    ),
    "extra_trees": Trainer(
        "extra_trees",
        _extra_trees,
        {"n_estimators": 200, "max_depth": 12, "min_samples_split": 2, "min_samples_leaf": 1},
        FOREST_SPACE,
    ),
    "boosted_trees": Trainer(
        "boosted_trees",
        _boosted,
        {
            "max_depth": 4, "learning_rate": 0.05, "n_estimators": 150, "subsample": 0.7, "colsample_bytree": 0.7,
            "min_child_weight": 5, "gamma": 0.1, "reg_lambda": 1.0, "reg_alpha": 0.5,
        },
        {
            "max_depth": Param(4, 10, integer=True),
            "learning_rate": Param(0.01, 0.3, log=True),
            "n_estimators": Param(100, 500, integer=True),
            "subsample": Param(0.6, 1.0),
            "colsample_bytree": Param(0.6, 1.0),
            "min_child_weight": Param(1, 10, integer=True),
            "gamma": Param(0.0, 1.0),
            "reg_lambda": Param(0.01, 10.0, log=True),
            "reg_alpha": Param(0.0, 1.0),
        },
        30,
        900.0,
    ),
}


def get_trainer(name: str) -> Trainer:
    if name not in TRAINERS:
        raise ValueError(f"unknown trainer {name!r}; available: {sorted(TRAINERS)}")
    return TRAINERS[name]


def register(trainer: Trainer) -> None:
    """Add a model kind; it then takes part in training, search and ranking."""
    TRAINERS[trainer.name] = trainer
