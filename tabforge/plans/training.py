"""A training run: clean, split, fit, train every model, rank, persist."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import key_hash
from ..models import results as rs
from ..models.registry import TRAINERS, SavedModel, get_trainer
from ..models.search import search
from ..operators import clean
from ..operators.correlation import select_features
from ..operators.evaluate import regression_metrics
from ..operators.split import train_test_split
from ..schema import q_col
from ..session import spread, stored
from ..sources import writers
from .fitted import FeaturePlan, FittedPlan

SELECTION_THRESHOLD = 0.3
KEY_HASH = "_key_hash"


def prepare(df: DataFrame, constraints: Mapping[str, Mapping[str, Any]], *, unify: bool = True) -> DataFrame:
    """Cleaning before the split; copies are removed before text is unified, so case variants stay."""
    df = clean.drop_duplicates(df)
    if unify:
        df = clean.unify_text(df)
    return clean.apply_constraints(df, constraints) if constraints else df


@dataclass
class TrainingRun:
    """Trains registered models on fixed train and test tables and keeps their results."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    target: str
    key: list[str]
    seed: int = 42
    models: dict[str, SavedModel] = field(default_factory=dict)
    results: dict[str, dict[str, Any]] = field(default_factory=dict)
    searches: dict[str, Any] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.train.sparkSession

    def data_info(self) -> dict[str, int]:
        counts = [d.count() for d in (self.train, self.test)]
        return {"n_train": counts[0], "n_test": counts[1], "n_features": len(self.features)}

    def train_one(self, name: str, **params: Any) -> SavedModel:
        model = get_trainer(name).train(self.train, self.features, self.target, self.key, seed=self.seed, **params)
        sides = [regression_metrics(model.transform(model.gathered(d), "_p"), self.target, "_p", side) for side, d in (("train", self.train), ("test", self.test))]
        on_train = on_test = sides[0].crossJoin(sides[1]).first().asDict()  # one row each, one job for both
        self.models[name] = model
        self.results[name] = {
            "train_rmse": on_train["train_rmse"],
            "test_rmse": on_test["test_rmse"],
            "test_mae": on_test["test_mae"],
            "test_r2": on_test["test_r2"],
            "hyperparams": model.hyperparams,
        }
        return model

    def optimize_one(self, name: str, **options: Any) -> dict[str, Any]:
        found = search(get_trainer(name), self.train, self.features, self.target, self.key, seed=self.seed, **options)
        self.searches[name] = found
        return found.best_params

    def train_all(
        self,
        names: Sequence[str] | None = None,
        *,
        optimize: bool = False,
        feature_subset: Sequence[str] | None = None,
        hyperparams: Mapping[str, Mapping[str, Any]] | None = None,
        search_options: Mapping[str, Mapping[str, Any]] | None = None,
    ) -> "TrainingRun":
        """Train every model with defaults, given settings, or settings found by search."""
        self.train, self.test = spread([self.train, self.test], self.key)
        for d in (self.train, self.test):
            d.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name in names or list(TRAINERS):
                extra = {"feature_subset": list(feature_subset)} if name == "polynomial" and feature_subset else {}
                params = dict((hyperparams or {}).get(name, {}))
                if optimize:
                    params.update(self.optimize_one(name, **extra, **(search_options or {}).get(name, {})))
                self.train_one(name, **params, **extra)
        finally:
            for d in (self.train, self.test):
                d.unpersist()
        return self

    def results_frame(self) -> DataFrame:
        return writers.results_frame(self.spark, self.results)

    def best(self) -> tuple[str | None, dict[str, Any] | None]:
        """Highest test R2; the first trained wins ties, undefined values never win."""
        best_name, best_r2 = None, float("-inf")
        for name, r in self.results.items():
            if r["test_r2"] is not None and r["test_r2"] > best_r2:
                best_name, best_r2 = name, r["test_r2"]
        return best_name, self.results.get(best_name)

    def predict(self, df: DataFrame, name: str | None = None, out: str = "prediction") -> DataFrame:
        name = name or self.best()[0]
        if name not in self.models:
            raise ValueError(f"model {name!r} has not been trained")
        return self.models[name].transform(df, out)

    def compare_importances(self, top_n: int = 10) -> DataFrame:
        return rs.compare_importances(self.spark, self.models, top_n)

    def save_model(self, name: str, folder: str, *, with_time: bool = False) -> str:
        stamp = f"_{dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S}" if with_time else ""
        path = f"{folder}/{name}{stamp}"
        self.models[name].save(self.spark, path)
        return path

    def save_all(self, folder: str, fitted: FittedPlan | None = None, *, with_time: bool = False) -> dict[str, str]:
        """Models, metric records, the fitted plan and the run record under one folder."""
        paths = {name: self.save_model(name, f"{folder}/models", with_time=with_time) for name in self.models}
        writers.write_results(self.spark, self.results, f"{folder}/results")
        if fitted is not None:
            fitted.save(self.spark, f"{folder}/features")
        writers.write_metadata(
            self.spark,
            f"{folder}/run",
            transformer_path=f"{folder}/features",
            target=self.target,
            n_features=len(self.features),
            results=self.results,
            model_paths=paths,
            best_model=self.best()[0],
        )
        return paths


def run_training(
    df: DataFrame,
    plan: FeaturePlan,
    *,
    names: Sequence[str] | None = None,
    test_size: float = 0.2,
    selection_threshold: float = SELECTION_THRESHOLD,
    hyperparams: Mapping[str, Mapping[str, Any]] | None = None,
    optimize: bool = False,
    search_options: Mapping[str, Mapping[str, Any]] | None = None,
    folder: str | None = None,
) -> tuple[TrainingRun, FittedPlan]:
    """From a raw table to ranked models; ``plan.key`` must identify rows."""
    if not plan.key:
        raise ValueError("a training run needs key columns: the split and row sampling hash them")
    # the key hash is stored beside the rows: every statistic of the fit reads one side of the split
    cleaned = prepare(df, plan.constraints, unify=plan.unify)
    hashed = KEY_HASH
    while hashed in {c.lower() for c in cleaned.columns}:
        hashed = "_" + hashed
    raw = stored(cleaned.withColumn(hashed, key_hash(plan.key, plan.seed)))
    train, test = train_test_split(raw, list(plan.key), test_size=test_size, seed=plan.seed, hashed=hashed)
    fitted, train_ready = plan.fit_transform(train)
    test_ready = fitted.transform(test)
    # selection and training read what was written, not the steps that led there
    if folder:
        written = df.sparkSession.read.parquet(writers.write_processed(train_ready, test_ready, f"{folder}/processed"))
        train_ready, test_ready = (
            written.where(F.col("split") == side).select(*[q_col(c) for c in ready.columns])
            for side, ready in (("train", train_ready), ("test", test_ready))
        )
    else:
        train_ready, test_ready = stored(train_ready), stored(test_ready)
    chosen = select_features(
        train_ready.drop(*plan.key), plan.target, selection_threshold, method="spearman"
    )
    run = TrainingRun(train_ready, test_ready, fitted.features, plan.target, list(plan.key), plan.seed)
    run.train_all(names, optimize=optimize, feature_subset=chosen or None, hyperparams=hyperparams,
                  search_options=search_options)
    if folder:
        run.save_all(folder, fitted)
    return run, fitted
