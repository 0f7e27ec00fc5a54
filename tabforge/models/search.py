"""Cross-validated random search: independent Spark jobs, a few at a time."""

from __future__ import annotations

import json
import logging
import math
import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.split import contiguous_folds, hash_folds
from ..schema import q_col
from .linear import TooWide
from .registry import Param, Trainer

log = logging.getLogger(__name__)

TRIAL_SCHEMA = "trial int, params map<string,string>, fold int, mse double"


def draw(space: Mapping[str, Param], rng: random.Random) -> dict[str, Any]:
    """One point of the search space."""
    point = {}
    for name, p in space.items():
        if p.integer:
            point[name] = rng.randint(int(p.low), int(p.high))
        elif p.log:
            point[name] = math.exp(rng.uniform(math.log(p.low), math.log(p.high)))
        else:
            point[name] = rng.uniform(p.low, p.high)
    return point


def with_folds(df: DataFrame, key: Sequence[str], k: int, *, order_by: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Contiguous folds of an ordered table, or key-hashed folds, which need no pass at all."""
    return contiguous_folds(df, order_by, k) if order_by else hash_folds(df, key, k, seed=seed)


def fold_error(
    trainer: Trainer, folded: DataFrame, fold: int, features: Sequence[str], target: str, key: Sequence[str],
    params: Mapping[str, Any], seed: int,
) -> float:
    """Mean squared error on one fold of a model trained on the others."""
    model = trainer.train(folded.where(F.col("fold") != fold).drop("fold"), features, target, key, seed=seed, **params)
    scored = model.transform(folded.where(F.col("fold") == fold), "_p")
    error = q_col(target) - F.col("_p")
    return scored.agg(F.avg(error * error)).first()[0]


def cross_validate(
    trainer: Trainer, df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], *,
    k: int = 5, order_by: Sequence[str] = (), seed: int = 42, parallel: int = 2, **params: Any,
) -> float:
    """Square root of the mean fold error (not the mean of the roots)."""
    folded = with_folds(df, key, k, order_by=order_by, seed=seed).persist()
    try:
        at_once = _errors_at_once(trainer, folded, k, features, target, [params])
        if at_once:
            errors = [e for e in at_once[0] if e is not None]
        else:
            with ThreadPoolExecutor(parallel) as pool:
                run = inheritable_thread_target(df.sparkSession)(
                    lambda fold: fold_error(trainer, folded, fold, features, target, key, params, seed)
                )
                errors = [e for e in pool.map(run, range(k)) if e is not None]
    finally:
        folded.unpersist()
    if len(errors) < k:
        raise ValueError(f"{k - len(errors)} of {k} folds have no rows")
    return math.sqrt(sum(errors) / len(errors))


def _errors_at_once(trainer: Trainer, folded: DataFrame, k: int, features: Sequence[str], target: str, points: Sequence[Mapping[str, Any]]):
    """Errors of all settings and folds where the trainer can tell them from sums; None: fit each."""
    if trainer.fold_errors is None:
        return None
    return trainer.fold_errors(folded, k, features, target, [{**trainer.defaults, **p} for p in points])


@dataclass
class SearchResult:
    best_params: dict[str, Any]
    best_value: float
    n_trials: int
    trials: DataFrame


def search(
    trainer: Trainer, df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], *,
    n_trials: int | None = None, timeout: float | None = None, k: int = 5, order_by: Sequence[str] = (),
    seed: int = 42, parallel: int = 2, space: Mapping[str, Param] | None = None, **fixed: Any,
) -> SearchResult:
    """Try random points within a trial and a time budget; at least one trial always runs.

    ``fixed`` settings (such as a feature subset) apply to every trial, so the search sees the
    same columns as the later training. A polynomial too wide to solve counts as an infeasible trial.
    Folds of a trial run side by side; where the trainer has ``fold_errors``, all trials and folds come from one pass.
    """
    spark: SparkSession = df.sparkSession
    rng = random.Random(seed)
    budget = trainer.trials if n_trials is None else n_trials
    if budget < 1:
        raise ValueError("a search needs at least one trial")
    deadline = time.monotonic() + (trainer.seconds if timeout is None else timeout)
    folded = with_folds(df, key, k, order_by=order_by, seed=seed).persist()
    rows, best, points = [], None, []
    try:
        drawn = [draw(space or trainer.space, rng) for _ in range(budget)]
        at_once = _errors_at_once(trainer, folded, k, features, target, [{**p, **fixed} for p in drawn])
        with ThreadPoolExecutor(parallel) as pool:
            for trial in range(budget):
                if trial and at_once is None and time.monotonic() > deadline:
                    break
                point = drawn[trial]
                run = inheritable_thread_target(spark)(
                    lambda fold: fold_error(trainer, folded, fold, features, target, key, {**point, **fixed}, seed)
                )
                try:
                    errors = at_once[trial] if at_once is not None else list(pool.map(run, range(k)))
                except TooWide as problem:
                    log.warning("trial %s is not feasible: %s", trial, problem)
                    errors = [None] * k
                rows += [(trial, {n: json.dumps(v) for n, v in point.items()}, f, e) for f, e in enumerate(errors)]
                known = [e for e in errors if e is not None]
                value = math.sqrt(sum(known) / len(known)) if known else math.inf
                points.append(point)
                if best is None or value < best[0]:
                    best = (value, trial)
    finally:
        folded.unpersist()
    if best[0] == math.inf:
        raise TooWide("no trial of the search was feasible")
    return SearchResult(points[best[1]], best[0], len(points), spark.createDataFrame(rows, TRIAL_SCHEMA))


def best_trial(trials: DataFrame) -> DataFrame:
    """(trial, params, rmse) of the best trial out of a trials table; the earlier wins ties."""
    scored = trials.groupBy("trial").agg(F.first("params").alias("params"), F.sqrt(F.avg("mse")).alias("rmse"))
    return scored.orderBy("rmse", "trial").limit(1)
