"""Queries that train, rank, search and score."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..models import results as rs, search as se
from ..models.linear import fit_polynomial_ridge
from ..models.registry import get_trainer
from ..operators import evaluate as ev, split as sp
from ..plans.fitted import FeaturePlan
from ..plans.scoring import score_file
from ..plans.training import TrainingRun, run_training
from ..session import checkpoint_dir
from ..sources import writers
from ..streaming.scoring import read_stream, start_scoring
from .base import query, rounded, table, union_all

LINES = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS revenue",
)
KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
FEATURES = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]


def _lines(spark, folder):
    return table(spark, folder, "lineitem", LINES)


@query(
    "ridge_one_feature",
    """SELECT round(sxy / (sxx + 5000), 8) AS slope, round(my - mx * sxy / (sxx + 5000), 6) AS intercept FROM (SELECT
    regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, avg(x) AS mx, avg(y) AS my FROM (SELECT l_quantity AS x,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS y FROM lineitem))""",
)
def ridge_one_feature(spark, folder):
    fitted = fit_polynomial_ridge(_lines(spark, folder), ["l_quantity"], "revenue", degree=1, alpha=5000.0).stages[-1]
    row = [(float(fitted.coefficients[0]), float(fitted.intercept))]
    return rounded(rounded(spark.createDataFrame(row, "slope double, intercept double"), 8, "slope"), 6, "intercept")


@query("poly_ridge")
def poly_ridge(spark, folder):
    return _trained(spark, folder, "polynomial")


@query("random_forest")
def random_forest(spark, folder):
    return _trained(spark, folder, "random_forest")


@query("random_forest_ml")
def random_forest_ml(spark, folder):
    # Spark ML's forest has no min_samples_split: 4 is what min_samples_leaf 2 implies
    return _trained(spark, folder, "random_forest", backend="ml", min_samples_split=4)


@query("extra_trees")
def extra_trees(spark, folder):
    return _trained(spark, folder, "extra_trees")


@query("boosted_trees")
def boosted_trees(spark, folder):
    return _trained(spark, folder, "boosted_trees")


@query("boosted_early_stopping")
def boosted_early_stopping(spark, folder):
    return _trained(spark, folder, "boosted_trees", early_stopping_rounds=2)


def _run(spark, folder) -> TrainingRun:
    train, test = sp.train_test_split(_lines(spark, folder), KEY)
    return TrainingRun(train, test, FEATURES, "revenue", KEY)


def _trained(spark, folder, name, **params):
    run = _run(spark, folder)
    run.train_all([name], hyperparams={name: params})
    return run.results_frame().drop("hyperparams")


@query("train_and_rank")
def train_and_rank(spark, folder):
    return rs.comparison(_all_four(spark, folder).results_frame()).drop("hyperparams")


@query("feature_importance")
def feature_importance(spark, folder):
    run = _all_four(spark, folder)
    return rs.importance_table(spark, run.models["extra_trees"])


@query("importance_comparison")
def importance_comparison(spark, folder):
    return _all_four(spark, folder).compare_importances()


def _all_four(spark, folder):
    names = ["polynomial", "random_forest", "extra_trees", "boosted_trees"]
    return _run(spark, folder).train_all(names, feature_subset=["l_extendedprice", "l_discount"])


@query("search_ridge")
def search_ridge(spark, folder):
    train, _ = sp.train_test_split(_lines(spark, folder), KEY)
    found = se.search(get_trainer("polynomial"), train, FEATURES, "revenue", KEY)
    return se.best_trial(found.trials).select("trial", "rmse")


@query("cross_validation")
def cross_validation(spark, folder):
    value = se.cross_validate(get_trainer("polynomial"), _lines(spark, folder), FEATURES, "revenue", KEY, k=5)
    return spark.createDataFrame([(value,)], "rmse double")


# -- evaluation with predictors that SQL can state --------------------------------------

PREDICTORS = {
    "scaled_price": "l_extendedprice / 1000",
    "discounted": "l_extendedprice * (1 - l_discount) / 1000",
    "by_quantity": "l_quantity * 2",
}
ACTUAL = "l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000"


def _metric_sql(expression: str, prefix: str) -> str:
    error = f"({ACTUAL} - {expression})"
    return f"""round(sqrt(avg({error} * {error})), 4) AS {prefix}_rmse, round(avg(abs({error})), 4) AS {prefix}_mae,
    round(1 - avg({error} * {error}) / var_pop({ACTUAL}), 6) AS {prefix}_r2"""


@query("regression_metrics", f"SELECT {_metric_sql(PREDICTORS['discounted'], 'test')} FROM lineitem")
def regression_metrics(spark, folder):
    scored = table(spark, folder, "lineitem", (f"{ACTUAL} AS y", f"{PREDICTORS['discounted']} AS p"))
    return rounded(rounded(ev.regression_metrics(scored, "y", "p"), 4, "test_rmse", "test_mae"), 6, "test_r2")


def _results(spark, folder):
    lines = table(spark, folder, "lineitem")
    sides = []
    for name, expression in PREDICTORS.items():
        scored = lines.selectExpr("l_orderkey", f"{ACTUAL} AS y", f"{expression} AS p")
        for side, rows in (("train", "l_orderkey % 5 <> 0"), ("test", "l_orderkey % 5 = 0")):
            row = ev.regression_metrics(scored.where(rows), "y", "p", "m").select(F.lit(name).alias("model"), F.lit(side).alias("side"), "*")
            sides.append(row)
    found: dict = {name: {"hyperparams": {}} for name in PREDICTORS}
    for r in reduce(DataFrame.unionByName, sides).collect():  # six rows, one job
        found[r["model"]].update({f"{r['side']}_{m}": r[f"m_{m}"] for m in ("rmse", "mae", "r2")})
    return writers.results_frame(spark, found)


RESULTS = union_all(
    f"""SELECT '{name}' AS model, sqrt(avg(({ACTUAL} - {e}) ** 2) FILTER (l_orderkey % 5 <> 0)) AS train_rmse,
    sqrt(avg(({ACTUAL} - {e}) ** 2) FILTER (l_orderkey % 5 = 0)) AS test_rmse,
    avg(abs({ACTUAL} - {e})) FILTER (l_orderkey % 5 = 0) AS test_mae,
    1 - avg(({ACTUAL} - {e}) ** 2) FILTER (l_orderkey % 5 = 0) / var_pop({ACTUAL}) FILTER (l_orderkey % 5 = 0) AS test_r2 FROM lineitem"""
    for name, e in PREDICTORS.items()
)


@query(
    "model_comparison",
    f"""SELECT model, round(train_rmse, 4) AS train_rmse, round(test_rmse, 4) AS test_rmse, round(test_mae, 4) AS test_mae,
    round(test_r2, 6) AS test_r2, round(test_rmse - train_rmse, 4) AS gap, round(abs(test_rmse - train_rmse), 4) AS abs_gap
    FROM ({RESULTS})""",
)
def model_comparison(spark, folder):
    table_ = rs.comparison(_results(spark, folder)).drop("hyperparams")
    return rounded(rounded(table_, 4, "train_rmse", "test_rmse", "test_mae", "gap", "abs_gap"), 6, "test_r2")


@query("best_model", f"SELECT model, round(test_r2, 6) AS test_r2 FROM ({RESULTS}) ORDER BY test_r2 DESC LIMIT 1")
def best_model(spark, folder):
    return rounded(rs.best_model(_results(spark, folder)).select("model", "test_r2"), 6, "test_r2")


@query(
    "best_per_metric",
    f"SELECT max_by(model, test_r2) AS best_r2, min_by(model, test_rmse) AS best_rmse, min_by(model, test_mae) AS best_mae FROM ({RESULTS})",
)
def best_per_metric(spark, folder):
    return rs.best_per_metric(_results(spark, folder))


SCORED = ("o_orderkey", "CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_totalprice END AS y", "o_custkey * 250.0 AS p")
SCORED_SQL = ("o_orderkey", "CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_totalprice END AS y", "o_custkey * 250.0::DOUBLE AS p")


def _scored_orders(spark, folder):
    return table(spark, folder, "orders", SCORED).withColumn("p", F.col("p").cast("double"))


@query(
    "error_table",
    f"""SELECT o_orderkey, y, p, round(abs(y - p), 4) AS abs_error, CASE WHEN y <> 0 THEN round(abs(y - p) / y * 100, 4) ELSE 0 END AS pct_error
    FROM (SELECT {', '.join(SCORED_SQL)} FROM orders)""",
)
def error_table(spark, folder):
    return rounded(ev.error_table(_scored_orders(spark, folder), "y", "p"), 4, "abs_error", "pct_error")


@query("residuals", f"SELECT o_orderkey, y, p, round(y - p, 4) AS residual FROM (SELECT {', '.join(SCORED_SQL)} FROM orders)")
def residuals(spark, folder):
    return rounded(ev.residuals(_scored_orders(spark, folder), "y", "p"), 4, "residual")


@query(
    "combined_predictions",
    f"""SELECT model, actual, predicted, round(actual - predicted, 4) AS residual FROM (SELECT 'first' AS model, y AS actual, p AS predicted
    FROM (SELECT {', '.join(SCORED_SQL)} FROM orders) UNION ALL SELECT 'second', y, p / 2 FROM (SELECT {', '.join(SCORED_SQL)} FROM orders))""",
)
def combined_predictions(spark, folder):
    first = _scored_orders(spark, folder)
    stacked = ev.combined_predictions({"first": first, "second": first.withColumn("p", F.col("p") / 2)}, "y", "p")
    return rounded(stacked, 4, "residual")


@query(
    "score_summary",
    f"SELECT count(*) AS n, round(avg(p), 4) AS mean, min(p) AS min, max(p) AS max FROM (SELECT {', '.join(SCORED_SQL)} FROM orders)",
)
def score_summary(spark, folder):
    return rounded(ev.score_summary(_scored_orders(spark, folder), "p"), 4, "mean")


@query("first_predictions", f"SELECT o_orderkey, p FROM (SELECT {', '.join(SCORED_SQL)} FROM orders) ORDER BY o_orderkey LIMIT 10")
def first_predictions(spark, folder):
    return ev.first_rows(_scored_orders(spark, folder), ["o_orderkey", "absent", "p"], ["o_orderkey"])


# -- a whole run: train, persist, load, score ---------------------------------------------

RUN_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag",
               "l_extendedprice * (1 - l_discount) / 1000 AS revenue")
RUN_SETTINGS = {"polynomial": {"degree": 2}, "boosted_trees": {"n_estimators": 5, "learning_rate": 0.5, "max_depth": 3}}


def saved_run(spark, folder, names=("polynomial", "boosted_trees")):
    """(folder of the saved run, the run, the fitted plan)"""
    plan = FeaturePlan("revenue", KEY, constraints={"revenue": {"min": 0.0, "dtype": "float", "action": "drop"}})
    path = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    lines = table(spark, folder, "lineitem", RUN_COLUMNS)
    run, fitted = run_training(lines, plan, names=list(names), hyperparams=RUN_SETTINGS, folder=path)
    return path, run, fitted


@query("score_file", "SELECT count(*) AS n FROM lineitem")
def score_saved(spark, folder):
    """Train, save everything, then score the CSV copy of the table with the reloaded best model."""
    path, _, _ = saved_run(spark, folder)
    raw = table(spark, folder, "lineitem", RUN_COLUMNS).drop("revenue")
    given = writers.write_table(raw, f"{path}/input.csv")
    scored, _ = score_file(spark, given, path, schema=raw.schema, output_path=f"{path}/scored.parquet")
    return spark.read.parquet(f"{path}/scored.parquet").agg(F.count("Predicted_Price").alias("n"))


@query("stream_scoring", "SELECT count(*) AS n FROM lineitem")
def stream_scoring(spark, folder):
    path, run, fitted = saved_run(spark, folder, ("polynomial",))
    schema = spark.read.parquet(f"{folder}/lineitem.parquet").schema
    stream = read_stream(spark, f"{folder}/lineitem*.parquet", schema).selectExpr(*RUN_COLUMNS).drop("revenue")
    started = start_scoring(
        stream, fitted, run.models["polynomial"], f"{path}/stream", f"{path}/stream-state", available_now=True
    )
    started.awaitTermination()
    return spark.read.parquet(f"{path}/stream").agg(F.count("Predicted_Price").alias("n"))
