"""Saved runs, scored files and streams, and column choices, each with the values that SQL gives."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..models.linear import fit_polynomial_ridge
from ..models.registry import TRAINERS, SavedModel, Trainer, register
from ..operators import encode as en, features as fe, impute as im, split as sp
from ..plans.fitted import FeaturePlan, FittedPlan
from ..plans.scoring import PREDICTED, score_file
from ..plans.training import TrainingRun
from ..schema import existing_columns, features_and_target, numeric_like, q_col, safe_columns, to_number
from ..session import checkpoint_dir
from ..sources import readers, writers
from ..streaming.scoring import read_stream, start_scoring
from .base import ORDERS_GAPS, query, rounded, source, table, union_all
from .checked import ALPHA
from .cleaning import RATIO_COLUMNS
from .modelling import ACTUAL, FEATURES, KEY

RIDGE = {"degree": 1, "alpha": float(ALPHA)}
METRICS = ("train_rmse", "test_rmse", "test_mae", "test_r2")
# four rows of five train, as in `_sides`; one slope with the ridge's penalty
LINE = f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, {ACTUAL} AS y, l_orderkey % 5 <> 0 AS train FROM lineitem),
    f AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS b, avg(y) AS my, avg(x) AS mx FROM t WHERE train),
    p AS (SELECT t.*, my + b * (x - mx) AS p FROM t, f),
    m AS (SELECT sqrt(avg((y - p) ** 2) FILTER (train)) AS train_rmse, sqrt(avg((y - p) ** 2) FILTER (NOT train)) AS test_rmse,
    avg(abs(y - p)) FILTER (NOT train) AS test_mae, 1 - avg((y - p) ** 2) FILTER (NOT train) / var_pop(y) FILTER (NOT train) AS test_r2 FROM p)"""


def _sides(spark, folder, *columns) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, folder, "lineitem", (*KEY, *columns, f"{ACTUAL} AS revenue"))
    return lines.where("l_orderkey % 5 <> 0"), lines.where("l_orderkey % 5 = 0")


def _line_run(spark, folder) -> tuple[str, FittedPlan]:
    """A run of one ridge, with its plan, models and records on disk."""
    train, test = _sides(spark, folder, "l_quantity")
    fitted, ready = FeaturePlan("revenue", KEY, stages=()).fit_transform(train)
    run = TrainingRun(ready, fitted.transform(test), fitted.features, "revenue", KEY)
    run.train_all(["polynomial"], hyperparams={"polynomial": RIDGE})
    path = f"{checkpoint_dir(spark)}/line-run-{uuid.uuid4().hex}"
    run.save_all(path, fitted)
    return path, fitted


def _scores(scored: DataFrame) -> DataFrame:
    return rounded(scored.select("l_orderkey", "l_linenumber", F.col(PREDICTED).alias("prediction")), 6, "prediction")


SCORES = f"{LINE} SELECT l_orderkey, l_linenumber, round(p, 6) AS prediction FROM p"


@query("score_file_rows", SCORES)
def score_file_rows(spark, folder):
    """The CSV copy of the table, scored from a saved run and read back from the written result."""
    path, _ = _line_run(spark, folder)
    raw = table(spark, folder, "lineitem", (*KEY, "l_quantity"))
    given = writers.write_table(raw, f"{path}/input.csv")
    score_file(spark, given, path, schema=raw.schema, output_path=f"{path}/scored.parquet")
    return _scores(readers.read_table(spark, f"{path}/scored.parquet"))


@query("stream_scoring_rows", SCORES)
def stream_scoring_rows(spark, folder):
    """The same scores by a stream over the table's files, with the plan and model of the run's record."""
    path, _ = _line_run(spark, folder)
    record = writers.read_json_record(spark, f"{path}/run")
    model = SavedModel.load(spark, record["best_model_path"])
    schema = spark.read.parquet(f"{folder}/lineitem.parquet").schema
    stream = read_stream(spark, f"{folder}/lineitem*.parquet", schema).select(*KEY, "l_quantity")
    fitted = FittedPlan.load(spark, record["transformer"]["path"])
    start_scoring(stream, fitted, model, f"{path}/stream", f"{path}/stream-state", available_now=True).awaitTermination()
    return _scores(spark.read.parquet(f"{path}/stream"))


@query(
    "run_record",
    f"{LINE} SELECT 'polynomial' AS best_model, 'revenue' AS target, 1::BIGINT AS n_features, '{float(ALPHA)}' AS alpha, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in METRICS) + " FROM m",
)
def run_record(spark, folder):
    """What the record of a saved run says of its best model."""
    path, _ = _line_run(spark, folder)
    record = writers.read_json_record(spark, f"{path}/run")
    best, about = record["best_model"], record["transformer"]
    told = record["models"][best]
    row = (best, about["target_column"], about["n_features"], told["hyperparams"]["alpha"], *[told["metrics"][m] for m in METRICS])
    schema = "best_model string, target string, n_features long, alpha string, " + ", ".join(f"{m} double" for m in METRICS)
    return rounded(spark.createDataFrame([row], schema), 6, *METRICS)


@query("registered_trainer", f"{LINE} SELECT 'one_slope' AS model, {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)} FROM m")
def registered_trainer(spark, folder):
    """A model kind that the caller adds takes part in a run by its name, on the features that it knows."""

    def fit(df, features, target, key, *, seed, **params):
        return fit_polynomial_ridge(df, features, target, **params)

    train, test = _sides(spark, folder, "l_quantity", "l_tax")
    register(Trainer("one_slope", fit, {**RIDGE, "feature_subset": ["absent", "l_quantity"]}, {}, has_importance=False))
    try:
        run = TrainingRun(train, test, ["l_quantity", "l_tax"], "revenue", KEY)
        run.train_one("one_slope")
    finally:
        del TRAINERS["one_slope"]
    return rounded(run.results_frame().drop("hyperparams"), 6, *METRICS)


@query("feature_subset_fallback", SCORES)
def feature_subset_fallback(spark, folder):
    """A subset without any known name stands for all features."""
    train, test = _sides(spark, folder, "l_quantity")
    run = TrainingRun(train, test, ["l_quantity"], "revenue", KEY)
    run.train_all(["polynomial"], feature_subset=["absent", "revenue"], hyperparams={"polynomial": RIDGE})
    return _scores(run.predict(train.unionByName(test), "polynomial", PREDICTED))


@query("data_info", f"""SELECT count(*) FILTER (l_orderkey % 5 <> 0) AS n_train, count(*) FILTER (l_orderkey % 5 = 0) AS n_test,
    {len(FEATURES)}::BIGINT AS n_features FROM lineitem""")
def data_info(spark, folder):
    info = TrainingRun(*_sides(spark, folder, *FEATURES), FEATURES, "revenue", KEY).data_info()
    return spark.createDataFrame([(info["n_train"], info["n_test"], info["n_features"])], "n_train long, n_test long, n_features long")


@query("prepare_data", """SELECT count(*) - ceil(0.2::DOUBLE * count(*))::BIGINT AS n_train, ceil(0.2::DOUBLE * count(*))::BIGINT AS n_test,
    count(*) AS n_keys, 0.0::DOUBLE AS mean, 1.0::DOUBLE AS deviation, round(sum(o_totalprice), 2) AS target FROM orders""")
def prepare_data(spark, folder):
    """Both sides of a standardised split: their sizes, and the training side's statistics."""
    orders = table(spark, folder, "orders", ("o_orderkey", "o_custkey", "o_totalprice"))
    train, test, _ = sp.prepare_data(orders, "o_totalprice", "o_orderkey", scale=True)
    tagged = sp.with_split_tag(train, test)
    on_train, feature = F.col("split") == "train", F.when(F.col("split") == "train", F.col("o_custkey"))
    return tagged.agg(
        F.count_if(on_train).alias("n_train"), F.count_if(~on_train).alias("n_test"), F.count_distinct("o_orderkey").alias("n_keys"),
        F.abs(F.round(F.avg(feature), 6)).alias("mean"), F.round(F.stddev_pop(feature), 6).alias("deviation"),
        F.round(F.sum("o_totalprice"), 2).alias("target"),
    )


# -- columns ----------------------------------------------------------------------------------


def _long(df: DataFrame, columns, value, name: str) -> DataFrame:
    """(column, name) with one aggregate per column."""
    wide = df.agg(*[value(q_col(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias(name)) for i, c in enumerate(columns)])))


@query("chosen_columns", union_all(
    f"SELECT '{request}' AS request, '{c}' AS \"column\", round(avg({c}), 4) AS mean FROM lineitem"
    for request, columns in (("named", ("l_tax", "l_discount")), ("role", ("l_orderkey", "l_linenumber", "l_partkey", *FEATURES[1:])))
    for c in columns
))
def chosen_columns(spark, folder):
    """Requested columns that exist, and all of a role; never the target."""
    lines = table(spark, folder, "lineitem", (*KEY, "l_returnflag", *FEATURES))
    named = existing_columns(lines, ["l_tax", "absent", "l_extendedprice", "l_discount"], target="l_extendedprice")
    role = existing_columns(lines, role="numeric", target="l_extendedprice")
    means = [_long(lines, c, lambda x: F.round(F.avg(x), 4), "mean").select(F.lit(r).alias("request"), "*") for r, c in (("named", named), ("role", role))]
    return means[0].unionByName(means[1])


@query("features_and_target", union_all(
    f"SELECT '{side}' AS side, '{c}' AS \"column\", count({c}) AS n FROM {source('orders', ORDERS_GAPS)}"
    for side, c in (("target", "o_totalprice"), *(("features", c) for c in ("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")))
))
def features_target_sides(spark, folder):
    sides = zip(("features", "target"), features_and_target(table(spark, folder, "orders", ORDERS_GAPS), "o_totalprice"))
    counts = [_long(df, df.columns, F.count, "n").select(F.lit(side).alias("side"), "*") for side, df in sides]
    return counts[0].unionByName(counts[1])


TEXTS = ("CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_totalprice AS STRING) END AS price", "CAST(o_orderkey AS STRING) AS order_number",
         "CASE WHEN o_orderkey % 100 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS mixed", "o_orderstatus", "CAST(NULL AS STRING) AS gone")


@query("numeric_like_text", union_all(
    f"""SELECT '{c}' AS "column", n > 0 AND n = parsed AS numeric_like, CASE WHEN n > 0 AND n = parsed THEN round(total, 2) END AS total
    FROM (SELECT count({c}) AS n, count(TRY_CAST({c} AS DOUBLE)) AS parsed, sum(TRY_CAST({c} AS DOUBLE)) AS total FROM {source('orders', TEXTS)})"""
    for c in ("price", "order_number", "mixed", "o_orderstatus", "gone")
))
def numeric_like_text(spark, folder):
    """Text columns that hold nothing but numbers, and their sums once they are read as numbers."""
    orders = table(spark, folder, "orders", TEXTS)
    like = numeric_like(orders, orders.columns)
    sums = _long(orders, orders.columns, lambda c: F.round(F.sum(to_number(c)), 2), "total")
    yes = F.col("column").isin([c for c in like if like[c]])
    return sums.select("column", yes.alias("numeric_like"), F.when(yes, F.col("total")).alias("total"))


@query("safe_onehot_names", """SELECT regexp_replace('p_brand_' || p_brand, '[^A-Za-z0-9_-]+', '_', 'g') AS "column", count(*) AS n FROM part
    WHERE p_brand > (SELECT min(p_brand) FROM part) GROUP BY p_brand""")
def safe_onehot_names(spark, folder):
    parts = table(spark, folder, "part", ("p_brand",))
    coded = safe_columns(en.apply_encoding(parts, en.fit_encoding(parts, {"p_brand": "onehot"})))
    return _long(coded, coded.columns, lambda c: F.sum(c).cast("long"), "n")


@query("skipped_column", """SELECT 'c_mktsegment_' || c_mktsegment AS "column", count(*) AS n FROM customer
    WHERE c_mktsegment > (SELECT min(c_mktsegment) FROM customer) GROUP BY c_mktsegment""")
def skipped_column(spark, folder):
    """A plan that skips errors goes on without the column that has too many levels."""
    customers = table(spark, folder, "customer", ("c_custkey", "c_name", "c_mktsegment", "c_acctbal"))
    plan = FeaturePlan("c_acctbal", ["c_custkey"], stages=("encode",), max_onehot=10, on_error="skip")
    fitted, ready = plan.fit_transform(customers)
    return _long(ready, fitted.features, lambda c: F.sum(c).cast("long"), "n")


FALLBACKS = source("orders", ORDERS_GAPS)


@query("impute_fallback", f"""SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM {FALLBACKS})), 4) AS o_totalprice,
    coalesce(o_orderpriority, (SELECT o_orderpriority FROM {FALLBACKS} WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
    ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority FROM {FALLBACKS}""")
def impute_fallback(spark, folder):
    """An unknown strategy, and a mean of text, become the median or the mode."""
    orders = table(spark, folder, "orders", ORDERS_GAPS)
    columns = ["o_totalprice", "o_orderpriority"]
    fitted = im.fit_imputation(orders, {"o_totalprice": "no such strategy", "o_orderpriority": "mean"}, columns=columns)
    return rounded(fitted.apply(orders).select("o_orderkey", *columns), 4, "o_totalprice")


@query("ratio_at_scoring", f"""SELECT l_orderkey, l_extendedprice, l_quantity,
    round(CASE WHEN l_quantity / 60.0::DOUBLE > 0 THEN l_extendedprice / (l_quantity / 60.0::DOUBLE) ELSE 0 END, 6) AS speed FROM {source('lineitem', RATIO_COLUMNS)}""")
def ratio_at_scoring(spark, folder):
    """The ratio as scoring has it: not rounded, and no row removed."""
    lines = table(spark, folder, "lineitem", RATIO_COLUMNS)
    return rounded(fe.ratio_feature(lines, "speed", "l_extendedprice", "l_quantity", unit=60.0), 6, "speed")


@query("csv_reader_options", f"SELECT o_orderkey, o_totalprice, o_orderpriority FROM {FALLBACKS}")
def csv_reader_options(spark, folder):
    """Options of the caller reach the reader: another separator, quote and comment sign."""
    orders = table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = f"{checkpoint_dir(spark)}/options-{uuid.uuid4().hex}.csv"
    orders.write.options(header=True, sep=";", quote="'", quoteAll=True).csv(path)
    return readers.load(spark, path, sep=";", quote="'", comment="#")[0].select(*orders.columns)
