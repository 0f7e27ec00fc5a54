"""Behaviour beyond the sizes of the test tables: limits, ties, missing and overflowing values."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.functions import buckets as bk, fitting as ft, lookups, ordered as od, quantiles as qt
from tabforge.models import histograms as hg, search as se, trees
from tabforge.models.linear import TooWide, fit_polynomial_ridge, term_count
from tabforge.models.registry import get_trainer
from tabforge.operators import correlation as co, distribution as di, encode as en, evaluate as ev, impute, isolation, outliers, profile, scale, split as sp
from tabforge.plans.fitted import FeaturePlan, FittedPlan
from tabforge.session import scratch, stored


@pytest.fixture(scope="module")
def gaps(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=1000)
    x[::10] = np.nan
    pdf = pd.DataFrame({"id": np.arange(1000), "x": x, "g": np.where(np.arange(1000) % 2, "a", "b")})
    return spark.createDataFrame(pdf).repartition(3).cache(), pdf


@pytest.mark.parametrize("levels", [5, 101, 5000])
def test_label_codes_have_one_type(spark, levels):
    df = spark.range(levels).selectExpr(f"concat('v', lpad(id % {levels}, 5, '0')) AS c", "id")
    coded = en.apply_encoding(df, en.fit_encoding(df, {"c": "label"}))
    assert coded.schema["c"].dataType.simpleString() == "bigint"
    assert coded.where("c <> id").count() == 0


@pytest.mark.parametrize("direct_rows", [0, 10**9])
def test_nan_is_missing_in_every_fit(gaps, monkeypatch, direct_rows):
    df, pdf = gaps
    monkeypatch.setattr(qt, "DIRECT_ROWS", direct_rows)
    monkeypatch.setattr(qt.exact_quantiles, "__kwdefaults__", {**qt.exact_quantiles.__kwdefaults__, "direct_rows": direct_rows})
    monkeypatch.setattr(qt.grouped_quantiles, "__kwdefaults__", {**qt.grouped_quantiles.__kwdefaults__, "direct_rows": direct_rows})
    p = [0.25, 0.5, 0.75, 0.95]
    assert np.allclose(qt.exact_quantiles(df, {"x": p})["x"], pdf.x.quantile(p))
    assert profile.numeric_summary(df, ["x"]).first()["median"] == pytest.approx(pdf.x.median())
    assert impute.fit_imputation(df, columns=["x"]).values["x"] == pytest.approx(pdf.x.median())
    assert scale.fit_scaling(df, {"x": "robust"})[0].centre == pytest.approx(pdf.x.median())
    assert di.box_stats(df, ["x"]).first()["q3"] == pytest.approx(pdf.x.quantile(0.75))
    got = {r["g"]: r["quantiles"] for r in qt.grouped_quantiles(df, ["g"], "x", [0.5]).collect()}
    assert got["a"][0] == pytest.approx(pdf[pdf.g == "a"].x.median())
    assert outliers.remove_outliers(df, {"x": "iqr"}).count() > 900


def test_ranks_beyond_the_rows_are_an_error(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    with pytest.raises(ArithmeticError):
        qt.order_statistics(df, {"x": [5]}, {"x": 6})


def test_infinite_values_have_ranks(spark):
    values = [float("-inf"), -1.0, 0.0, 5.0, float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert list(qt.order_statistics(df, {"x": range(6)}, {"x": 6}, bins=4)["x"].values()) == values


def test_folds_with_missing_order_values(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS k", "id")
    got = {r["fold"]: r["count"] for r in sp.contiguous_folds(df, ["k"], 4).groupBy("fold").count().collect()}
    assert got == {0: 125, 1: 125, 2: 125, 3: 625}
    none = sp.contiguous_folds(df.selectExpr("CAST(NULL AS INT) AS k", "id"), ["k"], 4)
    assert none.select("fold").distinct().collect()[0]["fold"] == 3
    two = sp.contiguous_folds(df, ["k", "id"], 4).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in two) == [250] * 4


def test_text_order_columns(spark):
    names = [f"name {i:04d}" for i in range(500)] + ["é", "", "Zed", "name 0007"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "s string, i long").repartition(4)
    got = [r["s"] for r in od.row_numbers(df, ["s", "i"], n_buckets=8).orderBy("row_number").collect()]
    assert got == sorted(names, key=lambda n: n.encode())
    filled = od.fill_along(df.withColumn("v", F.when(F.col("i") % 3 == 0, F.col("s"))), ["v"], ["s", "i"], n_buckets=8)
    assert filled.where("v is null").count() <= 2
    folds = sp.contiguous_folds(df, ["s"], 3).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [168, 168, 168]


@pytest.mark.parametrize("text", ["concat('https://www.example.org/path/', lpad(id * 7919 % 20011, 6, '0'))", "'one text'", "if(id % 3 = 0, 'hot', concat('Customer#', id))"])
def test_texts_with_one_beginning_are_spread(spark, text):
    """By whole texts, and rows of one text by the next column."""
    df = spark.range(20_000).selectExpr(f"{text} AS s", "id").repartition(6)
    sizes = [r["count"] for r in od.with_order_bucket(df, ["s", "id"], n_buckets=10).groupBy("_ob").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 10
    got = [(r["s"], r["id"]) for r in od.row_numbers(df, ["s", "id"], n_buckets=10).orderBy("row_number").collect()]
    assert got == sorted(got) and len(set(got)) == 20_000


def test_missing_keys_come_last(spark):
    """In every order column, whether or not a bucket was cut again."""
    rows = [(a, b) for a in (1, 1, 1, 2, None) for b in (5, 3, None)]
    for kind in ("long", "string"):
        df = spark.createDataFrame([(i, a, None if b is None else b if kind == "long" else str(b)) for i, (a, b) in enumerate(rows)], f"i long, a long, b {kind}")
        got = [(r["a"], r["b"] and int(r["b"])) for r in od.row_numbers(df, ["a", "b", "i"], n_buckets=4).orderBy("row_number").collect()]
        assert got == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))
    known = spark.createDataFrame([(1, None, "x"), (2, 2.0, "x"), (None, 7.0, "x")], "k long, v double, g string")
    for backward, expected in ((True, [2.0, 2.0, 7.0]), (False, [None, 2.0, 7.0])):
        filled = od.fill_along(known, ["v"], ["k"], backward=backward, n_buckets=4)
        assert [r["v"] for r in filled.orderBy(F.col("k").asc_nulls_last()).collect()] == expected
    last = spark.createDataFrame([(1, None), (2, None), (None, 7.0)], "k long, v double")
    assert {r["v"] for r in od.fill_along(last, ["v"], ["k"], backward=True, n_buckets=4).collect()} == {7.0}


def test_missing_leading_keys_are_spread(spark):
    df = spark.range(4000).selectExpr("CASE WHEN id % 4 = 0 THEN id END AS k", "id")
    cut = od.with_order_bucket(df, ["k", "id"], n_buckets=16)
    assert cut.where("k is null").groupBy("_ob").count().agg(F.max("count")).first()[0] < 1000
    got = od.row_numbers(df, ["k", "id"], n_buckets=16).toPandas().sort_values("row_number")
    assert got.k[:1000].is_monotonic_increasing and got.k[1000:].isna().all() and got.id[1000:].is_monotonic_increasing


def test_buckets_follow_the_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5000")
        assert bk.default_buckets(spark.range(1)) == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_wide_onehot(spark):
    df = spark.range(3000).selectExpr("concat('v', lpad(id % 1500, 4, '0')) AS c", "id % 1500 AS code")
    with pytest.raises(ValueError, match="onehot_vector"):
        en.fit_encoding(df, {"c": "onehot"})
    with pytest.raises(ValueError, match="30"):
        en.fit_encoding(df, {"c": "onehot"}, max_onehot=30)
    coded = en.apply_encoding(df.unionByName(df.limit(1).selectExpr("'new' AS c", "-1L AS code")), en.fit_encoding(df, {"c": "onehot_vector"}, drop_first=False))
    at = coded.select("code", F.array_position(vector_to_array("c"), 1.0).alias("p"), F.size(vector_to_array("c")).alias("n"))
    assert at.where("p <> code + 1 or n <> 1500").count() == 0


def test_refused_columns_leave_the_features(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "concat('v', id) AS wide", "CAST(id % 3 AS STRING) AS narrow", "id * 1.0D AS y")
    fitted = FeaturePlan("y", ["id"], on_error="skip").fit(df)
    assert "wide" not in fitted.features and "wide" not in fitted.transform(df).columns
    fitted.save(spark, str(tmp_path / "plan"))
    assert FittedPlan.load(spark, str(tmp_path / "plan")).transform(df).columns == fitted.transform(df).columns


def test_an_expansion_wider_than_the_normal_equations(spark, monkeypatch):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=["a", "b", "c"])
    pdf["y"] = pdf.a * pdf.b + pdf.c
    df = spark.createDataFrame(pdf)
    direct = fit_polynomial_ridge(df, ["a", "b", "c"], "y", degree=2, alpha=1.0).stages[-1].coefficients.toArray()
    monkeypatch.setattr("tabforge.models.linear.NORMAL_TERMS", 5)
    iterated = fit_polynomial_ridge(df, ["a", "b", "c"], "y", degree=2, alpha=1.0).stages[-1].coefficients.toArray()
    assert np.allclose(direct, iterated, atol=1e-3)
    with pytest.raises(TooWide, match="terms"):
        fit_polynomial_ridge(df, ["a", "b", "c"], "y", degree=2, max_terms=8)
    assert term_count(17, 4) > 4096


def test_isolation_samples_come_from_all_rows(spark):
    df = spark.range(60_000).selectExpr("id", "CAST(id AS DOUBLE) AS x")
    fitted = isolation.fit_isolation(df, "x", key=["id"], trees=8)
    assert len(fitted.breaks) > 8 * 100  # trees do not share their samples
    again = isolation.fit_isolation(df.repartition(7), "x", key=["id"], trees=8)
    assert np.array_equal(fitted.breaks, again.breaks)


def test_integer_fills_are_the_true_value_and_one_type(spark):
    full, part = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for df in (full, part, spark.createDataFrame([(1,), (3,)], "a int")):
        fitted = impute.fit_imputation(df)
        assert fitted.values["a"] in (1.5, 2.0)
        assert fitted.apply(part).schema["a"].dataType.simpleString() == "double"
    assert impute.fit_imputation(full).apply(part).where("a = 1.5").count() == 1


def test_counts_beyond_64_bit_products(spark):
    big = 5_000_000_000
    steps = spark.createDataFrame([(0.9, big, 0), (0.1, 0, big)], "s double, pos long, neg long")
    area = steps.agg((F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("x")).first()["x"]
    assert area == float(big) ** 2
    joint = spark.createDataFrame([(1.0, 1.0, big), (2.0, 2.0, big)], "_x double, _y double, _n long").selectExpr("*", "CAST(_x AS LONG) - 1 AS _r", "0 AS _yb")
    size = {"n": 2 * big, "dx": 2}
    assert co._tau_b(joint, size, 1, joint).first()["corr"] == pytest.approx(1.0)


def test_a_value_that_holds_half_of_a_group(spark):
    df = spark.range(5000).selectExpr("id % 2 AS g", "CASE WHEN id % 4 < 2 THEN 7.0D ELSE CAST(id AS DOUBLE) END AS x")
    got = {r["g"]: r["quantiles"] for r in qt.grouped_quantiles(df, ["g"], "x", [0.1, 0.5], direct_rows=0, n_buckets=8).collect()}
    pdf = df.toPandas()
    for g, q in got.items():
        assert np.allclose(q, pdf[pdf.g == g].x.quantile([0.1, 0.5]))


def test_dense_confusion_is_bounded(spark):
    df = spark.range(100).selectExpr("id AS a", "id % 50 AS b")
    assert ev.confusion_matrix(df, "a", "b").count() == 100
    with pytest.raises(ValueError, match="classes"):
        ev.confusion_matrix(df, "a", "b", dense_classes=20)
    assert ev.confusion_matrix(df.where("id < 3"), "a", "b", dense_classes=20).count() == 9


def test_slices_of_open_nodes_grow_the_same_tree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": np.arange(600), "a": rng.normal(size=600), "b": rng.normal(size=600)})
    pdf["y"] = np.sin(3 * pdf.a) + pdf.b
    df = spark.createDataFrame(pdf)
    whole = trees.fit_forest(df, ["a", "b"], "y", ["id"], n_estimators=2, max_depth=4)
    monkeypatch.setattr(hg, "CELL_BYTES", 3 * 2 * 64 * 16)  # three nodes a pass
    parts = trees.fit_forest(df, ["a", "b"], "y", ["id"], n_estimators=2, max_depth=4)
    assert np.allclose(whole.nodes[["feature", "threshold", "value"]], parts.nodes[["feature", "threshold", "value"]])


def test_a_vocabulary_of_measured_size_moves_no_rows(spark):
    df = spark.range(20_000).selectExpr("concat('v', id % 5000) AS c", "id")
    fitted = en.fit_encoding(df, {"c": "label"})
    plan = en.apply_encoding(df, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    salted = lookups.attach(df, fitted[0].vocabulary.withColumnRenamed("value", "c"), "c", rows=20_000, weight="n", broadcast_bytes=0)
    assert salted.where("code is null").count() == 0 and salted.count() == 20_000


def test_profiles_with_exact_and_sketched_counts(gaps):
    df, pdf = gaps
    exact = {r["column"]: r["unique"] for r in profile.column_profile(df).collect()}
    near = {r["column"]: r["unique"] for r in profile.column_profile(df, exact=False).collect()}
    assert exact["id"] == 1000 and exact["g"] == near["g"] == 2 and abs(near["id"] - 1000) < 80


def test_search_and_folds_without_rows(spark):
    df = spark.createDataFrame([(i, float(i), float(2 * i)) for i in range(6)], "id long, x double, y double")
    with pytest.raises(ValueError, match="trial"):
        se.search(get_trainer("polynomial"), df, ["x"], "y", ["id"], n_trials=0)
    with pytest.raises(ValueError, match="folds"):
        se.cross_validate(get_trainer("polynomial"), df.limit(2), ["x"], "y", ["id"], k=5, degree=1)


def test_scratch_removes_what_it_stored(spark):
    with scratch(spark):
        kept = stored(spark.range(5))
        path = Path(kept.inputFiles()[0].removeprefix("file://")).parent
        assert kept.count() == 5 and path.exists()
    assert not path.exists()


def test_workers_of_a_foreign_folder_have_the_package(tmp_path):
    """Queries with Python workers, from another working directory and without PYTHONPATH."""
    root = Path(__file__).resolve().parent.parent
    code = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location('entry', r'{root}/__spark_entry__.py')
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')
    .config('spark.sql.shuffle.partitions', '4').config('spark.checkpoint.dir', r'{tmp_path}/shared').getOrCreate())
print('rows', entry.queries()['tree_stump'](spark, '/root/testdata/sf0.001').count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 50" in done.stdout, done.stderr[-2000:]
