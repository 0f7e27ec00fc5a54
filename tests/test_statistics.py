import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import correlation as co, distribution as di, evaluate as ev, profile as pr


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.integers(0, 12, n).astype(float), "b": rng.normal(size=n).round(2)})
    pdf["c"] = np.where(np.arange(n) % 3 == 0, 4.0, pdf.a * 2 + rng.normal(size=n))  # a third share one value
    pdf["k"] = 1.0
    pdf.loc[pdf.id % 7 == 0, "b"] = np.nan
    pdf.loc[pdf.id % 9 == 0, "c"] = np.nan
    df = spark.createDataFrame(pdf)
    df = df.select("id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("a", "b", "c", "k")])
    return df.repartition(4).cache(), pdf


def as_dict(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_snapshot_and_overview(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, 3.0, None)], "a int, b double, c string")
    assert pr.table_snapshot(df).first().asDict() == {
        "rows": 3, "columns": 3, "duplicates": 1, "total_missing": 3, "missing_pct": 33.33, "high_missing": 1,
    }
    got = pr.data_overview(df).first()
    assert (got["columns_with_missing"], got["total_missing"], got["duplicates"], got["numeric_columns"]) == (2, 3, 1, 2)
    assert as_dict(pr.dtype_counts(df), "dtype")["double"] == {"dtype": "double", "n_columns": 1, "n_values": 1, "n_missing": 2}
    assert pr.table_summary(df, ["x"])["total_missing"] == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, s string")
    assert pr.table_snapshot(df).first()["missing_pct"] == 0.0
    assert as_dict(pr.column_profile(df), "column")["a"]["missing_pct"] is None
    assert pr.numeric_summary(df).first()["mean"] is None
    assert di.histogram(df).count() == 0 and di.kde(df, "a").count() == 0
    assert ev.roc_auc(df.withColumn("l", F.lit(1)), "l", "a").first()["auc"] is None


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 5.0)], "a int, b double")
    got = as_dict(pr.column_profile(df), "column")
    assert got["b"] == {"column": "b", "dtype": "double", "missing": 2, "missing_pct": 66.67, "unique": 1, "constant": 1, "high_missing": 1}
    assert [r["column"] for r in pr.column_profile(df, top_n=1).collect()] == ["b"]
    assert [r["column"] for r in pr.missing_table(df).collect()] == ["b"]


def test_numeric_summary_matches_pandas(numbers):
    df, pdf = numbers
    got = as_dict(pr.numeric_summary(df, ["a", "b", "c", "k"]), "column")
    for c in ("a", "b", "c", "k"):
        s = pdf[c]
        want = [s.mean(), s.std(), s.min(), s.median(), s.max(), s.skew()]
        assert np.allclose([got[c][m] for m in ("mean", "std", "min", "median", "max", "skewness")], want)
    described = as_dict(pr.describe_numeric(df, ["b"]), "column")["b"]
    want = pdf.b.describe()
    assert np.allclose([described[m] for m in ("count", "mean", "std", "min", "q1", "median", "q3", "max")], want)


def test_skewness_needs_three_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    assert pr.numeric_summary(df).first()["skewness"] is None


def test_value_counts(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,), (None,), ("z",)], "s string")
    rows = [(r["value"], r["n"], r["rank"]) for r in pr.value_counts(df, top_n=2).orderBy("rank").collect()]
    assert rows == [("x", 2, 1), (None, 2, 2)]
    assert [r["value"] for r in pr.value_counts(df, top_n=9, include_null=False).orderBy("rank").collect()] == ["x", "y", "z"]
    assert {r["value"] for r in pr.rare_categories(df, share=0.2).collect()} == {"y", "z"}
    assert pr.top_categories(df, max_levels=2).count() == 0


def test_overview_parts(trips):
    parts = pr.overview(trips, top_n=3)
    assert set(parts) == {
        "snapshot", "dtype_counts", "column_profile", "numeric_summary", "value_counts", "rare_categories", "top_correlations",
    }
    assert all(p.count() for name, p in parts.items() if name != "rare_categories")
    assert parts["rare_categories"].count() == 0  # one of eight rows is not rare


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlations_match_pandas(numbers, method):
    df, pdf = numbers
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("a", "k")]
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in co.correlations(df, pairs, method).collect()}
    if method == "kendall":
        want = {p: brute_tau_b(pdf[list(p)].dropna()) for p in pairs}
    else:
        ranked = pdf if method == "pearson" else None
        want = {}
        for p in pairs:
            both = pdf[list(p)].dropna()
            want[p] = (both if ranked is not None else both.rank()).corr().iloc[0, 1]
    assert got[("a", "k")] is None
    for p in pairs[:3]:
        assert got[p] == pytest.approx(want[p], abs=1e-10)


def brute_tau_b(pdf):
    x, y = (pdf.iloc[:, i].to_numpy() for i in (0, 1))
    dx, dy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    ups = np.triu_indices(len(x), 1)
    dx, dy = dx[ups], dy[ups]
    scale = np.sqrt((dx != 0).sum() * (dy != 0).sum())
    return (dx * dy).sum() / scale if scale else None


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_kendall_over_buckets(spark, rows_per_bucket):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.integers(0, 300, 700), "y": rng.integers(0, 50, 700)})
    pdf.loc[::3, "x"] = 17
    got = co.kendall(spark.createDataFrame(pdf), "x", "y", rows_per_bucket=rows_per_bucket).first()["corr"]
    assert got == pytest.approx(brute_tau_b(pdf), abs=1e-12)


def test_many_pairs_in_one_pass(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(90, 18)) + 1e4, columns=[f"c{i}" for i in range(18)])
    pdf.iloc[::5, 3] = np.nan
    pdf["c4"] = 0.1
    df = spark.createDataFrame(pdf)
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns]).repartition(3)
    got = co.matrix(df).collect()
    assert len(got) == 153
    want = pdf.corr()
    for r in got:
        if "c4" in (r["column_a"], r["column_b"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want.loc[r["column_a"], r["column_b"]])


def test_feature_selection(numbers):
    df, _ = numbers
    assert co.select_features(df, "c", 0.3) == ["a"]
    assert co.select_features(df.withColumn("s", F.lit("x")), "s") == []
    with pytest.raises(ValueError):
        co.matrix(df, ["a"])
    assert co.top_pairs(df, ["a", "c", "k"], top_n=5).count() == 1


def test_histogram_closes_last_bin_and_skips_nulls(numbers):
    df, pdf = numbers
    got = {(r["column"], r["bin"]): r["n"] for r in di.histogram(df, ["a", "c"], bins=10).collect()}
    for c in ("a", "c"):
        want, _ = np.histogram(pdf[c].dropna(), bins=10)
        assert [got.get((c, i), 0) for i in range(10)] == want.tolist()


def test_constant_histogram(numbers):
    df, pdf = numbers
    rows = di.histogram(df, ["k"], bins=10).collect()
    want, _ = np.histogram(pdf.k, bins=10)
    assert [(r["bin"], r["n"]) for r in rows] == [(int(np.argmax(want)), len(pdf))]


@pytest.mark.parametrize("column", ["a", "b"])
def test_kde(numbers, column):
    df, pdf = numbers
    x = pdf[column].dropna().to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    for r in di.kde(df, column, points=60).collect():
        assert r["density"] == pytest.approx(np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi)))


def test_box_statistics(numbers):
    df, pdf = numbers
    got = as_dict(di.box_stats(df, ["c"]), "column")["c"]
    q1, q3 = pdf.c.quantile([0.25, 0.75])
    out = ((pdf.c < q1 - 1.5 * (q3 - q1)) | (pdf.c > q3 + 1.5 * (q3 - q1))).sum()
    assert (got["q1"], got["q3"], got["n_outliers"]) == (pytest.approx(q1), pytest.approx(q3), out)


def test_line_and_relationships(numbers, trips):
    df, pdf = numbers
    both = pdf[["a", "c"]].dropna()
    slope, intercept = np.polyfit(both.a, both.c, 1)
    got = di.fit_line(df, "a", "c").first()
    assert (got["slope"], got["intercept"], got["n"]) == (pytest.approx(slope), pytest.approx(intercept), len(both))
    assert di.fit_line(df, "k", "c").first()["slope"] is None
    assert "median" in di.relationship_with_target(trips, "traffic", "price").columns
    assert "median" in di.relationship_with_target(trips, "price", "traffic").columns
    assert "share" in di.relationship_with_target(trips, "traffic", "part").columns


def test_crosstab(trips):
    wide = di.crosstab_wide(trips.where("part is not null"), "traffic", "part")
    for r in wide.collect():
        assert sum(r[c] for c in wide.columns if c != "traffic") == pytest.approx(1.0)


def test_missing_patterns(trips):
    got = {r["missing_columns"]: r["n"] for r in di.missing_patterns(trips).collect()}
    assert got == {"": 3, "fare": 1, "km": 1, "part,people,minutes": 1, "traffic": 1, "price": 1}


def test_joint_and_hexbin(numbers):
    df, pdf = numbers
    both = pdf[["a", "c"]].dropna()
    want, _, _ = np.histogram2d(both.a, both.c, bins=6)
    got = {(r["bin_x"], r["bin_y"]): r["n"] for r in di.joint_bins(df, "a", "c", 6).collect()}
    assert all(got.get((i, j), 0) == want[i, j] for i in range(6) for j in range(6))
    hexes = di.hexbin(df, "a", "c", 8).collect()
    assert sum(r["n"] for r in hexes) == len(both) and len(hexes) > 5


def test_qq_counts_every_row(numbers):
    df, pdf = numbers
    points = di.qq_points(df, "c", ["id"]).orderBy("theoretical").collect()
    assert [r["value"] for r in points] == sorted(pdf.c.dropna())
    assert points[0]["theoretical"] == pytest.approx(-points[-1]["theoretical"])
    assert 0 < di.qq_fit(df, "b", ["id"]).first()["r2"] <= 1


def test_target_analysis(numbers):
    df, pdf = numbers
    marks, top = di.target_analysis(df, "c", top_n=2)
    assert marks.first()["median"] == pytest.approx(pdf.c.median())
    rows = top.collect()
    assert rows[0]["feature"] == "a" and rows[0]["corr"] > 0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (4.0, 4.0)], "y double, p double")
    got = ev.regression_metrics(df, "y", "p", "train").first()
    assert got["train_rmse"] == pytest.approx((0.5 / 3) ** 0.5) and got["train_mae"] == pytest.approx(1 / 3)
    assert got["train_r2"] == pytest.approx(1 - 0.5 / (14 / 3))
    flat = df.withColumn("y", F.lit(2.0))
    assert ev.regression_metrics(flat, "y", "p").first()["test_r2"] == 0.0
    assert ev.regression_metrics(flat.withColumn("p", F.lit(2.0)), "y", "p").first()["test_r2"] == 1.0


def test_errors_and_confusion(spark):
    df = spark.createDataFrame([(0.0, 2.0), (4.0, 3.0)], "y double, p double")
    assert sorted((r["abs_error"], r["pct_error"]) for r in ev.error_table(df, "y", "p").collect()) == [(1.0, 25.0), (2.0, 0.0)]
    labels = spark.createDataFrame([(0, 0), (0, 1), (2, 1)], "y int, p int")
    got = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(labels, "y", "p", dense_classes=3).collect()}
    assert len(got) == 9 and got[(0, 1)] == 1 and got[(1, 1)] == 0


def test_auc_with_ties(spark):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 9, 300)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    diff = s[y == 1][:, None] - s[y == 0]
    want = ((diff > 0) + 0.5 * (diff == 0)).mean()
    assert ev.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(want)
    curve = ev.roc_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert (curve[-1]["tpr"], curve[-1]["fpr"], len(curve)) == (1.0, 1.0, 9)
    assert ev.roc_auc(df.where("y = 1"), "y", "s").first()["auc"] is None
