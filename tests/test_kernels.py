"""The distributed kernels against pandas, with hot values and on their large-table paths."""

from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tabforge.functions import buckets as bk, fitting as ft, lookups, numeric as num, ordered as od, quantiles as qt
from tabforge.functions.hashing import key_hash

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows; a third hold one value, some are missing, signs and magnitudes vary."""
    rng = np.random.default_rng(1)
    n = 3000
    x = np.where(np.arange(n) % 3 == 0, 7.5, rng.lognormal(3, 2, n) * rng.choice([-1, 1], n))
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "g": np.where(np.arange(n) % 10 < 7, "big", "small"), "k": rng.integers(0, 40, n)})
    pdf.loc[pdf.id % 11 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).repartition(5)
    return df.cache(), pdf


@pytest.mark.parametrize("direct_rows", [10**9, 0])
def test_exact_quantiles(hot, direct_rows):
    df, pdf = hot
    got = qt.exact_quantiles(df, {"x": PROBS, "k": PROBS}, direct_rows=direct_rows)
    for c in got:
        assert np.allclose(got[c], pdf[c].quantile(PROBS), rtol=1e-12)


@pytest.mark.parametrize("direct_rows", [10**9, 0])
def test_quantiles_of_nothing(spark, direct_rows):
    df = spark.createDataFrame([(None,)], "x double")
    assert qt.exact_quantiles(df, {"x": [0.5]}, direct_rows=direct_rows) == {"x": [None]}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e300, 1e300, allow_nan=False), st.sampled_from([0.0, 1.0, 1e-300])), min_size=1, max_size=40))
def test_order_statistics_of_any_floats(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = qt.order_statistics(df, {"x": range(len(values))}, {"x": len(values)}, bins=4)["x"]
    assert [got[i] for i in range(len(values))] == sorted(values)


@pytest.mark.parametrize("direct_rows", [10**9, 0])
@pytest.mark.parametrize("groups", [["g"], []])
def test_grouped_quantiles(hot, direct_rows, groups):
    df, pdf = hot
    rows = qt.grouped_quantiles(df, groups, "x", [0.25, 0.5, 0.9], direct_rows=direct_rows, n_buckets=16).collect()
    for r in rows:
        part = pdf[pdf.g == r["g"]] if groups else pdf
        assert r["n"] == part.x.count()
        assert np.allclose(r["quantiles"], part.x.quantile([0.25, 0.5, 0.9]))
    assert len(rows) == (2 if groups else 1)


def test_hot_value_gets_its_own_bucket(hot):
    df, _ = hot
    edges = bk.cut_points(df, [F.col("x")], 16)[0]
    assert 7.5 in edges and bk.single_valued(edges) == [edges.index(7.5) + 1]


def test_running_sums(hot):
    df, pdf = hot
    counts = df.where("x is not null").groupBy("g", "x").agg(F.count("*").alias("n"))
    got = od.running_sums(counts, "x", ["n"], groups=["g"], n_buckets=8).toPandas().sort_values(["g", "x"])
    want = got.groupby("g").n.cumsum() - got.n
    assert (got.n_before == want).all()


def test_row_numbers_split_equal_leading_keys(hot):
    df, pdf = hot
    known = df.where("x is not null")
    cut = od.with_order_bucket(known, ["x", "id"], n_buckets=16)
    largest = cut.groupBy("_ob").count().agg(F.max("count")).first()[0]
    assert largest < 600  # a third of the rows share one x
    got = od.row_numbers(known, ["x", "id"], n_buckets=16).toPandas().sort_values(["x", "id"])
    assert (got.row_number.to_numpy() == np.arange(len(got))).all()


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_fill_along(hot, backward, groups):
    df, pdf = hot
    df = df.withColumn("v", F.when(F.col("id") % 4 == 1, F.col("id")))
    got = od.fill_along(df, ["v", "x"], ["k", "id"], groups=groups, backward=backward, n_buckets=8).toPandas()
    got = got.sort_values("id").reset_index(drop=True)
    want = pdf.assign(v=pdf.id.where(pdf.id % 4 == 1)).sort_values(["k", "id"])
    source = want.groupby("g")[["v", "x"]] if groups else want[["v", "x"]]
    want = (source.bfill() if backward else source.ffill()).sort_index()
    assert np.allclose(got[["v", "x"]], want[["v", "x"]], equal_nan=True)


def test_average_ranks_of_few_and_many_values(hot):
    df, pdf = hot
    got = od.average_ranks(df.select("id", "x", "k"), ["x", "k"]).toPandas().sort_values("id")
    assert np.allclose(got["_rank0"], pdf.x.rank(), equal_nan=True)
    assert np.allclose(got["_rank1"], pdf.k.rank())


def test_attach_keeps_every_row_of_hot_keys(hot):
    df, pdf = hot
    keyed = df.withColumn("key", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")))
    keyed = keyed.withColumn("key", F.when(F.col("id") % 50 != 1, F.col("key")))
    table = keyed.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("key <> '7'")
    table = table.withColumn("code", F.length("key"))
    got = lookups.attach(keyed, table, "key", rows=100_000, weight="n").toPandas()
    assert len(got) == len(pdf)
    want = got.key.map(lambda k: len(k) if k is not None and k != "7" else np.nan)
    assert np.allclose(got.code.astype(float), want.astype(float), equal_nan=True)


def test_modes_and_levels(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0), ("b", 1.0), ("a", 2.0), (None, None)], "s string, x double")
    assert ft.modes(df, ["s", "x"]) == {"s": "a", "x": 1.0}
    assert ft.sorted_levels(df, ["s"], 1) == ({}, ["s"])
    assert ft.sorted_levels(df, ["s"], 2) == ({"s": ["a", "b"]}, [])
    assert ft.modes(df.where("s is null"), ["s"]) == {"s": None}


def test_wide_columns_are_recognised_by_sketch(spark):
    assert ft.sorted_levels(spark.range(5000).selectExpr("cast(id as string) AS s"), ["s"], 100) == ({}, ["s"])


def test_sorted_codes(spark):
    df = spark.range(1000).selectExpr("concat('v', id % 250) AS s")
    codes = {r["value"]: r["code"] for r in ft.sorted_codes(df.repartition(7), "s").collect()}
    assert codes == {v: i for i, v in enumerate(sorted({f"v{i}" for i in range(250)}))}


def test_normal_quantile(spark):
    ps = [1e-300, 1e-12, 1e-4, 0.05, 0.3, 0.5, 0.9, 0.99999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for r in df.select("p", num.normal_quantile(F.col("p")).alias("z")).collect():
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-9)


def test_half_even_follows_scaled_doubles(spark):
    values = [0.125, 2.675, 1.005, -0.125, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["r"] for r in df.select(num.half_even(F.col("x"), 2).alias("r")).collect()]
    assert got == list(np.round(values, 2))


def test_key_hash_ignores_partitioning(spark):
    df = spark.range(100).withColumn("h", key_hash("id", 42))
    first = {r["id"]: r["h"] for r in df.collect()}
    assert first == {r["id"]: r["h"] for r in df.repartition(13).collect()}
    assert len(set(first.values())) == 100
