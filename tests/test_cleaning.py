import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabforge import schema as sm
from tabforge.functions.text import unified
from tabforge.operators import clean, features as fe, split as sp
from tabforge.sources import readers, writers


def column(df, name, by="id"):
    return [r[name] for r in df.orderBy(by).collect()]


def test_roles(spark):
    df = spark.sql("SELECT 1 AS i, 1.5D AS d, 'a' AS s, true AS b, current_timestamp() AS t, date'2020-01-01' AS x")
    assert sm.column_roles(df) == sm.Roles(["i", "d"], ["s"], ["t", "x"], ["b"])
    with pytest.raises(ValueError, match="flat"):
        sm.column_roles(spark.sql("SELECT array(1) AS a"))


def test_column_lists(trips):
    assert sm.existing_columns(trips, ["price", "nope", "km"], target="price") == ["km"]
    assert sm.existing_columns(trips, role="numeric", target="price") == ["id", "km", "people", "fare"]
    assert sm.usable_subset(["nope"], ["a", "b"]) == ["a", "b"]
    assert sm.usable_subset(["b", "nope"], ["a", "b"]) == ["b"]
    x, y = sm.features_and_target(trips, "price")
    assert "price" not in x.columns and y.columns == ["price"]
    assert sm.safe_name("a b.c!") == "a_b_c" and sm.safe_name("!!") == "column"
    assert sm.safe_columns(trips.select(F.col("km").alias("k m"))).columns == ["k_m"]


def test_align(trips):
    aligned = sm.align_columns(trips, ["price", "extra", "km"])
    assert aligned.columns == ["price", "extra", "km"] and column(aligned.withColumn("id", F.lit(1)), "extra")[0] == 0


def test_numeric_like(trips):
    assert sm.numeric_like(trips, ["km", "minutes", "part"]) == {"km": True, "minutes": False, "part": False}
    assert sm.numeric_like(trips.where("id in (1, 2, 7)"), ["minutes"]) == {"minutes": True}
    assert sm.numeric_like(trips.where("id = 4"), ["minutes"]) == {"minutes": False}


def test_binary_columns(spark):
    df = spark.createDataFrame([(0, 1.0, 2, None), (1, 0.0, 1, None)], "a int, b double, c int, d int")
    assert sm.binary_columns(df) == ["a", "b", "d"]


def test_unify_strips_all_white_space_and_keeps_missing_as_level(trips):
    assert column(clean.unify_text(trips), "part") == [
        "morning", "morning", "evening", "nan", "night", "night", "evening", "evening",
    ]
    assert column(clean.unify_text(trips, missing_as_level=False), "part")[3] is None
    ruled = clean.unify_text(trips, rules={"traffic": {"low": "quiet", "nan": "unknown"}})
    assert column(ruled, "traffic")[:5] == ["quiet", "high", "high", "medium", "unknown"]


def test_unicode_space(spark):
    df = spark.createDataFrame([("  A b \x1f",)], "s string")
    assert df.select(unified(F.col("s"))).first()[0] == "a b"


def test_clip_keeps_nulls(trips):
    got = clean.apply_constraints(trips, {"km": {"min": 0, "max": 140, "action": "clip"}})
    assert column(got, "km") == [10.0, 140.0, None, 0.0, 25.0, 25.0, 40.0, 0.0]


def test_range_drop_and_nulls(trips):
    rule = {"price": {"min": 0.0}}
    assert column(clean.apply_constraints(trips, rule), "id") == [1, 2, 3, 5, 7, 8]
    assert column(clean.apply_constraints(trips, rule, keep_nulls=True), "id") == [1, 2, 3, 5, 6, 7, 8]


def test_numeric_coercion_drops_unparseable_rows(trips):
    got = clean.apply_constraints(trips, {"minutes": {"dtype": "float"}, "absent": {"min": 1}, "km": "not a rule"})
    assert [(r["id"], r["minutes"]) for r in got.orderBy("id").collect()] == [
        (1, 12.5), (2, 30.0), (4, None), (6, 70.0), (7, 8.0),
    ]
    kept = clean.apply_constraints(trips, {"minutes": {"dtype": "float"}}, drop_unparsable=False)
    assert kept.count() == 8 and column(kept, "minutes")[2] is None


def test_mean_action_modes(trips):
    rule = {"fare": {"min": 0.0, "action": "mean"}}
    assert column(clean.apply_constraints(trips, rule), "fare")[4] == -2.0
    assert column(clean.apply_constraints(trips, rule, mean_action="null_out"), "fare")[4] is None
    with pytest.raises(ValueError):
        clean.apply_constraints(trips, rule, mean_action="other")


def test_filters_reach_the_scan(spark, tmp_path, trips):
    trips.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    got = clean.apply_constraints(stored, {"price": {"min": 0.0}}).select("km")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(price,0.0)" in plan and "ReadSchema: struct<km:double,price:double>" in plan


def test_validate_rows(trips):
    rules = {"traffic": {"options": ["Low", "Medium", "High"]}, "km": {"min": 1, "max": 100}, "minutes": {"min": 5}}
    got = clean.validate_rows(trips, rules)
    assert column(got, "traffic")[2] == "High"
    assert column(got, "violations")[:4] == [[], ["km"], ["km", "minutes"], ["km", "minutes"]]


def test_drop_duplicates_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "x int, y string")
    assert clean.drop_duplicates(df).count() == 2


def test_ratio(spark):
    df = spark.createDataFrame([(1, 10.0, 30.0), (2, 10.0, 0.0), (3, 10.0, None), (4, None, 5.0), (5, 500.0, 1.0)], "id int, d double, m double")
    got = fe.speed_feature(df, "d", "m")
    assert [(r["id"], r["Speed_kmh"]) for r in got.orderBy("id").collect()] == [(1, 20.0), (2, 0.0), (3, 0.0), (4, None)]
    assert fe.ratio_feature(df, "r", "absent", "m").columns == df.columns


def test_datetime_parts(spark):
    df = spark.createDataFrame([(1, "2024-01-01 13:05:00"), (2, "junk")], "id int, t string")
    got = fe.datetime_parts(df, "t", ("hour", "dayofweek", "quarter"), drop_original=True).orderBy("id").collect()
    assert tuple(got[0]) == (1, 13, 0, 1) and tuple(got[1]) == (2, None, None, None)


def test_interactions(spark):
    df = spark.createDataFrame([(6.0, 2.0)], "a double, b double")
    got = fe.interactions(df, [("a", "b"), ("a", "zzz")], ("multiply", "add", "subtract", "divide")).first().asDict()
    assert got == {"a": 6.0, "b": 2.0, "a_x_b": 12.0, "a_plus_b": 8.0, "a_minus_b": 4.0, "a_div_b": pytest.approx(6 / 2.000001)}


def test_map_levels(trips):
    got = fe.map_levels(trips, "traffic", {"Low": 1, "Medium": 2, "High": 3}, "level")
    assert column(got, "level") == [1, 3, None, 2, None, 1, 1, 1]


def test_split_is_exact_and_stable(spark):
    df = spark.range(951)
    train, test = sp.train_test_split(df, "id")
    assert (train.count(), test.count()) == (760, 191)
    again = sp.train_test_split(df.repartition(9), "id")[1]
    assert sorted(r[0] for r in test.collect()) == sorted(r[0] for r in again.collect())
    assert sp.with_split_tag(train, test).groupBy("split").count().count() == 2
    loose = sp.train_test_split(df, "id", exact=False)[1].count()
    assert 140 < loose < 250
    with pytest.raises(ValueError):
        sp.train_test_split(df, "id", test_size=1.5)


@pytest.mark.parametrize("rows,k", [(23, 5), (3, 5), (10, 1)])
def test_contiguous_folds(spark, rows, k):
    import numpy as np

    df = spark.range(rows).withColumn("g", F.col("id") % 2)
    want = {i: f for f, part in enumerate(np.array_split(np.arange(rows), k)) for i in part}
    assert {r["id"]: r["fold"] for r in sp.contiguous_folds(df, ["id"], k).collect()} == want
    ordered = sorted(range(rows), key=lambda i: (i % 2, i))
    got = {r["id"]: r["fold"] for r in sp.contiguous_folds(df, ["g", "id"], k).collect()}
    assert [got[i] for i in ordered] == [want[i] for i in range(rows)]


def test_prepare_data(spark):
    df = spark.range(100).selectExpr("id", "cast(id as double) AS x", "cast(id * 2 as double) AS y")
    train, test, names = sp.prepare_data(df, "y", "id", scale=True)
    assert names == ["x"] and train.count() == 80
    assert train.selectExpr("round(avg(x), 9)", "round(stddev_pop(x), 9)").first() == (0.0, 1.0)


# -- files --------------------------------------------------------------------------------


def test_csv_tokens_and_inference(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d,e\n1,2,x,True,1.5\n2,NA, y ,False,n/a\n3,4,null,True,oops\n")
    df, roles = readers.load(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "boolean", "string"]
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        (1, 2.0, "x", True, "1.5"), (2, None, " y ", False, None), (3, 4.0, None, True, "oops"),
    ]
    assert roles.numeric == ["a", "b"] and roles.boolean == ["d"]


def test_csv_numbers_need_no_tokens(spark, tmp_path):
    schema = spark.createDataFrame([], "n int, x double, k long, t string").schema
    cells = [*readers.NA_TOKENS, "1d", "1.F ", "1e3", "Infinity", " 7 ", "x", "d", "12"]
    (tmp_path / "t.csv").write_text("n,x,k,t\n" + "".join(f'{i},"{c}","{c}","{c}"\n' for i, c in enumerate(cells)))
    got = readers.read_table(spark, str(tmp_path / "t.csv"), schema=schema)
    rows = got.orderBy("n").collect()
    first = len(readers.NA_TOKENS)
    assert all(r["x"] is None and r["k"] is None and r["t"] is None for r in rows[:first])
    assert [r["x"] for r in rows[first:]] == [None, None, 1000.0, math.inf, 7.0, None, None, 12.0]
    assert [r["k"] for r in rows[first:]] == [None, None, None, None, 7, None, None, 12]
    # the tokens are looked up for the text column alone
    assert got._jdf.queryExecution().optimizedPlan().toString().count("#N/A N/A") == 1


def test_csv_options_pass_through(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;2\n")
    assert readers.read_table(spark, str(tmp_path / "t.csv"), sep=";").columns == ["a", "b"]


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"a": 1, "b": "x"}, {"a": null, "b": "y"}]')
    assert readers.read_table(spark, str(tmp_path / "t.json")).count() == 2
    df = spark.createDataFrame([(1, None), (2, "y")], "a long, b string")
    back = readers.read_table(spark, writers.write_table(df, str(tmp_path / "o.jsonl")))
    assert sorted(back.select("a", "b").collect()) == sorted(df.collect(), key=lambda r: r[0])


def test_errors_of_paths(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_table(spark, "/nowhere/t.csv")
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, "/nowhere/t.xlsx")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, y int")
    assert column(sm.nan_to_null(df), "x", "y") == [None, 2.0]


def test_processed_sink_is_partitioned(spark, tmp_path):
    df = spark.range(10)
    path = writers.write_processed(df.where("id < 8"), df.where("id >= 8"), str(tmp_path / "p"))
    assert spark.read.parquet(path).where("split = 'test'").count() == 2


def test_json_record(spark, tmp_path):
    record = {"a": [1, 2], "b": {"c": "ü"}}
    assert writers.read_json_record(spark, writers.write_json_record(spark, record, str(tmp_path / "r"))) == record


def test_checkpoint_dir_is_read_from_the_session(spark):
    from tabforge.session import checkpoint_dir

    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_json_array_documents(spark, tmp_path):
    """One array per file, whatever the batch size and the session's limit of records; an empty table gives no document."""
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('a,\"', id, '\\n]') END AS `odd name`").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.sql.files.maxRecordsPerFile")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
        spark.conf.set("spark.sql.files.maxRecordsPerFile", 50)
        path = writers.write_json_arrays(df, str(tmp_path / "arrays"), ["id"], 4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before[0])
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before[1])
    assert len(list((tmp_path / "arrays").glob("part-*"))) == 4
    assert sorted(map(tuple, readers.read_json(spark, path).select(*df.columns).collect())) == sorted(map(tuple, df.collect()), key=lambda r: r[0])
    none = writers.write_json_arrays(df.limit(0), str(tmp_path / "none"), ["id"], 4)
    assert readers.read_json(spark, none, df.schema).count() == 0
