import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import encode as en, impute as im, isolation as iso, outliers as ou, scale as sc
from tabforge.plans.fitted import ONE_SHOT_STAGES, FeaturePlan, FittedPlan


def column(df, name, by="id"):
    return [r[name] for r in df.orderBy(by).collect()]


# -- imputation ---------------------------------------------------------------------------


def test_rules_and_fallbacks(trips):
    got = im.resolve_rules(trips, {"km": "mean", "part": "median", "fare": "whatever", "people": ("constant", None)})
    assert got["km"] == ("mean", None) and got["part"][0] == "mode" and got["fare"][0] == "median"
    assert got["people"] == ("constant", 0) and got["traffic"] == ("mode", None)


def test_fitted_values(trips):
    fitted = im.fit_imputation(trips, {"km": "mean", "part": ("constant", None), "minutes": ("constant", "?")})
    assert fitted.values["km"] == pytest.approx((10 + 200 - 3 + 25 + 25 + 40) / 7)
    assert fitted.values["fare"] == 5.0 and fitted.values["traffic"] == "Low"
    assert fitted.values["part"] == "Unknown" and fitted.values["minutes"] == "?"
    filled = fitted.apply(trips)
    assert filled.where(" or ".join(f"{c} is null" for c in trips.columns)).count() == 0
    assert filled.schema["id"].dataType.simpleString() == "double"  # the median rule decides, not the gaps


def test_columns_without_gaps_are_fitted_too(trips):
    fitted = im.fit_imputation(trips.where("km is not null"), columns=["km"])
    assert column(fitted.apply(trips), "km")[2] == fitted.values["km"]


def test_integer_column_takes_fractional_median(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, x int")
    assert column(im.fit_imputation(df, columns=["x"]).apply(df), "x") == [1.0, 2.0, 1.5]


def test_drop_is_sequential(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 1.0), (3, None, 100.0)], "id int, a double, b double")
    rules = {"a": "drop", "b": "mean"}
    assert im.fit_imputation(df, rules, columns=["a", "b"]).values["b"] == 1.0
    assert im.fit_imputation(df, rules, columns=["a", "b"], sequential=False).values["b"] == 50.5
    fitted = im.fit_imputation(df, rules, columns=["a", "b"])
    assert fitted.apply(df, training=True).count() == 2 and fitted.apply(df).count() == 3


def test_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, None)], "id int, x double, s string")
    fitted = im.fit_imputation(df, {"s": ("mode", "none")})
    assert fitted.values["x"] is None and fitted.values["s"] == "none"
    assert fitted.apply(df).first()["x"] is None


def test_ordered_fills_need_an_order(trips):
    with pytest.raises(ValueError, match="order_by"):
        im.fit_imputation(trips, {"km": "ffill"}, columns=["km"])
    fitted = im.fit_imputation(trips, {"km": "ffill", "price": "bfill"}, columns=["km", "price"], order_by=["id"])
    got = fitted.apply(trips)
    assert column(got, "km")[2] == 200.0 and column(got, "price")[5] == 60.0


def test_handle_missing(trips):
    assert im.handle_missing(trips, "drop").count() == 3
    assert column(im.handle_missing(trips, fill_value=-9), "km")[2] == -9.0


# -- outliers -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def spiky(spark):
    return spark.range(200).select("id", F.when(F.col("id") < 195, F.col("id") % 10).otherwise(F.col("id") * 10).cast("double").alias("x"),
                                   F.when(F.col("id") % 50 == 0, None).otherwise(F.lit(1.0)).alias("flat"))


def test_iqr_and_zscore(spiky):
    pdf = spiky.toPandas()
    q1, q3 = pdf.x.quantile([0.25, 0.75])
    want = pdf[pdf.x.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
    assert ou.remove_outliers(spiky, {"x": "iqr"}).count() == len(want)
    z = (pdf.x - pdf.x.mean()).abs() / pdf.x.std(ddof=0)
    assert ou.remove_outliers(spiky, {"x": "zscore"}).count() == (z <= 3).sum()
    assert ou.remove_outliers(spiky, {"x": "zscore"}, threshold=0.1).count() == (z <= 0.1).sum()
    # no spread removes nothing, missing values stay, absent columns are skipped
    assert ou.remove_outliers(spiky, {"flat": "zscore", "absent": "iqr"}).count() == 200
    assert ou.remove_outliers(spiky, {"flat": "iqr"}).count() == 200
    with pytest.raises(ValueError):
        ou.remove_outliers(spiky, {"x": "other"})


def test_isolation_forest_finds_the_spikes(spiky):
    kept = ou.remove_outliers(spiky, {"x": "isolation_forest"}, key=["id"])
    assert kept.where("id >= 195").count() == 0 and kept.where("id < 195").count() > 150
    first = iso.fit_isolation(spiky, "x", key=["id"])
    again = iso.fit_isolation(spiky.repartition(7), "x", key=["id"])
    assert np.array_equal(first.breaks, again.breaks) and np.array_equal(first.score, again.score)
    with pytest.raises(ValueError, match="key"):
        iso.fit_isolation(spiky, "x")


def test_average_path():
    assert iso.average_path(1) == 0.0 and iso.average_path(2) == 1.0
    assert iso.average_path(256) == pytest.approx(10.2448, abs=1e-3)


# -- scaling ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "method,want",
    [
        ("standard", lambda x: (x - x.mean()) / x.std()),
        ("minmax", lambda x: (x - x.min()) / (x.max() - x.min())),
        ("robust", lambda x: (x - np.median(x)) / (np.quantile(x, 0.75) - np.quantile(x, 0.25))),
        ("maxabs", lambda x: x / np.abs(x).max()),
        ("normalize", np.sign),
    ],
)
def test_scalers(spark, method, want):
    x = np.array([-4.0, 1.0, 2.0, 8.0])
    df = spark.createDataFrame([(i, float(v), 3.0) for i, v in enumerate(x)], "id int, x double, same double")
    plan = sc.scale_plan(df, method, columns=["x", "same"])
    got = sc.apply_scaling(df, sc.fit_scaling(df, plan))
    assert np.allclose(column(got, "x"), want(x))
    assert column(got, "same")[0] == {"maxabs": 1.0, "normalize": 1.0}.get(method, 0.0)


def test_scale_plan(trips):
    df = trips.withColumn("flag", (F.col("km") > 20).cast("int"))
    plan = sc.scale_plan(df, "standard", exclude=["price", "id"], rules={"km": "robust"}, skip_binary=True)
    assert plan == {"km": "robust", "people": "standard", "fare": "standard"}
    with pytest.raises(ValueError):
        sc.scale_plan(df, "other")


def test_row_vectors(spark):
    df = spark.createDataFrame([(3.0, 4.0), (0.0, 0.0)], "a double, b double")
    assert sorted(tuple(r) for r in sc.normalize_rows(df, ["a", "b"]).collect()) == [(0.0, 0.0), (0.6, 0.8)]


# -- encoding -----------------------------------------------------------------------------


def test_codes_and_unseen_levels(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, s string")
    new = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None), (4, "c")], "id int, s string")
    label = en.apply_encoding(new, en.fit_encoding(train, {"s": "label"}))
    assert column(label, "s") == [0, -1, -1, 2]
    ordinal = en.apply_encoding(new, en.fit_encoding(train, {"s": "ordinal"}))
    assert column(ordinal, "s") == [0.0, -1.0, None, 2.0]
    onehot = en.apply_encoding(new, en.fit_encoding(train, {"s": "onehot"}))
    assert onehot.columns == ["id", "s_b", "s_c"]
    assert [tuple(r)[1:] for r in onehot.orderBy("id").collect()] == [(0, 0), (0, 0), (0, 0), (0, 1)]
    full = en.fit_encoding(train, {"s": "onehot"}, drop_first=False)[0]
    assert full.output_columns == ["s_a", "s_b", "s_c"]


def test_vocabulary_codes_equal_literal_codes(spark, monkeypatch):
    df = spark.range(600).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id % 40) END AS s")
    df = df.withColumn("s", F.when(F.col("id") % 17 != 0, F.col("s")))
    new = df.union(spark.createDataFrame([(1000, "unknown")], "id long, s string"))
    for method in ("label", "ordinal"):
        literal = column(en.apply_encoding(new, en.fit_encoding(df, {"s": method})), "s")
        monkeypatch.setattr(en, "LITERAL_LEVELS", 5)
        fitted = en.fit_encoding(df, {"s": method})
        assert fitted[0].vocabulary is not None
        assert column(en.apply_encoding(new, fitted), "s") == literal
        monkeypatch.undo()


def test_too_wide_for_onehot(spark):
    df = spark.range(3000).selectExpr("cast(id as string) AS s")
    with pytest.raises(ValueError, match="one-hot"):
        en.fit_encoding(df, {"s": "onehot"})
    with pytest.raises(ValueError, match="unknown encoding"):
        en.encode_plan(df, "other")


# -- plans --------------------------------------------------------------------------------

RULES = {
    "km": {"min": 0.0, "max": 140.0, "dtype": "float", "action": "clip"},
    "minutes": {"dtype": "float"},
    "price": {"min": 0.0, "dtype": "float", "action": "drop"},
}


def plan(**changes):
    return FeaturePlan(**{"target": "price", "key": ["id"], "constraints": RULES, **changes})


def test_fit_and_apply(trips):
    fitted, train = plan().fit_transform(trips)
    assert train.columns == fitted.columns and train.columns[0] == "id"
    # rows 3, 5 and 8 hold unparseable minutes; row 4 a negative and row 6 no price
    assert column(train, "id") == [1, 2, 7]
    assert "part_morning" in fitted.columns and "traffic_low" in fitted.columns
    assert column(train, "price") == [20.0, 35.0, 60.0]
    new = fitted.transform(trips.drop("price"))
    assert new.columns == [c for c in fitted.columns if c != "price"] and new.count() == 8
    assert new.where(" or ".join(f"`{c}` is null" for c in new.columns)).count() == 0
    assert set(fitted.features) == set(fitted.columns) - {"id", "price"}


def test_compat_mode_leaves_text_alone_when_scoring(trips):
    fitted = plan(reference_compat=True).fit(trips)
    capitals = fitted.transform(trips.where("id in (1, 2)").drop("price"))
    assert column(capitals, "part_morning") == [0, 0]
    assert column(plan().fit(trips).transform(trips.where("id in (1, 2)").drop("price")), "part_morning") == [1, 1]


def test_missing_and_extra_columns_are_aligned(trips):
    fitted = plan().fit(trips)
    got = fitted.transform(trips.drop("price", "fare").withColumn("extra", F.lit(1)))
    assert got.columns == [c for c in fitted.columns if c != "price"] and set(column(got, "fare")) == {0}


def test_every_stage_and_saved_state(spark, trips, tmp_path):
    rich = trips.withColumn("when", F.lit("2024-03-05 10:00:00"))
    p = plan(
        datetime_features=[{"column": "when", "parts": ["hour", "month"], "drop_original": True}],
        remove_outliers=True, outlier_method="zscore", numeric_missing="mean", encoding="ordinal",
        encoder_rules={"part": "onehot"}, scaling="robust", scaler_rules={"fare": "minmax"},
        interaction_pairs=[("km", "fare")], interaction_operations=["multiply", "add"], text_rules={"part": {"night": "late"}},
    )
    fitted, train = p.fit_transform(rich)
    assert {"when_hour", "km_x_fare", "km_plus_fare"} <= set(train.columns)
    path = str(tmp_path / "plan")
    fitted.save(spark, path)
    again = FittedPlan.load(spark, path)
    new = rich.drop("price")
    assert sorted(map(str, again.transform(new).collect())) == sorted(map(str, fitted.transform(new).collect()))


def test_vocabulary_is_saved(spark, trips, tmp_path, monkeypatch):
    monkeypatch.setattr(en, "LITERAL_LEVELS", 1)
    fitted = plan(encoding="label").fit(trips)
    fitted.save(spark, str(tmp_path / "p"))
    again = FittedPlan.load(spark, str(tmp_path / "p"))
    assert sorted(map(str, again.transform(trips).collect())) == sorted(map(str, fitted.transform(trips).collect()))


def test_one_shot_order(trips):
    ready = plan(stages=ONE_SHOT_STAGES, ratio={"out": "speed", "numerator": "km", "denominator": "people", "unit": 60.0})
    fitted, train = ready.fit_transform(trips)
    assert "speed" in train.columns and [s.kind for s in fitted.steps][:2] == ["constraints", "impute"]


def test_guards(trips):
    with pytest.raises(ValueError, match="not been fitted"):
        FittedPlan([], [], "price").transform(trips)
    with pytest.raises(ValueError, match="target"):
        plan(target="absent").fit(trips)
    with pytest.raises(ValueError, match="stages"):
        plan(stages=["nope"]).fit(trips)


def test_failing_columns_can_be_skipped(trips):
    wide = trips.withColumn("part", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="one-hot"):
        plan(max_onehot=2).fit(wide)
    fitted = plan(on_error="skip", max_onehot=2).fit(wide)
    assert "part" not in fitted.columns and "traffic_low" in fitted.columns and not any(c.startswith("part_") for c in fitted.columns)


def test_scoring_plan_is_narrow(trips):
    fitted = plan().fit(trips)
    new = fitted.transform(trips.drop("price"))
    text = new._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
