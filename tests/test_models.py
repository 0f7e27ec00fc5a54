import dataclasses
import math
import pickle
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.models import histograms as hg, ml_forest, registry, results as rs, search as se, trees
from tabforge.models.linear import fit_polynomial_ridge, term_count
from tabforge.models.registry import TRAINERS, Param, SavedModel, Trainer, get_trainer, register
from tabforge.operators.split import train_test_split
from tabforge.plans.fitted import FeaturePlan
from tabforge.plans.scoring import score_file
from tabforge.plans.training import TrainingRun, run_training
from tabforge.session import checkpoint_dir
from tabforge.streaming.scoring import read_stream, start_scoring

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 1200
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 5, n).astype(float), "c": rng.uniform(size=n)})
    pdf["y"] = 3 * pdf.a + np.where(pdf.b > 2, 10, 0) + 0.1 * rng.normal(size=n)
    return spark.createDataFrame(pdf).repartition(3).cache(), pdf


def rmse(model, df):
    error = F.col("y") - F.col("prediction")
    return model.transform(df).agg(F.sqrt(F.avg(error * error))).first()[0]


@pytest.mark.parametrize("degree,alpha", [(1, 0.5), (3, 20.0)])
def test_ridge_has_the_closed_form(sample, degree, alpha):
    df, pdf = sample
    model = fit_polynomial_ridge(df, ["a", "c"], "y", degree=degree, alpha=alpha)
    powers = [(i, j) for i in range(degree + 1) for j in range(degree + 1 - i) if i + j]
    assert len(powers) == term_count(2, degree)
    t = np.column_stack([pdf.a**i * pdf.c**j for i, j in powers])
    centred, y = t - t.mean(0), pdf.y - pdf.y.mean()
    beta = np.linalg.solve(centred.T @ centred + alpha * np.eye(len(powers)), centred.T @ y)
    want = t @ beta + pdf.y.mean() - t.mean(0) @ beta
    got = model.transform(df).select("id", "prediction").toPandas().sort_values("id").prediction
    assert np.allclose(got, want, atol=1e-6)


def test_ridge_subset_and_width(sample):
    df, _ = sample
    assert fit_polynomial_ridge(df, X, "y", degree=2, feature_subset=["a", "zzz"]).stages[0].getInputCols() == ["a"]
    assert term_count(3, 3) == 19
    with pytest.raises(ValueError, match="terms"):
        fit_polynomial_ridge(df, [f"f{i}" for i in range(18)], "y", degree=5, max_terms=4096)


FOREST = {"n_estimators": 6, "max_depth": 4}


def test_one_tree_equals_brute_force(sample):
    """A single deep-enough tree on a step function finds the step and the two means."""
    df, pdf = sample
    stepped = df.withColumn("y", F.when(F.col("b") > 2, 10.0).otherwise(1.0))
    model = trees.fit_forest(stepped, X, "y", ["id"], n_estimators=1, max_depth=3)
    splits = model.nodes[model.nodes.left_child != model.nodes.node]
    assert len(splits) == 1 and splits.iloc[0].feature == 1 and splits.iloc[0].threshold == 2.5
    assert sorted(r[0] for r in model.transform(stepped).select(F.round("prediction", 9)).distinct().collect()) == [1.0, 10.0]


@pytest.mark.parametrize("options", [{"random_cuts": True}, {"bootstrap": True}])
def test_forests(sample, options):
    df, pdf = sample
    shallow = trees.fit_forest(df, X, "y", ["id"], **{**FOREST, "max_depth": 2}, **options)
    deep = trees.fit_forest(df, X, "y", ["id"], **FOREST, **options)
    assert rmse(deep, df) < rmse(shallow, df) < pdf.y.std()
    again = trees.fit_forest(df.repartition(7), X, "y", ["id"], **FOREST, **options)
    assert np.allclose(deep.nodes[["feature", "threshold", "left_child"]], again.nodes[["feature", "threshold", "left_child"]])
    other = trees.fit_forest(df, X, "y", ["id"], **FOREST, **options, seed=1)
    assert not deep.nodes.equals(other.nodes)
    assert sum(deep.importances().values()) == pytest.approx(1.0) and deep.importances()["c"] < 0.05
    low, high = deep.transform(df).agg(F.min("prediction"), F.max("prediction")).first()
    assert pdf.y.min() <= low and high <= pdf.y.max()


def test_sample_size_rules(sample):
    df, pdf = sample
    model = trees.fit_forest(df, X, "y", ["id"], n_estimators=2, max_depth=6, min_samples_split=300, min_samples_leaf=100)
    nodes = model.nodes
    leaves = nodes[nodes.left_child == nodes.node]
    assert (leaves.weight >= 100).all() and (nodes[nodes.left_child != nodes.node].weight >= 300).all()


def test_first_boosting_round_by_hand(sample):
    df, pdf = sample
    stepped = df.withColumn("y", F.when(F.col("b") > 2, 10.0).otherwise(1.0))
    y = np.where(pdf.b > 2, 10.0, 1.0)
    model = trees.fit_boosted(stepped, X, "y", ["id"], n_estimators=1, max_depth=1, learning_rate=0.3, reg_lambda=2.0, reg_alpha=5.0)
    got = sorted(r[0] for r in model.transform(stepped).select("prediction").distinct().collect())
    want = []
    for side in (1.0, 10.0):
        residual = (y[y == side] - y.mean()).sum()
        want.append(y.mean() + 0.3 * np.sign(residual) * (abs(residual) - 5.0) / ((y == side).sum() + 2.0))
    assert got == pytest.approx(want)


def test_boosting(sample, monkeypatch):
    df, pdf = sample
    settings = {"max_depth": 3, "learning_rate": 0.4, "subsample": 0.8, "colsample_bytree": 0.7, "min_child_weight": 5}
    monkeypatch.setattr(trees, "REFRESH", 3)
    model = trees.fit_boosted(df, X, "y", ["id"], n_estimators=7, **settings)
    monkeypatch.setattr(trees, "REFRESH", 100)
    same = trees.fit_boosted(df.repartition(5), X, "y", ["id"], n_estimators=7, **settings)
    assert np.allclose(model.nodes.value, same.nodes.value)
    assert rmse(model, df) < 0.5 * pdf.y.std()
    pruned = trees.fit_boosted(df, X, "y", ["id"], n_estimators=1, **settings, gamma=1e12)
    assert len(pruned.nodes) >= 1 and (pruned.nodes.left_child == pruned.nodes.node)[0]


def test_early_stopping(sample):
    df, _ = sample
    noise = df.withColumn("y", F.rand(3))
    model = trees.fit_boosted(noise, X, "y", ["id"], n_estimators=12, max_depth=4, learning_rate=1.0, early_stopping_rounds=2)
    assert model.settings["n_estimators"] < 12


@pytest.mark.parametrize("local_rows", [0, 150])
def test_trees_are_the_same_wherever_they_grow(sample, monkeypatch, local_rows):
    df, _ = sample
    fits = (
        lambda: trees.fit_forest(df, X, "y", ["id"], n_estimators=3, max_depth=5, random_cuts=True),
        lambda: trees.fit_forest(df, X, "y", ["id"], n_estimators=2, max_depth=5, bootstrap=True, min_samples_leaf=3, min_samples_split=8),
        lambda: trees.fit_boosted(df, X, "y", ["id"], n_estimators=3, max_depth=3, learning_rate=0.3, subsample=0.8, colsample_bytree=0.7, early_stopping_rounds=2),
    )
    want = [f().nodes.to_numpy(float) for f in fits]
    monkeypatch.setattr(hg, "LOCAL_ROWS", local_rows)
    for whole, f in zip(want, fits):
        assert np.allclose(whole, f().nodes.to_numpy(float))


def test_random_cut_by_hand():
    w, g = np.array([[0, 2, 0, 3, 1.0]]), np.array([[0, 4, 0, -3, -1.0]])
    grid = np.array([1.0, 2.0, 3.0, 4.0])
    rules = hg.GrowthRules(1, random_cuts=True)
    # values lie between the edges 1 and 5 (the last bin is as wide as its neighbour)
    for draw, cut, left in ((0.0, 1, 2.0), (0.2, 1, 2.0), (0.3, 2, 2.0), (0.6, 3, 5.0), (0.99, 3, 5.0)):
        gain, at, wl, *_ = hg.feature_splits(w, g, rules, grid, np.array([draw]))
        assert (at[0], wl[0]) == (cut, left) and gain[0] > 0


@pytest.mark.parametrize("degree, alpha", [(1, 0.5), (3, 20.0), (4, 1e-3)])
def test_ridge_errors_from_sums_equal_fitted_ones(sample, degree, alpha):
    df, _ = sample
    trainer = get_trainer("polynomial")
    slow = dataclasses.replace(trainer, fold_errors=None)
    shifted = df.withColumn("a", F.col("a") * 5 + 40)
    got, want = (se.cross_validate(t, shifted, ["a", "c"], "y", ["id"], k=2, degree=degree, alpha=alpha) for t in (trainer, slow))
    assert got == pytest.approx(want, rel=1e-5)
    found = se.search(trainer, df, X, "y", ["id"], n_trials=4, k=2, max_terms=20)
    assert {r["mse"] is None for r in found.trials.collect()} == {True, False}
    with pytest.raises(Exception, match="missing"):
        se.cross_validate(trainer, df.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), ["a"], "y", ["id"], k=2)


def test_prune_works_upwards():
    tree = hg.Tree()
    left, right = tree.split(0, 0, 3, 5.0, ((5, 1.0), (5, -1.0)))
    tree.split(left, 1, 2, 0.5, ((2, 1.0), (3, 0.0)))
    hg.prune(tree, 1.0)
    assert tree.is_leaf(left) and not tree.is_leaf(0)
    hg.prune(tree, 10.0)
    assert tree.is_leaf(0)


def test_poisson_weights_average_one():
    w = hg.row_weights(np.arange(200_000), 3, "bootstrap", 1.0)
    assert abs(w.mean() - 1) < 0.02 and abs((w == 0).mean() - math.exp(-1)) < 0.01
    assert abs(hg.row_weights(np.arange(100_000), 3, "subsample", 0.7).mean() - 0.7) < 0.01


def test_missing_feature_goes_right(spark):
    nodes = pd.DataFrame({"tree": [0] * 3, "node": [0, 1, 2], "feature": [0] * 3, "threshold": [1.0, 0, 0], "left_child": [1, 1, 2],
                          "value": [0.0, -1.0, 1.0], "gain": [1.0, 0, 0], "weight": [2.0, 1, 1]})
    model = trees.TreeEnsemble(["x"], nodes, 0.0, 1.0)
    df = spark.createDataFrame([(0, 1.0), (1, 1.5), (2, None)], "id int, x double")
    assert [r["prediction"] for r in model.transform(df).orderBy("id").collect()] == [-1.0, 1.0, 1.0]


# -- registry, search, ranking ------------------------------------------------------------


def test_registry():
    assert set(TRAINERS) >= {"polynomial", "random_forest", "extra_trees", "boosted_trees"}
    with pytest.raises(ValueError, match="unknown trainer"):
        get_trainer("nope")


def test_own_trainer(sample):
    class Mean:
        stages = [None]

        def __init__(self, value):
            self.value = value

        def transform(self, df):
            return df.withColumn("prediction", F.lit(self.value))

    def fit(df, features, target, key, *, seed, shift):
        return Mean(df.agg(F.avg(target)).first()[0] + shift)

    df, pdf = sample
    register(Trainer("mean", fit, {"shift": 0.0}, {"shift": Param(-1.0, 1.0)}, trials=3))
    try:
        run = TrainingRun(df, df, X, "y", ["id"]).train_all(["mean"])
        assert run.results["mean"]["test_r2"] == pytest.approx(0.0, abs=1e-9)
        assert run.models["mean"].importances() is None
        value = se.cross_validate(get_trainer("mean"), df, X, "y", ["id"], k=4, order_by=["id"])
        folds = np.array_split(pdf.y.to_numpy(), 4)
        errors = [((f - np.concatenate(folds[:i] + folds[i + 1 :]).mean()) ** 2).mean() for i, f in enumerate(folds)]
        assert value == pytest.approx(math.sqrt(np.mean(errors)))
        found = se.search(get_trainer("mean"), df, X, "y", ["id"], n_trials=3, k=2)
        assert found.n_trials == 3 and found.trials.count() == 6
        assert se.best_trial(found.trials).first()["rmse"] == pytest.approx(found.best_value)
        assert se.search(get_trainer("mean"), df, X, "y", ["id"], timeout=0.0, k=2).n_trials == 1
    finally:
        TRAINERS.pop("mean")


def test_infeasible_trials_are_recorded(sample, monkeypatch):
    from tabforge.models import linear

    df, _ = sample
    monkeypatch.setattr(linear, "MAX_TERMS", 9)  # three features: degree 2 and no more
    space = {"degree": Param(2, 3, integer=True)}
    found = se.search(get_trainer("polynomial"), df, X, "y", ["id"], n_trials=5, k=2, space=space, seed=4)
    assert found.best_params == {"degree": 2} and found.trials.where("mse is null").count() > 0
    with pytest.raises(ValueError, match="feasible"):
        se.search(get_trainer("polynomial"), df, X, "y", ["id"], n_trials=1, k=2, space={"degree": Param(4, 4, integer=True)})


def test_draw_stays_in_bounds():
    import random

    space = TRAINERS["boosted_trees"].space
    for seed in range(20):
        point = se.draw(space, random.Random(seed))
        assert all(space[n].low <= v <= space[n].high for n, v in point.items())
        assert isinstance(point["max_depth"], int)


def test_ranking(spark):
    rows = [("a", 1.0, 2.0, 1.0, 0.9), ("b", 1.0, 1.5, 3.0, 0.9), ("c", 1.0, 3.0, 2.0, None), ("d", 1.0, 9.0, 9.0, float("nan"))]
    table = spark.createDataFrame(rows, "model string, train_rmse double, test_rmse double, test_mae double, test_r2 double")
    assert rs.best_model(table).first()["model"] == "a"
    assert rs.comparison(table.where("model < 'd'")).first()["gap"] == 1.0
    best = rs.best_per_metric(table.where("model < 'd'")).first()
    assert (best["best_rmse"], best["best_mae"]) == ("b", "a")


def test_spark_forest_backend(sample):
    df, _ = sample
    trainer = get_trainer("random_forest")
    small = {"backend": "ml", "n_estimators": 3, "max_depth": 3, "min_samples_split": 4}
    model = trainer.train(df, X, "y", ["id"], **small)
    again = trainer.train(df.repartition(6), X, "y", ["id"], **small)
    assert model.importances() == again.importances()
    with pytest.raises(ValueError, match="min_samples_split"):
        trainer.train(df, X, "y", ["id"], backend="ml")


@pytest.mark.parametrize("rows_at_once", [64, 1 << 18])
def test_spark_forest_is_the_same_from_sums_by_vector(spark, monkeypatch, rows_at_once):
    # few different vectors, one of them frequent
    rows = [(i or None, float(i * i % 7 if i % 3 else 0), float(i * i % 11 if i % 3 else 0), float(i * i % 13) + math.sqrt(i % 17)) for i in range(1600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    trainer = get_trainer("random_forest")
    small = {"backend": "ml", "n_estimators": 7, "max_depth": 5, "min_samples_split": 4}
    want = trainer.train(df, ["a", "b"], "y", ["id"], **small)
    grown = []
    by_vector = registry.fit_by_vector
    monkeypatch.setattr(registry, "fit_by_vector", lambda *given: grown.append(by_vector(*given)) or grown[-1])
    monkeypatch.setattr(hg, "LOCAL_ROWS", 100)
    monkeypatch.setattr(ml_forest, "SUM_ROWS", rows_at_once)
    got = trainer.train(df, ["a", "b"], "y", ["id"], **small)
    assert len(grown) == 1 and got.model.stages[-1] is grown[0]

    def nodes(model):
        path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
        model.model.stages[-1].write().save(path)
        table = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select("*", "split.*").drop("split")
        return table.toPandas().sort_values(["treeID", "id"], ignore_index=True)

    a, b = nodes(want), nodes(got)
    for c in ("treeID", "id", "leftChild", "rightChild", "featureIndex", "rawCount"):
        assert a[c].tolist() == b[c].tolist(), c
    assert a["leftCategoriesOrThreshold"].map(list).tolist() == b["leftCategoriesOrThreshold"].map(list).tolist() and len(a) > 100
    for c in ("prediction", "impurity", "gain"):
        assert np.allclose(a[c], b[c], atol=1e-9), c
    assert got.model.stages[-1].explainParams() == want.model.stages[-1].explainParams()
    assert got.importances() == pytest.approx(want.importances())
    # as many vectors as rows: the rows themselves
    monkeypatch.setattr(hg, "LOCAL_VECTORS", 0)
    assert trainer.train(df, ["a", "b"], "y", ["id"], **small).importances() == want.importances() and grown[1] is None


def test_rows_are_gathered_for_spark_forests_only(sample):
    df, _ = sample
    forest = get_trainer("random_forest").train(df, X, "y", ["id"], backend="ml", n_estimators=2, max_depth=3, min_samples_split=4)
    laid = forest.gathered(df)
    task = F.spark_partition_id()
    assert {tuple(r) for r in laid.select(task, "*").collect()} == {tuple(r) for r in df.select(task, "*").collect()}  # in the same tasks
    share = forest.importances()
    first = min(X, key=lambda c: (share[c], c))
    for rows in laid.select(first).rdd.glom().collect():
        assert [r[first] for r in rows] == sorted(r[first] for r in rows) and len(rows) > 100
    cells = get_trainer("extra_trees").train(df, X, "y", ["id"], n_estimators=2, max_depth=3)
    ridge = get_trainer("polynomial").train(df, X, "y", ["id"], degree=1)
    assert cells.gathered(df) is df and ridge.gathered(df) is df


# -- a whole run --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def saved(spark, sample, tmp_path_factory):
    df, _ = sample
    folder = str(tmp_path_factory.mktemp("run"))
    raw = df.withColumn("kind", F.when(F.col("b") > 2, " Far").otherwise("near")).drop("b")
    plan = FeaturePlan("y", ["id"], constraints={"y": {"min": -100.0, "action": "drop"}, "c": {"min": 0.0, "max": 0.9, "action": "clip"}})
    settings = {"extra_trees": {"n_estimators": 4, "max_depth": 4}, "polynomial": {"degree": 2},
                "boosted_trees": {"n_estimators": 3, "max_depth": 2}, "random_forest": {"n_estimators": 2, "max_depth": 2}}
    run, fitted = run_training(raw, plan, hyperparams=settings, folder=folder)
    return folder, raw, run, fitted


def test_training_run(spark, saved):
    folder, raw, run, fitted = saved
    assert run.data_info() == {"n_train": 960, "n_test": 240, "n_features": 3}
    assert set(run.results) == set(TRAINERS) and run.best()[0] in run.results
    assert run.results["polynomial"]["hyperparams"]["feature_subset"] == ["a", "kind_near"]
    processed = spark.read.parquet(f"{folder}/processed")
    assert processed.where("split = 'test'").count() == 240
    assert spark.read.json(f"{folder}/results").count() == 4
    assert run.compare_importances().columns == ["feature", "boosted_trees", "extra_trees", "random_forest"]
    assert rs.importance_table(spark, run.models["polynomial"]) is None
    assert rs.importance_table(spark, run.models["extra_trees"], 2).count() == 2
    assert run.predict(run.test).columns[-1] == "prediction"
    with pytest.raises(ValueError, match="not been trained"):
        run.predict(run.test, "nope")
    with pytest.raises(ValueError, match="at least two"):
        rs.compare_importances(spark, {"extra_trees": run.models["extra_trees"]})


class SeenPlan(FeaturePlan):
    def fit_transform(self, train):
        self.seen = train
        return super().fit_transform(train)


def test_a_run_hashes_its_keys_once(spark):
    df = spark.range(200).selectExpr("id", "id % 7 AS a", "id % 5 + id % 7 AS y", "id % 3 AS _key_hash")
    plan = SeenPlan("y", ["id"])
    run, _ = run_training(df.union(df), plan, names=["polynomial"])  # copies go before the split
    assert "md5" not in plan.seen._jdf.queryExecution().toString()
    assert plan.seen.columns == df.columns and run.data_info() == {"n_train": 160, "n_test": 40, "n_features": 2}
    train, _ = train_test_split(df, "id")
    assert {tuple(r) for r in plan.seen.collect()} == {tuple(r) for r in train.collect()}


@pytest.mark.parametrize("name", ["polynomial", "extra_trees"])
def test_scoring_files(spark, saved, tmp_path, name):
    folder, raw, run, fitted = saved
    given = raw.drop("y").withColumn("note", F.lit("kept"))
    given.coalesce(1).write.option("header", True).csv(str(tmp_path / "in.csv"))
    scored, summary = score_file(spark, str(tmp_path / "in.csv"), folder, model_name=name, output_path=str(tmp_path / "out.parquet"))
    assert scored.columns == [*given.columns, "Predicted_Price"]
    back = spark.read.parquet(str(tmp_path / "out.parquet"))
    direct = run.models[name].transform(fitted.transform(raw.drop("y")), "p").select("id", "p")
    worst = back.join(direct, "id").agg(F.max(F.abs(F.col("p") - F.col("Predicted_Price"))), F.count("*")).first()
    assert worst[0] < 1e-9 and worst[1] == 1200 and summary.first()["n"] == 1200
    with pytest.raises(ValueError, match="not part of the run"):
        score_file(spark, str(tmp_path / "in.csv"), folder, model_name="nope")


def test_model_names_with_time(saved, tmp_path):
    _, _, run, _ = saved
    path = run.save_model("polynomial", str(tmp_path), with_time=True)
    assert "polynomial_2" in path and SavedModel.load(run.spark, path).features == run.features


def test_streams_are_scored_like_batches(spark, saved, tmp_path):
    folder, raw, run, fitted = saved
    source = str(tmp_path / "in")
    raw.drop("y").write.parquet(source)
    stream = read_stream(spark, source, raw.drop("y").schema)
    query = start_scoring(stream, fitted, run.models["extra_trees"], str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).agg(F.count("*"), F.round(F.sum("Predicted_Price"), 6)).first()
    batch = run.models["extra_trees"].transform(fitted.transform(raw.drop("y")), "p").agg(F.round(F.sum("p"), 6)).first()
    assert got[0] == 1200 and got[1] == pytest.approx(batch[0])


def test_ordered_fills_are_refused_on_streams(spark, sample, tmp_path):
    df, _ = sample
    plan = FeaturePlan("y", ["id"], missing_rules={"a": "ffill"}, order_by=["id"])
    fitted = plan.fit(df)
    df.drop("y").write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="stream"):
        fitted.transform(read_stream(spark, str(tmp_path / "in"), df.drop("y").schema))


def test_model_queries_run_at_the_default_settings(spark, monkeypatch):
    from tabforge.catalog import QUERIES

    seen, folds = [], []

    class Trained(Exception):
        pass

    def train_one(self, name, feature_subset=None, **params):
        seen.append((name, {k: v for k, v in params.items() if TRAINERS[name].defaults.get(k) != v}))

    def no_results(self):
        raise Trained

    monkeypatch.setattr(TrainingRun, "train_one", train_one)
    monkeypatch.setattr(TrainingRun, "results_frame", no_results)
    monkeypatch.setattr(TrainingRun, "compare_importances", no_results)
    monkeypatch.setattr(se, "_errors_at_once", lambda *_: None)
    monkeypatch.setattr(se, "fold_error", lambda trainer, folded, fold, features, target, key, params, seed: folds.append((fold, params)) or 1.0)
    folder = "/root/testdata/sf0.001"
    for name in ("random_forest", "random_forest_ml", "extra_trees", "boosted_trees", "boosted_early_stopping", "train_and_rank", "importance_comparison"):
        with pytest.raises(Trained):
            QUERIES[name](spark, folder)
    with pytest.raises(KeyError):  # no model was kept
        QUERIES["feature_importance"](spark, folder)
    four = [(n, {}) for n in ("polynomial", "random_forest", "extra_trees", "boosted_trees")]
    assert seen == [
        ("random_forest", {}), ("random_forest", {"backend": "ml", "min_samples_split": 4}), ("extra_trees", {}), ("boosted_trees", {}),
        ("boosted_trees", {"early_stopping_rounds": 2}), *four, *four, *four,
    ]
    QUERIES["cross_validation"](spark, folder)
    assert sorted(f for f, _ in folds) == [0, 1, 2, 3, 4] and all(p == {} for _, p in folds)
    folds.clear()
    QUERIES["search_ridge"](spark, folder)
    assert len(folds) == TRAINERS["polynomial"].trials * 5


@pytest.mark.parametrize("limits", [{"LOCAL_VECTORS": 0}, {"PACKED_ROWS": 64, "CHUNK_ROWS": 7}])
def test_trees_are_the_same_by_vectors_and_by_rows(spark, monkeypatch, limits):
    # few different vectors, one of them frequent, keys that repeat and are missing
    rows = [(None if i % 50 == 0 else i // 2, float(i * i % 7 if i % 3 else 0), float(i * i % 11 % 5 if i % 3 else 0), float(i * i % 13) + i % 7) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    settings = {"max_depth": 3, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.6}
    fits = (
        lambda: trees.fit_forest(df, ["a", "b"], "y", ["id"], n_estimators=9, max_depth=4, random_cuts=True),
        lambda: trees.fit_forest(df, ["a", "b"], "y", ["id"], n_estimators=3, max_depth=4, bootstrap=True, min_samples_leaf=3, min_samples_split=8),
        lambda: trees.fit_boosted(df, ["a", "b"], "y", ["id"], n_estimators=7, **settings, early_stopping_rounds=3),
        lambda: trees.fit_boosted(df, ["a", "b"], "y", ["id"], n_estimators=7, **settings),
    )
    want = [f().nodes.to_numpy(float) for f in fits]
    monkeypatch.setattr(hg, "LOCAL_ROWS", 100)
    monkeypatch.setattr(trees, "REFRESH", 3)
    for name, value in limits.items():
        monkeypatch.setattr(hg, name, value)
    laid = []
    by_vector = hg.by_vector
    monkeypatch.setattr(hg, "by_vector", lambda *given: laid.append(given) or by_vector(*given))
    for whole, f in zip(want, fits):
        assert np.allclose(whole, f().nodes.to_numpy(float))
    assert len(laid) == (0 if "LOCAL_VECTORS" in limits else 5)


def test_kept_cells_give_the_same_predictions(sample, monkeypatch):
    df, _ = sample
    holes = df.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    model = trees.fit_boosted(df, X, "y", ["id"], n_estimators=4, max_depth=3, learning_rate=0.3)
    want = {}
    for cells in (1 << 22, 0):
        monkeypatch.setattr(trees, "MEMO_CELLS", cells)
        want[cells] = sorted((r["id"], r["prediction"]) for r in model.transform(holes).collect())
    assert want[0] == want[1 << 22] and len(want[0]) == df.count()


def test_a_table_of_combinations_predicts_what_the_walk_does(sample):
    df, _ = sample
    model = trees.fit_forest(df, X, "y", ["id"], n_estimators=20, max_depth=6, random_cuts=True)
    packed, cuts = model._packed()
    shape = [len(c) + 1 for c in cuts]
    every = np.indices(shape).reshape(len(shape), -1).T
    assert (packed.table(shape) == packed.walk(every)).all() and len(every) > 100
    # a missing value stands above all cuts; a tree without a split has one combination
    lone = trees._Packed(np.zeros(1, int), np.array([255]), np.zeros(1, int), np.array([2.5]), [(0, 0)])
    assert lone.table([1, 1]).tolist() == [2.5] == lone.walk(np.zeros((1, 2), int)).tolist()


def test_sides_of_a_run_share_what_a_worker_has_worked_out(sample):
    df, _ = sample
    model = trees.fit_forest(df, X, "y", ["id"], n_estimators=2, max_depth=3, random_cuts=True)
    model.transform(df.where("id % 2 = 0"))
    first = model._sent[1]
    model.transform(df.where("id % 2 = 1"))
    assert model._sent[1] is first  # one memo for both tables
    again = pickle.loads(pickle.dumps(model))
    assert again._sent is None and again.nodes.equals(model.nodes)


def test_boosting_adds_up_the_combinations_of_a_rounds_features(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i * i % 11), float(i * 5 % 13), float(i * i % 17) + i % 7) for i in range(1600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    settings = {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.7}
    fit = lambda **more: trees.fit_boosted(df, ["a", "b", "c"], "y", ["id"], **settings, **more).nodes.to_numpy(float)
    want = fit(), fit(early_stopping_rounds=4)
    monkeypatch.setattr(hg, "LOCAL_ROWS", 100)
    jobs, grown = [], trees._boosted_by_vector
    monkeypatch.setattr(trees, "_boosted_by_vector", lambda *given: jobs.append(given[-1]) or grown(*given))
    for most in (hg.LOCAL_VECTORS, 700):  # all rounds in one job, and a few at a time
        monkeypatch.setattr(hg, "LOCAL_VECTORS", most)
        monkeypatch.setattr(trees, "REFRESH", 3)
        assert np.allclose(want[0], fit()) and np.allclose(want[1], fit(early_stopping_rounds=4))
    assert min(jobs) == 3 and max(jobs) > 8
    columns = [np.array(x) for x in ([0, 1, 0, 1, 1, 0, 1], [0, 0, 0, 1, 1, 2, 2], [1, 0, 1, 0, 1, 0, 1])]
    grids = [np.array([0.5]), np.array([0.5, 1.5]), np.array([0.5])]
    own, w, g = hg.combinations(columns, np.arange(1.0, 8), np.ones(7), grids, [0, 2])
    assert sorted(zip(own[0].tolist(), own[2].tolist(), w.tolist(), g.tolist())) == [(0, 0, 6.0, 1.0), (0, 1, 4.0, 2.0), (1, 0, 6.0, 2.0), (1, 1, 12.0, 2.0)]
    whole = hg.combinations(columns, np.ones(7), np.ones(7), grids, [0, 1, 2])  # twelve combinations of seven rows
    assert whole[0] is columns
