"""Queries whose models, searches and folds SQL can state in closed form."""

from __future__ import annotations

import random
import uuid

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.ordered import row_numbers
from ..functions.quantiles import exact_quantiles
from ..models import search as se, trees
from ..models.histograms import draws
from ..models.linear import fit_polynomial_ridge
from ..models.registry import Param, SavedModel, get_trainer
from ..operators import encode as en, evaluate as ev, split as sp
from ..plans.fitted import FeaturePlan, FittedPlan
from ..session import checkpoint_dir
from ..sources import readers, writers
from .base import ORDERS_GAPS, query, rounded, table
from .modelling import ACTUAL, KEY, LINES

STUMP = f"""WITH t AS (SELECT l_quantity AS q, {ACTUAL} AS y FROM lineitem), m AS (SELECT avg(y) AS m FROM t),
    c AS (SELECT q, count(*) AS n, sum(y - m) AS g FROM t, m GROUP BY q),
    r AS (SELECT q, sum(n) OVER (ORDER BY q) AS wl, sum(g) OVER (ORDER BY q) AS gl, sum(n) OVER () AS w, sum(g) OVER () AS g FROM c)"""


def _stump_sql(strength: str, leaf: str) -> str:
    side = lambda text, g, w: text.format(g=g, w=w)
    gain = f"{side(strength, 'gl', 'wl')} + {side(strength, '(g - gl)', '(w - wl)')}"
    return f"""{STUMP}, b AS (SELECT * FROM r WHERE wl < w ORDER BY {gain} DESC, q LIMIT 1)
    SELECT c.q AS l_quantity, round(m + CASE WHEN c.q <= b.q THEN {side(leaf, 'b.gl', 'b.wl')} ELSE {side(leaf, '(b.g - b.gl)', '(b.w - b.wl)')} END, 6) AS prediction
    FROM c, b, m"""


def _per_quantity(spark, folder, model):
    return rounded(model.transform(table(spark, folder, "lineitem", LINES)).select("l_quantity", "prediction").distinct(), 6, "prediction").distinct()


@query("tree_stump", _stump_sql("{g} * {g} / {w}", "{g} / {w}"))
def tree_stump(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    return _per_quantity(spark, folder, trees.fit_forest(lines, ["l_quantity"], "revenue", KEY, n_estimators=1, max_depth=1))


DRAW = float(draws(0, np.array([1]), np.array([0]), 42)[0, 0])  # of the first tree's root


@query("extra_tree_stump", f"""{STUMP}, l AS (SELECT q, row_number() OVER (ORDER BY q) - 1 AS i, lead(q) OVER (ORDER BY q) AS following FROM c),
    e AS (SELECT i, (q + following) / 2 AS e FROM l WHERE following IS NOT NULL),
    s AS (SELECT 2 * min(e) - (SELECT min(e) FROM e WHERE i > 0) AS low, 2 * max(e) - (SELECT max(e) FROM e WHERE i < (SELECT max(i) FROM e)) AS high, max(i) AS last FROM e),
    k AS (SELECT least(count(*) FILTER (e < low + {DRAW!r} * (high - low)), any_value(last)) AS k FROM e, s),
    b AS (SELECT r.* FROM r JOIN l USING (q), k WHERE i = k)
    SELECT c.q AS l_quantity, round(m + CASE WHEN c.q <= b.q THEN b.gl / b.wl ELSE (b.g - b.gl) / (b.w - b.wl) END, 6) AS prediction FROM c, b, m""")
def extra_tree_stump(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    return _per_quantity(spark, folder, trees.fit_forest(lines, ["l_quantity"], "revenue", KEY, n_estimators=1, max_depth=1, random_cuts=True))


SOFT = "sign({g}) * greatest(abs({g}) - 500, 0)"


@query("boosting_round", _stump_sql(f"({SOFT}) * ({SOFT}) / ({{w}} + 20)", f"0.3 * {SOFT} / ({{w}} + 20)"))
def boosting_round(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    model = trees.fit_boosted(lines, ["l_quantity"], "revenue", KEY, n_estimators=1, max_depth=1, learning_rate=0.3, reg_lambda=20.0, reg_alpha=500.0)
    return _per_quantity(spark, folder, model)


def _two_rounds_sql() -> str:
    """Two stumps on one feature: the second on what the first leaves, from sums per value."""
    gain = lambda t: " + ".join(f"({SOFT.format(g=g)}) * ({SOFT.format(g=g)}) / ({w} + 20)" for g, w in ((f"{t}.gl", f"{t}.wl"), (f"({t}.g - {t}.gl)", f"({t}.w - {t}.wl)")))
    leaf = lambda t: (
        f"CASE WHEN c.q <= {t}.q THEN 0.3 * {SOFT.format(g=f'{t}.gl')} / ({t}.wl + 20) ELSE 0.3 * {SOFT.format(g=f'({t}.g - {t}.gl)')} / ({t}.w - {t}.wl + 20) END")
    return f"""{STUMP}, b AS (SELECT * FROM r WHERE wl < w ORDER BY {gain('r')} DESC, q LIMIT 1),
    c2 AS (SELECT c.q, c.n, c.g - c.n * ({leaf('b')}) AS g, {leaf('b')} AS first FROM c, b),
    r2 AS (SELECT q, sum(n) OVER (ORDER BY q) AS wl, sum(g) OVER (ORDER BY q) AS gl, sum(n) OVER () AS w, sum(g) OVER () AS g FROM c2),
    b2 AS (SELECT * FROM r2 WHERE wl < w ORDER BY {gain('r2')} DESC, q LIMIT 1)
    SELECT c.q AS l_quantity, round(m + c.first + {leaf('b2')}, 6) AS prediction FROM c2 c, b2, m"""


@query("boosting_two_rounds", _two_rounds_sql())
def boosting_two_rounds(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    model = trees.fit_boosted(lines, ["l_quantity"], "revenue", KEY, n_estimators=2, max_depth=1, learning_rate=0.3, reg_lambda=20.0, reg_alpha=500.0)
    return _per_quantity(spark, folder, model)


ALPHA = 5000
ROWS_OF_AN_ARRAY = 10_000


def _folds_sql(k: int, alphas: str) -> str:
    """(trial, rmse): one-feature ridge over hash folds, from sums per fold."""
    key = ", ".join(KEY)
    return f"""WITH t AS (SELECT l_quantity::DOUBLE AS x, {ACTUAL} AS y, CAST('0x' || substr(md5(concat_ws(':', {key}, '42')), 1, 13) AS BIGINT) % {k} AS f FROM lineitem),
    s AS (SELECT f, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy FROM t GROUP BY f),
    o AS (SELECT *, sum(n) OVER () - n AS tn, sum(sx) OVER () - sx AS tx, sum(sy) OVER () - sy AS ty, sum(sxx) OVER () - sxx AS txx, sum(sxy) OVER () - sxy AS txy FROM s),
    l AS (SELECT o.*, trial, (txy - tx * ty / tn) / (txx - tx * tx / tn + alpha) AS b FROM o, (VALUES {alphas}) AS a(trial, alpha)),
    e AS (SELECT *, (ty - b * tx) / tn AS a FROM l)
    SELECT trial, sqrt(avg((syy - 2 * a * sy - 2 * b * sxy + n * a * a + 2 * a * b * sx + b * b * sxx) / n)) AS rmse FROM e GROUP BY trial"""


@query("cross_validation_ridge", f"SELECT round(rmse, 6) AS rmse FROM ({_folds_sql(5, f'(0, {ALPHA})')})")
def cross_validation_ridge(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    value = se.cross_validate(get_trainer("polynomial"), lines, ["l_quantity"], "revenue", KEY, k=5, degree=1, alpha=float(ALPHA))
    return rounded(spark.createDataFrame([(value,)], "rmse double"), 6, "rmse")


SPACE = {"alpha": Param(1_000.0, 90_000.0)}
_draws = random.Random(42)
TRIALS = [(i, se.draw(SPACE, _draws)["alpha"]) for i in range(3)]


@query("search_ridge_one_feature", f"SELECT trial, round(rmse, 6) AS rmse FROM ({_folds_sql(3, ', '.join(map(str, TRIALS)))}) ORDER BY rmse, trial LIMIT 1")
def search_ridge_one_feature(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    found = se.search(get_trainer("polynomial"), lines, ["l_quantity"], "revenue", KEY, n_trials=len(TRIALS), k=3, space=SPACE, degree=1)
    return rounded(se.best_trial(found.trials).select("trial", "rmse"), 6, "rmse")


def _quadratic_sql(k: int, trials: str) -> str:
    """(trial, rmse) over hash folds of a ridge on x and x squared, from sums per fold."""
    key = ", ".join(KEY)
    sums = {"n": "1", "x": "x", "q": "x * x", "c": "x * x * x", "d": "x * x * x * x", "y": "y", "xy": "x * y", "qy": "x * x * y", "yy": "y * y"}
    fold = ", ".join(f"sum({e}) AS {c}" for c, e in sums.items())
    rest = ", ".join(f"sum({c}) OVER () - {c} AS t{c}" for c in sums)
    return f"""WITH t AS (SELECT l_quantity::DOUBLE AS x, {ACTUAL} AS y, CAST('0x' || substr(md5(concat_ws(':', {key}, '42')), 1, 13) AS BIGINT) % {k} AS f FROM lineitem),
    s AS (SELECT f, {fold} FROM t GROUP BY f), o AS (SELECT *, {rest} FROM s),
    l AS (SELECT o.*, trial, tq - tx * tx / tn + alpha AS a11, tc - tx * tq / tn AS a12, td - tq * tq / tn + alpha AS a22,
        txy - tx * ty / tn AS b1, tqy - tq * ty / tn AS b2 FROM o, (VALUES {trials}) AS a(trial, alpha)),
    g AS (SELECT *, (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS g1, (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS g2 FROM l),
    e AS (SELECT *, (ty - g1 * tx - g2 * tq) / tn AS g0 FROM g)
    SELECT trial, round(sqrt(avg((yy - 2 * (g0 * y + g1 * xy + g2 * qy) + g0 * g0 * n + 2 * g0 * g1 * x + (2 * g0 * g2 + g1 * g1) * q + 2 * g1 * g2 * c + g2 * g2 * d) / n)), 6) AS rmse
    FROM e GROUP BY trial"""


@query("search_ridge_quadratic", _quadratic_sql(4, ", ".join(map(str, TRIALS))))
def search_ridge_quadratic(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    found = se.search(get_trainer("polynomial"), lines, ["l_quantity"], "revenue", KEY, n_trials=len(TRIALS), k=4, space=SPACE, degree=2)
    return rounded(found.trials.groupBy("trial").agg(F.sqrt(F.avg("mse")).alias("rmse")), 6, "rmse")


LINE = f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS x, {ACTUAL} AS y FROM lineitem),
    f AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS b, avg(y) AS my, avg(x) AS mx FROM t),
    p AS (SELECT t.*, my + b * (x - mx) AS p FROM t, f)"""


def _saved_line(spark, folder) -> SavedModel:
    """A one-feature ridge, saved and loaded again."""
    lines = table(spark, folder, "lineitem", LINES)
    model = SavedModel("line", fit_polynomial_ridge(lines, ["l_quantity"], "revenue", degree=1, alpha=float(ALPHA)), ["l_quantity"])
    path = model.save(spark, f"{checkpoint_dir(spark)}/line-{uuid.uuid4().hex}").removesuffix("/about")
    return SavedModel.load(spark, path)


@query("saved_model_scores", f"{LINE} SELECT l_orderkey, l_linenumber, round(p, 6) AS prediction FROM p")
def saved_model_scores(spark, folder):
    lines = table(spark, folder, "lineitem", LINES)
    return rounded(_saved_line(spark, folder).transform(lines).select("l_orderkey", "l_linenumber", "prediction"), 6, "prediction")


@query("evaluate_fitted", f"""{LINE} SELECT round(sqrt(avg((y - p) ** 2)), 6) AS test_rmse, round(avg(abs(y - p)), 6) AS test_mae,
    round(1 - avg((y - p) ** 2) / var_pop(y), 8) AS test_r2 FROM p""")
def evaluate_fitted(spark, folder):
    metrics, _ = ev.evaluate_model(_saved_line(spark, folder), table(spark, folder, "lineitem", LINES), "revenue")
    return rounded(rounded(metrics, 6, "test_rmse", "test_mae"), 8, "test_r2")


@query("saved_plan_scores", """WITH k AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM k),
    c AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code FROM (SELECT DISTINCT o_orderpriority FROM k))
    SELECT o_orderkey, round((o_totalprice - m) / d, 8) AS o_totalprice, coalesce(code, -1) AS o_orderpriority FROM orders LEFT JOIN c ON v = o_orderpriority, s""")
def saved_plan_scores(spark, folder):
    orders = table(spark, folder, "orders", ("o_orderkey", "o_totalprice", "o_orderpriority", "CAST(o_orderkey AS DOUBLE) AS y"))
    plan = FeaturePlan("y", ["o_orderkey"], stages=("encode", "scale"), encoding="label", exclude_scaling=["o_orderpriority"])
    path = f"{checkpoint_dir(spark)}/plan-{uuid.uuid4().hex}"
    plan.fit(orders.where("o_orderkey % 3 <> 0")).save(spark, path)
    scored = FittedPlan.load(spark, path).transform(orders)
    return rounded(scored.select("o_orderkey", "o_totalprice", "o_orderpriority"), 8, "o_totalprice")


@query("json_array_file", """SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders""")
def json_array_file(spark, folder):
    """Documents of one array each, written from and read back as the table; Spark splits the work by file."""
    orders = table(spark, folder, "orders", ("o_orderkey", "o_orderstatus", "o_totalprice", ORDERS_GAPS[2]))
    path = f"{checkpoint_dir(spark)}/arrays-{uuid.uuid4().hex}"
    writers.write_json_arrays(orders, path, ["o_orderkey"], files=orders.count() // ROWS_OF_AN_ARRAY + 1)
    return readers.read_json(spark, path).select(*orders.columns)


@query("results_read_back", "SELECT 'line' AS model, round(sqrt(avg((y - p) ** 2)), 4) AS test_rmse FROM (SELECT y, p FROM ("
       f"{LINE} SELECT y, p FROM p))")
def results_read_back(spark, folder):
    metrics, _ = ev.evaluate_model(_saved_line(spark, folder), table(spark, folder, "lineitem", LINES), "revenue")
    row = metrics.first().asDict()
    path = f"{checkpoint_dir(spark)}/results-{uuid.uuid4().hex}"
    writers.write_results(spark, {"line": {**row, "train_rmse": row["test_rmse"], "hyperparams": {"alpha": ALPHA}}}, path)
    return rounded(spark.read.json(path).select("model", "test_rmse"), 4, "test_rmse")


@query("quantiles_with_nan", """WITH t AS (SELECT o_totalprice AS x FROM orders WHERE o_orderkey % 10 <> 0)
    SELECT 0.05::DOUBLE AS p, round(quantile_cont(x, 0.05), 6) AS value FROM t UNION ALL SELECT 0.5::DOUBLE, round(quantile_cont(x, 0.5), 6) FROM t
    UNION ALL SELECT 0.95::DOUBLE, round(quantile_cont(x, 0.95), 6) FROM t""")
def quantiles_with_nan(spark, folder):
    """The bracket kernel on a column with NaN."""
    orders = table(spark, folder, "orders", ("CASE WHEN o_orderkey % 10 = 0 THEN double('NaN') ELSE o_totalprice END AS x",))
    p = [0.05, 0.5, 0.95]
    values = exact_quantiles(orders, {"x": p}, direct_rows=0)["x"]
    return rounded(spark.createDataFrame(list(zip(p, values)), "p double, value double"), 6, "value")


@query("kfold_missing_keys", """WITH t AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS k FROM orders),
    r AS (SELECT row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM t WHERE k IS NOT NULL),
    f AS (SELECT CASE WHEN i < (n % 4) * (n // 4 + 1) THEN i // (n // 4 + 1) ELSE n % 4 + (i - (n % 4) * (n // 4 + 1)) // (n // 4) END AS fold FROM r
          UNION ALL SELECT 3 FROM t WHERE k IS NULL)
    SELECT fold, count(*) AS n FROM f GROUP BY fold""")
def kfold_missing_keys(spark, folder):
    orders = table(spark, folder, "orders", ("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS k",))
    return sp.contiguous_folds(orders, ["k"], 4).groupBy("fold").agg(F.count("*").alias("n"))


@query("row_numbers_by_text", "SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS row_number FROM customer")
def row_numbers_by_text(spark, folder):
    return row_numbers(table(spark, folder, "customer", ("c_custkey", "c_name")), ["c_name", "c_custkey"]).drop("c_name")


@query("encode_onehot_vector", """SELECT p_partkey, code AS place FROM part JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
    FROM (SELECT DISTINCT p_brand AS v FROM part)) ON v = p_brand""")
def encode_onehot_vector(spark, folder):
    """Place of the one in each sparse vector, counted from 1; the dropped first level has none (0)."""
    parts = table(spark, folder, "part", ("p_partkey", "p_brand"))
    coded = en.apply_encoding(parts, en.fit_encoding(parts, {"p_brand": "onehot_vector"}))
    return coded.select("p_partkey", F.array_position(vector_to_array("p_brand"), 1.0).cast("long").alias("place"))
