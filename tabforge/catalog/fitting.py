"""Queries for imputation, outliers, scaling, encoding and fitted plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as en, impute as im, outliers as ou, scale as sc, split as sp
from ..plans.fitted import ONE_SHOT_STAGES, FeaturePlan
from ..session import stored
from .base import EVENTS_GAPS, ORDERS_GAPS, query, rounded, source, table

ORDERS, EVENTS = source("orders", ORDERS_GAPS), source("events", EVENTS_GAPS)


def _imputed(spark, folder, column, rule, digits=6, **options):
    orders = table(spark, folder, "orders", ORDERS_GAPS)
    fitted = im.fit_imputation(orders, {column: rule}, columns=[column], **options)
    filled = fitted.apply(orders, training=True).select("o_orderkey", column)
    return rounded(filled, digits, column) if column != "o_orderpriority" else filled


@query(
    "impute_mean",
    f"SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM {ORDERS})), 4) AS o_totalprice FROM {ORDERS}",
)
def impute_mean(spark, folder):
    return _imputed(spark, folder, "o_totalprice", "mean", 4)


@query(
    "impute_median",
    f"""SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM {ORDERS})), 4)
    AS o_totalprice FROM {ORDERS}""",
)
def impute_median(spark, folder):
    return _imputed(spark, folder, "o_totalprice", "median", 4)


@query(
    "impute_mode",
    f"""SELECT o_orderkey, coalesce(o_orderpriority, (SELECT o_orderpriority FROM {ORDERS} WHERE o_orderpriority IS NOT NULL
    GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority FROM {ORDERS}""",
)
def impute_mode(spark, folder):
    return _imputed(spark, folder, "o_orderpriority", "mode")


@query("impute_constant", f"SELECT o_orderkey, coalesce(o_totalprice, -1.5) AS o_totalprice FROM {ORDERS}")
def impute_constant(spark, folder):
    return _imputed(spark, folder, "o_totalprice", ("constant", -1.5))


@query("impute_unknown", f"SELECT o_orderkey, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority FROM {ORDERS}")
def impute_unknown(spark, folder):
    return _imputed(spark, folder, "o_orderpriority", "constant")


@query("impute_drop", f"SELECT o_orderkey, o_totalprice FROM {ORDERS} WHERE o_totalprice IS NOT NULL")
def impute_drop(spark, folder):
    return _imputed(spark, folder, "o_totalprice", "drop")


@query(
    "handle_missing",
    f"""SELECT o_orderkey, coalesce(o_totalprice, 0) AS o_totalprice, coalesce(o_custkey, 0) AS o_custkey,
    coalesce(o_orderpriority, (SELECT o_orderpriority FROM {ORDERS} WHERE o_orderpriority IS NOT NULL
    GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority, o_orderstatus FROM {ORDERS}""",
)
def handle_missing(spark, folder):
    return im.handle_missing(table(spark, folder, "orders", ORDERS_GAPS), fill_value=0)


@query(
    "handle_missing_drop",
    f"SELECT * FROM {ORDERS} WHERE o_totalprice IS NOT NULL AND o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL",
)
def handle_missing_drop(spark, folder):
    return im.handle_missing(table(spark, folder, "orders", ORDERS_GAPS), "drop")


@query(
    "impute_ffill",
    f"""SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS value FROM {EVENTS}""",
)
def impute_ffill(spark, folder):
    return _filled(spark, folder, "ffill", ["event_id"])


@query(
    "impute_bfill",
    f"""SELECT event_id, first_value(value IGNORE NULLS) OVER (ORDER BY user_id, event_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM {EVENTS}""",
)
def impute_bfill(spark, folder):
    return _filled(spark, folder, "bfill", ["user_id", "event_id"])


def _filled(spark, folder, rule, order_by):
    events = table(spark, folder, "events", EVENTS_GAPS)
    fitted = im.fit_imputation(events, {"value": rule}, columns=["value"], order_by=order_by)
    return fitted.apply(events).select("event_id", "value")


@query(
    "fill_from_batch",
    f"""SELECT o_orderkey::DOUBLE AS o_orderkey, coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM {ORDERS} WHERE o_orderstatus = 'F'))
    AS o_totalprice, coalesce(o_custkey::DOUBLE, (SELECT quantile_cont(o_custkey, 0.5) FROM {ORDERS} WHERE o_orderstatus = 'O')) AS o_custkey
    FROM {ORDERS} WHERE o_orderstatus = 'O'""",
)
def fill_from_batch(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS)
    fitted = im.fit_imputation(orders.where("o_orderstatus = 'F'"), columns=["o_totalprice"])
    batch = orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    return im.fill_from_batch(batch, fitted)


SKEWED = ("l_orderkey", "l_linenumber", "l_extendedprice * l_extendedprice * l_discount / 1e6 AS a",
          "l_quantity * l_quantity * l_tax AS b")
LINES = source("lineitem", SKEWED)


def _fences(c: str, relation: str) -> str:
    return f"""SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT quantile_cont({c}, 0.25) AS q1,
    quantile_cont({c}, 0.75) AS q3 FROM {relation})"""


def _skewed(spark, folder):
    return table(spark, folder, "lineitem", SKEWED)


def _kept(df):
    return df.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"),
                                          F.round(F.max("a"), 4).alias("max_a"), F.round(F.max("b"), 4).alias("max_b"))


KEPT = "SELECT l_linenumber, count(*) AS n, sum(l_orderkey)::BIGINT AS keys, round(max(a), 4) AS max_a, round(max(b), 4) AS max_b"


@query("outlier_iqr", f"{KEPT} FROM {LINES}, ({_fences('a', LINES)}) WHERE a BETWEEN lo AND hi GROUP BY l_linenumber")
def outlier_iqr(spark, folder):
    return _kept(ou.remove_outliers(_skewed(spark, folder), {"a": "iqr"}))


@query(
    "outlier_zscore",
    f"""{KEPT} FROM {LINES}, (SELECT avg(a) AS m, stddev_pop(a) AS s FROM {LINES}) WHERE abs((a - m) / s) <= 3 GROUP BY l_linenumber""",
)
def outlier_zscore(spark, folder):
    return _kept(ou.remove_outliers(_skewed(spark, folder), {"a": "zscore"}))


@query(
    "outlier_sequential",
    f"""WITH s1 AS (SELECT * FROM {LINES}, ({_fences('a', LINES)}) WHERE a BETWEEN lo AND hi)
    {KEPT} FROM (SELECT l_linenumber, l_orderkey, a, b FROM s1), ({_fences('b', 's1')}) WHERE b BETWEEN lo AND hi GROUP BY l_linenumber""",
)
def outlier_sequential(spark, folder):
    return _kept(ou.remove_outliers(_skewed(spark, folder), {"a": "iqr", "b": "iqr"}))


@query(
    "outlier_simultaneous",
    f"""{KEPT} FROM {LINES}, (SELECT lo AS la, hi AS ha FROM ({_fences('a', LINES)})), (SELECT lo AS lb, hi AS hb FROM ({_fences('b', LINES)}))
    WHERE a BETWEEN la AND ha AND b BETWEEN lb AND hb GROUP BY l_linenumber""",
)
def outlier_simultaneous(spark, folder):
    return _kept(ou.remove_outliers(_skewed(spark, folder), {"a": "iqr", "b": "iqr"}, simultaneous=True))


@query("outlier_iforest")
def outlier_iforest(spark, folder):
    events = table(spark, folder, "events", EVENTS_GAPS)
    kept = ou.remove_outliers(events, {"value": "isolation_forest"}, key=["event_id"])
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("max_value"))


SCALED = ("l_orderkey", "l_linenumber", "l_extendedprice", "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount")
TO_SCALE = source("lineitem", SCALED)


def _scale_sql(centre: str, spread: str) -> str:
    def one(c):
        return f"round(({c} - (SELECT {centre.format(c=c)} FROM {TO_SCALE})) / (SELECT {spread.format(c=c)} FROM {TO_SCALE}), 6) AS {c}"

    return f"SELECT l_orderkey, l_linenumber, {one('l_extendedprice')}, {one('l_discount')} FROM {TO_SCALE}"


def _scaled(spark, folder, method):
    lines = table(spark, folder, "lineitem", SCALED)
    plan = sc.scale_plan(lines, method, exclude=["l_orderkey", "l_linenumber"])
    return rounded(sc.apply_scaling(lines, sc.fit_scaling(lines, plan)), 6, "l_extendedprice", "l_discount")


@query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query("scale_minmax", _scale_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query("scale_robust", _scale_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def scale_robust(spark, folder):
    return _scaled(spark, folder, "robust")


@query("scale_maxabs", _scale_sql("min(0)", "max(abs({c}))"))
def scale_maxabs(spark, folder):
    return _scaled(spark, folder, "maxabs")


@query(
    "scale_normalize",
    f"""SELECT l_orderkey, l_linenumber, sign(l_extendedprice)::DOUBLE AS l_extendedprice, sign(l_discount)::DOUBLE AS l_discount
    FROM {TO_SCALE}""",
)
def scale_normalize(spark, folder):
    return _scaled(spark, folder, "normalize")


@query(
    "normalize_rows",
    """SELECT l_orderkey, round(l_quantity / sqrt(l_quantity * l_quantity + l_tax * l_tax), 6) AS l_quantity,
    round(l_tax / sqrt(l_quantity * l_quantity + l_tax * l_tax), 6) AS l_tax FROM lineitem""",
)
def normalize_rows(spark, folder):
    lines = table(spark, folder, "lineitem", ("l_orderkey", "l_quantity", "l_tax"))
    return rounded(sc.normalize_rows(lines, ["l_quantity", "l_tax"]), 6, "l_quantity", "l_tax")


CODES = "(SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code FROM (SELECT DISTINCT o_orderpriority FROM orders{where}))"


def _encoded(spark, folder, method, where=None, **options):
    orders = table(spark, folder, "orders", ("o_orderkey", "o_orderpriority"))
    fitted = en.fit_encoding(orders.where(where) if where else orders, {"o_orderpriority": method}, **options)
    return en.apply_encoding(orders, fitted)


@query("encode_label", f"SELECT o_orderkey, code::INT AS o_orderpriority FROM orders JOIN {CODES.format(where='')} ON v = o_orderpriority")
def encode_label(spark, folder):
    return _encoded(spark, folder, "label")


@query(
    "encode_ordinal",
    f"SELECT o_orderkey, code::DOUBLE AS o_orderpriority FROM orders JOIN {CODES.format(where='')} ON v = o_orderpriority",
)
def encode_ordinal(spark, folder):
    return _encoded(spark, folder, "ordinal")


KNOWN = "o_orderpriority <> '3-MEDIUM'"


@query(
    "encode_unseen",
    f"""SELECT o_orderkey, coalesce(code, -1)::INT AS o_orderpriority FROM orders
    LEFT JOIN {CODES.format(where=' WHERE ' + KNOWN)} ON v = o_orderpriority""",
)
def encode_unseen(spark, folder):
    return _encoded(spark, folder, "label", KNOWN)


@query(
    "encode_onehot",
    """SELECT o_orderkey, (o_orderstatus = 'O')::INT AS "o_orderstatus_O", (o_orderstatus = 'P')::INT AS "o_orderstatus_P" FROM orders""",
)
def encode_onehot(spark, folder):
    orders = table(spark, folder, "orders", ("o_orderkey", "o_orderstatus"))
    return en.apply_encoding(orders, en.fit_encoding(orders, {"o_orderstatus": "onehot"}))


@query(
    "encode_onehot_unseen",
    """SELECT o_orderkey, (o_orderstatus = 'F')::INT AS "o_orderstatus_F", (o_orderstatus = 'O')::INT AS "o_orderstatus_O" FROM orders""",
)
def encode_onehot_unseen(spark, folder):
    orders = table(spark, folder, "orders", ("o_orderkey", "o_orderstatus"))
    fitted = en.fit_encoding(orders.where("o_orderstatus <> 'P'"), {"o_orderstatus": "onehot"}, drop_first=False)
    return en.apply_encoding(orders, fitted)


@query(
    "encode_many_levels",
    """SELECT c_custkey, (dense_rank() OVER (ORDER BY c_name) - 1)::BIGINT AS c_name FROM customer""",
)
def encode_many_levels(spark, folder):
    customers = table(spark, folder, "customer", ("c_custkey", "c_name"))
    return en.apply_encoding(customers, en.fit_encoding(customers, {"c_name": "label"}))


# -- fit on the training side, apply to both ----------------------------------------------

PLAN_COLUMNS = (
    "o_orderkey",
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey::double END AS o_custkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
    "o_orderstatus",
    "o_totalprice",
)
HASH = "('0x' || substr(md5(o_orderkey || ':42'), 1, 13))::BIGINT"
LEVELS = ("2-high", "3-medium", "4-not specified", "5-low", "nan")
FIT_APPLY = f"""WITH c AS (SELECT o_orderkey, least(greatest(o_custkey, 100), 1200) AS o_custkey0, o_custkey,
    coalesce(lower(o_orderpriority), 'nan') AS prio, lower(o_orderstatus) AS status, o_totalprice FROM {source('orders', PLAN_COLUMNS)}
    WHERE o_totalprice >= 20000),
    k AS (SELECT o_orderkey, CASE WHEN o_custkey IS NULL THEN NULL ELSE o_custkey0 END AS cust, prio, status, o_totalprice,
    row_number() OVER (ORDER BY {HASH}) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM c),
    m AS (SELECT quantile_cont(cust, 0.5) AS med FROM k WHERE NOT is_test),
    f AS (SELECT k.*, coalesce(cust, med) AS filled FROM k, m),
    s AS (SELECT avg(filled) AS mu, stddev_pop(filled) AS sd FROM f WHERE NOT is_test)
    SELECT o_orderkey, round((filled - mu) / sd, 6) AS o_custkey, o_totalprice,
    {', '.join(f"(prio = '{v}')::INT AS {chr(34)}o_orderpriority_{v}{chr(34)}" for v in LEVELS)},
    (status = 'o')::INT AS "o_orderstatus_o", (status = 'p')::INT AS "o_orderstatus_p",
    CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM f, s"""

PLAN_RULES = {
    "o_custkey": {"min": 100, "max": 1200, "dtype": "float", "action": "clip"},
    "o_totalprice": {"min": 20000, "dtype": "float", "action": "drop"},
}


def plan_input(spark, folder):
    return table(spark, folder, "orders", PLAN_COLUMNS)


def prepared_orders(spark, folder):
    from ..plans.training import prepare

    return stored(prepare(plan_input(spark, folder), PLAN_RULES))


def order_plan(**changes):
    return FeaturePlan(**{"target": "o_totalprice", "key": ["o_orderkey"], "constraints": PLAN_RULES, **changes})


@query("tabular_fit_apply", FIT_APPLY)
def tabular_fit_apply(spark, folder):
    train, test = sp.train_test_split(prepared_orders(spark, folder), "o_orderkey")
    fitted, train_ready = order_plan().fit_transform(train)
    return rounded(sp.with_split_tag(train_ready, fitted.transform(test)), 6, "o_custkey")


@query(
    "tabular_new_rows",
    f"""SELECT o_orderkey, round(((CASE WHEN o_custkey IS NULL THEN med ELSE least(greatest(o_custkey, 100), 1200) END) - mu) / sd, 6) AS o_custkey,
    (status = 'o')::INT AS "o_orderstatus_o", (status = 'p')::INT AS "o_orderstatus_p"
    FROM (SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS status FROM {source('orders', PLAN_COLUMNS)}),
    (SELECT quantile_cont(v, 0.5) AS med FROM (SELECT least(greatest(o_custkey, 100), 1200) AS v FROM {source('orders', PLAN_COLUMNS)}
    WHERE o_totalprice >= 20000 AND o_orderstatus <> 'P' AND o_custkey IS NOT NULL)) m,
    (SELECT avg(v) AS mu, stddev_pop(v) AS sd FROM (SELECT CASE WHEN o_custkey IS NULL THEN med ELSE least(greatest(o_custkey, 100), 1200) END AS v
    FROM {source('orders', PLAN_COLUMNS)}, (SELECT quantile_cont(v, 0.5) AS med FROM (SELECT least(greatest(o_custkey, 100), 1200) AS v
    FROM {source('orders', PLAN_COLUMNS)} WHERE o_totalprice >= 20000 AND o_orderstatus <> 'P' AND o_custkey IS NOT NULL))
    WHERE o_totalprice >= 20000 AND o_orderstatus <> 'P')) s""".replace(
        """(status = 'o')::INT AS "o_orderstatus_o", (status = 'p')::INT AS "o_orderstatus_p\"""",
        """(status = 'o')::INT AS "o_orderstatus_o\"""",
    ),
)
def tabular_new_rows(spark, folder):
    """Scoring rows without target, with a level the fit never saw: no row goes, indicators are zero."""
    columns = plan_input(spark, folder).drop("o_orderpriority")
    from ..plans.training import prepare

    fitted = order_plan().fit(stored(prepare(columns.where("o_orderstatus <> 'P'"), PLAN_RULES)))
    return rounded(fitted.transform(columns.drop("o_totalprice")), 6, "o_custkey")


@query(
    "tabular_one_shot",
    f"""WITH c AS (SELECT o_orderkey, CASE WHEN o_custkey IS NULL THEN NULL ELSE least(greatest(o_custkey, 100), 1200) END AS cust,
    o_orderpriority AS prio0, o_totalprice FROM {source('orders', PLAN_COLUMNS)} WHERE o_totalprice >= 20000),
    f AS (SELECT o_orderkey, coalesce(cust, (SELECT quantile_cont(cust, 0.5) FROM c)) AS cust, lower(coalesce(prio0, (SELECT prio0 FROM c
    WHERE prio0 IS NOT NULL GROUP BY prio0 ORDER BY count(*) DESC, prio0 LIMIT 1))) AS prio, o_totalprice FROM c)
    SELECT o_orderkey, round((cust - (SELECT min(cust) FROM f)) / (SELECT max(cust) - min(cust) FROM f), 6) AS o_custkey,
    o_totalprice, (row_number() OVER () * 0 + CASE prio WHEN '1-urgent' THEN 0 WHEN '2-high' THEN 1 WHEN '3-medium' THEN 2
    WHEN '4-not specified' THEN 3 WHEN '5-low' THEN 4 END)::INT AS o_orderpriority FROM f""",
)
def tabular_one_shot(spark, folder):
    plan = order_plan(stages=ONE_SHOT_STAGES, scaling="minmax", encoding="label")
    _, ready = plan.fit_transform(plan_input(spark, folder).drop("o_orderstatus"))
    return rounded(ready, 6, "o_custkey")
