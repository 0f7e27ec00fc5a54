"""Queries for cleaning, derived columns, splits and file round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import clean, features as fe, split as sp
from ..operators.profile import low_cardinality
from ..schema import align_columns, binary_columns
from ..session import checkpoint_dir
from ..sources import readers, writers
from .base import ORDERS_GAPS, query, rounded, source, table, union_all

ORDERS = source("orders", ORDERS_GAPS)


@query("dedup_rows", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedup_rows(spark, folder):
    return clean.drop_duplicates(table(spark, folder, "documents", ("text", "lang", "source", "n_chars")))


RAGGED = ("p_partkey", "concat('  ', p_brand, chr(9)) AS p_brand", "concat(chr(10), p_type, ' ') AS p_type")


@query(
    "unify_text",
    f"""SELECT p_partkey, {', '.join(f"regexp_replace(lower({c}), '^[[:space:]]+|[[:space:]]+$', '', 'g') AS {c}" for c in ('p_brand', 'p_type'))}
    FROM {source('part', RAGGED)}""",
)
def unify_text(spark, folder):
    return clean.unify_text(table(spark, folder, "part", RAGGED))


@query(
    "replace_map",
    """SELECT o_orderkey, CASE lower(o_orderstatus) WHEN 'f' THEN 'finished' WHEN 'o' THEN 'open' ELSE lower(o_orderstatus) END
    AS o_orderstatus FROM orders""",
)
def replace_map(spark, folder):
    rules = {"o_orderstatus": {"f": "finished", "o": "open"}}
    return clean.unify_text(table(spark, folder, "orders", ("o_orderkey", "o_orderstatus")), rules=rules)


@query(
    "missing_level",
    f"SELECT o_orderkey, coalesce(lower(o_orderpriority), 'nan') AS o_orderpriority FROM {ORDERS}",
)
def missing_level(spark, folder):
    return clean.unify_text(table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_orderpriority"))


@query(
    "missing_kept",
    f"SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority FROM {ORDERS}",
)
def missing_kept(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_orderpriority")
    return clean.unify_text(orders, missing_as_level=False)


def _constrained(spark, folder, rule, **options):
    orders = table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_totalprice")
    return clean.apply_constraints(orders, {"o_totalprice": rule, "not_a_column": {"min": 0}}, **options)


@query(
    "clip_constraint",
    f"""SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 100000 WHEN o_totalprice > 400000 THEN 400000 ELSE o_totalprice END
    AS o_totalprice FROM {ORDERS}""",
)
def clip_constraint(spark, folder):
    return _constrained(spark, folder, {"min": 100000, "max": 400000, "action": "clip"})


@query("range_drop", f"SELECT o_orderkey, o_totalprice FROM {ORDERS} WHERE o_totalprice BETWEEN 100000 AND 400000")
def range_drop(spark, folder):
    return _constrained(spark, folder, {"min": 100000, "max": 400000})


@query(
    "range_keep_nulls",
    f"SELECT o_orderkey, o_totalprice FROM {ORDERS} WHERE o_totalprice BETWEEN 100000 AND 400000 OR o_totalprice IS NULL",
)
def range_keep_nulls(spark, folder):
    return _constrained(spark, folder, {"min": 100000, "max": 400000}, keep_nulls=True)


@query(
    "null_out",
    f"SELECT o_orderkey, CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS o_totalprice FROM {ORDERS}",
)
def null_out(spark, folder):
    return _constrained(spark, folder, {"min": 100000, "action": "mean"}, mean_action="null_out")


@query("mean_action_noop", f"SELECT o_orderkey, o_totalprice FROM {ORDERS}")
def mean_action_noop(spark, folder):
    return _constrained(spark, folder, {"min": 100000, "action": "mean"})


@query(
    "coerce_numeric",
    """SELECT event_id, json_extract_string(props, '$.k')::DOUBLE AS k FROM events WHERE event_id % 11 <> 0""",
)
def coerce_numeric(spark, folder):
    columns = ("event_id", "CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE get_json_object(props, '$.k') END AS k")
    return clean.apply_constraints(table(spark, folder, "events", columns), {"k": {"dtype": "float"}})


CHECKED = ("o_orderkey", "lower(o_orderpriority) AS o_orderpriority", "o_totalprice")


@query(
    "validate_rows",
    """SELECT o_orderkey, o_totalprice, CASE lower(o_orderpriority) WHEN '1-urgent' THEN '1-Urgent' WHEN '2-high' THEN '2-High'
    ELSE lower(o_orderpriority) END AS o_orderpriority, concat_ws(',', CASE WHEN lower(o_orderpriority) NOT IN ('1-urgent', '2-high')
    THEN 'o_orderpriority' END, CASE WHEN NOT (o_totalprice BETWEEN 50000 AND 450000) THEN 'o_totalprice' END) AS violations FROM orders""",
)
def validate_rows(spark, folder):
    rules = {"o_orderpriority": {"options": ["1-Urgent", "2-High"]}, "o_totalprice": {"min": 50000, "max": 450000}}
    checked = clean.validate_rows(table(spark, folder, "orders", CHECKED), rules)
    return checked.withColumn("violations", F.array_join("violations", ","))


RATIO_COLUMNS = ("l_orderkey", "l_extendedprice", "CASE WHEN l_linenumber = 3 THEN 0 ELSE l_quantity END AS l_quantity")


@query(
    "ratio_feature",
    f"""SELECT * FROM (SELECT l_orderkey, l_extendedprice, l_quantity, CASE WHEN l_quantity / 60.0::DOUBLE > 0
    THEN round_even(l_extendedprice / (l_quantity / 60.0::DOUBLE) * 100, 0) / 100 ELSE 0 END AS Speed_kmh
    FROM {source('lineitem', RATIO_COLUMNS)}) WHERE Speed_kmh BETWEEN 0 AND 200000""",
)
def ratio_feature(spark, folder):
    return fe.speed_feature(
        table(spark, folder, "lineitem", RATIO_COLUMNS), "l_extendedprice", "l_quantity", low=0, high=200000
    )


@query(
    "datetime_parts",
    """SELECT o_orderkey, hour(d) AS d_hour, day(d) AS d_day, month(d) AS d_month, year(d) AS d_year,
    isodow(d) - 1 AS d_dayofweek, quarter(d) AS d_quarter FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL
    ELSE o_orderdate END AS d FROM orders)""",
)
def datetime_parts(spark, folder):
    columns = ("o_orderkey", "CASE WHEN o_orderkey % 9 = 0 THEN 'not a date' ELSE cast(o_orderdate AS string) END AS d")
    parts = ("hour", "day", "month", "year", "dayofweek", "quarter")
    return fe.datetime_parts(table(spark, folder, "orders", columns), "d", parts, drop_original=True)


@query(
    "interactions",
    """SELECT l_orderkey, round(l_extendedprice * l_discount, 6) AS l_extendedprice_x_l_discount,
    round(l_extendedprice + l_discount, 6) AS l_extendedprice_plus_l_discount,
    round(l_extendedprice - l_discount, 6) AS l_extendedprice_minus_l_discount,
    round(l_extendedprice / (l_discount + 1e-6::DOUBLE), 2) AS l_extendedprice_div_l_discount FROM lineitem""",
)
def interactions(spark, folder):
    lines = table(spark, folder, "lineitem", ("l_orderkey", "l_extendedprice", "l_discount"))
    pairs = [("l_extendedprice", "l_discount"), ("l_extendedprice", "not_a_column")]
    made = fe.interactions(lines, pairs, ("multiply", "add", "subtract", "divide")).drop("l_extendedprice", "l_discount")
    name = "l_extendedprice_{}_l_discount".format
    return rounded(rounded(made, 6, name("x"), name("plus"), name("minus")), 2, name("div"))


@query(
    "ordinal_map",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 END AS level FROM events""",
)
def ordinal_map(spark, folder):
    events = table(spark, folder, "events", ("event_id", "event_type"))
    return fe.map_levels(events, "event_type", {"view": 1, "click": 2, "error": 3}, "level").drop("event_type")


@query("align_columns", "SELECT o_totalprice, 0 AS absent, o_orderkey FROM orders")
def align(spark, folder):
    return align_columns(table(spark, folder, "orders"), ["o_totalprice", "absent", "o_orderkey"])


@query(
    "binary_columns",
    "SELECT c AS column_name FROM ("
    + union_all(f"SELECT '{c}' AS c, bool_and({c} IN (0, 1)) AS ok FROM labels" for c in ("doc_id", "quality", "toxic"))
    + ") WHERE ok",
)
def binary(spark, folder):
    return spark.createDataFrame([(c,) for c in binary_columns(table(spark, folder, "labels"))], "column_name string")


@query(
    "low_cardinality",
    "SELECT c AS column_name FROM ("
    + union_all(f"SELECT '{c}' AS c, count(DISTINCT {c}) AS d FROM part" for c in ("p_name", "p_brand", "p_type"))
    + ") WHERE d <= 50",
)
def few_levels(spark, folder):
    names = low_cardinality(table(spark, folder, "part"), ["p_name", "p_brand", "p_type"])
    return spark.createDataFrame([(c,) for c in names], "column_name string")


SPLIT_HASH = "('0x' || substr(md5(o_orderkey || ':42'), 1, 13))::BIGINT"
SPLIT = f"""SELECT o_orderkey, o_totalprice, CASE WHEN row_number() OVER (ORDER BY {SPLIT_HASH}) <= ceil(0.2 * count(*) OVER ())
    THEN 'test' ELSE 'train' END AS split FROM orders"""


@query("union_split", SPLIT)
def union_split(spark, folder):
    train, test = sp.train_test_split(table(spark, folder, "orders", ("o_orderkey", "o_totalprice")), "o_orderkey")
    return sp.with_split_tag(train, test)


@query(
    "split_counts",
    f"SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM ({SPLIT}) GROUP BY split",
)
def split_counts(spark, folder):
    train, test = sp.train_test_split(table(spark, folder, "orders"), "o_orderkey")
    return sp.with_split_tag(train, test).groupBy("split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "split_by_threshold",
    f"""SELECT CASE WHEN {SPLIT_HASH} < CAST(floor(0.2 * 4503599627370496) AS BIGINT) THEN 'test' ELSE 'train' END AS split, count(*) AS n
    FROM orders GROUP BY 1""",
)
def split_by_threshold(spark, folder):
    train, test = sp.train_test_split(table(spark, folder, "orders"), "o_orderkey", exact=False)
    return sp.with_split_tag(train, test).groupBy("split").agg(F.count("*").alias("n"))


@query(
    "kfold_counts",
    """SELECT fold, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (SELECT event_id, CAST(CASE WHEN rn < (n % 7) * (n // 7 + 1)
    THEN rn // (n // 7 + 1) ELSE (n % 7) + (rn - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INT) AS fold
    FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS rn, count(*) OVER () AS n FROM events)) GROUP BY fold""",
)
def kfold_counts(spark, folder):
    return _fold_counts(sp.contiguous_folds(table(spark, folder, "events"), ["event_id"], 7), "event_id")


@query(
    "kfold_by_two_keys",
    """SELECT fold, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (SELECT event_id,
    CAST(CASE WHEN rn < (n % 5) * (n // 5 + 1) THEN rn // (n // 5 + 1) ELSE (n % 5) + (rn - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS fold
    FROM (SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS rn, count(*) OVER () AS n FROM events)) GROUP BY fold""",
)
def kfold_by_two_keys(spark, folder):
    return _fold_counts(sp.contiguous_folds(table(spark, folder, "events"), ["user_id", "event_id"], 5), "event_id")


@query(
    "hash_folds",
    """SELECT CAST(('0x' || substr(md5(event_id || ':42'), 1, 13))::BIGINT % 5 AS INT) AS fold, count(*) AS n,
    min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1""",
)
def hash_folds(spark, folder):
    return _fold_counts(sp.hash_folds(table(spark, folder, "events"), "event_id", 5), "event_id")


def _fold_counts(df, key):
    return df.groupBy("fold").agg(F.count("*").alias("n"), F.min(key).alias("first_id"), F.max(key).alias("last_id"))


# -- files: written to and read back from the shared scratch folder ------------------------


def _scratch(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", f"SELECT o_orderkey, o_totalprice, o_orderpriority FROM {ORDERS}")
def csv_round_trip(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_totalprice", "o_orderpriority")
    marked = orders.withColumn("o_orderpriority", F.coalesce("o_orderpriority", F.lit("NA")))
    path = writers.write_table(marked, _scratch(spark, "orders") + ".csv")
    return readers.read_csv(spark, path)


@query("csv_with_schema", f"SELECT o_orderkey, o_totalprice, o_orderpriority FROM {ORDERS}")
def csv_with_schema(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = writers.write_table(orders.withColumn("o_totalprice", F.coalesce(F.col("o_totalprice").cast("string"), F.lit("n/a"))),
                               _scratch(spark, "orders") + ".csv")
    return readers.load(spark, path, schema=orders.schema)[0]


@query("json_round_trip", f"SELECT o_orderkey, o_totalprice, o_orderpriority FROM {ORDERS}")
def json_round_trip(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS).select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = writers.write_table(orders, _scratch(spark, "orders") + ".jsonl")
    return readers.load(spark, path, schema=orders.schema)[0]


@query("split_sink", f"SELECT split, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ({SPLIT}) GROUP BY split")
def split_sink(spark, folder):
    train, test = sp.train_test_split(table(spark, folder, "orders", ("o_orderkey", "o_totalprice")), "o_orderkey")
    path = writers.write_processed(train, test, _scratch(spark, "processed"))
    stored = spark.read.parquet(path)
    return rounded(stored.groupBy("split").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2, "total")
