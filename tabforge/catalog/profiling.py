"""Queries for profiles, counts, correlations and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as num
from ..operators import correlation as co, distribution as di, evaluate as ev, profile as pr
from .base import EVENTS_GAPS, LINES_GAPS, ORDERS_GAPS, query, rounded, source, table, union_all

ORDERS, LINES, EVENTS = source("orders", ORDERS_GAPS), source("lineitem", LINES_GAPS), source("events", EVENTS_GAPS)
ORDER_TYPES = {
    "o_orderkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string", "o_orderstatus": "string",
    "o_custkey": "bigint",
}
LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def _share(part: str, whole: str) -> str:
    return f"round_even({part}::DOUBLE / {whole} * 100 * 100, 0) / 100"


@query(
    "profile_columns",
    union_all(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing,
        {_share(f'(count(*) - count({c}))', 'count(*)')} AS missing_pct, count(DISTINCT {c}) AS "unique",
        CAST(count(DISTINCT {c}) <= 1 AS INT) AS constant,
        CAST((count(*) - count({c})) * 2 > count(*) AS INT) AS high_missing FROM {ORDERS}"""
        for c, t in ORDER_TYPES.items()
    ),
)
def profile_columns(spark, folder):
    return pr.column_profile(table(spark, folder, "orders", ORDERS_GAPS))


@query(
    "profile_most_missing",
    'SELECT * FROM ('
    + union_all(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        {_share(f'(count(*) - count({c}))', 'count(*)')} AS missing_pct FROM {ORDERS}"""
        for c in ORDER_TYPES
    )
    + ') ORDER BY missing_pct DESC, "column" LIMIT 3',
)
def profile_most_missing(spark, folder):
    return pr.column_profile(table(spark, folder, "orders", ORDERS_GAPS), top_n=3).select("column", "missing", "missing_pct")


SNAPSHOT_COLUMNS = (
    "l_returnflag", "l_linestatus", "l_linenumber",
    "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount",
)
SNAPSHOT = source("lineitem", SNAPSHOT_COLUMNS)


@query(
    "table_snapshot",
    f"""SELECT n AS rows, 4 AS columns, n - d AS duplicates, m AS total_missing, {_share('m', '(n * 4)')} AS missing_pct,
    CAST(m::DOUBLE / (n * 4) >= 0.1 AS INT) AS high_missing
    FROM (SELECT count(*) AS n, count(*) - count(l_discount) AS m FROM {SNAPSHOT}),
    (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM {SNAPSHOT}))""",
)
def table_snapshot(spark, folder):
    return pr.table_snapshot(table(spark, folder, "lineitem", SNAPSHOT_COLUMNS))


@query(
    "dtype_counts",
    f"""SELECT 'bigint' AS dtype, 2 AS n_columns, count(o_orderkey) + count(o_custkey) AS n_values,
    2 * count(*) - count(o_orderkey) - count(o_custkey) AS n_missing FROM {ORDERS}
    UNION ALL SELECT 'double', 1, count(o_totalprice), count(*) - count(o_totalprice) FROM {ORDERS}
    UNION ALL SELECT 'string', 2, count(o_orderpriority) + count(o_orderstatus),
    2 * count(*) - count(o_orderpriority) - count(o_orderstatus) FROM {ORDERS}""",
)
def dtype_counts(spark, folder):
    return pr.dtype_counts(table(spark, folder, "orders", ORDERS_GAPS))


@query(
    "data_overview",
    f"""SELECT count(*) AS rows, 4 AS columns, 2 AS numeric_columns, 2 AS categorical_columns, 0 AS datetime_columns,
    0 AS boolean_columns, CAST(count(l_discount) < count(*) AS BIGINT) AS columns_with_missing,
    count(*) - count(l_discount) AS total_missing, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {SNAPSHOT})) AS duplicates
    FROM {SNAPSHOT}""",
)
def data_overview(spark, folder):
    return pr.data_overview(table(spark, folder, "lineitem", SNAPSHOT_COLUMNS))


@query(
    "table_summary",
    f"""SELECT count(*) AS n_rows, 5 AS n_columns, 3 AS n_numeric, 2 AS n_categorical,
    5 * count(*) - count(o_orderkey) - count(o_totalprice) - count(o_orderpriority) - count(o_orderstatus) - count(o_custkey)
    AS total_missing FROM {ORDERS}""",
)
def table_summary(spark, folder):
    s = pr.table_summary(table(spark, folder, "orders", ORDERS_GAPS))
    values = [(*s["shape"], s["n_numeric_cols"], s["n_categorical_cols"], s["total_missing"])]
    return spark.createDataFrame(
        values, "n_rows long, n_columns long, n_numeric long, n_categorical long, total_missing long"
    )


@query(
    "missing_table",
    'SELECT * FROM ('
    + union_all(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        {_share(f'(count(*) - count({c}))', 'count(*)')} AS missing_pct FROM {ORDERS}"""
        for c in ORDER_TYPES
    )
    + ") WHERE missing > 0",
)
def missing_table(spark, folder):
    return pr.missing_table(table(spark, folder, "orders", ORDERS_GAPS))


@query(
    "numeric_summary",
    union_all(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min,
        max({c})::DOUBLE AS max, round(skewness({c}), 4) AS skewness, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median,
        CAST(abs(skewness({c})) > 1 AS INT) AS skewed FROM {LINES}"""
        for c in LINE_COLUMNS
    )
    + f""" UNION ALL SELECT 'value', round(avg(value), 4), round(stddev_samp(value), 4), min(value), max(value),
    round(skewness(value), 4), round(quantile_cont(value, 0.5), 4), CAST(abs(skewness(value)) > 1 AS INT) FROM {EVENTS}""",
)
def numeric_summary(spark, folder):
    lines = pr.numeric_summary(table(spark, folder, "lineitem", LINES_GAPS))
    events = pr.numeric_summary(table(spark, folder, "events", EVENTS_GAPS), ["value"])
    return rounded(lines.unionByName(events), 4, "mean", "std", "skewness", "median")


@query(
    "describe_numeric",
    union_all(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q1,
        round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q3 FROM {LINES}"""
        for c in LINE_COLUMNS
    ),
)
def describe_numeric(spark, folder):
    return rounded(pr.describe_numeric(table(spark, folder, "lineitem", LINES_GAPS)), 4, "mean", "std", "q1", "median", "q3")


TEXT_COLUMNS = ("o_orderpriority", "o_orderstatus")
TEXT_COUNTS = union_all(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM {ORDERS} GROUP BY {c}""" for c in TEXT_COLUMNS
)


@query(
    "value_counts_topn",
    f"""SELECT "column", value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY "column"
    ORDER BY n DESC, value ASC NULLS LAST) AS rank FROM ({TEXT_COUNTS})) WHERE rank <= 3""",
)
def value_counts_topn(spark, folder):
    return pr.value_counts(table(spark, folder, "orders", ORDERS_GAPS), list(TEXT_COLUMNS), top_n=3)


PART_COUNTS = union_all(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM part GROUP BY {c}""" for c in ("p_brand", "p_type", "p_name")
)


@query(
    "rare_categories",
    f"""SELECT "column", value, n, round(n::DOUBLE / (SELECT count(*) FROM part), 6) AS share FROM ({PART_COUNTS})
    WHERE n::DOUBLE / (SELECT count(*) FROM part) < 0.05""",
)
def rare_categories(spark, folder):
    return rounded(pr.rare_categories(table(spark, folder, "part"), ["p_brand", "p_type", "p_name"]), 6, "share")


@query(
    "top_categories",
    f"""SELECT "column", value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY "column"
    ORDER BY n DESC, value) AS rank, count(*) OVER (PARTITION BY "column") AS levels
    FROM ({PART_COUNTS})) WHERE rank <= 10 AND levels <= 50""",
)
def top_categories(spark, folder):
    return pr.top_categories(table(spark, folder, "part"), ["p_brand", "p_type", "p_name"], top_n=10)


def _pairs(columns):
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


@query(
    "corr_pearson_top",
    "SELECT column_a, column_b, round(abs_corr, 6) AS abs_corr FROM ("
    + union_all(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, abs(corr({a}, {b})) AS abs_corr FROM {LINES}" for a, b in _pairs(LINE_COLUMNS)
    )
    + ") ORDER BY abs_corr DESC LIMIT 5",
)
def corr_pearson_top(spark, folder):
    return rounded(co.top_pairs(table(spark, folder, "lineitem", LINES_GAPS), top_n=5), 6, "abs_corr")


@query(
    "corr_target",
    "SELECT feature, round(corr, 6) AS corr FROM ("
    + union_all(
        f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS corr FROM {LINES}"
        for c in LINE_COLUMNS
        if c != "l_extendedprice"
    )
    + ") ORDER BY abs(corr) DESC LIMIT 3",
)
def corr_target(spark, folder):
    lines = table(spark, folder, "lineitem", LINES_GAPS)
    return rounded(co.top_target_correlations(lines, "l_extendedprice", 3), 6, "corr")


def spearman_sql(a: str, b: str, relation: str) -> str:
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(rx, ry), 6) AS corr FROM (
    SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS rx,
    rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS ry
    FROM {relation} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


SPEARMAN_PAIRS = [("l_quantity", "l_extendedprice"), ("l_tax", "l_extendedprice"), ("l_discount", "l_extendedprice")]


@query("corr_spearman", union_all(spearman_sql(a, b, LINES) for a, b in SPEARMAN_PAIRS))
def corr_spearman(spark, folder):
    return rounded(co.correlations(table(spark, folder, "lineitem", LINES_GAPS), SPEARMAN_PAIRS, "spearman"), 6, "corr")


@query(
    "corr_kendall",
    """SELECT 'c_acctbal' AS column_a, 'c_nationkey' AS column_b, round(s / sqrt((p - tx) * (p - ty)), 6) AS corr FROM
    (SELECT sum(sign(a.c_acctbal - b.c_acctbal) * sign(a.c_nationkey - b.c_nationkey)) AS s, count(*) AS p,
    count(*) FILTER (a.c_acctbal = b.c_acctbal) AS tx, count(*) FILTER (a.c_nationkey = b.c_nationkey) AS ty
    FROM customer a JOIN customer b ON a.c_custkey < b.c_custkey)""",
)
def corr_kendall(spark, folder):
    pairs = [("c_acctbal", "c_nationkey")]
    return rounded(co.correlations(table(spark, folder, "customer"), pairs, "kendall"), 6, "corr")


REVENUE = (
    "l_quantity", "l_discount", "l_tax", "l_extendedprice",
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS revenue",
)


@query(
    "select_features",
    "SELECT column_a AS feature FROM ("
    + union_all(
        spearman_sql(c, "revenue", source("lineitem", REVENUE)) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    )
    + ") WHERE abs(corr) >= 0.05",
)
def select_features(spark, folder):
    chosen = co.select_features(table(spark, folder, "lineitem", REVENUE), "revenue", 0.05)
    return spark.createDataFrame([(c,) for c in chosen], "feature string")


@query(
    "target_analysis",
    f"""SELECT 'value' AS "column", round(avg(value), 4) AS mean, round(quantile_cont(value, 0.5), 4) AS median,
    round(quantile_cont(value, 0.25), 4) AS q1, round(quantile_cont(value, 0.75), 4) AS q3,
    round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 4) AS iqr, round(stddev_samp(value), 4) AS std FROM {EVENTS}""",
)
def target_analysis(spark, folder):
    marks, _ = di.target_analysis(table(spark, folder, "events", EVENTS_GAPS), "value")
    return rounded(marks, 4, "mean", "median", "q1", "q3", "iqr", "std")


def _bin(x: str, lo: str, hi: str, bins: int) -> str:
    return f"CAST(least(floor(({x} - {lo}) / (({hi} - {lo}) / {bins}::DOUBLE)), {bins - 1}) AS INT)"


def _histogram_sql(c: str, relation: str, bins: int) -> str:
    return f"""SELECT '{c}' AS "column", bin, round(lo + bin * ((hi - lo) / {bins}), 4) AS bin_low,
    round(lo + (bin + 1) * ((hi - lo) / {bins}), 4) AS bin_high, count(*) AS n FROM (SELECT {_bin('x', 'lo', 'hi', bins)} AS bin, lo, hi
    FROM (SELECT {c}::DOUBLE AS x FROM {relation} WHERE {c} IS NOT NULL),
    (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM {relation})) GROUP BY bin, lo, hi"""


@query("histogram", union_all(_histogram_sql(c, LINES, 30) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def histogram(spark, folder):
    lines = table(spark, folder, "lineitem", LINES_GAPS)
    return rounded(di.histogram(lines, ["l_quantity", "l_extendedprice", "l_discount"]), 4, "bin_low", "bin_high")


@query(
    "histogram_centres",
    union_all(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median,
        round(stddev_samp({c}), 4) AS std FROM {LINES}"""
        for c in ("l_quantity", "l_extendedprice")
    ),
)
def histogram_centres(spark, folder):
    lines = table(spark, folder, "lineitem", LINES_GAPS)
    return rounded(di.centre_statistics(lines, ["l_quantity", "l_extendedprice"]), 4, "mean", "median", "std")


@query(
    "kde_grid",
    f"""WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
    stddev_samp(value) * count(value) ** (-0.2) AS h FROM {EVENTS}),
    g AS (SELECT CAST(i AS INT) AS point, lo + (hi - lo) * i / 59.0::DOUBLE AS x, n, h FROM range(60) r(i), s)
    SELECT point, round(x, 4) AS x, round(sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (n * h * sqrt(2 * pi())), 10)
    AS density FROM g, {EVENTS} e WHERE value IS NOT NULL GROUP BY point, x, n, h""",
)
def kde_grid(spark, folder):
    curve = di.kde(table(spark, folder, "events", EVENTS_GAPS), "value", 60)
    return curve.select("point", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"))


def _quartiles(c: str) -> str:
    return ", ".join(f"quantile_cont({c}::DOUBLE, {p}) AS {n}" for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))


def _box_sql(c: str, relation: str) -> str:
    return f"""SELECT '{c}' AS "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
    round(q1 - 1.5 * (q3 - q1), 4) AS lower, round(q3 + 1.5 * (q3 - q1), 4) AS upper, count({c}) AS n,
    count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
    round(count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / count({c}), 4) AS outlier_pct,
    CAST(count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / count({c}) > 5 AS INT) AS many_outliers
    FROM {relation}, (SELECT {_quartiles(c)} FROM {relation}) GROUP BY q1, median, q3"""


@query("box_stats", _box_sql("value", EVENTS) + " UNION ALL " + _box_sql("l_extendedprice", LINES))
def box_stats(spark, folder):
    stats = di.box_stats(table(spark, folder, "events", EVENTS_GAPS), ["value"]).unionByName(
        di.box_stats(table(spark, folder, "lineitem", LINES_GAPS), ["l_extendedprice"])
    )
    return rounded(stats, 4, "q1", "median", "q3", "iqr", "lower", "upper", "outlier_pct")


def _group_box_sql(group: str, c: str, relation: str) -> str:
    return f"""SELECT {group}, count({c}) AS n, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q1,
    round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3, max({c}) AS max
    FROM {relation} WHERE {c} IS NOT NULL GROUP BY {group}"""


@query("box_by_group", _group_box_sql("o_orderpriority", "o_totalprice", ORDERS))
def box_by_group(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS)
    return rounded(di.box_by_group(orders, "o_orderpriority", "o_totalprice"), 4, "q1", "median", "q3")


@query("class_distribution", _group_box_sql("event_type", "value", EVENTS))
def class_distribution(spark, folder):
    events = table(spark, folder, "events", EVENTS_GAPS)
    return rounded(di.relationship_with_target(events, "value", "event_type"), 4, "q1", "median", "q3")


@query(
    "fit_line",
    f"""SELECT regr_count(l_extendedprice, l_discount) AS n, round(regr_slope(l_extendedprice, l_discount), 4) AS slope,
    round(regr_intercept(l_extendedprice, l_discount), 4) AS intercept, round(regr_r2(l_extendedprice, l_discount), 8) AS r2 FROM {LINES}""",
)
def fit_line(spark, folder):
    line = di.relationship_with_target(table(spark, folder, "lineitem", LINES_GAPS), "l_discount", "l_extendedprice")
    return rounded(rounded(line, 4, "slope", "intercept"), 8, "r2")


@query(
    "crosstab_norm",
    f"""SELECT o_orderstatus, o_orderpriority, count(*) AS n,
    round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share
    FROM {ORDERS} WHERE o_orderpriority IS NOT NULL GROUP BY o_orderstatus, o_orderpriority""",
)
def crosstab_norm(spark, folder):
    orders = table(spark, folder, "orders", ORDERS_GAPS)
    return rounded(di.relationship_with_target(orders, "o_orderstatus", "o_orderpriority"), 6, "share")


@query(
    "crosstab_wide",
    f"""SELECT event_type, {', '.join(f"round(count(*) FILTER (parity = '{p}')::DOUBLE / count(*), 6) AS {p}" for p in ('even', 'odd'))}
    FROM (SELECT event_type, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM events) GROUP BY event_type""",
)
def crosstab_wide(spark, folder):
    columns = ("event_type", "CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity")
    return rounded(di.crosstab_wide(table(spark, folder, "events", columns), "event_type", "parity"), 6, "even", "odd")


@query(
    "missing_patterns",
    """SELECT concat_ws(',', CASE WHEN lang IS NULL THEN 'lang' END, CASE WHEN quality IS NULL THEN 'quality' END,
    CASE WHEN toxic IS NULL THEN 'toxic' END) AS missing_columns, count(*) AS n
    FROM (SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE lang END AS lang, quality, toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY 1""",
)
def missing_patterns(spark, folder):
    documents = table(spark, folder, "documents", ("doc_id", "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS lang"))
    return di.missing_patterns(documents.join(table(spark, folder, "labels"), "doc_id", "left").drop("doc_id"))


def _poly(x: str, coefficients) -> str:
    text = repr(coefficients[-1]) + "::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


QQ_SQL = f"""WITH o AS (SELECT value, row_number() OVER (ORDER BY value, event_id)::DOUBLE AS i, count(*) OVER ()::DOUBLE AS n
    FROM {EVENTS} WHERE value IS NOT NULL),
    p AS (SELECT value, CASE WHEN i = n THEN 0.5 ** (1 / n) WHEN i = 1 THEN 1 - 0.5 ** (1 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o),
    t AS (SELECT value, p - 0.5 AS d, 0.180625 - (p - 0.5) * (p - 0.5) AS c, sqrt(-ln(least(p, 1 - p))) AS r FROM p),
    z AS (SELECT value, CASE WHEN abs(d) <= 0.425 THEN d * {_poly('c', num.AS241_A)} / {_poly('c', num.AS241_B)}
    ELSE sign(d) * {_poly('(r - 1.6)', num.AS241_C)} / {_poly('(r - 1.6)', num.AS241_D)} END AS theoretical FROM t)"""


@query("qq_points", QQ_SQL + " SELECT value, round(theoretical, 8) AS theoretical FROM z")
def qq_points(spark, folder):
    return rounded(di.qq_points(table(spark, folder, "events", EVENTS_GAPS), "value", ["event_id"]), 8, "theoretical")


@query(
    "qq_fit",
    QQ_SQL
    + """ SELECT count(*) AS n, round(regr_slope(value, theoretical), 4) AS slope,
    round(regr_intercept(value, theoretical), 4) AS intercept, round(regr_r2(value, theoretical), 6) AS r2 FROM z""",
)
def qq_fit(spark, folder):
    line = di.qq_fit(table(spark, folder, "events", EVENTS_GAPS), "value", ["event_id"])
    return rounded(rounded(line, 4, "slope", "intercept"), 6, "r2")


@query(
    "joint_bins",
    f"""SELECT {_bin('l_quantity', 'xl', 'xh', 10)} AS bin_x, {_bin('l_extendedprice', 'yl', 'yh', 10)} AS bin_y, count(*) AS n
    FROM lineitem, (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh
    FROM lineitem) GROUP BY 1, 2""",
)
def joint_bins(spark, folder):
    return di.joint_bins(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", bins=10)


@query(
    "hexbin",
    """WITH b AS (SELECT min(o_custkey)::DOUBLE AS xl0, max(o_custkey)::DOUBLE AS xh0, min(o_totalprice) AS yl, max(o_totalprice) AS yh FROM orders),
    e AS (SELECT xl0 - 1e-9::DOUBLE * (xh0 - xl0) AS xl, xh0 + 1e-9::DOUBLE * (xh0 - xl0) AS xh, yl, yh FROM b),
    s AS (SELECT xl, yl, (xh - xl) / 30 AS sx, (yh - yl) / 17 AS sy FROM e),
    u AS (SELECT (o_custkey - xl) / sx AS u, (o_totalprice - yl) / sy AS v, xl, yl, sx, sy FROM orders, s),
    c AS (SELECT *, (u - round_even(u, 0)) ** 2 + 3 * (v - round_even(v, 0)) ** 2
    < (u - (floor(u) + 0.5)) ** 2 + 3 * (v - (floor(v) + 0.5)) ** 2 AS corner FROM u)
    SELECT round(CASE WHEN corner THEN round_even(u, 0) ELSE floor(u) + 0.5 END * sx + xl, 4) AS hex_x,
    round(CASE WHEN corner THEN round_even(v, 0) ELSE floor(v) + 0.5 END * sy + yl, 4) AS hex_y, count(*) AS n FROM c GROUP BY 1, 2""",
)
def hexbin(spark, folder):
    return rounded(di.hexbin(table(spark, folder, "orders"), "o_custkey", "o_totalprice"), 4, "hex_x", "hex_y")


@query(
    "confusion_matrix",
    """WITH c AS (SELECT DISTINCT quality AS k FROM labels UNION SELECT DISTINCT toxic FROM labels)
    SELECT a.k AS actual, p.k AS predicted, (SELECT count(*) FROM labels WHERE quality = a.k AND toxic = p.k) AS n FROM c a, c p""",
)
def confusion_matrix(spark, folder):
    return ev.confusion_matrix(table(spark, folder, "labels"), "quality", "toxic", dense_classes=100)


ROC = """WITH r AS (SELECT quality, n_chars::DOUBLE AS s FROM labels JOIN documents USING (doc_id)),
    g AS (SELECT s, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality <> 1) AS neg FROM r GROUP BY s),
    c AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM g)"""


@query(
    "roc_curve",
    ROC
    + """ SELECT s AS threshold, round(tp / sum(pos) OVER ()::DOUBLE, 6) AS tpr, round(fp / sum(neg) OVER ()::DOUBLE, 6) AS fpr,
    tp::BIGINT AS tp, fp::BIGINT AS fp FROM c""",
)
def roc_curve(spark, folder):
    return rounded(ev.roc_curve(_labelled(spark, folder), "quality", "n_chars").drop("pos", "neg"), 6, "tpr", "fpr")


@query(
    "roc_auc",
    ROC
    + """ SELECT round(sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg))::DOUBLE, 6) AS auc, sum(pos)::BIGINT AS n_pos,
    sum(neg)::BIGINT AS n_neg FROM c""",
)
def roc_auc(spark, folder):
    return rounded(ev.roc_auc(_labelled(spark, folder), "quality", "n_chars"), 6, "auc")


def _labelled(spark, folder):
    return table(spark, folder, "labels").join(table(spark, folder, "documents", ("doc_id", "n_chars")), "doc_id")
