"""The queries of these operators over the documents and pages, with SQL statements where SQL can state them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir
from .licenses import DRIFT, SHARE, gram_rows
from .quality import BUCKETS, LEAST_WORDS, LOSE, MARGIN, MOST_REPEATED, PAIR, SPREAD
from .words import ODD

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SPACES = "'[\\x20\\x09-\\x0D]+'"
WORD_LISTS = """
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents"""


@query("op7_exact_dedup", f"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), {SPACES}, ' ', 'g') AS c FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY c) AS keep_id, count(*) OVER (PARTITION BY c) AS group_size,
        doc_id = min(doc_id) OVER (PARTITION BY c) AS kept, sha256(c) AS text_sha256 FROM t""")
def exact_dedup(spark, folder):
    from .exact import exact_copies

    return exact_copies(table(spark, folder, "documents"))


@query("op9_benchmark_decontamination", f"""
    WITH d AS ({WORD_LISTS}),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    sizes AS (SELECT DISTINCT least(len(w), 13) AS n FROM b WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
        FROM b, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS r(i) WHERE len(w) > 0),
    grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
    hits AS (SELECT doc_id, item_id, g.n, i FROM grams g JOIN windows USING (n, g)),
    places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""")
def benchmark_decontamination(spark, folder):
    from .contamination import contaminated_words, is_contaminated

    found = contaminated_words(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


HASHED = "CAST('0x' || substr(md5(concat_ws(':', {}, '17')), 1, 13) AS BIGINT)"


@query("op5_source_mixing", f"""
    WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
    src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS w FROM s GROUP BY source),
    caps AS (SELECT *, 3.0::DOUBLE * source_size AS cap FROM src),
    steps AS (SELECT *, (SELECT sum(source_size)::DOUBLE FROM src) - coalesce(sum(cap) OVER before, 0) AS room,
        sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
        FROM caps WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT room / rest AS e FROM steps WHERE room / rest <= cap / w ORDER BY cap / w LIMIT 1),
    aims AS (SELECT source, source_size, least(cap, w * (SELECT e FROM level)) AS target FROM caps),
    dealt AS (SELECT doc_id, size, source_size, target, source, place, place % CAST(greatest(1, ceil(source_size / 200000)) AS BIGINT) AS shard
        FROM (SELECT *, {HASHED.format("coalesce(CAST(doc_id AS VARCHAR), '')")} AS place FROM s) JOIN aims USING (source)),
    shards AS (SELECT source, shard, sum(size) AS words, CAST(ceil(sum(size) / 64) AS BIGINT) AS blocks, first(target) AS target, first(source_size) AS source_size
        FROM dealt GROUP BY source, shard),
    parties AS (SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS votes FROM shards),
    seats AS (SELECT source, shard FROM (SELECT source, shard, row_number() OVER (ORDER BY votes / (2 * k + 1) DESC, source, shard) AS nth
        FROM parties, unnest(range(3 * blocks)) AS r(k)) WHERE nth <= (SELECT round(sum(votes)) FROM parties)),
    quotas AS (SELECT source, shard, words, blocks, (SELECT count(*) FROM seats q WHERE q.source = p.source AND q.shard = p.shard) AS quota,
        {HASHED.format("coalesce(source, ''), shard")} % greatest(1, blocks) AS f FROM parties p),
    runs AS (SELECT source, shard, quota // blocks AS rounds, CAST(floor(f * words / blocks) AS BIGINT) AS a,
        CAST(floor(least(blocks, f + quota % blocks) * words / blocks) AS BIGINT) AS b,
        CAST(floor(greatest(0, f + quota % blocks - blocks) * words / blocks) AS BIGINT) AS c FROM quotas WHERE blocks > 0),
    laid AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS p FROM dealt)
    SELECT doc_id, size, source_size, target, CAST(coalesce(rounds * size + greatest(0, least(p + size, b) - greatest(p, a)) + greatest(0, least(p + size, c) - p), 0) AS BIGINT) AS taken
    FROM laid LEFT JOIN runs USING (source, shard)""")
def source_mixing(spark, folder):
    from .mixing import mixed

    return mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_token_output")
def token_output(spark, folder):
    from .tokens import token_index

    return token_index(table(spark, folder, "documents"))


@query("op6_token_counts")
def token_counts(spark, folder):
    from .separators import FILE_SCHEMA, document_counts, write_flat

    flat_files = f"{checkpoint_dir(spark)}/flat-{uuid.uuid4().hex}"
    write_flat(table(spark, folder, "documents"), flat_files)
    return document_counts(spark.read.schema(FILE_SCHEMA).parquet(flat_files))


def _license_sql() -> str:
    grams = ", ".join(
        f"({t}, '{label}', {base}, {place}, {n_grams}, {size}, '{gram}')"
        for gram, t, label, base, place, _, n_grams, size in gram_rows()
    )
    return f"""
    WITH d AS ({WORD_LISTS}), t(template, label, base, place, n_grams, size, g) AS (VALUES {grams}),
    sizes AS (SELECT DISTINCT size FROM t),
    own AS (SELECT doc_id, size, i - 1 AS spot, array_to_string(w[i:i + size - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS r(i)),
    lines AS (SELECT doc_id, template, label, base, n_grams, spot - place AS diagonal, count(DISTINCT place) AS votes, min(spot) AS a
        FROM own JOIN t USING (size, g) GROUP BY ALL),
    marked AS (SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER same > {DRIFT}, true) THEN 1 ELSE 0 END AS fresh
        FROM lines WINDOW same AS (PARTITION BY doc_id, template ORDER BY diagonal)),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS part FROM marked),
    spans AS (SELECT doc_id, label, base, least(1.0, sum(votes) / n_grams)::DOUBLE AS score, min(a) AS a FROM numbered GROUP BY doc_id, template, label, base, n_grams, part),
    good AS (SELECT * FROM spans WHERE score >= CASE WHEN base THEN 1.0 ELSE {SHARE} END)
    SELECT doc_id, CAST(any_value(len(w)) AS BIGINT) AS n_words, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word, max(a) FILTER (base) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0) AS score
    FROM d LEFT JOIN good USING (doc_id) GROUP BY doc_id"""


@query("op2_license_scan", _license_sql())
def license_scan(spark, folder):
    from .licenses import license_summary

    return license_summary(table(spark, folder, "documents")).drop("spans")


@query("op8_toxicity")
def toxicity_chain(spark, folder):
    from .toxicity import fit_chain, toxicity

    docs = table(spark, folder, "documents")
    return toxicity(docs, fit_chain(docs, table(spark, folder, "labels")))


@query("op10_language_id")
def language_id(spark, folder):
    from .language import fit_field, held_out, languages

    docs = table(spark, folder, "documents")
    field = fit_field(docs.where(~held_out()))
    return languages(docs, field).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op4_near_dedup")
def near_dedup(spark, folder):
    from .near import near_classes

    return near_classes(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size", "kept", "n_shingles")


@query("op1_html_text")
def html_text(spark, folder):
    from .html import extract_text

    return extract_text(table(spark, folder, "pages"))


TWO_64 = 1 << 64
WORD = f"list_reduce(list_transform(list_reverse(regexp_extract_all(hex(encode(g)), '..')), lambda b: CAST('0x' || b AS INTEGER)::UHUGEINT + 1), lambda a, b: (a * {ODD} + b) % {TWO_64})"


@query("op12_quality_rules", f"""
    WITH d AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    codes AS (SELECT g, {WORD} AS h FROM (SELECT DISTINCT unnest(w) AS g FROM d)),
    words AS (SELECT nr, i, w[i] AS g FROM d, unnest(range(1, len(w) + 1)) AS r(i)),
    hashed AS (SELECT nr, h, lead(h) OVER (PARTITION BY nr ORDER BY i) AS following FROM words JOIN codes USING (g)),
    grams AS (SELECT nr, h AS k FROM hashed UNION ALL SELECT nr, (h * {PAIR} + following) % {TWO_64} FROM hashed WHERE following IS NOT NULL),
    cells AS (SELECT nr, k * {SPREAD} % {TWO_64} // {TWO_64 // BUCKETS} AS bucket, count(*)::DOUBLE AS n FROM grams GROUP BY ALL),
    sizes AS (SELECT nr, sum(n) AS size, nr IN (SELECT nr FROM d WHERE doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1)) AS good FROM cells GROUP BY nr),
    sums AS (SELECT bucket, sum(n) AS r, coalesce(sum(n) FILTER (good), 0) AS t FROM cells JOIN sizes USING (nr) GROUP BY bucket),
    whole AS (SELECT sum(r) AS all_r, sum(t) AS all_t FROM sums),
    scores AS (SELECT nr, any_value(good) AS good,
        sum(n * ln((t + 1) / ((r - n) * (all_t / greatest(all_r - size, 1)) + 1))) / any_value(size) AS score,
        sum(n * ln((t - n + 1) / ((r - n) * ((all_t - size) / greatest(all_r - size, 1)) + 1))) FILTER (good) / any_value(size) AS left_out
        FROM cells JOIN sizes USING (nr) JOIN sums USING (bucket), whole GROUP BY nr),
    least AS (SELECT {1 + MARGIN} * quantile_cont(left_out, {LOSE}) - {MARGIN} * quantile_cont(left_out, 0.5) AS threshold FROM scores WHERE good),
    windows AS (SELECT nr, i, array_to_string(w[i:i + 7], ' ') AS g FROM d, unnest(range(1, len(w) - 6)) AS r(i)),
    again AS (SELECT nr, i FROM (SELECT nr, i, count(*) OVER (PARTITION BY nr, g) AS n FROM windows) WHERE n > 1),
    places AS (SELECT nr, count(DISTINCT p) AS n_repeat_words FROM again, unnest(range(i, i + 8)) AS r(p) GROUP BY nr),
    lines AS (SELECT nr, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT nr, unnest(string_split(x, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY nr),
    base AS (SELECT nr, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda g: length(g))), 0)::BIGINT AS word_chars,
        length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM d LEFT JOIN lines USING (nr) LEFT JOIN places USING (nr)),
    ruled AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND coalesce(score >= (SELECT threshold FROM least), true) AS kept FROM ruled LEFT JOIN scores USING (nr)""")
def quality_rules(spark, folder):
    from .quality import fit_model, judged

    docs = table(spark, folder, "documents")
    return judged(docs, fit_model(docs, table(spark, folder, "labels"))).drop("score")


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """Statements of a tree over ``leaves(g, n, i, d)``: nodes {name}0.. by level, siblings {name}s1.. before (b) and after (a)."""
    out = [f"{name}0 AS (SELECT g, n, i, d FROM {leaves})"]
    for k in range(1, levels + 1):
        low = 16 ** (k - 1)
        out.append(
            f"{name}{k} AS (SELECT g, n, i // 16 AS i, CASE WHEN n <= {low} THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY {name}{k - 1}.i)) END AS d"
            f" FROM {name}{k - 1} GROUP BY g, n, i // 16)")
        out.append(
            f"{name}s{k} AS (SELECT x.g, x.i, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS b,"
            f" coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS a"
            f" FROM {name}{k - 1} x JOIN {name}{k - 1} y ON x.g = y.g AND x.i // 16 = y.i // 16 WHERE x.n > {low} GROUP BY x.g, x.i)")
    return ", ".join(out)


def _fold_sql(name: str, source: str, levels: int) -> str:
    """Statements {name}1.. that carry (proof, f) of ``source(g, i, proof, f, ...)`` up the tree {name}."""
    return ", ".join(
        f"{name}f{k} AS (SELECT c.* REPLACE (c.proof || coalesce(s.b || s.a, '') AS proof, CASE WHEN s.b IS NULL THEN c.f ELSE sha256(s.b || c.f || s.a) END AS f)"
        f" FROM {source if k == 1 else f'{name}f{k - 1}'} c LEFT JOIN {name}s{k} s ON c.{name}g = s.g AND c.{name}i // {16 ** (k - 1)} = s.i)"
        for k in range(1, levels + 1))


def _manifest_sql(levels: int = 7, top: int = 3) -> str:
    cell = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    row = lambda text: "sha256(" + " || ".join(map(cell, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "list_reduce([xor(p, q), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda p, q: {step}), 4294967295)"
    return f"""
    WITH rows AS (SELECT doc_id, coalesce('1' || source, '0') AS g, {row('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {row(low)} ELSE {row('text')} END AS other FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM rows),
    {_tree_sql("t", "(SELECT g, n, i, leaf AS d FROM leaves)", levels)},
    subroots AS (SELECT g AS source, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t{levels}),
    {_tree_sql("u", "(SELECT '' AS g, n, i, subroot AS d FROM subroots)", top)},
    starts AS (SELECT doc_id, leaf, subroot, g AS tg, leaves.i AS ti, '' AS ug, s.i AS ui, '' AS proof, other AS f FROM leaves JOIN subroots s ON g = source),
    {_fold_sql("t", "starts", levels)}, {_fold_sql("u", f"tf{levels}", top)}
    SELECT doc_id, leaf, subroot, u{top}.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u{top}.d AS verified FROM uf{top}, u{top}"""


@query("op11_merkle_manifest", _manifest_sql())
def merkle_manifest(spark, folder):
    from .merkle import manifest

    return manifest(table(spark, folder, "documents"))


@query("op13_periodic_runs")
def word_runs(spark, folder):
    from .runs import periodic_runs, repeated_tail, run_summary

    return run_summary(periodic_runs(table(spark, folder, "documents"), tail=repeated_tail))
