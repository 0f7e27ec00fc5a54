"""Merkle manifest of a table, with nested-interval labels.

Leaves are row digests, ranked by id within their source. Every node carries the interval [lo, hi) of leaf ranks that it
covers. A node of level n covers at most 16^n leaves, so the node of a level that can contain an interval is found by the bucket
lo div 16^n: ancestors are attached by a join on group, level bucket and containment of intervals. A node keeps its children's
intervals and digests; the interval of the parent without the node's own leaves the siblings, those before it and those after it.

A node's siblings with those of all its ancestors are its path. Paths are attached from the top down, so a leaf takes its path
from its run of sixteen, and what is stored per run is shared by sixteen rows. The subroots are the leaves of one more tree.

Only digests and ids are shuffled. Ranks come from one range sort by source, id and digest: no window and no task sees a
whole source. Sources of any number and size are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.lookups import attach
from ..session import stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = "doc_id IS NOT NULL AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0"
PATH = "array<struct<before: array<string>, after: array<string>>>"


def leaf_digest(fields: dict[str, Column]) -> Column:
    """sha256 of the row's fields: ``-`` if missing, else UTF-8 byte count, colon, value."""
    parts = []
    for c in fields.values():
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def hashed(digests: Column) -> Column:
    """sha256 of the digests' hex texts, one after another."""
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


def folded(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``lo``, the rank within the group by ``order``, and ``n``, the rows of the group; stored.

    Rows are range-partitioned and sorted, so a row's place in its task is known where it is written. Places become ranks with
    the counts per task and group, of which there are no more than tasks and groups together.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    placed = stored(placed.withColumn("_task", F.shiftright(at, 33)).withColumn("_place", at.bitwiseAND(F.lit((1 << 33) - 1))))
    parts = placed.groupBy(group, "_task").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    # windows over one row per task that holds the group
    whole = Window.partitionBy(group)
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        group, "_task", F.sum("_n").over(whole).alias("n"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    joined = placed.join(shifts, [group, "_task"])
    return joined.select(*rows.columns, "n", (F.col("_place") + F.col("_shift")).alias("lo"))


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of ``level`` above those of the level below; a group of one node passes it on."""
    width = FAN**level
    carried = [c for c in nodes.columns if c not in ("group", "n", "level")]
    runs = nodes.groupBy("group", "n", F.expr(f"lo div {width}").alias("bucket")).agg(F.sort_array(F.collect_list(F.struct(*carried))).alias("children"))
    lone = F.col("n") <= FAN ** (level - 1)
    return runs.select(
        "group", "n", F.lit(level).alias("level"), "bucket", F.element_at("children", 1)["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
        F.when(lone, F.element_at("children", 1)["digest"]).otherwise(hashed(F.col("children.digest"))).alias("digest"), "children",
    )


def _steps(lo: str, hi: str, children: str) -> Column:
    """The parent's interval without the node's own: digests of the siblings before and after it."""
    return F.expr(
        f"struct(transform(filter({children}, c -> c.hi <= {lo}), c -> c.digest) AS before, "
        f"transform(filter({children}, c -> c.lo >= {hi}), c -> c.digest) AS after)"
    )


def manifest_tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``group, n, lo, digest, ...`` to (runs, roots).

    ``runs`` are the level-1 nodes, whose children hold what the leaves carry, with ``path``: the steps of the run's own
    siblings and its ancestors' ones, lowest first. ``roots`` has group, n, digest.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    level = stored(_parents(leaves.withColumn("hi", F.col("lo") + 1).select("group", "n", "lo", "hi", *[c for c in leaves.columns if c not in ("group", "n", "lo")]), 1))
    levels = [level]
    while FAN ** len(levels) < most:
        # groups that already have their root stay behind
        going = levels[-1].where(F.col("n") > FAN ** len(levels)).select("group", "n", "lo", "hi", "digest")
        levels.append(stored(_parents(going, len(levels) + 1)))
    none = F.expr(f"CAST(array() AS {PATH})")
    roots, above = None, None
    for number in range(len(levels), 0, -1):
        own = levels[number - 1]
        top = own.where(F.col("n") <= FAN**number)
        tips = top.select("group", "n", "digest")
        roots = tips if roots is None else roots.unionByName(tips)
        found = top.withColumn("path", none)
        if above is not None:
            p = above.select(*[F.col(c).alias(f"_{c}") for c in ("group", "bucket", "lo", "hi", "children", "path")])
            inside = (F.col("group") == F.col("_group")) & (F.expr(f"lo div {FAN ** (number + 1)}") == F.col("_bucket"))
            inside = inside & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            below = own.where(F.col("n") > FAN**number).join(p, inside)
            steps = F.concat(F.array(_steps("lo", "hi", "_children")), F.col("_path"))
            found = found.unionByName(below.select(*own.columns, steps.alias("path")))
        above = stored(found) if number > 1 else found
    return above, roots


def manifest(
    docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", fields=FIELDS, tampered: str = TAMPERED, text: str = "text"
) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves lie by id (missing ids first, repeated ids by digest; equal rows are equal leaves), sources bytewise with missing
    first. ``tampered`` is SQL over the row that says where the leaf to verify is made of a text with A-Z lower-cased. A lone leaf is
    its source's subroot, and a lone subroot the root; their proofs have no digests. An empty table gives no rows.
    """
    cells = {c: F.col(f"`{c}`") for c in fields}
    changed = {**cells, text: folded(cells[text])}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0")).alias("group"), F.col(doc_id).alias("doc_id"),
        leaf_digest(cells).alias("digest"), F.when(F.expr(tampered), leaf_digest(changed)).alias("other"),
    )
    runs, subroots = manifest_tree(ranked(rows, "group", ["doc_id", "digest"]))
    subroots = stored(subroots)
    tops = subroots.select(F.lit("").alias("group"), F.col("group").alias("source"), F.col("n").alias("leaves"), "digest")
    top_runs, root = manifest_tree(ranked(tops, "group", ["source"]))
    tips = top_runs.withColumn("own", F.explode("children")).select(
        F.col("own.source").alias("group"), F.col("own.digest").alias("subroot"), _leaf_path().alias("top_path"), F.ceil(F.col("own.leaves") / FAN).alias("_runs")
    )
    tips = stored(tips.join(F.broadcast(root.select(F.col("digest").alias("root")))))  # the root is one row
    n_runs = tips.agg(F.sum("_runs")).first()[0] or 0
    each = attach(runs, tips, "group", rows=n_runs, weight="_runs").withColumn("own", F.explode("children"))
    each = each.withColumn("steps", F.concat(_leaf_path(), "top_path"))
    fold = "aggregate(steps, coalesce(own.other, own.digest), (a, s) -> sha2(CAST(concat(array_join(s.before, ''), a, array_join(s.after, '')) AS BINARY), 256))"
    siblings = "array_join(transform(steps, s -> concat(array_join(s.before, ''), array_join(s.after, ''))), '')"
    return each.select(
        F.col("own.doc_id").alias("doc_id"), F.col("own.digest").alias("leaf"), "subroot", "root",
        F.expr(f"sha2(CAST({siblings} AS BINARY), 256)").alias("proof_sha256"), F.expr(fold).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_path() -> Column:
    """The path of the leaf ``own`` of a run: its own step, then the run's; a lone leaf has none."""
    return F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array(_steps("own.lo", "own.hi", "children")), "path"))
