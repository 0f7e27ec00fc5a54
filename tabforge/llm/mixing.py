"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

Sources lie in code point order (missing last) and weigh 1, 2, 3, 1, 2, 3, ... of all words. A target stops at
three times its source's size; what is cut off is shared again by weight until no target is above.

The documents of a source are dealt into shards by a hash of their id, and lie in each shard in hash order. A
shard is cut into equal blocks of about ``block_words`` words. The apportionment gives every shard an integer
quota of blocks, by highest quotients votes / (2 seats + 1), where a shard's votes are the blocks that its part
of the target amounts to and a shard takes at most three rounds of its blocks. A shard then takes all of its
blocks as often as the quota allows, and the rest as a run of blocks that begins at a seeded block and may go
round; so documents stay whole but for the two ends of a run, and reruns agree.

Only the words per document, then per shard, are ever shuffled; texts are not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import key_hash
from ..session import stored
from .words import SPACE_BYTE, flat, slices

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 64
SHARD_WORDS = 200_000
SEED = 17


def _pieces(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every run of non-space bytes, and per text the index of its first run (one more at the end)."""
    inside = ~SPACE_BYTE[data]
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    start = np.flatnonzero(inside & (first[:-1] | ~np.concatenate(([False], inside[:-1]))))
    return start, np.searchsorted(start, begins)


def sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """doc_id, source, size of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sizes = [np.zeros(0, np.int64)]
            for _, _, data, begins in slices(batch.column(2)):
                sizes.append(np.diff(_pieces(data, begins)[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(sizes), pa.int64())], names=["doc_id", "source", "size"])

    return docs.select(doc_id, F.col(source).cast("string"), text).mapInArrow(run, f"doc_id {kind}, source string, size long")


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 0, in code point order with missing last; no task sees all sources."""
    spread = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    before, offsets = 0, {}
    for row in sorted(spread.groupBy("_part").count().collect()):  # one row per task that wrote
        offsets[row["_part"]] = before
        before += row["count"]
    if not offsets:
        return spread.select(*sources.columns, F.lit(0).cast("long").alias("place"))
    shift = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    inside = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    return spread.select(*sources.columns, (F.row_number().over(inside) - 1 + shift[F.col("_part")]).cast("long").alias("place"))


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> with ``target``: weights share all words, no target above ``most`` sizes."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(ranked(sources).withColumn("weight", weight))
    cap = F.col("source_size") * float(most)
    total = table.agg(F.sum("source_size").cast("double")).first()[0] or 0.0
    each, capped = 0.0, -1
    while True:  # words per unit of weight; it grows, so a capped source stays capped
        above = F.col("weight") * each >= cap
        row = table.agg(F.count_if(above).alias("n"), F.sum(F.when(above, cap).otherwise(0.0)).alias("held"), F.sum(F.when(~above, F.col("weight")).otherwise(0.0)).alias("free")).first()
        if row["n"] == capped or not row["free"]:
            break
        capped, each = row["n"], (total - row["held"]) / row["free"]
    return table.select("source", "source_size", F.least(cap, F.col("weight") * each).alias("target") if capped >= 0 else cap.alias("target"))


def apportion(parties: DataFrame, seats: int, *, key: list[str], votes: str = "votes", cap: str = "cap") -> DataFrame:
    """Adds ``quota``: ``seats`` seats by highest quotients votes / (2 k + 1), at most ``cap`` each.

    A party whose quotients are above a divisor d holds round(votes / d) seats. One job tries many divisors at once;
    each narrows the range until the seats fit, and seats that tie there go by quotient and key.
    """
    full = F.col(cap).cast("long")
    held = lambda d: F.least(full, F.ceil(F.col(votes) / (2.0 * F.lit(d)) - 0.5).cast("long"))  # noqa: E731  quotients above 2d
    possible, top = parties.agg(F.coalesce(F.sum(F.when(F.col(votes) > 0, full)), F.lit(0)), F.coalesce(F.max(votes), F.lit(0.0))).first()
    seats = min(seats, possible)
    if seats <= 0:
        return parties.withColumn("quota", F.lit(0).cast("long"))
    low, high = 0.0, float(top) + 1.0  # at high nobody has a seat, at low all have their cap
    given = 0
    while True:
        tries = [x for x in np.linspace(low, high, 66)[1:-1].tolist() if low < x < high]
        if not tries:
            break
        got = parties.agg(*[F.sum(held(d)).alias(f"_{i}") for i, d in enumerate(tries)]).first()
        for d, n in zip(tries, got):
            if n <= seats:
                high, given = d, n
                break
            low = d
        if given == seats:
            break
    with_seats = parties.withColumn("quota", F.greatest(F.lit(0), held(high)).cast("long"))
    if given == seats:
        return with_seats
    # quotients that tie at the last divisor: fewer than the parties that tie
    following = F.col(votes) / (2 * F.col("quota") + 1)
    tied = with_seats.where(F.col("quota") < full).orderBy(following.desc(), *key).limit(seats - given).select(*[F.col(k).alias(f"_{k}") for k in key], F.lit(1).alias("_more"))
    match = F.lit(True)
    for k in key:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return with_seats.join(tied, match, "left").withColumn("quota", F.col("quota") + F.coalesce("_more", F.lit(0))).drop("_more", *[f"_{k}" for k in key])


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(b, d) - F.greatest(a, c))


def mixed(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, most: int = MOST,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, taken, rounds, and the runs taken beyond whole rounds.

    ``taken`` = ``rounds`` * size + the words of runs [begin1, end1) and [begin2, end2), counted from the document's
    first word. Documents without words take none; rows that repeat an id lie next to each other in their shard.
    """
    size_of = stored(sized(docs, doc_id, text, source))
    by_source = size_of.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = stored(targets(by_source, weights, most))
    place = key_hash("doc_id", seed)
    null_safe = F.col("source").eqNullSafe(F.col("_source"))
    aimed = size_of.join(aims.withColumnRenamed("source", "_source"), null_safe).drop("_source")
    dealt = aimed.withColumn("_at", place).withColumn(
        "shard", F.pmod(F.col("_at"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / shard_words)))
    )
    shards = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    ).withColumn("blocks", F.ceil(F.col("words") / block_words).cast("long"))
    parties = stored(shards.withColumns({
        "votes": F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0),
        "cap": F.col("blocks") * most,
    }))
    seats = parties.agg(F.round(F.sum("votes")).cast("long")).first()[0] or 0
    quotas = apportion(parties, seats, key=["source", "shard"])
    n, first = F.col("blocks"), F.pmod(key_hash(["source", "shard"], seed), F.greatest(F.lit(1).cast("long"), F.col("blocks")))
    rest = F.pmod(F.col("quota"), n)
    word_at = lambda block: F.floor(block * F.col("words") / n).cast("long")
    none = F.lit(0).cast("long")
    runs = quotas.where("blocks > 0").select(
        F.col("source").alias("_s"), F.col("shard").alias("_h"), F.floor(F.col("quota") / n).cast("long").alias("rounds"),
        word_at(first).alias("_from"), word_at(F.least(n, first + rest)).alias("_to"), word_at(F.greatest(none, first + rest - n)).alias("_again"),
    )
    inside = Window.partitionBy("source", "shard").orderBy("_at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = dealt.withColumn("_begin", F.coalesce(F.sum("size").over(inside), none))
    joined = laid.join(runs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")), "left")
    begin, end = F.col("_begin"), F.col("_begin") + F.col("size")
    cut = lambda x: F.greatest(none, F.least(F.col("size"), F.coalesce(x, none) - begin))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("rounds", none).alias("rounds"),
        cut(none).alias("begin2"), cut(F.col("_again")).alias("end2"), cut(F.col("_from")).alias("begin1"), cut(F.col("_to")).alias("end1"),
    ).withColumn("taken", F.col("rounds") * F.col("size") + F.col("end1") - F.col("begin1") + F.col("end2") - F.col("begin2"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document as often as it is taken whole, and its taken runs of words.

    A text taken whole stays as it is; a run keeps the text from its first word to its last. Documents of which
    nothing is taken are left out.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    plan = mixed(docs, **options).where("taken > 0").select(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "rounds", "begin1", "end1", "begin2", "end2"
    )
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("begin"), F.col("_size").alias("end")), F.col("rounds").cast("int"))
    # a run that goes round may meet itself in one document: its two parts are separate rows
    runs = F.array(F.struct(F.col("begin2").alias("begin"), F.col("end2").alias("end")), F.struct(F.col("begin1").alias("begin"), F.col("end1").alias("end")))
    parts = plan.withColumn("_runs", F.concat(whole, F.filter(runs, lambda r: r["end"] > r["begin"])))
    # of rows that repeat an id, each pairs with one row of the plan
    same_id = Window.partitionBy("_id", "_size").orderBy("rounds", "begin1", "begin2", "end1", "end2")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    size = F.size(F.filter(F.split(F.col("row").getField(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    numbered = parts.select("_id", "_size", "_runs", F.row_number().over(same_id).alias("_nth"))
    keyed = docs.select(row.alias("row")).select("row", F.col("row").getField(doc_id).alias("_own"), F.coalesce(size, F.lit(0)).cast("long").alias("_words"))
    keyed = keyed.withColumn("_row", F.row_number().over(Window.partitionBy("_own", "_words").orderBy(F.xxhash64("row"))))
    joined = keyed.join(numbered, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size")) & (F.col("_row") == F.col("_nth")))
    taken = joined.select("row", F.explode("_runs").alias("run"))
    return _cut_texts(taken, text, docs.schema)


def _cut_texts(taken: DataFrame, text: str, schema) -> DataFrame:
    """The rows with their texts cut to the runs of words."""
    at = schema.names.index(text)

    def run(batches):
        for batch in batches:
            columns, runs = batch.column(0).flatten(), batch.column(1).to_pylist()
            out = []
            for one, run in zip(columns[at].to_pylist(), runs):
                start, count = _pieces(*flat(pa.array([one], pa.string())))
                b, e = run["begin"], run["end"]
                if b == 0 and e >= count[1]:
                    out.append(one)
                else:
                    raw = one.encode()
                    out.append(raw[start[b] : start[e] if e < len(start) else len(raw)].decode().rstrip(" \t\n\v\f\r"))
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return taken.mapInArrow(run, schema)
