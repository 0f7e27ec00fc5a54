"""Near-duplicate classes by BagMinHash over bags of five-word shingles.

The weighted Jaccard similarity of two texts is the overlap of their bags of shingles: sum of the smaller counts over
the sum of the larger. A signature has ``m`` components, each the first point of a Poisson process over the bag: a
shingle of weight w has its points on the levels 0 to w - 1, discretised in dyadic blocks [0, 1), [1, 2), [2, 4), ...
A block is one process with the block's length as rate, whose points are spread over its levels; a point counts when
its level is below w. So a shingle costs a process per doubling of its weight, two texts share the points of what
their bags share, and a component agrees with a probability equal to the similarity. Points come in ascending order, so
a process ends as soon as its next point lies beyond the largest component.

Steps: copies (equal word sequences) become one vertex; bands of components bucket the vertices; each bucket compares
all its members with one leader (the member with most company over all bands), never all pairs, and the bags decide.
Connected verified links make components. Buckets whose members are still in several components then compare the pairs
across components, in blocks of bounded size: first their signatures, then the lowest numbers of their bags (the whole
bag of a text of up to 512 shingles), and whole bags decide again. So a link that a leader does not show is found, and
pairs that are not alike are dropped inside the task that sees them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .words import ODD, Words, gram, mix, slices, unused

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 5  # a link of similarity 0.8 is missed with probability 1.5e-5
SLACK = 4.0  # standard deviations below the wanted similarity at which signatures rule a pair out
CHUNK = 2_000
SAMPLE = 512  # lowest numbers of a bag that stand for it before whole bags are compared
POINTS = 1 << 17
TEXT_BYTES = 2 << 20  # of whole texts that a task signs at once
U = np.uint64


# ---- bags and signatures ---------------------------------------------------------------------------------------------


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle hash) in order of text; a text of fewer words, but not none, is one shingle."""
    hashes = words.hashes()
    at, found = words.grams(hashes, k)
    text = np.searchsorted(words.first, at, side="right") - 1
    for n in range(1, k):
        short = np.flatnonzero(words.count == n)
        if len(short):
            text = np.concatenate((text, short))
            found = np.concatenate((found, mix(gram(hashes, words.first[short], n) + U(n))))
    return text, found


def bags(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), by text and hash."""
    text, found = shingles(words, k)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    at = np.flatnonzero(fresh)
    return text[at], found[at], np.diff(np.concatenate((at, [len(text)])))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """n_texts x m first points (32-bit floats as integers); texts without shingles keep infinity."""
    h = np.full(n_texts * m, np.inf)
    procs = []
    for block in range(int(weight.max()).bit_length() + 1 if len(weight) else 0):
        low = 0 if block == 0 else 1 << (block - 1)
        has = np.flatnonzero(weight > low)
        if not len(has):
            break
        length = max(1, low)
        procs.append((text[has], mix(shingle[has] ^ U((block + 1) * 0xD1342543DE82EF95 % (1 << 64))), np.full(len(has), length), np.minimum(weight[has] - low, length)))
    if not procs:
        return h.reshape(n_texts, m).astype(np.float32).view(np.uint32)
    doc, seed, length, open_levels = (np.concatenate(x) for x in zip(*procs))
    x, number = np.zeros(len(doc)), np.zeros(len(doc), U)
    most = np.full(n_texts, np.inf)
    while len(doc):
        k = int(np.clip(POINTS // len(doc), 1, 128))
        draw = mix(seed[:, None] + (number[:, None] + np.arange(1, k + 1, dtype=U)) * U(ODD))
        gap = -np.log((draw >> U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / length[:, None]
        points = x[:, None] + np.cumsum(gap, axis=1)
        second = mix(draw)
        counts = points <= most[doc][:, None]
        whole = open_levels >= length
        if not whole.all():
            level = (second >> U(32)) * length[:, None].astype(U) >> U(32)
            counts &= whole[:, None] | (level < open_levels[:, None].astype(U))
        place = doc[:, None] * m + ((second & U(0xFFFFFFFF)) * U(m) >> U(32)).astype(np.int64)
        np.minimum.at(h, place[counts], points[counts])
        x, number = points[:, -1], number + U(k)
        own = np.unique(doc)
        most[own] = h.reshape(n_texts, m)[own].max(axis=1)
        alive = x <= most[doc]
        doc, seed, length, open_levels, x, number = (v[alive] for v in (doc, seed, length, open_levels, x, number))
    return h.reshape(n_texts, m).astype(np.float32).view(np.uint32)


def _contents(words: Words) -> np.ndarray:
    """Two 64-bit hashes of each text's word sequence; of its bytes if it has no words."""
    hashes, out = words.hashes(), []
    for one in (hashes, mix(hashes ^ U(ODD))):
        up = np.multiply.accumulate(np.concatenate(([U(1)], np.full(max(int(words.count.max(initial=0)), 1), U(ODD)))))
        inside = np.arange(len(one)) - np.repeat(words.first[:-1], words.count)
        total = np.zeros(len(one) + 1, U)
        np.cumsum(one * up[inside], out=total[1:])
        out.append(mix(total[words.first[1:]] - total[words.first[:-1]] + words.count.astype(U)))
    empty = words.count == 0
    raw = words.stretch(words.sums(), words.begins[:-1], words.begins[1:])
    out[0][empty], out[1][empty] = raw[empty], mix(raw[empty] + U(1))
    return np.stack(out, axis=1).view(np.int64)


def sign(docs: DataFrame, doc_id: str, text: str, n_bands: int, n_rows: int, k: int) -> DataFrame:
    """doc_id, print, c1, c2 (content), n_shingles, bands, sketch (a byte per component) of every row."""
    m = n_bands * n_rows
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        salt = mix(np.arange(n_bands, dtype=U) + U(77))
        for batch in batches:
            for a, b, data, begins in slices(batch.column(2), TEXT_BYTES):
                words = Words(data, begins)
                where, shingle, weight = bags(words, k)
                sig = signatures(where, shingle, weight, b - a, m).astype(U)
                banded = sig.reshape(b - a, n_bands, n_rows)
                key = np.broadcast_to(salt, (b - a, n_bands)).copy()
                for j in range(n_rows):
                    key = mix(key * U(ODD) + banded[:, :, j])
                has = words.count > 0
                first = np.concatenate(([0], np.cumsum(has * n_bands))).astype(np.int32)
                sketch = (mix(sig) & U(255)).astype(np.uint8)
                content = _contents(words)
                n = np.bincount(where, weight, minlength=b - a).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(content[:, 0]), pa.array(content[:, 1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(first), pa.array(key[has].reshape(-1).view(np.int64))), pa.array([r.tobytes() for r in sketch], pa.binary())],
                    names=["doc_id", "print", "c1", "c2", "n_shingles", "bands", "sketch"],
                )

    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("print"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, print long, c1 long, c2 long, n_shingles long, bands array<long>, sketch binary"
    )


def bag_rows(rows: DataFrame, k: int) -> DataFrame:
    """v, text -> v, bag: the bag as sorted 64-bit numbers, one per shingle and occurrence."""

    def run(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1), TEXT_BYTES):
                where, shingle, weight = bags(Words(data, begins), k)
                repeat = np.repeat(np.arange(len(where)), weight)
                nth = np.arange(len(repeat)) - np.repeat(np.cumsum(weight) - weight, weight)
                one = mix(shingle[repeat] + nth.astype(U) * U(ODD))
                text = where[repeat]
                order = np.lexsort((one, text))
                one, first = one[order], np.searchsorted(text[order], np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([one[i:j].tobytes() for i, j in zip(first, first[1:])], pa.binary())], names=["v", "bag"])

    return rows.mapInArrow(run, "v long, bag binary")


# ---- candidates ----------------------------------------------------------------------------------------------------------


def _agreeing(pairs: DataFrame, uniq: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) whose sketches agree in at least ``least`` components."""
    sketch = uniq.select("v", "sketch")
    both = pairs.join(sketch.toDF("a", "sa"), "a").join(sketch.toDF("b", "sb"), "b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                keep = (x == y).sum(axis=1) >= least
                yield batch.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose bags have the wanted weighted Jaccard similarity."""
    both = pairs.join(bag.toDF("a", "x"), "a").join(bag.toDF("b", "y"), "b")

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), U) for c in (2, 3))
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = common >= similarity * (len(x) + len(y) - common) - 1e-9
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _across(members: DataFrame, least: int, chunk: int, similarity: float) -> DataFrame:
    """Pairs of one bucket in different components whose sketches and samples agree enough, each in its first common band.

    ``members``: key, n (of the bucket), band, v, comp, bands, sketch, sample (the lowest numbers of the bag), whole (the
    sample is the bag). A sample rules a pair out only ``SLACK`` standard deviations below the similarity. A bucket of more than ``chunk`` members is dealt
    into groups; each pair of groups is compared in a task of its own.
    """
    n_groups = F.ceil(F.col("n") / chunk).cast("int")
    own = members.withColumn("g", F.pmod(F.xxhash64("v"), n_groups).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), n_groups - 1))).withColumns({"i": F.least("g", "other"), "j": F.greatest("g", "other")})
    ordered = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select("key", "i", "j", "g", "band", "v", "comp", "bands", "sketch", "sample", "whole")

    def group(table):
        n = table.num_rows
        i, j = table.column(1)[0].as_py(), table.column(2)[0].as_py()
        g, band = table.column(3).to_numpy(), table.column(4)[0].as_py()
        v, comp = table.column(5).to_numpy(), table.column(6).to_numpy()
        if (comp == comp[0]).all():
            return None
        bands = table.column(7).combine_chunks().flatten().to_numpy().reshape(n, -1)
        sketch = np.frombuffer(b"".join(table.column(8).to_pylist()), np.uint8).reshape(n, -1)
        sample = [np.frombuffer(x.as_buffer(), U) for x in table.column(9)]
        whole = table.column(10).to_numpy()
        reach = np.array([np.iinfo(U).max if w or not len(x) else x[-1] for x, w in zip(sample, whole)], U)
        a, b = [], []
        for row in range(n - 1):
            later = np.flatnonzero(comp[row + 1 :] != comp[row]) + row + 1
            if i != j:
                later = later[g[later] != g[row]]
            if len(later):
                later = later[(sketch[later] == sketch[row]).sum(axis=1) >= least]
                later = later[(bands[later] == bands[row]).argmax(axis=1) == band]
            if len(later):
                later = later[_alike(sample, reach, whole, row, later, similarity)]
                a += [v[row]] * len(later)
                b += v[later].tolist()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]) if a else None

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            ids = np.stack([table.column(c).to_numpy() for c in range(3)], axis=1)
            cut = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist()]
            for x, y in zip(cut, cut[1:]):
                if (out := group(table.slice(x, y - x))) is not None:
                    yield out
            kept = table.slice(cut[-1])
        if kept is not None and (out := group(kept)) is not None:
            yield out

    return ordered.mapInArrow(run, "a long, b long")


def _alike(sample: list[np.ndarray], reach: np.ndarray, whole: np.ndarray, row: int, others: np.ndarray, similarity: float) -> np.ndarray:
    """Whether ``row`` may be similar to each of ``others``, by the numbers that both samples reach."""
    own, upto = sample[row], np.minimum(reach[row], reach[others])
    values = np.concatenate([sample[i] for i in others])
    of = np.repeat(np.arange(len(others)), [len(sample[i]) for i in others])
    inside = values <= upto[of]
    place = np.minimum(np.searchsorted(own, values), len(own) - 1)
    common = np.bincount(of[inside & (own[place] == values)], minlength=len(others))
    union = np.bincount(of[inside], minlength=len(others)) + np.searchsorted(own, upto, side="right") - common
    deviation = np.sqrt(similarity * (1 - similarity) / np.maximum(union, 1))
    slack = np.where(whole[others] & whole[row], 1e-9, SLACK * deviation)
    return common >= (similarity - slack) * union


def components(links: DataFrame) -> DataFrame:
    """v, comp (the smallest vertex that it is linked with, over any number of links) for every vertex of a link."""
    edges = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("comp")))
    while True:
        near = edges.join(labels.toDF("b", "comp"), "b").groupBy("a").agg(F.min("comp").alias("c"))
        lower = labels.join(near, F.col("v") == F.col("a")).select("v", F.least("comp", "c").alias("low"), F.col("comp").alias("old"))
        # a step along the labels themselves halves the rest of the way
        jumped = lower.join(labels.toDF("low", "beyond"), "low", "left")
        following = stored(jumped.select("v", F.least("low", F.coalesce("beyond", "low")).alias("comp"), "old"))
        labels = following.select("v", "comp")
        if following.where("comp <> old").isEmpty():
            return labels


# ---- the operator --------------------------------------------------------------------------------------------------------


def near_classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, n_bands: int = BANDS, n_rows: int = ROWS,
    k: int = SHINGLE, chunk: int = CHUNK,
) -> DataFrame:
    """One row per document row: doc_id, print (xxhash64 of the text), class_id, class_size, kept, n_shingles.

    A class holds the texts that a chain of links (weighted Jaccard similarity of at least ``similarity``) connects, and
    their copies; ``class_id`` is its smallest doc_id, and one row with that id is kept. Texts without words are in a
    class only with equal texts; missing texts equal empty ones. Missing ids come after all others.
    """
    m = n_bands * n_rows
    least = int(np.floor(m * similarity - SLACK * np.sqrt(m * similarity * (1 - similarity))))
    rows = stored(sign(docs, doc_id, text, n_bands, n_rows, k).withColumn("row", F.monotonically_increasing_id()))
    vertices = rows.groupBy("c1", "c2").agg(F.min("row").alias("v"))
    member = stored(rows.select("row", "doc_id", "c1", "c2").join(vertices, ["c1", "c2"]).select("row", "doc_id", "v"))
    uniq = stored(rows.join(vertices.select("v"), F.col("row") == F.col("v"), "left_semi").select(
        F.col("row").alias("v"), "doc_id", "print", "bands", "sketch"))
    entries = uniq.select("v", F.posexplode("bands").alias("band", "key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    company = stored(entries.join(shared, "key"))
    standing = company.groupBy("v").agg(F.sum("n").alias("rank"))
    leaders = company.join(standing, "v").groupBy("key").agg(F.max(F.struct("rank", F.col("v").alias("leader"))).alias("top")).select("key", "top.leader")
    pairs = company.join(leaders, "key").where("v <> leader").select(F.col("leader").alias("a"), F.col("v").alias("b")).distinct()
    pairs = stored(_agreeing(pairs, uniq, least))
    bag = _bags_of(docs, uniq, pairs.select(F.explode(F.array("a", "b")).alias("v")), doc_id, text, k)
    links = stored(_verified(pairs, bag, similarity))
    found = components(links)

    placed = company.join(found, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
    split = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    left_open = placed.join(split, "key")
    bag = _bags_of(docs, uniq, left_open.select("v"), doc_id, text, k)
    samples = bag.select("v", F.substring("bag", 1, 8 * SAMPLE).alias("sample"), (F.octet_length("bag") <= 8 * SAMPLE).alias("whole"))
    rest = stored(_across(left_open.join(uniq.select("v", "bands", "sketch"), "v").join(samples, "v"), least, chunk, similarity))
    if not rest.isEmpty():
        more = _verified(rest, bag, similarity)
        found = components(stored(links.unionAll(more)))

    whole = stored(member.join(found, "v", "left").select("row", "doc_id", F.coalesce("comp", "v").alias("comp")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = whole.groupBy("comp").agg(F.min(order).alias("first"), F.count("*").alias("class_size"))
    known = rows.select("row", "print", "n_shingles")
    return whole.join(classes, "comp").join(known, "row").select(
        "doc_id", "print", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept"), "n_shingles"
    )


def _bags_of(docs: DataFrame, uniq: DataFrame, vertices: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """v, bag of every vertex; each read from one document with that content."""
    wanted = vertices.distinct()
    keys = uniq.select("v", F.col("doc_id").alias("_id"), F.col("print").alias("_print")).join(wanted, "v")
    source = docs.select(F.col(doc_id).alias("_d"), F.col(text).alias("text")).withColumn("_p", F.xxhash64("text"))
    texts = source.join(keys, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_p") == F.col("_print"))).select("v", "text")
    # rows that repeat an id and a text give equal bags
    return stored(bag_rows(texts, k).dropDuplicates(["v"]))


def without_near_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The kept rows of ``docs``, in full."""
    own_id, own_print, times = unused(docs.columns, "_id", "_print", "_times")
    kept = near_classes(docs, doc_id=doc_id, text=text, **options).where("kept").select(F.col("doc_id").alias(own_id), F.col("print").alias(own_print))
    out = docs.join(kept, F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col(text)) == F.col(own_print)), "left_semi")
    again = docs.groupBy(doc_id).agg(F.count("*").alias(times)).where(F.col(times) > 1)
    return out if again.isEmpty() else out.dropDuplicates([doc_id, text])
