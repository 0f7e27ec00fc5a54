"""Spark ML's forest over many rows with few different vectors of bins.

Spark ML finds the cuts, bins the rows, draws the bootstrap counts and grows the trees, as in ``RandomForestRegressor.fit``.
Between the draws and the growth the rows of a tree's sample are added up by their bins: what a cut is chosen from are the
counts, sums and squares per bin, and rows with the same bins go the same way through every tree. The forest is the one of
``fit`` up to the rounding of sums; a pass reads vectors instead of a hundred counts for every row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import q_col
from ..session import spark_cores, stored
from . import histograms as hg

SUM_ROWS = 1 << 18  # rows that a task adds up at once: a byte per tree and some
SUM_VECTORS = 1 << 14  # vectors of which a task holds the sums: 24 bytes per tree
SIDE_BY_SIDE = 16  # trees grown at the same time
POINT = "org.apache.spark.ml.tree.impl.BaggedPoint"
SUMS = "tree int, code binary, w binary, s binary, q binary"


def fit_by_vector(forest: RandomForestRegressor, assembled: DataFrame, features: Sequence[str], rows: int) -> RandomForestRegressionModel | None:
    """The fitted ``forest``; None where this way does not serve: more vectors than one task holds or than half the rows,
    nominal features, or a session that serialises points otherwise.

    ``assembled`` has the features one by one too, and a layout that follows from its keys: draws follow the order of the rows.
    """
    spark = assembled.sparkSession
    trees, width = forest.getNumTrees(), len(features)
    drawn, single = _layout(spark, width, trees), _layout(spark, width, 1)
    if drawn is None or single is None:
        return None
    parts = _Parts(spark)
    forest._transfer_params_to_java()
    java, none = forest._java_obj, spark._jvm.scala.Option.empty()
    nominal = parts("org.apache.spark.ml.util.MetadataUtils").getCategoricalFeatures(assembled._jdf.schema().apply(forest.getFeaturesCol()))
    if nominal.size():
        return None
    instances = parts("org.apache.spark.ml.util.DatasetUtils").extractInstances(java, assembled._jdf, none)
    algo = parts("org.apache.spark.mllib.tree.configuration.Algo").Regression()
    strategy = java.getOldStrategy(nominal, 0, algo, java.getOldImpurity())
    getattr(strategy, "bootstrap_$eq")(True)
    subset, seed = forest.getFeatureSubsetStrategy(), forest.getSeed()
    metadata = parts("org.apache.spark.ml.tree.impl.DecisionTreeMetadata").buildMetadata(instances, strategy, trees, subset)
    grower = parts("org.apache.spark.ml.tree.impl.RandomForest")
    splits = grower.findSplits(instances, metadata, seed)
    grids = [[cut.threshold() for cut in own] for own in splits]
    sizes = [len(g) + 1 for g in grids]
    if math.prod(sizes) >= 1 << 62:
        return None
    counts = assembled.select(_code(features, grids).alias("code")).groupBy("code").agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        vectors, share = counts.count(), SUM_ROWS // 4
        if vectors > min(hg.LOCAL_VECTORS, rows // 2):
            return None
        frequent = {r["code"]: r["n"] // share + 1 for r in counts.where(F.col("n") > share).collect()}  # at most rows / share
    finally:
        counts.unpersist()
    points = parts("org.apache.spark.ml.tree.impl.TreePoint").convertToTreeRDD(instances, splits, metadata)
    bagging = parts(POINT)
    ones = getattr(bagging, "convertToBaggedRDD$default$5")()
    bagged = bagging.convertToBaggedRDD(points, forest.getSubsamplingRate(), trees, True, ones, seed)
    encoder = parts("org.apache.spark.sql.Encoders").kryo(parts.kind(POINT))
    blobs = DataFrame(spark._jsparkSession.createDataset(bagged, encoder).toDF(), spark)
    sums = stored(_sums(blobs, drawn, sizes, trees, max(spark_cores(spark), rows // SUM_ROWS + 1, vectors // SUM_VECTORS + 1), frequent), "tree")
    tag = parts("scala.reflect.ClassTag").apply(parts.kind("[[Lorg.apache.spark.ml.tree.Split;"))
    cuts = spark.sparkContext._jsc.sc().broadcast(splits, tag)
    level = spark.sparkContext._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK)

    def grow(tree):
        own = sums.where(F.col("tree") == tree).drop("tree").mapInArrow(_points(single, sizes), "value binary")
        data = getattr(own._jdf, "as")(encoder).rdd().persist(level)
        try:
            return grower.runBagged(data, metadata, cuts, strategy, 1, subset, seed, none, True, none, 0)[0]
        finally:
            data.unpersist(False)

    with ThreadPoolExecutor(min(trees, spark_cores(spark), SIDE_BY_SIDE)) as pool:
        grown = list(pool.map(inheritable_thread_target(spark)(grow), range(trees)))
    extra = spark._jvm.org.apache.spark.ml.param.ParamMap()
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees)
    for i, tree in enumerate(grown):
        array[i] = java.copyValues(tree, extra)
    model = spark._jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(java.uid(), array, width)
    return forest._copyValues(forest._create_model(java.copyValues(model, extra).setParent(java)))


class _Parts:
    """Scala objects and classes of Spark by name."""

    def __init__(self, spark: SparkSession):
        self.java = spark._jvm.java.lang.Class
        self.loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()

    def kind(self, name: str):
        return self.java.forName(name, True, self.loader)

    def __call__(self, name: str):
        return self.kind(f"{name}$").getField("MODULE$").get(None)


@dataclass(frozen=True)
class _Layout:
    """Where label, bins and counts stand in a serialised point."""

    blank: bytes
    label: int
    bins: int
    counts: int


def _layout(spark: SparkSession, width: int, trees: int) -> _Layout | None:
    """Read off two points of known content; None unless both have their numbers at the same places, in full length."""
    parts, gateway, impl = _Parts(spark), spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.tree.impl
    encoder = parts("org.apache.spark.sql.Encoders").kryo(parts.kind(POINT))

    def ints(values):
        array = gateway.new_array(spark._jvm.int, len(values))
        for i, v in enumerate(values):
            array[i] = int(v)
        return array

    found = []
    for label, bin_, count in ((0.1234567, 70_001, 90_001), (-7.6543e21, 0, 0)):
        bins, counts = np.arange(width, dtype="<i4") + bin_, np.arange(trees, dtype="<i4") + count
        point = impl.BaggedPoint(impl.TreePoint(label, ints(bins), 1.0), ints(counts), 1.0)
        data = spark._jsparkSession.createDataset(spark._jvm.java.util.Collections.singletonList(point), encoder)
        found.append((bytes(DataFrame(data.toDF(), spark).first()[0]), (np.array(label, "<f8").tobytes(), bins.tobytes(), counts.tobytes())))
    (first, marks), (second, others) = found
    at = [first.find(m) for m in marks]
    if len(first) != len(second) or min(at) < 0 or any(first.count(m) > 1 for m in marks) or any(second[i : i + len(m)] != m for i, m in zip(at, others)):
        return None
    return _Layout(first, *at)


def _code(features: Sequence[str], grids: list[list[float]]):
    """A number for each vector of bins."""
    cuts = [np.array(g) for g in grids]

    @F.pandas_udf("long")
    def code(*columns: pd.Series) -> pd.Series:
        out = np.zeros(len(columns[0]), np.int64)
        for grid, x in zip(cuts, columns):
            out = out * (len(grid) + 1) + np.searchsorted(grid, x.to_numpy(float), side="left")
        return pd.Series(out)

    return code(*[q_col(c).cast("double") for c in features])


def _sums(blobs: DataFrame, layout: _Layout, sizes: list[int], trees: int, parts: int, frequent: dict[int, int]) -> DataFrame:
    """Per tree and task the vectors in the tree's sample: their numbers, and counts, sums and squares of the labels.

    The rows of a vector go to one task; those of one too frequent for that are dealt out, and a vector then has several sums.
    """
    units = np.array(hg._one_key_each(blobs.sparkSession, parts), np.int32)
    width, hot = len(sizes), np.array(sorted(frequent), np.int64)
    ways = np.array([frequent[c] for c in hot.tolist()], np.int64)

    def send(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        seen = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            blob = batch.column(0)
            ends = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + n + 1]
            raw = np.frombuffer(blob.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(n, len(layout.blank))
            field = lambda at, kind, k: np.ascontiguousarray(raw[:, at : at + k * np.dtype(kind).itemsize]).view(kind)  # noqa: B023, E731
            y, bins, counts = field(layout.label, "<f8", 1)[:, 0], field(layout.bins, "<i4", width), field(layout.counts, "<i4", trees)
            code = np.zeros(n, np.int64)
            for f, size in enumerate(sizes):
                code = code * size + bins[:, f]
            unit = (hg.mixed(code, 1) * parts).astype(np.int64)
            if len(hot):
                place = np.minimum(np.searchsorted(hot, code), len(hot) - 1)
                unit = np.where(hot[place] == code, (unit + (seen + np.arange(n)) % ways[place]) % parts, unit)
            order = np.argsort(unit, kind="stable")
            code, y, counts = code[order], y[order], counts[order].astype(np.uint8)
            start = np.flatnonzero(np.diff(unit[order], prepend=-1))
            cut = [*zip(start, [*start[1:], n])]
            columns = [pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (code, y, counts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(units[unit[order][start]]), pa.array(np.full(len(cut), (task << 40) + seen)), *columns], names=["unit", "at", "code", "y", "n"]
            )
            seen += n

    def add_up(batches):
        held = sorted((row[1:] for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))), key=lambda row: row[0])
        if not held:
            return
        code, y, n = (np.frombuffer(b"".join(row[i] for row in held), kind) for i, kind in ((1, np.int64), (2, np.float64), (3, np.uint8)))
        held.clear()
        order = np.argsort(code, kind="stable")  # sums do not depend on how the rows arrived
        code, y, by_tree = code[order], y[order], np.ascontiguousarray(n.reshape(-1, trees)[order].T)
        start = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        own, squares = code[start], y * y
        for tree in range(trees):
            times = by_tree[tree].astype(float)
            w = np.add.reduceat(times, start)
            inside = w > 0
            found = (own, w, np.add.reduceat(times * y, start), np.add.reduceat(times * squares, start))
            columns = [pa.array([x[inside].tobytes()], pa.binary()) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *columns], names=["tree", "code", "w", "s", "q"])

    sent = blobs.mapInArrow(send, "unit int, at long, code binary, y binary, n binary").repartition(parts, "unit")
    return sent.mapInArrow(add_up, SUMS).repartition(trees, "tree")


def _points(layout: _Layout, sizes: list[int]):
    """Serialised points with the given counts, sums and squares: two of the same vector, as far apart as its labels spread."""

    def make(batches):
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                code, *sums = (np.frombuffer(x, kind) for x, kind in zip(row, (np.int64, *[np.float64] * 3)))
                w, s, q = sums
                mean = s / w
                spread = np.sqrt(np.maximum(q / w - mean * mean, 0.0))
                below = np.where(spread > 0, w // 2, 0.0)
                above = w - below
                two = np.flatnonzero(below)
                label = np.concatenate((mean + spread * np.sqrt(below / above), mean[two] - spread[two] * np.sqrt(above[two] / below[two])))
                out = np.tile(np.frombuffer(layout.blank, np.uint8), (len(label), 1))
                which = np.concatenate((np.arange(len(code)), two))
                bins, rest = np.empty((len(code), len(sizes)), "<i4"), code
                for f in reversed(range(len(sizes))):
                    rest, bins[:, f] = np.divmod(rest, sizes[f])
                counts = np.concatenate((above, below[two])).astype("<i4")
                for at, values in ((layout.label, label.astype("<f8")[:, None]), (layout.bins, bins[which]), (layout.counts, counts[:, None])):
                    seen = np.ascontiguousarray(values).view(np.uint8)
                    out[:, at : at + seen.shape[1]] = seen
                ends = np.arange(0, out.size + 1, len(layout.blank), dtype=np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([blob], ["value"])

    return make
