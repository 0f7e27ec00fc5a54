"""Toxicity by a chain of linear classifiers.

The labelled categories are predicted one after another. Each category has a logistic model over the same features
and over the probabilities of all earlier categories. A later model is trained on out-of-fold probabilities of the
earlier ones: each labelled row's probability comes from a model that has not seen its fold. Prediction then uses
the earlier models fitted on all folds.

Features are words and byte prefixes of words (inflected forms share them), each present or not, and a few measures
of the whole text. The classifier is fitted on a bounded sample of labelled rows (``sample``, by a hash of the id);
within it, counts per feature are summed by Spark and the ``vocabulary`` features with the strongest association (G
squared) to any category are kept. Prediction reads every whole text of every document, in one pass without shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import key_hash
from ..session import stored
from .words import Words, mix, slices

# category -> label column and the value that means yes
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
SAMPLE = 20_000
VOCABULARY = 4_000
LEAST_DOCS = 4
PREFIXES = (4, 5, 6, 7, 8)
FOLDS = 5
RIDGE = 2.0
STEPS = 150
SETTLED = 1e-3
MEASURES = 3
SEED = 8
U = np.uint64


@dataclass
class Chain:
    names: list[str]
    features: np.ndarray  # sorted feature hashes
    weights: list[np.ndarray]  # per category: features, measures, earlier categories, constant
    thresholds: list[float]


def _measures(words: Words) -> np.ndarray:
    """Per text: log of the words, share of bytes in words, mean word length; all about 0 to 1."""
    size = np.maximum(np.diff(words.begins), 1)
    upto = np.concatenate(([0], np.cumsum(words.end - words.start)))
    inside = upto[words.first[1:]] - upto[words.first[:-1]]
    return np.stack([np.log1p(words.count) / 10, inside / size, np.minimum(inside / np.maximum(words.count, 1) / 20, 2)], axis=1)


def _present(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature hash) of every word and every long enough prefix, with repetitions."""
    total = words.sums()
    text = words.text_of()
    size = words.end - words.start
    found = [(text, words.stretch(total, words.start, words.end))]
    for n in PREFIXES:
        at = np.flatnonzero(size >= n)
        found.append((text[at], mix(words.stretch(total, words.start[at], words.start[at] + n) + U(n))))
    return np.concatenate([t for t, _ in found]), np.concatenate([h for _, h in found])


def _in_vocabulary(words: Words, features: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature number) pairs of the chosen features."""
    text, hashes = _present(words)
    at = np.flatnonzero(sieve[(hashes & U(len(sieve) - 1)).astype(np.int64)])
    place = np.minimum(np.searchsorted(features, hashes[at]), max(len(features) - 1, 0))
    exact = features[place] == hashes[at] if len(features) else np.zeros(0, bool)
    pair = np.unique(text[at][exact].astype(np.int64) * max(len(features), 1) + place[exact])
    return pair // max(len(features), 1), pair % max(len(features), 1)


def _sieve(features: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[(features & U(len(out) - 1)).astype(np.int64)] = True
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(rows: np.ndarray, columns: np.ndarray, n_features: int, dense: np.ndarray, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Ridge logistic regression over sparse 0/1 features and dense ones, by accelerated gradient steps."""
    n = max(int(use.sum()), 1)
    if not use.any() or y[use].all() or not y[use].any():  # one class only: its smoothed share
        share = (y[use].sum() + 0.5) / (use.sum() + 1)
        out = np.zeros(n_features + dense.shape[1] + 1)
        out[-1] = np.log(share / (1 - share)) if use.any() else -30
        return out
    keep = use[rows]
    rows, columns = rows[keep], columns[keep]
    # a step per feature, as large as the rows that have it allow
    load = (np.bincount(rows, minlength=len(y)) + np.abs(dense).sum(axis=1) + 1) * use
    bound = np.concatenate((np.bincount(columns, load[rows], minlength=n_features), np.abs(dense).T @ load, [load.sum()]))
    rate = n / (0.25 * bound + RIDGE)
    w = np.zeros(n_features + dense.shape[1] + 1)
    look, momentum = w.copy(), 1.0
    weight = use / n
    for _ in range(STEPS):
        z = np.bincount(rows, look[columns], minlength=len(y)) + dense @ look[n_features:-1] + look[-1]
        error = (_sigmoid(z) - y) * weight
        gradient = np.concatenate((np.bincount(columns, error[rows], minlength=n_features), dense.T @ error, [error.sum()]))
        gradient[:-1] += RIDGE / n * look[:-1]
        new = look - rate * gradient
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        moved = np.abs(new - w).max()
        look, w, momentum = new + (momentum - 1) / following * (new - w), new, following
        if moved < SETTLED:
            break
    return w


def _scores(rows, columns, n_features: int, dense: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _sigmoid(np.bincount(rows, w[columns], minlength=len(dense)) + dense @ w[n_features:-1] + w[-1])


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The limit with the best F1 on out-of-fold probabilities, midway to the next lower one.

    At least half of what it calls positive must be so, and its F1 must beat that of calling everything positive; if no limit
    does (as with few labels, where all probabilities lie about the base rate), none is set and nothing is positive.
    """
    if not y.any():
        return 1.1
    order = np.argsort(-p, kind="stable")
    hits, called = np.cumsum(y[order]), np.arange(len(y)) + 1
    apart = np.append(p[order][1:] < p[order][:-1], True)  # a limit cannot part equal probabilities
    f1 = np.where(apart & (2 * hits >= called), 2 * hits / (called + y.sum()), 0.0)
    best = int(np.argmax(f1))
    if f1[best] <= 2 * y.sum() / (len(y) + y.sum()):
        return 1.1
    low = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + low) / 2)


def fit_chain(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", categories=CATEGORIES, sample: int = SAMPLE,
    vocabulary: int = VOCABULARY, folds: int = FOLDS, seed: int = SEED,
) -> Chain:
    """A chain fitted on at most ``sample`` labelled documents. Missing labels and ids are left out; of repeated labels the largest counts."""
    spark = docs.sparkSession
    columns = list(dict.fromkeys(c for _, c, _ in categories))
    known = labels.select(doc_id, *columns).dropna().groupBy(doc_id).agg(*[F.max(c).alias(c) for c in columns])
    chosen = known.orderBy(key_hash(doc_id, seed), doc_id).limit(sample)
    flags = [(F.col(c) == value).cast("double").alias(f"y{i}") for i, (_, c, value) in enumerate(categories)]
    # at most ``sample`` short rows: the one broadcast, of a size that the parameter bounds
    picked = chosen.select(F.col(doc_id).alias("_id"), *flags, F.pmod(key_hash(doc_id, seed + 1), F.lit(folds)).cast("int").alias("fold"))
    names = [f"y{i}" for i in range(len(categories))]
    rows = stored(docs.select(doc_id, text).join(F.broadcast(picked), F.col(doc_id) == F.col("_id")).select("_id", F.col(text).alias("text"), "fold", *names).repartition(8))

    def count(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(0)):
                where, hashes = _present(Words(data, begins))
                y = np.stack([batch.column(i + 1).slice(a, b - a).to_numpy() for i in range(len(names))], axis=1)
                both = np.stack((where.astype(np.int64), hashes.view(np.int64)), axis=1)
                if not len(both):
                    continue
                order = np.lexsort((both[:, 0], both[:, 1]))
                both = both[order]
                fresh = np.ones(len(both), bool)
                fresh[1:] = (both[1:] != both[:-1]).any(axis=1)
                both = both[fresh]
                start = np.flatnonzero(np.concatenate(([True], both[1:, 1] != both[:-1, 1])))
                yes = np.add.reduceat(y[both[:, 0]], start, axis=0)
                n = np.diff(np.concatenate((start, [len(both)])))
                yield pa.RecordBatch.from_arrays([pa.array(both[start, 1]), pa.array(n, pa.int64()), *[pa.array(yes[:, i]) for i in range(len(names))]], names=["feature", "n", *names])

    counted = rows.select("text", *names).mapInArrow(count, ", ".join(["feature long", "n long", *[f"{y} double" for y in names]]))
    # of the bounded sample
    summed = stored(counted.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(y).alias(y) for y in names]).where(F.col("n") >= LEAST_DOCS))
    whole = rows.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(y), F.lit(0.0)).alias(y) for y in names]).first()
    # a feature must be associated with a category more than chance would have it among as many features
    least = chance_association(summed.count() * len(names))
    strengths = [_association(F.col("n"), F.col(y), float(whole["n"]), float(whole[y])) for y in names]
    best = summed.select("feature", (F.greatest(*strengths) if len(strengths) > 1 else strengths[0]).alias("g")).where(F.col("g") >= least).orderBy(F.desc("g"), "feature").limit(vocabulary)
    features = np.sort(np.array([r["feature"] for r in best.collect()], np.int64).view(U))
    shared = spark.sparkContext.broadcast(features)

    def design(batches):
        sieve = _sieve(shared.value)
        for batch in batches:
            for a, b, data, begins in slices(batch.column(0)):
                words = Words(data, begins)
                where, number = _in_vocabulary(words, shared.value, sieve)
                first = np.searchsorted(where, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(first), pa.array(number, pa.int64())), pa.array(_measures(words).tolist(), pa.list_(pa.float64())),
                     *[batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns)]], names=["features", "measures", "fold", "_id", *names],
                )

    schema = ", ".join(["features array<long>", "measures array<double>", "fold int", f"_id {rows.schema['_id'].dataType.simpleString()}", *[f"{y} double" for y in names]])
    designed = rows.select("text", "fold", "_id", *names).mapInArrow(design, schema)

    def train(batches):
        table = pa.Table.from_batches(list(batches)).sort_by("_id")  # an order that does not depend on partitions
        lists = [table.column(c).combine_chunks() for c in ("features", "measures")]
        counts = np.diff(lists[0].offsets.to_numpy())
        targets = [table.column(y).to_numpy() > 0 for y in names]
        weights, thresholds = _train(
            np.repeat(np.arange(len(counts)), counts), lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy().reshape(len(counts), -1),
            table.column("fold").to_numpy(), targets, len(shared.value), folds,
        )
        yield pa.RecordBatch.from_arrays([pa.array([[w.tolist() for w in weights]]), pa.array([thresholds])], names=["weights", "thresholds"])

    # the sample is bounded, so one task holds it; only the weights reach the driver
    chain_names = [n for n, _, _ in categories]
    fitted = designed.repartition(1).mapInArrow(train, "weights array<array<double>>, thresholds array<double>").collect() if whole["n"] else []
    if not fitted:
        nothing = _train(np.zeros(0, int), np.zeros(0, int), np.zeros((0, MEASURES)), np.zeros(0, int), [np.zeros(0, bool)] * len(names), len(features), folds)
        return Chain(chain_names, features, *nothing)
    return Chain(chain_names, features, [np.array(w) for w in fitted[0]["weights"]], list(fitted[0]["thresholds"]))


def chance_association(features: int) -> float:
    """The G squared (chi-squared, one degree of freedom) that chance gives to one of so many features."""
    low, high = 0.0, 100.0
    for _ in range(60):
        g = (low + high) / 2
        low, high = (g, high) if features * math.erfc(math.sqrt(g / 2)) > 1 else (low, g)
    return low


def _association(n, yes, total: float, total_yes: float):
    """G squared of a feature and a category."""
    cell = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    no, share = n - yes, total_yes / total if total else 0.5
    rest_yes, rest_no = total_yes - yes, total - total_yes - no
    parts = [cell(yes, n * share), cell(no, n * (1 - share)), cell(rest_yes, (total - n) * share), cell(rest_no, (total - n) * (1 - share))]
    return 2 * (parts[0] + parts[1] + parts[2] + parts[3]) if 0 < share < 1 else F.lit(0.0)


def _train(rows, columns, dense, fold, targets, n_features: int, folds: int) -> tuple[list[np.ndarray], list[float]]:
    """Weights and threshold of each category in turn; ``rows`` and ``columns`` are the sparse 0/1 features."""
    weights, thresholds = [], []
    for target in targets:
        apart = np.zeros(len(dense))
        for k in range(folds):
            own = fold == k
            if own.any():
                model = _fit(rows, columns, n_features, dense, target, ~own)
                apart[own] = _scores(rows, columns, n_features, dense, model)[own]
        weights.append(_fit(rows, columns, n_features, dense, target, np.ones(len(dense), bool)))
        thresholds.append(_threshold(apart, target))
        dense = np.concatenate((dense, apart[:, None]), axis=1)
    return weights, thresholds


def toxicity(docs: DataFrame, chain: Chain, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, p_<category> and is_<category> of each. Missing and empty texts have no features, and are never rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"p_{n} double" for n in chain.names], *[f"is_{n} boolean" for n in chain.names]])

    def run(batches):
        model = shared.value
        sieve = _sieve(model.features)
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1)):
                words = Words(data, begins)
                rows, columns = _in_vocabulary(words, model.features, sieve)
                dense, out = _measures(words), []
                for w in model.weights:
                    out.append(_scores(rows, columns, len(model.features), dense, w))
                    dense = np.concatenate((dense, out[-1][:, None]), axis=1)
                yes = [(p >= t) & (words.count > 0) for p, t in zip(out, model.thresholds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, out), *map(pa.array, yes)], names=["doc_id", *[f"p_{n}" for n in model.names], *[f"is_{n}" for n in model.names]])

    return docs.select(doc_id, text).mapInArrow(run, schema)


def accepted(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, in full, that the chain does not call toxic; judged in the pass that reads them."""
    chain = fit_chain(docs, labels, doc_id=doc_id, text=text, **options)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at, toxic = docs.columns.index(text), chain.names.index("toxic")

    def run(batches):
        model = shared.value
        sieve = _sieve(model.features)
        for batch in batches:
            for a, b, data, begins in slices(batch.column(at)):
                words = Words(data, begins)
                rows, columns = _in_vocabulary(words, model.features, sieve)
                dense = _measures(words)
                for w in model.weights[: toxic + 1]:
                    p = _scores(rows, columns, len(model.features), dense, w)
                    dense = np.concatenate((dense, p[:, None]), axis=1)
                bad = (p >= model.thresholds[toxic]) & (words.count > 0)
                yield batch.slice(a, b - a).filter(pa.array(~bad))

    return docs.mapInArrow(run, docs.schema)
