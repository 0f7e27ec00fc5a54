"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets. Two multinomials are counted over them: one
over all documents (raw), one over the documents that a label calls good (trusted). A bucket weighs
log((t + 1) / (r T / R + 1)), with t and r its counts and T and R all counts: the raw counts are brought to the size of
the trusted ones, then both are smoothed alike, so what is rare in both weighs nothing. The score of a document is the
sum of the weights of its n-grams over their number; its own n-grams do not count as raw text, else a text that is new to
the trusted ones would speak against itself.

The threshold is deterministic: trusted documents are scored with their own n-grams taken out of both counts, and it lies
below the ``lose`` quantile of these scores by ``margin`` of that quantile's distance from their median, since other good
documents may lie a little lower. Every document at or above it is kept, unless a base rule (too short, too repetitive) rejects it.

Shuffled are bucket sums only: each task adds its rows into one table of ``BUCKETS`` counts. Two passes read all
texts (counts, verdicts), one the trusted texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.lookups import BROADCAST_BYTES, measured_bytes
from ..functions.quantiles import exact_quantiles
from ..session import stored
from .words import ODD, SPACE_BYTE, Words, _power, mix, slices

BUCKETS = 1 << 16
WINDOW = 8  # words of a window that must not repeat
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
LOSE = 0.002
MARGIN = 0.25
SLICE = 1 << 20
U = np.uint64
PAIR, SPREAD = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F  # odd multipliers
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
NEW_LINE = 0x0A
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """Words between white space of the texts of one slice, with running hash sums over their bytes."""

    def __init__(self, data: np.ndarray, begins: np.ndarray):
        self.words = Words(data, begins, ~SPACE_BYTE)
        self.words.data = data  # case counts
        self.total = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * _power("up", len(data)), out=self.total[1:])
        self.down = _power("down", len(data) + 1)
        self.hashes = self.of(self.words.start, self.words.end)
        self.text = self.words.text_of()

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sum of (byte + 1) ODD^place over the bytes ``start:end``, modulo 2^64."""
        return (self.total[end] - self.total[start]) * self.down[start]

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of every word and every pair of neighbouring words."""
        h, t = self.hashes, self.text
        at = np.flatnonzero(t[1:] == t[:-1])
        pairs = h[at] * U(PAIR) + h[at + 1]
        found = (np.concatenate((h, pairs)) * U(SPREAD)) >> U(64 - BUCKETS.bit_length() + 1)
        return np.concatenate((t, t[at])), found.astype(np.int64)

    def own(self, keys: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Keys that are equal only within one text."""
        return mix(keys + (text.astype(U) + U(1)) * U(ODD))

    def base(self) -> dict[str, np.ndarray]:
        words, data, n = self.words, self.words.data, len(self.words.count)
        per_text = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[words.begins])
        inside = ~SPACE_BYTE[data]
        # lines with a word, equal to an earlier line
        edge = np.zeros(len(data) + 1, bool)
        edge[words.begins] = True
        edge[1:] |= data == NEW_LINE
        start = np.flatnonzero(edge[:-1])
        stop = np.append(start[1:], len(data))[: len(start)]
        stop = stop - (data[stop - 1] == NEW_LINE)
        full = np.searchsorted(words.start, start) < np.searchsorted(words.start, stop)
        start, stop = start[full], stop[full]
        of_text = np.searchsorted(words.begins, start, side="right") - 1
        keys = self.own(mix(self.of(start, stop)) + (stop - start).astype(U), of_text)
        _, first = np.unique(keys, return_index=True)
        dup_lines = np.bincount(of_text, minlength=n) - np.bincount(of_text[first], minlength=n)
        # words in windows found twice or more
        at, grams = words.grams(mix(self.hashes) + (words.end - words.start).astype(U), WINDOW)
        _, which, times = np.unique(self.own(grams, self.text[at]), return_inverse=True, return_counts=True)
        again = at[times[which] > 1]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + WINDOW, -1)
        repeat = np.bincount(self.text[np.cumsum(cover)[:-1] > 0], minlength=n)
        return {
            "n_words": words.count,
            "word_chars": per_text(inside & ((data & 0xC0) != 0x80)),
            "n_symbols": per_text(SYMBOL[data]),
            "n_dup_lines": dup_lines,
            "n_repeat_words": repeat,
        }


def scores(texts: Text, t: np.ndarray, r: np.ndarray, trusted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Score and number of n-grams of each text, without its own n-grams in the raw counts (and the trusted ones if it is one)."""
    where, bucket = texts.buckets()
    n_texts = len(texts.words.count)
    cell, n = np.unique(where * BUCKETS + bucket, return_counts=True)
    where, bucket = cell // BUCKETS, cell % BUCKETS
    size = np.bincount(where, n, minlength=n_texts)
    t_here, all_t = (t[bucket] - n, (t.sum() - size)[where]) if trusted else (t[bucket], t.sum())
    all_r = np.maximum(r.sum() - size, 1.0)[where]
    w = np.log((t_here + 1.0) / ((r[bucket] - n) * (all_t / all_r) + 1.0))
    return np.bincount(where, w * n, minlength=n_texts) / np.maximum(size, 1), size


def flagged(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label: str, trusted) -> DataFrame:
    """(text, trusted) of every row; missing labels and ids are not trusted, of repeated labels the largest counts."""
    ids = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    ids = ids.where(F.col("_label") == trusted).select("_id", F.lit(True).alias("trusted"))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    yes = F.coalesce("trusted", F.lit(False)).alias("trusted")
    if measured_bytes(ids) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(ids), "_id", "left").select("text", yes)
    known = rows.where("_id IS NOT NULL").join(ids, "_id", "left").select("text", yes)
    return known.unionByName(rows.where("_id IS NULL").select("text", F.lit(False).alias("trusted")))


@dataclass
class Model:
    """Bucket counts of trusted and raw text, and the threshold (None: nothing is trusted)."""

    t: np.ndarray
    r: np.ndarray
    threshold: float | None

def fit_model(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", trusted=1, lose: float = LOSE,
    margin: float = MARGIN,
) -> Model:
    """Counts over all documents and all trusted ones, and the threshold."""
    rows = flagged(docs, labels, doc_id=doc_id, text=text, label=label, trusted=trusted)

    def count(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for a, b, data, begins in slices(batch.column(0), SLICE):
                good = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False).astype(bool)
                where, bucket = Text(data, begins).buckets()
                sums[0] += np.bincount(bucket, minlength=BUCKETS)
                sums[1] += np.bincount(bucket[good[where]], minlength=BUCKETS)
        filled = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(sums[0][filled]), pa.array(sums[1][filled])], names=["bucket", "r", "t"])

    # one row per bucket: a table whose size BUCKETS fixes
    found = rows.mapInArrow(count, "bucket long, r long, t long").groupBy("bucket").agg(F.sum("r").alias("r"), F.sum("t").alias("t")).toPandas()
    t, r = np.zeros(BUCKETS), np.zeros(BUCKETS)
    t[found["bucket"]], r[found["bucket"]] = found["t"], found["r"]
    if not t.any():
        return Model(t, r, None)
    shared = docs.sparkSession.sparkContext.broadcast((t, r))

    def left_out(batches):
        for batch in batches:
            for _, _, data, begins in slices(batch.column(0), SLICE):
                score, size = scores(Text(data, begins), *shared.value, True)
                yield pa.RecordBatch.from_arrays([pa.array(score[size > 0])], names=["score"])

    own = stored(rows.where("trusted").select("text").mapInArrow(left_out, "score double"))
    low, middle = exact_quantiles(own, {"score": [lose, 0.5]})["score"]
    return Model(t, r, low - margin * (middle - low))


def verdict(texts: Text, model: Model):
    """Base counts, base_failed, score and kept of the texts of a slice."""
    base = texts.base()
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])
    if model.threshold is None:
        return base, failed, np.zeros(len(failed)), ~failed
    score, _ = scores(texts, model.t, model.r, False)
    return base, failed, score, ~failed & (score >= model.threshold)


def judged(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    Missing texts count as empty: they have no words and fail the base rule for short texts, with score 0. Where nothing is
    trusted, the base rules alone decide. An empty table gives no rows; repeated rows are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", *COUNTS, "base_failed", "score", "kept"]

    def run(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1), SLICE):
                base, failed, score, kept = verdict(Text(data, begins), shared.value)
                columns = [batch.column(0).slice(a, b - a), *[pa.array(base[c].astype(np.int64)) for c in COUNTS], *map(pa.array, (failed, score, kept))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in COUNTS], "base_failed boolean, score double, kept boolean"])
    return docs.select(doc_id, text).mapInArrow(run, schema)


def good(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of ``docs``, in full, that :func:`judged` keeps."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(at), SLICE):
                yield batch.slice(a, b - a).filter(pa.array(verdict(Text(data, begins), shared.value)[-1]))

    return docs.mapInArrow(run, docs.schema)
