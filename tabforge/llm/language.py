"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a language, so code-switched texts are labelled word by word; the language of a text is the
one with the most expected words. A word's evidence is the sum of weights of its prefixes and suffixes (affixes), its
byte trigrams, and the word itself if the lexicon has it. Learned transition weights tie neighbours
together, and forward-backward sums over all labellings give each word's probabilities.

The model is fitted on a bounded, documented sample: about ``per_language`` documents of each language by a hash of the id,
a few segments of words from anywhere in each. Segments of different documents are joined into sequences, so the sample has
switches to learn transitions from. Prediction reads every word of every document, in one pass without shuffle; the
recursions run over all texts of a slice side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import HASH_RANGE, key_hash
from ..session import stored
from .words import Words, flat, mix, slices

PER_LANGUAGE = 1_000
SEGMENTS, SEGMENT_WORDS = 4, 20
JOINED = 3  # segments in a training sequence
LEXICON_COUNT = 3
BUCKETS = 1 << 16
STEPS = 60
RATE = 0.15
DECAY = 1e-5
SEED = 10
U = np.uint64
LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = True


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # bucket x language
    transitions: np.ndarray  # language x language
    lexicon: np.ndarray  # sorted word hashes


# ---- features ----------------------------------------------------------------------------------------------------------


def word_features(words: Words, at: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word in ``at``, bucket) of every feature of the words ``at``."""
    total = words.sums()
    start, end = words.start[at], words.end[at]
    size, own = end - start, np.arange(len(at))
    which, found = [], []

    def add(number, hashed, family: int):
        which.append(number)
        found.append(mix(hashed + U(family)) & U(BUCKETS - 1))

    for n in (1, 2, 3, 4):
        fits = np.flatnonzero(size >= n)
        add(own[fits], words.stretch(total, start[fits], start[fits] + n), 11 + n)
        add(own[fits], words.stretch(total, end[fits] - n, end[fits]), 21 + n)
    inner = np.maximum(size - 2, 0)
    number = np.repeat(own, inner)
    offset = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner)
    place = start[number] + offset
    add(number, words.stretch(total, place, place + 3), 31)
    if len(lexicon):
        slot = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[slot] == hashes)
        add(own[known], hashes[known], 41)
    return np.concatenate(which), np.concatenate(found).astype(np.int64)


def emissions(which: np.ndarray, buckets: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(which, weights[buckets, j], minlength=n) for j in range(weights.shape[1])], axis=1) if n else np.zeros((0, weights.shape[1]))


# ---- forward-backward ------------------------------------------------------------------------------------------------------


def posteriors(evidence: np.ndarray, first: np.ndarray, transitions: np.ndarray):
    """Per word the probability of each language; also the log partition of each text and the expected transitions.

    ``evidence`` has a row per word, texts one after another, text i in rows first[i]:first[i + 1]. All texts
    advance together, longest first, so a step costs one small array operation for all of them.
    """
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    begin, length = first[:-1][order], count[order]
    top = evidence.max(axis=1, keepdims=True) if len(evidence) else evidence
    e = np.exp(evidence - top)
    t = np.exp(transitions)
    forward = np.empty_like(e)
    scale = np.empty(len(e))
    steps = int(length[0]) if len(length) else 0
    alive = len(length) - np.searchsorted(length[::-1], np.arange(steps), side="right")
    last = np.zeros((len(order), e.shape[1]))
    for i in range(steps):
        n = alive[i]
        at = begin[:n] + i
        now = e[at] if i == 0 else (last[:n] @ t) * e[at]
        s = now.sum(axis=1)
        now /= s[:, None]
        forward[at], scale[at], last[:n] = now, s, now
    out = forward  # the backward pass overwrites it place by place
    pairs = np.zeros_like(t)
    behind = np.ones((len(order), e.shape[1]))
    for i in range(steps - 1, -1, -1):
        n = alive[i]
        at = begin[:n] + i
        own = forward[at] * behind[:n]
        own /= own.sum(axis=1)[:, None]
        if i:
            step = e[at] * behind[:n] / scale[at][:, None]
            pairs += (forward[at - 1].T @ step) * t
            behind[:n] = step @ t.T
        out[at] = own
    logs = np.log(scale) + top[:, 0] if len(e) else scale
    partition = np.add.reduceat(logs, first[:-1][count > 0]) if (count > 0).any() else np.zeros(0)
    return out, partition, pairs


# ---- training ------------------------------------------------------------------------------------------------------------------


def fit_field(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, seed: int = SEED,
) -> Field:
    """A field fitted on about ``per_language`` documents of each language. Missing languages and texts teach nothing."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(doc_id, F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = sorted((r["lang"], r["count"]) for r in known.groupBy("lang").count().collect())  # a row per language
    languages = [name for name, _ in counts]
    if not languages:
        return Field([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0, U))
    shares = F.create_map(*[F.lit(x) for name, n in counts for x in (name, min(1.0, per_language / n))])
    picked = known.where(key_hash(doc_id, seed) < shares[F.col("lang")] * HASH_RANGE)

    def cut(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1)):
                words = Words(data, begins)
                names, texts = [], []
                keys = words.stretch(words.sums(), words.begins[:-1], words.begins[1:])
                for i in range(b - a):
                    n = int(words.count[i])
                    draw = np.random.default_rng(int(keys[i] >> U(1)))
                    for _ in range(min(SEGMENTS, -(-n // SEGMENT_WORDS))):
                        f = int(words.first[i]) + int(draw.integers(0, max(1, n - SEGMENT_WORDS + 1)))
                        g = min(f + SEGMENT_WORDS, int(words.first[i + 1])) - 1
                        texts.append(words.data[words.start[f] : words.end[g]].tobytes().decode())
                        names.append(batch.column(0)[a + i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["lang", "text"])

    segments = stored(picked.select("lang", "text").mapInArrow(cut, "lang string, text string"))
    table = segments.toPandas().sort_values(["lang", "text"], kind="stable")  # bounded: per_language x SEGMENTS rows of each language
    return _train(list(table["text"]), np.searchsorted(languages, table["lang"].to_numpy(str)), languages, seed)


def _train(texts: list[str], label: np.ndarray, languages: list[str], seed: int) -> Field:
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(texts))
    words = Words(*flat(pa.array([texts[i] for i in order], pa.string())))
    gold = np.repeat(label[order], words.count)
    if not len(words):
        return Field(languages, np.zeros((BUCKETS, len(languages))), np.zeros((len(languages),) * 2), np.zeros(0, U))
    first = words.first[:: JOINED]
    if first[-1] != words.first[-1]:
        first = np.append(first, words.first[-1])
    hashes, at, of = np.unique(words.hashes(), return_index=True, return_inverse=True)
    lexicon = hashes[np.bincount(of) >= LEXICON_COUNT]
    which, buckets = word_features(words, at, hashes, lexicon)
    n, k = len(at), len(languages)
    truth = np.stack([np.bincount(of, gold == j, minlength=n) for j in range(k)], axis=1)
    inner = np.ones(len(words), bool)
    inner[first[:-1]] = False
    later = np.flatnonzero(inner)
    seen = np.bincount(gold[later - 1] * k + gold[later], minlength=k * k).reshape(k, k)
    weights, transitions = np.zeros((BUCKETS, k)), np.zeros((k, k))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, transitions)]
    for step in range(1, STEPS + 1):
        evidence = emissions(which, buckets, n, weights)
        p, _, pairs = posteriors(evidence[of], first, transitions)
        off = truth - np.stack([np.bincount(of, p[:, j], minlength=n) for j in range(k)], axis=1)
        up = np.stack([np.bincount(buckets, off[which, j], minlength=BUCKETS) for j in range(k)], axis=1)
        for x, g, m in ((weights, up / len(words) - DECAY * weights, moments[0]), (transitions, (seen - pairs) / len(words) - DECAY * transitions, moments[1])):
            m[0][:] = 0.9 * m[0] + 0.1 * g
            m[1][:] = 0.99 * m[1] + 0.01 * g * g
            x += RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-7)
    return Field(languages, weights, transitions, lexicon)


# ---- prediction ------------------------------------------------------------------------------------------------------------------


def _has_letter(words: Words) -> np.ndarray:
    """Per text, whether any character is a letter; only texts without a-z are looked at character by character."""
    upto = np.concatenate(([0], np.cumsum(LETTER[words.data])))
    plain = upto[words.begins[1:]] > upto[words.begins[:-1]]
    for i in np.flatnonzero(~plain & (words.count > 0)).tolist():
        plain[i] = any(c.isalpha() for c in words.data[words.begins[i] : words.begins[i + 1]].tobytes().decode())
    return plain


def label_words(words: Words, field: Field) -> np.ndarray:
    """Per word the probability of each language."""
    hashes, at, of = np.unique(words.hashes(), return_index=True, return_inverse=True)
    which, buckets = word_features(words, at, hashes, field.lexicon)
    return posteriors(emissions(which, buckets, len(at), field.weights)[of], words.first, field.transitions)[0]


def languages(docs: DataFrame, field: Field, *, doc_id: str = "doc_id", text: str = "text", per_word: bool = False) -> DataFrame:
    """One row per document row: doc_id, lang_pred, score (the language's share of the words), and word_langs on request.

    ``und`` with score 0 stands for texts that are missing or have no letter, and for a field without languages. Words
    without letters take part in the chain but not in the shares. Ties go to the first language in code point order.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        field = shared.value
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1)):
                words = Words(data, begins)
                names, score = np.full(b - a, "und", object), np.zeros(b - a)
                tags = None
                if field.languages and len(words):
                    p = label_words(words, field)
                    upto = np.concatenate(([0], np.cumsum((LETTER | (np.arange(256) >= 0x80))[words.data])))
                    lettered = (upto[words.end] > upto[words.start])[:, None]
                    sums = np.concatenate((np.zeros((1, p.shape[1])), np.cumsum(p * lettered, axis=0)))
                    mass = sums[words.first[1:]] - sums[words.first[:-1]]
                    ok = _has_letter(words) & (mass.sum(axis=1) > 0)
                    best = mass.argmax(axis=1)
                    names[ok] = np.array(field.languages, object)[best[ok]]
                    score[ok] = np.clip(mass[ok, best[ok]] / mass[ok].sum(axis=1), 0, 1)
                    tags = np.array(field.languages, object)[p.argmax(axis=1)]
                columns = [batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(score)]
                if per_word:
                    columns.append(pa.ListArray.from_arrays(pa.array(words.first.astype(np.int32)), pa.array(tags if tags is not None else [], pa.string())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "word_langs"][: len(columns)])

    schema = f"doc_id {kind}, lang_pred string, score double" + (", word_langs array<string>" if per_word else "")
    return docs.select(doc_id, text).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """The rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
