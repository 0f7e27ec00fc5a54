import numpy as np
import pyarrow as pa
import pytest
from itertools import product
from pyspark.sql import functions as F

import brute
from conftest import pairs
from tabforge.llm import language
from tabforge.llm.toxicity import accepted, fit_chain, toxicity
from tabforge.llm.words import Words, flat


# ---- toxicity ------------------------------------------------------------------------------------------------------------


def toxic_rows(n=900, seed=2):
    draw = np.random.default_rng(seed)
    plain, bad = [f"word{i}" for i in range(300)], ["grumble", "grumbling", "grumbled", "nastyfoo"]
    rows, labels = [], []
    for i in range(n):
        own = draw.choice(plain, int(draw.integers(5, 200))).tolist()
        toxic = i % 7 == 0
        if toxic:
            own[int(draw.integers(len(own)))] = str(draw.choice(bad))
        rows.append((i, " ".join(own)))
        if i % 3:
            labels.append((i, int(i % 5 > 0), int(toxic)))
    return rows, labels


def test_chain_finds_toxic_texts_it_has_not_seen(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = fit_chain(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r["is_toxic"] for r in toxicity(docs, chain).collect()}
    unseen = [i for i in range(900) if i % 3 == 0]
    hits = sum(got[i] == (i % 7 == 0) for i in unseen)
    assert hits / len(unseen) > 0.99
    again = fit_chain(docs.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(3))
    assert all(np.array_equal(a, b) for a, b in zip(chain.weights, again.weights)) and chain.thresholds == again.thresholds


def test_a_later_model_uses_the_earlier_probability(spark):
    # the second category follows from the first one alone
    rows = [(i, f"common {'sign' if i % 2 else 'other'} text{i % 11}") for i in range(400)]
    labels = [(i, i % 2, i % 2) for i in range(400)]
    chain = fit_chain(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, first int, second int"),
                      categories=(("first", "first", 1), ("second", "second", 1)))
    assert chain.names == ["first", "second"] and len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert abs(chain.weights[1][-2]) > 0.1


def test_toxicity_of_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in toxicity(docs, fit_chain(docs, labels)).collect()}
    assert len(got) == docs.count() and all(0 <= r["p_toxic"] <= 1 for r in got.values())
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert np.mean([got[d]["is_toxic"] == bool(y) for d, y in known.items()]) > 0.95


def test_toxicity_of_hard_rows(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 0, 0), (None, 1, 1), (4, None, 1), (5, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    chain = fit_chain(hard, labels)
    got = toxicity(hard, chain)
    assert got.count() == hard.count() and got.where("is_toxic and doc_id in (4, 5, 6, 7)").count() == 0
    kept = accepted(hard, labels)
    assert kept.schema == hard.schema and kept.count() <= hard.count()
    none = labels.limit(0)
    assert accepted(hard, none).count() == hard.count() and accepted(nothing, labels).count() == 0 and accepted(nothing, none).count() == 0


# ---- language ------------------------------------------------------------------------------------------------------------------


def test_forward_backward_against_all_labellings():
    draw = np.random.default_rng(1)
    lengths = [4, 0, 1, 3]
    first = np.concatenate(([0], np.cumsum(lengths)))
    evidence, transitions = draw.normal(size=(first[-1], 3)) * 3, draw.normal(size=(3, 3))
    got, partition, pairs_ = language.posteriors(evidence.copy(), first, transitions)
    want, logs, moves = np.zeros_like(evidence), [], np.zeros((3, 3))
    for a, b in zip(first, first[1:]):
        if a == b:
            continue
        weights = {y: np.exp(sum(evidence[a + i, c] for i, c in enumerate(y)) + sum(transitions[c, d] for c, d in zip(y, y[1:]))) for y in product(range(3), repeat=b - a)}
        whole = sum(weights.values())
        logs.append(np.log(whole))
        for y, w in weights.items():
            for i, c in enumerate(y):
                want[a + i, c] += w / whole
            for c, d in zip(y, y[1:]):
                moves[c, d] += w / whole
    assert np.allclose(got, want) and np.allclose(partition, logs) and np.allclose(pairs_, moves)


def test_features_of_a_word():
    words = Words(*flat(pa.array(["abcd abx", "abcd"])))
    hashes = words.hashes()
    which, buckets = language.word_features(words, np.arange(3), hashes, np.sort(hashes[:1]))
    own = [sorted(buckets[which == i].tolist()) for i in range(3)]
    assert own[0] == own[2] and len(own[0]) == 4 + 4 + 2 + 1 and len(set(own[0]) & set(own[1])) >= 2


def test_code_switched_text_is_labelled_word_by_word(spark):
    a, b = "red apple falls under the tree again".split(), "roter apfel fällt unter dem baum wieder".split()
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(draw.choice(a if i % 2 else b, 30)), "en" if i % 2 else "de") for i in range(120)]
    field = language.fit_field(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = spark.createDataFrame([(1, " ".join(a + b)), (2, " ".join(b + a[:2]))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.languages(mixed, field, per_word=True).collect()}
    assert got[1]["word_langs"] == ["en"] * 7 + ["de"] * 7 and got[2]["word_langs"] == ["de"] * 7 + ["en"] * 2
    assert got[2]["lang_pred"] == "de" and got[2]["score"] == pytest.approx(7 / 9, abs=0.03)
    assert (np.diag(field.transitions) > field.transitions.mean()).all()


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = language.fit_field(docs.where(~language.held_out()))
    both = language.languages(docs, field).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out()).collect()
    assert len(both) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in both]) > 0.95


def test_languages_of_hard_rows(spark, hard, nothing):
    field = language.fit_field(hard.where(~language.held_out()))
    for df in (hard, nothing):
        got = language.languages(df, field, per_word=True).collect()
        assert len(got) == df.count()
        for r, (_, text) in zip(got, pairs(df)):
            assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not brute.has_letter(text))
            assert len(r["word_langs"]) in (0, len(brute.words(text)))
    empty = language.fit_field(nothing)
    assert {r["lang_pred"] for r in language.languages(hard, empty).collect()} == {"und"}


def test_held_out_rows(spark):
    import zlib

    got = {r["doc_id"]: r["h"] for r in spark.range(200).select(F.col("id").alias("doc_id")).withColumn("h", language.held_out()).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}
