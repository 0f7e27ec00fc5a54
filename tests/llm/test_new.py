"""The hash manifest, the quality rules and the periodic runs against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import DOCS, pairs
from tabforge.llm.merkle import manifest
from tabforge.llm.quality import fit_model, good, judged
from tabforge.llm.runs import find_runs, periodic_runs, repeated_tail, run_summary

QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


# ---- manifest ----


def check_manifest(df):
    same(map(tuple, manifest(df).collect()), brute.manifest([r.asDict() for r in df.collect()]))


def test_manifest_of_documents_and_hard_rows(documents, hard, nothing):
    for df in (documents, hard, nothing):
        check_manifest(df)


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (256, 1), (257, 16, 1), (4097, 2, 33)])
def test_manifest_levels(spark, sizes):
    rows = [(s * 10_000 + i, f"Text {i}", None, f"s{s}" if s else None, i) for s, n in enumerate(sizes) for i in range(n)]
    check_manifest(spark.createDataFrame(rows, DOCS))


def test_manifest_of_many_sources(spark):
    rows = [(i, f"T{i % 3}", "en", f"é{i % 300}", 1) for i in range(700)] + [(5, "T2", "en", "é5", 1)] * 40
    check_manifest(spark.createDataFrame(rows, DOCS).repartition(7))


# ---- quality ----


def test_base_rules(documents, hard, nothing, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [
        (1, "a\n\nb\n a\na\n" * 9, None, None, 1), (2, "x#y $% & | <b> *\n" * 3, None, None, 1), (3, "é " * 8 + "ü\x0b你 " * 12, None, None, 1),
        (4, "\n".join(f"w{i}" for i in range(40)), None, None, 1), (5, "a b c d e f g h " * 2 + " ".join(map(str, range(40))), None, None, 1),
        (6, "\n", None, None, 1), (7, "AB ab aB " * 3, None, None, 1),
    ]
    for df in (documents, hard, nothing, spark.createDataFrame(rows, DOCS)):
        model = fit_model(df, labels)
        same(map(tuple, judged(df, model).select(*QUALITY).collect()), [(d, *brute.base_quality(t)) for d, t in pairs(df)])
        assert good(df, model).columns == df.columns
        same(pairs(good(df, model), "doc_id"), pairs(judged(df, model).where("kept"), "doc_id"))


def test_verdicts(spark):
    rng = random.Random(3)
    clean = [f"word{i}" for i in range(150)]
    dirty = [f"junk{i}!!" for i in range(150)]
    text = lambda words: " ".join(rng.choices(words, k=120))
    rows = [(i, text(dirty if i % 5 == 0 else clean), "en", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 400, 3)] + [(1, None, 0), (None, 1, 0), (4, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    verdicts = dict(pairs(judged(docs, fit_model(docs, labels)), "doc_id", "kept"))
    assert {d for d, kept in verdicts.items() if not kept} == {i for i in range(0, 400, 5)}
    # nothing trusted: the base rules alone decide
    model = fit_model(docs, labels.limit(0))
    assert model.threshold is None and judged(docs, model).where("NOT kept").count() == 0
    # a model does not depend on how the table is cut
    again = fit_model(docs.repartition(5), labels)
    assert np.isclose(again.threshold, fit_model(docs, labels).threshold)


# ---- runs ----


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(800):
        docs = []
        for _ in range(rng.randint(1, 5)):
            k, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 40)
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                w = w[: n // 3] + [rng.randrange(k) for _ in range(rng.randint(1, 5))] * rng.randint(2, 9) + w[n // 2 :]
            docs.append(w)
        first = np.cumsum([0, *map(len, docs)])
        got = find_runs(np.array([x for d in docs for x in d], np.int64), first).tolist()
        assert got == [[s + f, n, q] for d, f in zip(docs, first.tolist()) for s, n, q in brute.runs(d)]


@pytest.mark.parametrize("words, runs", [([7] * 30_000, 1), (list(range(997)) * 20, 1), ([x for i in range(5000) for x in (100 + i, 1, 2, 3, 4, 5)], 0)])
def test_runs_of_long_texts(words, runs):
    assert len(find_runs(np.array(words, np.int64), np.array([0, len(words)]))) == runs


def test_run_rows(documents, hard, nothing):
    for df in (documents, hard, nothing):
        df = df.where(F.coalesce(F.length("text"), F.lit(0)) < 20_000)  # the plain version is quadratic
        same(map(tuple, run_summary(periodic_runs(df, tail=repeated_tail)).collect()), [brute.run_row(*r) for r in pairs(df)])


def test_collapsed_text(spark, hard):
    df = spark.createDataFrame([(1, " a b\ta b a  b a b c "), (2, "X x X x"), (3, "z\nz z z z z"), (4, None)], "doc_id long, text string")
    assert dict(pairs(periodic_runs(df), "doc_id", "collapsed")) == {1: "a b c", 2: "X x X x", 3: "z", 4: ""}
    long = {r["doc_id"]: r for r in periodic_runs(hard).collect()}
    assert [tuple(x) for x in long[8]["runs"]] == [(0, 60_000, 4001)] and len(long[8]["collapsed"].split()) == 4001
