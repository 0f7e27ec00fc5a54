from collections import Counter

import numpy as np
import pytest

import brute
import corpus_pipeline
from conftest import pairs
from tabforge.llm.contamination import contaminated_words, decontaminated, is_contaminated, uncontaminated, without_spans
from tabforge.llm.licenses import BASE, license_summary
from pyspark.sql import functions as F


def digest(found):
    return Counter(pairs(found.select(
        "doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ",").cast("binary"), 256), is_contaminated()), "*"))


ITEMS = [
    (1, " ".join(f"w{i}" for i in range(40))), (2, " ".join(f"w{i}" for i in range(10, 30))), (3, "One, two."), (4, None), (5, "..."),
    (6, " ".join(["k"] * 20)), (7, " ".join(["k"] * 30)), (8, "tok1 tok2 tok3 tok4 tok5 tok6 tok7 tok8 tok9 tok10 tok11 tok12 tok13 tok14"), (8, "W1 w2"),
]


@pytest.mark.parametrize("block_words", [60_000, 30])
def test_contamination_of_hard_rows(spark, hard, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = digest(contaminated_words(hard, items, block_words=block_words))
    assert got == Counter(brute.contaminated(pairs(hard), ITEMS))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contamination_of_random_texts(spark, seed):
    draw = np.random.default_rng(seed)
    line = lambda n: " ".join(draw.choice(["a", "b", "c"], n))
    items = [(i, line(int(draw.integers(0, 25)))) for i in range(8)]
    docs = [(i, line(int(draw.integers(0, 200)))) for i in range(40)] + [(99, "x " + items[0][1] + " y")]
    got = digest(contaminated_words(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=13))
    assert got == Counter(brute.contaminated(docs, items))


def test_long_items_are_cut_without_losing_windows(spark, hard):
    items = [(1, " ".join(f"w{i % 4001}" for i in range(45_000))), (2, "nothing of this")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["n_hit"] for r in contaminated_words(hard, table, block_words=10_000).collect()}
    assert got[8] == 60_000 and got[12] == 60_000 and got[1] == 0


def test_uncontaminated_keeps_rows_whole(spark, hard):
    items = spark.createDataFrame([(8, " ".join(f"tok{i}" for i in range(30)))], "item_id long, text string")
    kept = uncontaminated(hard, items)
    assert kept.columns == hard.columns
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14]


def test_contamination_of_and_by_nothing(spark, hard, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated_words(nothing, none).count() == 0
    assert contaminated_words(hard, none).where("n_hit > 0").count() == 0 and uncontaminated(hard, none).count() == hard.count()


PASSAGE = " ".join(f"q{i}" for i in range(14))
FILL = " ".join(f"f{i}" for i in range(400))


@pytest.mark.parametrize("block_words", [60_000, 30])
def test_spans_are_cut_from_what_stays(spark, block_words):
    items = spark.createDataFrame([(1, PASSAGE), (2, " ".join(f"r{i}" for i in range(13))), (3, "Only two")], "item_id long, text string")
    nested = PASSAGE.replace("q7", " ".join(f"r{i}" for i in range(13)) + " q7")  # the cut brings an item together
    rows = [
        (1, f"Start: {PASSAGE.upper()}, é end. {FILL}"), (2, f"{FILL}\n{PASSAGE}"), (2, f"{FILL}\n{PASSAGE}"), (3, PASSAGE), (4, FILL), (5, None),
        (None, f"{nested} {FILL} {FILL}"), (6, f"{FILL} only. TWO é {PASSAGE} x"),
    ]
    df = spark.createDataFrame([(*r, len(r[1] or ""), 7) for r in rows], "doc_id long, text string, n_chars int, _cuts int")
    got = without_spans(df, items, block_words=block_words)
    assert got.schema == df.schema and got.where("n_chars <> length(coalesce(text, ''))").count() == 0
    whole = Counter(pairs(got))
    assert whole == Counter([(1, f"Start: , é end. {FILL}"), (2, f"{FILL}\n"), (2, f"{FILL}\n"), (3, ""), (4, FILL), (5, None), (None, f"{FILL} {FILL}"), (6, f"{FILL} é x")])
    assert contaminated_words(got, items).where("n_hit > 0").count() == 0
    # the verdict is on the given texts: what it rejects goes, the rest is cut
    kept = {d for d, _ in pairs(uncontaminated(df, items))}
    assert kept == {1, 2, 4, 5, None, 6}
    assert Counter(pairs(decontaminated(df, items, block_words=block_words))) == Counter({r: n for r, n in whole.items() if r[0] in kept})


def test_limits_of_spans(spark):
    items = spark.createDataFrame([(1, PASSAGE), (2, "only two")], "item_id long, text string")
    df = spark.createDataFrame([(1, f"{FILL} only two {PASSAGE} x only two"), (2, "a only two"), (3, f"only two {FILL}")], "doc_id long, text string")
    got = dict(pairs(without_spans(df, items, most_words=2)))
    assert got == {1: f"{FILL} x only two", 2: "a ", 3: f"only two {FILL}"}


def test_stage_leaves_no_benchmark_passage(spark, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, f"{FILL} {PASSAGE} x", "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    found = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, str(tmp_path))
    assert found.columns == docs.columns and pairs(found) == [(1, f"{FILL} x")]


# ---- licenses ----------------------------------------------------------------------------------------------------------------

NOTICES = [
    (1, "CC BY 4.0. All rights reserved, all rights  reserved! cc-by"), (2, "x general public license general public license"), (3, None), (4, ""),
    (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this big software and associated documentation files"),
    (6, "all rights all rights reserved cc cc by"), (7, "Allé rights reserved"), (8, " ".join(["cc by"] * 5_000)), (1, "Released under the MIT License."),
    (9, "You may not use this file except in writing"),
]


def test_base_phrases_and_more(spark):
    df = spark.createDataFrame([(*r, 3, "x", 1) for r in NOTICES], "doc_id long, text string, row int, label string, hits int").repartition(3)
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in license_summary(df).collect())
    want = Counter()
    for d, t in NOTICES:
        n, places, first, last, labels = brute.phrases(t, BASE)
        want[(d, n, places, first, last, ",".join(sorted(labels)))] += 1
    assert got == want
    labels = {(r["doc_id"], r["n_words"]): (r["labels"], r["score"]) for r in license_summary(df).collect()}
    assert labels[(5, 21)][0] == "mit" and 0.8 <= labels[(5, 21)][1] < 1
    assert labels[(1, 5)] == ("mit", 1.0) and labels[(9, 9)] == ("", 0.0) and labels[(3, 0)] == ("", 0.0)


def test_base_phrases_of_documents(documents):
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in license_summary(documents).collect()}
    for d, t in pairs(documents):
        *numbers, labels = brute.phrases(t, BASE)
        assert got[d] == (*numbers, ",".join(sorted(labels)))


def test_licenses_of_nothing(nothing, hard):
    assert license_summary(nothing).count() == 0 and license_summary(hard).count() == hard.count()
