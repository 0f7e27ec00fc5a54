from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import pairs
from tabforge.llm import near
from tabforge.llm.exact import exact_copies, without_copies
from tabforge.llm.words import Words, flat


# ---- exact ---------------------------------------------------------------------------------------------------------------


def expected_copies(rows):
    import hashlib
    import re

    content = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(content(t), []).append(d)
    out = Counter()
    for d, t in rows:
        own = groups[content(t)]
        keep = min((x for x in own if x is not None), default=None)
        out[(d, keep, len(own), d == keep, hashlib.sha256(content(t).encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("digits", [64, 1])
def test_exact_copies_with_strong_and_clashing_digests(hard, digits):
    digest = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, digits)
    assert Counter(pairs(exact_copies(hard, digest=digest), "*")) == expected_copies(pairs(hard))


def test_exact_copies_of_documents(documents):
    assert Counter(pairs(exact_copies(documents), "*")) == expected_copies(pairs(documents))


def test_exact_copies_of_a_hot_text(spark):
    rows = [(i, "same  text" if i % 3 else f"text {i}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert Counter(pairs(exact_copies(df), "*")) == expected_copies(rows)
    assert without_copies(df).count() == 1_001


def test_exact_copies_of_nothing(nothing):
    assert exact_copies(nothing).count() == 0 and without_copies(nothing).columns == nothing.columns


# ---- near ------------------------------------------------------------------------------------------------------------------


def near_rows(seed=3, n_base=12):
    draw = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for b in range(n_base):
        base = draw.choice(vocabulary, int(draw.integers(3, 160))).tolist()
        for _ in range(int(draw.integers(1, 9))):
            own = list(base)
            for _ in range(int(draw.integers(0, 4))):
                own[int(draw.integers(len(own)))] = str(draw.choice(vocabulary))
            rows.append((len(rows), " ".join(own)))
    return rows


def classes(df):
    return {r["doc_id"]: r["class_id"] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_classes_against_all_pairs(spark, seed):
    rows = near_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert classes(near.near_classes(df)) == brute.near_classes(rows)


def test_near_classes_of_documents(documents):
    rows = pairs(documents)
    assert classes(near.near_classes(documents)) == brute.near_classes(rows)


def test_star_whose_leaves_are_not_alike(spark):
    # every variant is near the base and, mostly, not near another: links that one leader cannot show
    draw = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        own = list(base)
        for at in draw.choice(120, 2 + i % 3, replace=False):
            own[at] = f"x{i}_{at}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute.near_classes(rows)
    assert classes(near.near_classes(df)) == want
    assert classes(near.near_classes(df, chunk=7)) == want


def test_repeated_lines_weigh_by_their_number(spark):
    once, often = "a b c d e f g h", " ".join(["a b c d e f g h"] * 40)
    rows = [(1, once), (2, often), (3, often + " a b c d e f g h"), (4, " ".join(["k"] * 3000)), (5, " ".join(["k"] * 2700)), (6, " ".join(["k"] * 1000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(near.near_classes(df)) == brute.near_classes(rows) == {1: 1, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6}


def test_near_classes_of_hard_rows(hard):
    got = near.near_classes(hard).select("doc_id", "class_id", "class_size", "kept").collect()
    assert len(got) == hard.count()
    by_id = {r["doc_id"]: r for r in got}
    # equal words, equal or both missing texts, near texts
    assert {d: by_id[d]["class_id"] for d in by_id} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9, 10: 9, 11: 11, 12: 8, None: None, 13: 13, 14: 14}
    assert sum(r["kept"] for r in got) == len({r["class_id"] for r in got})
    kept = near.without_near_copies(hard)
    assert kept.columns == hard.columns and sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 1, 4, 6, 7, 8, 9, 11, 13, 14]


def test_one_of_rows_that_repeat_an_id_and_a_text(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text of its own here")], "doc_id long, text string")
    assert near.without_near_copies(df).count() == 2


def test_near_classes_of_nothing(nothing):
    assert near.near_classes(nothing).count() == 0 and near.without_near_copies(nothing).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)]
    found = {r["v"]: r["comp"] for r in near.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 260)]}}


def test_signatures_agree_as_often_as_bags_overlap():
    one = " ".join(f"a{i}" for i in range(300))
    two = " ".join([f"a{i}" for i in range(200)] + [f"b{i}" for i in range(150)] + ["z"] * 400)
    three = " ".join([f"a{i}" for i in range(100)] + ["z"] * 900)
    texts = [one, two, three]
    words = Words(*flat(pa.array(texts)))
    m = 4_000
    sig = near.signatures(*near.bags(words), 3, m)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        want = brute.similarity(brute.bag(texts[i]), brute.bag(texts[j]))
        assert abs((sig[i] == sig[j]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m) + 0.005
    assert (near.signatures(*near.bags(words), 3, m) == sig).all()
