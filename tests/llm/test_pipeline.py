import zlib
from collections import Counter

import numpy as np
import pytest

import brute
import corpus_pipeline
from conftest import pairs
from tabforge.llm import QUERIES, SQL
from tabforge.llm.tokens import Encoder, default_tokenizer
from tabforge.llm.toxicity import accepted

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = [pairs(docs)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs = docs.checkpoint()
        kept.append(pairs(docs))
        assert kept[-1], name
    for before, after in zip(kept[:2], kept[1:3]):  # these filters change no text
        assert set(after) <= set(before)
    assert len({brute.near_classes(kept[1])[d] for d, _ in kept[1]}) == len(kept[2])
    items = pairs(spark.read.parquet(f"{FOLDER}/benchmark.parquet"), "item_id", "text")
    judged = {r[0]: r for r in brute.contaminated(kept[2], items)}
    texts = dict(kept[2])
    assert {d for d, r in judged.items() if not r[-1]} == {d for d, _ in kept[3]}
    cut = 0
    for d, text in kept[3]:
        if judged[d][2]:  # hit, but not dropped: the text goes on without the hit words
            cut += 1
            assert len(brute.words(text)) <= judged[d][1] - judged[d][2]
        else:
            assert text == texts[d]
    assert not any(r[2] for r in brute.contaminated(kept[3], items)), cut
    texts = dict(kept[3])
    assert all(" ".join(t.split()) in " ".join(texts[d].split()) for d, t in kept[4])
    found = pairs(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER), "*")
    encoder = Encoder(default_tokenizer()).tokenizer
    want = Counter()
    for d, t in kept[4]:
        ids = [*encoder.encode(t, add_special_tokens=False).ids, 2]
        want[(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((r[0], r[2], r[3]) for r in found) == want


def test_run_and_hard_rows(spark, hard, tmp_path):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    for df in (hard, hard.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            some = df.count() > 0
            df = stage(spark, df, str(tmp_path)).checkpoint()
            assert (df.count() > 0) == some, name


@pytest.mark.parametrize("n", [0, 5, 87, 399])
def test_few_labels_reject_no_clean_document(spark, n):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    some = spark.createDataFrame(sorted(labels.collect())[:n], labels.schema)
    kept = {d for d, in pairs(accepted(docs, some), "doc_id")}
    clean = {d for d, in pairs(labels.where("toxic = 0"), "doc_id")}
    toxic = {d for d, in pairs(labels.where("toxic = 1"), "doc_id")}
    assert len(clean & kept) >= 0.98 * len(clean)
    if n == 399:
        assert len(toxic - kept) >= 0.6 * len(toxic)  # 51 toxic documents teach which words mark them


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_over_whole_tables(spark, name):
    found = QUERIES[name](spark, FOLDER)
    source = "pages" if name.startswith("op1_") else "documents"
    assert found.count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
    assert len(set(found.columns)) == len(found.columns)


def test_statements_belong_to_queries():
    assert set(SQL) <= set(QUERIES)
