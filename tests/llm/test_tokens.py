import zlib
from collections import Counter
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from conftest import pairs
from tabforge.llm.mixing import apportion, mixed, mixture
from tabforge.llm.separators import FILE_SCHEMA, document_counts, write_flat
from tabforge.llm.words import flat
from tabforge.llm.tokens import BLOCK, Encoder, default_tokenizer, pack, read_ids, token_index, unpack, write_tokens
from pyspark.sql import functions as F

ENCODER = Encoder(default_tokenizer())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000) | st.integers(0, 3), max_size=300), st.sampled_from([1, 7, 64, BLOCK]))
def test_packing_round_trip(ids, block):
    ids = np.array(ids, np.uint32)
    words, offsets = pack(ids, block)
    assert unpack(words, offsets, len(ids), block).tolist() == ids.tolist()


def test_blocks_decode_alone_and_small_ids_share_words():
    ids = np.concatenate((np.ones(BLOCK * 2, np.uint32), np.arange(BLOCK + 5, dtype=np.uint32) * 1_000_003))
    words, offsets = pack(ids)
    own = unpack(words[offsets[2] : offsets[3]], offsets[2:4] - offsets[2], BLOCK)
    assert own.tolist() == ids[2 * BLOCK : 3 * BLOCK].tolist() and offsets[1] == -(-BLOCK // 60)


TEXT = st.text(alphabet=st.sampled_from(list(" \n\t  abé你'1.!s<|>\x1c\x85")) | st.characters(codec="utf-8"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT | st.sampled_from(["a <|endoftext|> b", "  it's  1 don't ", "\n \nb", "a ", " a"]), max_size=6))
def test_pieces_encode_like_whole_texts(texts):
    ids, sizes = ENCODER.encode(texts)
    whole = [ENCODER.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in whole for i in w] and sizes.tolist() == [len(w) for w in whole]


def test_a_text_that_is_not_plain_may_begin_with_a_plain_piece():
    fresh = Encoder(default_tokenizer())  # knows no piece yet
    ids, sizes = fresh.encode(["one two b\n\nc"])
    assert ids.tolist() == fresh.tokenizer.encode("one two b\n\nc", add_special_tokens=False).ids == ids[: sizes[0]].tolist()


HARD_TEXT = st.text(alphabet=st.sampled_from(list(" \n\t'strevmldSa1!.\u00a0\u2003\u0301é٣中\U0001f600\U00020000")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(HARD_TEXT, max_size=5))
def test_pieces_begin_where_the_tokenizer_cuts(texts):
    data, begins = flat(pa.array(texts, pa.string()))
    got = ENCODER._starts(data, begins).tolist() if len(data) else []
    want = []
    for text, begin in zip(texts, begins.tolist()):
        cut = ENCODER.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        want += [begin + len(text[:a].encode()) for _, (a, _) in cut]
    assert got == want


@pytest.mark.parametrize("special_as_text", [False, True])
def test_added_tokens_within_texts(special_as_text):
    encoder = Encoder(default_tokenizer(), special_as_text)
    texts = ["it's plain", None, "a <|endoftext|>  b", "", "<|endoftext|>", "don't\r\n\n stop ", "x<|endoftext|"]
    ids, sizes = encoder.encode(texts)
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in whole for i in w] and sizes.tolist() == [len(w) for w in whole]


def test_a_full_memo_keeps_the_pieces_in_use(monkeypatch):
    encoder = Encoder(default_tokenizer(), memo=40_000)
    common = " of the word"
    encoder.encode(["x" + common])
    asked = []
    own = encoder._byte_texts
    monkeypatch.setattr(encoder, "_byte_texts", lambda pieces: asked.extend(pieces) or own(pieces))
    for i in range(400):
        encoder.encode([f"x{common} q{chr(97 + i % 26)}{chr(97 + i // 26)}z. word, word; word"])
    assert not {b"x", b" of", b" the", b" word"} & set(asked)  # nor a piece again for each sign after it
    assert encoder.size <= 20_000 and len(encoder.young) + len(encoder.elder) < 400


def test_a_worker_keeps_no_memo_between_tasks(spark, documents, tmp_path):
    write_tokens(documents, str(tmp_path / "t"))

    def held(batches):
        from tabforge.llm import tokens

        for batch in batches:
            n = sum(len(e.young) + len(e.elder) for e in tokens._encoders.values())
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], names=["n"])

    assert {n for n, in spark.range(64).repartition(16).mapInArrow(held, "n long").collect()} == {0}


def expected_index(rows):
    out, start = Counter(), 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*ENCODER.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out[(d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    return out


def test_index_of_documents(spark, documents, tmp_path):
    assert Counter(pairs(token_index(documents.repartition(5), str(tmp_path / "t"), chunk_ids=5_000), "*")) == expected_index(pairs(documents))
    first = read_ids(spark, str(tmp_path / "t")).where("doc_id = 0").first()["ids"]
    assert ENCODER.tokenizer.decode(first[:-1], skip_special_tokens=False) == documents.where("doc_id = 0").first()["text"]


def test_index_of_hard_rows_and_of_nothing(hard, nothing):
    assert Counter(pairs(token_index(hard), "*")) == expected_index(pairs(hard))
    assert token_index(nothing).count() == 0


# ---- separator scan --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 3, 50])
@pytest.mark.parametrize("segment", [2, 1024])
def test_documents_over_block_ends(spark, block, segment):
    draw = np.random.default_rng(block)
    rows, want = [], Counter()
    for file in range(4):
        ids = draw.choice([5, 6, 9], int(draw.integers(0, 60)), p=[0.6, 0.3, 0.1]).astype("<u2")
        rows += [(file, i, ids[a : a + block].tobytes()) for i, a in enumerate(range(0, len(ids), block))]
        start = 0
        ends = [*np.flatnonzero(ids == 9).tolist()]
        for n, e in enumerate(ends):
            want[(file, n, start, e + 1 - start, True)] += 1
            start = e + 1
        if start < len(ids):
            want[(file, len(ends), start, len(ids) - start, False)] += 1
    files = spark.createDataFrame(rows, FILE_SCHEMA).repartition(5)
    assert Counter(pairs(document_counts(files, end_id=9, segment=segment), "*")) == want


def test_counts_of_flat_files(spark, hard, documents, nothing):
    for df in (hard, documents, nothing):
        folder = f"{spark.conf.get('spark.checkpoint.dir')}/{uuid4().hex}"
        write_flat(df, folder, block_ids=1_000)
        plain = Encoder(default_tokenizer(), special_as_text=True).tokenizer
        want = Counter(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs(df))
        got = document_counts(spark.read.schema(FILE_SCHEMA).parquet(folder))
        assert Counter(r["n_tokens"] for r in got.collect()) == want and got.where("not complete").count() == 0


# ---- mixing --------------------------------------------------------------------------------------------------------------------


def test_apportionment_by_highest_quotients(spark):
    draw = np.random.default_rng(4)
    for seats in (0, 1, 7, 40, 10_000):
        votes = [*draw.integers(1, 60, 9).astype(float).tolist(), 5.0, 5.0, 5.0, 0.0]
        caps = [*draw.integers(1, 30, 9).tolist(), 3, 3, 3, 4]
        got = {r["p"]: r["quota"] for r in apportion(spark.createDataFrame(list(zip(range(13), votes, caps)), "p int, votes double, cap long"), seats, key=["p"]).collect()}
        quotients = sorted(((-v / (2 * k + 1), p) for p, (v, c) in enumerate(zip(votes, caps)) if v for k in range(c)))[:seats]
        assert got == {p: sum(q == p for _, q in quotients) for p in range(13)}


def test_mix_of_hard_rows(hard):
    got = mixed(hard).collect()
    assert len(got) == hard.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    aims = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert sum(t for t, _ in aims.values()) == pytest.approx(total) and all(t <= 3 * s for t, s in aims.values())
    order = sorted(aims, key=lambda s: (s is None, s or ""))
    free = {s: aims[s][0] / (i % 3 + 1) for i, s in enumerate(order) if aims[s][0] < 3 * aims[s][1] * 0.999}
    assert max(free.values()) == pytest.approx(min(free.values()))
    for source, (target, size) in aims.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == source) - target) <= 64
    assert sorted(map(tuple, mixed(hard.repartition(3)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_mixture_holds_the_words_taken(hard, documents, nothing):
    for df in (hard, documents):
        taken = Counter()
        for r in mixed(df).collect():
            taken[r["doc_id"]] += r["taken"]
        out = mixture(df)
        assert out.schema.names == df.schema.names
        got, texts = Counter(), {d: (t or "").split() for d, t in pairs(df)}
        for d, t in pairs(out):
            own = t.split()
            got[d] += len(own)
            whole = " ".join(texts[d])
            assert " ".join(own) in whole
        assert got == +taken
    assert mixed(nothing).count() == 0 and mixture(nothing).count() == 0
