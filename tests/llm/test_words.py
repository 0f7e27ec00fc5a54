import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from brute import words as plain
from tabforge.llm.words import Words, flat, slices, words_of

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aZ09 .\né你-", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_counts(texts):
    found = Words(*flat(pa.array(texts, pa.string())))
    data = found.data.tobytes()
    own = [data[a:b].decode() for a, b in zip(found.start, found.end)]
    assert own == [w for t in texts for w in plain(t)]
    assert found.count.tolist() == [len(plain(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    found = Words(*flat(pa.array(texts, pa.string())))
    own = [w for t in texts for w in plain(t)]
    hashes = found.hashes().tolist()
    assert len(set(zip(own, hashes))) == len(set(own)) == len(set(hashes))


def test_slices_hold_whole_texts_and_long_ones_alone():
    texts = pa.array(["aa", "b" * 50, None, "cc", "dd"], pa.string()).slice(1)
    seen = [(a, b, bytes(data)) for a, b, data, _ in slices(texts, 10)]
    assert seen == [(0, 1, b"b" * 50), (1, 4, b"ccdd")]


def test_grams_stay_within_a_text():
    found = Words(*flat(pa.array(["a b c", "a b", "b c"], pa.string())))
    at, hashes = found.grams(found.hashes(), 2)
    assert at.tolist() == [0, 1, 3, 5] and hashes[0] == hashes[2] and hashes[1] == hashes[3]
    assert words_of("All-Rights É") == ["all", "rights", "É"] and np.all(found.count == [3, 2, 2])
