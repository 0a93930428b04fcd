import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rampart.llm import words
from rampart.llm.words import Rolling, segments, slices, words_of

TEXT = st.text(alphabet=st.sampled_from("aBcé \t\n\x0b\x0c\r\xa0 x|🙂"), max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.booleans())
def test_words_equal_split(texts, lower):
    w = words_of(pa.array(texts, pa.string()), lower)
    for r, t in enumerate(texts):
        raw = (t or "").encode()
        want = raw.lower().split() if lower else raw.split()
        assert [w.word(i) for i in range(w.first[r], w.first[r + 1])] == want


def test_hash_depends_on_bytes_only():
    a = words_of(pa.array(["x foo bar", "foo"]))
    h = a.hashes()
    assert h[1] == h[3] and len(set(h.tolist())) == 3
    assert words_of(pa.array(["foo"])).hashes()[0] == h[1]


def test_long_word_and_blocks(monkeypatch):
    text = " ".join(["ab" * 10, "c" * 5000, "ab" * 10, "d"])
    want = words_of(pa.array([text])).hashes()
    monkeypatch.setattr(words, "_BLOCK", 64)
    monkeypatch.setattr(words, "_POW", words._POW[:128])
    assert (words_of(pa.array([text])).hashes() == want).all()


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([None, "a" * 50, "", "b", "c" * 200, "d"])], ["text"])
    parts = list(slices(batch, limit=60))
    assert sum(map(len, parts)) == 6 and len(parts) > 2
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_segments_stay_in_texts():
    w = words_of(pa.array(["a b c", "d", "", "e f"]))
    start, row = segments(w, 2)
    assert start.tolist() == [0, 1, 4] and row.tolist() == [0, 0, 3]
    h = w.hashes()
    same = words_of(pa.array(["b c"])).hashes()
    assert Rolling(h).of(np.array([1]), 2)[0] == Rolling(same).of(np.array([0]), 2)[0]
