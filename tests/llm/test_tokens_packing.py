import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rampart.llm import packing, store, tokens
from rampart.llm.words import words_of
from tests.llm.conftest import prose

pytest.importorskip("tokenizers")
ODD = [None, "", "   ", "Don't  stop!!  it's <|endoftext|> x<|startoftext|>y", "Éá ñ İstanbul ΑΣ Σ ß", "a\xa0b c \x1c d",
       "1234 ab12cd $$$ &&&x it'S", "naïve—dash … 日本語テキスト 🙂🙂", "x" * 3000, "A.B,C;d"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_ids_equal_library(library):
    ids, at = tokens.WordCoder(tokens.tokenizer_path()).ids(words_of(pa.array(ODD, pa.string())))
    for i, t in enumerate(ODD):
        assert ids[at[i]:at[i + 1]].tolist() == library(t), t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_ids_equal_library_on_any_text(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path())
    ids, _ = tokens.coder(tokens.tokenizer_path()).ids(words_of(pa.array([text])))
    assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


def test_store_is_bounded(library):
    c = tokens.WordCoder(tokens.tokenizer_path(), limit=4)
    for k in range(5):
        text = prose(12, k)
        assert c.counts(words_of(pa.array([text]))).tolist() == [len(library(text))]


def test_counts_and_cache(spark, make, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "red"), (None, None), (50, "red")]
    cache = store.folder(spark, "cache")
    run = lambda d: sorted(map(tuple, tokens.count_tokens(d, tokens.tokenizer_path(), cache)
                               .select("doc_id", "n_bytes", "n_tokens").collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), len(library(t))) for i, t in rows), key=repr)
    assert run(make(rows)) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t in rows})
    assert run(make(rows)) == want
    assert spark.read.parquet(cache).count() == stored          # nothing was encoded again
    assert run(make([])) == []


def _pack(make, rows, **kw):
    return packing.pack(make(rows, kw.pop("parts", 3)), tokens.tokenizer_path(), **kw).collect()


@pytest.mark.parametrize("size,fan,parts", [(64, 2, 5), (512, 64, 2), (4096, 64, 1)])
def test_pieces_hold_every_id_once(make, library, size, fan, parts):
    rows = [(i, prose(3 + i * 11 % 300, i)) for i in range(40)] + [(100 + i, t) for i, t in enumerate(ODD)]
    got = _pack(make, rows, size=size, fan=fan, windows=4, parts=parts)
    ids = {i: library(t) + [2] for i, t in rows}
    seqs, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length))
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])

    def end(spans):
        at = 0
        for a, n in sorted(spans):
            assert a == at and n > 0
            at += n
        return at
    assert {d: end(s) for d, s in docs.items()} == {i: len(x) for i, x in ids.items()}
    full = [end(s) for s in seqs.values()]
    assert max(full) <= size and sum(n < size for n in full) <= 1


def test_pack_empty_and_repeated(make):
    assert _pack(make, []) == []
    got = _pack(make, [(1, None), (1, None), (None, "")])
    assert sorted(r.length for r in got) == [1, 1, 1] and len({r.sequence_id for r in got}) == 1
