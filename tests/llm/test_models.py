import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rampart.llm import lm, quality, toxicity
from rampart.llm.labelled import fold, logistic, one_of_copies, sigmoid, training_rows
from rampart.llm.words import words_of
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def _tables(spark, monkeypatch_dir, docs, labels):
    docs.write.mode("overwrite").parquet(f"{monkeypatch_dir}/documents.parquet")
    labels.write.mode("overwrite").parquet(f"{monkeypatch_dir}/labels.parquet")
    return str(monkeypatch_dir)


def _held_out(spark, op, target, sf=SF):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", target)
    return op(spark, sf).join(labels, "doc_id").where("held_out").toPandas()


def _auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_quality_on_held_out_rows(spark):
    got = _held_out(spark, quality.op8, "quality")
    assert _auc(got["score"].to_numpy(), got["quality"].to_numpy()) > 0.98
    assert got[got.quality == 1]["predicted"].mean() > 0.97 and got["score"].between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    got = _held_out(spark, toxicity.op6, "toxic")
    assert _auc(got["score"].to_numpy(), got["toxic"].to_numpy()) > 0.85
    assert got[got.toxic == 0]["predicted"].mean() < 0.02


@pytest.mark.parametrize("op,target", [(quality.op8, "quality"), (toxicity.op6, "toxic")])
def test_classifier_edges(spark, tmp_path, op, target):
    rows = [(i, prose(30, i) + (" BAD!! BAD!!" if i % 3 == 0 else "")) for i in range(60)]
    rows += [(None, "x"), (70, None), (71, ""), (72, " \n "), (1, rows[1][1]), (73, "w" * 5000), (74, "word " * 30000)]
    docs = spark.createDataFrame([(i, t, None, 1, 0.5) for i, t in rows], "doc_id long, text string, lang string, y int, score double")
    labels = [(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (5, None), (7, 0), (7, 1), (99, 1), (70, 0)]
    labels = spark.createDataFrame([(i, v, v) for i, v in labels], "doc_id long, quality int, toxic int")
    sf = _tables(spark, tmp_path, docs, labels)
    got = op(spark, sf).collect()
    assert len(got) == len(rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    once = collections.defaultdict(set)
    for r in got:
        once[r.doc_id].add((r.score, r.predicted, r.held_out))
    assert all(len(v) == 1 for v in once.values()) and not any(r.held_out for r in got if r.doc_id is None)
    assert once[71] and {s for s, _, _ in once[71]} == {s for s, _, _ in once[70]} == {s for s, _, _ in once[72]}
    none = _tables(spark, tmp_path / "none", docs.limit(0), labels.limit(0))
    assert op(spark, none).collect() == []
    unlabelled = _tables(spark, tmp_path / "unlabelled", docs, labels.limit(0))
    assert len({r.score for r in op(spark, unlabelled).collect()}) == 1


def test_held_out_labels_are_not_used(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {int(r.text[1:]) for r in training_rows(docs, labels, "quality", 5, 0).collect()}
    assert got == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert training_rows(docs, labels, "quality", 5, 0, rows=10).count() == 10
    folds = {r.i: r.f for r in docs.select(F.col("doc_id").alias("i"), fold("doc_id", 3).alias("f")).collect()}
    assert all(f == zlib.crc32(str(i).encode()) % 3 for i, f in folds.items())


def test_string_kernel_equals_brute_force():
    def brute(u, v):
        def phi(raw):
            s = [toxicity.START, *toxicity.letters(raw).tolist(), toxicity.END]
            out = collections.Counter()
            for i in range(len(s)):
                for j in range(i + 1, min(i + toxicity.SPAN, len(s))):
                    for k in range(j + 1, min(i + toxicity.SPAN, len(s))):
                        out[s[i], s[j], s[k]] += toxicity.DECAY ** (k - i + 1)
            return out
        a, b = phi(u), phi(v)
        dot = lambda x, y: sum(w * y[t] for t, w in x.items())
        return dot(a, b) / math.sqrt(dot(a, a) * dot(b, b))
    words = [b"idiot", b"i-d-i-o-t", b"idiiot", b"moron", b"papapapa", "été".encode()]
    g = toxicity.features(toxicity.grid([toxicity.letters(w) for w in words]))
    got = toxicity.kernel(g, g)
    for i, u in enumerate(words):
        for j, v in enumerate(words):
            assert abs(got[i, j] - brute(u, v)) < 1e-5
    assert got[0, 1] > 0.999 and got[0, 2] > got[0, 3]


def test_unit_scores_and_gaps():
    pos = [toxicity.letters(w) for w in (b"idiot", b"moron", b"stupid", b"worthless", b"loser")]
    neg = [toxicity.letters(w.encode()) for w in set(prose(400, 3).split())] + [toxicity.letters(f"ab{c}de{d}".encode()) for c in "xyz" for d in "klmno"]
    weight, bias = toxicity.train_units(pos, neg, [])
    m = toxicity.Model(weight, bias, np.array([1.0, 0, 0]))
    s = dict(zip(("idiot", "i.d.i.o.t", "idxiot", "stuupid", "gamma"), m.raw_units([b"idiot", b"i.d.i.o.t", b"idxiot", b"stuupid", b"gamma"])))
    assert min(s["idiot"], s["i.d.i.o.t"]) > 0 > s["gamma"] and s["idxiot"] > s["gamma"] and s["stuupid"] > s["gamma"]
    x = m.texts(words_of(pa.array(["a gamma b", "you i d i o t now", "", None, "gamma " + "z" * 300 + "idiot"])))
    assert x[1, 0] > 0 > x[0, 0] and x[2, 0] == x[3, 0] == toxicity.NOTHING


def test_random_index_terms():
    w = words_of(pa.array(["Hello hello WORLD!! wörld a$$$ a$$$ a$$$", "b | c", ""]))
    t = quality.terms(w)
    assert len(t) == len(w) and t[5] == t[6] != t[4]
    out = np.zeros((quality.BUCKETS, quality.DIM), np.float32)
    index = quality.index_vectors()
    quality.context_sums(words_of(pa.array(["b | c"])), np.array([1, 2, 3]), out, index)
    assert (out[2] == index[1] + index[3]).all() and (out[1] == index[2] + index[3]).all()


def test_net_and_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 2 * quality.DIM + 1))
    y = ((x[:, 0] * x[:, 1]) > 0).astype(int)               # not linear
    m = quality.train_net(x, y, quality.index_vectors(), epochs=40)
    assert ((m.logits(x) > 0) == y).mean() > 0.85 and 0.25 <= m.temperature <= 8


def test_logistic():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 2))
    y = (rng.random(2000) < sigmoid(2 * x[:, 0] - 1)).astype(float)
    w = logistic(x, y)
    assert abs(w[0] - 2) < 0.4 and abs(w[1]) < 0.3 and abs(w[2] + 1) < 0.3


def _base(rows):
    count = collections.Counter()
    toks = []
    for i, t in rows:
        w = (t or "").encode().lower().split() + [b"\n"]
        toks.append((i, w))
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            count.update(w)
    n, v = sum(count.values()), len(count)
    return [(i, len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for i, w in toks]


@pytest.mark.parametrize("frequent", [1 << 18, 8])
def test_language_model_rows(spark, make, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(i, prose(20 + i % 30, i % 17)) for i in range(80)] + [(90, None), (91, ""), (92, "novel wörds HERE"), (None, "alpha beta"),
                                                                    (93, "y" * 3000), (5, prose(20 + 5, 5))]
    got = lm.scores(make(rows), fold("id", 10) != 0).collect()
    key = lambda x: (repr(x[0]), x[1:])
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=key)
    assert mine == sorted(((*x[:4], round(x[4], 6)) for x in _base(rows)), key=key)
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)


def test_language_model_without_rows(spark, make):
    assert lm.scores(make([]), F.col("id") > 0).collect() == []
    got = lm.scores(make([(1, "a b")]), F.lit(False)).collect()
    assert got[0].train_tokens == 0 and got[0].n_known == 0 and math.isfinite(got[0].score)


def test_held_out_text_is_cheaper_than_unigrams(spark):
    got = lm.op3(spark, SF).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_spelling_is_a_distribution():
    """Probabilities of all one-byte words and the stop add up to at most one."""
    length, bits, nodes = lm.huffman(np.bincount(np.frombuffer(b"abracadabra ", np.uint8), minlength=256).astype(float))
    assert abs(sum(2.0 ** -length) - 1) < 1e-9
    m = lm.Mixer((length, bits, nodes), np.zeros((lm.SLOTS, 2), np.float32))
    first = np.array([m.costs([bytes([b])], np.zeros(1, np.int64))[0] for b in range(256)])
    assert abs(np.exp(first).sum() - 1) < 1e-6


def test_text_class():
    w = words_of(pa.array(["a b a", "b a a", "", "c"]))
    c = lm.text_class(w, w.hashes())
    assert c[0] == c[1] and c[2] == 0 and ((0 <= c) & (c < lm.CLASSES)).all()


def test_sample_keeps_one_of_copies(spark):
    base = prose(80, 5).split()
    rows = [(" ".join(base[:i] + ["x"] + base[i + 1:]), 1) for i in range(0, 60, 3)] + [(" ".join(base), 0)]
    rows += [(prose(40, 100 + i), i % 2) for i in range(10)] + [("short", 1), ("short", 1), (None, 0), ("", 1)]
    got = one_of_copies(spark.createDataFrame(rows, "text string, y int").coalesce(1)).collect()
    near = [r for r in got if r.text and set(r.text.split()[60:70]) == set(base[60:70])]
    assert sorted(r.y for r in near) == [0, 1]            # one of either label
    assert len(got) == 2 + 10 + 4                         # texts too short for a run stay
    assert one_of_copies(spark.createDataFrame([], "text string, y int")).collect() == []


def test_sample_keeps_unlike_texts_with_one_line_in_common(spark):
    line = "we use cookies on this site to give you the best experience of it"
    rows = [(f"{line} " + " ".join(f"w{(i * 31 + k * 7) % 9973}x{k}" for k in range(60)), i % 2) for i in range(120)]
    rows += [(f"{line} {prose(50, 900)}", 1)] * 5 + [(f"{line} {prose(50, 900)} again", 1)]
    got = one_of_copies(spark.createDataFrame(rows, "text string, y int").repartition(3)).collect()
    assert len(got) == 121 and {r.text for r in got} >= {t for t, _ in rows[:120]}


def test_frequent_rows_are_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(i % 50,) for i in range(1000)], "n long")
    for bound in (1000, 300, 25, 19, 0):
        monkeypatch.setattr(lm, "FREQUENT", bound)
        kept = df.where(lm.grade("n") >= lm.frequent_from(df))
        assert kept.count() <= bound
        assert bound != 1000 or kept.count() == 1000


def _phrases(seed, n):
    """n words in which the first of a pair nearly always says which one follows."""
    rng = np.random.default_rng(seed)
    return " ".join(x for k in rng.integers(0, 40, n // 2) for x in (f"first{k}", f"second{k if rng.random() < 0.95 else 7}"))


def test_language_model_learns_the_running_text(spark, make):
    """A text is worth more than its shuffled words, and than the unigram base; before, words'
    order did not count."""
    texts = {i: _phrases(i, 120) for i in range(150)}
    held = [i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = np.random.default_rng(5)
    other = {1000 + i: " ".join(rng.permutation(texts[i].split())) for i in held}
    rows = lm.scores(make([*texts.items(), *other.items()]), (fold("id", 10) != 0) & (F.col("id") < 1000)).collect()
    got = {r.doc_id: r for r in rows}
    for i in held:
        assert got[i].score > 0.9 * got[1000 + i].score and got[i].score > 0.9 * got[i].base_score
        assert abs(got[i].base_score - got[1000 + i].base_score) < 1e-6


def test_language_model_counts_every_occurrence(spark, make):
    """Repeated training rows teach more than one; before, a distinct word was one lesson."""
    base = [(i, prose(60, i)) for i in range(30)]
    probe = (900, "alpha omega gamma delta")
    cost = [{r.doc_id: r.score for r in lm.scores(make([*base, *[(i + 100, probe[1]) for i in range(k)], probe]), F.col("id") != 900).collect()}[900]
            for k in (2, 60)]
    assert cost[1] > cost[0] + 1


def test_slots_of_a_tree_and_of_tasks():
    """The tree's codes are a distribution, and sums of tasks' cells are the cells of all."""
    counts = np.array([50, 20, 20, 5, 5, 1, 1, 1])
    codes = lm.tree(counts)
    deep = np.floor(np.log2(codes))
    assert abs((2.0 ** -deep).sum() - 1) < 1e-12 and deep[0] == 1 and len(set(codes.tolist())) == 8
    assert lm.tree(np.array([3])).tolist() == [1]
    small, big = np.full(lm._CELL * 2, 3, np.uint32), np.full(lm._CELL * 2, 70_000, np.uint32)
    planes = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (small, big, small)]
    batch = pa.RecordBatch.from_arrays([pa.array([4, 4, 9]), pa.array(planes, pa.binary())], ["cell", "v"])
    got = {b.column("cell")[0].as_py(): np.frombuffer(b.column("v")[0].as_py(), np.uint16) for b in lm._slot_sums(iter([batch]))}
    assert (got[9] == lm.state_of(small.reshape(-1, 2))).all() and (got[4] == lm.state_of(np.full((1, 2), 70_003))).all()


def test_a_long_word_is_spelled_in_parts():
    words = [b"ab" * 40_000 + b" ", b"a "]
    mixer = lm.Mixer(lm.huffman(np.ones(256)), np.zeros((lm.SLOTS, 2), np.float32))
    w = words_of(pa.array([x.decode() for x in words]))
    chain = lm.Chain(w, w.hashes(), np.zeros(2, np.int64))
    leaf = mixer.coder.leaves(chain.key)
    sizes = [len(bit) for _, bit, _, _ in mixer.coder.pieces(chain, 0, len(leaf), leaf)]
    assert max(sizes) <= 8 << 14
    got = mixer.score(chain, leaf, 2)
    assert np.allclose(got, mixer.costs(words, np.zeros(2, np.int64)) + mixer.costs([lm.END], np.zeros(1, np.int64))[0])


def test_slots_of_a_path_are_near_and_counts_by_class_are_those_of_the_text():
    """Four levels of a path share one run of 16 slots (before, each decision had a place of its
    own), and leaves counted by class give the slots that the running text gives."""
    w = words_of(pa.array([" ".join(f"w{(i * i) % 97}" for i in range(k, k + 300)) for k in range(5)]))
    h = w.hashes()
    chain = lm.Chain(w, h, lm.text_class(w, h))
    keys, known = np.unique(chain.key, return_counts=True)
    coder = lm.Coder(lm.huffman(np.ones(256)), keys, lm.tree(np.append(known, 1)))
    leaf = coder.leaves(chain.key)
    (owner, bit, slots, place), = coder.pieces(chain, 0, len(leaf), leaf)
    assert np.array_equal(place, lm._DEPTH[np.arange(len(owner)) - (np.cumsum(coder.deep[leaf]) - coder.deep[leaf])[owner]])
    for t in range(0, len(leaf), 50):
        for s in slots:
            assert len(set((s[owner == t] >> lm.NEAR).tolist())) <= -(-coder.deep[leaf[t]] // lm.NEAR)
    cells, n = np.unique(chain.cls.astype(np.int64) * len(coder.codes) + leaf, return_counts=True)
    cls, some = np.divmod(cells, len(coder.codes))
    at, step = coder.walk(some)
    for k, s in enumerate(coder.tree_slots(at, step, cls.astype(np.uint64), None, None, range(2))):
        want, got = np.zeros((2, 2 << lm._CONTEXTS[k][2]), np.int64)
        np.add.at(want, slots[k].astype(np.int64) << 1 | bit, 1)
        np.add.at(got, s.astype(np.int64) << 1 | (step & 1), n[at])
        assert (want == got).all() and want.any()


def test_price_list_is_the_adaptive_map():
    """Prices by rounded logit are those of the map's formula, and of both bits add up to one."""
    m = lm.Mixer(lm.huffman(np.ones(256)), np.zeros((lm.SLOTS, 2), np.float32))
    m.map[:] = np.random.default_rng(2).integers(0, 90, m.map.shape)
    prices = np.exp(m.price_list().astype(float)).reshape(lm.GATES, lm.PRICES, 2)
    assert np.allclose(prices.sum(2), 1, atol=1e-6)
    ones, mass = m.noted()
    for gate, z in ((3, -15.9), (40, -2.0), (100, 0.3), (lm.GATES - 1, 8.7)):
        cell = gate * lm.STEPS + lm._step(np.array([z]))[0]
        p = (ones[cell] + 50 / (1 + math.exp(-z))) / mass[cell]
        assert abs(prices[gate, int((z + 16) * lm.PRICES / 32), 1] - p) < 0.005
