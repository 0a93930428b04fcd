import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from rampart.llm import decontam, graph, near_dup, substring
from rampart.llm.words import words_of
from tests.llm.conftest import prose


def _kept(rows, size):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k:k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def _passages():
    base, other = prose(400, 1), prose(300, 2)
    b, o = base.split(), other.split()
    rows = [(10, base), (3, " ".join(o[:120] + b[40:160] + o[120:])), (7, " ".join(b[100:149])), (8, " ".join(b[100:150])),
            (20, base), (21, base.replace("alpha", "ALPHA")), (22, " ".join(b[:90] + ["new"] + b[90:])), (5, None), (6, ""),
            (30, "same " * 200), (31, "same " * 120), (4, "\t\n "), (40, " ".join(b[200:260] + o[10:70] + b[200:260])),
            (None, base), (20, base), (41, other), (41, base)]
    return rows + [(100 + k, " ".join(prose(30, 50 + k).split() + b[300:360] + prose(30, 90 + k).split())) for k in range(12)]


def test_windows_equal_brute_force(make):
    rows = _passages()
    got = substring.dedup(make(rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == _kept(rows, 50)


def test_periodic_texts_equal_brute_force(make):
    """One phrase over and over: neighbouring anchors of one digest are one row."""
    pair, three = "of the " * 150, "a b c " * 90
    rows = [(9, pair), (2, "start here " + pair + "and end"), (5, three), (7, "x " + three + prose(60, 1)), (8, prose(60, 1) + " " + pair),
            (1, "of the " * 24 + "of"), (12, "same " * 300), (11, prose(20, 8) + " " + "same " * 90 + prose(20, 9)), (20, pair + three + pair)]
    got = substring.dedup(make(rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == _kept(rows, 50)
    w = words_of(pa.array([pair, "same " * 300, prose(300, 5)]))
    plain, merged = substring.anchors(w), substring.runs_of(*substring.anchors(w))
    assert plain[2].sum() == merged[2].sum()
    per = np.bincount(merged[0], minlength=3)
    assert per[0] <= 4 and per[1] <= 4 and per[2] == np.bincount(plain[0], minlength=3)[2]


def test_equal_rows_give_the_windows_of_one(make, monkeypatch):
    """N rows of one id and text must not meet each other's windows."""
    base = prose(400, 1)
    other = " ".join(base.split()[:200] + prose(200, 2).split())
    counts = {}
    for n in (1, 40):
        seen = {}
        write = substring.store.write
        monkeypatch.setattr(substring.store, "write", lambda df, name: seen.setdefault(name, write(df, name)))
        rows = [(5, base)] * n + [(6, other), (7, base + " " + other)]
        got = substring.dedup(make(rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got), key=repr) == _kept(rows, 50)
        counts[n] = [seen[k].count() for k in ("anchors", "seeds", "windows")]
        monkeypatch.undo()
    assert counts[1] == counts[40]


def test_kept_text_and_empty_table(make):
    assert substring.dedup(make([])).collect() == []
    rows = [(1, prose(80, 3)), (2, "start " + prose(80, 3) + " end")]
    got = {r.doc_id: r.kept for r in substring.dedup(make(rows), keep_text=True).collect()}
    assert got[2] == "start end" and got[1] == rows[0][1]
    kept = substring.without_repeats(make(rows + [(3, prose(80, 3)), (4, None)]))
    assert {r.doc_id: r.text for r in kept.collect()} == {1: rows[0][1], 2: "start end", 4: None}
    assert kept.columns == make([]).columns


def test_anchor_is_in_its_windows():
    w = words_of(pa.array([prose(300, 5)]))
    row, first, count, _, _ = substring.anchors(w, 50, 10)
    assert count.sum() == 251 and first[0] == 0 and (np.diff(first) == count[:-1]).all()


def _sets(rows, k):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def _components(rows, k, percent=80):
    sets = _sets([r for r in rows if r[0] is not None], k)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def _edited(text, k, seed):
    w, x = text.split(), seed
    for _ in range(k):
        x = (x * 48271 + 11) % 2147483647
        w[x % len(w)] = f"w{x % 997}"
    return " ".join(w)


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_equal_brute_force(make, shingle):
    base = prose(200, 9)
    rows = [(1000 - i, _edited(base, i % 14, i + 1)) for i in range(70)]
    rows += [(i, prose(5 + i, 200 + i)) for i in range(30)] + [(500, None), (501, ""), (502, "one"), (503, "ONE"), (504, "one two"),
             (505, "two one"), (506, " \n"), (1, prose(40, 77)), (600, prose(40, 77)), (None, base), (507, "one  TWO")]
    got = near_dup.near_duplicates(make(rows), shingle=shingle).collect()
    want = _components(rows, shingle)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])
    assert collections.Counter(r.n_shingles for r in got)[0] == (3 if shingle == 2 else 3)


def test_hub_that_is_not_the_smallest(make):
    """Copies that are similar to one document but not to each other."""
    base = prose(120, 4)
    rows = [(900, base)] + [(i, _edited(base, 9, 31 * i + 7)) for i in range(1, 60)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(make(rows)).collect()}
    assert got == _components(rows, 2)


def test_near_duplicates_of_nothing(make):
    assert near_dup.near_duplicates(make([])).collect() == []


def test_registers_estimate_similarity():
    a = np.sort(near_dup.mix(np.arange(1, 4001, dtype=np.uint64)))
    b = np.sort(near_dup.mix(np.arange(501, 4501, dtype=np.uint64)))
    h, offs = np.concatenate([a, b]), np.array([0, 4000, 8000])
    reg = near_dup.registers(h, offs)
    est = near_dup.estimate((reg[0] == reg[1]).sum(), np.array(reg.shape[1]))
    assert abs(est - 3500 / 4500) < 0.1


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 1 for i in range(2, 41)} | {100 + i: 100 for i in range(1, 30)} | {300: 200}
    assert got == want
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def _similar(items, rows):
    out = {}
    weight = lambda s: sum(map(len, s))
    for b, bt in items:
        bw = (bt or "").encode().lower().split()
        n, k = len(bw), min(5, len(bw))
        if not n or b is None:
            continue
        a = collections.Counter(tuple(bw[j:j + k]) for j in range(n - k + 1))
        ta = sum(weight(s) * c for s, c in a.items())
        for d, t in rows:
            w = (t or "").encode().lower().split()
            for s in range(max(1, len(w) - n + 1)):
                m = min(n, len(w))
                if m < k:
                    continue
                c = collections.Counter(tuple(w[s + j:s + j + k]) for j in range(m - k + 1))
                both = sum(weight(x) * min(v, a[x]) for x, v in c.items())
                sim = both / (ta + sum(weight(x) * v for x, v in c.items()) - both)
                if sim >= 0.8 and ((d, b) not in out or sim > out[d, b][0] + 1e-12):
                    out[d, b] = (sim, s)
    return out


def test_leaks_equal_brute_force(spark, make):
    items = [(1, prose(30, 21)), (2, prose(22, 22)), (3, "short item"), (4, ""), (5, None), (6, prose(30, 23)), (None, "x y z")]
    i1, i2 = items[0][1].split(), items[1][1].split()
    rows = [(1, prose(60, 31) + " " + " ".join(i1).upper() + " " + prose(60, 32)), (2, " ".join(i1[:29])),
            (3, prose(20, 33) + " " + " ".join(i1[:14] + ["zzz"] + i1[14:])), (4, " ".join(i2[:15])), (5, None), (6, ""),
            (7, prose(300, 34)), (8, "a short item b"), (9, " ".join(i2 + i2)), (None, " ".join(i1)), (1, " ".join(i1)),
            (10, " ".join(i1[:16]) + " " + prose(14, 35))]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontam.leaks(make(rows), bench).collect()
    want = _similar(items, [(k, t) for k, (_, t) in enumerate(rows)])
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.start, round(r.similarity, 9)) for r in got) == sorted(
        (rows[k][0] if rows[k][0] is not None else -1, b, s, round(sim, 9)) for (k, b), (sim, s) in want.items())
    left = decontam.clean(make(rows), bench)
    assert left.columns == make([]).columns
    leaked = {k for k, _ in want}
    assert left.count() == len(rows) - len(leaked)


def test_leaks_of_nothing(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(make([(1, "a b")]), none).collect() == []
    assert decontam.clean(make([(1, "a b")]), none).count() == 1
    assert decontam.leaks(make([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_blocks_name_every_print_within_radius():
    rng = np.random.default_rng(3)
    items = decontam.Items(10)
    items.ids, items.prints = list(range(20)), rng.integers(0, 256, (20, 16), np.uint8)
    base = np.repeat(items.prints, 20, 0)
    bits = np.unpackbits(base, axis=1)
    for r in bits:
        at = rng.choice(128, int(rng.integers(0, 60)), replace=False)
        r[at] ^= 1
    prints = np.packbits(bits, axis=1)
    far = decontam._POP[prints[:, None] ^ items.prints[None]].sum(-1, dtype=int)
    want = set(zip(*map(list, np.nonzero(far <= decontam.RADIUS))))
    assert set(zip(*map(list, items.near(prints)))) == want
