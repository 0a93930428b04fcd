import collections
import itertools
import math
import re
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rampart.llm import divergence, filter_audit
from tests.llm.conftest import prose

DOC = "doc_id long, text string, lang string, source string, n int, term string, part string"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, None, "x", None) for r in rows], DOC).repartition(3)


# ---- source divergence -------------------------------------------------------------------

def divergence_by_hand(rows, min_docs, top):
    df, count, groups = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)
        df.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), n in df.items() if g == lang and n >= min_docs]

        def p(of, t):
            total = sum(count[lang, s, u] for s in of for u in kept)
            return 1 + math.floor(Fraction(10 ** 9 * (sum(count[lang, s, t] for s in of) + 5), total + 5 * len(kept)))
        for s in sources:
            pairs = [(-sum(abs(p([s], t) - p([o], t)) for t in kept), o) for o in sources - {s}]
            terms = [(p(sources, t) - p([s], t), t) for t in kept
                     if count[lang, s, t] and p([s], t) > p(sources, t)]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -f, k) for k, (f, item) in enumerate(
                    sorted(found, key=lambda x: (x[0], x[1].encode())), 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


ROWS = [(i, prose(12, i) + (" ÉCLAIR Naïve 日本 a1b" if i % 2 else " zz_Q"), "de" if i % 3 else None, f"s{i % 4}")
        for i in range(40)] + [(1, None, "fr", "a"), (2, "", "fr", None), (3, "12 %%", "fr", "b")] + \
       [(9, "Alpha alpha", "de", "only here")] * 3 + [(None, "One one", "it", "z")]


def test_divergence_equals_brute_force(spark):
    assert got(divergence.divergence(docs_of(spark, ROWS), 3, 4)) == divergence_by_hand(ROWS, 3, 4)


def test_spills_and_blocks_change_nothing(spark, monkeypatch):
    want = got(divergence.divergence(docs_of(spark, ROWS), 3, 4))
    monkeypatch.setattr(divergence, "_CELLS", 8)
    monkeypatch.setattr(divergence, "_CHUNK", 16)
    assert got(divergence.divergence(docs_of(spark, ROWS), 3, 4, entries=7, block=5)) == want


def test_divergence_empty_and_nothing_kept(spark):
    assert got(divergence.divergence(docs_of(spark, ROWS).where("doc_id < 0"))) == []
    rows = [(1, "a b", "x", "p"), (2, "c", "x", "q"), (3, None, "y", "p")]
    assert got(divergence.divergence(docs_of(spark, rows))) == [("x", "p", "pair", "q", 0, 1), ("x", "q", "pair", "p", 0, 1)]


def test_ties_go_to_smaller_item(spark):
    rows = [(i, "b a é z", "x", s) for i, s in enumerate("pqrp")] + [(9, "other other", "x", "q")] * 3
    assert got(divergence.divergence(docs_of(spark, rows), 3, 2)) == divergence_by_hand(rows, 3, 2)


def test_long_text(spark):
    rows = [(i, prose(30000, i), "x", s) for i, s in enumerate("pqq")]
    assert got(divergence.divergence(docs_of(spark, rows), 1, 50)) == divergence_by_hand(rows, 1, 50)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10 ** 15), st.integers(0, 10 ** 15), st.integers(1, 10 ** 9))
def test_shares_are_exact(count, more, kept):
    total = count + more
    want = 1 + (10 ** 9 * (count + 5)) // (total + 5 * kept)
    assert divergence.shares(np.array([count]), np.array([total]), kept).tolist() == [want]


# ---- filter interaction ------------------------------------------------------------------

def fails_by_hand(rows, i):
    doc, text = rows[i][0], rows[i][1] or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    least = min((r[0] for r in rows if r[0] is not None and (r[1] or "") == text), default=None)
    return {c for c, bad in zip("ABCDE", [
        len(words) < 200, 100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text), re.search(r"[#$%&*|]", text),
        doc is not None and least < doc]) if bad}


def audit_by_hand(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    parts = collections.defaultdict(list)
    for i, r in enumerate(rows):
        parts[r[2] or ""].append((fails_by_hand(rows, i), r[0] in good and r[0] is not None, r[0] in toxic and r[0] is not None))
    out, shares = [], collections.Counter()
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[0]]
                left = [d for d in left if c not in d[0]]
                shares[part, c] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone),
                            sum(c in d[0] for d in docs) - len(gone), sum(d[0] == {c} for d in docs),
                            sum(d[1] for d in gone), sum(d[2] for d in gone)])
    return sorted((*r, shares[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_equals_brute_force(spark):
    long = prose(250, 3)
    varied = " ".join(f"w{i}" for i in range(260))
    rows = [(5, long, "en", "a"), (3, long, "de", "b"), (3, long, "de", "b"), (8, varied, "en", None), (9, varied + " $", None, "c"),
            (2, None, "en", "a"), (1, "", "de", "a"), (7, "", None, "a"), (None, varied, "en", "a"), (None, "", "en", "x"),
            (11, varied + " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3, "en", "a"), (12, long + " ÄÖÜ\xa0x|", "", "a"),
            (13, " ".join(["a"] * 300), "en", "a"), (14, prose(20000, 4), "de", "x"), (15, prose(20000, 4), "fr", "x")]
    labels = [(5, 1, 0), (3, 1, 1), (3, 0, 0), (8, 1, None), (2, 0, 1), (None, 1, 1), (15, None, 1), (99, 1, 1)]
    said = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, text string")
    df = filter_audit.audit(filter_audit.failures(docs_of(spark, rows), said))
    assert sorted(tuple(r) for r in df.collect()) == audit_by_hand(rows, labels)


def test_audit_of_no_rows(spark):
    said = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = filter_audit.failures(docs_of(spark, [(1, "a", "en", "s")]).where("doc_id > 1"), said)
    assert filter_audit.audit(df).count() == 0


def test_shares_by_least_squares_are_shapley_values():
    for n in (2, 3, 5):
        w = filter_audit.shapley_weights(n)
        for i in range(n):
            for s in range(1, 1 << n):
                m = bin(s).count("1")
                want = math.factorial(m - 1) * math.factorial(n - m) if s >> i & 1 else \
                    -math.factorial(m) * math.factorial(n - m - 1)
                assert w[i][s] == want, (n, i, s)
