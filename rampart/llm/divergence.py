"""Source divergence audit (operator 12): how far the sources of a language
differ in their use of words.

*In-mapper stripes*: a partition folds whole documents into one hash stripe per
(language, term), holding the number of documents with the term and its count in
each source.  A fold that has grown to ``entries`` counts is spilled, that is,
emitted as it is, and a new one begun.  Stripes of one key are merged by Spark.
Merged stripes are dealt in blocks of about ``block`` terms; each block emits its
part of every divergence: sums over its terms for pairs of sources, and its own
highest terms of each source.  Sums and ranks of the blocks' rows are the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm import store

#: on UTF-8 bytes: ASCII letters and every byte of a longer code point
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 1_000_000_000
STRIPE = "lang string, term string, df long, source array<string>, n array<long>"
_CHUNK = 1 << 16
_CELLS = 1 << 20


class Fold:
    """Stripes of one partition: per language, documents by term, and per
    (language, source) counts by term."""

    def __init__(self, entries: int):
        self.limit = entries
        self.clear()

    def clear(self) -> None:
        self.docs: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        docs = self.docs.setdefault(lang, Counter())
        counts = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        before = len(docs) + len(counts)
        text = text.lower()                      # bytes: only A-Z
        if len(text) < _CHUNK:
            terms = TERM.findall(text)
            counts.update(terms)
            docs.update(set(terms))
        else:                                    # a long text is read bit by bit, its terms met once each
            met, found = set(), (m.group() for m in TERM.finditer(text))
            while terms := list(islice(found, _CHUNK)):
                counts.update(terms)
                met.update(terms)
            docs.update(met)
        self.size += len(docs) + len(counts) - before

    def full(self) -> bool:
        return self.size >= self.limit

    def take(self) -> Iterator[pa.RecordBatch]:
        """Emit all stripes and forget them.  The empty term, which no text has,
        only names the sources."""
        for lang, docs in self.docs.items():
            names = list(self.counts[lang])
            yield _batch(lang, [""], [0], np.array([0, len(names)]), names, np.arange(len(names)), np.zeros(len(names), np.int64))
            place = dict(zip(docs, range(len(docs))))
            terms, sources, counts = [], [], []
            for i, c in enumerate(self.counts[lang].values()):
                terms.append(np.fromiter(map(place.__getitem__, c), np.int64, len(c)))
                sources.append(np.full(len(c), i, np.int64))
                counts.append(np.fromiter(c.values(), np.int64, len(c)))
            term = np.concatenate(terms)
            order = np.argsort(term, kind="stable")
            source, n = np.concatenate(sources)[order], np.concatenate(counts)[order]
            ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(docs)))])
            words, df = list(docs), list(docs.values())
            for a in range(0, len(words), _CHUNK):
                b = min(a + _CHUNK, len(words))
                lo, hi = ends[a], ends[b]
                yield _batch(lang, words[a:b], df[a:b], ends[a:b + 1] - lo, names, source[lo:hi], n[lo:hi])
        self.clear()


def _batch(lang: str, terms: list, df: list[int], ends: np.ndarray, names: list[str], source: np.ndarray,
           n: np.ndarray) -> pa.RecordBatch:
    """Stripes of one language: term i has the places ends[i]:ends[i + 1] of
    source (numbers of names) and n."""
    at = pa.array(ends, pa.int32())
    of = pa.DictionaryArray.from_arrays(pa.array(source, pa.int32()), pa.array(names, pa.string()))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(terms), np.int64))),
         pa.array(terms, pa.binary()).cast(pa.string()), pa.array(df, pa.int64()),
         pa.ListArray.from_arrays(at, of.cast(pa.string())), pa.ListArray.from_arrays(at, pa.array(n, pa.int64()))],
        ["lang", "term", "df", "source", "n"])


def stripes(docs: DataFrame, entries: int) -> DataFrame:
    """Unmerged stripes (lang, term, df, source, n) of every whole text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = Fold(entries)
        for b in batches:
            lang, source = b.column(1).to_pylist(), b.column(2).to_pylist()
            texts = b.column(0)
            for i in range(len(b)):
                fold.add(lang[i], source[i], texts[i].as_py())
                if fold.full():
                    yield from fold.take()
        yield from fold.take()

    def known(c):
        return F.coalesce(c, F.lit(""))
    return docs.select(known("text").cast("binary").alias("text"), known("lang").alias("lang"),
                       known("source").alias("source")).mapInArrow(work, STRIPE)


def shares(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exactly: long division by
    thousands, since 10^9 times a count need not fit 64 bits."""
    d = total + 5 * kept
    out, rest = np.divmod(count + 5, d)
    for _ in range(3):
        q, rest = np.divmod(rest * 1000, d)
        out = out * 1000 + q
    return out + 1


def _divergences(top: int):
    """One block of a language's kept stripes, with the language's totals."""
    def run(key, terms: pa.Table, sides: pa.Table):
        side = sides.to_pylist()[0]
        names, totals = side["sources"], np.array(side["totals"], np.int64)
        at = {s: i for i, s in enumerate(names)}
        size = len(names)
        words = np.array(terms.column("term").to_pylist(), object)
        pair = np.zeros((size, size), np.int64)
        best: list[list[tuple]] = [[] for _ in names]
        step = max(1, _CELLS // max(1, size))
        lists = terms.column("stripe")
        for a in range(0, len(words), step):
            rows = lists.slice(a, step).to_pylist()
            count = np.zeros((len(rows), size), np.int64)
            for i, stripe in enumerate(rows):
                for s in stripe:
                    count[i, at[s["source"]]] = s["n"]
            p = shares(count, totals[None, :], side["kept"])
            q = shares(count.sum(1), totals.sum(), side["kept"])
            for i in range(size):
                pair[i, i + 1:] += np.abs(p[:, i + 1:] - p[:, i:i + 1]).sum(0)
                found = np.flatnonzero((count[:, i] > 0) & (p[:, i] > q))
                best[i] += zip((q[found] - p[found, i]).tolist(), words[a + found].tolist())
                if len(best[i]) > top:           # code points sort as their UTF-8 does
                    best[i] = sorted(best[i])[:top]
        out = [(key[0].as_py(), names[i], "pair", names[j], int(pair[i, j]))
               for i in range(size) for j in range(i + 1, size)]
        out += [(key[0].as_py(), names[i], "term", w, -f) for i in range(size) for f, w in best[i]]
        cols = list(zip(*out)) or [()] * 5
        types = [pa.string()] * 4 + [pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                    ["lang", "source", "part", "item", "value"])
    return run


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, entries: int = 1_000_000,
               block: int = 10_000) -> DataFrame:
    """Rows lang, source, part, item, value, rank of ``docs`` (text, lang, source).

    Part 'pair' has every other source of the language, part 'term' the ``top``
    terms that a source uses most above its language.  Null text, lang or source
    read as ''.  Every row counts, repeated ones too; ties go to the smaller item.
    A language without kept terms has pairs of value 0; a source without terms
    takes part with counts of 0.  An empty table gives no rows.  Other columns are
    not read.

    In a task's memory: ``entries`` counts and one document while folding; then
    one block of terms, in slices of 2^20 counts, and a matrix of the language's
    sources squared, which is what the pairs return.  A frequent term is one
    small row a fold, added up by Spark.
    """
    # one shuffle serves the document counts, the sums per source and the merge
    frequent = F.sum("df").over(Window.partitionBy("lang", "term"))
    flat = stripes(docs, entries).repartition("lang", "term").withColumn("df", frequent) \
        .where((F.col("term") == "") | (F.col("df") >= min_docs)) \
        .select("lang", "term", F.explode(F.arrays_zip("source", "n")).alias("e")) \
        .groupBy("lang", "term", "e.source").agg(F.sum("e.n").alias("n"))
    merged = flat.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("stripe"))
    merged = store.write(merged, "stripes")
    kept = merged.where("term <> ''")
    blocks = -(-kept.count() // block) or 1
    kept = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "term", "stripe")
    # totals of every group that occurs, terms or not: one narrow row per language
    totals = merged.select("lang", "term", F.explode("stripe").alias("s")).groupBy("lang", "s.source").agg(
        F.sum("s.n").alias("total"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    sides = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("s")) \
        .join(vocabulary, "lang", "left").select(
            "lang", F.col("s.source").alias("sources"), F.col("s.total").alias("totals"),
            F.coalesce("kept", F.lit(0)).alias("kept"))
    sides = store.write(sides, "sides")
    each = store.write(sides.join(kept.select("lang", "block").distinct(), "lang"), "blocks")
    parts = kept.groupBy("lang", "block").cogroup(each.groupBy("lang", "block")).applyInArrow(
        _divergences(top), "lang string, source string, part string, item string, value long")
    parts = store.write(parts, "divergences")
    # all pairs of a language's sources, which are asked for, also where no term is kept
    none = sides.select("lang", "sources", F.explode("sources").alias("source")) \
        .select("lang", "source", F.explode("sources").alias("item")).where("source < item") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = parts.where("part = 'pair'").unionByName(none).groupBy("lang", "source", "part", "item").agg(
        F.sum("value").alias("value"))
    turned = pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(w).alias("rank")
    return pairs.unionByName(turned).select("*", rank).unionByName(
        parts.where("part = 'term'").select("*", rank).where(F.col("rank") <= top))


def op12(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
  FROM documents),
occ AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT occ.lang, occ.source, occ.term, count(*) AS c
  FROM occ JOIN kept ON occ.lang = kept.lang AND occ.term = kept.term GROUP BY occ.lang, occ.source, occ.term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5)) // (CAST(coalesce(n.n, 0) AS HUGEINT) + 5 * v.v) AS p
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
ln AS (SELECT lang, sum(c) AS n FROM c GROUP BY lang),
lc AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term),
q AS (
  SELECT lc.lang, lc.term,
    1 + (CAST(1000000000 AS HUGEINT) * (lc.c + 5)) // (CAST(ln.n AS HUGEINT) + 5 * v.v) AS q
  FROM lc JOIN ln ON lc.lang = ln.lang JOIN v ON v.lang = lc.lang),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.f, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
