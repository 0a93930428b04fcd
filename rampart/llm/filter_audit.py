"""Filter interaction audit (operator 13): what each filter of a chain removes,
in every order of the chain, and its fair share of all that goes.

Every document fails some subset of the filters.  Only how many fail which
subset matters, per part: at most 2^filters cells.  From these the rows that a
*coalition* (a set of filters, applied together) removes are tabulated for all
2^filters coalitions.  A step of an order is the difference of two coalitions,
and the Shapley value comes from the constrained least squares fit to all of
them: weights of the Shapley kernel, shares that add up to what all filters
remove, normal equations solved in rationals.
"""

from __future__ import annotations

import itertools
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"


def solve(a: list[list[Fraction]], b: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with a X = b, exactly (Gauss-Jordan)."""
    n, rows = len(a), [[*x, *y] for x, y in zip(a, b)]
    for i in range(n):
        p = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[p] = rows[p], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def shapley_weights(n: int) -> list[list[int]]:
    """w[i][s]: n! times the Shapley value of filter i is the sum of w[i][s] times
    what coalition s (a bit set) removes.

    The fit minimises sum over coalitions s, neither empty nor whole, of
    k(s) (removed(s) - sum of shares in s)^2 with shares adding up to
    removed(all); k(s) = (n-1) / (C(n,|s|) |s| (n-|s|)).  The normal equations
    with a multiplier for the constraint are linear in the removals, so they are
    solved once, with one right-hand side per coalition.
    """
    every = (1 << n) - 1
    inside = [[i for i in range(n) if s >> i & 1] for s in range(every + 1)]
    zero = [Fraction(0)] * (every + 1)
    a = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    b = [list(zero) for _ in range(n + 1)]
    for s in range(1, every):
        m = len(inside[s])
        k = Fraction(n - 1, math.comb(n, m) * m * (n - m))
        for i in inside[s]:
            b[i][s] += k
            for j in inside[s]:
                a[i][j] += k
    for i in range(n):
        a[i][n] = a[n][i] = Fraction(1)
    b[n][every] = Fraction(1)
    out = [[x * math.factorial(n) for x in row] for row in solve(a, b)[:n]]
    assert all(x.denominator == 1 for row in out for x in row)
    return [[int(x) for x in row] for row in out]


def coalitions(cells: DataFrame, n: int, counts: list[str]) -> DataFrame:
    """Per part of ``cells`` (part, mask, counts...): ``<count>_all``, and
    ``<count>_gone``, an array with what coalition s removes at place s."""
    def gone(c: str, s: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(c))), F.lit(0)).cast("long")
    return cells.groupBy("part").agg(
        *[F.sum(c).cast("long").alias(f"{c}_all") for c in counts],
        *[F.array(*[gone(c, s) for s in range(1 << n)]).alias(f"{c}_gone") for c in counts])


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every step of every order of the filters, per part.

    ``cells`` has part, mask (bit i: the i-th filter fails), and the counts n,
    good, toxic of the documents with that mask; a part may lack masks, and
    repeated (part, mask) rows add up.  Returns part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.  No rows
    give no rows.
    """
    n = len(letters)
    bit = {c: 1 << i for i, c in enumerate(letters)}
    every = (1 << n) - 1
    steps = []
    for order in itertools.permutations(letters):
        before = 0
        for k, c in enumerate(order, 1):
            steps.append(f"named_struct('filter_order','{''.join(order)}','step',{k},'i',{letters.index(c)},"
                         f"'own',{bit[c]},'before',{before},'after',{before | bit[c]})")
            before |= bit[c]
    share = [F.aggregate(F.zip_with("n_gone", F.lit(w), lambda x, y: x * y.cast("long")),
                         F.lit(0).cast("long"), lambda x, y: x + y) for w in shapley_weights(n)]
    t = coalitions(cells, n, ["n", "good", "toxic"]).withColumn("share", F.array(*share))
    t = t.select("*", F.expr(f"inline(array({','.join(steps)}))"))

    def at(c: str, where) -> Column:
        return F.get(f"{c}_gone", where)

    def lost(c: str) -> Column:
        return at(c, F.col("after")) - at(c, F.col("before"))
    return t.select(
        "part", "filter_order", "step",
        (F.col("n_all") - at("n", F.col("after"))).alias("kept"),
        lost("n").alias("removed"),
        (at("n", F.col("own")) - lost("n")).alias("redundant"),
        (at("n", F.lit(every)) - at("n", F.lit(every) - F.col("own"))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.get("share", F.col("i")).alias("shapley"))


def text_fails() -> Column:
    """Bits 0 to 3: the filters A to D fail on column ``t`` (no null)."""
    words = F.filter(F.split("t", SPACES), lambda w: w != "")
    capitals = F.length(F.regexp_replace("t", "[^A-Z]+", ""))
    few = F.size(words) < 200
    repeats = F.size(F.array_distinct(words)) * 100 < F.size(words) * 50
    loud = capitals.cast("long") * 100 > F.length("t").cast("long") * 3
    signs = F.col("t").rlike(r"[#$%&*|]")
    return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate([few, repeats, loud, signs])),
               F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Cells (part, mask, n, good, toxic) of documents and labels for the filters
    A to E.

    The whole text decides; a null text counts as empty and a null lang as part
    ''.  Each row is a document of its own.  E fails where a smaller doc_id has
    the same text, in any part; a null doc_id never fails E and is smaller than
    none, and rows that share the smallest doc_id all pass.  A document is good
    (toxic) if any label row of its doc_id says 1.  An empty table gives no rows;
    other columns are not read.

    Rows are counted per (doc_id, part, text digest) first, then per (digest,
    part), so a group of copies of any size shrinks in the tasks that read it and
    only (digest, part) counts meet in one task.
    """
    t = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("t"))
    rows = t.select("doc_id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), text_fails().alias("bits")) \
        .groupBy("digest", "part", "doc_id").agg(F.first("bits").alias("bits"), F.count("*").alias("n"))
    said = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("g"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("x")).withColumn("known", F.lit(True))
    # a null doc_id has no label: it joins on its digest instead, so that such rows spread
    rows = rows.withColumn("known", F.col("doc_id").isNotNull()) \
        .withColumn("id", F.coalesce("doc_id", F.xxhash64("digest")))
    rows = rows.join(said, ["id", "known"], "left").select(
        "digest", "part", "doc_id", "bits", "n", (F.col("n") * F.coalesce("g", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("x", F.lit(0))).alias("toxic"))
    head = F.struct("doc_id", "n", "good", "toxic")
    loose = F.col("doc_id").isNull()
    counts = ["n", "good", "toxic"]
    texts = rows.groupBy("digest", "part").agg(
        F.first("bits").alias("bits"), *[F.sum(c).alias(c) for c in counts],
        F.sum(F.when(loose, F.col("n")).otherwise(0)).alias("loose"),
        F.min(F.when(~loose, head)).alias("head"))
    # over the parts that hold a text: as many rows as it has languages
    least = texts.groupBy("digest").agg(F.min("head.doc_id").alias("least"))
    texts = texts.join(least, "digest")
    first = F.col("head.doc_id") == F.col("least")
    passed = [(F.when(first, F.col(f"head.{c}")).otherwise(0) + (F.col("loose") if c == "n" else F.lit(0))).alias(c)
              for c in counts]
    texts = texts.select("part", "bits", *counts, *[p.alias(f"pass_{c}") for p, c in zip(passed, counts)])
    same = F.struct(F.col("bits").alias("mask"), *[F.coalesce(f"pass_{c}", F.lit(0)).cast("long").alias(c) for c in counts])
    copy = F.struct((F.col("bits") + 16).alias("mask"),
                    *[(F.col(c) - F.coalesce(f"pass_{c}", F.lit(0))).cast("long").alias(c) for c in counts])
    return texts.select("part", F.explode(F.array(same, copy)).alias("c")).select("part", "c.*") \
        .groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in counts])


def op13(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit(failures(docs, labels))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS g, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x
  FROM labels GROUP BY doc_id),
f AS (
  SELECT w.part, coalesce(l.g, 0) AS g, coalesce(l.x, 0) AS x,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS fa,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS fb,
    CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 3 * length(w.t) THEN 1 ELSE 0 END AS fc,
    CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 1 ELSE 0 END AS fd,
    CASE WHEN w.doc_id > least.least THEN 1 ELSE 0 END AS fe
  FROM w JOIN least ON w.t = least.t LEFT JOIN l ON w.doc_id = l.doc_id),
cells AS (
  SELECT part, fa, fb, fc, fd, fe, count(*) AS n, sum(g) AS g, sum(x) AS x FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.c NOT IN (b.c, c.c, d.c, e.c) AND b.c NOT IN (c.c, d.c, e.c) AND c.c NOT IN (d.c, e.c) AND d.c <> e.c),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS done
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
judged AS (
  SELECT part, filter_order, step, own, n, g, x,
    (own = 'A' AND fa = 1) OR (own = 'B' AND fb = 1) OR (own = 'C' AND fc = 1) OR (own = 'D' AND fd = 1)
      OR (own = 'E' AND fe = 1) AS fails,
    (contains(done, 'A') AND fa = 1) OR (contains(done, 'B') AND fb = 1) OR (contains(done, 'C') AND fc = 1)
      OR (contains(done, 'D') AND fd = 1) OR (contains(done, 'E') AND fe = 1) AS went,
    fa + fb + fc + fd + fe AS failed
  FROM cells, steps),
rows_ AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT went AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT went AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN went AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT went AND fails THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT went AND fails THEN x ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM rows_
"""
