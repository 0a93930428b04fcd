"""Substring dedup (operator 1): seed and extend over winnowed anchors.

Every window of ``size`` words owns one anchor: the ``seed``-word run with the
smallest hash that starts inside it (the last one on a tie).  Anchors depend on
the window's words alone, so equal windows own equal anchors at equal places.

1. Seed: each anchor occurrence is one row (hash, digest of all words that its
   windows cover, document); neighbours with equal hash and digest, as in a text that
   says one phrase over and over, are one row with the windows of all.  Hashes that
   one document alone holds are dropped by one combining aggregate; all other
   occurrences are seeds.
2. Extend: occurrences with equal hash and digest are equal to the left and the
   right over all their windows, so the smallest document of that class decides
   for all of them at once.  Copies of any number are settled here; a hash of one
   class needs no further join.
3. Where one hash has several classes (a repeat begins or ends there), one
   occurrence of each class is extended window by window: the digests of its
   windows are joined with the smallest document that holds each.
4. Per document, the removed windows make maximal repeats: spans of covered words.

Nothing is gathered by key: groups are reduced by combining aggregates and joined
back as written tables, where Spark can split a hot key.  Rows that repeat an id and
its text are looked at once and get the result by a join at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.words import U64, Rolling, Words, mix, segments, slices, words_of

SIZE, SEED = 50, 10
_ANCHORS = "id long, tk long, hash long, ctx long, at int, n int"


def _last_min(v: np.ndarray, width: int) -> np.ndarray:
    """Index of the last smallest of v[i:i+width], for every i."""
    n = len(v) - width + 1
    best, pos = v.copy(), np.arange(len(v))
    span = 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:len(best) - step], best[step:]
        right = b <= a
        pos = np.where(right, pos[step:], pos[:len(pos) - step])
        best = np.where(right, b, a)
        span += step
    return pos[:n]


def anchors(w: Words, size: int = SIZE, seed: int = SEED):
    """(row, first window, windows, seed hash, digest) of each anchor occurrence;
    windows are counted in words of the slice."""
    start, row = segments(w, size)
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(U64), z.astype(U64)
    h = w.hashes()
    runs = Rolling(h)
    seeds = runs.of(np.arange(len(h) - seed + 1), seed)
    own = _last_min(seeds, size - seed + 1)[start]
    new = np.ones(len(start), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(start)))
    first, own = start[begin], own[begin]
    ctx = Rolling(h, salt=0x5851F42D4C957F2D).of(first, count + size - 1)
    return row[begin], first, count, seeds[own], mix(ctx ^ (own - first).astype(U64))


def runs_of(row, first, count, hashes, ctx):
    """The occurrences with neighbours of one row, hash and digest made one: equal
    digests cover equal words, so they are of one class and share its fate."""
    if not len(row):
        return row, first, count, hashes, ctx
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]) | (ctx[1:] != ctx[:-1])
    at = np.flatnonzero(new)
    return row[at], first[at], np.add.reduceat(count, at), hashes[at], ctx[at]


def _anchor_rows(size: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = words_of(part.column("text"))
                row, first, count, hashes, ctx = runs_of(*anchors(w, size, seed))
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pick), part.column("tk").take(pick),
                     pa.array(hashes.view(np.int64)), pa.array(ctx.view(np.int64)),
                     pa.array((first - w.first[row]).astype(np.int32)),
                     pa.array(count.astype(np.int32))], ["id", "tk", "hash", "ctx", "at", "n"])
    return work


def _window_rows(size: int):
    """Rows (hash, window digest, id, tk, at) of the windows of listed anchors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = words_of(part.column("text"))
                runs = Rolling(w.hashes(), salt=0x14057B7EF767814F)
                spots = part.column("spots")
                per = np.diff(np.asarray(spots.offsets))
                flat = spots.flatten()
                row = np.repeat(np.arange(len(per)), per)
                at = np.asarray(flat.field("at")).astype(np.int64)
                n = np.asarray(flat.field("n")).astype(np.int64)
                k = np.repeat(np.arange(len(at)), n)
                start = at[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                pick = pa.array(row[k])
                yield pa.RecordBatch.from_arrays(
                    [flat.field("hash").take(pa.array(k)),
                     pa.array(runs.of(start + w.first[row[k]], size).view(np.int64)),
                     part.column("id").take(pick), part.column("tk").take(pick),
                     pa.array(start.astype(np.int32))], ["hash", "win", "id", "tk", "at"])
    return work


def covered(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def once(docs: DataFrame) -> DataFrame:
    """One row of each (id, tk).  Texts move only where an id and its text repeat."""
    again = store.write(docs.groupBy("id", "tk").count().where("count > 1").select("id", "tk"), "repeated")
    if again.isEmpty():
        return docs
    same = docs.join(again, ["id", "tk"]).groupBy("id", "tk").agg(F.first("text").alias("text"))
    return docs.join(again, ["id", "tk"], "left_anti").unionByName(same)


def repeats(docs: DataFrame, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """Spans (id, tk, at, length) of words of ``docs`` (id, tk, text) that windows
    of ``size`` words cover whose words also start in a document with a smaller id.
    ``tk`` tells apart rows with one id and other texts.  Spans may overlap."""
    docs = once(docs.where("id is not null").select("id", "tk", "text"))
    found = store.write(docs.mapInArrow(_anchor_rows(size, seed), _ANCHORS), "anchors")
    shared = store.write(
        found.groupBy("hash").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                                  F.min("ctx").alias("c1"), F.max("ctx").alias("c2"))
        .where("lo < hi").select("hash", "lo", (F.col("c1") != F.col("c2")).alias("many")), "shared")
    seeds = store.write(found.join(shared, "hash"), "seeds")
    span = (F.col("n") + size - 1).alias("length")
    # a hash of one class: its smallest document is the class's
    whole = seeds.where("not many and id > lo").select("id", "tk", "at", span)
    mixed = seeds.where("many").drop("lo")
    classes = store.write(mixed.groupBy("hash", "ctx").agg(F.min("id").alias("lo"), F.max("id").alias("hi")),
                          "classes")
    whole = whole.unionByName(mixed.join(classes.where("lo < hi").drop("hi"), ["hash", "ctx"]).where("id > lo")
                              .select("id", "tk", "at", span))
    edge = (mixed.join(classes.select("hash", "ctx", F.col("lo").alias("id")), ["hash", "ctx", "id"])
            .groupBy("id", "tk").agg(F.collect_list(F.struct("hash", "at", "n")).alias("spots")))
    windows = store.write(docs.join(edge, ["id", "tk"]).select("id", "tk", "text", "spots")
                          .mapInArrow(_window_rows(size), "hash long, win long, id long, tk long, at int"),
                          "windows")
    again = store.write(windows.groupBy("hash", "win").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                        .where("lo < hi").drop("hi"), "again")
    part = (windows.join(again, ["hash", "win"]).where("id > lo")
            .select("id", "tk", "at", F.lit(size).alias("length")))
    return whole.unionByName(part)


def _cut(keep_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, at, length in zip(batch.column("text"), batch.column("at"), batch.column("length")):
                words = (text.as_py() or "").encode().split()
                n = len(words)
                if at.is_valid:
                    gone = covered(np.asarray(at.values), np.asarray(length.values), n)
                    words = [x for x, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(),
                             kept.decode() if keep_text else None))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "tk")), pa.array(cols[0], pa.int64()),
                 pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.string())],
                ["id", "tk", "n_words", "n_removed", "kept_sha256", "kept"])
    return work


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
          keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 and, if
    asked for, the kept words joined by one space (``kept``).

    A null or empty text has no words.  A row with a null id loses nothing and
    takes nothing from others.  Rows with one id never take words from each other;
    equal rows get equal results.  Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("tk", F.xxhash64("text"))
    spans = (repeats(docs, size).groupBy("id", "tk")
             .agg(F.collect_list(F.struct("at", "length")).alias("s")))
    spans = store.write(spans.select("id", "tk", F.col("s.at").alias("at"), F.col("s.length").alias("length")),
                        "spans")
    return (docs.join(spans, ["id", "tk"], "left").select("id", "tk", "text", "at", "length")
            .mapInArrow(_cut(keep_text), "id long, tk long, n_words long, n_removed long, "
                                         "kept_sha256 string, kept string")
            .withColumnRenamed("id", id_col))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of ``docs``, all columns, without covered words (see ``dedup``): a text
    that loses words becomes its kept words, joined by one space, and ``n_chars``, if
    there is such a column, its length; a text that loses all of them goes."""
    names = list(docs.columns)
    keyed = docs.withColumn("__rep_tk", F.xxhash64(text_col))
    spans = store.write(repeats(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                                .withColumn("tk", F.xxhash64("text")), size)
                        .groupBy("id", "tk").agg(F.collect_list(F.struct("at", "length")).alias("s"))
                        .select(F.col("id").alias("__rep_id"), F.col("tk").alias("__rep_t"), F.col("s.at").alias("__rep_at"),
                                F.col("s.length").alias("__rep_len")), "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, texts = np.ones(len(batch), bool), []
            for i, (text, at, length) in enumerate(zip(batch.column(text_col), batch.column("__rep_at"), batch.column("__rep_len"))):
                text = text.as_py()
                if at.is_valid:
                    words = (text or "").encode().split()
                    gone = covered(np.asarray(at.values), np.asarray(length.values), len(words))
                    if gone.any():
                        text = b" ".join([x for x, g in zip(words, gone.tolist()) if not g]).decode()
                        keep[i] = bool(text)
                texts.append(text)
            out = []
            for c in names:
                col = batch.column(c)
                if c == text_col:
                    col = pa.array(texts, pa.string())
                elif c == "n_chars":
                    col = pa.array([len(t) if v else n for t, v, n in zip(texts, batch.column("__rep_at").is_valid().to_pylist(),
                                                                          col.to_pylist())], col.type)
                out.append(col)
            yield pa.RecordBatch.from_arrays(out, names).filter(pa.array(keep))

    both = keyed.join(spans, (F.col(id_col) == F.col("__rep_id")) & (F.col("__rep_tk") == F.col("__rep_t")), "left")
    return both.select(*names, "__rep_at", "__rep_len").mapInArrow(work, docs.schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
           FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
seen AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
cov AS (SELECT doc_id, list(DISTINCT p) AS gone
        FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN seen USING (k) WHERE m < doc_id)
        GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w
                                   ELSE [w[j] FOR j IN range(1, len(w) + 1) IF NOT list_contains(gone, j)] END, ' '))
         AS kept_sha256
FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id
"""
