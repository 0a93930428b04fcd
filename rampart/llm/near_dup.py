"""MinHash near-dedup (operator 7) with HyperMinHash registers.

A document's set holds the hashes of its distinct ``shingle``-word runs.  Copies
of one set are one node from the start (grouped by a 128-bit digest).  Each node
has BANDS independent hash functions; each deals the set over ROWS buckets and
keeps, per bucket, the smallest value as leading-zero count (6 bits) and the
10 bits after the leading one.  The registers of one function are a band.  Two
sets of similarity 0.8 agree in a band with probability 0.8^6 or more, so they
miss all 40 bands with probability below 6e-6 (far less above 0.8).

Candidates are never all pairs of a bucket:

1. every node of a bucket is compared with the bucket's smallest node;
2. components of the confirmed links are formed; buckets whose nodes are all in
   one component are settled;
3. in each other bucket, nodes outside the largest component are compared by
   their registers with the nodes of other components.  What passes gives probes
   (node, component) and cells (component, node), each once, however many pairs
   stand behind them; probes are then compared with cells on the full sets.

The estimate from registers subtracts the share that agrees by chance and drops a
pair only five standard errors below the threshold.  Each link is confirmed on the
full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.graph import components
from rampart.llm.words import U64, Rolling, mix, segments, slices, words_of

BANDS, ROWS, MANTISSA = 40, 6, 10
BLOCK = 1024            # nodes of one bucket compared in one go
LOAD = 1 << 18          # hashes of full sets compared in one go
EMPTY = 0xFFFF
_MULT = mix(np.arange(1, BANDS + 1, dtype=U64)) | U64(1)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and offsets (texts + 1).
    A text with fewer words than a shingle has one hash, of all its words."""
    w = words_of(texts, lower=True)
    runs = Rolling(w.hashes())
    start, row = segments(w, shingle)
    h = runs.of(start, shingle)
    few = np.flatnonzero((w.counts > 0) & (w.counts < shingle))
    if len(few):
        row = np.concatenate([row, few])
        h = np.concatenate([h, runs.of(w.first[few], w.counts[few])])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(w.first)))


def registers(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """uint16 registers, texts x (BANDS * ROWS)."""
    n = len(offs) - 1
    base = np.repeat(np.arange(n) * ROWS, np.diff(offs))
    least = np.full((BANDS, n * ROWS), 0xFFFFFFFF, np.uint32)
    for t in range(BANDS):
        v = ((h * _MULT[t]) >> U64(32)) * U64(ROWS)
        np.minimum.at(least[t], base + (v >> U64(32)).astype(np.int64), v.astype(np.uint32))
    x = least.astype(np.float64)
    bits = np.where(least > 0, np.frexp(x)[1], 0).astype(np.uint32)      # bit length
    lead = np.uint32(32) - bits
    body = (least << np.minimum(lead, 31)) << np.uint32(1)              # bits after the leading one
    reg = (np.minimum(lead, 62) << np.uint32(MANTISSA)) | (body >> np.uint32(32 - MANTISSA))
    reg = np.where(least == 0xFFFFFFFF, EMPTY, reg).astype("<u2")
    return reg.reshape(BANDS, n, ROWS).transpose(1, 0, 2).reshape(n, BANDS * ROWS)


def estimate(same: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Similarity from ``same`` equal registers of ``used`` that are filled on
    either side; a mantissa of 10 bits agrees by chance once in about 2^11."""
    chance = 2.0 ** -(MANTISSA + 1)
    return np.clip((same / np.maximum(used, 1) - chance) / (1 - chance), 0, 1)


def _agree(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether register rows may belong to sets of similarity ``least``."""
    filled = (a != EMPTY) | (b != EMPTY)
    used = filled.sum(-1)
    est = estimate(((a == b) & filled).sum(-1), used)
    return est >= least - 5 * np.sqrt(least * (1 - least) / np.maximum(used, 1))


def _sketch(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                h, offs = shingle_sets(part.column("text"), shingle)
                n = np.diff(offs)
                run = np.zeros((2, len(h) + 1), U64)
                np.cumsum(mix(h), out=run[0, 1:])
                np.cumsum(mix(h ^ U64(0xA5A5A5A5A5A5A5A5)), out=run[1, 1:])
                d = (run[:, offs[1:]] - run[:, offs[:-1]]).view(np.int64)
                reg = registers(h, offs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n.astype(np.int64)), pa.array(d[0]), pa.array(d[1]),
                     pa.array([r.tobytes() for r in reg], pa.binary())], ["id", "n", "d1", "d2", "reg"])
    return work


def _full(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                h, offs = shingle_sets(part.column("text"), shingle)
                sets = [h[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:])]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], ["id", "items"])
    return work


def _regs(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(len(col), BANDS * ROWS)


def _close(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                ok = _agree(_regs(b.column("ra")), _regs(b.column("rb")), percent / 100)
                yield b.select(["c", "x"]).filter(pa.array(ok))
    return work


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a stream that is sorted by ``keys``."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        cols = [np.asarray(b.column(k)) for k in keys]
        cut = np.zeros(len(b) - 1, bool)
        for c in cols:
            cut |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), len(b)]
        if rest and any(rest[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, cols)):
            yield pa.Table.from_batches(rest)
            rest = []
        for i, j in zip(edges[:-1], edges[1:]):
            rest.append(b.slice(i, j - i))
            if j < len(b):
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def _confirm(percent: int):
    """(c, x) of probes that link with at least one cell of their group."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in by_group(batches, ["c", "pb", "cb"]):
            kind = np.asarray(g.column("kind"))
            items = g.column("items").to_pylist()
            cells = [np.frombuffer(items[i], U64) for i in np.flatnonzero(kind == 0)]
            sizes = np.array([len(c) for c in cells])
            owner = np.repeat(np.arange(len(cells)), sizes)
            pool = np.concatenate(cells) if cells else np.zeros(0, U64)
            if len(cells) > 1:
                order = np.argsort(pool, kind="stable")
                pool, owner = pool[order], owner[order]
            x, linked = np.asarray(g.column("x")), []
            for i in np.flatnonzero(kind == 1):
                mine = np.frombuffer(items[i], U64)
                lo, hi = np.searchsorted(pool, mine, "left"), np.searchsorted(pool, mine, "right")
                if len(cells) == 1:
                    both = np.array([(hi - lo).sum()])
                else:
                    n = hi - lo
                    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    both = np.bincount(owner[at], minlength=len(cells))
                if (100 * both >= percent * (sizes + len(mine) - both)).any():
                    linked.append(x[i])
            if linked:
                c = g.column("c")[0].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(linked), pa.int64()),
                                                  pa.array(linked, pa.int64())], ["c", "x"])
    return work


def _verify(docs: DataFrame, probes: DataFrame, cells: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (c, x): probes (c, x, n) that are similar to a cell (c, x, n) of their
    c.  Both sides are cut into blocks by the size of their sets."""
    rows = probes.withColumn("kind", F.lit(1)).unionByName(cells.withColumn("kind", F.lit(0)))
    rows = store.write(rows, "compare")
    blocks = store.write(rows.groupBy("c").agg(
        F.ceil(F.sum(F.when(F.col("kind") == 1, F.col("n"))) / LOAD).cast("int").alias("pbs"),
        F.ceil(F.sum(F.when(F.col("kind") == 0, F.col("n"))) / LOAD).cast("int").alias("cbs")), "blocks")
    wanted = store.write(rows.select("x").distinct(), "wanted")
    sets = store.write(docs.join(wanted, F.col("id") == F.col("x")).select("id", "text")
                       .mapInArrow(_full(shingle), "id long, items binary"), "sets")
    spread = rows.join(blocks, "c")
    mine = F.pmod(F.xxhash64("x"), F.when(F.col("kind") == 1, F.col("pbs")).otherwise(F.col("cbs"))).cast("int")
    other = F.when(F.col("kind") == 1, F.col("cbs")).otherwise(F.col("pbs"))
    spread = spread.select("c", "x", "kind", mine.alias("mine"), F.explode(F.sequence(F.lit(0), other - 1)).alias("o"))
    spread = spread.select("c", "x", "kind", F.when(F.col("kind") == 1, F.col("mine")).otherwise(F.col("o")).alias("pb"),
                           F.when(F.col("kind") == 1, F.col("o")).otherwise(F.col("mine")).alias("cb"))
    full = spread.join(sets, F.col("x") == F.col("id")).select("c", "pb", "cb", "kind", "x", "items")
    return (full.repartition("c", "pb", "cb").sortWithinPartitions("c", "pb", "cb")
            .mapInArrow(_confirm(percent), "c long, x long").distinct())


def _across(percent: int):
    """Probes and cells of one bucket block: nodes of other components whose
    registers may be of similar sets.  A pair counts in its first common band."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in by_group(batches, ["key", "i", "j"]):
            x, comp, n, blk = (np.asarray(g.column(k)) for k in ("x", "comp", "n", "blk"))
            band, i, j = (g.column(k)[0].as_py() for k in ("band", "i", "j"))
            reg = _regs(g.column("reg").combine_chunks())
            names, inverse, size = np.unique(comp, return_inverse=True, return_counts=True)
            if len(names) < 2:
                continue
            most = int(np.argmax(size))
            out: set[tuple[int, int, int, int]] = set()
            for a in np.flatnonzero(inverse != most):
                b = np.flatnonzero((comp != comp[a]) & ((comp < comp[a]) | (inverse == most))
                                   & (100 * np.minimum(n, n[a]) >= percent * np.maximum(n, n[a])))
                if i != j:
                    b = b[blk[b] != blk[a]]
                b = b[_agree(reg[b], reg[a], percent / 100)]
                if band and len(b):
                    same = (reg[b, :band * ROWS] == reg[a, :band * ROWS]).reshape(len(b), band, ROWS).all(2).any(1)
                    b = b[~same]
                for k in b.tolist():
                    out.add((int(comp[k]), int(x[a]), int(n[a]), 1))
                    out.add((int(comp[k]), int(x[k]), int(n[k]), 0))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.int32()])],
                    ["c", "x", "n", "kind"])
    return work


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 2, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of every row of ``docs``.

    Documents are linked when 100 * |A and B| >= percent * |A or B|; a component
    is named by its smallest id, and that document is kept.  A null, empty or
    blank text has an empty set and is linked with nothing.  Rows that share an id
    are one document, linked by whatever either row's text is linked with.  A row
    with a null id takes no part: its component is null and it is kept.  Other
    columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sk = store.write(docs.mapInArrow(_sketch(shingle), "id long, n long, d1 long, d2 long, reg binary"), "sketch")
    live = sk.where("n > 0 and id is not null")
    groups = store.write(live.groupBy("d1", "d2", "n").agg(F.min("id").alias("node")), "groups")
    own = store.write(live.select("id", "d1", "d2", "n").join(groups, ["d1", "d2", "n"]).select("id", "node"), "own")
    nodes = store.write(live.join(groups.withColumnRenamed("node", "id"), ["d1", "d2", "n", "id"])
                        .groupBy("id", "n", "d1", "d2").agg(F.max("reg").alias("reg"))
                        .select(F.col("id").alias("x"), "n", "reg"), "nodes")
    bands = nodes.select("x", "n", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"), "reg")
    part = F.substring(F.col("reg"), F.col("band") * (2 * ROWS) + 1, F.lit(2 * ROWS))
    bands = bands.select("x", "n", "band", F.xxhash64("band", part).alias("key"))
    shared = store.write(bands.groupBy("key").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
                         .where("lo < hi").drop("hi"), "shared")
    members = store.write(bands.join(shared, "key"), "members")

    pairs = members.where("x <> lo").select(F.col("lo").alias("c"), "x").distinct()
    a, b = nodes.select(F.col("x"), F.col("reg").alias("ra"), F.col("n").alias("na")), \
        nodes.select(F.col("x").alias("c"), F.col("reg").alias("rb"), F.col("n").alias("nb"))
    sized = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    stars = store.write(pairs.join(a, "x").join(b, "c").where(sized).select("c", "x", "ra", "rb")
                        .mapInArrow(_close(percent), "c long, x long"), "stars")
    size = nodes.select("x", "n")
    links = store.write(_verify(docs, stars.join(size, "x").select("c", "x", "n"),
                                stars.select(F.col("c").alias("x")).distinct().join(size, "x")
                                .select(F.col("x").alias("c"), "x", "n"), shingle, percent), "links")
    twice = own.groupBy("id").agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u < v")
    edges = store.write(links.select(F.col("c").alias("u"), F.col("x").alias("v"))
                        .unionByName(twice.select("u", "v")), "links")
    comps = store.write(components(edges), "comps")

    placed = store.write(members.join(comps.withColumnRenamed("node", "x"), "x", "left")
                         .select("key", "band", "x", "n", F.coalesce("comp", "x").alias("comp")), "placed")
    mixed = store.write(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                                  F.count("*").alias("size"))
                        .where("lo < hi and size > 2").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("k")),
                        "mixed")
    rows = placed.join(mixed, "key").withColumn("blk", F.pmod(F.xxhash64("x"), "k").cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
    rows = rows.select("key", "band", "x", "n", "comp", "blk", F.least("blk", "o").alias("i"),
                       F.greatest("blk", "o").alias("j")).join(nodes.select("x", "reg").distinct(), "x")
    across = store.write(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                         .select("key", "i", "j", "band", "x", "n", "comp", "blk", "reg")
                         .mapInArrow(_across(percent), "c long, x long, n long, kind int").distinct(), "across")
    more = _verify(docs, across.where("kind = 1").drop("kind"), across.where("kind = 0").drop("kind"),
                   shingle, percent)
    more = more.join(comps.withColumnRenamed("node", "x"), "x", "left").select(
        F.col("c").alias("u"), F.coalesce("comp", "x").alias("v"))
    over = store.write(components(store.write(more, "more")), "over").select(
        F.col("node").alias("comp"), F.col("comp").alias("top"))

    named = own.join(comps.withColumnRenamed("node", "node_"), F.col("node") == F.col("node_"), "left") \
        .select("id", F.coalesce("comp", "node").alias("comp")).join(over, "comp", "left") \
        .groupBy("id").agg(F.min(F.coalesce("top", "comp")).alias("component_id"))
    return (sk.select("id", "n").join(named, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
                                          ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * k >= 80 * (na.n + nb.n - k)),
reach AS (SELECT doc_id, doc_id AS root FROM d
          UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id, d.doc_id = min(root) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""
