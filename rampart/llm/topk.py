"""Exact top-k inner products (operator 5) over vectors by descending length.

Components become floor(scale * x).  The queries are a stated set; they are taken in
blocks of at most QUERY_ROWS rows, and each block is one pass over all vectors:

* the rotation is the eigenvectors of the vectors' Gram matrix (their right singular
  vectors), summed over all rows by the tasks; it moves length to the front;
* a task takes its vectors sorted by descending length, tile by tile.  A query whose
  k-th best score so far exceeds its length times the tile's largest length is done
  (Cauchy-Schwarz).  For the rest, the sums over the first HEAD rotated dimensions
  plus the product of the lengths of what remains bound the score, and only the
  vectors whose bound reaches the k-th best get the exact integer product;
* each task gives at most k rows per query, and the best k of those are the result.

Bounds are computed in floating point with a slack above its rounding; scores are
exact 64-bit integers.  Equal scores are never pruned, so ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm import store

QUERY_ROWS, TILE, HEAD = 8192, 512, 16
NONE = -(1 << 62)          # below every score; its negative is a number too


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), width)


def integer_vectors(vecs: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v array<long>, len2): usable vectors; a vector that is null, empty or
    holds null or non-finite components is left out."""
    x = F.col(vec_col)
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    ints = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    out = vecs.where(usable).select(F.col(id_col).alias("id"), ints.alias("v"))
    return out.withColumn("len2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))


def rotation(vecs: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the sum of outer products, largest first (width x width)."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((width, width))
        for b in batches:
            m = _matrix(b.column("v"), width).astype(np.float64)
            g += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(g.ravel())], ["i", "g"])

    cells = vecs.select("v").mapInArrow(gram, "i long, g double").groupBy("i").agg(F.sum("g").alias("g"))
    g = np.zeros(width * width)
    for r in cells.collect():            # width * width numbers, whatever the input
        g[r["i"]] = r["g"]
    return np.linalg.eigh(g.reshape(width, width))[1][:, ::-1].copy()


class Block:
    """One block of queries with their best k so far, as a task sees it."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, rot: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        turned = q.astype(np.float64) @ rot
        self.head = turned[:, :HEAD].copy()
        self.tail = np.sqrt((turned[:, HEAD:] ** 2).sum(1))
        self.best = np.full((len(ids), k), NONE)
        self.who = np.full((len(ids), k), np.iinfo(np.int64).max)

    def take(self, ids: np.ndarray, v: np.ndarray, rot: np.ndarray) -> bool:
        """Score a tile of vectors, longest first; False when no query needs more."""
        x = v.astype(np.float64)
        longest = np.sqrt((x ** 2).sum(1)).max()
        least = np.where(self.who[:, -1] == np.iinfo(np.int64).max, -np.inf, self.best[:, -1].astype(np.float64))
        slack = 1e-9 * self.length * longest + 1e-6
        live = np.flatnonzero(self.length * longest + slack >= least)
        if not len(live):
            return False
        turned = x @ rot
        bound = self.head[live] @ turned[:, :HEAD].T
        bound += np.outer(self.tail[live], np.sqrt((turned[:, HEAD:] ** 2).sum(1)))
        may = bound + slack[live, None] >= least[live, None]
        rows = may.any(1)
        cols = may.any(0)
        live = live[rows]
        if len(live):
            score = self.q[live] @ v[cols].T
            other = np.broadcast_to(ids[cols], score.shape)
            score = np.where(other == self.ids[live, None], NONE, score)
            other = np.where(other == self.ids[live, None], np.iinfo(np.int64).max, other)
            score = np.concatenate([self.best[live], score], 1)
            other = np.concatenate([self.who[live], other], 1)
            order = _best(score, other, self.k)
            self.best[live] = np.take_along_axis(score, order, 1)
            self.who[live] = np.take_along_axis(other, order, 1)
        return True


def _best(score: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row, ties to the smaller id."""
    kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
    out = np.empty((len(score), k), np.int64)
    for r in range(len(score)):
        c = np.flatnonzero(score[r] >= kth[r])
        out[r] = c[np.lexsort((other[r, c], -score[r, c]))[:k]]
    return out


def top_k(vecs: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): for each row of ``vecs`` that ``is_query``
    (a condition on the integer id column ``id``) picks, its k best other rows.

    Vectors that are null, empty or hold null or non-finite components take no part,
    nor do rows with a null id.  Rows that repeat an id are candidates of their own for
    other queries, but never for their own id; such a repeated query gives one result,
    by its first vector in component order.  No usable rows give no rows.  Vectors of another width than the most
    common one are compared within their own width.
    """
    spark = vecs.sparkSession
    ints = store.write(integer_vectors(vecs, id_col, vec_col, scale).where("id is not null"), "vectors")
    schema = f"query_id long, {id_col} long, score long"
    parts: list[DataFrame] = []
    for width in [r[0] for r in ints.groupBy(F.size("v").alias("w")).count().select("w").orderBy("w").collect()]:
        own = ints.where(F.size("v") == width)
        rot = rotation(own, width)
        queries = own.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
        blocks = -(-queries.count() // QUERY_ROWS)
        # longest first within each task; one long stretch of equal lengths is no trouble
        sorted_ = own.sortWithinPartitions(F.desc("len2")).select("id", "v")
        for b in range(blocks):
            rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
            if not rows:
                continue
            ids = np.array([r["id"] for r in rows], np.int64)
            q = np.array([r["v"] for r in rows], np.int64)

            def work(batches: Iterator[pa.RecordBatch], ids=ids, q=q, width=width, rot=rot) -> Iterator[pa.RecordBatch]:
                state = Block(ids, q, rot, k)
                more = True
                for batch in batches:
                    for i in range(0, len(batch) if more else 0, TILE):
                        part = batch.slice(i, TILE)
                        more = state.take(np.asarray(part.column("id")), _matrix(part.column("v"), width), rot)
                        if not more:
                            break
                found = state.who < np.iinfo(np.int64).max
                row = np.nonzero(found)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(state.who[found]), pa.array(state.best[found])],
                    ["query_id", id_col, "score"])

            # written before the next block is read: the driver holds one block of queries
            found = sorted_.mapInArrow(work, schema)
            parts.append(found if blocks == 1 else store.write(found, "found"))
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", id_col, "score"))


def op5(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
