"""Benchmark decontamination (operator 9): item-sized windows under SimHash.

A window has as many words as a benchmark item (lower-cased A-Z; the whole text
where that is shorter).  Its features are its 5-word shingles, each weighted by the
bytes of its words; its fingerprint has 128 bits.  Fingerprints are cut into 16
blocks of 8 bits: two that differ in at most RADIUS bits differ in at most
RADIUS // 16 bits in one block at least, so the block tables name every item within
the radius.  The named items within the radius are verified by the exact similarity

    sum over shingles of weight * min(count) / sum of weight * max(count)  >=  0.8.

Only windows that hold at least one shingle of an item of their size are
fingerprinted: a window without one has similarity 0.  RADIUS is 48: similarity 0.8
means about 20 differing bits, with a standard deviation of 4.

Documents are scanned where they are; nothing is shuffled.  The benchmark is sent to
the tasks in blocks of at most ITEM_BYTES, one pass over the documents each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.words import U64, Rolling, Words, mix, slices, words_of

SHINGLE, LEAST, RADIUS = 5, 0.8, 48
ITEM_BYTES = 8 << 20
_BITS, _BLOCKS = 128, 16
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NEAR = _POP[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // _BLOCKS


def fingerprint(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """uint8 fingerprints (windows x 16) of shingle hashes (windows x shingles)."""
    bits = np.empty((*shingles.shape, _BITS), np.int8)
    for half in range(2):
        code = mix(shingles ^ U64(0x9E3779B97F4A7C15 * (half + 1) % (1 << 64)))
        raw = code.astype("<u8").view(np.uint8).reshape(*shingles.shape, 8)
        bits[..., 64 * half:64 * half + 64] = np.unpackbits(raw, axis=-1)
    score = np.einsum("wsb,ws->wb", bits, 2 * weights.astype(np.int32), dtype=np.int32)
    return np.packbits(score > weights.sum(1, dtype=np.int32)[:, None], axis=1)


def similarity(a: dict, b: dict, weight: dict) -> float:
    both = sum(weight[s] * min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(weight[s] * n for s, n in a.items()) + sum(weight[s] * n for s, n in b.items())
    return both / (total - both) if total > both else 0.0


class Items:
    """Items of one size: shingles, fingerprints and block tables."""

    def __init__(self, size: int):
        self.size, self.k = size, min(SHINGLE, size)
        self.ids: list[int] = []
        self.sets: list[Counter] = []
        self.weight: dict[int, int] = {}
        self.prints = np.zeros((0, _BLOCKS), np.uint8)

    def add(self, item_id, w: Words, row: int, h: np.ndarray) -> None:
        a, b = w.first[row], w.first[row + 1]
        start = np.arange(a, b - self.k + 1)
        s, wt = Rolling(h).of(start, self.k), word_bytes(w, start, self.k)
        self.ids.append(item_id)
        self.sets.append(Counter(s.tolist()))
        self.weight.update(zip(s.tolist(), wt.tolist()))
        self.prints = np.concatenate([self.prints, fingerprint(s[None], wt[None])])

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) within RADIUS bits, found through the blocks."""
        named = np.zeros((len(prints), len(self.ids)), bool)
        for b in range(_BLOCKS):
            named |= _NEAR[:, self.prints[:, b]][prints[:, b]]
        win, item = np.nonzero(named)
        far = _POP[prints[win] ^ self.prints[item]].sum(1, dtype=np.int64)
        return win[far <= RADIUS], item[far <= RADIUS]


def word_bytes(w: Words, start: np.ndarray, k: int) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(w.end - w.start)])
    return run[start + k] - run[start]


class Bench:
    """A block of benchmark items, ready to look up windows of documents."""

    def __init__(self, items: list[tuple[int, str]]):
        w = words_of(pa.array([t for _, t in items], pa.string()), lower=True)
        h = w.hashes()
        self.sizes: dict[int, Items] = {}
        for row, (item_id, _) in enumerate(items):
            n = int(w.counts[row])
            if n:
                self.sizes.setdefault(n, Items(n)).add(item_id, w, row, h)
        self.grams: dict[int, tuple] = {}
        for k in {g.k for g in self.sizes.values()}:
            pairs = sorted({(s, n) for n, g in self.sizes.items() if g.k == k for c in g.sets for s in c})
            keys, first = np.unique(np.array([p[0] for p in pairs], U64), return_index=True)
            low = np.zeros(1 << 20, bool)
            low[(keys & U64(0xFFFFF)).astype(np.int64)] = True
            self.grams[k] = (keys, np.append(first, len(pairs)), np.array([p[1] for p in pairs]), low)

    def windows(self, w: Words, h: np.ndarray) -> Iterator[tuple[Items, np.ndarray, np.ndarray]]:
        """(items of a size, row, first word) of each window to fingerprint."""
        owner = w.row_of()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        runs = Rolling(h)
        for k, (keys, first, sizes, low) in self.grams.items():
            if len(h) < k:
                continue
            g = runs.of(np.arange(len(h) - k + 1), k)
            at = np.flatnonzero(low[(g & U64(0xFFFFF)).astype(np.int64)])
            at = at[owner[at] == owner[at + k - 1]]
            slot = np.minimum(np.searchsorted(keys, g[at]), len(keys) - 1)
            hit = keys[slot] == g[at]
            at, slot = at[hit], slot[hit]
            n = first[slot + 1] - first[slot]
            pick = np.repeat(first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append((np.repeat(at, n), sizes[pick]))
        if not found:
            return
        pos, size = (np.concatenate(x) for x in zip(*found))
        row = owner[pos]
        k = np.minimum(size, SHINGLE)
        lo = np.maximum(w.first[row], pos - (size - k))
        hi = np.maximum(w.first[row], np.minimum(pos, w.first[row + 1] - size))
        for n in np.unique(size).tolist():
            m = size == n
            spread = hi[m] - lo[m] + 1
            start = np.repeat(lo[m] - np.cumsum(spread) + spread, spread) + np.arange(spread.sum())
            start = np.unique(start)
            yield self.sizes[n], owner[start], start

    def hits(self, w: Words) -> list[tuple[int, int, int, int, float]]:
        """(row, item, first word in the text, words, similarity): the best window
        of each text and item, the first one on a tie."""
        h = w.hashes()
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for items, row, start in self.windows(w, h):
            size = np.minimum(items.size, w.first[row + 1] - start)
            for length in np.unique(size).tolist():
                if length < items.k:
                    continue
                m = size == length
                for i in range(0, int(m.sum()), 512):
                    self._look(items, w, h, row[m][i:i + 512], start[m][i:i + 512], length, best)
        return [(r, items, a, n, s) for (r, items), (s, a, n) in sorted(best.items())]

    def _look(self, items: Items, w: Words, h, row, start, length: int, best: dict) -> None:
        a, b = start[0], start[-1] + length
        grid = (start - a)[:, None] + np.arange(length - items.k + 1)[None, :]
        part = Rolling(h[a:b]).of(np.arange(b - a - items.k + 1), items.k)
        wts = word_bytes(w, a + np.arange(b - a - items.k + 1), items.k)
        shingles, weights = part[grid], wts[grid]
        win, item = items.near(fingerprint(shingles, weights))
        seen: dict[int, tuple[Counter, dict]] = {}
        for x, y in zip(win.tolist(), item.tolist()):
            if x not in seen:
                s = shingles[x].tolist()
                seen[x] = Counter(s), dict(zip(s, weights[x].tolist()))
            mine, weight = seen[x]
            sim = similarity(mine, items.sets[y], {**items.weight, **weight})
            if sim >= LEAST:
                key = (int(row[x]), items.ids[y])
                at = int(start[x] - w.first[row[x]])
                old = best.get(key)
                if old is None or (sim, -at) > (old[0], -old[1]):
                    best[key] = (sim, at, length)


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items (item_id, text) in blocks of about ITEM_BYTES; null texts and ids are
    no items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct()
    total = items.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    blocks = -(-total // ITEM_BYTES)
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield [(r[0], r[1]) for r in part.collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, item_id, start, n_words, similarity): for each row of ``docs`` and
    each item that one of its windows holds, the most similar window (first on a
    tie; start counts words).

    Null, empty and blank texts and items match nothing.  An item under five words
    is one shingle and has to occur whole.  Repeated rows give repeated results;
    rows with a null id are reported with that.  Other columns are not looked at.
    """
    out = None
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, item_id long, start int, n_words int, similarity double"
    for block in item_blocks(benchmark):
        bench = Bench(block)

        def work(batches: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    rows = bench.hits(words_of(part.column("text"), lower=True))
                    if rows:
                        row, item, at, n, sim = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("id").take(pa.array(row)), pa.array(item, pa.int64()), pa.array(at, pa.int32()),
                             pa.array(n, pa.int32()), pa.array(sim, pa.float64())],
                            ["id", "item_id", "start", "n_words", "similarity"])

        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], T._parse_datatype_string(schema))
    return out.withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no window of an item
    (see ``leaks``)."""
    schema = docs.schema
    for block in item_blocks(benchmark):
        bench = Bench(block)

        def work(batches: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col):
                    keep = np.ones(len(part), bool)
                    keep[[r[0] for r in bench.hits(words_of(part.column(text_col), lower=True))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(work, schema)
    return docs


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
