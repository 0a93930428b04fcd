"""Packing (operator 4): bounded-space online packing of token ids.

Each partition keeps ``windows`` open sequences.  A document's ids (with the end
id) are first cut into whole sequences; what is left goes into the open sequence
that it fills best.  When none has room, the fullest one is topped up with the
head of the piece and emitted, and the rest of the piece starts a new sequence.
At the end of a partition the open sequences are merged into whole ones; the
single one that stays short of that is merged with those of other partitions, in
groups of ``fan`` until groups do not shrink any more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.tokens import coding, tokenizer_path
from rampart.llm.words import slices, words_of

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long, left binary")
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "left"]
_TYPES = [pa.int64()] * 7 + [pa.binary()]
_GROUPS_FROM = 1 << 62


class Packer:
    """Open sequences of one partition; ``out`` collects finished pieces."""

    def __init__(self, size: int, windows: int, first_id: int):
        self.size, self.windows, self.next_id = size, windows, first_id
        self.open: list[tuple[int, list[tuple]]] = []   # (filled, pieces)
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.size:
            self._emit([(doc, at, ids[at:at + self.size], total)])
            at += self.size
        if at < total:
            self._place((doc, at, ids[at:], total))

    def _place(self, piece: tuple) -> None:
        need, best = len(piece[2]), -1
        for i, (filled, _) in enumerate(self.open):
            if filled + need <= self.size and (best < 0 or filled > self.open[best][0]):
                best = i
        if best < 0 and len(self.open) < self.windows:
            self.open.append((need, [piece]))
            return
        if best < 0:
            best = max(range(len(self.open)), key=lambda i: self.open[i][0])
            filled, pieces = self.open.pop(best)
            doc, at, ids, total = piece
            room = self.size - filled
            self._emit([*pieces, (doc, at, ids[:room], total)])
            rest = (doc, at + room, ids[room:], total)
            self.open.append((len(rest[2]), [rest]))
            return
        filled, pieces = self.open[best]
        pieces.append(piece)
        self.open[best] = (filled + need, pieces)
        if filled + need == self.size:
            self.open.pop(best)
            self._emit(pieces)

    def _emit(self, pieces: list[tuple], left: bool = False) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            raw = ids.astype("<u4").tobytes()
            self.out.append((doc, start, len(ids), zlib.crc32(raw), total, self.next_id, at,
                             raw if left else None))
            at += len(ids)
        self.next_id += 1

    def close(self, left: bool) -> None:
        """Merge the open sequences, fullest first; the last is ``left`` over."""
        run: list[tuple] = []
        filled = 0
        for _, pieces in sorted(self.open, key=lambda x: -x[0]):
            for doc, at, ids, total in pieces:
                while filled + len(ids) >= self.size:
                    room = self.size - filled
                    self._emit([*run, (doc, at, ids[:room], total)])
                    run, filled, at, ids = [], 0, at + room, ids[room:]
                if len(ids):
                    run.append((doc, at, ids, total))
                    filled += len(ids)
        self.open = []
        if run:
            self._emit(run, left)

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.out)) or [()] * 8
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _FIELDS)


def pack(docs: DataFrame, path: str, size: int = 4096, end_id: int = 2, windows: int = 64,
         fan: int = 64) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text): one row per piece with
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text has the end id alone.  Rows with a null or repeated
    doc_id are packed like any other.  An empty table gives no rows.  Other
    columns are not read.  The ids of at most ``windows`` sequences are in a
    task's memory besides one slice of texts.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Packer(size, windows, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], np.uint32)
        with coding(path) as c:
            for batch in batches:
                for part in slices(batch):
                    ids, at = c.ids(words_of(part.column("text")))
                    for doc, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                        p.add(doc, np.concatenate([ids[a:b], end]))
                    yield p.take()
        p.close(True)
        yield p.take()

    def merge(first_id: int):
        def run(key, table):
            p = Packer(size, 1 << 30, first_id + (key[0].as_py() << 12))
            table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
            for r in table.to_pylist():
                p.open.append((0, [(r["doc_id"], r["start"], np.frombuffer(r["left"], "<u4"), r["doc_tokens"])]))
            p.close(True)
            return pa.Table.from_batches([p.take()])
        return run

    pieces = store.write(docs.select("doc_id", "text").mapInArrow(work, PIECE), "pieces")
    done, left = [pieces.where("left is null")], pieces.where("left is not null")
    level = 0
    number = F.shiftright("sequence_id", 36)
    while True:
        groups = left.select(number.alias("n")).distinct().count()
        if groups <= 1:
            break
        level += 1
        merged = store.write(left.groupBy(F.floor(number / fan).cast("long").alias("g"))
                             .applyInArrow(merge(_GROUPS_FROM + (level << 56)), PIECE), "merged")
        done.append(merged.where("left is null"))
        left = merged.where("left is not null")
        number = F.shiftright(F.col("sequence_id") - F.lit(_GROUPS_FROM + (level << 56)), 12)
    out = left
    for d in done:
        out = out.unionByName(d)
    return out.drop("left")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, tokenizer_path())
