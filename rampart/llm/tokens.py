"""Token counts (operator 2): a digest cache in front of the tokenizer.

The normalised content of a document (null becomes the empty text; nothing else
is changed, for the tokenizer sees every byte) is named by its SHA-256, the
tokenizer by the SHA-256 of its file.  Stored counts are joined on the two
digests; only distinct contents that the cache lacks are encoded, by one
document that holds each, and their counts are appended to the cache.

Inside a task the encoder keeps the ids of words it has met (``WordCoder``): the
tokenizer used here drops white space and never joins what white space parts, so
a text's ids are its words' ids one after another.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.words import Words, slices, words_of

WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Slots:
    """A map from 64-bit keys to numbers in sorted arrays, a few runs of growing
    size; far smaller than a dict."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def __len__(self) -> int:
        return self.size

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        for k, v in self.runs:
            at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
            hit = k[at] == keys
            out[hit] = v[at[hit]]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` are ascending and not in the map."""
        self.size += len(keys)
        run = keys, values.astype(np.int32)
        while self.runs and len(self.runs[-1][0]) < 2 * len(run[0]):
            k, v = self.runs.pop()
            k, v = np.concatenate([k, run[0]]), np.concatenate([v, run[1]])
            order = np.argsort(k, kind="stable")
            run = k[order], v[order]
        self.runs.append(run)


class WordCoder:
    """Ids of whole texts by the tokenizers library, one call per new word.

    ``ids(words)`` gives all ids of a slice in order and the offsets of its
    texts.  A word made of plain letters and a tail of ASCII punctuation is cut
    there, as the tokenizer's own splitter does, and the letters' ids are kept
    in lower case; any other word goes through the whole tokenizer.  Both stores
    are emptied when they hold ``limit`` entries, so memory stays bounded.
    """

    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\Z")

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.limit = self.tokenizer.model, limit
        self.letters = _byte_letters()
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.clear()

    def clear(self) -> None:
        self.slot = Slots()                     # word hash -> row of the table below
        self.parts: dict[str, bytes] = {}       # letters or tail -> ids
        self.flat = np.empty(1 << 16, np.uint16 if self.small else np.uint32)
        self.at = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _part(self, text: str) -> bytes:
        got = self.parts.get(text)
        if got is None:
            shown = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            got = self.parts[text] = self._raw([t.id for t in self.model.tokenize(shown)])
        return got

    def _raw(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.small else 'I'}", *ids)

    def _encode(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        m = self.PLAIN.match(text)
        if m and "|" not in m[2]:
            ids = self._part(m[1].lower())
            return ids + self._part(m[2]) if m[2] else ids
        return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Rows of new words."""
        n = len(self.slot)
        raws = [self._encode(x) for x in words]
        ids = np.frombuffer(b"".join(raws), "<u2" if self.small else "<u4")
        while n + len(words) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat), self.flat.dtype)])
        self.flat[self.used:self.used + len(ids)] = ids
        size = np.array([len(r) for r in raws], np.int64) // ids.itemsize
        self.at[n + 1:n + 1 + len(words)] = self.used + np.cumsum(size)
        self.used += len(ids)
        return np.arange(n, n + len(words))

    def slots(self, w: Words) -> np.ndarray:
        if len(self.slot) > self.limit or len(self.parts) > self.limit:
            self.clear()
        keys, at, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        found = self.slot.find(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = self._learn([w.word(i) for i in at[new].tolist()])
            self.slot.add(keys[new], found[new])
        return found[inverse]

    def counts(self, w: Words) -> np.ndarray:
        """Tokens of each text."""
        s = self.slots(w)
        run = np.concatenate([[0], np.cumsum(self.at[s + 1] - self.at[s])])
        return run[w.first[1:]] - run[w.first[:-1]]

    def ids(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice, and where each text's ids start (texts + 1)."""
        s = self.slots(w)
        size = self.at[s + 1] - self.at[s]
        run = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(run[-1]) + np.repeat(self.at[s] - run[:-1], size)
        return self.flat[take].astype(np.uint32), run[w.first]


def _byte_letters() -> list[str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the
    rest for letters from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b if b in shown else more)
        more += b not in shown
    return out


@functools.lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    """One coder for a worker process, so that the tokenizer is read once."""
    return WordCoder(path)


@contextlib.contextmanager
def coding(path: str) -> Iterator[WordCoder]:
    """The worker's coder for one task.  Its words are dropped with the task: a worker
    that goes on to other work holds no memory for them."""
    c = coder(path)
    try:
        yield c
    finally:
        c.clear()


@functools.lru_cache(maxsize=4)
def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def count_tokens(docs: DataFrame, path: str, cache_dir: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id_col, digest, n_bytes, n_tokens) of every row of ``docs``.

    ``cache_dir`` is a Parquet folder of (content, tokenizer, n_tokens); it may
    be empty or not exist.  Rows that several runs have appended for one content
    are one row when read.  A null or empty text has 0 tokens; a null or repeated
    id is kept as it is; other columns of ``docs`` are not looked at.
    """
    spark, version = docs.sparkSession, tokenizer_digest(path)
    kept = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kept = kept.withColumn("content", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    schema = "content binary, tokenizer string, n_tokens long"
    spark.createDataFrame([], schema).write.mode("append").parquet(cache_dir)
    stored = (spark.read.schema(schema).parquet(cache_dir).where(F.col("tokenizer") == version)
              .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    missing = kept.groupBy("content").agg(F.min("id").alias("id")) \
        .join(stored.select("content"), "content", "left_anti")
    # one document for each missing content; ids are the join key, so a content
    # that a third of all documents share moves once
    work = kept.join(missing.select(F.col("id").alias("one"), F.col("content").alias("its")),
                     F.col("id").eqNullSafe(F.col("one")) & (F.col("content") == F.col("its")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coding(path) as c:
            for batch in batches:
                for part in slices(batch):
                    n = c.counts(words_of(part.column("text")))
                    yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(n, pa.int64())],
                                                     ["content", "n_tokens"])

    counted = work.select("content", "text").mapInArrow(encode, "content binary, n_tokens long") \
        .dropDuplicates(["content"])
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens") \
        .write.mode("append").parquet(cache_dir)
    stored = (spark.read.schema(schema).parquet(cache_dir).where(F.col("tokenizer") == version)
              .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    return (kept.select("id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
            .join(stored, "content")
            .select(F.col("id").alias(id_col), F.hex("content").alias("digest"), "n_bytes", "n_tokens"))


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (count_tokens(docs, tokenizer_path(), store.folder(spark, "tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit")))
