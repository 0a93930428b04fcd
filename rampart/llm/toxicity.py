"""Toxicity (operator 6): a subsequence string-kernel SVM with Nystrom landmarks.

A unit is a word in lower case without its signs, between a mark for its start and one
for its end; runs of single letters ("i d i o t") also make one unit.  Units are
compared by the gap-weighted subsequence kernel: every three characters of a unit that
lie within SPAN places are a feature of weight DECAY ** (places spanned), so inserted,
dropped and separated characters leave most features in place.  Features live on a
fixed alphabet, which makes the kernel exact and cheap: K(u, v) is a product of two
sparse vectors.

Landmarks are units of the labelled sentences.  With K_mm the kernel of the landmarks,
a unit's features are K_mm^(-1/2) K_m(u) (Nystrom), and a linear SVM with squared hinge
loss is fitted on them by Newton steps.  The witness units of a toxic sentence are
those that toxic texts hold far more often than others (G test); clean texts give the
other side, first a hashed choice, then the ones that a first fit scores highest.
Witnesses also enter with a letter inserted or doubled.  As the SVM is linear in the
kernel values, landmarks and weights fold into one weight per feature; a unit's score
is that sum over the square root of its own kernel.

The sample keeps one row of each group of copies: a text that occurs a thousand times
would make witnesses of all its words.

A text's score is a logistic function of its highest unit's score and of how many of
its units are high, fitted on the labelled texts.  Everything that is learned has
a fixed size; scoring is one scan, and a worker keeps the scores of words it has met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.labelled import SAMPLE_ROWS, fold, logistic, one_of_copies, sigmoid, training_rows
from rampart.llm.words import Words, slices, words_of

SPAN, DECAY, LETTERS = 6, 0.6, 64
LANDMARKS, POSITIVES, NEGATIVES = 256, 1_000, 6_000
PIECE, STEP = 48, 32           # longer units are cut into overlapping pieces
NOTHING = -6.0                 # score of a text without units

_TRIPLES = np.array([(j, k) for j in range(1, SPAN - 1) for k in range(j + 1, SPAN)])
_DECAYS = DECAY ** (_TRIPLES[:, 1] + 1).astype(float)
_FOLD = np.full(256, -1, np.int64)      # signs and controls are no letters
_FOLD[48:58] = 27                       # one letter for all digits
for _b in range(26):
    _FOLD[65 + _b] = _FOLD[97 + _b] = 1 + _b
_FOLD[128:192] = 28 + np.arange(64) % 32 % 30     # second bytes of UTF-8 letters, cases alike
_FOLD[192:] = 60 + np.arange(64) % 4


START, END = 58, 59


def letters(raw: bytes) -> np.ndarray:
    code = _FOLD[np.frombuffer(raw, np.uint8)]
    return code[code >= 0]


def grid(units: list[np.ndarray]) -> np.ndarray:
    """Units as rows, filled up with 0."""
    out = np.zeros((len(units), max([3, *map(len, units)]) + 2), np.int64)
    out[:, 0] = START
    for i, u in enumerate(units):
        out[i, 1:len(u) + 1] = u
        out[i, len(u) + 1] = END
    return out


def features(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature codes, weights) of each row; code 0 stands for none."""
    n, width = g.shape
    pad = np.concatenate([g, np.zeros((n, SPAN), np.int64)], 1)
    codes = np.empty((n, width, len(_TRIPLES)), np.int64)
    for t, (j, k) in enumerate(_TRIPLES):
        a, b, c = g, pad[:, j:j + width], pad[:, k:k + width]
        codes[:, :, t] = np.where((b > 0) & (c > 0), (a * LETTERS + b) * LETTERS + c, 0)
    weights = np.broadcast_to(_DECAYS, codes.shape)
    return codes.reshape(n, -1), weights.reshape(n, -1)


def own_kernel(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """K(u, u) of each row: features that occur twice are added first."""
    order = np.argsort(codes, axis=1, kind="stable")
    c, w = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    n, m = c.shape
    new = np.ones((n, m), bool)
    new[:, 1:] = c[:, 1:] != c[:, :-1]
    at = np.flatnonzero(new.ravel())
    total = np.add.reduceat(w.ravel(), at)
    total[c.ravel()[at] == 0] = 0
    return np.bincount(at // m, weights=total ** 2, minlength=n)


class Model:
    """One weight per feature, the SVM's bias and the last logistic step."""

    def __init__(self, weight: np.ndarray, bias: float, last: np.ndarray):
        self.weight, self.bias, self.last = weight.astype(np.float32), bias, last
        self.memo: dict[int, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "memo": {}}

    def units(self, parts: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(parts), NOTHING)
        size = np.array([len(p) for p in parts], np.int64)
        for lo, hi in ((2, 8), (8, 14), (14, PIECE)):
            pick = np.flatnonzero((size > lo) & (size <= hi))
            for i in range(0, len(pick), 2048):
                some = pick[i:i + 2048]
                codes, weights = features(grid([parts[j] for j in some]))
                norm = np.sqrt(np.maximum(own_kernel(codes, weights), 1e-12))
                out[some] = (self.weight[codes] * weights).sum(1) / norm + self.bias
        return out

    def raw_units(self, raws: list[bytes]) -> np.ndarray:
        """Highest score among the pieces of each word."""
        parts, owner = [], []
        for i, raw in enumerate(raws):
            u = letters(raw)
            for a in range(0, max(len(u) - PIECE, 0) + STEP, STEP) if len(u) > PIECE else (0,):
                parts.append(u[a:a + PIECE])
                owner.append(i)
        out = np.full(len(raws), NOTHING)
        if parts:
            np.maximum.at(out, np.array(owner), self.units(parts))
        return out

    def words(self, w: Words) -> np.ndarray:
        if len(self.memo) > 1_500_000:
            self.memo.clear()
        keys, at, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        found = [self.memo.get(k) for k in keys.tolist()]
        new = [i for i, s in enumerate(found) if s is None]
        if new:
            for i, s in zip(new, self.raw_units([w.word(at[i]) for i in new]).tolist()):
                found[i] = self.memo[int(keys[i])] = s
        return np.asarray(found, float)[inverse]

    def texts(self, w: Words) -> np.ndarray:
        """(score of the highest unit, log of how many are high) per text."""
        n = len(w.first) - 1
        s, row = self.words(w), w.row_of()
        runs = list(spelled(w))
        if runs:
            s = np.concatenate([s, self.raw_units([joined for _, joined in runs])])
            row = np.concatenate([row, np.array([r for r, _ in runs], np.int64)])
        out = np.tile([NOTHING, 0.0], (n, 1))
        if len(s):
            np.maximum.at(out[:, 0], row, s)
            out[:, 1] = np.log1p(np.bincount(row, weights=s > 0, minlength=n))
        return out

    def score(self, w: Words) -> np.ndarray:
        x = self.texts(w)
        return sigmoid(x @ self.last[:-1] + self.last[-1])


def spelled(w: Words) -> Iterator[tuple[int, bytes]]:
    """(row, letters) of runs of at least three one-letter words."""
    size = w.end - w.start
    one = (size == 1) | ((size == 2) & (w.data[w.start] >= 0xC0)) if len(w) else np.zeros(0, bool)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], one.astype(np.int8), [0]])))
    owner = w.row_of()
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        cuts = [a, *(a + 1 + np.flatnonzero(owner[a + 1:b] != owner[a:b - 1])).tolist(), b]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j - i >= 3:
                yield int(owner[i]), b"".join(w.word(k) for k in range(i, j))


def kernel(a: tuple, b: tuple) -> np.ndarray:
    """Normalised kernel of two lists of units, given as (codes, weights)."""
    size = LETTERS ** 3
    seen = np.unique(b[0])
    place = np.full(size, -1, np.int64)
    place[seen] = np.arange(len(seen))
    place[0] = -1

    def dense(x):
        m = np.zeros((len(x[0]), len(seen)), np.float32)
        col = place[x[0]]
        ok = col >= 0
        np.add.at(m, (np.nonzero(ok)[0], col[ok]), x[1][ok])
        return m / np.sqrt(np.maximum(own_kernel(*x), 1e-12))[:, None]

    mb = dense(b)
    return np.concatenate([dense((a[0][i:i + 1024], a[1][i:i + 1024])) @ mb.T for i in range(0, max(len(a[0]), 1), 1024)])


def varied(units: list[np.ndarray], seed: int = 11) -> list[np.ndarray]:
    """Each unit with one letter inserted, one doubled, and one digit inserted."""
    rng, out = np.random.default_rng(seed), []
    for u in units:
        for code in (rng.integers(1, 27), None, 27):
            i = int(rng.integers(1, len(u)))
            out.append(np.insert(u, i, u[i] if code is None else code))
    return out


def train_units(pos: list[np.ndarray], neg: list[np.ndarray], hard: list[np.ndarray]):
    """(feature weights, bias) of the SVM on units."""
    plain, pos = len(pos), pos + varied(pos)
    fp = features(grid(pos + neg + hard))
    y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg) + len(hard))])
    # landmarks: spread over the witnesses, then over the others most like them
    like = kernel(fp, (fp[0][:plain], fp[1][:plain]))
    chosen, near = [], np.zeros(plain)
    for _ in range(min(LANDMARKS * 2 // 3, plain)):
        i = int(np.argmin(near))
        chosen.append(i)
        near = np.maximum(near, like[:plain, i])
        near[i] = 2
    close = len(pos) + np.argsort(-like[len(pos):].max(1), kind="stable")[:LANDMARKS - len(chosen)]
    marks = np.concatenate([np.array(chosen, np.int64), close])
    lm = fp[0][marks], fp[1][marks]
    kmm = kernel(lm, lm).astype(float)
    val, vec = np.linalg.eigh(kmm + 1e-4 * np.eye(len(marks)))
    root = vec @ np.diag(np.maximum(val, 1e-6) ** -0.5) @ vec.T
    x = kernel(fp, lm) @ root
    x1 = np.hstack([x, np.ones((len(x), 1))])
    cost = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    keep = np.full(x1.shape[1], 0.1)
    keep[-1] = 1e-3
    w1, active = np.zeros(x1.shape[1]), np.ones(len(y), bool)
    for _ in range(50):
        xa = x1[active] * cost[active, None]
        w1 = np.linalg.solve(np.diag(keep) + x1[active].T @ xa, xa.T @ y[active])
        now = y * (x1 @ w1) < 1
        if (now == active).all():
            break
        active = now
    w, b = w1[:-1], w1[-1]
    beta = root @ w / np.sqrt(np.maximum(own_kernel(*lm), 1e-12))
    weight = np.zeros(LETTERS ** 3)
    np.add.at(weight, lm[0], lm[1] * beta[:, None])
    weight[0] = 0
    return weight, float(b)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most ``rows`` labelled documents outside fold ``held``.
    Without witnesses of toxicity every text has the share of toxic labels."""
    sample = store.write(one_of_copies(training_rows(docs, labels, "toxic", folds, held, rows)), "toxic-sample")

    def unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w, seen = words_of(part.column("text"), lower=True), set()
                y = part.column("y").to_pylist()
                _, at = np.unique(w.row_of().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ w.hashes(), return_index=True)
                owner = w.row_of()
                for i in at.tolist():
                    u = letters(w.word(i))
                    if len(u) > 2:
                        seen.add((int(owner[i]), u[:PIECE].astype(np.uint8).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([u for _, u in seen], pa.binary()),
                                                  pa.array([y[r] for r, _ in seen], pa.int32())], ["u", "y"])

    counts = store.write(sample.mapInArrow(unit_rows, "u binary, y int").groupBy("u")
                         .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")), "units")
    total = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    share = (n1 + 0.5) / (n1 + n0 + 1)
    plain = Model(np.zeros(LETTERS ** 3), NOTHING, np.array([0, 0, np.log(share / (1 - share))]))
    if not n1 or not n0:
        return plain
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    expect = (a + b) * F.lit(n1 / (n1 + n0))
    g = 2 * (a * F.log(a / expect) + F.when(b > 0, b * F.log(b / ((a + b) - expect))).otherwise(0.0))
    pos = [np.frombuffer(r["u"], np.uint8).astype(np.int64) for r in counts.where("a >= 3")
           .where((a / n1 > 8 * b / n0) & (g > 20)).orderBy(F.desc(g), "u").limit(POSITIVES).select("u").collect()]
    others = counts.where((b >= 1) & (a / n1 < 3 * b / n0 + 2 / n1))
    neg = [np.frombuffer(r["u"], np.uint8).astype(np.int64) for r in
           others.orderBy(F.xxhash64("u"), "u").limit(NEGATIVES).select("u").collect()]
    if not pos or not neg:
        return plain
    model, hard = plain, []
    for _ in range(2):
        weight, bias = train_units(pos, neg, hard)
        model = Model(weight, bias, plain.last)

        def high(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raws = batch.column("u").to_pylist()
                s = model.units([np.frombuffer(u, np.uint8).astype(np.int64) for u in raws])
                yield pa.RecordBatch.from_arrays([batch.column("u"), pa.array(s)], ["u", "s"])

        hard += [np.frombuffer(r["u"], np.uint8).astype(np.int64) for r in
                 others.select("u").mapInArrow(high, "u binary, s double")
                 .orderBy(F.desc("s"), "u").limit(1500).select("u").collect()]

    def text_rows(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = model.texts(words_of(part.column("text"), lower=True))
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(x[:, 0]), pa.array(x[:, 1])], ["y", "s1", "s2"])

    got = sample.mapInArrow(text_rows, "y int, s1 double, s2 double").toPandas()    # at most ``rows`` rows
    got = got.sort_values(["y", "s1", "s2"])
    last = logistic(got[["s1", "s2"]].to_numpy(), got["y"].to_numpy().astype(float))
    return Model(weight, bias, last)


def op6(spark, sf_dir: str) -> DataFrame:
    """Null doc_ids are not held out; null and empty texts have the score of a text
    without words; repeated rows have equal results; no rows give none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s = sent.value.score(words_of(part.column("text"), lower=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
