"""What the two classifiers share: the bounded training sample, folds and the
logistic last step."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store
from rampart.llm.near_dup import near_duplicates

SAMPLE_ROWS = 20_000


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, target: str, folds: int, held: int,
                  rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents outside fold ``held``: those
    whose hashed id is smallest.  Ids without a label, or with two different ones,
    are left out.  An id that repeats gives one row, with the text of smallest digest.
    At most ``rows`` ids and labels are sent to the scan of ``docs``."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
           .where(fold("doc_id", folds) != held)
           .groupBy("doc_id").agg(F.min(target).alias("y"), F.max(target).alias("y2")).where("y = y2")
           .select("doc_id", "y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    found = docs.select("doc_id", "text").join(F.broadcast(one), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.sha2("text", 256)).alias("text"),
                                       F.first("y").alias("y")).select("text", "y")


def one_of_copies(sample: DataFrame, run: int = 4, percent: int = 80) -> DataFrame:
    """One row of each group of copies and near copies in a bounded sample (text, y):
    what many copies of one text share says nothing about its label.  Rows are linked
    as ``near_dup`` links documents, on confirmed similarity of their whole sets of
    words, never on a part that they share; of each group the first row of either label
    stays.  Texts of fewer than ``run`` words are groups of their own."""
    kept = store.write(sample.withColumn("rid", F.monotonically_increasing_id()), "sample")
    long = kept.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= run)
    groups = near_duplicates(long.select("rid", "text"), "rid", shingle=1, percent=percent).select("rid", "component_id")
    groups = kept.select("rid", "y").join(groups, "rid", "left")
    chosen = store.write(groups.groupBy(F.coalesce("component_id", "rid").alias("component_id"), "y")
                         .agg(F.min("rid").alias("rid")).select("rid"), "chosen")
    return kept.join(chosen, "rid").drop("rid")


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) / len(y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w
