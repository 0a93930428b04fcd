"""Stages of the corpus pipeline.

Each takes (spark, docs, sf_dir) and gives what it keeps: all columns of documents,
but for the last, which gives the pieces of packed sequences.  Near-duplicate and
repeat stages work on the documents that their predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.llm import decontam, near_dup, packing, quality, store, substring, tokens
from rampart.operators.ordering import positions

LEAST_QUALITY = 0.3


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more.  It is fitted on
    labelled rows of ``docs``; without any, every document stays.

    Null and empty texts are scored like others.  Repeated rows get equal scores and
    stay or go together; a score of exactly 0.3 stays.  An empty table stays empty.
    All columns come through whatever their names.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model.w2.any():
        return docs
    return quality.filtered(docs, model, LEAST_QUALITY)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8):
    the one with the smallest id.

    Rows with a null id stay, and so do documents without words.  Rows that repeat an
    id and its text become one (the smallest of their other columns); rows of one id
    with unlike texts are documents of their own, of which a near-duplicate of
    another goes.  An empty table stays empty.  All columns come through.
    """
    known = docs.where("doc_id is not null")
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        groups = near_dup.near_duplicates(docs.select("doc_id", "text"), shingle=5)
        gone = store.write(groups.where("not kept").select("doc_id").distinct(), "gone")
        return docs.join(gone, "doc_id", "left_anti")
    # ids repeat: number the distinct (id, text) rows in order of id and compare by number
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    digest = F.sha2(F.col("text"), 256).alias("__digest")
    rows = known.select("doc_id", digest, F.struct("text", *names).alias("__row"))
    rows = store.write(rows.groupBy("doc_id", "__digest").agg(F.min("__row").alias("__row")), "rows")
    number = store.write(positions(rows.select("doc_id", "__digest"), [], [
        "doc_id", F.col("__digest").asc_nulls_first()], "__no"), "numbers")
    n = number.select(F.col("doc_id").alias("__id"), F.col("__digest").alias("__d"), "__no")
    rows = rows.join(n, (F.col("doc_id") == F.col("__id")) & F.col("__digest").eqNullSafe(F.col("__d")))
    groups = near_dup.near_duplicates(rows.select(F.col("__no").alias("doc_id"), F.col("__row.text").alias("text")), shingle=5)
    gone = store.write(groups.where("not kept").select(F.col("doc_id").alias("__no")).distinct(), "gone")
    left = rows.join(gone, "__no", "left_anti").select("doc_id", "__row.*").select(docs.columns)
    return docs.where("doc_id is null").unionByName(left)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that 50-word windows of smaller documents cover:
    such texts become their kept words, n_chars follows; texts that lose nothing stay
    as they are.  Documents with nothing left go.

    A null or empty text, and a row with a null id, lose nothing and stay.  Rows of
    one id never take words from each other, and equal rows lose the same.  An empty
    table stays empty.  All columns come through.
    """
    return substring.without_repeats(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none; equal rows stay or go together; rows with a null
    id are judged like others.  Without documents or items nothing goes.  All columns
    come through.
    """
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens.

    Every row is packed, also one with a null id or text (which has the end id alone)
    and a repeated one; an empty table gives no pieces.  The columns are the pieces'.
    """
    return packing.pack(docs, tokens.tokenizer_path())


STAGES = [(name, store.shipped(stage)) for name, stage in [
    ("quality", good),
    ("near_dup", distinct),
    ("substring", unrepeated),
    ("decontamination", unleaked),
    ("packing", packed),
]]
