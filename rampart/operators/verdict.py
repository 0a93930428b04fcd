"""The verdict contract shared by every policy.

A policy returns two DataFrames: a one-row verdict
``(policy, status, checked_rows, n_violations, message)`` with status in
pass / violation / error, and a table of violating rows.  Only a violation
steers; an error means the rule could not be evaluated.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASS, VIOLATION, ERROR = "pass", "violation", "error"

VERDICT_SCHEMA = T.StructType([
    T.StructField("policy", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("checked_rows", T.LongType()),
    T.StructField("n_violations", T.LongType()),
    T.StructField("message", T.StringType()),
])
VERDICT_COLS = [f.name for f in VERDICT_SCHEMA.fields]


class PolicyResult(NamedTuple):
    verdict: DataFrame
    violations: DataFrame


def error_verdict(spark: SparkSession, policy: str, message: str,
                  checked_rows: int = 0) -> DataFrame:
    """Verdict for a check that cannot run (missing table/column): no data job."""
    return spark.createDataFrame([(policy, ERROR, checked_rows, 0, message)], VERDICT_SCHEMA)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def status_expr(*branches: tuple[Column, str], default: str = PASS) -> Column:
    """Ordered rule list -> status; the first true condition wins."""
    out = F.lit(default)
    for cond, status in reversed(branches):
        out = F.when(cond, F.lit(status)).otherwise(out)
    return out


def verdict_select(policy: str, status: Column, checked: Column, bad: Column,
                   message: Column) -> list[Column]:
    return [
        F.lit(policy).alias("policy"),
        status.alias("status"),
        checked.cast("bigint").alias("checked_rows"),
        bad.cast("bigint").alias("n_violations"),
        message.alias("message"),
    ]
