"""Intermediate tables in the folder that the cluster shares.

``write(df, name)`` writes Parquet under ``spark.checkpoint.dir`` and reads it
back: lineage ends there, and a lost executor costs only its running tasks.
"""

from __future__ import annotations

import functools
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from rampart.session import ensure_checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, also
    when the driver put that folder on ``sys.path`` itself."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shipped(plan):
    """A plan (spark, ...) -> DataFrame that ships the package first."""
    @functools.wraps(plan)
    def run(spark, *args):
        ship(spark)
        return plan(spark, *args)
    return run
