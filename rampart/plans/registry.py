"""Key -> plan registry used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key`` with optional oracle SQL."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco
