"""Record sinks (A11, A12): verdicts, trial rows, summaries and exported
trajectories written as partitioned JSON or Parquet.

Writes are plain DataFrame writers (no driver collection); a partition
column such as the task keeps one folder per task like the reference's
per-task report files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_records(df: DataFrame, path: str, *, fmt: str = "json",
                  partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def read_records(spark: SparkSession, path: str, *, fmt: str = "json",
                 schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path) if fmt == "json" else r.parquet(path)


def write_json_documents(df: DataFrame, path: str, text_col: str = "json",
                         mode: str = "overwrite") -> None:
    """One JSON document per line (e.g. exported trajectories), as text."""
    df.select(text_col).write.mode(mode).text(path)
