"""Declared domains: extraction from spec text (H8) and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domain_from_spec(text: Column, column: str) -> Column:
    """Single-quoted values in the block that declares ``- name: <column>``,
    cut at the next ``- name:`` entry; null when the block is absent or has
    no quoted value."""
    import re
    col = re.escape(column)
    block = F.regexp_extract(text, r"(?s)-\s*name:\s*" + col + r"\b(.*?)(\n\s*-\s*name:\s|$)", 1)
    found = F.regexp_extract(text, r"-\s*name:\s*" + col + r"\b", 0) != ""
    vals = F.regexp_extract_all(block, F.lit(r"'([^']+)'"), 1)
    return F.when(found & (F.size(vals) > 0), vals)


def domain_drift(spec: DataFrame, projects: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Per project: is the spec's value set equal to the declared one?

    ``spec`` holds (project, value) rows, ``projects`` every project.  The
    declared literal list is crossed with the distinct project keys (its size
    is a driver-side constant), both sides are tagged and folded with one
    grouped aggregate; order and duplicates do not matter.
    """
    dec = F.explode(F.array(*[F.lit(v) for v in declared]))
    s = spec.select("project", "value", F.lit(True).alias("in_spec"),
                    F.lit(False).alias("in_declared"))
    d = projects.select("project").distinct().select(
        "project", dec.alias("value"), F.lit(False).alias("in_spec"),
        F.lit(True).alias("in_declared"))
    flags = s.unionByName(d).groupBy("project", "value").agg(
        F.bool_or("in_spec").alias("s"), F.bool_or("in_declared").alias("d"))
    return flags.groupBy("project").agg(
        F.count_if("s").alias("n_spec"),
        F.count_if(F.col("d") & ~F.col("s")).alias("n_missing"),
        F.count_if(F.col("s") & ~F.col("d")).alias("n_extra"),
        (F.count_if(F.col("s") != F.col("d")) == 0).alias("equal"))
