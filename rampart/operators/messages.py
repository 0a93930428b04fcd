"""Retry text per policy (P9): what is sent back on a violation, as rows.

One row per offender: ``(policy, subject, position, text)``.  Every offending row,
value, name and column is named; ``position`` orders a policy's rows, and is given
by :func:`rampart.operators.ordering.positions`, so no policy's offenders meet in
one task or one string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.operators.ordering import positions
from rampart.session import store


def _quote(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), c, F.lit("'")))


def domain_retry_rows(violations: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """P2, one row per value outside the domain: its row count, the replacement when
    one is known, and the declared domain."""
    dom = ", ".join(f"'{d}'" for d in domain)
    return violations.select(_quote(F.col("value")).alias("subject"), F.concat(
        F.lit(f"`{column}` holds "), _quote(F.col("value")), F.lit(" in "), F.col("row_count").cast("string"),
        F.lit(" rows; "),
        F.when(F.col("suggestion").isNotNull(), F.concat(F.lit("it must be "), _quote(F.col("suggestion"))))
         .otherwise(F.lit("it is not a declared value")),
        F.lit(f". The declared domain is exactly: {dom}.")).alias("text"))


def amount_retry_rows(violations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P1, one row per violating row, named by the ``keys`` that the check carried."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    def money(c):
        return F.coalesce(F.col(c).cast("decimal(38,2)").cast("string"), F.lit("None"))
    subject = F.concat_ws("/", *[shown(k) for k in keys])
    return violations.select(subject.alias("subject"), F.concat(
        subject, F.lit(" ("), F.col("value_type"), F.lit("): amount is "), money("amount_found"),
        F.lit(" but must be "), money("amount_expected"), F.lit(" from value "), money("raw_value"),
        F.lit(" and base "), money("base_amount")).alias("text"))


def type_retry_rows(report: DataFrame) -> DataFrame:
    """P3, one row per column that drifted to text."""
    return report.where(F.col("status") == "violation").select(F.col("column").alias("subject"), F.concat(
        F.lit("`"), F.col("column"), F.lit("` is "), F.col("found_category"), F.lit(" but its source `"),
        F.col("source_column"), F.lit("` is "), F.col("expected_category"),
        F.lit("; keep the source type")).alias("text"))


def name_gate_retry_rows(flags: DataFrame) -> DataFrame:
    """P4, for projects with offenders and no built candidate: one row per invented
    name and one per declared model still unbuilt."""
    bad = flags.groupBy("project").agg(F.bool_or("offender").alias("_off"),
                                       F.bool_or("built_candidate").alias("_built")) \
        .where("_off and not _built").select("project")
    subject = F.concat("project", F.lit("/"), "name")
    return flags.where("offender or unmet").join(bad, "project").select(subject.alias("subject"), F.when(
        F.col("offender"), F.concat(F.lit("built under the undeclared name "), F.col("name"),
                                    F.lit("; rebuild under a declared name, do not add new names to the schema")))
        .otherwise(F.concat(F.lit("the declared model "), F.col("name"), F.lit(" is still unbuilt"))).alias("text"))


def retry_rows(policies: dict[str, DataFrame]) -> DataFrame:
    """(policy, subject, position, text) of several policies' (subject, text) rows,
    positions by subject and text within each policy.  The rows are written first: sizes,
    range bounds and places are all read from them, and the checks run once."""
    out = None
    for name, rows in policies.items():
        part = rows.select(F.lit(name).alias("policy"), "subject", "text")
        out = part if out is None else out.unionByName(part)
    return positions(store(out, "retry-rows"), ["policy"], ["subject", "text"], name="position") \
        .select("policy", "subject", "position", "text").orderBy("policy", "position")
