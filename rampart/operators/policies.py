"""Row-level policies: derived amount (P1), value domain (P2), type
preservation (P3) and a range invariant (P10).

Each returns a :class:`PolicyResult`.  Metadata checks (missing column,
missing table) are answered from the schema on the driver; every data check
is a single aggregate (partial aggregation on the map side, so a hot key or
value never lands whole in one task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.functions.rounding import round_binary
from rampart.functions.tolerance import DEFAULT_TOL, exceeds_abs_tol
from rampart.functions.types import base_type_name, category, drifted_to_string
from rampart.operators.verdict import (ERROR, PASS, VIOLATION, PolicyResult, empty_like,
                                       error_verdict, status_expr, verdict_select)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# The declared domain of the charge-history type column, in declared order.
CHARGE_LINE_TYPES = ("charge line", "discount", "shipping", "tax", "refund")
# Known near-miss spellings -> the declared value they stand for.
CHARGE_LINE_CONFUSIONS = {
    "charge_line": "charge line",
    "chargeline": "charge line",
    "charge-line": "charge line",
    "line_item": "charge line",
    "line item": "charge line",
    "lineitem": "charge line",
    "charge_line_item": "charge line",
    "product": "charge line",
    "refunds": "refund",
    "taxes": "tax",
    "discounts": "discount",
}
# ---------------------------------------------------------------------------


def _col(df: DataFrame, name: str) -> Column:
    return df[name]


def _key_condition(left: DataFrame, right: DataFrame,
                   pairs: Sequence[tuple[str, str]], la: str, ra: str) -> Column:
    """Equi-join condition on alias-qualified names; both sides go through a
    string cast only when their types differ (ids compared as text)."""
    cond = None
    ltypes, rtypes = dict(left.dtypes), dict(right.dtypes)
    for lk, rk in pairs:
        lc, rc = F.col(f"{la}.{lk}"), F.col(f"{ra}.{rk}")
        if ltypes[lk] != rtypes[rk]:
            lc, rc = lc.cast("string"), rc.cast("string")
        c = lc == rc
        cond = c if cond is None else cond & c
    return cond


def expected_amount(kind: Column, value: Column, base: Column,
                    percentage_kind: str = "percentage", scale: int = 2,
                    rounding: str = "decimal") -> Column:
    """round(value/100 * base, scale) for percentage rows, else the raw value.

    ``rounding="decimal"`` computes in exact decimal arithmetic (half up), so that
    every engine lands on the same cent.  ``"binary"`` is the reference's way: the
    product of doubles, rounded by its exact value with ties to even
    (:func:`round_binary`).  The two differ by one unit near a tie.
    """
    if rounding == "binary":
        pct = round_binary(value.cast("double") / F.lit(100.0) * base.cast("double"), scale)
    elif rounding == "decimal":
        pct = F.round(value.cast("decimal(18,6)") * base.cast("decimal(18,6)")
                      * F.lit(0.01).cast("decimal(3,2)"), scale).cast("double")
    else:
        raise ValueError(f"rounding must be 'decimal' or 'binary', not {rounding!r}")
    return F.when(F.lower(kind) == F.lit(percentage_kind), pct).otherwise(value.cast("double"))


def derived_amount_rows(target: DataFrame, source: DataFrame, base: DataFrame, *,
                        target_source_keys: Sequence[tuple[str, str]],
                        source_base_keys: Sequence[tuple[str, str]],
                        kind_col: str, value_col: str, found_col: str, base_col: str,
                        target_filter: Column | str | None = None,
                        carry: Sequence[str] = (),
                        percentage_kind: str = "percentage", scale: int = 2,
                        tol: float = DEFAULT_TOL, rounding: str = "decimal") -> DataFrame:
    """The joined rows P1 evaluates, one per (target row x matching source row).

    Inner join target->source, left join source->base (a missing base gives a
    null expected amount, which the verdict turns into an error).
    """
    t = target if target_filter is None else target.where(target_filter)
    j = t.alias("t").join(source.alias("s"),
                          _key_condition(t, source, target_source_keys, "t", "s"), "inner")
    j = j.join(base.alias("b"), _key_condition(source, base, source_base_keys, "s", "b"), "left")
    kind = F.lower(F.col(f"s.{kind_col}"))
    value = F.col(f"s.{value_col}").cast("double")
    base_amt = F.col(f"b.{base_col}").cast("double")
    found = F.col(f"t.{found_col}").cast("double")
    exp = expected_amount(kind, value, base_amt, percentage_kind, scale, rounding)
    return j.select(
        *[F.col(f"t.{c}").alias(c) for c in carry],
        kind.alias("value_type"),
        found.alias("amount_found"),
        value.alias("raw_value"),
        base_amt.alias("base_amount"),
        exp.alias("amount_expected"),
        (found.isNull() | exp.isNull()).alias("is_null"),
        exceeds_abs_tol(found, exp, tol).alias("is_violation"),
    )


def key_fanout(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P1 join hazard: a key that is not unique multiplies the rows P1
    checks.  One row: distinct keys, keys seen more than once, and the extra
    rows those repeats add to a join.  A grouped count combines map-side, so
    a hot key is pre-aggregated before the shuffle."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.count(F.lit(1)).alias("distinct_keys"),
                   F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
                   F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
                    .cast("bigint").alias("extra_rows"))


def derived_amount_check(target: DataFrame | None, source: DataFrame | None,
                         base: DataFrame | None, *, policy: str = "derived_amount",
                         **kw) -> PolicyResult:
    """Every target row must carry the amount derived from its source."""
    spark = next(d for d in (target, source, base) if d is not None).sparkSession \
        if any(d is not None for d in (target, source, base)) else None
    if target is None:
        return PolicyResult(error_verdict(spark, policy, "target table not materialized"),
                            empty_like(spark, T.StructType([])))
    for name, d in (("source", source), ("base", base)):
        if d is None:
            return PolicyResult(error_verdict(spark, policy,
                                              f"{name} table missing from produced data"),
                                empty_like(spark, T.StructType([])))
    rows = derived_amount_rows(target, source, base, **kw)
    agg = rows.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(F.col("is_violation")).alias("bad"),
        F.count_if(F.col("is_null")).alias("nulls"),
    )
    checked, bad, nulls = F.col("checked"), F.col("bad"), F.col("nulls")
    status = status_expr((checked == 0, ERROR), (nulls > 0, ERROR), (bad > 0, VIOLATION))
    message = (F.when(checked == 0, F.lit("no rows found to check (join produced 0 rows)"))
               .when(nulls > 0, F.format_string("%d/%d rows have a null amount or base",
                                                nulls, checked))
               .when(bad > 0, F.format_string("%d/%d rows violate the amount invariant",
                                              bad, checked))
               .otherwise(F.format_string("all %d rows satisfy the amount invariant",
                                          checked)))
    verdict = agg.select(*verdict_select(policy, status, checked, bad, message))
    violations = rows.where("is_violation").drop("is_violation", "is_null")
    return PolicyResult(verdict, violations)


def suggestion_expr(value: Column, domain: Sequence[str],
                    confusions: Mapping[str, str]) -> Column:
    """Near-miss suggestion: trimmed lower-case lookup in the confusion table,
    else the underscore->space spelling when that is a declared value."""
    key = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    if confusions:
        pairs = [F.lit(x) for kv in confusions.items() for x in kv]
        mapped = F.create_map(*pairs)[key]
    else:
        mapped = F.lit(None).cast("string")
    spaced = F.regexp_replace(key, "_", " ")
    in_domain = F.array_contains(F.array(*[F.lit(d) for d in domain]), spaced)
    return F.coalesce(mapped, F.when(in_domain, spaced))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, the value as text; null is its own group."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("row_count"))


def value_domain_check(df: DataFrame | None, column: str, domain: Sequence[str], *,
                       confusions: Mapping[str, str] | None = None,
                       policy: str = "value_domain") -> PolicyResult:
    """Every value (null included) must be a declared value.

    Membership only, never coverage.  The domain is a driver-side literal list
    (its size is known), matched as an array literal inside the aggregate's
    projection: no join at all.
    """
    confusions = dict(confusions or {})
    if df is None:
        raise ValueError("value_domain_check needs a table")
    spark = df.sparkSession
    vschema = T.StructType([T.StructField("value", T.StringType()),
                            T.StructField("row_count", T.LongType()),
                            T.StructField("suggestion", T.StringType())])
    if column.lower() not in {c.lower() for c in df.columns}:
        return PolicyResult(error_verdict(spark, policy, f"table has no column {column!r}"),
                            empty_like(spark, vschema))
    counts = value_counts(df, column)
    dom = F.array(*[F.lit(d) for d in domain])
    outside = F.col("value").isNull() | ~F.array_contains(dom, F.col("value"))
    violations = counts.where(outside).select(
        "value", "row_count",
        suggestion_expr(F.col("value"), domain, confusions).alias("suggestion"))
    agg = counts.agg(F.sum("row_count").alias("total"),
                     F.sum(F.when(outside, F.col("row_count")).otherwise(0)).alias("bad_rows"),
                     F.count_if(outside).alias("bad_values"))
    total = F.coalesce(F.col("total"), F.lit(0))
    bad = F.col("bad_rows")
    status = status_expr((total == 0, ERROR), (bad > 0, VIOLATION))
    message = (F.when(total == 0, F.lit(f"table is empty; no {column} values to check"))
               .when(bad > 0, F.format_string(
                   f"%d/%d rows carry a {column} outside the declared domain", bad, total))
               .otherwise(F.format_string(
                   f"all %d rows carry a {column} inside the declared domain", total)))
    verdict = agg.select(*verdict_select(policy, status, total, F.col("bad_values"), message))
    return PolicyResult(verdict, violations)


def type_preservation_check(target: DataFrame, source: DataFrame,
                            column_map: Mapping[str, str], *,
                            policy: str = "type_preservation") -> PolicyResult:
    """A column derived from a numeric source must not turn into text.

    Schema-only: builds a tiny DataFrame (one row per mapped column) on the
    driver; the data is never scanned.
    """
    spark = target.sparkSession
    tfields = {f.name.lower(): f.dataType for f in target.schema.fields}
    sfields = {f.name.lower(): f.dataType for f in source.schema.fields}
    rows, checked = [], 0
    for tcol, scol in column_map.items():
        if tcol.lower() not in tfields:
            return PolicyResult(error_verdict(spark, policy, f"target has no column {tcol!r}",
                                              checked), _type_rows(spark, []))
        if scol.lower() not in sfields:
            return PolicyResult(error_verdict(spark, policy,
                                              f"source has no column {scol!r}", checked),
                                _type_rows(spark, []))
        found, expected = tfields[tcol.lower()], sfields[scol.lower()]
        checked += 1
        rows.append((tcol, base_type_name(found), base_type_name(expected), category(found),
                     category(expected), scol,
                     VIOLATION if drifted_to_string(expected, found) else PASS))
    table = _type_rows(spark, rows)
    bad = sum(1 for r in rows if r[-1] == VIOLATION)
    if bad:
        names = ", ".join(f"{r[0]}={r[1]}" for r in rows if r[-1] == VIOLATION)
        msg = f"{bad}/{checked} id columns violate the type invariant ({names})"
        status = VIOLATION
    else:
        msg, status = f"all {checked} id columns satisfy the type invariant", PASS
    from rampart.operators.verdict import VERDICT_SCHEMA
    verdict = spark.createDataFrame([(policy, status, checked, bad, msg)], VERDICT_SCHEMA)
    return PolicyResult(verdict, table.where(F.col("status") == VIOLATION))


def _type_rows(spark, rows):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (
        "column", "found_type", "expected_type", "found_category", "expected_category",
        "source_column", "status")])
    return spark.createDataFrame(rows, schema)


def type_report(target: DataFrame, source: DataFrame, column_map: Mapping[str, str]) -> DataFrame:
    """All mapped columns with their categories and status (from the schemas), and from
    one scan of the target: ``n_values`` non-null values, and ``n_lost``, how many of a
    drifted column's values do not cast back to the source's type."""
    spark = target.sparkSession
    tfields = {f.name.lower(): f.dataType for f in target.schema.fields}
    sfields = {f.name.lower(): f.dataType for f in source.schema.fields}
    rows, sums = [], []
    for tcol, scol in column_map.items():
        if tcol.lower() in tfields and scol.lower() in sfields:
            found, expected = tfields[tcol.lower()], sfields[scol.lower()]
            drifted = drifted_to_string(expected, found)
            rows.append((tcol, base_type_name(found), base_type_name(expected),
                         category(found), category(expected), scol,
                         VIOLATION if drifted else PASS))
            c = F.col(tcol)
            lost = F.count_if(c.isNotNull() & c.try_cast(expected).isNull()) if drifted \
                else F.lit(0).cast("bigint")
            sums.append(F.struct(F.lit(tcol).alias("column"), F.count(c).alias("n_values"),
                                 lost.alias("n_lost")))
    table = _type_rows(spark, rows)
    if not rows:
        return table.withColumn("n_values", F.lit(0).cast("bigint")).withColumn("n_lost", F.lit(0).cast("bigint"))
    scanned = target.agg(F.array(*sums).alias("x")).select(F.inline("x"))
    return table.join(scanned, "column")


def range_check(df: DataFrame, column: str, *, lower: float | None = 0.0,
                upper: float | None = None, policy: str = "range") -> PolicyResult:
    """P10: every non-null value within [lower, upper]; one aggregate."""
    spark = df.sparkSession
    if column not in df.columns:
        return PolicyResult(error_verdict(spark, policy, f"table has no column {column!r}"),
                            empty_like(spark, df.schema))
    c = F.col(column)
    out = F.lit(False)
    if lower is not None:
        out = out | (c < F.lit(lower))
    if upper is not None:
        out = out | (c > F.lit(upper))
    agg = df.agg(F.count(c).alias("checked"), F.count_if(out).alias("bad"))
    checked, bad = F.col("checked"), F.col("bad")
    status = status_expr((checked == 0, ERROR), (bad > 0, VIOLATION))
    message = (F.when(checked == 0, F.lit(f"no {column} values to check"))
               .when(bad > 0, F.format_string(f"%d/%d rows have {column} out of range",
                                              bad, checked))
               .otherwise(F.format_string(f"all %d rows have {column} in range", checked)))
    verdict = agg.select(*verdict_select(policy, status, checked, bad, message))
    return PolicyResult(verdict, df.where(out))
