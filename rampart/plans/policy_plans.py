"""Policy plans on the driver's tables.

Stand-ins: a discount line is a ``lineitem`` row reduced to one row per
(orderkey, linenumber); its base is ``orders.o_totalprice``; the produced
table carries the derived amount with a seeded fault on every 50th order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import policies as P
from rampart.operators.verdict import VERDICT_COLS
from rampart.plans.registry import query
from rampart.sources.tables import load_tables

# ---------------------------------------------------------------------------
# Shared stand-in inputs
# ---------------------------------------------------------------------------


def discount_inputs(t):
    """(target, source, base) for the derived-amount policy."""
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_discount").alias("l_discount"))
    source = lines.select(
        F.col("l_orderkey").alias("charge_id"),
        F.col("l_linenumber").alias("line_no"),
        F.when(F.col("l_linenumber") == 7, F.lit("fixed_amount"))
         .otherwise(F.lit("percentage")).alias("value_type"),
        F.round(F.col("l_discount") * 100, 2).alias("value"))
    base = t.orders.select(F.col("o_orderkey").alias("charge_id"),
                           F.col("o_totalprice").alias("total_price"))
    s, b = source.alias("s"), base.alias("b")
    expected = P.expected_amount(F.col("s.value_type"), F.col("s.value"),
                                 F.col("b.total_price"))
    target = (s.join(b, F.col("s.charge_id") == F.col("b.charge_id"), "left")
              .select(F.col("s.charge_id").cast("string").alias("charge_id"),
                      F.col("s.line_no").alias("line_no"),
                      F.lit("discount").alias("line_item_type"),
                      F.when(F.pmod(F.col("s.charge_id"), F.lit(50)) == 0, F.col("s.value"))
                       .otherwise(expected).alias("amount")))
    return target, source, base


def discount_kw() -> dict:
    return dict(
    target_source_keys=[("charge_id", "charge_id"), ("line_no", "line_no")],
    source_base_keys=[("charge_id", "charge_id")],
    kind_col="value_type", value_col="value", found_col="amount", base_col="total_price",
    target_filter=F.col("line_item_type") == "discount",
    )

DISCOUNT_CTE = """
lines AS (
  SELECT l_orderkey, l_linenumber, min(l_discount) AS l_discount
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
src AS (
  SELECT l_orderkey AS charge_id, l_linenumber AS line_no,
         CASE WHEN l_linenumber = 7 THEN 'fixed_amount' ELSE 'percentage' END AS value_type,
         round(l_discount * 100, 2) AS value
  FROM lines),
base AS (SELECT o_orderkey AS charge_id, o_totalprice AS total_price FROM orders),
target AS (
  SELECT CAST(s.charge_id AS VARCHAR) AS charge_id, s.line_no, 'discount' AS line_item_type,
         CASE WHEN s.charge_id % 50 = 0 THEN s.value
              WHEN lower(s.value_type) = 'percentage' THEN CAST(round(
                   CAST(s.value AS DECIMAL(38,6)) * CAST(b.total_price AS DECIMAL(38,6))
                   * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE)
              ELSE CAST(s.value AS DOUBLE) END AS amount
  FROM src s LEFT JOIN base b ON s.charge_id = b.charge_id),
checked AS (
  SELECT t.charge_id, t.line_no, s.value AS raw_value, CAST(b.total_price AS DOUBLE) AS base_amount,
         lower(s.value_type) AS value_type, CAST(t.amount AS DOUBLE) AS amount_found,
         CASE WHEN lower(s.value_type) = 'percentage' THEN CAST(round(
                   CAST(s.value AS DECIMAL(38,6)) * CAST(b.total_price AS DECIMAL(38,6))
                   * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE)
              ELSE CAST(s.value AS DOUBLE) END AS amount_expected
  FROM target t
  JOIN src s ON t.charge_id = CAST(s.charge_id AS VARCHAR) AND t.line_no = s.line_no
  LEFT JOIN base b ON s.charge_id = b.charge_id
  WHERE t.line_item_type = 'discount'),
flagged AS (
  SELECT *, (amount_found IS NULL OR amount_expected IS NULL) AS is_null,
         CASE WHEN isnan(amount_found) OR isnan(amount_expected) THEN false
              ELSE abs(amount_found - amount_expected) > 0.01 END AS is_violation
  FROM checked)
"""


DISCOUNT_SUMMARY = """
SELECT value_type,
       count(*) AS checked_rows,
       count(*) FILTER (WHERE is_violation) AS violations,
       count(*) FILTER (WHERE is_null) AS null_rows,
       round(coalesce(sum(CASE WHEN is_violation
                               THEN abs(amount_found - amount_expected) END), 0), 2) AS abs_error
FROM flagged GROUP BY value_type
"""


def discount_summary(spark, sf_dir, **kw) -> DataFrame:
    t = load_tables(spark, sf_dir)
    target, source, base = discount_inputs(t)
    rows = P.derived_amount_rows(target, source, base, **discount_kw(), **kw)
    return rows.groupBy("value_type").agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if("is_violation").alias("violations"),
        F.count_if("is_null").alias("null_rows"),
        F.round(F.coalesce(F.sum(F.when(F.col("is_violation"), F.abs(
            F.col("amount_found") - F.col("amount_expected")))), F.lit(0.0)), 2)
         .alias("abs_error")).orderBy(F.col("value_type").asc_nulls_first())


@query("discount_check", sql="WITH " + DISCOUNT_CTE + DISCOUNT_SUMMARY)
def discount_check(spark, sf_dir) -> DataFrame:
    return discount_summary(spark, sf_dir)


# The double's exact value in 2^-60ths is a whole number; 2 places by whole-number division
_SIXTY = 1 << 60
_BINARY_SQL = DISCOUNT_CTE.replace("flagged AS (", f"""exact AS (
  SELECT * REPLACE (CASE WHEN value_type = 'percentage' THEN (
      (n * 100) // {_SIXTY} + CASE WHEN 2 * ((n * 100) % {_SIXTY}) > {_SIXTY} THEN 1
                                   WHEN 2 * ((n * 100) % {_SIXTY}) = {_SIXTY} THEN ((n * 100) // {_SIXTY}) % 2
                                   ELSE 0 END)::DOUBLE / 100 ELSE amount_expected END AS amount_expected)
  FROM (SELECT *, CAST(raw_value / 100.0::DOUBLE * base_amount * {_SIXTY}::DOUBLE AS HUGEINT) AS n FROM checked) c),
flagged AS (""").replace("FROM checked)\n", "FROM exact)\n")


@query("discount_check_binary", sql="WITH " + _BINARY_SQL + DISCOUNT_SUMMARY)
def discount_check_binary(spark, sf_dir) -> DataFrame:
    """P1 with the reference's rounding (H19): amounts made by decimal rounding differ
    by a cent near ties, which a tolerance of a cent just lets or does not let through."""
    return discount_summary(spark, sf_dir, rounding="binary")


@query("discount_key_fanout", sql="""
SELECT side, count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
       CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS extra_rows
FROM (SELECT 'source' AS side, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
      UNION ALL
      SELECT 'base', count(*) FROM orders GROUP BY o_orderkey)
GROUP BY side
""")
def discount_key_fanout(spark, sf_dir) -> DataFrame:
    """SURVEY §7.6 hazard 6: P1's join keys on the raw inputs (lineitem's
    (orderkey, linenumber) repeats in the driver's data)."""
    t = load_tables(spark, sf_dir)
    src = P.key_fanout(t.lineitem, ["l_orderkey", "l_linenumber"]).select(
        F.lit("source").alias("side"), "*")
    base = P.key_fanout(t.orders, ["o_orderkey"]).select(F.lit("base").alias("side"), "*")
    return src.unionByName(base)


def discount_verdict(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    target, source, base = discount_inputs(t)
    return P.derived_amount_check(target, source, base, policy="discount", **discount_kw()).verdict


DISCOUNT_VERDICT_SQL = """
SELECT 'discount' AS policy,
       CASE WHEN count(*) = 0 THEN 'error'
            WHEN count(*) FILTER (WHERE is_null) > 0 THEN 'error'
            WHEN count(*) FILTER (WHERE is_violation) > 0 THEN 'violation'
            ELSE 'pass' END AS status,
       count(*) AS checked_rows,
       count(*) FILTER (WHERE is_violation) AS n_violations,
       CASE WHEN count(*) = 0 THEN 'no rows found to check (join produced 0 rows)'
            WHEN count(*) FILTER (WHERE is_null) > 0 THEN printf(
              '%d/%d rows have a null amount or base', count(*) FILTER (WHERE is_null), count(*))
            WHEN count(*) FILTER (WHERE is_violation) > 0 THEN printf(
              '%d/%d rows violate the amount invariant',
              count(*) FILTER (WHERE is_violation), count(*))
            ELSE printf('all %d rows satisfy the amount invariant', count(*)) END AS message
FROM flagged
"""

# ---------------------------------------------------------------------------
# Value domain on orders.o_orderpriority
# ---------------------------------------------------------------------------
# Declared domain for the stand-in: omits '4-NOT SPECIFIED' on purpose.
PRIORITY_DOMAIN = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
PRIORITY_CONFUSIONS = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM",
                       "low": "5-LOW"}


def priority_table(t) -> DataFrame:
    """orders priorities with seeded nulls and padded lower-case near misses."""
    k = F.col("o_orderkey")
    return t.orders.select(
        F.when(F.pmod(k, F.lit(97)) == 0, F.lit(None).cast("string"))
         .when(F.pmod(k, F.lit(89)) == 0,
               F.concat(F.lit(" "), F.lower(F.split(F.col("o_orderpriority"), "-")[1]),
                        F.lit(" ")))
         .otherwise(F.col("o_orderpriority")).alias("priority"))


PRIORITY_CTE = """
prio AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 89 = 0 THEN ' ' || lower(split_part(o_orderpriority, '-', 2)) || ' '
              ELSE o_orderpriority END AS priority
  FROM orders),
counts AS (SELECT CAST(priority AS VARCHAR) AS value, count(*) AS row_count FROM prio GROUP BY 1),
keyed AS (SELECT *, lower(trim(coalesce(value, ''))) AS k,
                 (value IS NULL OR value NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) AS outside
          FROM counts)
"""


@query("enum_domain_check", sql="WITH " + PRIORITY_CTE + """
SELECT value, row_count,
       CASE k WHEN 'urgent' THEN '1-URGENT' WHEN 'high' THEN '2-HIGH'
              WHEN 'medium' THEN '3-MEDIUM' WHEN 'low' THEN '5-LOW'
              ELSE CASE WHEN replace(k, '_', ' ') IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
                        THEN replace(k, '_', ' ') END END AS suggestion
FROM keyed WHERE outside
""")
def enum_domain_check(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    res = P.value_domain_check(priority_table(t), "priority", PRIORITY_DOMAIN,
                               confusions=PRIORITY_CONFUSIONS, policy="enum")
    return res.violations.orderBy(F.col("value").asc_nulls_first())


def enum_verdict(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return P.value_domain_check(priority_table(t), "priority", PRIORITY_DOMAIN,
                                confusions=PRIORITY_CONFUSIONS, policy="enum").verdict


ENUM_VERDICT_SQL = """
SELECT 'enum' AS policy,
       CASE WHEN coalesce(sum(row_count), 0) = 0 THEN 'error'
            WHEN sum(CASE WHEN outside THEN row_count ELSE 0 END) > 0 THEN 'violation'
            ELSE 'pass' END AS status,
       CAST(coalesce(sum(row_count), 0) AS BIGINT) AS checked_rows,
       count(*) FILTER (WHERE outside) AS n_violations,
       CASE WHEN coalesce(sum(row_count), 0) = 0 THEN 'table is empty; no priority values to check'
            WHEN sum(CASE WHEN outside THEN row_count ELSE 0 END) > 0 THEN printf(
              '%d/%d rows carry a priority outside the declared domain',
              sum(CASE WHEN outside THEN row_count ELSE 0 END), sum(row_count))
            ELSE printf('all %d rows carry a priority inside the declared domain', sum(row_count))
       END AS message
FROM keyed
"""

# ---------------------------------------------------------------------------
# Type preservation: lineitem ids vs part columns (schema only)
# ---------------------------------------------------------------------------
ID_MAP = {"l_partkey": "p_partkey", "l_linenumber": "p_size",
          "l_extendedprice": "p_retailprice"}


def typed_target(t) -> DataFrame:
    return t.lineitem.select(F.col("l_partkey").cast("string").alias("l_partkey"),
                             "l_linenumber", "l_extendedprice")


@query("id_type_check", sql="""
WITH found AS (SELECT column_name, column_type FROM (DESCRIBE SELECT CAST(l_partkey AS VARCHAR)
                 AS l_partkey, l_linenumber, l_extendedprice FROM lineitem)),
expected AS (SELECT column_name, column_type FROM (DESCRIBE SELECT p_partkey, p_size, p_retailprice
                 FROM part)),
m(tcol, scol) AS (VALUES ('l_partkey', 'p_partkey'), ('l_linenumber', 'p_size'),
                         ('l_extendedprice', 'p_retailprice')),
cat AS (
  SELECT m.tcol AS "column",
         CASE WHEN f.column_type IN ('VARCHAR', 'BLOB') THEN 'string'
              WHEN f.column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') THEN 'integral'
              WHEN f.column_type IN ('FLOAT', 'DOUBLE') OR f.column_type LIKE 'DECIMAL%' THEN 'numeric'
              ELSE 'other' END AS found_category,
         CASE WHEN e.column_type IN ('VARCHAR', 'BLOB') THEN 'string'
              WHEN e.column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') THEN 'integral'
              WHEN e.column_type IN ('FLOAT', 'DOUBLE') OR e.column_type LIKE 'DECIMAL%' THEN 'numeric'
              ELSE 'other' END AS expected_category,
         m.scol AS source_column
  FROM m JOIN found f ON f.column_name = m.tcol JOIN expected e ON e.column_name = m.scol)
SELECT "column", found_category, expected_category, source_column,
       CASE WHEN expected_category IN ('integral', 'numeric') AND found_category = 'string'
            THEN 'violation' ELSE 'pass' END AS status,
       CASE "column" WHEN 'l_partkey' THEN (SELECT count(l_partkey) FROM lineitem)
                     WHEN 'l_linenumber' THEN (SELECT count(l_linenumber) FROM lineitem)
                     ELSE (SELECT count(l_extendedprice) FROM lineitem) END AS n_values,
       CASE WHEN "column" = 'l_partkey' THEN
         (SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL
             AND TRY_CAST(CAST(l_partkey AS VARCHAR) AS BIGINT) IS NULL) ELSE 0 END AS n_lost
FROM cat
""")
def id_type_check(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return P.type_report(typed_target(t), t.part, ID_MAP).select(
        "column", "found_category", "expected_category", "source_column", "status", "n_values", "n_lost")


# ---------------------------------------------------------------------------
# Range invariant (P10) on customer.c_acctbal >= 0
# ---------------------------------------------------------------------------
RANGE_VERDICT_SQL = """
SELECT 'range' AS policy,
       CASE WHEN count(c_acctbal) = 0 THEN 'error'
            WHEN count(*) FILTER (WHERE c_acctbal < 0) > 0 THEN 'violation'
            ELSE 'pass' END AS status,
       count(c_acctbal) AS checked_rows,
       count(*) FILTER (WHERE c_acctbal < 0) AS n_violations,
       CASE WHEN count(c_acctbal) = 0 THEN 'no c_acctbal values to check'
            WHEN count(*) FILTER (WHERE c_acctbal < 0) > 0 THEN printf(
              '%d/%d rows have c_acctbal out of range',
              count(*) FILTER (WHERE c_acctbal < 0), count(c_acctbal))
            ELSE printf('all %d rows have c_acctbal in range', count(c_acctbal)) END AS message
FROM customer
"""


def range_verdict(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return P.range_check(t.customer, "c_acctbal", lower=0.0, policy="range").verdict


query("range_check", sql=RANGE_VERDICT_SQL)(range_verdict)


@query("verdict_message", sql=f"""
WITH {DISCOUNT_CTE}, {PRIORITY_CTE}
{DISCOUNT_VERDICT_SQL}
UNION ALL
{ENUM_VERDICT_SQL}
UNION ALL
{RANGE_VERDICT_SQL}
""")
def verdict_message(spark, sf_dir) -> DataFrame:
    parts = [discount_verdict(spark, sf_dir), enum_verdict(spark, sf_dir),
             range_verdict(spark, sf_dir)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*VERDICT_COLS)


def retry_text(spark, sf_dir) -> DataFrame:
    """Retry messages for the violating stand-in policies, one row per offender."""
    from rampart.operators import messages as Msg
    from rampart.operators import names as N
    from rampart.plans.gate_plans import name_sets
    t = load_tables(spark, sf_dir)
    enum = P.value_domain_check(priority_table(t), "priority", PRIORITY_DOMAIN,
                                confusions=PRIORITY_CONFUSIONS, policy="enum")
    target, source, base = discount_inputs(t)
    amount = P.derived_amount_check(target, source, base, carry=["charge_id", "line_no"], **discount_kw())
    return Msg.retry_rows({
        "discount": Msg.amount_retry_rows(amount.violations, ["charge_id", "line_no"]),
        "enum": Msg.domain_retry_rows(enum.violations, "priority", PRIORITY_DOMAIN),
        "idtype": Msg.type_retry_rows(P.type_report(typed_target(t), t.part, ID_MAP)),
        "namegate": Msg.name_gate_retry_rows(N.name_flags(*name_sets(t)))})


def _retry_sql() -> str:
    from rampart.plans.gate_plans import NAME_CTE
    dom = ", ".join(f"''{d}''" for d in PRIORITY_DOMAIN)
    money = "coalesce(CAST(CAST({} AS DECIMAL(38,2)) AS VARCHAR), 'None')"
    return f"""
WITH {DISCOUNT_CTE}, {PRIORITY_CTE}, {NAME_CTE},
enum_v AS (
  SELECT CASE WHEN value IS NULL THEN 'None' ELSE '''' || value || '''' END AS subject, row_count,
         CASE k WHEN 'urgent' THEN '1-URGENT' WHEN 'high' THEN '2-HIGH'
                WHEN 'medium' THEN '3-MEDIUM' WHEN 'low' THEN '5-LOW'
                ELSE CASE WHEN replace(k, '_', ' ') IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
                          THEN replace(k, '_', ' ') END END AS suggestion
  FROM keyed WHERE outside),
bad AS (SELECT project FROM sets GROUP BY project HAVING bool_or(offender) AND NOT bool_or(built_candidate)),
rows AS (
  SELECT 'enum' AS policy, subject,
         '`priority` holds ' || subject || ' in ' || CAST(row_count AS VARCHAR) || ' rows; '
         || CASE WHEN suggestion IS NOT NULL THEN 'it must be ''' || suggestion || ''''
                 ELSE 'it is not a declared value' END
         || '. The declared domain is exactly: {dom}.' AS text
  FROM enum_v
  UNION ALL
  SELECT 'discount', charge_id || '/' || line_no,
         charge_id || '/' || line_no || ' (' || value_type || '): amount is ' || {money.format('amount_found')}
         || ' but must be ' || {money.format('amount_expected')} || ' from value ' || {money.format('raw_value')}
         || ' and base ' || {money.format('base_amount')}
  FROM flagged WHERE is_violation
  UNION ALL
  SELECT 'idtype', 'l_partkey', '`l_partkey` is string but its source `p_partkey` is integral; keep the source type'
  UNION ALL
  SELECT 'namegate', project || '/' || name,
         CASE WHEN offender THEN 'built under the undeclared name ' || name
                                 || '; rebuild under a declared name, do not add new names to the schema'
              ELSE 'the declared model ' || name || ' is still unbuilt' END
  FROM sets JOIN bad USING (project) WHERE offender OR unmet)
SELECT policy, subject, row_number() OVER (PARTITION BY policy ORDER BY subject, text) AS position, text
FROM rows
"""


query("retry_text", sql=_retry_sql())(retry_text)
