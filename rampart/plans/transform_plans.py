"""Table transform plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import transforms as T
from rampart.plans.registry import query
from rampart.sources.tables import load_tables

# M5: the later end of the predicted spine, in days after the last activity of all.
SPINE_SURPLUS_DAYS = 30


def _dec(c, scale=2):
    return F.col(c).cast(f"decimal(18,{scale})")


@query("charge_history", sql="""
WITH k AS (
  SELECT *, 'charge line' AS line_item_type, 0 AS source_index, l_extendedprice AS amount FROM lineitem
  UNION ALL
  SELECT *, 'discount', 1,
         CAST(round(CAST(round(l_discount * 100, 2) AS DECIMAL(38,6))
                    * CAST(l_extendedprice AS DECIMAL(38,6)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE)
  FROM lineitem
  UNION ALL
  SELECT *, 'shipping', 2,
         CAST(round(CAST(l_quantity AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(3,2)), 2) AS DOUBLE)
  FROM lineitem
  UNION ALL
  SELECT *, 'tax', 3,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DOUBLE)
  FROM lineitem
  UNION ALL
  SELECT *, 'refund', 4, -l_extendedprice FROM lineitem WHERE l_returnflag = 'R')
SELECT l_orderkey AS charge_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY line_item_type, amount, l_linenumber, l_partkey, l_suppkey)
         AS charge_row_num,
       source_index, CAST(l_shipdate AS DATE) AS charge_created_at, l_suppkey AS customer_id,
       l_partkey AS address_id, amount, line_item_type || ' ' || l_linenumber AS title, line_item_type
FROM k
""")
def charge_history(spark, sf_dir) -> DataFrame:
    """T1 with all checked columns; supplier and part stand for customer and address."""
    li = load_tables(spark, sf_dir).lineitem
    kinds = {
        "charge line": F.col("l_extendedprice"),
        "discount": T.percentage_amount(F.lit("percentage"), F.round(F.col("l_discount") * 100, 2),
                                        F.col("l_extendedprice")),
        "shipping": F.round(_dec("l_quantity") * F.lit(0.5).cast("decimal(3,2)"), 2).cast("double"),
        "tax": F.round(_dec("l_extendedprice") * _dec("l_tax"), 2).cast("double"),
        "refund": (-F.col("l_extendedprice"), F.coalesce(F.col("l_returnflag") == "R", F.lit(False))),
    }
    h = T.charge_history(li, charge="l_orderkey", kinds=kinds, order_tie=["l_linenumber", "l_partkey", "l_suppkey"],
                         carry={"charge_created_at": F.col("l_shipdate").cast("date")})
    return h.select("charge_id", "charge_row_num", "source_index", "charge_created_at",
                    F.col("l_suppkey").alias("customer_id"), F.col("l_partkey").alias("address_id"), "amount",
                    F.concat("line_item_type", F.lit(" "), F.col("l_linenumber").cast("string")).alias("title"),
                    "line_item_type")


@query("daily_spine", sql="""
WITH lines AS (
  SELECT l_orderkey, count(*) AS items,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS disc,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS refund,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))
                  ELSE 0 END) AS refund_tax
  FROM lineitem GROUP BY l_orderkey),
act AS (SELECT c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS day, o_custkey, o_totalprice,
               items, disc, refund, refund_tax
        FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lines ON l_orderkey = o_orderkey),
daily AS (SELECT segment, day, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
                 CAST(sum(items) AS BIGINT) AS line_items, CAST(round(sum(disc), 2) AS DOUBLE) AS discounts,
                 CAST(round(sum(refund_tax), 2) AS DOUBLE) AS refund_tax,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) - coalesce(sum(refund), 0) AS DOUBLE) AS adjusted_total
          FROM act GROUP BY segment, day),
spine AS (SELECT segment, CAST(unnest(generate_series((SELECT min(day) FROM act), (SELECT max(day) FROM act),
                                                      INTERVAL 1 DAY)) AS DATE) AS day
          FROM (SELECT DISTINCT segment FROM act))
SELECT s.segment, s.day, coalesce(d.orders, 0) AS orders, coalesce(d.customers, 0) AS customers,
       coalesce(d.revenue, 0) AS revenue, coalesce(d.line_items, 0) AS line_items,
       coalesce(d.discounts, 0) AS discounts, coalesce(d.refund_tax, 0) AS refund_tax,
       coalesce(d.adjusted_total, 0) AS adjusted_total
FROM spine s LEFT JOIN daily d ON d.segment = s.segment AND d.day = s.day
""")
def daily_spine(spark, sf_dir) -> DataFrame:
    """Line items are summed per order before the join."""
    t = load_tables(spark, sf_dir)
    price, back = _dec("l_extendedprice"), F.col("l_returnflag") == "R"
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items"), F.sum(price * _dec("l_discount")).alias("disc"),
        F.sum(F.when(back, price).otherwise(0)).alias("refund"),
        F.sum(F.when(back, price * _dec("l_tax")).otherwise(0)).alias("refund_tax"))
    act = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")) \
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("c_mktsegment").alias("segment"), "o_orderdate", "o_custkey", "o_totalprice",
        "items", "disc", "refund", "refund_tax")
    total = F.sum(_dec("o_totalprice"))
    s = T.daily_spine(act, entity="segment", day="o_orderdate", measures=[
        F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"),
        total.cast("double").alias("revenue"), F.sum("items").alias("line_items"),
        F.round(F.sum("disc"), 2).cast("double").alias("discounts"),
        F.round(F.sum("refund_tax"), 2).cast("double").alias("refund_tax"),
        (total - F.coalesce(F.sum("refund"), F.lit(0))).cast("double").alias("adjusted_total")])
    zero = F.lit(0.0)
    return s.select("segment", "day", F.coalesce("orders", F.lit(0)).alias("orders"),
                    F.coalesce("customers", F.lit(0)).alias("customers"),
                    F.coalesce("revenue", zero).alias("revenue"),
                    F.coalesce("line_items", F.lit(0)).alias("line_items"),
                    *[F.coalesce(c, zero).alias(c) for c in ("discounts", "refund_tax", "adjusted_total")])


@query("spine_drift", sql=f"""
WITH act AS (SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day FROM orders),
e AS (SELECT max(day) + {SPINE_SURPLUS_DAYS} AS last_day FROM act),
b AS (SELECT status, min(day) AS first_day, max(day) AS gold_end FROM act GROUP BY status)
SELECT status, gold_end, date_diff('day', first_day, gold_end) + 1 AS gold_rows,
       date_diff('day', first_day, last_day) + 1 AS pred_rows,
       date_diff('day', gold_end, last_day) AS surplus,
       (SELECT count(*) FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d)
        WHERE CAST(d AS DATE) > gold_end) AS surplus_after_gold_end,
       date_diff('day', gold_end, last_day)
         = (SELECT count(*) FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d)
            WHERE CAST(d AS DATE) > gold_end) AS explained
FROM b CROSS JOIN e
""")
def spine_drift(spark, sf_dir) -> DataFrame:
    """M5: a spine run to a later end day than the gold's last activity day
    has surplus rows; they are explained when all of them fall after the
    gold's last day.  The later end is a fixed number of days after the last activity of
    all statuses, never the clock."""
    o = load_tables(spark, sf_dir).orders
    o = o.where("o_orderdate is not null")
    last_day = o.agg(F.max(F.col("o_orderdate").cast("date"))).first()[0]     # one scalar
    end = F.date_add(F.lit(last_day), SPINE_SURPLUS_DAYS)
    b = o.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_day"),
        F.max(F.col("o_orderdate").cast("date")).alias("gold_end"))
    pred = b.select("status", "gold_end", F.explode(F.sequence("first_day", end)).alias("d"))
    after = pred.groupBy("status", "gold_end").agg(
        F.count(F.lit(1)).alias("pred_rows"),
        F.count_if(F.col("d") > F.col("gold_end")).alias("surplus_after_gold_end"))
    j = b.join(after, ["status", "gold_end"])
    gold_rows = F.datediff("gold_end", "first_day") + 1
    surplus = F.col("pred_rows") - gold_rows
    return j.select("status", "gold_end", gold_rows.cast("bigint").alias("gold_rows"), "pred_rows",
                    surplus.cast("bigint").alias("surplus"), "surplus_after_gold_end",
                    (surplus == F.col("surplus_after_gold_end")).alias("explained"))


@query("running_totals", sql="""
WITH d AS (SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS day,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS daily
           FROM orders GROUP BY 1, 2)
SELECT custkey, day, CAST(daily AS DOUBLE) AS daily,
       CAST(sum(daily) OVER (PARTITION BY custkey ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE)
         AS running
FROM d
""")
def running_totals(spark, sf_dir) -> DataFrame:
    o = load_tables(spark, sf_dir).orders.withColumnRenamed("o_custkey", "custkey")
    return T.running_totals(o, entity="custkey", day="o_orderdate", amount="o_totalprice")


@query("active_months", sql="""
WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1)
SELECT o.o_custkey AS custkey, o.o_orderkey AS orderkey, CAST(o.o_orderdate AS DATE) AS day,
       greatest(round((date_diff('day', f.first_day, CAST(o.o_orderdate AS DATE)) + 1) / 30, 2), 0)
         AS months
FROM orders o JOIN f ON f.o_custkey = o.o_custkey
""")
def active_months(spark, sf_dir) -> DataFrame:
    o = load_tables(spark, sf_dir).orders.select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderdate").cast("date").alias("day"))
    return T.active_months(o, entity="custkey", day="day").select(
        "custkey", "orderkey", "day", "months")


@query("product_rollup", sql="""
WITH per_line AS (
  SELECT l_partkey, l_orderkey, l_linenumber,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sub,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS ref,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS qref,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS disc,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS tax
  FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT l_partkey, count(*) AS lines, sum(q) AS q, sum(sub) AS sub, sum(ref) AS ref,
             sum(qref) AS qref, sum(disc) AS disc, sum(tax) AS tax FROM per_line GROUP BY 1)
SELECT l_partkey, lines, CAST(round(q, 2) AS DOUBLE) AS quantity,
       CAST(round(q - qref, 2) AS DOUBLE) AS net_quantity, CAST(round(sub, 2) AS DOUBLE) AS subtotal,
       CAST(round(ref, 2) AS DOUBLE) AS refunds, CAST(round(sub - ref, 2) AS DOUBLE) AS net,
       CAST(sub AS DOUBLE) / lines AS avg_per_line, CAST(q AS DOUBLE) / lines AS avg_quantity_per_line,
       CAST(disc AS DOUBLE) / lines AS avg_discount_per_line,
       CAST(round(disc, 2) AS DOUBLE) AS discount_total, CAST(round(tax, 2) AS DOUBLE) AS tax_total
FROM p
""")
def product_rollup(spark, sf_dir) -> DataFrame:
    li = load_tables(spark, sf_dir).lineitem
    r = T.product_rollup(li, product="l_partkey", line_key=["l_orderkey", "l_linenumber"],
                         quantity="l_quantity", price="l_extendedprice", discount="l_discount",
                         tax="l_tax", refunded=F.col("l_returnflag") == "R")
    return r
