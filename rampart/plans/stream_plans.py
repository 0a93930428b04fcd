"""Streaming plans: run to completion, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.plans.registry import query
from rampart.streaming import jobs as S


@query("stream_event_counts", sql="""
SELECT user_id, event_type, count(*) AS n, round(sum(value), 2) AS value_sum
FROM events GROUP BY user_id, event_type
""")
def stream_event_counts(spark, sf_dir) -> DataFrame:
    """Must equal the batch rollup over the same input."""
    return S.event_counts(spark, sf_dir)


@query("stream_round_state", sql="""
WITH RECURSIVE known AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS t FROM events
  WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL),
mark AS (SELECT (max(t) // 1000 - 3600000) * 1000 AS m FROM known),
e AS (
  SELECT user_id, t, event_type = 'view' AS opens, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k
  FROM known WHERE event_type IN ('view', 'purchase')),
settle AS (
  SELECT v.user_id, v.k, min(p.k) AS settle_k
  FROM e v JOIN e p ON v.user_id = p.user_id AND p.k > v.k AND p.t <= v.t + 21600000000 AND NOT p.opens
  WHERE v.opens GROUP BY v.user_id, v.k),
late AS (
  SELECT v.user_id, v.k, min(a.k) AS late_k, min(CASE WHEN a.opens THEN a.k END) AS late_open
  FROM e v JOIN e a ON v.user_id = a.user_id AND a.t > v.t + 21600000000 WHERE v.opens GROUP BY v.user_id, v.k),
after_settle AS (
  SELECT s.user_id, s.k, min(o.k) AS next_open
  FROM settle s JOIN e o ON s.user_id = o.user_id AND o.opens AND o.k > s.settle_k GROUP BY s.user_id, s.k),
v AS (
  SELECT v.user_id, v.k, v.t, s.settle_k, l.late_k,
    CASE WHEN s.settle_k IS NOT NULL THEN n.next_open ELSE l.late_open END AS next_k
  FROM e v LEFT JOIN settle s ON v.user_id = s.user_id AND v.k = s.k
  LEFT JOIN late l ON v.user_id = l.user_id AND v.k = l.k
  LEFT JOIN after_settle n ON v.user_id = n.user_id AND v.k = n.k
  WHERE v.opens),
chain AS (
  SELECT user_id, min(k) AS k FROM v GROUP BY user_id
  UNION ALL
  SELECT v.user_id, v.next_k AS k FROM chain JOIN v ON chain.user_id = v.user_id AND chain.k = v.k
  WHERE v.next_k IS NOT NULL)
SELECT v.user_id, strftime(make_timestamp(v.t), '%Y-%m-%d %H:%M:%S.%f') AS round_start,
  CASE WHEN p.t IS NOT NULL THEN 'settled'
       WHEN v.late_k IS NOT NULL OR v.t + 21600000000 < mark.m THEN 'timed_out' ELSE 'open' END AS outcome,
  CASE WHEN p.t IS NOT NULL THEN strftime(make_timestamp(p.t), '%Y-%m-%d %H:%M:%S.%f')
       WHEN v.late_k IS NOT NULL OR v.t + 21600000000 < mark.m
         THEN strftime(make_timestamp(v.t + 21600000000), '%Y-%m-%d %H:%M:%S.%f') END AS resolved_at
FROM chain JOIN v ON chain.user_id = v.user_id AND chain.k = v.k
LEFT JOIN e p ON p.user_id = v.user_id AND p.k = v.settle_k CROSS JOIN mark
""")
def stream_round_state(spark, sf_dir) -> DataFrame:
    """Rounds by keyed state and event-time timers, over the whole event stream."""
    def text(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return S.round_state(spark, sf_dir).select("user_id", text("round_start"), "outcome", text("resolved_at"))


@query("stream_policy_log", sql="""
WITH v AS (
  SELECT 'discount_range' AS policy, count(l_discount) AS checked_rows,
         count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.1) AS n_violations FROM lineitem
  UNION ALL
  SELECT 'returnflag_domain', count(*),
         count(DISTINCT coalesce(l_returnflag, '<null>'))
           FILTER (WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')) FROM lineitem
  UNION ALL
  SELECT 'quantity_range', count(l_quantity),
         count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) FROM lineitem)
SELECT policy, checked_rows, n_violations,
       CASE WHEN checked_rows = 0 THEN 'error' WHEN n_violations > 0 THEN 'violation'
            ELSE 'pass' END AS status
FROM v
""")
def stream_policy_log(spark, sf_dir) -> DataFrame:
    """S3: per-batch verdict log folded over batches."""
    return S.policy_log_summary(S.policy_log(spark, sf_dir))
