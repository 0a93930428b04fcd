"""Inputs of the trial reports, given in the schema the reports read, from ``events``.

A user is a run.  Its record is JSON text, its artifacts are paths, its model
names come from what it wrote, and the spec is a literal list as in a spec
file.  Everything the reports conclude is worked out by the library from these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.operators import runs as R
from rampart.session import store

TASKS4 = ("recharge001", "shopify001", "shopify002", "recharge002")
# (task, model, ships with SQL, is scored): a fixed spec
SPEC = [
    ("recharge001", "charge_history", False, True), ("recharge001", "stg_charge", True, False),
    ("shopify001", "products", False, True), ("shopify001", "daily_shop", False, False),
    ("shopify001", "stg_order", True, False),
    ("shopify002", "products", False, False), ("shopify002", "daily_shop", False, True),
    ("shopify002", "customers", False, True), ("shopify002", "stg_order", True, False),
    ("recharge002", "customer_daily_rollup", False, True), ("recharge002", "stg_charge", True, False)]
ROOT = "/runs"


def _pick(values, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


def task_of(uid: Column) -> Column:
    return _pick(TASKS4, F.pmod(F.floor(uid / 3), F.lit(4)))


def arm_of(uid: Column) -> Column:
    return _pick(R.ARMS, F.pmod(uid, F.lit(3)))


def exp_of(uid: Column) -> Column:
    return R.exp_id("nudge", task_of(uid), arm_of(uid), uid)


def log_facts(t) -> DataFrame:
    """One pass over the logs, written: per run its token and call counts, last event
    type, and ``net``, the first transport-failure message (H14)."""
    k, typ = F.get_json_object("props", "$.k"), F.col("event_type")
    n = k.cast("bigint")
    msg = F.when(F.pmod(n, F.lit(9)) == 0, F.concat(_pick(R.NET_MARKERS, F.pmod(n, F.lit(10))), F.lit(" api.example.com"))) \
        .otherwise(F.lit("HTTP 500"))
    e = t.events.select("user_id", typ, F.struct("ts", "event_id").alias("at"),
                        F.when(typ == "purchase", R.defensive_long(k)).otherwise(0).alias("k"),
                        F.when(typ == "error", msg).alias("msg"))
    hit = R.net_marker_hit(F.col("msg"))
    return store(e.groupBy("user_id").agg(
        F.sum("k").alias("tokens"), F.count_if(typ != "error").alias("tools"), F.max_by(typ, F.col("at")).alias("last"),
        F.min_by(F.substring("msg", 1, 200), F.when(hit, F.col("at"))).alias("net")), "log-facts")


def grid(facts: DataFrame) -> DataFrame:
    """The expected runs: every user, and one that never ran."""
    uid = F.col("user_id")
    return facts.select("user_id").unionByName(facts.agg((F.max("user_id") + 1).alias("user_id")).where("user_id is not null")) \
        .select("user_id", exp_of(uid).alias("exp"), task_of(uid).alias("task"), arm_of(uid).alias("arm"),
                F.when(F.pmod(uid, F.lit(2)) == 0, "larger").otherwise("smaller").alias("model"))


def record_texts(facts: DataFrame) -> DataFrame:
    """(user_id, exp, text): what each run wrote as its record.  Some wrote none, a few
    an empty file, some broke off in the middle; some counts are not numbers."""
    uid = F.col("user_id")
    outage = F.pmod(uid, F.lit(25)) == 0
    exp, task = exp_of(uid), task_of(uid)
    usage = F.when(outage, F.lit("0")).when(F.pmod(uid, F.lit(29)) == 3, F.lit("n/a")).otherwise(F.col("tokens").cast("string"))
    old = F.concat(F.lit("/old"), F.lit(ROOT), F.lit("/"), exp)
    text = F.to_json(F.struct(
        task.alias("instance_id"), F.concat(old, F.lit("/_pi_meta/"), task, F.lit("/trajectory.jsonl")).alias("trajectory"),
        F.concat(old, F.lit("/"), task, F.lit("/shop.duckdb")).alias("produced_db"),
        (F.col("last") != "error").alias("settled"), (F.col("last") == "signup").alias("timed_out"),
        F.when(F.pmod(uid, F.lit(23)) != 2, (F.col("last") == "purchase").cast("int")).alias("score"),
        F.when(outage, 0).otherwise(F.col("tools")).alias("n_tool_calls_total"),
        F.array(F.struct(F.struct(usage.alias("totalTokens")).alias("usage")),
                F.struct(F.lit(None).cast("struct<totalTokens:string>").alias("usage"))).alias("rounds")))
    text = F.when(F.pmod(uid, F.lit(409)) == 9, F.lit("")) \
        .when(F.pmod(uid, F.lit(37)) == 5, F.left(text, F.lit(60))).otherwise(text)
    return facts.where(F.pmod(uid, F.lit(41)) != 7).select("user_id", exp.alias("exp"), text.alias("text"))


def artifact_listing(users: DataFrame) -> DataFrame:
    """(path): the files that are there now for ``users`` (user_id); some runs lack one."""
    uid = F.col("user_id")
    run = F.concat(F.lit(ROOT + "/"), exp_of(uid), F.lit("/"))
    logs = users.where(F.pmod(uid, F.lit(31)) != 0).select(F.concat(run, F.lit("_pi_meta/"), task_of(uid), F.lit("/trajectory.jsonl")).alias("path"))
    dbs = users.where(F.pmod(uid, F.lit(43)) != 1).select(F.concat(run, task_of(uid), F.lit("/shop.duckdb")).alias("path"))
    return logs.unionByName(dbs)


def spec_table(spark) -> DataFrame:
    return spark.createDataFrame(SPEC, "task string, name string, shipped boolean, scored boolean")


def written_models(t) -> DataFrame:
    """(user_id, name, built): the models that a run wrote, and whether their table was made."""
    uid, k = F.col("user_id"), F.get_json_object("props", "$.k").cast("bigint")
    targets = F.lit(None).cast("array<string>")
    for task in TASKS4:
        names = [m for s, m, shipped, _ in SPEC if s == task and not shipped]
        targets = F.when(task_of(uid) == task, F.array(*[F.lit(n) for n in names])).otherwise(targets)
    name = F.get(targets, F.pmod(k, F.size(targets)).cast("int"))
    return t.events.where("event_type in ('click', 'purchase')").select(
        "user_id", F.when(F.col("event_type") == "click", F.concat(name, F.lit("_custom"))).otherwise(name).alias("name"),
        (F.pmod(k, F.lit(4)) != 0).alias("built")).groupBy("user_id", "name").agg(F.bool_or("built").alias("built"))


_SPEC_VALUES = ", ".join(f"('{s}', '{m}', {str(a).lower()}, {str(b).lower()})" for s, m, a, b in SPEC)
_TARGETS_SQL = " ".join(
    f"WHEN '{task}' THEN {[m for s, m, shipped, _ in SPEC if s == task and not shipped]}" for task in TASKS4)

INPUT_SQL = f"""
ev AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
ids AS (SELECT DISTINCT user_id FROM events UNION SELECT max(user_id) + 1 FROM events),
grid0 AS (
  SELECT user_id, list_extract({list(TASKS4)}, CAST((user_id // 3) % 4 AS INTEGER) + 1) AS task,
         list_extract({list(R.ARMS)}, CAST(user_id % 3 AS INTEGER) + 1) AS arm,
         CASE WHEN user_id % 2 = 0 THEN 'larger' ELSE 'smaller' END AS model FROM ids),
grid AS (SELECT *, 'nudge-' || task || '-' || arm || '-r' || user_id AS exp FROM grid0),
msgs AS (SELECT *, CASE WHEN CAST(k AS BIGINT) % 9 = 0
                        THEN list_extract({list(R.NET_MARKERS)}, CAST(CAST(k AS BIGINT) % 10 AS INTEGER) + 1)
                             || ' api.example.com' ELSE 'HTTP 500' END AS msg FROM ev),
nets AS (SELECT user_id, arg_min(substring(msg, 1, 200), (ts, event_id)) AS net FROM msgs
         WHERE event_type = 'error' AND ({' OR '.join(f"contains(msg, '{m}')" for m in R.NET_MARKERS)}) GROUP BY user_id),
f0 AS (SELECT user_id,
              sum(CASE WHEN event_type = 'purchase' THEN coalesce(TRY_CAST(k AS BIGINT), 0) ELSE 0 END) AS tokens,
              count(*) FILTER (WHERE event_type <> 'error') AS tools, arg_max(event_type, (ts, event_id)) AS last
       FROM ev GROUP BY user_id),
facts AS (
  SELECT user_id,
         CAST(CASE WHEN user_id % 25 = 0 OR user_id % 29 = 3 THEN 0 ELSE tokens END AS BIGINT) AS tokens,
         CAST(CASE WHEN user_id % 25 = 0 THEN 0 ELSE tools END AS BIGINT) AS tools,
         last <> 'error' AS settled, last = 'signup' AS timed_out,
         CASE WHEN user_id % 23 <> 2 THEN CAST(last = 'purchase' AS INTEGER) END AS score,
         user_id % 41 <> 7 AND user_id % 409 <> 9 AS present,
         user_id % 37 <> 5 AS parses
  FROM f0),
validity AS (
  SELECT g.*, f.tokens, f.tools, f.score, n.net,
         CASE WHEN NOT coalesce(f.present, false) THEN 'no record at ' || exp || '.stdout.json'
              WHEN NOT f.parses THEN 'unparseable ' || exp || '.stdout.json' END AS record_problem,
         CASE WHEN NOT coalesce(f.present AND f.parses, false) THEN 'MISSING'
              WHEN tokens = 0 AND tools = 0 THEN 'VOID_NO_MODEL'
              WHEN n.net IS NOT NULL AND (timed_out OR NOT settled) THEN 'VOID_NETWORK'
              WHEN timed_out OR NOT settled THEN 'VOID_TIMEOUT' ELSE 'VALID' END AS status
  FROM grid g LEFT JOIN facts f ON f.user_id = g.user_id LEFT JOIN nets n ON n.user_id = g.user_id)
"""

GATE_SQL = f"""
spec(task, name, shipped, scored) AS (VALUES {_SPEC_VALUES}),
named AS (
  SELECT user_id, event_type, CAST(k AS BIGINT) AS k,
         CASE list_extract({list(TASKS4)}, CAST((user_id // 3) % 4 AS INTEGER) + 1) {_TARGETS_SQL} END AS targets
  FROM ev WHERE event_type IN ('click', 'purchase')),
written AS (
  SELECT user_id, list_extract(targets, CAST(k % len(targets) AS INTEGER) + 1)
                  || CASE WHEN event_type = 'click' THEN '_custom' ELSE '' END AS name,
         bool_or(k % 4 <> 0) AS built FROM named GROUP BY 1, 2),
tagged AS (
  SELECT g.user_id, s.name, 'declared' AS tag FROM grid g JOIN spec s ON s.task = g.task
  UNION ALL SELECT g.user_id, s.name, unnest(['shipped', 'run', 'materialized']) FROM grid g JOIN spec s ON s.task = g.task AND s.shipped
  UNION ALL SELECT user_id, name, 'run' FROM written
  UNION ALL SELECT user_id, name, 'materialized' FROM written WHERE built),
flags0 AS (
  SELECT user_id, name, bool_or(tag = 'declared') AS d, bool_or(tag = 'shipped') AS s,
         bool_or(tag = 'run') AS r, bool_or(tag = 'materialized') AS m FROM tagged GROUP BY user_id, name),
gate AS (
  SELECT user_id, count(*) FILTER (WHERE d AND NOT s) AS n_candidates,
         count(*) FILTER (WHERE r AND NOT s AND m) AS n_built_new,
         count(*) FILTER (WHERE r AND NOT s AND m AND NOT d) AS n_offenders,
         count(*) FILTER (WHERE d AND NOT s AND m) AS n_built_candidates
  FROM flags0 GROUP BY user_id),
gated AS (
  SELECT *, CASE WHEN n_candidates = 0 THEN 'pass' WHEN n_built_new = 0 THEN 'error'
                 WHEN n_offenders > 0 AND n_built_candidates = 0 THEN 'violation' ELSE 'pass' END AS gate_status
  FROM gate),
listing AS (
  SELECT g.user_id, count(*) AS n_scored, count(f.name) AS n_scored_built,
         coalesce(string_agg(f.name, ',' ORDER BY f.name), '') AS scored_built
  FROM grid g JOIN spec s ON s.task = g.task AND s.scored
  LEFT JOIN flags0 f ON f.user_id = g.user_id AND f.name = s.name AND f.m GROUP BY g.user_id)
"""
