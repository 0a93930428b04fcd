"""Trajectory analytics plans.

Stand-in (SURVEY §7.4): a run is a ``user_id``, ordered by (ts, event_id);
``error`` events are ends carrying the notice, every other event is a start:
``click`` a wrong write, ``purchase`` the target write, ``view`` a spec read,
``signup`` a bash call.  Tool, command, path and result text are derived per
event from its type, id and ``props.k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import events as E
from rampart.plans.registry import query
from rampart.sources.tables import load_tables

# Declared model names and targets of the stand-in project.
DECLARED = ("orders_base", "daily_rollup", "customers")
TARGETS = ("daily_rollup",)


def trajectory(t) -> DataFrame:
    e = t.events
    k = F.get_json_object("props", "$.k").cast("bigint")
    typ = F.col("event_type")
    tool = (F.when(typ == "view", "read").when(typ == "click", "edit")
            .when(typ == "purchase", "write").otherwise("bash"))
    command = (F.when(typ == "signup", F.when(F.pmod(k, F.lit(2)) == 0,
                                              F.concat(F.lit("dbt run --select m"), k.cast("string")))
                      .otherwise(F.lit("ls -la")))
               .when(typ == "error", F.lit("dbt build")))
    wrong_name = (F.when(F.pmod(k, F.lit(10)) == 0, F.concat(F.lit("stg_src"), k.cast("string")))
                  .when(F.pmod(k, F.lit(10)) == 1, F.lit("orders_base"))
                  .when(F.pmod(k, F.lit(10)) == 2, F.lit("daily_rollup"))
                  .otherwise(F.concat(F.lit("model_"), F.pmod(k, F.lit(7)).cast("string"))))
    path = (F.when(typ == "view", F.lit("models/schema.yml"))
            .when(typ == "click", F.concat(
                F.lit("models/"), F.when(F.pmod(k, F.lit(3)) == 0, F.lit("marts/")).otherwise(""),
                wrong_name, F.lit(".sql")))
            .when(typ == "purchase", F.lit("models/daily_rollup.sql")))
    result = (F.when(typ == "error", F.lit("Compilation Error in model"))
              .when((typ == "signup") & (F.pmod(k, F.lit(5)) == 0),
                    F.lit("Traceback (most recent call last)"))
              .otherwise(F.concat(F.lit("ok "), k.cast("string"))))
    return e.select("user_id", "ts", "event_id", "event_type", "value", k.alias("k"),
                    (typ != "error").alias("is_start"), tool.alias("tool"),
                    command.alias("command"), path.alias("path"), result.alias("result"),
                    ((typ == "error") & (F.pmod(k, F.lit(2)) == 0)).alias("is_error"))


TRAJ_CTE = """
traj0 AS (SELECT user_id, ts, event_id, event_type, value,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
traj AS (
  SELECT *, event_type <> 'error' AS is_start,
         CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'edit'
              WHEN 'purchase' THEN 'write' ELSE 'bash' END AS tool,
         CASE WHEN event_type = 'signup' THEN
                CASE WHEN k % 2 = 0 THEN 'dbt run --select m' || CAST(k AS VARCHAR) ELSE 'ls -la' END
              WHEN event_type = 'error' THEN 'dbt build' END AS command,
         CASE WHEN event_type = 'view' THEN 'models/schema.yml'
              WHEN event_type = 'click' THEN 'models/' || CASE WHEN k % 3 = 0 THEN 'marts/' ELSE '' END
                   || CASE WHEN k % 10 = 0 THEN 'stg_src' || CAST(k AS VARCHAR)
                           WHEN k % 10 = 1 THEN 'orders_base'
                           WHEN k % 10 = 2 THEN 'daily_rollup'
                           ELSE 'model_' || CAST(k % 7 AS VARCHAR) END || '.sql'
              WHEN event_type = 'purchase' THEN 'models/daily_rollup.sql' END AS path,
         CASE WHEN event_type = 'error' THEN 'Compilation Error in model'
              WHEN event_type = 'signup' AND k % 5 = 0 THEN 'Traceback (most recent call last)'
              ELSE 'ok ' || CAST(k AS VARCHAR) END AS result,
         (event_type = 'error' AND k % 2 = 0) AS is_error
  FROM traj0),
idx AS (
  SELECT *, CAST(sum(CASE WHEN is_start THEN 1 ELSE 0 END) OVER (
                PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
              - CASE WHEN is_start THEN 1 ELSE 0 END AS BIGINT) AS starts_before
  FROM traj),
firsts AS (
  SELECT user_id,
         count(*) FILTER (WHERE is_start) AS n_calls,
         min(starts_before) FILTER (WHERE event_type = 'click') AS first_wrong,
         min(starts_before) FILTER (WHERE event_type = 'purchase') AS first_target,
         min(starts_before - 1) FILTER (WHERE event_type = 'error') AS first_notice,
         min(starts_before) FILTER (WHERE event_type = 'view') AS first_yml,
         min(starts_before) FILTER (WHERE event_type IN ('click', 'purchase')) AS first_write
  FROM idx GROUP BY user_id)
"""


def causal_table(t, totals=()) -> DataFrame:
    tr = trajectory(t)
    typ = F.col("event_type")
    return E.first_indices(
        tr, run="user_id", is_start=F.col("is_start"),
        markers={"first_wrong": (typ == "click", False),
                 "first_target": (typ == "purchase", False),
                 "first_notice": (typ == "error", True),
                 "first_yml": (typ == "view", False),
                 "first_write": (typ.isin("click", "purchase"), False)},
        after_counts={"rereads": ("first_notice", typ == "view")}, totals=dict(totals))


@query("causal_conversion", sql="WITH " + TRAJ_CTE + """
SELECT user_id, first_wrong, first_target, first_notice,
       coalesce(first_wrong IS NOT NULL AND (first_notice IS NULL OR first_wrong < first_notice),
                false) AS entered_trap,
       coalesce(first_wrong IS NOT NULL AND (first_notice IS NULL OR first_wrong < first_notice)
                AND first_notice IS NOT NULL AND first_target IS NOT NULL
                AND first_target > first_notice, false) AS converted,
       coalesce(first_target IS NOT NULL AND (first_notice IS NULL OR first_target < first_notice),
                false) AS correct_before_notice
FROM firsts
""")
def causal_conversion(spark, sf_dir) -> DataFrame:
    c = causal_table(load_tables(spark, sf_dir))
    return c.select("user_id", "first_wrong", "first_target", "first_notice",
                    *E.causal_flags(F.col("first_wrong"), F.col("first_target"),
                                    F.col("first_notice")))


@query("reread_after_notice", sql="WITH " + TRAJ_CTE + """,
first_notice_ev AS (
  SELECT user_id, min((ts, event_id)) AS k FROM traj WHERE event_type = 'error' GROUP BY user_id)
SELECT f.user_id, f.first_notice,
       (SELECT count(*) FROM traj t WHERE t.user_id = f.user_id AND t.event_type = 'view'
          AND n.k IS NOT NULL AND (t.ts, t.event_id) > n.k) AS rereads
FROM firsts f LEFT JOIN first_notice_ev n ON n.user_id = f.user_id
""")
def reread_after_notice(spark, sf_dir) -> DataFrame:
    return causal_table(load_tables(spark, sf_dir)).select("user_id", "first_notice", "rereads")


@query("read_write_gap", sql="WITH " + TRAJ_CTE + """
SELECT user_id, first_yml AS first_read, first_write, first_write - first_yml AS gap FROM firsts
""")
def read_write_gap(spark, sf_dir) -> DataFrame:
    c = causal_table(load_tables(spark, sf_dir))
    return c.select("user_id", F.col("first_yml").alias("first_read"), "first_write",
                    (F.col("first_write") - F.col("first_yml")).alias("gap"))


@query("wrong_names", sql="WITH " + TRAJ_CTE + """,
names AS (
  SELECT user_id, unnest(regexp_extract_all('{"path": "' || path || '"}',
         'models/(?:[A-Za-z0-9_]+/)*([A-Za-z0-9_]+)\\.sql', 1)) AS name
  FROM traj WHERE tool IN ('write', 'edit', 'str_replace', 'create_file')),
classed AS (
  SELECT user_id, name,
         CASE WHEN starts_with(name, 'stg_')
                   OR (name IN ('orders_base', 'daily_rollup', 'customers')
                       AND name NOT IN ('daily_rollup')) THEN 'skip'
              WHEN name IN ('daily_rollup') THEN 'target' ELSE 'wrong' END AS cls
  FROM names)
SELECT user_id, name AS wrong_name, count(*) AS writes FROM classed WHERE cls = 'wrong'
GROUP BY user_id, name
""")
def wrong_names(spark, sf_dir) -> DataFrame:
    tr = trajectory(load_tables(spark, sf_dir))
    args = F.concat(F.lit('{"path": "'), F.col("path"), F.lit('"}'))
    n = tr.where(F.col("tool").isin(*E.WRITE_TOOLS)).select(
        "user_id", F.explode(E.model_names(args)).alias("name"))
    return (n.where(E.name_class(F.col("name"), DECLARED, TARGETS) == "wrong")
            .groupBy("user_id", F.col("name").alias("wrong_name"))
            .agg(F.count(F.lit(1)).alias("writes")))


@query("step_pairing", sql="""
WITH e AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS call_id, ts, event_id,
         event_id % 2 = 0 AS is_start, event_id % 2 = 1 AS is_end, event_type AS tool, props AS args,
         CASE event_id % 6 WHEN 0 THEN 'dbt run ' || repeat('x', CAST(event_id % 900 AS INTEGER))
                           WHEN 2 THEN '' END AS command,
         CASE WHEN event_id % 4 = 2 THEN 'models/' || event_type END AS path,
         CASE WHEN event_id % 10 = 4 THEN 'pattern' END AS pattern
  FROM events),
s AS (SELECT *, sum(CASE WHEN is_end THEN 1 ELSE 0 END) OVER (
                  PARTITION BY user_id, call_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
                - CASE WHEN is_end THEN 1 ELSE 0 END AS seg FROM e),
st AS (SELECT * FROM s WHERE is_start QUALIFY row_number() OVER (
         PARTITION BY user_id, call_id, seg ORDER BY ts DESC, event_id DESC) = 1)
SELECT en.user_id, en.event_id, st.event_id IS NOT NULL AS matched, coalesce(st.tool, '?') AS tool,
       substring(CASE WHEN st.command <> '' THEN st.command WHEN st.path <> '' THEN st.path
                      WHEN st.pattern <> '' THEN st.pattern
                      ELSE substring(coalesce(st.args, '{}'), 1, 120) END, 1, 600) AS label
FROM s en LEFT JOIN st ON st.user_id = en.user_id AND st.call_id = en.call_id AND st.seg = en.seg
WHERE en.is_end
""")
def step_pairing(spark, sf_dir) -> DataFrame:
    """Even events start calls, odd ones end them; a call id is the
    user's ``k`` modulo 10, so ids repeat, overlap and miss their partner."""
    i = F.col("event_id")
    e = load_tables(spark, sf_dir).events.select(
        "user_id", "ts", "event_id", F.col("event_type").alias("tool"), F.col("props").alias("args"),
        F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(10)).alias("call_id"),
        F.when(F.pmod(i, F.lit(6)) == 0, F.concat(F.lit("dbt run "), F.repeat(
            F.lit("x"), F.pmod(i, F.lit(900)).cast("int"))))
         .when(F.pmod(i, F.lit(6)) == 2, F.lit("")).alias("command"),
        F.when(F.pmod(i, F.lit(4)) == 2, F.concat(F.lit("models/"), F.col("event_type"))).alias("path"),
        F.when(F.pmod(i, F.lit(10)) == 4, F.lit("pattern")).alias("pattern"))
    odd = F.pmod(i, F.lit(2)) == 1
    steps = E.pair_steps(e, run="user_id", call_id="call_id", is_start=~odd, is_end=odd,
                         payload=["tool", "command", "path", "pattern", "args"])
    return steps.select(
        F.col("run").alias("user_id"), F.col("tie").alias("event_id"), "matched",
        F.coalesce("start_tool", F.lit("?")).alias("tool"),
        E.step_label(*[F.col(f"start_{c}") for c in ("command", "path", "pattern", "args")]).alias("label"))


RESULT_SQL_CTE = """
r AS (
  SELECT event_id,
         CASE WHEN event_id % 53 = 0 THEN '{"output": "trunc'
              WHEN event_id % 4 = 0 THEN '"plain ' || event_type || '"'
              WHEN event_id % 4 = 1 THEN '{"output": "out ' || json_extract_string(props, '$.k')
                                         || '", "content": "ignored"}'
              WHEN event_id % 4 = 2 THEN '{"output": "", "content": [{"type": "text", "text": "line '
                                         || json_extract_string(props, '$.k')
                                         || '"}, {"type": "image"}, "tail"]}'
              ELSE '{"other": ' || json_extract_string(props, '$.k') || '}' END AS raw
  FROM events),
o0 AS (SELECT event_id, raw, json_valid(raw) AS ok,
              CAST(CASE WHEN json_valid(raw) THEN raw END AS JSON) AS j FROM r),
o AS (
  SELECT event_id, raw, ok, j,
         CASE WHEN json_type(j) = 'OBJECT' THEN
           CASE WHEN json_extract(j, '$.output') IS NOT NULL
                     AND json_extract(j, '$.output')::VARCHAR NOT IN ('null', '""', '[]', '{}', 'false', '0')
                  THEN json_extract(j, '$.output')
                WHEN json_extract(j, '$.content') IS NOT NULL
                     AND json_extract(j, '$.content')::VARCHAR NOT IN ('null', '""', '[]', '{}', 'false', '0')
                  THEN json_extract(j, '$.content')
                WHEN json_extract(j, '$.text') IS NOT NULL
                     AND json_extract(j, '$.text')::VARCHAR NOT IN ('null', '""', '[]', '{}', 'false', '0')
                  THEN json_extract(j, '$.text') END END AS out
  FROM o0)
"""


@query("result_text", sql="WITH " + RESULT_SQL_CTE + """
SELECT event_id,
       CASE WHEN NOT ok THEN substring(raw, 1, 2000)
            WHEN json_type(j) = 'VARCHAR' THEN json_extract_string(j, '$')
            WHEN json_type(out) = 'ARRAY' THEN array_to_string(list_filter(list_transform(
                   json_extract(out, '$[*]'),
                   lambda x: CASE WHEN json_type(x) = 'VARCHAR' THEN json_extract_string(x, '$')
                             WHEN json_extract_string(x, '$.type') = 'text'
                               THEN coalesce(json_extract_string(x, '$.text'), '') END),
                   lambda x: x IS NOT NULL), chr(10))
            WHEN json_type(out) = 'VARCHAR' THEN json_extract_string(out, '$')
            ELSE substring(raw, 1, 2000) END AS result_text
FROM o
""")
def result_text(spark, sf_dir) -> DataFrame:
    e = load_tables(spark, sf_dir).events
    k = F.get_json_object("props", "$.k")
    eid = F.col("event_id")
    raw = (F.when(F.pmod(eid, F.lit(53)) == 0, F.lit('{"output": "trunc'))
           .when(F.pmod(eid, F.lit(4)) == 0, F.concat(F.lit('"plain '), F.col("event_type"),
                                                      F.lit('"')))
           .when(F.pmod(eid, F.lit(4)) == 1, F.concat(F.lit('{"output": "out '), k,
                                                      F.lit('", "content": "ignored"}')))
           .when(F.pmod(eid, F.lit(4)) == 2, F.concat(
               F.lit('{"output": "", "content": [{"type": "text", "text": "line '), k,
               F.lit('"}, {"type": "image"}, "tail"]}')))
           .otherwise(F.concat(F.lit('{"other": '), k, F.lit("}"))))
    return e.select("event_id", E.result_text(raw).alias("result_text"))


STEP_CTE = """
steps AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step_no,
         (tool = 'bash' AND coalesce(command, '') LIKE '%dbt%') AS f_dbt,
         tool IN ('edit', 'write') AS f_edit,
         (coalesce(is_error, false) OR lower(coalesce(result, '')) LIKE '%error%'
          OR lower(coalesce(result, '')) LIKE '%fail%'
          OR lower(coalesce(result, '')) LIKE '%traceback%'
          OR lower(coalesce(result, '')) LIKE '%compilation%') AS f_error,
         (lower(coalesce(command, '')) LIKE '%dbt%' AND (lower(coalesce(command, '')) LIKE '%run%'
          OR lower(coalesce(command, '')) LIKE '%build%')) AS f_build
  FROM traj)
"""


def step_flags(tr) -> dict:
    return {"dbt": E.is_dbt_call(F.col("tool"), F.col("command")), "edits": F.col("tool").isin("edit", "write"),
            "errors": E.is_error_result(F.col("is_error"), F.col("result")), "dbt_build": E.is_dbt_build(F.col("command"))}


@query("step_filters", sql="WITH " + TRAJ_CTE + "," + STEP_CTE + """
SELECT user_id, count(*) AS n_steps, count(*) FILTER (WHERE f_dbt) AS n_dbt,
       count(*) FILTER (WHERE f_edit) AS n_edits, count(*) FILTER (WHERE f_error) AS n_errors,
       count(*) FILTER (WHERE f_build) AS n_dbt_build,
       min(step_no) FILTER (WHERE f_error) AS first_error_step
FROM steps GROUP BY user_id
""")
def step_filters(spark, sf_dir) -> DataFrame:
    """E5: numbers are given before any filter, so the first error's is one more than
    the count of all steps before it."""
    tr = trajectory(load_tables(spark, sf_dir))
    flags = step_flags(tr)
    out = E.first_indices(tr, run="user_id", is_start=F.lit(True), markers={"first_error": (flags["errors"], False)},
                          totals={f"n_{k}": c for k, c in flags.items()})
    return out.select("user_id", F.col("n_calls").alias("n_steps"), "n_dbt", "n_edits", "n_errors", "n_dbt_build",
                      (F.col("first_error") + 1).alias("first_error_step"))


TAIL_N = 3


@query("step_tail", sql="WITH " + TRAJ_CTE + "," + STEP_CTE + f"""
SELECT user_id, step_no, tool FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY step_no DESC) AS rn
  FROM steps WHERE f_error) WHERE rn <= {TAIL_N}
""")
def step_tail(spark, sf_dir) -> DataFrame:
    """The last N error steps per run, by their place among all steps."""
    tr = trajectory(load_tables(spark, sf_dir))
    return E.last_positions(tr, run="user_id", keep=step_flags(tr)["errors"], n=TAIL_N, payload=["tool"]) \
        .select("user_id", "step_no", "tool")


@query("event_type_counts", sql="""
SELECT user_id, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER)
         AS round, event_type, count(*) AS n
FROM events GROUP BY ALL
""")
def event_type_counts(spark, sf_dir) -> DataFrame:
    e = load_tables(spark, sf_dir).events
    rnd = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    return e.groupBy("user_id", rnd.cast("int").alias("round"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("usage_rollup", sql="""
WITH doubled AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 2 = 0),
counters AS (
  SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS turns,
         count(*) FILTER (WHERE event_type <> 'error') AS tool_calls,
         count(*) FILTER (WHERE event_type = 'signup'
                          AND CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0) AS dbt_calls,
         count(*) FILTER (WHERE event_type IN ('error', 'purchase', 'view') AND event_id % 7 = 0) AS policy_checks,
         count(DISTINCT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7)
                             AS INTEGER)) AS rounds
  FROM doubled GROUP BY user_id),
usage AS (
  SELECT user_id, round(sum(value), 2) AS usage, CAST(sum(k) AS BIGINT) AS input_tokens, count(*) AS usage_msgs
  FROM (SELECT DISTINCT user_id, ts, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM doubled WHERE event_type = 'purchase')
  GROUP BY user_id)
SELECT c.user_id, turns, tool_calls, dbt_calls, policy_checks, rounds, coalesce(usage, 0) AS usage,
       coalesce(input_tokens, 0) AS input_tokens, coalesce(usage_msgs, 0) AS usage_msgs
FROM counters c LEFT JOIN usage u ON u.user_id = c.user_id
""")
def usage_rollup(spark, sf_dir) -> DataFrame:
    e = load_tables(spark, sf_dir).events
    doubled = e.unionByName(e.where(F.pmod(F.col("event_id"), F.lit(2)) == 0))
    k = F.get_json_object("props", "$.k").cast("bigint")
    typ = F.col("event_type")
    rnd = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    counters = doubled.groupBy("user_id").agg(
        F.count_if(typ == "view").alias("turns"),
        F.count_if(typ != "error").alias("tool_calls"),
        F.count_if((typ == "signup") & (F.pmod(k, F.lit(2)) == 0)).alias("dbt_calls"),
        F.count_if(typ.isin("error", "purchase", "view") & (F.pmod("event_id", F.lit(7)) == 0))
         .alias("policy_checks"),
        F.count_distinct(rnd).alias("rounds"))
    # Usage is a nested record, counted once per (run, timestamp, record); the
    # second copy of a message has its keys in another order.
    total, tokens = F.col("value").cast("string"), k.cast("string")
    first = F.concat(F.lit('{"input": '), tokens, F.lit(', "cost": {"total": '), total, F.lit("}}"))
    other = F.concat(F.lit('{"cost": {"total": '), total, F.lit('}, "input": '), tokens, F.lit("}"))
    messages = e.where(typ == "purchase").select("user_id", "ts", "event_id", first.alias("usage")) \
        .unionByName(e.where((typ == "purchase") & (F.pmod("event_id", F.lit(2)) == 0))
                     .select("user_id", "ts", "event_id", other.alias("usage")))
    record = E.usage_record(F.col("usage"))
    usage = (messages.select("user_id", "ts", record.alias("u")).dropDuplicates(["user_id", "ts", "u"])
             .groupBy("user_id").agg(F.round(F.sum("u.cost.total"), 2).alias("usage"),
                                     F.sum("u.input").alias("input_tokens"),
                                     F.count(F.lit(1)).alias("usage_msgs")))
    return counters.join(usage, "user_id", "left").select(
        "user_id", "turns", "tool_calls", "dbt_calls", "policy_checks", "rounds",
        F.coalesce("usage", F.lit(0.0)).alias("usage"),
        F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"),
        F.coalesce("usage_msgs", F.lit(0)).alias("usage_msgs"))


@query("event_scan_tolerant", sql="""
WITH lines AS (
  SELECT CASE WHEN event_id % 41 = 0 THEN ''
              WHEN event_id % 37 = 0 THEN substring('{"type": "' || event_type || '", "run": '
                                                    || user_id || '}', 1, 15)
              ELSE '{"type": "' || event_type || '", "run": ' || user_id || ', "id": '
                   || event_id || '}' END AS line
  FROM events),
parsed AS (SELECT json_extract_string(line, '$.type') AS event_type,
                  CAST(json_extract(line, '$.run') AS BIGINT) AS run
           FROM lines WHERE line LIKE '%"type"%' AND json_valid(line))
SELECT event_type, count(*) AS n_events, count(DISTINCT run) AS n_runs FROM parsed GROUP BY 1
""")
def event_scan_tolerant(spark, sf_dir) -> DataFrame:
    from rampart.sources.events import parse_event_lines
    e = load_tables(spark, sf_dir).events
    full = F.concat(F.lit('{"type": "'), F.col("event_type"), F.lit('", "run": '),
                    F.col("user_id").cast("string"), F.lit(", \"id\": "),
                    F.col("event_id").cast("string"), F.lit("}"))
    cut = F.substring(F.concat(F.lit('{"type": "'), F.col("event_type"), F.lit('", "run": '),
                               F.col("user_id").cast("string"), F.lit("}")), 1, 15)
    eid = F.col("event_id")
    lines = e.select(F.when(F.pmod(eid, F.lit(41)) == 0, F.lit(""))
                     .when(F.pmod(eid, F.lit(37)) == 0, cut).otherwise(full).alias("value"))
    parsed = parse_event_lines(lines, prefilter='"type"', fields={"event_type": ("$.type", "string"),
                                                                  "run": ("$.run", "bigint")})
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                            F.count_distinct("run").alias("n_runs"))


@query("verdict_rollup", sql="""
WITH r AS (SELECT user_id, event_type = 'purchase' AND value > 150 AS is_round,
                  value < 300 AS ok, event_id % 5 <> 0 AS round_settled FROM events)
SELECT user_id, count(*) FILTER (WHERE is_round) AS n_rounds,
       coalesce(bool_and(ok) FILTER (WHERE is_round), true) AS all_ok,
       coalesce(bool_or(NOT ok) FILTER (WHERE is_round), false) AS any_bad,
       count(*) FILTER (WHERE is_round) > 0
         AND coalesce(bool_and(round_settled) FILTER (WHERE is_round), false) AS settled,
       count(*) FILTER (WHERE is_round) > 0
         AND coalesce(bool_and(ok) FILTER (WHERE is_round), false) AS all_built
FROM r GROUP BY user_id
""")
def verdict_rollup(spark, sf_dir) -> DataFrame:
    """all/any over possibly empty sets -- ``all`` of nothing is true,
    but ``settled`` is false with zero rounds and ``all_built`` needs a
    non-empty list (Spark's bool_and over no rows is null, hence coalesce)."""
    e = load_tables(spark, sf_dir).events
    is_round = (F.col("event_type") == "purchase") & (F.col("value") > 150)
    ok = F.col("value") < 300
    settled_round = F.pmod(F.col("event_id"), F.lit(5)) != 0
    n = F.count_if(is_round)
    return e.groupBy("user_id").agg(
        n.alias("n_rounds"),
        F.coalesce(F.bool_and(F.when(is_round, ok)), F.lit(True)).alias("all_ok"),
        F.coalesce(F.bool_or(F.when(is_round, ~ok)), F.lit(False)).alias("any_bad"),
        ((n > 0) & F.coalesce(F.bool_and(F.when(is_round, settled_round)), F.lit(False)))
         .alias("settled"),
        ((n > 0) & F.coalesce(F.bool_and(F.when(is_round, ok)), F.lit(False))).alias("all_built"))
