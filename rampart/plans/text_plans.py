"""Text and log plans.

Logs: each document's whole text followed by dbt-style lines derived from
its id (missing-node warnings, a repeated one, one without a file, a summary
line).  Responses: each assistant turn's whole text wrapped in one of three
response shapes chosen by ``conv_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import text as X
from rampart.plans.registry import query
from rampart.sources.tables import load_tables

NL = "\n"


def doc_logs(t) -> DataFrame:
    d = t.documents
    i = F.col("doc_id")
    warn = F.concat(F.lit("[WARNING]: Did not find matching node for patch with name 'model_"),
                    F.pmod(i, F.lit(7)).cast("string"),
                    F.lit("' in the 'models' section of file 'models/schema_"),
                    F.pmod(i, F.lit(3)).cast("string"), F.lit(".yml'\n"))
    log = F.concat(
        F.col("text"), F.lit(NL),
        F.when(F.pmod(i, F.lit(5)) == 0, warn).otherwise(F.lit("")),
        F.when(F.pmod(i, F.lit(10)) == 0, warn).otherwise(F.lit("")),
        F.when(F.pmod(i, F.lit(15)) == 0,
               F.lit("Did not find matching node for patch with name 'orders_x'\n")).otherwise(F.lit("")),
        F.when(F.pmod(i, F.lit(4)) == 1, F.lit("  Done. PASS=3 WARN=0 ERROR=1 SKIP=0 TOTAL=4"))
         .otherwise(F.lit("Done. PASS=4 WARN=0 ERROR=0 SKIP=0 TOTAL=4")))
    return d.select("doc_id", log.alias("log"))


LOG_CTE = """
logs AS (
  SELECT doc_id, text || chr(10)
         || CASE WHEN doc_id % 5 = 0 THEN '[WARNING]: Did not find matching node for patch with name ''model_'
                 || CAST(doc_id % 7 AS VARCHAR) || ''' in the ''models'' section of file ''models/schema_'
                 || CAST(doc_id % 3 AS VARCHAR) || '.yml''' || chr(10) ELSE '' END
         || CASE WHEN doc_id % 10 = 0 THEN '[WARNING]: Did not find matching node for patch with name ''model_'
                 || CAST(doc_id % 7 AS VARCHAR) || ''' in the ''models'' section of file ''models/schema_'
                 || CAST(doc_id % 3 AS VARCHAR) || '.yml''' || chr(10) ELSE '' END
         || CASE WHEN doc_id % 15 = 0 THEN 'Did not find matching node for patch with name ''orders_x'''
                 || chr(10) ELSE '' END
         || CASE WHEN doc_id % 4 = 1 THEN '  Done. PASS=3 WARN=0 ERROR=1 SKIP=0 TOTAL=4'
                 ELSE 'Done. PASS=4 WARN=0 ERROR=0 SKIP=0 TOTAL=4' END AS log
  FROM documents)
"""


@query("log_diagnostics", sql="WITH " + LOG_CTE + f""",
re AS (SELECT '{X.MISSING_NODE_RE.replace("'", "''")}' AS p,
              '{X.TRIGGER_RE.replace("'", "''")}' AS trig),
h0 AS (SELECT doc_id, regexp_extract_all(log, (SELECT p FROM re), 1) AS names,
              regexp_extract_all(log, (SELECT p FROM re), 2) AS paths FROM logs),
h1 AS (SELECT doc_id, unnest(names) AS name, unnest(paths) AS path,
              generate_subscripts(names, 1) AS pos FROM h0),
h2 AS (SELECT doc_id, name, coalesce(path, '') AS path, min(pos) AS pos FROM h1 GROUP BY ALL),
hits AS (SELECT doc_id, count(*) AS n_hits,
                string_agg(name || '@' || path, ', ' ORDER BY pos) AS hit_list,
                string_agg('  * no model matches the declared name ''' || name || ''''
                           || CASE WHEN path <> '' THEN ' (declared in ' || path || ')' ELSE '' END,
                           chr(10) ORDER BY pos) AS items
         FROM h2 GROUP BY doc_id),
l0 AS (SELECT doc_id, unnest(string_split(log, chr(10))) AS line,
              generate_subscripts(string_split(log, chr(10)), 1) AS pos FROM logs),
ft AS (SELECT doc_id, arg_min(substring(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), 1, 300), pos)
                AS first_trigger
       FROM l0 WHERE regexp_matches(line, (SELECT trig FROM re))
                 AND regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY doc_id),
j AS (SELECT l.doc_id, regexp_matches(l.log, (SELECT trig FROM re)) AS triggered,
             coalesce(h.n_hits, 0) AS n_hits, coalesce(h.hit_list, '') AS hit_list, h.items,
             ft.first_trigger
      FROM logs l LEFT JOIN hits h ON h.doc_id = l.doc_id LEFT JOIN ft ON ft.doc_id = l.doc_id)
SELECT doc_id, triggered, n_hits, hit_list, first_trigger,
       CASE WHEN triggered THEN
         CASE WHEN n_hits > 0 THEN
           chr(10) || '{X.NOTICE_BANNER}' || chr(10) || '{X.SPECIFIC_HEAD}' || chr(10) || items
           || chr(10) || chr(10) || '{X.SPECIFIC_TAIL}' || chr(10) || '{X.NOTICE_END}' || chr(10)
         ELSE
           chr(10) || '{X.NOTICE_BANNER}' || chr(10) || '{X.PROBLEM_HEAD}' || chr(10) || '  * '
           || coalesce(first_trigger, '') || chr(10) || chr(10) || '{X.PROBLEM_TAIL}' || chr(10)
           || '{X.NOTICE_END}' || chr(10)
         END END AS nudge
FROM j
""")
def log_diagnostics(spark, sf_dir) -> DataFrame:
    # One projection per document: each whole log is mined in its own row,
    # so the job is a single scan with no shuffle.
    logs = doc_logs(load_tables(spark, sf_dir))
    t = logs.select("doc_id", "log", X.trigger_lines(F.col("log")).alias("tl"))
    j = t.select("doc_id", (F.size("tl") > 0).alias("triggered"),
                 X.missing_nodes(F.col("log")).alias("hits"),
                 X.first_trigger_line(F.col("tl")).alias("first_trigger"))
    return j.select(
        "doc_id", "triggered", F.size("hits").cast("long").alias("n_hits"),
        F.array_join(F.transform("hits", lambda h: F.concat(h["name"], F.lit("@"), h["path"])),
                     ", ").alias("hit_list"),
        "first_trigger",
        F.when(F.col("triggered"), X.nudge_block("specific", F.col("hits"), F.col("first_trigger")))
         .alias("nudge"))


def responses(t) -> DataFrame:
    c = t.conversations.where(F.col("role") == "assistant")
    conv, turn = F.col("conv_id"), F.col("turn")
    resp = (F.when(F.pmod(conv, F.lit(3)) == 0,
                   F.concat(F.col("text"), F.lit("\nObservation: none")))
            .when(F.pmod(conv, F.lit(3)) == 1,
                  F.concat(F.lit("Thought: "), F.col("text"),
                           F.lit('\nAction: Bash(code="ls models\\_'), turn.cast("string"),
                           F.lit('")\nThought: next')))
            .otherwise(F.concat(F.lit("Thought: "), F.col("text"),
                                F.lit('\nAction: CreateFile(filepath="models/m'), conv.cast("string"),
                                F.lit('.sql"):\n```\nselect '), turn.cast("string"), F.lit("\n"),
                                F.when(F.pmod(turn, F.lit(4)) == 1, F.lit("```")).otherwise(F.lit("")))))
    return c.select("conv_id", "turn", resp.alias("response"))


RESP_CTE = """
resp AS (
  SELECT conv_id, turn,
         CASE WHEN conv_id % 3 = 0 THEN text || chr(10) || 'Observation: none'
              WHEN conv_id % 3 = 1 THEN 'Thought: ' || text || chr(10) || 'Action: Bash(code="ls models\\_'
                   || CAST(turn AS VARCHAR) || '")' || chr(10) || 'Thought: next'
              ELSE 'Thought: ' || text || chr(10) || 'Action: CreateFile(filepath="models/m'
                   || CAST(conv_id AS VARCHAR) || '.sql"):' || chr(10) || '```' || chr(10) || 'select '
                   || CAST(turn AS VARCHAR) || chr(10) || CASE WHEN turn % 4 = 1 THEN '```' ELSE '' END
         END AS response
  FROM conversations WHERE role = 'assistant')
"""


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _action_sql() -> str:
    parts = []
    for p in X.ACTION_RES:
        q = p.replace("'", "''")
        parts.append(f"WHEN regexp_matches(response, '{q}') THEN "
                     f"{_strip(f'regexp_extract(response, {chr(39)}{q}{chr(39)}, 1)')}")
    return "CASE " + " ".join(parts) + " END"


FIELDS_CTE = RESP_CTE + f""",
fields AS (
  SELECT conv_id, turn, response,
         CASE WHEN regexp_matches(response, '{X.THOUGHT_RE}')
              THEN {_strip(f"regexp_extract(response, '{X.THOUGHT_RE}', 1)")} ELSE response END AS thought,
         {_action_sql()} AS a0
  FROM resp),
fields2 AS (
  SELECT *, CASE WHEN coalesce(a0, '') = '' THEN {_strip('response')} ELSE a0 END AS action FROM fields)
"""


@query("response_fields", sql="WITH " + FIELDS_CTE + """
SELECT conv_id, turn, thought, action,
       replace(replace(action, '\\_', '_'), '''''''', '```') AS action_retry
FROM fields2
""")
def response_fields(spark, sf_dir) -> DataFrame:
    r = responses(load_tables(spark, sf_dir))
    a = X.action_text(F.col("response"))
    return r.select("conv_id", "turn", X.thought(F.col("response")).alias("thought"),
                    a.alias("action"), X.unescape_action(a).alias("action_retry"))


@query("truncated_fences", sql="WITH " + RESP_CTE + f"""
SELECT conv_id,
       count(*) FILTER (WHERE regexp_matches(response, '{X.FILE_ACTION_OPEN_RE}')) AS file_actions,
       count(*) FILTER (WHERE regexp_matches(response, '{X.FILE_ACTION_OPEN_RE}')
                        AND ((length(response) - length(replace(response, '```', ''))) // 3) % 2 = 1)
         AS truncated
FROM resp GROUP BY conv_id
""")
def truncated_fences(spark, sf_dir) -> DataFrame:
    r = responses(load_tables(spark, sf_dir))
    opened = F.coalesce(F.col("response").rlike(X.FILE_ACTION_OPEN_RE), F.lit(False))
    return r.groupBy("conv_id").agg(
        F.count_if(opened).alias("file_actions"),
        F.count_if(X.truncated_file_action(F.col("response"))).alias("truncated"))


@query("message_split", sql=f"""
SELECT conv_id,
       {_strip("coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role = 'system' AND coalesce(text, '') <> ''), '')")}
         AS system_text,
       count(*) FILTER (WHERE role <> 'system') AS n_messages,
       count(*) FILTER (WHERE role = 'user') AS n_user,
       count(*) FILTER (WHERE role = 'assistant') AS n_assistant
FROM conversations GROUP BY conv_id
""")
def message_split(spark, sf_dir) -> DataFrame:
    """Every third turn's content is a list of parts, which flattens to its text."""
    c = load_tables(spark, sf_dir).conversations
    listed = F.to_json(F.array(F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text")),
                               F.struct(F.lit("image").alias("type"), F.lit("none").alias("text"))))
    content = F.when(F.pmod("turn", F.lit(3)) == 0, listed).otherwise(F.col("text"))
    c = c.withColumn("text", X.flatten_content(content))
    return X.split_messages(c, conv="conv_id", pos="turn", role="role", text="text")


MEMORY = 2


@query("context_window", sql=f"""
WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT c.conv_id, c.turn, 'window' AS variant FROM conversations c JOIN n USING (conv_id)
WHERE n.n <= {2 * MEMORY + 1} OR c.turn = 0 OR c.turn >= n.n - {2 * MEMORY}
UNION ALL
SELECT conv_id, turn, 'overflow' FROM conversations WHERE turn NOT IN (1, 2)
""")
def context_window(spark, sf_dir) -> DataFrame:
    c = load_tables(spark, sf_dir).conversations
    return X.context_window(c, conv="conv_id", pos="turn", memory=MEMORY)


@query("trajectory_export", sql="WITH " + FIELDS_CTE + """,
prev AS (SELECT f.conv_id, f.turn, u.text AS observation, f.thought, f.action, f.response
         FROM fields2 f LEFT JOIN conversations u ON u.conv_id = f.conv_id AND u.turn = f.turn - 1),
traj AS (SELECT conv_id, list({'observation': coalesce(observation, ''), 'thought': coalesce(thought, ''),
                               'action': coalesce(action, ''), 'response': coalesce(response, '')}
                              ORDER BY turn) AS traj
         FROM prev GROUP BY conv_id),
heads AS (
  SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS task,
         string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role = 'system') AS system_message,
         arg_max(role, turn) = 'assistant' AS finished
  FROM conversations GROUP BY conv_id),
res AS (SELECT conv_id, arg_max(response, turn) AS last_resp FROM resp GROUP BY conv_id)
SELECT h.conv_id, CAST(to_json({'Task': coalesce(h.task, ''),
                         'system_message': coalesce(h.system_message, ''),
                         'trajectory': coalesce(t.traj, []),
                         'finished': coalesce(h.finished, false),
                         'result': coalesce(CASE WHEN h.finished THEN r.last_resp END, '')}) AS VARCHAR) AS json
FROM heads h LEFT JOIN traj t USING (conv_id) LEFT JOIN res r USING (conv_id)
""")
def trajectory_export(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    c = t.conversations
    r = responses(t)
    fields = r.select("conv_id", "turn", "response", X.thought(F.col("response")).alias("thought"),
                      X.action_text(F.col("response")).alias("action"))
    u = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("observation"))
    steps = fields.join(u, ["conv_id", "turn"], "left")
    is_user, is_sys = F.col("role") == "user", F.col("role") == "system"
    heads = c.groupBy("conv_id").agg(
        F.min_by(F.when(is_user, F.col("text")), F.when(is_user, F.col("turn"))).alias("task"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(is_sys, F.struct(
            F.col("turn").alias("p"), F.col("text").alias("t"))))), lambda x: x["t"]), "\n\n")
         .alias("system_message"),
        (F.max_by("role", "turn") == "assistant").alias("finished"))
    last = r.groupBy("conv_id").agg(F.max_by("response", "turn").alias("last_resp"))
    heads = heads.join(last, "conv_id", "left").select(
        "conv_id", "task", "system_message", "finished",
        F.when(F.col("finished"), F.col("last_resp")).alias("result"))
    return X.export_trajectory(steps, heads, conv="conv_id", pos="turn")
