"""Text and log jobs.

Every function works on whole texts, row by row, with JVM regex functions;
groupings are per document or per conversation, whose size is the text's own.
Regexes stay within the subset shared by Java and RE2 (no look-around, no
back-references, explicit ``(?s)`` / ``(?i)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.operators.skew import SALT, join_per_group
from rampart.session import store

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
MISSING_NODE_RE = (r"Did not find matching node for patch with name '([^']+)'"
                   r"(?: in the '[^']*' section of file '([^']+)')?")
TRIGGER_RE = (r"(?i)\[?WARNING\]?|Encountered an error|Compilation Error|"
              r"Database Error|Runtime Error|ERROR=[1-9]|FAIL=[1-9]")
NOTICE_BANNER = "================ HARNESS NOTICE ================"
NOTICE_END = "================================================"
THOUGHT_RE = r"(?s)Thought:(.*?)Action"
ACTION_RES = (r"""(?s)["']?Action["']?:? (.*?)Observation""",
              r"""(?s)["']?Action["']?:? (.*?)Thought""",
              r"""(?s)["']?Action["']?:? (.*?)$""",
              r"(?s)^(.*?)Observation")
FILE_ACTION_OPEN_RE = r"(?s)(?:CreateFile|EditFile)\(filepath=.*?\).*?```"
# ---------------------------------------------------------------------------

# Wording of the rendered notice (ours; only the banner is load-bearing).
GENERIC_NOTICE = ("dbt printed warnings or errors above. Check the project's schema files "
                  "(models/**/*.yml) and make sure your model's name and columns match what "
                  "they declare before going on.")
SPECIFIC_HEAD = "dbt says these declared models have no SQL model:"
SPECIFIC_TAIL = "You may have built a model under a different name; compare with the schema."
PROBLEM_HEAD = "dbt reported an unresolved problem:"
PROBLEM_TAIL = "Compare your model with the schema files before going on."


def strip_ws(c: Column) -> Column:
    """Python-style strip of leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def missing_nodes(log: Column) -> Column:
    """H3 + G7: (name, path) hits in first-occurrence order, duplicates
    dropped; an absent path is an empty string."""
    names = F.regexp_extract_all(log, F.lit(MISSING_NODE_RE), 1)
    paths = F.regexp_extract_all(log, F.lit(MISSING_NODE_RE), 2)
    hits = F.array_distinct(F.arrays_zip(names.alias("name"), paths.alias("path")))
    # cheap literal test first: most texts never mention a missing node
    return F.when(F.coalesce(log.contains("Did not find matching node for patch"), F.lit(False)),
                  hits).otherwise(F.array().cast(hits_type()))


def hits_type() -> str:
    return "array<struct<name:string,path:string>>"


def triggered(text: Column) -> Column:
    """H4: any trigger phrase, case-insensitive."""
    return F.coalesce(text.rlike(TRIGGER_RE), F.lit(False))


def trigger_lines(text: Column) -> Column:
    """The lines of a whole text that trigger (a trigger never spans lines,
    so ``size(trigger_lines(t)) > 0`` is exactly ``triggered(t)``)."""
    return F.filter(F.split(text, "\n"), lambda ln: F.coalesce(ln.rlike(TRIGGER_RE), F.lit(False)))


def first_trigger_line(lines: Column) -> Column:
    """H5 within one whole text, from its ``trigger_lines``: the first
    non-blank one, trimmed and cut to 300; a per-row expression."""
    nonblank = F.filter(lines, lambda ln: ln.rlike(r"\S"))
    return F.substring(strip_ws(F.try_element_at(nonblank, F.lit(1))), 1, 300)


def first_trigger_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """H5: per text, the first non-blank line that triggers, trimmed, cut to 300."""
    lines = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    hit = lines.where(triggered(F.col("line")) & (strip_ws(F.col("line")) != ""))
    return hit.groupBy(key).agg(
        F.min_by(F.substring(strip_ws(F.col("line")), 1, 300), F.col("pos")).alias("first_trigger"))


def nudge_block(mode: str, hits: Column, first_trigger: Column) -> Column:
    """The notice appended to a triggering log, per mode."""
    if mode == "off":
        return F.lit(None).cast("string")
    if mode == "generic":
        return F.lit("\n" + NOTICE_BANNER + "\n" + GENERIC_NOTICE + "\n" + NOTICE_END + "\n")
    items = F.transform(hits, lambda h: F.concat(
        F.lit("  * no model matches the declared name '"), h["name"], F.lit("'"),
        F.when(h["path"] != "", F.concat(F.lit(" (declared in "), h["path"], F.lit(")")))
         .otherwise(F.lit(""))))
    with_hits = F.concat_ws("\n", F.lit(""), F.lit(NOTICE_BANNER), F.lit(SPECIFIC_HEAD),
                            F.array_join(items, "\n"), F.lit(""), F.lit(SPECIFIC_TAIL),
                            F.lit(NOTICE_END))
    no_hits = F.concat_ws("\n", F.lit(""), F.lit(NOTICE_BANNER), F.lit(PROBLEM_HEAD),
                          F.concat(F.lit("  * "), F.coalesce(first_trigger, F.lit(""))),
                          F.lit(""), F.lit(PROBLEM_TAIL), F.lit(NOTICE_END))
    return F.concat(F.when(F.size(hits) > 0, with_hits).otherwise(no_hits), F.lit("\n"))


def thought(response: Column) -> Column:
    """Text between ``Thought:`` and ``Action`` (stripped), else the
    whole response."""
    found = response.rlike(THOUGHT_RE)
    return F.when(found, strip_ws(F.regexp_extract(response, THOUGHT_RE, 1))).otherwise(response)


def action_text(response: Column) -> Column:
    """The first pattern that matches wins (stripped); empty -> the
    whole response stripped."""
    out = F.lit(None).cast("string")
    for p in reversed(ACTION_RES):
        out = F.when(response.rlike(p), strip_ws(F.regexp_extract(response, p, 1))).otherwise(out)
    return F.when(F.coalesce(out, F.lit("")) == "", strip_ws(response)).otherwise(out)


def unescape_action(a: Column) -> Column:
    """H11 retry form: ``\\_`` -> ``_`` and three single quotes -> a fence."""
    return F.replace(F.replace(a, F.lit("\\_"), F.lit("_")), F.lit("'''"), F.lit("```"))


def fence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("```"))


def truncated_file_action(response: Column) -> Column:
    """A file action opened a fence that never closed (odd fence count;
    the upstream action grammar is not available, SURVEY §7.7)."""
    opened = F.coalesce(response.rlike(FILE_ACTION_OPEN_RE), F.lit(False))
    return opened & (F.pmod(fence_count(response), F.lit(2)) == 1)


def flatten_content(raw: Column) -> Column:
    """Message content as text.  A JSON array keeps its text parts
    (``{type: text}`` objects and bare strings), joined by newlines; any other
    content is itself, and is not parsed; null is empty."""
    v = F.try_parse_json(F.when(F.ltrim(raw).startswith("["), raw))
    items = F.try_variant_get(v, "$", "array<variant>")
    parts = F.filter(F.transform(items, lambda x: F.when(
        F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))
        .when(F.try_variant_get(x, "$.type", "string") == "text",
              F.coalesce(F.try_variant_get(x, "$.text", "string"), F.lit("")))),
        lambda x: x.isNotNull())
    is_list = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    return F.when(is_list, F.array_join(parts, "\n")).otherwise(F.coalesce(raw, F.lit("")))


def split_messages(msgs: DataFrame, *, conv: str, pos: str, role: str, text: str) -> DataFrame:
    """Per conversation, system turns pulled out (non-empty ones joined
    by a blank line, stripped) and the remaining turn counts."""
    is_sys = F.col(role) == "system"
    sys_items = F.when(is_sys & (F.coalesce(F.col(text), F.lit("")) != ""),
                       F.struct(F.col(pos).alias("p"), F.col(text).alias("t")))
    return msgs.groupBy(conv).agg(
        strip_ws(F.array_join(F.transform(F.sort_array(F.collect_list(sys_items)),
                                          lambda x: x["t"]), "\n\n")).alias("system_text"),
        F.count_if(~is_sys).alias("n_messages"),
        F.count_if(F.col(role) == "user").alias("n_user"),
        F.count_if(F.col(role) == "assistant").alias("n_assistant"))


def context_window(msgs: DataFrame, *, conv: str, pos: str, memory: int) -> DataFrame:
    """Which messages survive.  ``pos`` is a 0-based contiguous index.

    window: once the history exceeds 2*memory+1, keep the first message and
    the last 2*memory.  overflow: keep the first, drop the next two.
    """
    n = store(msgs.groupBy(conv).agg(F.count(F.lit(1)).alias("_n")), "lengths")
    j = join_per_group(msgs, n, [conv], [pos], "_n").drop(SALT)
    p = F.col(pos)
    window = (F.col("_n") <= 2 * memory + 1) | (p == 0) | (p >= F.col("_n") - 2 * memory)
    overflow = ~p.isin(1, 2)
    a = j.where(window).select(conv, pos, F.lit("window").alias("variant"))
    b = j.where(overflow).select(conv, pos, F.lit("overflow").alias("variant"))
    return a.unionByName(b)


STEP_KEYS = ("observation", "thought", "action", "response")


def export_trajectory(steps: DataFrame, heads: DataFrame, *, conv: str, pos: str) -> DataFrame:
    """One JSON document per run with exactly the five top keys and
    four step keys, in order; a missing step value becomes ""."""
    st = steps.select(conv, pos, F.struct(*[F.coalesce(F.col(k), F.lit("")).alias(k)
                                           for k in STEP_KEYS]).alias("s"))
    per = st.groupBy(conv).agg(F.transform(F.sort_array(F.collect_list(
        F.struct(F.col(pos).alias("p"), F.col("s").alias("s")))), lambda x: x["s"]).alias("traj"))
    j = heads.join(per, conv, "left")
    doc = F.struct(F.coalesce(F.col("task"), F.lit("")).alias("Task"),
                   F.coalesce(F.col("system_message"), F.lit("")).alias("system_message"),
                   F.coalesce(F.col("traj"), F.array().cast(
                       "array<struct<observation:string,thought:string,action:string,"
                       "response:string>>")).alias("trajectory"),
                   F.coalesce(F.col("finished"), F.lit(False)).alias("finished"),
                   F.coalesce(F.col("result"), F.lit("")).alias("result"))
    return j.select(conv, F.to_json(doc).alias("json"))
