"""Event-log analytics over trajectories.

An event table has a run key and a total order inside the run (here the
pair (ts, tie)).  Starts are tool calls; ends close them.

Call indices (E1/E2) and first occurrences (D5) are computed as *counts of
starts before a threshold*: a grouped ``min`` finds each run's thresholds
(one row per run), that row is joined back to the run's events
(:mod:`rampart.operators.skew`: a hot run is salted by its size) and counted per
(run, salt), then per run.  Both aggregates combine map-side, and a run holding a
third of all events is spread over many tasks -- unlike ``sum(is_start) over
(partition by run order by ts)``, or a join on the run alone, which AQE cannot
split here.  The last events of a run (E6) are found the same way: the top few
keys per run, then counts up to them; no event table is numbered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rampart.operators.skew import SALT, join_per_group
from rampart.session import store

# Fixed values that must equal the reference's behaviour.
WRITE_TOOLS = ("write", "edit", "str_replace", "create_file")
MODEL_PATH_RE = r"models/(?:[A-Za-z0-9_]+/)*([A-Za-z0-9_]+)\.sql"
ERROR_WORDS = ("error", "fail", "traceback", "compilation")


def order_key(ts: str = "ts", tie: str = "event_id") -> Column:
    return F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie"))


def before(ts: Column, tie: Column, key: Column) -> Column:
    """(ts, tie) strictly before the struct ``key`` (null key -> null)."""
    return (ts < key["ts"]) | ((ts == key["ts"]) & (tie < key["tie"]))


def first_indices(ev: DataFrame, *, run: str, is_start: Column,
                  markers: Mapping[str, tuple[Column, bool]],
                  after_counts: Mapping[str, tuple[str, Column]] = (),
                  totals: Mapping[str, Column] = {},
                  ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Per run: for each marker, the call index of its first occurrence.

    ``markers`` maps a name to ``(condition, is_notice)``.  A start's index
    is the number of starts before it; a notice (an end event) takes the
    index of the last call started before it, i.e. that count minus one
    (-1 when nothing started yet).  ``after_counts`` maps a name to
    ``(marker, condition)``: events matching the condition later than the
    marker's first occurrence; ``totals`` maps a name to a condition counted over
    the whole run.  Also returns ``n_calls`` (all starts).
    """
    e = ev.select(F.col(run).alias("_run"), F.col(ts).alias("_ts"), F.col(tie).alias("_tie"),
                  is_start.alias("_start"),
                  *[cond.alias(f"_m_{name}") for name, (cond, _) in markers.items()],
                  *[cond.alias(f"_a_{name}") for name, (_, cond) in dict(after_counts).items()],
                  *[cond.alias(f"_t_{name}") for name, cond in totals.items()])
    key = F.struct(F.col("_ts").alias("ts"), F.col("_tie").alias("tie"))
    firsts = e.groupBy("_run").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_start").alias("n_calls"),
        *[F.count_if(f"_t_{n}").alias(n) for n in totals],
        *[F.min(F.when(F.col(f"_m_{n}"), key)).alias(f"_k_{n}") for n in markers])
    firsts = store(firsts, "firsts")             # one row per run, read for the sizes and joined twice
    j = join_per_group(e, firsts.select("_run", "_n", *[f"_k_{n}" for n in markers]), ["_run"], ["_ts", "_tie"], "_n")
    ts_c, tie_c = F.col("_ts"), F.col("_tie")
    counts = j.groupBy("_run", SALT).agg(
        *[F.count_if(F.col("_start") & before(ts_c, tie_c, F.col(f"_k_{n}"))).alias(f"_c_{n}")
          for n in markers],
        *[F.count_if(F.col(f"_a_{n}") & before(F.col(f"_k_{m}")["ts"], F.col(f"_k_{m}")["tie"],
                                               key)).alias(n)
          for n, (m, _) in dict(after_counts).items()])
    names = [f"_c_{n}" for n in markers] + list(dict(after_counts))
    counts = counts.groupBy("_run").agg(*[F.sum(n).alias(n) for n in names])
    out = firsts.join(counts, "_run", "left")
    cols = [F.col("_run").alias(run), F.col("n_calls"), *totals]
    for n, (_, notice) in markers.items():
        cnt = F.coalesce(F.col(f"_c_{n}"), F.lit(0)) - (1 if notice else 0)
        cols.append(F.when(F.col(f"_k_{n}").isNotNull(), cnt).cast("bigint").alias(n))
    for n in dict(after_counts):
        cols.append(F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n))
    return out.select(*cols)


def last_positions(ev: DataFrame, *, run: str, keep: Column, n: int, payload: Sequence[str] = (),
                   ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The last ``n`` events of each run that meet ``keep``, with ``step_no``, their
    1-based place among all events of the run.

    The top ``n`` keys per run are limited before the shuffle; then each run's
    events up to each of these keys are counted.
    """
    e = ev.select(F.col(run).alias("_run"), F.col(ts).alias("_ts"), F.col(tie).alias("_tie"),
                  keep.alias("_keep"), *payload)
    w = Window.partitionBy("_run").orderBy(F.col("_ts").desc(), F.col("_tie").desc())
    last = e.where("_keep").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    tails = last.groupBy("_run").agg(F.sort_array(F.collect_list(F.struct(
        F.col("_ts").alias("ts"), F.col("_tie").alias("tie"), *payload))).alias("_keys"))
    sizes = e.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    tails = store(tails.join(sizes, "_run"), "tails")
    j = join_per_group(e.select("_run", "_ts", "_tie"), tails, ["_run"], ["_ts", "_tie"], "_n")

    def upto(i):
        key = F.get("_keys", F.lit(i))
        return F.count_if(~before(key["ts"], key["tie"], F.struct(F.col("_ts").alias("ts"), F.col("_tie").alias("tie"))))
    counts = j.groupBy("_run", SALT).agg(*[upto(i).alias(f"_c{i}") for i in range(n)]) \
        .groupBy("_run").agg(F.array(*[F.sum(f"_c{i}") for i in range(n)]).alias("_c"))
    out = tails.join(counts, "_run").select("_run", "_c", F.posexplode("_keys").alias("_i", "_k"))
    return out.select(F.col("_run").alias(run), F.get("_c", F.col("_i")).alias("step_no"),
                      F.col("_k.ts").alias(ts), F.col("_k.tie").alias(tie), *[F.col(f"_k.{p}").alias(p) for p in payload])


def causal_flags(first_wrong: Column, first_target: Column, first_notice: Column) -> list[Column]:
    """E3 with strict comparisons: trap, conversion, correct-before-notice."""
    trap = first_wrong.isNotNull() & (first_notice.isNull() | (first_wrong < first_notice))
    converted = trap & first_notice.isNotNull() & first_target.isNotNull() & \
        (first_target > first_notice)
    correct = first_target.isNotNull() & (first_notice.isNull() | (first_target < first_notice))
    return [F.coalesce(trap, F.lit(False)).alias("entered_trap"),
            F.coalesce(converted, F.lit(False)).alias("converted"),
            F.coalesce(correct, F.lit(False)).alias("correct_before_notice")]


def pair_steps(ev: DataFrame, *, run: str, call_id: str, is_start: Column, is_end: Column,
               ts: str = "ts", tie: str = "event_id",
               payload: Sequence[str] = ()) -> DataFrame:
    """Each end takes the latest start with its call id since the last
    end of that id (a later start overwrites, an end consumes).  Unmatched
    ends get tool ``?`` and empty args; unmatched starts are dropped.

    The window is per (run, call id) -- a call id's own events -- so a hot
    run is spread over its many call ids.
    """
    e = ev.select(F.col(run).alias("run"), F.col(call_id).alias("call_id"),
                  F.col(ts).alias("ts"), F.col(tie).alias("tie"),
                  is_start.alias("is_start"), is_end.alias("is_end"), *payload)
    w = Window.partitionBy("run", "call_id").orderBy("ts", "tie")
    seg = F.sum(F.col("is_end").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) \
        - F.col("is_end").cast("int")
    e = e.withColumn("seg", seg)
    starts = e.where("is_start").groupBy("run", "call_id", "seg").agg(
        F.max_by(F.struct(*[F.col(p) for p in payload] or [F.lit(1).alias("_")]),
                 F.struct("ts", "tie")).alias("start"))
    ends = e.where("is_end")
    j = ends.join(starts, ["run", "call_id", "seg"], "left")
    return j.select("run", "call_id", "ts", "tie", F.col("start").isNotNull().alias("matched"),
                    *[F.col(f"start.{p}").alias(f"start_{p}") for p in payload],
                    *[F.col(p).alias(f"end_{p}") for p in payload])


def step_label(command: Column, path: Column, pattern: Column, args: Column) -> Column:
    """The first of command, path and pattern that is not empty, else the first
    120 characters of the arguments' JSON; all cut to 600 characters."""
    def full(c):
        return F.when(c != "", c)
    return F.substring(F.coalesce(full(command), full(path), full(pattern),
                                  F.substring(F.coalesce(args, F.lit("{}")), 1, 120)), 1, 600)


def usage_record(raw: Column) -> Column:
    """A usage JSON object as a record; equal records are equal whatever the order
    of their keys.  Missing fields are null."""
    return F.from_json(raw, "input bigint, output bigint, totalTokens bigint, cost struct<total: double>")


def model_names(text: Column) -> Column:
    """H1: every model name in ``models/(dir/)*name.sql`` paths of a text."""
    return F.regexp_extract_all(text, F.lit(MODEL_PATH_RE), 1)


def name_class(name: Column, declared: Sequence[str], targets: Sequence[str]) -> Column:
    """H2: skip ``stg_`` names and declared non-targets; else target / wrong.
    (``A or B and C`` in the reference binds as ``A or (B and C)``.)"""
    dec = F.array(*[F.lit(x) for x in declared]) if declared else F.array().cast("array<string>")
    tgt = F.array(*[F.lit(x) for x in targets]) if targets else F.array().cast("array<string>")
    skip = name.startswith("stg_") | (F.array_contains(dec, name) & ~F.array_contains(tgt, name))
    return F.when(skip, F.lit("skip")).when(F.array_contains(tgt, name), F.lit("target")) \
        .otherwise(F.lit("wrong"))


def is_error_result(is_error: Column, result: Column) -> Column:
    """Flagged error, or the lower-cased result mentions an error word."""
    low = F.lower(F.coalesce(result, F.lit("")))
    hit = F.lit(False)
    for w in ERROR_WORDS:
        hit = hit | low.contains(w)
    return F.coalesce(is_error, F.lit(False)) | hit


def is_dbt_call(tool: Column, command: Column) -> Column:
    """A bash call whose command mentions dbt (case-sensitive)."""
    return (tool == "bash") & F.coalesce(command, F.lit("")).contains("dbt")


def is_dbt_build(command: Column) -> Column:
    """Lower-cased command has dbt and (run or build)."""
    low = F.lower(F.coalesce(command, F.lit("")))
    return low.contains("dbt") & (low.contains("run") | low.contains("build"))


FALSY_JSON = ("null", '""', "[]", "{}", "false", "0")


def result_text(raw: Column, limit: int = 2000) -> Column:
    """A JSON string as is; else the first truthy of output / content /
    text: a list keeps its text parts (``{type: text}`` objects and bare
    strings) joined by newlines, a string is itself; otherwise the JSON text
    cut to ``limit``.  A missing result reads as ``{}``."""
    txt = F.coalesce(raw, F.lit("{}"))
    v = F.try_parse_json(txt)

    def field(k):
        return F.try_variant_get(v, f"$.{k}", "variant")

    def truthy(x):
        return x.isNotNull() & ~F.to_json(x).isin(*FALSY_JSON)

    is_obj = F.schema_of_variant(v).startswith("OBJECT")
    out = F.when(is_obj, F.coalesce(*[F.when(truthy(field(k)), field(k))
                                      for k in ("output", "content", "text")]))
    kind = F.schema_of_variant(out)
    items = F.try_variant_get(out, "$", "array<variant>")
    parts = F.filter(F.transform(items, lambda x: F.when(
        F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))
        .when(F.try_variant_get(x, "$.type", "string") == "text",
              F.coalesce(F.try_variant_get(x, "$.text", "string"), F.lit("")))),
        lambda x: x.isNotNull())
    return (F.when(v.isNull(), F.substring(txt, 1, limit))
            .when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
            .when(kind.startswith("ARRAY"), F.array_join(parts, "\n"))
            .when(kind == "STRING", F.try_variant_get(out, "$", "string"))
            .otherwise(F.substring(txt, 1, limit)))
