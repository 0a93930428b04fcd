"""Experiment report plans.

Trial rows (X2) join each expected run's record and validity (X1, A2), resolved
artifacts (H7), name gate (P4), listing of scored targets (A3, G3) and call
indices (E1-E3); their inputs are in :mod:`rampart.plans.trial_inputs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import names as N
from rampart.operators import reports as X
from rampart.operators import runs as R
from rampart.plans import trial_inputs as I
from rampart.plans.event_plans import TRAJ_CTE, causal_table
from rampart.plans.gate_plans import CHECK_CTE, OUTCOME_SQL, outcome_table
from rampart.plans.registry import query
from rampart.plans.run_plans import validity_table
from rampart.session import store
from rampart.sources.tables import load_tables


def resolved_paths(records: DataFrame) -> DataFrame:
    """H7: each run's trajectory and database, first existing of re-rooted, canonical, stored."""
    root = F.lit(I.ROOT)
    canonical = F.concat(root, F.lit("/"), F.col("exp"), F.lit("/_pi_meta/"), F.col("task"), F.lit("/trajectory.jsonl"))

    def candidates(name, more):
        stored = F.col(f"rec.{name}")
        return [F.struct(F.struct("user_id", F.lit(name).alias("artifact")).alias("key"), F.lit(i).alias("priority"), p.alias("path"))
                for i, p in enumerate([R.reroot(stored, F.col("exp"), root), *more, stored])]
    c = records.select(F.explode(F.array(*candidates("trajectory", [canonical]), *candidates("produced_db", []))).alias("c"))
    c = c.select("c.*").where("path is not null")
    found = R.resolve_first_existing(c, I.artifact_listing(records.where("tools is not null")), run="key")
    return found.groupBy("key.user_id").agg(*[
        F.max(F.when(F.col("key.artifact") == a, F.col("resolved"))).alias(a) for a in ("trajectory", "produced_db")])


def gate_parts(t, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gate verdict, listing of scored targets) per run of ``runs`` (user_id, task)."""
    spec = F.broadcast(I.spec_table(t.spark))   # a literal list
    spec = runs.join(spec, "task").select(F.col("user_id").alias("project"), "name", "shipped", "scored")
    shipped, wrote = spec.where("shipped"), I.written_models(t).withColumnRenamed("user_id", "project")
    cols = ["project", "name"]
    flags = store(N.name_flags(
        spec.select(*cols), shipped.select(*cols), shipped.select(*cols).unionByName(wrote.select(*cols)),
        shipped.select(*cols).unionByName(wrote.where("built").select(*cols))), "name-flags")
    run = F.col("project").alias("user_id")
    return (N.name_gate(flags).select(run, "status", "n_built_candidates"),
            N.scored_listing(spec.where("scored"), flags).select(run, "n_scored", "n_scored_built", "scored_built"))


def trial_rows_df(t) -> DataFrame:
    records = validity_table(t)
    gate, listing = gate_parts(t, records.select("user_id", "task"))
    indices = causal_table(t, {"n_missing_node_warn": F.col("event_type") == "signup"})
    return X.trial_rows(
        records.select("user_id", "task", "arm", "model"), records.select("user_id", "problem", "status", "score"),
        resolved_paths(records), gate, listing, indices, "user_id")


TRIAL_SQL = "WITH " + TRAJ_CTE + "," + I.INPUT_SQL + "," + I.GATE_SQL + """,
warn AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'signup') AS warn
         FROM events GROUP BY user_id),
trial0 AS (
  SELECT v.*, f.first_wrong, f.first_target, f.first_notice, w.warn, g.gate_status, g.n_built_candidates,
         l.n_scored, l.n_scored_built, l.scored_built,
         CASE WHEN record_problem IS NOT NULL THEN record_problem
              ELSE concat_ws('; ', CASE WHEN v.user_id % 31 = 0 THEN 'trajectory unresolved' END,
                             CASE WHEN v.user_id % 43 = 1 THEN 'produced database unresolved' END) END AS problems
  FROM validity v LEFT JOIN firsts f ON f.user_id = v.user_id
  LEFT JOIN warn w ON w.user_id = v.user_id LEFT JOIN gated g ON g.user_id = v.user_id
  LEFT JOIN listing l ON l.user_id = v.user_id),
flags AS (
  SELECT *, CASE WHEN record_problem IS NOT NULL THEN 'MISSING' WHEN problems <> '' THEN 'UNREADABLE' ELSE status END AS validity,
         problems = '' AS measured,
         coalesce(first_wrong IS NOT NULL AND (first_notice IS NULL OR first_wrong < first_notice),
                  false) AS trap,
         coalesce(first_wrong IS NOT NULL AND (first_notice IS NULL OR first_wrong < first_notice)
                  AND first_notice IS NOT NULL AND first_target IS NOT NULL
                  AND first_target > first_notice, false) AS conv,
         coalesce(first_target IS NOT NULL AND (first_notice IS NULL OR first_target < first_notice),
                  false) AS correct
  FROM trial0),
trial AS (
  SELECT user_id, task, arm, model, validity, problems,
         CASE WHEN measured THEN gate_status END AS gate_status,
         CASE WHEN measured THEN gate_status = 'violation' END AS wrong_name,
         CASE WHEN measured THEN n_built_candidates > 0 END AS target_built,
         CASE WHEN measured THEN scored_built END AS scored_built,
         CASE WHEN measured THEN n_scored > 0 AND n_scored = n_scored_built END AS scored_all_built,
         CASE WHEN measured THEN trap END AS entered_trap,
         CASE WHEN measured THEN conv END AS converted,
         CASE WHEN measured THEN correct END AS correct_before_notice,
         CASE WHEN record_problem IS NULL THEN score END AS score,
         CASE WHEN measured THEN warn END AS n_missing_node_warn
  FROM flags)
"""

TRIAL_COLS = ("user_id, task, arm, model, validity, problems, gate_status, wrong_name, target_built, scored_built, "
              "scored_all_built, entered_trap, converted, correct_before_notice, score, n_missing_node_warn")


@query("trial_rows", sql=TRIAL_SQL + f"SELECT {TRIAL_COLS} FROM trial")
def trial_rows(spark, sf_dir) -> DataFrame:
    return trial_rows_df(load_tables(spark, sf_dir))


ARM_AGG_SQL = """
count(*) AS total, count(*) FILTER (WHERE validity = 'VALID') AS valid,
count(*) FILTER (WHERE validity LIKE 'VOID%') AS void,
count(*) FILTER (WHERE validity IN ('UNREADABLE', 'MISSING')) AS unread,
count(*) FILTER (WHERE validity = 'VALID' AND wrong_name) AS wrong,
count(*) FILTER (WHERE validity = 'VALID' AND scored_all_built) AS scored_built,
count(*) FILTER (WHERE validity = 'VALID' AND entered_trap) AS trap,
count(*) FILTER (WHERE validity = 'VALID' AND converted) AS conv,
count(*) FILTER (WHERE validity = 'VALID' AND score = 1) AS passed
"""
ARM_RATES_SQL = """
CASE WHEN valid > 0 THEN wrong / valid END AS wrong_rate,
CASE WHEN trap > 0 THEN conv / trap END AS conv_per_trap,
CASE WHEN valid > 0 THEN conv / valid END AS conv_per_trial,
CASE WHEN valid > 0 THEN passed / valid END AS pass_rate,
valid = 0 AS no_valid_trials
"""


@query("arm_table", sql=TRIAL_SQL + f"""
SELECT *, {ARM_RATES_SQL} FROM (SELECT arm, {ARM_AGG_SQL} FROM trial GROUP BY arm)
""")
def arm_table(spark, sf_dir) -> DataFrame:
    return X.arm_table(trial_rows(spark, sf_dir))


@query("arm_table_pooled", sql=TRIAL_SQL + f"""
SELECT *, {ARM_RATES_SQL} FROM (
  SELECT task, arm, grouping(task) = 1 AS pooled, {ARM_AGG_SQL}
  FROM trial GROUP BY GROUPING SETS ((task, arm), (arm)))
""")
def arm_table_pooled(spark, sf_dir) -> DataFrame:
    return X.arm_table_pooled(trial_rows(spark, sf_dir))


@query("baseline_signal", sql=TRIAL_SQL + """
SELECT task, count(*) AS base_valid, count(*) FILTER (WHERE n_missing_node_warn > 0) AS with_warning,
       count(*) FILTER (WHERE n_missing_node_warn > 0 AND converted) AS warned_converted
FROM trial WHERE validity = 'VALID' AND arm = 'off' GROUP BY ROLLUP (task)
""")
def baseline_signal(spark, sf_dir) -> DataFrame:
    return X.baseline_signal(trial_rows(spark, sf_dir))


@query("overfit_flag", sql=TRIAL_SQL + """,
s AS (
  SELECT task,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'generic') AS generic_n,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'generic' AND entered_trap) AS generic_trap,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'generic' AND converted) AS generic_conv,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'generic' AND wrong_name) AS generic_wrong,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'specific') AS specific_n,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'specific' AND entered_trap) AS specific_trap,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'specific' AND converted) AS specific_conv,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'specific' AND wrong_name) AS specific_wrong,
         count(*) FILTER (WHERE validity = 'VALID' AND arm = 'off' AND entered_trap) AS off_trap
  FROM trial GROUP BY task),
r AS (
  SELECT *,
    coalesce(CASE WHEN specific_trap > 0 THEN specific_conv / specific_trap END
             < CASE WHEN generic_trap > 0 THEN generic_conv / generic_trap END, false) AS wc,
    coalesce(specific_wrong / specific_n > generic_wrong / generic_n, false) AS ww
  FROM s),
st AS (
  SELECT *, CASE WHEN generic_n = 0 OR specific_n = 0 THEN 'not-reported:no-valid'
                 WHEN generic_trap + specific_trap + off_trap = 0 THEN 'not-reported:no-trap'
                 WHEN generic_conv = 0 AND specific_conv = 0 THEN 'not-reported:no-conversion'
                 WHEN wc OR ww THEN 'overfit' ELSE 'ok' END AS status
  FROM r)
SELECT task, status, CASE WHEN status = 'overfit' THEN wc END AS worse_conversion,
       CASE WHEN status = 'overfit' THEN ww END AS worse_wrong_name,
       generic_trap, generic_conv, specific_trap, specific_conv
FROM st
""")
def overfit_flag(spark, sf_dir) -> DataFrame:
    return X.overfit_flag(trial_rows(spark, sf_dir))


@query("not_counted", sql=TRIAL_SQL + """,
tasks AS (SELECT task, bool_and(validity = 'MISSING') AS skipped, bool_or(validity = 'UNREADABLE') AS unread
          FROM trial GROUP BY task),
batch AS (SELECT CASE WHEN bool_and(skipped) THEN 'error' WHEN bool_or(NOT skipped AND unread) THEN 'failure' ELSE 'ok' END AS s
          FROM tasks)
SELECT user_id, task, validity, problems AS reason,
       CASE WHEN skipped THEN 'skipped' ELSE 'reported' END AS task_status, batch.s AS batch_status
FROM trial JOIN tasks USING (task) CROSS JOIN batch WHERE validity IN ('UNREADABLE', 'MISSING')
""")
def not_counted(spark, sf_dir) -> DataFrame:
    """What was excluded from every denominator, and why."""
    return X.not_counted(trial_rows(spark, sf_dir), "user_id")


# ---------------------------------------------------------------------------
# Run summary (X7, D9), model summary (D16), funnel (X10), cross-model tag
# ---------------------------------------------------------------------------

def run_metrics(t) -> DataFrame:
    """Per run: cost (sum of purchase values), wall seconds, edits, turns."""
    e = t.events
    typ = F.col("event_type")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.groupBy("user_id").agg(
        F.sum(F.when(typ == "purchase", F.col("value")).otherwise(0.0)).alias("cost"),
        ((F.max(micros) - F.min(micros)) / 1e6).alias("wall_s"),
        F.count_if(typ.isin("click", "purchase")).alias("edits"),
        F.count_if(typ == "view").alias("turns"))


METRICS_SQL = """,
metrics AS (
  SELECT user_id, sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS cost,
         (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS wall_s,
         count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS edits,
         count(*) FILTER (WHERE event_type = 'view') AS turns
  FROM events GROUP BY user_id)
"""


# every expected run with its record's score, its log's metrics and its checks' outcome
SUMMARY_SQL = "WITH " + I.INPUT_SQL + "," + CHECK_CTE + OUTCOME_SQL + METRICS_SQL + """,
summary AS (
  SELECT v.user_id, v.arm, CASE WHEN v.record_problem IS NULL THEN v.score END AS score, m.cost, m.wall_s,
         coalesce(c.has_checks, false) AS has_checks, coalesce(c.fired, false) AS fired,
         coalesce(c.fired_reason, 'no-policy-or-no-settle') AS fired_reason,
         coalesce(c.retries_used, 0) AS retries_used, coalesce(c.dfc_class, 'no-policy') AS dfc_class
  FROM validity v LEFT JOIN metrics m ON m.user_id = v.user_id LEFT JOIN classed c ON c.user_id = v.user_id)
"""


def summary_rows(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    out = outcome_table(spark, sf_dir).drop("first_status", "last_status")
    j = validity_table(t).select("user_id", "arm", "score").join(run_metrics(t), "user_id", "left") \
        .join(out, "user_id", "left")
    return j.fillna({"has_checks": False, "fired": False, "fired_reason": "no-policy-or-no-settle",
                     "retries_used": 0, "dfc_class": "no-policy"})


@query("run_summary", sql=SUMMARY_SQL + """
SELECT arm, count(*) AS runs, count(score) AS scored, count(*) FILTER (WHERE score = 1) AS passed,
       CASE WHEN count(score) > 0 THEN count(*) FILTER (WHERE score = 1) / count(score) END AS pass_rate,
       round(sum(coalesce(cost, 0)), 2) AS cost_total,
       round(sum(coalesce(cost, 0)) / greatest(count(*), 1), 4) AS cost_mean,
       round(sum(wall_s) FILTER (WHERE wall_s > 0), 1) AS wall_total,
       round(avg(wall_s) FILTER (WHERE wall_s > 0), 2) AS wall_mean,
       count(*) FILTER (WHERE has_checks) AS policy_runs, count(*) FILTER (WHERE fired) AS fired,
       count(*) FILTER (WHERE fired AND score = 1) AS fired_scored_1,
       count(*) FILTER (WHERE fired AND coalesce(score, 0) <> 1) AS fired_scored_0
FROM summary GROUP BY arm
""")
def run_summary(spark, sf_dir) -> DataFrame:
    """D9, X7 per arm: pass rate over scored runs only; cost mean over all rows; wall
    total and mean over truthy (positive, non-null) values; how many runs with checks
    fired, and what those scored."""
    j = summary_rows(spark, sf_dir)
    truthy, passed = F.col("wall_s") > 0, F.coalesce(F.col("score") == 1, F.lit(False))
    return j.groupBy("arm").agg(
        F.count(F.lit(1)).alias("runs"), F.count("score").alias("scored"), F.count_if(passed).alias("passed"),
        F.when(F.count("score") > 0, F.count_if(passed) / F.count("score")).alias("pass_rate"),
        F.round(F.sum(F.coalesce("cost", F.lit(0.0))), 2).alias("cost_total"),
        F.round(F.sum(F.coalesce("cost", F.lit(0.0))) / F.greatest(F.count(F.lit(1)), F.lit(1)), 4)
         .alias("cost_mean"),
        F.round(F.sum(F.when(truthy, F.col("wall_s"))), 1).alias("wall_total"),
        F.round(F.avg(F.when(truthy, F.col("wall_s"))), 2).alias("wall_mean"),
        F.count_if("has_checks").alias("policy_runs"), F.count_if("fired").alias("fired"),
        F.count_if(F.col("fired") & passed).alias("fired_scored_1"),
        F.count_if(F.col("fired") & ~passed).alias("fired_scored_0"))


@query("class_histogram", sql=SUMMARY_SQL + """,
parts AS (
  SELECT arm, 'class' AS part, substring(dfc_class, 1, 26) AS value FROM summary
  UNION ALL SELECT arm, 'fired', CASE WHEN fired THEN 'fired' ELSE 'not fired' END FROM summary WHERE has_checks
  UNION ALL SELECT arm, 'never-fired', fired_reason FROM summary WHERE has_checks AND NOT fired
  UNION ALL SELECT arm, 'outcome', CASE WHEN score = 1 THEN 'scored 1' ELSE 'scored 0' END FROM summary WHERE fired
  UNION ALL SELECT arm, 'retries', CAST(retries_used AS VARCHAR) FROM summary WHERE fired)
SELECT arm, part, value, count(*) AS runs FROM parts GROUP BY arm, part, value
""")
def class_histogram(spark, sf_dir) -> DataFrame:
    """Classes, fired split, reasons, outcomes and retry counts per arm."""
    return X.outcome_histograms(summary_rows(spark, sf_dir), ["arm"])


@query("model_summary", sql=TRIAL_SQL + METRICS_SQL + """
SELECT model, count(*) AS runs, round(avg(wall_s), 2) AS avg_wall, round(avg(edits), 4) AS avg_edits,
       round(avg(turns), 4) AS avg_turns, round(sum(cost), 2) AS total_cost,
       round(avg(cost), 4) AS avg_cost
FROM trial JOIN metrics USING (user_id) GROUP BY model
""")
def model_summary(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    j = trial_rows_df(t).join(run_metrics(t), "user_id")
    return j.groupBy("model").agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.avg("wall_s"), 2).alias("avg_wall"),
        F.round(F.avg("edits"), 4).alias("avg_edits"), F.round(F.avg("turns"), 4).alias("avg_turns"),
        F.round(F.sum("cost"), 2).alias("total_cost"), F.round(F.avg("cost"), 4).alias("avg_cost"))


@query("success_funnel", sql=TRIAL_SQL + """
SELECT model, count(*) AS runs, count(*) FILTER (WHERE validity = 'VALID') AS artifact_ok,
       count(*) FILTER (WHERE validity = 'VALID' AND target_built) AS target_built,
       count(*) FILTER (WHERE validity = 'VALID' AND target_built AND score = 1) AS passed
FROM trial GROUP BY model
""")
def success_funnel(spark, sf_dir) -> DataFrame:
    r = trial_rows(spark, sf_dir)
    ok = F.col("validity") == "VALID"
    built = ok & F.col("target_built")
    return r.groupBy("model").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(ok).alias("artifact_ok"),
        F.count_if(built).alias("target_built"),
        F.count_if(built & (F.col("score") == 1)).alias("passed"))


@query("cross_model_tag", sql=TRIAL_SQL + """,
per AS (
  SELECT task,
         coalesce(bool_or(score = 1) FILTER (WHERE model = 'larger' AND validity = 'VALID'), false) AS lp,
         coalesce(bool_or(score = 1) FILTER (WHERE model = 'smaller' AND validity = 'VALID'), false) AS sp,
         coalesce(bool_or(wrong_name) FILTER (WHERE model = 'larger' AND validity = 'VALID'), false) AS lw,
         coalesce(bool_or(wrong_name) FILTER (WHERE model = 'smaller' AND validity = 'VALID'), false) AS sw
  FROM trial GROUP BY task)
SELECT task, lp AS larger_pass, sp AS smaller_pass,
       CASE WHEN lp AND sp THEN 'both-pass' WHEN lp OR sp THEN 'one-model-gap'
            WHEN lw <> sw THEN 'different-failure' ELSE 'same-failure' END AS tag
FROM per
""")
def cross_model_tag(spark, sf_dir) -> DataFrame:
    r = trial_rows(spark, sf_dir)
    ok = F.col("validity") == "VALID"

    def flag(model, cond):
        return F.coalesce(F.bool_or(F.when(ok & (F.col("model") == model), cond)), F.lit(False))

    per = r.groupBy("task").agg(
        flag("larger", F.col("score") == 1).alias("larger_pass"),
        flag("smaller", F.col("score") == 1).alias("smaller_pass"),
        flag("larger", F.col("wrong_name")).alias("lw"),
        flag("smaller", F.col("wrong_name")).alias("sw"))
    lp, sp = F.col("larger_pass"), F.col("smaller_pass")
    tag = (F.when(lp & sp, "both-pass").when(lp | sp, "one-model-gap")
           .when(F.col("lw") != F.col("sw"), "different-failure").otherwise("same-failure"))
    return per.select("task", "larger_pass", "smaller_pass", tag.alias("tag"))


@query("base_rate", sql=TRIAL_SQL + """
SELECT task AS batch, count(*) FILTER (WHERE wrong_name) AS events, count(*) AS trials
FROM trial WHERE validity = 'VALID' GROUP BY ROLLUP (task)
""")
def base_rate(spark, sf_dir) -> DataFrame:
    """Wrong-name events over VALID trials per batch and pooled."""
    r = trial_rows(spark, sf_dir).where(F.col("validity") == "VALID")
    return r.rollup(F.col("task").alias("batch")).agg(
        F.count_if("wrong_name").alias("events"), F.count(F.lit(1)).alias("trials"))


# ---------------------------------------------------------------------------
# X11 firing breakdown: which policies fired per run, and in what order
# ---------------------------------------------------------------------------
STACK = ("namegate", "discount", "enum")


@query("firing_breakdown", sql="""
WITH fires AS (
  SELECT user_id,
         list_extract(['namegate', 'discount', 'enum'],
                      CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS INTEGER) + 1) AS policy,
         ts, event_id
  FROM events WHERE event_type = 'error'),
firsts AS (SELECT user_id, policy, min((ts, event_id)) AS k FROM fires GROUP BY user_id, policy),
per AS (SELECT user_id, string_agg(policy, '+' ORDER BY policy) AS fired_set,
               string_agg(policy, '>' ORDER BY k) AS handoff, count(*) AS n_policies
        FROM firsts GROUP BY user_id)
SELECT fired_set, handoff, n_policies, count(*) AS runs FROM per GROUP BY ALL
""")
def firing_breakdown(spark, sf_dir) -> DataFrame:
    e = load_tables(spark, sf_dir).events.where(F.col("event_type") == "error")
    k = F.get_json_object("props", "$.k").cast("bigint")
    fires = e.select("user_id", F.element_at(F.array(*[F.lit(p) for p in STACK]),
                                             (F.pmod(k, F.lit(3)) + 1).cast("int")).alias("policy"),
                     F.struct("ts", "event_id").alias("k"))
    # One row per (run, policy) first; the per-run lists are then bounded by
    # the stack length.
    firsts = fires.groupBy("user_id", "policy").agg(F.min("k").alias("k"))
    per = firsts.groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_list("policy")), "+").alias("fired_set"),
        X.ordered_join(F.col("policy"), F.col("k"), ">").alias("handoff"),
        F.count(F.lit(1)).alias("n_policies"))
    return per.groupBy("fired_set", "handoff", "n_policies").agg(F.count(F.lit(1)).alias("runs"))


# ---------------------------------------------------------------------------
# Per-task record files (JSON partitioned by task), written and read back
# ---------------------------------------------------------------------------

@query("sink_roundtrip", sql=TRIAL_SQL + f"SELECT {TRIAL_COLS} FROM trial")
def sink_roundtrip(spark, sf_dir) -> DataFrame:
    """The trial rows written as JSON records, one folder per task, into a
    fresh folder under the session's checkpoint dir, then read back with the
    written schema.  Must equal ``trial_rows``."""
    import uuid

    from rampart.session import ensure_checkpoint_dir
    from rampart.sources import sinks

    rows = trial_rows_df(load_tables(spark, sf_dir))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/records/trials-{uuid.uuid4().hex}"
    sinks.write_records(rows, path, fmt="json", partition_by=["task"])
    back = sinks.read_records(spark, path, fmt="json", schema=rows.schema)
    return back.select(*rows.columns)
