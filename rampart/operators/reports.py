"""Experiment reports over trial rows.

A trial row carries ``validity`` (VALID / VOID_* / UNREADABLE / MISSING) and
the measured flags.  Denominators follow the reference: MISSING and
UNREADABLE rows count in an arm's total but in no rate; an arm without a
VALID row is reported as such (its rates are null, never 0); a zero trap
count makes conversions-per-trap null ("n/a").  Everything is a grouped
aggregate; pooling is a grouping set, not a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.operators.events import causal_flags

VALID = "VALID"
NOT_READ = ("MISSING", "UNREADABLE")


def _valid() -> Column:
    return F.col("validity") == VALID


def trial_rows(grid: DataFrame, records: DataFrame, paths: DataFrame, gate: DataFrame,
               listing: DataFrame, indices: DataFrame, run: str) -> DataFrame:
    """One row per expected run, joined from its parts; every part that could not
    be read adds its cause to ``problems``.

    ``records`` has ``problem`` (no usable record), ``status`` (X1) and the record's
    facts; ``paths`` the resolved ``trajectory`` and ``produced_db`` (null: not found);
    ``gate`` the name gate's ``status`` and ``n_built_candidates``; ``listing`` how many
    scored targets there are and which were built; ``indices`` the first call indices
    and ``n_missing_node_warn``.  A run without a record is MISSING; with any other
    cause it is UNREADABLE and nothing is measured.  The record's own facts (score,
    tokens) stay on such a row, but no rate counts it.
    """
    gate = gate.select(run, F.col("status").alias("gate_status"), "n_built_candidates", F.lit(True).alias("_gate"))
    listing = listing.select(run, "n_scored", "n_scored_built", "scored_built", F.lit(True).alias("_list"))
    indices = indices.select(run, "first_wrong", "first_target", "first_notice", "n_missing_node_warn",
                             F.lit(True).alias("_scan"))
    j = grid
    for part in (records, paths, gate, listing, indices):
        j = j.join(part, run, "left")
    found = F.col("trajectory").isNotNull() & F.col("produced_db").isNotNull()
    causes = F.array(
        F.when(F.col("trajectory").isNull(), F.lit("trajectory unresolved")),
        F.when(F.col("produced_db").isNull(), F.lit("produced database unresolved")),
        F.when(found & F.col("_gate").isNull(), F.lit("name gate could not read the database")),
        F.when(found & F.col("_list").isNull(), F.lit("no table listing")),
        F.when(found & F.col("_scan").isNull(), F.lit("trajectory not readable")))
    problems = F.when(F.col("problem").isNotNull(), F.array("problem")).otherwise(F.filter(causes, lambda c: c.isNotNull()))
    j = j.withColumn("problems", problems)
    validity = (F.when(F.col("problem").isNotNull(), "MISSING").when(F.size("problems") > 0, "UNREADABLE")
                .otherwise(F.col("status")))
    fw, ft, fn = F.col("first_wrong"), F.col("first_target"), F.col("first_notice")
    trap, conv, correct = causal_flags(fw, ft, fn)
    built = (F.col("n_scored") > 0) & (F.col("n_scored_built") == F.col("n_scored"))

    def m(x, name):
        return F.when(~validity.isin(*NOT_READ), x).alias(name)
    return j.select(
        *grid.columns, validity.alias("validity"), F.array_join("problems", "; ").alias("problems"),
        m(F.col("gate_status"), "gate_status"), m(F.col("gate_status") == "violation", "wrong_name"),
        m(F.col("n_built_candidates") > 0, "target_built"), m(F.col("scored_built"), "scored_built"),
        m(built, "scored_all_built"), m(trap, "entered_trap"), m(conv, "converted"),
        m(correct, "correct_before_notice"), "score", m(F.col("n_missing_node_warn"), "n_missing_node_warn"))


def not_counted(rows: DataFrame, run: str) -> DataFrame:
    """The rows that no denominator holds, with their causes; per task whether it
    is reported (``skipped``: every run of it is missing), and for the batch ``failure``
    if a run of a reported task is unreadable, ``error`` if no task is reported (an
    empty result, not a zero one), else ``ok``."""
    missing, unread = F.col("validity") == "MISSING", F.col("validity") == "UNREADABLE"
    tasks = rows.groupBy("task").agg(F.bool_and(missing).alias("skipped"), F.bool_or(unread).alias("unread"))
    batch = tasks.agg(F.when(F.coalesce(F.bool_and("skipped"), F.lit(True)), "error")
                      .when(F.bool_or(~F.col("skipped") & F.col("unread")), "failure").otherwise("ok").alias("batch_status"))
    out = rows.where(missing | unread).join(tasks, "task")
    # one row, whatever the input: its status goes to every listed row
    return out.withColumn("_one", F.lit(1)).join(F.broadcast(batch.withColumn("_one", F.lit(1))), "_one").select(
        run, "task", "validity", F.col("problems").alias("reason"),
        F.when(F.col("skipped"), "skipped").otherwise("reported").alias("task_status"), "batch_status")


def arm_aggregates() -> list[Column]:
    v = _valid()
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(v).alias("valid"),
        F.count_if(F.col("validity").startswith("VOID")).alias("void"),
        F.count_if(F.col("validity").isin("UNREADABLE", "MISSING")).alias("unread"),
        F.count_if(v & F.col("wrong_name")).alias("wrong"),
        F.count_if(v & F.col("scored_all_built")).alias("scored_built"),
        F.count_if(v & F.col("entered_trap")).alias("trap"),
        F.count_if(v & F.col("converted")).alias("conv"),
        F.count_if(v & (F.col("score") == 1)).alias("passed"),
    ]


def arm_rates() -> list[Column]:
    valid, trap = F.col("valid"), F.col("trap")
    return [
        F.when(valid > 0, F.col("wrong") / valid).alias("wrong_rate"),
        F.when(trap > 0, F.col("conv") / trap).alias("conv_per_trap"),
        F.when(valid > 0, F.col("conv") / valid).alias("conv_per_trial"),
        F.when(valid > 0, F.col("passed") / valid).alias("pass_rate"),
        (valid == 0).alias("no_valid_trials"),
    ]


def arm_table(rows: DataFrame, by: Sequence[str] = ("arm",)) -> DataFrame:
    """One row per arm (or per ``by`` group)."""
    return rows.groupBy(*by).agg(*arm_aggregates()).select("*", *arm_rates())


def arm_table_pooled(rows: DataFrame, task: str = "task", arm: str = "arm") -> DataFrame:
    """Per (task, arm) and pooled per arm in one grouping-sets aggregate;
    ``task`` is null on pooled rows and ``pooled`` marks them."""
    return (rows.groupingSets([[task, arm], [arm]], task, arm)
            .agg((F.grouping(task) == 1).alias("pooled"), *arm_aggregates())
            .select("*", *arm_rates()))


def baseline_signal(rows: DataFrame, group: str = "task", base_arm: str = "off") -> DataFrame:
    """Among VALID baseline runs, how many saw the tool's own warning,
    and how many of those converted; per group and pooled (rollup)."""
    base = rows.where(_valid() & (F.col("arm") == base_arm))
    warn = F.col("n_missing_node_warn") > 0
    return base.rollup(group).agg(
        F.count(F.lit(1)).alias("base_valid"),
        F.count_if(warn).alias("with_warning"),
        F.count_if(warn & F.col("converted")).alias("warned_converted"))


def overfit_flag(rows: DataFrame, group: str = "task") -> DataFrame:
    """Is the specific arm worse than the generic arm?

    Not reported when either arm lacks VALID rows, when no arm entered the
    trap, or when neither nudge arm converted; otherwise flagged when the
    specific arm's conversion rate is lower or its wrong-name rate higher."""
    v = _valid()

    def stats(a: str) -> list[Column]:
        m = v & (F.col("arm") == a)
        return [F.count_if(m).alias(f"{a}_n"), F.count_if(m & F.col("entered_trap")).alias(f"{a}_trap"),
                F.count_if(m & F.col("converted")).alias(f"{a}_conv"),
                F.count_if(m & F.col("wrong_name")).alias(f"{a}_wrong")]

    agg = rows.groupBy(group).agg(*stats("generic"), *stats("specific"), *stats("off"))
    c = F.col
    g_rate = F.when(c("generic_trap") > 0, c("generic_conv") / c("generic_trap"))
    s_rate = F.when(c("specific_trap") > 0, c("specific_conv") / c("specific_trap"))
    g_wr = c("generic_wrong") / c("generic_n")
    s_wr = c("specific_wrong") / c("specific_n")
    worse_conv = F.coalesce(s_rate < g_rate, F.lit(False))
    worse_wrong = F.coalesce(s_wr > g_wr, F.lit(False))
    status = (F.when((c("generic_n") == 0) | (c("specific_n") == 0), F.lit("not-reported:no-valid"))
              .when(c("generic_trap") + c("specific_trap") + c("off_trap") == 0,
                    F.lit("not-reported:no-trap"))
              .when((c("generic_conv") == 0) & (c("specific_conv") == 0),
                    F.lit("not-reported:no-conversion"))
              .when(worse_conv | worse_wrong, F.lit("overfit"))
              .otherwise(F.lit("ok")))
    return agg.select(group, status.alias("status"),
                      F.when(status == "overfit", worse_conv).alias("worse_conversion"),
                      F.when(status == "overfit", worse_wrong).alias("worse_wrong_name"),
                      "generic_trap", "generic_conv", "specific_trap", "specific_conv")


def outcome_histograms(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., part, value, runs) from one pass over ``rows`` with dfc_class,
    has_checks, fired, fired_reason, retries_used and score.

    Parts: ``class`` of every run (26 characters), ``fired`` of the runs with
    checks, ``never-fired`` reasons of those that never did, and ``outcome`` and
    ``retries`` of those that did (any score but 1 counts as 0).
    """
    fired = F.col("has_checks") & F.col("fired")

    def item(cond, part, value):
        return F.when(cond, F.struct(F.lit(part).alias("part"), value.cast("string").alias("value")))
    items = F.array(
        item(F.lit(True), "class", F.substring("dfc_class", 1, 26)),
        item(F.col("has_checks"), "fired", F.when(F.col("fired"), "fired").otherwise("not fired")),
        item(F.col("has_checks") & ~F.col("fired"), "never-fired", F.col("fired_reason")),
        item(fired, "outcome", F.when(F.col("score") == 1, "scored 1").otherwise("scored 0")),
        item(fired, "retries", F.col("retries_used")))
    return rows.select(*by, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("x")) \
        .groupBy(*by, "x.part", "x.value").agg(F.count(F.lit(1)).alias("runs"))


def termination(finished: Column, steps: Column, cap: int) -> Column:
    """Clean-terminate / hit-cap / error-other (null-safe)."""
    return (F.when(finished.eqNullSafe(F.lit(True)), F.lit("clean-terminate"))
            .when(steps.isNotNull() & (steps >= cap), F.lit("hit-cap"))
            .otherwise(F.lit("error/other")))


def ordered_join(items: Column, order: Column, sep: str = "; ") -> Column:
    """D14 aggregate: strings joined in ``order`` (for bounded groups only)."""
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("o"), items.alias("s"))))
    return F.array_join(F.transform(pairs, lambda x: x["s"]), sep)
