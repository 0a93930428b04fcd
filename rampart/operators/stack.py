"""Policy stacking (P5), the retry loop over a verdict log (P6) and the
outcome classes read from it (P7, P8).

All three are grouped aggregates over a verdict log; none needs a window over
a whole run.  The stack's per-group collections hold at most one entry per
stacked policy (the stack is a short, validated driver-side list).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.operators.skew import SALT, join_per_group
from rampart.session import store
from rampart.operators.verdict import ERROR, PASS, VIOLATION


def validate_stack(names: Sequence[str], known: Sequence[str]) -> list[str]:
    """Reject an empty list, unknown names and duplicates (order kept)."""
    names = [n.strip() for n in names if n and n.strip()]
    if not names:
        raise ValueError("empty policy list")
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown policy {unknown[0]!r} (known: {', '.join(known)})")
    if len(names) != len(set(names)):
        raise ValueError(f"policy listed twice: {names}")
    return names


def stack_verdicts(log: DataFrame, group: str | Sequence[str] = "run") -> DataFrame:
    """Fold ``(group.., policy, ord, status, checked_rows, message)`` rows.

    Left to right, the first violation wins and evaluation stops there; an
    error never masks a later policy; if every policy errored the first error
    is reported; otherwise pass with summed ``checked_rows`` and the messages
    joined by ``; `` in stack order.
    """
    keys = [group] if isinstance(group, str) else list(group)
    s = F.col("status")
    info = F.struct(F.col("policy"), F.col("checked_rows"), F.col("message"))
    agg = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(s == ERROR).alias("n_error"),
        F.min(F.when(s == VIOLATION, F.col("ord"))).alias("viol_ord"),
        F.min_by(info, F.when(s == VIOLATION, F.col("ord"))).alias("viol"),
        F.min_by(info, F.col("ord")).alias("first"),
        F.sum(F.coalesce(F.col("checked_rows"), F.lit(0))).alias("sum_checked"),
        F.sort_array(F.collect_list(F.struct(
            F.col("ord"), F.col("policy"),
            F.concat_ws(": ", F.col("policy"), F.col("message")).alias("m")))).alias("items"),
    )
    viol = F.col("viol_ord").isNotNull()
    all_err = F.col("n_error") == F.col("n")
    status = F.when(viol, F.lit(VIOLATION)).when(all_err, F.lit(ERROR)).otherwise(F.lit(PASS))
    single = F.col("n") == 1
    policy = (F.when(viol, F.col("viol.policy")).when(all_err | single, F.col("first.policy"))
              .otherwise(F.array_join(F.transform("items", lambda x: x["policy"]), "+")))
    evaluated = F.when(viol, F.size(F.filter("items", lambda x: x["ord"] <= F.col("viol_ord")))) \
        .otherwise(F.col("n"))
    checked = (F.when(viol, F.col("viol.checked_rows")).when(all_err, F.col("first.checked_rows"))
               .otherwise(F.col("sum_checked")))
    message = (F.when(viol, F.col("viol.message")).when(all_err | single, F.col("first.message"))
               .otherwise(F.array_join(F.transform("items", lambda x: x["m"]), "; ")))
    return agg.select(*keys, status.alias("status"), policy.alias("policy"),
                      evaluated.cast("bigint").alias("evaluated"),
                      checked.cast("bigint").alias("checked_rows"), message.alias("message"))


def _before(ts: Column, eid: Column, ts0: Column, eid0: Column) -> Column:
    return (ts < ts0) | ((ts == ts0) & (eid < eid0))


def retry_trace(checks: DataFrame, run: str = "run", ts: str = "ts", tie: str = "event_id",
                status: str = "status", cap: int = 3) -> DataFrame:
    """Replay check -> (violation -> retry -> recheck)* until a pass or an
    error, the end of the log, or ``cap`` retries.

    Every check before the stopping one is a violation by construction, so
    the round list is ``violation`` x retries followed by the final status.
    The stopping position is a count of the checks ordered before the first
    non-violation: a grouped min, a join of one threshold row per run (a hot run
    salted by its size) and a count per (run, salt), then per run -- no window.
    """
    c = checks.select(F.col(run).alias("run"), F.col(ts).alias("ts"),
                      F.col(tie).alias("tie"), F.col(status).alias("status"))
    firsts = c.groupBy("run").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.min(F.when(F.col("status") != VIOLATION, F.struct("ts", "tie", "status")))
         .alias("stop"))
    firsts = store(firsts, "firsts")
    with_stop = join_per_group(c, firsts.where("stop is not null"), ["run"], ["ts", "tie"], "n_checks")
    before = with_stop.where(_before(
        F.col("ts"), F.col("tie"), F.col("stop.ts"), F.col("stop.tie"))) \
        .groupBy("run", SALT).agg(F.count(F.lit(1)).alias("n_before")) \
        .groupBy("run").agg(F.sum("n_before").alias("n_before"))
    t = firsts.join(before, "run", "left")
    k = F.coalesce(F.col("n_before"), F.lit(0)) + 1
    has_stop = F.col("stop").isNotNull()
    used = F.when(has_stop, F.least(k, F.lit(cap + 1))).otherwise(
        F.least(F.col("n_checks"), F.lit(cap + 1)))
    final = F.when(has_stop & (k <= cap + 1), F.col("stop.status")).otherwise(F.lit(VIOLATION))
    retries = used - 1
    out = t.select(
        F.col("run").alias(run),
        F.col("n_checks").cast("bigint").alias("n_checks"),
        used.cast("bigint").alias("checks_used"),
        retries.cast("bigint").alias("retries_used"),
        final.alias("final_status"),
        ((final == VIOLATION) & (used == cap + 1)).alias("cap_hit"),
        F.array_join(F.concat(F.array_repeat(F.lit(VIOLATION), retries.cast("int")),
                              F.array(final)), ",").alias("rounds"),
    )
    return out


def fired_reason(first_status: Column, first_message: Column) -> Column:
    """Why (or whether) the checker had anything to evaluate."""
    msg = F.coalesce(first_message, F.lit(""))
    return (F.when(first_status.isNull(), F.lit("no-policy-or-no-settle"))
            .when(first_status.isin(VIOLATION, PASS), first_status)
            .when(msg.contains("not materialized"), F.lit("no-target-table"))
            .when(msg.contains("missing from produced DB"), F.lit("missing-source-table"))
            .when(msg.contains("no discount rows"), F.lit("no-discount-rows"))
            .otherwise(F.concat(F.lit("error: "), F.substring(msg, 1, 40))))


def policy_class(first_status: Column, last_status: Column, retries: Column,
                 reason: Column) -> Column:
    """No-policy / passed-first-try / never-fired(reason) /
    fixed-after-N-retry / cap-hit-still-<last>."""
    return (F.when(first_status.isNull(), F.lit("no-policy"))
            .when(first_status == PASS, F.lit("passed-first-try"))
            .when(first_status == ERROR, F.concat(F.lit("never-fired("), reason, F.lit(")")))
            .when(last_status == PASS, F.concat(F.lit("fixed-after-"), retries.cast("string"),
                                               F.lit("-retry")))
            .otherwise(F.concat(F.lit("cap-hit-still-"), last_status)))
