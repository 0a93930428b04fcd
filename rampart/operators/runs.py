"""Run selection, validity and artifact resolution (A2, A7, B9-B12, B16, C4, C6,
E9, H6, H7, H14, H16, H18, X1).

All of these are expressions or grouped folds over run/record/path tables;
the small dimensions (arms, kinds, markers) are literal arrays, never joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
ARMS = ("off", "generic", "specific")
# Task-id prefix -> task kind, tested in this order; anything else is dbt.
KIND_PREFIXES = (("bq", "bq"), ("ga", "bq"), ("local", "local"), ("sf", "sf"),
                 ("ch0", "ch"), ("postgres", "pg"))
# Transport-failure markers searched on error-message lines.
NET_MARKERS = (
    "ENOTFOUND", "getaddrinfo", "EAI_AGAIN", "ECONNRESET", "ECONNREFUSED",
    "ETIMEDOUT", "pending stream has been canceled", "socket hang up",
    "Could not connect to the endpoint URL", "EPIPE",
)
# ---------------------------------------------------------------------------


def task_kind(task_id: Column) -> Column:
    """Kind by id prefix, first match wins."""
    out = F.lit("dbt")
    for prefix, kind in reversed(KIND_PREFIXES):
        out = F.when(task_id.startswith(prefix), F.lit(kind)).otherwise(out)
    return out


def select_tasks(task_id: Column, idx: Column, *, name: str | None = None,
                 indices: Sequence[int] | None = None,
                 index_range: tuple[int, int] | None = None) -> Column:
    """Substring of the id, else an index list, else a half-open range;
    with none given every task is selected."""
    if name:
        return task_id.contains(name)
    if index_range is not None:
        lo, hi = index_range
        return (idx >= lo) & (idx < hi)
    if indices is not None:
        return idx.isin(*indices)
    return F.lit(True)


def retry_action(exists: Column, finished: Column, result: Column, *,
                 overwriting: bool, retry_failed: bool) -> Column:
    """Run / skip / overwrite / retry for one task.

    An existing result is skipped unless overwriting is on, so retry-failed
    only acts together with overwriting.  A finished result without ``FAIL``
    (case-sensitive) and without ``error`` (any case) is skipped."""
    clean = (F.coalesce(finished, F.lit(False))
             & ~F.coalesce(result, F.lit("")).contains("FAIL")
             & ~F.lower(F.coalesce(result, F.lit(""))).contains("error"))
    if not overwriting:
        return F.when(exists, F.lit("skip")).otherwise(F.lit("run"))
    if retry_failed:
        return F.when(~exists, F.lit("run")).when(clean, F.lit("skip")).otherwise(F.lit("retry"))
    return F.when(exists, F.lit("overwrite")).otherwise(F.lit("run"))


def exp_id(prefix: str, task: Column, arm: Column, trial: Column,
           legacy_task: str | None = None) -> Column:
    """``{prefix}-{task}-{arm}-r{i}``; the legacy task has no task part."""
    full = F.concat_ws("-", F.lit(prefix), task, arm, F.concat(F.lit("r"), trial.cast("string")))
    if legacy_task is None:
        return full
    short = F.concat_ws("-", F.lit(prefix), arm, F.concat(F.lit("r"), trial.cast("string")))
    return F.when(task == legacy_task, short).otherwise(full)


def arm_of(exp: Column, arms: Sequence[str] = ARMS) -> Column:
    """The arm whose ``-{arm}-r`` occurs in the run id (first in order)."""
    out = F.lit(None).cast("string")
    for a in reversed(arms):
        out = F.when(exp.contains(f"-{a}-r"), F.lit(a)).otherwise(out)
    return out


def trial_grid(tasks: DataFrame, task_col: str, n: int, arms: Sequence[str] = ARMS,
               prefix: str = "nudge", legacy_task: str | None = None) -> DataFrame:
    """C4: tasks x arms x trials by exploding literal arrays per task row."""
    g = tasks.select(F.col(task_col).alias("task")).distinct() \
        .select("task", F.explode(F.array(*[F.lit(a) for a in arms])).alias("arm")) \
        .select("task", "arm", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("trial"))
    return g.withColumn("exp_id", exp_id(prefix, F.col("task"), F.col("arm"), F.col("trial"),
                                         legacy_task))


def defensive_long(x: Column) -> Column:
    """A non-numeric count contributes 0."""
    return F.coalesce(x.cast("string").try_cast("bigint"), F.lit(0))


def net_marker_hit(text: Column) -> Column:
    hit = F.lit(False)
    for m in NET_MARKERS:
        hit = hit | text.contains(m)
    return hit


def validity_class(has_record: Column, tokens: Column, tools: Column, net: Column,
                   settled: Column, timed_out: Column) -> Column:
    """X1, in order: MISSING, VOID_NO_MODEL, VOID_NETWORK, VOID_TIMEOUT, VALID.
    A transport error in a settled, not timed-out run stays VALID."""
    incomplete = F.coalesce(timed_out, F.lit(False)) | ~F.coalesce(settled, F.lit(False))
    return (F.when(~has_record, F.lit("MISSING"))
            .when((F.coalesce(tokens, F.lit(0)) == 0) & (F.coalesce(tools, F.lit(0)) == 0),
                  F.lit("VOID_NO_MODEL"))
            .when(net.isNotNull() & incomplete, F.lit("VOID_NETWORK"))
            .when(incomplete, F.lit("VOID_TIMEOUT"))
            .otherwise(F.lit("VALID")))


def reroot(stored: Column, run_id: Column, new_root: Column) -> Column:
    """H6: keep the tail of ``stored`` from the LAST part equal to the run id
    (backslashes as slashes) under ``new_root``; null without the id."""
    parts = F.split(F.regexp_replace(stored, r"\\", "/"), "/")
    pos = F.array_position(F.reverse(parts), run_id)       # 1-based from the end
    n = F.size(parts)
    tail = F.slice(parts, (n - pos + 1).cast("int"), pos.cast("int"))
    return F.when(stored.isNotNull() & (pos > 0),
                  F.concat(new_root, F.lit("/"), F.array_join(tail, "/")))


def resolve_first_existing(candidates: DataFrame, listing: DataFrame, *, run: str = "run",
                           path: str = "path", priority: str = "priority",
                           glob_priority: int | None = None) -> DataFrame:
    """H7: per run, the highest-priority candidate that exists.

    ``candidates`` holds (run, path, priority); glob candidates share one
    priority and count only when exactly one exists for the run.  Existence
    is a semi-join against the file listing (an equi-join on the path).
    """
    hits = candidates.join(listing.select(F.col(path).alias("_p")).distinct(),
                           F.col(path) == F.col("_p"), "left_semi")
    if glob_priority is not None:
        glob_n = hits.where(F.col(priority) == glob_priority).groupBy(run).agg(
            F.count(F.lit(1)).alias("_globs"))
        hits = hits.join(glob_n, run, "left").where(
            (F.col(priority) != glob_priority) | (F.col("_globs") == 1)).drop("_globs")
    return hits.groupBy(run).agg(F.min_by(F.col(path), F.col(priority)).alias("resolved"))


def pick_shallowest(files: DataFrame, *, run: str = "run", path: str = "path") -> DataFrame:
    """Exclude ``/gold/`` paths, keep the shortest; a tie at the shortest
    length is ambiguous (the runner refuses it); no hit gives no path."""
    f = files.where(~F.col(path).contains("/gold/")).select(run, path).distinct() \
        .withColumn("_len", F.length(path))
    best = f.groupBy(run).agg(F.min("_len").alias("_min"), F.count(F.lit(1)).alias("n_hits"))
    at_min = f.join(best, run).where(F.col("_len") == F.col("_min")).groupBy(run, "n_hits").agg(
        F.count(F.lit(1)).alias("n_shallowest"), F.min(path).alias("first"))
    return at_min.select(
        run, "n_hits", "n_shallowest",
        F.when(F.col("n_shallowest") == 1, F.col("first")).alias("picked"),
        F.when(F.col("n_shallowest") == 1, F.lit("ok")).otherwise(F.lit("ambiguous"))
         .alias("status"))


def config_state(lines: DataFrame, *, run: str = "run", line: str = "line") -> DataFrame:
    """Per file of lines, which fix of the blocker is in place."""
    t = F.trim(F.col(line))
    blocker = t.startswith("order:") & t.contains("ref('order_data')")
    ident = t.startswith("recharge_order_identifier:")
    after_colon = F.lower(F.trim(F.regexp_extract(t, r"^[^:]*:(.*)$", 1)))
    using = t.startswith("recharge__using_orders:") & after_colon.startswith("true")
    agg = lines.groupBy(run).agg(F.bool_or(blocker).alias("blocker_active"),
                                 F.bool_or(ident).alias("identifier_live"),
                                 F.bool_or(using).alias("using_orders"))
    state = (F.when(F.col("using_orders") & F.col("blocker_active"), F.lit("FIXED-vars"))
             .when(F.col("using_orders"), F.lit("FIXED-both"))
             .when(~F.col("blocker_active") & F.col("identifier_live"), F.lit("FIXED"))
             .when(~F.col("blocker_active"), F.lit("CHANGED"))
             .otherwise(F.lit("NOT-FIXED")))
    return agg.select(run, state.alias("state"))
