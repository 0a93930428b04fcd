"""Declared-name gate (P4) and its set algebra.

Four name sets keyed by project -- declared (pristine spec), shipped
(fixture SQL files), run (SQL files after the run) and materialized (tables
built) -- are tagged, unioned and folded with one ``groupBy(project, name)``:
no joins, one shuffle for the per-name flags and one partial aggregate for
the per-project verdict.  A project holding a third of all names only means
more rows in its partial aggregates, never one task holding the group.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.operators.verdict import ERROR, PASS, VIOLATION, status_expr

SETS = ("declared", "shipped", "run", "materialized")


def name_flags(declared: DataFrame, shipped: DataFrame, run: DataFrame,
               materialized: DataFrame, project: str = "project",
               name: str = "name") -> DataFrame:
    """One row per (project, name) with membership booleans and the derived
    set labels: candidate, created, built_new, offender, built_candidate, unmet."""
    parts = []
    for tag, df in zip(SETS, (declared, shipped, run, materialized)):
        parts.append(df.select(F.col(project).alias("project"), F.col(name).alias("name"),
                               F.lit(tag).alias("tag")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    flags = u.groupBy("project", "name").agg(
        *[F.bool_or(F.col("tag") == t).alias(f"in_{t}") for t in SETS])
    d, s, r, m = (F.col(f"in_{t}") for t in SETS)
    candidate = d & ~s                     # G1: declared, shipped without SQL
    created = r & ~s                       # G2: agent-created (edited fixture SQL is not)
    built_new = created & m                # G3
    return flags.select(
        "project", "name", *[f"in_{t}" for t in SETS],
        candidate.alias("candidate"),
        created.alias("created"),
        built_new.alias("built_new"),
        (built_new & ~d).alias("offender"),
        (candidate & m).alias("built_candidate"),   # G3
        (candidate & ~m).alias("unmet"),            # G4
    )


def name_gate(flags: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """Per-project verdict in the reference's rule order:
    no declarations -> error; no candidates -> pass (not applicable);
    nothing created materialized -> error; offenders without any built
    candidate -> violation; otherwise pass (possibly with a helper).

    ``unreadable`` (project, ...) names projects whose database could not be listed:
    these are errors whatever the other sets say, and measure nothing."""
    if unreadable is not None:
        bad = unreadable.select("project").distinct()
        known = name_gate(flags.join(bad, "project", "left_anti"))
        zero = [F.lit(0).cast("bigint").alias(c) for c in known.columns[3:]]
        return known.unionByName(bad.select("project", F.lit(ERROR).alias("status"),
                                            F.lit("catalog-unreadable").alias("reason"), *zero))
    agg = flags.groupBy("project").agg(
        F.count_if("in_declared").alias("n_declared"),
        F.count_if("candidate").alias("n_candidates"),
        F.count_if("built_new").alias("n_built_new"),
        F.count_if("offender").alias("n_offenders"),
        F.count_if("built_candidate").alias("n_built_candidates"),
        F.count_if("unmet").alias("n_unmet"),
    )
    c = F.col
    status = status_expr(
        (c("n_declared") == 0, ERROR),
        (c("n_candidates") == 0, PASS),
        (c("n_built_new") == 0, ERROR),
        ((c("n_offenders") > 0) & (c("n_built_candidates") == 0), VIOLATION),
    )
    reason = (F.when(c("n_declared") == 0, F.lit("no-declarations"))
              .when(c("n_candidates") == 0, F.lit("not-applicable"))
              .when(c("n_built_new") == 0, F.lit("nothing-created-built"))
              .when((c("n_offenders") > 0) & (c("n_built_candidates") == 0),
                    F.lit("undeclared-name"))
              .when(c("n_offenders") > 0, F.lit("helper-beside-candidate"))
              .otherwise(F.lit("declared-names")))
    return agg.select("project", status.alias("status"), reason.alias("reason"),
                      c("n_built_new").alias("checked_rows"), "n_offenders", "n_unmet",
                      "n_built_candidates", "n_candidates")


def offenders(flags: DataFrame) -> DataFrame:
    """Violation rows (one per offending name); no per-project collection."""
    return flags.where("offender").select("project", "name")


def scored_listing(scored: DataFrame, flags: DataFrame) -> DataFrame:
    """Per project, the scored (project, name) targets and which of them are
    materialized (``scored_built``: sorted names)."""
    made = flags.where("in_materialized").select("project", "name", F.lit(True).alias("_made"))
    j = scored.select("project", "name").distinct().join(made, ["project", "name"], "left")
    return j.groupBy("project").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count("_made").alias("n_scored_built"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_made"), F.col("name")))), ",").alias("scored_built"))


# ---------------------------------------------------------------------------
# Name sources (A8, A9): YAML declarations and SQL file inventories
# ---------------------------------------------------------------------------

def sql_inventory(spark: SparkSession, root: str, project_depth: int = 1) -> DataFrame:
    """(project, name) for every ``models/**/*.sql`` below ``root/<project>``.

    The listing is a distributed file scan (binaryFile, path only); the model
    name is the basename without ``.sql``.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.sql").load(root).select("path"))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _re_escape(os.path.abspath(root)) + "/", "")
    parts = F.split(rel, "/")
    return files.select(
        F.array_join(F.slice(parts, 1, project_depth), "/").alias("project"),
        F.regexp_extract(F.col("path"), r"/models/(?:.*/)?([^/]+)\.sql$", 1).alias("name"),
    ).where(F.col("name") != "").distinct()


def declared_models(spark: SparkSession, root: str, project_depth: int = 1) -> DataFrame:
    """(project, name) for ``models:`` entries of every schema YAML under
    ``root/<project>/models``; a malformed file contributes nothing.

    Files are read whole (one row per file) and parsed per batch with
    ``mapInPandas``; YAML parsing is the only per-row Python step.
    """
    files = (spark.read.option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.yml").text(root, wholetext=True)
             .select(F.col("_metadata.file_path").alias("path"), "value")
             .where(F.col("path").rlike(r"/models/")))
    prefix = "file:" + os.path.abspath(root) + "/"

    def parse(batches):
        import pandas as pd
        import yaml
        for pdf in batches:
            out = []
            for path, text in zip(pdf["path"], pdf["value"]):
                rel = path[len(prefix):] if path.startswith(prefix) else path
                project = "/".join(rel.split("/")[:project_depth])
                try:
                    doc = yaml.safe_load(text) or {}
                except Exception:  # noqa: BLE001 -- a malformed file is skipped
                    continue
                if not isinstance(doc, dict):
                    continue
                for entry in doc.get("models") or []:
                    if isinstance(entry, dict) and entry.get("name"):
                        out.append((project, str(entry["name"])))
            yield pd.DataFrame(out, columns=["project", "name"])

    schema = T.StructType([T.StructField("project", T.StringType()),
                           T.StructField("name", T.StringType())])
    return files.mapInPandas(parse, schema).distinct()


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
