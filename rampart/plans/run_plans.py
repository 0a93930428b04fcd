"""Run selection, validity and artifact plans.

Stand-ins: customers are tasks (ids, kinds, records, project YAML lines),
orders are stored results, events are run trajectories, pages give stored
artifact paths, parts give candidate database files per brand.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import runs as R
from rampart.operators.ordering import positions
from rampart.plans import trial_inputs as I
from rampart.plans.registry import query
from rampart.session import ensure_checkpoint_dir, store
from rampart.sources.records import SUFFIX, expected_records, parse_records, record_facts, scan_record_files
from rampart.sources.tables import load_tables

# ---------------------------------------------------------------------------
# Spec lookup, first match in file order wins
# ---------------------------------------------------------------------------


@query("spec_lookup", sql="""
WITH specs AS (SELECT o_custkey, min(o_orderkey) AS spec_orderkey,
                      arg_min(o_orderpriority, o_orderkey) AS spec_priority
               FROM orders GROUP BY o_custkey)
SELECT c_custkey, spec_orderkey, spec_priority, spec_orderkey IS NOT NULL AS found
FROM customer LEFT JOIN specs ON specs.o_custkey = customer.c_custkey
""")
def spec_lookup(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    specs = t.orders.groupBy("o_custkey").agg(
        F.min_by(F.struct("o_orderkey", "o_orderpriority"), F.col("o_orderkey")).alias("s"))
    j = t.customer.select("c_custkey").join(specs, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", F.col("s.o_orderkey").alias("spec_orderkey"),
                    F.col("s.o_orderpriority").alias("spec_priority"),
                    F.col("s").isNotNull().alias("found"))


# ---------------------------------------------------------------------------
# B9 task selection, B10 task kind, B11 retry selection
# ---------------------------------------------------------------------------
SEL_NAME, SEL_LIST, SEL_RANGE = "00001", (3, 5, 7, 11), (100, 120)


@query("task_selection", sql=f"""
WITH idx AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS idx
             FROM customer),
f AS (SELECT c_custkey, idx, contains(c_name, '{SEL_NAME}') AS by_name,
             idx IN {SEL_LIST} AS by_list, idx >= {SEL_RANGE[0]} AND idx < {SEL_RANGE[1]} AS by_range
      FROM idx)
SELECT * FROM f WHERE by_name OR by_list OR by_range
""")
def task_selection(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    c = positions(t.customer.select("c_custkey", "c_name"), [], ["c_custkey"], name="pos")
    c = c.withColumn("idx", F.col("pos") - 1)
    tid, idx = F.col("c_name"), F.col("idx")
    f = c.select("c_custkey", "idx",
                 R.select_tasks(tid, idx, name=SEL_NAME).alias("by_name"),
                 R.select_tasks(tid, idx, indices=SEL_LIST).alias("by_list"),
                 R.select_tasks(tid, idx, index_range=SEL_RANGE).alias("by_range"))
    return f.where(F.col("by_name") | F.col("by_list") | F.col("by_range"))


# Prefixes used to build stand-in task ids.
ID_PREFIXES = ("bq", "ga", "local", "sf", "ch0", "postgres", "shopify", "recharge")


@query("task_kind", sql=f"""
WITH ids AS (SELECT list_extract({list(ID_PREFIXES)}, CAST(c_custkey % 8 AS INTEGER) + 1)
                    || CAST(c_custkey AS VARCHAR) AS instance_id FROM customer)
SELECT CASE WHEN starts_with(instance_id, 'bq') OR starts_with(instance_id, 'ga') THEN 'bq'
            WHEN starts_with(instance_id, 'local') THEN 'local'
            WHEN starts_with(instance_id, 'sf') THEN 'sf'
            WHEN starts_with(instance_id, 'ch0') THEN 'ch'
            WHEN starts_with(instance_id, 'postgres') THEN 'pg' ELSE 'dbt' END AS kind,
       count(*) AS tasks
FROM ids GROUP BY 1
""")
def task_kind(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    iid = F.concat(F.element_at(F.array(*[F.lit(p) for p in ID_PREFIXES]),
                                (F.pmod(F.col("c_custkey"), F.lit(8)) + 1).cast("int")),
                   F.col("c_custkey").cast("string"))
    return t.customer.select(R.task_kind(iid).alias("kind")).groupBy("kind").agg(
        F.count(F.lit(1)).alias("tasks"))


@query("retry_selection", sql="""
WITH r AS (
  SELECT o_orderkey % 5 <> 0 AS ex, o_orderstatus = 'F' AS finished,
         CASE WHEN o_orderkey % 11 = 0 THEN 'FAIL: mismatch' WHEN o_orderkey % 13 = 0 THEN 'Error: timeout'
              ELSE 'done ' || o_orderpriority END AS result
  FROM orders),
a AS (
  SELECT 'overwrite+retry' AS mode,
         CASE WHEN NOT ex THEN 'run'
              WHEN finished AND NOT contains(result, 'FAIL') AND NOT contains(lower(result), 'error')
                THEN 'skip' ELSE 'retry' END AS action FROM r
  UNION ALL
  SELECT 'retry_only', CASE WHEN ex THEN 'skip' ELSE 'run' END FROM r
  UNION ALL
  SELECT 'overwrite_only', CASE WHEN ex THEN 'overwrite' ELSE 'run' END FROM r)
SELECT mode, action, count(*) AS n FROM a GROUP BY ALL
""")
def retry_selection(spark, sf_dir) -> DataFrame:
    o = load_tables(spark, sf_dir).orders
    k = F.col("o_orderkey")
    r = o.select((F.pmod(k, F.lit(5)) != 0).alias("ex"),
                 (F.col("o_orderstatus") == "F").alias("finished"),
                 F.when(F.pmod(k, F.lit(11)) == 0, F.lit("FAIL: mismatch"))
                  .when(F.pmod(k, F.lit(13)) == 0, F.lit("Error: timeout"))
                  .otherwise(F.concat(F.lit("done "), F.col("o_orderpriority"))).alias("result"))
    modes = [("overwrite+retry", True, True), ("retry_only", False, True),
             ("overwrite_only", True, False)]
    out = None
    for name, ow, rf in modes:
        a = r.select(F.lit(name).alias("mode"), R.retry_action(
            F.col("ex"), F.col("finished"), F.col("result"), overwriting=ow,
            retry_failed=rf).alias("action"))
        out = a if out is None else out.unionByName(a)
    return out.groupBy("mode", "action").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# C4 trial grid and C6 pending cells
# ---------------------------------------------------------------------------
N_TRIALS = 3
LEGACY_TASK = "AUTOMOBILE"

GRID_SQL = f"""
grid AS (
  SELECT task, arm, trial,
         CASE WHEN task = '{LEGACY_TASK}' THEN 'nudge-' || arm || '-r' || trial
              ELSE 'nudge-' || task || '-' || arm || '-r' || trial END AS exp_id
  FROM (SELECT task, arm, unnest(range(1, {N_TRIALS + 1})) AS trial
        FROM (SELECT task, unnest(['off', 'generic', 'specific']) AS arm
              FROM (SELECT DISTINCT c_mktsegment AS task FROM customer))))
"""


def grid_table(t) -> DataFrame:
    return R.trial_grid(t.customer, "c_mktsegment", N_TRIALS, legacy_task=LEGACY_TASK)


@query("trial_grid", sql="WITH " + GRID_SQL + """
SELECT task, arm, CAST(trial AS INTEGER) AS trial, exp_id,
       CASE WHEN contains(exp_id, '-off-r') THEN 'off' WHEN contains(exp_id, '-generic-r') THEN 'generic'
            WHEN contains(exp_id, '-specific-r') THEN 'specific' END AS arm_parsed
FROM grid
""")
def trial_grid(spark, sf_dir) -> DataFrame:
    g = grid_table(load_tables(spark, sf_dir))
    return g.select("task", "arm", "trial", "exp_id", R.arm_of(F.col("exp_id")).alias("arm_parsed"))


@query("pending_cells", sql="WITH " + GRID_SQL + """,
records AS (
  SELECT c_custkey, c_mktsegment AS task,
         list_extract(['off', 'generic', 'specific'], CAST(c_custkey % 3 AS INTEGER) + 1) AS arm,
         CAST((c_custkey // 3) % 4 + 1 AS INTEGER) AS trial,
         c_custkey % 17 <> 0 AS parses,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal > 5000 AS INTEGER) END AS score
  FROM customer),
done AS (SELECT task, arm, trial FROM records
         QUALIFY row_number() OVER (PARTITION BY task, arm, trial ORDER BY c_custkey DESC) = 1
             AND parses AND score IS NOT NULL)
SELECT g.task, g.arm, CAST(g.trial AS INTEGER) AS trial, g.exp_id FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.task = g.task AND d.arm = g.arm AND d.trial = g.trial)
""")
def pending_cells(spark, sf_dir) -> DataFrame:
    """Each customer is one write of a cell's record; the last one stands."""
    t = load_tables(spark, sf_dir)
    rec = t.customer.select(
        "c_custkey",
        F.col("c_mktsegment").alias("task"),
        F.element_at(F.array(*[F.lit(a) for a in R.ARMS]),
                     (F.pmod(F.col("c_custkey"), F.lit(3)) + 1).cast("int")).alias("arm"),
        (F.pmod(F.floor(F.col("c_custkey") / 3), F.lit(4)) + 1).cast("int").alias("trial"),
        (F.pmod(F.col("c_custkey"), F.lit(17)) != 0).alias("parses"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(
            (F.col("c_acctbal") > 5000).cast("int")).alias("score"))
    last = rec.groupBy("task", "arm", "trial").agg(
        F.max_by(F.struct("parses", "score"), "c_custkey").alias("r"))
    done = last.where("r.parses and r.score is not null").select("task", "arm", "trial")
    return grid_table(t).join(done, ["task", "arm", "trial"], "left_anti") \
        .select("task", "arm", "trial", "exp_id")


# ---------------------------------------------------------------------------
# X1 run validity
# ---------------------------------------------------------------------------

def validity_table(t, facts: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """Every expected run with its record's facts and validity, as a written table (one
    row per run, which every part of a report joins).  ``facts`` are the
    :func:`log_facts`; ``files`` is a :func:`scan_record_files` result, without which
    the record texts are taken as rows."""
    facts = I.log_facts(t) if facts is None else facts
    if files is None:
        files = I.record_texts(facts).select("exp", F.octet_length("text").alias("bytes"), "text")
    recs = expected_records(I.grid(facts), parse_records(files))
    j = recs.select("*", *record_facts()).join(facts.select("user_id", "net"), "user_id", "left")
    status = R.validity_class(F.col("problem").isNull(), F.col("tokens"), F.col("tools"),
                              F.col("net"), F.col("settled"), F.col("timed_out"))
    return store(j.withColumn("status", status), "validity")


#: record files by :func:`write_record_files`: below which folders, their names, their run
RECORD_FILES = ("/*", f"{{part-*,*{SUFFIX}}}", rf"/(?:exp=)?([^/]+?)(?:{re.escape(SUFFIX)}|/part-[^/]*)$")


def plain_folder(root: str) -> str | None:
    """The path of a folder of the (shared) file system; None for a store that only Spark reaches."""
    return re.sub("^file:/*", "/", root) if re.match("/|file:", root) else None


def write_record_files(facts: DataFrame, root: str) -> None:
    """The stand-in's records as files, one per run; the empty record has no bytes.

    Where ``root`` is a folder of the (shared) file system, tasks write its files as any
    program would, dealt over 256 folders.  Elsewhere Spark's writers make a folder per
    run.  Either way all tasks write at once, and no run takes a job of its own."""
    spark, texts = facts.sparkSession, I.record_texts(facts)
    # files are made by all tasks at once: rows are dealt by run, and not coalesced by their few bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, suffix = plain_folder(root), SUFFIX
    if folder:
        def write(rows):
            import os
            import uuid
            import zlib
            for exp, text in rows:
                at = f"{folder}/{zlib.crc32(exp.encode()) % 256:02x}"
                os.makedirs(at, exist_ok=True)
                part = f"{at}/.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(text.encode())
                os.replace(part, f"{at}/{exp}{suffix}")          # a task that runs twice writes the same
        os.makedirs(f"{folder}/00")                              # there is a folder to list, if no run wrote
        texts.where("text is not null").select("exp", "text").repartition(tasks, "exp").foreachPartition(write)
        return

    def files(rows: DataFrame):
        return rows.repartition(tasks, "exp").write.mode("append").partitionBy("exp")
    files(texts.where("text <> ''").select("exp", F.col("text").alias("value"))).text(root)
    # a CSV line of one null, written as nothing, is a file without a byte
    files(texts.where("text = ''").select("exp", F.lit(None).cast("string").alias("value"))).csv(root, nullValue="")


VALIDITY_SQL = "WITH " + I.INPUT_SQL + """
SELECT status, coalesce(regexp_extract(record_problem, '^(no record|unparseable)', 1), '') AS problem, count(*) AS runs
FROM validity GROUP BY 1, 2
"""


def validity_counts(v: DataFrame) -> DataFrame:
    cause = F.regexp_extract(F.coalesce("problem", F.lit("")), "^(no record|unparseable)", 1)
    return v.groupBy("status", cause.alias("problem")).agg(F.count(F.lit(1)).alias("runs"))


@query("run_validity", sql=VALIDITY_SQL)
def run_validity(spark, sf_dir) -> DataFrame:
    """Absent, empty and broken records are MISSING, each with its cause."""
    return validity_counts(validity_table(load_tables(spark, sf_dir)))


@query("record_scan", sql=VALIDITY_SQL)
def record_scan(spark, sf_dir) -> DataFrame:
    """A2: the same from record files, one per run: some are not there, some have no
    bytes, some break off."""
    t = load_tables(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}"
    facts = I.log_facts(t)
    write_record_files(facts, root)
    return validity_counts(validity_table(t, facts, scan_record_files(spark, root + RECORD_FILES[0], *RECORD_FILES[1:])))


# ---------------------------------------------------------------------------
# H6 path re-rooting, H7 artifact resolution, E9 shallowest pick, H16 config state
# ---------------------------------------------------------------------------

@query("path_reroot", sql="""
WITH p AS (
  SELECT page_id, list_extract(['fr', 'de', 'en'], CAST(page_id % 3 AS INTEGER) + 1) AS run,
         CASE WHEN page_id % 2 = 1 THEN replace(url, '/', '\\') ELSE url END AS stored
  FROM pages),
s AS (SELECT page_id, run, string_split(replace(stored, '\\', '/'), '/') AS parts FROM p),
q AS (SELECT page_id, parts, coalesce(list_position(list_reverse(parts), run), 0) AS pos FROM s)
SELECT page_id,
       CASE WHEN pos > 0 THEN '/runs/' || array_to_string(list_slice(parts, len(parts) - pos + 1,
                                                                   len(parts)), '/') END AS rerooted
FROM q
""")
def path_reroot(spark, sf_dir) -> DataFrame:
    p = load_tables(spark, sf_dir).pages
    run = F.element_at(F.array(F.lit("fr"), F.lit("de"), F.lit("en")),
                       (F.pmod(F.col("page_id"), F.lit(3)) + 1).cast("int"))
    stored = F.when(F.pmod(F.col("page_id"), F.lit(2)) == 1,
                    F.translate("url", "/", "\\")).otherwise(F.col("url"))
    return p.select("page_id", R.reroot(stored, run, F.lit("/runs")).alias("rerooted"))


def _artifact_inputs(t):
    p = t.pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("run"),
                       F.col("page_id").alias("id"))
    root = F.concat(F.lit("/new/"), F.col("run"))
    reroot = F.concat(root, F.lit("/trajectory.jsonl"))
    canonical = F.concat(root, F.lit("/_pi_meta/inst/trajectory.jsonl"))
    stored = F.concat(F.lit("/old/"), F.col("run"), F.lit("/trajectory.jsonl"))
    x1 = F.concat(root, F.lit("/_pi_meta/x1/trajectory.jsonl"))
    x2 = F.concat(root, F.lit("/_pi_meta/x2/trajectory.jsonl"))
    i = F.col("id")
    exists = F.array(F.when(F.pmod(i, F.lit(4)) == 1, reroot),
                     F.when(F.pmod(i, F.lit(4)) == 2, canonical),
                     F.when(F.pmod(i, F.lit(4)) == 3, x1),
                     F.when(F.pmod(i, F.lit(8)) == 7, x2),
                     F.when(F.pmod(i, F.lit(5)) == 0, stored))
    listing = p.select(F.explode(F.filter(exists, lambda x: x.isNotNull())).alias("path"))
    fixed = p.select("run", F.explode(F.array(
        F.struct(reroot.alias("path"), F.lit("reroot").alias("kind")),
        F.struct(canonical.alias("path"), F.lit("canonical").alias("kind")),
        F.struct(stored.alias("path"), F.lit("stored").alias("kind")))).alias("c")) \
        .select("run", "c.path", "c.kind")
    globbed = listing.select(
        F.regexp_extract("path", r"^/new/(p[0-9]+)/_pi_meta/[^/]+/trajectory\.jsonl$", 1)
         .alias("run"), "path", F.lit("glob").alias("kind")).where(F.col("run") != "")
    return p, fixed.unionByName(globbed), listing


# Candidate orders of the two readers: the report reader tries the stored path
# before the glob, the validity reader the glob before the stored path.
REPORT_ORDER = {"reroot": 1, "canonical": 2, "stored": 3, "glob": 4}
VALIDITY_ORDER = {"reroot": 1, "canonical": 2, "glob": 3, "stored": 4}


@query("artifact_resolution", sql="""
WITH p AS (SELECT page_id AS id, 'p' || page_id AS run FROM pages),
paths AS (SELECT id, run, '/new/' || run || '/trajectory.jsonl' AS reroot,
                 '/new/' || run || '/_pi_meta/inst/trajectory.jsonl' AS canonical,
                 '/old/' || run || '/trajectory.jsonl' AS stored,
                 '/new/' || run || '/_pi_meta/x1/trajectory.jsonl' AS x1,
                 '/new/' || run || '/_pi_meta/x2/trajectory.jsonl' AS x2 FROM p),
listing AS (SELECT reroot AS path FROM paths WHERE id % 4 = 1
            UNION ALL SELECT canonical FROM paths WHERE id % 4 = 2
            UNION ALL SELECT x1 FROM paths WHERE id % 4 = 3
            UNION ALL SELECT x2 FROM paths WHERE id % 8 = 7
            UNION ALL SELECT stored FROM paths WHERE id % 5 = 0),
cands AS (SELECT run, reroot AS path, 'reroot' AS kind FROM paths
          UNION ALL SELECT run, canonical, 'canonical' FROM paths
          UNION ALL SELECT run, stored, 'stored' FROM paths
          UNION ALL SELECT regexp_extract(path, '^/new/(p[0-9]+)/_pi_meta/[^/]+/trajectory\\.jsonl$', 1),
                           path, 'glob' FROM listing
                    WHERE regexp_extract(path, '^/new/(p[0-9]+)/_pi_meta/[^/]+/trajectory\\.jsonl$', 1) <> ''),
hits AS (SELECT * FROM cands WHERE path IN (SELECT path FROM listing)),
globs AS (SELECT run, count(*) AS n FROM hits WHERE kind = 'glob' GROUP BY run),
usable AS (SELECT h.* FROM hits h LEFT JOIN globs g USING (run) WHERE kind <> 'glob' OR g.n = 1),
rep AS (SELECT run, arg_min(path, CASE kind WHEN 'reroot' THEN 1 WHEN 'canonical' THEN 2
                                          WHEN 'stored' THEN 3 ELSE 4 END) AS resolved_report
        FROM usable GROUP BY run),
val AS (SELECT run, arg_min(path, CASE kind WHEN 'reroot' THEN 1 WHEN 'canonical' THEN 2
                                          WHEN 'glob' THEN 3 ELSE 4 END) AS resolved_validity
        FROM usable GROUP BY run)
SELECT p.id AS page_id, resolved_report, resolved_validity
FROM p LEFT JOIN rep USING (run) LEFT JOIN val USING (run)
""")
def artifact_resolution(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    p, cands, listing = _artifact_inputs(t)
    out = p
    for name, order in (("resolved_report", REPORT_ORDER), ("resolved_validity", VALIDITY_ORDER)):
        prio = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])[F.col("kind")]
        res = R.resolve_first_existing(cands.withColumn("priority", prio), listing,
                                       glob_priority=order["glob"])
        out = out.join(res.withColumnRenamed("resolved", name), "run", "left")
    return out.select(F.col("id").alias("page_id"), "resolved_report", "resolved_validity")


@query("artifact_pick", sql="""
WITH f AS (
  SELECT DISTINCT p_brand AS run,
         '/out/' || p_brand || CASE WHEN p_size % 4 = 0 AND p_partkey % 2 = 0 THEN '/gold' ELSE '' END
         || '/' || repeat('d/', CAST(p_size % 4 AS INTEGER))
         || CASE WHEN p_partkey % 7 = 0 THEN 'alt.duckdb' ELSE 'run.duckdb' END AS path
  FROM part),
g AS (SELECT run, path, length(path) AS l FROM f WHERE NOT contains(path, '/gold/')),
b AS (SELECT run, min(l) AS m, count(*) AS n_hits FROM g GROUP BY run)
SELECT g.run AS brand, b.n_hits, count(*) AS n_shallowest,
       CASE WHEN count(*) = 1 THEN min(path) END AS picked,
       CASE WHEN count(*) = 1 THEN 'ok' ELSE 'ambiguous' END AS status
FROM g JOIN b ON b.run = g.run AND g.l = b.m GROUP BY g.run, b.n_hits
""")
def artifact_pick(spark, sf_dir) -> DataFrame:
    p = load_tables(spark, sf_dir).part
    path = F.concat(
        F.lit("/out/"), F.col("p_brand"),
        F.when((F.pmod(F.col("p_size"), F.lit(4)) == 0) & (F.pmod(F.col("p_partkey"), F.lit(2)) == 0),
               F.lit("/gold")).otherwise(F.lit("")),
        F.lit("/"), F.repeat(F.lit("d/"), F.pmod(F.col("p_size"), F.lit(4)).cast("int")),
        F.when(F.pmod(F.col("p_partkey"), F.lit(7)) == 0, F.lit("alt.duckdb"))
         .otherwise(F.lit("run.duckdb")))
    files = p.select(F.col("p_brand").alias("run"), path.alias("path"))
    return R.pick_shallowest(files).select(F.col("run").alias("brand"), "n_hits", "n_shallowest",
                                           "picked", "status")


@query("config_state", sql="""
WITH c AS (SELECT c_custkey FROM customer),
lines AS (
  SELECT c_custkey AS run, CASE WHEN c_custkey % 2 = 1 THEN '  order: "{{ ref(''order_data'') }}"'
                                ELSE '  # order: "{{ ref(''order_data'') }}"' END AS line
  FROM c WHERE c_custkey % 9 <> 0
  UNION ALL
  SELECT c_custkey, CASE WHEN c_custkey % 4 >= 2 THEN '  recharge_order_identifier: "order_data"'
                         ELSE '  # recharge_order_identifier: "order_data"' END
  FROM c WHERE c_custkey % 9 <> 0
  UNION ALL
  SELECT c_custkey, CASE WHEN c_custkey % 8 >= 6 THEN '  recharge__using_orders: True'
                         WHEN c_custkey % 8 = 5 THEN '  recharge__using_orders: false'
                         ELSE 'models:' END
  FROM c WHERE c_custkey % 9 <> 0),
flags AS (
  SELECT run,
         bool_or(starts_with(trim(line), 'order:') AND contains(trim(line), 'ref(''order_data'')'))
           AS blocker,
         bool_or(starts_with(trim(line), 'recharge_order_identifier:')) AS ident,
         bool_or(starts_with(trim(line), 'recharge__using_orders:')
                 AND starts_with(lower(trim(regexp_extract(trim(line), '^[^:]*:(.*)$', 1))), 'true'))
           AS using_orders
  FROM lines GROUP BY run),
states AS (
  SELECT CASE WHEN using_orders AND blocker THEN 'FIXED-vars' WHEN using_orders THEN 'FIXED-both'
              WHEN NOT blocker AND ident THEN 'FIXED' WHEN NOT blocker THEN 'CHANGED'
              ELSE 'NOT-FIXED' END AS state FROM flags
  UNION ALL SELECT 'no-yml' FROM c WHERE c_custkey % 9 = 0)
SELECT state, count(*) AS runs FROM states GROUP BY state
""")
def config_state(spark, sf_dir) -> DataFrame:
    c = load_tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("run"))
    k = F.col("run")
    l1 = F.when(F.pmod(k, F.lit(2)) == 1, F.lit("  order: \"{{ ref('order_data') }}\"")) \
        .otherwise(F.lit("  # order: \"{{ ref('order_data') }}\""))
    l2 = F.when(F.pmod(k, F.lit(4)) >= 2, F.lit('  recharge_order_identifier: "order_data"')) \
        .otherwise(F.lit('  # recharge_order_identifier: "order_data"'))
    l3 = F.when(F.pmod(k, F.lit(8)) >= 6, F.lit("  recharge__using_orders: True")) \
        .when(F.pmod(k, F.lit(8)) == 5, F.lit("  recharge__using_orders: false")) \
        .otherwise(F.lit("models:"))
    has_file = F.pmod(k, F.lit(9)) != 0
    lines = c.where(has_file).select("run", F.explode(F.array(l1, l2, l3)).alias("line"))
    states = R.config_state(lines).select("state").unionByName(
        c.where(~has_file).select(F.lit("no-yml").alias("state")))
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("runs"))
