"""Name gate, policy stack, retry loop and outcome plans.

Stand-ins:
* name gate -- project = ``p_brand``, model name = ``p_name`` with spaces as
  underscores; the four sets are bands of ``p_size`` / ``p_partkey`` and the
  brand number picks which bands the "run" created, so every gate branch
  occurs;
* verdict log -- events of one user are the checks of one run, ordered by
  (ts, event_id): ``error`` = violation, ``purchase`` = pass, ``view`` =
  error with a message chosen by ``event_id``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.operators import names as N
from rampart.operators import stack as S
from rampart.plans.registry import query
from rampart.session import ensure_checkpoint_dir
from rampart.sources import catalogs as C
from rampart.sources.tables import load_tables

CAP = 3  # retries allowed across a whole stack


def part_names(t) -> DataFrame:
    return t.part.select(
        F.col("p_brand").alias("project"),
        F.regexp_replace("p_name", " ", "_").alias("name"),
        F.col("p_size").alias("size"), F.col("p_partkey").alias("partkey"),
        F.pmod(F.substring("p_brand", 7, 4).cast("int"), F.lit(5)).alias("b"))


def name_sets(t):
    """declared / shipped / run / materialized (project, name) sets.

    Brand number mod 5 picks the run: 0 created nothing, 1 invented names
    only (``<name>_custom``), 2 invented names and built candidates, 3 built
    candidates only, 4 declares nothing beyond what ships.
    """
    p = part_names(t)
    size, b = F.col("size"), F.col("b")
    built = F.pmod(F.col("partkey"), F.lit(4)) != 0
    invented = p.where(b.isin(1, 2) & size.between(36, 45)).withColumn(
        "name", F.concat(F.col("name"), F.lit("_custom")))
    cand = p.where(b.isin(2, 3, 4) & size.between(21, 28))
    shipped = p.where((size <= 20) | (size > 45) | ((b == 4) & (size >= 29)))
    # every part is in one of the sets
    declared = p.where(((b != 4) & ((size <= 35) | (size > 45) | b.isin(0, 3)))
                       | ((b == 4) & ((size <= 20) | (size >= 29))))
    run = shipped.unionByName(invented).unionByName(cand)
    materialized = run.where(built)
    return declared, shipped, run, materialized


NAME_CTE = """
p AS (SELECT p_brand AS project, replace(p_name, ' ', '_') AS name, p_size AS size,
             p_partkey AS partkey, CAST(substring(p_brand, 7, 4) AS INTEGER) % 5 AS b FROM part),
runs AS (
  SELECT project, name, partkey FROM p WHERE size <= 20 OR size > 45 OR (b = 4 AND size >= 29)
  UNION ALL SELECT project, name || '_custom', partkey FROM p
   WHERE b IN (1, 2) AND size BETWEEN 36 AND 45
  UNION ALL SELECT project, name, partkey FROM p WHERE b IN (2, 3, 4) AND size BETWEEN 21 AND 28),
tagged AS (
  SELECT project, name, 'declared' AS tag FROM p
   WHERE (b <> 4 AND (size <= 35 OR size > 45 OR b IN (0, 3)))
      OR (b = 4 AND (size <= 20 OR size >= 29))
  UNION ALL SELECT project, name, 'shipped' FROM p
   WHERE size <= 20 OR size > 45 OR (b = 4 AND size >= 29)
  UNION ALL SELECT project, name, 'run' FROM runs
  UNION ALL SELECT project, name, 'materialized' FROM runs WHERE partkey % 4 <> 0),
flags AS (
  SELECT project, name, bool_or(tag = 'declared') AS d, bool_or(tag = 'shipped') AS s,
         bool_or(tag = 'run') AS r, bool_or(tag = 'materialized') AS m
  FROM tagged GROUP BY project, name),
sets AS (
  SELECT project, name, d, (d AND NOT s) AS candidate, (r AND NOT s AND m) AS built_new,
         (r AND NOT s AND m AND NOT d) AS offender, (d AND NOT s AND m) AS built_candidate,
         (d AND NOT s AND NOT m) AS unmet
  FROM flags),
gate AS (
  SELECT project,
         count(*) FILTER (WHERE d) AS n_declared,
         count(*) FILTER (WHERE candidate) AS n_candidates,
         count(*) FILTER (WHERE built_new) AS n_built_new,
         count(*) FILTER (WHERE offender) AS n_offenders,
         count(*) FILTER (WHERE built_candidate) AS n_built_candidates,
         count(*) FILTER (WHERE unmet) AS n_unmet
  FROM sets GROUP BY project),
gated AS (
  SELECT *, CASE WHEN n_declared = 0 THEN 'error' WHEN n_candidates = 0 THEN 'pass'
                 WHEN n_built_new = 0 THEN 'error'
                 WHEN n_offenders > 0 AND n_built_candidates = 0 THEN 'violation'
                 ELSE 'pass' END AS status,
            CASE WHEN n_declared = 0 THEN 'no-declarations'
                 WHEN n_candidates = 0 THEN 'not-applicable'
                 WHEN n_built_new = 0 THEN 'nothing-created-built'
                 WHEN n_offenders > 0 AND n_built_candidates = 0 THEN 'undeclared-name'
                 WHEN n_offenders > 0 THEN 'helper-beside-candidate'
                 ELSE 'declared-names' END AS reason
  FROM gate)
"""


def gate_table(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return N.name_gate(N.name_flags(*name_sets(t)))


@query("name_gate", sql="WITH " + NAME_CTE + """
SELECT project AS brand, status, reason, n_built_new AS checked_rows, n_offenders, n_unmet,
       n_built_candidates
FROM gated
""")
def name_gate(spark, sf_dir) -> DataFrame:
    return gate_table(spark, sf_dir).select(
        F.col("project").alias("brand"), "status", "reason", "checked_rows", "n_offenders",
        "n_unmet", "n_built_candidates")


# ---------------------------------------------------------------------------
# A3: the gate over listed databases
# ---------------------------------------------------------------------------
KINDS_SHIPPED = ("promo",)


def brand_models(t) -> DataFrame:
    """(project, name, made): the models that a brand family's run has, and whether it made
    their tables.  A family declares its kinds; some runs use an invented name instead."""
    p = t.part.select(F.substring("p_brand", 1, 7).alias("project"), F.lower(F.element_at(F.split("p_type", " "), -1)).alias("kind"), "p_partkey")
    g = p.groupBy("project", "kind").agg(F.min("p_partkey").alias("k"))
    number = F.substring("project", 7, 1).cast("int")
    name = F.when((F.pmod(number, F.lit(3)) == 0) & ~F.col("kind").isin(*KINDS_SHIPPED),
                  F.concat("kind", F.lit("_custom"))).otherwise(F.col("kind"))
    return g.select("project", "kind", name.alias("name"), (F.pmod("k", F.lit(4)) != 0).alias("made"))


def _build_databases(spark, t, models: DataFrame, run: str) -> dict[str, str]:
    """The stand-in's produced databases, one per brand family and a table per
    model made; family 4 has none.  Returns project -> database."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/databases-{run}"
    kind = F.lower(F.element_at(F.split("p_type", " "), -1))
    t.part.select("p_partkey", "p_name", "p_retailprice", F.translate(F.substring("p_brand", 1, 7), "#", "_").alias("brand"), kind.alias("kind")) \
        .write.partitionBy("brand", "kind").parquet(f"{root}/data")
    built: dict[str, dict[str, str]] = {}
    for r in models.select("project", "kind", "name", "made").collect():      # a table list: families x kinds
        tables = built.setdefault(r.project, {})
        if r.made:
            path = f"{root}/data/brand={r.project.replace('#', '_')}/kind={r.kind}"
            tables[r.name] = f"(p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE) USING parquet LOCATION '{path}'"
    names = {p: f"{p.replace('#', '_')}_{run}".lower() for p in built}
    for p, tables in built.items():
        if not p.endswith("4"):
            C.create_database(spark, names[p], f"{root}/{names[p]}", tables)
    return names


@query("catalog_gate", sql="""
WITH m AS (
  SELECT substring(p_brand, 1, 7) AS project, lower(split_part(p_type, ' ', -1)) AS kind, min(p_partkey) AS k FROM part GROUP BY 1, 2),
models AS (
  SELECT project, kind, k % 4 <> 0 AS made,
         kind || CASE WHEN CAST(substring(project, 7, 1) AS INTEGER) % 3 = 0 AND kind <> 'promo' THEN '_custom' ELSE '' END AS name
  FROM m),
tagged AS (
  SELECT project, kind AS name, 'd' AS tag FROM models
  UNION ALL SELECT project, kind, 's' FROM models WHERE kind = 'promo'
  UNION ALL SELECT project, name, 'r' FROM models
  UNION ALL SELECT project, name, 'm' FROM models WHERE made),
f AS (SELECT project, name, bool_or(tag = 'd') AS d, bool_or(tag = 's') AS s, bool_or(tag = 'r') AS r, bool_or(tag = 'm') AS m
      FROM tagged GROUP BY project, name),
g AS (SELECT project, count(*) FILTER (WHERE d AND NOT s) AS cand, count(*) FILTER (WHERE r AND NOT s AND m) AS new,
             count(*) FILTER (WHERE r AND NOT s AND m AND NOT d) AS off, count(*) FILTER (WHERE d AND NOT s AND m) AS got,
             count(*) FILTER (WHERE d AND NOT s AND NOT m) AS unmet, project LIKE '%4' AS bad FROM f GROUP BY project)
SELECT project AS brand,
       CASE WHEN bad THEN 'error' WHEN cand = 0 THEN 'pass' WHEN new = 0 THEN 'error'
            WHEN off > 0 AND got = 0 THEN 'violation' ELSE 'pass' END AS status,
       CASE WHEN bad THEN 'catalog-unreadable' WHEN cand = 0 THEN 'not-applicable' WHEN new = 0 THEN 'nothing-created-built'
            WHEN off > 0 AND got = 0 THEN 'undeclared-name' WHEN off > 0 THEN 'helper-beside-candidate'
            ELSE 'declared-names' END AS reason,
       CASE WHEN bad THEN 0 ELSE off END AS n_offenders, CASE WHEN bad THEN 0 ELSE unmet END AS n_unmet,
       CASE WHEN bad THEN 0 ELSE got END AS n_built_candidates
FROM g
""")
def catalog_gate(spark, sf_dir) -> DataFrame:
    """P4 with the materialized set as the catalog lists it; a database that cannot be
    opened is an error and not an empty set."""
    t = load_tables(spark, sf_dir)
    models = brand_models(t)
    names = _build_databases(spark, t, models, uuid.uuid4().hex)
    projects = spark.createDataFrame([(p, d) for p, d in names.items()], "project string, database string")
    listed = C.list_tables(spark, list(names.values())).join(projects, "database")
    C.drop_databases(spark, list(names.values()))
    declared = models.select("project", F.col("kind").alias("name"))
    flags = N.name_flags(declared, declared.where(F.col("name").isin(*KINDS_SHIPPED)), models.select("project", "name"),
                         listed.where("error is null").select("project", "name"))
    return N.name_gate(flags, listed.where("error is not null")).select(
        F.col("project").alias("brand"), "status", "reason", "n_offenders", "n_unmet", "n_built_candidates")


# Expected verdict per labelled bucket (brand number mod 4).
BUCKETS = ("gold", "bad", "control", "content")
EXPECTED = {"gold": "pass", "bad": "violation", "control": "pass", "content": "pass"}


@query("gate_validation", sql="WITH " + NAME_CTE + """,
labelled AS (
  SELECT CASE CAST(substring(project, 7, 4) AS INTEGER) % 4
              WHEN 0 THEN 'gold' WHEN 1 THEN 'bad' WHEN 2 THEN 'control' ELSE 'content' END
         AS bucket, status FROM gated)
SELECT bucket, count(*) AS runs,
       count(*) FILTER (WHERE status = CASE bucket WHEN 'bad' THEN 'violation' ELSE 'pass' END)
         AS agree
FROM labelled GROUP BY bucket
""")
def gate_validation(spark, sf_dir) -> DataFrame:
    g = gate_table(spark, sf_dir)
    idx = F.pmod(F.substring("project", 7, 4).cast("int"), F.lit(4))
    bucket = F.element_at(F.array(*[F.lit(b) for b in BUCKETS]), idx + 1)
    expected = F.create_map(*[F.lit(x) for kv in EXPECTED.items() for x in kv])[bucket]
    return (g.select(bucket.alias("bucket"), (F.col("status") == expected).alias("ok"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("runs"),
                                   F.count_if("ok").alias("agree")))


# Declared domain for the drift check: every p_type but PROMO.
DECLARED_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")


@query("domain_drift", sql="""
WITH spec AS (SELECT DISTINCT p_brand || '/' || p_size AS project, p_type AS value FROM part),
projects AS (SELECT DISTINCT p_brand || '/' || p_size AS project FROM part),
both_sides AS (
  SELECT project, value, true AS in_spec, false AS in_declared FROM spec
  UNION ALL SELECT project, unnest(['ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD']), false, true
  FROM projects),
flags AS (SELECT project, value, bool_or(in_spec) AS s, bool_or(in_declared) AS d
          FROM both_sides GROUP BY project, value)
SELECT project AS brand, count(*) FILTER (WHERE s) AS n_spec,
       count(*) FILTER (WHERE d AND NOT s) AS n_missing,
       count(*) FILTER (WHERE s AND NOT d) AS n_extra,
       count(*) FILTER (WHERE s <> d) = 0 AS equal
FROM flags GROUP BY project
""")
def domain_drift(spark, sf_dir) -> DataFrame:
    """A project is a brand and size; each of its parts has a spec text
    whose ``kind`` entry quotes the part's type, between entries that quote others."""
    from rampart.operators.domains import domain_drift as drift
    from rampart.operators.domains import domain_from_spec
    t = load_tables(spark, sf_dir)
    project = F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string"))
    text = F.concat(F.lit("  - name: label\n    description: 'NOT THIS'\n  - name: kind\n    description: one of '"),
                    F.col("p_type"), F.lit("'\n  - name: other\n    description: 'NOR THIS'\n"))
    spec = t.part.select(project.alias("project"), F.explode(domain_from_spec(text, "kind")).alias("value"))
    projects = t.part.select(project.alias("project"))
    return drift(spec, projects, DECLARED_TYPES).withColumnRenamed("project", "brand")


# ---------------------------------------------------------------------------
# Policy stack over per-group verdicts from orders
# ---------------------------------------------------------------------------
STACK_LOG_CTE = """
grp AS (
  SELECT o_custkey % 100 AS grp, count(*) AS n,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
         count(*) FILTER (WHERE o_totalprice > 450000) AS n_hi,
         count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS n_ns
  FROM orders GROUP BY 1),
log AS (
  SELECT grp, 'namegate' AS policy, 1 AS ord,
         CASE WHEN grp % 9 = 0 THEN 'error' WHEN n_p * 3 > n THEN 'violation' ELSE 'pass' END
           AS status,
         CASE WHEN grp % 9 = 0 THEN 0 ELSE n_p END AS checked_rows,
         CASE WHEN grp % 9 = 0 THEN 'could not evaluate'
              ELSE printf('%d/%d rows flagged', n_p, n) END AS message
  FROM grp
  UNION ALL
  SELECT grp, 'discount', 2,
         CASE WHEN grp % 7 = 0 THEN 'error' WHEN n_hi * 10 > n THEN 'violation' ELSE 'pass' END,
         CASE WHEN grp % 7 = 0 THEN 0 ELSE n END,
         CASE WHEN grp % 7 = 0 THEN 'could not evaluate'
              ELSE printf('%d/%d rows flagged', n_hi, n) END
  FROM grp
  UNION ALL
  SELECT grp, 'enum', 3,
         CASE WHEN grp % 11 = 0 THEN 'error' WHEN n_ns * 5 > n THEN 'violation' ELSE 'pass' END,
         CASE WHEN grp % 11 = 0 THEN 0 ELSE n END,
         CASE WHEN grp % 11 = 0 THEN 'could not evaluate'
              ELSE printf('%d/%d rows flagged', n_ns, n) END
  FROM grp)
"""


def stack_log(t) -> DataFrame:
    o = t.orders
    grp = o.groupBy(F.pmod(F.col("o_custkey"), F.lit(100)).alias("grp")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_p"),
        F.count_if(F.col("o_totalprice") > 450000).alias("n_hi"),
        F.count_if(F.col("o_orderpriority") == "4-NOT SPECIFIED").alias("n_ns"))
    specs = [("namegate", 1, 9, F.col("n_p"), F.col("n_p") * 3 > F.col("n"), F.col("n_p")),
             ("discount", 2, 7, F.col("n_hi"), F.col("n_hi") * 10 > F.col("n"), F.col("n")),
             ("enum", 3, 11, F.col("n_ns"), F.col("n_ns") * 5 > F.col("n"), F.col("n"))]
    out = None
    for name, ord_, mod, bad, violated, checked in specs:
        err = F.pmod(F.col("grp"), F.lit(mod)) == 0
        part = grp.select(
            "grp", F.lit(name).alias("policy"), F.lit(ord_).alias("ord"),
            F.when(err, "error").when(violated, "violation").otherwise("pass").alias("status"),
            F.when(err, F.lit(0).cast("bigint")).otherwise(checked).alias("checked_rows"),
            F.when(err, F.lit("could not evaluate"))
             .otherwise(F.format_string("%d/%d rows flagged", bad, F.col("n"))).alias("message"))
        out = part if out is None else out.unionByName(part)
    return out


@query("policy_stack", sql="WITH " + STACK_LOG_CTE + """,
agg AS (
  SELECT grp, count(*) AS n, count(*) FILTER (WHERE status = 'error') AS n_error,
         min(ord) FILTER (WHERE status = 'violation') AS viol_ord,
         sum(coalesce(checked_rows, 0)) AS sum_checked,
         string_agg(policy, '+' ORDER BY ord) AS names,
         string_agg(policy || ': ' || message, '; ' ORDER BY ord) AS msgs,
         min(ord) AS first_ord
  FROM log GROUP BY grp)
SELECT a.grp,
       CASE WHEN viol_ord IS NOT NULL THEN 'violation' WHEN n_error = n THEN 'error'
            ELSE 'pass' END AS status,
       CASE WHEN viol_ord IS NOT NULL THEN v.policy WHEN n_error = n OR n = 1 THEN f.policy
            ELSE names END AS policy,
       CAST(CASE WHEN viol_ord IS NOT NULL
                 THEN (SELECT count(*) FROM log l WHERE l.grp = a.grp AND l.ord <= a.viol_ord)
                 ELSE n END AS BIGINT) AS evaluated,
       CAST(CASE WHEN viol_ord IS NOT NULL THEN v.checked_rows
                 WHEN n_error = n THEN f.checked_rows ELSE sum_checked END AS BIGINT)
         AS checked_rows,
       CASE WHEN viol_ord IS NOT NULL THEN v.message WHEN n_error = n OR n = 1 THEN f.message
            ELSE msgs END AS message
FROM agg a
LEFT JOIN log v ON v.grp = a.grp AND v.ord = a.viol_ord
LEFT JOIN log f ON f.grp = a.grp AND f.ord = a.first_ord
""")
def policy_stack(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return S.stack_verdicts(stack_log(t), "grp")


# ---------------------------------------------------------------------------
# Verdict log from events: retry loop and outcome classes
# ---------------------------------------------------------------------------
# Fragments that the outcome classes look for.  The stand-in error
# checks choose one by event_id mod 4.
ERROR_MESSAGES = (
    "target table charge_history not materialized",
    "source table charge_data missing from produced DB",
    "no discount rows found to check (join produced 0 rows)",
    "checker raised: KeyError: total_line_items_price",
)


def check_log(t) -> DataFrame:
    e = t.events.where(F.col("event_type").isin("error", "purchase", "view"))
    status = (F.when(F.col("event_type") == "error", "violation")
              .when(F.col("event_type") == "purchase", "pass").otherwise("error"))
    msg = F.when(status == "error", F.element_at(
        F.array(*[F.lit(m) for m in ERROR_MESSAGES]),
        (F.pmod(F.col("event_id"), F.lit(4)) + 1).cast("int"))) \
        .otherwise(F.concat(status, F.lit(" on check")))
    return e.select("user_id", "ts", "event_id", status.alias("status"), msg.alias("message"))


CHECK_CTE = """
checks AS (
  SELECT user_id, ts, event_id,
         CASE event_type WHEN 'error' THEN 'violation' WHEN 'purchase' THEN 'pass'
              ELSE 'error' END AS status,
         CASE WHEN event_type = 'view' THEN CASE event_id % 4
                WHEN 0 THEN 'target table charge_history not materialized'
                WHEN 1 THEN 'source table charge_data missing from produced DB'
                WHEN 2 THEN 'no discount rows found to check (join produced 0 rows)'
                ELSE 'checker raised: KeyError: total_line_items_price' END
              ELSE (CASE event_type WHEN 'error' THEN 'violation' ELSE 'pass' END) || ' on check'
         END AS message
  FROM events WHERE event_type IN ('error', 'purchase', 'view')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
           FROM checks),
firsts AS (SELECT user_id, count(*) AS n_checks,
                  min(pos) FILTER (WHERE status <> 'violation') AS k FROM ranked GROUP BY user_id),
trace AS (
  SELECT f.user_id, f.n_checks,
         CASE WHEN k IS NOT NULL THEN least(k, 4) ELSE least(n_checks, 4) END AS used,
         CASE WHEN k IS NOT NULL AND k <= 4 THEN r.status ELSE 'violation' END AS final_status
  FROM firsts f LEFT JOIN ranked r ON r.user_id = f.user_id AND r.pos = f.k)
"""


def trace_table(spark, sf_dir) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return S.retry_trace(check_log(t), run="user_id", cap=CAP)


@query("retry_trace", sql="WITH " + CHECK_CTE + """
SELECT user_id, n_checks, used AS checks_used, used - 1 AS retries_used, final_status,
       (final_status = 'violation' AND used = 4) AS cap_hit,
       repeat('violation,', CAST(used - 1 AS INTEGER)) || final_status AS rounds
FROM trace
""")
def retry_trace(spark, sf_dir) -> DataFrame:
    return trace_table(spark, sf_dir)


OUTCOME_SQL = """,
first_check AS (SELECT user_id, status AS first_status, message AS first_message
                FROM ranked WHERE pos = 1),
outcome AS (
  SELECT u.user_id, fc.user_id IS NOT NULL AS has_checks, fc.first_status, t.final_status AS last_status,
         coalesce(t.used - 1, 0) AS retries_used,
         CASE WHEN fc.user_id IS NULL THEN 'no-policy-or-no-settle'
              WHEN fc.first_status IN ('violation', 'pass') THEN fc.first_status
              WHEN fc.first_message LIKE '%not materialized%' THEN 'no-target-table'
              WHEN fc.first_message LIKE '%missing from produced DB%' THEN 'missing-source-table'
              WHEN fc.first_message LIKE '%no discount rows%' THEN 'no-discount-rows'
              ELSE 'error: ' || substring(fc.first_message, 1, 40) END AS fired_reason
  FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN trace t ON t.user_id = u.user_id
  LEFT JOIN first_check fc ON fc.user_id = u.user_id),
classed AS (
  SELECT *, has_checks AND first_status IN ('violation', 'pass') AS fired,
         CASE WHEN NOT has_checks THEN 'no-policy'
              WHEN first_status = 'pass' THEN 'passed-first-try'
              WHEN first_status = 'error' THEN 'never-fired(' || fired_reason || ')'
              WHEN last_status = 'pass' THEN 'fixed-after-' || CAST(retries_used AS VARCHAR) || '-retry'
              ELSE 'cap-hit-still-' || last_status END AS dfc_class
  FROM outcome)
"""


def outcome_table(spark, sf_dir) -> DataFrame:
    """P7, P8 of every run; one without checks has class ``no-policy``."""
    t = load_tables(spark, sf_dir)
    log = check_log(t)
    first = log.groupBy("user_id").agg(
        F.min_by(F.struct("status", "message"), F.struct("ts", "event_id")).alias("f"))
    tr = S.retry_trace(log, run="user_id", cap=CAP)
    j = t.events.select("user_id").distinct().join(tr.join(first, "user_id"), "user_id", "left")
    fs, ls, r = F.col("f.status"), F.col("final_status"), F.col("retries_used")
    has = fs.isNotNull()
    reason = F.when(has, S.fired_reason(fs, F.col("f.message"))).otherwise("no-policy-or-no-settle")
    return j.select("user_id", has.alias("has_checks"), fs.alias("first_status"), ls.alias("last_status"),
                    F.coalesce(r, F.lit(0)).alias("retries_used"), reason.alias("fired_reason"),
                    (has & fs.isin("violation", "pass")).alias("fired"),
                    F.when(has, S.policy_class(fs, ls, r, reason)).otherwise("no-policy").alias("dfc_class"))


@query("policy_outcome", sql="WITH " + CHECK_CTE + OUTCOME_SQL + """
SELECT user_id, first_status, last_status, retries_used, fired_reason, fired, dfc_class
FROM classed
""")
def policy_outcome(spark, sf_dir) -> DataFrame:
    return outcome_table(spark, sf_dir).drop("has_checks")
