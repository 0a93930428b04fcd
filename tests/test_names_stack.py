"""P4 name gate branches (names_small), YAML/SQL sources, P5-P8 (verdict_log)."""

import pytest
from pyspark.sql import functions as F

from rampart.operators import names as N
from rampart.operators import stack as S


def _sets(spark, declared, shipped, run, mat, project="p"):
    def df(names):
        return spark.createDataFrame([(project, n) for n in names], "project string, name string")
    return df(declared), df(shipped), df(run), df(mat)


@pytest.mark.parametrize("declared,shipped,run,mat,status,reason", [
    # right build
    (["a", "target"], ["a"], ["a", "target"], ["a", "target"], "pass", "declared-names"),
    # invented name, target not built -> violation
    (["a", "target"], ["a"], ["a", "mine"], ["a", "mine"], "violation", "undeclared-name"),
    # helper beside the right build -> not steered
    (["a", "target"], ["a"], ["a", "target", "helper"], ["a", "target", "helper"], "pass",
     "helper-beside-candidate"),
    # nothing created got built -> error
    (["a", "target"], ["a"], ["a"], ["a"], "error", "nothing-created-built"),
    # no candidates at all -> not applicable
    (["a"], ["a"], ["a", "x"], ["a", "x"], "pass", "not-applicable"),
    # a candidate that pre-existed in the database still counts as built
    (["a", "target"], ["a"], ["a", "mine"], ["a", "mine", "target"], "pass",
     "helper-beside-candidate"),
    # an edited fixture model is not "created"
    (["a", "target"], ["a"], ["a"], ["a", "target"], "error", "nothing-created-built"),
])
def test_gate_branches(spark, declared, shipped, run, mat, status, reason):
    g = N.name_gate(N.name_flags(*_sets(spark, declared, shipped, run, mat))).collect()[0]
    assert (g.status, g.reason) == (status, reason)


def test_yaml_and_sql_sources(spark, tmp_path):
    m = tmp_path / "proj1" / "models" / "sub"
    m.mkdir(parents=True)
    (m / "schema.yml").write_text(
        "version: 2\nmodels:\n  - name: orders_rollup\n    columns:\n      - name: id\n"
        "  - name: customers\n")
    (m / "broken.yml").write_text("models: [unclosed\n")
    (m / "orders_rollup.sql").write_text("select 1")
    (tmp_path / "proj1" / "models" / "stg_x.sql").write_text("select 2")
    dec = sorted((r.project, r.name) for r in N.declared_models(spark, str(tmp_path)).collect())
    assert dec == [("proj1", "customers"), ("proj1", "orders_rollup")]
    sql = sorted((r.project, r.name) for r in N.sql_inventory(spark, str(tmp_path)).collect())
    assert sql == [("proj1", "orders_rollup"), ("proj1", "stg_x")]


def _log(spark, rows):
    return spark.createDataFrame(rows, "run string, policy string, ord int, status string, "
                                       "checked_rows long, message string")


def test_stack_first_violation_wins_and_errors_never_mask(spark):
    log = _log(spark, [
        ("r1", "namegate", 1, "error", 0, "e1"), ("r1", "discount", 2, "violation", 7, "v2"),
        ("r1", "enum", 3, "violation", 9, "v3"),
        ("r2", "namegate", 1, "pass", 3, "ok1"), ("r2", "discount", 2, "error", 0, "e2"),
        ("r3", "namegate", 1, "error", 0, "e1"), ("r3", "discount", 2, "error", 0, "e2"),
        ("r4", "enum", 1, "violation", 5, "only"),
    ])
    got = {r.run: (r.status, r.policy, r.evaluated, r.checked_rows, r.message)
           for r in S.stack_verdicts(log, "run").collect()}
    assert got["r1"] == ("violation", "discount", 2, 7, "v2")
    assert got["r2"] == ("pass", "namegate+discount", 2, 3, "namegate: ok1; discount: e2")
    assert got["r3"] == ("error", "namegate", 2, 0, "e1")
    assert got["r4"] == ("violation", "enum", 1, 5, "only")


def test_stack_rejects_bad_lists():
    known = ["namegate", "discount", "enum"]
    assert S.validate_stack(["namegate", " discount"], known) == ["namegate", "discount"]
    for bad in ([], ["nope"], ["enum", "enum"]):
        with pytest.raises(ValueError):
            S.validate_stack(bad, known)


def test_retry_trace_and_outcome(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for run, statuses in {"fixed": ["violation", "violation", "pass"],
                          "cap": ["violation"] * 6, "first": ["pass", "violation"],
                          "err": ["error"], "short": ["violation", "violation"]}.items():
        for i, s in enumerate(statuses):
            rows.append((run, t0 + dt.timedelta(minutes=i), i, s))
    log = spark.createDataFrame(rows, "run string, ts timestamp_ntz, event_id long, status string")
    tr = {r.run: r for r in S.retry_trace(log, run="run", cap=3).collect()}
    assert (tr["fixed"].retries_used, tr["fixed"].final_status, tr["fixed"].cap_hit) == (2, "pass", False)
    assert tr["fixed"].rounds == "violation,violation,pass"
    assert (tr["cap"].checks_used, tr["cap"].final_status, tr["cap"].cap_hit) == (4, "violation", True)
    assert (tr["first"].retries_used, tr["first"].final_status) == (0, "pass")
    assert (tr["err"].final_status, tr["short"].cap_hit) == ("error", False)
    cls = F.col("c")
    df = spark.createDataFrame([("pass", "pass", 0, None), ("violation", "pass", 2, None),
                                ("violation", "violation", 3, None), (None, None, 0, None),
                                ("error", "error", 0, "target table x not materialized")],
                               "f string, l string, r int, m string")
    out = df.select(S.policy_class(F.col("f"), F.col("l"), F.col("r"),
                                   S.fired_reason(F.col("f"), F.col("m"))).alias("c"))
    assert [r.c for r in out.select(cls).collect()] == [
        "passed-first-try", "fixed-after-2-retry", "cap-hit-still-violation", "no-policy",
        "never-fired(no-target-table)"]
