"""Runs (X1, H6, H7, E9, H16, B9-B11, H18) and golden report tables."""

import pytest
from pyspark.sql import functions as F

from rampart.operators import reports as X
from rampart.operators import runs as R


def test_validity_order(spark):
    rows = [(False, 0, 0, None, False, False), (True, 0, 0, "ENOTFOUND", False, False),
            (True, 10, 2, "ENOTFOUND", False, False), (True, 10, 2, "ENOTFOUND", True, False),
            (True, 10, 2, None, False, False), (True, 10, 2, None, True, True),
            (True, 10, 2, None, True, False), (True, 0, 3, None, True, False)]
    df = spark.createDataFrame(rows, "rec boolean, tok long, tools long, net string, "
                                     "settled boolean, timed_out boolean")
    got = [r.s for r in df.select(R.validity_class(
        F.col("rec"), F.col("tok"), F.col("tools"), F.col("net"), F.col("settled"),
        F.col("timed_out")).alias("s")).collect()]
    assert got == ["MISSING", "VOID_NO_MODEL", "VOID_NETWORK", "VALID", "VOID_TIMEOUT",
                   "VOID_TIMEOUT", "VALID", "VALID"]


def test_defensive_token_cast(spark):
    df = spark.createDataFrame([("12",), ("n/a",), (None,)], "x string")
    assert [r.v for r in df.select(R.defensive_long(F.col("x")).alias("v")).collect()] == [12, 0, 0]


def test_reroot(spark):
    df = spark.createDataFrame([
        ("/old/root/exp1/_pi_meta/t/trajectory.jsonl", "exp1"),
        ("C:\\old\\exp1\\x\\exp1\\db.duckdb", "exp1"),
        ("/somewhere/else.jsonl", "exp1"), (None, "exp1")], "p string, run string")
    got = [r.r for r in df.select(R.reroot(F.col("p"), F.col("run"), F.lit("/runs")).alias("r"))
           .collect()]
    assert got == ["/runs/exp1/_pi_meta/t/trajectory.jsonl", "/runs/exp1/db.duckdb", None, None]


def test_resolution_priority_and_glob_guard(spark):
    cands = spark.createDataFrame([
        ("a", "/a/reroot", 1), ("a", "/a/stored", 4),
        ("b", "/b/g1", 3), ("b", "/b/stored", 4),
        ("c", "/c/g1", 3), ("c", "/c/g2", 3), ("c", "/c/stored", 4)],
        "run string, path string, priority int")
    listing = spark.createDataFrame([(p,) for p in ["/a/reroot", "/a/stored", "/b/g1",
                                                    "/b/stored", "/c/g1", "/c/g2", "/c/stored"]],
                                    "path string")
    got = {r.run: r.resolved for r in R.resolve_first_existing(cands, listing, glob_priority=3)
           .collect()}
    assert got == {"a": "/a/reroot", "b": "/b/g1", "c": "/c/stored"}


def test_shallowest_pick(spark):
    files = spark.createDataFrame([
        ("r1", "/x/gold/db.duckdb"), ("r1", "/x/a/db.duckdb"), ("r1", "/x/a/b/db.duckdb"),
        ("r2", "/y/a/db.duckdb"), ("r2", "/y/b/db.duckdb")], "run string, path string")
    got = {r.run: (r.picked, r.status) for r in R.pick_shallowest(files).collect()}
    assert got == {"r1": ("/x/a/db.duckdb", "ok"), "r2": (None, "ambiguous")}


def test_config_state_branches(spark):
    blocker = "  order: \"{{ ref('order_data') }}\""
    ident = "  recharge_order_identifier: \"order_data\""
    rows = [("nf", blocker), ("fixed", "# order"), ("fixed", ident), ("changed", "# order"),
            ("vars", blocker), ("vars", "  recharge__using_orders: True"),
            ("both", "recharge__using_orders:  true  "), ("false", blocker),
            ("false", "recharge__using_orders: false")]
    df = spark.createDataFrame(rows, "run string, line string")
    got = {r.run: r.state for r in R.config_state(df).collect()}
    assert got == {"nf": "NOT-FIXED", "fixed": "FIXED", "changed": "CHANGED", "vars": "FIXED-vars",
                   "both": "FIXED-both", "false": "NOT-FIXED"}


def test_kind_selection_retry_and_ids(spark):
    df = spark.createDataFrame([("bq1",), ("ga2",), ("local3",), ("sf_x",), ("ch01",),
                                ("postgres9",), ("recharge001",)], "id string")
    assert [r.k for r in df.select(R.task_kind(F.col("id")).alias("k")).collect()] == [
        "bq", "bq", "local", "sf", "ch", "pg", "dbt"]
    rr = spark.createDataFrame([(True, True, "done"), (True, True, "FAIL x"), (True, True, "Error"),
                                (True, False, "done"), (False, None, None)],
                               "ex boolean, fin boolean, res string")
    act = [r.a for r in rr.select(R.retry_action(F.col("ex"), F.col("fin"), F.col("res"),
                                                 overwriting=True, retry_failed=True).alias("a"))
           .collect()]
    assert act == ["skip", "retry", "retry", "retry", "run"]
    ids = spark.createDataFrame([("recharge001", "off", 1), ("shopify001", "generic", 2)],
                                "t string, a string, i int")
    got = [(r.e, r.arm) for r in ids.select(
        R.exp_id("nudge", F.col("t"), F.col("a"), F.col("i"), "recharge001").alias("e"))
        .select("e", R.arm_of(F.col("e")).alias("arm")).collect()]
    assert got == [("nudge-off-r1", "off"), ("nudge-shopify001-generic-r2", "generic")]


# Golden trial rows transcribed from the reference's recorded nine-run batch
# (task recharge001): (run, wrong_name, scored_built, first_wrong,
# first_target, first_notice, missing-node warnings, score).
GOLDEN = [
    ("nudge-off-r1", True, False, 15, None, None, 2, 0),
    ("nudge-off-r2", True, False, 14, None, None, 1, 0),
    ("nudge-off-r3", True, False, 7, None, None, 2, 0),
    ("nudge-generic-r1", False, True, None, 16, 17, 0, 0),
    ("nudge-generic-r2", False, True, 6, 19, 9, 1, 0),
    ("nudge-generic-r3", False, True, None, 8, 9, 0, 0),
    ("nudge-specific-r1", False, True, 13, 23, 14, 1, 0),
    ("nudge-specific-r2", False, True, 7, 14, 8, 1, 0),
    ("nudge-specific-r3", False, True, 15, 23, 16, 1, 0),
]


def golden_rows(spark):
    from rampart.operators.events import causal_flags
    df = spark.createDataFrame(GOLDEN, "exp string, wrong_name boolean, scored_all_built boolean, "
                                       "fw int, ft int, fn int, n_missing_node_warn int, score int")
    return df.select("*", F.lit("recharge001").alias("task"), F.lit("VALID").alias("validity"),
                     R.arm_of(F.col("exp")).alias("arm"),
                     *causal_flags(F.col("fw"), F.col("ft"), F.col("fn")))


def test_golden_arm_table(spark):
    got = {r.arm: (r.valid, r.total, r.wrong, r.scored_built, r.trap, r.conv, r.passed)
           for r in X.arm_table(golden_rows(spark)).collect()}
    # off 3/3 valid, wrong 3/3, built 0/3, trap 3/3, conv 0/3;
    # generic wrong 0/3, built 3/3, trap 1/3, conv/trap 1/1; specific trap 3/3, conv 3/3
    assert got == {"off": (3, 3, 3, 0, 3, 0, 0), "generic": (3, 3, 0, 3, 1, 1, 0),
                   "specific": (3, 3, 0, 3, 3, 3, 0)}


def test_golden_baseline_and_overfit(spark):
    rows = golden_rows(spark)
    b = {r.task: (r.base_valid, r.with_warning, r.warned_converted)
         for r in X.baseline_signal(rows).collect()}
    assert b["recharge001"] == (3, 3, 0)
    o = X.overfit_flag(rows).collect()[0]
    assert o.status == "ok"


def test_arm_without_valid_rows_and_zero_trap(spark):
    df = golden_rows(spark).withColumn(
        "validity", F.when(F.col("arm") == "off", F.lit("MISSING")).otherwise(F.col("validity")))
    got = {r.arm: r for r in X.arm_table(df).collect()}
    assert got["off"].valid == 0 and got["off"].unread == 3 and got["off"].wrong_rate is None
    assert got["off"].no_valid_trials
    pooled = X.arm_table_pooled(golden_rows(spark)).where("pooled").collect()
    assert sorted(r.arm for r in pooled) == ["generic", "off", "specific"]


# ---- trial rows from their parts ----------------------------------------------------------

def _golden_parts(spark, tmp_path, broken=False):
    """The nine recorded runs as files, paths, names and indices: what the report reads."""
    import json

    from rampart.operators import names as N
    from rampart.sources import records as A
    exps = [g[0] for g in GOLDEN]
    for i, (exp, *_, score) in enumerate(GOLDEN):
        rec = {"instance_id": "recharge001", "settled": True, "timed_out": False, "score": score, "n_tool_calls_total": 20 + i,
               "rounds": [{"usage": {"totalTokens": 1000}}, {"usage": None}, {"usage": {"totalTokens": "n/a"}}]}
        (tmp_path / f"{exp}.stdout.json").write_text(json.dumps(rec))
    if broken:
        (tmp_path / "nudge-off-r1.stdout.json").unlink()
        (tmp_path / "nudge-off-r2.stdout.json").write_text("")
        (tmp_path / "nudge-off-r3.stdout.json").write_text('{"settled": tr')
    grid = spark.createDataFrame([(e,) for e in exps], "exp string").select(
        "exp", F.lit("recharge001").alias("task"), R.arm_of(F.col("exp")).alias("arm"))
    recs = A.expected_records(grid.select("exp"), A.parse_records(A.scan_record_files(spark, str(tmp_path))))
    recs = recs.select("*", *A.record_facts())
    recs = recs.select("exp", "problem", "score", "tokens", R.validity_class(
        F.col("problem").isNull(), F.col("tokens"), F.col("tools"), F.lit(None), F.col("settled"), F.col("timed_out")).alias("status"))
    paths = grid.select("exp", F.lit("/t").alias("trajectory"), F.lit("/d").alias("produced_db"))
    target, wrong = "charge_line_item_history", "charge_history_custom"
    pairs = "project string, name string"
    declared = spark.createDataFrame([(e, n) for e in exps for n in (target, "stg_charge")], pairs)
    shipped = spark.createDataFrame([(e, "stg_charge") for e in exps], pairs)
    made = [(g[0], target if g[2] else wrong) for g in GOLDEN]
    run = shipped.union(spark.createDataFrame(made, pairs))
    flags = N.name_flags(declared, shipped, run, run)
    gate = N.name_gate(flags).withColumnRenamed("project", "exp")
    listing = N.scored_listing(declared.where(F.col("name") == target), flags).withColumnRenamed("project", "exp")
    indices = spark.createDataFrame([(g[0], g[3], g[4], g[5], g[6]) for g in GOLDEN],
                                    "exp string, first_wrong int, first_target int, first_notice int, n_missing_node_warn int")
    return grid, recs, paths, gate, listing, indices


def test_golden_trial_rows_from_parts(spark, tmp_path):
    got = {r.exp: r for r in X.trial_rows(*_golden_parts(spark, tmp_path), run="exp").collect()}
    for exp, wrong, built, fw, ft, fn, warn, score in GOLDEN:
        r = got[exp]
        assert (r.validity, r.problems, r.wrong_name, r.target_built, r.scored_all_built, r.n_missing_node_warn, r.score) == (
            "VALID", "", wrong, built, built, warn, score)
        assert r.gate_status == ("violation" if wrong else "pass")
    assert [e for e in got if got[e].converted] == [e for e in got if got[e].entered_trap and "off" not in e]
    assert {e for e in got if got[e].correct_before_notice} == {"nudge-generic-r1", "nudge-generic-r3"}
    arms = {r.arm: (r.valid, r.total, r.wrong, r.scored_built, r.trap, r.conv, r.passed)
            for r in X.arm_table(X.trial_rows(*_golden_parts(spark, tmp_path), run="exp")).collect()}
    assert arms == {"off": (3, 3, 3, 0, 3, 0, 0), "generic": (3, 3, 0, 3, 1, 1, 0), "specific": (3, 3, 0, 3, 3, 3, 0)}


def test_every_unread_part_adds_its_cause(spark, tmp_path):
    grid, recs, paths, gate, listing, indices = _golden_parts(spark, tmp_path, broken=True)
    e = F.col("exp")
    paths = paths.withColumn("trajectory", F.when(~e.isin("nudge-generic-r1", "nudge-generic-r2"), F.col("trajectory"))) \
        .withColumn("produced_db", F.when(e != "nudge-generic-r1", F.col("produced_db")))
    gate, indices = gate.where("exp <> 'nudge-specific-r1'"), indices.where("exp not in ('nudge-specific-r1', 'nudge-off-r1')")
    rows = X.trial_rows(grid, recs, paths, gate, listing, indices, run="exp")
    got = {r.exp: r for r in rows.collect()}
    assert {x: (got[x].validity, got[x].problems) for x in got if got[x].validity != "VALID"} == {
        "nudge-off-r1": ("MISSING", "no record at nudge-off-r1.stdout.json"),
        "nudge-off-r2": ("MISSING", "no record at nudge-off-r2.stdout.json"),
        "nudge-off-r3": ("MISSING", "unparseable nudge-off-r3.stdout.json"),
        "nudge-generic-r1": ("UNREADABLE", "trajectory unresolved; produced database unresolved"),
        "nudge-generic-r2": ("UNREADABLE", "trajectory unresolved"),
        "nudge-specific-r1": ("UNREADABLE", "name gate could not read the database; trajectory not readable")}
    assert all(got[x].wrong_name is None and got[x].entered_trap is None and got[x].scored_built is None
               for x in got if got[x].validity != "VALID")
    assert {r.batch_status for r in X.not_counted(rows, "exp").collect()} == {"failure"}


def test_not_counted_statuses(spark):
    def status(rows):
        df = spark.createDataFrame(rows, "exp string, task string, validity string, problems string")
        return {(r.task, r.task_status, r.batch_status) for r in X.not_counted(df, "exp").collect()}
    gone = [("a1", "a", "MISSING", "no record"), ("a2", "a", "MISSING", "no record")]
    assert status(gone) == {("a", "skipped", "error")}
    assert status([*gone, ("b1", "b", "VALID", "")]) == {("a", "skipped", "ok")}
    assert status([*gone, ("b1", "b", "VALID", ""), ("b2", "b", "MISSING", "x")]) == {("a", "skipped", "ok"), ("b", "reported", "ok")}
    assert status([("b1", "b", "VOID_TIMEOUT", ""), ("b2", "b", "UNREADABLE", "x")]) == {("b", "reported", "failure")}


def test_graded_targets_are_not_any_target(spark):
    """A run that builds a declared model which is not graded: built, but not all scored ones."""
    from rampart.operators import names as N
    pairs = "project string, name string"
    declared = spark.createDataFrame([("p", "products"), ("p", "daily_shop"), ("q", "products"), ("q", "daily_shop")], pairs)
    made = spark.createDataFrame([("p", "daily_shop"), ("q", "products"), ("q", "extra")], pairs)
    flags = N.name_flags(declared, declared.limit(0), made, made)
    gate = {r.project: r for r in N.name_gate(flags).collect()}
    listing = {r.project: r for r in N.scored_listing(declared.where("name = 'products'"), flags).collect()}
    assert gate["p"].n_built_candidates == 1 and (listing["p"].n_scored, listing["p"].n_scored_built) == (1, 0)
    assert gate["q"].status == "pass" and listing["q"].scored_built == "products"


def test_record_files_of_every_kind(spark, tmp_path):
    from rampart.sources import records as A
    files = {"ok": b'{"score": 1, "settled": true, "n_tool_calls_total": "3"}', "empty": b"", "blank": b" \n", "broken": b'{"score": 1',
             "list": b"[1, 2]", "latin": b'{"score": "\xe9"}', "odd": b' {"score": "x", "rounds": [null, {"usage": {"totalTokens": 7}}], "new": [1]}'}
    for name, data in files.items():
        (tmp_path / f"{name}.stdout.json").write_bytes(data)
    (tmp_path / "notes.txt").write_text("{}")
    grid = spark.createDataFrame([(n,) for n in [*files, "absent"]], "exp string")
    recs = A.expected_records(grid, A.parse_records(A.scan_record_files(spark, str(tmp_path))))
    got = {r.exp: r for r in recs.select("exp", "problem", *A.record_facts()).collect()}
    assert {n: (got[n].problem or "").split(" ")[0] for n in got} == {
        "ok": "", "odd": "", "empty": "no", "absent": "no", "blank": "unparseable", "broken": "unparseable",
        "list": "unparseable", "latin": "unparseable"}
    assert (got["ok"].tools, got["ok"].score, got["odd"].tokens, got["odd"].score) == (3, 1, 7, None)


def test_outcome_histograms(spark):
    rows = [("passed-first-try", True, True, "pass", 0, 1), ("fixed-after-2-retry", True, True, "violation", 2, None),
            ("never-fired(no-target-table)", True, False, "no-target-table", 0, 0), ("no-policy", False, False, "no-policy-or-no-settle", 0, 1)]
    df = spark.createDataFrame(rows, "dfc_class string, has_checks boolean, fired boolean, fired_reason string, retries_used int, score int")
    assert {tuple(r) for r in X.outcome_histograms(df).collect()} == {
        ("class", "passed-first-try", 1), ("class", "fixed-after-2-retry", 1), ("class", "never-fired(no-target-tabl", 1),
        ("class", "no-policy", 1), ("fired", "fired", 2), ("fired", "not fired", 1), ("never-fired", "no-target-table", 1),
        ("outcome", "scored 1", 1), ("outcome", "scored 0", 1), ("retries", "0", 1), ("retries", "2", 1)}


@pytest.mark.parametrize("plain", [True, False])
def test_record_files_take_no_job_per_run(spark, tmp_path, monkeypatch, plain):
    """One file per record, empty ones of no bytes, by as many jobs for twenty empty records
    as for one; a folder that only Spark's writers reach gives the same."""
    from rampart.plans import run_plans as RP
    from rampart.sources import records as A
    if not plain:
        monkeypatch.setattr(RP, "plain_folder", lambda root: None)

    def run(name, ids):
        texts = spark.createDataFrame([(i, f"nudge-a-off-r{i}", "" if i % 2 else '{"a": "é"}') for i in ids], "user_id long, exp string, text string")
        monkeypatch.setattr(RP.I, "record_texts", lambda facts: facts)
        spark.sparkContext.setJobGroup(name, name)
        RP.write_record_files(texts, f"file:{tmp_path}/{name}")
        spark.sparkContext.setJobGroup("", "")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        empty = [x for x in (tmp_path / name).rglob("*r[0-9]*") if x.suffix == ".json" and not x.stat().st_size] or [
            x for x in (tmp_path / name).rglob("exp=*/part-*") if not x.stat().st_size]
        files = A.scan_record_files(spark, f"{tmp_path}/{name}" + RP.RECORD_FILES[0], *RP.RECORD_FILES[1:]).collect()
        return jobs, len(empty), sorted((r.exp, r.text.strip()) for r in files if r.bytes)
    few, empty, got = run("few", [1, 2])
    assert empty == 1 and got == [("nudge-a-off-r2", '{"a": "é"}')]
    many, empty, got = run("many", range(40))
    assert many <= few + 1 and empty == 20 and [e for e, _ in got] == sorted(f"nudge-a-off-r{i}" for i in range(0, 40, 2))
