"""Event analytics on events_small (A1, C3, D4, E1-E4) and the JSONL source."""

import datetime as dt

from pyspark.sql import functions as F

from rampart.operators import events as E
from rampart.sources.events import read_event_log

T0 = dt.datetime(2024, 1, 1)


def ev(spark, rows):
    return spark.createDataFrame(
        [(run, T0 + dt.timedelta(seconds=i), i, typ) for i, (run, typ) in enumerate(rows)],
        "run string, ts timestamp_ntz, event_id long, typ string")


def indices(spark, rows):
    e = ev(spark, rows)
    t = F.col("typ")
    out = E.first_indices(e, run="run", is_start=t != "notice",
                          markers={"wrong": (t == "wrong", False), "target": (t == "target", False),
                                   "notice": (t == "notice", True)},
                          after_counts={"rereads": ("notice", t == "read")})
    return {r.run: r for r in out.collect()}


def test_notice_takes_last_started_index(spark):
    # calls: read(0) wrong(1) notice -> index 1; read(2) target(3)
    r = indices(spark, [("a", "read"), ("a", "wrong"), ("a", "notice"), ("a", "read"),
                        ("a", "target")])["a"]
    assert (r.wrong, r.target, r.notice, r.rereads, r.n_calls) == (1, 3, 1, 1, 4)
    flags = ev(spark, [("x", "y")]).select(*E.causal_flags(F.lit(1), F.lit(3), F.lit(1))).first()
    # a write and its own notice share an index: neither trap nor ...
    assert (flags.entered_trap, flags.converted) == (False, False)


def test_notice_before_any_start_is_minus_one(spark):
    r = indices(spark, [("b", "notice"), ("b", "wrong"), ("b", "target")])["b"]
    assert (r.notice, r.wrong, r.target) == (-1, 0, 1)


def test_golden_trap_and_conversion_flags(spark):
    df = spark.createDataFrame([(6, 19, 9), (None, 16, 17), (None, 23, 10), (15, None, None)],
                               "w int, t int, n int")
    got = [tuple(r) for r in df.select(*E.causal_flags(F.col("w"), F.col("t"), F.col("n"))).collect()]
    assert got == [(True, True, False), (False, False, True), (False, False, False),
                   (True, False, False)]


def test_pairing_overwrite_unmatched_and_order(spark):
    rows = [("r", 1, "start", "bash"), ("r", 1, "start", "edit"), ("r", 1, "end", None),
            ("r", 2, "end", None), ("r", 3, "start", "read"), ("r", 1, "end", None)]
    df = spark.createDataFrame(
        [(run, cid, T0 + dt.timedelta(seconds=i), i, kind, tool)
         for i, (run, cid, kind, tool) in enumerate(rows)],
        "run string, cid long, ts timestamp_ntz, event_id long, kind string, tool string")
    steps = E.pair_steps(df, run="run", call_id="cid", is_start=F.col("kind") == "start",
                         is_end=F.col("kind") == "end", payload=["tool"])
    got = [(r.call_id, r.matched, r.start_tool) for r in steps.orderBy("ts").collect()]
    # later start overwrites; end without start unmatched; an end consumes its start;
    # the start without an end is dropped
    assert got == [(1, True, "edit"), (2, False, None), (1, False, None)]


def test_result_text_shapes(spark):
    raws = ['"plain"', '{"output": "out"}', '{"output": "", "content": [{"type": "text", '
            '"text": "a"}, {"type": "image"}, "b"]}', '{"other": 1}', '{"output": "trunc', None]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [r.t for r in df.select(E.result_text(F.col("raw")).alias("t")).collect()]
    assert got == ["plain", "out", "a\nb", '{"other": 1}', '{"output": "trunc', "{}"]


def test_jsonl_scan_keeps_file_order_and_skips_bad_lines(spark, tmp_path):
    d = tmp_path / "runA"
    d.mkdir()
    lines = []
    for i in range(3000):
        lines.append('{"type": "tool_execution_start", "i": %d}' % i)
        if i % 500 == 0:
            lines += ["", "{broken", '"just a string"']
    (d / "trajectory.jsonl").write_text("\n".join(lines) + "\n")
    df = read_event_log(spark, str(tmp_path), prefilter='"type"',
                        fields={"type": ("$.type", "string"), "i": ("$.i", "int")})
    got = [r.i for r in df.orderBy("file", "seq_block", "seq_line").collect()]
    assert got == list(range(3000))
    assert {r.run for r in df.select("run").distinct().collect()} == {"runA"}


def test_usage_dedup_by_timestamp_and_usage(spark):
    df = spark.createDataFrame([("r", 1, 10.0), ("r", 1, 10.0), ("r", 2, 10.0), ("r", 2, 5.0)],
                               "run string, ts long, usage double")
    tot = df.dropDuplicates(["run", "ts", "usage"]).groupBy("run").agg(F.sum("usage").alias("u"))
    assert tot.first().u == 25.0


def test_step_labels_fall_through_and_are_cut(spark):
    rows = [("dbt run", "p", None, "{}"), ("", "models/a.sql", "x", "{}"), (None, "", "pat", "{}"),
            (None, None, None, '{"k": "' + "y" * 200 + '"}'), ("c" * 700, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "c string, p string, t string, a string")
    got = [r.x for r in df.select(E.step_label(*[F.col(k) for k in "cpta"]).alias("x")).collect()]
    assert got == ["dbt run", "models/a.sql", "pat", ('{"k": "' + "y" * 200)[:120], "c" * 600, "{}"]


def test_usage_records_ignore_key_order(spark):
    rows = [("r", 1, '{"input": 3, "cost": {"total": 1.5}}'), ("r", 1, '{"cost": {"total": 1.5}, "input": 3}'),
            ("r", 1, '{"input": 4, "cost": {"total": 1.5}}'), ("r", 2, "{}")]
    df = spark.createDataFrame(rows, "run string, ts long, raw string")
    kept = df.select("run", "ts", E.usage_record(F.col("raw")).alias("u")).dropDuplicates(["run", "ts", "u"])
    assert kept.count() == 3 and kept.agg(F.sum("u.input")).first()[0] == 7
