"""Transforms (T1-T6), text jobs (H3-H12, H15, E7/E8) and sinks."""

import datetime as dt
import json
import tempfile

from pyspark.sql import functions as F

from rampart.operators import text as X
from rampart.operators import transforms as T
from rampart.sources import sinks


def test_active_months_first_value_and_never_negative(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 31)),
                                (2, dt.date(2024, 3, 1))], "c long, d date")
    got = sorted((r.c, r.months) for r in T.active_months(df, entity="c", day="d").collect())
    assert got == [(1, 0.03), (1, 1.03), (2, 0.03)]


def test_spine_clamped_to_last_activity(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 3))],
                               "e string, d date")
    s = T.daily_spine(df, entity="e", day="d", start="2024-01-01",
                      measures=[F.count(F.lit(1)).alias("n")])
    rows = sorted((r.e, str(r.day), r.n) for r in s.collect())
    assert len(rows) == 6 and max(r[1] for r in rows) == "2024-01-03"
    assert ("a", "2024-01-02", None) in rows


def test_running_totals_exact(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 0.1), (1, dt.date(2024, 1, 1), 0.2),
                                (1, dt.date(2024, 1, 2), 0.3)], "c long, d date, a double")
    got = [(r.daily, r.running) for r in T.running_totals(df, entity="c", day="d", amount="a")
           .orderBy("day").collect()]
    assert got == [(0.3, 0.3), (0.3, 0.6)]


def test_charge_history_numbering(spark):
    df = spark.createDataFrame([(7, 1, 10.0, 0.5), (7, 2, 20.0, 1.0)], "o long, ln int, p double, t double")
    h = T.charge_history(df, charge="o", kinds={"charge line": F.col("p"), "tax": F.col("t")},
                         order_tie=["ln"])
    got = [(r.charge_row_num, r.line_item_type, r.amount) for r in h.orderBy("charge_row_num").collect()]
    assert got == [(1, "charge line", 10.0), (2, "charge line", 20.0), (3, "tax", 0.5), (4, "tax", 1.0)]


def test_missing_nodes_dedupe_in_order_and_trigger(spark):
    log = ("x\nDid not find matching node for patch with name 'b' in the 'models' section of file 'f.yml'\n"
           "Did not find matching node for patch with name 'a'\n"
           "Did not find matching node for patch with name 'b' in the 'models' section of file 'f.yml'\n"
           "Done. PASS=1 ERROR=0")
    df = spark.createDataFrame([(1, log), (2, "fine\n  Compilation Error in x  \n"), (3, "ok")],
                               "id long, log string")
    hits = df.select("id", X.missing_nodes(F.col("log")).alias("h"), X.triggered(F.col("log")).alias("t"))
    got = {r.id: ([(h.name, h.path) for h in r.h], r.t) for r in hits.collect()}
    assert got[1] == ([("b", "f.yml"), ("a", "")], False)
    assert got[2] == ([], True) and got[3] == ([], False)
    ft = {r.id: r.first_trigger for r in X.first_trigger_lines(df, "id", "log").collect()}
    assert ft == {2: "Compilation Error in x"}


def test_thought_action_and_fences(spark):
    rs = ["Thought: think\nAction: Bash(code=\"a\")\nObservation: o",
          "no thought here\nObservation: o",
          "Thought: t\nAction: CreateFile(filepath=\"m.sql\"):\n```\nselect 1\n",
          "Thought: t\nAction: CreateFile(filepath=\"m.sql\"):\n```\nselect 1\n```",
          "plain"]
    df = spark.createDataFrame([(r,) for r in rs], "r string")
    got = [(x.th, x.ac, x.tr) for x in df.select(
        X.thought(F.col("r")).alias("th"), X.action_text(F.col("r")).alias("ac"),
        X.truncated_file_action(F.col("r")).alias("tr")).collect()]
    assert got[0] == ("think", 'Bash(code="a")', False)
    assert got[1] == (rs[1], "no thought here", False)
    assert got[2][2] is True and got[3][2] is False
    assert got[4] == ("plain", "plain", False)
    u = df.select(X.unescape_action(F.lit("a\\_b '''x'''")).alias("u")).first().u
    assert u == "a_b ```x```"


def test_message_split_and_window(spark):
    msgs = spark.createDataFrame(
        [(1, 0, "system", " sys A "), (1, 1, "system", ""), (1, 2, "user", "u"),
         (1, 3, "assistant", "a"), (2, 0, "user", "q")] +
        [(3, i, "user" if i % 2 else "assistant", f"m{i}") for i in range(9)],
        "c long, p long, role string, text string")
    got = {r.c: (r.system_text, r.n_messages) for r in
           X.split_messages(msgs, conv="c", pos="p", role="role", text="text").collect()}
    assert got[1] == ("sys A", 2) and got[2] == ("", 1)
    w = X.context_window(msgs, conv="c", pos="p", memory=2)
    kept = sorted(r.p for r in w.where("c = 3 AND variant = 'window'").collect())
    assert kept == [0, 5, 6, 7, 8]
    dropped = sorted(r.p for r in w.where("c = 3 AND variant = 'overflow'").collect())
    assert dropped == [0, 3, 4, 5, 6, 7, 8]


def test_export_keys_and_order(spark):
    steps = spark.createDataFrame([(1, 2, "obs", None, "act", "resp"), (1, 1, "o1", "t1", "a1", "r1")],
                                  "c long, p long, observation string, thought string, action string, "
                                  "response string")
    heads = spark.createDataFrame([(1, "task", None, True, None), (2, None, "s", False, "x")],
                                  "c long, task string, system_message string, finished boolean, "
                                  "result string")
    docs = {r.c: json.loads(r.json) for r in X.export_trajectory(steps, heads, conv="c", pos="p").collect()}
    assert list(docs[1]) == ["Task", "system_message", "trajectory", "finished", "result"]
    assert [list(s) for s in docs[1]["trajectory"]] == [["observation", "thought", "action", "response"]] * 2
    assert docs[1]["trajectory"][1]["thought"] == "" and docs[1]["result"] == ""
    assert docs[2]["trajectory"] == [] and docs[2]["Task"] == ""


def test_sink_roundtrip(spark):
    df = spark.createDataFrame([("t1", "r1", "pass", 3), ("t2", "r2", "violation", 1)],
                               "task string, run string, status string, checked_rows long")
    for fmt in ("json", "parquet"):
        out = tempfile.mkdtemp(prefix="rampart-sink-")
        sinks.write_records(df, out, fmt=fmt, partition_by=["task"])
        back = sinks.read_records(spark, out, fmt=fmt)
        got = sorted((r.task, r.run, r.status, r.checked_rows) for r in back.collect())
        assert got == [("t1", "r1", "pass", 3), ("t2", "r2", "violation", 1)]


def test_spine_starts_at_the_first_day(spark):
    rows = [("a", dt.date(1994, 12, 31), 1.0), ("a", dt.date(1995, 1, 2), 2.0), ("b", dt.date(1995, 1, 1), 4.0), ("b", None, 9.0)]
    df = spark.createDataFrame(rows, "e string, d date, v double")
    spine = lambda **kw: [(r.e, str(r.day), r.s) for r in T.daily_spine(
        df, entity="e", day="d", measures=[F.sum("v").alias("s")], **kw).orderBy("e", "day").collect()]
    assert spine() == [("a", "1994-12-31", 1.0), ("a", "1995-01-01", None), ("a", "1995-01-02", 2.0),
                       ("b", "1994-12-31", None), ("b", "1995-01-01", 4.0), ("b", "1995-01-02", None)]
    assert spine(start="1995-01-02") == [("a", "1995-01-02", 2.0), ("b", "1995-01-02", None)]
    assert spine(start="1995-01-03") == []


def test_charge_history_conditional_kind(spark):
    df = spark.createDataFrame([(7, 1, 10.0, True), (7, 2, None, False)], "o long, ln int, p double, r boolean")
    h = T.charge_history(df, charge="o", kinds={"charge line": F.col("p"), "refund": (-F.col("p"), F.col("r"))},
                         order_tie=["ln"], carry={"flag": F.col("r")})
    got = sorted((r.charge_row_num, r.line_item_type, r.source_index, r.amount, r.flag) for r in h.collect())
    assert got == [(1, "charge line", 0, None, False), (2, "charge line", 0, 10.0, True), (3, "refund", 1, -10.0, True)]


def test_product_rollup_averages(spark):
    df = spark.createDataFrame([(1, 5, 1, 2.0, 10.0, 0.1, 0.2, "R"), (1, 5, 1, 2.0, 10.0, 0.1, 0.2, "N"), (1, 6, 1, 4.0, 20.0, 0.0, 0.0, "N")],
                               "p long, o long, ln int, q double, a double, d double, t double, f string")
    r = T.product_rollup(df, product="p", line_key=["o", "ln"], quantity="q", price="a", discount="d", tax="t",
                         refunded=F.col("f") == "R").first()
    assert (r.lines, r.quantity, r.net_quantity, r.subtotal, r.net) == (2, 8.0, 6.0, 40.0, 30.0)
    assert (r.avg_per_line, r.avg_quantity_per_line, r.avg_discount_per_line) == (20.0, 4.0, 1.0)


def test_flattened_content(spark):
    raws = ["plain", '[{"type": "text", "text": "a"}, {"type": "image"}, "b"]', "[not json", None, "", '{"type": "text", "text": "x"}']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    assert [r.t for r in df.select(X.flatten_content(F.col("raw")).alias("t")).collect()] == [
        "plain", "a\nb", "[not json", "", "", '{"type": "text", "text": "x"}']
