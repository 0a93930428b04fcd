"""Skew: one run / group holding a third of all rows must give the same
answers as the plain window formulation (which would put it in one task)."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rampart.operators import events as E
from rampart.operators import ordering, skew
from rampart.operators.ordering import positions
from rampart.session import store

T0 = dt.datetime(2024, 1, 1)


def _skewed_events(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        run = "hot" if i % 3 == 0 else f"r{rnd.randrange(50)}"
        typ = rnd.choice(["read", "wrong", "target", "notice", "read"])
        rows.append((run, T0 + dt.timedelta(seconds=rnd.randrange(10**6)), i, typ))
    return spark.createDataFrame(rows, "run string, ts timestamp_ntz, event_id long, typ string")


def test_first_indices_equal_window_formulation_under_skew(spark):
    e = _skewed_events(spark)
    t = F.col("typ")
    got = {r.run: (r.wrong, r.target, r.notice, r.n_calls) for r in E.first_indices(
        e, run="run", is_start=t != "notice",
        markers={"wrong": (t == "wrong", False), "target": (t == "target", False),
                 "notice": (t == "notice", True)}).collect()}
    w = Window.partitionBy("run").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    s = (t != "notice").cast("int")
    idx = e.withColumn("before", F.sum(s).over(w) - s)
    ref = idx.groupBy("run").agg(
        F.min(F.when(t == "wrong", F.col("before"))).alias("wrong"),
        F.min(F.when(t == "target", F.col("before"))).alias("target"),
        F.min(F.when(t == "notice", F.col("before") - 1)).alias("notice"),
        F.sum(s).alias("n_calls"))
    want = {r.run: (r.wrong, r.target, r.notice, r.n_calls) for r in ref.collect()}
    assert got == want
    assert sum(1 for _ in range(3000) if _ % 3 == 0) == 1000   # the hot run holds a third


def test_positions_equal_row_number_under_skew(spark):
    e = _skewed_events(spark).select("run", "ts", "event_id")
    got = {(r.run, r.event_id): r.pos for r in
           positions(e, ["run"], ["ts", "event_id"]).collect()}
    w = Window.partitionBy("run").orderBy("ts", "event_id")
    want = {(r.run, r.event_id): r.rn for r in e.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def _plain(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


@pytest.fixture
def bare(spark, monkeypatch):
    """No broadcast, no coalescing, and small groups may be hot."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    _plain(spark)
    monkeypatch.setattr(skew, "LEAST_ROWS", 100)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", was)


def _small(e):
    return store(e.groupBy("run").agg(F.min("ts").alias("first"), F.count(F.lit(1)).alias("n")), "small")


def test_hot_group_falls_as_partitions_grow(bare):
    """A run with a third of the events: the more partitions, the fewer of its rows in one task."""
    e = _skewed_events(bare, n=12000)
    most = {}
    for parts in (4, 16, 64):
        bare.conf.set("spark.sql.shuffle.partitions", str(parts))
        out = skew.join_per_group(e, _small(e), ["run"], ["ts", "event_id"], "n")
        tasks = out.where("run = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in tasks) == 4000 and out.count() == 12000
        most[parts] = out.where("run = 'hot'").groupBy(skew.SALT).count().agg(F.max("count")).first()[0]
    assert most[4] >= 1500 and most[16] < 900 and most[64] < 260


def test_only_hot_groups_are_salted(bare):
    e = _skewed_events(bare, n=6000)
    small = _small(e)
    hot = skew.hot_groups(small, ["run"], "n")
    assert [(r.run, r._salts) for r in hot.collect()] == [("hot", 3)]
    out = skew.join_per_group(e, small, ["run"], ["ts", "event_id"], "n")
    assert {r.run for r in out.where(f"{skew.SALT} > 0").select("run").distinct().collect()} == {"hot"}
    assert skew.hot_groups(small.where("run <> 'hot'"), ["run"], "n") is None
    assert skew.hot_groups(small.limit(0), ["run"], "n") is None


def test_results_do_not_depend_on_salts(bare, monkeypatch):
    e, t = _skewed_events(bare), F.col("typ")

    def run():
        first = E.first_indices(e, run="run", is_start=t != "notice", markers={"wrong": (t == "wrong", False), "notice": (t == "notice", True)},
                                after_counts={"later": ("notice", t == "read")}, totals={"reads": t == "read"})
        last = E.last_positions(e, run="run", keep=t == "wrong", n=3, payload=["typ"])
        return sorted(map(tuple, first.collect())), sorted(map(tuple, last.collect()))
    split = run()
    monkeypatch.setattr(skew, "LEAST_ROWS", 10 ** 9)
    assert run() == split


def test_last_positions_equal_window_formulation(bare):
    e = _skewed_events(bare)
    got = sorted((r.run, r.step_no, r.event_id) for r in E.last_positions(
        e, run="run", keep=F.col("typ") == "wrong", n=3).collect())
    w = Window.partitionBy("run").orderBy("ts", "event_id")
    num = e.withColumn("k", F.row_number().over(w)).where("typ = 'wrong'")
    back = Window.partitionBy("run").orderBy(F.desc("k"))
    want = sorted((r.run, r.k, r.event_id) for r in num.withColumn("rn", F.row_number().over(back)).where("rn <= 3").collect())
    assert got == want
    assert "positions" not in E.last_positions(e, run="run", keep=F.col("typ") == "x", n=3)._jdf.toString()


def test_hot_and_small_groups_are_numbered_alike(bare):
    e = _skewed_events(bare).select("run", "ts", "event_id")
    e = e.withColumn("run", F.when(F.col("run") != "r1", F.col("run")))
    got = {(r.run, r.event_id): r.pos for r in positions(e, ["run"], ["ts", "event_id"]).collect()}
    w = Window.partitionBy("run").orderBy("ts", "event_id")
    assert got == {(r.run, r.event_id): r.rn for r in e.withColumn("rn", F.row_number().over(w)).collect()}


def test_no_group_is_numbered_without_a_join(bare):
    df = bare.range(1000).select(((F.col("id") * 37) % 1000).alias("v"))
    out = positions(df, [], ["v"])
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert all(r.pos == r.v + 1 for r in out.collect()) and positions(df.limit(0), [], ["v"]).count() == 0


def test_running_total_over_partitions(bare):
    df = bare.range(3000).select((F.col("id") % 2).alias("g"), "id", (F.col("id") % 5).alias("w"))
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = {r.id: r.b or 0 for r in df.withColumn("b", F.sum("w").over(w)).collect()}
    assert {r.id: r.before for r in ordering.running_total(df, ["g"], ["id"], "w").collect()} == want


def test_positions_of_one_frequent_value(bare, monkeypatch):
    """Equal sort keys are numbered once each, and spread over the tasks."""
    spark = bare
    df = spark.range(20000).select(F.lit("c").alias("g"), F.lit(1.0).alias("v"), "id").repartition(6)
    kept = []
    write = ordering.store
    monkeypatch.setattr(ordering, "store", lambda d, name: kept.append(write(d, name)) or kept[-1])
    out = positions(df, ["g"], ["v"], name="pos")
    assert out.select("pos").distinct().count() == 20000
    assert out.agg(F.min("pos"), F.max("pos")).first() == (1, 20000)
    tasks = kept[-1].groupBy(F.shiftright("_mid", 33)).count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 8000


def test_positions_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "g int, v int")
    got = {(r.g, r.v, r.pos) for r in positions(df, ["g"], ["v"]).collect()}
    assert got == {(None, 1, 1), (None, 2, 2), (1, 5, 1)}
