"""Structured Streaming jobs.

Each job reads a table folder as a file stream, runs to completion with
``Trigger.AvailableNow`` and writes to a sink under the session's shared
checkpoint folder (``spark.checkpoint.dir``).  A job that is given a ``run``
name resumes from that run's checkpoint; a lost executor only replays its tasks.  The
registered query functions return the sink read back as a batch DataFrame.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rampart.operators import policies as P
from rampart.operators.verdict import VERDICT_COLS
from rampart.session import ensure_checkpoint_dir


def stream_base(spark: SparkSession, name: str, run: str | None = None) -> str:
    """Folder of a job's checkpoint and sink.  With the same ``run`` name a job
    resumes where it stopped; without one the run is new."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{run or uuid.uuid4().hex}"


def table_stream(spark: SparkSession, sf_dir: str, table: str,
                 files_per_batch: int | None = None) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of part files.
    The path is a pattern that only this table matches: a plain path to a single
    file is refused by the source."""
    path = f"{sf_dir.rstrip('/')}/{table}.parque"
    reader = spark.readStream.schema(spark.read.parquet(path + "t").schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path + "[t]")


def _run(writer, timeout_s: float | None = None) -> None:
    """Run to the end of the input; a limit only where the caller sets one."""
    q = writer.trigger(availableNow=True).start()
    try:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            raise TimeoutError("streaming job did not finish")
    finally:
        if q.isActive:
            q.stop()


# ---------------------------------------------------------------------------
# Live event counters per run and type, duplicates dropped in-watermark
# ---------------------------------------------------------------------------

def event_counts(spark: SparkSession, sf_dir: str, watermark: str = "1 hour", *,
                 run: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Counts and value sums per (run, event type) over a stream in which some
    events arrive twice; the second arrival of an event id within the watermark
    is dropped, so the totals equal the batch rollup.  Different events of equal
    time and value all count."""
    base = stream_base(spark, "event-counts", run)
    s = table_stream(spark, sf_dir, "events", files_per_batch) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    dup = s.where(F.pmod(F.col("event_id"), F.lit(2)) == 0)
    u = s.unionByName(dup).withWatermark("ts", watermark) \
        .dropDuplicatesWithinWatermark(["user_id", "event_id"])
    agg = u.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum("value").alias("value_sum"))
    out = f"{base}/out"

    def publish(df: DataFrame, batch_id: int) -> None:
        # complete mode: every batch carries the whole result; overwrite is idempotent
        df.write.mode("overwrite").parquet(out)

    _run(agg.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", f"{base}/ckpt"))
    return spark.read.parquet(out).select(
        "user_id", "event_type", "n", F.round("value_sum", 2).alias("value_sum"))


# ---------------------------------------------------------------------------
# Round settle / time-out state with event-time timers
# ---------------------------------------------------------------------------
ROUND_OUT = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("round_start", T.TimestampType()),
    T.StructField("outcome", T.StringType()), T.StructField("resolved_at", T.TimestampType())])


_NO_TIME = np.iinfo(np.int64).min           # numpy's NaT


def replay_rounds(start: int | None, events, deadline_us: int):
    """Run ordered (ts_us, event_id, opens) events over an open round: the new open
    start, and the rounds that ended as (start, outcome, at)."""
    out = []
    for t, _, opens in events:
        if start is not None and t > start + deadline_us:
            out.append((start, "timed_out", start + deadline_us))
            start = None
        if start is None and opens:
            start = t
        elif start is not None and not opens:
            out.append((start, "settled", t))
            start = None
    return start, out


def _rounds_frame(rows) -> pd.DataFrame:
    users, starts, outcomes, ends = zip(*rows) if rows else ((), (), (), ())

    def times(us):
        return np.array([_NO_TIME if x is None else x for x in us], np.int64).view("datetime64[us]")
    return pd.DataFrame({"user_id": pd.array(users, "Int64"), "round_start": times(starts),
                         "outcome": np.array(outcomes, object), "resolved_at": times(ends)})


class Rounds(StatefulProcessor):
    """State of one key: the open round's start, and its waiting events.

    The events that a call brings are put in order and kept as runs of at most ``chunk``
    events, each under the slot of event time of its first event.  A key has one timer,
    at the end of the first slot that waits.  When it fires, the runs that begin in
    slots passed by the watermark are read in order and replayed slot by slot; what
    reaches beyond goes back.  Only runs that overlap in time are in memory together,
    and a key with few events costs a few state calls, however many slots they span."""

    def __init__(self, deadline_us: int, slot_ms: int, chunk: int):
        self.deadline_us, self.slot_ms, self.chunk = deadline_us, slot_ms, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start_us long")
        self.waiting = handle.getMapState("waiting", "slot long, chunk int",
                                          "ts_us array<long>, event_id array<long>, opens array<boolean>")

    def _keep(self, events: list, number: dict[int, int]) -> None:
        """Write ordered events as runs; ``number`` has the next free run of each slot."""
        for i in range(0, len(events), self.chunk):
            run = events[i:i + self.chunk]
            slot = run[0][0] // (self.slot_ms * 1000)
            n = number.get(slot, 0)
            self.waiting.updateValue((slot, n), tuple(map(list, zip(*run))))
            number[slot] = n + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number: dict[int, int] = {}
        for slot, n in list(self.waiting.keys()):
            number[slot] = max(number.get(slot, 0), n + 1)
        first = None
        for f in rows:
            us = f["ts"].to_numpy("datetime64[us]").astype(np.int64)
            if len(us):
                self._keep(sorted(zip(us.tolist(), f["event_id"].tolist(), f["opens"].tolist())), number)
                first = int(us.min()) if first is None else min(first, int(us.min()))
        if first is not None:
            self.handle.registerTimer((first // (self.slot_ms * 1000) + 1) * self.slot_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Every slot that ends by the watermark is complete: its events are replayed in
        order.  The next timer is for the first slot that still waits."""
        passed = expiredTimerInfo.getExpiryTimeInMs()
        if timerValues is not None:
            passed = max(passed, timerValues.getCurrentWatermarkInMs())
        slot_us, ended = self.slot_ms * 1000, passed // self.slot_ms       # slots below ``ended`` are complete
        before = self.open.get()
        before = start = None if before is None else before[0]
        runs = sorted(tuple(k) for k in self.waiting.keys())
        number: dict[int, int] = {}
        for slot, n in runs:
            number[slot] = n + 1
        out, held = [], []                            # held: ordered events of the runs read so far

        def replay(until_slot):
            nonlocal start, held
            n = bisect.bisect_left(held, (until_slot * slot_us,))
            start, done = replay_rounds(start, held[:n], self.deadline_us)
            out.extend((key[0], *r) for r in done)
            held = held[n:]
        for slot, n in runs:
            if slot >= ended:
                break
            if held and held[0][0] < slot * slot_us:
                replay(slot)
            held = sorted([*held, *zip(*self.waiting.getValue((slot, n)))])
            self.waiting.removeKey((slot, n))
            if len(out) >= self.chunk:
                yield _rounds_frame(out)
                out = []
        if held:
            replay(ended)
        # what reaches beyond goes back as runs of its own, under slots that have not ended
        self._keep(held, number)
        if start is not None and start + self.deadline_us < ended * slot_us:
            out.append((key[0], start, "timed_out", start + self.deadline_us))
            start = None
        if start is not None and start != before:
            self.open.update((start,))
            self.handle.registerTimer(((start + self.deadline_us) // slot_us + 1) * self.slot_ms)
        elif start is None and before is not None:
            self.open.clear()
        later = [held[0][0] // slot_us] if held else []
        later += [slot for slot, _ in runs if slot >= ended][:1]
        if later:
            self.handle.registerTimer((min(later) + 1) * self.slot_ms)
        if out:
            yield _rounds_frame(out)

    def close(self) -> None:
        pass


def _run_on_rocksdb(spark: SparkSession, writer) -> None:
    """Map and timer states need the RocksDB store; the session's choice comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        _run(writer)
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def _finish(deadline_us: int, mark_us: int):
    """Replay of what waits at the end, one ordered row after another: a key's open
    start is its first row (``event_id`` null)."""
    def fn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        user = start = None

        def end():
            if start is None:
                return []
            late = start + deadline_us
            return [(user, start, "timed_out", late) if late < mark_us else (user, start, "open", None)]
        for f in frames:
            out = []
            for u, t, i, opens in zip(f["user_id"].tolist(), f["ts_us"].tolist(), f["event_id"].tolist(), f["opens"].tolist()):
                if u != user:
                    out += end()
                    user, start = u, None
                start, ended = replay_rounds(start, [(t, i, opens)], deadline_us)
                out += [(u, *r) for r in ended]
            yield _rounds_frame(out)
        yield _rounds_frame(end())
    return fn


def round_state(spark: SparkSession, sf_dir: str, *, deadline_hours: int = 6,
                delay_ms: int = 3_600_000, open_type: str = "view",
                settle_type: str = "purchase", run: str | None = None, slot_ms: int = 600_000,
                chunk: int = 1_000, files_per_batch: int | None = None) -> DataFrame:
    """A round opens at ``open_type`` and settles at ``settle_type``; when the
    deadline passes first (a later event of these types, or the watermark) it times out.

    Only opening and settling events reach the state; all events drive the
    watermark.  They wait until the watermark has passed
    their slot of ``slot_ms``, so a late event within the delay is taken in its place
    whichever batch brings it, and the result does not depend on how the input is cut
    into batches.  A timed-out round is emitted when the slot of its deadline is passed.

    When the input ends, what still waits is read from the state store and replayed
    as one ordered scan; a round still open then is returned as ``open`` (no
    ``resolved_at``) unless its deadline lies before the final watermark (the
    newest event less the delay).  The stream's own state keeps it for the next
    run.  Events without a user, time or id are ignored.
    """
    base = stream_base(spark, "round-state", run)
    known = "user_id is not null and ts is not null and event_id is not null"
    s = (table_stream(spark, sf_dir, "events", files_per_batch)
         .select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
         .where(known).withWatermark("ts", f"{delay_ms} milliseconds"))
    # the condition names the event time, so that it stays above the watermark
    s = s.where(F.when(F.col("ts").isNotNull(), F.col("event_type").isin(open_type, settle_type))) \
        .select("user_id", "ts", "event_id", (F.col("event_type") == open_type).alias("opens"))
    deadline_us = deadline_hours * 3600 * 1_000_000
    rounds = s.groupBy("user_id").transformWithStateInPandas(
        Rounds(deadline_us, slot_ms, chunk), ROUND_OUT, "append", "EventTime")
    out = f"{base}/out"
    _run_on_rocksdb(spark, rounds.writeStream.outputMode("append").format("parquet").option("path", out)
                    .option("checkpointLocation", f"{base}/ckpt"))

    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(f"{base}/ckpt")
    newest = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").where(known).agg(
        F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0]
    waiting = state("waiting").select(F.col("key.user_id").alias("user_id"), F.explode(F.arrays_zip(
        "user_map_value.ts_us", "user_map_value.event_id", "user_map_value.opens")).alias("e")).select("user_id", "e.*")
    starts = state("open").select(F.col("key.user_id").alias("user_id"), F.col("value.start_us").alias("ts_us"),
                                  F.lit(None).cast("long").alias("event_id"), F.lit(True).alias("opens"))
    left = waiting.unionByName(starts).repartition("user_id") \
        .sortWithinPartitions("user_id", "ts_us", F.col("event_id").asc_nulls_first())
    mark_us = ((newest or 0) - delay_ms) * 1000
    return spark.read.schema(ROUND_OUT).parquet(out).unionByName(
        left.mapInPandas(_finish(deadline_us, mark_us), ROUND_OUT))


# ---------------------------------------------------------------------------
# S3: continuous policy checks into an append-only verdict log
# ---------------------------------------------------------------------------
RETURN_FLAGS = ("A", "N")          # stand-in declared domain (omits R on purpose)


def policy_log(spark: SparkSession, sf_dir: str, *, run: str | None = None,
               files_per_batch: int | None = None) -> DataFrame:
    """Every micro-batch of new line items is checked by three policies.  The log
    has one verdict row per batch and policy, and one row (value, n_violations) per
    value that the domain policy rejects: a distinct count over batches needs the
    values.  It is partitioned by batch id; a replayed batch overwrites only its
    own partition (idempotent)."""
    base = stream_base(spark, "policy-log", run)
    log_path = f"{base}/log"
    s = table_stream(spark, sf_dir, "lineitem", files_per_batch)

    def check(df: DataFrame, batch_id: int) -> None:
        domain = P.value_domain_check(df, "l_returnflag", RETURN_FLAGS, policy="returnflag_domain")
        vs = [P.range_check(df, "l_discount", lower=0.0, upper=0.1, policy="discount_range").verdict,
              domain.verdict,
              P.range_check(df, "l_quantity", lower=1.0, upper=40.0, policy="quantity_range").verdict,
              ]
        u = vs[0]
        for v in vs[1:]:
            u = u.unionByName(v)
        u = u.withColumn("kind", F.lit("verdict")).withColumn("value", F.lit(None).cast("string"))
        values = domain.violations.select(
            F.lit("returnflag_domain").alias("policy"), F.lit("violation").alias("status"),
            F.lit(0).cast("long").alias("checked_rows"), F.col("row_count").alias("n_violations"),
            F.lit(None).cast("string").alias("message"), F.lit("value").alias("kind"), "value")
        (u.unionByName(values).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log_path))

    _run(s.writeStream.foreachBatch(check).option("checkpointLocation", f"{base}/ckpt"))
    return spark.read.parquet(log_path).select("batch_id", "kind", "value", *VERDICT_COLS)


def policy_log_summary(log: DataFrame) -> DataFrame:
    """Fold the log over batches.  Checked rows add up; so do violations of a policy
    on rows, while a policy on values counts its distinct values (null is one) over
    all batches.  Violation if any batch violated, error only if every batch errored.
    The result does not depend on how the rows were cut into batches."""
    v = F.col("kind") == "verdict"
    by_value = log.where(~v).groupBy("policy", "value").agg(F.sum("n_violations").alias("n")) \
        .groupBy("policy").agg(F.count(F.lit(1)).alias("n_values"))
    out = log.where(v).groupBy("policy").agg(
        F.sum("checked_rows").alias("checked_rows"), F.sum("n_violations").alias("n_rows"),
        F.when(F.bool_or(F.col("status") == "violation"), F.lit("violation"))
         .when(F.bool_and(F.col("status") == "error"), F.lit("error"))
         .otherwise(F.lit("pass")).alias("status"))
    return out.join(by_value, "policy", "left").select(
        "policy", "checked_rows", F.coalesce("n_values", "n_rows").alias("n_violations"), "status")
