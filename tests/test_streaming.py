"""S1-S3 over single-file and folder tables, cut into one or many batches."""

import datetime as dt
import os
import random
import tempfile

import pandas as pd
import pytest

from rampart.streaming import jobs as S

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


def _table_dir(name, rows, columns, parts):
    """``parts`` 0: one file; otherwise a folder of so many part files, in order."""
    d = tempfile.mkdtemp(prefix="rampart-ev-")
    _add(d, name, rows, columns, parts)
    return d


def _add(d, name, rows, columns, parts, first=0):
    pdf = pd.DataFrame(rows, columns=columns)
    kw = dict(index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    if not parts:
        pdf.to_parquet(f"{d}/{name}.parquet", **kw)
        return
    os.makedirs(f"{d}/{name}.parquet", exist_ok=True)
    for i in range(parts):
        path = f"{d}/{name}.parquet/part-{first + i:03d}.parquet"
        pdf.iloc[i * len(pdf) // parts:(i + 1) * len(pdf) // parts].to_parquet(path, **kw)
        os.utime(path, (1_700_000_000 + first + i,) * 2)      # the source reads by file time


EV = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _rounds(spark, d, **kw):
    return sorted(((r.user_id, r.round_start, r.outcome, r.resolved_at)
                   for r in S.round_state(spark, d, **kw).collect()), key=repr)


def _brute_rounds(rows, hours=6):
    """Opening and settling events of each user in order; what is open at the end has
    timed out if its deadline lies before the newest event less the delay."""
    out, mark = [], max(r[1] for r in rows) - H
    for u in {r[2] for r in rows}:
        start = None
        for _, t, _, typ, *_ in sorted((r for r in rows if r[2] == u and r[3] in ("view", "purchase")),
                                       key=lambda r: (r[1], r[0])):
            if start is not None and t > start + hours * H:
                out.append((u, start, "timed_out", start + hours * H))
                start = None
            if start is None and typ == "view":
                start = t
            elif start is not None and typ == "purchase":
                out.append((u, start, "settled", t))
                start = None
        if start is not None:
            late = start + hours * H
            out.append((u, start, "timed_out", late) if late < mark else (u, start, "open", None))
    return sorted(out, key=repr)


def test_round_state_settle_timeout_and_timer(spark):
    rows = [
        (0, T0, 1, "view", 1.0, "{}"), (1, T0 + 2 * H, 1, "purchase", 1.0, "{}"),   # settled
        (2, T0 + 3 * H, 1, "view", 1.0, "{}"), (3, T0 + 10 * H, 1, "click", 1.0, "{}"),  # timed out by a later event
        (4, T0 + 11 * H, 2, "view", 1.0, "{}"),                                   # timed out by the timer
        (5, T0 + 30 * H, 3, "signup", 1.0, "{}"),                                 # closing event
        (6, T0 + 30 * H, 3, "view", 1.0, "{}"),                                   # still open
    ]
    got = _rounds(spark, _table_dir("events", rows, EV, 0))
    assert got == sorted([(1, T0, "settled", T0 + 2 * H), (1, T0 + 3 * H, "timed_out", T0 + 9 * H),
                          (2, T0 + 11 * H, "timed_out", T0 + 17 * H), (3, T0 + 30 * H, "open", None)], key=repr)


def _disordered(n=120, late_minutes=50):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        t = T0 + dt.timedelta(minutes=20 * i)
        rows.append((i, t - dt.timedelta(minutes=rng.randrange(late_minutes)), i % 3,
                     rng.choice(["view", "purchase", "click", "view"]), 1.0, "{}"))
    return rows


@pytest.mark.parametrize("parts,slot_ms,chunk", [(0, 600_000, 1000), (2, 60_000, 2), (5, 7_200_000, 3)])
def test_round_state_does_not_depend_on_batches(spark, parts, slot_ms, chunk):
    rows = _disordered()
    got = _rounds(spark, _table_dir("events", rows, EV, parts), files_per_batch=1, slot_ms=slot_ms, chunk=chunk)
    assert got == _brute_rounds(rows)


def test_round_state_resumes(spark):
    rows = sorted(_disordered(60), key=lambda r: r[0])
    d = _table_dir("events", rows[:30], EV, 1)
    run = "resume-test-" + os.path.basename(d)
    assert _rounds(spark, d, run=run) == _brute_rounds(rows[:30])
    _add(d, "events", rows[30:], EV, 1, first=1)
    assert _rounds(spark, d, run=run) == _brute_rounds(rows)
    assert _rounds(spark, d, run=run) == _brute_rounds(rows)      # nothing new: nothing changes


def test_round_state_nulls_and_ties(spark):
    rows = [(1, T0, 1, "view", 1.0, "{}"), (2, T0, 1, "purchase", 1.0, "{}"), (4, T0 + H, 1, "purchase", 1.0, "{}"),
            (3, T0 + H, 1, "view", 1.0, "{}"), (5, T0 + 2 * H, 2, "view", None, None), (6, T0 + 8 * H, 2, "purchase", 1.0, None),
            (7, T0 + 30 * H, 3, "click", 1.0, None)]
    d = _table_dir("events", rows, EV, 0)
    assert _rounds(spark, d) == _brute_rounds(rows)
    broken = spark.read.parquet(d).selectExpr(
        "event_id", "ts", "if(event_id = 7, null, user_id) user_id", "if(event_id = 4, null, event_type) event_type", "value", "props")
    e = tempfile.mkdtemp(prefix="rampart-ev-")
    broken.coalesce(1).write.parquet(f"{e}/events.parquet")
    assert (1, T0 + H, "open", None) in _rounds(spark, e)


class _Map(dict):
    def containsKey(self, k):
        return k in self

    def getValue(self, k):
        return self[k]

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        del self[k]


class _Handle:
    """In-memory states; records the timers."""
    def __init__(self):
        self.maps, self.timers, self.value = {}, set(), None

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Map())

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.add(ms)


def test_a_key_is_read_slot_by_slot(monkeypatch):
    """100,000 events of one key: no state value over a chunk, no replay over a slot."""
    n, h = 100_000, _Handle()
    rng = random.Random(5)
    us = sorted(1_700_000_000_000_000 + rng.randrange(40 * 3_600_000_000) for _ in range(n))
    f = pd.DataFrame({"ts": pd.to_datetime(us, unit="us"), "event_id": range(n),
                      "opens": [rng.random() < 0.5 for _ in range(n)]}).sample(frac=1, random_state=1)
    p = S.Rounds(6 * 3_600_000_000, 600_000, 100)
    p.init(h)
    list(p.handleInputRows((1,), iter([f.iloc[:60_000], f.iloc[60_000:]]), None))
    assert max(len(v[0]) for v in h.maps["waiting"].values()) <= 100
    seen, replay = [], S.replay_rounds
    monkeypatch.setattr(S, "replay_rounds", lambda s, ev, d: (seen.append(len(ev)), replay(s, ev, d))[1])

    class Info:
        def __init__(self, ms):
            self.getExpiryTimeInMs = lambda: ms
    got = []
    while h.timers:
        ms = min(h.timers)
        h.timers.remove(ms)
        for frame in p.handleExpiredTimer((1,), None, Info(ms)):
            got += frame["resolved_at"].tolist()
    start, want = replay(None, sorted(zip(us, range(n), f.sort_values("event_id")["opens"])), 6 * 3_600_000_000)
    assert len(got) == len(want) + (start is not None) and got == sorted(got)
    assert max(seen) < 1_000 and not h.maps["waiting"] and h.value is None


class _Counted(_Map):
    """Counts the calls that would go to the state store."""
    def __init__(self):
        super().__init__()
        self.calls = 0

    def __getattribute__(self, name):
        if name in ("containsKey", "getValue", "updateValue", "removeKey", "keys"):
            self.calls += 1
        return super().__getattribute__(name)


class _Passed:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


@pytest.mark.parametrize("chunk", [3, 1_000])
def test_a_key_costs_few_state_calls_and_timers(chunk):
    """200 events over 20 days, brought in three calls that overlap: the slots that they
    span cost nothing, and any number of watermarks gives the rounds of one ordered replay."""
    rng, h = random.Random(9), _Handle()
    us = [1_700_000_000_000_000 + rng.randrange(20 * 86_400_000_000) for _ in range(200)]
    f = pd.DataFrame({"ts": pd.to_datetime(us, unit="us"), "event_id": range(200), "opens": [rng.random() < 0.5 for _ in us]})
    h.maps = {"waiting": _Counted()}
    p = S.Rounds(6 * 3_600_000_000, 600_000, chunk)
    p.init(h)
    for part in (f.iloc[:90], f.iloc[90:100], f.iloc[100:]):
        list(p.handleInputRows((1,), iter([part.iloc[:40], part.iloc[40:]]), None))
    assert len(h.timers) <= 3
    got, ends = [], [min(us) // 1000 + 3 * 86_400_000, min(us) // 1000 + 11 * 86_400_000, max(us) // 1000 + 86_400_000]
    for end in ends:
        while h.timers and min(h.timers) <= end:
            h.timers.remove(min(h.timers))
            for frame in p.handleExpiredTimer((1,), _Passed(end), _Passed(end)):
                got += list(zip(frame["round_start"].astype("int64"), frame["outcome"]))
    start, want = S.replay_rounds(None, sorted(zip(us, range(200), f["opens"])), 6 * 3_600_000_000)
    assert got == [(r[0], r[1]) for r in want] + ([] if start is None else [(start, "timed_out")])
    assert not h.maps["waiting"] and h.value is None and not h.timers
    assert h.maps["waiting"].calls <= (40 if chunk == 1_000 else 250)


@pytest.mark.parametrize("parts", [0, 3])
def test_event_counts_drop_only_repeated_events(spark, parts):
    rows = [(i, T0 + dt.timedelta(minutes=i), i % 2, "click", 1.5, "{}") for i in range(10)]
    rows += [(20, T0, 0, "view", 1.5, "{}"), (21, T0, 0, "click", 1.5, "{}")]     # equal time and value
    d = _table_dir("events", rows, EV, parts)
    got = sorted((r.user_id, r.event_type, r.n, r.value_sum) for r in S.event_counts(spark, d, files_per_batch=1).collect())
    assert got == [(0, "click", 6, 9.0), (0, "view", 1, 1.5), (1, "click", 5, 7.5)]


@pytest.mark.parametrize("parts", [0, 2, 5])
def test_policy_log_folds_values(spark, parts):
    cols = ["l_discount", "l_returnflag", "l_quantity"]
    rows = [(0.05, "R", 10.0), (0.2, "A", 50.0), (0.05, "N", 1.0), (None, "R", 41.0), (0.05, None, 2.0),
            (0.05, "X", None), (0.0, "R", 40.0), (0.1, "A", 0.5), (0.3, "X", 3.0), (0.05, None, 4.0)]
    log = S.policy_log(spark, _table_dir("lineitem", rows, cols, parts), files_per_batch=1)
    got = {r.policy: (r.checked_rows, r.n_violations, r.status) for r in S.policy_log_summary(log).collect()}
    assert got == {"discount_range": (9, 2, "violation"), "returnflag_domain": (10, 3, "violation"),
                   "quantity_range": (9, 3, "violation")}


def test_policy_log_of_empty_batches_is_an_error(spark):
    rows = spark.createDataFrame(
        [(0, "verdict", None, "p", "error", 0, 0, ""), (1, "verdict", None, "p", "error", 0, 0, ""),
         (0, "verdict", None, "q", "error", 0, 0, ""), (1, "verdict", None, "q", "pass", 3, 0, "")],
        "batch_id int, kind string, value string, policy string, status string, checked_rows long, n_violations long, message string")
    assert {r.policy: r.status for r in S.policy_log_summary(rows).collect()} == {"p": "error", "q": "pass"}
