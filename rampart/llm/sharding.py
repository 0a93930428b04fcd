"""Sharding (operator 11): balanced label propagation over linked documents.

Documents of one *link* value are neighbours of each other.  Every document
starts in a shard given by a hash, which is even but cuts nearly all links.  Then
rounds of joins move documents to the shard that holds most of their neighbours,
under quotas: a round's wishes are counted per (from, to, gain) on the cluster,
the driver turns these few numbers into quotas that overfill no shard, and the
highest gains go first.  Where a shard is full, its would-be movers look for the
next one, so a group larger than a shard fills few shards instead of all.
Documents without neighbours cut nothing wherever they are; they fill the room
that is left, which makes the sizes even.

All of it is DataFrame work.  Documents of one link value, size and shard have the
same neighbours and the same wish, so they are one row with a count: rows never
exceed the documents, and a group of any number of copies is at most one row per
size and shard.
"""

from __future__ import annotations

import heapq
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm import store

_SLICES = 8          # of each gain, so that a quota ends within one of them
_BLOCK = 20_000
_ALL = 1 << 62


def running(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """``df`` with ``at``: the sum of ``value`` over the rows before it in its
    ``by`` group, in an order of no meaning that ``order`` (unique there) fixes.

    Rows are dealt in blocks by hash; a window numbers each block and another one
    the blocks.  Both hold about the root of the rows, 20,000 at least.
    """
    rows = df.count()
    blocks = max(1, rows // max(_BLOCK, isqrt(rows)))
    df = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = (Window.unboundedPreceding, -1)
    heads = df.groupBy(*by, "_b").agg(F.sum(value).alias("_v"))
    heads = heads.select(*by, "_b", F.coalesce(F.sum("_v").over(
        Window.partitionBy(*by).orderBy("_b").rowsBetween(*before)), F.lit(0)).alias("_at"))
    here = F.sum(value).over(Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(*before))
    return df.join(heads, [*by, "_b"]).withColumn("at", F.col("_at") + F.coalesce(here, F.lit(0))).drop("_b", "_at")


def quotas(wish: dict[tuple[int, int], int], load: list[int], cap: float) -> dict[tuple[int, int], float]:
    """How much of each wished flow (from, to) may go so that no shard ends over
    ``cap`` (one that already is takes nothing unless as much leaves it)."""
    flow = {k: float(v) for k, v in wish.items()}
    for _ in range(200):
        net = [float(x) for x in load]
        into = [0.0] * len(load)
        for (s, t), x in flow.items():
            net[s] -= x
            net[t] += x
            into[t] += x
        over = {t: (into[t] - (net[t] - cap)) / into[t] for t in range(len(load)) if into[t] > 0 and net[t] > cap + 0.5}
        if not over:
            return flow
        for s, t in flow:
            flow[s, t] *= max(0.0, over.get(t, 1.0))
    # cut short: count no leaving documents, which overfills nothing either
    into = [sum(x for (_, t), x in wish.items() if t == u) for u in range(len(load))]
    return {(s, t): x * min(1.0, max(0.0, cap - load[t]) / into[t]) if into[t] else 0.0 for (s, t), x in wish.items()}


def _cuts(hist: dict, allowed: dict, keys: int) -> tuple[list[int], list[float]]:
    """Per key: levels below cut go whole, the level at cut by a fraction."""
    cut, part = [-1] * keys, [0.0] * keys
    for key, levels in hist.items():
        left, cut[key] = allowed.get(key, 0.0), _ALL
        for level, size in sorted(levels.items()):
            if size > left:
                cut[key], part[key] = level, left / size
                break
            left -= size
    return cut, part


def _taken(cut: list[int], part: list[float], key: Column, whole=F.floor) -> Column:
    """How many of a row's ``n`` documents the cuts let through."""
    at = F.get(F.lit(cut).cast("array<long>"), key)
    some = whole(F.col("n") * F.get(F.lit(part).cast("array<double>"), key)).cast("long")
    return F.coalesce(F.when(F.col("level") < at, F.col("n")).when(F.col("level") == at, F.least(some, "n")), F.lit(0))


def _level(gain: Column, first: str) -> Column:
    """Small where ``gain`` is large (first = 'high') or small ('low'): powers of two, in slices."""
    power = F.floor(F.log2(gain + 1)).cast("int")
    power = 63 - power if first == "high" else power
    return (power * _SLICES + F.pmod(F.xxhash64("g"), F.lit(_SLICES))).cast("long")


def _histogram(df: DataFrame, key: Column, n: str = "n") -> dict[int, dict[int, int]]:
    """Bytes by (key, level): at most keys x 64 gains x slices numbers."""
    out: dict[int, dict[int, int]] = {}
    for k, level, size in df.groupBy(key.alias("k"), "level").agg(F.sum(F.col(n) * F.col("size"))).collect():
        out.setdefault(k, {})[level] = size
    return out


def _loads(df: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for s, size in df.groupBy("s").agg(F.sum(F.col("n") * F.col("size"))).collect():
        out[s] = size
    return out


def propagate(cells: DataFrame, shards: int, cap: float, rounds: int) -> DataFrame:
    """Moved ``cells`` (g, size, s, n): documents of linked groups, counted."""
    load = _loads(cells, shards)
    settled: list[DataFrame] = []
    shut = [False] * shards      # asked for, and had no room for a single document
    for _ in range(rounds):
        votes = store.write(cells.groupBy("g").agg(F.array(*[
            F.coalesce(F.sum(F.when(F.col("s") == i, F.col("n"))), F.lit(0)) for i in range(shards)]).alias("votes")), "votes")
        room = F.lit([not no and x < cap * (1 - 1 / 1024) for x, no in zip(load, shut)])
        best = F.array_max(F.transform("votes", lambda v, i: F.when(
            F.get(room, i), F.struct(v.alias("v"), F.xxhash64("g", i).alias("h"), i.alias("t")))))
        own = F.struct(F.get("votes", F.col("s")).alias("v"), F.xxhash64("g", "s").alias("h"), F.col("s").alias("t"))
        here = cells.join(votes.select("g", "votes", best.alias("best"),
                                       (F.size(F.filter("votes", lambda v: v > 0)) == 1).alias("alone")), "g")
        wish = F.when(F.col("best.v").isNotNull() & (F.col("best") > own), F.col("best.t"))
        here = store.write(here.select("g", "size", "s", "n", "alone", wish.alias("t"),
                                       _level(F.col("best.v") - F.get("votes", F.col("s")), "high").alias("level")), "wishes")
        settled.append(here.where("alone").select("g", "size", "s", "n"))
        pair = F.col("s") * shards + F.col("t")
        hist = _histogram(here.where("t is not null"), pair)
        if not hist:
            cells = here.where("not alone").select("g", "size", "s", "n")
            break
        allowed = quotas({(k // shards, k % shards): sum(v.values()) for k, v in hist.items()}, load, cap)
        cut, part = _cuts(hist, {s * shards + t: x for (s, t), x in allowed.items()}, shards * shards)
        moved = here.where("not alone").withColumn("moved", _taken(cut, part, pair))
        cells = store.write(moved.select("g", "size", F.explode(F.array(
            F.struct("s", (F.col("n") - F.col("moved")).alias("n")), F.struct(F.col("t").alias("s"), F.col("moved").alias("n")))).alias("c"))
            .select("g", "size", "c.*").where("n > 0").groupBy("g", "size", "s").agg(F.sum("n").alias("n")), "cells")
        flows = moved.where("moved > 0").groupBy("s", "t").agg(F.sum(F.col("moved") * F.col("size"))).collect()
        for s, t, size in flows:
            load[s] -= size
            load[t] += size
        for t in {k % shards for k in hist} - {t for _, t, _ in flows}:
            shut[t] = True
    for done in settled:
        cells = cells.unionByName(done)
    return cells


def _trim(cells: DataFrame, shards: int, cap: float) -> tuple[DataFrame, DataFrame]:
    """(kept, loose): where linked documents alone overfill a shard, the rows with
    fewest neighbours there leave it."""
    over = {s: x - cap for s, x in enumerate(_loads(cells, shards)) if x > cap}
    if not over:
        return cells, cells.limit(0)
    ranked = cells.withColumn("level", _level(F.col("n"), "low"))
    cut, part = _cuts(_histogram(ranked.where(F.col("s").isin(list(over))), F.col("s")), over, shards)
    ranked = store.write(ranked.withColumn("out", _taken(cut, part, F.col("s"), F.ceil)), "trim")
    return (ranked.select("g", "size", "s", (F.col("n") - F.col("out")).alias("n")).where("n > 0"),
            ranked.select("g", "size", "s", F.col("out").alias("n")).where("n > 0"))


def water_level(load: list[int], size: int) -> list[int]:
    """How much of ``size`` each shard takes so that the loads end as even as can be."""
    low = sorted(load)
    for i in range(len(low), 0, -1):
        level = (sum(low[:i]) + size) / i
        if level >= low[i - 1]:
            return [max(0, round(level - x)) for x in load]
    return [0] * len(load)


def _fill(loose: DataFrame, load: list[int], large: int) -> DataFrame:
    """Shards for ``loose`` rows (g, size, n), so that ``load`` becomes even.

    Documents of ``large`` bytes or more, whose number the total bounds, are
    placed one by one, the largest first, where most room is.  The others lie on
    a line, cut where each shard is full: an error of one smaller document each.
    """
    load, spark = list(load), loose.sparkSession
    heap = [(x, s) for s, x in enumerate(load)]
    heapq.heapify(heap)
    placed: dict[tuple, int] = {}
    rows = loose.where(F.col("size") >= large).groupBy(F.hex("g"), "size").agg(F.sum("n")).collect()
    for g, size, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        for _ in range(n):
            x, s = heapq.heappop(heap)
            placed[g, size, s] = placed.get((g, size, s), 0) + 1
            load[s] = x + size
            heapq.heappush(heap, (load[s], s))
    values = ",".join(f"(unhex('{g}'),{size}L,{s},{n}L)" for (g, size, s), n in placed.items())
    one = (spark.sql(f"SELECT * FROM VALUES {values} AS v(g, size, s, n)") if placed
           else spark.sql("SELECT unhex('') g, 0L size, 0 s, 0L n WHERE false"))
    small = store.write(loose.where(F.col("size") < large).groupBy("g", "size").agg(F.sum("n").alias("n")), "loose")
    weight = F.col("n") * F.col("size")
    total = small.agg(F.sum(weight)).first()[0] or 0
    bounds = [0]
    for x in water_level(load, total):
        bounds.append(bounds[-1] + x)
    bounds[-1] = _ALL
    line = running(small.withColumn("w", weight), [], ["g", "size"], "w")

    def up_to(i: Column) -> Column:
        """How many of the row's documents begin before bound i."""
        room = F.greatest(F.get(F.lit(bounds).cast("array<long>"), i) - F.col("at"), F.lit(0))
        return F.least(F.ceil(room.cast("decimal(38,0)") / F.col("size")).cast("long"), F.col("n"))
    cut = line.select("g", "size", F.explode(F.filter(F.transform(
        F.sequence(F.lit(0), F.lit(len(load) - 1)), lambda i: F.struct(i.alias("s"), (up_to(i + 1) - F.when(
            i == 0, F.lit(0)).otherwise(up_to(i))).alias("n"))), lambda c: c["n"] > 0)).alias("c"))
    return cut.select("g", "size", "c.*").unionByName(one)


def _slots(units: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per document: the units (g, size, doc_id, crc, m) dealt to the
    counts that ``cells`` (g, size, s, n) gives each shard, with gapless slots."""
    cells = running(cells, ["s"], ["g", "size"], "n")
    before = Window.partitionBy("g", "size").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    kinds = cells.groupBy("g", "size").agg(F.collect_list(F.struct("s", "start", "n", "at")).alias("cells"))
    count = units.groupBy("g", "size").agg(F.count("*").alias("u"))
    kinds = store.write(kinds.join(count, ["g", "size"]), "kinds")
    # two written tables: a group that holds a third of all rows is split by size
    rows = store.write(units.join(kinds, ["g", "size"]).withColumn("sub", F.when(F.col("u") <= _BLOCK, 0).otherwise(
        F.pmod(F.xxhash64("doc_id", "crc"), F.ceil(F.col("u") / _BLOCK)))), "dealt")
    heads = rows.where(F.col("u") > _BLOCK).groupBy("g", "size", "sub").agg(F.sum("m").alias("v"))
    heads = heads.select("g", "size", "sub", F.coalesce(F.sum("v").over(
        Window.partitionBy("g", "size").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    large = rows.where(F.col("u") > _BLOCK).join(heads, ["g", "size", "sub"])
    rows = rows.where(F.col("u") <= _BLOCK).withColumn("off", F.lit(0).cast("long")).unionByName(large)
    here = F.sum("m").over(Window.partitionBy("g", "size", "sub").orderBy("doc_id", "crc")
                           .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("lo", F.col("off") + F.coalesce(here, F.lit(0))).withColumn("hi", F.col("lo") + F.col("m"))
    # a unit of repeated rows may lie over several shards; then one row per document again
    rows = rows.select("doc_id", "size", "crc", F.explode(F.filter(F.transform("cells", lambda c: F.struct(
        c["s"].alias("s"), (c["at"] + F.greatest(F.col("lo"), c["start"]) - c["start"]).alias("first"),
        (F.least(F.col("hi"), c["start"] + c["n"]) - F.greatest(F.col("lo"), c["start"])).alias("k"))),
        lambda p: p["k"] > 0)).alias("p"))
    rows = rows.select("doc_id", "size", "crc", "p.*").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("k") - 1) / 4096))).alias("a"))
    return rows.select("doc_id", "size", "crc", "s", "first", F.explode(F.sequence(
        F.col("a") * 4096, F.least(F.col("a") * 4096 + 4095, F.col("k") - 1))).alias("i")) \
        .select("doc_id", "size", "crc", "s", (F.col("first") + F.col("i")).alias("slot"))


def shard(docs: DataFrame, shards: int = 16, link: Column | None = None, rounds: int = 24,
          fine: int = 256) -> DataFrame:
    """doc_id, size, crc, s (shard), slot of every row of ``docs`` (doc_id, text).

    Size is the UTF-8 bytes of the text plus one; a null text counts as empty.
    ``link`` (default: the text's SHA-256) makes neighbours of the rows with an
    equal value; a null links with nothing.  Shards' sizes differ by at most
    1/``fine`` of a shard on either side, or one document if that is larger.
    Slots run from 0 without gaps in each shard.  Repeated rows, and a null
    doc_id, are documents like any other; equal rows may change places, which
    does not show.  An empty table gives no rows.  Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    alone = F.sha2(F.concat_ws("|", F.lit("alone"), F.hex(digest), F.col("doc_id").cast("string")), 256)
    g = digest if link is None else F.coalesce(F.unhex(F.sha2(link.cast("string"), 256)), F.unhex(alone))
    units = store.write(docs.select(
        "doc_id", g.alias("g"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc")).groupBy("g", "size", "doc_id", "crc").agg(F.count("*").alias("m")), "units")
    start = F.pmod(F.xxhash64("doc_id", "g"), F.lit(shards)).cast("int").alias("s")
    cells = store.write(units.groupBy("g", "size", start).agg(F.sum("m").alias("n")), "cells")
    total = cells.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    groups = cells.groupBy("g").agg((F.sum("n") > 1).alias("linked"))
    cells = store.write(cells.join(groups, "g"), "start")
    cap = total / shards
    linked = propagate(cells.where("linked").drop("linked"), shards, cap, rounds)
    kept, loose = _trim(store.write(linked, "linked"), shards, cap)
    loose = loose.unionByName(cells.where("not linked").drop("linked")).select("g", "size", "n")
    filled = _fill(loose, _loads(kept, shards), max(1, total // (shards * fine)))
    final = store.write(kept.unionByName(filled).groupBy("g", "size", "s").agg(F.sum("n").alias("n")), "final")
    return _slots(units, final)


def op11(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                      F.col("s").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
