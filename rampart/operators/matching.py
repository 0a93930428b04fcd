"""Tolerant table matching (M1-M4) as distributed plans.

A gold column is matched when ANY predicted column has the same length and
equal values position by position -- after sorting both when order is
ignored.  Null and NaN are equal to each other; two numerics are equal under
``isclose(abs_tol=0.01, rel_tol=1e-9)``; anything else must be exactly equal
(a string never equals a number).  Booleans count as numbers.

Plan (SURVEY §4.3):
1. profile every column in one global aggregate over each wide table (rows,
   nulls, class, min, max, exact multiset fingerprint);
2. keep only pairs that can still match (same length and null count, same
   class, min/max within tolerance, equal fingerprint for exact classes);
3. unpivot only the surviving columns and count their values once; equal
   counts settle exact pairs;
4. for the numeric pairs left, a distinct value's count makes it an interval of
   ranks.  Intervals are cut into bins of ranks; within a bin one window holds
   the value of every column at each rank where any of them changes, and all
   pairs are compared there.  No row is ranked or copied for a pair: a value
   that a third of all rows hold is one interval.

With an explicit order column, the rows of each table are numbered once and joined on
their position, and all pairs are compared in each joined row.

Shuffles have partitions by the number of values, so that what a task holds does not
grow with the tables.

Sort difference from the reference: it sorts numbers by their *text*; we sort
them numerically unless ``sort="string"`` is asked for.  Under a fixed
tolerance, if any pairing matches, the numerically sorted one does, so the
default accepts a superset (see tests).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.functions.float_text import float_text
from rampart.functions.tolerance import DEFAULT_REL_TOL, DEFAULT_TOL, isclose
from rampart.operators.ordering import positions, running_total
from rampart.session import TASK_ROWS, partitions_for, store

NUM, STR, OTHER = "numeric", "string", "other"


def value_class(dt: T.DataType) -> str:
    if isinstance(dt, (T.NumericType, T.BooleanType)):
        return NUM
    if isinstance(dt, (T.StringType, T.CharType, T.VarcharType)):
        return STR
    return OTHER


def sort_text(col: Column, dt: T.DataType) -> Column:
    """The text that a value sorts by in ``sort="string"`` mode: whole numbers
    without a point, others as :func:`float_text`, booleans by name."""
    if isinstance(dt, T.BooleanType):
        return F.when(col, "True").otherwise("False")
    if isinstance(dt, T.IntegralType) or value_class(dt) != NUM:
        return col.cast("string")
    return float_text(col)


def _forms(col: Column, dt: T.DataType) -> tuple[str, Column, Column, Column]:
    """(class, is_null, v_num, v_str) of one column: numbers as doubles (NaN
    is null), everything else as text."""
    cls = value_class(dt)
    if cls == NUM:
        num = col.cast("double")
        is_null = col.isNull() | F.isnan(num)
        return cls, is_null, F.when(~is_null, num), F.lit(None).cast("string")
    return cls, col.isNull(), F.lit(None).cast("double"), col.cast("string")


def profile(df: DataFrame, columns: Sequence[str], side: str) -> list[tuple]:
    """Per column: rows, nulls, class, min, max, multiset fingerprint.

    One global aggregate over the wide table (partial per task, one row per
    task merged): no unpivot and no shuffle of values.  The result is column
    metadata, one tuple per column.
    """
    # Multiset fingerprint: the 64-bit hash summed in three 21/21/22-bit
    # slices, each a plain long sum that cannot overflow below ~4e12 rows per
    # column (no big-decimal arithmetic).
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    mask = F.lit((1 << 21) - 1)
    exprs, classes = [F.count(F.lit(1)).alias("n_rows")], []
    for i, c in enumerate(columns):
        cls, is_null, v_num, v_str = _forms(F.col(f"`{c}`"), types[c])
        classes.append(cls)
        h = F.when(~is_null, F.xxhash64(v_num, v_str))
        exprs += [F.count_if(is_null).alias(f"n{i}"), F.min(v_num).alias(f"lo{i}"),
                  F.max(v_num).alias(f"hi{i}"),
                  F.sum(F.shiftrightunsigned(h, 0).bitwiseAND(mask)).alias(f"a{i}"),
                  F.sum(F.shiftrightunsigned(h, 21).bitwiseAND(mask)).alias(f"b{i}"),
                  F.sum(F.shiftrightunsigned(h, 42)).alias(f"c{i}")]
    r = df.agg(*exprs).collect()[0]
    return [(side, c, classes[i], r["n_rows"], r[f"n{i}"] or 0, r[f"lo{i}"], r[f"hi{i}"],
             (r[f"a{i}"], r[f"b{i}"], r[f"c{i}"]))
            for i, c in enumerate(columns)]


def candidate_pairs(gold_prof: list[tuple], pred_prof: list[tuple],
                    tol: float = DEFAULT_TOL) -> list[dict]:
    """(gold_col, pred_col) pairs that pass every cheap necessary condition:
    equal length and null count, and either both entirely null, or the same
    class with min/max within tolerance (numbers) or equal fingerprints.

    Both inputs are :func:`profile` tuples, one per column, so this is a
    comparison of column metadata (like a schema), never of data.
    """
    def near(a, b):
        if a is None or b is None:
            return a is None and b is None
        # an infinity is close to itself only
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= max(tol, DEFAULT_REL_TOL * max(abs(a), abs(b)))

    out = []
    for _, gc, gcls, gn, gnull, glo, ghi, gfp in gold_prof:
        for _, pc, pcls, pn, pnull, plo, phi, pfp in pred_prof:
            if gn != pn or gnull != pnull:
                continue
            trivial = gnull == gn
            fp_equal = gfp == pfp
            if gcls == NUM:
                ok = fp_equal or (near(glo, plo) and near(ghi, phi))
            else:
                ok = fp_equal
            if trivial or (gcls == pcls and ok):
                out.append({"gold_col": gc, "pred_col": pc, "n_rows": gn,
                            "trivial": trivial, "fp_equal": fp_equal})
    return out


def values_equal(g_null: Column, g_num: Column, g_str: Column, g_cls: Column,
                 p_null: Column, p_num: Column, p_str: Column, p_cls: Column,
                 tol: float = DEFAULT_TOL) -> Column:
    both_num = (g_cls == NUM) & (p_cls == NUM)
    close = isclose(g_num, p_num, tol)
    same_str = (g_cls != NUM) & (p_cls != NUM) & (g_str == p_str)
    return F.when(g_null & p_null, True).when(g_null | p_null, False) \
        .when(both_num, close).otherwise(F.coalesce(same_str, F.lit(False)))


def value_counts(gold: DataFrame, pred: DataFrame, cols: Sequence[tuple[str, str]],
                 partitions: int | None = None) -> DataFrame:
    """One row per distinct value (is_null, v_num, v_str) of the columns ``cols``
    ((side, name)), with ``n0``, ``n1``...: how often each column holds it.

    One shuffle serves all columns, and a value of any number of rows is combined
    before it.  With ``partitions`` each table's rows are dealt to so many tasks first:
    a task's table of values has no more entries than its share of the values.
    """
    def one(side, df):
        items = []
        for i, (s, c) in enumerate(cols):
            if s == side:
                _, is_null, v_num, v_str = _forms(F.col(f"`{c}`"), df.schema[c].dataType)
                items.append(F.struct(F.lit(i).alias("c"), is_null.alias("is_null"), v_num.alias("v_num"), v_str.alias("v_str")))
        if partitions:
            df = df.select(*[f"`{c}`" for s, c in cols if s == side]).repartition(partitions)
        return df.select(F.explode(F.array(*items)).alias("x")).select("x.*")
    both = one("gold", gold).unionByName(one("pred", pred))
    return both.groupBy("is_null", "v_num", "v_str").agg(
        *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(len(cols))])


def match_intervals(counts: DataFrame, cols: Sequence[tuple[str, str]], types: Sequence[T.DataType],
                    pairs: list[tuple[str, str]], n_rows: int, sort: str = "numeric",
                    tol: float = DEFAULT_TOL, partitions: int | None = None) -> DataFrame:
    """(gold_col, pred_col, ok) of numeric ``pairs``: equal, within the tolerance,
    at every rank.  ``counts`` are the :func:`value_counts` of ``cols``, whose types
    say how a number sorts by text.  The columns of a pair have equally many values."""
    number = {c: i for i, c in enumerate(cols)}
    used = sorted({number["gold", g] for g, _ in pairs} | {number["pred", p] for _, p in pairs})
    runs = counts.where(~F.col("is_null")).select("v_num", F.explode(F.filter(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(f"n{i}").alias("cnt")) for i in used]), lambda x: x["cnt"] > 0)).alias("x")) \
        .select("x.c", "v_num", "x.cnt")
    if sort == "string":
        text = F.lit(None).cast("string")
        for i in used:
            text = F.when(F.col("c") == i, sort_text(F.col("v_num").cast(types[i]), types[i])).otherwise(text)
        runs = runs.withColumn("v_txt", text)
    order = ["v_txt", "v_num"] if sort == "string" else ["v_num"]
    runs = running_total(runs, ["c"], order, "cnt", "lo", partitions)
    size = max(4096, isqrt(n_rows))
    last = F.col("lo") + F.col("cnt") - 1
    cut = runs.select("c", "v_num", "lo", F.explode(F.sequence(
        F.floor(F.col("lo") / size), F.floor(last / size))).alias("bin"))
    cut = cut.select("c", "v_num", "bin", F.greatest("lo", F.col("bin") * size).alias("at"))
    # peers of a rank are in the frame, and every bin begins with a row of each column
    if partitions:
        cut = cut.repartition(partitions, "bin")
    w = Window.partitionBy("bin").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    held = cut.select(*[F.last(F.when(F.col("c") == i, F.col("v_num")), ignorenulls=True).over(w).alias(f"c{i}")
                        for i in used])

    def same(g, p):
        x, y = F.col(f"c{number['gold', g]}"), F.col(f"c{number['pred', p]}")
        return F.when(x.isNull() & y.isNull(), True).otherwise(F.coalesce(isclose(x, y, tol), F.lit(False)))
    ok = held.agg(*[F.bool_and(same(g, p)).alias(f"p{i}") for i, (g, p) in enumerate(pairs)])
    return ok.select(F.explode(F.array(*[F.struct(F.lit(g).alias("gold_col"), F.lit(p).alias("pred_col"),
                                                  F.coalesce(f"p{i}", F.lit(True)).alias("ok"))
                                         for i, (g, p) in enumerate(pairs)])).alias("x")).select("x.*")


def column_match(gold: DataFrame, pred: DataFrame | None, gold_cols: Sequence[str], *,
                 ignore_order: bool = True, order_col: str | None = None,
                 pred_order_col: str | None = None,
                 tol: float = DEFAULT_TOL, sort: str = "numeric") -> DataFrame:
    """Per checked gold column: ``matched`` and the first predicted column
    that matches it (``matched_by``).  A missing prediction matches nothing.

    ``sort`` says how numbers are ordered when order is ignored: ``"numeric"``,
    or ``"string"``, by their text as the reference does (9.999 then sorts after
    10.0, so a pair within the tolerance can be refused).
    """
    spark = gold.sparkSession
    if sort not in ("numeric", "string"):
        raise ValueError(f"sort must be 'numeric' or 'string', not {sort!r}")
    if not ignore_order and (order_col is None or pred_order_col is None):
        raise ValueError("an order-respecting match needs an explicit order column on both sides")
    if pred is None:
        return spark.createDataFrame([(c, i, False, None) for i, c in enumerate(gold_cols)],
                                     "gold_col string, idx int, matched boolean, "
                                     "matched_by string")
    pred_cols = [c for c in pred.columns if c != pred_order_col]
    # The profiles and the pair list are column metadata, at most
    # len(gold_cols) x len(pred_cols) pairs: they are read on the driver once
    # (like a schema) so that the data plans below stay literal filters and a
    # tiny broadcast.
    gold_prof = profile(gold, gold_cols, "gold")
    pair_rows = candidate_pairs(gold_prof, profile(pred, pred_cols, "pred"), tol)
    # Equal-length columns that are entirely null (or empty) match.
    trivial = [(r["gold_col"], r["pred_col"]) for r in pair_rows if r["trivial"]]
    real = [(r["gold_col"], r["pred_col"]) for r in pair_rows if not r["trivial"]]
    if ignore_order:
        known, ok = list(trivial), None
        if real:
            cols = sorted({("gold", g) for g, _ in real} | {("pred", p) for _, p in real})
            types = [(gold if s == "gold" else pred).schema[c].dataType for s, c in cols]
            n_rows = max(r["n_rows"] for r in pair_rows)
            # values that one task can hold are not dealt to many
            parts = partitions_for(spark, n_rows * len(cols)) if n_rows * len(cols) > TASK_ROWS else None
            counts = store(value_counts(gold, pred, cols, parts), "value-counts", parts)
            # Equal fingerprints: confirm that the value counts are equal.  Exact
            # equality implies the tolerant match; numbers whose counts differ may
            # still match within the tolerance, anything else cannot.
            cands = [(r["gold_col"], r["pred_col"]) for r in pair_rows if not r["trivial"] and r["fp_equal"]]
            exact = set(_confirm_exact(counts, cols, cands)) if cands else set()
            if sort == "string":
                exact = {(g, p) for g, p in exact if value_class(gold.schema[g].dataType) != NUM
                         or gold.schema[g].dataType == pred.schema[p].dataType}
            known += sorted(exact)
            best: dict[str, str] = {}
            for g, p in known:
                best[g] = min(p, best.get(g, p))
            numeric = {c for _, c, cls, *_ in gold_prof if cls == NUM}
            # only pairs that could still change matched / matched_by
            open_ = [(g, p) for g, p in real if g in numeric and (g, p) not in exact and (g not in best or p < best[g])]
            if open_:
                ok = match_intervals(counts, cols, types, open_, n_rows, sort, tol, parts)
        done = spark.createDataFrame([(g, p, True) for g, p in known], "gold_col string, pred_col string, ok boolean")
        return _fold(spark, done if ok is None else ok.unionByName(done), gold_cols)
    done = spark.createDataFrame([(g, p, True) for g, p in trivial], "gold_col string, pred_col string, ok boolean")
    if not real:
        return _fold(spark, done, gold_cols)
    def numbered(df, names, order):
        """The rows of one table by position, each column as ``f"{side}{i}"`` (null, number, text)."""
        forms = {c: _forms(F.col(f"`{c}`"), df.schema[c].dataType) for c in names}
        wide = df.select(F.col(order).alias("_ord"), *[F.struct(null.alias("is_null"), num.alias("v_num"), text.alias("v_str"))
                                                       .alias(f"x{i}") for i, (_, null, num, text) in enumerate(forms.values())])
        at = positions(wide, [], ["_ord"], name="rank", partitions=parts).drop("_ord").repartition(parts, "rank")
        return at, {c: (f"x{i}", cls) for i, (c, (cls, *_)) in enumerate(forms.items())}
    parts = partitions_for(spark, max(r["n_rows"] for r in pair_rows))
    g, g_at = numbered(gold, sorted({g for g, _ in real}), order_col)
    p, p_at = numbered(pred, sorted({p for _, p in real}), pred_order_col)
    joined = g.alias("g").join(p.alias("p"), F.col("g.rank") == F.col("p.rank"), "left")

    def same(gc, pc):
        (x, x_cls), (y, y_cls) = g_at[gc], p_at[pc]
        sides = [[F.col(f"{t}.{k}") for k in ("is_null", "v_num", "v_str")] + [F.lit(cls)]
                 for t, cls in ((f"g.{x}", x_cls), (f"p.{y}", y_cls))]
        return F.coalesce(values_equal(*sides[0], *sides[1], tol), F.lit(False))
    ok = joined.agg(*[F.bool_and(same(gc, pc)).alias(f"p{i}") for i, (gc, pc) in enumerate(real)])
    per_pair = ok.select(F.explode(F.array(*[
        F.struct(F.lit(gc).alias("gold_col"), F.lit(pc).alias("pred_col"), F.col(f"p{i}").alias("ok")) for i, (gc, pc) in enumerate(real)])).alias("x")) \
        .select("x.*")
    return _fold(spark, per_pair.unionByName(done), gold_cols)


def _fold(spark, per_pair: DataFrame, gold_cols: Sequence[str]) -> DataFrame:
    hits = per_pair.groupBy("gold_col").agg(
        F.bool_or("ok").alias("matched"),
        F.min(F.when(F.col("ok"), F.col("pred_col"))).alias("matched_by"))
    cols = spark.createDataFrame([(c, i) for i, c in enumerate(gold_cols)],
                                 "gold_col string, idx int")
    return (F.broadcast(cols).join(hits, "gold_col", "left")
            .select("gold_col", "idx", F.coalesce("matched", F.lit(False)).alias("matched"),
                    "matched_by"))


def _confirm_exact(counts: DataFrame, cols: Sequence[tuple[str, str]],
                   cands: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Candidate pairs whose columns hold every value equally often: one flag per
    pair from one pass over the :func:`value_counts`."""
    number = {c: i for i, c in enumerate(cols)}
    r = counts.agg(*[F.bool_and(F.col(f"n{number['gold', g]}") == F.col(f"n{number['pred', p]}")).alias(f"p{i}")
                     for i, (g, p) in enumerate(cands)]).first()
    return [pair for i, pair in enumerate(cands) if r[f"p{i}"]]


def multiset_diff(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """M4 strict mode: rows only in gold / only in pred, each distinct row once with
    its surplus ``n``.  One grouped sum of signs gives both sides in one shuffle, and
    a row of any number of copies is combined before it."""
    cols = gold.columns
    both = gold.select(*cols, F.lit(1).alias("_sign")).unionByName(
        pred.select(*cols, F.lit(-1).alias("_sign")))
    surplus = both.groupBy(*cols).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    return surplus.select(*cols, F.abs("_n").alias("n"),
                          F.when(F.col("_n") > 0, "gold_only").otherwise("pred_only").alias("side"))
