"""Positions within groups without a one-task window.

``row_number() over (partition by g order by k)`` puts each whole group in
one task; a group holding a third of the data then runs on one core.  Groups
of at most a shuffle partition's share of the rows are numbered that way, in one
shuffle.  A larger (hot) group, and rows without a group, are range-partitioned on
(g, k), sorted within partitions and numbered by ``monotonically_increasing_id``
(partition id in the high bits, the row's place in the sorted partition in the
low bits).  These rows are written once under the checkpoint folder so ids never
change; then each partition's offset comes from the partitions' counts: a literal
where there is one group, and a small table of one row per partition that a
hot group spans otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rampart.operators.skew import hot_groups, with_hot
from rampart.session import store


def positions(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
              name: str = "pos", counts: DataFrame | None = None,
              partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` column: the row's place within its group.

    ``order`` entries may be column names or sort Columns (e.g. ``F.col(x).asc_nulls_last()``).
    Ties are numbered in an arbitrary order.  ``counts`` (group columns, ``n``) may give
    the groups' sizes, or upper bounds of them, where that is cheaper than to count ``df``.
    ``partitions`` is the number of range partitions of a whole table.
    """
    group = list(group)
    if not group:
        return _number_all(df, order, name, partitions)
    if counts is None:
        counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    hot = hot_groups(store(counts, "group-sizes"), group, "n")
    w = Window.partitionBy(*group).orderBy(*order)
    if hot is None:
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    df = with_hot(df, hot, group)
    rest = df.where("_salts is null").drop("_salts").withColumn(name, F.row_number().over(w).cast("bigint"))
    return rest.unionByName(_number_hot(df.where("_salts is not null").drop("_salts"), group, order, name))


def _ranged(df: DataFrame, sort_cols: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions, sorted and written, with ``_pid`` and ``_idx`` of each row."""
    # Equal sort keys cannot be told apart by range bounds; the row's own number
    # in the input splits a frequent value over many partitions.
    ranged = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*([partitions] if partitions else []), *sort_cols, "_tie") \
        .sortWithinPartitions(*sort_cols, "_tie").drop("_tie")
    # One write; ids are fixed by the files, and nothing is kept on executors.
    ranged = store(ranged.withColumn("_mid", F.monotonically_increasing_id()), "positions")
    pid = F.shiftright(F.col("_mid"), 33)
    return ranged.withColumn("_pid", pid).withColumn("_idx", F.col("_mid") - F.shiftleft(pid, 33)).drop("_mid")


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _number_all(df: DataFrame, order: Sequence[str | Column], name: str, partitions: int | None = None) -> DataFrame:
    """Places in the whole table: one literal offset per partition, no join."""
    ranged = _ranged(df, _sort_cols(order), partitions)
    sizes = {r[0]: r[1] for r in ranged.groupBy("_pid").agg(F.count(F.lit(1))).collect()}
    offsets, at = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(at)
        at += sizes.get(p, 0)
    off = F.get(F.lit(offsets).cast("array<bigint>"), F.col("_pid").cast("int"))
    return ranged.withColumn(name, off + F.col("_idx") + 1).drop("_pid", "_idx")


def _number_hot(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """Places in groups larger than a partition: few groups, many partitions each."""
    ranged = _ranged(df, [F.col(g) for g in group] + _sort_cols(order))
    counts = ranged.groupBy("_pid", *group).agg(F.min("_idx").alias("_first"),
                                                F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    out = ranged.alias("r").join(offsets.select("_pid", *group, "_first", "_off").alias("o"),
                                 [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ["_pid", *group]])
    out = out.select(*[F.col(f"r.{c}").alias(c) for c in ranged.columns], "_first", "_off")
    return out.withColumn(name, F.col("_off") + F.col("_idx") - F.col("_first") + 1) \
              .drop("_pid", "_idx", "_first", "_off")


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str,
                  name: str = "before", partitions: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows before this one in its group.

    ``order`` must be unique within a group (e.g. distinct values with their
    counts), so range partitions are even and a window per (partition, group)
    is as small as a partition; earlier partitions come in by one offset each.
    ``partitions`` is their number where the rows are known.
    """
    keys = [*group, *order]
    ranged = store(df.repartitionByRange(*([partitions] if partitions else []), *keys).withColumn("_pid", F.spark_partition_id()), "running")
    before = (Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_pid", *group).agg(F.sum(weight).alias("_sum"))
    sums = sums.select("_pid", *group, F.coalesce(F.sum("_sum").over(
        Window.partitionBy(*group).orderBy("_pid").rowsBetween(*before)), F.lit(0)).alias("_off"))
    here = F.sum(weight).over(Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(*before))
    return ranged.join(sums, ["_pid", *group]).withColumn(
        name, F.col("_off") + F.coalesce(here, F.lit(0))).drop("_pid", "_off")
