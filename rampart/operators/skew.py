"""Joining small per-group values back to rows when one group may be hot.

The small side is an aggregate with one row per group and the group's number of
rows, which is worked out anyway.  A group is *hot* if it holds more than a shuffle
partition's share of all rows; there are fewer such groups than partitions, so
their list is small whatever the data.  Only a hot group is salted, by as many
salts as it has shares: its rows carry a salt made of their own unique columns and
its small row is copied once per salt.  All other groups are joined as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"
LEAST_ROWS = 10_000      # no group of fewer rows is worth a second task


def hot_groups(counts: DataFrame, keys: Sequence[str], rows: str) -> DataFrame | None:
    """(keys, _salts) of the groups with more than their share, or None.

    ``counts`` has one row per group with its number of ``rows``; it is read twice
    at most, so hand in a written table.  The result has fewer rows than there are
    shuffle partitions.
    """
    spark = counts.sparkSession
    total, most = counts.agg(F.sum(rows), F.max(rows)).first()
    share = max(LEAST_ROWS, (total or 0) / int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not most or most <= share:
        return None
    found = counts.where(F.col(rows) > share).select(*keys, rows).collect()
    schema = T.StructType([*[T.StructField(k, counts.schema[k].dataType) for k in keys],
                           T.StructField("_salts", T.IntegerType())])
    return spark.createDataFrame([(*r[:-1], ceil(r[-1] / share)) for r in found], schema)


def with_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the ``_salts`` of its group, null if that is not hot; a null key is a group."""
    h = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_salts"))
    same = [df[k].eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    return df.join(h, same, "left").drop(*[f"_hot_{k}" for k in keys])


def join_per_group(df: DataFrame, small: DataFrame, keys: Sequence[str],
                   unique: Sequence[str | Column], rows: str) -> DataFrame:
    """``df`` joined with its group's row of ``small`` (a written table with the number
    of ``rows`` of each group), hot groups split by size.  The salt column stays for
    a first-level aggregate; it is 0 in groups that are not hot."""
    hot = hot_groups(small, keys, rows)
    if hot is None:
        return df.withColumn(SALT, F.lit(0)).join(small, list(keys))
    salts = F.coalesce("_salts", F.lit(1))
    left = with_hot(df, hot, keys).withColumn(SALT, F.pmod(F.xxhash64(*unique), salts).cast("int")).drop("_salts")
    right = with_hot(small, hot, keys).withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [*keys, SALT])
