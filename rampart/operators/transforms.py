"""User-level table transforms the checked targets are built with.

Scale notes: running totals first collapse to one row per (entity, day), so a
window partition holds at most one row per calendar day whatever the
entity's volume; first-activity dates are a grouped ``min`` joined back
instead of a per-entity window; the daily spine is generated per entity up to
one scalar date bound.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rampart.operators.ordering import positions
from rampart.operators.skew import SALT, join_per_group
from rampart.operators.policies import expected_amount
from rampart.session import store


def charge_history(df: DataFrame, *, charge: str, kinds: Mapping[str, Column | tuple[Column, Column]],
                   order_tie: Sequence[str] = (), carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per (source row, kind) with a row number per charge, ordered by
    (kind, amount, tie columns).  A kind is an amount, or (amount, condition) where
    only some rows have it; ``source_index`` is the kind's place in ``kinds`` and
    ``carry`` names further columns.  The source is read once, its kinds exploded.
    Numbering is distributed (:func:`positions`), so a charge with huge fan-out is
    not one task."""
    items = []
    for i, (name, kind) in enumerate(kinds.items()):
        amount, cond = kind if isinstance(kind, tuple) else (kind, F.lit(True))
        items.append(F.struct(F.lit(name).alias("line_item_type"), F.lit(i).alias("source_index"),
                              amount.cast("double").alias("amount"), cond.alias("has")))
    u = df.select(F.col(charge).alias("charge_id"), *[F.col(c) for c in order_tie],
                  *[c.alias(n) for n, c in (carry or {}).items()],
                  F.explode(F.filter(F.array(*items), lambda x: x["has"])).alias("x"))
    u = u.select("*", "x.line_item_type", "x.source_index", "x.amount").drop("x")
    # a charge has at most one row per source row and kind
    sizes = df.groupBy(F.col(charge).alias("charge_id")).agg((F.count(F.lit(1)) * len(kinds)).alias("n"))
    return positions(u, ["charge_id"], ["line_item_type", "amount", *order_tie],
                     name="charge_row_num", counts=sizes)


def percentage_amount(kind: Column, value: Column, base: Column) -> Column:
    """round(value/100 * base, 2) for percentage kinds, else the value."""
    return expected_amount(kind, value, base)


def daily_spine(activity: DataFrame, *, entity: str, day: str,
                measures: Sequence[Column], start: str | None = None) -> DataFrame:
    """Every day from the FIRST to the LAST ACTIVITY DAY (never the
    clock) for every entity, left-joined with the per-day aggregates.

    With a ``start`` the spine begins there: earlier activity is outside the
    contract and left out, and a start after the last activity day gives no
    rows.  Rows without a day are on no spine.  The input is aggregated once;
    the bounds and the entities come from its daily rows."""
    daily = store(activity.where(F.col(day).isNotNull())
                  .groupBy(entity, F.col(day).cast("date").alias("day")).agg(*measures), "daily")
    # The clamps are two scalars, read once and used as literals.
    first_day, last_day = daily.agg(F.min("day"), F.max("day")).first()
    if start is not None:
        first_day = datetime.date.fromisoformat(start)
    if last_day is None or first_day > last_day:
        return daily.limit(0)
    spine = daily.select(entity).distinct().select(
        entity, F.explode(F.sequence(F.lit(first_day), F.lit(last_day))).alias("day"))
    return spine.join(daily, [entity, "day"], "left")


def running_totals(df: DataFrame, *, entity: str, day: str, amount: str,
                   scale: int = 2) -> DataFrame:
    """T4: per entity and day, the day's total and the running total.
    Exact decimal sums; the window sees one row per (entity, day)."""
    daily = df.groupBy(entity, F.col(day).cast("date").alias("day")).agg(
        F.sum(F.col(amount).cast(f"decimal(18,{scale})")).alias("_daily"))
    w = Window.partitionBy(entity).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(entity, "day", F.col("_daily").cast("double").alias("daily"),
                        F.sum("_daily").over(w).cast("double").alias("running"))


def active_months(df: DataFrame, *, entity: str, day: str, inclusive: bool = True,
                  scale: int = 2) -> DataFrame:
    """T5: (days since the entity's first day [+1]) / 30, rounded; never
    negative.  First day = grouped min joined back on (entity, salt), so an
    entity with a third of all rows is split (no per-entity window)."""
    first = store(df.groupBy(entity).agg(F.min(F.col(day).cast("date")).alias("_first"),
                                         F.count(F.lit(1)).alias("_n")), "first-days")
    j = join_per_group(df, first, [entity], df.columns, "_n").drop(SALT, "_n")
    days = F.datediff(F.col(day).cast("date"), F.col("_first")) + (1 if inclusive else 0)
    months = F.round(days.cast("decimal(12,0)") / F.lit(30), scale)
    return j.withColumn("months", F.greatest(months, F.lit(0)).cast("double")).drop("_first")


def product_rollup(lines: DataFrame, *, product: str, line_key: Sequence[str],
                   quantity: str, price: str, discount: str, tax: str,
                   refunded: Column) -> DataFrame:
    """T6 per product: lines, quantity, net quantity, subtotal, refunds, net, averages
    per line (amount, quantity, discount), discount and tax.  Sums combine before the
    shuffle; only the keys are shuffled whole, to count distinct lines."""
    d = lambda c: F.col(c).cast("decimal(18,2)")
    back = lambda c: F.sum(F.when(refunded, c).otherwise(0))
    sums = lines.groupBy(F.col(product).alias("_p")).agg(
        F.sum(d(quantity)).alias("q"), back(d(quantity)).alias("qref"),
        F.sum(d(price)).alias("sub"), back(d(price)).alias("ref"),
        F.sum(d(price) * d(discount)).alias("disc"), F.sum(d(price) * d(tax)).alias("tax"))
    n = lines.select(product, *line_key).distinct().groupBy(product).agg(F.count(F.lit(1)).alias("lines"))
    agg = sums.join(n, F.col("_p").eqNullSafe(F.col(product)))
    r = lambda c: F.round(c, 2).cast("double")
    per = lambda c: F.col(c).cast("double") / F.col("lines")
    return agg.select(product, "lines", r(F.col("q")).alias("quantity"),
                      r(F.col("q") - F.col("qref")).alias("net_quantity"),
                      r(F.col("sub")).alias("subtotal"), r(F.col("ref")).alias("refunds"),
                      r(F.col("sub") - F.col("ref")).alias("net"),
                      per("sub").alias("avg_per_line"), per("q").alias("avg_quantity_per_line"),
                      per("disc").alias("avg_discount_per_line"),
                      r(F.col("disc")).alias("discount_total"), r(F.col("tax")).alias("tax_total"))
