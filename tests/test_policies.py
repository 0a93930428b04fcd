"""P1-P3, P10 on hand-made fixtures (FIXTURES.md §3: charges_small,
domain_small, types_small)."""

import math

import pytest
from pyspark.sql import functions as F

from rampart.operators import policies as P

KW = dict(target_source_keys=[("charge_id", "charge_id"), ("title", "code")],
          source_base_keys=[("charge_id", "id")], kind_col="value_type", value_col="value",
          found_col="amount", base_col="total", target_filter="line_item_type = 'discount'")


def _charges(spark, amounts, base_rows=None):
    target = spark.createDataFrame(
        [(str(i), f"C{i}", "discount", a) for i, a in enumerate(amounts)],
        "charge_id string, title string, line_item_type string, amount double")
    source = spark.createDataFrame(
        [(0, "C0", "percentage", 8.0), (1, "C1", "percentage", 15.0), (2, "C2", "fixed_amount", 5.0),
         (3, "C3", "percentage", 10.0)],
        "charge_id long, code string, value_type string, value double")
    base = spark.createDataFrame(base_rows or [(0, 11.95), (1, 9.95), (2, 20.0), (3, 40.0)],
                                 "id long, total double")
    return target, source, base


def verdict(res):
    return res.verdict.collect()[0]


def test_percentage_amounts_pass(spark):
    # 8 % of 11.95 -> 0.96; 15 % of 9.95 -> 1.49 (half-up on the exact value)
    t, s, b = _charges(spark, [0.96, 1.49, 5.0, 4.0])
    v = verdict(P.derived_amount_check(t, s, b, policy="discount", **KW))
    assert (v.status, v.checked_rows, v.n_violations) == ("pass", 4, 0)


def test_raw_value_fault_is_violation(spark):
    t, s, b = _charges(spark, [8.0, 1.49, 5.0, 4.0])   # raw percentage instead of amount
    res = P.derived_amount_check(t, s, b, **KW)
    v = verdict(res)
    assert v.status == "violation" and v.n_violations == 1
    bad = res.violations.collect()[0]
    assert bad.amount_expected == 0.96 and bad.amount_found == 8.0


def test_within_tolerance_is_not_a_violation(spark):
    t, s, b = _charges(spark, [0.965, 1.499, 5.009, 4.0])
    assert verdict(P.derived_amount_check(t, s, b, **KW)).status == "pass"


def test_nan_amount_is_not_a_violation_but_null_is_error(spark):
    t, s, b = _charges(spark, [math.nan, 1.49, 5.0, 4.0])
    assert verdict(P.derived_amount_check(t, s, b, **KW)).status == "pass"
    t, s, b = _charges(spark, [None, 1.49, 5.0, 4.0])
    v = verdict(P.derived_amount_check(t, s, b, **KW))
    assert v.status == "error" and "null" in v.message


def test_missing_base_row_is_error(spark):
    t, s, b = _charges(spark, [0.96, 1.49, 5.0, 4.0], base_rows=[(0, 11.95), (1, 9.95), (2, 20.0)])
    assert verdict(P.derived_amount_check(t, s, b, **KW)).status == "error"


def test_missing_tables_and_empty_join_are_errors(spark):
    t, s, b = _charges(spark, [0.96])
    assert verdict(P.derived_amount_check(None, s, b, **KW)).status == "error"
    assert verdict(P.derived_amount_check(t, None, b, **KW)).status == "error"
    empty = t.where("false")
    v = verdict(P.derived_amount_check(empty, s, b, **KW))
    assert v.status == "error" and "0 rows" in v.message


def test_join_fan_out_counts_duplicates(spark):
    t, s, b = _charges(spark, [0.96, 1.49, 5.0, 4.0])
    v = verdict(P.derived_amount_check(t.unionByName(t.limit(1)), s, b, **KW))
    assert v.checked_rows == 5


def test_domain_membership_with_null_and_suggestions(spark):
    vals = ["charge line", "discount", "shipping", "tax", "refund", "charge_line", "line_item",
            "Taxes", None, None]
    df = spark.createDataFrame([(v,) for v in vals], "line_item_type string")
    res = P.value_domain_check(df, "line_item_type", P.CHARGE_LINE_TYPES,
                               confusions=P.CHARGE_LINE_CONFUSIONS)
    v = verdict(res)
    assert v.status == "violation" and v.checked_rows == 10 and v.n_violations == 4
    got = {r.value: (r.row_count, r.suggestion) for r in res.violations.collect()}
    assert got == {"charge_line": (1, "charge line"), "line_item": (1, "charge line"),
                   "Taxes": (1, "tax"), None: (2, None)}


def test_domain_underscore_fallback_and_membership_only(spark):
    df = spark.createDataFrame([("discount",), ("shipping",)], "t string")
    assert verdict(P.value_domain_check(df, "t", ("discount", "shipping", "tax"))).status == "pass"
    df = spark.createDataFrame([("free_ship",)], "t string")
    res = P.value_domain_check(df, "t", ("free ship",))
    assert res.violations.collect()[0].suggestion == "free ship"


def test_domain_empty_table_and_missing_column(spark):
    df = spark.createDataFrame([], "line_item_type string")
    assert verdict(P.value_domain_check(df, "line_item_type", P.CHARGE_LINE_TYPES)).status == "error"
    assert verdict(P.value_domain_check(df, "other", P.CHARGE_LINE_TYPES)).status == "error"


def test_type_preservation(spark):
    src = spark.createDataFrame([(1, 2, 3)], "ID long, CUSTOMER_ID long, ADDRESS_ID long")
    m = {"charge_id": "ID", "customer_id": "CUSTOMER_ID", "address_id": "ADDRESS_ID"}
    from decimal import Decimal
    ok = spark.createDataFrame([(1, 2.0, Decimal(3))], "charge_id long, customer_id double, "
                                                       "address_id decimal(18,0)")
    assert verdict(P.type_preservation_check(ok, src, m)).status == "pass"
    bad = spark.createDataFrame([("1", 2, 3)], "charge_id string, customer_id long, address_id long")
    res = P.type_preservation_check(bad, src, m)
    v = verdict(res)
    assert v.status == "violation" and v.checked_rows == 3
    assert res.violations.collect()[0].column == "charge_id"
    missing = spark.createDataFrame([(1,)], "charge_id long")
    assert verdict(P.type_preservation_check(missing, src, m)).status == "error"


def test_range_check(spark):
    df = spark.createDataFrame([(0.03,), (1.0,), (-0.5,), (None,)], "months double")
    v = verdict(P.range_check(df, "months", lower=0.0))
    assert (v.status, v.checked_rows, v.n_violations) == ("violation", 3, 1)


def test_key_fanout_counts_repeated_join_keys(spark):
    """SURVEY §7.6 hazard 6: repeated keys inflate P1's checked rows; the
    fan-out report names how many keys repeat and how many rows they add."""
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (2, 2)], "k long, n int")
    r = P.key_fanout(df, ["k", "n"]).collect()[0]
    assert (r.distinct_keys, r.duplicated_keys, r.extra_rows) == (3, 1, 2)
    r = P.key_fanout(df.limit(0), ["k", "n"]).collect()[0]
    assert (r.distinct_keys, r.duplicated_keys, r.extra_rows) == (0, 0, 0)


def test_rounding_by_the_binary_value(spark):
    """2.675 lies below its tie and 0.125 on it; decimal rounding takes both up."""
    import random

    from rampart.functions.rounding import round_binary
    rnd = random.Random(11)
    values = [2.675, 0.125, 0.375, 1.005, -2.675, -0.125, 0.0, -0.001, 1e-9, 0.5, 1.5, 2.5, 1e15, -1e300, 1e12 + 0.125, 1.1, 99999.995]
    values += [rnd.randrange(10 ** 7) / 8 for _ in range(300)] + [round(rnd.uniform(0, 1e5), 3) for _ in range(1500)]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-5, 9) for _ in range(1500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for scale in (0, 2, 4):
        got = [r.r for r in df.select(round_binary(F.col("v"), scale).alias("r")).collect()]
        want = [round(v, scale) if abs(v) < 2 ** 44 / 10 ** scale else v for v in values]
        assert got == want, [x for x in zip(values, got, want) if x[1] != x[2]][:5]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "v double")
    got = [r.r for r in odd.select(round_binary(F.col("v")).alias("r")).collect()]
    assert got[0] != got[0] and got[1:] == [float("inf"), None]


def test_expected_amount_in_both_roundings(spark):
    df = spark.createDataFrame([("percentage", 8.0, 11.95), ("percentage", 12.5, 1.0), ("percentage", 50.0, 5.35), ("fixed", 3.0, 9.0)],
                               "k string, v double, b double")

    def amounts(mode):
        return [r.e for r in df.select(P.expected_amount(F.col("k"), F.col("v"), F.col("b"), rounding=mode).alias("e")).collect()]
    assert amounts("decimal") == [0.96, 0.13, 2.68, 3.0]
    assert amounts("binary") == [0.96, 0.12, 2.67, 3.0] == [round(8.0 / 100 * 11.95, 2), round(0.125, 2), round(50 / 100 * 5.35, 2), 3.0]
    with pytest.raises(ValueError):
        amounts("up")


def test_retry_rows_are_made_once(spark):
    """Sizes, range bounds, positions and the final order do not run the checks again."""
    from pyspark.sql import functions as F

    from rampart.operators import messages as Msg
    made = spark.sparkContext.accumulator(0)

    def text(i):
        made.add(1)
        return f"t{i:06d}"
    rows = spark.range(12_000).select(F.udf(text)("id").alias("subject"), F.lit("x").alias("text"))
    few = spark.createDataFrame([("b", "2"), ("a", "1"), ("a", None)], "subject string, text string")
    got = Msg.retry_rows({"many": rows, "few": few}).collect()
    assert made.value == 12_000
    assert [(r.policy, r.subject, r.position) for r in got[:3]] == [("few", "a", 1), ("few", "a", 2), ("few", "b", 3)]
    assert [(r.subject, r.position) for r in got[3:]] == [(f"t{i:06d}", i + 1) for i in range(12_000)]
