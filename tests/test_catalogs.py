"""A3 listings and M2 guarded reads."""

import uuid

import pytest

from rampart.operators import names as N
from rampart.sources import catalogs as C


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    spark.range(5).write.parquet(good)
    spark.range(5).selectExpr("cast(id as string) v").write.text(bad)
    C.create_database(spark, name, str(tmp_path / "db"),
                      {"good": f"(id BIGINT) USING parquet LOCATION '{good}'", "bad": f"(id BIGINT) USING parquet LOCATION '{bad}'"},
                      {"seen": f"SELECT id + 1 AS n FROM parquet.`{good}`"})
    yield name
    C.drop_databases(spark, [name])


def test_listing_tells_missing_from_empty(spark, tmp_path, database):
    empty = f"db_{uuid.uuid4().hex}"
    C.create_database(spark, empty, str(tmp_path / "empty"))
    got = {tuple(r) for r in C.list_tables(spark, [database, empty, "no_such_db"]).collect()}
    C.drop_databases(spark, [empty])
    assert got == {(database, "good", None), (database, "bad", None), (database, "seen", None),
                   ("no_such_db", None, "could not open no_such_db: not found")}
    assert C.list_tables(spark, []).count() == 0


def test_reads_that_fail_are_errors(spark, database):
    df, error = C.read_table(spark, database, "seen")
    assert error is None and sorted(r.n for r in df.collect()) == [1, 2, 3, 4, 5]
    assert C.read_table(spark, database, "absent") == (None, "TABLE_OR_VIEW_NOT_FOUND")
    df, error = C.read_table(spark, database, "bad")
    assert df is None and error
    assert C.read_table(spark, "no_such_db", "good")[0] is None


def test_gate_over_unreadable_database(spark):
    pairs = "project string, name string"
    declared = spark.createDataFrame([("a", "m"), ("b", "m")], pairs)
    none = declared.limit(0)
    made = spark.createDataFrame([("a", "m")], pairs)
    bad = spark.createDataFrame([("b", "could not open b"), ("c", "could not open c")], "project string, error string")
    got = {r.project: (r.status, r.reason, r.n_unmet) for r in N.name_gate(
        N.name_flags(declared, none, declared, made), bad).collect()}
    assert got == {"a": ("pass", "declared-names", 0), "b": ("error", "catalog-unreadable", 0),
                   "c": ("error", "catalog-unreadable", 0)}


def test_diagnosis_keeps_the_other_tables(spark, database):
    from rampart.plans.matching_plans import diagnose
    rows = {t: diagnose(spark, database, "no_such_db" if t == "good" else database, t, [0]).first()
            for t in ("good", "bad", "seen")}
    assert rows["bad"].error.startswith("gold table unreadable: ") and rows["bad"].gold_rows is None
    assert rows["good"].error == "pred table missing/unreadable: TABLE_OR_VIEW_NOT_FOUND" and rows["good"].pred_exists is False
    assert rows["seen"].error is None and rows["seen"].cols_matched == "[0]n"
