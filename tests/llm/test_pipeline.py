import corpus_pipeline
from rampart.llm import decontam, near_dup, queries, stages
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dup", "substring", "decontamination", "packing"]


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    assert good.where("text rlike '!! [A-Z]+!! [A-Z]+!!'").count() < docs.where("text rlike '!! [A-Z]+!! [A-Z]+!!'").count()
    one = steps["near_dup"](spark, docs, SF)
    assert one.columns == docs.columns
    groups = near_dup.near_duplicates(one, shingle=5)
    assert groups.where("not kept").count() == 0 and one.groupBy("text").count().where("count > 1 and text rlike '\\\\S'").count() == 0
    kept = steps["substring"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.where("n_chars <> char_length(text)").count() == 0
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    free = steps["decontamination"](spark, docs, SF)
    leaked = decontam.leaks(docs, bench).select("doc_id").distinct().count()
    assert leaked > 0 and free.count() == docs.count() - leaked


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, SF)
    full = got.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n")
    assert full.where("n > 4096").count() == 0 and full.where("n < 4096").count() <= 1


def test_equal_rows_leave_one_and_unlike_rows_stay(spark, make):
    rows = [(1, prose(60, 1)), (1, prose(60, 1)), (2, prose(60, 1)), (3, prose(60, 2)), (None, prose(60, 1)), (4, None), (4, ""),
            (5, prose(60, 3)), (5, prose(60, 4)), (5, prose(60, 2)), (5, prose(60, 3)), (4, None)]
    got = stages.distinct(spark, make(rows), SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(1, prose(60, 1)), (3, prose(60, 2)), (None, prose(60, 1)), (4, None), (4, ""), (5, prose(60, 3)), (5, prose(60, 4))], key=repr)
    assert stages.distinct(spark, make(rows), SF).columns == make(rows).columns


def test_stages_of_odd_rows(spark, make):
    """Null and empty texts, null ids, repeated rows, clashing columns and no rows: each stage is defined."""
    rows = [(1, None), (2, ""), (None, prose(30, 1)), (None, None), (3, prose(80, 2)), (3, prose(80, 2)), (4, prose(80, 2)), (5, "x " * 3000)]
    docs, none = make(rows), make([(1, "a")]).where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out, empty = stage(spark, docs, SF), stage(spark, none, SF)
        assert empty.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns == empty.columns, name
    steps = dict(corpus_pipeline.STAGES)
    assert steps["decontamination"](spark, docs, SF).count() == len(rows)
    kept = steps["substring"](spark, docs, SF).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [1, 2, 3, 3, 5, None, None]
    pieces = steps["packing"](spark, docs, SF).collect()
    assert sum(p.length for p in pieces if p.doc_id is None) > 2 and {p.doc_id for p in pieces} == {None, 1, 2, 3, 4, 5}
