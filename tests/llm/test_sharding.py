import collections
import zlib

import pytest
from pyspark.sql import functions as F

from rampart.llm import sharding
from tests.llm.conftest import prose


def rows_of(docs, **kw):
    return [tuple(r) for r in sharding.shard(docs, **kw).collect()]


def holds(rows, texts, shards):
    """Every document once, with its size and checksum; slots without gaps."""
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert collections.Counter(r[:3] for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r[3] < shards
        slots[r[3]].append(r[4])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def loads(rows, shards):
    out = [0] * shards
    for r in rows:
        out[r[3]] += r[1]
    return out


def cut_groups(rows):
    at = collections.defaultdict(set)
    for r in rows:
        at[r[1], r[2]].add(r[3])
    return at


def test_links_stay_together_and_sizes_are_even(make):
    texts = [(i, prose(20 + i % 31, i)) for i in range(400)] + \
            [(1000 + 5 * g + k, prose(40, 9000 + g)) for g in range(60) for k in range(2 + g % 4)]
    rows = rows_of(make(texts), shards=8)
    holds(rows, texts, 8)
    assert all(len(s) == 1 for s in cut_groups(rows).values())
    size = loads(rows, 8)
    assert max(size) - min(size) <= 0.02 * sum(size) / 8


def test_group_larger_than_a_shard_fills_few(make):
    """Half of all bytes are one text: four whole shards of eight, and no more than one besides."""
    hot = prose(50, 1)
    texts = [(i, hot) for i in range(600)] + [(1000 + i, prose(50, 50 + i)) for i in range(600)]
    rows = rows_of(make(texts), shards=8)
    holds(rows, texts, 8)
    per = collections.Counter(r[3] for r in rows if r[2] == zlib.crc32(hot.encode()))
    assert len(per) <= 6
    size = loads(rows, 8)
    assert max(size) - min(size) <= 0.03 * sum(size) / 8


def test_only_copies(make):
    texts = [(i, prose(30, 7)) for i in range(100)]
    rows = rows_of(make(texts), shards=4)
    holds(rows, texts, 4)
    assert sorted(collections.Counter(r[3] for r in rows).values()) == [25] * 4


def test_repeated_rows_nulls_long_and_one_giant(make):
    texts = [(7, "same")] * 50 + [(None, None)] * 9 + [(None, "x"), (3, ""), (3, None), (4, "é🙂"), (5, "w " * 60000)] + \
            [(100 + i, prose(5, i)) for i in range(40)]
    rows = rows_of(make(texts), shards=4)
    holds(rows, texts, 4)
    giant = [r for r in rows if r[1] > 100000][0]
    assert loads(rows, 4)[giant[3]] == giant[1]      # nothing joins what is over the mean by itself


def test_empty_table(make, spark):
    assert rows_of(make([(1, "a")]).where("doc_id < 0")) == []


def test_split_hot_kind(make, monkeypatch):
    """Positions of a group over several blocks."""
    monkeypatch.setattr(sharding, "_BLOCK", 16)
    texts = [(i, "copy") for i in range(300)] + [(None, "copy")] * 40 + [(1000 + i, prose(9, i)) for i in range(100)]
    rows = rows_of(make(texts), shards=4)
    holds(rows, texts, 4)


def test_link_of_other_column(spark):
    """Rows of one link value with unlike sizes move together where three of four bytes are linked; a null links with nothing."""
    texts = [(i, prose(3 + i % 17, i), i // 6 if i < 300 else None) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, host int")
    rows = rows_of(docs, shards=5, link=F.col("host"))
    holds(rows, [(i, t) for i, t, _ in texts], 5)
    where = {r[0]: r[3] for r in rows}
    whole = sum(len({where[i] for i in range(6 * h, 6 * h + 6)}) == 1 for h in range(50))
    assert whole >= 40, whole
    size = loads(rows, 5)
    assert max(size) - min(size) <= 0.1 * sum(size) / 5


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_BLOCK", 10)
    df = spark.range(500).select((F.col("id") % 3).alias("k"), "id", (F.col("id") % 7 + 1).alias("v"))
    got = sharding.running(df, ["k"], ["id"], "v").collect()
    for k in range(3):
        spans = sorted((r.at, r.at + r.v) for r in got if r.k == k)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("load", [[0, 0, 0], [90, 10, 50], [100, 100, 0], [130, 20, 0]])
def test_quotas_overfill_nothing(load):
    wish = {(0, 1): 60, (1, 2): 30, (2, 1): 90, (1, 0): 40, (0, 2): 5}
    got = sharding.quotas(wish, load, 100.0)
    assert all(0 <= got[k] <= wish[k] for k in wish)
    for t in range(3):
        into = sum(x for (_, u), x in got.items() if u == t)
        net = load[t] + into - sum(x for (u, _), x in got.items() if u == t)
        assert into < 1 or net <= 101


def test_water_level():
    assert sharding.water_level([5, 9, 1], 6) == [1, 0, 5]
    assert sharding.water_level([0, 0], 0) == [0, 0]
    assert sharding.water_level([10, 0, 0], 4) == [0, 2, 2]


def test_query_columns(spark, tmp_path):
    from rampart.llm.queries import QUERIES
    spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["op11_sharding"](spark, str(tmp_path))
    assert df.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                         ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    assert [tuple(r)[:4] for r in df.collect()] == [(1, 2, zlib.crc32(b"a"), "bytes")]
    assert "Python" not in df._jdf.queryExecution().toString()
