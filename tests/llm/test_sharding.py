import random
import zlib
from collections import defaultdict

from logloom.llm import sharding as S
from tests.llm.conftest import EDGE, dicts, table


def laws(rows, shards):
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards
        by[r["shard"]].append(r)
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
    return [sum(r["size"] for r in by[i]) for i in range(shards)]


def test_whole_table(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    rows = dicts(S.shard_records(docs))
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r["size"] == len(texts[r["id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["id"]])
    sizes = laws(rows, 8)
    # a shard ends at a record's edge
    assert max(sizes) - min(sizes) <= 2 * max(len(t) + 1 for t in texts.values())
    where = defaultdict(set)
    for r in rows:
        where[texts[r["id"]]].add(r["shard"])
    assert all(len(s) == 1 for t, s in where.items() if 10 * (len(t) + 1) < 0.005 * sum(sizes) / 8)


def test_a_hot_text_is_dealt_out(spark):
    rng = random.Random(2)
    texts = ["the same text " * 5] * 3000 + ["x" * rng.randint(0, 100) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    sizes = laws(dicts(S.shard_records(df)), 8)
    assert max(sizes) <= 1.02 * min(sizes)


def test_repeated_ids_and_few_rows(spark, edge, empty):
    rows = dicts(S.shard_records(edge))
    assert len(rows) == len(EDGE)
    laws(rows, 8)
    assert [r["size"] for r in rows if r["id"] == 2] == [1]
    assert S.shard_records(empty).count() == 0
    assert S.shard_records(empty).columns == S.shard_records(edge).columns
    same = spark.createDataFrame([(None, "same")] * 800, "doc_id bigint, text string").repartition(4)
    sizes = laws(dicts(S.shard_records(same)), 8)
    assert max(sizes) - min(sizes) <= 2 * 5


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLES_PER_RANGE", 1)  # poor boundaries
    df = spark.range(5000).selectExpr("id AS doc_id", "repeat('a', cast(id % 97 AS int)) AS text")
    sizes = laws(dicts(S.shard_records(df)), 8)
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 8 + 200


def test_range_search(spark):
    bounds = [(-(1 << 63), 3), (-5, 0), (-5, 7), (0, -(1 << 63)), (9, 9)]
    keys = [(-(1 << 63), 2), (-(1 << 63), 3), (-6, 0), (-5, 0), (-5, 6), (-5, 7), (0, -1), (9, 8), (9, 9), (10, 0)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(keys, "k1 bigint, k2 bigint")
    got = [r[0] for r in df.select(S._range_of(F.col("k1"), F.col("k2"), bounds)).collect()]
    assert got == [sum(b <= k for b in bounds) for k in keys]


def test_write_shards(edge, tmp_path):
    S.write_shards(edge, str(tmp_path / "out"), shards=3)
    back = edge.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(EDGE) and set(edge.columns) < set(back.columns)
