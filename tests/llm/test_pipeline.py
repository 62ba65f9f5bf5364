import inspect
import os

from pyspark.sql import functions as F

import corpus_pipeline
from logloom.llm import decontaminate, exact_dedup, simhash
from logloom.llm.common import ROW_ID, keep_rows, stored, with_row_id
from logloom.session import work_dir
from tests.llm.conftest import table
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(spark):
    docs = table(spark, "documents", SF)
    items = [(r.item_id, r.text) for r in table(spark, "benchmark", SF).collect()]
    outs, before = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SF), "test_stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        outs[name] = (before, after)
        before = after

    def texts(df):
        return {r.doc_id: r.text for r in df.collect()}
    a, b = map(texts, outs["quality_classifier"])
    assert set(b) <= set(a)  # 200 documents give too little evidence to reject any
    a, b = map(texts, outs["exact_dedup"])
    assert set(b) == {max(i for i in a if a[i] == t) for t in set(a.values())}
    a, b = map(texts, outs["simhash_near_dedup"])
    comp = brute_components({brute_fp(t) for t in a.values()})
    groups = {}
    for i, t in a.items():
        groups.setdefault(comp[brute_fp(t)], []).append(i)
    assert set(b) == {min(g) for g in groups.values()}
    a, b = map(texts, outs["benchmark_decontamination"])
    assert all(brute_hits(t, items)[1] == 0 for t in b.values())
    assert all(b[i] == t for i, t in a.items() if brute_hits(t, items)[1] == 0)
    a, b = outs["best_fit_packing"]
    assert {r.doc_id for r in b.select("doc_id").collect()} == set(texts(a))


def test_the_quality_stage_rejects_documents(spark):
    """At five times the size the strict form holds, and mostly bad ones go."""
    mid = "/root/testdata/sf0.01"
    docs, labels = table(spark, "documents", mid), table(spark, "labels", mid)
    kept = corpus_pipeline.keep_good(spark, docs, mid)
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in kept.collect()}
    known = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.collect()}
    bad = sum(not known[i] for i in gone if i in known)
    assert gone and bad >= 0.8 * sum(i in known for i in gone)


def test_the_quality_stage_rejects_documents_of_a_small_corpus(spark):
    docs = table(spark, "documents", SF)
    kept = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs, SF).collect()}
    assert kept < {r.doc_id for r in docs.collect()}


def test_contract():
    assert [len(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [3] * 5
    assert all(m.__name__.startswith("logloom.llm") for m in (decontaminate, exact_dedup, simhash))


def test_hot_groups(spark, tmp_path):
    """A third of all rows are copies, a third near copies."""
    base = " ".join(f"w{i}" for i in range(200))
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, F.lit(base)).when(
        F.col("id") < 600, F.concat(F.lit(base + " x"), F.col("id").cast("string"))).otherwise(
        F.concat_ws(" ", *[F.md5((F.col("id") * 1000 + k).cast("string")) for k in range(20)])).alias("text"))
    docs = stored(df, "hot")
    assert exact_dedup.drop_exact_duplicates(docs).count() == 601
    near = simhash.near_duplicates(docs)
    assert near.where("component_id < 600").select("component_id").distinct().count() == 1
    assert near.where("component_id >= 600").count() == 300


def test_run_leaves_its_stages_only(spark):
    root = work_dir(spark, "llm").removeprefix("file://")

    def held():
        return {f"{n}/{t}" for n in (os.listdir(root) if os.path.isdir(root) else ()) for t in os.listdir(f"{root}/{n}")}
    before = held()
    assert corpus_pipeline.run(spark, SF).count() > 0
    left = sorted(x.split("/")[0] for x in held() - before)
    assert left == sorted(f"stage_{n}" for n, _ in corpus_pipeline.STAGES)


def test_run_over_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, name, SF).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_decisions_hold_however_the_files_are_split(spark, tmp_path):
    """Between the scan that decides and the scan that keeps, splits change."""
    path = str(tmp_path / "docs.parquet")
    table(spark, "documents", "/root/testdata/sf0.01").repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {max(i for i in texts if texts[i] == t) for t in set(texts.values())}
    confs = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism")
    before = {c: spark.conf.get(c, None) for c in confs}
    kept = stored(exact_dedup.exact_duplicates(docs).where("kept"), "kept")
    try:
        for size in ("20k", "150k", "100m"):
            spark.conf.set(confs[0], size)
            spark.conf.set(confs[1], "1k")
            assert size != "20k" or spark.read.parquet(path).rdd.getNumPartitions() != 7
            rows = [r.doc_id for r in keep_rows(docs, kept).collect()]
            assert len(rows) == len(want) and set(rows) == want
            # the way without a broadcast gives the same
            assert {r.doc_id for r in keep_rows(docs, kept, max_bytes=0).collect()} == want
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_rows_are_identified_only_where_that_is_sure(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).write.parquet(path)
    scan = spark.read.parquet(path)
    twice = scan.select("doc_id", "text", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    for df, rows in ((scan, 10), (scan.where("doc_id > 3"), 6), (twice, 20), (scan.union(scan), 20),
                     (scan.limit(4), 4), (scan.groupBy("doc_id", "text").count(), 10)):
        ids = with_row_id(df, "doc_id", "text").select(ROW_ID)
        assert ids.count() == ids.distinct().count() == rows
