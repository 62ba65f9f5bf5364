import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from logloom.llm import warc
from tests.llm.conftest import dicts

PAGES = [(1, "http://a/1", "<p>x</p>", "k"), (2, "http://a/2", "<p>x</p>", "k"), (3, None, None, "k"),
         (4, "http://a/4\r\nWARC-Type: evil", "", "k"), (None, "http://a/5", "<p>x</p>", "k"),
         (6, "http://a/6", "ünï 😀" * 1000, "k"), (7, "u", "<p>x</p>", "k"), (7, "u", "<p>x</p>", "k")]


def archive(spark, rows, **kw):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, sha256 string").coalesce(1)
    h, p = warc.write_archive(df, **kw)
    return h, p, warc.read_archive(spark, h, p)


def test_round_trip(spark):
    h, p, records = archive(spark, PAGES)
    assert spark.read.parquet(p).count() == 3  # every payload once
    parsed = dicts(warc.parsed_records(records))
    assert len(parsed) == len(PAGES)
    for r in parsed:
        want = {i: (t or "").encode() for i, _, t, _ in PAGES}[r["id"]]
        assert r["payload_bytes"] == len(want)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(want).digest()).decode()
    kind = sorted((r["id"] or 0, r["record_type"], r["refers_to"] or 0) for r in parsed)
    assert kind == [(0, "revisit", 7), (1, "revisit", 7), (2, "revisit", 7), (3, "revisit", 4),
                    (4, "response", 0), (6, "response", 0), (7, "response", 0), (7, "revisit", 7)]


def test_records_are_exact(spark):
    for r in dicts(archive(spark, PAGES)[2]):
        raw = bytes(r["record"])
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        assert len(fields) == len(lines) - 1  # no line came in through a url
        n = int(fields[b"Content-Length"])
        assert rest[n:] == b"\r\n\r\n"
        if fields[b"WARC-Type"] == b"response":
            assert rest[:n] == {i: (t or "").encode() for i, _, t, _ in PAGES}[r["id"]]
        else:
            assert n == 0 and fields[b"WARC-Refers-To"].startswith(b"<urn:uuid:")


def test_small_payloads_are_responses(spark):
    parsed = dicts(warc.parsed_records(archive(spark, PAGES, min_bytes=5)[2]))
    assert {r["record_type"] for r in parsed if r["payload_bytes"] < 5} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in parsed) == 4


def test_empty_table(spark):
    assert warc.parsed_records(archive(spark, [])[2]).count() == 0


def test_fields_come_from_the_record_bytes(spark):
    h, p, records = archive(spark, PAGES)
    plan = warc.parsed_records(records)
    rebuilt = {r["id"]: bytes(r["record"]) for r in records.collect()}
    assert len({r["header"] for r in map(lambda r: {"header": bytes(r["header"])}, records.collect())}) == len(PAGES)
    assert b"WARC-Refers-To" in rebuilt[1] and plan.count() == len(PAGES)
    # a revisit that names another record is found out
    other = records.where("id = 6").first()
    name = bytes(other["header"]).split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0]
    changed = [(r["id"], bytes(r["header"]), re.sub(rb"(WARC-Refers-To: )[^\r]+", rb"\g<1>" + name, bytes(r["record"])))
               for r in records.collect()]
    bad = spark.createDataFrame(changed, records.schema)
    with pytest.raises(Exception, match="does not match the record"):
        warc.parsed_records(bad).collect()
    # and so is a block that does not have its digest
    changed = [(r["id"], bytes(r["header"]), bytes(r["record"]).replace(b"<p>x", b"<p>y")) for r in records.collect()]
    with pytest.raises(Exception, match="does not match its header"):
        warc.parsed_records(spark.createDataFrame(changed, records.schema)).collect()


def test_a_changed_payload_is_an_error(spark, tmp_path):
    h, p, _ = archive(spark, PAGES)
    bad = str(tmp_path / "bad")
    spark.read.parquet(p).withColumn("payload", F.lit("z").cast("binary")).write.parquet(bad)
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, h, bad).collect()
