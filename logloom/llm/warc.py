"""Content-addressed WARC archive.

A WARC record per page is kept in two tables: ``payloads`` holds the bytes of
every distinct payload once, under its SHA-256 digest; ``headers`` holds the
exact header bytes of every record with the digest of its payload.  The
original record is header + block, rebuilt by a join; all that is said of a
record is parsed from these bytes again.

The strong digest is verified, not trusted: the archive job fails when two
payloads of one digest differ in a second digest or in length, and reading
back recomputes the digest of every stored payload.

Scale: payloads are found equal by their digests, a row per task and digest in
the shuffle however many pages share one.  The one copy that is stored is
picked by a bitmap of rows where the pages are read, so writing shuffles no
payload; reading back shuffles each stored payload once, to its one response.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.common import ROW_ID, identified, keep_rows, row_id, stored
from logloom.session import work_dir

MIN_BYTES = 0
# Fixed values of the record format (WARC 1.1, RFC 4648 base32).
VERSION = "WARC/1.1"
CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def base32_of_hex(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hex SHA-1: five-bit groups of each 20
    bits (five hex digits make four base32 letters)."""
    letters = []
    for k in range(8):
        v = F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32),
                                F.shiftright(v, s).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1))
                    for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def record_id(key: Column) -> Column:
    """The WARC-Record-ID of a record's key."""
    h = F.md5(F.concat(F.lit(str(NAMESPACE)), key.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"),
                    F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"),
                    F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def record_headers(kind: Column, uri: Column, date: Column, key: Column, digest: Column,
                   length: Column, refers_key: Column) -> Column:
    """The header block of a record as text, ending in the empty line."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    revisit = kind == "revisit"
    return F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", record_id(key)),
        line("WARC-Date", date),
        # a control character would end the header early: percent-encode it
        F.coalesce(line("WARC-Target-URI",
                        F.regexp_replace(F.regexp_replace(uri, "\r", "%0D"), "\n", "%0A")),
                   F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To", record_id(refers_key))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        # a revisit carries no block of its own
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
        F.lit(CRLF))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = MIN_BYTES,
                  date: str = "2024-01-01T00:00:00Z") -> tuple[str, str]:
    """Write the ``headers`` and ``payloads`` tables; returns their paths.

    Of records with equal payloads of at least ``min_bytes`` bytes the one
    with the largest id is ``response`` and the others ``revisit`` it (of
    repeated ids, the last of the scan); smaller payloads are all responses.
    A null payload is empty, a null url has no target line, a null id is
    smaller than any other.  ``date`` is the capture time when the table has
    none.
    """
    spark = pages.sparkSession
    pages = identified(pages)

    def payload(rows: DataFrame, *more: Column) -> DataFrame:
        body = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
        return rows.select(*more, body.alias("payload"))
    digest = stored(payload(pages, row_id(pages), F.col(id_col).alias("id"),
                            F.col(url_col).cast("string").alias("url")).select(
        ROW_ID, "id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("bytes")), "warc_digests")
    one = (F.min("sha1") == F.max("sha1")) & (F.min("bytes") == F.max("bytes"))
    first = stored(digest.groupBy("sha256").agg(
        F.max(F.struct("id", ROW_ID)).alias("top"), F.when(one, F.max("bytes")).otherwise(
            F.raise_error(F.lit("two payloads share a digest")).cast("bigint")).alias("bytes"))
        .select("sha256", F.col(f"top.{ROW_ID}").alias("top_row"), F.col("top.id").alias("top_id"),
                (F.col("bytes") >= min_bytes).alias("shared")), "warc_first")

    payload_path = work_dir(spark, "llm", "warc_payloads", unique=True)
    payload(keep_rows(pages, first.select(F.col("top_row").alias(ROW_ID)))).select(
        F.sha2("payload", 256).alias("sha256"), "payload").write.parquet(payload_path)

    def key(number: str, row: str) -> Column:
        return F.concat_ws("/", F.col(number).cast("string"), F.col(f"{row}.file").cast("string"),
                           F.col(f"{row}.row").cast("string"))
    linked = digest.join(first, "sha256")
    kind = F.when(F.col("shared") & (F.col("top_row") != F.col(ROW_ID)), F.lit("revisit")).otherwise(F.lit("response"))
    headers = linked.select(
        "id", "sha256", record_headers(
            kind, F.col("url"), F.lit(date), key("id", ROW_ID), base32_of_hex(F.col("sha1")),
            F.col("bytes"), key("top_id", "top_row")).cast("binary").alias("header"))
    header_path = work_dir(spark, "llm", "warc_headers", unique=True)
    headers.write.parquet(header_path)
    return header_path, payload_path


def _field(head: Column, name: str, value: str) -> Column:
    found = F.regexp_extract(head, f"\n{name}: ({value})\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, header_path: str, payload_path: str) -> DataFrame:
    """The original records: ``id, header, record``.

    ``record`` is the exact bytes of the WARC record: the header, for a
    response the payload as its block, and two line ends.  The digest of every
    payload is recomputed; a wrong one is an error.
    """
    payloads = spark.read.parquet(payload_path)
    checked = payloads.select(
        "sha256", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload"))
        .otherwise(F.raise_error(F.lit("stored payload does not match its digest")))
        .alias("payload"))
    headers = spark.read.parquet(header_path)
    revisit = _field(F.col("header").cast("string"), "WARC-Type", "[a-z]+") == "revisit"
    tail = F.lit(CRLF * 2).cast("binary")
    responses = headers.where(~revisit).join(checked, "sha256").select(
        "id", "header", F.concat("header", "payload", tail).alias("record"))
    return responses.unionByName(headers.where(revisit).select(
        "id", "header", F.concat("header", tail).alias("record")))


def parsed_records(records: DataFrame) -> DataFrame:
    """What the bytes of the records say: ``id, payload_bytes, payload_digest,
    record_type, refers_to``.

    A response's block is cut out by its Content-Length and must match its
    digest.  A revisit is joined to the response that its WARC-Refers-To names,
    whose payload is its own too and must have the digest that it states.
    """
    head = F.substring_index(F.col("record").cast("string"), CRLF * 2, 1)
    rows = records.select("id", "record", F.concat(head, F.lit(CRLF)).alias("head"))
    rows = rows.select(
        "id", "record", (F.octet_length("head") + 2).alias("at"),
        _field(F.col("head"), "WARC-Type", "[a-z]+").alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID", "[^\r]+").alias("record_id"),
        _field(F.col("head"), "Content-Length", "[0-9]+").cast("bigint").alias("length"),
        _field(F.col("head"), "WARC-Payload-Digest", "sha1:[A-Z2-7]{32}").alias("digest"),
        _field(F.col("head"), "WARC-Refers-To", "[^\r]+").alias("refers"))
    block = F.substring("record", F.col("at") + 1, F.col("length").cast("int"))
    whole = F.octet_length("record") == F.col("at") + F.col("length") + 4
    stated = F.concat(F.lit("sha1:"), base32_of_hex(F.sha1(block))) == F.col("digest")
    parsed = rows.select("id", "record_type", "record_id", "length", "refers", F.when(
        whole & ((F.col("record_type") == "revisit") | stated), F.substring("digest", 6, 32)).otherwise(
        F.raise_error(F.lit("record does not match its header"))).alias("digest"))
    parsed = stored(parsed, "warc_parsed")
    responses = parsed.where(F.col("record_type") == "response")
    known = responses.select(F.col("record_id").alias("refers"), F.col("id").alias("refers_to"),
                             F.col("length").alias("bytes"), F.col("digest").alias("original"))
    revisits = parsed.where(F.col("record_type") == "revisit").join(known, "refers", "left")
    return responses.select(
        "id", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast(parsed.schema["id"].dataType).alias("refers_to")).unionByName(revisits.select(
            "id", F.col("bytes").alias("payload_bytes"), F.when(
                F.col("digest") == F.col("original"), F.col("digest")).otherwise(
                F.raise_error(F.lit("revisit does not match the record it refers to"))).alias("payload_digest"),
            "record_type", "refers_to"))
