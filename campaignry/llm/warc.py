"""Content-addressed web archive: payload bytes once per strong digest, exact record headers apart, records by join.

``write_archive`` leaves two tables in the shared folder, both bucketed by the digest of the payload, so that putting
a record together again joins bucket with bucket and moves nothing. ``read_archive`` rebuilds every record byte for
byte, ``parse_records`` reads records as any reader of the format would and checks them against their digests.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from base64 import b32encode
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignry.session import cut_lineage, scratch_path

# The alphabets of base 32 as conv() writes it and as the standard defines it.
_CONV, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PARSED = "row long, page_id long, record_type string, refers_row long, payload_bytes long, payload_digest string"


@dataclass(frozen=True)
class Archive:
    headers: str  # table names
    payloads: str


def base32_sha1(data: Column) -> Column:
    """Upper-case base 32 of SHA-1: four groups of 40 bits, eight digits each."""
    digest = F.sha1(data)
    parts = [F.lpad(F.upper(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32)), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _CONV, _BASE32)


def fingerprints(pages: DataFrame) -> DataFrame:
    """row (unique), page_id, url, digest (SHA-256), sha1 in base 32 and length of each page's payload."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", F.unhex(F.sha2("payload", 256)).alias("digest"),
        base32_sha1(F.col("payload")).alias("sha1"), F.length("payload").cast("long").alias("size"),
    )


def _urn(row: Column, page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def record_headers(rows: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """row, digest, kind and the exact header bytes of each record.

    Of payloads of at least ``min_revisit_bytes``, the record with the largest page_id (then row) is the response.
    """
    heads = cut_lineage(rows.groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("head")))
    r = rows.join(heads, "digest")
    revisit = (F.col("size") >= min_revisit_bytes) & (F.col("row") != F.col("head.row"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    block = F.length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("row"), F.col("page_id")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            _urn(F.col("head.row"), F.col("head.page_id")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"),
        F.lit("\r\n\r\n"), http,
    )
    return r.select("row", "digest", revisit.alias("revisit"), F.encode(head, "UTF-8").alias("header"))


def write_archive(pages: DataFrame, min_revisit_bytes: int = 0) -> Archive:
    """Pages as an archive of records. A null html is the empty payload; repeated rows are records of their own."""
    spark = pages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"warc_{uuid.uuid4().hex[:12]}"
    archive = Archive(f"{name}_headers", f"{name}_payloads")

    def save(df: DataFrame, table: str) -> None:
        df.write.bucketBy(buckets, "digest").option("path", scratch_path(spark, table)).option("compression", "zstd").saveAsTable(table)

    headers = record_headers(cut_lineage(fingerprints(pages)), min_revisit_bytes)
    # A record that revisits moves by its own row, so that one digest with many records is spread over the buckets.
    place = F.when(F.col("revisit"), F.unhex(F.sha2(F.col("row").cast("string"), 256))).otherwise(F.col("digest"))
    save(headers.select("row", place.alias("digest"), "revisit", "header"), archive.headers)
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    stored = pages.select(payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    save(stored.dropDuplicates(["digest"]), archive.payloads)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """row and record: the original bytes, from the exact header and, for responses, the stored payload."""
    headers = spark.table(archive.headers)
    payloads = spark.table(archive.payloads)
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    responses = headers.filter("NOT revisit").join(payloads, "digest")
    full = responses.select("row", F.concat("header", "payload", end).alias("record"))
    return full.unionAll(headers.filter("revisit").select("row", F.concat("header", end).alias("record")))


def parse_record(record: bytes) -> tuple:
    """(page_id, type, row referred to, payload bytes, digest) of one record; the digest is that of the bytes found."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError("a record of another length than it says")
    _, _, payload = block.partition(b"\r\n\r\n")
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    page, row = re.fullmatch(r"<urn:page:(-?\d*):(\d+)>", fields["warc-record-id"]).groups()
    page = int(page) if page else None
    if fields["warc-type"] == "revisit":
        target = re.fullmatch(r"<urn:page:(-?\d*):(\d+)>", fields["warc-refers-to"])
        return int(row), page, "revisit", int(target[2]), None, named
    found = b32encode(hashlib.sha1(payload).digest()).decode()
    if found != named:
        raise ValueError(f"payload digest {found}, header says {named}")
    return int(row), page, fields["warc-type"], None, len(payload), found


def parse_records(records: DataFrame) -> DataFrame:
    names = [x.split()[0] for x in PARSED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in PARSED.split(", ")])

    def parse(batches):
        for batch in batches:
            rows = [parse_record(x.as_buffer().to_pybytes()) for x in batch.column("record")]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return records.select("record").mapInArrow(parse, PARSED)


def archived_pages(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes the pages to an archive, reads it back and returns one row per record.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to. Nulls: a null id is smaller than any
    other; a null html has the empty payload. An empty table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    archive = write_archive(pages, min_revisit_bytes)
    parsed = cut_lineage(parse_records(read_archive(spark, archive)))
    full = parsed.filter("record_type = 'response'").select(
        F.col("row").alias("refers_row"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("bytes"))
    out = parsed.join(full, "refers_row", "left")
    return out.select("page_id", F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS pos,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS head FROM pages)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(sha1(body), (i // 8 * 10 + 1)::INT, 10))::BIGINT) >> ((7 - i % 8) * 5)::INT) & 31)::INT + 1, 1)
                        for i in range(32)], '') AS payload_digest,
       CASE WHEN pos = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN pos > 1 THEN head END AS refers_to
FROM p
"""
