"""Content-addressed WARC archive.

``write_archive`` stores each distinct payload once, under its SHA-256 digest
(verified: the rows of one digest agree in length and in a second, independent
hash, else the write fails), and the exact header bytes of every record apart
from it.  ``read_records`` joins headers and payloads into the original records,
byte for byte; ``parse_records`` reads records back and checks each payload
against both digests.  ``export_warc`` and ``read_warc`` go through ``.warc``
files of the standard layout.

Payloads and response headers are bucketed alike by digest and the id of the
digest's response, so the join that rebuilds the records shuffles nothing.  Only
responses carry a payload, one for each digest; revisits need no join.  A Bloom
filter of the responses' ids stops the copies in the scan, so a payload that a
third of all pages share is shuffled, stored and joined once (but for the few
copies that the filter lets through, which the join drops).
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_filter, release, slices_for, stored

BUCKET_BYTES = 16 << 20
# Fixed value: the standard's profile of revisits of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
_RECORD_ID = "urn:x-page:"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal digest of whole 20-bit groups: five
    hexadecimal digits are four of base 32."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _http_header() -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))


def _warc_header(revisit: bool) -> Column:
    block = F.octet_length("http").cast("long") + (F.lit(0) if revisit else F.col("n"))
    uri = F.when(F.col("url").isNotNull(), F.concat(
        F.lit("WARC-Target-URI: "), F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
        F.lit("\r\n"))).otherwise(F.lit(""))
    refers = [F.lit(f"WARC-Refers-To: <{_RECORD_ID}"), F.col("original").cast("string"),
              F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n")] if revisit else []
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {'revisit' if revisit else 'response'}\r\nWARC-Record-ID: <{_RECORD_ID}"),
        F.col("page_id").cast("string"), F.lit(">\r\n"), uri, F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"),
        F.col("sha1"), F.lit("\r\n"), *refers, F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        block.cast("string"), F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> None:
    """Archive of ``pages`` under ``path``: tables payloads, responses, revisits
    and meta.  Of the records with an equal payload of at least ``min_bytes``
    the one with the largest id is the response, the others revisit it; smaller
    payloads are all responses.  Null payload: empty.  Rows without an id are
    left out; rows repeated with one id and payload are records of one kind."""
    spark = pages.sparkSession
    raw = F.coalesce(pages[payload_col].cast("string"), F.lit("")).cast("binary")
    full = (pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                         raw.alias("payload")).where("page_id is not null")
            .withColumn("sha256", F.sha2("payload", 256)))
    slim = stored(full.select("page_id", "url", "sha256", base32(F.sha1("payload")).alias("sha1"),
                              F.octet_length("payload").cast("long").alias("n"),
                              F.xxhash64("payload").alias("other")), "warc-pages")
    originals = stored(slim.groupBy("sha256").agg(
        F.max("page_id").alias("original"), F.max("n").alias("n"),
        ((F.min("n") != F.max("n")) | (F.min("other") != F.max("other")) | (F.min("sha1") != F.max("sha1"))).alias("clash")),
        "warc-originals")
    total, clashes, n = originals.agg(F.sum("n"), F.count_if("clash"), F.count(F.lit(1))).first()
    if clashes:
        raise ValueError(f"{clashes} digests stand for different payloads")
    buckets = slices_for(total or 0, BUCKET_BYTES, 4)
    keep = originals.select("sha256", F.col("original").alias("page_id"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(buckets, "sha256", "page_id")

    def bucketed(df: DataFrame, name: str) -> None:
        table = f"warc_{uuid.uuid4().hex}"
        (df.write.bucketBy(buckets, "sha256", "page_id").sortBy("sha256", "page_id")
         .option("path", f"{path}/{name}").format("parquet").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")  # the files stay

    # one shuffle of the payloads, once each: by the buckets they are written to
    likely = id_filter(keep, "page_id", n).rows(full, "page_id")
    bucketed(dealt(likely).join(dealt(keep).hint("merge"), ["sha256", "page_id"]).dropDuplicates(["sha256", "page_id"])
             .select("sha256", "page_id", "payload"), "payloads")
    typed = slim.join(originals.select("sha256", "original"), "sha256").withColumn("http", _http_header())
    response = (F.col("page_id") == F.col("original")) | (F.col("n") < min_bytes)
    # a small payload that is no revisit still shares the stored bytes of its digest
    bucketed(dealt(typed.where(response).select("sha256", F.col("original").alias("page_id"),
                                                _warc_header(False).cast("binary").alias("header"),
                                                F.col("http").cast("binary").alias("http"))), "responses")
    typed.where(~response).select(_warc_header(True).cast("binary").alias("header"),
                                  F.col("http").cast("binary").alias("http")).write.parquet(f"{path}/revisits")
    release(slim, originals)
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/meta")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record binary, sha256): the records, rebuilt; sha256 is null for revisits."""
    buckets = spark.read.parquet(f"{path}/meta").first()["buckets"]

    def table(name: str, columns: str) -> DataFrame:
        t = f"warc_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {t} (sha256 STRING, page_id BIGINT, {columns}) USING parquet "
                  f"CLUSTERED BY (sha256, page_id) SORTED BY (sha256, page_id) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}/{name}'")
        df = spark.table(t)
        df.schema  # noqa: B018  resolved while the table is there
        spark.sql(f"DROP TABLE {t}")
        return df

    responses = table("responses", "header BINARY, http BINARY")
    payloads = table("payloads", "payload BINARY")
    whole = responses.join(payloads.hint("merge"), ["sha256", "page_id"]).select(
        F.concat("header", "http", "payload", F.lit(b"\r\n\r\n")).alias("record"), "sha256")
    revisits = spark.read.parquet(f"{path}/revisits").select(
        F.concat("header", "http", F.lit(b"\r\n\r\n")).alias("record"), F.lit(None).cast("string").alias("sha256"))
    return whole.union(revisits)


def split_record(data: bytes, at: int = 0):
    """(fields, block, end) of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no record at byte {at}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    end = stop + 4 + int(fields["Content-Length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("record of a wrong length")
    return fields, data[stop + 4:end], end + 4


def _row(fields: dict, block: bytes, sha256: str | None):
    head, _, payload = block.partition(b"\r\n\r\n")
    n = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("payload and digest disagree")
        if sha256 is not None and hashlib.sha256(payload).hexdigest() != sha256:
            raise ValueError("payload and store key disagree")
    refers = fields.get("WARC-Refers-To")
    number = lambda x: int(x.strip("<>").removeprefix(_RECORD_ID))
    return number(fields["WARC-Record-ID"]), n, digest, kind, number(refers) if refers else None


_PARSED = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64())])
PARSED = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARSED)], schema=_PARSED)


def parse_records(records: DataFrame) -> DataFrame:
    """What each record says: page_id, payload_bytes and payload_digest of the
    full payload, record_type, refers_to.  A payload that disagrees with its
    digest raises."""
    def run(batches):
        for batch in batches:
            rows = []
            for record, key in zip(batch.column(0), batch.column(1)):
                fields, block, _ = split_record(record.as_py())
                rows.append(_row(fields, block, key.as_py()))
            if rows:
                yield _batch(rows)

    return records.select("record", "sha256").mapInArrow(run, PARSED)


def export_warc(spark: SparkSession, path: str, out: str, per_file: int = 20_000, compression: str | None = "gzip") -> None:
    """Standard ``.warc`` files of an archive: records one after another."""
    text = F.col("record").cast("string")
    (read_records(spark, path).select(F.substring(text, F.lit(1), F.length(text) - 4).alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file)
     .option("compression", compression or "none").text(out))


def read_warc(spark: SparkSession, out: str) -> DataFrame:
    """Parse exported files record by record, by their lengths."""
    def run(batches):
        import gzip
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                at, rows = 0, []
                while at < len(data):
                    fields, block, at = split_record(data, at)
                    rows.append(_row(fields, block, None))
                if rows:
                    yield _batch(rows)

    return spark.read.format("binaryFile").load(out).select("content").mapInArrow(run, PARSED)
