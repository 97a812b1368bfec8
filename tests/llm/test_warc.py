import base64
import hashlib
import random

import pytest

from helpers_llm import SF001
from interlens.llm import warc
from interlens.session import scratch_path

PAGES = "page_id long, url string, html string, sha256 string, n long"


def brute(rows, min_bytes=0):
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = len(raw) < min_bytes or best[h or ""] == i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if first else "revisit", None if first else best[h or ""]))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def pages():
    rnd = random.Random(6)
    texts = [None, "", "é", "a\r\n\r\nWARC/1.1\r\n", "x" * 100000, "\x00", "<html>" + "y" * 50]
    rows = [(i, rnd.choice([None, "http://a/b", "http://a/\r\nX: y"]), rnd.choice(texts)) for i in range(80)]
    return rows


@pytest.mark.parametrize("min_bytes", [0, 60])
def test_round_trip(spark, min_bytes):
    rows = pages()
    path = scratch_path(spark, "warc-test")
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES).repartition(3)
    warc.write_archive(df, path, min_bytes)
    if min_bytes == 0:
        n = spark.read.parquet(f"{path}/payloads").count()
        assert n == len({h or "" for _, _, h in rows})
    records = warc.read_records(spark, path)
    assert got(warc.parse_records(records)) == brute(rows, min_bytes)
    for r in records.collect():
        fields, block, end = warc.split_record(bytes(r.record))
        assert end == len(r.record) and int(fields["Content-Length"]) == len(block)
    for codec in ("gzip", None):
        out = scratch_path(spark, "warc-files")
        warc.export_warc(spark, path, out, per_file=7, compression=codec)
        assert got(warc.read_warc(spark, out)) == brute(rows, min_bytes)


def test_rebuilding_shuffles_nothing(spark, capsys):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.read.parquet(f"{SF001}/pages.parquet"), path)
    warc.read_records(spark, path).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_tampered_payload_raises(spark):
    from pyspark.sql import functions as F
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), path)
    bad = warc.read_records(spark, path).withColumn(
        "record", F.replace(F.col("record").cast("string"), F.lit("abc"), F.lit("abd")).cast("binary"))
    with pytest.raises(Exception, match="disagree"):
        warc.parse_records(bad).collect()


def test_empty_and_null_ids(spark):
    for rows, want in (([], []), ([(None, "u", "a"), (2, None, "a"), (2, None, "a"), (1, "u", "a")], [1, 2, 2])):
        path = scratch_path(spark, "warc-test")
        warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
        assert sorted(r.page_id for r in warc.parse_records(warc.read_records(spark, path)).collect()) == want
