import base64
import hashlib

import pytest

from starloom.llm import warc
from starloom.session import scratch_path

RECORD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def cases():
    rows = [(i, f"http://h{i}/", f"<p>page {i} {'x' * (37 * i % 500)}</p>") for i in range(60)]
    rows += [(100, "http://a/\r\nX-Evil: 1", "same"), (101, None, "same"), (102, "u", "same"), (103, "u", None), (104, "u", ""),
             (105, "u", f"before {RECORD} after"), (106, "u", RECORD), (107, "u", "WARC/1.1\r\n"), (108, "u", "WARC/1.1\r\n" * 40),
             (109, "u", "tail WARC/1.1\r"), (110, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 9999999\r\n\r\n"), (None, "u", "nobody"),
             (None, "u", "same"), (111, "u", "é ß 漢 \x00 \r\n\r\n x"), (112, "u", "dup"), (112, "u", "dup"), (113, "u", "dup"),
             (114, "u", RECORD * 30), (115, "u", RECORD * 30), (116, "u", "y" * 200_000)]
    return rows


def brute(rows, least=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        again = len(raw) >= least and last is not None and page != last
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split", ["2000", "20000", "128m"])
def test_round_trip_at_any_split_size(spark, split):
    rows = cases()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    path = scratch_path(spark, "warc_test")
    from pyspark.sql import functions as F
    warc.write(warc.classify(pages.withColumn("last", F.lit(1)).withColumn("sha1", F.lit("x"))), path)
    try:
        spark.conf.set(key, split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert found(warc.read(spark, path)) == brute(rows)
    finally:
        spark.conf.set(key, old)
        spark.conf.set("spark.sql.files.openCostInBytes", opened)


def test_least_bytes(spark):
    rows = cases()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.classify(pages, least=10)
    assert found(got) == brute(rows, 10)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0
