import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tabwright.llm import warc
from tabwright.llm.common import shared_folder

PAGES = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        f = first.get(data)
        again = f is not None and f != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def digest(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str)


def test_framing_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 4095, 4096, 4097, 100_000):
        data = rng.randbytes(n)
        assert warc.dechunked(warc.chunked(data)) == data
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"4\r\nabc\r\n0\r\n\r\n")


def test_pages_with_corner_cases(spark):
    long = "é<p>" * 50_000
    marker = "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n" * 10
    rows = [(1, "http://a/", long), (2, "http://b/", long), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "u", "x" * 99), (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "u", "y" * 100), (9, "u", marker), (9, "u", marker), (None, "u", "z" * 200), (10, "u", "z" * 200), (11, "u", long + "!"), (11, "u", long + "!")]
    df = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")).withColumn("record_id", F.lit(3))
    got = warc.archive_digest(df.repartition(3), shared_folder(spark, "t"))
    assert got.filter("fault is not null").count() == 0
    assert digest(got) == expected(rows)


def test_empty_table(spark):
    assert warc.archive_digest(spark.createDataFrame([], PAGES), shared_folder(spark, "t")).collect() == []


def test_payloads_come_back(spark):
    rows = [(i, f"http://h/{i}", chr(65 + i) * (i * 20_000)) for i in range(6)]
    path = shared_folder(spark, "t")
    warc.write_archives(spark.createDataFrame(rows, PAGES), path, segment_bytes=7000, per_file=3)
    got = {int(r.page_id): bytes(r.payload).decode() for r in warc.read_archives(spark, path).collect()}
    assert got == {i: h for i, _, h in rows}


def test_broken_segments_are_named(spark):
    head = ("r", "response", "r", 1, None, "1", None, "sha256:x", bytearray(b"ab"))
    tail = ("r:3", "continuation", "r", 3, 4, None, None, None, bytearray(b"cd"))
    short = [("s", "response", "s", 1, None, "2", None, "sha256:x", bytearray(b"ab")), ("s:2", "continuation", "s", 2, 9, None, None, None, bytearray(b"cd"))]
    good = [("g", "response", "g", 1, None, "3", None, "sha256:x", bytearray(b"ab")), ("g:2", "continuation", "g", 2, 4, None, None, None, bytearray(b"cd"))]
    got = {r.record_id: r for r in warc.reassembled(spark.createDataFrame([head, tail, *short, *good], warc.RECORD)).collect()}
    assert got["r"].fault == "missing segment" and got["r"].block is None
    assert got["s"].fault == "length differs"
    assert got["g"].fault is None and bytes(got["g"].block) == b"abcd"


def test_gzip_archives_are_read():
    import gzip

    data = warc._record({"WARC-Type": "response"}, b"x")
    assert list(warc.records_in(gzip.compress(data) + gzip.compress(data))) == list(warc.records_in(data + data))
