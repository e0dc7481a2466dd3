"""WARC archives: writing with segmentation and chunked framing, reading with segment reassembly."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD = "record_id string, record_type string, origin_id string, segment long, total long, page_id string, refers_to string, digest string, block binary"


def chunked(payload: bytes, size: int = 4096) -> bytes:
    """Chunked transfer framing of ``payload``."""
    return b"".join(b"%x\r\n%s\r\n" % (len(c := payload[i : i + size]), c) for i in range(0, len(payload), size)) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped, a broken frame is an error."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        at = end + 2 + n
        if body[at : at + 2] != b"\r\n":
            raise ValueError("chunk length and chunk differ")
        out.append(body[end + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(fields: dict[str, object], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + f"Content-Length: {len(block)}\r\n\r\n"
    return b"WARC/1.1\r\n" + head.encode() + block + b"\r\n\r\n"


def _header_text(text: str | None) -> str | None:
    return None if text is None else "".join(c for c in text if c >= " ")


def records_of(row, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response cut into a first segment and continuations."""
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<{row.record_id}>", "WARC-Target-URI": _header_text(row.url), "WARC-Page-ID": row.page_id, "WARC-Payload-Digest": f"sha256:{row.digest}"}
    if row.refers_to is not None:
        yield _record(fields | {"WARC-Type": "revisit", "WARC-Refers-To": f"<{row.refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}, b"")
        return
    block = HTTP_HEAD + chunked(bytes(row.payload))
    cuts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(cuts) > 1:
        fields["WARC-Segment-Number"] = 1
    yield _record(fields, cuts[0])
    for n, cut in enumerate(cuts[1:], 2):
        last = len(block) if n == len(cuts) else None
        yield _record({"WARC-Type": "continuation", "WARC-Record-ID": f"<{row.record_id}:{n}>", "WARC-Segment-Origin-ID": f"<{row.record_id}>", "WARC-Segment-Number": n, "WARC-Segment-Total-Length": last}, cut)


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive, plain or gzip."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        start, n = end + 4, int(fields["Content-Length"])
        if data[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError("a record's length and its block differ")
        yield fields, data[start : start + n]
        at = start + n + 4


def _id(text: Column) -> Column:
    return F.concat(F.lit("urn:sha256:"), F.sha2(text, 256))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100, segment_bytes: int = 1 << 15, per_file: int = 4096) -> None:
    """Write one logical record per row of ``pages`` as gzip WARC files below ``path``.

    Among rows with equal payloads of ``least`` bytes or more, that with the smallest id is a response and the others revisit it
    (copies that share the smallest id too are responses); all shorter ones are responses. Payload: the html in UTF-8, empty
    for null. Blocks over ``segment_bytes`` are cut into continuation records. A record's id is a digest of the row's id, url
    and payload, so a repeated task writes the same bytes and a repeated row repeats its records. A row without id revisits like any other.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col("__html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("__page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("__html"))
    rows = rows.withColumn("digest", F.sha2(payload, 256)).withColumn("size", F.octet_length(payload))
    rows = rows.withColumn("record_id", _id(F.concat_ws("|", F.coalesce(F.col("__page").cast("string"), F.lit("null")), "digest", F.coalesce("url", F.lit("null")))))
    firsts = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min(F.struct(F.col("__page").isNull(), "__page", "record_id")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    rows = rows.join(saved(firsts, "first-payloads"), "digest", "left")  # few repeats are broadcast, and the pages then not shuffled
    later = F.when(~F.col("__page").eqNullSafe(F.col("first.__page")), F.col("first.record_id"))
    rows = rows.select("record_id", "url", F.col("__page").cast("string").alias("page_id"), "digest", later.alias("refers_to"), F.when(later.isNull(), payload).alias("payload"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"record": [r for row in b.itertuples() for r in records_of(row, segment_bytes)]})

    # The text writer ends each value with the record's last line feed.
    lines = rows.mapInPandas(build, "record binary").select(F.expr("substring(record, 1, octet_length(record) - 1)").cast("string").alias("value"))
    lines.write.option("lineSep", "\n").option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path)


def _records(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b.content:
                rows = []
                for f, block in records_in(bytes(data)):
                    if ("WARC-Segment-Number" in f) == segmented:
                        bare = {k: f[k].strip("<>") for k in ("WARC-Record-ID", "WARC-Segment-Origin-ID", "WARC-Refers-To") if k in f}
                        n, total = f.get("WARC-Segment-Number"), f.get("WARC-Segment-Total-Length")
                        rows.append((bare["WARC-Record-ID"], f["WARC-Type"], bare.get("WARC-Segment-Origin-ID", bare["WARC-Record-ID"]), n and int(n), total and int(total), f.get("WARC-Page-ID"), bare.get("WARC-Refers-To"), f.get("WARC-Payload-Digest"), block))
                    if len(rows) >= 256:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["record_id", "record_type", "origin_id", "segment", "total", "page_id", "refers_to", "digest", "block"])
    return out.assign(segment=out.segment.astype("Int64"), total=out.total.astype("Int64"))


def reassembled(parts: DataFrame) -> DataFrame:
    """Logical records (``RECORD`` columns, ``copies``, ``fault``) from segment records.

    Continuations are grouped by origin id and ordered by segment number; ``fault`` names a record whose numbers are not 1 to n or whose length
    is not the total in its last segment (its block is null). Segments of a record written more than once are merged and counted in ``copies``.
    A group is one record's segments: as large as the page that it yields.
    """
    whole = ["record_type", "page_id", "refers_to", "digest", "block", "total"]
    once = parts.groupBy("origin_id", "segment").agg(F.count("*").alias("copies"), *[F.first(c, ignorenulls=True).alias(c) for c in whole])
    heads = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in whole[:4]]
    got = once.groupBy("origin_id").agg(F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("s"), F.min("copies").alias("copies"), F.max("total").alias("total"), F.max("segment").alias("top"), *heads)
    joined = F.array_join(F.transform("s", lambda x: F.hex(x["block"])), "")
    fault = F.when((F.col("top") != F.size("s")) | F.col("record_type").isNull() | F.col("total").isNull(), "missing segment").when(F.length(joined) != 2 * F.col("total"), "length differs")
    out = got.select(F.col("origin_id").alias("record_id"), "record_type", "page_id", "refers_to", "digest", F.unhex(joined).alias("block"), "copies", fault.alias("fault"))
    return out.withColumn("block", F.when(F.col("fault").isNull(), F.col("block")))


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Logical records of the archives below ``path``: record_id, record_type, page_id (text), refers_to, stated (the header's digest),
    payload, payload_bytes, payload_digest, fault. A revisit has no payload of its own. ``fault`` names a broken record, else null."""
    columns = ["record_id", "record_type", "page_id", "refers_to", "digest", "block"]
    whole = _records(spark, path, segmented=False).select(*columns, F.lit(1).cast("long").alias("copies"), F.lit(None).cast("string").alias("fault"))
    parts = reassembled(_records(spark, path, segmented=True)).select(*columns, "copies", "fault")
    schema = "record_id string, record_type string, page_id string, refers_to string, stated string, payload binary, payload_bytes long, payload_digest string, fault string"

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples():
                stated, data, fault = (r.digest or "").removeprefix("sha256:"), None, r.fault
                if r.record_type != "revisit" and r.block is not None:
                    data = payload_of(bytes(r.block))
                    if hashlib.sha256(data).hexdigest() != stated:
                        fault = "digest differs"
                known = data is not None
                rows += [(r.record_id, r.record_type, r.page_id, r.refers_to, stated, data if keep_payload else None, len(data) if known else None, hashlib.sha256(data).hexdigest() if known else None, fault)] * int(r.copies)
            if not rows:
                continue
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            yield out.assign(payload_bytes=out.payload_bytes.astype("Int64"))

    return whole.unionByName(parts).mapInPandas(decode, schema)


def archive_digest(pages: DataFrame, path: str, id_col: str = "page_id") -> DataFrame:
    """Write ``pages`` to archives below ``path``, read them back, and give a row per page: id, payload_bytes, payload_digest, record_type, refers_to, fault."""
    write_archives(pages, path, id_col)
    got = saved(read_archives(pages.sparkSession, path, keep_payload=False).drop("payload"), "warc-read")
    kind = dict(pages.dtypes)[id_col]
    own = got.filter("record_type = 'response'")
    first = own.groupBy("record_id").agg(F.first("page_id").alias("__first"), F.first("payload_bytes").alias("__bytes"), F.first("payload_digest").alias("__digest"))
    seen = got.filter("record_type = 'revisit'").select("page_id", F.col("refers_to").alias("record_id"), "stated", "fault").join(first, "record_id", "left")
    fault = F.when(~F.col("__digest").eqNullSafe(F.col("stated")), "target missing").otherwise(F.col("fault"))
    own = own.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to"), "fault")
    seen = seen.select("page_id", F.col("__bytes").alias("payload_bytes"), F.col("__digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("__first").alias("refers_to"), fault.alias("fault"))
    return own.unionByName(seen).select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "fault")
