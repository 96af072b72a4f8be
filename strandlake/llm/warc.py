"""WARC archives: write pages as records, read them back by boundary-chain verification.

Writing: each page is one record; Spark's text writer concatenates records, the last line feed of a record being the
writer's line separator, so the files are plain WARC/1.1. Of pages with equal payloads the smallest page_id is a
response, the others revisit it.

Reading: tasks emit, for every place where the record magic occurs, the offset at which that record would be followed
by its successor. Pointer jumping from offset 0 of each file keeps what the chain reaches; magic inside payloads is
off the chain.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, maybe_broadcast, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2000-01-01T00:00:00Z"
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
CRLF = "\r\n"


def base32(hexed: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex, a column of its own: five hex digits make four base32 digits."""

    def four(i: Column) -> Column:
        n = F.conv(F.substring(hexed, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """One column `value`: each page's WARC record without its final line feed."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.regexp_replace(F.coalesce(F.col(url), F.lit("about:blank")), r"[\x00-\x20\x7F]", "_").alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("hexed"))
    ids = rows.select("page_id", F.unhex("hexed").alias("digest"), F.octet_length("payload").alias("bytes"))
    firsts = ids.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.min("page_id").cast("long").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.withColumn("digest", F.unhex("hexed")).withColumn("bytes", F.octet_length("payload")).join(maybe_broadcast(table(firsts, "warc-firsts")), ["digest", "bytes"], "left")
    size, revisit = F.octet_length("payload"), F.coalesce(F.col("page_id") > F.col("first"), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), uri(F.col("page_id"))), F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("hexed"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri(F.col("first")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    return rows.select(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block, F.lit("\r\n\r")).alias("value"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, file_bytes: int = 1 << 25) -> str:
    """Write `pages` as WARC files of about `file_bytes` bytes, or a larger record, to the folder `path`; returns it.

    Null html is an empty payload, null url `about:blank`; control characters of a url become `_`; payloads of fewer
    than `least` bytes never become revisits. Repeated rows make repeated records; rows of one id and unlike html are
    records of their own. Other columns aren't archived.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for value in batch.column("value"):
                held.append(value.as_buffer())
                size += len(held[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(held)], pa.binary())], ["value"])

    made = records(pages, page_id, url, html, least).mapInArrow(files, "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)
    return path


def _candidates(data: bytes) -> Iterator[tuple]:
    """(offset, successor, page_id, type, refers_to, payload bytes, digest) wherever the magic occurs with a sound header."""
    for m in MAGIC.finditer(data):
        end = data.find(b"\r\n\r\n", m.start())
        if end < 0:
            continue
        head = dict(line.split(b": ", 1) for line in data[m.end():end].split(b"\r\n") if b": " in line)
        length = head.get(b"Content-Length", b"")
        if not length.isdigit():
            continue
        start, after = end + 4, end + 4 + int(length)
        if data[after:after + 4] != b"\r\n\r\n":
            continue
        http = data.find(b"\r\n\r\n", start, after)
        size = re.search(rb"Content-Length: (\d+)", data[start:http]) if http >= 0 else None
        if head.get(b"WARC-Type") == b"revisit":
            digest, n = head.get(b"WARC-Payload-Digest", b"").removeprefix(b"sha1:").decode(), int(size[1]) if size else None
        else:
            body = data[http + 4 if http >= 0 else start:after]
            digest, n = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
        number = lambda name: int(x[1]) if (x := re.fullmatch(rb"<urn:page:(-?\d+)>", head.get(name, b""))) else None
        yield m.start(), after + 4, number(b"WARC-Record-ID"), head.get(b"WARC-Type", b"").decode("utf-8", "replace"), number(b"WARC-Refers-To"), n, digest


def read_archives(spark, path: str) -> DataFrame:
    """The records of all WARC files in `path`: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Candidates are joined to their successors; each round doubles how far a pointer jumps, so a file of n records takes
    log2(n) rounds of a join on (file, offset). A file that is cut off, or holds a record without a sound header and
    length, keeps the records before that place; empty files and folders without files have none.
    """
    schema = "file string, at long, next long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"], strict=True):
                rows = [(file, at, to, page, kind, refers, n, digest) for at, to, page, kind, refers, n, digest in _candidates(bytes(data))]
                frame = pd.DataFrame(rows, columns=["file", "at", "next", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"], dtype=object)
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = table(files.mapInPandas(scan, schema), "warc-candidates")
    return chain(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def chain(found: DataFrame) -> DataFrame:
    """Rows (file, at, next, ...) that the chain from offset 0 of their file reaches, by pointer jumping."""
    links = found.select("file", "at", "next").distinct()
    reached = table(links.where("at = 0").select("file", "at"), "warc-reached")
    jumps = table(links, "warc-jumps")
    n = reached.count()
    while True:
        step = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        on_chain = step.join(links.select("file", "at"), ["file", "at"], "left_semi")
        reached = table(reached.unionByName(on_chain).distinct(), "warc-reached")
        more = reached.count()
        if more == n:
            break
        n = more
        far = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("far"))
        jumps = table(jumps.join(far, ["file", "next"]).select("file", "at", F.col("far").alias("next")), "warc-jumps")
    return found.join(reached, ["file", "at"], "left_semi")


def op9_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_archives(spark, write_archives(pages, fresh(spark, "warc")))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, ('0x' || h) AS x, h, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM q
"""
