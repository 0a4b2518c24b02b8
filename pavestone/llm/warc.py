"""Operator 5, WARC: archives written from pages and read back by boundary-chain verification.

Writing: of pages with equal payloads, the one with the largest page_id becomes
the response record and the others revisit it.  A record is one text row ending
in two line ends, so Spark's text writer makes the archives: files of FILE_BYTES of payload on average
at most, and of no more than FILE_RECORDS records.

Reading: each task takes one archive file after the other and emits every place where the
magic stands as a candidate, with the offset of the record that would follow
it.  Only the candidates that the chain of successors reaches from the start of
the file are records; a magic inside a payload is never reached.  A task jumps along the
chain inside one block of a file, and pointer jumping (doubling joins) over the
blocks finds where the chain enters each of them.

Defined results: a null html is an empty payload; a null page_id or url is kept
as null; rows equal in page_id and payload are one capture each (all of them
response if theirs is the largest page_id); a page of any length is one record, in a file of its own if it is longer than one;
an empty table gives no rows; other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, only, width, written

MAGIC = b"WARC/1.1\r\n"
SEPARATOR = "\r\n\r\n"
#: A task compresses the chain within this many bytes.
BLOCK_BYTES = 4 << 20
#: Payload bytes of an archive file on average, and its most records.
FILE_BYTES, FILE_RECORDS = 32 << 20, 20_000
DATE = "2026-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: four times 40 bits are four times 8 digits."""
    hexed = F.sha1(payload)
    part = lambda k: F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(k) for k in range(4)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits(narrow: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the captures (page_id, payload_digest, payload_bytes) whose payload a larger page_id holds too."""
    narrow = narrow.where(F.col("payload_bytes") >= least_bytes).select("page_id", "payload_digest")
    # partial maxima before the shuffle: a payload may be on a third of the pages
    last = narrow.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first")).where("first < refers_to").drop("first")
    # written: both sides of the join are then plain exchanges, which adaptive execution can split
    last = written(last, "responses")
    return narrow.join(last.hint("merge"), "payload_digest").where("page_id < refers_to").distinct()


def captures(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return only(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"), base32_sha1(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes")
    )


def record_text() -> Column:
    """One record without its last two line ends; a revisit carries no payload, but its digest and length."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("-")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    url = F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", ""), F.lit("\r\n"))).otherwise("")
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    return F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\n"), url, F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\nWARC-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), urn(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(SEPARATOR), block,
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, compression: str | None = "gzip", file_bytes: int = FILE_BYTES) -> None:
    """Writes the pages as archives below `path`."""
    every = captures(pages)
    narrow = written(every.select("page_id", "payload_digest", "payload_bytes"), "captures")
    # header and payload of all records, so that files grow in number and not in size
    total = narrow.agg(F.sum(F.col("payload_bytes") + 500)).first()[0] or 0
    keys = ["page_id", "payload_digest"]
    # with fewer partitions than Spark's own number the join would deal the pages once more
    files = max(width(pages.sparkSession), -(-total // file_bytes))
    l, r = every.repartition(files, *keys).alias("l"), revisits(narrow, least_bytes).hint("merge").alias("r")
    same = (F.col("l.page_id") == F.col("r.page_id")) & (F.col("l.payload_digest") == F.col("r.payload_digest"))
    rows = l.join(r, same, "left").select("l.*", "r.refers_to")
    rows.select(record_text().alias("value")).write.option("lineSep", SEPARATOR).option("compression", compression or "none").option("maxRecordsPerFile", FILE_RECORDS).text(path)


CANDIDATES = (
    "file string, at long, next long, block long, leaves long, record_type string, page_id long, url string, refers_to long, "
    "payload_bytes long, payload_digest string, declared_digest string, payload binary"
)


NAMES = frozenset("content-length warc-type warc-record-id warc-target-uri warc-refers-to warc-payload-length warc-payload-digest".split())


def _named_lines(data: bytes, at: int, end: int) -> list[tuple[int, str, str]]:
    """(place, name, value) of the last line of each name that this module reads, between a magic and the empty line."""
    out: dict[str, tuple[int, str, bytes]] = {}
    for line in data[at:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon and (name := name.strip().lower().decode("latin-1")) in NAMES:
            out[name] = (at, name, value)
        at += len(line) + 2
    return [(place, name, value.decode("utf-8", "replace").strip()) for place, name, value in out.values()]


def _number(x: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", x or "")
    return int(found[1]) if found else None


def scan(data: bytes, block_bytes: int, keep_payload: bool) -> list[tuple]:
    """The candidates of one file: its magics, where each one's record would end, and where the chain leaves their block."""
    found, at, end = [], data.find(MAGIC), -1
    while at >= 0:
        if end < at:  # magics without an empty line between them share the one behind, and its header lines
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                break
            lines = _named_lines(data, at, end)
        head = {name: value for place, name, value in lines if place > at}
        length = head.get("content-length", "")
        if length.isdigit() and (after := end + 4 + int(length)) <= len(data) and data[after : after + 4] == b"\r\n\r\n":
            found.append((at, after + 4, head, end + 4, after))
        at = data.find(MAGIC, at + 1)
    # chains run forward, so one backward pass finds where each leaves its block; a chain that meets no candidate ends there
    leaves: dict[int, int] = {}
    for at, after, *_ in reversed(found):
        leaves[at] = leaves[after] if after // block_bytes == at // block_bytes and after in leaves else after
    out = []
    digests: dict[tuple[int, int], str] = {}
    for at, after, head, begin, end in found:
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
        kind = head.get("warc-type", "")
        if kind == "revisit":
            size, own = int(head.get("warc-payload-length", "0") or 0), digest
        else:
            size = end - begin
            own = digests.get((begin, end)) or digests.setdefault((begin, end), base64.b32encode(hashlib.sha1(memoryview(data)[begin:end]).digest()).decode())
        out.append((at, after, at // block_bytes, leaves[at], kind, _number(head.get("warc-record-id")), head.get("warc-target-uri"), _number(head.get("warc-refers-to")), size, own, digest, data[begin:end] if keep_payload else None))
    return out


def _scan_task(block_bytes: int, keep_payload: bool):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("next", pa.int64()), ("block", pa.int64()), ("leaves", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string()), ("payload", pa.binary())])
        for b in it:
            for file, content in zip(b.column(0), b.column(1), strict=True):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows = scan(data, block_bytes, keep_payload)
                step = 64 if keep_payload else 5000
                for i in range(0, len(rows), step):
                    part = list(zip(*[(file.as_py(), *r) for r in rows[i : i + step]], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, schema.types, strict=True)], schema=schema)

    return task


def entries(candidates: DataFrame) -> DataFrame:
    """(file, at): where the chain from the start of each file enters its blocks, by pointer jumping.

    `reached` doubles its steps each round and `jump` the length of its jumps;
    both are written between rounds, so a plan never grows with the rounds.
    """
    jump = written(candidates.select("file", "at", F.col("leaves").alias("to")), "jumps")
    known = jump.select("file", "at")  # all candidates: a chain may end beyond them
    reached = written(known.where("at = 0").distinct(), "reached")
    n = reached.count()
    while True:
        # no side is bounded: none is broadcast
        step = reached.join(jump.hint("merge"), ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = written(reached.unionByName(step.join(known.hint("merge"), ["file", "at"], "left_semi")).distinct(), "reached")
        m = reached.count()
        if m == n:
            return reached
        n = m
        jump = written(jump.alias("a").join(jump.select("file", F.col("at").alias("to"), F.col("to").alias("to2")).hint("merge"), ["file", "to"]).select("file", "at", F.col("to2").alias("to")), "jumps")


def _on_chain(pdf):
    """The candidates of one block that the chain reaches from where it enters the block."""
    import pandas as pd

    pdf = pdf.sort_values("at")
    at, after = pdf["at"].to_numpy(), pdf["next"].to_numpy()
    keep = pdf["entry"].to_numpy(bool).copy()
    place = {a: i for i, a in enumerate(at)}
    for i in range(len(at)):  # successors lie behind, so one pass in order settles all
        if keep[i] and (j := place.get(after[i])) is not None:
            keep[j] = True
    return pd.DataFrame({"file": pdf["file"], "at": at})[keep]


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The records of the archives below `path`, one row each."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = written(files.mapInArrow(_scan_task(block_bytes, keep_payload), CANDIDATES), "candidates")
    chain = found.select("file", "at", "next", "block", "leaves")
    entry = entries(chain).withColumn("entry", F.lit(True))
    marked = chain.join(entry.hint("merge"), ["file", "at"], "left").select("file", "at", "next", "block", F.coalesce("entry", F.lit(False)).alias("entry"))
    reached = marked.groupBy("file", "block").applyInPandas(_on_chain, "file string, at long")
    return found.join(reached.hint("merge"), ["file", "at"], "left_semi")


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_OP5 = """
WITH raw AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), named AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM raw
), coded AS (
  SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 10 * CAST(i // 8 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest
  FROM named
), last AS (
  SELECT payload_digest, max(page_id) AS top FROM coded GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM coded JOIN last USING (payload_digest)
"""
