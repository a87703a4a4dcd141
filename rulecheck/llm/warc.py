"""WARC archives: writing, and reading by boundary-chain verification.

Writing: one record per page. Pages with equal payloads (SHA-1) of at least a
given size become one response, that of the largest id, and revisits of it.
Records are written by Spark's text writer: a record is one row and the line
separator is the two line ends that close a record.

Reading: archives are split like any large text file, at the record magic. A
magic inside a payload splits there too, so a task cannot know which of its
chunks begin a record. It emits candidates: for each chunk, where the record
that would begin there ends (header and Content-Length say so), as offsets
within its split. Offsets in the file follow from the splits' lengths. Inside a
split the chains of candidates are followed back to front; across splits
pointer jumping from each file's start finds the chunks at which the true chain
enters each split, in rounds that grow with the logarithm of a file's splits.
Only records reachable from the start of their file are kept; the chunks that a
payload with a magic was split into are joined again.

Cases: null and empty html are empty payloads; a null page id has an empty
name and is always a response; repeated rows are written once each (equal ones
are all responses or all revisits); of one page id with several payloads, each
payload is a response or a revisit by itself; an empty table makes archives
without records; other columns are ignored. A chain that breaks off (a truncated
archive) keeps the records before the break. A length that is no number of at most
SIZE_DIGITS digits names no record.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecheck.llm.common import ship_package, stage, staging_path

# The record format.
MAGIC = "WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_AT = CLOSE + MAGIC
MIN_PAYLOAD = 0
SIZE_DIGITS = 18  # of a record's length; a longer number names no record, and sums with offsets stay below 2^63
DATE = "2024-01-01T00:00:00Z"


def name_of(page_id: Column) -> Column:
    """Record name of a page."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def base32(hexadecimal: Column) -> Column:
    """Base32 text of a SHA-1 given in hexadecimal: its four quarters are 8 digits each (no padding)."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Record texts (``value``), one per page.

    Digests are computed in a pass that moves no payloads; only pages that revisit
    another one (staged, so that Spark knows their size) are joined to the payloads,
    by page and payload.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    digests = rows.select("page_id", "sha", F.octet_length("html").alias("bytes"))
    digests = digests.where((F.col("bytes") >= min_payload) & F.col("page_id").isNotNull())
    shared = digests.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1").drop("pages")
    revisits = digests.join(shared, "sha").where("page_id <> first").select("page_id", "sha", "first").distinct()
    revisits = stage(revisits, "revisits")
    joined = rows.join(revisits, ["page_id", "sha"], "left")
    digest = base32(F.hex("sha"))
    size = F.octet_length("html")
    again = F.col("first").isNotNull()
    head = F.concat(
        F.lit(MAGIC),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit("\r\n")),
        F.concat(F.lit("WARC-Record-ID: "), name_of(F.col("page_id")), F.lit("\r\n")),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " "), F.lit("\r\n")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest, F.lit("\r\n")),
        F.concat(F.lit("X-Payload-Length: "), size.cast("string"), F.lit("\r\n")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), name_of(F.col("first")), F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(""),
        F.concat(F.lit("Content-Type: text/html\r\nContent-Length: "), F.when(again, F.lit(0)).otherwise(size).cast("string"), F.lit("\r\n\r\n")),
    )
    return joined.select(F.concat(head, F.when(again, "").otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Write all pages as archives below ``path``, one file per task."""
    records(pages, min_payload).write.option("lineSep", CLOSE).text(path)


_CHUNK = pa.struct([("at", pa.int64()), ("next", pa.int64()), ("exit", pa.int64()), ("cut", pa.int64()), ("size", pa.int64()), ("head", pa.string()), ("sha", pa.string())])
_BLOCK = pa.schema([("file", pa.string()), ("block", pa.int64()), ("length", pa.int64()), ("chunks", pa.list_(_CHUNK))])
_BLOCK_SQL = "file string, block bigint, length bigint, chunks array<struct<at:bigint,next:bigint,exit:bigint,cut:bigint,size:bigint,head:string,sha:string>>"


def parse_head(chunk: bytes) -> tuple[int, int, str] | None:
    """Header length, content length and header text of a chunk; None if no record begins there.
    Where the content begins with a magic, the header's end is part of the separator."""
    cut = chunk.find(b"\r\n\r\n")
    cut = len(chunk) if cut < 0 else cut
    try:
        head = chunk[:cut].decode()
        size = dict(x.split(": ", 1) for x in head.split("\r\n"))["Content-Length"]
    except (ValueError, KeyError):
        return None
    digits = size.strip().lstrip("0") or "0"
    return (cut + 4, int(digits), head) if digits.isascii() and digits.isdigit() and len(digits) <= SIZE_DIGITS else None


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """File, split, number in the split, offset of the magic within the split's share of the
    file, and bytes behind the magic. The share begins behind the first magic of a split that
    is not a file's first; its length grows by each chunk and the separator."""
    last, at, number = None, 0, 0
    for batch in batches:
        for file, block, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
            if (file, block) != last:
                last, at, number = (file, block), 0, 0
            for data in value.split(SPLIT_AT.encode()):  # a line reader may overlook one at its buffer's end
                if block == 0 and number == 0:
                    magic = data.startswith(MAGIC.encode())
                    yield file, block, 0, 0, data[len(MAGIC) :] if magic else b""
                else:
                    yield file, block, number, at - len(MAGIC), data
                at += len(data) + len(SPLIT_AT)
                number += 1


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its length, and for each chunk the record that would begin there:
    where its successor would be (``next``) and where its chain leaves the split (``exit``)."""
    last, chunks, length = None, [], 0

    def close() -> pa.RecordBatch:
        exits = {}
        for c in reversed(chunks):
            leaves = c["next"] is not None and c["next"] >= length - len(MAGIC)
            c["exit"] = c["next"] if leaves else exits.get(c["next"])
            exits[c["at"]] = c["exit"]
        return pa.RecordBatch.from_pydict({"file": [last[0]], "block": [last[1]], "length": [length], "chunks": [chunks]}, schema=_BLOCK)

    for file, block, _, at, data in _chunks(batches):
        if (file, block) != last:
            if last is not None:
                yield close()
            last, chunks = (file, block), []
        length = at + len(MAGIC) + len(data) + len(SPLIT_AT)
        found = parse_head(data)
        if found is None:
            chunks.append({"at": at, "next": None})
            continue
        cut, size, head = found
        inside = cut + size <= len(data)
        sha = base64.b32encode(hashlib.sha1(data[cut : cut + size]).digest()).decode() if inside else None
        chunks.append({"at": at, "next": at + len(MAGIC) + cut + size + len(CLOSE), "cut": cut, "size": size, "head": head, "sha": sha})
    if last is not None:
        yield close()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of splits with a mark on those that the chains from the split's entries reach, and the
    cut-up record that each belongs to (``owner``); before the split's first record (``carried``),
    chunks belong to one of an earlier split, if any."""
    for batch in batches:
        for row in batch.to_pylist():
            base, by_start = row["base"], {c["at"]: c for c in row["chunks"]}
            reached: set[int] = set()
            for entry in row["entries"] or []:
                at = entry - base
                while at in by_start and at not in reached:
                    reached.add(at)
                    at = by_start[at]["next"]
            out, owner, carried = [], None, True
            for i, c in enumerate(row["chunks"]):
                own = {k: c[k] for k in ("cut", "size", "head")} | {"offset": base + c["at"]}
                real = c["at"] in reached and c["head"] is not None
                if real:
                    owner, carried = own if c["sha"] is None else None, False
                out.append(own | {"file": row["file"], "block": row["block"], "number": i, "reached": real, "sha": c["sha"], "owner": owner, "carried": carried})
            yield pa.RecordBatch.from_pylist(out, schema=_MARKED)


_OWNER = pa.struct([("offset", pa.int64()), ("cut", pa.int64()), ("size", pa.int64()), ("head", pa.string())])
_MARKED = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("offset", pa.int64()), ("reached", pa.bool_()), ("cut", pa.int64())]
    + [("size", pa.int64()), ("head", pa.string()), ("sha", pa.string()), ("owner", _OWNER), ("carried", pa.bool_())]
)
_OWNER_SQL = "struct<offset:bigint,cut:bigint,size:bigint,head:string>"
_MARKED_SQL = f"file string, block bigint, number bigint, offset bigint, reached boolean, cut bigint, size bigint, head string, sha string, owner {_OWNER_SQL}, carried boolean"


def _scan(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.option("lineSep", SPLIT_AT).text(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _entries(blocks: DataFrame) -> DataFrame:
    """Offsets at which the true chain of each file enters its splits (``file``, ``block``,
    ``entries``), by pointer jumping over the candidates' exits."""
    based = F.sum("length").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = stage(blocks.select("file", "block", "length").withColumn("base", F.coalesce(based, F.lit(0))).drop("length"), "bases")
    most = base.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    candidates = blocks.select("file", "block", F.inline("chunks")).join(base, ["file", "block"])
    candidates = stage(candidates.select("file", "block", (F.col("at") + F.col("base")).alias("at"), (F.col("exit") + F.col("base")).alias("exit")), "candidates")
    entered = base.select("file", F.lit(0).cast("bigint").alias("at")).distinct()
    jumps = candidates.where("exit IS NOT NULL").select("file", "at", "exit")
    for _ in range(max(0, int(most) - 1).bit_length()):
        further = entered.join(jumps, ["file", "at"]).select("file", F.col("exit").alias("at"))
        entered = stage(entered.unionByName(further).distinct(), "entered")
        second = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("last"))
        jumps = stage(jumps.join(second, ["file", "exit"]).select("file", "at", F.col("last").alias("exit")), "jumps")
    where = candidates.join(entered, ["file", "at"]).groupBy("file", "block").agg(F.collect_list("at").alias("entries"))
    return base.join(where, ["file", "block"], "left")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Verified records of all archives below ``path``: ``file``, ``offset``, ``size`` (of the
    content), ``head`` (header text) and ``sha`` (base32 SHA-1 of the content as read)."""
    ship_package(spark)
    blocks = stage(_scan(spark, path).mapInArrow(_candidates, _BLOCK_SQL), "splits")
    marked = blocks.join(_entries(blocks), ["file", "block"]).select("file", "block", "chunks", "base", "entries")
    marked = stage(marked.mapInArrow(_walk, _MARKED_SQL), "marked")
    whole = marked.where("reached AND sha IS NOT NULL").select("file", "offset", "size", "head", "sha")
    place = ["file", "block", "number", "offset"]
    inside = marked.where("owner IS NOT NULL").select(*place, "owner")
    last = F.max(F.when(F.col("reached"), F.struct("offset", F.col("sha").isNull().alias("cutup"), "owner"))).alias("last")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    carry = marked.groupBy("file", "block").agg(last).select("file", "block", F.last("last", ignorenulls=True).over(before).alias("open"))
    outside = marked.where("carried").select(*place).join(carry.where("open.cutup"), ["file", "block"]).select(*place, F.col("open.owner").alias("owner"))
    parts = stage(inside.unionByName(outside), "parts")
    if parts.isEmpty():  # no payload holds a magic, so none was cut up
        return whole
    texts = _scan(spark, path).mapInArrow(_numbered, "file string, block bigint, number bigint, data binary")
    pieces = texts.join(parts, ["file", "block", "number"]).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("offset", "data"))).alias("pieces"))
    return whole.unionByName(pieces.mapInArrow(_rejoin, "file string, offset bigint, size bigint, head string, sha string"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for file, block, number, _, data in _chunks(batches):
        held.append({"file": file, "block": block, "number": number, "data": data})
        size += len(data)
        if size > 4 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=_NUMBERED)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_NUMBERED)


_NUMBERED = pa.schema([("file", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("data", pa.binary())])
_RECORD = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("head", pa.string()), ("sha", pa.string())])


def _rejoin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads that hold a magic, from their pieces; a record cut off by the file's end is left out."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            own = row["owner"]
            data = SPLIT_AT.encode().join(p["data"] for p in row["pieces"])[own["cut"] : own["cut"] + own["size"]]
            if len(data) == own["size"]:
                sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
                out.append({"file": row["file"], "offset": own["offset"], "size": own["size"], "head": own["head"], "sha": sha})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)


def field(name: str) -> Column:
    """A header field's value, null where the record has none."""
    value = F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def page_of(name: str) -> Column:
    return F.regexp_extract(F.coalesce(field(name), F.lit("")), r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all pages written as archives and read back."""
    path = staging_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return pages_of(read_records(spark, path))


# DuckDB: the records of all pages, without archives. Base32 digits are five bits of the SHA-1 each.
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html) AS n, sha1(html) AS x, max(page_id) OVER (PARTITION BY html) AS top FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', x[i:i]) - 1), 4, '0')), '') AS bits FROM s)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(1, 6),
    lambda j: CAST(bits[5 * k + j:5 * k + j] AS INTEGER) << (5 - j)))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id <> top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM b
"""


def pages_of(found: DataFrame) -> DataFrame:
    """The query's columns: length and digest of a response as read, of a revisit as declared."""
    response = field("WARC-Type") == "response"
    declared = F.regexp_extract("head", r"WARC-Payload-Digest: sha1:([A-Z2-7]{32})", 1)
    return found.select(
        page_of("WARC-Record-ID").alias("page_id"),
        F.when(response, F.col("size")).otherwise(field("X-Payload-Length").cast("bigint")).alias("payload_bytes"),
        F.when(response, F.col("sha")).otherwise(declared).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(~response, page_of("WARC-Refers-To")).alias("refers_to"),
    )
