"""WARC: round trip of hostile payloads under several split sizes, and broken archives."""

from __future__ import annotations

import base64
import hashlib

import duckdb
import pytest

from rulecheck.llm import warc
from rulecheck.llm.common import staging_path

SF = "/root/testdata/sf0.001"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc"
ROWS = [
    (1, "u", "same"), (2, "u", "same"), (5, "u", "same"), (3, "u", None), (4, "u", ""), (7, "u\r\nv", "tail\r\n\r\nWARC/1.0\r\n"),
    (6, "u", "x\r\n\r\n" + FAKE + "\r\n\r\nWARC/1.0\r\nContent-Length: zz\r\n\r\nq"), (9, "u", "\r\n\r\n"), (None, "u", "n"), (11, None, "WARC/1.0\r\n"),
    (8, "u", "é" * 3000 + "\r\n\r\n" + FAKE * 3 + "\r\n\r\n" + FAKE + "\r\n\r\n"), (12, "u", "\r\n\r\n" + FAKE + "\r\n\r\n" + FAKE),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def check(found, rows):
    payload = {i: (t or "").encode() for i, _, t in rows}
    assert sorted(r.page_id or -1 for r in found) == sorted(i or -1 for i in payload)
    for r in found:
        own = payload[r.page_id]
        top = max(i for i in payload if i is not None and payload[i] == own) if r.page_id is not None else None
        kind = "response" if r.page_id in (None, top) else "revisit"
        assert (r.payload_bytes, r.payload_digest, r.record_type) == (len(own), digest(own), kind), r
        assert r.refers_to == (top if kind == "revisit" else None)


@pytest.mark.parametrize("split", ["128m", "1500"])
def test_hostile_payloads(spark, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pages = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id bigint, url string, html string, sha string, first int").repartition(2)
        path = staging_path(spark, "warc")
        warc.write_archives(pages, path)
        check(warc.pages_of(warc.read_records(spark, path)).collect(), ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_query_over_the_table(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    found = warc.op8_warc(spark, SF)
    rows = found.collect()
    check(rows, pages)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    wanted = con.sql(warc.OP8_SQL)
    assert found.columns == wanted.columns and sorted(map(tuple, rows)) == sorted(wanted.fetchall())


@pytest.mark.parametrize("split", ["128m", "600"])
def test_lengths_beyond_any_file(spark, split):
    """Numbers of 19, 20, 30 and 5000 digits behind a magic in a payload, alone and in a cut-up payload."""
    fakes = [f"\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: {n}\r\n\r\nabc" for n in ("9" * 18, "9" * 19, "9" * 20, "1" * 30, "7" * 5000, "-5", "+3", "1_0", "\u0663")]
    rows = [(i, "u", f) for i, f in enumerate(fakes)] + [(50, "u", "x".join(fakes) * 2), (51, "u", "plain"), (52, "u", "y" * 3000 + fakes[2])]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        path = staging_path(spark, "warc")
        warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), path)
        check(warc.pages_of(warc.read_records(spark, path)).collect(), rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_repeated_rows_are_written_once_each(spark):
    rows = [(1, "u", "A")] * 3 + [(2, "u", "A")] * 2 + [(None, "u", "A")] * 2 + [(3, "u", "B\r\n\r\n" + FAKE)] * 2
    path = staging_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path)
    found = warc.pages_of(warc.read_records(spark, path)).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in found) == sorted(
        [(1, "revisit", 2)] * 3 + [(2, "response", 0)] * 2 + [(0, "response", 0)] * 2 + [(3, "response", 0)] * 2
    )


def test_small_payloads_are_no_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    path = staging_path(spark, "warc")
    warc.write_archives(pages, path, min_payload=3)
    kinds = {r.page_id: r.record_type for r in warc.pages_of(warc.read_records(spark, path)).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_one_page_id_over_several_payloads(spark):
    """Each payload of a page id is a response or a revisit by itself; every row is written once."""
    rows = [(1, "u", "A"), (1, "u", "B"), (2, "u", "A"), (3, "u", "C"), (3, "u", "D"), (4, "u", "C"), (5, "u", "D")]
    path = staging_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path)
    found = warc.pages_of(warc.read_records(spark, path)).collect()
    own = {(1, "A"): 2, (1, "B"): None, (2, "A"): None, (3, "C"): 4, (3, "D"): 5, (4, "C"): None, (5, "D"): None}
    expected = [(i, 1, digest(t.encode()), "response" if of is None else "revisit", of or 0) for (i, t), of in own.items()]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in found) == sorted(expected)


def test_empty_table(spark):
    path = staging_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_records(spark, path).collect() == []


def test_broken_chain_keeps_what_comes_before(spark):
    def record(i, body, size=None):
        return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(body) if size is None else size}\r\n\r\n{body}\r\n\r\n"

    path = staging_path(spark, "broken")
    text = record(1, "a") + record(2, "b", size=2) + record(3, "c")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert sorted(r.page_id for r in warc.pages_of(warc.read_records(spark, path)).collect()) == [1, 2]
    path = staging_path(spark, "cut-off")
    spark.createDataFrame([(record(1, "a") + record(2, "b" * 50, size=500),)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert [r.page_id for r in warc.pages_of(warc.read_records(spark, path)).collect()] == [1]


def test_base32_equals_the_library(spark):
    row = spark.sql("SELECT 'x' AS v").select(warc.base32(warc.F.sha1("v")).alias("b"), warc.base32(warc.F.lit("0" * 40)).alias("z")).first()
    assert (row.b, row.z) == (digest(b"x"), "A" * 32)
