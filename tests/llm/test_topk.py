"""Exact top-k search against every query compared with every row."""

from __future__ import annotations

import random
from math import comb

import duckdb
import pytest
from pyspark.sql import functions as F

from rulecheck.llm import topk

SF = "/root/testdata/sf0.001"
KIND = "vec_id bigint, embedding array<float>"


def code(v, dimensions):
    return [x is not None and x == x and x > 0 for x in v] + [False] * (dimensions - len(v))


def brute(rows, queries, k):
    dimensions = max(len(v) for _, v in rows if v is not None)
    coded = [(i, code(v, dimensions)) for i, v in rows if i is not None and v is not None]
    out = []
    for q, own in [(i, code(v, dimensions)) for i, v in queries if i is not None and v is not None]:
        near = sorted((sum(a != b for a, b in zip(own, c, strict=True)), i) for i, c in coded)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


def test_query_matches_sql(spark):
    got = sorted(map(tuple, topk.op5_topk(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert got == sorted(con.sql(topk.OP5_SQL).fetchall())


@pytest.mark.parametrize("dimensions", [20, 70])
def test_groups_of_equal_and_near_codes(spark, dimensions):
    dice = random.Random(dimensions)
    centres = [[dice.choice([-1.0, 1.0]) for _ in range(dimensions)] for _ in range(3)]
    rows = []
    for i in range(120):
        v = list(dice.choice(centres))
        for _ in range(dice.choice([0, 0, 1, 2, 9])):
            v[dice.randrange(dimensions)] *= -1
        rows.append((i, v))
    rows += [(None, centres[0]), (500, None), (501, centres[1][:11]), (502, [float("nan"), None] + centres[2][2:]), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], KIND + ", distance int, w0 string").repartition(3)
    asked = df.where("vec_id % 20 = 0 OR vec_id > 499 OR vec_id IS NULL")
    queries = [r for r in rows if r[0] is None or r[0] % 20 == 0 or r[0] > 499]
    got = topk.search(df, asked, "vec_id", "embedding", k=6)
    assert got.columns == ["query_id", "rank", "neighbour_id", "distance"]
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 6)


def test_fewer_rows_than_k_and_empty_tables(spark):
    rows = [(1, [1.0, -1.0]), (2, [-1.0, 1.0])]
    df = spark.createDataFrame(rows, KIND)
    assert sorted(map(tuple, topk.search(df, df, "vec_id", "embedding", k=5).collect())) == brute(rows, rows, 5)
    empty = df.where("false")
    assert topk.search(empty, empty, "vec_id", "embedding").collect() == []
    assert topk.search(df, empty, "vec_id", "embedding").collect() == []


def test_segments_follow_the_number_of_codes():
    assert topk.segment_bounds(64, 100_000) == [(0, 16), (16, 32), (32, 48), (48, 64)]
    assert topk.segment_bounds(64, 65_535) == topk.segment_bounds(64, 9_000) == [(0, 12), (12, 25), (25, 38), (38, 51), (51, 64)]
    assert topk.segment_bounds(70, 1) == [(0, 7), (7, 15), (15, 23), (23, 31), (31, 38), (38, 46), (46, 54), (54, 62), (62, 70)]
    assert topk.segment_bounds(64, 10**12) == [(0, 32), (32, 64)]
    assert topk.segment_bounds(3, 10**12) == [(0, 3)]


@pytest.mark.parametrize("width", [3, 16, 18])
def test_masks_are_all_choices_of_bits_once(spark, monkeypatch, width):
    monkeypatch.setattr(topk, "HALF_BITS", 11)
    seen = set()
    for radius in range(width + 1):
        if comb(width, radius) > 5000:
            continue
        sets = spark.range(1).select(F.inline(topk.masks(width, radius))).collect()
        made = [a | b for r in sets for a in r.low for b in r.high]
        assert len(made) == comb(width, radius) and all(m.bit_count() == radius and m < 1 << width for m in made)
        assert seen.isdisjoint(made) and len(set(made)) == len(made)
        seen |= set(made)


def test_segments_of_more_than_half_a_list(spark, monkeypatch):
    """Wide segments across words of a code, their masks in two halves."""
    monkeypatch.setattr(topk, "LEAST_BITS", 9)
    monkeypatch.setattr(topk, "HALF_BITS", 5)
    dice = random.Random(1)
    rows = [(i, [dice.choice([-1.0, 1.0]) for _ in range(77)]) for i in range(60)]
    rows += [(100 + i, [x * (-1 if dice.random() < 0.1 else 1) for x in v]) for i, v in rows[:40]]
    df = spark.createDataFrame(rows, KIND)
    asked = df.where("vec_id % 30 = 0")
    got = topk.search(df, asked, "vec_id", "embedding", k=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, [r for r in rows if r[0] % 30 == 0], 2)
