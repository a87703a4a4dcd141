"""Vector codes against a plain version of the same rounds, and DuckDB."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np

from rulecheck.llm import vector_codes
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
KIND = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = [[] for _ in book]
            for _, v, _ in kept:
                mine[near(book, cut(v, p))[1]].append(cut(v, p))
            books[p] = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for c, m in zip(book, mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = []
    for i, v, y in kept:
        found = [near(book, cut(v, p)) for p, book in enumerate(books)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), y))
    total = {y: sum(r[2] for r in out if r[3] == y) for y in {r[3] for r in out}}
    return sorted(((i, code, error, total[y], sha) for i, code, error, y in out), key=str)


def codes(spark, rows, kind=KIND, extra=()):
    df = spark.createDataFrame([(*r, *extra) for r in rows], kind).repartition(3)
    vectors = vector_codes.usable(df, "vec_id", "embedding", F.col("label"))
    books, length = vector_codes.fit(vectors)
    out = vector_codes.with_label_errors(vector_codes.encode(vectors, books, length))
    sha = vector_codes.digest(books)
    return sorted(((r["id"], r["code"], r["error"], r["label_error"], sha) for r in out.collect()), key=str)


def test_query_matches_sql(spark):
    found = vector_codes.op13_codes(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    wanted = con.sql(vector_codes.OP13_SQL)
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall())


def test_ties_repeats_nulls_and_clashing_columns(spark):
    dice = random.Random(3)
    rows = [(i, [dice.choice([-0.5, -0.0001, 0.0, 0.25, 1.0]) for _ in range(16)], dice.choice([None, 1, 2])) for i in range(70)]
    rows += [rows[5], (None, rows[6][1], None), (900, None, 1), (901, [float("nan")] + [0.0] * 15, 1), (902, [float("-inf")] * 16, 1), (903, [None] + [0.0] * 15, 2)]
    assert codes(spark, rows, KIND + ", code string, salt int", ("clash", 1)) == brute(rows)


def test_components_beyond_64_bit_squares(spark):
    dice = random.Random(4)
    rows = [(i, [dice.choice([-1.0, 1.0, 1e9, -3e9, 2e14]) * dice.random() for _ in range(8)], 0) for i in range(40)]
    wanted = [(i, c, e if e < 1 << 63 else None, sha) for i, c, e, _, sha in brute(rows)]
    assert [(i, c, e, sha) for i, c, e, _, sha in codes(spark, rows)] == wanted


def test_other_lengths_few_rows_and_empty_tables(spark):
    rows = [(i, [float(i)] * 8, 1) for i in range(5)]
    odd = [(10, [1.0] * 9, 1), (11, [], 2), (12, [3e38] * 8, 3)]
    found = codes(spark, rows + odd)
    assert [r for r in found if r[1] is not None] == brute(rows)
    assert [(r[0], r[2]) for r in found if r[1] is None] == [(10, None), (11, None), (12, None)]
    assert codes(spark, [(11, [], 2)]) == [(11, "0" * 16, 0, 0, hashlib.sha256(b"").hexdigest())]
    assert codes(spark, []) == [] and codes(spark, [(1, None, 1)]) == []


def test_masks_hold_exactly_the_box():
    dice = np.random.default_rng(5)
    book = vector_codes.Codebook(dice.integers(-9, 9, (64, 5)))
    x, radius = dice.integers(-12, 12, (200, 5)), dice.integers(0, 9, 200)
    mask = book.box(x, radius)
    inside = (abs(x[:, None, :] - book.entries) <= radius[:, None, None]).all(axis=2)
    assert [[bool(m >> e & 1) for e in range(64)] for m in mask.tolist()] == inside.tolist()
    away = ((x[:, None, :] - book.entries) ** 2).sum(axis=2)
    entry, error = book.nearest(x)
    assert entry.tolist() == away.argmin(axis=1).tolist() and error.tolist() == away.min(axis=1).tolist()
