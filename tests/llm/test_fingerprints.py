"""One-permutation MinHash against exact Jaccard similarities."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rulecheck.llm import fingerprints as f
from rulecheck.llm.common import document_key
from rulecheck.llm.kernels import text_buffer

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    ordered = sorted(rows, key=lambda r: -r[0])
    for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 3
        yield i, t, t[: len(t) - k] + n[:k], n


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in f.op2_fingerprints(spark, SF).collect()}
    prints, wrong = {}, []
    for i, text, changed, following in expected(docs):
        r = got.pop(i)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        wrong += [r.near_edited - jaccard(text, changed), r.near_next - jaccard(text, following)]
    assert not got
    assert np.abs(wrong).max() < 0.2 and np.std(wrong) < 0.03


def test_neighbours_meet_whatever_the_partitions(spark):
    dice = random.Random(3)
    rows = [(i, "".join(dice.choice("ab é\n") for _ in range(dice.randint(0, 40)))) for i in dice.sample(range(-500, 10_000), 60)] + [(20_000, None)]
    df = spark.createDataFrame([(i, t, "clash", False) for i, t in rows], "doc_id bigint, text string, part string, guest boolean").repartition(5)
    got = {r.doc_id: r.edited_sha256 for r in f.edited_documents(df).collect()}
    assert got == {i: hashlib.sha256(c.encode()).hexdigest() for i, _, c, _ in expected(rows)}


@pytest.mark.parametrize("hot", [None, 7, -(1 << 63), (1 << 60) + 1])
def test_an_id_of_a_third_of_all_rows_spreads_over_the_ranges(spark, hot):
    """The ranges stay even, and every row still meets the row after it, null ids last."""
    base = 0 if hot in (None, 7) else hot
    rows = [((hot if i % 3 == 0 else base + 10 * i), f"text {i} " + "ab" * (i % 5)) for i in range(3000)] + [(None, "x"), (None, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sizes = [r["count"] for r in f.neighbours(df, 8).where("NOT guest").groupBy("part").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    ordered = [(r.doc_id, r.text) for r in df.select("doc_id", "text", *document_key()).orderBy(F.col("_k").desc(), F.col("_h").desc()).collect()]
    want = [hashlib.sha256(f.edited(t, n).encode()).hexdigest() for (_, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1], strict=True)]
    got = [(r.doc_id, r.edited_sha256) for r in f.edited_documents(df).collect()]
    assert sorted(map(str, got)) == sorted(str((i, w)) for (i, _), w in zip(ordered, want, strict=True))
    ids = [i for i, _ in ordered]
    assert ids == sorted((i for i in ids if i is not None), reverse=True) + [i for i in ids if i is None]


def test_copies_with_one_id_are_guests_once_per_batch(spark):
    df = spark.createDataFrame([(9, "same")] * 600 + [(i, f"t{i}") for i in range(300)], "doc_id bigint, text string").repartition(3)
    dealt = f.neighbours(df, 6)
    assert dealt.where("guest").count() <= 3 * 6
    assert f.edited_documents(df).count() == 900


def test_odd_tables(spark):
    kind = "doc_id bigint, text string"
    assert f.edited_documents(spark.createDataFrame([], kind)).collect() == []
    (one,) = f.edited_documents(spark.createDataFrame([(5, "abcdef")], kind)).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    rows = f.edited_documents(spark.createDataFrame([(None, "x y"), (3, ""), (3, ""), (4, None)], kind)).collect()
    assert len(rows) == 4 and sum(r.doc_id is None for r in rows) == 1
    empty = [r for r in rows if r.doc_id == 3]
    assert empty[0].fingerprint == "" and {r.near_edited for r in empty} == {1.0}
    prints = f.fingerprint_documents(spark.createDataFrame([(1, "A b c"), (2, "a b  C"), (3, None)], kind)).collect()
    # letter case and white space between words do not count
    assert [r.fingerprint == prints[0].fingerprint for r in prints] == [True, True, False] and prints[2].fingerprint == ""


def test_densification_follows_the_probe_sequence():
    """The shortcut by first visits gives what probing one attempt after the other gives."""
    dice = np.random.default_rng(1)
    minima = np.full((40, f.BINS), f._EMPTY, np.uint64)
    for row in minima:
        row[dice.choice(f.BINS, dice.integers(1, 60), replace=False)] = dice.integers(1, 1 << 40)
    dense = f.densify(minima)
    for r in range(0, 40, 7):
        for b in range(0, f.BINS, 37):
            probe, at = 0, b
            while minima[r, at] == f._EMPTY:
                probe += 1
                at = int(f._sources(np.array([b]), probe)[0])
            assert dense[r, b] == minima[r, at]


def test_likeness_is_unbiased():
    dice, found = random.Random(9), []
    for _ in range(60):
        base = [str(dice.random()) for _ in range(300)]
        other = list(base)
        for k in dice.sample(range(300), 12):
            other[k] = str(dice.random())
        a, b = " ".join(base), " ".join(other)
        bits, filled = f.sketch(*text_buffer(pa.array([a, b])))
        found.append(f.likeness(bits[:1], filled[:1], bits[1:], filled[1:])[0] - jaccard(a, b))
    assert abs(np.mean(found)) < 0.012 and np.std(found) < 0.04
