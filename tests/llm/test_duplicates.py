"""Substring removal (4), Jaccard join (7) and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rulecheck.llm import jaccard, substrings
from rulecheck.llm.common import id_of
from rulecheck.llm.components import _labelled, components
from rulecheck.llm.packed import home_of

SF = "/root/testdata/sf0.001"


def removal(rows):
    """Kept words by row, straight from the rule; rows are (order key, text)."""
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: r[0]):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            key = tuple(w[p : p + 20])
            if key in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(key)
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def test_removal_query_matches_sql_and_brute_force(spark):
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.op4_substrings(spark, SF).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert got == [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for (i, _), (n, k, t) in zip(docs, removal(docs), strict=True)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.sql(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({substrings.OP4_SQL})").fetchall())


@pytest.mark.parametrize("seed", range(3))
def test_removal_of_overlapping_passages(spark, seed):
    """Few different words, so that repeats overlap, nest and repeat inside a text; many
    small partitions, so that they meet across blocks of input."""
    dice = random.Random(seed)
    passages = [[dice.choice("abcdefgh") + str(dice.randint(0, 9)) for _ in range(dice.randint(15, 60))] for _ in range(8)]
    texts = []
    for _ in range(60):
        w = []
        for _ in range(dice.randint(0, 6)):
            p = dice.choice(passages)
            a = dice.randint(0, len(p) - 1)
            w += p[a : a + dice.randint(1, 40)] + [str(dice.random())] * dice.randint(0, 2)
        texts.append(dice.choice([" ", "\n", "\t \x0b"]).join(w))
    texts += ["z " * 200, "z " * 50, None, "", "one"]
    rows = [(i * 7 - 100, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id bigint, text string, at string, _k int").repartition(6)
    got = sorted((r._rest.doc_id, (r.n_words, r.n_removed, r.text)) for r in substrings.remove_repeats(df).collect())
    assert [g for _, g in got] == removal(rows)


def test_removal_of_odd_tables(spark):
    kind = "doc_id bigint, text string"
    assert substrings.remove_repeats(spark.createDataFrame([], kind)).collect() == []
    long = " ".join(str(i) for i in range(30))
    # null ids come first; the same row twice is one document, there twice
    df = spark.createDataFrame([(None, long), (1, long), (1, long), (2, "a  b")], kind)
    got = sorted((r._rest.doc_id or 0, r.n_removed, r.text) for r in substrings.remove_repeats(df).collect())
    assert got == [(0, 0, long), (1, 30, ""), (1, 30, ""), (2, 0, "a b")]
    same = spark.createDataFrame([(5, long), (5, long)], kind)
    assert [r.n_removed for r in substrings.remove_repeats(same).collect()] == [0, 0]
    as_is = {r._rest.doc_id: r.text for r in substrings.remove_repeats(spark.createDataFrame([(2, "a  b"), (3, None)], kind), as_is=True).collect()}
    assert as_is == {2: "a  b", 3: ""}


def test_spans_cover_runs_of_windows():
    assert substrings.spans(np.array([5, 6, 7]), 20) == [(5, 27)]
    assert substrings.spans(np.array([0, 20, 41, 41]), 20) == [(0, 40), (41, 61)]


def word_set(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in (text or "").encode().split()]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def joined(rows):
    """(set size, smallest id of the component) by row, from all pairs that share a shingle."""
    rows = sorted(rows, key=lambda r: r[0])
    sets, holders, root = [word_set(t) for _, t in rows], defaultdict(list), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for t in s for j in holders[t]).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for t in s:
            holders[t].append(i)
    return [(len(s), rows[find(i)][0]) for i, s in enumerate(sets)]


def test_join_query_matches_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op7_jaccard(spark, SF).collect())
    assert got == [(i, n, c) for (i, _), (n, c) in zip(docs, joined(docs), strict=True)]


@pytest.mark.parametrize("seed", range(2))
def test_join_of_families_around_the_threshold(spark, seed, monkeypatch):
    """Copies with a few words changed, near the threshold on both sides; passages that
    many families share; sets of very different sizes; groups salted into small parts."""
    dice = random.Random(seed)
    word = lambda: str(dice.randint(0, 10**9))
    shared = [[word() for _ in range(25)] for _ in range(3)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(dice.choice([8, 30, 60, 120]))] + dice.choice(shared) * dice.randint(0, 1)
        for _ in range(dice.randint(1, 14)):
            w = list(base)
            for _ in range(dice.randint(0, max(1, len(w) // 40))):
                w[dice.randrange(len(w))] = word()
            w = w[: len(w) - dice.randint(0, len(w) // 6)]
            rows.append((len(rows) * 3 + 10, " ".join(w)))
    rows += [(1, None), (2, ""), (3, "Only Four WORDS here"), (4, "only four words HERE"), (5, " \n")]
    monkeypatch.setattr(jaccard, "GROUP_TOKENS", 600)
    monkeypatch.setattr(jaccard, "QUERIES_PER_TASK", 2)
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id bigint, text string, n int, tokens string").repartition(4)
    found = sorted((r._k, (r.n, r.first_k)) for r in jaccard.jaccard_components(df).collect())
    assert [f for _, f in found] == joined(rows)
    kept = jaccard.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in joined(rows)})


def test_join_without_token_marks(spark, monkeypatch):
    """A token that one block of input calls frequent keeps one place in the order everywhere."""
    text = " ".join(str(i) for i in range(40))
    rows = [(i, text + f" tail{i}") for i in range(30)] + [(100 + i, f"head{i} " + text) for i in range(3)]
    monkeypatch.setattr(jaccard, "INPUT_BYTES", 1500)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert {r.first_k for r in jaccard.jaccard_components(df).collect()} == {0}


def test_join_of_odd_tables(spark):
    kind = "doc_id bigint, text string"
    assert jaccard.jaccard_components(spark.createDataFrame([], kind)).collect() == []
    df = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b"), (8, ""), (8, "")], kind)
    assert sorted((r._k, r.n, r.first_k) for r in jaccard.jaccard_components(df).collect()) == sorted(
        [(jaccard.NO_ID, 1, jaccard.NO_ID), (7, 1, jaccard.NO_ID), (7, 1, jaccard.NO_ID), (8, 0, 8), (8, 0, 8)]
    )
    # one copy stays of rows with words; empty texts are linked with nothing
    assert sorted(((r.doc_id or 0), r.text) for r in jaccard.keep_first(df).collect()) == [(0, "a b"), (8, ""), (8, "")]


def colliding():
    """Texts of equal 32-bit hash (``F.hash``); the first repeats 25 of its words, the other none."""
    p, q = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 25), ("q", 60)))
    return f"{p} {p} a6064", f"{q} b257127"


def test_removal_keeps_texts_of_one_id_apart_whose_short_hashes_collide(spark):
    a, b = colliding()
    df = spark.createDataFrame([(None, a), (None, b), (5, a), (5, b)], "doc_id bigint, text string")
    assert df.selectExpr("hash(text) AS h").distinct().count() == 1
    first = substrings.remove_repeats(df.where("doc_id IS NULL")).collect()
    assert sorted((r.n_words, r.n_removed) for r in first) == [(51, 25), (61, 0)]
    assert b in [r.text for r in first]


def test_join_keeps_texts_of_one_id_apart_whose_short_hashes_collide(spark):
    texts = colliding()
    for doc_id in (None, 5):
        df = spark.createDataFrame([(doc_id, t) for t in texts], "doc_id bigint, text string")
        assert sorted(r.text for r in jaccard.keep_first(df).collect()) == sorted(texts)
        assert sorted(r.n for r in jaccard.jaccard_components(df).collect()) == sorted(len(word_set(t)) for t in texts)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 150)]
    star = [(5, i) for i in range(300, 400)]
    found = {r.node: r.label for r in components(spark.createDataFrame([*chain, *star, (9, 9), (150, 100)], "a bigint, b bigint")).collect()}
    assert found == {i: 100 for i in range(100, 151)} | {5: 5, 9: 9} | {i: 5 for i in range(300, 400)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_rounds_grow_with_the_logarithm_of_a_chain(spark):
    down = [(0, 1000)] + [(k, k - 1) for k in range(2, 1001)]
    labels, rounds = _labelled(spark.createDataFrame(down, "a bigint, b bigint"))
    assert {r.label for r in labels.collect()} == {0} and labels.count() == 1001
    assert rounds <= 15


def batch_of(texts):
    df = pa.table({"_k": pa.array(range(len(texts)), pa.int64()), "_h": pa.array([7] * len(texts), pa.int64()), "text": texts})
    return df.combine_chunks().to_batches()


def test_a_passage_in_all_documents_fills_no_bucket_and_no_home():
    """Bytes that a bucket and a home get stay near the median, though all documents share a passage."""
    dice = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"w{dice.randrange(10**9)}" for _ in range(40)) for _ in range(8_000)]
    for rows in (substrings._index_and_probes(8, iter(batch_of(texts))), jaccard._facts(8, iter(batch_of(texts)))):
        size = Counter()
        for b in rows:
            for r in b.to_pylist():
                size[r["bucket"]] += sum(len(x) for c, x in r.items() if c != "bucket" and x is not None)
        assert len(size) == 8 and max(size.values()) <= 3 * np.median(list(size.values()))


def test_homes_of_documents_without_id(spark):
    df = spark.range(9_000).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS doc_id", "'text ' || id AS text")
    rows = jaccard.keyed(df).select("_k", "_h").toPandas()
    at = home_of(rows["_k"].to_numpy(), rows["_h"].to_numpy(), 8)
    counts = np.bincount(at, minlength=8)
    assert counts.max() <= 2 * np.median(counts)


def test_smallest_id_is_not_taken_for_none(spark):
    text = " ".join(str(i) for i in range(30))
    least = -(1 << 63)
    rows = [(None, text), (least, text), (3, "other " * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in named(jaccard.jaccard_components(df)).collect()), key=str)
    assert found == sorted([(None, 26, None), (least, 26, None), (3, 1, 3)], key=str)
    kept = jaccard.keep_first(df).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(3, "other " * 3)] and len(kept) == 2
    removed = {r._rest.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()}
    assert removed == {None: 0, least: 30, 3: 0}
    apart = spark.createDataFrame([(least, text), (5, text + " x")], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in named(jaccard.jaccard_components(apart)).collect()} == {(least, least), (5, least)}


def named(found):
    return found.select(id_of("_k", "_h").alias("doc_id"), F.col("n").alias("n_shingles"), id_of("first_k", "first_h").alias("component_id"))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_where_most_tokens_are_shared_by_very_many(spark, seed):
    """Sets of mostly frequent tokens, below and above the threshold with each other: the salted rows of the matrix."""
    dice = random.Random(seed)
    common = [f"c{i}" for i in range(44)]
    texts = []
    for i in range(420):
        own = [f"o{seed}x{i}x{j}" for j in range(dice.choice([6, 9, 12]))]
        texts.append(common + own)
        if i % 6 == 0:  # a partner that shares most of its own words as well
            texts.append(common + own[:-1] + [f"y{i}"])
        if i % 50 == 0:
            texts.append(common[: dice.choice([20, 40])])
    texts = [" ".join(t) for t in texts]
    sets = [word_set(t) for t in texts]
    parent = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = parent[i], parent[j]
                parent = [min(a, b) if x in (a, b) else x for x in parent]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r._k: r.first_k for r in jaccard.jaccard_components(df).collect()}
    assert 20 < len(set(parent)) < len(parent) and got == dict(enumerate(parent))
