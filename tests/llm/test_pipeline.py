"""The corpus pipeline: every stage's decisions against brute force on its own input."""

from __future__ import annotations

import random

import corpus_pipeline as p
import public_tokenizers
import pytest
import test_duplicates as duplicates
from tokenizers import Tokenizer

from rulecheck.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "language_id", "ngram_jaccard_join", "substring_dedup", "packing"]
    for name, step in p.STAGES:
        docs = stage(step(spark, docs, SF), name)
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "quality_classifier":
            known = [(labels[i], i in after) for i in rows if i in labels]
            assert sum(bool(q) == kept for q, kept in known) >= 0.95 * len(known)
        if name == "language_id":
            assert set(after) <= set(rows) and len(after) >= 0.98 * len(rows)
        if name == "ngram_jaccard_join":
            ordered = sorted((i, r.text) for i, r in rows.items())
            assert set(after) == {i for (i, _), (_, c) in zip(ordered, duplicates.joined(ordered), strict=True) if c == i}
        if name == "substring_dedup":
            ordered = sorted((i, r.text) for i, r in rows.items())
            for (i, text), (_, gone, kept) in zip(ordered, duplicates.removal(ordered), strict=True):
                assert after[i].text == (kept if gone else text) and after[i].n_chars == len(after[i].text)
        else:
            assert all(rows[i] == r for i, r in after.items())
        rows = after
    lib, total = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    for r in docs.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(lib.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows.items()}


def test_registered():
    import __spark_entry__ as e

    names = e.queries()
    assert names["pipeline"] is p.run and "pipeline" not in e.oracle_sql()
    assert [n for n in names if n.startswith("op")] == [
        "op1_chat", "op2_fingerprints", "op3_quality", "op4_substrings", "op5_topk", "op6_language", "op7_jaccard", "op8_warc", "op9_packing", "op10_encoding",
        "op11_prefixes", "op12_main_text", "op13_codes",
    ]


WORDS = "the house on a hill was old and its doors were never shut since people came at any hour to ask what they wanted most".split()


def odd_rows(spark):
    """Rows with nulls, empty and very long texts, repeats, ties of ids and clashing columns."""
    dice = random.Random(5)
    texts = [" ".join(dice.choice(WORDS) for _ in range(60)) for _ in range(12)]
    rows = [(i, "a", t, "en") for i, t in enumerate(texts)]
    rows += [(None, None, " ".join(dice.choice(WORDS) for _ in range(50)), None), (20, "a", None, "en"), (21, "a", "", "en"), (21, "a", "", "en"), (22, "a", " .,\n 12 ", "en")]
    rows += [(3, "b", texts[0] + " indeed", "en"), (30, "a", texts[4] + " so", "en"), (31, "b", texts[5], None), (31, "b", texts[5], None)]
    rows += [(40, "c", " ".join(dice.choice(WORDS) for _ in range(60_000)), "en"), (41, "c", "  two\t\tblanks  stay here ", "en")]
    full = [(*r, None if r[2] is None else len(r[2]), 7, "clash", 0.5, i) for i, r in enumerate(rows)]
    return rows, spark.createDataFrame(full, "doc_id bigint, source string, text string, lang string, n_chars bigint, _k int, words string, score double, row int").repartition(3)


@pytest.fixture
def odd_folder(spark, tmp_path):
    spark.createDataFrame([(0, 1), (1, 0), (2, 1), (None, 1), (4, None), (99, 0)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_odd_rows_in_every_stage(spark, odd_folder):
    rows, docs = odd_rows(spark)
    by_stage = {}
    for name, step in p.STAGES[:-1]:
        out = step(spark, docs, odd_folder)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        by_stage[name] = {r.row: r for r in out.collect()}
        whole = {r.row: r for r in docs.collect()}
        if name != "substring_dedup":
            assert all(whole[i] == r for i, r in by_stage[name].items())
    scored = by_stage["quality_classifier"]
    assert len({i in scored for i, r in enumerate(rows) if not r[2]}) == 1  # null and empty texts alike
    spoken = by_stage["language_id"]
    assert {i for i in range(len(rows)) if i not in spoken} == {i for i, r in enumerate(rows) if not any(c.isalpha() for c in r[2] or "")}
    kept = by_stage["ngram_jaccard_join"]
    wordless = {i for i, r in enumerate(rows) if not (r[2] or "").split()}
    assert wordless <= set(kept)
    gone = [rows[i][:2] for i in range(len(rows)) if i not in kept]
    assert sorted(gone) == [(3, "b"), (30, "a"), (31, "b"), (31, "b")]
    left = by_stage["substring_dedup"]
    assert set(left) == set(range(len(rows)))
    for i, r in enumerate(rows):
        assert (left[i].text is None) == (r[2] is None) and left[i].n_chars == (None if r[2] is None else len(left[i].text))
    assert left[len(rows) - 1].text == rows[-1][2]
    last = {i: r[2] for i, r in enumerate(rows) if r[:2] in [(3, "b"), (30, "a"), (31, "b")]}
    assert all(left[i].text.split() == t.split()[60:] for i, t in last.items())
    pieces = p.pack(spark, docs, odd_folder).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(x.length for x in pieces) == sum(len(lib.encode(r[2] or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(x.doc_id is None for x in pieces) >= 1


def test_empty_table_in_every_stage(spark, odd_folder):
    _, docs = odd_rows(spark)
    empty = docs.where("false")
    for name, step in p.STAGES:
        out = step(spark, empty, odd_folder)
        assert out.collect() == []
        if name != "packing":
            assert out.columns == docs.columns
