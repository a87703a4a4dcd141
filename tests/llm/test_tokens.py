"""Packing (9) and encoding (10) against the tokenizers library."""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rulecheck.llm import encoding, packing
from rulecheck.llm.bpe import encode_words, load_model
from rulecheck.llm.lexicon import Lexicon, build

SF = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SIGNS = list("aAbtThe the İßΣσςéÉ̈\x1c\x1d\x85\xa0 \t\n  '<>|123²½ǅK中文한국!?.,-_​\U0001f600ﬁ") + ["<|endoftext|>", "<|startoftext|>", "  ", "the", "'S", "'ll", "ab" * 250]
ODD = [None, "", " ", "\n", "<|endoftext|>", " a", "a ", "a  b", "x" * 5000, "the " * 5000]


def texts(n=1500):
    dice = random.Random(5)
    return ["".join(dice.choice(SIGNS) for _ in range(dice.randint(0, 30))) for _ in range(n)]


def test_byte_level_ids_equal_the_library():
    lib, own = Tokenizer.from_file(BYTES), packing.ByteLevelEncoder(load_model(BYTES), cache_words=300)
    for block in np.array_split(np.array(texts() + [t or "" for t in ODD], object), 40):
        for t, ids in zip(block, own.encode(list(block)), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_distinct_pieces_are_merged_once(monkeypatch):
    lib, model, merged = Tokenizer.from_file(BYTES), load_model(BYTES), []
    monkeypatch.setattr(packing, "encode_words", lambda m, words: (merged.extend(words), encode_words(m, words))[1])
    own = packing.ByteLevelEncoder(model)
    block = ["a word*** word%%% word.\nWord word, 1word é", " word é***", "", "word 'word' word  word"]
    for t, ids in zip(block * 2, own.encode(block) + own.encode(block), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
    assert len(merged) == len(set(merged))


def test_every_code_point_is_split_as_the_library_does():
    lib, own = Tokenizer.from_file(BYTES), packing.ByteLevelEncoder(load_model(BYTES))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b1{c}2!{c}?" for c in points[:0x3000]] + [f"a{a}b1{b}2!{c}? {a}" for a, b, c in zip(points[::3], points[1::3], points[2::3], strict=False)]
    for k in range(0, len(texts), 20000):
        block = texts[k : k + 20000]
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(block)]
        assert [t for t, g, e in zip(block, got, lib.encode_batch(block, add_special_tokens=False), strict=True) if g != e.ids] == []


def test_apostrophes_and_white_space_are_split_as_the_library_does():
    dice, signs = random.Random(9), [*"aAstrevmld1!' \n\t", "'", "'", " ", "'s", "'re", "'ll", "'S", " '", "é", "\xa0", "<|endoftext|>"]
    lib, own = Tokenizer.from_file(BYTES), packing.ByteLevelEncoder(load_model(BYTES), cache_words=300)
    for k in range(20):
        block = ["".join(dice.choice(signs) for _ in range(dice.randint(0, 12))) for _ in range(500)]
        block = [t.encode("ascii", "ignore").decode() for t in block] if k % 2 else block
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(block)]
        assert [t for t, g, e in zip(block, got, lib.encode_batch(block, add_special_tokens=False), strict=True) if g != e.ids] == []


def test_buffers_and_blocks_cover_all_documents_within_their_bounds():
    dice = random.Random(2)
    sizes = [dice.choice([0, 10, 5000, 300_000, 3_000_000]) if i % 7 else 0 for i in range(5000)]
    buffers = list(packing._buffers(sizes))
    assert [b for block in packing._blocks(buffers, sizes) for b in block] == buffers
    assert [i for a, b in buffers for i in range(a, b)] == list(range(len(sizes)))
    for a, b in buffers:
        assert b - a <= 1024 and (b - a == 1 or sum(sizes[a : b - 1]) < packing.BUFFER_TOKENS * 4)
    for block in packing._blocks(buffers, sizes):
        assert len(block) == 1 or sum(sizes[block[0][0] : block[-1][0]]) < packing.BLOCK_BYTES
    assert list(packing._blocks(packing._buffers([]), [])) == []


@pytest.mark.parametrize("known", [[], ["the", "then", "other", "é", "aa"]])
def test_word_ids_equal_the_library(known):
    lib, model = Tokenizer.from_file(WORDS), load_model(WORDS)
    words = [w.encode() for w in known]
    ids, at = encode_words(model, words) if words else (np.zeros(0, int), np.zeros(1, int))
    own = encoding.WordEncoder(model, Lexicon(build(words, ids, at)), cache_runs=300)
    for block in np.array_split(np.array(texts() + ODD, object), 40):
        for t, got in zip(block, own.encode(list(block)), strict=True):
            got = np.frombuffer(got, "<u4")
            want = lib.encode(t or "", add_special_tokens=False).ids
            assert got.tolist() == want, t
            assert encoding.decode(model, got) == lib.decode(want, skip_special_tokens=False)


def test_transducer_is_minimal_and_exact(tmp_path):
    words = [w.encode() for w in ("talked", "walked", "talking", "walking", "t", "talk")]
    ids, at = np.arange(12), np.arange(0, 13, 2)
    np.save(tmp_path / "x.npy", build(words, ids, at))
    lexicon = Lexicon.open(str(tmp_path / "x.npy"))
    assert [np.frombuffer(x, "<u4").tolist() for x in lexicon.lookup(words)] == [[2 * i, 2 * i + 1] for i in range(6)]
    assert lexicon.lookup([b"", b"walk", b"talke", b"talkeds", b"x"]) == [None] * 5
    # walk- and talk- share their endings; only the state behind "talk" differs by being final
    assert lexicon.states < sum(len(w) for w in words) / 2
    assert Lexicon(build([], np.zeros(0, int), np.zeros(1, int))).lookup([b"", b"a"]) == [None, None]


def test_encoding_query(spark):
    import hashlib

    lib = Tokenizer.from_file(WORDS)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = encoding.op10_encoding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = lib.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encoding_of_odd_rows(spark):
    lib = Tokenizer.from_file(WORDS)
    rows = [(i, t, "x", [1]) for i, t in enumerate(ODD)] + [(None, "the", "x", [1]), (0, None, "x", [1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, ids array<int>")
    got = sorted((r.doc_id or -1, r.ids, r.decoded) for r in encoding.encode_documents(df, WORDS).collect())
    want = [lib.encode(t or "", add_special_tokens=False).ids for _, t, *_ in rows]
    assert got == sorted((i or -1, w, lib.decode(w, skip_special_tokens=False)) for (i, *_), w in zip(rows, want, strict=True))
    assert encoding.encode_documents(df.where("false"), WORDS).collect() == []


def test_frequent_words_are_bounded(spark):
    df = spark.createDataFrame([(f"w{i}", 1 << (i % 9)) for i in range(90)], "word string, n bigint")
    kept = encoding.frequent_words(df, 35)
    assert sorted(kept) == sorted(f"w{i}" for i in range(90) if i % 9 >= 6)
    assert encoding.frequent_words(df, 5) == []


def check_pieces(rows, docs, lib):
    """Every id in exactly one piece; sequences gapless and full but for one per task."""
    want = {k: np.array([[*lib.encode(t or "", add_special_tokens=False).ids, 0] for t in ts], object) for k, ts in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for k, ids in want.items():
        assert sum(r.length for r in pieces[k]) == sum(map(len, ids))
        if len(ids) == 1:
            at = 0
            for r in sorted(pieces[k], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids[0])
                assert zlib.crc32(np.array(ids[0][at : at + r.length], "<u4").tobytes()) == r.ids_crc32
                at += r.length
    open_ended = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and {r.sequence_length for r in s} == {at if at & (at - 1) == 0 else 1024}
        assert len({r.step_group for r in s}) == 1
        open_ended += at & (at - 1) != 0
    return open_ended


def test_packing_query(spark):
    docs = {r.doc_id: [r.text] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = packing.op9_packing(spark, SF).collect()
    assert set(r.doc_id for r in rows) == set(docs)
    assert check_pieces(rows, docs, Tokenizer.from_file(BYTES)) <= 1
    steps = defaultdict(int)
    for r in rows:
        steps[r.step_group] += r.length
    loads = sorted(steps.values())
    assert loads[len(loads) // 2] >= 0.9 * packing.STEP_TOKENS


def test_packing_of_odd_rows(spark):
    docs = {i: [t] for i, t in enumerate(ODD)} | {None: ["a b"], 77: ["twice", "twice"]}
    rows = [(k, t, "clash", 1) for k, ts in docs.items() for t in ts]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, sequence_id string, offset int").coalesce(1)
    got = packing.digest_columns(packing.pack_documents(df, BYTES)).collect()
    assert check_pieces(got, docs, Tokenizer.from_file(BYTES)) <= 1
    assert packing.pack_documents(df.where("false"), BYTES).collect() == []
    with pytest.raises(ValueError, match="powers of two"):
        packing.pack_documents(df, BYTES, tiers=(1000,))


def test_every_mark_next_to_others_is_normalised_as_the_library_does():
    """Python's Unicode tables may be newer than the library's."""
    model = load_model(WORDS)
    lib = Tokenizer.from_file(WORDS)
    marks = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) in ("Mn", "Mc", "Me")]
    texts = [f"a{m}{o}b" for m in marks for o in "\u0301\u0327"] + [f"a{o}{m} \u00c9{m}" for m in marks for o in "\u0301\u0327"]
    texts += ["\u1c89\u0411", "x\u1c89y", "\u0130stanbul \u0130\u0307", "\u03a3\u03a3", "\u00aa\u0149\u01c5 \u024f\u0250", "e\u0301\u00e9"]
    own = encoding.WordEncoder(model, Lexicon(build([], np.zeros(0, np.int32), np.zeros(1, np.int64))))
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
    assert [t for t, g, e in zip(texts, got, lib.encode_batch(texts, add_special_tokens=False), strict=True) if g != e.ids] == []


def test_all_latin_pairs_take_the_short_way_rightly():
    model = load_model(WORDS)
    lib = Tokenizer.from_file(WORDS)
    low = [chr(c) for c in range(1, 0x250) if chr(c) != " "]
    texts = [f"{a}{b}" for a in low for b in low[::7]] + [f"x{a}" for a in low]
    own = encoding.WordEncoder(model, Lexicon(build([], np.zeros(0, np.int32), np.zeros(1, np.int64))))
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
    assert [t for t, g, e in zip(texts, got, lib.encode_batch(texts, add_special_tokens=False), strict=True) if g != e.ids] == []
