"""Encoding and decoding with a word-level byte-pair vocabulary.

The words of all documents are counted by Spark; the most frequent ones (at
most ``lexicon_words``) are merged once, compiled into a minimal acyclic
transducer with id outputs and handed to the executors as a file that each
Python worker memory-maps. Words the transducer accepts get their ids from it;
unseen words are merged exactly by rank. Ids equal those of the published
implementation.

A text is cut at single spaces (no later step joins across one) and each
distinct run is normalised, split and encoded once per worker, from a bounded
cache. Runs that hold a special token's text are given to the published
implementation.

Cases: null and empty texts have no ids and decode to the empty text; null
``doc_id`` and repeated rows are kept; an empty table gives no rows (the
transducer is then empty); extra columns are ignored; a text or word of any
length is encoded whole.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast, SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rulecheck.llm.bpe import BpeModel, encode_words, load_model
from rulecheck.llm.common import documents, kept_in_worker, ship_package, stage
from rulecheck.llm.lexicon import Lexicon, build

LEXICON_WORDS = 50_000
CACHE_RUNS = 1_000_000
COUNT_WORDS = 200_000
BATCH_CHARS = 1 << 20
LATIN_END = "\u0250"
# Fixed value: the split pattern stated in the vocabulary file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = regex.compile(SPLIT)
_BEYOND_LATIN = re.compile(f"[^\\x00-{chr(ord(LATIN_END) - 1)}]")


def split_words(library: Tokenizer, run: str) -> list[str]:
    """Words of a run without special tokens, by the tokenizer's own normaliser and
    splitter, whose tables may be older than Python's."""
    text = library.normalizer.normalize_str(run)
    return [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def split_runs(library: Tokenizer, runs: list[str]) -> list[list[str]]:
    """Words of each run; the runs hold no space and no special token.

    Below LATIN_END no character composes with another and letters are the same in
    every Unicode version, so lower case is all there is to do, for all runs at once.
    """
    joined = " ".join(runs)
    if _BEYOND_LATIN.search(joined):
        plain = iter(split_runs(library, [r for r in runs if not _BEYOND_LATIN.search(r)]))
        return [split_words(library, r) if _BEYOND_LATIN.search(r) else next(plain) for r in runs]
    words = _SPLIT.findall
    return [[r] if r.isalpha() else words(r) for r in joined.lower().split(" ")] if runs else []


def holds_special(special: list[str], runs: list[str]) -> set[str]:
    """The runs that hold a special token's text; all are searched at once first."""
    joined = " ".join(runs)
    found = [t for t in special if t in joined]
    return {r for r in runs if any(t in r for t in found)} if found else set()


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS or i + 1 == len(texts):
            yield lo, i + 1
            lo, size = i + 1, 0


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes."""

    def __init__(self, model: BpeModel, lexicon: Lexicon, cache_runs: int = CACHE_RUNS):
        self.model, self.lexicon, self.most = model, lexicon, cache_runs
        self.runs: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.runs) + len(self.words) > self.most:
            self.runs, self.words = {"": b""}, {}
        cut = [t.split(" ") if t else [] for t in texts]
        self._learn(set().union(*cut).difference(self.runs))
        return [b"".join(map(self.runs.__getitem__, c)) for c in cut]

    def _learn(self, runs: set[str]) -> None:
        marked = holds_special(self.model.special, list(runs))
        for r in marked:
            self.runs[r] = np.array(self.model.library.encode(r, add_special_tokens=False).ids, "<u4").tobytes()
        plain = list(runs.difference(marked))
        parts = split_runs(self.model.library, plain)
        new = list(set(chain.from_iterable(parts)).difference(self.words))
        if new:
            coded = [w.encode() for w in new]
            known = self.lexicon.lookup(coded)
            self.words.update((w, k) for w, k in zip(new, known, strict=True) if k is not None)
            unseen = [i for i, k in enumerate(known) if k is None]
            if unseen:
                ids, at = encode_words(self.model, [coded[i] for i in unseen])
                blob, ends = ids.astype("<u4").tobytes(), (at * 4).tolist()
                self.words.update((new[i], blob[a:b]) for i, a, b in zip(unseen, ends, ends[1:], strict=False))
        ids_of = self.words.__getitem__
        self.runs.update(zip(plain, [ids_of(p[0]) if len(p) == 1 else b"".join(map(ids_of, p)) for p in parts], strict=True))


def word_counts(docs: DataFrame, shared: Broadcast[BpeModel]) -> DataFrame:
    """Words of all texts with their counts (``word``, ``n``), summed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        model = shared.value

        def flush() -> pa.RecordBatch:
            total: dict[str, int] = {}
            for r in holds_special(model.special, list(seen)):
                del seen[r]
            for words, n in zip(split_runs(model.library, list(seen)), seen.values(), strict=True):
                for w in words:
                    total[w] = total.get(w, 0) + n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(text.split(" "))
                if len(seen) > COUNT_WORDS:
                    yield flush()
        yield flush()

    parts = documents(docs, "text").mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[str]:
    """The most frequent words, at most ``most``: all words above the lowest count
    class (eighths of a power of two) at which they still fit."""
    level = F.floor(F.log2("n") * 8).cast("int")
    classes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for c in classes:
        total += c["words"]
        if total > most:
            break
        least = c["level"]
    return [] if least is None else [r["word"] for r in counts.where(level >= least).select("word").collect()]


def compile_lexicon(docs: DataFrame, shared: Broadcast[BpeModel], lexicon_words: int = LEXICON_WORDS) -> np.ndarray:
    """Transducer of the corpus's frequent words."""
    counts, model = stage(word_counts(docs, shared), "word-counts"), shared.value
    words = [w.encode() for w in frequent_words(counts, lexicon_words)]
    ids, at = encode_words(model, words) if words else (np.zeros(0, np.int32), np.zeros(1, np.int64))
    return build(words, ids, at)


def encode_documents(docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id``, ``ids`` (array of token ids) and ``decoded`` (the text decoded
    from those ids, special tokens kept) of every document."""
    sc = ship_package(docs.sparkSession).sparkContext
    name = f"lexicon-{uuid.uuid4().hex[:12]}.npy"
    scratch = tempfile.mkdtemp(prefix="rulecheck-lexicon-")  # the driver serves the file while the application runs
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    path = os.path.join(scratch, name)
    shared = sc.broadcast(load_model(tokenizer_path))
    np.save(path, compile_lexicon(docs, shared, lexicon_words))
    sc.addFile(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(name, lambda: WordEncoder(shared.value, Lexicon.open(SparkFiles.get(name))))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _blocks(texts):
                coded = encoder.encode(texts[lo:hi])
                flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                decoded = [decode(shared.value, flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return documents(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def decode(model: BpeModel, ids: np.ndarray) -> str:
    """Text of ids; the vocabulary file names no decoder, so tokens are joined by spaces."""
    return " ".join(map(model.pieces.__getitem__, ids.tolist()))


def digest_columns(encoded: DataFrame) -> DataFrame:
    """The query's columns: ids and decoded text as digests."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ids and decoded texts of all documents, as digests."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest_columns(encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")))
