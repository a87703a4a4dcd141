"""Language identification with string kernels.

A text is the set of its byte n-grams (one to four bytes, A-Z folded,
digits as one sign): the blended-spectrum presence kernel of
two texts is the share of n-grams they have in common, |x & y| / sqrt(|x| |y|).
N-grams are hashed to ``COLUMNS`` columns. ``LANDMARKS`` texts span a Nyström
approximation: kernel rows against the landmarks, whitened by the landmarks' own
kernel matrix, are the inputs of a one-versus-rest kernel ridge regression.

The landmarks, the whitening and the ridge weights fold into one matrix of
columns x languages, so scoring is a batched matrix product of presence rows
with that matrix, divided by each text's norm. The model's size is fixed.

Training uses at most ``SAMPLE_ROWS`` texts: per language, an equal share of those of
smallest hash of ``doc_id`` and text among different rows, so a repeated ``doc_id`` or
row counts no more than it holds texts; the first of them are the landmarks. Of more
than LANDMARKS languages, the most frequent ones are learned. The texts'  kernel rows are computed by the executors, which return sums
of products (landmarks x landmarks), not rows. Every text is predicted whole.

Cases: null texts and texts without a letter get ``und`` and score 0; rows with
null ``doc_id`` or null language never train; repeated rows are predicted once
each; with nothing to learn from every text is ``und``; an empty table gives no
rows; extra columns are ignored, clashing names too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecheck.llm.common import ship_package, stage
from rulecheck.llm.kernels import slices, text_buffer

COLUMNS = 1 << 15
SPECTRUM = (1, 2, 3, 4)
LANDMARKS, SAMPLE_ROWS, RIDGE = 256, 6_000, 1e-3
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 256
SUMMING_TASKS = 8
SPARE = 1.25  # of a language's sample is drawn by a share of hashes, before the exact cut
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_FOLD[[9, 10, 11, 12, 13]] = 32


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # columns x languages
    bias: np.ndarray


def presence(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1: which hashed n-grams each text of a block has."""
    rows = len(offsets) - 1
    out = np.zeros(rows * COLUMNS, np.float32)
    text = _FOLD[raw].astype(np.uint32)
    row = np.repeat(np.arange(rows), np.diff(offsets)) * COLUMNS
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(raw))
    gram = np.zeros(len(raw), np.uint32)
    for width in range(1, max(SPECTRUM) + 1):
        m = len(raw) - width + 1
        if m <= 0:
            break
        gram = (gram[:m] << np.uint32(8)) | text[width - 1 :]
        if width in SPECTRUM:
            ok = left[:m] >= width
            x = gram * np.uint32(0x9E3779B1) + np.uint32(width * 0x85EBCA6B & 0xFFFFFFFF)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            out[row[:m][ok] + (x[ok] >> np.uint32(17)).astype(np.int64)] = 1.0
    return out.reshape(rows, COLUMNS)


def _normed(p: np.ndarray) -> np.ndarray:
    return p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1.0))


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def is_training(doc_id: Column) -> Column:
    """Rows that may be learned from: checksum of the id's decimal text, modulo 4, is not 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS) -> Model:
    """Model learned from ``text`` and ``lang`` of a bounded sample of ``docs``."""
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(is_training(F.col("doc_id"))).withColumn("drawn", F.xxhash64("doc_id", "text"))
    per = rows.select("lang", "drawn").distinct().groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(landmarks).collect()
    if not per:
        return Model([], np.zeros((COLUMNS, 0), np.float32), np.zeros(0))
    names = [r["lang"] for r in per]
    quota = sample_rows / len(names)
    share = F.create_map(*[F.lit(x) for r in per for x in (r["lang"], int(min(1.0, SPARE * quota / r["rows"]) * (1 << 30)))])
    dealt = F.pmod(F.col("drawn"), F.lit(1 << 30))
    # a language that is not learned has no share
    sample = stage(rows.where(dealt < F.try_element_at(share, F.col("lang"))).dropDuplicates(["lang", "drawn"]), "sample")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("drawn"))
    places = sample.select("lang", "drawn", place.alias("place")).where(F.col("place") <= int(quota))
    sample = sample.join(F.broadcast(places), ["lang", "drawn"])  # at most sample_rows places
    marks = sample.where(F.col("place") <= landmarks // len(names)).select("text").toPandas()  # at most ``landmarks`` texts
    if marks.empty:
        return Model([], np.zeros((COLUMNS, 0), np.float32), np.zeros(0))
    raw, offs = text_buffer(pa.array(sorted(t or "" for t in marks["text"]), pa.large_string()))
    basis = np.concatenate([_normed(presence(raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a])) for a, b in slices(offs, BLOCK_BYTES, BLOCK_ROWS)])
    used = np.flatnonzero(basis.any(axis=0))
    shared = spark.sparkContext.broadcast((used, np.ascontiguousarray(basis[:, used].T)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, marks = shared.value
        m = marks.shape[1] + 1
        gram, target, count = np.zeros((m, m)), np.zeros((m, len(names))), 0
        for batch in batches:
            raw, offs = text_buffer(batch.column("text"))
            lang = np.array([names.index(x) for x in batch.column("lang").to_pylist()], np.int64)
            for a, b in slices(offs, BLOCK_BYTES, BLOCK_ROWS):
                p = presence(raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                k = (p[:, columns] @ marks) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1.0))
                k = np.concatenate([k, np.ones((b - a, 1))], axis=1).astype(np.float64)
                gram += k.T @ k
                target += k.T @ np.eye(len(names))[lang[a:b]]
                count += b - a
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([target.tobytes()])], names=["gram", "target"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for parts in zip(batch.column("gram").to_pylist(), batch.column("target").to_pylist(), strict=True):
                own = [np.frombuffer(x) for x in parts]
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in total], names=["gram", "target"])

    m = basis.shape[0] + 1
    sums = sample.repartition(SUMMING_TASKS, "drawn").select("doc_id", "text", "lang").mapInArrow(run, "gram binary, target binary")
    # one task adds the tasks' sums, each of a fixed size, as they come; the driver gets one pair
    whole = sums.repartition(1).mapInArrow(add, "gram binary, target binary").first()
    gram, target = np.frombuffer(whole["gram"]).reshape(m, m), np.frombuffer(whole["target"]).reshape(m, -1)
    shared.destroy()
    own = (basis @ basis.T).astype(np.float64)
    level, vectors = np.linalg.eigh(own)
    keep = level > 1e-6 * level.max()
    white = vectors[:, keep] / np.sqrt(level[keep])  # kernel row -> Nyström coordinates
    lift = np.zeros((m, white.shape[1] + 1))
    lift[:-1, :-1], lift[-1, -1] = white, 1.0
    inner = lift.T @ gram @ lift
    penalty = RIDGE * np.trace(inner) / len(inner) * np.eye(len(inner))
    penalty[-1, -1] = 1e-9
    solved = lift @ np.linalg.solve(inner + penalty, lift.T @ target)
    return Model(names, np.ascontiguousarray((solved[:-1].T.astype(np.float32) @ basis).T), solved[-1])


def predict(model: Model, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language (index) and its score, 0 to 1, of a block of texts."""
    p = presence(raw, offsets)
    scores = (p @ model.weights) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1.0)) + model.bias
    best = scores.argmax(axis=1)
    return best, np.clip(scores[np.arange(len(best)), best], 0.0, 1.0)


def predict_documents(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` as ``_rest``, ``lang_pred`` and ``score``."""
    shared = ship_package(docs.sparkSession).sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_rest"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            raw, offs = text_buffer(batch.column("text"))
            for lo, hi in slices(offs, BLOCK_BYTES, BLOCK_ROWS):
                part = batch.slice(lo, hi - lo)
                known = [bool(model.languages) and has_letter(t) for t in part.column("text").to_pylist()]
                names, score = [UNKNOWN] * len(part), np.zeros(len(part))
                if any(known):
                    best, top = predict(model, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
                    score = np.where(known, top, 0.0)
                yield pa.RecordBatch.from_arrays([part.column("_rest"), pa.array(names, pa.string()), pa.array(score.astype(np.float64))], names=["_rest", "lang_pred", "score"])

    return rows.mapInArrow(run, f"_rest {rows.schema['_rest'].dataType.simpleString()}, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = predict_documents(docs.drop("lang"), fit(docs))
    return found.select(
        F.col("_rest.doc_id").alias("doc_id"),
        F.coalesce(~is_training(F.col("_rest.doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
