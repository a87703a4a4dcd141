"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (proximal, per coordinate) updates.

Features of a text are n-grams of its words (one and two words), of their shapes
(letter case, marks, digits, length; one and two) and of word repetitions, hashed
into ``DIMENSIONS`` weights. A feature's value is its count over the text's
words, so a score is a sparse dot product, one sum over words per text.

Training uses at most ``SAMPLE_ROWS`` rows: those of smallest hash of ``doc_id``,
label and text among the different labelled rows of at most as many labels. Shards
train side by side, each over its rows in a fixed order, in a task of its own, and
their weights are averaged by their numbers of rows; the weights (bounded by
``DIMENSIONS``) are all that reaches the driver, and are broadcast for scoring.
Every text is scored whole.

Cases: null and empty texts have no features and score by the intercept; rows
with null ``doc_id`` or label never train; repeated rows train once and score once
each; an empty table, or no labels, gives weights of 0 and scores of 0.5; extra
columns are ignored, clashing names too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import documents, ship_package, smallest, stage
from rulecheck.llm.kernels import Words, mix, slices, text_buffer, words

DIMENSIONS = 1 << 18
SAMPLE_ROWS = 20_000
SHARDS, EPOCHS = 4, 3
SPARE = 1.25  # of the sample is drawn by a share of hashes, before the exact cut
ROWS_AT = DIMENSIONS + 1  # stands for the number of rows among the weights' indexes
ALPHA, BETA, L1, L2 = 2.0, 0.01, 1e-5, 1e-5
INPUT_BYTES = 2 << 20
_KINDS = np.zeros(256, np.uint8)  # 0 letter, 1 upper case, 2 digit, 3 mark
_KINDS[33:48] = _KINDS[58:65] = _KINDS[91:97] = _KINDS[123:127] = 3
_KINDS[48:58] = 2
_KINDS[65:91] = 1
_LENGTHS = np.searchsorted([2, 3, 6, 10, 16], np.arange(64), "right").astype(np.uint64)


def shapes(w: Words) -> np.ndarray:
    """Hash of every word's shape: numbers of capitals, digits and marks, its last mark, its length."""
    kind = _KINDS[w.raw]
    shape = _LENGTHS[np.minimum(w.ends - w.starts, 63)]
    for k in (1, 2, 3):
        total = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        shape = shape * np.uint64(4) + np.minimum(total[w.ends] - total[w.starts], 3).astype(np.uint64)
    last = w.raw[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    return mix(shape * np.uint64(256) + np.where(_KINDS[last] == 3, last, 0).astype(np.uint64) + np.uint64(1))


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of a block of texts: weight index and text of each, and words per text."""
    w = words(raw, offsets)
    row = w.row_of()
    h, s = w.hashes(), shapes(w)
    same = row[1:] == row[:-1]
    index, rows = [h, s], [row, row]
    for x, salt in ((h, 11), (s, 13)):
        index.append(mix(x[:-1][same] * np.uint64(3) + x[1:][same] + np.uint64(salt)))
        rows.append(row[1:][same])
    for gap in (1, 2, 3):
        again = (row[gap:] == row[:-gap]) & (h[gap:] == h[:-gap])
        index.append(np.full(int(again.sum()), mix(np.array([gap + 100], np.uint64))[0]))
        rows.append(row[gap:][again])
    flat = mix(np.concatenate(index)) % np.uint64(DIMENSIONS)
    return flat.astype(np.int64), np.concatenate(rows), w.counts()


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(texts: list[str | None], labels: np.ndarray) -> np.ndarray:
    """Weights (the last one is the intercept) after EPOCHS passes over the rows in order."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at):
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    examples = []
    for text, label in zip(texts, labels.tolist(), strict=True):
        index, _, count = features(*text_buffer(pa.array([text], pa.large_string())))
        at, times = np.unique(index, return_counts=True)
        examples.append((np.append(at, DIMENSIONS).astype(np.int32), np.append(times / max(count[0], 1), 1.0).astype(np.float32), label))
    for _ in range(EPOCHS):
        for at, value, label in examples:
            w = weights(at)
            g = (_sigmoid(w @ value) - label) * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(DIMENSIONS + 1))


def score(weights: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of the good label for a block of texts."""
    index, row, count = features(raw, offsets)
    total = np.bincount(row, weights=weights[index], minlength=len(offsets) - 1)
    return _sigmoid(total / np.maximum(count, 1) + weights[DIMENSIONS])


def is_training(doc_id: Column) -> Column:
    """Rows that may be learned from: checksum of the id's decimal text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Averaged weights of the shards. ``labels``: ``doc_id`` and ``label`` (0 or 1)."""
    ship_package(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = stage(smallest(known.where(is_training(F.col("doc_id"))).distinct(), sample_rows, "doc_id", "label"), "labels")
    of = documents(docs, "doc_id", "text")
    labelled = of.select("doc_id").join(F.broadcast(known), "doc_id").count()  # at most sample_rows labels; their ids may repeat
    share = min(1.0, SPARE * sample_rows / max(1, labelled))
    rows = of.join(F.broadcast(known), "doc_id").withColumn("drawn", F.xxhash64("doc_id", "label", "text"))
    rows = stage(rows.where(F.pmod(F.col("drawn"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["drawn"]), "training")
    rows = smallest(rows, sample_rows, "doc_id", "label", "text")
    rows = rows.withColumn("shard", F.pmod("drawn", F.lit(SHARDS)).cast("int")).select("shard", "drawn", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if held:
            table = pa.Table.from_batches(held).sort_by([("drawn", "ascending")])
            w = train(table.column("text").to_pylist(), table.column("label").to_numpy())
            at = np.append(np.flatnonzero(w), ROWS_AT)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.append(w[at[:-1]], 1.0) * len(table))], names=["at", "weight"])

    trained = rows.repartitionById(SHARDS, "shard").mapInArrow(run, "at int, weight double")
    found = trained.groupBy("at").agg(F.sum("weight").alias("weight")).toPandas()
    weights = np.zeros(ROWS_AT + 1)
    weights[found["at"].to_numpy()] = found["weight"].to_numpy()
    return weights[:ROWS_AT] / max(weights[ROWS_AT], 1.0)


def score_documents(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """All columns of ``docs`` as ``_rest``, and ``score``."""
    shared = ship_package(docs.sparkSession).sparkContext.broadcast(weights)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_rest"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffer(batch.column("text"))
            for lo, hi in slices(offs, INPUT_BYTES):
                s = score(shared.value, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                yield pa.RecordBatch.from_arrays([batch.column("_rest").slice(lo, hi - lo), pa.array(s)], names=["_rest", "score"])

    return rows.mapInArrow(run, f"_rest {rows.schema['_rest'].dataType.simpleString()}, score double")


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: score and decision for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_documents(docs, fit(docs, labels_of(spark, sf_dir)))
    return scored.select(
        F.col("_rest.doc_id").alias("doc_id"),
        F.coalesce(~is_training(F.col("_rest.doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
