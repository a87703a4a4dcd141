"""Document fingerprints: one-permutation MinHash with optimal densification.

Word shingles (five words, A-Z folded) are hashed once; the top bits choose one
of ``BINS`` bins and the smallest remaining bits per bin are kept. An empty bin
takes the value of a bin reached by its own fixed sequence of hashed probes
(the same for all documents), which keeps collision probabilities equal to the
Jaccard similarity. Of each bin the low ``BITS`` bits are stored, packed, as
hexadecimal text. Two fingerprints agree in a bin by chance with probability
2^-BITS, so the likeness is (m - c) / (1 - c) for a share m of equal bins.

Cases: null and empty texts, and texts without words, have the empty string as
fingerprint; two of them have likeness 1, one against a text with words 0.
Fewer than five words make one shingle of the whole sequence. Equal texts have
equal fingerprints; null ``doc_id`` and repeated rows are kept; an empty table
gives no rows; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import NO_ID, document_key, documents, partitions, ship_package
from rulecheck.llm.kernels import mix, shingles, slices, text_buffer, words

WIDTH, BINS, BITS = 5, 512, 4
BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 2048
EDITED_SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def bin_minima(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Smallest remaining hash bits per text and bin, before densification."""
    shift = np.uint64(64 - int(BINS).bit_length() + 1)
    out = np.full(rows * BINS, _EMPTY, np.uint64)
    np.minimum.at(out, row * BINS + (hashes >> shift).astype(np.int64), hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    return out.reshape(rows, BINS)


def _sources(bins: np.ndarray, probe: int) -> np.ndarray:
    """The bin that each given bin looks into at its ``probe``-th attempt."""
    return (mix(bins.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(probe)) % np.uint64(BINS)).astype(np.int64)


@lru_cache(1)
def _first_visits() -> np.ndarray:
    """For every bin, the attempt at which it first looks into each other bin."""
    out, cols, probe = np.zeros((BINS, BINS), np.int32), np.arange(BINS), 1
    while (out == 0).any():
        at = _sources(cols, probe)
        new = out[cols, at] == 0
        out[cols[new], at[new]] = probe
        probe += 1
    return out


def densify(minima: np.ndarray) -> np.ndarray:
    """Fill the empty bins of texts that have any value: each bin follows its own
    sequence of hashed attempts to the first bin that was not empty. A few attempts
    are made for all texts at once, the rest by the order of first visits."""
    out = minima.copy()
    empty = minima == _EMPTY
    empty[empty.all(axis=1)] = False
    row, col = np.nonzero(empty)
    for probe in range(1, 9):
        source = _sources(col, probe)
        value = minima[row, source]
        hit = value != _EMPTY
        out[row[hit], col[hit]] = value[hit]
        row, col = row[~hit], col[~hit]
    at = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        r, cols = row[lo], col[lo:hi]
        have = np.flatnonzero(minima[r] != _EMPTY)
        out[r, cols] = minima[r, have[_first_visits()[cols[:, None], have].argmin(axis=1)]]
    return out


def low_bits(dense: np.ndarray) -> np.ndarray:
    """The stored bits of every bin. The bin's number is mixed in, so that one value that
    fills many bins of a short text agrees by chance in each of them independently."""
    return (mix(dense + np.arange(BINS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def sketch(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stored bits of a block of texts, and which texts have shingles."""
    hashes, row = shingles(words(raw, offsets, lower=True), WIDTH)
    minima = bin_minima(hashes, row, len(offsets) - 1)
    return low_bits(densify(minima)), np.bincount(row, minlength=len(offsets) - 1) > 0


def pack(bits: np.ndarray, filled: np.ndarray) -> list[str]:
    """Hexadecimal text of packed bins; empty for texts without shingles."""
    per = 8 // BITS
    packed = np.zeros((len(bits), BINS // per), np.uint8)
    for k in range(per):
        packed |= bits[:, k::per] << (8 - BITS * (k + 1))
    return [packed[i].tobytes().hex() if ok else "" for i, ok in enumerate(filled.tolist())]


def likeness(a: np.ndarray, a_filled: np.ndarray, b: np.ndarray, b_filled: np.ndarray) -> np.ndarray:
    """Bias-corrected similarity of stored bits, row by row."""
    chance = 2.0**-BITS
    same = (a == b).mean(axis=1)
    return np.where(a_filled & b_filled, np.clip((same - chance) / (1 - chance), 0.0, 1.0), (a_filled == b_filled).astype(float))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_buffer(batch.column("text"))
            for lo, hi in slices(offs, BLOCK_BYTES, BLOCK_ROWS):
                prints = pack(*sketch(raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return documents(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint string")


def _places(key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Order of documents as 16 bytes that compare like (key, tie-break)."""
    both = np.stack([key, tie], axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return both.astype(">u8").view("S16").ravel()


def _batch_places(batch: pa.RecordBatch) -> np.ndarray:
    return _places(*[batch.column(c).to_numpy(zero_copy_only=False) for c in ("_k", "_h")])


def range_cuts(docs: DataFrame, parts: int) -> np.ndarray:
    """Last places of all ranges but the highest, for ranges of about equally many rows.

    They are quantiles of the ids. An id that fills several quantiles (or the null id) is
    cut by its tie-break as often, so its rows spread over as many ranges.
    """
    if parts < 2:
        return np.zeros(0, "S16")
    ids = docs.select("_k", F.col("doc_id").isNull().alias("none"))
    values, times = np.unique(ids.approxQuantile("_k", [k / parts for k in range(1, parts)], 0.2 / parts), return_counts=True)
    exact = {}
    hot = [v for v, n in zip(values.tolist(), times.tolist(), strict=True) if n > 1]
    if hot:  # quantiles are doubles; the id itself is the most frequent one that rounds to it
        rounded = F.col("_k").cast("double")
        counts = ids.where(rounded.isin(hot)).groupBy("_k", "none").count()
        exact = {r["v"]: r["id"] for r in counts.groupBy(rounded.alias("v")).agg(F.max_by(F.struct("_k", "none"), "count").alias("id")).collect()}
    key, tie = [], []
    for v, n in zip(values.tolist(), times.tolist(), strict=True):
        k, none = exact.get(v, (int(min(v, 2.0**63 - 1024)), False))
        low = NO_ID if none else 0
        key += [k] * n
        tie += [low + (1 << 63) * j // n for j in range(1, n)] + [(1 << 63) - 1]
    return np.unique(_places(np.array(key, np.int64), np.array(tie, np.int64)))


def neighbours(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of ``docs`` dealt to ranges of their order (``part``), and further rows per
    range (``guest``): the one that follows it in descending order, so every row meets
    its successor in its own range. The last row's successor is the first.

    The cut points and the greatest place of each range, two numbers per partition, are
    all that the driver sees. Only exact copies with one id cannot be told apart; each
    batch sends one of them as a guest.
    """
    docs = docs.select("doc_id", "text", *document_key())
    bounds = range_cuts(docs, parts)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _batch_places(batch)
            part = np.searchsorted(bounds, place)
            order = np.lexsort((place, part))
            last = pa.array(order[np.flatnonzero(np.diff(part[order], append=-1))])
            parts_of = pa.array(part, pa.int32()).take(last)
            yield pa.RecordBatch.from_arrays([parts_of, batch.column("_k").take(last), batch.column("_h").take(last)], names=["part", "_k", "_h"])

    highest = docs.select("_k", "_h").mapInArrow(tops, "part int, _k bigint, _h bigint").groupBy("part").agg(F.max(F.struct("_k", "_h")).alias("top")).collect()
    highest = sorted((r["part"], r["top"]["_k"], r["top"]["_h"]) for r in highest)
    top = _places(np.array([k for _, k, _ in highest], np.int64), np.array([h for _, _, h in highest], np.int64))
    host = np.roll(np.array([p for p, _, _ in highest], np.int32), -1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _batch_places(batch)
            at = np.minimum(np.searchsorted(top, place), max(len(top) - 1, 0))
            extra = np.flatnonzero(top[at] == place) if len(place) else np.zeros(0, np.int64)
            extra = extra[np.unique(at[extra], return_index=True)[1]]
            rows = np.concatenate([np.arange(len(place)), extra])
            part = np.concatenate([np.searchsorted(bounds, place), host[at[extra]]])
            guest = np.arange(len(rows)) >= len(place)
            both = batch.take(pa.array(rows)) if len(extra) else batch
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(guest), *[both.column(c) for c in ("doc_id", "text", "_k", "_h")]], names=["part", "guest", "doc_id", "text", "_k", "_h"])

    return docs.mapInArrow(deal, "part int, guest boolean, doc_id bigint, text string, _k bigint, _h bigint")


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the start of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n] if n else text


def edited_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likenesses.

    One shuffle by ranges of ``doc_id`` brings neighbours together; each task then
    streams its sorted rows and holds one block and the row after it. Rows of equal
    ``doc_id`` follow each other in descending order of their texts' hashes.
    """
    spark = ship_package(docs.sparkSession)
    parts = partitions(spark)
    dealt = neighbours(documents(docs, "doc_id", "text"), parts)
    ordered = dealt.repartitionById(parts, "part").sortWithinPartitions("part", "guest", F.col("_k").desc(), F.col("_h").desc())
    return ordered.mapInArrow(_compare, EDITED_SCHEMA)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.RecordBatch | None = None  # the last row so far, which still waits for its successor
    for batch in batches:
        _, offs = text_buffer(batch.column("text"))
        for lo, hi in slices(offs, BLOCK_BYTES, BLOCK_ROWS):
            block = batch.slice(lo, hi - lo)
            if held is not None:
                block = pa.concat_batches([held, block])
            held = block.slice(len(block) - 1)
            if len(block) > 1:
                yield _compare_block(block, len(block) - 1)
    if held is not None:
        yield _compare_block(held, 1)


def _compare_block(block: pa.RecordBatch, rows: int) -> pa.RecordBatch:
    """Results of the first ``rows`` rows of a block, without guests."""
    part, guest = block.column("part").to_numpy(), block.column("guest").to_numpy(zero_copy_only=False)
    texts = [t or "" for t in block.column("text").to_pylist()]
    bits, filled = sketch(*text_buffer(block.column("text")))
    own = np.flatnonzero(~guest[:rows])
    after = np.minimum(own + 1, len(texts) - 1)
    follows = (after > own) & (part[after] == part[own])
    after = np.where(follows, after, own)  # only without any row to follow: the row itself
    changed = [edited(texts[i], texts[j]) for i, j in zip(own.tolist(), after.tolist(), strict=True)]
    e_bits, e_filled = sketch(*text_buffer(pa.array(changed, pa.large_string())))
    return pa.RecordBatch.from_arrays(
        [
            block.column("doc_id").take(pa.array(own)),
            pa.array([len(texts[i]) for i in own.tolist()], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
            pa.array(pack(bits[own], filled[own]), pa.string()),
            pa.array(pack(e_bits, e_filled), pa.string()),
            pa.array(likeness(bits[own], filled[own], e_bits, e_filled)),
            pa.array(likeness(bits[own], filled[own], bits[after], filled[after])),
        ],
        names=[f.split()[0] for f in EDITED_SCHEMA.split(", ")],
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of all documents and of their edited texts."""
    return edited_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
