"""Removal of repeated passages by fixed-block anchors.

A passage repeats when ``WINDOW`` (20) consecutive words occur again. Every
document's text is cut into non-overlapping reference blocks of half a window;
any window holds at least one of them whole. The blocks form the index, and
every rolling run of the same length, of every document, probes it: a block is
an anchor when its words also occur elsewhere. Around its anchors each document
extends to all windows that hold one, and of the windows with equal words all
but the earliest (smaller ``doc_id``, then earlier start) are repeats; runs of
them are the maximal exact repeats. Their words are removed.

How it runs: texts are scanned once for the index and the probes, and shuffled
once, by document; both later joins reuse that shuffle. Probes go to hash
buckets as 32-bit remainders, each distinct one once per block of input (twice
if it repeats there), so a passage that half of all documents share costs a few
bytes per block; places of a block that occurs twice in one block of input go
straight to their documents. A false match of remainders only adds a candidate. Windows are
compared by 64 bits plus a bucket from independent bits. A window that repeats
inside a block of input is settled there; only its first occurrence travels.
Buckets and partitions follow ``spark.sql.shuffle.partitions``.

Cases: null and empty texts have no words; texts under 20 words lose none; a
null ``doc_id`` comes before all others; rows of equal ``doc_id`` follow the
order of a 63-bit hash of their texts, and rows equal in both are one document that is
there twice (both keep the same words); an empty table gives no rows. Other
columns pass through whatever their names. Texts are read whole; a task holds
one block of input, a long text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import document_key, partitions, ship_package, stage
from rulecheck.llm.kernels import mix, rolling, slices, text_buffer, window_starts, words
from rulecheck.llm.packed import bucket_of, home_of, pack_places, segments, unpack_places

WINDOW = 20
BLOCK = WINDOW // 2
INPUT_BYTES = 4 << 20
_LAST = np.iinfo(np.int32).max


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Record batches of about INPUT_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        _, offs = text_buffer(batch.column("text"))
        for lo, hi in slices(offs, INPUT_BYTES):
            held.append(batch.slice(lo, hi - lo))
            size += int(offs[hi] - offs[lo])
            if size >= INPUT_BYTES // 2:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _index_and_probes(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: remainders of all rolling runs, and the reference blocks with their places.
    A block whose words occur again in the same block of input is an anchor for sure: its
    places are settled and travel under their documents' homes (``probes`` null), so a
    bucket gets one place of a value from a block of input at most."""
    for batch in _blocks(batches):
        w = words(*text_buffer(batch.column("text")))
        start, row = window_starts(w.rows, BLOCK)
        value = rolling(w.hashes(), BLOCK)[start] if len(start) else np.zeros(0, np.uint64)
        if not len(value):
            continue
        pos = start - w.rows[row]
        anchor = np.flatnonzero(pos % BLOCK == 0)
        distinct, inverse, times = np.unique(value, return_inverse=True, return_counts=True)
        probes = np.repeat(distinct, np.minimum(times, 2))
        key, tie = batch.column("_k").to_numpy(), batch.column("_h").to_numpy()
        settled = anchor[times[inverse[anchor]] > 1]
        yield from _settled(buckets, key[row[settled]], tie[row[settled]], pos[settled].astype(np.int32))
        anchor = anchor[times[inverse[anchor]] == 1]
        anchor = anchor[np.argsort(value[anchor], kind="stable")]
        key, tie = key[row[anchor]], tie[row[anchor]]
        place, block_value = pos[anchor].astype(np.int32), value[anchor]
        edges = np.arange(buckets + 1)
        p_at = np.searchsorted(bucket_of(probes, buckets), edges)
        b_at = np.searchsorted(bucket_of(block_value, buckets), edges)
        out: dict[str, list] = {"bucket": [], "probes": [], "blocks": [], "places": []}
        for b in np.flatnonzero(np.diff(p_at)).tolist():
            lo, hi = b_at[b], b_at[b + 1]
            order = lo + np.lexsort((place[lo:hi], tie[lo:hi], key[lo:hi]))
            out["bucket"].append(b)
            out["probes"].append(probes[p_at[b] : p_at[b + 1]].astype(np.uint32).tobytes())
            out["blocks"].append(block_value[order].astype(np.uint32).tobytes())
            out["places"].append(pack_places(key[order], tie[order], place[order]))
        yield pa.RecordBatch.from_pydict(out, schema=_BUCKET)


_BUCKET = pa.schema([("bucket", pa.int32()), ("probes", pa.binary()), ("blocks", pa.binary()), ("places", pa.binary())])


def _settled(homes: int, key: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    for sent in _homeward(homes, key, tie, pos):
        none = pa.nulls(len(sent), pa.binary())
        yield pa.RecordBatch.from_arrays([sent.column("home"), none, none, sent.column("places")], schema=_BUCKET)


def _anchors(homes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: the reference blocks whose words occur at least twice. Settled places go on
    to the home with the bucket's number as they come."""
    probes, blocks, places = [], [], []
    for whole in batches:
        done = whole.column("probes").is_null()
        if whole.column("probes").null_count:
            sent = whole.filter(done)
            yield pa.RecordBatch.from_arrays([sent.column("bucket"), sent.column("places")], schema=_HOME)
        batch = whole.filter(pa.compute.invert(done))
        probes += [np.frombuffer(x, np.uint32) for x in batch.column("probes").to_pylist()]
        for b, p in zip(batch.column("blocks").to_pylist(), batch.column("places").to_pylist(), strict=True):
            if b:
                blocks.append(np.frombuffer(b, np.uint32))
                places.append(p)
    if not blocks:
        return
    every = np.concatenate(probes)
    del probes
    every.sort()
    again = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    if not len(again):
        return
    found = []
    for value, packed in zip(blocks, places, strict=True):
        at = np.minimum(np.searchsorted(again, value), len(again) - 1)
        hit = again[at] == value
        if hit.any():
            found.append([x[hit] for x in unpack_places(packed)])
    if found:
        yield from _homeward(homes, *[np.concatenate([f[i] for f in found]) for i in range(3)])


def _homeward(homes: int, key: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Places dealt to the homes of their documents, one compact row per home."""
    if len(key):
        home = home_of(key, tie, homes)
        order = np.lexsort((pos, tie, key, home))
        out: dict[str, list] = {"home": [], "places": []}
        for lo, hi in segments(home[order]):
            o = order[lo:hi]
            out["home"].append(int(home[o[0]]))
            out["places"].append(pack_places(key[o], tie[o], pos[o]))
        yield pa.RecordBatch.from_pydict(out, schema=_HOME)


_HOME = pa.schema([("home", pa.int32()), ("places", pa.binary())])


def _at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One home: one row per document with the sorted list of its positions."""
    places = [unpack_places(p) for batch in batches for p in batch.column("places").to_pylist()]
    if not places:
        return
    key, tie, pos = (np.concatenate([p[i] for p in places]) for i in range(3))
    del places
    order = np.lexsort((pos, tie, key))
    key, tie, pos = key[order], tie[order], pos[order]
    new = np.flatnonzero((np.diff(key, prepend=key[:1] - 1) != 0) | (np.diff(tie, prepend=tie[:1] - 1) != 0))
    for lo in range(0, len(new), 4096):
        part = np.append(new, len(key))[lo : lo + 4097]
        lists = pa.ListArray.from_arrays(pa.array(part - part[0], pa.int32()), pa.array(pos[part[0] : part[-1]], pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(key[part[:-1]]), pa.array(tie[part[:-1]]), lists], names=["_k", "_h", "at"])


def _windows(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that hold an anchor. Those that repeat within the block are settled
    (bucket by document, ``hashes`` empty); first occurrences go to their bucket."""
    for whole in batches:
        whole = whole.filter(whole.column("at").is_valid())
        for batch in _blocks(iter([whole])) if len(whole) else ():
            w = words(*text_buffer(batch.column("text")))
            n_words = len(w.starts)
            marked = np.zeros(n_words + 1, np.int32)
            lists = batch.column("at")
            lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(batch)), lens)
            lo = w.rows[row] + np.maximum(flat - BLOCK, 0)
            hi = np.minimum(w.rows[row] + flat + 1, w.rows[row + 1] - WINDOW + 1)
            fits = hi > lo
            np.add.at(marked, lo[fits], 1)
            np.add.at(marked, hi[fits], -1)
            start = np.flatnonzero(np.cumsum(marked[:-1]) > 0)
            if not len(start):
                continue
            h = w.hashes()
            value = rolling(h, WINDOW)[start]
            other = rolling(mix(h + np.uint64(0x2545F4914F6CDD1D)), WINDOW)[start]
            del h
            of = np.searchsorted(w.rows, start, "right") - 1
            pos = (start - w.rows[of]).astype(np.int32)
            key, tie = batch.column("_k").to_numpy(), batch.column("_h").to_numpy()
            by = np.lexsort((tie, key))
            rank = np.empty(len(by), np.int64)
            rank[by] = np.cumsum(np.concatenate([[0], (np.diff(key[by]) != 0) | (np.diff(tie[by]) != 0)]))
            place = rank[of] << 32 | pos
            order = np.lexsort((place, value))
            value, other, place, of, pos = value[order], other[order], place[order], of[order], pos[order]
            first = np.concatenate([[True], value[1:] != value[:-1]])
            leader = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            later = place > place[leader]
            yield from _pack_windows(bucket_of(other[first], buckets), value[first], key[of[first]], tie[of[first]], pos[first])
            if later.any():
                k, t, p, r = key[of[later]], tie[of[later]], pos[later], place[later]
                o = np.argsort(r, kind="stable")
                home = home_of(k, t, buckets)[o]
                yield from _pack_windows(home, np.zeros(0, np.uint64), k[o], t[o], p[o])


_WINDOW = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary())])


def _pack_windows(bucket: np.ndarray, value: np.ndarray, key: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((pos, tie, key, bucket))
    out: dict[str, list] = {"bucket": [], "hashes": [], "places": []}
    for lo, hi in segments(bucket[order]):
        o = order[lo:hi]
        out["bucket"].append(int(bucket[o[0]]))
        out["hashes"].append(value[o].tobytes() if len(value) else b"")
        out["places"].append(pack_places(key[o], tie[o], pos[o]))
    yield pa.RecordBatch.from_pydict(out, schema=_WINDOW)


def _repeats(homes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: all windows but the earliest of each word sequence, sent to their documents' homes."""
    values, places, settled = [], [], []
    for batch in batches:
        for h, p in zip(batch.column("hashes").to_pylist(), batch.column("places").to_pylist(), strict=True):
            if h:
                values.append(np.frombuffer(h, np.uint64))
                places.append(unpack_places(p))
            else:
                settled.append(unpack_places(p))
    if settled:
        yield from _homeward(homes, *[np.concatenate([p[i] for p in settled]) for i in range(3)])
    if not values:
        return
    value = np.concatenate(values)
    key, tie, pos = (np.concatenate([p[i] for p in places]) for i in range(3))
    del values, places
    order = np.lexsort((pos, tie, key, value))
    value, key, tie, pos = value[order], key[order], tie[order], pos[order]
    first = np.concatenate([[True], value[1:] != value[:-1]])
    leader = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    later = (key != key[leader]) | (tie != tie[leader]) | (pos != pos[leader])
    yield from _homeward(homes, key[later], tie[later], pos[later])


def spans(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Word ranges covered by windows of ``width`` words."""
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > width)
    lo = starts[np.concatenate([[0], cut + 1])]
    hi = starts[np.concatenate([cut, [len(starts) - 1]])] + width
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


def _cut(kind: pa.DataType, as_is: bool, nulls: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept text of each document."""
    for batch in batches:
        _, offs = text_buffer(batch.column("text"))
        for lo, hi in slices(offs, INPUT_BYTES):
            part = batch.slice(lo, hi - lo)
            kept, n_words, removed, ranges = [], [], [], []
            for text, at in zip(part.column("text").to_pylist(), part.column("at").to_pylist(), strict=True):
                w = (text or "").encode().split()
                cut = spans(np.array(at, np.int64), WINDOW) if at else []
                n_words.append(len(w))
                removed.append(sum(b - a for a, b in cut))
                ranges.append([{"start": a, "end": b} for a, b in cut])
                for a, b in reversed(cut):
                    del w[a:b]
                kept.append(text if as_is and not cut and (nulls or text is not None) else b" ".join(w).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("_rest"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(ranges, kind)],
                names=["_rest", "text", "n_words", "n_removed", "removed"],
            )


def remove_repeats(docs: DataFrame, as_is: bool = False, nulls: bool = False) -> DataFrame:
    """``_rest`` (a struct of all other columns of ``docs``), ``text`` (kept words joined
    by one space), ``n_words``, ``n_removed`` and ``removed`` (word ranges) of every row.

    ``as_is`` leaves texts that lose no word as they were; null ones become empty, with
    ``nulls`` too they stay null."""
    spark = ship_package(docs.sparkSession)
    buckets = partitions(spark)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    keyed = docs.select(
        *document_key(),
        F.col("text").cast("string").alias("text"),
        F.struct(*others).alias("_rest"),
    )
    ranges = "array<struct<start:bigint,end:bigint>>"
    place, sent = "_k bigint, _h bigint, at array<int>", "home int, places binary"

    probes = keyed.select("_k", "_h", "text").mapInArrow(lambda b: _index_and_probes(buckets, b), "bucket int, probes binary, blocks binary, places binary")
    anchors = probes.repartitionById(buckets, "bucket").mapInArrow(lambda b: _anchors(buckets, b), sent)
    anchors = stage(anchors, "anchors").repartitionById(buckets, "home").mapInArrow(_at_home, place)
    windows = keyed.join(anchors, ["_k", "_h"], "left").select("_k", "_h", "text", "_rest", "at")
    windows = windows.mapInArrow(lambda b: _windows(buckets, b), "bucket int, hashes binary, places binary")
    repeats = windows.repartitionById(buckets, "bucket").mapInArrow(lambda b: _repeats(buckets, b), sent)
    repeats = repeats.repartitionById(buckets, "home").mapInArrow(_at_home, place)
    found = keyed.join(repeats, ["_k", "_h"], "left").select("_k", "_h", "text", "_rest", "at")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    rest = found.schema["_rest"].dataType.simpleString()
    return found.mapInArrow(lambda b: _cut(kind, as_is, nulls, b), f"_rest {rest}, text string, n_words bigint, n_removed bigint, removed {ranges}")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: words kept of every document, as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(F.col("_rest.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# DuckDB: the same rule, window by window.
OP4_SQL = r"""
WITH w AS (SELECT doc_id, string_split_regex(trim(regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS words FROM documents),
n AS (SELECT doc_id, CASE WHEN words = [''] THEN [] ELSE words END AS words FROM w),
e AS (SELECT doc_id, len(words) AS n, UNNEST(words) AS word, UNNEST(range(0, len(words))) AS i FROM n),
s AS (SELECT doc_id, n, i AS p, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)) AS h FROM e),
g AS (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS r FROM s WHERE p + 20 <= n),
c AS (SELECT DISTINCT doc_id, UNNEST(range(p, p + 20)) AS i FROM g WHERE r > 1),
k AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS kept, COUNT(*) AS n_kept
      FROM e ANTI JOIN c ON e.doc_id = c.doc_id AND e.i = c.i GROUP BY e.doc_id)
SELECT n.doc_id, CAST(len(n.words) AS BIGINT) AS n_words, CAST(len(n.words) - COALESCE(k.n_kept, 0) AS BIGINT) AS n_removed,
  sha256(COALESCE(k.kept, '')) AS kept_sha256
FROM n LEFT JOIN k ON n.doc_id = k.doc_id
"""
