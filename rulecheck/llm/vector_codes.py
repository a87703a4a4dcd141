"""Vector code compression: product codes from integer codebooks.

Components become integers ``floor(scale * x)``, vectors are cut into equal
consecutive parts and every part is replaced by the number of its nearest
codebook entry. Codebooks are refined in rounds of assigning and averaging, all
in integers, so results do not depend on how Spark deals the rows.

Nearest entries are found by slice-and-intersect bitmasks. Per dimension, a
codebook keeps its coordinates sorted, with the mask of the entries before each
place (a prefix mask). A range of coordinates is then the difference of two
prefix masks, and the entries inside a box are the AND of one such slice per
dimension. The initial radius of a part is its largest coordinate difference
from a first guess (the nearest entry in the widest dimension); the box holds
that guess at least. The best distance found in it gives the final radius: no
entry outside the box of that radius can be nearer or as near, so the masks'
candidates are exact, ties included.

Each round is one scan of the vectors; tasks add up their parts per entry and
emit one number per codebook component, which Spark sums. The driver holds the
codebooks only (entries x vector length integers).

Cases: rows with a null vector, or null or non-finite components, are dropped.
The vector length is that of most rows kept (ties: the longer); rows of another
length, or with an integer beyond +-2^62, keep their row with a null code and
error and take no part in the codebooks. A length that is no multiple of the
number of parts makes the last parts shorter. Fewer rows than entries give
smaller codebooks. Null ids come after all others; rows of equal id are ordered
by their vectors; repeated rows count each. An error beyond a long is null.
Equal labels (nulls together) share the sum of their errors. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import ship_package, stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK = 4096  # vectors compared at a time
WIDEST = 1 << 62
SALTS = 8


class Codebook:
    """One part's entries (at most 64), with sorted coordinates and prefix masks per dimension."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        below = np.bitwise_or.accumulate(np.uint64(1) << order.astype(np.uint64), axis=0)
        self.prefix = np.concatenate([np.zeros((1, entries.shape[1]), np.uint64), below])

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries within ``radius`` of each row in every dimension."""
        mask = np.full(len(x), np.uint64(2 ** len(self.entries) - 1))
        for j in range(x.shape[1]):
            lo = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left")
            hi = np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            mask &= self.prefix[hi, j] ^ self.prefix[lo, j]
        return mask

    def guess(self, x: np.ndarray) -> np.ndarray:
        """A near entry of each row: the next coordinate in the dimension where entries lie widest apart."""
        j = int(np.argmax(self.sorted[-1] - self.sorted[0]))
        at = np.minimum(np.searchsorted(self.sorted[:, j], x[:, j]), len(self.entries) - 1)
        return np.argsort(self.entries[:, j], kind="stable")[at]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest entry (ties: the lower number) of each row."""
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        numbers = np.arange(len(self.entries), dtype=np.uint64)
        away = np.full((len(x), len(self.entries)), 1 << 300 if x.dtype == object else np.iinfo(np.int64).max, x.dtype)

        def verify(mask: np.ndarray) -> None:
            row, entry = np.nonzero((mask[:, None] >> numbers) & np.uint64(1))
            away[row, entry] = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)

        first = self.box(x, abs(x - self.entries[self.guess(x)]).max(axis=1))
        verify(first)
        verify(self.box(x, _root(away.min(axis=1))) & ~first)
        best = away.argmin(axis=1)
        return best, away[np.arange(len(x)), best]


def _root(squares: np.ndarray) -> np.ndarray:
    """Integer square roots."""
    if squares.dtype == object:
        return np.array([math.isqrt(s) for s in squares], object)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def cuts(length: int, parts: int) -> list[slice]:
    """Equal consecutive parts of a vector."""
    width = -(-length // parts)
    return [slice(min(p * width, length), min((p + 1) * width, length)) for p in range(parts)]


def integers(column: pa.Array, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that fit (the length, the range) and their integers."""
    if not len(column):
        return np.zeros(0, bool), np.zeros((0, length), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    fit = sizes == length
    flat = column.filter(pa.array(fit)).flatten().to_numpy(zero_copy_only=False).reshape(int(fit.sum()), length)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * float(scale))
    small = (abs(scaled) <= WIDEST).all(axis=1)
    fit[fit] = small
    return fit, scaled[small].astype(np.int64)


def _blocks(books: list[np.ndarray], length: int, scale: int, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Row numbers, integers and (entry, distance) per part, a block of rows at a time."""
    fit, values = integers(column, length, scale)
    rows = np.flatnonzero(fit)
    far = max([int(abs(values).max(initial=0))] + [int(abs(b).max(initial=0)) for b in books])
    if 4 * far * far * max(length, 1) >= WIDEST:  # exact beyond 64 bits
        values, books = values.astype(object), [b.astype(object) for b in books]
    made = [Codebook(b) for b in books]
    for lo in range(0, len(rows), BLOCK):
        part = values[lo : lo + BLOCK]
        yield rows[lo : lo + BLOCK], part, [m.nearest(part[:, c]) for m, c in zip(made, cuts(length, len(made)), strict=True)]


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0)), ("rows", pa.int64())])
_SUMS_SQL = "part int, entry int, place int, total decimal(38,0), rows bigint"


def _sums(books: list[np.ndarray], length: int, scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per entry of each codebook: its parts' number and sums by component, over one task's rows."""
    totals = [np.zeros(b.shape, object) for b in books]
    counts = [np.zeros(len(b), np.int64) for b in books]
    for batch in batches:
        for _, values, found in _blocks(books, length, scale, batch.column("vector")):
            for p, (c, (entry, _)) in enumerate(zip(cuts(length, len(books)), found, strict=True)):
                added = np.zeros(books[p].shape, values.dtype)
                np.add.at(added, entry, values[:, c])
                totals[p] += added
                counts[p] += np.bincount(entry, minlength=len(books[p]))
    rows = [
        (p, e, j, Decimal(int(total)), int(counts[p][e]))
        for p, book in enumerate(totals)
        for e in np.flatnonzero(counts[p]).tolist()
        for j, total in enumerate(book[e])
    ]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SUMS, strict=True)], schema=_SUMS)


_CODES_SQL = "id bigint, label string, code string, error bigint"
_CODES = pa.schema([("id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])


def _codes(books: list[np.ndarray], length: int, scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digits = np.array([f"{i:02x}" for i in range(64)], object)
    for batch in batches:
        code, error = np.full(len(batch), None, object), np.full(len(batch), None, object)
        for rows, _, found in _blocks(books, length, scale, batch.column("vector")):
            code[rows] = sum((digits[entry] for entry, _ in found[1:]), digits[found[0][0]])
            error[rows] = sum(away.astype(object) for _, away in found)
        held = [None if e is None or e >= 1 << 63 else int(e) for e in error]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(held, pa.int64())], schema=_CODES)


def usable(df: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """``id``, ``vector`` (doubles) and ``label`` of rows whose vectors are whole."""
    held = df.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), label.alias("label"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return held.where(F.col("vector").isNotNull() & whole)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[list[np.ndarray], int]:
    """Codebooks (one array of entries per part) of usable vectors, and the vector length."""
    ship_package(vectors.sparkSession)
    vectors = vectors.select("id", "vector")
    length = vectors.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if length is None:
        return [np.zeros((0, 0), np.int64)] * parts, 0
    length = length["length"]
    right = vectors.where((F.size("vector") == length) & F.forall("vector", lambda x: F.abs(F.floor(x * scale).cast("double")) <= float(WIDEST)))
    first = right.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    _, start = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), length, scale)
    books = [start[:, c] for c in cuts(length, parts)]
    if not len(start):
        return books, length
    for _ in range(rounds):
        books = _refined(right, books, length, scale)
    return books, length


def _refined(right: DataFrame, books: list[np.ndarray], length: int, scale: int) -> list[np.ndarray]:
    sums = right.select("vector").mapInArrow(lambda b: _sums(books, length, scale, b), _SUMS_SQL)
    sums = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    after = [b.copy() for b in books]
    for r in sums.collect():  # at most entries x vector length rows
        after[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["rows"]
    return after


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], length: int, scale: int = SCALE) -> DataFrame:
    """``id``, ``label``, ``code`` (two hex digits a part) and ``error`` (squared distance) of usable vectors."""
    ship_package(vectors.sparkSession)
    rows = vectors.select("id", F.col("label").cast("string").alias("label"), "vector")
    return rows.mapInArrow(lambda b: _codes(books, length, scale, b), _CODES_SQL)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` and the sum of errors over each label. Labels are summed up before the
    shuffle; a label of very many rows is spread over SALTS partitions when its sum comes back."""
    sums = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"))
    sums = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("copy"))
    spread = codes.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    return spread.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("copy"))).drop("of", "copy", "salt")


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: product codes of all embeddings."""
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", F.col("label"))
    books, length = fit(vectors)
    codes = with_label_errors(stage(encode(vectors, books, length), "codes"))
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    away = "list_sum(list_transform(list_zip(r.x, c.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v "
        "FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)",
        f"rows8 AS MATERIALIZED (SELECT rid, vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) t(p))",
        f"c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM rows8 QUALIFY e < {ENTRIES})",
    ]
    assign = "a{0} AS MATERIALIZED (SELECT r.rid, r.p, min(struct_pack(d := " + away + ", e := c.e)) AS n FROM rows8 r JOIN c{0} c ON r.p = c.p GROUP BY r.rid, r.p)"
    for i in range(ROUNDS):
        steps += [
            assign.format(i),
            f"s{i} AS (SELECT p, e, j, ((s - ((s % k + k) % k)) // k)::BIGINT AS y FROM (SELECT r.p, a.n.e AS e, j, sum(r.x[j])::HUGEINT AS s, count(*) AS k "
            f"FROM rows8 r JOIN a{i} a ON r.rid = a.rid AND r.p = a.p, unnest(range(1, len(r.x) + 1)) t(j) GROUP BY r.p, a.n.e, j))",
            f"c{i + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(u.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT p, e, list(y ORDER BY j) AS x FROM s{i} GROUP BY p, e) u ON u.p = c.p AND u.e = c.e)",
        ]
    steps.append(assign.format(ROUNDS))
    steps.append(f"found AS (SELECT rid, string_agg(printf('%02x', n.e), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid)")
    steps.append(f"hashed AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM c{ROUNDS})")
    return (
        "WITH " + ", ".join(steps) + " SELECT k.vec_id, f.code, f.error, (sum(f.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, h.h AS codebooks_sha256 "
        "FROM kept k JOIN found f ON k.rid = f.rid, hashed h"
    )


OP13_SQL = _sql()
