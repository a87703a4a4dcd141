"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension: 1 where the value is above 0. Codes
are cut into m nearly equal segments of about log2(n) bits, n being the number of
different codes and no more, and indexed by (segment, value): a value then holds a few
codes however large the table is.
Two codes at distance at most m (s + 1) - 1 agree in one segment up to s
bits. So the search probes all values within s bits of each query segment, for
s = 0, 1, 2, ..., verifies the full distance of what it finds, and drops a query
as soon as its k-th verified distance is covered by that bound: nothing closer
can be missing.

Equal codes are one index entry with their k smallest ids, and equal queries are
searched once, so a vector that a third of all rows share is one entry. An entry
is reported in one round and by one segment only (its first nearest one), so
nothing has to be made distinct. What stays between rounds is k rows per query,
on shared storage. The driver sees the numbers of different codes, of rows up to k,
and of dimensions, and whether queries are open.

Cases: a null vector has no code, it is neither query nor result; null and NaN
values give bit 0; shorter vectors are filled up with 0; equal distances are
ordered by id, rows without an id are left out; repeated rows are found (and
ask) once each; fewer rows than k give them all; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecheck.llm.common import stage

K = 10
LEAST_BITS, MOST_BITS = 8, 32
HALF_BITS = 16
SALTS = 64


def codes(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int) -> DataFrame:
    """``id`` and code words ``w0``, ``w1``, ... (64 bits each) of all rows with an id and a vector."""
    rows = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")

    def word(k: int) -> Column:
        part = F.slice("v", 64 * k + 1, 64)
        bits = F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when((x > 0) & ~F.isnan(x), 1).otherwise(0).cast("bigint")))
        missing = min(64, dimensions - 64 * k) - F.size(part)
        return F.call_function("shiftleft", bits, missing.cast("int"))

    return rows.select("id", *[word(k).alias(f"w{k}") for k in range(-(-dimensions // 64))])


def segment_bounds(dimensions: int, entries: int) -> list[tuple[int, int]]:
    """First and last (excluded) dimension of each segment: the fewest segments of nearly equal
    width that are no wider than log2 of the number of different codes, so that a value
    holds at least one code on average (from 2^LEAST_BITS codes to 2^(MOST_BITS + 1))."""
    width = min(max(entries.bit_length() - 1, LEAST_BITS), MOST_BITS)
    m = -(-dimensions // width)
    return [(dimensions * j // m, dimensions * (j + 1) // m) for j in range(m)]


def segment_of(prefix: str, first: int, last: int, dimensions: int) -> Column:
    """Dimensions ``first`` to ``last`` (excluded) of a code in words ``<prefix>0``, ``<prefix>1``, ..., as a number."""
    value = F.lit(0).cast("bigint")
    for k in range(first // 64, (last - 1) // 64 + 1):
        held = min(64, dimensions - 64 * k)  # bits of this word, the first dimension in the highest
        start, stop = max(first - 64 * k, 0), min(last - 64 * k, held)
        piece = F.shiftrightunsigned(F.col(f"{prefix}{k}"), held - stop).bitwiseAND(F.lit((1 << (stop - start)) - 1))
        value = F.shiftleft(value, stop - start).bitwiseOR(piece)
    return value


def _segments(prefix: str, dimensions: int, bounds: list[tuple[int, int]]) -> list[Column]:
    return [segment_of(prefix, first, last, dimensions) for first, last in bounds]


def _masks(bits: int, ones: int) -> list[int]:
    """All numbers of some bits with a number of them set."""
    return [sum(1 << b for b in chosen) for chosen in combinations(range(bits), ones)]


def masks(width: int, radius: int) -> Column:
    """Choices of ``radius`` bits of a segment, as an array of (low, high) lists: every mask is one
    of ``low`` with one of ``high``, so that no list is longer than 2^HALF_BITS."""
    low, high = min(width, HALF_BITS), max(width - HALF_BITS, 0)
    kind = "array<bigint>"
    splits = [(_masks(low, radius - h), [x << HALF_BITS for x in _masks(high, h)]) for h in range(max(0, radius - low), min(high, radius) + 1)]
    return F.array(*[F.struct(F.lit(a).cast(kind).alias("low"), F.lit(b).cast(kind).alias("high")) for a, b in splits])


def index_entries(coded: DataFrame, words: list[str], k: int) -> DataFrame:
    """Distinct codes with their ``k`` smallest ids; very frequent codes are cut down per salt first."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    inside = F.row_number().over(Window.partitionBy(*words, "salt").orderBy("id"))
    few = coded.withColumn("salt", salt).withColumn("place", inside).where(F.col("place") <= k)
    place = F.row_number().over(Window.partitionBy(*words).orderBy("id"))
    few = few.withColumn("place", place).where(F.col("place") <= k)
    return few.groupBy(*words).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def search(vectors: DataFrame, queries: DataFrame, id_column: str, vector_column: str, k: int = K) -> DataFrame:
    """The ``k`` rows of ``vectors`` nearest to each row of ``queries``: ``query_id``,
    ``rank`` (from 1), ``neighbour_id``, ``distance``."""
    dimensions = vectors.agg(F.max(F.size(f"`{vector_column}`"))).first()[0] or 0
    if dimensions < 1:
        return vectors.sparkSession.createDataFrame([], RESULT)
    own = codes(vectors, id_column, vector_column, dimensions)
    words = [c for c in own.columns if c != "id"]
    entries = stage(index_entries(own, words, k), "codes")
    rows = own.limit(k).count()  # fewer rows than k can never fill k places
    bounds = segment_bounds(dimensions, entries.count())
    widths = [last - first for first, last in bounds]
    segments = _segments("w", dimensions, bounds)
    m = len(segments)
    pairs = F.array(*[F.struct(F.lit(j).alias("segment"), s.alias("value")) for j, s in enumerate(segments)])
    index = stage(entries.select(*words, "ids", F.inline(pairs)), "index")
    asked = stage(codes(queries, id_column, vector_column, dimensions), "queries")
    asking = [f"q{w}" for w in words]
    open_queries = asked.select(*[F.col(w).alias(q) for w, q in zip(words, asking, strict=True)]).distinct()
    open_queries = stage(open_queries.withColumn("worst", F.lit(dimensions)), "open")
    best = None
    found = []
    own_segments, query_segments = segments, _segments("qw", dimensions, bounds)
    apart = [F.bit_count(a.bitwiseXOR(b)) for a, b in zip(own_segments, query_segments, strict=True)]
    distance = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(q))) for w, q in zip(words, asking, strict=True)), F.lit(0))
    for radius in range(max(widths) + 1):
        nears = [F.struct(F.lit(j).alias("segment"), s.alias("near"), F.lit(w).alias("width")) for j, (s, w) in enumerate(zip(query_segments, widths, strict=True))]
        probes = open_queries.select("*", F.inline(F.array(*nears)))
        wide = F.when(F.col("width") == max(widths), masks(max(widths), radius)).otherwise(masks(min(widths), radius))
        probes = probes.select(*asking, "worst", "segment", "near", F.inline(wide))
        probes = probes.select(*asking, "worst", "segment", "near", "high", F.explode("low").alias("mask"))
        probes = probes.select(*asking, "worst", "segment", F.col("near").bitwiseXOR(F.col("mask")).alias("near"), F.explode("high").alias("mask"))
        probes = probes.withColumn("value", F.col("near").bitwiseXOR(F.col("mask"))).drop("near", "mask")
        # both sides are shuffled: the probes are many more than their source's size tells Spark
        met = probes.hint("merge").join(index, ["segment", "value"])
        first = F.lit(True)
        for j, a in enumerate(apart):  # the entry's first nearest segment reports it, in that segment's round
            first = first & F.when(F.col("segment") > j, a > radius).otherwise(a >= radius)
        met = met.where(first).withColumn("distance", distance).where("distance <= worst")
        new = met.select(*asking, F.explode("ids").alias("neighbour_id"), "distance")
        both = new if best is None else new.unionByName(best)
        rank = F.row_number().over(Window.partitionBy(*asking).orderBy("distance", "neighbour_id"))
        best = stage(both.withColumn("rank", rank).where(F.col("rank") <= k), "best")
        covered = m * (radius + 1) - 1
        state = open_queries.join(best.groupBy(*asking).agg(F.count("*").alias("have"), F.max("distance").alias("far")), asking, "left")
        done = (F.col("have") >= rows) & (F.col("far") <= covered)
        state = stage(state.select(*asking, F.coalesce(done, F.lit(False)).alias("done"), F.when(F.col("have") >= rows, F.col("far")).otherwise(dimensions).alias("worst")), "state")
        closed = state.where("done").select(*asking)
        found.append(best.join(closed, asking, "left_semi"))
        open_queries = state.where("NOT done").select(*asking, "worst")
        if open_queries.isEmpty():
            break
        best = best.join(open_queries.select(*asking), asking, "left_semi").drop("rank")
    nearest = found[0]
    for f in found[1:]:
        nearest = nearest.unionByName(f)
    renamed = asked.select(F.col("id").alias("query_id"), *[F.col(w).alias(q) for w, q in zip(words, asking, strict=True)])
    return renamed.join(nearest, asking).select("query_id", F.col("rank").cast("int"), "neighbour_id", F.col("distance").cast("int"))


RESULT = "query_id bigint, rank int, neighbour_id bigint, distance int"


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every row whose id is divisible by 100, against all rows (itself included)."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 100 = 0"), "vec_id", "embedding")


# DuckDB: every query against every row.
OP5_SQL = """
WITH c AS (
  SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '')::BIT AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), p AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, bit_count(xor(q.code, r.code)) AS distance
  FROM c q, c r WHERE q.vec_id % 100 = 0
), t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, CAST(distance AS INTEGER) AS distance FROM t WHERE rank <= 10
"""
