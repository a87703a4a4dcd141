"""Prefix trie over rebuilt conversations, by whole-sequence collapse.

A conversation is rebuilt from the head of its family's first conversation (the
first ``h`` turns of conversation ``c - c % 100``, h = crc32(c) % 6) and its own
turns after its first ``h``. The trie's nodes are the distinct prefixes of all
rebuilt conversations, the empty one included.

1. Turns become digests and lengths; texts are read once and never shuffled.
   They are dealt by ranges of (conversation, turn), so a conversation with very
   many turns spans many tasks. Each task follows its rows; what the task before
   left in the same conversation (turns, hash, code points) is added afterwards,
   a few numbers per task. That gives each turn's number, and for rebuilt
   conversations each prefix's 127-bit rolling hash, its node.
2. Identical rebuilt conversations collapse into one weighted sequence with a list
   of ends; only the one of smallest id goes on.
3. Sequences that are proper prefixes of others are dropped by an anti-join against
   all proper prefixes: what stays are the leaves.
4. Weighted prefixes are grouped by node: members, leaves below, smallest member.
   Each node has one owner, the smallest sequence through it, and the nodes of an
   owner are the tail of its path. So a subtree's saved code points are two sums
   over sequences: weighted code points from the node on, less code points from
   the node on that the sequence owns. No node is sent to its ancestors.

Sequences are joined to their prefixes in blocks of prefixes, and parents to
children in SALTS copies, so that no long sequence or wide node meets one task.
The ids that end at a node are packed into runs by the tasks that sort them
before they are hashed in order; the hash of one node's ends is one stream.

Cases: null role or text counts as empty; turns are ordered by number, null first,
turns of one number by a digest of role and text; repeated rows are turns of their
own. Rows without a conversation id belong to no conversation and make no node. A
conversation whose head is missing or short takes what there is and may have no
turns; it then ends at the root. An empty table has no nodes, not even a root.
Other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import partitions, ship_package, stage

FAMILY, HEADS = 100, 6
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1F3A7B2C94D8E6F0B5A7931
PATH_BLOCK = 4096
ENDS_PER_ROW = 10_000
SALTS = 8

_TURN_SQL = "part int, c bigint, depth bigint, key binary, before binary, node binary, points bigint, upto bigint"
_TURN = pa.schema(
    [("part", pa.int32()), ("c", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("before", pa.binary()), ("node", pa.binary())]
    + [("points", pa.int64()), ("upto", pa.int64())]
)


def turns_of(conversations: DataFrame) -> DataFrame:
    """``c``, ``turn``, ``key`` (digest of role and text) and ``points`` (code points of the text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn"), key.alias("key"), F.char_length(text).cast("bigint").alias("points"))


def _raw(state: int) -> bytes:
    return state.to_bytes(16, "big")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one task: number of turns, hash and code points of each prefix within
    the task. A row without a key is a conversation's root."""
    part, last, depth, state, upto = TaskContext.get().partitionId(), None, 0, 0, 0
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _TURN.names}
        for c, key, points in zip(*(batch.column(x).to_pylist() for x in ("c", "key", "points")), strict=True):
            if c != last:
                last, depth, state, upto = c, 0, 0, 0
            before = state
            if key is not None:
                depth += 1
                state = (state * BASE + int.from_bytes(key, "big") + 1) % PRIME
                upto += points
            for x, y in zip(out.values(), (part, c, depth, key, _raw(before), _raw(state), points, upto), strict=True):
                x.append(y)
        yield pa.RecordBatch.from_pydict(out, schema=_TURN)


def _continue(carried: dict[int, tuple[int, int, int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task's first conversation continue what earlier tasks hold of it."""
    for batch in batches:
        parts, ids = batch.column("part").to_pylist(), batch.column("c").to_pylist()
        late = [i for i, (p, c) in enumerate(zip(parts, ids, strict=True)) if p in carried and carried[p][0] == c]
        if not late:
            yield batch
            continue
        rows = batch.to_pydict()
        for i in late:
            _, depth, state, upto = carried[parts[i]]
            here = rows["depth"][i]
            for name, turns in (("before", here - 1), ("node", here)):
                rows[name][i] = _raw((int.from_bytes(rows[name][i], "big") + state * pow(BASE, turns, PRIME)) % PRIME)
            rows["depth"][i], rows["upto"][i] = here + depth, rows["upto"][i] + upto
        yield pa.RecordBatch.from_pydict(rows, schema=_TURN)


def followed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Prefixes of all conversations: ``depth``, ``node`` and ``upto`` (code points) up to and
    with each row, ``before`` (the parent's node), in the given order within ``c``."""
    spark = ship_package(rows.sparkSession)
    dealt = rows.repartitionByRange(partitions(spark), "c", *order).sortWithinPartitions("c", *order)
    done = stage(dealt.select("c", "key", "points").mapInArrow(_follow, _TURN_SQL), name)
    ends = done.groupBy("part").agg(F.min("c").alias("first"), F.max(F.struct("c", "depth", "node", "upto")).alias("last"))
    carried: dict[int, tuple[int, int, int, int]] = {}
    held = None
    for r in sorted(ends.collect()):  # one row per task
        last, start = r["last"], (0, 0, 0)
        if held is not None and held[0] == r["first"]:
            carried[r["part"]] = held
            if last["c"] == held[0]:
                start = held[1:]
        here = last["depth"]
        state = (int.from_bytes(last["node"], "big") + start[1] * pow(BASE, here, PRIME)) % PRIME
        held = (last["c"], here + start[0], state, last["upto"] + start[2])
    return done.mapInArrow(lambda b: _continue(carried, b), _TURN_SQL).drop("part")


def heads(c: Column) -> Column:
    """How many turns a conversation takes from its family's first one."""
    return F.crc32(c.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Prefixes of all rebuilt conversations, see ``followed``; each has its root."""
    turns = followed(turns_of(conversations), ["turn", "key"], "turns").select("c", "depth", "key", "points")
    ids = turns.where("depth = 1").select("c")
    own = turns.where(F.col("depth") > heads(F.col("c"))).select("c", F.lit(1).alias("source"), "depth", "key", "points")
    lent = turns.where((F.col("depth") < HEADS) & (F.col("c") % FAMILY == 0)).withColumnRenamed("c", "head")
    taken = ids.withColumn("head", F.col("c") - F.col("c") % FAMILY).join(lent, "head").where(F.col("depth") <= heads(F.col("c")))
    taken = taken.select("c", F.lit(0).alias("source"), "depth", "key", "points")
    roots = ids.select("c", F.lit(-1).alias("source"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("bigint").alias("points"))
    return followed(roots.unionByName(taken).unionByName(own), ["source", "depth"], "rebuilt")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids that end at one node, as text."""
    last, ids = None, []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"depth": last[0], "node": last[1], "first": ids[0], "ids": ",".join(map(str, ids))}], schema=_RUN)

    for batch in batches:
        for depth, node, c in zip(*(batch.column(x).to_pylist() for x in ("depth", "node", "c")), strict=True):
            if ids and ((depth, node) != last or len(ids) >= ENDS_PER_ROW):
                yield row()
                ids = []
            last = (depth, node)
            ids.append(c)
    if ids:
        yield row()


_RUN_SQL = "depth bigint, node binary, first bigint, ids string"
_RUN = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's runs, in order."""
    last, state = None, None
    for batch in batches:
        out: dict[str, list] = {"depth": [], "node": [], "ends": []}

        def close(out: dict[str, list] = out) -> None:
            for x, y in zip(out.values(), (*last, state.hexdigest()), strict=True):
                x.append(y)

        for depth, node, ids in zip(*(batch.column(x).to_pylist() for x in ("depth", "node", "ids")), strict=True):
            if (depth, node) == last:
                state.update(b"," + ids.encode())
                continue
            if last is not None:
                close()
            last, state = (depth, node), hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pydict(out, schema=_ENDS)
    if last is not None:
        yield pa.RecordBatch.from_pydict({"depth": [last[0]], "node": [last[1]], "ends": [state.hexdigest()]}, schema=_ENDS)


_ENDS_SQL = "depth bigint, node binary, ends string"
_ENDS = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("ends", pa.string())])


def end_digests(ended: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their ids, ascending, joined by commas."""
    parts = partitions(ended.sparkSession)
    order = ["depth", "node", "c"]
    runs = ended.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*order).mapInArrow(_packed, _RUN_SQL)
    dealt = runs.repartition(parts, "depth", "node").sortWithinPartitions("depth", "node", "first")
    return dealt.mapInArrow(_hashed, _ENDS_SQL)


def _along(paths: DataFrame, sequences: DataFrame, *facts: str) -> DataFrame:
    """Prefixes joined to facts about their sequences (``c``, ``length``), block by block."""
    block = F.floor(F.col("depth") / PATH_BLOCK)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("length") / PATH_BLOCK))
    return paths.withColumn("block", block).join(sequences.select("c", *facts, F.explode(blocks).alias("block")), ["c", "block"]).drop("block")


def trie(prefixes: DataFrame) -> DataFrame:
    """All nodes of the trie over ``rebuilt`` prefixes: ``conv_id``, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    ended = prefixes.groupBy("c").agg(F.max(F.struct("depth", "node", "upto")).alias("end")).select("c", "end.*")
    ended = stage(ended, "ended")
    sequences = ended.groupBy("depth", "node").agg(F.min("c").alias("c"), F.count("*").alias("weight"), F.max("upto").alias("total"))
    sequences = stage(sequences.withColumnRenamed("depth", "length"), "sequences")
    paths = stage(_along(prefixes.drop("key"), sequences, "weight", "length", "total"), "paths")

    inner = paths.where("depth < length").select(F.col("depth").alias("length"), "node").distinct()
    leaves = sequences.join(inner, ["length", "node"], "left_anti").select("c", F.lit(1).alias("leaf"))
    owned = paths.groupBy("depth", "node").agg(F.min(F.struct("c", (F.col("upto") - F.col("points")).alias("base"))).alias("by"))
    owned = owned.groupBy(F.col("by.c").alias("c")).agg(F.min(F.struct("depth", "by.base")).alias("own"))
    facts = sequences.select("c", "length").join(leaves, "c", "left").join(owned, "c", "left")
    facts = stage(facts.select("c", "length", F.coalesce("leaf", F.lit(0)).alias("leaf"), "own"), "facts")

    base = F.col("upto") - F.col("points")
    own = F.when(F.col("own").isNull(), 0).otherwise(F.col("total") - F.greatest(base, F.col("own.base")))
    saved = F.col("weight") * (F.col("total") - base) - own
    nodes = _along(paths.drop("length"), facts, "leaf", "own").groupBy("depth", "node").agg(
        F.min("c").alias("conv_id"),
        F.max("before").alias("before"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"),
    )
    nodes = stage(nodes, "nodes")

    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("before"), F.col("conv_id").alias("parent_conv_id"))
    above = above.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    out = nodes.join(below, ["depth", "node"], "left").join(end_digests(ended), ["depth", "node"], "left")
    out = out.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(above, ["depth", "before", "salt"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"),
        F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the trie over all rebuilt conversations."""
    return trie(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))


_BITS = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"


def _sql() -> str:
    rounds = ["t0 AS (SELECT b, b::BIGINT AS v FROM range(256) r(b))"]
    rounds += [f"t{i + 1} AS (SELECT b, {_BITS.format('v')} AS v FROM t{i})" for i in range(8)]
    digits = "list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i:i])::BIGINT)"
    crc = f"list_reduce({digits}, lambda a, x: xor(a >> 8, vs[(xor(a, x) & 255) + 1]), 4294967295::BIGINT)"
    return "WITH " + ", ".join([
        *rounds,
        "lut AS MATERIALIZED (SELECT list(v ORDER BY b) AS vs FROM t8)",
        "turns AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, "
        "md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id)",
        f"headed AS MATERIALIZED (SELECT c, own, xor({crc}, 4294967295) % {HEADS} AS h FROM turns, lut)",
        f"whole AS MATERIALIZED (SELECT a.c, coalesce(b.own[1:a.h], []) || a.own[a.h + 1:] AS s FROM headed a LEFT JOIN turns b ON b.c = a.c - a.c % {FAMILY})",
        "prefixes AS MATERIALIZED (SELECT c, d, s[1:d] AS p, len(s) = d AS is_end FROM whole, unnest(range(0, len(s) + 1)) t(d))",
        "nodes AS MATERIALIZED (SELECT d, p, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '') AS ends FROM prefixes GROUP BY d, p)",
        "children AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL)",
        "placed AS MATERIALIZED (SELECT n.*, coalesce(k.n, 0) AS kids FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.p = n.p)",
        "below AS (SELECT u.p[1:a] AS p, a AS d, sum((u.n - 1) * (CASE WHEN u.d = 0 THEN 0 ELSE length(u.p[u.d].t) END)) AS saved, count(*) FILTER (u.kids = 0) AS leaves "
        "FROM placed u, unnest(range(0, u.d + 1)) t(a) GROUP BY ALL)",
    ]) + (
        " SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, n.kids::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, "
        "b.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256 FROM placed n JOIN below b ON b.d = n.d AND b.p = n.p "
        "LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = n.p[1:n.d - 1]"
    )


OP11_SQL = _sql()
