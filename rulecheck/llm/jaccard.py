"""Exact n-gram Jaccard join with a token-group matrix.

A document's set holds its distinct word shingles; two documents link when their
sets' Jaccard similarity is at least ``num/den``. Result: each document's set
size and component (connected by links).

1. Every (token, document) fact goes to a hash bucket of the token, which counts
   the documents holding it and returns that to the documents, for repeated
   tokens only. A document whose repeated tokens are fewer than its set's share
   ``num/den`` cannot link with anything and is done.
2. Equal sets become one class; only its representative goes on.
3. Similar representatives are partitioned into groups (by a min-hash of the set;
   large groups are cut to a bounded number of tokens) and linked inside their group.
   Samples of the linked sets meet once more by another min-hash; what links then
   shares a label, and later steps compare only across labels.
4. The token-group matrix leads queries to groups. Tokens are ordered from rare to
   frequent, and for a pair that links, its first common token leaves enough tokens
   behind in both sets. So a row of the matrix names, for one token, the groups in
   which some set has it that early, with what it says about them: set sizes, tokens
   left, labels. A query looks only at groups that could hold a partner of another
   label.
5. Each group that is looked at stores the union of all its members' tokens. The
   tokens that a query shares with the union are counted; the count bounds the
   overlap with every member. Only groups whose bound suffices are opened, and the
   query is compared with their members exactly. Components are computed over all
   links.

No link between different texts is lost: every bound holds for any pair that
links. Compared are queries against opened groups in blocks, not all pairs;
links leave a task as a spanning forest.

Hot tokens and groups: a token that HOT_IN_BLOCK documents of one block of input
hold is marked frequent there and its facts go straight to their documents, past
the token's bucket; frequent tokens come last in the order. Rows of the matrix for
tokens that MANY documents hold are summed up per group before the shuffle and
their queries salted. Queries of one group are dealt to parts and salted, so a group
that very many look at is compared in many tasks.

Tokens are 48 bits within their bucket, classes 128 bits.

Cases: texts without words have an empty set and link with nothing, not even with
each other; texts with fewer words than a shingle have one token, the whole
sequence; a null ``doc_id`` counts as smaller than all others; rows of equal
``doc_id`` are told apart by a 63-bit hash of their text, repeated rows are equal sets;
an empty table gives no rows; other columns of ``docs`` are ignored. Texts are
read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecheck.llm.common import NO_ID, document_key, id_of, partitions, ship_package, shuffled, stage
from rulecheck.llm.components import components
from rulecheck.llm.kernels import mix, shingles, slices, text_buffer, words
from rulecheck.llm.packed import bucket_of, home_of, segments

WIDTH, NUM, DEN = 5, 80, 100
INPUT_BYTES = 4 << 20
HOT_IN_BLOCK = 8  # documents of one block that make a token frequent
FREQUENT = 255
MANY = FREQUENT - 1  # documents that hold a token, from which its rows of the matrix are salted
GROUP_TOKENS = 1 << 16
QUERIES_PER_TASK = 512
QUERY_PARTS = 64
SALTS = 8
_REM = np.uint64((1 << 48) - 1)


def needed(sizes: np.ndarray | int, other: np.ndarray | int, num: int, den: int):
    """Smallest overlap with which sets of these sizes link: ceil(num (a + b) / (num + den))."""
    return -((-num * (sizes + other)) // (num + den))


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays))


def _expand(data: bytes, *kinds: str) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, out, lo = len(flat) // sum(widths), [], 0
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(flat[lo : lo + width * n].reshape(width, n).T).view(kind).ravel())
        lo += width * n
    return out


def _delta(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


_BUCKET = pa.schema([("bucket", pa.int32()), ("facts", pa.binary()), ("marks", pa.binary()), ("settled", pa.binary()), ("sizes", pa.binary())])
_BUCKET_SQL = "bucket int, facts binary, marks binary, settled binary, sizes binary"
_HOME = pa.schema([("home", pa.int32()), ("bucket", pa.int32()), ("sizes", pa.binary()), ("facts", pa.binary())])
_HOME_SQL = "home int, bucket int, sizes binary, facts binary"
_DOCUMENT_SQL = "_k bigint, _h bigint, n int, digest binary, tokens binary, rare int, g1 bigint, g2 bigint"
_DOCUMENT = pa.schema(
    [("_k", pa.int64()), ("_h", pa.int64()), ("n", pa.int32()), ("digest", pa.binary()), ("tokens", pa.binary()), ("rare", pa.int32())]
    + [("g1", pa.int64()), ("g2", pa.int64())]
)


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a block of texts, sorted by value: value, row; and set sizes."""
    value, row = shingles(words(*text_buffer(batch.column("text")), lower=True), WIDTH)
    order = np.lexsort((row, value))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new], np.bincount(row[new], minlength=len(batch))


def _pack_facts(key: np.ndarray, tie: np.ndarray, rem: np.ndarray, *more: np.ndarray) -> bytes:
    """Facts sorted by document, so that keys are small differences."""
    order = np.lexsort((rem, tie, key))
    k, t, r = key[order], tie[order], rem[order]
    return _squeeze(_delta(k), _delta(t), r.astype("<u4"), (r >> np.uint64(32)).astype("<u2"), *[m[order] for m in more])


def _unpack_facts(data: bytes, *more: str) -> list[np.ndarray]:
    key, tie, low, high, *rest = _expand(data, "<i8", "<i8", "<u4", "<u2", *more)
    return [np.cumsum(key), np.cumsum(tie), low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32), *rest]


def _pack_tokens(key: np.ndarray, tie: np.ndarray, token: np.ndarray) -> bytes:
    order = np.lexsort((token, tie, key))
    return _squeeze(_delta(key[order]), _delta(tie[order]), token[order])


def _facts(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: (token, document) facts and the tokens marked frequent by this block of input.
    Per home, as a bucket of the same number: set sizes, and facts about those frequent tokens,
    which are settled and need not meet the others of their token."""
    for batch in batches:
        _, offs = text_buffer(batch.column("text"))
        for lo, hi in slices(offs, INPUT_BYTES):
            part = batch.slice(lo, hi - lo)
            key, tie = part.column("_k").to_numpy(), part.column("_h").to_numpy()
            value, row, size = _sets(part)
            out: dict[str, list] = {name: [] for name in _BUCKET.names}
            home = home_of(key, tie, buckets)
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            times = np.diff(np.append(np.flatnonzero(new), len(value)))
            hot = np.repeat(times >= HOT_IN_BLOCK, times)
            rem, bucket = value & _REM, bucket_of(value, buckets)
            for a, b in segments(bucket):
                k, t, r, h = key[row[a:b]], tie[row[a:b]], rem[a:b], hot[a:b]
                marks = _squeeze(r[h & new[a:b]]) if h.any() else None
                for name, x in zip(_BUCKET.names, (int(bucket[a]), _pack_facts(k[~h], t[~h], r[~h]), marks, None, None), strict=True):
                    out[name].append(x)
            own, token = row[hot], bucket[hot].astype(np.uint64) << np.uint64(48) | rem[hot]
            at = np.argsort(home[own], kind="stable")
            own, token, edge = own[at], token[at], np.searchsorted(home[own[at]], np.arange(buckets + 1))
            by = np.argsort(home, kind="stable")
            for a, b in segments(home[by]):
                o, number = by[a:b], int(home[by[a]])
                lo, hi = edge[number], edge[number + 1]
                settled = _pack_tokens(key[own[lo:hi]], tie[own[lo:hi]], token[lo:hi]) if hi > lo else None
                for name, x in zip(_BUCKET.names, (number, None, None, settled, _squeeze(key[o], tie[o], size[o].astype("<i4"))), strict=True):
                    out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=_BUCKET)


def _count(homes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: the facts about repeated tokens, with a class of frequency, sent to their
    documents' homes in one row each; set sizes and settled facts that came along go on to
    their home, the facts as they come."""
    facts, marks, sizes, number = [], [], [], 0
    for batch in batches:
        rows = batch.to_pydict()
        for b, f, m, z in zip(rows["bucket"], rows["facts"], rows["marks"], rows["sizes"], strict=True):
            number = b
            if z is not None:
                sizes.append(_expand(z, "<i8", "<i8", "<i4"))
            if f is not None:
                facts.append(f)
            if m is not None:
                marks.append(_expand(m, "<u8")[0])
        done = [s for s in rows["settled"] if s is not None]
        if done:
            yield pa.RecordBatch.from_pydict({"home": [number] * len(done), "bucket": [None] * len(done), "sizes": [None] * len(done), "facts": done}, schema=_HOME)
    if sizes:
        packed = _squeeze(*[np.concatenate([z[i] for z in sizes]) for i in range(3)])
        yield pa.RecordBatch.from_pydict({"home": [number], "bucket": [number], "sizes": [packed], "facts": [None]}, schema=_HOME)
    if not facts:
        return
    # facts stay compressed but for their tokens, until it is known which tokens repeat
    token, times = np.unique(np.concatenate([_unpack_facts(f)[2] for f in facts]), return_counts=True)
    kind = np.minimum(times, FREQUENT - 1).astype(np.uint8)
    if marks:
        kind[np.isin(token, np.concatenate(marks))] = FREQUENT
    token, kind = token[kind > 1], kind[kind > 1]
    found: list[list[np.ndarray]] = []
    for f in facts if len(token) else ():
        key, tie, rem = _unpack_facts(f)
        at = np.minimum(np.searchsorted(token, rem), len(token) - 1)
        held = token[at] == rem
        found.append([key[held], tie[held], rem[held], kind[at[held]]])
    if found:
        yield from _homeward(homes, number, *[np.concatenate([f[i] for f in found]) for i in range(4)])


def _homeward(homes: int, bucket: int, key: np.ndarray, tie: np.ndarray, rem: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
    home = home_of(key, tie, homes)
    by = np.argsort(home, kind="stable")
    out: dict[str, list] = {name: [] for name in _HOME.names}
    for a, b in segments(home[by]):
        o = by[a:b]
        for name, x in zip(_HOME.names, (int(home[o[0]]), bucket, None, _pack_facts(key[o], tie[o], rem[o], kind[o])), strict=True):
            out[name].append(x)
    yield pa.RecordBatch.from_pydict(out, schema=_HOME)


def _assemble(num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One home: all its documents; those that can link with the repeated tokens of their set, rare ones first."""
    sizes, facts = [], []
    for batch in batches:
        rows = batch.to_pydict()
        for b, z, f in zip(rows["bucket"], rows["sizes"], rows["facts"], strict=True):
            if z is not None:
                sizes.append(_expand(z, "<i8", "<i8", "<i4"))
            elif b is None:
                k, t, r = _expand(f, "<i8", "<i8", "<u8")
                facts.append((np.cumsum(k), np.cumsum(t), r, np.full(len(r), FREQUENT, np.uint8)))
            else:
                k, t, r, c = _unpack_facts(f, "u1")
                facts.append((k, t, np.uint64(b) << np.uint64(48) | r, c))
    if not sizes:
        return
    key, tie, n = (np.concatenate([s[i] for s in sizes]) for i in range(3))
    fk, ft, token, kind = (np.concatenate([f[i] for f in facts]) for i in range(4)) if facts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint8))
    del facts
    by = np.lexsort((token, kind, ft, fk))
    fk, ft, token, kind = fk[by], ft[by], token[by], kind[by]
    start = np.flatnonzero(np.concatenate([[True], (fk[1:] != fk[:-1]) | (ft[1:] != ft[:-1])])[: len(fk)])
    where = {(int(fk[i]), int(ft[i])): (int(i), int(j)) for i, j in zip(start, np.append(start[1:], len(fk))[: len(start)], strict=True)}
    out: dict[str, list] = {name: [] for name in _DOCUMENT.names}
    held = 0
    for k, t, size in zip(key.tolist(), tie.tolist(), n.tolist(), strict=True):
        a, b = where.get((k, t), (0, 0))
        own, often = token[a:b], kind[a:b]
        if len(own) > 1:
            new = np.concatenate([[True], (own[1:] != own[:-1]) | (often[1:] != often[:-1])])
            own, often = own[new], often[new]
        row = [k, t, size, None, None, None, None, None]
        if size and den * len(own) >= num * size:
            data = own.tobytes()
            alone = b"" if len(own) == size else f"{k},{t}".encode()
            least = [int(mix(own ^ np.uint64(s)).min().view(np.int64)) for s in (0, 0x5851F42D4C957F2D)]
            row[3:] = hashlib.md5(data + alone).digest(), data, int(np.searchsorted(often, MANY)), *least
            held += len(data)
        for name, x in zip(_DOCUMENT.names, row, strict=True):
            out[name].append(x)
        if held > INPUT_BYTES or len(out["_k"]) >= 10_000:
            yield pa.RecordBatch.from_pydict(out, schema=_DOCUMENT)
            out, held = {name: [] for name in _DOCUMENT.names}, 0
    yield pa.RecordBatch.from_pydict(out, schema=_DOCUMENT)


def document_sets(docs: DataFrame, num: int, den: int) -> DataFrame:
    """Every document's set size; for those that can link, their repeated tokens (8 bytes each,
    rare ones first), the set's digest and two min-hashes. Written to shared storage."""
    spark = ship_package(docs.sparkSession)
    buckets = partitions(spark)
    facts = keyed(docs).select("_k", "_h", "text").mapInArrow(lambda b: _facts(buckets, b), _BUCKET_SQL)
    counted = facts.repartitionById(buckets, "bucket").mapInArrow(lambda b: _count(buckets, b), _HOME_SQL)
    return stage(counted.repartitionById(buckets, "home").mapInArrow(lambda b: _assemble(num, den, b), _DOCUMENT_SQL), "sets")


def keyed(docs: DataFrame) -> DataFrame:
    """Order key, tie-break and text of documents, and all columns as ``_rest``."""
    return docs.select(
        *document_key(),
        F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_rest"),
    )


class Group:
    """A group of documents: the union of their tokens and, once it is opened, who holds each."""

    def __init__(self, sizes: list[int], sets: list[np.ndarray]):
        self.sizes, self.sets = np.array(sizes, np.int64), sets
        self.union = np.unique(np.concatenate(sets))
        self.rows: np.ndarray | None = None

    def shared(self, tokens: np.ndarray) -> np.ndarray:
        """Places in the union of the tokens that it holds."""
        t = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        return t[self.union[t] == tokens]

    def qualifies(self, size: int, shared: int, num: int, den: int) -> bool:
        """Whether so many tokens shared with the union suffice to link with any member."""
        least = np.maximum(self.sizes, -(-num * size // den)).min()
        return shared > 0 and shared >= needed(size, int(least), num, den)

    def overlaps(self, places: np.ndarray) -> np.ndarray:
        """How many of these tokens of the union each member holds."""
        if self.rows is None:
            flat = np.searchsorted(self.union, np.concatenate(self.sets))
            by = np.argsort(flat, kind="stable")
            self.rows = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])[by]
            self.at = np.searchsorted(flat[by], np.arange(len(self.union) + 1))
        lens = self.at[places + 1] - self.at[places]
        cells = np.repeat(self.at[places] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        return np.bincount(self.rows[cells], minlength=len(self.sizes))

    def linked(self, size: int, tokens: np.ndarray, num: int, den: int) -> np.ndarray:
        """Members that link with a set of this size; the group is opened only if its union qualifies."""
        places = self.shared(tokens)
        if not self.qualifies(size, len(places), num, den):
            return np.zeros(0, np.int64)
        both = self.overlaps(places)
        return np.flatnonzero((both > 0) & (den * both >= num * (self.sizes + size - both)))


def _streamed(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal values of some columns, in rows sorted by them."""
    last, held = None, {}
    for batch in batches:
        rows = batch.to_pydict()
        for i, at in enumerate(zip(*[rows[c] for c in by], strict=True)):
            if at != last:
                if last is not None:
                    yield last, held
                last, held = at, {c: [] for c in rows}
            for c, x in rows.items():
                held[c].append(x[i])
    if last is not None:
        yield last, held


def _edges(pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if pairs:
        a, b = zip(*pairs, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _blocks(key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Rows with equal keys, in rows sorted by them, in blocks of about GROUP_TOKENS tokens at most."""
    last, held, size = None, {}, 0
    for batch in batches:
        rows = batch.to_pydict()
        for i, at in enumerate(rows[key]):
            more = len(rows["tokens"][i]) // 8
            if last is not None and (at != last or size + more > GROUP_TOKENS):
                yield held
                last = None
            if last is None:
                last, held, size = at, {c: [] for c in rows}, 0
            for c, x in rows.items():
                held[c].append(x[i])
            size += more
    if last is not None:
        yield held


def _roots(num: int, den: int, names: list[int], sizes: list[int], tokens: list[bytes]) -> np.ndarray:
    """The smallest name that each member of a block is linked with, over any number of links."""
    root = np.array(names, np.int64)
    if len(names) > 1:
        sets = [np.frombuffer(t, np.uint64) for t in tokens]
        group = Group(sizes, sets)
        for i, (size, own) in enumerate(zip(sizes, sets, strict=True)):
            near = np.unique(root[group.linked(size, own, num, den)])
            if len(near) > 1 or len(near) == 1 and near[0] != root[i]:
                near = np.union1d(near, root[i : i + 1])
                root[np.isin(root, near)] = near[0]
    return root


_GROUP = pa.schema(
    [("gid", pa.int64()), ("root", pa.int64()), ("sample", pa.bool_()), ("node", pa.int64()), ("n", pa.int32())]
    + [("tokens", pa.binary()), ("rare", pa.int32()), ("g2", pa.int64())]
)
_GROUP_SQL = "gid bigint, root bigint, sample boolean, node bigint, n int, tokens binary, rare int, g2 bigint"


def _group(num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of sets with equal min-hashes, linked inside: ``root`` is the smallest member that
    a set is linked with. One set per root and second min-hash is marked as a sample."""
    for g in _blocks("g1", batches):
        root = _roots(num, den, g["node"], g["n"], g["tokens"]).tolist()
        seen: set[tuple[int, int]] = set()
        sample = [not ((r, h) in seen or seen.add((r, h))) for r, h in zip(root, g["g2"], strict=True)]
        columns = {"gid": [g["node"][0]] * len(root), "root": root, "sample": sample} | {c: g[c] for c in ("node", "n", "tokens", "rare", "g2")}
        yield pa.RecordBatch.from_pydict(columns, schema=_GROUP)


def _meet(num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Roots whose samples share a second min-hash and link."""
    for g in _blocks("g2", batches):
        # samples of one root need no exact comparison with each other, but each may link with other roots
        low = _roots(num, den, list(range(len(g["root"]))), g["n"], g["tokens"])
        least: dict[int, int] = {}
        for name, root in zip(low.tolist(), g["root"], strict=True):
            least[name] = min(root, least.get(name, root))
        yield from _edges(sorted({(r, least[x]) for r, x in zip(g["root"], low.tolist(), strict=True) if r != least[x]}))


def groups_of(reps: DataFrame, num: int, den: int) -> DataFrame:
    """Groups of similar sets. Sets are dealt by ranges of their min-hash, so that a value that
    very many share spans several tasks, and cut into blocks of a bounded number of tokens."""
    parts = partitions(reps.sparkSession)
    rows = reps.select("g1", "node", "n", "tokens", "rare", "g2").repartitionByRange(parts, "g1", "node").sortWithinPartitions("g1", "node")
    return stage(rows.mapInArrow(lambda b: _group(num, den, b), _GROUP_SQL), "groups")


def meetings(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Links between groups' roots by samples of equal second min-hash (``a``, and a smaller ``b``)."""
    parts = partitions(groups.sparkSession)
    rows = groups.where("sample").select("g2", "root", "n", "tokens").repartitionByRange(parts, "g2", "root").sortWithinPartitions("g2", "root")
    return stage(rows.mapInArrow(lambda b: _meet(num, den, b), "a bigint, b bigint"), "meetings")


_ROW_SQL = "token bigint, many boolean, node bigint, gid bigint, label bigint, n bigint, remaining bigint"


def _matrix(num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens early enough in a set's order to be the first that it shares with one it links with."""
    for batch in batches:
        rows = batch.to_pydict()
        for lo in range(0, len(rows["node"]), 256):
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for node, gid, label, n, rare, data in zip(*[rows[c][lo : lo + 256] for c in ("node", "gid", "label", "n", "rare", "tokens")], strict=True):
                tokens = np.frombuffer(data, np.int64)
                count = min(max(len(tokens) - -(-num * n // den) + 1, 0), len(tokens))
                left = np.arange(len(tokens), len(tokens) - count, -1)
                many = np.arange(count) >= rare
                for x, y in zip(out, (tokens[:count], many, *[np.full(count, v) for v in (node, gid, label, n)], left), strict=True):
                    x.append(y)
            arrays = [pa.array(np.concatenate(x).astype(bool if i == 1 else np.int64)) for i, x in enumerate(out)]
            yield pa.RecordBatch.from_arrays(arrays, names=["token", "many", "node", "gid", "label", "n", "remaining"])


def _dealt(matrix: DataFrame, parts: int) -> DataFrame:
    """Rows of the matrix by token. Tokens that few documents hold are one run of rows. Those
    that many hold are summed up per group before the shuffle; queries with such a token are
    dealt to SALTS runs, and each run gets all the token's group summaries first."""
    salt = F.when(F.col("many"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0).cast("int")
    queries = matrix.select("token", salt.alias("salt"), F.lit(True).alias("query"), "node", "gid", "label", F.col("label").alias("high"), "n", F.col("n").alias("most"), "remaining")
    groups = matrix.where("many").groupBy("token", "gid").agg(
        F.min("label").alias("label"), F.max("label").alias("high"), F.min("n").alias("n"), F.max("n").alias("most"), F.max("remaining").alias("remaining")
    )
    copies = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    groups = groups.select("token", copies, F.lit(False).alias("query"), F.lit(0).cast("bigint").alias("node"), "gid", "label", "high", "n", "most", "remaining")
    return groups.unionByName(queries).repartition(parts, "token", "salt").sortWithinPartitions("token", "salt", "query")


def _open(num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the matrix, sorted by token: the groups that each query must look at."""
    found: dict[int, list[np.ndarray]] = {}
    held: dict[str, np.ndarray] | None = None
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal size
        gids, parts, nodes = [], [], []
        for gid, x in found.items():
            every = np.unique(np.concatenate(x))
            part = (mix(every.view(np.uint64)) % np.uint64(QUERY_PARTS)).astype(np.int64) if len(every) > QUERIES_PER_TASK else np.zeros(len(every), np.int64)
            for p in np.unique(part).tolist():
                gids.append(gid)
                parts.append(p)
                nodes.append(_squeeze(every[part == p]))
        yield pa.RecordBatch.from_arrays([pa.array(gids, pa.int64()), pa.array(parts, pa.int64()), pa.array(nodes, pa.binary())], names=["gid", "part", "nodes"])
        found.clear()
        size = 0

    def rows_of(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        nonlocal size
        new = np.flatnonzero(np.concatenate([[True], (c["token"][1:] != c["token"][:-1]) | (c["salt"][1:] != c["salt"][:-1])]))
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(c["token"])], strict=True):
            if b - a < 2:
                continue
            first = a + int(np.searchsorted(c["query"][a:b], True))
            if first > a:
                g, least, most, low, high, rest = (c[x][a:first] for x in ("gid", "n", "most", "label", "high", "remaining"))
            else:
                by = a + np.argsort(c["gid"][a:b], kind="stable")
                at = np.flatnonzero(np.diff(c["gid"][by], prepend=c["gid"][by[0]] - 1))
                g = c["gid"][by][at]
                least, most = np.minimum.reduceat(c["n"][by], at), np.maximum.reduceat(c["n"][by], at)
                low, high = np.minimum.reduceat(c["label"][by], at), np.maximum.reduceat(c["label"][by], at)
                rest = np.maximum.reduceat(c["remaining"][by], at)
            if len(g) < 2 or low.min() == high.max():
                continue
            for lo in range(first, b, 1024):
                q = slice(lo, min(lo + 1024, b))
                nq, lq = c["n"][q, None], c["label"][q, None]
                fits = (c["gid"][q, None] < g) & (den * most >= num * nq) & (den * nq >= num * least)
                fits &= (low != high) | (low != lq)
                fits &= np.minimum(c["remaining"][q, None], rest) >= needed(nq, np.maximum(least, -(-num * nq // den)), num, den)
                for j in np.flatnonzero(fits.any(axis=0)).tolist():
                    found.setdefault(int(g[j]), []).append(c["node"][q][fits[:, j]])
                size += int(fits.sum())
                if size > 1 << 21:
                    yield from flush()

    for batch in batches:
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if held is not None:
            cols = {c: np.concatenate([held[c], x]) for c, x in cols.items()}
        if not len(cols["token"]):
            continue
        last = (cols["token"] != cols["token"][-1]) | (cols["salt"] != cols["salt"][-1])
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        held = {c: x[cut:] for c, x in cols.items()}
        if cut:
            yield from rows_of({c: x[:cut] for c, x in cols.items()})
        if not held["query"][0] and held["query"][-1]:  # all of the token's groups are here: its queries need not wait
            yield from rows_of(held)
            held = {c: x[~held["query"]] for c, x in held.items()}
    if held is not None:
        yield from rows_of(held)
    if found:
        yield from flush()


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries of each group (of a group that very many look at: of one part of them), once each."""
    for (gid, part), g in _streamed(batches, "gid", "part"):
        nodes = np.unique(np.concatenate([_expand(x, "<i8")[0] for x in g["nodes"]]))
        for lo in range(0, len(nodes), 10_000):
            some = nodes[lo : lo + 10_000]
            same = [pa.array(np.full(len(some), x)) for x in (gid, part, len(nodes))]
            yield pa.RecordBatch.from_arrays([*same[:2], pa.array(some), same[2]], names=["gid", "part", "node", "queries"])


def _compare(num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups that were looked at: members first, then the queries. The tokens that a query shares
    with the group's union are counted; groups that qualify are opened. Links between labels."""
    for _, g in _streamed(batches, "gid", "part", "salt"):
        members = [i for i, q in enumerate(g["query"]) if not q]
        queries = [i for i, q in enumerate(g["query"]) if q]
        if not members or not queries:
            continue
        sets = [np.frombuffer(t, np.uint64) for t in g["tokens"]]
        group = Group([g["n"][i] for i in members], [sets[i] for i in members])
        labels = np.array([g["label"][i] for i in members])
        pairs = set()
        for i in queries:
            near = group.linked(g["n"][i], sets[i], num, den)
            pairs.update((g["label"][i], label) for label in np.unique(labels[near]).tolist() if label != g["label"][i])
        yield from _edges(sorted(pairs))


def link_across(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Links between labels (``a``, ``b``), by the token-group matrix."""
    parts = partitions(groups.sparkSession)
    matrix = groups.select("node", "gid", "label", "n", "rare", "tokens").mapInArrow(lambda b: _matrix(num, den, b), _ROW_SQL)
    looked = _dealt(matrix, parts).mapInArrow(lambda b: _open(num, den, b), "gid bigint, part bigint, nodes binary")
    looked = looked.repartition(parts, "gid", "part").sortWithinPartitions("gid", "part")
    looked = stage(looked.mapInArrow(_distinct, "gid bigint, part bigint, node bigint, queries bigint"), "looked")
    salts = F.ceil(F.col("queries") / QUERIES_PER_TASK)
    sets = groups.select("node", "label", "n", "tokens")
    queries = looked.join(shuffled(sets), "node").select("gid", "part", F.pmod(F.xxhash64("node"), salts).alias("salt"), F.lit(True).alias("query"), "label", "n", "tokens")
    targets = looked.groupBy("gid", "part").agg(F.max(salts).alias("salts"))
    members = groups.select("gid", "label", "n", "tokens").join(shuffled(targets), "gid")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    members = members.select("gid", "part", each, F.lit(False).alias("query"), "label", "n", "tokens")
    keys = ["gid", "part", "salt"]
    rows = members.unionByName(queries).repartition(parts, *keys).sortWithinPartitions(*keys, "query")
    return rows.mapInArrow(lambda b: _compare(num, den, b), "a bigint, b bigint")


def salted_join(rows: DataFrame, table: DataFrame, key: str, *by: str) -> DataFrame:
    """Rows joined to a table with one row per ``key``, of which one key may have a large
    share of all rows: they are spread over SALTS partitions each, by the columns ``by``."""
    spread = rows.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    repeated = table.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return spread.join(shuffled(repeated), [key, "salt"]).drop("salt")


def jaccard_components(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``_k``, ``_h`` (key of a document, see ``keyed``), ``n`` (set size), and ``first_k``,
    ``first_h``: the key of the smallest document of its component; one row per document."""
    sets = document_sets(docs, num, den)
    able = sets.where("digest IS NOT NULL")
    same = [F.first(c).alias(c) for c in ("n", "tokens", "rare", "g1", "g2")]
    reps = able.groupBy("digest").agg(F.min(F.struct("_k", "_h")).alias("first"), *same)
    reps = stage(reps.withColumn("node", F.monotonically_increasing_id()), "classes")
    groups = groups_of(reps, num, den)
    met = meetings(groups, num, den)
    # labels only spare comparisons, so one step from root to root is enough here
    labels = met.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("label"))
    labelled = stage(groups.drop("sample", "g2").join(shuffled(labels), "root", "left").withColumn("label", F.coalesce("label", "root")), "labelled")
    inside = groups.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    links = inside.unionByName(met).unionByName(link_across(labelled, num, den))
    whole = components(links)
    classes = reps.select("node", "digest", "first").join(shuffled(whole), "node", "left").withColumn("component", F.coalesce("label", "node"))
    classes = stage(classes.select("digest", "component", "first"), "components")
    firsts = classes.groupBy("component").agg(F.min("first").alias("first"))
    of = salted_join(classes.select("digest", "component"), firsts, "component", "digest").select("digest", "first")
    linked = salted_join(able.select("_k", "_h", "n", "digest"), of, "digest", "_k", "_h")
    linked = linked.select("_k", "_h", "n", F.col("first._k").alias("first_k"), F.col("first._h").alias("first_h"))
    alone = sets.where("digest IS NULL").select("_k", "_h", "n", F.col("_k").alias("first_k"), F.col("_h").alias("first_h"))
    return linked.unionByName(alone)


def keep_first(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Rows of ``docs``, all columns, without the documents that link (over any number of
    links) to one of smaller ``doc_id``; of repeated rows one stays. Texts without words stay."""
    found = jaccard_components(docs, num, den)
    first = stage(found.where("_k = first_k AND _h = first_h").select("_k", "_h", "n").distinct(), "first")
    kept = keyed(docs).join(shuffled(first), ["_k", "_h"]).select("_k", "_h", "n", "_rest")
    copy = F.row_number().over(Window.partitionBy("_k", "_h").orderBy(F.lit(0)))
    one = kept.where("n > 0").withColumn("copy", copy).where("copy = 1")  # Spark keeps one row of a task's equal rows before the shuffle
    return one.select("_rest.*").unionByName(kept.where("n = 0").select("_rest.*"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: set size and component of every document."""
    found = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(id_of("_k", "_h").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), id_of("first_k", "first_h").alias("component_id"))
