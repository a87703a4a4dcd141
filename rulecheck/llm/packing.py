"""Hierarchical multi-length packing of tokenised documents into training sequences.

Every document becomes its token ids followed by an end id. Documents are
routed by length to tiers of context sizes (1024, 512, 256, 128): whole long
windows are cut off first, and what remains goes to the smallest tier that
holds it. Each tier is packed by itself; the gap behind a piece is filled from
the shorter tiers (largest piece that fits first, and a cut piece last), so a
sequence is closed only when its window is full. All window sizes are powers of
two. The sequences of a buffer are then spread over step groups of nearly equal
token counts.

Each task packs its own documents from a bounded buffer and carries open pieces
over, so there is no shuffle, a hot source is nothing special, and at most one
sequence per task is padded. Sequence ids hold the task's partition number.

Cases: null text is empty (one end id, so one piece); null ``doc_id`` is kept;
repeated rows are packed once each; an empty table gives no rows; extra columns
are ignored; a text of any length is cut at window ends.
"""

from __future__ import annotations

import heapq
import sys
import uuid
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.bpe import BpeModel, encode_words, load_model
from rulecheck.llm.common import documents, kept_in_worker, ship_package

TIERS = (1024, 512, 256, 128)
END_ID = 0
STEP_TOKENS = 16 * 1024
BUFFER_TOKENS = 1 << 18
BLOCK_BYTES = 1 << 21
CACHE_WORDS = 1_000_000
PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "sequence_length bigint, tier int, step_group bigint, ids binary"
)
# Fixed value: the split of text before byte-level merging, as published with the vocabulary:
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")  # pieces of their own behind an apostrophe that begins one
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)


@cache
def code_point_kinds() -> np.ndarray:
    """The kind of every code point, as the split's classes see it."""
    every = np.arange(sys.maxunicode + 1, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    kinds = np.full(len(every), OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(pattern, every):
            kinds[m.start() : m.end()] = kind
    kinds[ord(" ")] = SPACE
    return kinds


def piece_starts(codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places where the pieces of ``SPLIT`` begin in the code points of joined texts; ``firsts``
    holds the first place of each text that is not empty.

    Letters, numbers and other signs go on while their kind does, and take one space before
    them along. Of a run of white space before something else, the last one is by itself.
    """
    kinds = code_point_kinds()[codes]
    opens = np.zeros(len(codes) + 1, bool)  # a text begins here, or all end
    opens[firsts], opens[-1] = True, True
    begins, blank = opens.copy(), kinds >= BLANK
    begins[1:-1] |= np.where(blank[1:], ~blank[:-1], (kinds[1:] != kinds[:-1]) & (kinds[:-1] != SPACE))
    begins[:-2] |= blank[:-1] & ~blank[1:] & ~opens[1:-1]
    marks = np.flatnonzero(codes == ord("'"))
    marks = marks[begins[marks]]
    for ending in ENDINGS:
        at = marks[marks + len(ending) < len(codes)]
        for k, sign in enumerate(ending, 1):
            at = at[(codes[at + k] == ord(sign)) & ~opens[at + k]]
        begins[at + 1], begins[at + 1 + len(ending)] = False, True
    return np.flatnonzero(begins[:-1])


class ByteLevelEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, with a bounded cache of pieces.

    The texts of a call are split together and their distinct pieces looked up once;
    pieces that the cache does not hold are merged together.
    """

    def __init__(self, model: BpeModel, cache_words: int = CACHE_WORDS):
        self.model, self.most = model, cache_words
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}  # piece k has the ids from ends[k] to ends[k + 1]
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        special = {i for i, t in enumerate(texts) if any(s in t for s in self.model.special)}
        coded = self._encode([t if i not in special else "" for i, t in enumerate(texts)])
        for i in special:
            coded[i] = np.array(self.model.library.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return coded

    def _encode(self, texts: list[str]) -> list[bytes]:
        text = "".join(texts)
        if not text:
            return [b""] * len(texts)
        data = text.encode()
        plain = len(data) == len(text)
        codes = np.frombuffer(data, np.uint8) if plain else np.frombuffer(text.encode("utf-32-le"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = piece_starts(codes, np.append(0, ends[ends < len(text)]))
        at = starts if plain else np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[starts]
        offsets = np.append(at, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        slots, which = self._slots(_values(coded.dictionary)), coded.indices.to_numpy()
        first, size = self.ends[slots][which], np.diff(self.ends)[slots][which]
        until = np.append(0, np.cumsum(size))
        blob = self.ids[np.repeat(first - until[:-1], size) + np.arange(until[-1])].tobytes()
        bounds = (until[np.append(0, np.searchsorted(starts, ends))] * 4).tolist()
        return [blob[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _slots(self, pieces: list[bytes]) -> np.ndarray:
        """The slots of distinct pieces; those not held so far are merged and added."""
        if max(len(self.slots), len(self.ids) // 8) > self.most:
            self._clear()
        slots = np.fromiter(map(self.slots.get, pieces, repeat(-1)), np.int64, len(pieces))
        lacking = np.flatnonzero(slots < 0)
        if len(lacking):
            new = [pieces[i] for i in lacking.tolist()]
            ids, at = encode_words(self.model, new)
            slots[lacking] = np.arange(len(self.slots), len(self.slots) + len(new))
            self.slots.update(zip(new, slots[lacking].tolist(), strict=True))
            self.ids = np.concatenate([self.ids, ids.astype("<u4")])
            self.ends = np.concatenate([self.ends, self.ends[-1] + at[1:]])
        return slots


def _values(binary: pa.Array) -> list[bytes]:
    """``to_pylist`` of a whole binary array without nulls, some ten times as fast."""
    _, offsets, data = binary.buffers()
    ends, data = np.frombuffer(offsets, np.int32, len(binary) + 1).tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


class Packer:
    """Packs one task's documents; ``rows`` collects finished pieces."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.base, self.sequences, self.steps = task << 40, 0, 0
        self.waiting: dict[int, deque] = {t: deque() for t in tiers}  # pieces by tier
        self.held = 0
        self.closed: list[tuple[int, int, list]] = []  # tier, length, pieces

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, top = len(ids) // 4, self.tiers[0]
        whole = n - n % top
        for at in range(0, whole, top):
            self.closed.append((top, top, [(doc_id, at, top, n, ids)]))
        if n > whole:
            self._route((doc_id, whole, n - whole, n, ids))

    def _route(self, piece: tuple) -> None:
        tier = next(t for t in reversed(self.tiers) if piece[2] <= t)
        self.waiting[tier].append(piece)
        self.held += piece[2]

    def _take(self, tier: int) -> tuple:
        piece = self.waiting[tier].popleft()
        self.held -= piece[2]
        return piece

    def _next(self, gap: int) -> tuple | None:
        """A piece for a gap: the largest tier that fits as a whole, else the head of a piece."""
        fits = [t for t in self.tiers if self.waiting[t] and self.waiting[t][0][2] <= gap]
        if fits:
            return self._take(fits[0])
        tier = next((t for t in reversed(self.tiers) if self.waiting[t]), None)
        if tier is None:
            return None
        doc_id, start, length, n, ids = self._take(tier)
        self._route((doc_id, start + gap, length - gap, n, ids))
        return (doc_id, start, gap, n, ids)

    def pack(self, last: bool = False) -> list[tuple]:
        """Close every window that can be filled; with ``last`` the rest as well."""
        for tier in self.tiers:
            while self.waiting[tier] and (self.held >= tier or last):
                gap, pieces = tier, []
                while gap and (piece := self._take(tier) if not pieces else self._next(gap)) is not None:
                    pieces.append(piece)
                    gap -= piece[2]
                self.closed.append((tier, tier - gap, pieces))
        return self._steps()

    def _steps(self) -> list[tuple]:
        """Number the closed sequences and deal them to step groups, longest first to the emptiest."""
        closed, self.closed = self.closed, []
        if not closed:
            return []
        groups = max(1, round(sum(s[1] for s in closed) / self.step_tokens))
        heap, rows = [(0, g) for g in range(groups)], []
        for tier, length, pieces in sorted(closed, key=lambda s: -s[1]):
            load, g = heapq.heappop(heap)
            heapq.heappush(heap, (load + length, g))
            padded = length if length & (length - 1) == 0 else self.tiers[0]
            offset = 0
            for doc_id, start, size, n, ids in pieces:
                part = ids[4 * start : 4 * (start + size)]
                rows.append((doc_id, start, size, n, self.base + self.sequences, offset, padded, tier, self.base + self.steps + g, part))
                offset += size
            self.sequences += 1
        self.steps += groups
        return rows


def _buffers(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of documents that are packed together, by the bytes of their texts."""
    lo, held = 0, 0
    for hi, size in enumerate(sizes):
        if hi > lo and (held >= BUFFER_TOKENS * 4 or hi - lo >= 1024):
            yield lo, hi
            lo, held = hi, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def _blocks(buffers: Iterable[tuple[int, int]], sizes: list[int]) -> Iterator[list[tuple[int, int]]]:
    """Buffers in a row that are encoded together."""
    block, held = [], 0
    for lo, hi in buffers:
        block.append((lo, hi))
        held += sum(sizes[lo:hi])
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of packed sequences with their ids (``PIECE_SCHEMA``).

    ``tiers`` are powers of two, longest first. The vocabulary is read once and
    broadcast; its size is that of the tokenizer file.
    """
    if list(tiers) != sorted(tiers, reverse=True) or any(t & (t - 1) or t < 1 for t in tiers):
        raise ValueError("tiers must be powers of two, longest first")
    model = ship_package(docs.sparkSession).sparkContext.broadcast(load_model(tokenizer_path))
    end = np.array([end_id], "<u4").tobytes()
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(key, lambda: ByteLevelEncoder(model.value))
        packer = Packer(TaskContext.get().partitionId(), tiers, step_tokens)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for buffers in _blocks(_buffers(sizes), sizes):
                lo, hi = buffers[0][0], buffers[-1][1]
                coded = encoder.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                for a, b in buffers:
                    for doc_id, ids in zip(doc_ids[a:b], coded[a - lo : b - lo], strict=True):
                        packer.add(doc_id, ids + end)
                    yield from _batches(packer.pack())
        yield from _batches(packer.pack(last=True))

    return documents(docs, "doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_length")]
    + [("tier", pa.int32()), ("step_group", pa.int64()), ("ids", pa.binary())]
)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: pieces of all documents with the checksum of their ids."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return digest_columns(pieces)


def digest_columns(pieces: DataFrame) -> DataFrame:
    """The query's columns: ids replaced by their checksum."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_length", "tier", "step_group"
    )
