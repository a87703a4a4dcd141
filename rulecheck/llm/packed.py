"""Compact rows for shuffling many small facts: hashes, and (document, position) places.

A place is a document's order key (64 bits), a tie-break (64 bits, see
``common.document_key``) and a word position (32 bits). Arrays of places are stored as differences and compressed,
so a run of places in one document costs about a byte each.
"""

from __future__ import annotations

import numpy as np
import zstandard

from rulecheck.llm.kernels import mix

U32 = np.uint32


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper 32 bits; sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def segments(sorted_values: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal values in a sorted array."""
    at = np.flatnonzero(np.diff(sorted_values, prepend=sorted_values[:1] - 1, append=sorted_values[-1:] + 1)) if len(sorted_values) else np.zeros(1, np.int64)
    return list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def pack_places(key: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> bytes:
    parts = [np.diff(key, prepend=key.dtype.type(0)), np.diff(tie, prepend=tie.dtype.type(0)), np.diff(pos, prepend=pos.dtype.type(0))]
    flat = b"".join(p.astype(t).view(np.uint8).reshape(len(p), np.dtype(t).itemsize).T.tobytes() for p, t in zip(parts, ("<i8", "<i8", "<i4"), strict=True))
    return zstandard.ZstdCompressor(level=1).compress(flat)


def unpack_places(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(flat) // 20
    out = []
    for lo, width, kind in ((0, 8, "<i8"), (8, 8, "<i8"), (16, 4, "<i4")):
        cells = flat[lo * n : (lo + width) * n].reshape(width, n).T
        out.append(np.cumsum(np.ascontiguousarray(cells).view(kind).ravel(), dtype=kind))
    return out[0], out[1], out[2]


def home_of(key: np.ndarray, tie: np.ndarray, homes: int) -> np.ndarray:
    """The partition in which all facts about a document meet. Documents of one id (or
    none) but different texts have different homes."""
    x = mix(key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mix(tie.view(np.uint64)))
    return bucket_of(x, homes)
