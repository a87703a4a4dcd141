"""Vectorised text kernels shared by the operators (numpy over Arrow buffers).

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; texts are handled
as UTF-8, so words, shingles and windows never depend on Python string objects.
Null texts have no words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=U64)
_SEEDS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
_ODD = (U64(0xD6E8FEB86659FD93), U64(0xFF51AFD7ED558CCB))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit values: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(29)
    return x


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (nulls empty) and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(offsets: np.ndarray, most_bytes: int, most_rows: int = 1 << 30) -> list[tuple[int, int]]:
    """Row ranges of at most ``most_bytes`` text bytes and ``most_rows`` rows each (one row at least)."""
    out, lo, n = [], 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n, lo + most_rows)
        out.append((lo, hi))
        lo = hi
    return out


@dataclass
class Words:
    """Words of a block of texts: byte starts and ends, and row offsets into them."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # rows[i]:rows[i+1] are the words of text i

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts())

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of every word; seeds 0 and 1 are independent."""
        n = len(self.starts)
        length = self.ends - self.starts
        h = mix(length.astype(U64) * _ODD[seed] + _SEEDS[seed])
        if n == 0:
            return h
        buf = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        load = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
        active, at, left = None, self.starts, length
        while True:
            chunk = load[at] & _KEEP[np.minimum(left, 8)]
            if active is None:
                h = mix(h ^ (chunk * _ODD[seed]))
            else:
                h[active] = mix(h[active] ^ (chunk * _ODD[seed]))
            more = np.flatnonzero(left > 8)
            if not len(more):
                return h
            active = more if active is None else active[more]
            at, left = at[more] + 8, left[more] - 8


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Split texts (bytes and row offsets) into words; ``lower`` folds A-Z."""
    if lower:
        raw = _LOWER[raw]
    solid = np.empty(len(raw) + 2, dtype=bool)
    solid[0] = solid[-1] = False
    np.logical_not(_SPACE[raw], out=solid[1:-1])
    begin = solid[1:-1] & ~solid[:-2]
    finish = solid[1:-1] & ~solid[2:]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    begin[edge] = solid[1:-1][edge]
    finish[edge - 1] = solid[1:-1][edge - 1]
    starts = np.flatnonzero(begin)
    return Words(raw, starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets))


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every run of ``width`` consecutive values (shorter input: none)."""
    if len(h) < width:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        have, size = h, 1
        out, done = None, 0
        left = width
        while left:
            if left & 1:
                if out is None:
                    out, done = have, size
                else:
                    m = len(h) - done - size + 1
                    out = mix(out[:m] * U64(0x9FB21C651E98DF25) + have[done : done + m])
                    done += size
            left >>= 1
            if left:
                m = len(h) - 2 * size + 1
                have = mix(have[:m] * U64(0x9FB21C651E98DF25) + have[size : size + m])
                size *= 2
    return out[: len(h) - width + 1]


def window_starts(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at which a window of ``width`` words fits into its text, and their texts."""
    count = np.maximum(np.diff(rows) - width + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    return rows[:-1][row] + (np.arange(len(row)) - first[row]), row


def shingles(w: Words, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes with their text index: every run of ``width`` words, or the
    whole sequence of a text with fewer words; texts without words have none."""
    h = w.hashes(seed)
    at, row = window_starts(w.rows, width)
    value = rolling(h, width)[at] if len(at) else np.zeros(0, U64)
    count = w.counts()
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        acc = mix(count[short].astype(U64) + _SEEDS[seed])
        for j in range(width - 1):
            has = count[short] > j
            acc[has] = mix(acc[has] * U64(0x9FB21C651E98DF25) + h[w.rows[short[has]] + j])
        value, row = np.concatenate([value, acc]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        value, row = value[order], row[order]
    return value, row
