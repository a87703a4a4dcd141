"""Byte-pair merging of many words at once.

``BpeModel`` holds a tokenizer file's vocabulary and merge ranks as arrays; it
is bounded by the vocabulary, so it can be broadcast. ``encode_words`` merges a
whole batch of distinct words together: words of one length form a matrix of
symbol ids, and each step merges the leftmost pair of lowest rank in every row.
That is the order in which the published algorithm merges, so ids are exact.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np

LONG_WORD = 192  # bytes; longer words go one by one to the library's own merge queue
_NONE = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {}, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


@dataclass
class BpeModel:
    """Vocabulary and merges of one tokenizer file."""

    spec: str  # the file's JSON text, for texts that hold special tokens
    suffix: str  # marks a word's last symbol, or empty
    special: list[str]
    pieces: list[str]  # token strings by id
    first: np.ndarray  # id of each byte inside a word
    last: np.ndarray  # id of each byte at a word's end
    keys: np.ndarray  # open-addressing table of pairs (a << 32 | b), -1 where empty
    ranks: np.ndarray
    merged: np.ndarray
    _library: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_library": None}

    @property
    def library(self):
        """The published implementation, for the few texts with special tokens."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Table slots of pairs of symbol ids, -1 where no merge exists."""
        mask = len(self.keys) - 1
        want = (a.astype(np.int64) << 32) | b
        slot = _spread(want, mask)
        found = self.keys[slot]
        out = np.where(found == want, slot, -1)
        open_ = np.flatnonzero((found != want) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            found = self.keys[slot[open_]]
            hit = found == want[open_]
            out[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (found != -1)]
        return out


def _spread(keys: np.ndarray, mask: int) -> np.ndarray:
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(20)).astype(np.int64) & mask


def load_model(path: str) -> BpeModel:
    """Read a ``tokenizers`` JSON file of kind BPE with a byte-level alphabet."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    data = json.loads(spec)
    model = data["model"]
    if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
        raise ValueError(f"unsupported tokenizer model in {path}")
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    special = [t["content"] for t in data["added_tokens"]]
    pieces = [""] * (1 + max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]))
    for piece, i in vocab.items():
        pieces[i] = piece
    for t in data["added_tokens"]:
        pieces[t["id"]] = t["content"]
    chars = byte_characters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    size = 1 << max(4, (len(pairs) * 6).bit_length())
    keys, ranks, merged = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32), np.zeros(size, np.int32)
    packed = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
    slots = _spread(packed, size - 1) if len(packed) else packed
    for rank, ((a, b), key, slot) in enumerate(zip(pairs, packed.tolist(), slots.tolist(), strict=True)):
        while keys[slot] not in (-1, key):
            slot = (slot + 1) & (size - 1)
        keys[slot], ranks[slot], merged[slot] = key, min(rank, ranks[slot]), vocab[a + b]
    first = np.array([vocab[c] for c in chars], np.int32)
    last = np.array([vocab[c + suffix] for c in chars], np.int32)
    return BpeModel(spec, suffix, special, pieces, first, last, keys, ranks, merged)


def encode_words(model: BpeModel, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words (UTF-8 bytes, none empty): flat ids and offsets."""
    n = len(words)
    if any(len(w) > LONG_WORD for w in words):
        return _encode_mixed(model, words)
    length = np.fromiter(map(len, words), np.int64, n)
    flat = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum(length)])
    ids = model.first[flat]
    ids[at[1:] - 1] = model.last[flat[at[1:] - 1]]
    out_len = length.copy()
    order = np.argsort(length, kind="stable")
    bounds = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        width = int(length[order[lo]])
        if width < 2:
            continue
        step = max(1, (1 << 17) // width)
        for k in range(lo, hi, step):
            rows = order[k : min(hi, k + step)]
            cells = at[rows][:, None] + np.arange(width)
            block, size = _merge(model, ids[cells])
            ids[cells] = block
            out_len[rows] = size
    keep = np.arange(len(ids)) - np.repeat(at[:-1], length) < np.repeat(out_len, length)
    return ids[keep], np.concatenate([[0], np.cumsum(out_len)])


def _encode_mixed(model: BpeModel, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
    flat, at = encode_words(model, [words[i] for i in short]) if short else (np.zeros(0, np.int32), np.zeros(1, np.int64))
    parts = dict(zip(short, np.split(flat, at[1:-1]), strict=True)) if short else {}
    chars = byte_characters()
    for i, w in enumerate(words):
        if i not in parts:
            parts[i] = np.array([t.id for t in model.library.model.tokenize("".join(chars[b] for b in w))], np.int32)
    out = [parts[i] for i in range(len(words))]
    return np.concatenate(out), np.concatenate([[0], np.cumsum([len(p) for p in out])])


def _merge(model: BpeModel, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row of a matrix of symbol ids as far as it goes: the ids, and how many.

    Rows that still merge do so once per step, so they all have the same length.
    """
    done, size = block.copy(), np.full(len(block), block.shape[1], np.int64)
    live = np.arange(len(block))
    slot = model.lookup(block[:, :-1].ravel(), block[:, 1:].ravel()).astype(np.int32).reshape(len(block), -1)
    rank = np.where(slot >= 0, model.ranks[slot], _NONE)
    while True:
        pick = rank.argmin(axis=1)
        able = rank[np.arange(len(live)), pick] != _NONE
        if not able.all():
            rest, go = np.flatnonzero(~able), np.flatnonzero(able)
            done[live[rest], : block.shape[1]] = block[rest]
            size[live[rest]] = block.shape[1]
            live, block, rank, slot, pick = live[go], block[go], rank[go], slot[go], pick[go]
        if not len(live):
            return done, size
        rows, m = block.shape
        r = np.arange(rows)
        new = model.merged[slot[r, pick]]
        shift = np.arange(m - 1) + (np.arange(m - 1) > pick[:, None])
        block = np.take(block.ravel(), shift + (r * m)[:, None])
        block[r, pick] = new
        if m == 2:
            done[live, :1], size[live] = block, 1
            return done, size
        old = shift[:, :-1] + (r * (m - 1))[:, None]
        slot, rank = np.take(slot.ravel(), old), np.take(rank.ravel(), old)
        for side in (-1, 0):
            j = pick + side
            ok = np.flatnonzero((j >= 0) & (j < m - 2))
            if len(ok):
                at = j[ok]
                s = model.lookup(block[ok, at], block[ok, at + 1])
                slot[ok, at] = s
                rank[ok, at] = np.where(s >= 0, model.ranks[s], _NONE)
