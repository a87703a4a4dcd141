"""A minimal acyclic transducer from words to token ids.

Words sharing a suffix share states. The output is a number: every edge carries
how many words precede it, and the sum along a path is the word's rank, which
points into a table of id sequences (so outputs never stop states from being
shared). The whole is one integer array in a file that readers memory-map; its
size is bounded by the number of words it is built from.
"""

from __future__ import annotations

import numpy as np


def build(words: list[bytes], ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Compile distinct words (any order) with their flat ids and offsets."""
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    edges: list[list[tuple[int, int]]] = []  # of registered states: (byte, target)
    final: list[bool] = []
    path: list[tuple[list, bool]] = [([], False)]  # open states of the last word: edges, final

    def close(depth: int, last: bytes) -> None:
        """Register the open states below ``depth``; equal ones become one state."""
        while len(path) > depth + 1:
            out, end = path.pop()
            state = register.setdefault((tuple(out), end), len(edges))
            if state == len(edges):
                edges.append(out)
                final.append(end)
            path[-1][0].append((last[len(path) - 1], state))

    last = b""
    for i in order:
        word = words[i]
        common = next((k for k, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
        close(common, last)
        path.extend(([], False) for _ in word[common:])
        path[-1] = (path[-1][0], True)
        last = word
    close(0, last)
    root = len(edges)
    edges.append(path[0][0])
    final.append(path[0][1])
    count = [0] * len(edges)  # targets are registered before their sources
    keys, target, skip = [], [], []
    for s, out in enumerate(edges):
        below = int(final[s])
        for byte, t in out:
            keys.append(s << 8 | byte)
            target.append(t)
            skip.append(below)
            below += count[t]
        count[s] = below
    flat = [ids[at[i] : at[i + 1]] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in flat], dtype=np.int64)]) if flat else np.zeros(1, np.int64)
    head = np.array([root, len(edges), len(keys), len(order)], np.int64)
    return np.concatenate([head, np.array(final, np.int64), np.array(keys, np.int64), np.array(target, np.int64), np.array(skip, np.int64), offsets, *flat]).astype(np.int64)


class Lexicon:
    """Reader of a compiled (memory-mapped) transducer."""

    def __init__(self, data: np.ndarray):
        self.root, states, n_edges, n_words = (int(x) for x in data[:4])
        cuts = np.cumsum([4, states, n_edges, n_edges, n_edges, n_words + 1])
        self.final, self.keys, self.target, self.skip, self.at = (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        self.ids = data[cuts[-1] :]
        self.states = states

    @classmethod
    def open(cls, path: str) -> Lexicon:
        return cls(np.load(path, mmap_mode="r"))

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 for words that are not accepted; all words walk together."""
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        start = np.cumsum(length) - length
        state, number = np.full(n, self.root, np.int64), np.zeros(n, np.int64)
        live, depth = np.arange(n), 0
        while len(live := live[length[live] > depth]) and len(self.keys):
            want = state[live] << 8 | flat[start[live] + depth]
            edge = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[edge] == want
            state[live[~hit]] = -1
            live, edge = live[hit], edge[hit]
            state[live] = self.target[edge]
            number[live] += self.skip[edge]
            depth += 1
        if not len(self.keys):
            state[length > 0] = -1
        return np.where((state >= 0) & (self.final[state] == 1), number, -1)

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        """Id sequences (little-endian 32-bit) of known words, None for others."""
        rank = self.ranks(words).tolist()
        return [None if r < 0 else self.ids[self.at[r] : self.at[r + 1]].astype("<u4").tobytes() for r in rank]
