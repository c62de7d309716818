"""Byte-level BPE of many short words at once, with the merges of a tokenizer file.

Words of about the same number of bytes form a matrix of symbols; in each round every word that still has a mergeable pair replaces
its pair of lowest rank, the leftmost of equal ones, as the library does. Tests compare it with the library.
"""

from __future__ import annotations

import json

import numpy as np

MAX_BYTES = 48              # longer words are left to the library
_NONE = np.int32(2 ** 31 - 1)
_ROWS = 1 << 15             # words of a matrix


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """Merges of a byte-level BPE model; `usable` where the file holds nothing but these."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], _byte_letters()
        vocab = model["vocab"]
        self.usable = (model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
                       and not model.get("end_of_word_suffix") and not model.get("ignore_merges") and all(c in vocab for c in letters))
        if not self.usable:
            return
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        # A hash table in arrays: pairs that share a slot follow each other from there.
        self.bits = (8 * len(keys)).bit_length()
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NONE, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.ranks[slot[first]] = keys[first], first
            left = np.setdiff1d(left, first)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where it isn't merged or a place is empty (-1)."""
        key = left << 32 | right
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where((found == key) & (right >= 0), self.ranks[slot], _NONE)
        at = np.flatnonzero((found != key) & (found >= 0) & (right >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[at]]
            hit = found == key[at]
            out[at[hit]] = self.ranks[slot[at[hit]]]
            at = at[~hit & (found >= 0)]
        return out

    def _encode(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols, merged until nothing can be; free places at the end are -1."""
        n, size = symbols.shape
        out = symbols
        rows = np.arange(n)                                 # rows that still change, in `symbols`
        ranks = np.full((n, size), _NONE, np.int32)         # of the pair that begins at each place
        if size > 1:
            ranks[:, :-1] = self._rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, size - 1)
        place = np.arange(size)
        while True:
            best = ranks.argmin(axis=1)
            value = ranks[np.arange(len(rows)), best]
            go = value != _NONE
            if not go.all():
                out[rows[~go]] = symbols[~go]
                rows, symbols, ranks, best, value = rows[go], symbols[go], ranks[go], best[go], value[go]
            if not len(rows):
                return out
            own = np.arange(len(rows))
            take = np.minimum(place + (place > best[:, None]), size - 1)        # closes the gap behind the merged symbol
            symbols, ranks = np.take_along_axis(symbols, take, 1), np.take_along_axis(ranks, take, 1)
            symbols[:, -1], ranks[:, -1] = -1, _NONE
            symbols[own, best] = self.merged[value]
            after = symbols[own, np.minimum(best + 1, size - 1)]
            ranks[own, best] = np.where(best + 1 < size, self._rank(symbols[own, best], after), _NONE)
            has = np.flatnonzero(best > 0)
            ranks[has, best[has] - 1] = self._rank(symbols[has, best[has] - 1], symbols[has, best[has]])

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (at most MAX_BYTES long) as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out: list[bytes] = [b""] * len(words)
        wide = -(-sizes // 4) * 4                       # few matrices: sizes are rounded up
        for size in np.unique(wide[sizes > 0]).tolist():
            of_size = np.flatnonzero(wide == size)
            for lo in range(0, len(of_size), _ROWS):
                at = of_size[lo:lo + _ROWS].tolist()
                raw = np.frombuffer(b"".join([words[i].ljust(size, b"\0") for i in at]), np.uint8).reshape(-1, size)
                done = self._encode(np.where(np.arange(size) < sizes[at][:, None], self.of_byte[raw], -1))
                ends = (4 * (done >= 0).sum(axis=1)).tolist()
                data = done.astype("<u4").tobytes()
                for k, (i, end) in enumerate(zip(at, ends)):
                    out[i] = data[4 * size * k:4 * size * k + end]
        return out
