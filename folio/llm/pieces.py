"""Texts as byte pieces, and ragged results remembered for pieces met before.

The public byte-level pattern joins at most one space to the token after it, and looks beyond a
token only after a run of white space. So a single space between two characters that are not white
space always starts a token: a text may be cut in front of it, and its pieces (mostly a space and a
word with its punctuation) are encoded one by one with the same result. What could be Unicode
white space next to the space forbids the cut, which costs time and changes nothing.

``Ragged`` keeps results as one array and finds them by a piece's 64-bit hash; it keeps the pieces' bytes as well and
compares them before it gives a result, so pieces with one hash never get each other's. It holds up to
``limit`` pieces and starts anew beyond that, so its memory is bounded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from folio.llm.common import Words, same_runs

_ASCII_WS = np.zeros(256, dtype=bool)
_ASCII_WS[[0x20, *range(0x09, 0x0E)]] = True
_WIDE_FIRST = np.zeros(256, dtype=bool)  # first bytes of wider white space
_WIDE_FIRST[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE_MIDDLE = np.zeros(256, dtype=bool)  # bytes before their last one
_WIDE_MIDDLE[[0xC2, 0x80, 0x81, 0x9A]] = True


class Pieces(Words):
    """Every byte belongs to a piece; pieces start with a text or with a safe space."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        cut = np.zeros(n + 1, dtype=bool)
        if n > 2:
            bare = data == 0x20
            solid = ~_ASCII_WS[data]
            cut[1 : n - 1] = bare[1:-1] & solid[:-2] & solid[2:] & ~_WIDE_FIRST[data[2:]]
            cut[2:n] &= ~((data[1:-1] >= 0x80) & _WIDE_MIDDLE[data[:-2]])
            inner = offsets[(offsets > 0) & (offsets < n)]
            cut[inner - 1] = False  # a text's last byte
        cut[offsets[offsets < n]] = True
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(cut[:n])
        self.end = np.append(self.start[1:], n) if len(self.start) else self.start
        self.at = np.searchsorted(self.start, offsets)


class Ragged:
    def __init__(self, kind, limit: int = 3_000_000):
        self.kind, self.limit = kind, limit
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)  # where a piece's result starts, and its size
        self.size = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)  # where its bytes start, and their number
        self.length = np.zeros(0, np.int64)
        self.values, self.used = np.zeros(1 << 12, self.kind), 0
        self.bytes, self.filled = np.zeros(1 << 12, np.uint8), 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        return at, self.key[at] == keys

    def _remember(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        self.values, first = _appended(self.values, self.used, values), self.used + np.cumsum(sizes) - sizes
        own = data[np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]
        self.bytes, begin = _appended(self.bytes, self.filled, own), self.filled + np.cumsum(length) - length
        self.used, self.filled = self.used + len(values), self.filled + len(own)
        key = np.concatenate([self.key, keys])
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        for name, more in (("first", first), ("size", sizes), ("begin", begin), ("length", length)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order].astype(np.int64))

    def gather(
        self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """(values of all pieces in order, size of each). Piece ``i`` is ``data[start[i]:end[i]]``; ``make(places)`` gives (sizes, values) of new ones."""
        length = end - start
        keys, place, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.key) + len(keys) > self.limit:
            self.clear()
        _, known = self._find(keys)
        if not known.all():
            new = place[~known]
            sizes, values = make(new)
            self._remember(keys[~known], data, start[new], length[new], np.asarray(sizes, np.int64), values)
        at = self._find(keys)[0][back]
        first, size = self.first[at], self.size[at]
        same = self.length[at] == length
        same[same] = same_runs(data, start[same], self.bytes[: self.filled], self.begin[at[same]], length[same])
        values = self.values
        if not same.all():  # another piece with the same hash: its own result, which nobody remembers
            odd = np.flatnonzero(~same)
            sizes, own = make(odd)
            first[odd], size[odd] = self.used + np.cumsum(sizes) - sizes, sizes
            values = np.concatenate([self.values[: self.used], own])
        before = np.cumsum(size) - size
        return values[np.repeat(first - before, size) + np.arange(int(size.sum()))], size


def _appended(room: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    if used + len(more) > len(room):
        room = np.concatenate([room[:used], np.zeros(max(used, len(more)) + len(more), room.dtype)])
    room[used : used + len(more)] = more
    return room
