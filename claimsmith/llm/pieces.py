"""Pieces of plain texts as arrays: where they begin, their hashes, and a table of what is known about them.

Works on the code units of many texts at once, without an object per piece.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from claimsmith.llm.common import _MUL, _MUL_INV, _power, mix

LIMIT = 0x234  # plain characters are below
_LETTER, _NUMBER, _OTHER, _BLANK = range(4)
_KIND = np.array([_LETTER if unicodedata.category(chr(i))[0] == "L" else _NUMBER if unicodedata.category(chr(i))[0] == "N"
                  else _BLANK if chr(i) in " \t\n\r" else _OTHER for i in range(LIMIT)], np.uint8)
_CODE = mix(np.arange(1, LIMIT + 1, dtype=np.uint64) * _MUL)
# The pattern's endings after an apostrophe, tried in this order.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def piece_starts(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in the code units of texts that begin at ``first``.

    The published pattern as rules on runs of letters, numbers, blanks and
    others: a run takes one space before it along; of two or more blanks
    before a run the last stands apart; blanks at a text's end are one piece;
    a lone apostrophe takes one of a few endings from the letters after it.
    """
    n = len(code)
    kind = _KIND[code]
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    ends = begins[1:].copy()  # the last unit of each text
    ends[-1:] = True
    begins = begins[:n]
    run = begins.copy()
    run[1:] |= kind[1:] != kind[:-1]
    out = run.copy()
    start = np.flatnonzero(run)
    stop = np.append(start[1:], n)
    blank = kind[start] == _BLANK
    inner = blank & ~ends[stop - 1]  # a run of the same text follows
    last = stop[inner] - 1
    out[last] = True
    out[stop[inner][code[last] == 0x20]] = False
    lone = start[(stop - start == 1) & (code[start] == 0x27) & ~ends[start]]
    lone = lone[out[lone]]  # not taken along with a space before
    open_ = np.ones(len(lone), bool)
    for ending in _ENDINGS:
        fits = open_ & (lone + len(ending) < n)
        for k, c in enumerate(ending, 1):
            fits[fits] = (code[lone[fits] + k] == ord(c)) & ~ends[lone[fits] + k - 1]
        at = lone[fits]
        out[at + 1] = False
        after = at + 1 + len(ending)
        after = after[after < n]
        out[after] |= kind[after] == _LETTER
        open_ &= ~fits
    return np.flatnonzero(out)


def piece_hashes(code: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece, never 0."""
    acc = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(_CODE[code] * _power("up", _MUL, len(code)), out=acc[1:])
    stop = np.append(start[1:], len(code))
    h = mix((acc[stop] - acc[start]) * _power("down", _MUL_INV, len(code))[start] + stop.astype(np.uint64) - start.astype(np.uint64))
    h[h == 0] = 1
    return h


class PieceTable:
    """Ids by piece hash: an open-addressed table with a pool of ids.

    ``shrink`` brings it back to three quarters of ``limit`` pieces, those
    that were learned first; between calls it takes whatever is added."""

    def __init__(self, dtype: np.dtype, limit: int):
        self.limit = limit
        self.n = 0
        self.hash, self.start, self.pool = np.zeros(1, np.uint64), np.zeros(2, np.int64), np.zeros(1, dtype)
        self._slots(int(limit * 3 // 2).bit_length())

    def _slots(self, bits: int) -> None:
        """An index of 2 ** bits slots over the pieces there are."""
        self.bits = bits
        self.key, self.entry = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self._place(self.hash[:self.n], np.arange(self.n, dtype=np.int32))

    def _home(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, h: np.ndarray, number: np.ndarray) -> None:
        left, slot = np.arange(len(h)), self._home(h)
        while len(left):
            free = np.flatnonzero(self.key[slot] == 0)
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.key[slot[won]] = h[left[won]]
            self.entry[slot[won]] = number[left[won]]
            go = np.ones(len(left), bool)
            go[won] = False
            left, slot = left[go], (slot[go] + 1) & (len(self.key) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash's piece, -1 where it isn't known."""
        out = np.full(len(h), -1, np.int32)
        left, slot = np.arange(len(h)), self._home(h)
        while len(left):
            key = self.key[slot]
            hit = key == h[left]
            out[left[hit]] = self.entry[slot[hit]]
            go = ~hit & (key != 0)
            left, slot = left[go], (slot[go] + 1) & (len(self.key) - 1)
        return out

    def shrink(self) -> None:
        if self.n > self.limit:
            self.n = self.limit * 3 // 4
            self._slots(int(self.limit * 3 // 2).bit_length())

    def add(self, h: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """New distinct hashes, with their ids one after another."""
        n, used = self.n + len(h), self.start[self.n]
        self.hash, self.start = _room(self.hash, n), _room(self.start, n + 1)
        self.pool = _room(self.pool, used + len(ids))
        self.hash[self.n:n] = h
        self.start[self.n + 1:n + 1] = used + np.cumsum(lengths)
        self.pool[used:used + len(ids)] = ids
        if 4 * n > 3 * len(self.key):
            self.n = n
            self._slots(self.bits + 1)
        else:
            self._place(h, np.arange(self.n, n, dtype=np.int32))
            self.n = n

    def ids(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, ids before each piece and in all)."""
        begin = self.start[number]
        length = self.start[number + 1] - begin
        before = np.concatenate([[0], np.cumsum(length)])
        return self.pool[np.repeat(begin - before[:-1], length) + np.arange(before[-1])], before


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """The array, longer by half and more if it can't hold n."""
    if len(a) >= n:
        return a
    out = np.zeros(int(n) + int(n) // 2 + 1, a.dtype)
    out[:len(a)] = a
    return out
