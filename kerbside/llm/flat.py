"""Text as flat numpy arrays: characters, word starts, word hashes, a table of known words.

Many texts lie behind each other in one byte array; nothing here loops over
words or characters in Python.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Bytes worked on together; a longer text is taken alone and whole.
CHUNK = 1 << 20
LETTER, NUMBER, OTHER, SPACE = range(4)
# Code points with the property White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def chunks(batch: pa.Array, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive texts of an Arrow string array; nulls are empty."""
    filled = batch.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    low = 0
    while low < len(filled):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + size, "right")) - 1)
        high = min(high, len(filled))
        yield whole[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each (start, length), behind each other."""
    total = int(lengths.sum())
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, code point) of every character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.int32)
    more = np.flatnonzero(code >= 0xC0)
    if len(more):
        lead, place = code[more], at[more]
        second = data[np.minimum(place + 1, len(data) - 1)].astype(np.int32) & 63
        third = data[np.minimum(place + 2, len(data) - 1)].astype(np.int32) & 63
        fourth = data[np.minimum(place + 3, len(data) - 1)].astype(np.int32) & 63
        two = (lead & 31) << 6 | second
        three = (lead & 15) << 12 | second << 6 | third
        four = (lead & 7) << 18 | second << 12 | third << 6 | fourth
        code[more] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return at, code


@cache
def classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    first = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(0x110000)], np.uint8)
    kinds = np.full(0x110000, OTHER, np.uint8)
    kinds[first == ord("L")] = LETTER
    kinds[first == ord("N")] = NUMBER
    kinds[list(WHITE_SPACE)] = SPACE
    return kinds


def piece_starts(code: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pieces of the byte-level pattern start, as a flag per character.

    The pattern is 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|white
    space not before other text|white space. ``text_starts``: the first
    character of every text (texts without characters left out).
    """
    n = len(code)
    kind = classes()[code]
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    start |= first[:n]
    # the last white space before other text stands alone, or leads that text if it is a space
    white = kind == SPACE
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last] = True
    start[last[code[last] == 32] + 1] = False
    # contractions start at an apostrophe that starts a piece
    mark = np.flatnonzero((code[:-1] == 39) & start[:-1] & ~first[1:n] & (kind[1:] == LETTER)) if n > 1 else np.zeros(0, np.int64)
    if len(mark):
        one = code[mark + 1]
        inside = mark + 2 < n
        two = np.where(inside & ~first[np.minimum(mark + 2, n)], code[np.minimum(mark + 2, n - 1)], 0)
        e, ell = ord("e"), ord("l")
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        size = np.where(((one == ord("r")) | (one == ord("v"))) & (two == e) | (one == ell) & (two == ell), 2, size)
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        after = mark + 1 + size
        after = after[after < n]
        start[after] = True
    return start


@cache
def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.full(size, MULTIPLIER | np.uint64(1), np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes, never 0, of words that lie behind each other without gaps from starts[0]."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = _powers(1 << max(12, int(lengths.max()).bit_length()))
    whole = data[starts[0] : starts[-1] + lengths[-1]]
    within = np.arange(len(whole)) - np.repeat(starts - starts[0], lengths)
    sums = np.add.reduceat((whole.astype(np.uint64) + np.uint64(1)) * powers[within], starts - starts[0])
    return mixed(sums + lengths.astype(np.uint64)) | np.uint64(1)


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, 64-bit hash, first word of each text) of words between ASCII white space.

    The last array has one entry more than there are texts.
    """
    white = WHITE[data]
    begin = ~white
    begin[1:] &= white[:-1]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    begin[filled] = ~white[filled]
    starts = np.flatnonzero(begin)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    reach = np.diff(np.concatenate((starts, [len(data)])))
    powers = _powers(1 << max(12, int(reach.max()).bit_length()))
    inside = ~white[starts[0] :]
    weight = (data[starts[0] :].astype(np.uint64) + np.uint64(1)) * inside
    within = np.arange(len(inside)) - np.repeat(starts - starts[0], reach)
    hashes = mixed(np.add.reduceat(weight * powers[within], starts - starts[0]))
    lengths = np.add.reduceat(inside.astype(np.int64), starts - starts[0])
    return starts, lengths, hashes, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Numbering:
    """Numbers 0, 1, 2, ... for hashes, by open addressing."""

    def __init__(self, bits: int = 16) -> None:
        self.size = 0
        self._room(bits)

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it has none."""
        mask = (1 << self.bits) - 1
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int32)
        left = np.arange(len(hashes))
        while len(left):
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) & mask
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Numbers for distinct hashes that have none."""
        if 2 * (self.size + len(hashes)) > len(self.keys):
            keys, values = self.keys, self.values
            self._room(int(2 * (self.size + len(hashes)) - 1).bit_length() + 1)
            self._place(keys[keys != 0], values[keys != 0])
        self._place(hashes, np.arange(self.size, self.size + len(hashes), dtype=np.int32))
        self.size += len(hashes)

    def _place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(hashes):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[free]
            mine = self.keys[slot] == hashes
            self.values[slot[mine]] = numbers[mine]
            hashes, numbers, slot = hashes[~mine], numbers[~mine], (slot[~mine] + 1) & mask
