"""Sets of unit ends, in the manner of Roaring bitmaps.

The ends of a text's units (code point offsets) are one set. A set's numbers
are split by their high bits into containers of 2**16 values, and each
container takes the smallest of three forms: a sorted array, a bitmap, or runs.
Cumulative cardinalities of the containers make ``select`` (the i-th smallest
number) a search for the container and a select inside it.

One object holds the sets of many texts side by side, so that building and
selecting are array operations over all of them.
"""

from __future__ import annotations

import numpy as np

BITS = 16
ARRAY, BITMAP, RUNS = 0, 1, 2
BITMAP_BYTES = (1 << BITS) // 8


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class BoundarySets:
    """Sets ``0 .. n_sets - 1``; ``values`` ascend inside each set and ``sets``
    (the set of each value) ascends."""

    def __init__(self, sets: np.ndarray, values: np.ndarray, n_sets: int):
        self.size = np.bincount(sets, minlength=n_sets).astype(np.int64)
        self.first = _starts(self.size)                     # rank of each set's first value among all
        key = (sets.astype(np.int64) << 47) | (values >> BITS)
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        at = np.flatnonzero(new)                            # first value of each container
        self.high = (values[at] >> BITS).astype(np.int64)
        self.cum = np.concatenate([at, [len(values)]]).astype(np.int64)     # cumulative cardinalities
        card = np.diff(self.cum)
        low = (values & ((1 << BITS) - 1)).astype(np.int64)
        box = np.cumsum(new) - 1                            # container of each value
        opens = new.copy()
        opens[1:] |= low[1:] != low[:-1] + 1                # a run begins
        runs = np.bincount(box[opens], minlength=len(card)).astype(np.int64) if len(card) else card
        bytes_of = np.stack([2 * card, np.full_like(card, BITMAP_BYTES), 2 + 4 * runs])
        self.kind = bytes_of.argmin(axis=0) if len(card) else card
        kind = self.kind[box] if len(card) else box
        # arrays: the low bits themselves
        self.array = low[kind == ARRAY].astype(np.uint16)
        self.array_at = _starts(np.where(self.kind == ARRAY, card, 0))
        # runs: begin and length, lengths also cumulated over all run containers
        head = np.flatnonzero(opens)
        head_kind = kind[head] == RUNS
        length = np.diff(np.concatenate([head, [len(values)]]))
        self.run_low, self.run_cum = low[head][head_kind].astype(np.uint16), _starts(length[head_kind])
        self.run_at = _starts(np.where(self.kind == RUNS, card, 0))     # values before, in run containers
        # bitmaps: 64-bit words with the values before each word
        n_maps = int((self.kind == BITMAP).sum())
        nth = np.cumsum(self.kind == BITMAP) - 1
        mine = kind == BITMAP
        bit = nth[box[mine]] * (1 << BITS) + low[mine]
        flags = np.zeros(n_maps << BITS, np.uint8)
        flags[bit] = 1
        self.words = np.packbits(flags, bitorder="little").view(np.uint64)
        self.word_cum = _starts(np.bitwise_count(self.words))
        self.map_at = _starts(np.where(self.kind == BITMAP, card, 0))   # values before, in bitmaps
        self.map_no = nth

    def select(self, sets: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The ``i``-th smallest number (from 0) of each of ``sets``."""
        rank = self.first[sets] + i
        box = np.searchsorted(self.cum, rank, side="right") - 1
        inner = rank - self.cum[box]
        low = np.zeros(len(rank), np.int64)
        kind = self.kind[box]
        a = kind == ARRAY
        low[a] = self.array[self.array_at[box[a]] + inner[a]]
        r = kind == RUNS
        nth = self.run_at[box[r]] + inner[r]
        run = np.searchsorted(self.run_cum, nth, side="right") - 1
        low[r] = self.run_low[run].astype(np.int64) + nth - self.run_cum[run]
        m = kind == BITMAP
        if m.any():
            nth = self.map_at[box[m]] + inner[m]
            word = np.searchsorted(self.word_cum, nth, side="right") - 1
            bits = np.unpackbits(self.words[word].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
            want = (nth - self.word_cum[word] + 1).reshape(-1, 1)
            bit = (np.cumsum(bits, axis=1) == want).argmax(axis=1)
            low[m] = (word - self.map_no[box[m]] * (1 << (BITS - 6))) * 64 + bit
        return (self.high[box] << BITS) + low


def line_ends(texts: list[bytes]) -> BoundarySets:
    """The ends, in code points, of each UTF-8 text's lines (a last line may
    lack its line break; an empty text has no line)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = _starts(size)[1:]                                # byte ends of the texts
    cuts = np.union1d(np.flatnonzero(data == 10) + 1, ends[size > 0])
    if not len(cuts):
        return BoundarySets(np.zeros(0, np.int64), np.zeros(0, np.int64), len(texts))
    lead = (data & 0xC0) != 0x80                            # the first byte of a code point
    points = np.cumsum(np.add.reduceat(lead.view(np.uint8), np.concatenate([[0], cuts[:-1]]), dtype=np.int64))
    owner = np.searchsorted(ends, cuts, side="left")
    before = np.concatenate([[0], points])[np.searchsorted(cuts, ends - size, side="right")]     # code points before each text
    return BoundarySets(owner, points - before[owner], len(texts))
