"""Character n-grams of whole texts as packed integers, vectorised."""

from __future__ import annotations

import numpy as np

from tagwise.llm.vectext import slices, utf8

SLICE = 1 << 18


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 bytes, and the index of each lead byte."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    pad = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.uint32)
    b = pad[lead]
    cp = b.copy()
    two, three, four = (b >= 0xC0) & (b < 0xE0), (b >= 0xE0) & (b < 0xF0), b >= 0xF0
    i = lead[two]
    cp[two] = (pad[i] & 0x1F) << 6 | (pad[i + 1] & 0x3F)
    i = lead[three]
    cp[three] = (pad[i] & 0x0F) << 12 | (pad[i + 1] & 0x3F) << 6 | (pad[i + 2] & 0x3F)
    i = lead[four]
    cp[four] = (pad[i] & 0x07) << 18 | (pad[i + 1] & 0x3F) << 12 | (pad[i + 2] & 0x3F) << 6 | (pad[i + 3] & 0x3F)
    return cp, lead


def point_slices(texts):
    """(a, b, code points, bounds of each row) of slices of a string column."""
    raw, offs = utf8(texts)
    for a, b in slices(offs, SLICE):
        cp, lead = code_points(raw[offs[a]:offs[b]])
        yield a, b, cp, np.searchsorted(lead, offs[a:b + 1] - offs[a])


class Folded:
    """A lookup from code point to a class, filled for the code points met."""

    def __init__(self, rule):
        self.rule, self.known = rule, {}

    def __call__(self, cp: np.ndarray) -> np.ndarray:
        table = np.zeros(int(cp.max()) + 1 if len(cp) else 1, np.int64)
        for c in np.flatnonzero(np.bincount(cp)) if len(cp) else ():
            c = int(c)
            if c not in self.known:
                self.known[c] = self.rule(c)
            table[c] = self.known[c]
        return table[cp]


def counted(row: np.ndarray, code: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) in order, with counts; codes below 2 ** bits."""
    key = np.sort(row.astype(np.int64) << bits | code)
    if not len(key):
        return key, key, key
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(head, len(key)))
    key = key[head]
    return key >> bits, key & ((1 << bits) - 1), n
