"""Vectorised text primitives used inside tasks (numpy over the UTF-8 bytes
of a whole Arrow batch): word boundaries, word hashes, shingle sets.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Hashes are 64 bit;
two different words or shingles of one pair of documents meet with a
probability near 1e-11.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19       # bytes worked on at once inside a task; one longer text is taken alone
MULT = 0x9E3779B97F4A7C15 | 1
MULT_INV = pow(MULT, -1, 1 << 64)


def utf8(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges [a, b) of at most ``limit`` bytes (one row at least)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int = 1) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    return out


def word_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, in order."""
    keep = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offs] = True                       # words never reach over two rows
    start, end = keep.copy(), keep.copy()
    start[1:] &= ~keep[:-1] | edge[1:n]
    end[:-1] &= ~keep[1:] | edge[1:n]
    ws, we = np.flatnonzero(start), np.flatnonzero(end) + 1
    per_row = np.diff(np.searchsorted(ws, offs))
    return ws, we, np.repeat(np.arange(len(offs) - 1), per_row)


class SpanHasher:
    """64-bit polynomial hashes of byte spans by prefix sums; the powers are
    kept for the longest slice seen."""

    def __init__(self, seed: int = 1):
        self.table = byte_table(seed)
        self.pw = self.inv = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.pw) < n + 1:
            for name, m in (("pw", MULT), ("inv", MULT_INV)):
                a = np.full(n + 1, m, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def __call__(self, raw: np.ndarray, ws: np.ndarray, we: np.ndarray) -> np.ndarray:
        self._grow(len(raw))
        s = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.table[raw] * self.pw[:len(raw)], out=s[1:])
        return mix((s[we] - s[ws]) * self.inv[ws] + (we - ws).astype(np.uint64))


class SymbolHasher(SpanHasher):
    """Hashes of spans of symbols 0 to 256."""

    def __init__(self):
        super().__init__()
        self.table = mix(np.arange(1, 258, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def prepare(self, sym: np.ndarray) -> np.ndarray:
        self._grow(len(sym))
        out = np.zeros(len(sym) + 1, np.uint64)
        np.cumsum(self.table[sym] * self.pw[:len(sym)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (sums[b] - sums[a]) * self.inv[a] + (b - a).astype(np.uint64)

    def __call__(self, sym, a, b):
        return self.spans(self.prepare(sym), a, b)


def ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + n), one after another."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + n, n)


def run_starts(n: np.ndarray) -> np.ndarray:
    return np.cumsum(n) - n


def shingle_hashes(word: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles and the bounds of each row's
    part. ``first``: bounds of each row's words. A row of fewer words, but at
    least one, has its whole sequence as one shingle."""
    count = np.diff(first)
    mult = [np.uint64(pow(MULT, k + 1, 1 << 64)) for k in range(width)]
    n_sh = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(n_sh)])
    full = np.zeros(len(word), np.uint64)
    if len(word) >= width:
        m = len(word) - width + 1
        for k in range(width):
            full[:m] += word[k:m + k] * mult[k]
    # a shingle starts at each of a row's words but its last width - 1
    row = np.repeat(np.arange(len(count)), n_sh)
    at = np.arange(bounds[-1]) - bounds[row] + first[row]
    out = full[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        acc = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            acc[has] += word[first[short][has] + k] * mult[k]
        out[bounds[short]] = acc + count[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix(out), bounds


def shingle_sets(texts, width: int):
    """(row, sorted distinct shingle hashes) of each row of a string column."""
    raw, offs = utf8(texts)
    hasher = SpanHasher()
    for a, b in slices(offs):
        part = lower_ascii(raw[offs[a]:offs[b]])
        local = offs[a:b + 1] - offs[a]
        ws, we, row = word_spans(part, local)
        words = hasher(part, ws, we)
        first = np.searchsorted(row, np.arange(b - a + 1))
        sh, bounds = shingle_hashes(words, first, width)
        for i in range(b - a):
            yield a + i, np.unique(sh[bounds[i]:bounds[i + 1]])
