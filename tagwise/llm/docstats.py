"""Per-document statistics over whole texts, vectorised: used by the quality
classifier and the quality rules."""

from __future__ import annotations

import numpy as np

from tagwise.llm.vectext import SpanHasher, lower_ascii, mix, slices, utf8, word_spans

SYMBOLS = b"#*$%&|<>"


def line_spans(raw: np.ndarray, offs: np.ndarray):
    """Start, end and row of every \\n-separated line, empty ones included."""
    nl = np.flatnonzero(raw == 10)
    row_of = np.searchsorted(offs, nl, "right") - 1
    n_rows = len(offs) - 1
    start = np.concatenate([offs[:-1], nl + 1])
    end = np.concatenate([nl, offs[1:]])
    row_s = np.concatenate([np.arange(n_rows), row_of])
    row_e = np.concatenate([row_of, np.arange(n_rows)])
    # the k-th start of a row belongs to its k-th end
    s, e = np.lexsort((start, row_s)), np.lexsort((end, row_e))
    return start[s], end[e], row_s[s]


def per_row(row: np.ndarray, n_rows: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weight, n_rows)


def repeats(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal (row, key): whether an entry is a later one, and how many
    there are in all."""
    order = np.lexsort((key, row))          # stable: the first in the text comes first
    r, k = row[order], key[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    group = np.cumsum(new) - 1
    size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    later, total = np.empty(len(r), bool), np.empty(len(r), np.int64)
    later[order] = ~new
    total[order] = size[group] if len(group) else 0
    return later, total


def lead_bytes(raw: np.ndarray) -> np.ndarray:
    return (raw & 0xC0) != 0x80


def statistics(texts, lower: bool = False):
    """(row range, dict of per-row arrays) for slices of a string column."""
    raw_all, offs_all = utf8(texts)
    hasher = SpanHasher()
    for a, b in slices(offs_all):
        raw = raw_all[offs_all[a]:offs_all[b]]
        offs = offs_all[a:b + 1] - offs_all[a]
        n = b - a
        byte_row = np.repeat(np.arange(n), np.diff(offs))
        kind = np.zeros(256, np.uint8)
        ws, we, row = word_spans(raw, offs)
        words = hasher(raw, ws, we)
        low = hasher(lower_ascii(raw), ws, we) if lower else words
        first = np.searchsorted(row, np.arange(n + 1))

        def count(mask):
            return np.bincount(byte_row[mask], minlength=n)

        kind[list(SYMBOLS)] = 1
        is_word = np.zeros(len(raw) + 1, np.int64)
        np.add.at(is_word, ws, 1)
        np.add.at(is_word, we, -1)
        inside = np.cumsum(is_word[:-1]) > 0
        s = {"n_words": np.diff(first), "word_chars": count(inside & lead_bytes(raw)),
             "n_symbols": count(kind[raw] == 1), "n_bytes": np.diff(offs)}

        # 3-word windows found twice or more cover these words
        cover = np.zeros(len(words) + 1, np.int64)
        if len(words) >= 3:
            win = mix(words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(0x9E3779B97F4A7C15) + words[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
            same = np.flatnonzero(row[:-2] == row[2:])
            _, total = repeats(row[same], win[same])
            again = same[total >= 2]
            np.add.at(cover, again, 1)
            np.add.at(cover, again + 3, -1)
        s["n_repeat_words"] = per_row(row[np.cumsum(cover[:-1]) > 0], n)

        # lines with a word, equal to an earlier line
        ls, le, lrow = line_spans(raw, offs)
        filled = np.searchsorted(ws, le) > np.searchsorted(ws, ls)
        later, _ = repeats(lrow[filled], hasher(raw, ls[filled], le[filled]))
        s["n_lines"], s["n_dup_lines"] = per_row(lrow[filled], n), per_row(lrow[filled][later], n)

        if lower:       # what only the classifier looks at
            letter = ((raw | 32) >= 97) & ((raw | 32) <= 122)
            s["upper"], s["letters"] = count((raw >= 65) & (raw <= 90)), count(letter)
            s["exclaim"], s["pipes"], s["digits"] = count(raw == 33), count(raw == 124), count((raw >= 48) & (raw <= 57))
            s["stops"], s["wide"] = count((raw == 46) | (raw == 44)), count(raw >= 128)
            twin = np.zeros(len(low), bool)
            twin[1:] = (low[1:] == low[:-1]) & (row[1:] == row[:-1])
            s["twins"] = per_row(row[twin], n)
            later, _ = repeats(row, low)
            s["repeated"] = per_row(row[later], n)
        yield a, b, s
