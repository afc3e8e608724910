"""BPE encoding and decoding: speculate and verify.

Whole slices of texts are cut into words as arrays; each task encodes every
word that it remembers once and assembles the ids of its documents by
vectorised gathers. New words of a slice go through three steps:

1. greedy longest match proposes a token sequence;
2. every adjacent pair of the proposals is tested for compatibility with
   vectorised look-ups (a pair is compatible when merging its own bytes by
   rank gives the same two tokens back; a sequence whose pairs are all
   compatible is the one that the merges give);
3. only words with an incompatible pair are merged exactly, by rank.

The vocabulary file is read on the driver (49k entries, a fixed size) and
broadcast. The word rules are the file's own: NFC, white space collapsed,
lower case, then letters, single digits, or other signs.
"""

from __future__ import annotations

import json
import re
import sys
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.llm.ship import Shipped
from tagwise.llm.vectext import SpanHasher, SymbolHasher, ragged, run_starts

# fixed values: the vocabulary's word pattern and word end. The pattern is
# 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+
OTHER, SPACE, LETTER, NUMBER = range(4)
KINDS = {SPACE: r"\p{White_Space}+", LETTER: r"\p{L}+", NUMBER: r"\p{N}+"}
QUOTE, QUOTED_ONE, QUOTED_TWO = ord("'"), "stmd", ("re", "ve", "ll")
WORD_END = "</w>"

# a task's memory: an executor holds one worker a core beside its JVM
MEMO_CHUNKS = 400_000       # distinct words that a task remembers; then it forgets those met in one slice only
MEMO_BYTES = 1 << 24        # bytes of these words and of their ids
MEMO_PAIRS = 300_000        # tested pairs that it remembers
SLICE_CHARS = 1 << 18       # characters of a batch worked on at once
MERGE_CELLS = 1 << 17       # symbols merged at once
DECODE_TOKENS = 1 << 17     # tokens of a batch decoded at once


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 stands for
    itself, the others take the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {b: chr(b) for b in own}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return [out[b] for b in range(256)]


END = 256                   # symbol of the word end; 0 to 255 are bytes


class Vocabulary:
    """Tokens, merge ranks and special tokens of a BPE file with word ends,
    as arrays."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        model = model["model"]
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        code = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.n_merges = len(pairs)
        self.pair_rank = np.argsort(code, kind="stable").astype(np.int32)
        self.pair_code = code[self.pair_rank]
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for t, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = t
        kind = np.zeros(sys.maxunicode + 1, np.uint8)       # of every code point, kept as runs
        every = "".join(map(chr, range(sys.maxunicode + 1)))
        for k, pattern in KINDS.items():
            for m in regex.finditer(pattern, every):
                kind[m.start():m.end()] = k
        at = np.flatnonzero(np.diff(kind, prepend=255))
        self.kind, self.kind_n = kind[at], np.diff(at, append=len(kind))
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.plain = np.array([ids.get(c, -1) for c in byte], np.int64)              # id of a byte
        self.final = np.array([ids.get(c + WORD_END, -1) for c in byte], np.int64)   # of a word's last byte

        # every token as symbols, and every prefix of one, by hash
        self.hasher = SymbolHasher()
        spelt = {}
        for t, i in ids.items():
            has_end = t.endswith(WORD_END) and t != WORD_END
            spelt[i] = [byte[c] for c in (t[:-len(WORD_END)] if has_end else t)] + [END] * has_end
        prefix: dict[tuple, int] = {}
        for i, q in spelt.items():
            for k in range(1, len(q)):
                prefix.setdefault(tuple(q[:k]), -1)
            prefix[tuple(q)] = i
        flat = np.fromiter(chain.from_iterable(prefix), np.int64)
        n = np.fromiter(map(len, prefix), np.int64, len(prefix))
        at = run_starts(n)
        key = self.hasher(flat, at, at + n)
        order = np.argsort(key)
        self.prefix_key, self.prefix_token = key[order], np.fromiter(prefix.values(), np.int64)[order]
        self.hasher = SymbolHasher()            # without the powers for all prefixes at once
        # the bytes of every token as ids, where its own merges begin
        size = np.zeros(len(self.tokens), np.int64)
        parts = []
        for i in range(len(self.tokens)):
            q = spelt.get(i, [])
            q = [int(self.plain[c]) for c in q] if not q or q[-1] != END else [*(int(self.plain[c]) for c in q[:-2]), int(self.final[q[-2]])]
            size[i] = len(q)
            parts.append(q)
        self.base, self.base_n = np.fromiter(chain.from_iterable(parts), np.int64), size
        self.base_at = run_starts(size)


class Encoder:
    def __init__(self, vocab: Vocabulary, normalizer):
        self.v = vocab
        self.kind = np.repeat(vocab.kind, vocab.kind_n)
        self.beyond = re.compile("[^\x00-\u02ff]")       # below, NFC changes nothing
        self.special = re.compile("(" + "|".join(map(re.escape, vocab.special)) + ")") if vocab.special else None
        self.lower = normalizer
        self.hasher = SpanHasher()
        self.pair_code, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self.reset()

    def reset(self) -> None:
        """Forget all words. They are numbered: sorted hashes lead to the
        number, bytes and ids lie in pools."""
        self.key, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.raw, self.raw_at, self.raw_n = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.ids_at, self.ids_n = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)          # met in a later slice too

    def forget(self) -> None:
        """Keep the words that were met again since the last time, all others
        go; where that would keep more than half of the memory, all go."""
        keep = np.flatnonzero(self.again)
        if len(keep) > MEMO_CHUNKS // 2 or (self.raw_n[keep] + 4 * self.ids_n[keep].astype(np.int64)).sum() > MEMO_BYTES // 2:
            return self.reset()
        place = np.full(len(self.again), -1, np.int32)
        place[keep] = np.arange(len(keep), dtype=np.int32)
        number = place[self.number]
        self.key, self.number = self.key[number >= 0], number[number >= 0]
        self.raw, self.raw_n = self.raw[ragged(self.raw_at[keep], self.raw_n[keep])], self.raw_n[keep]
        self.ids, self.ids_n = self.ids[ragged(self.ids_at[keep], self.ids_n[keep])], self.ids_n[keep]
        self.raw_at, self.ids_at = run_starts(self.raw_n), run_starts(self.ids_n)
        self.again = np.zeros(len(keep), bool)

    # -- step 1: greedy longest match of all words at once ---------------------
    def propose(self, sym: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Tokens (flat), their number per word (0: none fits). The word end,
        the last symbol of each word, must ride on its last token."""
        v = self.v
        sums = v.hasher.prepare(sym)
        at, alive = start.copy(), np.arange(len(start))
        who, what, failed = [], [], np.zeros(len(start), bool)
        while len(alive):
            i, e = at[alive], end[alive]
            best, step = np.full(len(alive), -1, np.int64), np.zeros(len(alive), np.int64)
            cur, k = np.arange(len(alive)), 1
            while len(cur):
                j = i[cur] + k
                key = v.hasher.spans(sums, i[cur], j)
                p = np.minimum(np.searchsorted(v.prefix_key, key), len(v.prefix_key) - 1)
                ok = v.prefix_key[p] == key
                cur, j, tok = cur[ok], j[ok], v.prefix_token[p[ok]]
                hit = (tok >= 0) & (j != e[cur] - 1)
                best[cur[hit]], step[cur[hit]] = tok[hit], k
                k += 1
                cur = cur[j < e[cur]]
            good = best >= 0
            failed[alive[~good]] = True
            who.append(alive[good])
            what.append(best[good])
            at[alive] += step
            alive = alive[good & (at[alive] < e)]
        who, what = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, what))
        order = np.argsort(who, kind="stable")
        who, what = who[order], what[order]
        keep = ~failed[who]
        return what[keep], np.bincount(who[keep], minlength=len(start))

    # -- step 3, also behind step 2: exact merging by rank ---------------------
    def merge(self, flat: np.ndarray, n: np.ndarray):
        """Merged sequences (flat) and their lengths. In each round every
        sequence merges its best pair, the leftmost of equal ones. Worked on
        in groups of like length, so that a very long word doesn't pad the
        others."""
        start, out_n = run_starts(n), n.copy()
        out = flat.copy()
        order = np.argsort(n, kind="stable")
        a = int(np.searchsorted(n[order], 2))
        while a < len(order):
            limit = int(n[order[a]]) * 5 // 4 + 1
            b = min(int(np.searchsorted(n[order], limit, "right")), a + max(1, MERGE_CELLS // limit))
            rows = order[a:b]
            width = int(n[rows[-1]])
            cols = np.arange(width)
            inside = cols < n[rows][:, None]
            sym = np.where(inside, flat[np.minimum(start[rows][:, None] + cols, len(flat) - 1)], -1)
            done = self._merge_rows(sym)
            inside = done >= 0
            out_n[rows] = inside.sum(axis=1)
            out[ragged(start[rows], out_n[rows])] = done[inside]
            a = b
        return out[ragged(start, out_n)], out_n

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of the merge table, or its length where there is no merge."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.v.pair_code, code), self.v.n_merges - 1)
        return np.where((self.v.pair_code[at] == code) & (right >= 0), self.v.pair_rank[at], self.v.n_merges)

    def _merge_rows(self, sym: np.ndarray) -> np.ndarray:
        none, width = self.v.n_merges, sym.shape[1]
        rank = np.full(sym.shape, none, np.int32)
        rank[:, :-1] = self._rank(sym[:, :-1], sym[:, 1:])
        done, live = sym.copy(), np.arange(len(sym))
        cols = np.arange(width)
        while True:
            j = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), j]
            go = best < none
            if not go.all():
                done[live[~go]] = sym[~go]
                live, sym, rank, j, best = live[go], sym[go], rank[go], j[go], best[go]
            if not len(live):
                return done
            r = np.arange(len(live))
            # close the gap to the right of j, then renew the two ranks beside it
            idx = np.minimum(cols + (cols > j[:, None]), width - 1)
            sym = np.take_along_axis(sym, idx, 1)
            rank = np.take_along_axis(rank, idx, 1)
            sym[:, -1], rank[:, -1] = -1, none
            sym[r, j] = self.v.merged[best]
            rank[r, j] = np.where(j + 1 < width, self._rank(sym[r, j], sym[r, np.minimum(j + 1, width - 1)]), none)
            prev = np.maximum(j - 1, 0)
            rank[r, prev] = np.where(j > 0, self._rank(sym[r, prev], sym[r, j]), rank[r, prev])

    # -- step 2: which pairs of tokens stand side by side ----------------------
    def compatible(self, code: np.ndarray) -> np.ndarray:
        """Of packed pairs (left, right): whether merging their bytes gives
        them back. Right 0xFFFFFFFF stands for a token alone, which its own
        merges must reach. Tested once each."""
        uniq, inv = np.unique(code, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_code, uniq), max(0, len(self.pair_code) - 1))
        known = self.pair_code[at] == uniq if len(self.pair_code) else np.zeros(len(uniq), bool)
        ok = np.zeros(len(uniq), bool)
        ok[known] = self.pair_ok[at[known]]
        new = uniq[~known]
        if len(new):
            a, b = new >> 32, new & 0xFFFFFFFF
            lone = b == 0xFFFFFFFF
            b = np.where(lone, 0, b)
            na, nb = self.v.base_n[a], np.where(lone, 0, self.v.base_n[b])
            take = ragged(np.column_stack([self.v.base_at[a], self.v.base_at[b]]).ravel(), np.column_stack([na, nb]).ravel())
            got, n = self.merge(self.v.base[take], na + nb)
            first = run_starts(n)
            second = got[np.minimum(first + 1, len(got) - 1)]
            ok[~known] = (got[first] == a) & np.where(lone, n == 1, (n == 2) & (second == b))
            if len(self.pair_code) > MEMO_PAIRS:
                self.pair_code, self.pair_ok = uniq, ok
            else:
                at = np.searchsorted(self.pair_code, new)
                self.pair_code, self.pair_ok = np.insert(self.pair_code, at, new), np.insert(self.pair_ok, at, ok[~known])
        return ok[inv]

    def learn(self, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of new words, given by their bytes, and how many each has."""
        end = np.cumsum(size + 1)
        start = end - size - 1
        raw = np.full(int(end[-1]), END, np.int64)
        raw[ragged(start, size)] = flat
        prop, n = self.propose(raw, start, end)
        ok = np.zeros(len(size), bool)
        some = np.flatnonzero(n)
        if len(some):
            first = run_starts(n[some])
            last = first + n[some] - 1
            nxt = np.append(prop[1:], 0)
            nxt[last] = 0xFFFFFFFF
            lone = np.zeros(len(prop), bool)     # the last token of a longer word is vouched for by its pair
            lone[last] = n[some] > 1
            good = np.ones(len(prop), bool)
            good[~lone] = self.compatible((prop << 32 | nxt)[~lone])
            ok[some] = np.logical_and.reduceat(good, first)
        base = self.v.plain[np.where(raw == END, 0, raw)]
        base[end - 2] = self.v.final[raw[end - 2]]
        bad = np.flatnonzero(~ok)
        exact, exact_n = self.merge(base[ragged(start[bad], size[bad])], size[bad])
        n_out = n.copy()
        n_out[bad] = exact_n
        out = np.empty(int(n_out.sum()), np.int32)
        at = run_starts(n_out)
        out[ragged(at[ok], n_out[ok])] = prop[ragged(run_starts(n)[ok], n[ok])]
        out[ragged(at[bad], exact_n)] = exact
        return out, n_out

    # -- texts -------------------------------------------------------------------
    def cut(self, text: str) -> tuple[pa.Array, np.ndarray]:
        """The words of a normalised text (binary) and where each begins, in
        characters. A quote that does not follow another sign opens one of the
        pattern's endings; other words are runs of one kind, numbers apart."""
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        char = raw if len(raw) == len(text) else np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.kind[char]
        new = kind == NUMBER
        new[:1] = True
        new[1:] |= kind[1:] != kind[:-1]
        at = np.flatnonzero(char[:-1] == QUOTE)
        at = at[(at == 0) | (kind[at - 1] != OTHER)]
        one = np.isin(char[at + 1], [ord(c) for c in QUOTED_ONE])
        b, c = char[at + 1], char[np.minimum(at + 2, len(char) - 1)]
        two = np.logical_or.reduce([(b == ord(x)) & (c == ord(y)) for x, y in QUOTED_TWO]) & (at + 2 < len(char))
        new[at[one | two] + 1] = False
        after = np.concatenate([at[one] + 2, at[two] + 3])
        new[after[after < len(char)]] = True
        inside = kind != SPACE
        first = np.flatnonzero(new & inside)
        if char is raw:
            offs, raw = np.cumsum(inside)[first] - 1, raw[inside]
        else:
            width = np.diff(np.flatnonzero((raw & 0xC0) != 0x80), append=len(raw)).astype(np.uint8)
            offs, raw = np.cumsum(width * inside, dtype=np.int64)[first] - width[first], raw[np.repeat(inside, width)]
        offs = np.append(offs, len(raw)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offs), pa.py_buffer(raw)]), first

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of different words; those not remembered are learned."""
        if not len(words):
            return np.zeros(0, np.int64)
        _, offs, raw = words.buffers()
        offs = np.frombuffer(offs, np.int64)[words.offset:words.offset + len(words) + 1]
        raw = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]]
        at, n = offs[:-1] - offs[0], np.diff(offs)
        key = self.hasher(raw, at, at + n)
        out = np.zeros(len(words), np.int64)
        known = np.zeros(len(words), bool)
        if len(self.key):
            place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            out = self.number[place].astype(np.int64)
            may = np.flatnonzero((self.key[place] == key) & (self.raw_n[out] == n))
            if len(may):                        # same hash and length: the bytes decide
                equal = raw[ragged(at[may], n[may])] == self.raw[ragged(self.raw_at[out[may]], n[may])]
                known[may] = np.logical_and.reduceat(equal, run_starts(n[may]))
        self.again[out[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            flat = raw[ragged(at[new], n[new])]
            ids, ids_n = self.learn(flat, n[new])
            out[new] = np.arange(len(self.raw_n), len(self.raw_n) + len(new))
            for pool, more, start, size, more_n in (("raw", flat, "raw_at", "raw_n", n[new]), ("ids", ids, "ids_at", "ids_n", ids_n)):
                setattr(self, start, np.concatenate([getattr(self, start), run_starts(more_n) + len(getattr(self, pool))]))
                setattr(self, pool, np.concatenate([getattr(self, pool), more]))
                setattr(self, size, np.concatenate([getattr(self, size), more_n.astype(np.int32)]))
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
            order = new[np.argsort(key[new])]
            place = np.searchsorted(self.key, key[order])
            self.key, self.number = np.insert(self.key, place, key[order]), np.insert(self.number, place, out[order])
        return out

    def normal(self, text: str) -> str:
        return text.lower() if text.isascii() or not self.beyond.search(text) else self.lower(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the bounds of each text's part."""
        pieces, marks = [], []                  # marks: (pieces before it, id) of each special token
        piece_end = np.zeros(len(texts) + 1, np.int64)
        for row, text in enumerate(texts):
            if self.special and "<" in text:
                parts = self.special.split(text)
                for i in range(0, len(parts), 2):
                    pieces.append(self.normal(parts[i]))
                    if i + 1 < len(parts):
                        marks.append((len(pieces), self.v.special[parts[i + 1]]))
            else:
                pieces.append(self.normal(text))
            piece_end[row + 1] = len(pieces)
        words, first = self.cut("\n".join(pieces))
        piece_at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)])
        words = words.dictionary_encode()
        if len(self.raw_n) > MEMO_CHUNKS or len(self.raw) + self.ids.nbytes > MEMO_BYTES:
            self.forget()
        at = self.numbers(words.dictionary)[words.indices.to_numpy()]
        n = self.ids_n[at].astype(np.int64)
        ids = self.ids[ragged(self.ids_at[at], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(first, piece_at)]
        if marks:
            mark, special = (np.array(x, np.int64) for x in zip(*marks))
            ids = np.insert(ids, ends[mark], special)
            ends += np.searchsorted(mark, np.arange(len(ends)), "right")
        return ids, ends[piece_end]


def _encode_rows(shared, keep: list[str]):
    def run(batches):
        from tokenizers import normalizers
        # texts beyond U+02FF take the library's normaliser: NFC and a lower case that looks at one character at a time
        norm = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        enc = Encoder(shared.get(), norm)
        for t in batches:
            text = pc.fill_null(t.column("text"), "")
            ends = np.cumsum(pc.utf8_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)
            a = 0
            while a < len(ends):            # small output batches bound the memory
                done = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, done + SLICE_CHARS, "right")))
                flat, bounds = enc.encode(text.slice(a, b - a).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[t.column(c).slice(a, b - a) for c in keep], lists], [*keep, "ids"])
                a = b
            t = text = lists = flat = None      # before the next batch is read
    return run


def encode(docs: DataFrame, vocab_path: str, keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids`` (array<int>) of each row's whole ``text``.

    Null text counts as empty and has no ids; special tokens that stand in a
    text become their ids, as the tokenizers library does. Rows stay rows:
    copies are encoded like any other; a column of ``docs`` named ids is
    replaced. Empty table: empty result."""
    keep = [c for c in keep if c not in ("ids", "text")]
    shared = Shipped(docs.sparkSession, Vocabulary(vocab_path))
    src = docs.select(*[F.col(c).alias(c) for c in keep], F.col("text").cast("string").alias("text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.drop("text").dtypes), "ids array<int>"])
    return src.mapInArrow(_encode_rows(shared, keep), schema)


def _decode_rows(shared, keep: list[str]):
    def run(batches):
        tokens = pa.array(shared.get(), pa.string())
        for t in batches:
            lists = t.column("ids").cast(pa.large_list(pa.int32()))
            flat = lists.flatten()
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            offs = np.concatenate([[0], np.cumsum(n)])
            a = 0
            while a < len(n):
                b = max(a + 1, int(np.searchsorted(offs, offs[a] + DECODE_TOKENS, "right")) - 1)
                words = tokens.take(flat.slice(int(offs[a]), int(offs[b] - offs[a])))
                part = pa.ListArray.from_arrays(pa.array((offs[a:b + 1] - offs[a]).astype(np.int32)), words)
                yield pa.RecordBatch.from_arrays([*[t.column(c).slice(a, b - a) for c in keep], pc.binary_join(part, " ")], [*keep, "decoded"])
                a = b
            t = lists = flat = words = part = None      # before the next batch is read
    return run


def decode(ids: DataFrame, vocab_path: str) -> DataFrame:
    """All columns of ``ids`` and ``decoded``: the tokens joined by a space
    (the file names no decoder). Null or empty ids: empty text."""
    keep = [c for c in ids.columns if c != "decoded"]
    shared = Shipped(ids.sparkSession, Vocabulary(vocab_path).tokens)
    src = ids.select(*keep)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.dtypes), "decoded string"])
    return src.mapInArrow(_decode_rows(shared, keep), schema)
