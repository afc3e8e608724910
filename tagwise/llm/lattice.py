"""LM scoring by subword lattice likelihood.

A word's probability is the sum over all paths of its lattice: its
segmentations into pieces of an existing vocabulary, and, for a word of the
training texts, one arc from its begin to its end. The sum is a forward
recursion in log space over the matching pieces, vectorised over many words; a
text's probability is the product over its words and one end. Single bytes are
pieces too, so every text has a probability.

The weights sum to one, so the model is proper: a word arc has its discounted
count, (c - d) / N, and the discounts' mass d V / N goes to the pieces. The
vocabulary's scores are ranks (a BPE file); they give the first piece weights by
Zipf's law, and expected piece counts over the training words (each with the
same discounted mass; forward-backward, summed by Spark) re-estimate them
``ROUNDS`` times.

Words are counted once per Arrow batch, exchanged in packed rows by bucket and
summed; the table of distinct words (with training count and lattice
log-probability) grows with the corpus and stays distributed. Its ``HEAD`` most
frequent words (a fixed bound) are broadcast to the scoring pass; what a text
holds beyond these joins the table by shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.llm.ship import Shipped
from tagwise.llm.vectext import (SpanHasher, SymbolHasher, lower_ascii, ragged, run_starts, slices,
                                 utf8, word_spans)
from tagwise.session import cut_lineage

WORD_BEGIN = 256
ROUNDS = 2
HEAD = 400_000
SMOOTH = 0.01
FOLD_MOD, FOLD_REST = 7, 2


class Pieces:
    """Pieces as symbols (bytes, and 256 for a word's begin), by the hash of
    every prefix, with log probabilities (natural)."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[tuple, float] = {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            begin, body = p.startswith("▁"), p.lstrip("▁") if p.startswith("▁") else p
            if "▁" in body or p.count("▁") > 1:
                continue
            q = ([WORD_BEGIN] if begin else []) + list(body.encode("utf-8"))
            found.setdefault(tuple(q), -sp.get_score(i))
        for b in range(257):
            found.setdefault((b,), float(len(found)))
        self.names = list(found)
        rank = np.array(list(found.values()))
        self.logp = -np.log(np.argsort(np.argsort(rank)) + 3.0)
        self.logp -= np.log(np.exp(self.logp).sum())
        self.hasher = SymbolHasher()
        prefix: dict[tuple, int] = {}
        for i, q in enumerate(self.names):
            for k in range(1, len(q)):
                prefix.setdefault(q[:k], -1)
            prefix[q] = i
        flat = np.array([s for q in prefix for s in q], np.int64)
        n = np.array([len(q) for q in prefix], np.int64)
        at = run_starts(n)
        key = self.hasher(flat, at, at + n)
        order = np.argsort(key)
        self.prefix_key, self.prefix_piece = key[order], np.array(list(prefix.values()), np.int64)[order]

    def lattice(self, words: list[str]):
        """Arcs of all words: (node from, node to, piece), and each word's
        first and last node. A word has one node more than symbols."""
        raw = np.frombuffer(("\n" + "\n".join(words)).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
        raw[raw == 10] = WORD_BEGIN             # words hold no white space
        start = np.flatnonzero(raw == WORD_BEGIN)
        end = np.append(start[1:], len(raw))
        word = np.repeat(np.arange(len(words)), end - start)
        sums = self.hasher.prepare(raw)
        cur, k, arcs = np.arange(len(raw)), 1, []
        stop = end[word]
        while len(cur):
            key = self.hasher.spans(sums, cur, cur + k)
            p = np.minimum(np.searchsorted(self.prefix_key, key), len(self.prefix_key) - 1)
            ok = self.prefix_key[p] == key
            cur, piece = cur[ok], self.prefix_piece[p[ok]]
            hit = piece >= 0
            arcs.append((cur[hit], np.full(int(hit.sum()), k), piece[hit]))
            k += 1
            cur = cur[cur + k <= stop[cur]]
        pos, size, piece = (np.concatenate(x) for x in zip(*arcs))
        node = pos + word[pos]                  # one more node per word before
        return node, node + size, piece, start + np.arange(len(words)), end + np.arange(len(words)), (end - start)

    def _sweep(self, into, other, weight, depth, first, n_nodes):
        """Log-sum over arcs into each node, level by level; ``depth`` is a
        node's distance from its word's first node of the sweep."""
        value = np.full(n_nodes, -np.inf)
        value[first] = 0.0
        level = depth[into]
        order = np.lexsort((into, level))
        into, other, weight, level = into[order], other[order], weight[order], level[order]
        cut = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
        for a, b in zip(cut, np.append(cut[1:], len(into))):
            x = value[other[a:b]] + weight[a:b]
            node = into[a:b]
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            top = np.maximum.reduceat(x, head)
            n = np.diff(np.append(head, b - a))
            value[node[head]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, n)), head))
        return value

    def score(self, words: list[str], counts: np.ndarray | None = None):
        """Log probability of each word; with ``counts`` also the expected
        number of each piece."""
        if not words:
            return np.zeros(0), np.zeros(len(self.names))
        src, dst, piece, first, last, size = self.lattice(words)
        n_nodes = int(last[-1]) + 1
        depth = np.arange(n_nodes) - np.repeat(first, size + 1)
        w = self.logp[piece]
        fwd = self._sweep(dst, src, w, depth, first, n_nodes)
        total = fwd[last]
        if counts is None:
            return total, None
        back = self._sweep(src, dst, w, np.repeat(size, size + 1) - depth, last, n_nodes)
        owner = np.repeat(np.arange(len(words)), size + 1)[src]
        post = np.exp(fwd[src] + w + back[dst] - total[owner]) * counts[owner]
        return total, np.bincount(piece, post, len(self.names))


def _in_parts(words: list[str], limit: int = 400_000):
    """Ranges of words of at most ``limit`` characters in all."""
    a, n = 0, 0
    for b, w in enumerate(words):
        if n and n + len(w) > limit:
            yield a, b
            a, n = b, 0
        n += len(w) + 1
    if a < len(words):
        yield a, len(words)


def _words(texts, hasher: SpanHasher):
    """(a, b, row, hash, bytes, start, end) of the words of slices of a column."""
    raw, offs = utf8(texts)
    for a, b in slices(offs):
        part = lower_ascii(raw[offs[a]:offs[b]])
        ws, we, row = word_spans(part, offs[a:b + 1] - offs[a])
        yield a, b, row, hasher(part, ws, we), part, ws, we


def _count_rows(n_buckets: int):
    """Per Arrow batch and bucket one row with the distinct words and their
    numbers in training texts."""
    def run(batches):
        hasher = SpanHasher()
        for t in batches:
            train = t.column("train").to_numpy(zero_copy_only=False)
            hashes, counts, spelt = [], [], []
            for a, b, row, h, part, ws, we in _words(t.column("text"), hasher):
                uniq, at, inv = np.unique(h, return_index=True, return_inverse=True)
                hashes.append(uniq)
                counts.append(np.bincount(inv, train[a:b][row], len(uniq)).astype(np.int64))
                n = (we - ws)[at]
                body = part[ragged(ws[at], n)]
                offs = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
                spelt.append(pa.Array.from_buffers(pa.large_string(), len(uniq), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(body.tobytes())]))
            if not hashes:
                continue
            h, at, inv = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            c = np.bincount(inv, np.concatenate(counts), len(h)).astype(np.int64)
            word = pa.concat_arrays(spelt).take(pa.array(at)).cast(pa.string())
            bucket = (h % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            some = np.flatnonzero(np.diff(cut))
            offs = pa.array(np.append(cut[some], len(h)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.ListArray.from_arrays(offs, pa.array(h[order].view(np.int64))),
                 pa.ListArray.from_arrays(offs, pa.array(c[order])), pa.ListArray.from_arrays(offs, word.take(pa.array(order)))],
                ["bucket", "h", "c", "word"])
    return run


def _sum_bucket(table: pa.Table) -> pa.Table:
    h, c, word = (table.column(k).combine_chunks().flatten() for k in ("h", "c", "word"))
    h, at, inv = np.unique(h.to_numpy(), return_index=True, return_inverse=True)
    return pa.table({"h": pa.array(h), "c": pa.array(np.bincount(inv, c.to_numpy(), len(h)).astype(np.int64)),
                     "word": word.take(pa.array(at))})


def _expected_rows(shared):
    def run(batches):
        pieces = shared.get()
        total = np.zeros(len(pieces.names))
        for t in batches:
            words = t.column("word").to_pylist()
            for a, b in _in_parts(words):
                total += pieces.score(words[a:b], np.ones(b - a))[1]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])
    return run


def _word_scores(shared, discount: float, n_tokens: int, spare: float):
    """log10 probability of each word: its own arc and the pieces' paths."""
    def run(batches):
        pieces = shared.get()
        for t in batches:
            words, c = t.column("word").to_pylist(), t.column("c").to_numpy()
            lp = [pieces.score(words[a:b])[0] for a, b in _in_parts(words)]
            lp = (np.concatenate(lp) if lp else np.zeros(0)) + np.log(spare)
            with np.errstate(divide="ignore"):
                own = np.log(np.maximum(c - discount, 0) / max(1, n_tokens))
            yield pa.RecordBatch.from_arrays([t.column("h"), t.column("c"), pa.array(np.logaddexp(lp, own) / np.log(10))], ["h", "c", "logp"])
    return run


def _text_rows(shared, keep: list[str]):
    """What the broadcast words give a text, and the rest as (hash, number)."""
    def run(batches):
        head_h, head_base, head_logp, head_known = shared.get()
        hasher = SpanHasher()
        for t in batches:
            for a, b, row, h, *_ in _words(t.column("text"), hasher):
                n = b - a
                uniq, inv = np.unique(h, return_inverse=True)
                at = np.minimum(np.searchsorted(head_h, uniq), max(0, len(head_h) - 1))
                hit = head_h[at] == uniq if len(head_h) else np.zeros(len(uniq), bool)
                is_head = hit[inv]
                r, k = row[is_head], at[inv[is_head]]
                sums = [np.bincount(r, x[k], n) for x in (head_base, head_logp, head_known)]
                key = np.sort(row[~is_head] * len(uniq) + inv[~is_head])
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
                m = np.diff(np.append(first, len(key)))
                key = key[first]
                offs = pa.array(np.searchsorted(key, np.arange(n + 1) * max(1, len(uniq))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*[t.column(c).slice(a, n) for c in keep], pa.array(np.bincount(row, minlength=n).astype(np.int64) + 1),
                     pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2].astype(np.int64)),
                     pa.ListArray.from_arrays(offs, pa.array(uniq[key % max(1, len(uniq))].view(np.int64))),
                     pa.ListArray.from_arrays(offs, pa.array(m.astype(np.int64)))],
                    [*keep, "n_tokens", "base_part", "logp_part", "known_part", "rest", "rest_n"])
    return run


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLD_MOD == FOLD_REST, F.lit(False))


def score_texts(docs: DataFrame, piece_path: str, keep: tuple = ("doc_id",), n_buckets: int | None = None) -> DataFrame:
    """``keep`` columns with ``held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10) of every row's whole text.

    Null texts count as empty: one end token. Rows with a null doc_id are in
    the training fold; repeated rows each count and each get a row. Without
    training rows the first piece weights stand. Columns with the new names are
    replaced; empty table: empty result."""
    spark = docs.sparkSession
    n_buckets = n_buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    new = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "text")
    keep = [c for c in keep if c not in new]
    src = docs.select(*[F.col(c) for c in dict.fromkeys(["doc_id", *keep])], F.col("text").cast("string").alias("text")).withColumn("held_out", held_out())
    words = cut_lineage(src.select((~F.col("held_out")).alias("train"), "text")
                        .mapInArrow(_count_rows(n_buckets), "bucket int, h array<long>, c array<long>, word array<string>")
                        .groupBy("bucket").applyInArrow(_sum_bucket, "h long, c long, word string"), "words")
    n_train = src.where(~F.col("held_out")).count()
    row = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"),
                    F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    n_tokens, n_types = row["n"] + n_train, row["v"] + (n_train > 0)
    spread = float(n_tokens + n_types + 1)
    # absolute discounting; without training texts an end is as likely as a word
    discount = min(0.95, max(0.05, row["n1"] / max(1, row["n1"] + 2 * row["n2"])))
    spare = discount * n_types / n_tokens if n_train else 0.5
    end_logp = float(np.log10((n_train - discount) / n_tokens if n_train else 0.5))

    pieces = Pieces(piece_path)
    for _ in range(ROUNDS if n_train else 0):
        got = (words.where("c > 0").select("word").mapInArrow(_expected_rows(Shipped(spark, pieces)), "piece long, n double")
               .groupBy("piece").agg(F.sum("n").alias("n")).orderBy("piece").toArrow())       # one row per piece
        n = np.full(len(pieces.names), SMOOTH)
        n[got.column("piece").to_numpy()] += got.column("n").to_numpy()
        pieces.logp = np.log(n / n.sum())
    table = cut_lineage(words.select("h", "c", "word").mapInArrow(
        _word_scores(Shipped(spark, pieces), discount, n_tokens, spare), "h long, c long, logp double"), "word-scores")

    def base(c):
        return F.log10((c + 1) / F.lit(spread))
    head = table.orderBy(F.desc("c"), "h").limit(HEAD).withColumn("base", base(F.col("c"))).toArrow()     # at most HEAD rows
    h = head.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    shared = Shipped(spark, (h[order], *(head.column(k).to_numpy()[order] for k in ("base", "logp")), (head.column("c").to_numpy() > 0)[order].astype(float)))
    cols = [*keep, "held_out"]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.select(*cols).dtypes), "n_tokens long, base_part double, logp_part double, known_part long",
                        "rest array<long>, rest_n array<long>"])
    texts = cut_lineage(src.select(*cols, "text").mapInArrow(_text_rows(shared, cols), schema)
                        .withColumn("_row", F.monotonically_increasing_id()), "texts")
    tail = (texts.select("_row", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select("_row", F.col("x.rest").alias("h"), F.col("x.rest_n").alias("m"))
            .join(table, "h").groupBy("_row")
            .agg(F.sum(F.col("m") * base(F.col("c"))).alias("b"), F.sum(F.col("m") * F.col("logp")).alias("l"),
                 F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("k")))
    end_base = float(np.log10((n_train + 1) / spread))
    return texts.join(tail, "_row", "left").select(
        *keep, "held_out", "n_tokens", (F.col("known_part") + F.coalesce("k", F.lit(0)) + int(n_train > 0)).cast("long").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce("b", F.lit(0.0)) + F.lit(end_base)).alias("base_score"),
        (F.col("logp_part") + F.coalesce("l", F.lit(0.0)) + F.lit(end_logp)).alias("score"))
