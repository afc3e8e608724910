"""Batch query routing and search over the catalog.

A batch of queries is a DataFrame end to end; nothing is collected.

Containment (``contains(tags, key)``): keys hold no spaces, so every match
lies inside one space-separated word of the tags. Matching runs as equi
joins: each key picks its rarest character n-gram (n = min(3, len)), joins
the distinct tag words that hold it and verifies ``contains`` on them. Results
stay (key, word) as long as an operator needs no items; words are mapped to
items through the (item, word) table.

Fuzzy titles: the best title by common blocks (``fuzzy_title_ratio``), which
all searches use, or by edits (Levenshtein ratio >= cutoff). A ratio >= c needs
lengths within the factor c, so candidates come from an equi join on length
bands; ``levenshtein``, bounded by the edits that c allows, verifies them in the
same pass.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.functions import text as tx
from tagwise.functions.fixed import (FUZZY_CUTOFF, NO_DESCRIPTION, PERSON_MIN_HITS, PERSON_WORD_MIN_LEN,
                                     POSTER_PLACEHOLDER, POSTER_PREFIX, RESULT_LIMIT, TITLE_NEIGHBOURS)
from tagwise.operators.similarity import LEAST, SELF_EPS, TIE_DIGITS, _blocks, _product, as_arrays, asked_and_held, packed_blocks, vectors_arrays
from tagwise.session import cut_lineage


# ---------------------------------------------------------------------------
# containment join
# ---------------------------------------------------------------------------

def _grams(col, n: int):
    """All overlapping substrings of n characters (a look-ahead capture, so
    it runs in the JVM regex engine; words hold no line breaks)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit("(?=(.{%d}))" % n), 1)


def tag_words(items: DataFrame, id_col: str = "movie_id", text_col: str = "tags") -> DataFrame:
    """(id, word): distinct space-separated words of each item's text."""
    return (items.select(F.col(id_col).alias("id"),
                         F.explode(F.array_distinct(F.split(text_col, " "))).alias("word"))
            .filter(F.col("word") != ""))


def word_table(words: DataFrame) -> DataFrame:
    """(word, items, len): every distinct word, the items that hold it, and
    its length."""
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("items"))
            .withColumn("len", F.char_length("word")))


def contains_words(keys: DataFrame, index: DataFrame) -> DataFrame:
    """keys (kid, key) x distinct words -> (kid, word, items) for words that
    contain the key. Keys must be non-empty and hold no space.

    Only words reach the result, so a key in a third of all items costs no
    (key, item) rows; keys longer than the longest word and grams that no key
    asks for are dropped before the join."""
    longest = index.agg(F.max("len")).first()[0] or 0
    keys = keys.filter(F.char_length("key") <= longest)
    width = F.least(F.char_length("key"), F.lit(3))
    kg = cut_lineage(keys.select("kid", "key", F.explode(F.array_distinct(F.when(F.char_length("key") < 3, F.array("key"))
                                                                          .otherwise(_grams("key", 3)))).alias("g"), width.alias("n")), "key_grams")
    widths = [r["n"] for r in kg.select("n").distinct().orderBy("n").collect()]      # 1, 2, 3 at most

    def held(grams, widths):
        """(word, items, g) of the given grams; they are cut anew for each use, as all (word, gram) rows are many times the words."""
        each = index.select("word", "items", F.lit(None).cast("string").alias("g")).limit(0)
        for n in widths:
            each = each.unionByName(index.filter(F.col("len") >= n)
                                    .select("word", "items", F.explode(F.array_distinct(_grams("word", n))).alias("g")))
        return each.join(grams, "g", "left_semi")
    # a short key is its own gram; the others take the gram that fewest words hold
    long = kg.filter("n = 3")
    asked = cut_lineage(long.select("g").distinct(), "asked_grams")
    gdf = held(asked, [n for n in widths if n == 3]).groupBy("g").agg(F.count(F.lit(1)).alias("gdf"))
    # a gram that no word holds means no match at all
    best = (long.join(gdf, "g", "left").groupBy("kid", "key")
            .agg(F.min_by("g", F.struct(F.coalesce("gdf", F.lit(0)), "g")).alias("g"), F.min(F.coalesce("gdf", F.lit(0))).alias("gdf"))
            .filter(F.col("gdf") > 0).select("kid", "key", "g"))
    best = cut_lineage(best.unionByName(kg.filter("n < 3").select("kid", "key", "g").distinct()), "rarest_grams")
    rarest = cut_lineage(best.select("g").distinct(), "rarest_distinct")
    return best.join(held(rarest, widths), "g").filter(F.col("word").contains(F.col("key"))).select("kid", "word", "items")


def contains_join(keys: DataFrame, words: DataFrame, index: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """keys (kid, key) x items -> (kid, id) for items whose text contains key.

    The matching words are written first, so the join knows their size and need
    not shuffle the words of all items. With ``texts`` (id, text), a key whose
    words stand in as many places as there are items is looked for in the texts
    themselves, as its words would be more rows; a text holds no more keys than
    it has substrings, so such keys are few however many items there are."""
    hit = cut_lineage(contains_words(keys, index), "hit_words")
    if texts is None:
        return hit.join(words, "word").select("kid", "id").distinct()
    broad = hit.groupBy("kid").agg(F.sum("items").alias("total")).filter(F.col("total") >= texts.count())
    broad = cut_lineage(broad.join(keys, "kid").select("kid", "key"), "broad_keys")
    rare = cut_lineage(hit.join(F.broadcast(broad.select("kid")), "kid", "left_anti").select("kid", "word"), "rare_words")
    found = rare.join(words, "word").select("kid", "id")
    found = found.unionByName(texts.join(F.broadcast(broad), F.col("text").contains(F.col("key"))).select("kid", "id"))
    return found.distinct()


def keys_in_items(keys: DataFrame, words: DataFrame, index: DataFrame, least: int) -> DataFrame:
    """(kid) of the keys that at least ``least`` items contain. A word held
    by so many items decides alone; items are counted only for keys whose
    words are all rarer, so no key meets more than ``least`` items per word."""
    hit = cut_lineage(contains_words(keys, index), "hit_words")
    per = hit.groupBy("kid").agg(F.max("items").alias("most"), F.sum("items").alias("total"))
    sure = per.filter(F.col("most") >= least).select("kid")
    rare = hit.join(per.filter((F.col("most") < least) & (F.col("total") >= least)).select("kid"), "kid", "left_semi")
    few = (rare.join(words, "word").groupBy("kid").agg(F.count_distinct("id").alias("n"))
           .filter(F.col("n") >= least).select("kid"))
    return sure.unionByName(few)


# ---------------------------------------------------------------------------
# fuzzy title match
# ---------------------------------------------------------------------------

LENGTH_BAND = 1.25      # titles whose lengths lie within this factor share a join key
MIN_CUTOFF = 1e-6


def _band(n):
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.lit(math.log(LENGTH_BAND))).cast("int")


def fuzzy_title_match(queries: DataFrame, titles: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """queries (kid, q) x titles (title) -> (kid, matched, ratio): the best
    title with 1 - levenshtein/max_len >= cutoff; ties -> larger string."""
    tl = titles.select(F.col("title").alias("t")).distinct()
    # an identical title has ratio 1, the maximum, and only it can have it:
    # resolve those queries with an equi join and send only the rest on
    exact = (queries.join(tl, queries["q"] == tl["t"])
             .select("kid", F.col("t").alias("matched"), F.lit(1.0).alias("ratio")))
    rest = cut_lineage(queries.filter("q <> ''").join(exact.select("kid"), "kid", "left_anti").select("kid", "q"), "unmatched_queries")
    lq, lt = F.char_length("q"), F.char_length("cand")
    mx = F.greatest(lq, lt)
    asked = rest.select("kid", "q", F.explode(F.sequence(_band(F.floor(lq * cutoff)), _band(F.ceil(lq / max(cutoff, MIN_CUTOFF))))).alias("band"))
    # the length band is necessary for the ratio; the distance bound lets
    # levenshtein stop early. A pair meets in one band, so pairs stay distinct
    # and go from the join to the score without a shuffle of their own
    cands = tl.filter("t <> ''").select(F.col("t").alias("cand"), _band(F.char_length("t")).alias("band"))
    band = asked.join(cands, "band").filter(F.least(lq, lt) >= F.lit(cutoff) * mx)
    limit = F.floor(F.lit(1 - cutoff) * mx + 1e-9).cast("int")
    scored = (band.select("kid", "q", "cand", mx.alias("mx"), limit.alias("lim"))
              .select("kid", "cand", "mx", F.expr("levenshtein(q, cand, lim)").alias("d"))
              .filter(F.col("d") >= 0)
              .select("kid", "cand", (1 - F.col("d") / F.col("mx")).alias("ratio")))
    ok = scored.filter(F.col("ratio") >= cutoff - 1e-12)
    fuzzy = (ok.groupBy("kid")
             .agg(F.max_by("cand", F.struct("ratio", "cand")).alias("matched"),
                  F.max("ratio").alias("ratio")))
    return exact.unionByName(fuzzy)


def _shared(counts: str, title: str):
    """Characters that the title shares with the query's (character, count)
    list, as multisets: the most that common blocks can hold."""
    held = lambda c: F.char_length(title) - F.char_length(F.replace(F.col(title), c, F.lit("")))
    return F.aggregate(counts, F.lit(0), lambda a, x: a + F.least(x["n"], held(x["c"])))


_BEST = T.StructType([T.StructField("kid", T.LongType()), T.StructField("matched", T.StringType()),
                      T.StructField("ratio", T.DoubleType()), T.StructField("candidates", T.LongType()),
                      T.StructField("scored", T.LongType())])


def _best_title(cutoff: float):
    """Rows sorted by query and falling bound -> each query's best title here.
    A bound below the best ratio so far ends the query's scoring; an equal one
    does not, as equal ratios go to the larger title."""
    def fn(batches):
        kid = matched = None
        ratio, seen, scored, blocks = 0.0, 0, 0, SequenceMatcher(None)
        for pdf in batches:
            out = []
            for k, q, title, bound in zip(pdf["kid"], pdf["q"], pdf["cand"], pdf["bound"]):
                if k != kid:
                    if kid is not None:
                        out.append((kid, matched, ratio, seen, scored))
                    kid, matched, ratio, seen, scored = k, None, 0.0, 0, 0
                    blocks.set_seq2(q)
                seen += 1
                if bound < ratio:
                    continue
                blocks.set_seq1(title)
                scored += 1
                r = blocks.ratio()
                if r >= cutoff and (r, title) > (ratio, matched or ""):
                    ratio, matched = r, title
            if out:
                yield pd.DataFrame(out, columns=_BEST.fieldNames())
        if kid is not None:
            yield pd.DataFrame([(kid, matched, ratio, seen, scored)], columns=_BEST.fieldNames())
    return fn


def fuzzy_title_ratio(queries: DataFrame, titles: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """queries (kid, q) x titles (title) -> (kid, matched, ratio, candidates,
    scored): the best title by the ratio 2 * M / (length + length), M = the
    characters in common blocks (longest block first, then left and right of
    it), ratio >= cutoff; ties -> larger string.

    An identical title is the best one and is found by an equi join. For the
    other queries M is bounded by the shorter string and by the characters
    shared as multisets: the first bound is an equi join on bands of the
    admissible lengths, the second an expression on its rows, and only pairs that pass
    both (``candidates``) reach a task's scoring. There they are scored by falling bound,
    and a bound below the best ratio so far saves the scoring (``scored``
    counts the others). Each task returns its best title per query, so no group
    of titles of one query or one length is ever collected. Queries or titles
    that are null or empty match nothing."""
    tl = titles.select(F.col("title").alias("t")).filter("t <> ''").distinct()
    queries = queries.select("kid", "q").filter("q <> ''")
    exact = queries.join(tl, queries["q"] == tl["t"]).select(
        "kid", F.col("t").alias("matched"), F.lit(1.0).alias("ratio"), F.lit(0).cast("long").alias("candidates"),
        F.lit(0).cast("long").alias("scored"))
    rest = queries.join(exact.select("kid"), "kid", "left_anti")
    lq = F.char_length("q")
    spread = (2 - cutoff) / cutoff      # the longer string's length over the shorter one's, at most
    chars = F.array_distinct(F.filter(F.split("q", ""), lambda c: c != ""))
    counts = F.transform(chars, lambda c: F.struct(c.alias("c"), (lq - F.char_length(F.replace(F.col("q"), c, F.lit("")))).alias("n")))
    asked = rest.select("kid", "q", lq.alias("lq"), counts.alias("counts"),
                        F.explode(F.sequence(_band(F.floor(lq / spread)), _band(F.ceil(lq * spread)))).alias("band"))
    bound = lambda most: F.lit(2.0) * most / (F.col("lq") + F.col("lt"))
    lt = F.char_length("t")
    pairs = (asked.join(tl.select(F.col("t").alias("cand"), lt.alias("lt"), _band(lt).alias("band")), "band")
             .filter(bound(F.least("lq", "lt")) >= cutoff)
             .withColumn("bound", bound(_shared("counts", "cand"))).filter(F.col("bound") >= cutoff)
             .select("kid", "q", "cand", "bound"))
    best = pairs.sortWithinPartitions("kid", F.desc("bound")).mapInPandas(_best_title(cutoff), _BEST)
    fuzzy = (best.groupBy("kid")
             .agg(F.max_by("matched", F.struct("ratio", "matched")).alias("matched"), F.max("ratio").alias("ratio"),
                  F.sum("candidates").alias("candidates"), F.sum("scored").alias("scored"))
             .filter(F.col("matched").isNotNull()))
    return exact.unionByName(fuzzy)


# ---------------------------------------------------------------------------
# routing
# ---------------------------------------------------------------------------

def prepare_queries(raw: DataFrame, col: str = "query") -> DataFrame:
    """Distinct non-blank queries with an id, lower-cased and squeezed."""
    q = raw.select(F.col(col).alias("query")).filter(F.trim("query") != "").distinct()
    ql = F.lower(F.trim("query"))
    return q.select(F.xxhash64("query").alias("kid"), "query", ql.alias("q"),
                    tx.squeeze(ql).alias("squeezed"))


def route_query(queries: DataFrame, cat: DataFrame, genre_vocab: DataFrame,
                char_map: DataFrame, words: DataFrame, index: DataFrame,
                min_hits: int = PERSON_MIN_HITS, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """(kid, query, q, route, person_key, matched_title): genre -> character
    -> person (>= min_hits items contain the squeezed query and it is no
    squeezed title) -> title (fuzzy) -> person fallback -> none."""
    g = queries.join(F.broadcast(genre_vocab.select(F.col("genre_query").alias("q"),
                                                    F.lit(True).alias("is_genre"))), "q", "left")
    c = g.join(F.broadcast(char_map.select(F.col("character").alias("q"), "actor")), "q", "left")
    keys = queries.filter(F.col("squeezed") != "").select("kid", F.col("squeezed").alias("key"))
    hits = keys_in_items(keys, words, index, min_hits).withColumn("is_held", F.lit(True))
    sq_titles = cat.select(tx.squeeze(F.lower("title")).alias("squeezed")).distinct() \
        .withColumn("is_title", F.lit(True))
    person_pre = F.col("is_held").isNotNull() & F.col("is_title").isNull()
    early = cut_lineage(c.join(hits, "kid", "left").join(sq_titles, "squeezed", "left").withColumn("person_pre", person_pre), "early")
    # titles are matched only for queries that no earlier step has taken
    rest = early.filter(F.col("is_genre").isNull() & F.col("actor").isNull() & ~F.col("person_pre"))
    titles = cat.select(F.lower("title").alias("title"))
    x = early.join(fuzzy_title_ratio(rest.select("kid", "q"), titles, cutoff), "kid", "left")
    route = (F.when(F.col("is_genre"), "genre")
             .when(F.col("actor").isNotNull(), "character")
             .when(F.col("person_pre"), "person")
             .when(F.col("matched").isNotNull(), "title")
             .when(F.col("squeezed") != "", "person_fallback")
             .otherwise("none"))
    return x.select("kid", "query", "q", route.alias("route"),
                    F.coalesce("actor", "squeezed").alias("person_key"),
                    F.col("matched").alias("matched_title"))


# ---------------------------------------------------------------------------
# genre search
# ---------------------------------------------------------------------------

def search_by_genre(routed: DataFrame, cat: DataFrame, alias_map: DataFrame,
                    words: DataFrame, index: DataFrame, seed: int = 0,
                    limit: int = RESULT_LIMIT) -> DataFrame:
    """Genre filter on the joined genre list; when nothing matches, the first
    alias term (in order) whose squeezed form a tag contains; then a seeded
    pseudo-random sample of ``limit`` titles."""
    gq = routed.filter(F.col("route") == "genre").select("kid", "query", "q")
    terms = (gq.join(F.broadcast(alias_map), "q", "left")
             .select("kid", "query", F.posexplode(F.coalesce("terms", F.array("q"))).alias("tpos", "term"))
             .select("kid", "query", "tpos", F.regexp_replace("term", " ", "").alias("term")))
    # the term must occur in the joined genre string: the same containment
    # join as for tags, over the (item, joined genres) "words"
    gstr = cat.select(F.col("movie_id").alias("id"),
                      F.lower(F.regexp_replace(F.concat_ws("", "genres"), " ", "")).alias("word"))
    gwords = gstr.filter(F.col("word") != "")
    gkeys = terms.filter(F.col("term") != "").select(
        F.xxhash64("kid", "tpos").alias("tk"), "kid", "term")
    gh = contains_join(gkeys.select(F.col("tk").alias("kid"), F.col("term").alias("key")),
                       gwords, word_table(gwords))
    by_genre = (gh.join(gkeys.select(F.col("tk").alias("kid"), F.col("kid").alias("qk")), "kid")
                .select(F.col("qk").alias("kid"), "id").distinct()
                .join(cat.select(F.col("movie_id").alias("id"), "title"), "id")
                .select("kid", "id", "title"))
    # fallback: terms contained in the tags, for queries without genre hits
    need = terms.join(by_genre.select("kid").distinct(), "kid", "left_anti")
    fkeys = need.filter(F.col("term") != "").select(
        F.xxhash64("kid", "tpos").alias("tk"), "kid", "tpos", "term")
    fh = contains_join(fkeys.select(F.col("tk").alias("kid"), F.col("term").alias("key")), words, index)
    fh = fh.join(fkeys.select(F.col("tk").alias("kid"), F.col("kid").alias("qk"), "tpos"), "kid") \
        .select(F.col("qk").alias("kid"), "tpos", "id")
    first_t = fh.groupBy("kid").agg(F.min("tpos").alias("tpos"))
    by_tags = fh.join(first_t, ["kid", "tpos"]).join(cat.select(F.col("movie_id").alias("id"), "title"), "id") \
        .select("kid", "id", "title")
    m = by_genre.unionByName(by_tags)
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")))
    w = Window.partitionBy("kid").orderBy(order, "id")
    # a filter on the row number itself lets the window keep ``limit`` rows per partition only
    return (m.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= limit)
            .join(gq.select("kid", "query"), "kid")
            .select("query", F.lit("genre").alias("route"), (F.col("rn") - 1).alias("pos"), "title",
                    F.lit(None).cast("double").alias("score")))


# ---------------------------------------------------------------------------
# person search: anchors -> summed vector -> blocked scoring -> top titles
# ---------------------------------------------------------------------------

_PERSON_SCHEMA = T.StructType([T.StructField("kid", T.LongType()), T.StructField("id", T.LongType()),
                               T.StructField("score", T.DoubleType()), T.StructField("tkey", T.LongType())])
SUM_ROWS = 256          # vectors that are added at once, and sums that a task keeps


def _sum_vectors(batches):
    """Rows (kids, idx, w) -> (kid, term_idx, w): the sums of each kid's vectors
    in the task."""
    held: dict = {}

    def out():
        for kid, v in held.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kid, np.int64)), pa.array(at, pa.int32()), pa.array(v[at])], ["kid", "term_idx", "w"])
        held.clear()
    for t in batches:
        for a in range(0, len(t), SUM_ROWS):
            x = t.slice(a, SUM_ROWS)
            row = lambda c: np.repeat(np.arange(len(x)), pc.list_value_length(x.column(c)).to_numpy())
            kids, who = np.unique(x.column("kids").flatten().to_numpy(), return_inverse=True)
            idx = x.column("idx").flatten().to_numpy()
            V = np.zeros((len(x), int(idx.max()) + 1))
            V[row("idx"), idx] = x.column("w").flatten().to_numpy()
            for lo in range(0, len(kids), SUM_ROWS):
                asks = np.zeros((min(SUM_ROWS, len(kids) - lo), len(x)))
                mine = (who >= lo) & (who < lo + SUM_ROWS)
                asks[who[mine] - lo, row("kids")[mine]] = 1
                for kid, v in zip(kids[lo:lo + SUM_ROWS].tolist(), asks @ V):
                    if kid not in held and len(held) >= SUM_ROWS:
                        yield from out()
                    old = held.get(kid)
                    if old is not None and len(old) > len(v):
                        old[:len(v)] += v
                    else:
                        if old is not None:
                            v[:len(old)] += old
                        held[kid] = v
    yield from out()


class _BestTitles:
    """The ``limit`` best of different titles of each query over the blocks met
    so far, by (round(score, 9) desc, id asc), positive scores only."""

    def __init__(self, kids: np.ndarray, limit: int):
        self.kids, self.limit = kids, limit
        self.floor = np.full(len(kids), LEAST)
        self.row = self.other = self.tkey = np.zeros(0, np.int64)
        self.score = np.zeros(0)

    def add(self, S: np.ndarray, other: np.ndarray, tkey: np.ndarray) -> None:
        r, c = np.nonzero(S >= self.floor[:, None])
        if not len(r):
            return
        row, oid = np.concatenate([self.row, r]), np.concatenate([self.other, other[c]])
        title, score = np.concatenate([self.tkey, tkey[c]]), np.concatenate([self.score, S[r, c]])
        key = np.round(score, TIE_DIGITS)
        o = np.lexsort((oid, -key, row))
        row, oid, title, score, key = (x[o] for x in (row, oid, title, score, key))
        o = np.lexsort((np.arange(len(row)), title, row))
        first = np.ones(len(o), bool)
        first[1:] = (row[o][1:] != row[o][:-1]) | (title[o][1:] != title[o][:-1])
        keep = np.sort(o[first])
        row, oid, title, score, key = (x[keep] for x in (row, oid, title, score, key))
        at = np.arange(len(row)) - np.searchsorted(row, row)
        last = at == self.limit - 1
        self.floor[row[last]] = np.maximum(key[last] - SELF_EPS, LEAST)
        keep = at < self.limit
        self.row, self.other, self.tkey, self.score = row[keep], oid[keep], title[keep], score[keep]


def _person_kernel(limit: int):
    """Pairs of a block of queries and one of items -> each query's best titles
    over all blocks that the task met."""
    def run(batches):
        best: dict = {}
        seen: tuple = (None, None)
        for t in batches:
            a_data, b_data, b_tkey = (t.column(c) for c in ("a_data", "b_data", "b_tkey"))
            for i, lo in enumerate(t.column("a_blk").to_pylist()):
                if seen[0] != lo:
                    seen = (lo, _blocks(a_data[i].as_buffer()))
                tkey, at = np.frombuffer(b_tkey[i].as_buffer(), np.int64), 0
                for d in _blocks(b_data[i].as_buffer()):
                    for x, q in enumerate(seen[1]):
                        best.setdefault((lo, x), _BestTitles(q.ids, limit)).add(_product(q, d), d.ids, tkey[at:at + len(d.ids)])
                    at += len(d.ids)
        for x in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(x.kids[x.row]), pa.array(x.other), pa.array(x.score), pa.array(x.tkey)], _PERSON_SCHEMA.fieldNames())
    return run


def person_scores(anchors: DataFrame, vlong: DataFrame, items: DataFrame,
                  limit: int = RESULT_LIMIT, block_rows: int = 1024) -> DataFrame:
    """anchors (kid, anchor_id) -> the best ``limit`` distinct titles of each kid
    and task by summed anchor similarity: (kid, id, score, tkey). sum_a cos(a, j) =
    (sum_a v_a) . v_j; the anchors' vectors are added inside the tasks, and
    blocks of query vectors meet blocks of items as in ``topk_for_rows`` (no
    anchor x item pair table, no row per anchor and term, no vector shuffled per
    block)."""
    v = as_arrays(vlong, [])
    asks = anchors.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("kid").alias("kids"))
    sums = v.join(asks, "id").select("kids", "idx", "w").mapInArrow(_sum_vectors, "kid long, term_idx int, w double")
    qv = sums.groupBy("kid", "term_idx").agg(F.sum("w").alias("w")).withColumnRenamed("kid", "id")
    tkey = items.select(F.col("movie_id").alias("id"), F.xxhash64("title").alias("tkey")).groupBy("id").agg(F.min("tkey").alias("tkey"))
    asked, held = asked_and_held(packed_blocks(vectors_arrays(qv), 256, []), packed_blocks(v.join(tkey, "id"), block_rows, [], "tkey"))
    side = lambda df, name: df.select(*[F.col(c).alias(f"{name}_{c}") for c in df.columns])
    return side(asked, "a").crossJoin(side(held, "b")).mapInArrow(_person_kernel(limit), _PERSON_SCHEMA)


def rank_person_results(cands: DataFrame, items: DataFrame, keys: DataFrame,
                        limit: int = RESULT_LIMIT) -> DataFrame:
    """Merge block candidates into the first ``limit`` distinct titles (score
    desc, id asc), filling with zero-score titles in id order when fewer
    scored; titles whose tags contain the person key go first, in reverse
    rank order, then the rest in rank order."""
    titles = items.select(F.col("movie_id").alias("id"), "title", "tags",
                          F.xxhash64("title").alias("tkey"))
    best = (cands.groupBy("kid", "tkey")
            .agg(F.max_by("id", F.struct(F.round("score", TIE_DIGITS), -F.col("id"))).alias("id"),
                 F.max("score").alias("score")))
    # zero-score fillers: the first 2*limit-1 titles by their smallest id
    first_ids = titles.groupBy("tkey").agg(F.min("id").alias("id"))
    fill = (first_ids.orderBy("id").limit(2 * limit - 1)
            .agg(F.collect_list(F.struct("tkey", "id")).alias("f")))  # one row, <= 2*limit-1 entries
    fillers = (keys.select("kid").crossJoin(F.broadcast(fill))
               .select("kid", F.explode("f").alias("e"))
               .select("kid", "e.tkey", "e.id", F.lit(0.0).alias("score")))
    u = best.unionByName(fillers)
    per_t = Window.partitionBy("kid", "tkey").orderBy(F.desc(F.round("score", TIE_DIGITS)), "id")
    u = u.withColumn("t1", F.row_number().over(per_t)).filter("t1 = 1")
    w = Window.partitionBy("kid").orderBy(F.desc(F.round("score", TIE_DIGITS)), "id")
    # written: a few rows a query, with which the texts can be joined where they stand
    top = cut_lineage(u.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit), "person_top")
    x = top.join(titles.select("id", "title", "tags"), "id").join(keys, "kid")
    hit = F.col("tags").contains(F.col("person_key"))
    w2 = Window.partitionBy("kid").orderBy(F.desc(hit.cast("int")),
                                           F.when(hit, -F.col("rank")).otherwise(F.col("rank")))
    return x.withColumn("pos", F.row_number().over(w2) - 1).select(
        "kid", "pos", "title", F.round("score", 4).alias("score"))


def person_anchors(routed: DataFrame, words: DataFrame, index: DataFrame, texts: DataFrame | None = None,
                   word_min_len: int = PERSON_WORD_MIN_LEN) -> DataFrame:
    """(kid, anchor_id, person_key): items containing the person key; when
    none, the first query word longer than 3 characters that has a hit."""
    p = routed.filter(F.col("route").isin("person", "character", "person_fallback")) \
        .filter(F.col("person_key") != "")
    direct = contains_join(p.select("kid", F.col("person_key").alias("key")), words, index, texts)
    missing = p.join(direct.select("kid").distinct(), "kid", "left_anti")
    wd = (missing.select("kid", F.posexplode(F.split("q", r"(?U)\s+")).alias("wpos", "word"))
          .filter(F.char_length("word") >= word_min_len))
    wk = wd.select(F.xxhash64("kid", "wpos").alias("wk"), "kid", "wpos", "word")
    wh = contains_join(wk.select(F.col("wk").alias("kid"), F.col("word").alias("key")), words, index, texts)
    wh = wh.join(wk.select(F.col("wk").alias("kid"), F.col("kid").alias("qk"), "wpos"), "kid") \
        .select(F.col("qk").alias("kid"), "wpos", "id")
    first_w = wh.groupBy("kid").agg(F.min("wpos").alias("wpos"))
    by_word = wh.join(first_w, ["kid", "wpos"]).select("kid", "id")
    anchors = direct.unionByName(by_word).select("kid", F.col("id").alias("anchor_id"))
    return anchors.join(p.select("kid", "person_key"), "kid")


def search_by_person(routed: DataFrame, cat: DataFrame, vlong: DataFrame, words: DataFrame,
                     index: DataFrame, limit: int = RESULT_LIMIT, block_rows: int = 1024) -> DataFrame:
    # anchors feed the query vectors, the person keys and a size count;
    # written once so later plans scan them instead of re-planning them
    texts = cat.select(F.col("movie_id").alias("id"), F.col("tags").alias("text"))
    anchors = cut_lineage(person_anchors(routed, words, index, texts), "anchors")
    keys = anchors.select("kid", "person_key").distinct()
    cands = cut_lineage(person_scores(anchors.select("kid", "anchor_id"), vlong, cat, limit, block_rows),
                        "person_cands")
    res = rank_person_results(cands, cat, keys, limit)
    return res.join(routed.select("kid", "query", "route"), "kid").select(
        "query", "route", "pos", "title", "score")


# ---------------------------------------------------------------------------
# title search, batch, outcome, sorting, enrichment
# ---------------------------------------------------------------------------

def title_anchors(routed: DataFrame, cat: DataFrame) -> DataFrame:
    """(query, anchor, title): the first item of each matched title."""
    t = routed.filter(F.col("route") == "title").select("kid", "query", "matched_title")
    first = (cat.select(F.lower("title").alias("matched_title"), F.col("movie_id").alias("id"), "title")
             .groupBy("matched_title").agg(F.min_by(F.struct("id", "title"), "id").alias("a"))
             .select("matched_title", F.col("a.id").alias("anchor"), F.col("a.title").alias("title")))
    return t.join(first, "matched_title").select("query", "anchor", "title")


def title_recommend(a: DataFrame, cat: DataFrame, topk: DataFrame,
                    n: int = TITLE_NEIGHBOURS) -> DataFrame:
    """Anchors of ``title_anchors``: the matched title followed by its
    anchor's n nearest neighbours."""
    head = a.select("query", F.lit(0).alias("pos"), "title", F.lit(None).cast("double").alias("score"))
    nb = (a.join(topk.filter(F.col("rank") <= n), F.col("anchor") == F.col("id"))
          .join(cat.select(F.col("movie_id").alias("other_id"), F.col("title").alias("ntitle")), "other_id")
          .select("query", F.col("rank").alias("pos"), F.col("ntitle").alias("title"),
                  F.round("score", 4).alias("score")))
    return head.unionByName(nb).withColumn("route", F.lit("title")).select(
        "query", "route", "pos", "title", "score")


def recommend_metrics(results: DataFrame) -> DataFrame:
    """Per query: result count, top and mean neighbour score (4 dp). Only the
    title route reports similarity; genre and person results count 0."""
    results = results.withColumn("score", F.when(F.col("route") == "title", F.col("score")))
    return results.groupBy("query", "route").agg(
        F.count(F.lit(1)).alias("recommendations_count"),
        F.round(F.coalesce(F.max_by("score", F.when(F.col("score").isNotNull(), -F.col("pos"))),
                           F.lit(0.0)), 4).alias("top_similarity_score"),
        F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 4).alias("avg_similarity_score"))


def recommend_outcome(queries: DataFrame, results: DataFrame) -> DataFrame:
    """success (first title = matched title) / not_found / error (blank)."""
    firsts = results.filter(F.col("pos") == 0).select("query", F.col("title").alias("matched_title"))
    counts = results.groupBy("query").agg(F.count(F.lit(1)).alias("recommendations_count"))
    q = queries.select("query").distinct()
    x = q.join(firsts, "query", "left").join(counts, "query", "left")
    blank = F.trim(F.coalesce("query", F.lit(""))) == ""
    return x.select("query",
                    F.when(blank, "error").when(F.col("matched_title").isNull(), "not_found")
                    .otherwise("success").alias("status"),
                    "matched_title", F.coalesce("recommendations_count", F.lit(0)).alias("recommendations_count"))


def blank_query_guard(raw: DataFrame, col: str = "query") -> DataFrame:
    """Adds ``accepted`` and ``status``: a null or blank query is rejected
    with status error and never routed."""
    ok = F.trim(F.coalesce(F.col(col), F.lit(""))) != ""
    return raw.withColumn("accepted", ok).withColumn("status", F.when(ok, "accepted").otherwise("error"))


def sort_recommendations(results: DataFrame, key: list[str] | None = None, rating: str = "rating",
                         pos: str = "pos", query: str = "query", title: str = "title") -> DataFrame:
    """Titles equal to the query (trimmed, lower case) first, then rated items
    by rating desc (input order on ties), then the others in input order. A
    rating of 0 or less counts as none. The rating is shown rounded to 1
    decimal or as 'N/A'."""
    key = key or []
    searched = F.lower(F.trim(title)) == F.lower(F.trim(query))
    rated = F.coalesce(F.col(rating) > 0, F.lit(False))
    bucket = F.when(searched, 0).when(rated, 1).otherwise(2)
    w = Window.partitionBy(*key).orderBy(bucket, F.desc_nulls_last(F.when(bucket == 1, F.col(rating))), pos)
    label = F.when(rated, F.format_string("%.1f", F.round(F.col(rating), 1))).otherwise(F.lit("N/A"))
    return results.select("*", (F.row_number().over(w) - 1).alias("display_pos"), label.alias("rating_label"))


def enrich_metadata(titles: DataFrame, candidates: DataFrame, failed: str | None = None,
                    fallback_overview: str = NO_DESCRIPTION, image_prefix: str = POSTER_PREFIX,
                    placeholder: str = POSTER_PLACEHOLDER) -> DataFrame:
    """Per requested title: the first candidate (by ``cand_pos``) that has a
    poster (outcome success); else the constants (fallback): placeholder
    poster, no rating, the default overview. Where the boolean column
    ``failed`` of ``titles`` is true the request went wrong: the constants
    again, outcome error. The pick is a min_by aggregate, combined map-side, so
    a title with very many candidates is no hot task."""
    best = (candidates.filter(F.col("poster_path").isNotNull() & (F.col("poster_path") != "")).groupBy("title")
            .agg(F.min_by(F.struct("poster_path", "vote_average", "overview"), "cand_pos").alias("b")))
    bad = F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(False)
    good = F.col("b").isNotNull() & ~bad
    return titles.join(best, "title", "left").select(
        "title",
        F.when(good, F.concat(F.lit(image_prefix), F.col("b.poster_path"))).otherwise(F.lit(placeholder)).alias("poster"),
        F.when(good, F.col("b.vote_average")).alias("rating"),
        F.when(good, F.coalesce("b.overview", F.lit(fallback_overview))).otherwise(F.lit(fallback_overview)).alias("overview"),
        F.when(bad, "error").when(good, "success").otherwise("fallback").alias("outcome"))
