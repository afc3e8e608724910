"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query's SQL recomputes the answer from the raw tables with plain SQL;
shared pieces are CTE fragments built from the same parameters the Spark
operators use, so both sides read one definition of the fixed values.
"""

from __future__ import annotations

from tagwise.functions.fixed import (MAX_DF, MAX_FEATURES, MIN_DF, STOP_WORDS, TOP_K)
from tagwise.plans.derived import LANG_GENRE

# Java's (?U)\s, spelled out for RE2.
UWS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
ASCII_WS = r"[ \t\n\r]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(xs) -> str:
    return "[" + ", ".join(sql_str(x) for x in xs) + "]::VARCHAR[]"


def clean_text(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{UWS}', ' ', 'g'))"


def clean_name(x: str) -> str:
    return f"lower(regexp_replace({x}, '{UWS}', '', 'g'))"


def tokens(x: str, stop=STOP_WORDS) -> str:
    t = f"regexp_extract_all(lower({x}), '{TOKEN}')"
    if stop:
        t = f"list_filter({t}, lambda t: NOT list_contains({sql_list(stop)}, t))"
    return t


def uni_bi(toks: str) -> str:
    return (f"({toks}) || list_transform(range(1, len({toks})), "
            f"lambda i: ({toks})[i] || ' ' || ({toks})[i + 1])")


def heading(x: str) -> str:
    unit = r"[^\n.!?]*[^ \t\n\r.!?][^\n.!?]*"
    return f"trim(regexp_replace(regexp_extract({x}, '{unit}'), '{ASCII_WS}', ' ', 'g'))"


def genre_of(x: str) -> str:
    cases = " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in LANG_GENRE.items())
    return f"(CASE {clean_name(x)} {cases} ELSE {clean_name(x)} END)"


def catalog_cte() -> str:
    """documents -> catalog with tags (see plans/derived.py)."""
    kw = r"list_sort(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{10,}')))"
    return f"""
cat0 AS (
  SELECT doc_id AS movie_id,
         {heading('text')} AS title,
         text AS overview,
         [{genre_of('lang')}] AS genres,
         {kw} AS keywords,
         []::VARCHAR[] AS "cast",
         [{clean_name('source')}] AS crew
  FROM documents),
cat AS (
  SELECT *, array_to_string([{clean_text('overview')}] || genres || genres || keywords
            || "cast" || "cast" || crew || crew || crew, ' ') AS tags
  FROM cat0)"""


def tfidf_ctes(src: str = "cat", id_col: str = "movie_id", text_col: str = "tags",
               stop=STOP_WORDS, min_df=MIN_DF, max_df=MAX_DF, max_features=MAX_FEATURES) -> str:
    """-> CTEs tok, tf, nd, vocab, nv(id, term_idx, w normalised)."""
    return f"""
tk AS (SELECT {id_col} AS id, {tokens(text_col, stop)} AS t FROM {src}),
tok AS (SELECT id, unnest({uni_bi('t')}) AS term FROM tk),
tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term),
nd AS (SELECT count(*) AS n FROM {src}),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
vocab AS (
  SELECT term, df, cf, n, row_number() OVER (ORDER BY cf DESC, term) - 1 AS term_idx
  FROM st, nd WHERE df >= {min_df} AND df <= {max_df} * n
  QUALIFY term_idx < {max_features}),
wt AS (
  SELECT tf.id, v.term_idx,
         (1 + ln(tf.tf)) * (ln((1 + v.n)::DOUBLE / (1 + v.df)) + 1) AS w
  FROM tf JOIN vocab v USING (term)),
nv AS (SELECT id, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM wt)"""


def pairs_cte(src: str = "nv") -> str:
    return f"""
pairs AS (
  SELECT a.id, b.id AS other_id, sum(a.w * b.w) AS score
  FROM {src} a JOIN {src} b ON a.term_idx = b.term_idx AND a.id <> b.id
  GROUP BY a.id, b.id)"""


def topk_sql(k: int = TOP_K) -> str:
    return f"""WITH {catalog_cte()},{tfidf_ctes()},{pairs_cte()},
ranked AS (
  SELECT id, other_id, score,
         row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other_id) AS rank
  FROM pairs WHERE score > 0)
SELECT id, rank, other_id, round(score, 6) AS score FROM ranked WHERE rank <= {k}"""
