"""Oracle SQL per registered query id (DuckDB dialect, driver views)."""

from __future__ import annotations

from tagwise.functions import fixed as FX
from tagwise.operators import approx as AX
from tagwise.plans import oracle as O
from tagwise.plans.oracle import UWS, clean_name, clean_text, sql_str

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def rr(a: str, b: str, digits: int = 4) -> str:
    """Half-up rounding of an exact integer ratio (matches text.ratio_round)."""
    sc = 10 ** digits
    return f"(CASE WHEN ({b}) <> 0 THEN ((({a})::BIGINT * {2 * sc} + ({b})::BIGINT) // (({b})::BIGINT * 2)) / {sc}.0 END)"


def wc(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, '{UWS}'), lambda w: w <> ''))"


CAT = f"WITH RECURSIVE {O.catalog_cte()}"
TFIDF = f"WITH RECURSIVE {O.catalog_cte()},{O.tfidf_ctes()}"

FEEDBACK = """
fbk AS (
  SELECT event_id, ts, user_id, event_type, concat_ws(' ', event_type, props) AS query,
         CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN 'not_found'
              ELSE 'success' END AS status,
         value * 10 AS latency_ms
  FROM events),
pos AS (SELECT event_id, ts, user_id, props AS movie FROM events WHERE event_type = 'purchase')"""

FSTATS = f"""
fs AS (
  SELECT count(*) AS total_queries,
         avg({wc('query')}) AS query_length_mean,
         var_pop({wc('query')}) AS query_length_variance,
         coalesce(avg(latency_ms), 0.0) AS avg_latency_ms,
         count_if(status = 'success') / count(*) AS success_rate,
         count_if(status = 'not_found') / count(*) AS not_found_rate,
         count(DISTINCT query) AS unique_queries,
         (SELECT count(*) FROM pos) AS positive_count
  FROM fbk),
fs2 AS (
  SELECT total_queries >= {FX.MIN_FEEDBACK_FOR_DRIFT} AS sufficient_data, total_queries, positive_count,
         {rr('positive_count', 'total_queries')} AS positive_rate,
         query_length_mean, query_length_variance, avg_latency_ms, success_rate,
         not_found_rate, unique_queries, {FX.MIN_FEEDBACK_FOR_DRIFT} AS required
  FROM fs),
bl AS (
  SELECT round(avg({wc('tags')}), 9) AS base_mean, round(coalesce(var_samp({wc('tags')}), 1.0), 9) AS base_var
  FROM cat)"""

PCT = "printf('%.1f%%', ({x}) * 100)"


def pct(x):
    return PCT.format(x=x)


CHECKPOINTS = f"""
firsts AS (SELECT query, min({{'ts': ts, 'e': event_id}}) AS f FROM fbk GROUP BY query),
s AS (SELECT f.ts, f.event_id, 1 AS kind, {wc('f.query')}::DOUBLE AS wc, f.status,
             CASE WHEN x.query IS NULL THEN 0 ELSE 1 END AS is_new
      FROM fbk f LEFT JOIN firsts x ON x.f.ts = f.ts AND x.f.e = f.event_id),
u AS (SELECT * FROM s UNION ALL
      SELECT ts, event_id, 0, 0.0, NULL, 0 FROM pos),
c AS (
  SELECT *, sum(kind) OVER w AS cum_n, sum(wc) OVER w AS cum_wc, sum(wc * wc) OVER w AS cum_wc2,
         sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) OVER w AS cum_succ,
         sum(CASE WHEN status = 'not_found' THEN 1 ELSE 0 END) OVER w AS cum_nf,
         sum(is_new) OVER w AS cum_new, sum(1 - kind) OVER w AS cum_pos
  FROM u WINDOW w AS (ORDER BY ts, kind, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cp AS (
  SELECT cum_n AS rn, ts, event_id,
         round(cum_wc / cum_n, 6) AS query_length_mean,
         round(greatest(cum_wc2 / cum_n - (cum_wc / cum_n) * (cum_wc / cum_n), 0.0), 6) AS query_length_variance,
         round(cum_succ / cum_n, 6) AS success_rate, round(cum_nf / cum_n, 6) AS not_found_rate,
         cum_new AS unique_queries, cum_pos AS positive_count
  FROM c WHERE kind = 1 AND cum_n % {FX.DRIFT_CHECK_EVERY} = 0)"""
SUCCESS_CHECKPOINTS = CHECKPOINTS.replace("kind = 1 AND", "kind = 1 AND status = 'success' AND")     # the stream checks after a success only

VERDICTS = f"""
vd AS (
  SELECT cp.*, abs(query_length_mean - base_mean) / base_mean AS md,
         abs(query_length_variance - base_var) / greatest(base_var, 1.0) AS vdr,
         {rr('positive_count', 'rn')} AS prate
  FROM cp, bl),
vd2 AS (
  SELECT rn, ts, round(md, 4) AS mean_drift, round(vdr, 4) AS variance_drift, success_rate,
         prate AS positive_rate,
         (md > {FX.DRIFT_THRESHOLD_MEAN} OR vdr > {FX.DRIFT_THRESHOLD_VARIANCE}
          OR success_rate < {FX.LOW_SUCCESS_RATE}
          OR (rn > {FX.POSITIVE_RATE_MIN_TOTAL} AND prate < {FX.LOW_POSITIVE_RATE})) AS drift_detected
  FROM vd)"""

REGISTRY = f"""
reg AS (
  SELECT 'v_' || strftime(max(ts), '%Y%m%d_%H%M%S') AS version, max(ts) AS registered_at,
         {rr('count_if(value > 20)', 'count(*)')} AS genre_match_rate,
         count(*) AS n_items, count(DISTINCT user_id) AS vocabulary_size
  FROM events GROUP BY CAST(ts AS DATE))"""

RAW_JSONLESS = f"""
li AS (SELECT l_orderkey, l_linenumber, l_returnflag, p_name, p_brand, p_type
       FROM lineitem JOIN part ON l_partkey = p_partkey),
agg AS (
  SELECT l_orderkey AS movie_id,
         list({clean_name('p_type')} ORDER BY l_linenumber, p_type, p_brand, p_name, CASE WHEN l_returnflag = 'R' THEN 'Director' ELSE 'Producer' END) AS genres,
         list({clean_name('p_brand')} ORDER BY l_linenumber, p_type, p_brand, p_name, CASE WHEN l_returnflag = 'R' THEN 'Director' ELSE 'Producer' END) AS keywords,
         list({clean_name('p_name')} ORDER BY l_linenumber, p_type, p_brand, p_name, CASE WHEN l_returnflag = 'R' THEN 'Director' ELSE 'Producer' END)[1:{FX.CAST_TOP_N}] AS "cast",
         list({clean_name('p_name')} ORDER BY l_linenumber, p_type, p_brand, p_name, CASE WHEN l_returnflag = 'R' THEN 'Director' ELSE 'Producer' END) FILTER (WHERE l_returnflag = 'R') AS dirs
  FROM li GROUP BY l_orderkey),
pc AS (
  SELECT a.movie_id, c_name AS title, o_orderpriority AS overview, genres, keywords, "cast",
         CASE WHEN dirs IS NULL THEN []::VARCHAR[] ELSE dirs[1:1] END AS crew
  FROM agg a JOIN orders o ON o.o_orderkey = a.movie_id JOIN customer ON o_custkey = c_custkey)"""


def _quality_part():
    blank = lambda c: f"regexp_replace({c}, '^{UWS}|{UWS}$', '', 'g') = ''"
    return f"""
pq AS (SELECT p_name AS title, p_brand, p_type, p_retailprice FROM part),
b AS (SELECT quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.75) AS q3 FROM pq),
iss AS (
  SELECT 'min_rows' AS "check", NULL::VARCHAR AS "column", count(*)::DOUBLE AS value,
         CASE WHEN count(*) < {FX.MIN_ROWS} THEN printf('Too few rows: %d < %d', count(*), {FX.MIN_ROWS}) END AS issue
  FROM pq
  UNION ALL
  SELECT 'duplicates', 'title', (count(*) - count(DISTINCT title))::DOUBLE,
         CASE WHEN count(*) - count(DISTINCT title) > 0
              THEN printf('%d duplicate %s values', count(*) - count(DISTINCT title), 'title') END
  FROM pq
  UNION ALL
  SELECT 'empty_strings', c, n::DOUBLE, CASE WHEN n > 0 THEN printf('%d empty values in %s', n, c) END
  FROM (SELECT 'title' AS c, count_if({blank('title')}) AS n FROM pq
        UNION ALL SELECT 'p_brand', count_if({blank('p_brand')}) FROM pq
        UNION ALL SELECT 'p_type', count_if({blank('p_type')}) FROM pq)
  UNION ALL
  SELECT 'outliers', 'p_retailprice', n::DOUBLE, CASE WHEN n > 0 THEN printf('%d outliers in %s', n, 'p_retailprice') END
  FROM (SELECT count_if(p_retailprice < q1 - 1.5 * (q3 - q1) OR p_retailprice > q3 + 1.5 * (q3 - q1)) AS n
        FROM pq, b))"""


EV = """
ev AS (SELECT event_id, nullif(event_type, 'error') AS event_type, user_id,
              nullif(props, '{"k": 69}') AS props, value FROM events)"""

ORACLE: dict[str, str] = {
    "topk_neighbours": O.topk_sql(FX.TOP_K),
    "build_tags": f"{CAT} SELECT movie_id, title, tags FROM cat",
    "vocabulary": f"{TFIDF} SELECT term, term_idx, df, cf FROM vocab",
    "tfidf_vectors": f"{TFIDF} SELECT id, term_idx, round(w, 6) AS w FROM nv",
    "vocab_stats": f"""{TFIDF}
SELECT (SELECT count(*) FROM vocab) AS vocabulary_size, (SELECT n FROM nd) AS matrix_rows,
       count(*) AS nnz, count(DISTINCT id) AS nonzero_rows FROM nv""",
    "baseline_tag_length": f"""{CAT}
SELECT round(avg(length(tags)), 6) AS mean, round(var_samp(length(tags)), 6) AS variance,
       round(min(length(tags))::DOUBLE, 6) AS min, round(max(length(tags))::DOUBLE, 6) AS max,
       round(median(length(tags))::DOUBLE, 6) AS median FROM cat""",
    "baseline_word_count": f"""{CAT}
SELECT round(avg({wc('tags')}), 6) AS mean, round(var_samp({wc('tags')}), 6) AS variance,
       round(min({wc('tags')})::DOUBLE, 6) AS min, round(max({wc('tags')})::DOUBLE, 6) AS max FROM cat""",
    "baseline_list_counts": f"""{CAT}
SELECT 'genres' AS feature, round(avg(len(genres)), 6) AS mean_per_item, round(var_samp(len(genres)), 6) AS variance,
       count_if(len(genres) = 0) AS items_empty FROM cat
UNION ALL SELECT 'cast', round(avg(len("cast")), 6), round(var_samp(len("cast")), 6), count_if(len("cast") = 0) FROM cat
UNION ALL SELECT 'keywords', round(avg(len(keywords)), 6), round(var_samp(len(keywords)), 6),
       count_if(len(keywords) = 0) FROM cat""",
    "baseline_director_counts": f"""{CAT}
SELECT count_if(len(crew) > 0) AS with_director, count_if(len(crew) = 0) AS without_director FROM cat""",
    "baseline_top_genres": f"""{CAT}
SELECT genre, count(*) AS count FROM (SELECT unnest(genres) AS genre FROM cat)
GROUP BY genre ORDER BY count DESC, genre LIMIT 10""",
    "baseline_statistics": f"""{CAT}
SELECT count(*) AS total_items, round(avg(length(tags)), 6) AS tag_length_mean,
       round(median(length(tags))::DOUBLE, 6) AS tag_length_median,
       round(var_samp({wc('tags')}), 6) AS word_count_variance,
       round(avg(len(genres)), 6) AS genres_mean_per_item,
       count_if(len(keywords) = 0) AS items_no_keywords,
       count_if(len(crew) > 0) AS items_with_director,
       (SELECT least(count(DISTINCT g), 10) FROM (SELECT unnest(genres) AS g FROM cat)) AS top_genre_count
FROM cat""",
    "feature_importance": f"""{CAT},
t AS (SELECT sum({wc('tags')}) AS total,
             sum({wc('overview')}) AS overview, sum(len(genres) * 2) AS genres,
             sum(len(keywords)) AS keywords, sum(len("cast") * 2) AS "cast", sum(len(crew) * 3) AS director
      FROM cat)
SELECT feature, words, round(words / total * 100, 2) AS importance FROM (
  SELECT 'overview' AS feature, overview AS words, total FROM t UNION ALL
  SELECT 'genres', genres, total FROM t UNION ALL SELECT 'keywords', keywords, total FROM t UNION ALL
  SELECT 'cast', "cast", total FROM t UNION ALL SELECT 'director', director, total FROM t)""",
    "parse_catalog": f"""WITH {RAW_JSONLESS}
SELECT movie_id, title, array_to_string(genres, '|') AS genres, array_to_string(keywords, '|') AS keywords,
       array_to_string("cast", '|') AS "cast", array_to_string(crew, '|') AS crew,
       array_to_string([{clean_text('overview')}] || genres || genres || keywords || "cast" || "cast"
                       || crew || crew || crew, ' ') AS tags
FROM pc""",
    "catalog_merge_by_id": """
SELECT o_orderkey AS movie_id, o_orderpriority AS title, c_name AS "cast", c_mktsegment AS crew
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "missing_values": f"""WITH {EV},
m AS (SELECT count(*) AS n, count_if(event_id IS NULL) AS event_id, count_if(event_type IS NULL) AS event_type,
             count_if(user_id IS NULL) AS user_id, count_if(props IS NULL) AS props,
             count_if(value IS NULL) AS value FROM ev),
l AS (SELECT 'event_id' AS "column", event_id AS missing, n FROM m UNION ALL
      SELECT 'event_type', event_type, n FROM m UNION ALL SELECT 'user_id', user_id, n FROM m UNION ALL
      SELECT 'props', props, n FROM m UNION ALL SELECT 'value', value, n FROM m)
SELECT 'events' AS source, "column", missing, {rr('missing', 'n')} AS rate,
       CASE WHEN {rr('missing', 'n')} > {FX.MISSING_HIGH_RATE} THEN 'high' WHEN missing > 0 THEN 'some'
            ELSE 'none' END AS level FROM l""",
    "drop_nulls": f"""WITH {EV}
SELECT count(*) AS rows_before,
       count_if(event_id IS NULL OR event_type IS NULL OR user_id IS NULL OR props IS NULL OR value IS NULL)
         AS rows_dropped,
       count_if(NOT (event_id IS NULL OR event_type IS NULL OR user_id IS NULL OR props IS NULL OR value IS NULL))
         AS rows_after
FROM ev""",
    "min_rows_check": f"""
SELECT 'min_rows' AS "check", NULL::VARCHAR AS "column", count(*)::DOUBLE AS value,
       CASE WHEN count(*) < {FX.MIN_ROWS} THEN printf('Too few rows: %d < %d', count(*), {FX.MIN_ROWS}) END AS issue
FROM part""",
    "duplicate_titles": """
SELECT 'duplicates' AS "check", 'title' AS "column", (count(*) - count(DISTINCT p_name))::DOUBLE AS value,
       CASE WHEN count(*) - count(DISTINCT p_name) > 0
            THEN printf('%d duplicate %s values', count(*) - count(DISTINCT p_name), 'title') END AS issue
FROM part""",
    "empty_strings": f"""
SELECT 'empty_strings' AS "check", c AS "column", n::DOUBLE AS value,
       CASE WHEN n > 0 THEN printf('%d empty values in %s', n, c) END AS issue
FROM (SELECT 'text' AS c, count_if(regexp_replace(text, '^{UWS}|{UWS}$', '', 'g') = '') AS n FROM documents
      UNION ALL SELECT 'lang', count_if(regexp_replace(lang, '^{UWS}|{UWS}$', '', 'g') = '') FROM documents
      UNION ALL SELECT 'source', count_if(regexp_replace(source, '^{UWS}|{UWS}$', '', 'g') = '') FROM documents)""",
    "rating_outliers": """
WITH b AS (SELECT quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3 FROM customer),
n AS (SELECT count_if(c_acctbal < q1 - 1.5 * (q3 - q1) OR c_acctbal > q3 + 1.5 * (q3 - q1)) AS n FROM customer, b)
SELECT 'outliers' AS "check", 'c_acctbal' AS "column", n::DOUBLE AS value,
       CASE WHEN n > 0 THEN printf('%d outliers in %s', n, 'c_acctbal') END AS issue FROM n""",
    "quality_issues": f"WITH {_quality_part()} SELECT * FROM iss",
    "quality_summary": f"""WITH {_quality_part()}
SELECT count_if(issue IS NOT NULL) = 0 AS passed, count_if(issue IS NOT NULL) AS issue_count,
       coalesce(string_agg(issue, '; ' ORDER BY issue), '') AS issues FROM iss""",
    "validate_schema": """
SELECT 'part' AS source, c AS "column", c IN (SELECT column_name FROM (DESCRIBE part)) AS present,
       (SELECT count(*) FROM part) AS rows
FROM (VALUES ('p_partkey'), ('p_name'), ('p_retailprice'), ('p_comment')) t(c)""",
    "eda_profile": """
SELECT 'lineitem' AS "table", (row_number() OVER () - 1)::INTEGER AS position, column_name AS "column",
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type,
       (SELECT count(*) FROM lineitem) AS rows
FROM (DESCRIBE lineitem)""",
    "feedback_stats": f"""{CAT},{FEEDBACK},{FSTATS}
SELECT sufficient_data, total_queries, positive_count, positive_rate,
       round(query_length_mean, 6) AS query_length_mean, round(query_length_variance, 6) AS query_length_variance,
       round(avg_latency_ms, 6) AS avg_latency_ms, round(success_rate, 6) AS success_rate,
       round(not_found_rate, 6) AS not_found_rate, unique_queries, required FROM fs2""",
    "status_counts": f"WITH {FEEDBACK} SELECT status, count(*) AS count FROM fbk GROUP BY status",
    "request_counts": f"""WITH {FEEDBACK}
SELECT event_type AS endpoint,
       CASE WHEN status = 'error' THEN 500 WHEN status = 'not_found' THEN 404 ELSE 200 END AS status_code,
       count(*) AS count FROM fbk GROUP BY ALL""",
    "latency_histogram": f"""WITH {FEEDBACK},
h AS (SELECT {', '.join(f"count_if(latency_ms / 1000.0 <= {b}) AS b{i}" for i, b in enumerate(FX.REQUEST_LATENCY_BUCKETS))},
             count(*) AS cnt, sum(latency_ms / 1000.0) AS total FROM fbk)
SELECT le, bucket_count, round(total, 6) AS sum_seconds, cnt AS count FROM (
  {' UNION ALL '.join(f"SELECT '{b}' AS le, b{i} AS bucket_count, total, cnt FROM h" for i, b in enumerate(FX.REQUEST_LATENCY_BUCKETS))}
  UNION ALL SELECT '+Inf', cnt, total, cnt FROM h)""",
    "latency_violations": f"""WITH {FEEDBACK}
SELECT count_if(latency_ms > {FX.MAX_LATENCY_MS}) AS violations, count(*) AS requests FROM fbk""",
    "last_gauge": f"""WITH {FEEDBACK}
SELECT event_type, round(latency_ms, 6) AS last_value, strftime(ts, {TS}) AS last_ts FROM fbk
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "favorites_count": f"WITH {FEEDBACK} SELECT user_id, count(DISTINCT movie) AS favorites FROM pos GROUP BY user_id",
    "distinct_queries": f"WITH {FEEDBACK} SELECT count(DISTINCT query) AS distinct_queries FROM fbk",
    "drift_checkpoints": f"""WITH {FEEDBACK},{CHECKPOINTS}
SELECT rn, strftime(ts, {TS}) AS ts, event_id, query_length_mean, query_length_variance, success_rate,
       not_found_rate, unique_queries, positive_count FROM cp""",
    "active_requests": f"""WITH {FEEDBACK},
ev2 AS (SELECT ts AS t, 1 AS d, 1 AS kind, event_id FROM fbk UNION ALL
        SELECT ts + to_microseconds(round(latency_ms * 1000)::BIGINT), -1, 0, event_id FROM fbk),
c AS (SELECT t, sum(d) OVER (ORDER BY t, kind, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a FROM ev2)
SELECT max(a) AS max_active, strftime(arg_min(t, {{'na': -a, 't': t}}), {TS}) AS first_peak_at FROM c""",
    "session_activity": f"""WITH {FEEDBACK},
g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                      OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                     THEN 1 ELSE 0 END AS new_s FROM fbk),
h AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g)
SELECT user_id, strftime(min(ts), {TS}) AS session_start,
       strftime(max(ts) + INTERVAL 30 MINUTE, {TS}) AS session_end,
       count(*) AS requests, count_if(status = 'success') AS successes
FROM h GROUP BY user_id, sid""",
    "detect_drift": f"""{CAT},{FEEDBACK},{FSTATS},
x AS (
  SELECT fs2.*, abs(query_length_mean - base_mean) / base_mean AS md,
         abs(query_length_variance - base_var) / greatest(base_var, 1.0) AS vdr FROM fs2, bl),
y AS (
  SELECT *, list_filter([
      CASE WHEN md > {FX.DRIFT_THRESHOLD_MEAN} THEN 'Query length mean drifted ' || {pct('md')} END,
      CASE WHEN vdr > {FX.DRIFT_THRESHOLD_VARIANCE} THEN 'Query length variance drifted ' || {pct('vdr')} END,
      CASE WHEN success_rate < {FX.LOW_SUCCESS_RATE} THEN 'Low success rate: ' || {pct('success_rate')} END,
      CASE WHEN total_queries > {FX.POSITIVE_RATE_MIN_TOTAL} AND positive_rate < {FX.LOW_POSITIVE_RATE}
           THEN 'Low positive feedback rate: ' || {pct('positive_rate')} END], lambda s: s IS NOT NULL) AS sig
  FROM x)
SELECT sufficient_data AND len(sig) > 0 AS drift_detected,
       CASE WHEN NOT sufficient_data THEN 'insufficient_data' ELSE 'evaluated' END AS reason,
       CASE WHEN sufficient_data THEN round(md, 4) END AS mean_drift,
       CASE WHEN sufficient_data THEN round(vdr, 4) END AS variance_drift,
       CASE WHEN sufficient_data THEN len(sig) ELSE 0 END AS signal_count,
       CASE WHEN sufficient_data THEN array_to_string(sig, '; ') ELSE '' END AS signals,
       CASE WHEN sufficient_data AND len(sig) > 0 THEN 'RETRAIN' ELSE 'NO_ACTION' END AS recommendation
FROM y""",
    "drift_scores": f"""{CAT},{FEEDBACK},{FSTATS},
x AS (SELECT fs2.*, abs(query_length_mean - base_mean) / base_mean AS md,
             abs(query_length_variance - base_var) / greatest(base_var, 1.0) AS vdr FROM fs2, bl)
SELECT feature, score FROM (
  SELECT 'query_length_mean' AS feature, round(md, 4) AS score FROM x UNION ALL
  SELECT 'query_length_variance', round(vdr, 4) FROM x UNION ALL
  SELECT 'success_rate', CASE WHEN success_rate < {FX.LOW_SUCCESS_RATE} THEN round(1 - success_rate, 4) END FROM x
  UNION ALL
  SELECT 'positive_rate', CASE WHEN total_queries > {FX.POSITIVE_RATE_MIN_TOTAL} AND positive_rate < {FX.LOW_POSITIVE_RATE}
                               THEN round(1 - positive_rate, 4) END FROM x)
WHERE score IS NOT NULL""",
    "checkpoint_drift": f"""{CAT},{FEEDBACK},{FSTATS},{CHECKPOINTS},{VERDICTS}
SELECT rn, strftime(ts, {TS}) AS ts, mean_drift, variance_drift, round(success_rate, 6) AS success_rate,
       positive_rate, drift_detected FROM vd2""",
    "retrain_requests": f"""{CAT},{FEEDBACK},{FSTATS},{CHECKPOINTS},{VERDICTS}
SELECT 'retrain_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || rn::VARCHAR AS request_id,
       'auto_drift_' || rn || '_requests' AS reason, 'drift_detection' AS triggered_by, strftime(ts, {TS}) AS ts, rn
FROM vd2 WHERE drift_detected""",
    "quality_gate": f"""WITH {REGISTRY}
SELECT version, genre_match_rate,
       CASE WHEN genre_match_rate >= {FX.MIN_GENRE_MATCH} THEN 'promote' ELSE 'rollback' END AS decision FROM reg""",
    "stage_transition": f"""WITH {REGISTRY},
r AS (SELECT *, genre_match_rate >= {FX.MIN_GENRE_MATCH} AS p FROM reg)
SELECT version, strftime(registered_at, {TS}) AS registered_at, genre_match_rate,
       CASE WHEN NOT p THEN 'Staging'
            WHEN count_if(p) OVER (ORDER BY registered_at, version ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) > 0
            THEN 'Archived' ELSE 'Production' END AS stage,
       CASE WHEN p THEN max(CASE WHEN p THEN version END) OVER
            (ORDER BY registered_at, version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS replaced_version
FROM r""",
    "registry_describe": f"""WITH {REGISTRY}
SELECT version, printf('Content model, genre match rate %.4f, %d items, vocabulary %d',
                       genre_match_rate, n_items, vocabulary_size) AS description,
       strftime(registered_at, '%Y-%m-%d') AS trained_on FROM reg""",
    "latest_pointer": f"""WITH {REGISTRY}
SELECT coalesce(arg_max(version, {{'t': registered_at, 'v': version}}), 'unknown') AS latest_version FROM reg""",
    "promote_version": f"""WITH {REGISTRY},
r AS (SELECT *, genre_match_rate >= {FX.MIN_GENRE_MATCH} AS p,
             arg_max(CASE WHEN genre_match_rate >= {FX.MIN_GENRE_MATCH} THEN version END,
                     CASE WHEN genre_match_rate >= {FX.MIN_GENRE_MATCH} THEN {{'t': registered_at, 'v': version}} END)
               OVER (ORDER BY registered_at, version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM reg)
SELECT version, round(genre_match_rate, 4) AS genre_match_rate,
       CASE WHEN p THEN 'promote' ELSE 'rollback' END AS decision,
       CASE WHEN p THEN version ELSE coalesce(prev, 'keep_current') END AS serving_version,
       CASE WHEN p AND prev IS NOT NULL THEN 'backup/' || prev END AS backup_location
FROM r""",
    "artifact_readiness": f"""WITH {REGISTRY},
d AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS artifact FROM events),
m AS (SELECT artifact FROM d WHERE artifact NOT IN (SELECT strftime(registered_at, '%Y-%m-%d') FROM reg))
SELECT count(*) = 0 AS ready, count(*) AS missing_count, coalesce(string_agg(artifact, ',' ORDER BY artifact), '') AS missing
FROM m""",
    "experiment_metrics": f"""WITH {REGISTRY}
SELECT version AS run_id, 'metric' AS kind, 'genre_match_rate' AS key, genre_match_rate::DOUBLE AS value FROM reg
UNION ALL SELECT version, 'param', 'n_items', n_items::DOUBLE FROM reg
UNION ALL SELECT version, 'param', 'vocabulary_size', vocabulary_size::DOUBLE FROM reg""",
    "enrich_metadata": """
WITH cand AS (SELECT p_name AS title, p_partkey AS cand_pos,
                     CASE WHEN p_size > 25 THEN '/p' || p_partkey::VARCHAR END AS poster_path,
                     p_retailprice / 200 AS vote_average, p_type AS overview FROM part),
best AS (SELECT * FROM cand WHERE poster_path IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY title ORDER BY cand_pos) = 1),
titles AS (SELECT title, bool_or(failed) AS failed FROM (
  SELECT p_name AS title, false AS failed FROM part UNION ALL SELECT s_name, s_acctbal < 0 FROM supplier) GROUP BY title),
j AS (SELECT t.title, t.failed, b.*, NOT t.failed AND b.title IS NOT NULL AS good
      FROM titles t LEFT JOIN best b ON t.title = b.title)
SELECT title, CASE WHEN good THEN 'https://image.tmdb.org/t/p/w500' || poster_path
                   ELSE 'https://via.placeholder.com/300x450?text=No+Image' END AS poster,
       CASE WHEN good THEN round(vote_average, 6) END AS rating,
       CASE WHEN good THEN overview ELSE 'No description available.' END AS overview,
       CASE WHEN failed THEN 'error' WHEN good THEN 'success' ELSE 'fallback' END AS outcome
FROM j""",
}


# ---------------------------------------------------------------------------
# similarity summaries, evaluation, embeddings
# ---------------------------------------------------------------------------

def _topk_ranked(k: int) -> str:
    return f"""{O.pairs_cte()},
ranked AS (
  SELECT id, other_id, score,
         row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other_id) AS rank
  FROM pairs WHERE score > 0 QUALIFY rank <= {k})"""


def _gmr(sample: int | None) -> str:
    samp = "" if sample is None else f"QUALIFY row_number() OVER (ORDER BY md5('0|' || movie_id::VARCHAR), movie_id) <= {sample}"
    return f"""{TFIDF},{_topk_ranked(FX.EVAL_NEIGHBOURS)},
s AS (SELECT movie_id, genres FROM cat {samp}),
per AS (SELECT s.movie_id, count_if(coalesce(len(list_intersect(s.genres, c2.genres)) > 0, false)) AS hits
        FROM s LEFT JOIN ranked r ON r.id = s.movie_id LEFT JOIN cat c2 ON c2.movie_id = r.other_id
        WHERE len(s.genres) > 0 GROUP BY s.movie_id)
SELECT coalesce({rr('sum(hits)', f'count(*) * {FX.EVAL_NEIGHBOURS}')}, 0.0) AS genre_match_rate,
       count(*) AS evaluated FROM per"""


EMB = """
ex AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS term_idx
       FROM embeddings),
en AS (SELECT id, term_idx, x, sqrt(sum(x * x) OVER (PARTITION BY id)) AS nrm FROM ex),
nv AS (SELECT id, term_idx, x / nrm AS w FROM en WHERE nrm > 0 AND x <> 0)"""

ORACLE.update({
    "similarity_summary": f"""{TFIDF},{O.pairs_cte()},
cs AS (SELECT sum(w) AS s FROM nv GROUP BY term_idx)
SELECT round((SELECT sum(s * s) FROM cs) / ((SELECT n FROM nd) * (SELECT n FROM nd)), 6) AS mean_similarity,
       round((SELECT max(score) FROM pairs WHERE score > 0 AND score < 1 - 1e-9), 6) AS max_below_one""",
    "similarity_footprint": f"""{TFIDF},{_topk_ranked(FX.TOP_K)},
c AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS n, (SELECT count(*) FROM ranked) AS nnz)
SELECT round(n * n * 8 / 1048576, 4) AS dense_mb,
       round((nnz * 8 + nnz * 4 + (n + 1) * 4) / 1048576, 4) AS sparse_mb,
       round((1 - ((nnz * 8 + nnz * 4 + (n + 1) * 4) / 1048576) / (n * n * 8 / 1048576)) * 100, 1) AS reduction_pct,
       nnz, round(nnz / (n * n) * 100, 4) AS density_pct FROM c""",
    "genre_match_rate": _gmr(FX.EVAL_SAMPLE),
    "genre_match_rate_all": _gmr(None),
    "embedding_topk": f"""WITH {EMB},{O.pairs_cte()},
ranked AS (SELECT id, other_id, score,
                  row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other_id) AS rank
           FROM pairs WHERE score > 0)
SELECT id, rank, other_id, round(score, 6) AS score FROM ranked WHERE rank <= {FX.TOP_K}""",
    "model_version_info": f"""{TFIDF}
SELECT 'tfidf-cosine' AS model, (SELECT count(*) FROM vocab) AS vocabulary_size,
       (SELECT n FROM nd) AS matrix_rows, count(*) AS nnz FROM nv""",
})


# ---------------------------------------------------------------------------
# search
# ---------------------------------------------------------------------------

def lev(a: str, b: str) -> str:
    """Character-level Levenshtein (DuckDB's built-in counts bytes)."""
    sb = f"string_split({b}, '')"
    dp = (f"list_reduce(string_split({a}, ''), lambda prev, ca: list_reduce(range(1, len({sb}) + 1), "
          f"lambda row, j: list_append(row, least(prev[j + 1] + 1, row[len(row)] + 1, "
          f"prev[j] + CASE WHEN ca = {sb}[j] THEN 0 ELSE 1 END)), [prev[1] + 1]), "
          f"range(0, len({sb}) + 1))[len({sb}) + 1]")
    return f"(CASE WHEN {a} = '' THEN length({b}) WHEN {b} = '' THEN length({a}) ELSE {dp} END)"


def excess(a: str, b: str) -> str:
    """Characters of a (as a multiset) that b lacks: a lower bound on the
    edit distance."""
    cnt = lambda x: f"(length({x}) - length(replace({x}, c, '')))"
    return (f"list_sum(list_transform(list_distinct(string_split({a}, '')), "
            f"lambda c: greatest({cnt(a)} - {cnt(b)}, 0)))")


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(sql_str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) t({', '.join(cols)})"


def _alias_values() -> str:
    body = ", ".join(f"({sql_str(k)}, {O.sql_list(v)})" for k, v in FX.GENRE_SEARCH_MAP.items())
    return f"(VALUES {body}) am(q, terms)"


QUERY_NAMES = O.sql_list([*FX.GENRE_QUERIES, *FX.CHARACTER_TO_ACTOR])

ROUTE = f"""
qraw AS (SELECT lower(lang) AS query FROM documents UNION ALL SELECT source FROM documents
         UNION ALL SELECT p_name FROM part
         UNION ALL SELECT unnest({QUERY_NAMES})
         UNION ALL SELECT lower({O.heading('text')}) FROM documents),
q AS (SELECT DISTINCT query, lower(trim(query)) AS q, replace(replace(lower(trim(query)), ' ', ''), '-', '') AS sq
      FROM qraw WHERE trim(query) <> ''),
gv AS (SELECT unnest({O.sql_list(FX.GENRE_QUERIES)}) AS g),
cm AS (SELECT * FROM {_values(FX.CHARACTER_TO_ACTOR.items(), ['character', 'actor'])}),
hits AS (SELECT q.query, count(*) AS hits FROM q JOIN cat ON q.sq <> '' AND contains(cat.tags, q.sq)
         GROUP BY q.query),
stt AS (SELECT DISTINCT replace(replace(lower(title), ' ', ''), '-', '') AS sq FROM cat),
tl AS (SELECT DISTINCT lower(title) AS t FROM cat),
fzx AS (SELECT q.query, tl.t FROM q JOIN tl ON tl.t = q.q WHERE q.q <> ''),
-- pairs within the two bounds of the ratio: lengths, and characters shared as multisets
fzc AS (SELECT row_number() OVER () AS pair, * FROM (
          SELECT q.query, q.q, tl.t FROM q, tl
          WHERE q.query NOT IN (SELECT query FROM fzx) AND length(tl.t) > 0
            AND 2.0 * least(length(q.q), length(tl.t)) / (length(q.q) + length(tl.t)) >= {FX.FUZZY_CUTOFF}
            AND 2.0 * (length(tl.t) - {excess('tl.t', 'q.q')}) / (length(q.q) + length(tl.t)) >= {FX.FUZZY_CUTOFF})),
-- equal characters, in diagonal runs (i: in the title, j: in the query)
fzg AS (SELECT pair, d, min(i) AS s, max(i) + 1 AS e FROM (
          SELECT pair, i, i - j AS d, i - row_number() OVER (PARTITION BY pair, i - j ORDER BY i) AS run FROM (
            SELECT a.pair, a.i, b.j FROM (SELECT pair, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i FROM fzc) a
            JOIN (SELECT pair, unnest(string_split(q, '')) AS c, generate_subscripts(string_split(q, ''), 1) AS j FROM fzc) b ON a.pair = b.pair AND a.c = b.c))
        GROUP BY pair, d, run),
-- the longest run inside a range (first in the title, then in the query), then the ranges left and right of it
fzb AS (
  SELECT pair, 1 AS alo, length(t) + 1 AS ahi, 1 AS blo, length(q) + 1 AS bhi, 0 AS n FROM fzc
  UNION ALL
  SELECT pair, CASE side WHEN 0 THEN alo ELSE best.i - best.len END, CASE side WHEN 0 THEN best.i ELSE ahi END,
         CASE side WHEN 0 THEN blo ELSE best.j - best.len END, CASE side WHEN 0 THEN best.j ELSE bhi END, CASE side WHEN 0 THEN -best.len ELSE 0 END
  FROM (SELECT pair, alo, ahi, blo, bhi, min({{'len': -len, 'i': i, 'j': i - d}}) AS best FROM (
          SELECT b.*, g.d, greatest(g.s, b.alo, b.blo + g.d) AS i, least(g.e, b.ahi, b.bhi + g.d) - greatest(g.s, b.alo, b.blo + g.d) AS len
          FROM fzb b JOIN fzg g ON g.pair = b.pair) WHERE len > 0
        GROUP BY pair, alo, ahi, blo, bhi), (VALUES (0), (1)) sides(side)),
fz0 AS (SELECT c.query, c.t, 2.0 * m.n / (length(c.q) + length(c.t)) AS ratio
        FROM fzc c JOIN (SELECT pair, sum(n)::DOUBLE AS n FROM fzb GROUP BY pair) m USING (pair) UNION ALL SELECT query, t, 1.0 FROM fzx),
fz AS (SELECT query, t AS matched, ratio FROM fz0 WHERE ratio >= {FX.FUZZY_CUTOFF}
       QUALIFY row_number() OVER (PARTITION BY query ORDER BY ratio DESC, t DESC) = 1),
routed AS (
  SELECT q.query, q.q, q.sq,
         CASE WHEN q.q IN (SELECT g FROM gv) THEN 'genre'
              WHEN cm.actor IS NOT NULL THEN 'character'
              WHEN coalesce(h.hits, 0) >= {FX.PERSON_MIN_HITS} AND q.sq NOT IN (SELECT sq FROM stt) THEN 'person'
              WHEN fz.matched IS NOT NULL THEN 'title'
              WHEN q.sq <> '' THEN 'person_fallback' ELSE 'none' END AS route,
         coalesce(cm.actor, q.sq) AS person_key, fz.matched AS matched_title, fz.ratio
  FROM q LEFT JOIN cm ON cm.character = q.q LEFT JOIN hits h ON h.query = q.query
         LEFT JOIN fz ON fz.query = q.query)"""

LEVENSHTEIN = f"""
lvc AS (SELECT q.query, q.q, tl.t FROM q, tl
        WHERE q.query NOT IN (SELECT query FROM fzx) AND length(tl.t) > 0 AND least(length(q.q), length(tl.t)) >= {FX.FUZZY_CUTOFF} * greatest(length(q.q), length(tl.t))
          -- multiset bound: each edit removes at most one surplus character
          AND greatest({excess('q.q', 'tl.t')}, {excess('tl.t', 'q.q')})
              <= {1 - FX.FUZZY_CUTOFF} * greatest(length(q.q), length(tl.t)) + 1e-9),
lv0 AS (SELECT query, t, 1 - (CASE WHEN strlen(q) = length(q) AND strlen(t) = length(t) THEN levenshtein(q, t)
                                   ELSE {lev('q', 't')} END) / greatest(length(q), length(t)) AS ratio
        FROM lvc UNION ALL SELECT query, t, 1.0 FROM fzx),
lv AS (SELECT query, t AS matched, ratio FROM lv0 WHERE ratio >= {FX.FUZZY_CUTOFF} - 1e-12
       QUALIFY row_number() OVER (PARTITION BY query ORDER BY ratio DESC, t DESC) = 1)"""

GENRE = f"""
gq AS (SELECT query, q FROM routed WHERE route = 'genre'),
terms AS (
  SELECT query, tpos, replace(term, ' ', '') AS term FROM (
    SELECT gq.query, unnest(coalesce(am.terms, [gq.q])) AS term,
           generate_subscripts(coalesce(am.terms, [gq.q]), 1) AS tpos
    FROM gq LEFT JOIN {_alias_values()} ON am.q = gq.q)),
bg AS (SELECT DISTINCT t.query, c.movie_id AS id FROM terms t JOIN cat c
       ON t.term <> '' AND contains(lower(replace(array_to_string(c.genres, ''), ' ', '')), t.term)),
need AS (SELECT * FROM terms WHERE query NOT IN (SELECT query FROM bg) AND term <> ''),
fh AS (SELECT n.query, n.tpos, c.movie_id AS id FROM need n JOIN cat c ON contains(c.tags, n.term)),
bt AS (SELECT query, id FROM fh WHERE (query, tpos) IN (SELECT query, min(tpos) FROM fh GROUP BY query)),
gm AS (SELECT DISTINCT query, id FROM (SELECT * FROM bg UNION ALL SELECT * FROM bt)),
gres AS (
  SELECT gm.query, 'genre' AS route,
         row_number() OVER (PARTITION BY gm.query ORDER BY md5('0|' || gm.id::VARCHAR), gm.id) - 1 AS pos,
         c.title, NULL::DOUBLE AS score
  FROM gm JOIN cat c ON c.movie_id = gm.id QUALIFY pos < {FX.RESULT_LIMIT})"""

TITLE = f"""{_topk_ranked(FX.TOP_K)},
tq AS (SELECT query, matched_title FROM routed WHERE route = 'title'),
anc AS (SELECT lower(title) AS mt, arg_min(movie_id, movie_id) AS anchor, arg_min(title, movie_id) AS title
        FROM cat GROUP BY lower(title)),
tres AS (
  SELECT tq.query, 'title' AS route, 0 AS pos, anc.title, NULL::DOUBLE AS score
  FROM tq JOIN anc ON anc.mt = tq.matched_title
  UNION ALL
  SELECT tq.query, 'title', r.rank, c.title, round(r.score, 4)
  FROM tq JOIN anc ON anc.mt = tq.matched_title JOIN ranked r ON r.id = anc.anchor AND r.rank <= {FX.TITLE_NEIGHBOURS}
       JOIN cat c ON c.movie_id = r.other_id)"""

PERSON = f"""
pq AS (SELECT query, q, person_key, route FROM routed
       WHERE route IN ('person', 'character', 'person_fallback') AND person_key <> ''),
direct AS (SELECT pq.query, c.movie_id AS anchor FROM pq JOIN cat c ON contains(c.tags, pq.person_key)),
nod AS (SELECT * FROM pq WHERE query NOT IN (SELECT query FROM direct)),
wd AS (SELECT query, word, wpos FROM (
         SELECT query, unnest(string_split_regex(q, '{UWS}')) AS word,
                generate_subscripts(string_split_regex(q, '{UWS}'), 1) AS wpos FROM nod)
       WHERE length(word) >= {FX.PERSON_WORD_MIN_LEN}),
wh AS (SELECT wd.query, wd.wpos, c.movie_id AS anchor FROM wd JOIN cat c ON contains(c.tags, wd.word)),
bw AS (SELECT query, anchor FROM wh WHERE (query, wpos) IN (SELECT query, min(wpos) FROM wh GROUP BY query)),
anchors AS (SELECT * FROM direct UNION ALL SELECT * FROM bw),
qv AS (SELECT a.query, nv.term_idx, sum(nv.w) AS qw FROM anchors a JOIN nv ON nv.id = a.anchor GROUP BY ALL),
sc AS (SELECT qv.query, nv.id, sum(qv.qw * nv.w) AS score FROM qv JOIN nv USING (term_idx) GROUP BY ALL),
scp AS (SELECT sc.query, c.title, arg_max(sc.id, {{'r': round(sc.score, 9), 'i': -sc.id}}) AS id,
               max(sc.score) AS score
        FROM sc JOIN cat c ON c.movie_id = sc.id WHERE sc.score > 0 GROUP BY ALL),
fill AS (SELECT title, min(movie_id) AS id FROM cat GROUP BY title ORDER BY id LIMIT {2 * FX.RESULT_LIMIT - 1}),
pk AS (SELECT DISTINCT a.query, p.person_key FROM anchors a JOIN pq p USING (query)),
uu AS (SELECT * FROM scp UNION ALL SELECT pk.query, fill.title, fill.id, 0.0 FROM pk, fill),
best AS (SELECT * FROM uu QUALIFY row_number() OVER (PARTITION BY query, title ORDER BY round(score, 9) DESC, id) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM best
        QUALIFY rank <= {FX.RESULT_LIMIT}),
hitq AS (SELECT top.*, contains(c.tags, pk.person_key) AS hit FROM top JOIN cat c ON c.movie_id = top.id
         JOIN pk USING (query)),
pres AS (SELECT h.query, p.route,
                row_number() OVER (PARTITION BY h.query ORDER BY h.hit DESC,
                                   CASE WHEN h.hit THEN -h.rank ELSE h.rank END) - 1 AS pos,
                h.title, round(h.score, 4) AS score
         FROM hitq h JOIN pq p USING (query))"""

SEARCH = f"{TFIDF},{ROUTE}"
ALLRES = f"{SEARCH},{GENRE},{TITLE},{PERSON},\nres AS (SELECT * FROM gres UNION ALL SELECT * FROM tres UNION ALL SELECT * FROM pres)"

ORACLE.update({
    "route_query": f"{CAT},{ROUTE} SELECT query, route, person_key, CASE WHEN route = 'title' THEN matched_title END AS matched_title FROM routed",
    "blank_query_guard": """
SELECT event_id, query, trim(coalesce(query, '')) <> '' AS accepted,
       CASE WHEN trim(coalesce(query, '')) <> '' THEN 'accepted' ELSE 'error' END AS status
FROM (SELECT event_id, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '  '
                            WHEN event_type <> 'error' THEN event_type || ' ' || props END AS query FROM events)""",
    "query_item_contains": f"""{CAT},{ROUTE}
SELECT q.query, c.movie_id FROM q JOIN cat c ON q.sq <> '' AND contains(c.tags, q.sq)""",
    "fuzzy_title_levenshtein": f"{CAT},{ROUTE},{LEVENSHTEIN} SELECT query, matched, round(ratio, 6) AS ratio FROM lv",
    "fuzzy_title_ratio": f"""{CAT},{ROUTE}
SELECT fz.query, matched, round(ratio, 6) AS ratio, coalesce(n, 0)::BIGINT AS candidates
FROM fz LEFT JOIN (SELECT query, count(*) AS n FROM fzc GROUP BY query) USING (query)""",
    "search_by_genre": f"{CAT},{ROUTE},{GENRE} SELECT query, route, pos, title, score FROM gres",
    "title_recommend": f"{SEARCH},{TITLE} SELECT query, route, pos, title, score FROM tres",
    "search_by_person": f"{SEARCH},{PERSON} SELECT query, route, pos, title, score FROM pres",
    "recommend_batch": f"""{ALLRES}
SELECT query, route, count(*) AS recommendations_count,
       round(coalesce(arg_min(score, pos) FILTER (WHERE score IS NOT NULL AND route = 'title'), 0.0), 4) AS top_similarity_score,
       round(coalesce(avg(score) FILTER (WHERE route = 'title'), 0.0), 4) AS avg_similarity_score
FROM res GROUP BY query, route""",
    "recommend_outcome": f"""{ALLRES},
f AS (SELECT query, title AS matched_title FROM res WHERE pos = 0),
n AS (SELECT query, count(*) AS c FROM res GROUP BY query)
SELECT q.query, CASE WHEN trim(coalesce(q.query, '')) = '' THEN 'error'
                     WHEN f.matched_title IS NULL THEN 'not_found' ELSE 'success' END AS status,
       f.matched_title, coalesce(n.c, 0) AS recommendations_count
FROM (SELECT DISTINCT query FROM qraw) q LEFT JOIN f USING (query) LEFT JOIN n USING (query)""",
    "sort_recommendations": f"""{SEARCH},{TITLE},
rating AS (SELECT c.title, max(l.quality * 10.0 / 3) AS rating FROM cat c LEFT JOIN labels l ON l.doc_id = c.movie_id
           GROUP BY c.title),
x AS (SELECT tres.*, CASE WHEN rating.rating > 0 THEN rating.rating END AS rated,
             CASE WHEN lower(trim(title)) = lower(trim(query)) THEN 0 WHEN rating.rating > 0 THEN 1 ELSE 2 END AS bucket
      FROM tres LEFT JOIN rating USING (title))
SELECT query, title,
       row_number() OVER (PARTITION BY query ORDER BY bucket, CASE WHEN bucket = 1 THEN rated END DESC NULLS LAST, pos) - 1 AS display_pos,
       coalesce(printf('%.1f', round(rated, 1)), 'N/A') AS rating_label
FROM x""",
})


# ---------------------------------------------------------------------------
# alerts
# ---------------------------------------------------------------------------

LOG_RULES = [r for r in FX.ALERT_RULES if r[1].startswith(("ratio_5xx", "ratio_error", "ratio_not_found", "ratio_success", "pct_",
                                                           "rate_success", "rate_requests", "increase_", "p95_"))]
HOST_RULES = [r for r in FX.ALERT_RULES if r[1].endswith("_used_pct") or r[1] == "rate_rx_bytes"]
RULE_SIZES = sorted({r[2] for r in LOG_RULES})
B = FX.REQUEST_LATENCY_BUCKETS


def _counts(w: int) -> str:
    """Counts of the ``w`` seconds before the end of each minute, by a window
    over one row per minute."""
    names = ["total", "n_error", "n_not_found", "n_success", "n_violations", *(f"b{i}" for i in range(len(B)))]
    sums = ", ".join(f"CAST(sum({c}) OVER sl AS BIGINT) AS {c}" for c in names)
    return f"""
  SELECT {w} AS window_seconds, make_timestamp((k + 1) * 60000000) AS evaluated_at, {sums} FROM minutes
  WINDOW sl AS (ORDER BY k ROWS BETWEEN {w // 60 - 1} PRECEDING AND CURRENT ROW)"""


def _minutes() -> str:
    bucket_cols = ", ".join(f"count(*) FILTER (WHERE latency_ms / 1000.0 <= {b}) AS b{i}" for i, b in enumerate(B))
    return f"""
  SELECT s.k, count(f.ts) AS total, count(*) FILTER (WHERE status = 'error') AS n_error, count(*) FILTER (WHERE status = 'not_found') AS n_not_found,
         count(*) FILTER (WHERE status = 'success') AS n_success, count(*) FILTER (WHERE latency_ms > {FX.MAX_LATENCY_MS}) AS n_violations, {bucket_cols}
  FROM (SELECT unnest(range(epoch_us(min(ts)) // 60000000, epoch_us(max(ts)) // 60000000 + 1)) AS k FROM fbk) s
  LEFT JOIN fbk f ON epoch_us(f.ts) // 60000000 = s.k GROUP BY s.k"""


def _p95() -> str:
    expr = f"{B[-1] * 1000.0}"
    for i in reversed(range(len(B))):
        lo = 0.0 if i == 0 else B[i - 1]
        prev = "0" if i == 0 else f"b{i - 1}"
        inside = f"({lo} + ({B[i]} - {lo}) * (0.95 * total - {prev}) / (b{i} - {prev})) * 1000.0"
        expr = f"CASE WHEN b{i} >= 0.95 * total THEN {inside} ELSE {expr} END"
    return f"CASE WHEN total > 0 THEN {expr} END"


def _rules_values(rules, alias: str = "rules") -> str:
    nul = lambda x: "NULL" if x is None else sql_str(x)
    return "(VALUES " + ", ".join(
        f"({sql_str(r[0])}, {sql_str(r[1])}, {r[2]}, {sql_str(r[3])}, {float(r[4])}, {r[5]}, {sql_str(r[6])}, {nul(r[7])}, {nul(r[8])})"
        for r in rules) + f") {alias}(rule, signal, window_seconds, op, threshold, for_seconds, severity, team, reason)"


CONDITION = """coalesce(CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold
                             WHEN '==' THEN value = threshold ELSE false END, false)"""


def _runs(src: str, out: str, *by: str) -> str:
    """A run ends at a false step or a missing one; it fires once its steps span ``for``."""
    keys = ", ".join(["rule", "severity", "for_seconds", *by])
    return f"""
{out}_p AS (SELECT *, lag(evaluated_at) OVER (PARTITION BY {keys} ORDER BY evaluated_at) AS prev,
                   lag(condition) OVER (PARTITION BY {keys} ORDER BY evaluated_at) AS prevc FROM {src}),
{out}_r AS (SELECT *, sum(CASE WHEN prevc AND evaluated_at - prev = INTERVAL 1 MINUTE THEN 0 ELSE 1 END)
                      OVER (PARTITION BY {keys} ORDER BY evaluated_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
            FROM {out}_p WHERE condition),
{out} AS (SELECT {keys}, min(evaluated_at) AS started_at, count(*) AS steps FROM {out}_r GROUP BY {keys}, run
          HAVING epoch_us(max(evaluated_at)) - epoch_us(min(evaluated_at)) >= for_seconds::BIGINT * 1000000)"""


ALERTS = f"""
minutes AS ({_minutes()}),
wcnt AS ({' UNION ALL '.join(_counts(w) for w in RULE_SIZES)}),
ev0 AS (
  SELECT rule, severity, for_seconds, evaluated_at, op, threshold,
         CASE signal WHEN 'ratio_5xx' THEN CASE WHEN total > 0 THEN n_error / total END
                     WHEN 'ratio_error' THEN CASE WHEN total > 0 THEN n_error / total END
                     WHEN 'ratio_not_found' THEN CASE WHEN total > 0 THEN n_not_found / total END
                     WHEN 'ratio_success' THEN CASE WHEN total > 0 THEN n_success / total END
                     WHEN 'pct_4xx_5xx' THEN CASE WHEN total > 0 THEN (n_error + n_not_found) / total * 100 END
                     WHEN 'rate_success' THEN n_success / window_seconds
                     WHEN 'rate_requests' THEN total / window_seconds
                     WHEN 'increase_violations' THEN n_violations::DOUBLE
                     WHEN 'p95_latency_ms' THEN {_p95()} END AS value
  FROM wcnt JOIN {_rules_values(LOG_RULES)} USING (window_seconds)),
evr AS (SELECT *, {CONDITION} AS condition FROM ev0),{_runs('evr', 'fired')}"""

HOST = f"""
smp AS (SELECT user_id % 3 AS instance, epoch_us(ts) // 60000000 AS k, least(value * 2, 100.0) AS cpu_used_pct,
               least(value * 3, 100.0) AS memory_used_pct, least(value * 4, 100.0) AS disk_used_pct, value * 5e6 AS rate_rx_bytes FROM events),
lng AS (UNPIVOT smp ON cpu_used_pct, memory_used_pct, disk_used_pct, rate_rx_bytes INTO NAME signal VALUE v),
hst AS (
  SELECT rule, severity, for_seconds, instance, make_timestamp((k + o + 1) * 60000000) AS evaluated_at, op, threshold, sum(v) / count(v) AS value
  FROM lng JOIN {_rules_values(HOST_RULES)} USING (signal), (SELECT unnest(range(0, 60)) AS o)
  WHERE o < greatest(window_seconds, 60) // 60 GROUP BY ALL),
hev AS (SELECT *, {CONDITION} AS condition FROM hst),{_runs('hev', 'hfired', 'instance')}"""

ALERT_BASE = f"WITH {FEEDBACK},{ALERTS}"


def _rules_sql(rules) -> str:
    names = ", ".join(sql_str(r) for r in rules)
    return f"""{ALERT_BASE}
SELECT rule, severity, strftime(evaluated_at, {TS}) AS evaluated_at, round(value, 6) AS value, condition
FROM evr WHERE rule IN ({names})"""


def _rate(slide: bool) -> str:
    if not slide:
        win = "SELECT epoch_us(ts) // 3600000000 * 3600000000 AS ws, status FROM fbk"
    else:
        win = ("SELECT (epoch_us(ts) // 900000000 - k) * 900000000 AS ws, status "
               "FROM fbk, (SELECT unnest(range(0, 4)) AS k)")
    return f"""WITH {FEEDBACK}
SELECT strftime(make_timestamp(ws), {TS}) AS window_start, status, count(*) AS n, round(count(*) / 3600.0, 6) AS rate
FROM ({win}) GROUP BY ws, status"""


ORACLE.update({
    "rate_tumbling": _rate(False),
    "rate_sliding": _rate(True),
    "ratio_alert": _rules_sql(["HighErrorRate", "HighRecommendationFailureRate", "HighNotFoundRate",
                               "RecommendationQualityDrop", "ModelRetrainingRequired",
                               "ErrorRateExceeds5Percent"]),
    "increase_alert": _rules_sql(["TooManyLatencyViolations"]),
    "quantile_alert": _rules_sql(["InferenceP95LatencyHigh"]),
    "absence_alert": _rules_sql(["NoRecommendationsServed", "ZeroThroughput"]),
    "alert_for_duration": f"""{ALERT_BASE}
SELECT rule, severity, strftime(started_at, {TS}) AS started_at,
       strftime(started_at + to_seconds(for_seconds), {TS}) AS fired_at, steps FROM fired""",
    "host_threshold_alert": f"""WITH {HOST}
SELECT rule, severity, instance, strftime(started_at, {TS}) AS started_at,
       strftime(started_at + to_seconds(for_seconds), {TS}) AS fired_at, steps FROM hfired""",
    "alert_labels": f"""{ALERT_BASE},{HOST}
SELECT f.rule, r.severity, r.team, r.reason, r.signal, count(*) AS firings
FROM (SELECT rule FROM fired UNION ALL SELECT rule FROM hfired) f JOIN {_rules_values(FX.ALERT_RULES, 'r')} ON r.rule = f.rule
GROUP BY ALL""",
    "gauge_alert": " UNION ALL ".join(f"""SELECT * FROM (WITH {FEEDBACK},
g AS (SELECT ts, event_id, latency_ms > {r[4]} AS c FROM fbk),
g2 AS (SELECT *, CASE WHEN c <> lag(c) OVER (ORDER BY ts, event_id) THEN 1 ELSE 0 END AS chg FROM g),
h AS (SELECT *, sum(chg) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM g2)
SELECT '{r[0]}' AS rule, strftime(min(ts), {TS}) AS started_at, strftime(max(ts), {TS}) AS ended_at, count(*) AS samples
FROM h WHERE c GROUP BY run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= {r[5] * 1000000})"""
                                      for r in FX.ALERT_RULES if r[1] == "last_latency_ms"),
    "up_alert": f"""WITH {FEEDBACK},
g AS (SELECT ts, lag(ts) OVER (ORDER BY ts, event_id) AS prev FROM fbk)
SELECT strftime(prev, {TS}) AS down_from, strftime(ts, {TS}) AS up_again,
       round((epoch_us(ts) - epoch_us(prev)) / 1e6, 6) AS gap_seconds
FROM g WHERE epoch_us(ts) - epoch_us(prev) > 900000000""",
    "model_not_ready_alert": f"""WITH {FEEDBACK},
w AS (SELECT DISTINCT epoch_us(ts) // 600000000 AS k FROM fbk),
s AS (SELECT DISTINCT epoch_us(ts) // 600000000 AS k FROM fbk WHERE status = 'success')
SELECT strftime(make_timestamp(k * 600000000), {TS}) AS window_start FROM w WHERE k NOT IN (SELECT k FROM s)""",
})


# ---------------------------------------------------------------------------
# stream twins: closed windows only (end <= max event time - watermark)
# ---------------------------------------------------------------------------

WM = "(SELECT max(ts) FROM fbk) - INTERVAL 10 MINUTE"

ORACLE.update({
    "stream_feedback_ingest": f"""WITH {FEEDBACK}
SELECT event_id, strftime(ts, {TS}) AS ts, user_id, query, status, round(latency_ms, 6) AS latency_ms FROM fbk""",
    "stream_feedback_stats": f"""WITH {FEEDBACK},
w AS (SELECT make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS ws, * FROM fbk)
SELECT strftime(ws, {TS}) AS window_start, strftime(ws + INTERVAL 1 HOUR, {TS}) AS window_end,
       count(*) AS total_queries, round(avg({wc('query')}), 6) AS query_length_mean,
       round(var_pop({wc('query')}), 6) AS query_length_variance, round(avg(latency_ms), 6) AS avg_latency_ms,
       count_if(status = 'success') AS successes, count_if(status = 'not_found') AS not_found
FROM w GROUP BY ws HAVING ws + INTERVAL 1 HOUR <= {WM}""",
    "stream_positive_dedup": f"WITH {FEEDBACK} SELECT DISTINCT user_id, movie FROM pos",
    "stream_session_activity": f"""WITH {FEEDBACK},
g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                      OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                     THEN 1 ELSE 0 END AS new_s FROM fbk),
h AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g),
s AS (SELECT user_id, min(ts) AS st, max(ts) + INTERVAL 30 MINUTE AS en, count(*) AS requests,
             count_if(status = 'success') AS successes FROM h GROUP BY user_id, sid)
SELECT user_id, strftime(st, {TS}) AS session_start, strftime(en, {TS}) AS session_end, requests, successes
FROM s WHERE en <= {WM}""",
    "stream_alert_for_duration": f"""{ALERT_BASE},
closed AS (SELECT max(k) AS k FROM (SELECT epoch_us(ts) // 60000000 + 1 AS k FROM fbk) WHERE make_timestamp(k * 60000000) <= {WM})
SELECT rule, severity, strftime(started_at, {TS}) AS started_at, strftime(started_at + to_seconds(for_seconds), {TS}) AS fired_at
FROM fired, closed WHERE started_at + to_seconds(for_seconds) <= make_timestamp(closed.k * 60000000)""",
    "stream_up_alert": f"""WITH {FEEDBACK},
t AS (SELECT 'APIDown' AS rule, ts, event_id FROM events UNION ALL SELECT 'PrometheusDown', ts, event_id FROM events WHERE user_id % 3 = 0),
g AS (SELECT rule, ts, lead(ts) OVER (PARTITION BY rule ORDER BY ts, event_id) AS nxt FROM t)
SELECT rule, 'critical' AS severity, strftime(ts, {TS}) AS down_from, strftime(ts + INTERVAL 15 MINUTE, {TS}) AS fired_at FROM g
WHERE (nxt IS NULL OR nxt > ts + INTERVAL 15 MINUTE)
  AND make_timestamp((epoch_us(ts + INTERVAL 15 MINUTE) // 60000000 + 1) * 60000000) <= {WM}""",
    "stream_drift": f"""{CAT},{FEEDBACK},{FSTATS},{SUCCESS_CHECKPOINTS},{VERDICTS}
SELECT rn, strftime(ts, {TS}) AS ts, mean_drift, variance_drift, round(success_rate, 6) AS success_rate,
       positive_rate, drift_detected, CASE WHEN drift_detected THEN 'auto_drift_' || rn || '_requests' END AS retrain_reason FROM vd2""",
    "stream_alert_counts": f"""WITH {FEEDBACK},
w AS (SELECT make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS ws, status FROM fbk)
SELECT strftime(ws, {TS}) AS window_start, status, count(*) AS n FROM w
GROUP BY ws, status HAVING ws + INTERVAL 1 HOUR <= {WM}""",
})


ORACLE.update({
    "sink_feature_store": f"""{CAT}
SELECT (SELECT 'v_' || strftime(max(ts), '%Y%m%d_%H%M%S') FROM events) AS version, movie_id, title, tags FROM cat""",
    "sink_validation_report": f"WITH {_quality_part()} SELECT * FROM iss",
    "feedback_append": f"""WITH {FEEDBACK}
SELECT strftime(ts, {TS}) AS timestamp, query, NULL::VARCHAR AS matched_title, 0 AS recommendations_count,
       round(latency_ms, 6) AS latency_ms, status FROM fbk""",
    "positive_append": f"""WITH {FEEDBACK}
SELECT strftime(ts, {TS}) AS timestamp, movie, 'favorites' AS source FROM pos""",
    "alias_lookup": f"""{CAT},{ROUTE}
SELECT q.query, array_to_string(coalesce(am.terms, [q.q]), '|') AS terms
FROM q LEFT JOIN {_alias_values()} ON am.q = q.q""",
    "character_lookup": f"""{CAT},{ROUTE}
SELECT q.query, coalesce(cm.actor, replace(q.q, ' ', '')) AS person_key FROM q LEFT JOIN cm ON cm.character = q.q""",
    "avg_by_instance": f"WITH {FEEDBACK} SELECT user_id AS instance, round(avg(latency_ms), 6) AS avg_latency_ms FROM fbk GROUP BY 1",
    "latest_baseline": f"""WITH {REGISTRY}
SELECT version, 'feature_store/' || version || '/baseline' AS path FROM reg ORDER BY version DESC LIMIT 1""",
    "run_summary": f"""WITH {REGISTRY}
SELECT version, genre_match_rate,
       CASE WHEN genre_match_rate >= {FX.MIN_GENRE_MATCH} THEN 'promote' ELSE 'rollback' END AS decision
FROM reg ORDER BY registered_at DESC, version DESC LIMIT 1""",
})
ORACLE["poster_url_valid"] = """
WITH cand AS (SELECT p_name AS title, p_partkey AS cand_pos,
                     CASE WHEN p_size > 25 THEN '/p' || p_partkey::VARCHAR END AS poster_path FROM part),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY title ORDER BY poster_path IS NULL, cand_pos) = 1),
titles AS (SELECT p_name AS title FROM part UNION SELECT s_name FROM supplier),
e AS (SELECT t.title, CASE WHEN poster_path IS NOT NULL THEN 'https://image.example/w500' || poster_path END AS poster
      FROM titles t LEFT JOIN best b ON t.title = b.title)
SELECT title, coalesce(poster IS NOT NULL AND starts_with(poster, 'http') AND NOT contains(poster, 'placeholder')
                       AND NOT contains(poster, 'None') AND NOT contains(poster, 'null'), false) AS valid FROM e"""


# ---------------------------------------------------------------------------
# feature ablation: every variant through the same TF-IDF / top-5 / sample
# ---------------------------------------------------------------------------

def _variant_tags() -> str:
    parts = {"overview": f"[{clean_text('overview')}]", "genres": "genres || genres", "keywords": "keywords",
             "cast": '"cast" || "cast"', "director": "crew || crew || crew"}
    rows = []
    for v in ["full"] + FX.ABLATION_FEATURES:
        keep = [p for f, p in parts.items() if f != v]
        rows.append(f"SELECT '{v}' AS variant, movie_id, genres, array_to_string({' || '.join(keep)}, ' ') AS tags FROM cat0")
    return " UNION ALL ".join(rows)


ABLATION = f"""WITH {O.catalog_cte()},
var AS ({_variant_tags()}),
tk AS (SELECT variant, movie_id AS id, {O.tokens('tags')} AS t FROM var),
tok AS (SELECT variant, id, unnest({O.uni_bi('t')}) AS term FROM tk),
tf AS (SELECT variant, id, term, count(*) AS tf FROM tok GROUP BY ALL),
nd AS (SELECT variant, count(*) AS n FROM var GROUP BY variant),
st AS (SELECT variant, term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY ALL),
vocab AS (SELECT st.variant, term, df, n,
                 row_number() OVER (PARTITION BY st.variant ORDER BY cf DESC, term) - 1 AS term_idx
          FROM st JOIN nd USING (variant) WHERE df >= {FX.MIN_DF} AND df <= {FX.MAX_DF} * n
          QUALIFY term_idx < {FX.MAX_FEATURES}),
wt AS (SELECT tf.variant, tf.id, v.term_idx, (1 + ln(tf.tf)) * (ln((1 + v.n)::DOUBLE / (1 + v.df)) + 1) AS w
       FROM tf JOIN vocab v USING (variant, term)),
nv AS (SELECT variant, id, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY variant, id)) AS w FROM wt),
pairs AS (SELECT a.variant, a.id, b.id AS other_id, sum(a.w * b.w) AS score
          FROM nv a JOIN nv b ON a.variant = b.variant AND a.term_idx = b.term_idx AND a.id <> b.id GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY variant, id ORDER BY round(score, 9) DESC, other_id) AS rank
           FROM pairs WHERE score > 0 QUALIFY rank <= {FX.EVAL_NEIGHBOURS}),
s AS (SELECT variant, movie_id, genres FROM var
      QUALIFY row_number() OVER (PARTITION BY variant ORDER BY md5('0|' || movie_id::VARCHAR), movie_id) <= {FX.ABLATION_SAMPLE}),
per AS (SELECT s.variant, s.movie_id,
               count_if(coalesce(len(list_intersect(s.genres, c2.genres)) > 0, false)) AS hits
        FROM s LEFT JOIN ranked r ON r.variant = s.variant AND r.id = s.movie_id
               LEFT JOIN cat0 c2 ON c2.movie_id = r.other_id
        WHERE len(s.genres) > 0 GROUP BY ALL),
rates AS (SELECT v.variant, coalesce({rr('sum(hits)', f'count(per.movie_id) * {FX.EVAL_NEIGHBOURS}')}, 0.0) AS rate
          FROM (SELECT DISTINCT variant FROM var) v LEFT JOIN per USING (variant) GROUP BY v.variant),
imp AS (SELECT r.variant AS feature, r.rate AS score_without, b.rate AS score_with,
               round(b.rate - r.rate, 4) AS impact_drop,
               CASE WHEN b.rate > 0 THEN round(round(b.rate - r.rate, 4) / b.rate * 100, 2) ELSE 0.0 END AS impact_pct
        FROM rates r, (SELECT rate FROM rates WHERE variant = 'full') b WHERE r.variant <> 'full'),
impr AS (SELECT *, row_number() OVER (ORDER BY impact_drop DESC, feature) AS impact_rank FROM imp)"""

ORACLE.update({
    "feature_impact": f"{ABLATION} SELECT * FROM impr",
    "most_important_feature": f"{ABLATION} SELECT feature AS most_important_feature, impact_drop FROM impr WHERE impact_rank = 1",
})

ORACLE["sink_drift_report"] = ORACLE["detect_drift"]

ORACLE["scan_feedback"] = f"""WITH {FEEDBACK}
SELECT strftime(ts, {TS}) AS timestamp, query, status, round(latency_ms, 6) AS latency_ms FROM fbk
UNION ALL SELECT strftime(ts, {TS}), movie, 'positive', NULL FROM pos"""

ORACLE["sink_model_artifacts"] = f"""{TFIDF},{_topk_ranked(FX.TOP_K)}
SELECT 'vocabulary' AS artifact, (SELECT count(*) FROM vocab) AS rows
UNION ALL SELECT 'neighbours', (SELECT count(*) FROM ranked)
UNION ALL SELECT 'catalog', (SELECT count(*) FROM cat)"""
ORACLE["genre_filter"] = f"{CAT},{ROUTE},{GENRE} SELECT DISTINCT query, id AS movie_id FROM bg"


MV = """
mv AS (SELECT l_orderkey * 10 + l_linenumber AS id, s_name AS title, l_quantity AS vote_average
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
cr AS (SELECT s_suppkey AS movie_id, s_name AS title, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS balance FROM supplier)"""


def _missing_sql(src: str, name: str, cols) -> str:
    return " UNION ALL ".join(f"""SELECT 'missing', '{name}', '{c}', count_if({c} IS NULL)::DOUBLE,
  CASE WHEN round(count_if({c} IS NULL) / count(*), 4) > {FX.MISSING_HIGH_RATE} THEN 'high' WHEN count_if({c} IS NULL) > 0 THEN 'some' ELSE 'none' END
FROM {src}""" for c in cols)


def _checks_sql(src: str, name: str) -> str:
    return f"""SELECT 'quality', '{name}', 'min_rows', count(*)::DOUBLE,
  CASE WHEN count(*) < {FX.MIN_ROWS} THEN printf('Too few rows: %d < %d', count(*), {FX.MIN_ROWS}) END FROM {src}
UNION ALL SELECT 'quality', '{name}', 'duplicates:title', (count(*) - count(DISTINCT title))::DOUBLE,
  CASE WHEN count(*) > count(DISTINCT title) THEN printf('%d duplicate %s values', count(*) - count(DISTINCT title), 'title') END FROM {src}
UNION ALL SELECT 'quality', '{name}', 'empty_strings:title', count_if(trim(title) = '')::DOUBLE,
  CASE WHEN count_if(trim(title) = '') > 0 THEN printf('%d empty values in %s', count_if(trim(title) = ''), 'title') END FROM {src}"""


ORACLE.update({
    "catalog_merge": f"""WITH {MV}
SELECT mv.id AS movie_id, title, vote_average, round(balance, 6) AS balance FROM mv JOIN cr USING (title)""",
    "validation_report": f"""WITH {MV},
b AS (SELECT quantile_cont(vote_average, 0.25) AS q1, quantile_cont(vote_average, 0.75) AS q3 FROM mv)
SELECT 'rows' AS section, 'movies' AS source, 'rows' AS name, count(*)::DOUBLE AS value, NULL::VARCHAR AS note FROM mv
UNION ALL SELECT 'rows', 'credits', 'rows', count(*), NULL FROM cr
UNION ALL SELECT 'rows', 'merged', 'rows', count(*), NULL FROM mv JOIN cr USING (title)
UNION ALL {_missing_sql('mv', 'movies', ['id', 'title', 'vote_average'])}
UNION ALL {_missing_sql('cr', 'credits', ['movie_id', 'title', 'balance'])}
UNION ALL {_checks_sql('mv', 'movies')}
UNION ALL SELECT 'quality', 'movies', 'outliers:vote_average', n::DOUBLE, CASE WHEN n > 0 THEN printf('%d outliers in %s', n, 'vote_average') END
FROM (SELECT count_if(vote_average < q1 - 1.5 * (q3 - q1) OR vote_average > q3 + 1.5 * (q3 - q1)) AS n FROM mv, b)
UNION ALL {_checks_sql('cr', 'credits')}
UNION ALL SELECT 'status', 'load', 'status', NULL, 'passed'""",
    "scan_catalog": """
SELECT o_orderkey AS movie_id, o_orderpriority AS title, 'a, "quoted"' || chr(10) || o_orderstatus AS overview,
       round(o_totalprice, 6) AS vote_average, o_custkey::BIGINT AS vote_count, strftime(o_orderdate, '%Y-%m-%d') AS release_date,
       'a, "quoted"' || chr(10) || o_orderstatus AS crew FROM orders""",
    "rollback_version": f"""WITH {REGISTRY},
r AS (SELECT version, arg_max(CASE WHEN genre_match_rate >= {FX.MIN_GENRE_MATCH} THEN version END,
                              CASE WHEN genre_match_rate >= {FX.MIN_GENRE_MATCH} THEN {{'t': registered_at, 'v': version}} END)
               OVER (ORDER BY registered_at, version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM reg)
SELECT version, coalesce(prev, version) AS serving_version, CASE WHEN prev IS NULL THEN 'no_backup' ELSE 'rolled_back' END AS status FROM r""",
})


# Pivot lists, and as many probes as find the wished share of a sample's true
# neighbours.
ORACLE["cosine_topk_approx"] = f"""
WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u FROM v),
pv AS (SELECT row_number() OVER (ORDER BY md5('pivot|' || id), id) AS no, u FROM u
       QUALIFY no <= least({AX.MAX_PIVOTS}, ceil({AX.PIVOTS_PER_ROOT} * sqrt((SELECT count(*) FROM u))))),
od AS (SELECT u.id, pv.no, row_number() OVER (PARTITION BY u.id ORDER BY round(list_inner_product(u.u, pv.u), 9) DESC, pv.no) AS r FROM u, pv),
sm AS (SELECT id, u FROM u ORDER BY md5('sample|' || id), id LIMIT {AX.SAMPLE}),
tr AS (SELECT s.id, o.id AS other_id FROM sm s JOIN u o ON s.id <> o.id WHERE list_inner_product(s.u, o.u) > 0
       QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY round(list_inner_product(s.u, o.u), 9) DESC, o.id) <= {FX.TOP_K}),
fd AS (SELECT tr.id, tr.other_id, min(q.r) AS probes FROM tr JOIN od a ON a.id = tr.other_id AND a.r <= {AX.ASSIGN}
       JOIN od q ON q.id = tr.id AND q.no = a.no GROUP BY tr.id, tr.other_id),
pb AS (SELECT min(probes) AS probes FROM (SELECT probes, sum(count(*)) OVER (ORDER BY probes) AS c, sum(count(*)) OVER () AS n FROM fd GROUP BY probes)
       WHERE c >= {AX.RECALL} * n),
pr AS (SELECT DISTINCT q.id, a.id AS other_id FROM od q JOIN od a ON q.no = a.no AND a.r <= {AX.ASSIGN} AND q.id <> a.id, pb WHERE q.r <= pb.probes),
sc AS (SELECT pr.id, pr.other_id, list_inner_product(a.u, b.u) AS score FROM pr JOIN u a ON a.id = pr.id JOIN u b ON b.id = pr.other_id)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other_id) AS rank, other_id, round(score, 6) AS score
FROM sc WHERE score > 0 QUALIFY rank <= {FX.TOP_K}"""
