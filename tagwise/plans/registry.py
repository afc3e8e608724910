"""Registered queries: (spark, sf_dir) -> DataFrame, keyed like SURVEY §2 ids.

Each query reads the whole driver tables it maps onto (plans/derived.py);
doubles are rounded to 6 digits only at the output so engines compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.functions import fixed as FX
from tagwise.functions import text as tx
from tagwise.operators import approx as AX
from tagwise.operators import baseline as BL
from tagwise.operators import catalog as CT
from tagwise.operators import drift as DR
from tagwise.operators import evaluate as EV
from tagwise.operators import feedback as FB
from tagwise.operators import quality as QA
from tagwise.operators import search as SR
from tagwise.operators import similarity as sim
from tagwise.plans import derived
from tagwise.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def ts_str(c):
    """Timestamps leave as fixed-format strings (engine-neutral)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def catalog_vectors(spark: SparkSession, sf_dir: str, arrays: bool = False):
    cat = derived.documents_catalog(spark, sf_dir)
    vocab, vec = sim.build_vectors(cat, "movie_id", "tags", arrays=arrays)
    return cat, vocab, vec


def n_docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# 2.6 text features and similarity
# ---------------------------------------------------------------------------

@query("topk_neighbours")
def q_topk_neighbours(spark, sf_dir):
    _, _, vec = catalog_vectors(spark, sf_dir, arrays=True)
    top = sim.topk_neighbours(vec, FX.TOP_K)
    return top.select("id", "rank", "other_id", r6("score").alias("score"))


@query("build_tags")
def q_build_tags(spark, sf_dir):
    return derived.documents_catalog(spark, sf_dir).select("movie_id", "title", "tags")


@query("vocabulary")
def q_vocabulary(spark, sf_dir):
    _, vocab, _ = catalog_vectors(spark, sf_dir)
    return vocab.select("term", "term_idx", "df", "cf")


@query("tfidf_vectors")
def q_tfidf_vectors(spark, sf_dir):
    _, _, vec = catalog_vectors(spark, sf_dir)
    return vec.select("id", "term_idx", r6("w").alias("w"))


@query("vocab_stats")
def q_vocab_stats(spark, sf_dir):
    _, vocab, vec = catalog_vectors(spark, sf_dir)
    return sim.vocab_stats(vocab, vec, n_docs(spark, sf_dir))


@query("similarity_summary")
def q_similarity_summary(spark, sf_dir):
    _, _, vec = catalog_vectors(spark, sf_dir, arrays=True)
    s = sim.similarity_summary(vec, n_docs(spark, sf_dir))
    return s.select(r6("mean_similarity").alias("mean_similarity"),
                    r6("max_below_one").alias("max_below_one"))


@query("similarity_footprint")
def q_similarity_footprint(spark, sf_dir):
    _, _, vec = catalog_vectors(spark, sf_dir, arrays=True)
    return sim.similarity_footprint(n_docs(spark, sf_dir), sim.topk_neighbours(vec, FX.TOP_K))


@query("embedding_topk")
def q_embedding_topk(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    top = sim.topk_neighbours(sim.embedding_vectors(emb), FX.TOP_K)
    return top.select("id", "rank", "other_id", r6("score").alias("score"))


@query("cosine_topk_approx")
def q_cosine_topk_approx(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    top = AX.cosine_topk_approx(emb, k=FX.TOP_K)
    return top.select("id", "rank", "other_id", r6("score").alias("score"))


@query("genre_match_rate")
def q_genre_match_rate(spark, sf_dir):
    """Neighbours are computed for the seeded sample only (sample x n)."""
    cat, _, vec = catalog_vectors(spark, sf_dir, arrays=True)
    sample = EV.md5_sample(cat.select("movie_id"), FX.EVAL_SAMPLE).select(F.col("movie_id").alias("id"))
    top = sim.topk_for_rows(sim.cut_lineage(vec, "vectors"), sample, FX.EVAL_NEIGHBOURS)
    return EV.genre_match_rate(cat, top, FX.EVAL_SAMPLE)


@query("genre_match_rate_all")
def q_genre_match_rate_all(spark, sf_dir):
    cat, _, vec = catalog_vectors(spark, sf_dir, arrays=True)
    top = sim.topk_neighbours(vec, FX.EVAL_NEIGHBOURS)
    return EV.genre_match_rate(cat, top, None)


def ablation_rates(spark, sf_dir, sample=FX.ABLATION_SAMPLE):
    cat = derived.documents_catalog(spark, sf_dir)
    var = CT.build_tag_variants(cat, FX.ABLATION_FEATURES)
    _, vec = sim.build_vectors(var, "movie_id", "tags", part=["variant"], arrays=True)
    judged = EV.md5_sample(var.select("variant", "movie_id"), sample, part=["variant"]).select("variant", F.col("movie_id").alias("id"))
    top = sim.topk_for_rows(sim.cut_lineage(vec, "vectors"), judged, FX.EVAL_NEIGHBOURS, part=["variant"])
    items = var.select("variant", "movie_id", "genres")
    return EV.genre_match_rate(items, top, sample, part=["variant"])


@query("feature_impact")
def q_feature_impact(spark, sf_dir):
    return EV.feature_impact(ablation_rates(spark, sf_dir))


@query("most_important_feature")
def q_most_important_feature(spark, sf_dir):
    return EV.most_important_feature(EV.feature_impact(ablation_rates(spark, sf_dir)))


# ---------------------------------------------------------------------------
# 2.4 baselines and importance
# ---------------------------------------------------------------------------

@query("baseline_tag_length")
def q_baseline_tag_length(spark, sf_dir):
    b = BL.baseline_tag_length(derived.documents_catalog(spark, sf_dir))
    return b.select(*[r6(c).alias(c) for c in b.columns])


@query("baseline_word_count")
def q_baseline_word_count(spark, sf_dir):
    b = BL.baseline_word_count(derived.documents_catalog(spark, sf_dir))
    return b.select(*[r6(c).alias(c) for c in b.columns])


@query("baseline_list_counts")
def q_baseline_list_counts(spark, sf_dir):
    b = BL.baseline_list_counts(derived.documents_catalog(spark, sf_dir))
    return b.select("feature", r6("mean_per_item").alias("mean_per_item"),
                    r6("variance").alias("variance"), "items_empty")


@query("baseline_director_counts")
def q_baseline_director_counts(spark, sf_dir):
    return BL.baseline_director_counts(derived.documents_catalog(spark, sf_dir))


@query("baseline_top_genres")
def q_baseline_top_genres(spark, sf_dir):
    return BL.top_genres(derived.documents_catalog(spark, sf_dir))


@query("baseline_statistics")
def q_baseline_statistics(spark, sf_dir):
    b = BL.baseline_statistics(derived.documents_catalog(spark, sf_dir))
    return b.select("total_items", r6("tag_length.mean").alias("tag_length_mean"),
                    r6("tag_length.median").alias("tag_length_median"),
                    r6("word_count.variance").alias("word_count_variance"),
                    r6("genre_counts.mean_per_item").alias("genres_mean_per_item"),
                    "keyword_counts.items_no_keywords",
                    "director_counts.items_with_director",
                    F.size(F.map_keys("top_genres")).alias("top_genre_count"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    return BL.feature_importance(derived.documents_catalog(spark, sf_dir))


# ---------------------------------------------------------------------------
# 2.1 / 2.2 / 2.9 raw catalog parsing and quality
# ---------------------------------------------------------------------------

@query("parse_catalog")
def q_parse_catalog(spark, sf_dir):
    raw = derived.raw_catalog_tpch(spark, sf_dir)
    p = CT.prepare_catalog(raw)
    return p.select("movie_id", "title",
                    F.array_join("genres", "|").alias("genres"),
                    F.array_join("keywords", "|").alias("keywords"),
                    F.array_join("cast", "|").alias("cast"),
                    F.array_join("crew", "|").alias("crew"), "tags")


@query("catalog_merge_by_id")
def q_catalog_merge_by_id(spark, sf_dir):
    """orders (as items) JOIN customer (as credits) on the key."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"),
                                             F.col("o_custkey").alias("movie_id_key"),
                                             F.col("o_orderpriority").alias("title"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("movie_id_key"),
                                               F.col("c_name").alias("cast"),
                                               F.col("c_mktsegment").alias("crew"))
    return o.join(c, "movie_id_key").select(F.col("id").alias("movie_id"), "title", "cast", "crew")


def title_catalogs(spark, sf_dir):
    """Movies = line items titled by their supplier's name; credits =
    suppliers, whose names are unique, so a merge on title multiplies nothing."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    movies = li.join(sup.select("s_suppkey", "s_name"), li.l_suppkey == sup.s_suppkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("s_name").alias("title"), F.col("l_quantity").alias("vote_average"))
    credits = sup.select(F.col("s_suppkey").alias("movie_id"), F.col("s_name").alias("title"),
                         F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("balance"))
    return movies, credits


@query("catalog_merge")
def q_catalog_merge(spark, sf_dir):
    m = CT.catalog_merge(*title_catalogs(spark, sf_dir))
    return m.select("movie_id", "title", "vote_average", r6("balance").alias("balance"))


@query("validation_report")
def q_validation_report(spark, sf_dir):
    movies, credits = title_catalogs(spark, sf_dir)
    return QA.validation_report(movies, credits, CT.catalog_merge(movies, credits))


@query("scan_catalog")
def q_scan_catalog(spark, sf_dir):
    """Two catalog files written as header CSV, with quotes, commas and line
    breaks in the texts, and read back with the declared schemas."""
    from tagwise.sources.tables import scan_catalog
    o = table(spark, sf_dir, "orders")
    base = _scratch(spark, "catalog_csv")
    text = F.concat(F.lit('a, "quoted"\n'), "o_orderstatus")
    (o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), text.alias("overview"), F.lit("[]").alias("genres"),
              F.lit(None).cast("string").alias("keywords"), F.col("o_totalprice").alias("vote_average"), F.col("o_custkey").cast("long").alias("vote_count"),
              F.lit(0.5).alias("popularity"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"))
     .write.option("header", True).option("escape", "\"").csv(f"{base}/movies"))
    (o.select(F.col("o_orderkey").alias("movie_id"), F.col("o_orderpriority").alias("title"), F.lit("[]").alias("cast"), text.alias("crew"))
     .write.option("header", True).option("escape", "\"").csv(f"{base}/credits"))
    movies, credits = scan_catalog(spark, f"{base}/movies", f"{base}/credits")
    return (CT.catalog_merge_by_id(CT.rename_id(movies), credits)
            .select("movie_id", "title", "overview", r6("vote_average").alias("vote_average"), "vote_count", "release_date", "crew"))


def events_with_nulls(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.expr("nullif(event_type, 'error')").alias("event_type"),
                    "user_id", F.expr("nullif(props, '{\"k\": 69}')").alias("props"), "value")


@query("missing_values")
def q_missing_values(spark, sf_dir):
    return QA.missing_values(events_with_nulls(spark, sf_dir), "events")


@query("drop_nulls")
def q_drop_nulls(spark, sf_dir):
    return CT.drop_nulls_report(events_with_nulls(spark, sf_dir))


@query("min_rows_check")
def q_min_rows_check(spark, sf_dir):
    return QA.min_rows_check(table(spark, sf_dir, "part"), FX.MIN_ROWS)


@query("duplicate_titles")
def q_duplicate_titles(spark, sf_dir):
    return QA.duplicate_titles(table(spark, sf_dir, "part").select(F.col("p_name").alias("title")))


@query("empty_strings")
def q_empty_strings(spark, sf_dir):
    return QA.empty_strings(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query("rating_outliers")
def q_rating_outliers(spark, sf_dir):
    return QA.rating_outliers(table(spark, sf_dir, "customer"), "c_acctbal")


@query("quality_issues")
def q_quality_issues(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("title"), "p_brand", "p_type",
                                           "p_retailprice")
    return QA.quality_issues(p, "title", "p_retailprice", ["title", "p_brand", "p_type"])


@query("quality_summary")
def q_quality_summary(spark, sf_dir):
    iss = q_quality_issues(spark, sf_dir)
    return QA.quality_summary(iss).select("passed", "issue_count",
                                          F.array_join("issues", "; ").alias("issues"))


@query("validate_schema")
def q_validate_schema(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    req = ["p_partkey", "p_name", "p_retailprice", "p_comment"]
    return QA.schema_table(part, req, "part").crossJoin(part.agg(F.count(F.lit(1)).alias("rows")))


@query("eda_profile")
def q_eda_profile(spark, sf_dir):
    return QA.eda_profile(table(spark, sf_dir, "lineitem"), "lineitem")


# ---------------------------------------------------------------------------
# 2.4 / 2.5 feedback
# ---------------------------------------------------------------------------

def fb(spark, sf_dir):
    return derived.feedback_from_events(spark, sf_dir), derived.positives_from_events(spark, sf_dir)


@query("feedback_stats")
def q_feedback_stats(spark, sf_dir):
    s, p = fb(spark, sf_dir)
    x = FB.feedback_stats(s, p)
    return x.select(*[r6(c).alias(c) if c in ("query_length_mean", "query_length_variance",
                                               "avg_latency_ms", "success_rate", "not_found_rate")
                      else F.col(c) for c in x.columns])


@query("status_counts")
def q_status_counts(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    return FB.status_counts(s, ["status"])


@query("request_counts")
def q_request_counts(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    code = F.when(F.col("status") == "error", 500).when(F.col("status") == "not_found", 404).otherwise(200)
    return FB.status_counts(s.select(F.col("event_type").alias("endpoint"), code.alias("status_code")),
                            ["endpoint", "status_code"])


@query("latency_histogram")
def q_latency_histogram(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    h = FB.latency_histogram(s, F.col("latency_ms") / 1000.0)
    return h.select("le", "bucket_count", r6("sum_seconds").alias("sum_seconds"), "count")


@query("latency_violations")
def q_latency_violations(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    return FB.latency_violations(s, F.col("latency_ms"))


@query("last_gauge")
def q_last_gauge(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    g = FB.last_gauge(s, ["event_type"], "latency_ms", "ts", "event_id")
    return g.select("event_type", r6("last_value").alias("last_value"), ts_str("last_ts").alias("last_ts"))


@query("favorites_count")
def q_favorites_count(spark, sf_dir):
    _, p = fb(spark, sf_dir)
    return FB.favorites_count(p)


@query("distinct_queries")
def q_distinct_queries(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    return s.select("query").distinct().agg(F.count(F.lit(1)).alias("distinct_queries"))


@query("drift_checkpoints")
def q_drift_checkpoints(spark, sf_dir):
    s, p = fb(spark, sf_dir)
    return FB.drift_checkpoints(s, p, success_only=False).withColumn("ts", ts_str("ts"))


@query("active_requests")
def q_active_requests(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    a = FB.active_requests(s, "ts", F.col("latency_ms"), "event_id")
    return a.select("max_active", ts_str("first_peak_at").alias("first_peak_at"))


@query("session_activity")
def q_session_activity(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    a = FB.session_activity(s, "user_id", "ts", "30 minutes")
    return a.select("user_id", ts_str("session_start").alias("session_start"),
                    ts_str("session_end").alias("session_end"), "requests", "successes")


# ---------------------------------------------------------------------------
# 2.10 drift, gates, registry
# ---------------------------------------------------------------------------

def catalog_baseline(spark, sf_dir):
    return BL.baseline_word_count(derived.documents_catalog(spark, sf_dir))


@query("detect_drift")
def q_detect_drift(spark, sf_dir):
    s, p = fb(spark, sf_dir)
    return DR.detect_drift(FB.feedback_stats(s, p), catalog_baseline(spark, sf_dir))


@query("drift_scores")
def q_drift_scores(spark, sf_dir):
    s, p = fb(spark, sf_dir)
    return DR.drift_scores(FB.feedback_stats(s, p), catalog_baseline(spark, sf_dir))


@query("checkpoint_drift")
def q_checkpoint_drift(spark, sf_dir):
    s, p = fb(spark, sf_dir)
    v = DR.checkpoint_drift(FB.drift_checkpoints(s, p, success_only=False), catalog_baseline(spark, sf_dir))
    return v.select("rn", ts_str("ts").alias("ts"), "mean_drift", "variance_drift", r6("success_rate").alias("success_rate"),
                    "positive_rate", "drift_detected")


@query("retrain_requests")
def q_retrain_requests(spark, sf_dir):
    s, p = fb(spark, sf_dir)
    v = DR.checkpoint_drift(FB.drift_checkpoints(s, p, success_only=False), catalog_baseline(spark, sf_dir))
    return DR.retrain_requests(v).withColumn("ts", ts_str("ts"))


def model_registry(spark, sf_dir):
    """One training run per day of events: quality = share of the day's
    events with value > 20, items = events, vocabulary = users."""
    e = table(spark, sf_dir, "events")
    day = F.to_date(F.col("ts").cast("timestamp"))
    return (e.groupBy(day.alias("day")).agg(
        tx.ratio_round(F.count_if(F.col("value") > 20), F.count(F.lit(1)), 4).alias("genre_match_rate"),
        F.count(F.lit(1)).alias("n_items"), F.count_distinct("user_id").alias("vocabulary_size"),
        F.max(F.col("ts").cast("timestamp")).alias("registered_at"))
        .select(F.concat(F.lit("v_"), F.date_format("registered_at", "yyyyMMdd_HHmmss")).alias("version"),
                "registered_at", "genre_match_rate", "n_items", "vocabulary_size"))


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    return DR.quality_gate(model_registry(spark, sf_dir)).select("version", "genre_match_rate", "decision")


@query("stage_transition")
def q_stage_transition(spark, sf_dir):
    return DR.stage_transitions(model_registry(spark, sf_dir)).withColumn("registered_at", ts_str("registered_at"))


@query("registry_describe")
def q_registry_describe(spark, sf_dir):
    d = DR.registry_describe(model_registry(spark, sf_dir))
    return d.select("version", "description", F.col("tags")["trained_on"].alias("trained_on"))


@query("latest_pointer")
def q_latest_pointer(spark, sf_dir):
    return DR.latest_pointer(model_registry(spark, sf_dir))


@query("promote_version")
def q_promote_version(spark, sf_dir):
    return DR.promote_and_rollback(model_registry(spark, sf_dir))


@query("rollback_version")
def q_rollback_version(spark, sf_dir):
    return DR.rollback_version(model_registry(spark, sf_dir))


@query("model_version_info")
def q_model_version_info(spark, sf_dir):
    _, vocab, vec = catalog_vectors(spark, sf_dir)
    st = sim.vocab_stats(vocab, vec, n_docs(spark, sf_dir))
    return st.select(F.lit("tfidf-cosine").alias("model"), "vocabulary_size", "matrix_rows", "nnz")


@query("artifact_readiness")
def q_artifact_readiness(spark, sf_dir):
    """Required artifacts vs the per-day runs present in the registry."""
    reg = model_registry(spark, sf_dir).select(F.date_format("registered_at", "yyyy-MM-dd").alias("artifact"))
    days = (table(spark, sf_dir, "events")
            .select(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("artifact")).distinct())
    return DR.artifact_readiness(days, reg).select("ready", "missing_count",
                                                   F.array_join("missing", ",").alias("missing"))


@query("experiment_metrics")
def q_experiment_metrics(spark, sf_dir):
    reg = model_registry(spark, sf_dir).withColumnRenamed("version", "run_id")
    return DR.experiment_metrics(reg, {"metric": ["genre_match_rate"],
                                       "param": ["n_items", "vocabulary_size"]})


# ---------------------------------------------------------------------------
# 2.3 / 2.5 / 2.7 search and recommendation
# ---------------------------------------------------------------------------

def query_batch(spark, sf_dir) -> DataFrame:
    """Queries derived from the tables: every language, every source (person
    route), every genre and character name, every part name, and the title of
    every document (title route)."""
    d = table(spark, sf_dir, "documents")
    names = spark.createDataFrame([(g,) for g in [*FX.GENRE_QUERIES, *FX.CHARACTER_TO_ACTOR]], "query string")
    return (d.select(F.lower("lang").alias("query"))
            .unionByName(d.select(F.col("source").alias("query")))
            .unionByName(table(spark, sf_dir, "part").select(F.col("p_name").alias("query")))
            .unionByName(names)
            .unionByName(d.select(F.lower(derived.heading()).alias("query"))))


def lookups(spark, cat):
    gv = spark.createDataFrame([(g,) for g in FX.GENRE_QUERIES], "genre_query string")     # fixed list
    cm = spark.createDataFrame(list(FX.CHARACTER_TO_ACTOR.items()), "character string, actor string")
    am = spark.createDataFrame(list(FX.GENRE_SEARCH_MAP.items()), "q string, terms array<string>")
    return gv, cm, am


def search_context(spark, sf_dir, route=True):
    """Catalog, (item, word) rows, distinct words, query batch and routing feed a dozen
    joins each; they are written once to the checkpoint folder so every
    later reference is a file scan (reusing cached plans instead makes the
    plan tree grow with every reference)."""
    cat = sim.cut_lineage(derived.documents_catalog(spark, sf_dir).select("movie_id", "title", "genres", "tags"), "catalog")
    words = SR.tag_words(cat)
    if route:       # else they are read twice only, and are as large as the texts
        words = sim.cut_lineage(words, "words")
    index = sim.cut_lineage(SR.word_table(words), "word_table")
    q = sim.cut_lineage(SR.prepare_queries(query_batch(spark, sf_dir)), "queries")
    if not route:
        return cat, words, index, q, None, None
    gv, cm, am = lookups(spark, cat)
    routed = sim.cut_lineage(SR.route_query(q, cat, gv, cm, words, index), "routed")
    return cat, words, index, q, routed, am


@query("route_query")
def q_route_query(spark, sf_dir):
    _, _, _, _, routed, _ = search_context(spark, sf_dir)
    return routed.select("query", "route", "person_key", F.when(F.col("route") == "title", F.col("matched_title")).alias("matched_title"))


@query("blank_query_guard")
def q_blank_query_guard(spark, sf_dir):
    """Queries of the request log, of which errors came in blank or empty."""
    e = table(spark, sf_dir, "events")
    text = (F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), F.lit("  "))
            .when(F.col("event_type") != "error", F.concat_ws(" ", "event_type", "props")))
    g = SR.blank_query_guard(e.select("event_id", text.alias("query")))
    return g.select("event_id", "query", "accepted", "status")


@query("query_item_contains")
def q_query_item_contains(spark, sf_dir):
    cat, words, index, q, _, _ = search_context(spark, sf_dir, route=False)
    keys = q.filter(F.col("squeezed") != "").select("kid", F.col("squeezed").alias("key"))
    hits = SR.contains_join(keys, words, index, cat.select(F.col("movie_id").alias("id"), F.col("tags").alias("text")))
    return hits.join(q, "kid").select("query", F.col("id").alias("movie_id"))


@query("fuzzy_title_levenshtein")
def q_fuzzy_title(spark, sf_dir):
    cat, _, _, q, _, _ = search_context(spark, sf_dir, route=False)
    fz = SR.fuzzy_title_match(q.select("kid", "q"), cat.select(F.lower("title").alias("title")))
    return fz.join(q, "kid").select("query", "matched", r6("ratio").alias("ratio"))


@query("fuzzy_title_ratio")
def q_fuzzy_ratio(spark, sf_dir):
    """Best title of every query by common blocks; ``candidates`` = the pairs
    that both bounds leave (0 where the title itself is in the catalog)."""
    cat, _, _, q, _, _ = search_context(spark, sf_dir, route=False)
    fz = SR.fuzzy_title_ratio(q.select("kid", "q"), cat.select(F.lower("title").alias("title")))
    return fz.join(q, "kid").select("query", "matched", r6("ratio").alias("ratio"), "candidates")


@query("search_by_genre")
def q_search_by_genre(spark, sf_dir):
    cat, words, index, _, routed, am = search_context(spark, sf_dir)
    return SR.search_by_genre(routed, cat, am, words, index)


@query("search_by_person")
def q_search_by_person(spark, sf_dir):
    cat, words, index, _, routed, _ = search_context(spark, sf_dir)
    _, vec = sim.build_vectors(cat, "movie_id", "tags", arrays=True)
    return SR.search_by_person(routed, cat, sim.cut_lineage(vec, "vectors"), words, index)


def title_results(routed, cat, vec):
    """Neighbours are computed for the matched titles' items only."""
    a = sim.cut_lineage(SR.title_anchors(routed, cat), "title_anchors")
    top = sim.topk_for_rows(vec, a.select(F.col("anchor").alias("id")), FX.TITLE_NEIGHBOURS)
    return SR.title_recommend(a, cat, top)


@query("title_recommend")
def q_title_recommend(spark, sf_dir):
    cat, _, _, _, routed, _ = search_context(spark, sf_dir)
    _, vec = sim.build_vectors(cat, "movie_id", "tags", arrays=True)
    return title_results(routed, cat, sim.cut_lineage(vec, "vectors"))


def recommend_all(spark, sf_dir):
    cat, words, index, q, routed, am = search_context(spark, sf_dir)
    _, vec = sim.build_vectors(cat, "movie_id", "tags", arrays=True)
    v = sim.cut_lineage(vec, "vectors")
    res = (SR.search_by_genre(routed, cat, am, words, index)
           .unionByName(title_results(routed, cat, v))
           .unionByName(SR.search_by_person(routed, cat, v, words, index)))
    return q, res


@query("recommend_batch")
def q_recommend_batch(spark, sf_dir):
    _, res = recommend_all(spark, sf_dir)
    return SR.recommend_metrics(res)


@query("recommend_outcome")
def q_recommend_outcome(spark, sf_dir):
    """Outcome of every query as it came in, blank ones included."""
    _, res = recommend_all(spark, sf_dir)
    return SR.recommend_outcome(query_batch(spark, sf_dir), res)


@query("sort_recommendations")
def q_sort_recommendations(spark, sf_dir):
    """Title-route results enriched with a rating (labels.quality of the
    item, null when unlabelled), sorted for display."""
    cat, _, _, _, routed, _ = search_context(spark, sf_dir)
    _, vec = sim.build_vectors(cat, "movie_id", "tags", arrays=True)
    res = title_results(routed, cat, sim.cut_lineage(vec, "vectors"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rating = (cat.select("movie_id", "title").join(lab, F.col("movie_id") == F.col("doc_id"), "left")
              .groupBy("title").agg(F.max(F.col("quality") * 10.0 / 3).alias("rating")))
    s = SR.sort_recommendations(res.join(rating, "title", "left"), ["query"])
    return s.select("query", "title", "display_pos", "rating_label")


@query("enrich_metadata")
def q_enrich_metadata(spark, sf_dir):
    """Titles = part names and supplier names; metadata candidates = part
    rows of that name (poster when p_size > 25, rating = price / 200,
    overview = type; names with small parts only have no poster: fallback).
    Supplier names have no candidate: fallback, or error where the balance is
    negative (a failed request)."""
    p = table(spark, sf_dir, "part")
    cand = p.select(F.col("p_name").alias("title"), F.col("p_partkey").alias("cand_pos"),
                    F.when(F.col("p_size") > 25, F.concat(F.lit("/p"), F.col("p_partkey").cast("string")))
                    .alias("poster_path"),
                    (F.col("p_retailprice") / 200).alias("vote_average"), F.col("p_type").alias("overview"))
    titles = (p.select(F.col("p_name").alias("title"), F.lit(False).alias("failed"))
              .unionByName(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("title"), (F.col("s_acctbal") < 0).alias("failed")))
              .groupBy("title").agg(F.max("failed").alias("failed")))
    return SR.enrich_metadata(titles, cand, "failed").withColumn("rating", r6("rating"))


# ---------------------------------------------------------------------------
# 2.11 alerts (batch form; stream twins in tagwise/streaming)
# ---------------------------------------------------------------------------

from tagwise.operators import alerts as AL  # noqa: E402

RULE_SIZES = sorted({r[2] for r in FX.ALERT_RULES if r[1] in AL.LOG_SIGNALS})


def alert_eval(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    return AL.evaluate_rules(AL.step_counts(s, RULE_SIZES), AL.rules_table(spark))


def host_eval(spark, sf_dir):
    """Host metrics from event values: instance = user_id modulo 3."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    samples = e.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 3).alias("instance"),
                       F.least(v * 2, F.lit(100.0)).alias("cpu_used_pct"), F.least(v * 3, F.lit(100.0)).alias("memory_used_pct"),
                       F.least(v * 4, F.lit(100.0)).alias("disk_used_pct"), (v * 5e6).alias("rate_rx_bytes"))
    return AL.host_threshold(samples, AL.rules_table(spark))


@query("rate_tumbling")
def q_rate_tumbling(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    r = AL.rate_windows(s, "1 hour")
    return r.select(ts_str("window_start").alias("window_start"), "status", "n", r6("rate").alias("rate"))


@query("rate_sliding")
def q_rate_sliding(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    r = AL.rate_windows(s, "1 hour", "15 minutes")
    return r.select(ts_str("window_start").alias("window_start"), "status", "n", r6("rate").alias("rate"))


def _rules_of(ev, kinds):
    return ev.filter(F.col("rule").isin(kinds)).select(
        "rule", "severity", ts_str("evaluated_at").alias("evaluated_at"), r6("value").alias("value"), "condition")


@query("ratio_alert")
def q_ratio_alert(spark, sf_dir):
    return _rules_of(alert_eval(spark, sf_dir), ["HighErrorRate", "HighRecommendationFailureRate",
                                                 "HighNotFoundRate", "RecommendationQualityDrop",
                                                 "ModelRetrainingRequired", "ErrorRateExceeds5Percent"])


@query("increase_alert")
def q_increase_alert(spark, sf_dir):
    return _rules_of(alert_eval(spark, sf_dir), ["TooManyLatencyViolations"])


@query("quantile_alert")
def q_quantile_alert(spark, sf_dir):
    return _rules_of(alert_eval(spark, sf_dir), ["InferenceP95LatencyHigh"])


@query("absence_alert")
def q_absence_alert(spark, sf_dir):
    return _rules_of(alert_eval(spark, sf_dir), ["NoRecommendationsServed", "ZeroThroughput"])


def _fired(f, *by):
    return f.select("rule", "severity", *by, ts_str("started_at").alias("started_at"),
                    ts_str("fired_at").alias("fired_at"), "steps")


@query("alert_for_duration")
def q_alert_for_duration(spark, sf_dir):
    return _fired(AL.alert_for_duration(alert_eval(spark, sf_dir)))


@query("host_threshold_alert")
def q_host_threshold_alert(spark, sf_dir):
    return _fired(AL.alert_for_duration(host_eval(spark, sf_dir), ["instance"]), "instance")


@query("alert_labels")
def q_alert_labels(spark, sf_dir):
    f = AL.alert_for_duration(alert_eval(spark, sf_dir)).select("rule")
    h = AL.alert_for_duration(host_eval(spark, sf_dir), ["instance"]).select("rule")
    return AL.alert_labels(f.unionByName(h), AL.rules_table(spark))


@query("gauge_alert")
def q_gauge_alert(spark, sf_dir):
    """Both rules on the last latency."""
    s, _ = fb(spark, sf_dir)
    out = None
    for r in FX.ALERT_RULES:
        if r[1] == "last_latency_ms":
            g = AL.gauge_alert(s, "latency_ms", r[4], r[5]).select(
                F.lit(r[0]).alias("rule"), ts_str("started_at").alias("started_at"), ts_str("ended_at").alias("ended_at"), "samples")
            out = g if out is None else out.unionByName(g)
    return out


UP_GAP_SECONDS = 15 * 60


@query("up_alert")
def q_up_alert(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    u = AL.up_alert(s, UP_GAP_SECONDS)
    return u.select(ts_str("down_from").alias("down_from"), ts_str("up_again").alias("up_again"),
                    r6("gap_seconds").alias("gap_seconds"))


@query("model_not_ready_alert")
def q_model_not_ready(spark, sf_dir):
    """Windows (10 min) with requests but nothing served: the windows
    anti-joined with the windows that had a success."""
    s, _ = fb(spark, sf_dir)
    ws = F.window("ts", "10 minutes").start
    up = s.select(ws.alias("w")).distinct()
    served = s.filter(F.col("status") == "success").select(ws.alias("w")).distinct()
    return up.join(served, "w", "left_anti").select(ts_str("w").alias("window_start"))


# ---------------------------------------------------------------------------
# 2.11 Structured Streaming twins (file stream of events, availableNow)
# ---------------------------------------------------------------------------

from tagwise.streaming import alert_stream as AS  # noqa: E402
from tagwise.streaming import feedback_stream as ST  # noqa: E402


@query("stream_feedback_ingest")
def q_stream_feedback_ingest(spark, sf_dir):
    d = ST.stream_feedback_ingest(spark, sf_dir)
    return d.select("event_id", ts_str("ts").alias("ts"), "user_id", "query", "status",
                    r6("latency_ms").alias("latency_ms"))


@query("stream_feedback_stats")
def q_stream_feedback_stats(spark, sf_dir):
    d = ST.stream_feedback_stats(spark, sf_dir)
    return d.select(ts_str("window_start").alias("window_start"), ts_str("window_end").alias("window_end"),
                    "total_queries", r6("query_length_mean").alias("query_length_mean"),
                    r6("query_length_variance").alias("query_length_variance"),
                    r6("avg_latency_ms").alias("avg_latency_ms"), "successes", "not_found")


@query("stream_positive_dedup")
def q_stream_positive_dedup(spark, sf_dir):
    return ST.stream_positive_dedup(spark, sf_dir).select("user_id", "movie")


@query("stream_session_activity")
def q_stream_session_activity(spark, sf_dir):
    d = ST.stream_session_activity(spark, sf_dir)
    return d.select("user_id", ts_str("session_start").alias("session_start"),
                    ts_str("session_end").alias("session_end"), "requests", "successes")


@query("stream_alert_counts")
def q_stream_alert_counts(spark, sf_dir):
    d = ST.stream_alert_counts(spark, sf_dir)
    return d.select(ts_str("window_start").alias("window_start"), "status", "n")


@query("stream_drift")
def q_stream_drift(spark, sf_dir):
    """One verdict at each tenth request that is a success."""
    d = ST.stream_drift(spark, sf_dir, catalog_baseline(spark, sf_dir))
    return d.select("rn", ts_str("ts").alias("ts"), "mean_drift", "variance_drift", r6("success_rate").alias("success_rate"),
                    "positive_rate", "drift_detected", "retrain_reason")


@query("stream_alert_for_duration")
def q_stream_alert_for_duration(spark, sf_dir):
    """Rules on the log, fired on the stream."""
    d = AS.alert_stream(ST.feedback_stream(spark, sf_dir), AL.rules_table(spark), RULE_SIZES)
    return d.select("rule", "severity", ts_str("started_at").alias("started_at"), ts_str("fired_at").alias("fired_at"))


@query("stream_up_alert")
def q_stream_up_alert(spark, sf_dir):
    """Silent targets: the backend (heartbeat: any request) and the monitor
    (heartbeat: a sample of host 0, on which it runs)."""
    e = ST.feedback_stream(spark, sf_dir)
    target = F.explode(F.array_compact(F.array(F.lit("up_api"), F.when(F.col("user_id") % 3 == 0, "up_monitor"))))
    d = AS.heartbeat_stream(e.select("ts", target.alias("target")), UP_GAP_SECONDS)
    rules = AL.rules_table(spark).select(F.col("signal").alias("target"), "rule", "severity")
    return d.join(F.broadcast(rules), "target").select("rule", "severity", ts_str("down_from").alias("down_from"), ts_str("fired_at").alias("fired_at"))


# ---------------------------------------------------------------------------
# 2.1 sinks (write, then read back what was written) and small lookups
# ---------------------------------------------------------------------------

import uuid  # noqa: E402

from tagwise.session import ensure_checkpoint_dir  # noqa: E402
from tagwise.sources import sinks as SK  # noqa: E402


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sinks/{name}-{uuid.uuid4().hex}"


def data_version(spark, sf_dir):
    """Run version derived from the data: the last event time."""
    e = table(spark, sf_dir, "events")
    return e.agg(F.concat(F.lit("v_"), F.date_format(F.max(F.col("ts").cast("timestamp")),
                                                     "yyyyMMdd_HHmmss")).alias("version"))


@query("sink_feature_store")
def q_sink_feature_store(spark, sf_dir):
    cat = derived.documents_catalog(spark, sf_dir).select("movie_id", "title", "tags")
    feats = cat.crossJoin(F.broadcast(data_version(spark, sf_dir)))  # one row
    path = _scratch(spark, "feature_store")
    feats.write.mode("append").partitionBy("version").parquet(path)
    return spark.read.parquet(path).select("version", "movie_id", "title", "tags")


@query("sink_validation_report")
def q_sink_validation_report(spark, sf_dir):
    path = SK.write_report(q_quality_issues(spark, sf_dir), _scratch(spark, "validation"))
    return spark.read.schema("check string, column string, value double, issue string").json(path)


@query("sink_drift_report")
def q_sink_drift_report(spark, sf_dir):
    d = q_detect_drift(spark, sf_dir)
    path = SK.write_report(d, _scratch(spark, "drift"))
    return spark.read.schema(d.schema).json(path)


@query("feedback_append")
def q_feedback_append(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    path = _scratch(spark, "search_feedback")
    rows = s.select(ts_str("ts").alias("timestamp"), "query", F.lit(None).cast("string").alias("matched_title"),
                    F.lit(0).alias("recommendations_count"), r6("latency_ms").alias("latency_ms"), "status")
    SK.append_log(rows.filter(F.col("status") != "error"), path)
    SK.append_log(rows.filter(F.col("status") == "error"), path)
    return spark.read.parquet(path)


@query("positive_append")
def q_positive_append(spark, sf_dir):
    _, p = fb(spark, sf_dir)
    path = _scratch(spark, "positive_feedback")
    SK.append_log(p.select(ts_str("ts").alias("timestamp"), "movie", "source"), path)
    return spark.read.parquet(path)


@query("alias_lookup")
def q_alias_lookup(spark, sf_dir):
    q = SR.prepare_queries(query_batch(spark, sf_dir))
    _, _, am = lookups(spark, derived.documents_catalog(spark, sf_dir))
    x = q.join(F.broadcast(am), "q", "left")
    return x.select("query", F.array_join(F.coalesce("terms", F.array("q")), "|").alias("terms"))


@query("character_lookup")
def q_character_lookup(spark, sf_dir):
    q = SR.prepare_queries(query_batch(spark, sf_dir))
    _, cm, _ = lookups(spark, derived.documents_catalog(spark, sf_dir))
    x = q.join(F.broadcast(cm.withColumnRenamed("character", "q")), "q", "left")
    return x.select("query", F.coalesce("actor", F.translate("q", " ", "")).alias("person_key"))


@query("poster_url_valid")
def q_poster_url_valid(spark, sf_dir):
    e = q_enrich_metadata(spark, sf_dir)
    p = F.col("poster")
    ok = (p.isNotNull() & p.startswith("http") & ~p.contains("placeholder") & ~p.contains("None")
          & ~p.contains("null"))
    return e.select("title", F.coalesce(ok, F.lit(False)).alias("valid"))


@query("avg_by_instance")
def q_avg_by_instance(spark, sf_dir):
    s, _ = fb(spark, sf_dir)
    return s.groupBy(F.col("user_id").alias("instance")).agg(r6(F.avg("latency_ms")).alias("avg_latency_ms"))


@query("latest_baseline")
def q_latest_baseline(spark, sf_dir):
    """The model's own baseline (none here) first, else the lexically largest
    feature-store version."""
    reg = model_registry(spark, sf_dir).select("version",
                                               F.concat(F.lit("feature_store/"), F.col("version"),
                                                        F.lit("/baseline")).alias("path"))
    empty = spark.createDataFrame([], "version string, path string")
    return DR.latest_baseline(empty, reg)


@query("run_summary")
def q_run_summary(spark, sf_dir):
    reg = DR.quality_gate(model_registry(spark, sf_dir))
    last = reg.agg(F.max_by(F.struct("version", "genre_match_rate", "decision"),
                            F.struct("registered_at", "version")).alias("r"))
    return last.select("r.version", "r.genre_match_rate", "r.decision")


@query("scan_feedback")
def q_scan_feedback(spark, sf_dir):
    """Both feedback logs written as header CSV and read back through the
    declared-schema reader."""
    from tagwise.sources.tables import ISO_TS, scan_feedback
    s, p = fb(spark, sf_dir)
    base = _scratch(spark, "feedback_csv")
    (s.select(F.col("ts").alias("timestamp"), "query", F.lit(None).cast("string").alias("matched_title"),
              F.lit(0).alias("recommendations_count"), F.col("latency_ms").cast("string").alias("latency_ms"),
              "status")
     .write.option("header", True).option("escape", "\"").option("timestampFormat", ISO_TS)
     .csv(f"{base}/search"))
    (p.select(F.col("ts").alias("timestamp"), "movie", "source")
     .write.option("header", True).option("escape", "\"").option("timestampFormat", ISO_TS).csv(f"{base}/pos"))
    search, pos = scan_feedback(spark, f"{base}/search", f"{base}/pos")
    return (search.select(ts_str("timestamp").alias("timestamp"), "query", "status",
                          r6(F.col("latency_ms").try_cast("double")).alias("latency_ms"))
            .unionByName(pos.select(ts_str("timestamp").alias("timestamp"), F.col("movie").alias("query"),
                                    F.lit("positive").alias("status"), F.lit(None).cast("double").alias("latency_ms"))))


@query("sink_model_artifacts")
def q_sink_model_artifacts(spark, sf_dir):
    """Persist vocabulary, neighbour table and catalog; report what was written."""
    cat, vocab, vec = catalog_vectors(spark, sf_dir, arrays=True)
    top = sim.topk_neighbours(vec, FX.TOP_K)
    base = SK.sink_model_artifacts(vocab.select("term", "term_idx", "df", "cf"), top,
                                   cat.select("movie_id", "title", "tags"), _scratch(spark, "model"))
    counts = [spark.read.parquet(f"{base}/{a}").agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(a).alias("artifact"), "rows") for a in ("vocabulary", "neighbours", "catalog")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("genre_filter")
def q_genre_filter(spark, sf_dir):
    """Items whose joined genre list contains a genre-routed query's term."""
    cat, words, index, _, routed, am = search_context(spark, sf_dir)
    gq = routed.filter(F.col("route") == "genre").select("kid", "query", "q")
    terms = (gq.join(F.broadcast(am), "q", "left")
             .select("kid", "query", F.explode(F.coalesce("terms", F.array("q"))).alias("term"))
             .select("kid", "query", F.regexp_replace("term", " ", "").alias("term"))
             .filter(F.col("term") != ""))
    gwords = cat.select(F.col("movie_id").alias("id"),
                        F.lower(F.regexp_replace(F.concat_ws("", "genres"), " ", "")).alias("word")) \
        .filter(F.col("word") != "")
    tk = terms.select(F.xxhash64("kid", "term").alias("tk"), "query", "term")
    hits = SR.contains_join(tk.select(F.col("tk").alias("kid"), F.col("term").alias("key")),
                            gwords, SR.word_table(gwords))
    return (hits.join(tk.select(F.col("tk").alias("kid"), "query"), "kid")
            .select("query", F.col("id").alias("movie_id")).distinct())
