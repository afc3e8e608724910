"""Fixed values that results depend on.

FIXED VALUES: these literals must equal the behaviour being reproduced
(thresholds, vocabularies, lookup maps, buckets, alert rules). They are data,
kept together here in their natural order; operators take them as parameters.
"""

# ---- FIXED VALUES: text features ------------------------------------------
MAX_FEATURES = 7000
MIN_DF = 2
MAX_DF = 0.85
TOP_K = 20
TITLE_NEIGHBOURS = 9
RESULT_LIMIT = 10
FEATURE_WEIGHTS = {"overview": 1, "genres": 2, "keywords": 1, "cast": 2, "director": 3}
CAST_TOP_N = 5
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Spark's default English stop-word list (StopWordsRemover, 181 words).
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd "
    "you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't "
    "won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's "
    "let's ought that's there's what's when's where's who's why's would"
).split()

# ---- FIXED VALUES: query routing ------------------------------------------
GENRE_QUERIES = [
    "action", "adventure", "animation", "animated", "comedy", "crime",
    "documentary", "drama", "fantasy", "horror", "romance", "romantic",
    "scifi", "sci-fi", "science fiction", "superhero", "thriller",
    "war", "western", "mystery", "music", "history", "family",
]

GENRE_SEARCH_MAP = {
    "action": ["action"],
    "adventure": ["adventure"],
    "animation": ["animation"],
    "animated": ["animation"],
    "comedy": ["comedy"],
    "crime": ["crime"],
    "documentary": ["documentary"],
    "drama": ["drama"],
    "fantasy": ["fantasy"],
    "horror": ["horror"],
    "romance": ["romance"],
    "romantic": ["romance"],
    "scifi": ["science fiction", "sciencefiction"],
    "sci-fi": ["science fiction", "sciencefiction"],
    "science fiction": ["science fiction", "sciencefiction"],
    "superhero": ["action", "adventure"],
    "thriller": ["thriller"],
    "war": ["war"],
    "western": ["western"],
    "mystery": ["mystery"],
    "music": ["music"],
    "history": ["history"],
    "family": ["family"],
}

# Character -> squeezed actor name ("heathledger" spelt correctly, see README).
CHARACTER_TO_ACTOR = {
    "loki": "tomhiddleston",
    "iron man": "robertdowneyjr",
    "tony stark": "robertdowneyjr",
    "batman": "christianbale",
    "bruce wayne": "christianbale",
    "joker": "heathledger",
    "spider-man": "tobeymaguire",
    "spiderman": "tobeymaguire",
    "thor": "chrishemsworth",
    "captain america": "chrisevans",
    "black widow": "scarlettjohansson",
    "hermione": "emmawatson",
    "harry potter": "danielradcliffe",
    "jack sparrow": "johnnydepp",
    "james bond": "danielcraig",
    "katniss": "jenniferlawrence",
    "neo": "keanureeves",
    "forrest gump": "tomhanks",
    "wolverine": "hughjackman",
    "deadpool": "ryanreynolds",
    "gandalf": "ianmckellen",
}

FUZZY_CUTOFF = 0.6
PERSON_MIN_HITS = 3
PERSON_WORD_MIN_LEN = 4  # words longer than 3 characters

# ---- FIXED VALUES: data quality --------------------------------------------
MIN_ROWS = 4000
MISSING_HIGH_RATE = 0.10
IQR_FACTOR = 1.5
MOVIES_REQUIRED = ["id", "title", "overview", "genres", "keywords",
                   "vote_average", "vote_count", "popularity", "release_date"]
CREDITS_REQUIRED = ["movie_id", "title", "cast", "crew"]

# ---- FIXED VALUES: feedback, drift, promotion ------------------------------
MAX_LATENCY_MS = 200.0
MIN_FEEDBACK_FOR_DRIFT = 10
DRIFT_THRESHOLD_MEAN = 0.20
DRIFT_THRESHOLD_VARIANCE = 0.50
LOW_SUCCESS_RATE = 0.70
LOW_POSITIVE_RATE = 0.05
POSITIVE_RATE_MIN_TOTAL = 20
MIN_GENRE_MATCH = 0.60
EVAL_SAMPLE = 20
ABLATION_SAMPLE = 15
EVAL_NEIGHBOURS = 5
DRIFT_CHECK_EVERY = 10
ABLATION_FEATURES = ["overview", "genres", "keywords", "cast", "director"]

# Histogram buckets in seconds.
REQUEST_LATENCY_BUCKETS = [0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0]
METADATA_LATENCY_BUCKETS = [0.1, 0.5, 1.0, 2.0, 5.0]

# ---- FIXED VALUES: alert rules ---------------------------------------------
# (rule, signal, window_seconds, op, threshold, for_seconds, severity, team, reason)
ALERT_RULES = [
    ("HighErrorRate", "ratio_5xx", 300, ">", 0.05, 120, "critical", "backend", None),
    ("APIDown", "up_api", 0, "==", 0.0, 60, "critical", "backend", None),
    ("InferenceLatencyHigh", "last_latency_ms", 0, ">", 200.0, 120, "warning", "ml", None),
    ("InferenceLatencyCritical", "last_latency_ms", 0, ">", 500.0, 60, "critical", "ml", None),
    ("TooManyLatencyViolations", "increase_violations", 600, ">", 5.0, 300, "warning", "ml", None),
    ("NoRecommendationsServed", "rate_success", 600, "==", 0.0, 300, "warning", "backend", None),
    ("HighRecommendationFailureRate", "ratio_error", 300, ">", 0.10, 180, "warning", "backend", None),
    ("TMDBHighFailureRate", "ratio_metadata_error", 300, ">", 0.20, 180, "warning", "backend", None),
    ("TooManyActiveRequests", "active_requests", 0, ">", 50.0, 120, "warning", "backend", None),
    ("HighCPUWarning", "cpu_used_pct", 120, ">", 70.0, 300, "warning", "infrastructure", "high_cpu"),
    ("HighCPUCritical", "cpu_used_pct", 120, ">", 90.0, 180, "critical", "infrastructure", "high_cpu"),
    ("HighMemoryWarning", "memory_used_pct", 0, ">", 75.0, 300, "warning", "infrastructure", "high_memory"),
    ("HighMemoryCritical", "memory_used_pct", 0, ">", 90.0, 180, "critical", "infrastructure", "high_memory"),
    ("HighDiskUsage", "disk_used_pct", 0, ">", 80.0, 300, "warning", "infrastructure", "high_disk"),
    ("HighNetworkReceive", "rate_rx_bytes", 300, ">", 1e8, 300, "warning", "infrastructure", "high_network"),
    ("ModelNotReady", "model_not_ready", 0, "==", 1.0, 600, "warning", "ml", None),
    ("PrometheusDown", "up_monitor", 0, "==", 0.0, 60, "critical", "infrastructure", None),
    ("HighNotFoundRate", "ratio_not_found", 600, ">", 0.30, 300, "warning", "ml", "data_drift"),
    ("RecommendationQualityDrop", "ratio_success", 1800, "<", 0.70, 600, "warning", "ml", "data_drift"),
    ("ModelRetrainingRequired", "ratio_not_found", 3600, ">", 0.50, 900, "critical", "ml", "data_drift"),
    ("TMDBFallbackRateHigh", "ratio_fallback", 600, ">", 0.40, 300, "warning", "ml", "data_drift"),
    ("ErrorRateExceeds5Percent", "pct_4xx_5xx", 300, ">", 5.0, 120, "critical", "backend", None),
    ("InferenceP95LatencyHigh", "p95_latency_ms", 300, ">", 200.0, 180, "warning", "ml", None),
    ("ZeroThroughput", "rate_requests", 300, "==", 0.0, 180, "critical", "backend", None),
]

# metadata display (fixed values)
POSTER_PREFIX = "https://image.tmdb.org/t/p/w500"
POSTER_PLACEHOLDER = "https://via.placeholder.com/300x450?text=No+Image"
NO_DESCRIPTION = "No description available."
