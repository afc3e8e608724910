"""Scalar string / array / JSON functions as native Column expressions.

Everything here stays inside whole-stage codegen: no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.functions.fixed import CAST_TOP_N, STOP_WORDS, TOKEN_PATTERN

# JSON element schema for genres / keywords / cast / crew columns.
NAME_JOB = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("job", T.StringType()),
]))

_WS = r"(?U)\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _objects(c) -> Column:
    """The objects of a JSON list; null for anything else (a lone object too)."""
    return F.from_json(F.when(F.ltrim(_c(c)).startswith("["), _c(c)), NAME_JOB)


def _named(arr, objects=lambda a: a) -> Column:
    """Names of the ``objects`` of a parsed list. The list is bound to a lambda's
    variable, so its text is parsed once however often the list is looked at."""
    def names(a):
        some = objects(a)
        bad = a.isNull() | F.exists(some, lambda x: x["name"].isNull())
        return F.when(bad, F.array().cast("array<string>")).otherwise(F.transform(some, lambda x: x["name"]))
    return F.element_at(F.transform(F.array(arr), names), 1)


def parse_names(c) -> Column:
    """JSON text -> list of ``name``; unparseable text, or any element without
    a name, gives an empty list (never null)."""
    return _named(_objects(c))


def parse_cast(c, top_n: int = CAST_TOP_N) -> Column:
    """First ``top_n`` names."""
    return _named(_objects(c), lambda a: F.slice(a, 1, top_n))


def parse_director(c) -> Column:
    """First element whose job is Director, as a one-element list."""
    arr = _objects(c)
    d = F.transform(F.slice(F.filter(arr, lambda x: x["job"] == "Director"), 1, 1),
                    lambda x: x["name"])
    return F.coalesce(F.filter(d, lambda n: n.isNotNull()), F.array().cast("array<string>"))


def clean_name(c) -> Column:
    """Delete all whitespace, lower case."""
    return F.lower(F.regexp_replace(_c(c), _WS, ""))


def clean_names(c) -> Column:
    return F.transform(_c(c), lambda x: clean_name(x))


def clean_text(c) -> Column:
    """Lower, trim, collapse whitespace runs to one space."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), _WS, " "))


def repeat_list(c, k: int) -> Column:
    return F.flatten(F.array_repeat(_c(c), k)) if k > 1 else _c(c)


def word_count(c) -> Column:
    """``len(s.split())``."""
    return F.size(F.filter(F.split(_c(c), _WS), lambda w: w != ""))


def char_length(c) -> Column:
    return F.char_length(_c(c))


def squeeze(c, hyphens: bool = True) -> Column:
    """Lower case with spaces (and hyphens) removed."""
    return F.translate(F.lower(_c(c)), " -" if hyphens else " ", "")


def _stop_regex(stop_words: list[str]) -> str:
    # Tokens are runs of word characters, so words with an apostrophe can
    # never equal a token and are left out of the pattern.
    words = [w for w in stop_words if all(ch.isalnum() or ch == "_" for ch in w)]
    return r"(?<![\p{L}\p{N}_])(?:" + "|".join(words) + r")(?![\p{L}\p{N}_])"


def tokenize(c, stop_words: list[str] | None = STOP_WORDS) -> Column:
    """Lower-cased tokens of >= 2 word characters with stop words removed
    (repeats kept). Stop words are blanked with one regex pass before the
    extraction, which equals filtering the token list but runs in the JVM
    regex engine instead of an interpreted lambda."""
    low = F.lower(_c(c))
    if stop_words:
        low = F.regexp_replace(low, _stop_regex(stop_words), " ")
    return F.regexp_extract_all(low, F.lit(TOKEN_PATTERN), 0)


def ngrams_1_2(toks) -> Column:
    """Unigrams followed by the bigrams of adjacent tokens."""
    t = _c(toks)
    n = F.greatest(F.size(t) - 1, F.lit(0))
    return F.concat(t, F.zip_with(F.slice(t, F.lit(1), n), F.slice(t, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))


def truncate_overview(c, n: int = 80, default: str = "No overview available.") -> Column:
    return F.coalesce(F.concat(F.substring(_c(c), 1, n), F.lit("...")), F.lit(default))


def percent_format(c) -> Column:
    return F.format_string("%.1f%%", _c(c) * 100)


def abs_rel_change(cur, base, floor_one: bool = False) -> Column:
    den = F.greatest(_c(base), F.lit(1.0)) if floor_one else _c(base)
    return F.abs(_c(cur) - _c(base)) / den


def version_string(ts) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def ratio_round(a, b, digits: int = 4) -> Column:
    """round(a / b, digits) half-up on the exact ratio of two non-negative
    integers (no binary floating-point tie artefacts); null when b = 0."""
    a, b = _c(a), _c(b)
    scale = 10 ** digits
    q = (a.cast("long") * (2 * scale) + b.cast("long")) / (b.cast("long") * 2)
    return F.when(b != 0, F.floor(q) / float(scale))
