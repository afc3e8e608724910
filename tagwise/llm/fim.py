"""Fill-in-the-middle: a text cut at two line ends and put in another order.

The line ends of every whole text form a boundary set (``boundaries``); the two
cuts are drawn as numbers of lines, and two selects turn them into code point
offsets. Drawing, cutting and putting together are Spark expressions; only the
boundary sets are made in Arrow batches, from the text's bytes, and only three
numbers per row come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.llm.boundaries import line_ends

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7:"
RATE = 100          # per cent of the texts that are transformed
SPM_RATE = 50       # per cent of these with the suffix first
SLICE_BYTES = 8 << 20
CUTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "first", "second")])


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Stretches of about ``SLICE_BYTES``; a longer text is one of its own."""
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SLICE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def cut_lines(texts: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per text: its lines n, and the code point offsets behind ``a mod (n+1)``
    and ``b mod (n+1)`` lines, the smaller first."""
    out = np.zeros((len(texts), 3), np.int64)
    for begin, end in _slices(texts):
        ends = line_ends(texts[begin:end])
        n = ends.size
        units = np.stack([a[begin:end] % (n + 1), b[begin:end] % (n + 1)], axis=1)
        units.sort(axis=1)
        out[begin:end, 0] = n
        for k in range(2):
            some = np.flatnonzero(units[:, k])
            out[begin + some, k + 1] = ends.select(some, units[some, k] - 1)
    return out


@F.pandas_udf(CUTS)
def _cuts(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for text, a, b in parts:
        got = cut_lines([bytes(t) for t in text], a.to_numpy(np.int64), b.to_numpy(np.int64))
        yield pd.DataFrame({"n": got[:, 0], "first": got[:, 1], "second": got[:, 2]})


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits, as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` (all its columns, as they are) with one column ``fim``: a struct
    of n (lines), form, prefix_chars, middle_chars, output.

    Draws come from the sha256 of ``seed`` and the key (null: empty), so equal
    keys with equal texts get equal cuts. Null text counts as empty. An empty
    text, one that holds a marker, and those that ``rate`` leaves out stay
    ``plain`` with null lengths. A column ``fim`` of ``docs`` is replaced."""
    others = [c for c in docs.columns if c != "fim"]
    row = F.struct(*others) if others else F.struct(F.lit(None).alias("none"))
    base = docs.select(
        row.alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"),
        F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256).alias("h"))
    cut = base.withColumn("c", _cuts(F.col("t").cast("binary"), _draw(F.col("h"), 0), _draw(F.col("h"), 1)))
    marked = F.contains("t", F.lit(PREFIX)) | F.contains("t", F.lit(SUFFIX)) | F.contains("t", F.lit(MIDDLE))
    plain = (F.col("t") == "") | marked | (_draw(F.col("h"), 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_draw(F.col("h"), 3) % 100 < spm_rate, "spm").otherwise("psm")
    cut = cut.withColumn("form", form)
    piece = lambda begin, end: F.substring("t", (begin + 1).cast("int"), (end - begin).cast("int"))
    first, second, whole = F.col("c.first"), F.col("c.second"), F.length("t").cast("long")
    pre, mid, suf = piece(F.lit(0), first), piece(first, second), piece(second, whole)
    output = (F.when(F.col("form") == "plain", F.col("t"))
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), pre, F.lit(SUFFIX), suf, F.lit(MIDDLE), mid))
              .otherwise(F.concat(F.lit(SUFFIX), suf, F.lit(PREFIX), pre, F.lit(MIDDLE), mid)))
    cutted = F.col("form") != "plain"
    return cut.select(*[F.col("row").getField(c).alias(c) for c in others], F.struct(
        F.col("c.n").alias("n"), "form", F.when(cutted, first).alias("prefix_chars"),
        F.when(cutted, second - first).alias("middle_chars"), output.alias("output")).alias("fim"))


def restore(output: Column, form: Column) -> Column:
    """The exact text from ``output`` and ``form``. No marker is in a cut text,
    and none can arise across a seam, so each marker is found once."""
    psm = F.split(F.substr(output, F.lit(len(PREFIX) + 1)), f"{SUFFIX}|{MIDDLE}")      # prefix, suffix, middle
    spm = F.split(F.substr(output, F.lit(len(SUFFIX) + 1)), f"{PREFIX}|{MIDDLE}")      # suffix, prefix, middle
    return (F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
            .when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output))
