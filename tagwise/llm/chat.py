"""Chat formatting as relational expressions (no Python in the plan).

Template: ``<|turn|>role<|text|>text<|next|>text<|end|>`` per run of adjacent
turns of one role; ``<|next|>`` keeps the seams of merged turns, so the exact
turns can be read back. Inside roles and texts ``\\`` becomes ``\\\\`` and
``<|`` becomes ``<\\|``: no marker can come from a text, and the two
replacements undo each other in reverse order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


CHUNK = 128


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _ends(sizes: Column) -> Column:
    """Running sums of an array of numbers: sums of chunks first, then inside
    the chunks, so no array is grown by one element per turn."""
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda x, y: x + y)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")),
                         lambda c: total(F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK))))
    before = F.aggregate(chunks, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return _let(before, lambda b: F.transform(sizes, lambda _, i: (
        F.get(b, F.floor(i / CHUNK).cast("int")) + total(F.slice(sizes, i - i % CHUNK + 1, i % CHUNK + 1)))))


def format_chat(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id, n_turns, formatted, loss_spans`` per conversation.

    ``loss_spans`` are (start, length) in code points of ``formatted``, one
    for each text of ``loss_role``. Turns are ordered by turn (null first),
    then role and text, so ties and repeated rows have one order. Null roles
    and texts count as empty; rows with a null conv_id form one conversation;
    other columns are ignored. Empty table: empty result. A conversation is
    one output row, so its turns meet in one task; nothing wider is gathered."""
    t = turns.select(F.col("conv_id"), F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    conv = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # merged runs: a turn opens one where the role before is another, and closes
    # one where the role behind is another; each turn only looks at its neighbours
    role = lambda i: F.get(F.col("ts"), i)["role"]
    seg = F.transform("ts", lambda x, i: F.struct(
        F.when((i > 0) & (role(i - 1) == x["role"]), F.lit(NEXT))
        .otherwise(F.concat(F.lit(TURN), escape(x["role"]), F.lit(TEXT))).alias("head"),
        escape(x["text"]).alias("body"),
        F.when((i < F.size("ts") - 1) & (role(i + 1) == x["role"]), F.lit("")).otherwise(F.lit(END)).alias("tail"),
        (x["role"] == F.lit(loss_role)).alias("loss")))
    conv = conv.select("conv_id", F.size("ts").cast("long").alias("n_turns"), seg.alias("seg"))
    sizes = F.transform("seg", lambda s: (F.length(s["head"]) + F.length(s["body"]) + F.length(s["tail"])).cast("long"))
    ends = _let(sizes, _ends)
    marked = _let(ends, lambda e: F.transform("seg", lambda s, i: F.struct(
        (F.get(e, i) - F.length(s["tail"]) - F.length(s["body"])).alias("start"),
        F.length(s["body"]).cast("long").alias("length"), s["loss"].alias("loss"))))
    spans = F.transform(F.filter(marked, lambda m: m["loss"]), lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length")))
    text = F.array_join(F.transform("seg", lambda s: F.concat(s["head"], s["body"], s["tail"])), "")
    return conv.select("conv_id", "n_turns", text.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    runs = F.filter(F.split(formatted, r"<\|turn\|>"), lambda x: x != "")
    texts = lambda parts: F.transform(
        F.split(F.regexp_replace(F.element_at(parts, 2), r"<\|end\|>$", ""), r"<\|next\|>", -1),
        lambda x: F.struct(unescape(F.element_at(parts, 1)).alias("role"), unescape(x).alias("text")))
    return F.flatten(F.transform(runs, lambda r: _let(F.split(r, r"<\|text\|>"), texts)))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. Spans are
    cut in chunks of neighbours from one piece of the text each, as finding a
    code point means counting from the beginning."""
    def cut(text, begin, length):
        return F.substring(text, (begin + 1).cast("int"), length.cast("int"))

    def chunk(b):
        first, last = b[0]["start"], F.element_at(b, -1)
        piece = cut(formatted, first, last["start"] + last["length"] - first)
        return _let(piece, lambda p: F.array_join(F.transform(b, lambda s: unescape(cut(p, s["start"] - first, s["length"]))), ""))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int")),
                         lambda c: _let(F.slice(spans, c * CHUNK + 1, F.lit(CHUNK)), chunk))
    return F.when(F.size(spans) > 0, F.array_join(chunks, "")).otherwise("")
