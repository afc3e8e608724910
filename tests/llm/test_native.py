"""Sharding, mixing and chat formatting: their laws on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

from tagwise.llm import chat, mixing, sharding


def test_matrix_sums_and_spread():
    counts = np.array([0, 5, 17, 1000, 3])
    sums = np.zeros((5, 7))
    for seed in range(200):
        m = sharding.communication_matrix(counts, 7, seed)
        assert (m.sum(axis=1) == counts).all() and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1 and m.min() >= 0
        sums += m
    assert abs(sums[2, 0] / 200 - 17 / 7) < 0.5


def test_shards_are_even_and_gapless(docs, rows):
    got = sharding.shard(docs, n_shards=7, n_parts=5).collect()
    assert len(got) == len(rows) and sharding.shard(docs, 7, 5).columns == [*docs.columns, "shard", "slot"]
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(v) for v in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    again = sharding.shard(docs.repartition(4), n_shards=7, n_parts=5).collect()
    place = lambda x: Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in x)
    assert place(got) == place(again)


def test_sharding_of_empty_and_tiny_tables(empty, docs):
    assert sharding.shard(empty).collect() == []
    assert [(r["shard"], r["slot"]) for r in sharding.shard(docs.limit(1), 40).collect()] == [(0, 0)]


def targets(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] < level * w[s]]
        if not full:
            out.update({s: level * w[s] for s in open_})
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_targets_follow_the_weights(docs, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = targets(sizes)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 3
        rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["copies"] in (int(rate + 1e-9), int(rate + 1e-9) + 1)


def test_mix_comes_near_its_targets(spark):
    df = spark.createDataFrame([(i, "a b c d e " * (1 + i % 7), f"s{i % 5 if i % 3 else 0}") for i in range(6000)], "doc_id long, text string, source string")
    per = mixing.mixed(df).selectExpr("source", "size * copies AS taken", "target").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in per:
        assert abs(r["sum(taken)"] - r["max(target)"]) < 0.06 * r["max(target)"]
    out = mixing.emit(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["copies"] for r in mixing.mixed(df).collect())


def test_mixing_of_empty_and_wordless_tables(empty, docs):
    assert mixing.mixed(empty).collect() == [] and mixing.emit(empty).collect() == []
    assert mixing.emit(docs.where("text is null")).collect() == []


CONV = [(1, 0, "user", "hi"), (1, 1, "user", "again <|next|> \\ <\\| <|"), (1, 2, "assistant", "a<|end|>\n"), (1, 3, "assistant", "<"), (1, 4, "user", None),
        (2, 5, "assistant", "b"), (2, 1, "system", ""), (2, 1, None, "no role"), (None, 0, "assistant", "lost"), (3, None, "user", "late"),
        (3, 2, "assistant", "|<|turn|>\\"), (3, 2, "assistant", "|<|turn|>\\"), (4, 0, "a|<|text|>b", "x"), (4, 1, "assistant", "")]


def test_chat_reads_back(spark):
    df = spark.createDataFrame([(*r, "k", 1) for r in CONV], "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    f = chat.format_chat(df)
    got = f.select("conv_id", "n_turns", "formatted", "loss_spans", chat.read_turns(f.formatted).alias("t"), chat.loss_text(f.formatted, f.loss_spans).alias("l")).collect()
    by = defaultdict(list)
    for c, t, r, x in CONV:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    assert {r["conv_id"] for r in got} == set(by)
    for r in got:
        want = sorted(by[r["conv_id"]])
        assert [(t["role"], t["text"]) for t in r["t"]] == [w[1:] for w in want] and r["n_turns"] == len(want)
        assert r["l"] == "".join(w[2] for w in want if w[1] == "assistant")
        runs = 1 + sum(a[1] != b[1] for a, b in zip(want, want[1:]))
        assert r["formatted"].count(chat.TURN) == r["formatted"].count(chat.END) == runs
        masked = "".join(r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"])
        assert hashlib.sha256(masked.replace("<\\|", "<|").replace("\\\\", "\\").encode()).digest() == hashlib.sha256(r["l"].encode()).digest()


def test_chat_on_empty_table(spark):
    assert chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_no_python_in_native_plans(docs):
    for df in (mixing.emit(docs), sharding.shard(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_conversations_take_linear_time(spark):
    """Many turns, long runs of one role and no loss text at all."""
    import time

    from pyspark.sql import functions as F
    took = []
    for n in (1000, 12_000):
        roles = F.when(F.col("id") < n // 2, F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")).otherwise("user")
        df = spark.range(n).select((F.col("id") % 1).alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"),
                                   F.concat(F.lit("é<|text|>"), F.col("id").cast("string")).alias("text"))
        f = chat.format_chat(df).select("n_turns", chat.read_turns(F.col("formatted")).alias("turns"),
                                        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
        f.collect()
        begin = time.time()
        r = f.collect()[0]
        took.append(time.time() - begin)
        want = [("user" if i >= n // 2 or i % 3 == 0 else "assistant", f"é<|text|>{i}") for i in range(n)]
        assert [(x["role"], x["text"]) for x in r["turns"]] == want and r["n_turns"] == n
        assert r["loss"] == "".join(t for role, t in want if role == "assistant")
    assert took[1] < 5
    quiet = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    f = chat.format_chat(quiet)
    assert f.select(chat.loss_text(F.col("formatted"), F.col("loss_spans"))).first()[0] == ""
