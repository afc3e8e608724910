"""BPE against the tokenizers library."""

import random

from tokenizers import Tokenizer

from tagwise.llm import bpe
from tagwise.llm.queries import vocab_path

ODD = ["Hello  World's café, don't 12!! <|endoftext|> ok<|startoftext|>x ÄÖİ Σας ΟΔΟΣ   z q\x1c w", "日本語 é", "a\u0085b c é <|endoftext",
       "'sthe 'tis it'll''s !!!'s", "x" * 3000, "​　 zz ﻿", "ǅ Ⅷ ½ ①", "<|endoftext|><|endoftext|>", "é É ẞ", "\U0001f600 ok \U00010400"]


def test_equal_to_the_library(spark, docs, rows, words):
    rng = random.Random(2)
    texts = [r[1] for r in rows] + ODD + ["".join(rng.choice("abcdefgh'1é !") for _ in range(200)) for _ in range(60)]
    texts += [" ".join("".join(rng.sample(words, 3)) for _ in range(40)) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(texts)], "doc_id long, text string, decoded string").repartition(3)
    lib = Tokenizer.from_file(vocab_path())
    got = bpe.decode(bpe.encode(df, vocab_path()), vocab_path()).collect()
    assert len(got) == len(texts)
    for r in got:
        want = lib.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want, texts[r["doc_id"]]
        assert r["decoded"] == lib.decode(want, skip_special_tokens=False)


def test_small_memo_gives_the_same(words):
    from tokenizers import normalizers
    norm = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
    enc = bpe.Encoder(bpe.Vocabulary(vocab_path()), norm)
    lib, old = Tokenizer.from_file(vocab_path()), (bpe.MEMO_CHUNKS, bpe.MEMO_PAIRS)
    bpe.MEMO_CHUNKS = bpe.MEMO_PAIRS = 5
    try:
        for k in range(0, 60, 3):
            texts = [" ".join(words[k:k + 9]), "", "".join(words[k:k + 4])]
            ids, b = enc.encode(texts)
            assert [ids[b[i]:b[i + 1]].tolist() for i in range(3)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    finally:
        bpe.MEMO_CHUNKS, bpe.MEMO_PAIRS = old


def test_empty_table_and_null_ids(empty, spark):
    assert bpe.encode(empty, vocab_path(), tuple(empty.columns)).collect() == []
    r, = bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), vocab_path()).collect()
    assert (r["doc_id"], r["decoded"]) == (1, "")


def encoder():
    from tokenizers import normalizers
    norm = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
    return bpe.Encoder(bpe.Vocabulary(vocab_path()), norm)


def names(n):
    """Different words of letters only."""
    return ["".join(chr(97 + k // 26 ** i % 26) for i in range(4)) for k in range(n)]


def test_a_word_is_learned_once():
    """120 000 words, seen twice; a hundred thousand were too many to remember."""
    enc, seen = encoder(), []
    learn = enc.learn
    enc.learn = lambda *a: seen.append(1) or learn(*a)
    many = names(120_000)
    texts = [" ".join(many[k:k + 20_000]) for k in range(0, len(many), 20_000)]
    first = [enc.encode([t])[0].tolist() for t in texts]
    assert len(seen) == len(texts)
    assert [enc.encode([t])[0].tolist() for t in texts] == first
    assert len(seen) == len(texts)


def test_words_met_again_are_kept(monkeypatch):
    enc, lib = encoder(), Tokenizer.from_file(vocab_path())
    monkeypatch.setattr(bpe, "MEMO_CHUNKS", 40)
    many = names(400)
    for k in range(0, 400, 20):
        text = " ".join(["often", "met", *many[k:k + 20], "again"])
        assert enc.encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
        assert len(enc.raw_n) <= 40 + 23
        assert k < 20 or enc.again.sum() >= 3


def test_long_words_are_bounded_by_their_bytes(monkeypatch):
    enc, lib = encoder(), Tokenizer.from_file(vocab_path())
    monkeypatch.setattr(bpe, "MEMO_BYTES", 2000)
    for w in names(40):
        text = f"{w * 100} often"
        assert enc.encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
        assert len(enc.raw) + enc.ids.nbytes < 2000 + 5 * len(text)


def test_quotes_specials_and_bounds_against_the_library():
    rng = random.Random(7)
    parts = [*"'''strevlmda1 \n\t!.<|>", "é", "\u00a0", "\x85", "\x1c", "\u0307", "İ", "Σ", "日", "½", "\U00010400", "\0", "\u2003", "\u0301",
             *bpe.Vocabulary(vocab_path()).special, "<|ENDOFTEXT|>"]
    enc, lib = encoder(), Tokenizer.from_file(vocab_path())
    assert [x.tolist() for x in enc.encode(["", ""])] == [[], [0, 0, 0]]
    for _ in range(150):
        texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 3, 8, 40]))) for _ in range(rng.choice([1, 5, 20]))]
        ids, b = enc.encode(texts)
        for i, t in enumerate(texts):
            assert ids[b[i]:b[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids, t
