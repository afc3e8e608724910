"""A Python worker of encode and decode keeps little: an executor holds one a core."""

import pickle
import tracemalloc
import weakref

import pyarrow as pa

from tagwise.llm import bpe
from tagwise.llm.queries import vocab_path


class Here:
    def __init__(self, obj):
        self.obj = obj

    def get(self):
        return self.obj


def batches(left, *columns):
    """Each batch must be free when the next one is asked for."""
    for column in columns:
        b = pa.RecordBatch.from_pydict(column)
        ref = weakref.ref(b)
        yield b
        del b
        left.append(ref() is not None)


def test_a_batch_is_free_before_the_next():
    left, vocab = [], bpe.Vocabulary(vocab_path())
    out = list(bpe._encode_rows(Here(vocab), ["doc_id"])(batches(left, *({"doc_id": [k], "text": [f"some text {k}"]} for k in range(3)))))
    assert left == [False] * 3 and sum(b.num_rows for b in out) == 3
    ids = [b.column("ids").to_pylist() for b in out]
    del out
    left.clear()
    out = list(bpe._decode_rows(Here(vocab.tokens), ["ids"])(batches(left, *({"ids": pa.array(x, pa.list_(pa.int32()))} for x in ids))))
    assert left == [False] * 3
    assert [b.column("decoded").to_pylist() for b in out] == [[f"some</w> text</w> {k}</w>"] for k in range(3)]


def test_what_is_shipped_is_small(spark, monkeypatch):
    sent = []

    class Sent(bpe.Shipped):
        def __init__(self, spark, obj):
            sent.append(len(pickle.dumps(obj)))
            super().__init__(spark, obj)
    monkeypatch.setattr(bpe, "Shipped", Sent)
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, vocab_path()), vocab_path()).collect()[0].decoded == "some</w> text</w>"
    assert sent[0] < 8e6 and sent[1] < 1e6          # the vocabulary; the tokens alone


def test_many_different_words_do_not_add_up():
    vocab = bpe.Vocabulary(vocab_path())
    texts = [" ".join(f"w{k * 2000 + i}" for i in range(2000)) for k in range(150)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in bpe._encode_rows(Here(vocab), ["doc_id"])(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts)
    assert peak < 64e6, peak


def test_remembered_words_take_little():
    vocab = bpe.Vocabulary(vocab_path())
    name = ["".join(chr(97 + k // 26 ** i % 26) for i in range(4)) for k in range(300_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(150)), "text": [" ".join(name[k:k + 2000]) for k in range(0, len(name), 2000)]})
    del name
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in bpe._encode_rows(Here(vocab), ["doc_id"])(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 150
    assert peak < 96e6, peak
