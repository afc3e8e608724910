"""The pipeline's last stage holds one Python worker a task."""

import contextlib
import io

import corpus_pipeline


def test_encode_and_decode_are_two_jobs(spark):
    docs = spark.createDataFrame([(1, "en", "a", "some text, and more"), (2, None, None, None)], "doc_id long, lang string, source string, text string")
    out = io.StringIO()
    got = corpus_pipeline.encode(spark, docs, "")
    with contextlib.redirect_stdout(out):
        got.explain()
    assert out.getvalue().count("MapInArrow") == 1
    assert {r.doc_id: r.n_tokens == len(r.ids) for r in got.collect()} == {1: True, 2: True}
