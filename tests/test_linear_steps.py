"""Steps whose shuffles must follow the rows, not the blocks or the copies of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwise.functions import text as tx
from tagwise.llm import ngram_join
from tagwise.operators import similarity as sim


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(t), float(rng.random())) for i in range(90) for t in rng.choice(40, 6, replace=False)]
    return spark.createDataFrame(rows, "id long, term_idx int, w double").cache()


def explained(df):
    return df._jdf.queryExecution().toString()


def test_pairs_of_blocks_are_not_shuffled(vectors):
    for cands in (sim.block_candidates(vectors, 5, block_rows=8),
                  sim.topk_for_rows(vectors, vectors.select("id"), 5, block_rows=8)):
        plan = explained(cands)
        assert "FlatMapGroups" not in plan and "sequence(" not in plan


def test_a_task_hands_on_k_candidates_per_row(vectors):
    got = sim.block_candidates(vectors.coalesce(1), 5, block_rows=8)
    n = got.where("kind = 'n'").count()
    tasks = got.rdd.getNumPartitions()
    assert n <= 2 * 90 * 5 * tasks and got.where("kind = 'm'").count() == 0


def test_equal_scores_go_to_the_smaller_id_across_blocks(spark):
    rows = [(i, 0, 1.0) for i in range(40)]
    v = spark.createDataFrame(rows, "id long, term_idx int, w double")
    got = sim.topk_neighbours(v, 3, block_rows=4).groupBy("id").agg(F.sort_array(F.collect_list("other_id")).alias("o")).collect()
    assert len(got) == 40 and all(r.o == [x for x in range(5) if x != r.id][:3] for r in got)


def test_vectors_count_terms_of_the_vocabulary_only(spark):
    docs = spark.createDataFrame([(i, f"alpha beta w{i} alpha") for i in range(12)], "id long, tags string")
    vocab, vec = sim.build_vectors(docs, "id", "tags", max_df=1.0)
    plan = explained(vec)
    assert plan.index("LeftSemi") < plan.index("InMemoryRelation")
    got = {r.term: (r.df, r.cf) for r in vocab.collect()}
    assert got["alpha"] == (12, 24) and got["alpha beta"] == (12, 12) and "w3" not in got
    assert vec.groupBy("id").agg(F.sum(F.col("w") * F.col("w")).alias("s")).where("abs(s - 1) > 1e-9").count() == 0


def test_bigrams_of_short_lists(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,)], "t array<string>")
    got = [r.x for r in df.select(tx.ngrams_1_2("t").alias("x")).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], [], None]


def test_shingles_are_packed_by_pieces(spark, monkeypatch):
    import pyarrow as pa
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    whole = list(ngram_join._blob_rows(5, 4)([batch]))
    monkeypatch.setattr(ngram_join, "PIECE", 50)
    pieces = list(ngram_join._blob_rows(5, 4)([batch]))
    assert len(whole) == 1 and len(pieces) > 3
    size = lambda bs: sum(len(x) for b in bs for x in b.column("tok").to_pylist())
    assert size(whole) == size(pieces)
