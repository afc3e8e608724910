"""The pipeline's stages on the small tables, and what they promise."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
def test_stages_keep_columns_and_effects(spark):
    import corpus_pipeline as p
    from tagwise.llm.ngram_join import jaccard_components
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in p.STAGES:
        docs = p.cut_lineage(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != p.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert ids["mix"] <= ids["near_duplicates"] <= ids["language"] <= ids["quality"] and ids["encode"] == ids["mix"]
    comp = {r["doc_id"]: r["component_id"] for r in jaccard_components(kept["language"]).collect()}
    assert ids["near_duplicates"] == set(comp.values())
    assert kept["encode"].count() == kept["mix"].count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids["quality"] for i in good) >= 0.95 * len(good)


def test_queries_are_registered():
    import __spark_entry__ as e
    names = e.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in names if k.startswith("op") and k[2].isdigit()}
    assert "pipeline" in names
