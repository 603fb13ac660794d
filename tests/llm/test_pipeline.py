"""The pipeline over the small tables, stage by stage."""

import corpus_pipeline
from helpers import awkward_texts, table

import __spark_entry__ as E

SF_SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "bpe"]


def test_run_keeps_the_columns_and_a_document_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert last.count() == docs.count() == last.select("doc_id").distinct().count() > 0.7 * before


def test_stages_take_awkward_tables(spark):
    docs = table(spark, awkward_texts())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() <= docs.count()
        assert stage(spark, docs.where("false"), SF_SMALL).count() == 0
