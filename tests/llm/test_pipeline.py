import pytest
from brute import brute_components, brute_simhash
from test_packing import check

import corpus_pipeline
from freightloom.llm import quality
from freightloom.llm.store import stored


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The table before the first stage and after each."""
    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf_dir), name))
    return frames


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "temperature_mixing", "lexical_packing"]
    assert all(f.schema == stages[0].schema for f in stages[:-1])


def test_rejected_documents_go(stages, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.quality_scores(stages[0], labels).where("predicted = 1").collect()}
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(good)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, brute_simhash(r.text)) for r in stages[1].collect()]
    first = [min(i for i, p in rows if p in group) for group in brute_components(sorted({p for _, p in rows}))]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(first)


def test_mixing_reads_every_document(stages):
    assert {r.doc_id for r in stages[3].collect()} == {r.doc_id for r in stages[2].collect()}


def test_packing_holds_every_id(stages):
    check(stages[4].collect(), [(r.doc_id, r.text) for r in stages[3].collect()])


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, stages[4].collect()))


def test_stages_on_odd_rows(odd_docs, no_docs, spark, tmp_path):
    spark.createDataFrame([(k, int(k % 2)) for k in range(12)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (odd_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), f"odd-{name}")
        assert (docs.count() > 0) == (start.count() > 0)
