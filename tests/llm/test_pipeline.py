import corpus_pipeline
from tellermill.llm.registry import ORACLES, QUERIES


def test_names():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)


def test_pipeline_packs_what_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
        assert kept.columns == docs.columns
        now = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert now < ids or now == ids
        docs, ids = kept, now
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
