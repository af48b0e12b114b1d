"""The pipeline's stages in order, each on what the one before kept."""

from quartermaster.llm.common import prepare, table

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import corpus_pipeline as p
    prepare(spark)
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for i, (name, stage) in enumerate(p.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        now = {r["doc_id"] for r in docs.collect()}
        if i < len(p.STAGES) - 1:
            assert docs.columns == columns and now < kept
        else:
            assert now == kept
        kept = now
    assert [n for n, _ in p.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]


def test_empty_documents(spark):
    import corpus_pipeline as p
    prepare(spark)
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, docs, SF).collect() == []
