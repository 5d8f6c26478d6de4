import corpus_pipeline
import __spark_entry__ as entry_points
from llm.test_classifiers import held_back_words
from llm.test_jaccard import shingles

SF = "/root/testdata/sf0.001"


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test")
        assert docs.columns == names
    sets = [s for s in (shingles(r["text"]) for r in docs.collect()) if s]
    assert len(sets) > 100
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}


def test_registered_queries():
    names = entry_points.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_toxic_documents_like_any_labelled_row(spark, tmp_path):
    docs, labels, asked = held_back_words(spark, rows=6100, late=100)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    assert kept & asked.keys() == {i for i, toxic in asked.items() if not toxic}
