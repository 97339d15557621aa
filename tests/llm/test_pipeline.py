"""The pipeline's rows against the stages applied one by one."""

from collections import Counter

import corpus_pipeline
from conftest import SF_DIR

from paperloom.llm import mixing, pieces, quality_classifier


def test_stages_compose(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == docs.columns
        if name == "n-gram Jaccard join":
            assert after.count() == after.select("doc_id").distinct().count() <= before.count()
        before = after
    want = Counter(r.doc_id for r in before.select("doc_id").collect())
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in rows) == want
    texts = {r.doc_id: r.text for r in before.collect()}
    codec = pieces.Codec.load()
    assert all(codec.decode(r.piece_ids) == texts[r.doc_id] and r.n_pieces == len(r.piece_ids) for r in rows)


def test_quality_stage_follows_the_scores(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    measured = quality_classifier.text_statistics(docs)
    model = quality_classifier.fit(measured, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    good = {r.doc_id for r in quality_classifier.scores(measured, model).filter("predicted = 1").collect()}
    assert {r.doc_id for r in corpus_pipeline.good_quality(spark, docs, SF_DIR).collect()} == good
    assert mixing.repeated(docs.limit(0)).count() == 0
