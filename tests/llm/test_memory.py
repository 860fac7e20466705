"""What the pipeline's Python workers hold."""

import corpus_pipeline
from muster.llm import op3_bpe, op7_decontaminate

SF = "/root/testdata/sf0.001"


def test_encoder_keeps_numbers_and_one_vocabulary():
    bpe = op3_bpe.TrieBpe(op3_bpe.vocabulary_path("word_bpe_49k.json"))
    ids = bpe.encode_words(["unbelievable", "unbelievably", "zqxj"])
    assert not hasattr(bpe, "library")  # its model is the vocabulary again
    assert bpe.pairs and all(type(k) is int for k in bpe.pairs)
    shared = {id(i) for i in bpe.ids}
    assert all(id(i) in shared for word in ids.values() for i in word)


def test_stages_hand_over_small_batches_and_need_no_pandas(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = op7_decontaminate.without_leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name != "line dedup":
                spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
                stage(spark, docs.limit(5), SF)
                assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == corpus_pipeline.ARROW_ROWS, name
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
