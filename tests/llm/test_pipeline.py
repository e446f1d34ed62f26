from __future__ import annotations

import corpus_pipeline
from pubwatch.llm.queries import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_duplicates", "mixing", "byte_bpe"]
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).persist()
        assert out.columns == columns
        if name != "mixing":
            assert out.count() <= before
            assert out.exceptAll(docs).count() == 0
        else:
            assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        if name == "exact_dedup":
            texts = [r["text"] for r in out.collect()]
            assert len({t.lower() for t in texts}) == len(texts)
        docs, before = out, out.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == before
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    assert last.select("decoded_sha256").exceptAll(docs.select(digest)).count() == 0


def test_run_gives_the_same_rows_twice(spark):
    first, again = corpus_pipeline.run(spark, SF), corpus_pipeline.run(spark, SF)
    assert first.count() > 0
    assert first.exceptAll(again).count() == 0 and again.exceptAll(first).count() == 0
