"""The pipeline on the smallest tables: what each stage may and must do to its own input."""

from __future__ import annotations

import corpus_pipeline
from quotemill.llm import near_dedup, quality
from quotemill.scratch import land


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns
        counts.append(docs.count())
        if name == "quality rules":
            assert counts[-1] == quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("kept").count()
        if name == "near-duplicates":
            assert near_dedup.near_duplicates(docs, corpus_pipeline.SIMILARITY).where("not kept").count() == 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert counts[0] > counts[1] == counts[2] and encoded.count() == counts[3]
