"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotemill.llm import (
    bpe, collocations, decontamination, mixing, near_dedup, neighbours, quality, sentence_spans, suffix_dedup,
    token_output, toxicity, url_filter, whitening,
)
from quotemill.llm.shared import read, prepare

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return read(spark, sf_dir, name)


def op1_url_filter(spark, sf_dir):
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op2_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(_table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_neighbours(spark, sf_dir):
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op6_bpe(spark, sf_dir):
    return bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_sentence_spans(spark, sf_dir):
    return sentence_spans.remove_repeats(_table(spark, sf_dir, "documents"), tails=True)


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_token_output(spark, sf_dir):
    return token_output.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_decontamination(spark, sf_dir):
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark, sf_dir):
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_near_dedup, op3_suffix_dedup, op4_mixing, op5_neighbours, op6_bpe,
        op7_sentence_spans, op8_toxicity, op9_token_output, op10_quality,
        op11_collocations, op12_decontamination, op13_whitening,
    )
}
