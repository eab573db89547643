"""The corpus pipeline: documents to token ids in five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotemill.llm import bpe, mixing, near_dedup, quality, suffix_dedup
from quotemill.llm.queries import tokenizer_path
from quotemill.llm.shared import land, read, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near-duplicates in the pipeline: word shingles of five, similarity in percent.
SIMILARITY = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the cascade reject go.

    A null or empty text fails the base. Repeated rows all stay or all go. Here and in the other stages null ids
    and sources are values like others, texts of any length are taken whole, columns may have
    any names and come back as they are, and an empty table gives no rows.
    """
    prepare(spark)
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least doc_id, null last.

    Of repeated rows of it one stays. Texts without words, null or empty, are all kept.
    """
    prepare(spark)
    return near_dedup.keep_one(docs, SIMILARITY)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start in several places go from all of them; the rows stay.

    Repeated rows lose all of a long enough text. A null text stays null; ``n_chars`` is made to fit.
    """
    prepare(spark)
    return suffix_dedup.clean_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once, twice or not at all, so that sources reach their targets.

    Repeated rows are drawn one by one. Null and empty texts have no words: they get the copies that are
    certain in their source.
    """
    prepare(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mix: a null or empty text has none."""
    prepare(spark)
    return bpe.encode_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("source mix", source_mix),
    ("byte-pair encoding", encode),
]

#: SQL can express neither the links of near-duplicates nor the draw of the mix.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
