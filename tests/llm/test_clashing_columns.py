"""Columns of the caller may have any name: every name that an operator makes for itself is tried."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from quotemill.llm import (
    bpe, collocations, decontamination, mixing, near_dedup, quality, sentence_spans, suffix_dedup, token_output, toxicity,
)
from quotemill.llm.queries import tokenizer_path
from quotemill.llm.shared import prepare

OWN = {"doc_id", "text", "lang", "source"}
FOLDER = Path(mixing.__file__).parent


def made_names():
    """Every lower-case word that the operators' code names in quotes: all columns they make are among these."""
    code = "".join(f.read_text() for f in FOLDER.glob("*.py"))
    return sorted(set(re.findall(r'"(_?[a-z][a-z_0-9]{0,16})"', code)) - OWN)


@pytest.fixture(scope="module")
def tables(spark):
    prepare(spark)
    rng = random.Random(4)
    words = ["alder", "birch", "cedar", "dogwood", "elm", "fir", "ginkgo", "hazel", "ivy", "juniper"]
    prose = [" ".join(rng.choice(words) + rng.choice(["", "s", "er"]) for _ in range(90)) + "." for _ in range(12)]
    texts = [*prose, prose[0], prose[1] + " end", None, "", prose[2] + "\n" + prose[3]]
    plain = spark.createDataFrame([(i, t, "en", f"s{i % 2}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    names = made_names()
    assert {"target", "whole", "chance", "_row", "_salt", "ranges", "kept", "row", "class", "text_key", "key"} <= set(names)
    return plain, plain.select("*", *(F.lit(f"own {n}").alias(n) for n in names))


def rows_of(df):
    return Counter(map(str, df.collect()))


OPERATORS = {
    "near": near_dedup.near_duplicates,
    "suffix": suffix_dedup.digests,
    "mix": mixing.mix,
    "bpe": lambda d: bpe.digests(d, tokenizer_path()),
    "tokens": lambda d: token_output.round_trip(d, tokenizer_path()),
    "sentences": sentence_spans.remove_repeats,
    "quality": quality.judge,
    "collocations": lambda d: collocations.collocations(d, least=3),
    "leaks": lambda d: decontamination.contamination(d, d.limit(3).select(F.col("doc_id").alias("item_id"), "text")),
    "toxicity": lambda d: toxicity.toxicity(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))).select("doc_id", "held_out"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_ignore_columns_of_any_name(tables, name):
    plain, wide = tables
    assert rows_of(OPERATORS[name](wide)) == rows_of(OPERATORS[name](plain))


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_columns_of_any_name(spark, sf_dir, tables, at):
    plain, wide = tables
    stage = corpus_pipeline.STAGES[at][1]
    got = stage(spark, wide, sf_dir)
    if at == len(corpus_pipeline.STAGES) - 1:
        assert rows_of(got) == rows_of(stage(spark, plain, sf_dir))
        return
    assert got.columns == wide.columns
    assert rows_of(got.select(*plain.columns)) == rows_of(stage(spark, plain, sf_dir))
    assert got.count() > 0
    for row in got.collect():
        assert all(row[n] == f"own {n}" for n in wide.columns if n not in (*OWN, "n_chars"))


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_take_awkward_rows_and_empty_tables(spark, sf_dir, tables, at):
    plain, _ = tables
    nulls = plain.select(*(F.lit(None).cast(t).alias(c) for c, t in plain.dtypes))
    odd = plain.unionAll(plain).unionAll(nulls.limit(3))
    name, stage = corpus_pipeline.STAGES[at]
    assert stage(spark, plain.limit(0), sf_dir).count() == 0
    got = stage(spark, odd, sf_dir).collect()
    if name == "near-duplicates":  # every text once, but for those without words
        assert Counter(r.text for r in got if r.text)[plain.first().text] == 1
        assert sum(not r.text for r in got) == 2 * 2 + 3
    if name in ("repeated strings", "byte-pair encoding"):
        assert len(got) == odd.count()
    if name == "quality rules":
        assert all(r.text for r in got) and set(Counter(map(str, got)).values()) == {2}


def test_repeated_rows_are_drawn_one_by_one(spark):
    prepare(spark)
    rows = [(1, "ten words " * 5, "a")] * 1000 + [(2, "ten words " * 5, None)] * 3 + [(None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mix(docs).collect()
    a = [r for r in got if r.source == "a"]
    assert abs(sum(r.taken for r in a) - a[0].target) <= 10 and len({r.copies for r in a if r.size}) == 2
    assert rows_of(mixing.mix(docs.repartition(3))) == rows_of(mixing.mix(docs))
    copies = mixing.mixed_documents(docs)
    assert copies.where("doc_id = 1").count() == sum(r.copies for r in a if r.size)
