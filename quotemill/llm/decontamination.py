"""Benchmark decontamination by a prefix-filtered join of shingles, with DataFrame functions only.

A *window* is a run of words of a benchmark item, as long as asked for, or the whole of a
shorter item. Its shingles are its runs of three words (fewer, if it is shorter). A document
holds a window only if it holds all shingles of it, so it is enough to join the documents with
one of them, the *prefix*: the shingle that is rarest in the documents. A match says
where the window would start; it has to lie within the document (length and position), and
then each other shingle has to stand at its own place.

The documents are read once. Every place of theirs is tested against a bitmap of the
benchmark's shingles; what passes is joined with these, by text, and landed: that is all the
later joins read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotemill.llm.shared import has_bit, land, pack_slots

#: Fixed value of the contract: words of a window.
WINDOW = 10
SHINGLE = 3
#: Bits of the bitmap for each shingle, and at most: 8 MiB.
BITS, MAX_BITS = 256, 1 << 26

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value of the contract: all that is not part of a word, once letters are lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words with ASCII letters lowered; none for null."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, GAP), ""), F.array().cast("array<string>"))


def _run(words: str, start: Column, length: Column) -> Column:
    return F.slice(words, start, length)


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, window, length): the distinct windows of each item, words joined by a space."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    length = F.least(F.col("n"), F.lit(window))
    start = F.explode(F.sequence(F.lit(1), F.col("n") - length + 1)).alias("start")
    placed = items.select("item_id", "w", length.alias("length"), start)
    return placed.select("item_id", F.array_join(_run("w", F.col("start"), F.col("length")), " ").alias("window"), "length").distinct()


def shingles_of(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(window, length, size, at, shingle, h): the shingles of each distinct window, by their place in it."""
    size = F.least(F.col("length"), F.lit(shingle))
    once = windows.select("window", "length").distinct().withColumns({"w": F.split("window", " "), "size": size})
    placed = once.select("*", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("at"))
    run = _run("w", F.col("at"), F.col("size"))
    return placed.select("window", "length", "size", "at", F.array_join(run, " ").alias("shingle"), F.xxhash64(run).alias("h"))


def places_of(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """(key, n, at, shingle): one row at 0 for each document, with its number of words ``n``, and one
    for each place where a listed shingle (size, h) may start. Read in one pass."""
    # At most as many sizes as a shingle has words, and one count.
    sizes = sorted(r["size"] for r in listed.select("size").distinct().collect()) or [SHINGLE]
    bits = min(MAX_BITS, max(1 << 12, 1 << math.ceil(math.log2(max(1, listed.count()) * BITS))))
    slots = listed.select(F.pmod("h", F.lit(bits)).alias("slot"))
    bitmap = land(pack_slots(slots, bits), "bitmap").scalar()
    key = F.struct("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    rows = docs.select(key.alias("key"), words_of(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    placed = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("at"))
    if len(sizes) == 1:
        placed = placed.withColumn("size", F.lit(sizes[0]))
    else:
        placed = placed.select("*", F.explode(F.array(*(F.lit(s) for s in sizes))).alias("size"))
    run = _run("w", F.greatest("at", F.lit(1)), F.col("size"))
    fits = (F.col("at") > 0) & (F.col("at") + F.col("size") - 1 <= F.col("n"))
    may = fits & has_bit(bitmap, F.pmod(F.xxhash64(run), F.lit(bits)))
    document = (F.col("at") == 0) & (F.col("size") == sizes[0])
    return placed.where(document | may).select(
        "key", "n", "at", F.when(F.col("at") > 0, F.array_join(run, " ")).alias("shingle")
    )


def occurrences(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """(key, window, start, length): where windows stand in documents.

    ``hits`` holds every place (key, n, at, shingle) of every shingle, once.
    """
    rarity = hits.groupBy("shingle").agg(F.count("*").alias("n_hits"))
    ordered = shingles.join(rarity, "shingle", "left")
    rarest = F.min(F.struct(F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "at", "shingle")).alias("first")
    prefix = ordered.groupBy("window", "length", "size").agg(rarest).where("first.n_hits > 0")
    prefix = prefix.select("window", "length", "size", F.col("first.at").alias("offset"), "first.shingle")
    start = F.col("at") - F.col("offset") + 1
    candidates = hits.join(prefix, "shingle").select("key", "n", "window", "length", "size", start.alias("start"))
    candidates = candidates.where((F.col("start") > 0) & (F.col("start") + F.col("length") - 1 <= F.col("n")))
    # All shingles of the candidate, each at its own place.
    needed = candidates.join(shingles.select("window", "at", "shingle"), "window")
    needed = needed.withColumn("at", F.col("start") + F.col("at") - 1)
    there = needed.join(hits.select("key", "at", "shingle"), ["key", "at", "shingle"], "left_semi")
    found = there.groupBy("key", "window", "start", "length", "size").agg(F.count("*").alias("n_there"))
    return found.where(F.col("n_there") == F.col("length") - F.col("size") + 1).select("key", "window", "start", "length")


def words_hit(found: DataFrame) -> DataFrame:
    """(key, n_hit): words of each document inside any occurrence."""
    spans = found.groupBy("key", "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), "start")))
    return spans.select("key", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of ``docs``.

    A word is hit if it lies in a run of words that is a window of an item of ``benchmark`` (item_id, text);
    items_sha256 is taken of the ids of these items, sorted as texts, joined by commas. Null
    and empty texts have no words, on both sides; an item without words has no window. Items that share an id
    count once; one without an id hits words but is not listed. Rows that repeat a document
    get the same figures. Texts of any length are read whole; extra columns are ignored; an empty table of
    documents gives no rows, an empty benchmark no hits.
    """
    windows = land(windows_of(benchmark, window), "windows")
    shingles = land(shingles_of(windows, shingle), "shingles")
    listed = land(shingles.select("size", "shingle", "h").distinct(), "listed")
    places = land(places_of(docs.select("doc_id", "text"), listed.select("size", "h")), "places")
    # Rows that repeat a document give the same places.
    exact = places.where("at > 0").join(listed.select("shingle"), "shingle", "left_semi")
    hits = land(exact.select("key", "n", "at", "shingle").distinct(), "hits")
    found = land(occurrences(hits, shingles), "found")
    items = found.select("key", "window").distinct().join(windows.select("window", "item_id"), "window")
    items = items.select("key", F.col("item_id").cast("string").alias("item")).distinct().groupBy("key").agg(
        F.count("item").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")
    )
    rows = places.where("at = 0").select("key", F.col("n").cast("long").alias("n_words"))
    judged = rows.join(words_hit(found).join(items, "key"), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return judged.select(
        "key.doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
