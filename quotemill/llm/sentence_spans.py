"""Substring dedup by sliding sentence spans.

A span is a run of consecutive sentences: from each sentence on, and with ``tails`` also up to
each sentence, the shortest run of at least ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words.
Together they cover every longer run that repeats. Spans with equal words are joined
over all documents, and every sentence that a span other than its first occurrence covers is
removed. The first occurrence is the one with the smallest doc_id, text key and place.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.shared import MIX, land, map_batches, parts, row_key, texts_of, word_hashes

MIN_SENTENCES = 2
MIN_WORDS = 25
#: A longer sentence counts as several. Of every ``WINDOW`` consecutive words in it, a piece begins
#: at the one with the least hash (the last such), so equal passages are cut alike wherever they
#: stand: of a passage of 2 * WINDOW + MIN_WORDS words, a run of MIN_WORDS is cut out alike.
LONG_SENTENCE = 25
WINDOW = 12

SENTENCE = re.compile(rb"[^.!?\n]+[.!?\n]*[ \t-\r]*|[.!?\n]+[ \t-\r]*")
WORD = re.compile(rb"[^ \t-\r]+[ \t-\r]*")
SECOND = np.uint64(0xD6E8FEB86659FD93)


def sentences(text: bytes) -> list[bytes]:
    """The text cut into sentences with the separators after them; joined they are the text."""
    out = []
    for sentence in SENTENCE.findall(text):
        if len(sentence) < 2 * LONG_SENTENCE or len(sentence.split()) <= LONG_SENTENCE:
            out.append(sentence)
            continue
        words = WORD.findall(sentence)
        lead = sentence[: len(sentence) - sum(map(len, words))]
        words[0] = lead + words[0]
        cuts = [0, *_cuts(words), len(words)]
        out += [b"".join(words[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]
    return out


def _cuts(words: list[bytes]) -> list[int]:
    """Places of the words that begin a piece, after the first."""
    h = [xxhash.xxh3_64_intdigest(w.strip().lower()) for w in words]
    # The place in use stays until it leaves the window or a hash as small comes in: no arrays for a few dozen words.
    least, out = 0, []
    for i, x in enumerate(h):
        if least <= i - WINDOW:
            least = min(range(i, i - WINDOW, -1), key=h.__getitem__)
        elif x <= h[least]:
            least = i
        if i >= WINDOW - 1 and least > (out[-1] if out else 0):
            out.append(least)
    return out


def spans(texts: list[bytes], min_sentences: int, min_words: int, tails: bool = False) -> tuple[np.ndarray, ...]:
    """Owner (place in ``texts``), first sentence, sentences and two hashes of each span."""
    # Cuts are the same in lower case. Words are counted and joined, and then gone: kept as objects
    # for a whole slice they would be many times its text.
    n_words, joined, sizes = [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        cut = [sentence.split() for sentence in sentences(text.lower())]
        sizes[i] = len(cut)
        n_words += map(len, cut)
        joined += map(b" ".join, cut)
    owner = np.repeat(np.arange(len(texts)), sizes)
    # Sentences without words join no span of their own but stay in place.
    n_words = np.array(n_words, dtype=np.int64)
    flat, h = joined, word_hashes(joined)
    total = np.concatenate([[0], np.cumsum(n_words)])
    at = np.arange(len(flat))
    until = np.cumsum(sizes)[owner] if len(flat) else at
    since = until - sizes[owner] if len(flat) else at
    end = np.maximum(at + min_sentences, np.searchsorted(total, total[:-1] + min_words))
    good = (end <= until) & (n_words > 0)
    # The shortest run up to each sentence, where it is not the shortest from its own start too.
    first = np.minimum(at + 1 - min_sentences, np.searchsorted(total, total[1:] - min_words, side="right") - 1)
    tail = (first >= since) & (n_words > 0) & tails
    tail[tail] = (end[first[tail]] != at[tail] + 1) | ~good[first[tail]]
    at, end = np.concatenate([at[good], first[tail]]), np.concatenate([end[good], at[tail] + 1])
    owner = np.concatenate([owner[good], owner[tail]])
    hashes = []
    for base, salt in ((MIX, np.uint64(1)), (SECOND, np.uint64(3))):
        longest = int((end - at).max()) if len(at) else 0
        mixed = (h + salt) * base
        mixed ^= mixed >> np.uint64(29)
        x = np.zeros(len(at), dtype=np.uint64)
        for k in range(longest):  # runs are short: a few sentences
            live = at + k < end
            x[live] = x[live] * base + mixed[at[live] + k]
        hashes.append((x ^ (x >> np.uint64(32))).view(np.int64))
    first = at - (np.cumsum(sizes) - sizes)[owner] if len(at) else at
    return owner, first, end - at, *hashes


def repeated_spans(
    docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, tails: bool = False
) -> DataFrame:
    """doc_id, text key and the sentences (places from 0) of a document that repeat an earlier one."""
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key().alias("text_key"), "text")

    def make(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch.column(2))
        found = [[a + x[0], *x[1:]] for a, b in parts(texts) for x in [spans(texts[a:b], min_sentences, min_words, tails)]]
        owner, first, n, h1, h2 = (np.concatenate(x) for x in zip(*found))
        return {
            "doc_id": batch.column(0).take(pa.array(owner)), "text_key": batch.column(1).take(pa.array(owner)),
            "first": first.astype(np.int32), "n": n.astype(np.int32), "h1": h1, "h2": h2,
        }

    runs = map_batches(keyed, "doc_id long, text_key long, first int, n int, h1 long, h2 long", make)
    place = F.struct("doc_id", "text_key", "first")
    twice = (
        runs.groupBy("h1", "h2").agg(F.min(place).alias("origin"), F.max(place).alias("latest"))
        .where("origin <> latest").select("h1", "h2", "origin")
    )
    # Written first, so that the join has a shuffle of its own, which Spark splits at a common span.
    later = runs.join(land(twice, "twice"), ["h1", "h2"]).where(place != F.col("origin"))
    covered = later.select("doc_id", "text_key", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("at"))
    return covered.groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("removed"))


def remove_repeats(
    docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, tails: bool = False
) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed (whether any) and the remaining text of every row.

    Rows that share doc_id and text are one document, written twice: they get the same
    result. A null or empty text has no sentences and remains empty. Null ids are an id,
    the smallest. Extra columns are ignored. An empty table gives no rows. Without ``tails``
    the last sentences of a repeated run stay if the last run that fits ends before them.
    """
    removed = repeated_spans(docs, min_sentences, min_words, tails)
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key().alias("text_key"), "text")
    same = keyed["doc_id"].eqNullSafe(removed["doc_id"]) & (keyed["text_key"] == removed["text_key"])
    marked = keyed.join(removed, same, "left").select(keyed["doc_id"], "text", "removed")

    def make(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_sentences": [], "n_removed": [], "removed": [], "text": []}
        for text, gone in zip(texts_of(batch.column(1)), batch.column(2).to_pylist()):
            cut, gone = sentences(text), set(gone or ())
            out["n_sentences"].append(len(cut))
            out["n_removed"].append(len(gone))
            out["removed"].append(bool(gone))
            left = b"".join(s for i, s in enumerate(cut) if i not in gone) if gone else text
            out["text"].append(left.decode())
        return {"doc_id": batch.column(0), **out}

    return map_batches(marked, "doc_id long, n_sentences long, n_removed long, removed boolean, text string", make)
