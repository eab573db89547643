"""Quality rules as a short-circuit cascade: the rule that rejects most per cost goes first."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.shared import MIX, let_go, parts, texts_of, word_hashes

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

NOT_STARTS = bytes(range(0x80, 0xC0))
LETTER = re.compile(rb"[A-Za-z\x80-\xff]").search

#: Rows on which cost and selectivity are estimated; the order of rules never changes a verdict.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Text:
    """A text with the base figures every rule may use."""

    raw: bytes
    words: list[bytes]
    n_words: int
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int


def too_many_symbols(t: Text) -> bool:
    return 10 * t.n_symbols > t.n_words


def odd_word_length(t: Text) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 15 * t.n_words


def repeated_lines(t: Text) -> bool:
    return 10 * t.n_dup_lines > 3 * t.n_lines


def mostly_digits(t: Text) -> bool:
    digits = len(t.raw) - len(t.raw.translate(None, b"0123456789"))
    return 100 * digits > 30 * t.word_chars


def letterless_words(t: Text) -> bool:
    return 100 * sum(not LETTER(w) for w in t.words) > 20 * t.n_words


RULES: dict[str, Callable[[Text], bool]] = {
    f.__name__: f
    for f in (too_many_symbols, odd_word_length, repeated_lines, mostly_digits, letterless_words)
}


def repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text, how many words lie in a three-word window that the text holds at least twice."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    total = int(sizes.sum())
    covered = np.zeros(total, dtype=bool)
    if total >= 3:
        h = word_hashes([w for ws in words for w in ws])
        inside = owner[:-2] == owner[2:]
        window = ((h[:-2] * MIX + h[1:-1]) * MIX + h[2:]) * MIX
        window ^= (owner[:-2].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        at = np.flatnonzero(inside)
        order = at[np.argsort(window[at], kind="stable")]
        same = window[order[1:]] == window[order[:-1]]
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        starts = order[twice]
        for k in range(3):
            covered[starts + k] = True
    return np.bincount(owner[covered], minlength=len(words))


def measured(texts: list[bytes]) -> Iterator[tuple[Text, int]]:
    for a, b in parts(texts):
        words = [t.split() for t in texts[a:b]]
        for raw, ws, n_repeat in zip(texts[a:b], words, repeat_words(words).tolist()):
            lines = [x for x in raw.split(b"\n") if x.strip()]
            yield Text(
                raw, ws, len(ws),
                len(raw.translate(None, NOT_STARTS + SPACES)),
                len(raw) - len(raw.translate(None, SYMBOLS)),
                len(lines), len(lines) - len(set(lines)),
            ), n_repeat


def base_failed(t: Text, n_repeat: int) -> bool:
    return t.n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PCT * t.n_words


def rule_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second, most first, estimated on at most ``sample_rows`` rows.

    One task runs every rule on the sample and returns one row per rule. A rule
    without rejections goes by its cost alone, after all that reject. The empty
    sample gives the order of ``RULES``.
    """

    def probe(batches):
        spent, hits = dict.fromkeys(RULES, 1e-9), dict.fromkeys(RULES, 0)
        for batch in batches:
            for text, n_repeat in measured(texts_of(batch.column(0))):
                if base_failed(text, n_repeat):
                    continue
                for name, rule in RULES.items():
                    began = time.perf_counter()
                    hits[name] += rule(text)
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pylist(
            [{"rule": r, "hits": hits[r], "seconds": spent[r]} for r in RULES]
        )

    rows = (
        docs.select("text").limit(sample_rows).coalesce(1)
        .mapInArrow(probe, "rule string, hits long, seconds double").collect()
    )
    place = {name: i for i, name in enumerate(RULES)}
    best = {r.rule: (-r.hits / r.seconds, r.seconds, place[r.rule]) for r in rows}
    return sorted(RULES, key=lambda name: best.get(name, (0, 0, place[name])))


def passes(text: Text, order: list[str]) -> str | None:
    """The first rule that rejects, or None. Rules after it are not run."""
    return next((name for name in order if RULES[name](text)), None)


RESULT = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
]
RESULT_TYPES = ", ".join(f"{c} {'boolean' if c in RESULT[-2:] else 'long'}" for c in RESULT)


def judge(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Base figures and verdict of every row of ``docs`` (columns doc_id and text; others are ignored).

    Words are runs of anything but ASCII white space. A null text is empty, so it
    fails the base. Each row is judged by itself: repeated rows and null ids
    change nothing; an empty table gives no rows.
    """
    order = order or rule_order(docs)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for t, n_repeat in measured(texts_of(batch.column(1))):
                failed = base_failed(t, n_repeat)
                kept = not failed and passes(t, order) is None
                rows.append(
                    (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, n_repeat, failed, kept)
                )
            columns = [batch.column(0), *(pa.array(c) for c in zip(*rows))]
            yield pa.RecordBatch.from_arrays(columns, RESULT)

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, RESULT_TYPES)


def filter_documents(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns unchanged, whatever their names.

    Only texts go to Python, and verdicts come back. A null or empty text fails the base, so its row goes;
    of repeated rows all stay or none; a text of any length is judged whole; an empty table gives no rows.
    """
    order = order or rule_order(docs)

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        let_go(__name__)
        found = measured(texts_of(texts))
        return pa.array([not base_failed(t, n) and passes(t, order) is None for t, n in found], pa.bool_())

    return docs.where(kept(F.col("text")))
