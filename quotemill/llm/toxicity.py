"""Toxicity by a weighted finite-state grammar over clauses.

Three small transducers run over the words of a clause and are composed into one table:

* scope of negation: what stands after a negation in the clause is negated;
* reported speech: what stands after a verb of saying, or in quotation marks, is reported;
* target: a person who is addressed or spoken of makes the clause aim at somebody.

A lexicon transducer first rewrites a word as insult, threat, target, negation, report
or other. Insults (words, and stems written ``lowe*``) are learned from the training
labels with the odds that a document with them is toxic. A clause matches if it has an
insult or threat; its odds are those of its strongest word times the weights of the
states it is in. A document scores by its strongest clause, a little more by further ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.shared import land, map_batches, texts_of

#: Bound of the classifier: labelled documents it is fitted on.
MAX_TRAINING_ROWS = 20_000

#: An entry needs so many toxic training documents, such odds, and so much evidence (G squared)
#: that by chance FALSE_ENTRIES of all candidates would have it.
MIN_TOXIC_DOCS = 5
MIN_ODDS = 3.0
FALSE_ENTRIES = 1.0
STEMS = (4, 5, 6)

HELD_OUT_MOD = 5

CLASSES = {
    "threat": "kill murder hurt destroy stab shoot strangle töten umbringen verletzen tuer frapper matar golpear",
    "target": "you your yours he she they him her them du ihr dich euch sie tu vous toi te él ella tú usted vosotros",
    "negation": "not never no isn't aren't wasn't don't nicht nie kein keine pas jamais nunca jamás",
    "report": "said says called claimed wrote reported quoted sagte nannte schrieb dit appelé écrit dijo llamó escribió",
}
THREAT_ODDS = 0.5
#: Weights of the states: the odds of a clause are multiplied by them.
NEGATED, REPORTED, TARGETED = 0.5, 0.5, 2.0
TARGETED_THREAT = 6.0

CLAUSE = re.compile(r"[.!?;:,\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”«»„]")
QUOTES = frozenset("\"“”«»„")

#: Each transducer: {(state, class): next state}; a pair it does not name keeps the state.
NEGATION = {(0, "negation"): 1}
REPORT = {(0, "report"): 1, (0, "quote"): 1, (1, "quote"): 0}
TARGET = {(0, "target"): 1}


def compose(*machines: dict[tuple[int, str], int]) -> dict[tuple[tuple[int, ...], str], tuple[int, ...]]:
    """The machine whose state is the states of all ``machines`` that read the same classes."""
    out, todo = {}, [(0,) * len(machines)]
    seen = set(todo)
    while todo:
        state = todo.pop()
        for kind in {k for m in machines for _, k in m}:
            after = tuple(m.get((s, kind), s) for m, s in zip(machines, state))
            out[state, kind] = after
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return out


GRAMMAR = compose(NEGATION, REPORT, TARGET)
KINDS = {word: kind for kind, words in CLASSES.items() for word in words.split()}


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


def clauses(text: str) -> list[list[str]]:
    return [found for c in CLAUSE.split(text.lower()) if (found := TOKEN.findall(c))]


def word_odds(word: str, lexicon: dict[str, float]) -> float | None:
    best = max((lexicon[f] for f in features(word) if f in lexicon), default=None)
    if best is None and KINDS.get(word) == "threat":
        return THREAT_ODDS
    return best


def clause_odds(words: list[str], lexicon: dict[str, float], known: dict[str, float | None]) -> float:
    """Odds that the clause is toxic; 0 if nothing in it matches."""
    if not any(_odds(w, lexicon, known) for w in words):
        return 0.0
    state, best, threat = (0, 0, 0), 0.0, False
    for word in words:
        kind = "quote" if word in QUOTES else KINDS.get(word, "other")
        odds = _odds(word, lexicon, known)
        if odds:
            negated, reported, _ = state
            best = max(best, odds * (NEGATED if negated else 1) * (REPORTED if reported else 1))
            threat |= kind == "threat"
        state = GRAMMAR.get((state, kind), state)
    return best * ((TARGETED_THREAT if threat else TARGETED) if state[2] else 1)


def _odds(word: str, lexicon: dict[str, float], known: dict[str, float | None]) -> float | None:
    if word not in known:
        if len(known) > 200_000:
            known.clear()
        known[word] = word_odds(word, lexicon)
    return known[word]


def score(text: str, lexicon: dict[str, float], blank: float, known: dict[str, float | None]) -> float:
    """``blank`` is the probability of a document in which no clause matches."""
    odds = [o for c in clauses(text) if (o := clause_odds(c, lexicon, known))]
    if not odds:
        return blank
    p = max(odds) / (1 + max(odds))
    more = sum(o > 1 for o in odds) - 1
    return p + (1 - p) * more / (more + 10) if more > 0 else max(p, blank)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Text and label of at most ``max_rows`` labelled documents that are not held out.

    They are those with the smallest hashes of their ids, so a rerun takes the same. The
    ids are few enough to be broadcast. Null labels and ids are left out; a document with two
    labels counts as toxic.
    """
    usable = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    usable = usable.agg((F.max("toxic") > 0).alias("toxic")).where(~held_out(F.col("doc_id")))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MOD == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> tuple[dict[str, float], float]:
    """Lexicon (entry to odds) and the probability of a document without any match.

    Without toxic training rows the lexicon is empty. Candidates are all entries of enough
    toxic documents. Only those with the odds are collected.
    """
    rows = land(training_rows(docs, labels, max_rows), "toxic")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    if not n_toxic:
        return {}, 0.0
    candidates = land(_document_counts(rows).where(F.col("t") >= MIN_TOXIC_DOCS), "candidates")
    least = 2 * math.log(max(2, candidates.count()) / FALSE_ENTRIES)
    odds = (F.col("t") + 0.5) / (F.col("c") + 0.5)
    passing = candidates.withColumn("odds", odds).where(
        (F.col("odds") >= MIN_ODDS) & (F.col("t") * n_clean > F.col("c") * n_toxic)
        & (evidence(F.col("t"), n_toxic, F.col("c"), n_clean) >= least)
    )
    lexicon = {r["entry"]: r["odds"] for r in passing.select("entry", "odds").collect()}
    return lexicon, 0.5 / (1 + n_clean / max(1, n_toxic))


def evidence(t: Column, n_toxic: int, c: Column, n_clean: int) -> Column:
    """G squared of entry against label."""
    total, g = n_toxic + n_clean, F.lit(0.0)
    for n, seen in ((n_toxic, t), (n_clean, c)):
        for cell, column in ((seen, t + c), (n - seen, total - t - c)):
            g += F.when(cell > 0, cell * F.log(cell * total / (n * column))).otherwise(0.0)
    return 2 * g


def _document_counts(rows: DataFrame) -> DataFrame:
    """In how many toxic (t) and clean (c) documents each entry stands; counted per batch before the shuffle."""

    def make(batch: pa.RecordBatch) -> dict:
        counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()
        for toxic, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            counts[not toxic].update({f for w in set(TOKEN.findall(text.decode().lower())) for f in features(w)})
        entries = list(counts[0] | counts[1])
        t, c = (pa.array([n[e] for e in entries], pa.int64()) for n in counts)
        return {"entry": pa.array(entries, pa.string()), "t": t, "c": c}

    counted = map_batches(rows.select("toxic", "text"), "entry string, t long, c long", make)
    return counted.groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def score_documents(docs: DataFrame, lexicon: dict[str, float], blank: float) -> DataFrame:
    """doc_id, score and predicted of every row, from its whole text alone.

    A null or empty text has no clause and scores as any text without a match. Repeated
    rows and null ids stay; extra columns are ignored; an empty table gives no rows.
    """

    def make(batch: pa.RecordBatch) -> dict:
        known: dict[str, float | None] = {}
        scores = [score(t.decode(), lexicon, blank, known) for t in texts_of(batch.column(1))]
        return {
            "doc_id": batch.column(0), "score": pa.array(scores, pa.float64()),
            "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()),
        }

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return map_batches(chosen, "doc_id long, score double, predicted int", make)


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Learn from the labels that are not held out, then score every row."""
    lexicon, blank = learn(docs, labels, max_rows)
    scored = score_documents(docs, lexicon, blank)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
