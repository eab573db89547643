"""Phrase collocations by Toivonen's mining: a sample proposes, a full pass decides.

1. Phrases of one to four words that are frequent in a sample of the rows, at a lowered count,
   are *proposed*.
2. One pass over all rows counts the proposals and their negative border: phrases that are not
   proposed but whose two parts one word shorter are (all single words, to begin with).
3. A frequent phrase of the border is a *failure* of the sample. A frequent phrase that was not
   counted contains a failure, so one more pass counts every phrase that contains one, and
   with that the search is closed.

Passes count 64-bit keys: a task sorts the keys of many texts at once and sends one block of keys,
counts and witnesses to each of as many key ranges as the input's size asks for. A *witness* is a
row in which the phrase stands: a last pass takes the text of each frequent phrase from its
witness alone. One of F frequent phrases shares its key with one of D others once in 2^64 / (F D) times;
its count is then too high. Sets of keys go to the tasks as Bloom filters of at most ``MAX_BITS``:
what they let through wrongly is counted too, and falls out with the rare.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotemill.llm.shared import MIX, land, texts_of

#: Fixed values of the contract.
LONGEST, LEAST, KEEP_PERCENT, TOP, UNKNOWN = 4, 30, 80, 2000, "und"
#: One row in so many is in the sample, and how often it may miss a phrase that just is frequent.
SAMPLE, MISS = 4, 0.05
#: Bytes of text hashed at once, keys sorted at once, and keys of one range of keys.
BLOCK, SORTED, RANGE = 1 << 20, 1 << 21, 1 << 21
#: Bits of a filter, at most; bits for one key.
MAX_BITS, BITS = 1 << 27, 32

#: ASCII letters lowered, tabs to spaces, borders of pieces to newlines.
TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10
)
SPACE, BORDER = 32, 10
BASE = 0x5851F42D4C957F2D
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, size=256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def _powers_of(n: int) -> list[np.ndarray]:
    """Powers of ``BASE`` modulo 2^64, and their inverses, for ``n`` places at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * BLOCK)
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
        del _powers[:-2]
    return _powers


class Words:
    """The words of a block of text: where they are, their hashes, piece and language.

    ``skip`` words at the start were already there at the end of the block before.
    """

    def __init__(self, text: bytes, first: list[int], langs: list[str], rows: list[int], skip: int = 0) -> None:
        self.text, self.langs, self.skip = text, langs, skip
        b = np.frombuffer(text, dtype=np.uint8)
        border = b == BORDER
        gap = np.ones(len(b) + 2, dtype=np.int8)
        gap[1:-1] = border | (b == SPACE)
        edges = np.flatnonzero(np.diff(gap))
        self.starts, self.ends = edges[::2], edges[1::2]
        up, down = _powers_of(len(b))
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[b] * up[: len(b)], out=sums[1:])
        self.hashes = _mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self.piece = np.cumsum(border, dtype=np.int32)[self.starts]
        self.doc = np.searchsorted(first, self.starts, side="right") - 1
        names = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], dtype=np.uint64)
        self.lang = names[self.doc]
        self.row = np.array(rows, dtype=np.int64).astype(np.uint32)[self.doc]

    def keys(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length the key of the phrase that starts at each word, and whether it is one:
        within a piece, and ending after ``skip``."""
        n, out = len(self.hashes), []
        key = _mixed(self.hashes ^ self.lang)
        for size in range(1, LONGEST + 1):
            if size > 1:
                key = _mixed(key[:-1] * MIX + self.hashes[size - 1 :] + np.uint64(size))
            real = self.piece[: n - size + 1] == self.piece[size - 1 :]
            real[: max(0, self.skip - size + 1)] = False
            out.append((key, real))
            if not len(key):
                break
        return out + [(key, real)] * (LONGEST - len(out))

    def phrase(self, at: int, size: int) -> bytes:
        return b" ".join(self.text[self.starts[at] : self.ends[at + size - 1]].split())


def blocks(texts: list[bytes], langs: list[str], rows: list[int]) -> Iterator[Words]:
    """All words of the texts, in blocks. A text longer than a block is cut between words, and a
    block begins with the last words of the block before, for the phrases over the cut."""
    some, size = [], 0

    def made() -> Words:
        ends = np.cumsum([len(text) + 1 for text, _, _ in some])
        first = [0, *ends[:-1].tolist()]
        found = b"\n".join(text for text, _, _ in some).translate(TABLE)
        return Words(found, first, [lang for _, lang, _ in some], [row for _, _, row in some])

    for text, lang, row in zip(texts, langs, rows):
        if len(text) > BLOCK:
            yield from _cut(text.translate(TABLE), lang, row)
            continue
        if some and size + len(text) > BLOCK:
            yield made()
            some, size = [], 0
        some.append((text, lang, row))
        size += len(text) + 1
    if some:
        yield made()


def _cut(text: bytes, lang: str, row: int) -> Iterator[Words]:
    at, before = 0, []
    while at < len(text):
        end = min(at + BLOCK, len(text))
        if end < len(text):
            last = max(text.rfind(b" ", at + 1, end), text.rfind(b"\n", at + 1, end))
            if last < 0:
                nexts = [x for x in (text.find(b" ", end), text.find(b"\n", end)) if x >= 0]
                last = min(nexts, default=len(text))
            end = last
        block = b" ".join([*before, text[at:end]])
        yield Words(block, [0], [lang], [row], len(before))
        before = block.rpartition(b"\n")[2].rsplit(None, LONGEST - 1)[-(LONGEST - 1) :]
        at = end


def _blocks_of(batch: pa.RecordBatch) -> Iterator[Words]:
    return blocks(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist())


class Filter:
    """A Bloom filter of mixed 64-bit keys, made by Spark, held by every task."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.shift = words, np.uint64(64 - int(math.log2(64 * len(words))))

    @staticmethod
    def slots(keys: np.ndarray, shift: np.uint64) -> np.ndarray:
        return (keys[None, :] * ODD[:, None]) >> shift

    @classmethod
    def of(cls, keys: DataFrame) -> Filter:
        """Of the column key, or of keys with a row each. At most ``MAX_BITS`` bits are made, whatever the
        number of keys."""
        columns = ["key", "row"] if set(keys.columns) == {"key", "row"} else ["key"]
        bits = min(MAX_BITS, max(1 << 12, 1 << math.ceil(math.log2(max(1, keys.count()) * BITS))))
        shift = np.uint64(64 - int(math.log2(bits)))

        def run(batches):
            for batch in batches:
                made = batch.column(0).to_numpy().view(np.uint64)
                if len(columns) > 1:
                    made = _witness(made, batch.column(1).to_numpy())
                slots = cls.slots(made, shift).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slots >> np.uint64(6)).astype(np.int32)), pa.array(np.uint64(1) << (slots & np.uint64(63))).view(pa.int64())],
                    ["word", "bit"],
                )

        words = keys.select(*columns).mapInArrow(run, "word int, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
        found = words.toArrow()
        made = np.zeros(bits // 64, dtype=np.uint64)
        made[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(made)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.arange(len(keys))
        for odd in ODD:
            slot = (keys[found] * odd) >> self.shift
            bit = (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
            found = found[bit == 1]
        out = np.zeros(len(keys), dtype=bool)
        out[found] = True
        return out


_COUNTS = "range int, keys binary, counts binary, rows binary"


def _counted(keys: list[np.ndarray], rows: list[np.ndarray], ranges: int) -> pa.RecordBatch:
    """Sorted keys with their counts and a row of each, cut into ranges of keys."""
    found, first, counts = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
    columns = [found, counts.astype(np.uint32), np.concatenate(rows)[first]]
    at = [0]
    if ranges > 1:
        at = np.searchsorted(found, np.arange(ranges, dtype=np.uint64) << np.uint64(64 - int(math.log2(ranges))))
    at = [*at, len(found)]
    some = [i for i in range(ranges) if at[i] < at[i + 1]]
    cut = [pa.array([c[at[i] : at[i + 1]].tobytes() for i in some], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *cut], ["range", "keys", "counts", "rows"])


def _joined(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for c in table[column].chunks for x in c])


def frequent_keys(docs: DataFrame, wanted, ranges: int, least: int) -> DataFrame:
    """(key, f, row): keys that stand at least ``least`` times in ``docs`` (text, lang, row), of those that ``wanted``
    picks of a block, each with a row in which it stands."""

    def run(batches):
        keys, rows, n = [], [], 0
        for batch in batches:
            for words in _blocks_of(batch):
                for key, picked in wanted(words.keys()):
                    at = np.flatnonzero(picked)
                    keys.append(key[at])
                    rows.append(words.row[at])
                    n += len(at)
                if n >= SORTED:
                    yield _counted(keys, rows, ranges)
                    keys, rows, n = [], [], 0
        if n:
            yield _counted(keys, rows, ranges)

    def merge(table: pa.Table) -> pa.Table:
        keys, rows = _joined(table, "keys", np.uint64), _joined(table, "rows", np.uint32)
        order = np.argsort(keys)
        keys, counts = keys[order], _joined(table, "counts", np.uint32)[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        f = np.add.reduceat(counts, first)
        good = f >= least
        return pa.table({"key": keys[first][good].view(np.int64), "f": f[good], "row": rows[order][first][good].astype(np.int64)})

    counted = docs.select("text", "lang", "row").mapInArrow(run, _COUNTS)
    return counted.groupBy("range").applyInArrow(merge, "key long, f long, row long")


def _parts_in(proposed: Filter):
    """Picks the phrases whose two parts one word shorter are proposed; all single words."""

    def wanted(keys):
        inside = None
        for size, (key, real) in enumerate(keys, 1):
            good = real if inside is None else real & inside[:-1] & inside[1:]
            yield key, good
            inside = np.zeros(len(key), dtype=bool)
            if size < LONGEST:
                inside[good] = proposed.has(key[good])

    return wanted


def _containing(failures: Filter):
    """Picks the phrases of two words or more that contain a failure."""

    def wanted(keys):
        inside = None
        for key, real in keys:
            broken = failures.has(key)
            if inside is not None:
                broken |= inside[: len(key)] | inside[1 : len(key) + 1]
                yield key, real & broken
            inside = broken

    return wanted


def _pairs_in(pairs: Filter):
    """Picks the phrases of three words or more whose pairs are all frequent in the sample."""

    def wanted(keys):
        key, real = keys[1]
        inside = np.zeros(len(key), dtype=bool)
        inside[real] = pairs.has(key[real])
        for key, real in keys[2:]:
            inside = (inside[:-1] & inside[1:])[: len(key)]
            yield key, real & inside

    return wanted


def _witness(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return _mixed(keys ^ (rows.astype(np.uint64) * MIX))


def phrase_counts(docs: DataFrame, least: int = LEAST, sample: int = SAMPLE) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of one to four words that stand ``least`` times or more in
    a language, and a row of size 0 with the number of all words of each language.

    Rows whose text is null or has no words add nothing; a null language is ``und``. Repeated rows count
    each. Texts of any length are read in blocks; an empty table gives no rows.
    """
    spark = docs.sparkSession
    row = F.xxhash64("doc_id", "text")
    rows = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), row.alias("row"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    # A word takes some six bytes; half of all keys of a block are alike.
    ranges = 1 << max(0, math.ceil(math.log2(max(1, size / 6 / RANGE))))
    part = rows.where(F.pmod("row", F.lit(sample)) == 0)
    lowered = max(2, _lowered(least, sample))

    def given(keys: DataFrame):
        return spark.sparkContext.broadcast(Filter.of(keys))

    def passed(over: DataFrame, pick, count: int, label: str) -> DataFrame:
        return land(frequent_keys(over, pick, ranges, count), label)

    short = passed(part, lambda keys: keys[:2], lowered, "short")
    pairs = given(short)
    proposed = short.unionByName(passed(part, lambda keys: _pairs_in(pairs.value)(keys), lowered, "long"))
    held = given(proposed)
    frequent = passed(rows, lambda keys: _parts_in(held.value)(keys), least, "frequent")
    failures = land(frequent.join(proposed.select("key"), "key", "left_anti"), "failures")
    if not failures.isEmpty():
        broken = given(failures)
        more = passed(rows, lambda keys: _containing(broken.value)(keys), least, "more")
        frequent = land(frequent.unionByName(more.join(frequent.select("key"), "key", "left_anti")), "closed")
    witnesses = given(frequent.select(F.col("key"), F.col("row")))

    def texts(batches):
        for batch in batches:
            yield _texts(_blocks_of(batch), witnesses.value)

    found = rows.mapInArrow(texts, "lang string, phrase string, size int, key long, n long")
    words = found.where("size = 0").groupBy("lang").agg(F.sum("n").alias("f"))
    # A phrase comes from every row that is its witness: rows that are repeated, and by mistake of the filter.
    named = found.where("size > 0").groupBy("key").agg(F.min(F.struct("lang", "phrase", "size")).alias("p"))
    exact = frequent.join(named, "key").select("p.lang", "p.phrase", "p.size", "f")
    return exact.unionByName(words.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("size"), "f"))


def _lowered(least: int, sample: int) -> int:
    """The highest count that a phrase at ``least`` misses in the sample as rarely as ``MISS``."""
    p, below = 1 / sample, 0.0
    for k in range(least + 1):
        below += math.comb(least, k) * p**k * (1 - p) ** (least - k)
        if below > MISS:
            return k
    return least


def _texts(found: Iterator[Words], witnesses: Filter) -> pa.RecordBatch:
    """Texts and keys of the phrases whose witness a row is, once each, and the number of words by language."""
    named: dict[int, tuple[str, bytes, int]] = {}
    total: dict[str, int] = {}
    for words in found:
        for i, n in enumerate(np.bincount(words.doc[words.skip :], minlength=len(words.langs)).tolist()):
            total[words.langs[i]] = total.get(words.langs[i], 0) + n
        for size, (key, real) in enumerate(words.keys(), 1):
            at = np.flatnonzero(real)
            at = at[witnesses.has(_witness(key[at], words.row[at]))]
            keys, first = np.unique(key[at], return_index=True)
            for k, i in zip(keys.view(np.int64).tolist(), at[first].tolist()):
                if k not in named:
                    named[k] = (words.langs[words.doc[i]], words.phrase(i, size), size)
    langs, phrases, sizes = zip(*named.values()) if named else ((), (), ())
    total = {lang: n for lang, n in total.items() if n}
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*langs, *total], pa.string()),
            pa.array([*phrases, *(b"" for _ in total)], pa.binary()).cast(pa.string()),
            pa.array([*sizes, *(0 for _ in total)], pa.int32()),
            pa.array([*named, *(None for _ in total)], pa.int64()),
            pa.array([*(None for _ in named), *total.values()], pa.int64()),
        ],
        ["lang", "phrase", "size", "key", "n"],
    )


def collocations(
    docs: DataFrame, least: int = LEAST, keep_percent: int = KEEP_PERCENT, top: int = TOP, sample: int = SAMPLE
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best ``top`` phrases of each language.

    A phrase of two to four words that stands a >= ``least`` times is a candidate. Cut after k words it
    has score floor(2000000 a / (l + r)), with the counts l and r of the two parts; the lowest cut
    counts, of equal ones the first. A candidate inside a longer one that stands ``keep_percent`` percent
    as often or more is left out. Ranked by score and a, falling, then by phrase. n is the number of words
    of the language. Needs columns doc_id, text and lang, ignores others; null languages are ``und``, null and
    empty texts have no words, repeated rows count each, and an empty table gives no rows.
    """
    counts = land(phrase_counts(docs, least, sample), "phrases")
    phrases, wide = counts.where("size > 0"), "decimal(20,0)"
    candidates = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    words = F.split("phrase", " ")

    def text(start, length):
        return F.array_join(F.slice(words, start, length), " ")

    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("*", k).withColumns({"left": text(1, F.col("k")), "right": text(F.col("k") + 1, F.col("size") - F.col("k"))})
    part = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(f"(cast(a as {wide}) * 2000000) div (cast(l as {wide}) + cast(r as {wide}))")
    scored = cuts.join(part, ["lang", "left"]).join(rest, ["lang", "right"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("best"))
    # Every phrase of two words or more inside a longer candidate, with the most frequent such candidate.
    spans = [(start, length) for length in range(2, LONGEST) for start in range(1, LONGEST - length + 2)]
    inner = F.array(*(F.when((F.lit(s + n - 1) <= F.col("size")) & (F.lit(n) < F.col("size")), text(s, F.lit(n))) for s, n in spans))
    longer = candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("f"))
    around = longer.where("phrase is not null").groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    covered = F.expr(f"cast(f as {wide}) * 100 >= cast(best.a as {wide}) * {keep_percent}")
    kept = best.join(around, ["lang", "phrase"], "left").where(F.col("f").isNull() | ~covered)
    # The best of each part of a language first: a language's phrases are not ranked in one task.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    order = (F.desc("best.score"), F.desc("best.a"), "phrase")
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    few = parted.withColumn("place", place).where(F.col("place") <= top).drop("place", "part")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "best.a", "best.l", "best.r", "n", "best.score",
    )
