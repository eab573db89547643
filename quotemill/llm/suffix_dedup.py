"""Suffix dedup: bytes covered by a string of ``LENGTH`` bytes that starts anywhere else too.

The difference-cover idea, with a cover that content chooses: of the places in a window the
one with the least gram hash is sampled, so two equal strings hold a sampled suffix at
the same offset, whatever place in their documents they have. In the steps of the method:

1. *Sort sampled suffixes, coarse.* A wide window samples few suffixes, named by their first
   ``COARSE`` bytes. Sorted by name, a name that occurs once starts no repeat; its windows go.
2. *Recurse on names.* In what is left a narrow window samples again. A suffix is named by the
   names of the 8-byte blocks of all that its windows share, and sorted by name.
3. *Merge the remaining suffixes.* A suffix that is not sampled is the few bytes up to the
   next sampled one and that one's suffix: it is placed by these bytes, the sampled name and
   the bytes after it.
4. *Compare adjacent prefixes.* Suffixes that agree in ``LENGTH`` bytes stand side by side.

Names are 128-bit hashes, so the order of the names is that of the hashes: equal
prefixes are adjacent in any order. Nothing beyond ``LENGTH`` bytes is ever compared,
so two levels are enough. The sort is by shuffled partitions; a name with very many
suffixes is counted by its windows instead, which Spark adds up before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.shared import MIX, IdBitmap, as_binary, land, map_batches, texts_of, whole_row

LENGTH = 200
#: Sampled suffixes are named by so many bytes; the window takes the rest of LENGTH.
COARSE = 64
#: The narrow window, and the gram that chooses in it.
WINDOW, GRAM = 32, 16
#: Suffixes of one name that a task compares by itself.
HOT = 100_000
#: Bytes of text that are handled at once.
STEP = 1 << 18

Piece = tuple[int, int, bytes]


def pieces(texts: list[tuple[int, bytes, list[tuple[int, int]]]], length: int) -> Iterator[list[Piece]]:
    """(key, offset, bytes) of the ranges of windows, in lists of some ``STEP`` bytes.

    A window belongs to one piece, which holds all its bytes; long ranges are cut.
    """
    out: list[Piece] = []
    size = 0
    for key, text, ranges in texts:
        for low, high in ranges:
            for at in range(low, min(high, len(text) - length + 1), STEP):
                end = min(at + STEP, high)
                out.append((key, at, text[at : end + length - 1]))
                size += len(out[-1][2])
                if size >= STEP:
                    yield out
                    out, size = [], 0
    if out:
        yield out


class Block:
    """Pieces side by side, with eight bytes from every place on as one number."""

    def __init__(self, some: list[Piece], length: int) -> None:
        sizes = np.array([len(p[2]) for p in some], dtype=np.int64)
        raw = b"".join(p[2] for p in some) + bytes(length + 64)
        self.bytes = np.frombuffer(raw, dtype=np.uint8)
        self.words = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=(1,)).copy()
        self.total = int(sizes.sum())
        self.start = np.cumsum(sizes) - sizes
        #: Places where a whole window of the piece starts.
        flags = np.zeros(self.total + 1, dtype=np.int32)
        good = sizes >= length
        flags[self.start[good]] += 1
        flags[(self.start + sizes)[good] - length + 1] -= 1
        self.windows = np.flatnonzero(np.cumsum(flags)[: self.total])
        self.keys = np.array([p[0] for p in some], dtype=np.int64)
        self.offset = np.array([p[1] for p in some], dtype=np.int64)

    def piece_of(self, at: np.ndarray) -> np.ndarray:
        # Not a function kept by the block: that would be a cycle, and blocks would pile up until a collection.
        return np.searchsorted(self.start, at, side="right") - 1

    def name(self, at: np.ndarray | slice, n: int, salt: int) -> np.ndarray:
        """Name of the ``n`` bytes from each place on, by the names of their blocks of 8."""
        x = np.uint64(salt)
        for k in [*range(0, n - 7, 8), *([n - 8] if n % 8 else [])]:
            block = self.words[at.start + k : at.stop + k] if isinstance(at, slice) else self.words[at + k]
            x = (x ^ block) * MIX
            x ^= x >> np.uint64(29)
        return x

    def sampled(self, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one sampled place: first window, last window, the place.

        The place has the least hash among the first ``width`` places of a window, the last
        of equal ones: a matter of the window's bytes alone.
        """
        hashes = self.name(slice(0, self.total + width), gram, 11)
        place = np.arange(len(hashes), dtype=np.uint64)
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - place)
        have = 1
        while have * 2 <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: have - width], least[width - have :])
        at = self.windows
        if not len(at):
            return at, at, at
        chosen = (np.uint64(0xFFFFFFFF) - (least[at] & np.uint64(0xFFFFFFFF))).astype(np.int64)
        first = np.ones(len(at), dtype=bool)
        first[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        last = np.append(first[1:], True)
        return at[first], at[last], chosen[first]


def _distinct(docs: DataFrame, make, schema: str, extra: str | None = None) -> DataFrame:
    """``make`` over the texts of a task, of equal texts once. ``docs``: text_key, text and, if
    ``extra`` names it, the ranges of windows to look at."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ranges = batch.column(2).to_pylist() if extra else None
            some = []
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), texts_of(batch.column(1)))):
                if key not in seen:
                    seen.add(key)
                    some.append((key, text, merged(ranges[i]) if extra else [(0, len(text))]))
            for group in pieces(some, LENGTH):
                found = make(Block(group, LENGTH))
                yield pa.RecordBatch.from_arrays([pa.array(found[n]) for n in names], names)

    return docs.mapInArrow(run, schema)


def merged(ranges: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _coarse(block: Block) -> dict:
    first, last, at = block.sampled(LENGTH - COARSE + 1, COARSE)
    piece = block.piece_of(first)
    shift = block.offset[piece] - block.start[piece]
    return {
        "name": block.name(at, COARSE, 21).view(np.int64), "text_key": block.keys[piece],
        "low": (first + shift).astype(np.int32), "high": (last + shift + 1).astype(np.int32),
    }


def _fine(block: Block) -> dict:
    """Runs of windows with the names of their sampled suffixes and the bytes around what is named."""
    first, last, at = block.sampled(WINDOW, GRAM)
    piece = block.piece_of(first)
    shift = block.offset[piece] - block.start[piece]
    shared, side = LENGTH - WINDOW + 1, WINDOW - 1
    padded = np.concatenate([np.zeros(side, dtype=np.uint8), block.bytes])
    before = padded[at[:, None] + np.arange(side)]
    after = block.bytes[at[:, None] + np.arange(shared, LENGTH)]
    return {
        "n1": block.name(at, shared, 31).view(np.int64), "n2": block.name(at, shared, 47).view(np.int64),
        "text_key": block.keys[piece], "at": (at + shift).astype(np.int32),
        "least": (at - last).astype(np.int8), "most": (at - first).astype(np.int8),
        "around": as_binary(np.hstack([before, after])),
    }


FINE = "n1 long, n2 long, text_key long, at int, least byte, most byte, around binary"


def _window_keys(n1: np.ndarray, n2: np.ndarray, around: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each number of bytes before the sampled suffix: hashes of the windows of all rows."""
    side = WINDOW - 1
    after = np.zeros((side + 1, len(n1)), dtype=np.uint64)
    for k in range(side):
        after[k + 1] = (after[k] ^ (around[:, side + k].astype(np.uint64) + np.uint64(1))) * MIX
        after[k + 1] ^= after[k + 1] >> np.uint64(31)
    x = n1.view(np.uint64) ^ (n2.view(np.uint64) * MIX)
    for n in range(side + 1):
        if n:
            x = (x ^ (around[:, side - n].astype(np.uint64) + np.uint64(257))) * MIX
            x = x ^ (x >> np.uint64(29))
        y = (x ^ (after[side - n] * np.uint64(0xD6E8FEB86659FD93))) * MIX
        yield n, y ^ (y >> np.uint64(32))


def _columns(table: pa.Table) -> list[np.ndarray]:
    plain = [table[c].to_numpy() for c in ("n1", "n2", "text_key", "at", "least", "most")]
    around = np.frombuffer(b"".join(table["around"].to_pylist()), dtype=np.uint8)
    return [*plain, around.reshape(table.num_rows, -1)]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by name: covered bytes of each run of windows, from adjacent equal windows."""

    def covered(table: pa.Table) -> pa.RecordBatch:
        n1, n2, key, at, least, most, around = _columns(table)
        same = (n1[1:] == n1[:-1]) & (n2[1:] == n2[:-1])
        shared = np.append(same, False) | np.insert(same, 0, False)
        n1, n2, key, at, least, most, around = (x[shared] for x in (n1, n2, key, at, least, most, around))
        low, high = np.full(len(n1), WINDOW), np.full(len(n1), -1)
        for n, x in _window_keys(n1, n2, around):
            rows = np.flatnonzero((least <= n) & (n <= most))
            order = rows[np.argsort(x[rows], kind="stable")]
            equal = x[order[1:]] == x[order[:-1]]
            twice = order[np.append(equal, False) | np.insert(equal, 0, False)] if len(order) else order
            low[twice] = np.minimum(low[twice], n)
            high[twice] = n
        hit = high >= 0
        start, end = at[hit] - high[hit], at[hit] - low[hit] + LENGTH
        return pa.RecordBatch.from_arrays(
            [pa.array(key[hit]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            ["text_key", "low", "high"],
        )

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < 50_000:
            continue
        table = pa.Table.from_batches(held)
        n1, n2 = table["n1"].to_numpy(), table["n2"].to_numpy()
        cut = rows - int(((n1 == n1[-1]) & (n2 == n2[-1])).sum())  # the last name may go on
        if cut:
            yield covered(table.slice(0, cut))
        held = table.slice(cut).to_batches()
        rows -= cut
    if rows:
        yield covered(pa.Table.from_batches(held))


def _hot_windows(rows: DataFrame) -> DataFrame:
    """Covered bytes of runs whose names are too common for one task: their windows are counted."""

    def make(batch: pa.RecordBatch) -> dict:
        n1, n2, key, at, least, most, around = _columns(pa.Table.from_batches([batch]))
        other = _window_keys(n2, n1, around)
        out: dict[str, list] = {"w1": [], "w2": [], "text_key": [], "at": []}
        for (n, x), (_, y) in zip(_window_keys(n1, n2, around), other):
            good = (least <= n) & (n <= most)
            for name, values in (("w1", x.view(np.int64)), ("w2", y.view(np.int64)), ("text_key", key), ("at", at - n)):
                out[name].append(values[good])
        return {k: np.concatenate(v) for k, v in out.items()}

    windows = map_batches(rows, "w1 long, w2 long, text_key long, at int", make)
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    return windows.join(twice, ["w1", "w2"]).select("text_key", F.col("at").alias("low"), (F.col("at") + LENGTH).alias("high"))


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """By text key: the byte ranges that repeat elsewhere, and the texts that have copies.

    ``docs`` has text_key and text. A text with a copy repeats as a whole; apart from
    that, equal texts of a task are looked at once. Neither is written: who uses them twice has to.
    """
    copies = docs.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").select("text_key")
    long_enough = docs.where(F.octet_length("text") >= LENGTH)
    coarse = land(_distinct(long_enough, _coarse, "name long, text_key long, low int, high int"), "coarse")
    twice = coarse.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    ranges = land(
        coarse.join(twice, "name").groupBy("text_key").agg(F.collect_set(F.struct("low", "high")).alias("ranges")), "ranges"
    )
    maybe = IdBitmap(F.col("text_key"), ranges).has(F.col("text_key"))
    zones = long_enough.where(maybe).join(ranges, "text_key").select("text_key", "text", "ranges")
    fine = land(_distinct(zones, _fine, FINE, "ranges"), "fine")
    hot = fine.groupBy("n1", "n2").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("n1", "n2")
    hot = land(hot, "hot")
    cool = fine.join(hot, ["n1", "n2"], "left_anti").select(*fine.columns)
    sorted_names = cool.repartition("n1", "n2").sortWithinPartitions("n1", "n2")
    found = sorted_names.mapInArrow(_compare, "text_key long, low int, high int")
    if not hot.isEmpty():
        found = found.unionByName(_hot_windows(fine.join(hot, ["n1", "n2"]).select(*fine.columns)))
    return found.groupBy("text_key").agg(F.collect_list(F.struct("low", "high")).alias("ranges")), copies


def _marked(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``ranges`` to remove and whether it is ``copied``.

    A bitmap over the texts to change keeps nearly all others out of the shuffle that brings texts
    and ranges together.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found, copies = repeats(docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")))
    marks = found.join(copies.withColumn("copied", F.lit(True)), "text_key", "full")
    marks = land(marks.select("text_key", "ranges", F.coalesce("copied", F.lit(False)).alias("copied")), "marks")
    keyed = docs.select(whole_row(docs).alias("row"), F.xxhash64(text).alias("text_key"))
    maybe = IdBitmap(F.col("text_key"), marks).has(F.col("text_key"))
    none = F.lit(None).cast(marks.schema["ranges"].dataType)
    clean = keyed.where(~maybe).select("row", none.alias("ranges"), F.lit(False).alias("copied"))
    touched = keyed.where(maybe).join(marks, "text_key", "left")
    return clean.unionByName(touched.select("row", "ranges", F.coalesce("copied", F.lit(False)).alias("copied")))


def _cut(texts: list[bytes], ranges: list, copied: list[bool]) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Maximal removed runs, and the bytes that are kept, of each text."""
    for text, some, whole in zip(texts, ranges, copied):
        gone = [(0, len(text))] if whole and len(text) >= LENGTH else merged(some or [])
        ends = [0, *(x for span in gone for x in span), len(text)]
        yield gone, b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))


def _figures(docs: DataFrame, last: str, kind: pa.DataType, view) -> DataFrame:
    def make(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch.column(1))
        out: dict[str, list] = {"n_removed": [], "n_spans": [], last: []}
        for gone, kept in _cut(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            out["n_removed"].append(sum(b - a for a, b in gone))
            out["n_spans"].append(len(gone))
            out[last].append(view(kept))
        return {
            "doc_id": batch.column(0), "n_bytes": pa.array(map(len, texts), pa.int64()),
            "n_removed": pa.array(out["n_removed"], pa.int64()), "n_spans": pa.array(out["n_spans"], pa.int64()),
            last: pa.array(out[last], kind),
        }

    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} {kind}"
    marked = _marked(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"))
    return map_batches(marked.select("row.doc_id", "row.text", "ranges", "copied"), schema, make)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes of every row.

    A text is its UTF-8 bytes, a null text is empty. Every byte that lies in a string of
    ``LENGTH`` bytes which also starts somewhere else, in this or another row, is removed:
    repeated rows go altogether if they are long enough. Null ids stay; extra columns are
    ignored; an empty table gives no rows. What is kept may end amid a character.
    """
    return _figures(docs, "kept", pa.binary(), lambda kept: kept)


def digests(docs: DataFrame) -> DataFrame:
    """As ``remove_repeats``, with the SHA-256 of the kept bytes in place of them.

    It is taken where the texts are cut: a second Python step would double the workers.
    """
    return _figures(docs, "kept_sha256", pa.string(), lambda kept: hashlib.sha256(kept).hexdigest())


def clean_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the remaining text, and ``n_chars`` to fit, if they have that column.

    Bytes of a character that a removed run cuts through go too. A row of which nothing
    remains stays, with an empty text; a null text stays null. Repeated rows are treated alike, texts of
    any length whole. Columns may have any names; an empty table gives no rows.
    """
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = columns.index("text")
            found = _cut(texts_of(batch.column(at)), *(batch.column(len(columns) + k).to_pylist() for k in (0, 1)))
            texts = [kept.decode("utf-8", "ignore") for _, kept in found]
            null = batch.column(at).is_null().to_pylist()
            texts = [None if gone else t for t, gone in zip(texts, null)]
            out = {c: batch.column(i) for i, c in enumerate(columns)}
            out["text"] = pa.array(texts, pa.string())
            if "n_chars" in out:
                sizes = [None if t is None else len(t) for t in texts]
                out["n_chars"] = pa.array(sizes, pa.int64()).cast(out["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(out.values()), columns)

    marked = _marked(docs).select("row.*", "ranges", "copied")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    return marked.toDF(*(f"c{i}" for i in range(len(columns) + 2))).mapInArrow(run, schema)
