"""Helpers the operators share: tables, Arrow batches of texts, stable hashes, id bitmaps."""

from __future__ import annotations

import gc
import math
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.scratch import land

__all__ = [
    "MIX", "Chunks", "IdBitmap", "as_binary", "cuts_letters", "has_bit", "hold", "land", "let_go", "letters_and_marks", "map_batches",
    "pack_slots", "parts", "prepare", "read", "row_key", "texts_of", "whole_row", "word_hashes",
]

MIX = np.uint64(0x9E3779B97F4A7C15)
MAX_BITMAP_BITS = 1 << 26
#: Rows of an Arrow batch, unless the session names another number than Spark's default.
BATCH_ROWS = 1000


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once for each application, and keep Arrow
    batches of texts small: a batch is held several times over, by the JVM and by Python."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    # The driver serves the archive from its own disk as long as the application runs.
    archive = Path(tempfile.mkdtemp(prefix=package.name), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key() -> Column:
    """Tells apart rows that share a doc_id but not a text; equal rows share it."""
    return F.xxhash64(F.col("text").isNull(), F.col("text"))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def parts(texts: list[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Slices of a batch of at most ``limit`` bytes, or of one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def as_binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a two-dimensional array."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(rows), [None, offsets.buffers()[1], pa.py_buffer(rows.tobytes())]
    )


#: ASCII marks but the apostrophe, which some letters after it join.
MARKS = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
NORMAL = ["NFC", "Replace", "Lowercase"]
CUT = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_letters(tokenizer: dict) -> bool:
    """Whether a tokenizer (its file's content) lower-cases and makes words of letters and of marks apart,
    so that both parts of ``letters_and_marks`` are encoded as if alone."""
    normal = [x["type"] for x in (tokenizer["normalizer"] or {}).get("normalizers", [])]
    steps = (tokenizer["pre_tokenizer"] or {}).get("pretokenizers", [])
    if normal != NORMAL or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return False
    split, spelt = steps
    *joined, letters, digits, marks = split["pattern"].get("Regex", "").split("|")
    cut = split["invert"] and split["behavior"] == "Removed" and not spelt["use_regex"] and not spelt["add_prefix_space"]
    return cut and "|".join([letters, digits, marks]) == CUT and all(x.startswith("'") for x in joined)


def letters_and_marks(chunk: bytes) -> tuple[bytes, bytes] | None:
    """A chunk of Latin letters and marks after them, if any: the letters in lower case, and the marks.

    These letters are the same in every normal form and never part of a longer symbol with a mark.
    """
    letters = chunk.rstrip(MARKS)
    if letters.isalpha():
        return letters.lower(), chunk[len(letters) :]
    text = letters.decode()
    return (text.lower().encode(), chunk[len(letters) :]) if LATIN(text) else None


class Chunks(dict[bytes, int]):
    """Numbers chunks of texts as they first come. What is known of a chunk is found in lists by its
    number, so a word of a text is looked up by its bytes only once. ``new`` are the chunks since it was emptied."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number

    def parted(self) -> tuple[list[bytes], list[bytes], list[tuple[int, int, int]]]:
        """The new chunks by how they are learned: words of letters, others, and by numbers those made
        of letters and marks (-1: none) that are chunks as well, numbered here where they are new."""
        words, others, made = [], [], []
        for number, chunk in enumerate(self.new, len(self) - len(self.new)):  # letters and marks are appended meanwhile
            cut = letters_and_marks(chunk)
            if not cut:
                others.append(chunk)
            elif cut[0] == chunk:
                words.append(chunk)
            else:
                made.append((number, self[cut[0]], self[cut[1]] if cut[1] else -1))
        return words, others, made

    def keep(self, runs: list[list[int]], *known: list) -> list[list[int]]:
        """Forget all chunks but those of ``runs``, also in the lists ``known``; ``runs`` by the new numbers."""
        kept = sorted(set().union(*runs))
        names = list(self)
        self.clear()
        self.update((names[i], k) for k, i in enumerate(kept))
        for values in known:
            values[:] = [values[i] for i in kept]
        moved = {i: k for k, i in enumerate(kept)}
        return [[moved[i] for i in run] for run in runs]


_held: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """``release`` frees what the module ``owner`` keeps in this Python worker from task to task."""
    _held[owner] = release


def let_go(user: str) -> None:
    """Free what modules other than ``user`` keep: Spark gives a worker to the stages of all operators."""
    others = [owner for owner in _held if owner != user]
    for owner in others:
        _held.pop(owner)()
    if others:
        gc.collect()


def map_batches(
    df: DataFrame, schema: T.StructType | str, make: Callable[[pa.RecordBatch], dict]
) -> DataFrame:
    """``make`` turns a batch into the output columns by name; empty batches are skipped."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(make.__module__)
        for batch in batches:
            if batch.num_rows:
                columns = make(batch)
                yield pa.RecordBatch.from_arrays(
                    [_array(columns[f.name]) for f in kind.fields], [f.name for f in kind.fields]
                )

    return df.mapInArrow(run, kind)


def _array(values) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        return values.combine_chunks()
    return values if isinstance(values, pa.Array) else pa.array(values)


class IdBitmap:
    """A filter over hashed ids that every task holds: what is not in it is not among the ids.

    Its size follows the number of ids up to ``MAX_BITMAP_BITS`` (8 MiB, enough for four million); with more,
    more others pass it, and what follows has to tell them apart anyway.
    """

    def __init__(self, ids: Column, rows: DataFrame) -> None:
        n = rows.count()
        self.bits = min(MAX_BITMAP_BITS, max(1 << 16, 1 << math.ceil(math.log2(max(1, 16 * n)))))
        slots = rows.select(F.pmod(F.xxhash64(ids), F.lit(self.bits)).alias("slot"))
        self.words = land(pack_slots(slots, self.bits), "bitmap").scalar()

    def has(self, ids: Column) -> Column:
        return has_bit(self.words, F.pmod(F.xxhash64(ids), F.lit(self.bits)))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct: names made beside it cannot clash with theirs. ``row.*`` gives them back."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))


def pack_slots(slots: DataFrame, bits: int) -> DataFrame:
    """Numbers of bits, in rows, to one row with the array of all ``bits`` / 64 words."""
    spark = slots.sparkSession
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    marked = slots.select(F.shiftright("slot", 6).alias("word"), bit.alias("bit"))
    blank = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = marked.groupBy("word").agg(F.bit_or("bit").alias("bit"))
    words = words.unionByName(blank).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    packed = F.array_sort(F.collect_list(F.struct("word", "bit")))
    return words.agg(F.transform(packed, lambda x: x["bit"]).alias("words"))


def has_bit(words: Column, slot: Column) -> Column:
    word = F.get(words, F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1
