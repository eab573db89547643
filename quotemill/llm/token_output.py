"""Token ids on disk: bit planes of fixed-size id blocks, each plane compressed by itself.

A *chunk* holds the ids of whole documents, some 256k ids or one longer document. Its
ids are cut into blocks of ``BLOCK`` ids. The bits (or bytes) of equal weight of a
block form a plane; a plane is compressed with zstandard. The chunk index stores where
each plane begins, the documents of the chunk and their numbers of ids, so one document
is read by decompressing the blocks that hold it.

Chunks are rows of a table in a folder that all executors share, written with Spark's
commit protocol: a lost task leaves nothing behind. The columns without ``payload`` are
the index, and reading them does not touch the planes.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from quotemill.llm.shared import Chunks, cuts_letters, map_batches, parts, texts_of
from quotemill.scratch import scratch_path

BLOCK = 1 << 16
CHUNK_IDS = 1 << 18
MAX_WORDS = 500_000
#: Chunks that the library encodes in one text.
JOINED = 1000
END_ID = 1

#: Bits of an id, and bits that a plane takes from it.
ID_BITS = 32
PLANE_BITS = {"bit": 1, "byte": 8}
#: Byte planes take an eighth of the work of bit planes.
PLANE = "byte"

CHUNK = (
    "part long, chunk long, n_ids long, doc_ids array<long>, n_tokens array<long>,"
    " plane_ends array<long>, payload binary"
)


@functools.cache
def pack_ids(n: int) -> struct.Struct:
    return struct.Struct(f"<{n}I")


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit integers.

    No rule of the tokenizer looks across ASCII white space, which gets no id, so the
    library encodes each distinct chunk between white space once. If the tokenizer's words are
    either letters or marks, chunks that differ in case or in marks at their end share their letters' ids.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = sorted(self.library.get_added_tokens_decoder().items())
        plain = ((x.content.encode(), i) for i, x in added if not (x.normalized or x.lstrip or x.rstrip or x.single_word))
        self.between = next(plain, None)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        suffix = content["model"].get("end_of_word_suffix")
        self.apart = bool(suffix) and cuts_letters(content)
        #: By id, whether a word ends with it.
        self.ends = np.zeros(1 + max(self.library.get_vocab().values()), dtype=bool)
        if self.apart:
            self.ends[[i for token, i in content["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.chunks = Chunks()
        #: Ids of each chunk by its number.
        self.known: list[bytes] = []

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        chunks, known = self.chunks, self.known
        for a, b in parts(texts):
            runs = [list(map(chunks.__getitem__, t.split())) for t in texts[a:b]]
            if chunks.new:
                self._learn()
            if len(chunks) > MAX_WORDS:
                runs = chunks.keep(runs, known)
            for run in runs:
                yield b"".join(map(known.__getitem__, run))

    def _learn(self) -> None:
        chunks, known = self.chunks, self.known
        words, others, made = chunks.parted() if self.apart else ([], chunks.new, [])
        known.extend([b""] * (len(chunks) - len(known)))
        self._learn_alone(others + self._learn_words(words))
        for number, letters, marks in made:
            known[number] = known[letters] + known[marks] if marks >= 0 else known[letters]
        chunks.new = []

    def _learn_words(self, words: list[bytes]) -> list[bytes]:
        """Encode words of letters, many in one text with spaces between them: each ends where an id
        ends a word. Returns words that are not learned, as some of their text did not become such ids."""
        left = []
        for k in range(0, len(words), JOINED):
            group = words[k : k + JOINED]
            ids = np.array(self.library.encode_batch_fast([b" ".join(group).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
            at = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(at) != len(group):
                left += group
                continue
            flat = ids.tobytes()
            for word, a, b in zip(group, [0, *at], at):
                self.known[self.chunks[word]] = flat[a:b]
        return left

    def _learn_alone(self, chunks: list[bytes]) -> None:
        """Encode many chunks in one text, with an added token between them.

        The library cuts a text at such a token before anything else, so the chunks are encoded
        as if alone; one result for all costs less than one for each. A chunk that
        spells the token, and all chunks if the tokenizer has none, are encoded alone.
        """
        alone = chunks
        if self.between:
            mark, mark_id = self.between
            alone = [c for c in chunks if mark in c]
            if alone:
                chunks = [c for c in chunks if mark not in c]
            for k in range(0, len(chunks), JOINED):
                group = chunks[k : k + JOINED]
                joined = (mark + mark.join(group) + mark).decode()
                ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
                at = (np.flatnonzero(ids == mark_id) * 4).tolist()
                flat = ids.tobytes()
                for chunk, a, b in zip(group, at, at[1:]):
                    self.known[self.chunks[chunk]] = flat[a + 4 : b]
        for chunk in alone:
            ids = self.library.encode(chunk.decode(), add_special_tokens=False).ids
            self.known[self.chunks[chunk]] = pack_ids(len(ids)).pack(*ids)


_encoders: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]


def to_planes(ids: np.ndarray, plane: str = PLANE) -> list[bytes]:
    """The planes of one block, lowest bits first."""
    octets = ids.astype("<u4").view(np.uint8).reshape(len(ids), ID_BITS // 8)
    if plane == "byte":
        return [column.tobytes() for column in octets.T]
    bits = np.unpackbits(np.ascontiguousarray(octets.T), axis=1, bitorder="little")
    # One row per byte of an id; a byte's eight bits of consecutive ids are interleaved.
    bits = bits.reshape(ID_BITS // 8, len(ids), 8).transpose(0, 2, 1)
    return [row.tobytes() for row in np.packbits(bits.reshape(ID_BITS, len(ids)), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n_ids: int, plane: str = PLANE) -> np.ndarray:
    rows = np.frombuffer(b"".join(planes), dtype=np.uint8).reshape(len(planes), -1)
    if plane == "bit":
        bits = np.unpackbits(rows, axis=1, count=n_ids, bitorder="little")
        bits = bits.reshape(ID_BITS // 8, 8, n_ids).transpose(0, 2, 1)
        rows = np.packbits(np.ascontiguousarray(bits), axis=2, bitorder="little")[:, :, 0]
    return np.ascontiguousarray(rows.T).view("<u4")[:, 0]


def pack(ids: np.ndarray, plane: str, level: int) -> tuple[list[int], bytes]:
    """Ends of the compressed planes of all blocks, and the planes one after another."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    planes = [
        squeeze(p) for at in range(0, len(ids), BLOCK) for p in to_planes(ids[at : at + BLOCK], plane)
    ]
    return np.cumsum([len(p) for p in planes], dtype=np.int64).tolist(), b"".join(planes)


def unpack(n_ids: int, ends: list[int], payload: bytes, plane: str) -> np.ndarray:
    n_planes, loosen = ID_BITS // PLANE_BITS[plane], zstandard.ZstdDecompressor().decompress
    planes = [loosen(payload[a:b]) for a, b in zip([0, *ends], ends)]
    blocks = [
        from_planes(planes[k * n_planes : (k + 1) * n_planes], min(BLOCK, n_ids - k * BLOCK), plane)
        for k in range(-(-n_ids // BLOCK))
    ]
    return np.concatenate(blocks) if blocks else np.zeros(0, dtype="<u4")


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, plane: str = PLANE, level: int = 1, end_id: int = END_ID
) -> None:
    """Encode every row of ``docs``, append ``end_id`` to each, and write them by ascending doc_id.

    Null ids come first; rows with equal ids follow by text, so that a hot id is cut into
    several files; equal rows are all written. A null or empty text has the end id
    alone. Extra columns are ignored. An empty table writes no chunk.
    """
    chosen = docs.select(docs["doc_id"].cast("long"), "text")
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = chosen.select("doc_id", "text", *(c.alias(f"_{i}") for i, c in enumerate(order[1:])))
    ranged = keyed.repartitionByRange("doc_id", "_0", "_1").sortWithinPartitions("doc_id", "_0", "_1")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        held = 0

        def full() -> pa.RecordBatch:
            nonlocal chunk, held
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            ends, payload = pack(flat, plane, level)
            row = {
                "part": part, "chunk": chunk, "n_ids": len(flat), "doc_ids": list(doc_ids),
                "n_tokens": [len(x) // 4 for x in ids], "plane_ends": ends, "payload": payload,
            }
            ids.clear()
            doc_ids.clear()
            chunk, held = chunk + 1, 0
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        for batch in batches:
            encoded = encoder(tokenizer).encode(texts_of(batch.column(1)))
            for doc_id, x in zip(batch.column(0).to_pylist(), encoded):
                ids.append(x + end)
                doc_ids.append(doc_id)
                held += len(x) // 4 + 1
                if held >= CHUNK_IDS:
                    yield full()
        if doc_ids:
            yield full()

    ranged.select("doc_id", "text").mapInArrow(run, CHUNK).write.parquet(path)


_SCHEMA = pa.schema([
    ("part", pa.int64()), ("chunk", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
    ("plane_ends", pa.list_(pa.int64())), ("payload", pa.binary()),
])


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each chunk begins in the run of all ids: part, chunk, start.

    Parts are totalled first, so the one window over all of them has a row per file.
    """
    index = spark.read.schema(CHUNK).parquet(path).select("part", "chunk", "n_ids")
    totals = index.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts_start = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    local = index.select("part", "chunk", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("local"))
    return local.join(parts_start, "part").select("part", "chunk", (F.col("base") + F.col("local")).alias("start"))


def _read(spark: SparkSession, path: str, plane: str, schema: str, view) -> DataFrame:
    """Per document doc_id, part, chunk, offset in the chunk, n_tokens, and ``view`` of its ids."""
    last, kind = schema.split()[-2:]

    def make(batch: pa.RecordBatch) -> dict:
        names = ("doc_id", "part", "chunk", "offset", "n_tokens", last)
        out: dict[str, list] = {k: [] for k in names}
        for row in batch.to_pylist():
            flat = unpack(row["n_ids"], row["plane_ends"], row["payload"], plane)
            at = 0
            for doc_id, n in zip(row["doc_ids"], row["n_tokens"]):
                values = (doc_id, row["part"], row["chunk"], at, n, view(flat[at : at + n].tobytes()))
                for name, value in zip(names, values):
                    out[name].append(value)
                at += n
        return {k: pa.array(v, pa.binary() if k == last and kind == "binary" else pa.int64()) for k, v in out.items()}

    return map_batches(spark.read.schema(CHUNK).parquet(path), schema, make)


PLACE = "doc_id long, part long, chunk long, offset long, n_tokens long"


def read_tokens(spark: SparkSession, path: str, plane: str = PLANE) -> DataFrame:
    """Per document: doc_id, part, chunk, offset in the chunk, n_tokens and ids (little-endian, 32 bits each)."""
    return _read(spark, path, plane, f"{PLACE}, ids binary", bytes)


def round_trip(docs: DataFrame, tokenizer: str, plane: str = PLANE) -> DataFrame:
    """Write all documents, read the files back, and describe each document from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer, path, plane)
    rows = _read(spark, path, plane, f"{PLACE}, ids_crc32 long", zlib.crc32)
    return rows.join(chunk_index(spark, path), ["part", "chunk"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
