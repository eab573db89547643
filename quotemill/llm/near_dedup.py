"""MinHash near-duplicates: banded minima, signature verification, exact confirmation, components.

Documents with equal shingle sets are one *class*; all that follows works on classes.
Classes that agree on all minima of a band share a bucket. A bucket compares a few of its
classes, the *hubs*, with all others, and never all with all: after a round, links have
joined most of a bucket into one component, and only classes in a component other than the
hub's are compared again, with more hubs at once. A pair that shares several bands is compared in
the bucket of the first of them alone. A hub was compared with its whole bucket, so it
leaves; the rounds end when no bucket has two components left. So every pair of a bucket
that could join two components is compared, and once.

What is left after the first round are mostly families: variants of one text that share buckets
and are not linked. Their classes get a second, longer signature of one bit a minimum, so that a
pair costs a few machine words to compare and hardly one in the family has to be confirmed.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotemill.llm.components import components
from quotemill.llm.shared import (
    MIX, IdBitmap, land, map_batches, parts, row_key, texts_of, whole_row, word_hashes,
)

SHINGLE = 5
#: All bands miss a pair as similar as asked once in so many at most, and so does the signature.
MISS = 2_000_000
#: Minima of a band, if the bands it takes fit into a signature; else fewer.
ROWS = 5
SEED = 7
#: Minima of a signature, more only if bands of one row need them. The lowest byte of a
#: minimum stands for it: equal minima stay equal, others agree once in 256.
MINIMA = 200
#: Bits of the longer signature of classes that the first round leaves, in words of 64.
BIT_WORDS = 32
#: Hubs of a bucket: one at first, then so many, for up to which Spark ranks within each
#: partition before it shuffles.
MOST_HUBS = 1000
#: Classes of a bucket that one task compares with the bucket's hubs.
BLOCK = 2000


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for pairs at ``percent``: at 85, 25 bands of 5 rows."""
    for rows in range(ROWS, 0, -1):
        agree = (percent / 100) ** rows
        bands = 1 if agree == 1 else math.ceil(-math.log(MISS) / math.log1p(-agree))
        if bands * rows <= MINIMA:
            break
    return bands, rows


def least_agreeing(percent: int, n_hashes: int) -> int:
    """The most minima of which pairs at ``percent`` agree on fewer once in ``MISS`` at most."""
    s, below = percent / 100, 0.0
    for k in range(n_hashes + 1):
        below += math.comb(n_hashes, k) * s**k * (1 - s) ** (n_hashes - k)
        if below > 1 / MISS:
            return k
    return n_hashes


def most_differing(percent: int, n_bits: int) -> int:
    """The fewest bits in which pairs at ``percent`` differ more often only once in ``MISS`` at most."""
    p, above = (1 - percent / 100) / 2, 0.0
    for k in range(n_bits, -1, -1):
        if p > 0:
            ways = math.lgamma(n_bits + 1) - math.lgamma(k + 1) - math.lgamma(n_bits - k + 1)
            above += math.exp(ways + k * math.log(p) + (n_bits - k) * math.log1p(-p))
        elif k == 0:
            above = 1.0
        if above > 1 / MISS:
            return k
    return n_bits


def shingles(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted within it, and where each text's end.

    Words are lower-cased (ASCII) runs without white space. A text with fewer than ``n``
    words has one shingle, one without words none.
    """
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    h = word_hashes([w for ws in words for w in ws])
    h = (h ^ (h >> np.uint64(32))) * MIX
    starts = np.cumsum(sizes) - sizes
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    at = starts[owner] + np.arange(len(owner)) - (ends - counts)[owner]
    length = np.minimum(sizes, n)[owner]
    x = length.astype(np.uint64)
    for k in range(n):
        live = k < length
        x[live] = x[live] * MIX + h[at[live] + k]
        x ^= x >> np.uint64(29)
    order = np.lexsort((x, owner))
    x, owner = x[order], owner[order]
    fresh = np.ones(len(x), dtype=bool)
    fresh[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
    return x[fresh], np.cumsum(np.bincount(owner[fresh], minlength=len(texts)))


def hash_functions(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``n`` universal functions x -> (a x + b) mod 2^64, of which the upper 32 bits count."""
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 63, size=(2, n), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signatures(x: np.ndarray, ends: np.ndarray, n_hashes: int, seed: int = SEED) -> np.ndarray:
    """Minima of every hash function over each text's shingles; texts without any get zeros."""
    starts = np.concatenate([[0], ends[:-1]])
    some = ends > starts
    out = np.zeros((len(ends), n_hashes), dtype=np.uint32)
    if some.any():
        a, b = hash_functions(n_hashes, seed)
        for j in range(n_hashes):
            values = ((x * a[j] + b[j]) >> np.uint64(32)).astype(np.uint32)
            out[some, j] = np.minimum.reduceat(values, starts[some])
    return out


def _sets(texts: list[bytes], n: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Class key (128-bit hash of the whole set), shingles and ends, of each text."""
    x, ends = shingles(texts, n)
    starts = np.concatenate([[0], ends[:-1]])
    return [xxhash.xxh3_128_digest(x[a:b].tobytes()) for a, b in zip(starts, ends)], x, ends


def prints(docs: DataFrame, n: int = SHINGLE, n_hashes: int = MINIMA) -> DataFrame:
    """doc_id, text key, n_shingles, class and signature of every row."""
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key().alias("text_key"), "text")

    def make(batch: pa.RecordBatch) -> dict:
        texts, out = texts_of(batch.column(2)), []
        for a, b in parts(texts, 1 << 20):
            keys, x, ends = _sets(texts[a:b], n)
            out.append((keys, np.diff(ends, prepend=0), signatures(x, ends, n_hashes)))
        keys, sizes, minima = zip(*out)
        return {
            "doc_id": batch.column(0), "text_key": batch.column(1),
            "n_shingles": np.concatenate(sizes).astype(np.int64),
            "class": pa.array([k for ks in keys for k in ks], pa.binary()),
            "signature": pa.ListArray.from_arrays(
                np.arange(batch.num_rows + 1, dtype=np.int32) * n_hashes, np.concatenate(minima).astype(np.uint8).view(np.int8).ravel()
            ),
        }

    schema = "doc_id long, text_key long, n_shingles long, class binary, signature array<tinyint>"
    return map_batches(keyed, schema, make)


def buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, bucket, class, n_shingles, weight) for buckets of at least two classes.

    ``weight`` is how many classes a class meets in all its buckets: the text that
    the others are variants of meets most.
    """
    bucket = F.posexplode(
        F.array(*(F.xxhash64(F.lit(i), F.slice("signature", i * rows + 1, rows)) for i in range(bands)))
    )
    members = classes.select(bucket.alias("band", "bucket"), "class", "n_shingles")
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = land(members.join(shared, "bucket"), "met")
    weight = met.groupBy("class").agg(F.sum("n").alias("weight"))
    return met.drop("n").join(weight, "class")


def _close(a: Column, b: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _agree(a: Column, b: Column, percent: int, n_hashes: int) -> Column:
    """Signature verification: minima agree as often as the similarity makes likely."""
    least = least_agreeing(percent, n_hashes)
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) >= least


def _first_shared(a: Column, b: Column, band: Column, rows: int) -> Column:
    """Whether no band before this one is shared."""
    before = F.when(band > 0, F.sequence(F.lit(0), band - 1)).otherwise(F.array().cast("array<int>"))
    return F.forall(before, lambda i: F.slice(a, i * rows + 1, F.lit(rows)) != F.slice(b, i * rows + 1, F.lit(rows)))


def _texts_of_classes(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text_key, text) of one document of each class in ``wanted``: a bitmap over
    these documents keeps nearly all other texts out of what follows."""
    sources = land(classes.join(wanted, "class").select("class", "doc_id", "text_key"), "wanted")
    here = F.struct("doc_id", "text_key")
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key().alias("text_key"), "text")
    return keyed.where(IdBitmap(here, sources).has(here))


def bit_signatures(docs: DataFrame, classes: DataFrame, wanted: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(class, bits): the lowest bit of each of 64 ``BIT_WORDS`` minima, for the classes in ``wanted``."""

    def make(batch: pa.RecordBatch) -> dict:
        found, keys, bits = texts_of(batch.column(2)), [], []
        for a, b in parts(found, 1 << 18):
            some, x, ends = _sets(found[a:b], n)
            minima = signatures(x, ends, 64 * BIT_WORDS, seed=SEED + 1).astype(np.uint8) & 1
            keys += some
            bits.append(np.packbits(minima, axis=1).view(np.int64))
        offsets = np.arange(len(keys) + 1, dtype=np.int32) * BIT_WORDS
        return {"class": pa.array(keys, pa.binary()), "bits": pa.ListArray.from_arrays(offsets, np.concatenate(bits).ravel())}

    made = map_batches(_texts_of_classes(docs, classes, wanted), "class binary, bits array<long>", make)
    return made.join(wanted, "class", "left_semi").groupBy("class").agg(F.first("bits").alias("bits"))


def _rows_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of one length as the rows of an array."""
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width)


def family_pairs(ranked: DataFrame, hubs: DataFrame, percent: int, bands: int, band_rows: int) -> DataFrame:
    """(u, v): hubs and classes of their bucket that may be similar, by sizes and longer signatures.

    Both have bucket, band, class, n_shingles, place, hub, n, bits and signature. A bucket of ``n`` classes is cut
    by hash into blocks of about ``BLOCK``, each of which meets all hubs in a task of its own;
    only pairs that pass leave it.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    ranked = ranked.withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    # Both sides come from the same tables: columns of one of them get an identity of their own.
    hubs = hubs.select(*(F.col(c).alias(c) for c in hubs.columns)).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    most, n_hashes = most_differing(percent, 64 * BIT_WORDS), max(MINIMA, bands * band_rows)

    def compare(members: pa.Table, heads: pa.Table) -> pa.Table:
        found: list[tuple[bytes, bytes]] = []
        if members.num_rows and heads.num_rows:
            sizes, bits, minima = [], [], []
            for side in (members, heads):
                sizes.append(side["n_shingles"].to_numpy())
                # Counted as unsigned words: of a negative number numpy counts the bits of its absolute value.
                bits.append(_rows_of(side["bits"], BIT_WORDS).view(np.uint64))
                minima.append(_rows_of(side["signature"], n_hashes)[:, : bands * band_rows].reshape(-1, bands, band_rows))
            names, places = members["class"].to_pylist(), np.array(members["place"].to_pylist(), dtype=object)
            # Who is no hub comes after all hubs.
            ranks = members["hub"].fill_null(MOST_HUBS + 1).to_numpy()
            band = heads["band"][0].as_py()
            for j, (u, place, rank) in enumerate(zip(heads["class"].to_pylist(), heads["place"].to_pylist(), heads["hub"].to_pylist())):
                small, large = np.minimum(sizes[0], sizes[1][j]), np.maximum(sizes[0], sizes[1][j])
                at = np.flatnonzero((ranks > rank) & (100 * small >= percent * large) & (places != place))
                at = at[np.bitwise_count(bits[0][at] ^ bits[1][j]).sum(axis=1) <= most]
                # A pair counts in the first band it shares.
                before = (minima[0][at, :band] == minima[1][j, :band]).all(axis=2).any(axis=1)
                found += [(u, names[i]) for i in at[~before]]
        return pa.table({"u": pa.array([u for u, _ in found], pa.binary()), "v": pa.array([v for _, v in found], pa.binary())})

    by = ("bucket", "block")
    return ranked.groupBy(*by).cogroup(hubs.groupBy(*by)).applyInArrow(compare, "u binary, v binary")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, n: int = SHINGLE) -> DataFrame:
    """Pairs of classes whose full shingle sets are similar enough.

    Sets are made again from the texts of the classes in ``pairs`` alone, and compared by Spark: no
    task holds more of them than the pair at hand.
    """
    wanted = pairs.select(F.col("u").alias("class")).unionByName(pairs.select(F.col("v").alias("class"))).distinct()

    def make(batch: pa.RecordBatch) -> dict:
        found, keys, sets = texts_of(batch.column(2)), [], []
        for a, b in parts(found):
            some, x, ends = _sets(found[a:b], n)
            keys += some
            sets += [x[c:d].view(np.int64) for c, d in zip([0, *ends], ends)]
        return {"class": pa.array(keys, pa.binary()), "items": pa.array(sets, pa.list_(pa.int64()))}

    # Rows that repeat one document carry equal sets; one is enough.
    texts = _texts_of_classes(docs, classes, wanted)
    made = map_batches(texts, "class binary, items array<long>", make).join(wanted, "class", "left_semi")
    sets = land(made.groupBy("class").agg(F.first("items").alias("items")), "sets")
    both = (
        pairs.join(sets.select(F.col("class").alias("u"), F.col("items").alias("iu")), "u")
        .join(sets.select(F.col("class").alias("v"), F.col("items").alias("iv")), "v")
        .select("u", "v", "iu", "iv")
    )
    common, sizes = F.size(F.array_intersect("iu", "iv")), F.size("iu") + F.size("iv")
    return both.where(100 * common >= percent * (sizes - common)).select("u", "v")


def links(docs: DataFrame, classes: DataFrame, percent: int, n: int = SHINGLE) -> DataFrame:
    """(class, component): the smallest class of the component, for classes with a link."""
    bands, band_rows = banding(percent)
    n_hashes = max(MINIMA, bands * band_rows)
    members = land(buckets(classes, bands, band_rows), "buckets")
    columns = members.columns
    signature = classes.select("class", "signature")
    joined, longer = None, None
    n_hubs = 1
    while not members.isEmpty():
        if joined is None:
            # Every bucket holds several classes, each a component of its own.
            placed = members.withColumn("place", F.col("class"))
        else:
            placed = members.join(joined, "class", "left").withColumn("place", F.coalesce("component", "class"))
            split = placed.groupBy("bucket").agg(
                F.min("place").alias("low"), F.max("place").alias("high"), F.count("*").alias("n")
            )
            split = split.where("low <> high").select("bucket", "n")
            placed = land(placed.join(split, "bucket").select(*columns, "place", "n"), "placed")
            if placed.isEmpty():
                break
        if joined is not None and longer is None:
            bits = bit_signatures(docs, classes, placed.select("class").distinct(), n)
            signature = longer = land(signature.join(bits, "class"), "signatures")
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("weight"), "class"))
        hubs = land(placed.withColumn("hub", rank).where(F.col("hub") <= n_hubs), "hubs")
        # In the first round the only hub of a bucket is told from the others by its place.
        ranked = placed
        if joined is not None:
            ranked = placed.join(hubs.select("bucket", "class", "hub"), ["bucket", "class"], "left")
        ranked = ranked.join(signature, "class")
        if joined is None:
            hub = hubs.join(signature, "class").select(
                "bucket", F.col("class").alias("u"), F.col("n_shingles").alias("nu"),
                F.col("place").alias("pu"), F.col("signature").alias("su"),
            )
            worth = (
                (ranked["bucket"] == hub["bucket"]) & (F.col("place") != F.col("pu"))
                & _close(F.col("n_shingles"), F.col("nu"), percent)
                & _agree(F.col("signature"), F.col("su"), percent, n_hashes)
                & _first_shared(F.col("signature"), F.col("su"), F.col("band"), band_rows)
            )
            found = ranked.join(hub, worth).select("u", F.col("class").alias("v"))
        else:
            found = family_pairs(ranked, hubs.join(signature, "class"), percent, bands, band_rows)
        pairs = land(found, "pairs")
        new = pairs if pairs.isEmpty() else land(confirmed(pairs, docs, classes, percent, n), "links")
        if joined is None or not new.isEmpty():
            # Components so far are stars, of the same reach as the links that made them.
            known = [] if joined is None else [joined.select(F.col("class").alias("u"), F.col("component").alias("v"))]
            found = reduce(DataFrame.unionByName, known, new)
            joined = land(components(found).select(F.col("node").alias("class"), "component"), "joined")
        # A hub was compared with its whole bucket, but for what shared its place.
        members = land(placed.join(hubs.select("bucket", "class"), ["bucket", "class"], "left_anti").select(*columns), "members")
        n_hubs = MOST_HUBS
    return joined if joined is not None else classes.select("class", F.col("class").alias("component")).limit(0)


def near_duplicates(docs: DataFrame, percent: int = 85, n: int = SHINGLE) -> DataFrame:
    """doc_id, text key, n_shingles, component_id and kept of every row.

    Documents are linked whose shingle sets have an intersection of at least ``percent``
    percent of their union; a component is named by its smallest doc_id. Rows without words
    have no shingles and are linked with nothing. Repeated rows share a component and are
    all kept or none; a null id names a component only if it has no other. Extra columns are
    ignored; an empty table gives no rows.
    """
    return _placed(docs, percent, n).drop("stays")


def _placed(docs: DataFrame, percent: int, n: int) -> DataFrame:
    """``near_duplicates`` and ``stays``: whether the row has the least doc_id (null last) and text
    key of its component."""
    bands, band_rows = banding(percent)
    rows = land(prints(docs, n, max(MINIMA, bands * band_rows)), "prints")
    worded = rows.where("n_shingles > 0")
    least = worded.groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        F.min(F.struct("doc_id", "text_key")).alias("least"), F.min("doc_id").alias("name"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("keeper"),
    )
    classes = land(least.select("class", "n_shingles", "signature", "least.doc_id", "least.text_key", "name", "keeper"), "classes")
    joined = links(docs, classes, percent, n)
    ids = classes.select("class", "name", "keeper").join(joined, "class", "left")
    ids = ids.withColumn("component", F.coalesce("component", "class"))
    names = ids.drop("keeper").join(
        ids.groupBy("component").agg(F.min("name").alias("component_id"), F.min("keeper").alias("keeper")), "component"
    )
    named = names.select("class", "component_id", "keeper")
    placed = rows.join(named, "class", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )
    return placed.select(
        "doc_id", "text_key", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        ((F.col("n_shingles") == 0) | (
            F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_key") == F.col("keeper.text_key"))
        )).alias("stays"),
    )


def keep_one(docs: DataFrame, percent: int = 85, n: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each group stays, as it is.

    It is the one with the least doc_id (null last) and text key. Of repeated rows of that document one
    stays; texts without words, null or empty, are all kept. Texts of any length are compared whole. Columns may have any
    names; an empty table gives no rows. A bitmap over the rows that go keeps nearly all others out
    of the shuffle.
    """
    found = _placed(docs, percent, n).groupBy("doc_id", "text_key").agg(
        F.bool_or("stays").alias("kept"), (F.count("*") > 1).alias("again"), F.max("n_shingles").alias("n")
    )
    odd = land(found.where(~F.col("kept") | (F.col("again") & (F.col("n") > 0))), "odd")
    here = F.struct("doc_id", "text_key")
    keyed = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("text_key"))
    maybe = IdBitmap(here, odd).has(here)
    odd = odd.select(F.col("doc_id").alias("odd_id"), F.col("text_key").alias("odd_key"), "kept")
    same = F.col("doc_id").eqNullSafe(F.col("odd_id")) & (F.col("text_key") == F.col("odd_key"))
    touched = keyed.where(maybe).join(odd, same, "left").where("kept is null or kept")
    once = touched.where("kept").dropDuplicates(["doc_id", "text_key"])
    rest = [keyed.where(~maybe), touched.where("kept is null"), once]
    return reduce(DataFrame.unionAll, (df.select("row.*") for df in rest))
