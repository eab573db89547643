"""Nearest neighbours by balanced posting lists, completed by a bound.

Vectors are put into posting lists around centroids. A vector near the border of
clusters stands in several lists. Centroids form a small graph that each task holds and
walks to find the lists of a vector; a query reads the lists whose distance is within
a ratio of its nearest. A list is cut into blocks of bounded size, and so are the
queries of a list, so a task scores bounded matrices.

No vector of a list is nearer to a query than the list's centroid less its radius. A query
then reads every list of which that does not rule out a vector as near as its last place, so
the result is exact. Lists near each other form groups; the second pass reads whole groups.

The measure is the inner product. With one more component, the square root of the largest
squared norm less the vector's own, all vectors have one norm, and the largest inner product
with a query (its component is 0) is the smallest distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotemill.llm.shared import as_binary, land, map_batches

#: Bounds of what is fitted on the driver and held by each task: a sample and centroids.
SAMPLE_ROWS = 20_000
MAX_LISTS = 4096
LIST_SIZE = 200
#: Graph: links of a centroid, entry points, and how many centroids a walk keeps and expands.
DEGREE, ENTRIES, BEAM = 16, 8, 48
#: Replicas of a vector: lists within this ratio of its nearest, at most so many.
REPLICA_RATIO, MAX_REPLICAS = 1.1, 4
#: Lists of a query: within this ratio of its nearest, at most so many.
PROBE_RATIO, MAX_PROBES = 1.6, 48
#: Rows of a block of a list, and of the queries of a list, and queries scored at once.
BLOCK, QUERY_BLOCK, SCORED = 4096, 16_384, 512
#: Groups of lists of the second pass: so many, and one more for so many vectors.
GROUPS, GROUP_SIZE = 64, 16_384


@dataclass
class Centroids:
    """Centroids with their graph; ``top`` is the largest squared norm of the indexed vectors."""

    points: np.ndarray
    graph: np.ndarray
    top: float

    def lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        if query:  # scaled to the common norm: this changes no order among the vectors
            norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
            return np.hstack([vectors * (np.sqrt(self.top) / norm), np.zeros((len(vectors), 1))])
        rest = np.maximum(self.top - (vectors**2).sum(axis=1, keepdims=True), 0)
        return np.hstack([vectors, np.sqrt(rest)])

    def nearest(self, lifted: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first walks over the graph, for all rows at once: centroids and distances, nearest first."""
        n_rows, n_points, rows = len(lifted), len(self.points), np.arange(len(lifted))[:, None]
        dist = np.full((n_rows, n_points), np.inf)
        spent = np.zeros((n_rows, n_points), dtype=bool)

        def visit(which: np.ndarray) -> None:
            gap = self.points[which] - lifted[:, None, :]
            dist[rows, which] = np.einsum("ijk,ijk->ij", gap, gap)

        entry = np.linspace(0, n_points - 1, min(ENTRIES, n_points)).astype(int)
        visit(np.broadcast_to(entry, (n_rows, len(entry))))
        for _ in range(min(max(n, BEAM), n_points)):
            best = np.where(spent, np.inf, dist).argmin(axis=1)
            spent[rows[:, 0], best] = True
            visit(self.graph[best])
        n = min(n, n_points)
        found = np.argpartition(dist, n - 1, axis=1)[:, :n]
        order = np.argsort(dist[rows, found], axis=1, kind="stable")
        found = np.take_along_axis(found, order, axis=1)
        return found, np.sqrt(dist[rows, found])


def fit(sample: np.ndarray, n_lists: int, top: float, rounds: int = 8, seed: int = 5) -> Centroids:
    """Centroids by Lloyd's rounds over the sample; an empty cluster takes the farthest point."""
    blank = Centroids(np.zeros((0, 0)), np.zeros((0, 0), dtype=int), top)
    centers = cluster(blank.lifted(sample, query=False), n_lists, rounds, seed)
    degree = min(DEGREE, len(centers))
    square = (centers**2).sum(axis=1)
    links = [
        np.argsort(square - 2 * centers[i] @ centers.T, kind="stable")[:degree] for i in range(len(centers))
    ]
    # A ring through all centroids keeps the graph connected.
    ring = (np.arange(len(centers)) + 1) % len(centers)
    return Centroids(centers, np.hstack([np.array(links), ring[:, None]]), top)


def cluster(points: np.ndarray, n_lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = points[rng.choice(len(points), size=min(n_lists, len(points)), replace=False)]
    for _ in range(rounds):
        owner, gap = _closest(points, centers)
        total = np.zeros_like(centers)
        np.add.at(total, owner, points)
        n = np.bincount(owner, minlength=len(centers))
        centers = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers)
        empty = np.flatnonzero(n == 0)
        centers[empty] = points[np.argsort(-gap, kind="stable")[: len(empty)]]
    return centers


def _closest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    owner, gap = [], []
    for a in range(0, len(points), 4096):
        d = (centers**2).sum(axis=1) - 2 * points[a : a + 4096] @ centers.T
        owner.append(d.argmin(axis=1))
        gap.append(d.min(axis=1) + (points[a : a + 4096] ** 2).sum(axis=1))
    return np.concatenate(owner), np.concatenate(gap)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.float64).reshape(len(values), -1)


def usable(embeddings: DataFrame, dims: int | None = None) -> DataFrame:
    """vec_id, key and vector (64-bit floats) of the vectors that take part.

    Left out are null ids, and vectors that are null, zero, hold null or non-finite
    components or have another length than ``dims``, by default the commonest length.
    """
    if dims is None:
        sizes = embeddings.where("embedding is not null").groupBy(F.size("embedding").alias("n")).count()
        row = sizes.orderBy(F.desc("count"), "n").first()
        dims = row["n"] if row else 0
    chosen = embeddings.where(F.col("vec_id").isNotNull() & (F.size("embedding") == dims)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )

    def make(batch: pa.RecordBatch) -> dict:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        vectors = flat.reshape(batch.num_rows, -1) + 0.0  # one zero only
        with np.errstate(over="ignore"):
            norm = (vectors**2).sum(axis=1) if dims else np.zeros(batch.num_rows)
        good = np.isfinite(norm) & (norm > 0) & np.isfinite(vectors).all(axis=1)
        vectors = vectors[good]
        return {
            "vec_id": batch.column(0).filter(pa.array(good)),
            "key": pa.array([xxhash.xxh3_128_digest(v.tobytes()) for v in vectors], pa.binary()),
            "vector": as_binary(vectors) if len(vectors) else pa.array([], pa.binary()),
            "norm": norm[good],
        }

    return map_batches(chosen, "vec_id long, key binary, vector binary, norm double", make)


def _lists(rows: DataFrame, centroids, n: int, ratio: float, query: bool) -> DataFrame:
    """Every row once for each of its lists, nearest first: all its columns, ``list``, ``gap`` and
    whether the list is its ``first``."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Centroids = centroids.value
        step = max(1, min(1024, (1 << 22) // max(1, len(index.points))))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                found, gap = index.nearest(index.lifted(_matrix(batch.column(names.index("vector"))), query), n)
                keep = gap <= ratio * gap[:, :1] + 1e-12
                row, at = np.nonzero(keep)
                out = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(found[row, at].astype(np.int32)), pa.array(gap[row, at]), pa.array(at == 0)],
                    [*names, "list", "gap", "first"],
                )

    schema = ", ".join(f"{k} {t}" for k, t in rows.dtypes) + ", list int, gap double, first boolean"
    return rows.mapInArrow(run, schema)


def _unread(queries: DataFrame, centroids, radii: np.ndarray, groups: np.ndarray) -> DataFrame:
    """``key``, ``vector`` and ``list`` (a group) of what ``queries`` must still read.

    ``queries`` has key, vector, lists (those read) and least (the score of the last place, null
    if places are empty). ``radii`` are those of the lists, negative for one without vectors.
    """
    shipped = queries.sparkSession.sparkContext.broadcast((radii, groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Centroids = centroids.value
        radius, group = shipped.value
        n_groups, top = int(group.max()) + 1, np.sqrt(index.top)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                vectors = _matrix(batch.column(1))
                lifted = index.lifted(vectors, True)
                score = batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                cosine = top * score / np.sqrt((vectors**2).sum(axis=1))
                reach = np.where(np.isnan(score), np.inf, np.sqrt(np.maximum(2 * index.top - 2 * cosine, 0)))
                square = (lifted**2).sum(axis=1)[:, None] + (index.points**2).sum(axis=1) - 2 * lifted @ index.points.T
                gap = np.sqrt(np.maximum(square, 0))
                # Room for rounding, also for that of the square root of a small difference.
                open_ = (gap - radius <= reach[:, None] + 1e-6 * top) & (radius >= 0)
                for i, read in enumerate(batch.column(2).to_pylist()):
                    open_[i, read] = False
                wanted = np.zeros((batch.num_rows, n_groups), dtype=bool)
                row, at = np.nonzero(open_)
                wanted[row, group[at]] = True
                row, at = np.nonzero(wanted)
                out = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [out.column(0), out.column(1), pa.array(at.astype(np.int32))], ["key", "vector", "list"]
                )

    return queries.select("key", "vector", "lists", "least").mapInArrow(run, "key binary, vector binary, list int")


def _search(postings: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, key, least, score): per query and block the ``k`` + 1 nearest vectors."""
    n_blocks = postings.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    n_query = queries.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    shape = land(n_blocks.join(n_query, "list"), "shape")
    left = postings.join(shape, "list").select(
        "list", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"), "key", "vector", "least",
    )
    right = queries.join(shape, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("key"), F.col("query_blocks")).cast("int").alias("query_block"), "key", "vector",
    )
    by = ["list", "block", "query_block"]
    schema = pa.schema([("query", pa.binary()), ("key", pa.binary()), ("least", pa.int64()), ("score", pa.float64())])

    def score(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return schema.empty_table()
        v, q = _matrix(block["vector"].combine_chunks()), _matrix(asked["vector"].combine_chunks())
        least = block["least"].to_numpy()
        n = min(k + 1, len(v))
        keys, asks = block["key"].combine_chunks(), asked["key"].combine_chunks()
        out = []
        for a in range(0, len(q), SCORED):
            some = q[a : a + SCORED]
            near = some @ v.T
            # The last place may be tied: all that reach its score stay until the order is exact.
            cut = np.partition(near, len(v) - n, axis=1)[:, len(v) - n]
            row, at = np.nonzero(near >= cut[:, None] - 1e-9 * (1 + np.abs(cut[:, None])))
            exact = np.einsum("ij,ij->i", some[row], v[at])
            order = np.lexsort((least[at], -exact, row))
            row, at, exact = row[order], at[order], exact[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, at, exact = row[place < n], at[place < n], exact[place < n]
            columns = [asks.take(pa.array(a + row)), keys.take(pa.array(at)), pa.array(least[at]), pa.array(exact)]
            out.append(pa.table(columns, schema=schema))
        return pa.concat_tables(out)

    grouped = left.groupBy(*by).cogroup(right.groupBy(*by))
    return grouped.applyInArrow(score, "query binary, key binary, least long, score double")


def nearest(
    embeddings: DataFrame, k: int = 20, every: int = 20, max_probes: int = MAX_PROBES,
    probe_ratio: float = PROBE_RATIO, list_size: int = LIST_SIZE,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest other rows of every query.

    Queries are the rows whose vec_id is a multiple of ``every``. Equal vectors are indexed
    once, with their ``k`` + 1 smallest ids: no others can be among a query's nearest. Ties go
    to the smaller id. ``max_probes`` and ``probe_ratio`` bound the first pass alone. Repeated
    rows count once. What ``usable`` leaves out is neither query nor candidate; extra columns are
    ignored; a table without vectors gives no rows.
    """
    spark = embeddings.sparkSession
    base = land(usable(embeddings), "vectors")
    by_key = Window.partitionBy("key").orderBy("vec_id")
    ids = base.select("key", "vec_id").distinct().withColumn("n", F.row_number().over(by_key)).where(F.col("n") <= k + 1)
    ids = ids.groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    vectors = base.groupBy("key").agg(F.first("vector").alias("vector"), F.min("vec_id").alias("least"))
    vectors = land(vectors.join(ids, "key"), "distinct")
    facts = base.agg(F.max("norm").alias("top")).first()
    n = vectors.count()
    n_ids = ids.agg(F.sum(F.size("ids"))).first()[0]
    none = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], none)

    sample = vectors.select("vector", "key").orderBy("key").limit(SAMPLE_ROWS).select("vector").toArrow()
    n_lists = max(1, min(MAX_LISTS, n // list_size))
    index = fit(_matrix(sample["vector"].combine_chunks()), n_lists, facts["top"])
    centroids = spark.sparkContext.broadcast(index)

    postings = land(_lists(vectors.select("key", "vector", "least"), centroids, MAX_REPLICAS, REPLICA_RATIO, False), "postings")
    asked = base.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "key", "vector")
    queries = asked.groupBy("key").agg(F.first("vector").alias("vector"))
    probes = land(_lists(queries, centroids, max_probes, probe_ratio, True), "probes")
    hits = land(_search(postings, probes, k), "hits")
    found = land(_best(hits, vectors, k), "found")

    # Every vector stands in its first list, so the radii and the second pass need no replicas.
    radii, whole = np.full(len(index.points), -1.0), min(k + 1, n_ids)
    for r in postings.where("first").groupBy("list").agg(F.max("gap").alias("radius")).collect():
        radii[r["list"]] = r["radius"]
    n_groups = min(len(index.points), GROUPS + n // GROUP_SIZE)
    groups = _closest(index.points, cluster(index.points, n_groups))[0]
    last = F.when(F.size("near") >= whole, F.element_at("near", -1)["score"])
    read = probes.groupBy("key").agg(F.first("vector").alias("vector"), F.collect_list("list").alias("lists"))
    read = read.join(found.select(F.col("query").alias("key"), last.alias("least")), "key", "left")
    more = land(_unread(read, centroids, radii, groups), "unread")
    if not more.isEmpty():
        group_of = F.get(F.array(*(F.lit(int(g)) for g in groups)), F.col("list"))
        grouped = postings.where("first").select("key", "vector", "least", group_of.alias("list"))
        again = _search(grouped, more, k)
        found = land(_best(hits.unionByName(again), vectors, k), "found")
    asked_ids = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query")).distinct()
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asked_ids.join(found, "query").select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )


def _best(hits: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Per query vector the ``k`` + 1 nearest ids, with scores, in order. A replica counts once."""
    once = hits.groupBy("query", "key", "least").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "least"))
    top = once.withColumn("n", rank).where(F.col("n") <= k + 1).join(vectors.select("key", "ids"), "key")
    one = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("vec_id")))
    near = F.slice(F.array_sort(F.flatten(F.collect_list(one))), 1, k + 1)
    as_score = F.transform(near, lambda x: F.struct(x["vec_id"].alias("vec_id"), (-x["far"]).alias("score")))
    return top.groupBy("query").agg(as_score.alias("near"))
