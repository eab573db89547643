"""Embedding whitening by Chebyshev-filtered subspace iteration.

The components are the leading eigenvectors of the covariance V of the vectors. V is never
formed: the only access to it is the product VQ = YᵀYQ / n with a narrow block Q, one
distributed pass over the centred vectors Y. A task adds up its rows, Spark adds up the tasks, and the
driver gets as many numbers as Q has.

1. A short Lanczos run bounds the spectrum from below.
2. A block of some more vectors than components is filtered: the Chebyshev recurrence over
   passes damps all eigenvalues between that bound and the least of the block. Its degree is as
   high as keeps the block's largest part from hiding its least.
3. QR makes the block orthonormal, Rayleigh and Ritz's projection turns it to the eigenvectors in it.
4. Components are locked, and left out of the filter, as their residuals vanish. The rounds end when all
   are *certified*: no residual is above rounding, or they no longer shrink and are below ``CERTIFIED``.

Centring is exact: entries are whole numbers, and their sums are added as whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.shared import land

#: Fixed values of the contract: components, and a whole number from each entry.
COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Entries beyond this stand at it: a long holds no more.
FARTHEST = 1 << 62
#: Vectors of the block beyond the components: half as many, so many at least.
SPARE = 8
#: Passes of the bound, the highest degree, the spread that a filter may cause, and rounds.
BOUND_PASSES, DEGREE, SPREAD, ROUNDS = 8, 12, 1e9, 200
#: Residuals, over the largest eigenvalue, of rounding and of a component that passes.
ROUNDING, CERTIFIED = 2e-15, 1e-12

EPS = np.finfo(float).eps


def whole_vectors(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): entries as whole numbers floor(scale * c) + shift, of vectors without null, NaN or infinite entries."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    far = float(FARTHEST)
    x = F.transform(c, lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(far)), F.lit(-far))) + shift)
    return embeddings.where(finite & (F.size("embedding") > 0)).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Vectors:
    """Vectors of one length: number, sums, least and greatest entry by place; the sums are exact."""

    rows: DataFrame
    n: int
    sums: list[int]
    least: list[int]
    most: list[int]

    @classmethod
    def of(cls, rows: DataFrame) -> Vectors:
        """Reads ``rows`` once. Sums are kept as two halves, so that none runs over."""

        def run(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch)
                    high, low = x >> 32, x & 0xFFFFFFFF
                    mine = [np.full(x.shape[1], len(x)), high.sum(0), low.sum(0), x.min(0), x.max(0)]
                    if total is None:
                        total = mine
                    else:
                        total = [a + b for a, b in zip(total[:3], mine)] + [np.minimum(total[3], mine[3]), np.maximum(total[4], mine[4])]
            if total is not None:
                places = pa.array(np.arange(len(total[0]), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([places, *map(pa.array, total)], ["place", "n", "high", "low", "least", "most"])

        parts = rows.select("x").mapInArrow(run, "place int, n long, high long, low long, least long, most long")
        exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
        found = parts.groupBy("place").agg(*exact, F.min("least").alias("least"), F.max("most").alias("most")).collect()
        found = sorted(found, key=lambda r: r["place"])
        sums = [(int(r["high"]) << 32) + int(r["low"]) for r in found]
        return cls(rows, int(found[0]["n"]) if found else 0, sums, [r["least"] for r in found], [r["most"] for r in found])

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        """x - S/n in doubles: the whole part of the mean is taken off before it can cost a digit."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return lambda x: (x - whole) - rest

    def deviations(self) -> Callable[[np.ndarray], pa.Array]:
        """Sum of (n x - S)² of each row, exact; null where a long cannot hold it."""
        n, sums = self.n, self.sums
        reach = [max(abs(n * a - s), abs(n * b - s)) for a, b, s in zip(self.least, self.most, sums)]
        far = max((abs(v) for v in [*self.least, *self.most]), default=0)
        if sum(r * r for r in reach) < 1 << 63 and n * far < 1 << 62:
            small = np.array(sums, dtype=np.int64)
            return lambda x: pa.array(((n * x - small) ** 2).sum(axis=1))

        def big(x: np.ndarray) -> pa.Array:
            found = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
            return pa.array([v if v < 1 << 63 else None for v in found], pa.int64())

        return big

    def added(self, make: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
        """One pass: the sum over all rows of ``make`` (centred rows -> matrix)."""
        centred = self.centred()

        def run(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    mine = make(centred(_matrix(batch)))
                    total = mine if total is None else total + mine
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total), dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total.T)],
                    ["place", *(f"c{j}" for j in range(columns))],
                )

        schema = T.StructType([T.StructField("place", T.IntegerType()), *(T.StructField(f"c{j}", T.DoubleType()) for j in range(columns))])
        parts = self.rows.select("x").mapInArrow(run, schema)
        found = parts.groupBy("place").agg(*(F.sum(f"c{j}").alias(f"c{j}") for j in range(columns))).toArrow().sort_by("place")
        return np.column_stack([found[f"c{j}"].to_numpy() for j in range(columns)])

    def times(self, block: np.ndarray) -> np.ndarray:
        """V times a block, in one pass."""
        return self.added(lambda y: y.T @ (y @ block), block.shape[1]) / self.n


def lower_bound(product: Callable, width: int, passes: int, rng: np.random.Generator) -> float:
    """A bound of the spectrum from below: the least Ritz value of a Lanczos run less its residual."""
    basis, diagonal, beside = [rng.standard_normal(width)], [], []
    basis[0] /= np.linalg.norm(basis[0])
    for _ in range(min(passes, width)):
        w = product(basis[-1][:, None])[:, 0]
        diagonal.append(basis[-1] @ w)
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beside.append(np.linalg.norm(w))
        if beside[-1] <= EPS * max(diagonal):
            break
        basis.append(w / beside[-1])
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside[:-1], 1)[: len(diagonal), : len(diagonal)] + np.diag(beside[:-1], -1))
    return max(0.0, float(ritz[0] - beside[-1]))


def leading(
    product: Callable, width: int, wanted: int, spare: int | None = None, seed: int = 3
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of ``product`` (block -> V block), falling, and their vectors."""
    rng = np.random.default_rng(seed)
    spare = max(SPARE, wanted // 2) if spare is None else spare
    size = min(width, wanted + spare)
    block = np.linalg.qr(rng.standard_normal((width, size)))[0]
    low = lower_bound(product, width, BOUND_PASSES, rng) if size < width else 0.0
    last = np.inf
    for _ in range(ROUNDS):
        image = product(block)
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(values[0], 0.0)
        residuals = np.linalg.norm(image - block * values, axis=0)
        worst = residuals[:wanted].max()
        if worst <= ROUNDING * top or (worst <= CERTIFIED * top and worst > last / 2):
            return values[:wanted], block[:, :wanted]
        last = worst
        still = residuals[:wanted] > ROUNDING * top
        locked = int(np.argmax(still)) if still.any() else wanted
        high = max(values[-1], 1e-6 * top)
        filtered = _filtered(product, block, image, values, locked, min(low, values[-1]), high)
        block = np.linalg.qr(np.hstack([block[:, :locked], filtered]))[0]
    raise ArithmeticError(f"no certified components after {ROUNDS} rounds: residual {worst / top:.1e}")


def _filtered(product, block, image, values, locked, low, high) -> np.ndarray:
    """The Chebyshev filter of the unlocked vectors. The first product is known; locked parts are taken out at each step."""
    centre, half = (high + low) / 2, max((high - low) / 2, EPS * high)
    kept = block[:, :locked]

    def free(x: np.ndarray) -> np.ndarray:
        return x - kept @ (kept.T @ x)

    growth = np.arccosh(max(1 + 1e-9, (values[locked] - centre) / half))
    degree = int(np.clip(np.log(SPREAD) / growth, 1, DEGREE))
    before = block[:, locked:]
    now = free(image[:, locked:] - centre * before) / half
    for _ in range(degree - 1):
        before, now = now, free(2 * (product(now) - centre * now) / half - before)
    return now


def whitened(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each vector and component.

    Needs vec_id and embedding, ignores other columns. Vectors that are null, empty or hold null, NaN or
    infinite entries take no part, nor do those of another length than most (of equally many the longest).
    Repeated rows and null ids count each. There are at most as many components as entries. A component
    without variance has a null ``whitened`` and is left out of ``identity_error``, which is null if all are; an
    explained share of no variance is 0. A deviation that a long cannot hold is null. An empty table gives no rows.
    """
    rows = land(whole_vectors(embeddings, scale, shift), "vectors")
    lengths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if not lengths:
        return rows.sparkSession.createDataFrame([], schema)
    vectors = Vectors.of(rows.where(F.size("x") == lengths[0]["width"]))
    wanted = min(components, vectors.width)
    trace = float(vectors.added(lambda y: (y * y).sum(axis=0)[None, :], vectors.width).sum()) / vectors.n
    values, axes = np.zeros(wanted), np.eye(vectors.width)[:, :wanted]
    if trace > 0:
        values, axes = leading(vectors.times, vectors.width, wanted)
    live = values > max(vectors.width, 100) * EPS * max(values[0], 0)
    scaled = axes[:, live] / np.sqrt(values[live])
    error = _identity_error(vectors, scaled) if live.any() else None
    share = np.where(live, values / trace, 0.0) if trace > 0 else np.zeros(wanted)
    centred, deviations, n = vectors.centred(), vectors.deviations(), vectors.n

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            flat = np.full((len(x), wanted), np.nan)
            flat[:, live] = centred(x) @ scaled
            dead = np.tile(~live, len(x))
            each = pa.array(np.repeat(np.arange(len(x)), wanted))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n)), deviations(x).take(each), pa.array(flat.ravel(), mask=dead),
                    pa.array(np.tile(share, len(x))), pa.array([error] * len(each), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)


def _identity_error(vectors: Vectors, scaled: np.ndarray) -> float:
    """The largest difference between the covariance of the whitened vectors and the identity: one pass."""
    k = scaled.shape[1]

    def make(y: np.ndarray) -> np.ndarray:
        w = y @ scaled
        return np.vstack([w.T @ w, w.sum(axis=0)[None, :]])

    found = vectors.added(make, k) / vectors.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
