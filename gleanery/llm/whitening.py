"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

An entry c counts as the whole number x = floor(64 c) + 1000000, so counts, sums and
deviations are exact. With C the rows of x less their mean, the bidiagonalisation builds
orthonormal u1, u2, ... among the rows' directions and v1, v2, ... among the dimensions with
C V = U B, B having a diagonal and one band above it. A step is one distributed pass:
each task holds its rows' part of C v, and sums C' (C v) beside the inner products of C v
with all earlier u, by which the step is reorthogonalised. The u are as long as the table,
so they are not stored: u = C a for a short vector a, from which a task makes its part anew.
So a pass needs nothing but the blocks written once and some short vectors, and a lost
task is simply run again. The v are reorthogonalised against all earlier ones. Where a step
leaves little of a vector, its pass is repeated on what is left. After as many steps as
there are dimensions (in a flat spectrum the later components converge only then; where the
space closes early, as with equal deviations, a new direction is drawn) the singular values
of the small B give the deviations, and its right vectors the components.

Rows whose vector is null, empty, or holds null or not finite entries are left out, and so
are vectors shorter than the longest, whose last entries are missing. Rows that repeat an id
or a vector count and appear as often as they are there. Components of equal deviation are
taken in any order, each with its largest part positive; only components with deviation
(over ``LEAST`` of the largest) are numbered, so there may be fewer than were asked for, and no rows at all where all vectors
are equal or the table is empty. Texts are not read, and other columns are not carried.
Entries are taken to be below 2**30 in size, where ``n`` times x is still a whole number of
63 bits for billions of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gleanery.session import scratch_path

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # fixed values: of a whole number in an entry
LEAST = 1e-6  # of the largest singular value: what counts as deviation
NOISE = 1e-13  # of the largest variance: what rounding leaves of none
ENTRIES = 1 << 18  # of one block


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, vector array<double>) of the rows that count."""
    entries = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("key"), entries.alias("vector"))
    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    return rows.where(F.size("vector") == F.lit(longest or 0))


def _whole(column: pa.ListArray) -> np.ndarray:
    """A batch's vectors as rows of whole numbers."""
    entries = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * entries).astype(np.int64) + SHIFT).reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rows, block): the vectors of many rows as the bytes of one matrix."""
    parts, size = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(_whole(batch.column(0)))
            size += parts[-1].size
        if size >= ENTRIES:
            yield _block(parts)
            parts, size = [], 0
    if parts:
        yield _block(parts)


def _block(parts: list[np.ndarray]) -> pa.RecordBatch:
    x = np.concatenate(parts)
    return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["rows", "block"])


def _summed(blocks: DataFrame, measure: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of a short vector that is measured on every block of whole numbers. It is
    added up within the tasks, then by place."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = measure(np.frombuffer(block.as_buffer(), np.int64).reshape(n, -1))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], names=["parts"])

    parts = blocks.mapInArrow(of_task, f"parts array<{kind}>").select(F.posexplode("parts").alias("at", "part"))
    rows = parts.groupBy("at").agg(F.sum("part").alias("total")).toPandas()
    return rows.sort_values("at")["total"].to_numpy()


@dataclass
class Fit:
    """What is learned from all rows: ``n``, the exact sums of x, the components as columns
    ordered by falling variance ``e``, and the variance of all dimensions together."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    e: np.ndarray
    trace: float


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less their mean, rounded once."""
    return (n * x - sums) / n


def _without(v: np.ndarray, known: np.ndarray) -> np.ndarray:
    """What a vector has beside the known directions."""
    for _ in range(2):
        v = v - known @ (known.T @ v)
    return v


def bidiagonalise(products: Callable, dim: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(B, V) with C V = U B, for as many directions as the rows of C span.

    ``products(a, A)`` gives the squared length of C a, the inner products of C a with the
    columns of C A, and C' C a. Directions are begun within the span of the rows, as the
    image of a random one, so that no a has a part that C does not see."""
    rng = np.random.default_rng(seed)
    nothing = np.zeros((dim, 0))
    right, makers, images = nothing, nothing, nothing  # v of each step; a and C' u of each u = C a
    b = np.zeros((dim, dim))
    largest = 0.0  # entry of B
    rest = np.zeros(dim)
    for k in range(dim):
        beta = np.linalg.norm(rest)
        if beta <= dim * np.finfo(float).eps * largest:  # the space so far is closed
            drawn = _without(rng.standard_normal(dim), right)
            rest = _without(products(drawn / np.linalg.norm(drawn), nothing)[2], right)
            if np.linalg.norm(rest) <= NOISE * largest**2:
                return b[:k, :k], right
        v = _without(rest / np.linalg.norm(rest), right)
        v /= np.linalg.norm(v)
        a, gone = v, np.zeros(k)
        for _ in range(3):
            square, along, image = products(a, makers)
            a, image, gone = a - makers @ along, image - images @ along, gone + along
            left = max(square - along @ along, 0.0)
            if left > 0.1 * square:  # else most of it was along earlier u: measure what is left
                break
        alpha = np.sqrt(left)
        largest = max(largest, alpha, *np.abs(gone))
        if alpha <= dim * np.finfo(float).eps * largest:
            alpha, a, image = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            a, image = a / alpha, image / alpha
        b[k, k] = alpha
        if k:
            b[k - 1, k] = gone[-1]
        right, makers, images = (np.column_stack(pair) for pair in ((right, v), (makers, a), (images, image)))
        rest = _without(image, right)
    return b, right


def fit(blocks: DataFrame, components: int = COMPONENTS, seed: int = 0) -> Fit | None:
    """The components of the blocks' rows; None without rows."""
    totals = _summed(blocks, lambda x: np.r_[len(x), x.sum(axis=0)], "bigint")
    if not len(totals):
        return None
    n, sums = int(totals[0]), totals[1:].astype(np.int64)

    def products(a: np.ndarray, makers: np.ndarray):
        def measure(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            u = c @ a
            return np.r_[u @ u, (c @ makers).T @ u, c.T @ u]

        found = _summed(blocks, measure)
        k = makers.shape[1]
        return found[0], found[1 : k + 1], found[k + 1 :]

    b, right = bidiagonalise(products, len(sums), seed)
    if not len(b):
        return Fit(n, sums, right, np.zeros(0), 0.0)
    _, singular, turned = np.linalg.svd(b)
    vectors = right @ turned.T
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    used = (singular > LEAST * singular[0]) & (np.arange(len(singular)) < components)
    e = singular**2 / n
    return Fit(n, sums, vectors[:, used], e[used], float(e.sum()))


def identity_error(blocks: DataFrame, fitted: Fit) -> float:
    """The largest entry of the whitened rows' covariance less the identity."""
    n, sums, turn = fitted.n, fitted.sums, fitted.vectors / np.sqrt(fitted.e)
    mean = _summed(blocks, lambda x: (_centred(x, n, sums) @ turn).sum(axis=0)) / n

    def measure(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ turn - mean
        return (w.T @ w).ravel()

    found = _summed(blocks, measure).reshape(len(mean), len(mean)) / n
    return float(np.abs(found - np.eye(len(mean))).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The squared length of n x - S, exactly."""
    gaps = n * x - sums
    if gaps.shape[1] * float(np.abs(gaps).max()) ** 2 < 2.0**62:
        return pa.array((gaps * gaps).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([sum(g * g for g in row) for row in gaps.tolist()], pa.decimal128(38, 0))


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id", seed: int = 0
) -> DataFrame:
    """(key, n, deviation decimal(38,0), whitened array<double>, explained array<double>,
    identity_error) of every row that counts: the arrays hold a value for each component."""
    rows = usable(vectors, vector, key)
    path = scratch_path(vectors.sparkSession, "vectors")
    rows.select("vector").mapInArrow(_packed, "rows bigint, block binary").write.parquet(path)
    blocks = vectors.sparkSession.read.schema("rows bigint, block binary").parquet(path)
    fitted = fit(blocks, components, seed)
    schema = T.StructType(
        [
            T.StructField(key, rows.schema["key"].dataType),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    if fitted is None or not len(fitted.e):
        n, explained, error = 0, [], 0.0
        found = vectors.sparkSession.createDataFrame([], schema)
    else:
        n, sums, turn = fitted.n, fitted.sums, fitted.vectors / np.sqrt(fitted.e)
        explained, error = (fitted.e / fitted.trace).tolist(), identity_error(blocks, fitted)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = _whole(batch.column(1))
                    w = _centred(x, n, sums) @ turn
                    lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel())
                    yield pa.RecordBatch.from_arrays([batch.column(0), _deviations(x, n, sums), lists], names=[key, "deviation", "whitened"])

        found = rows.mapInArrow(project, schema)
    return found.select(
        key,
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(x) for x in explained]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
