"""Whitening of embeddings onto their first components, by mixed-precision eigenvectors.

Entries become whole numbers, so sums over all rows are exact however Spark deals them: counts
and sums first, then products of entries moved by the rounded mean, and the part of the mean
that rounding left is taken off in whole numbers. What reaches the driver is one covariance
matrix, bounded by the square of the dimension.

Its eigenvectors start as those of the matrix in float32. Ogita and Aishima's iteration, matrix
products in extended precision, corrects them: each round about doubles the right digits. It
cannot part eigenvalues that lie closer than the error of the round; the vectors of such a
cluster are turned by a sub-solve: the matrix on their span, moved by the mean eigenvalue and
scaled, is solved in the same way, where their distances are no longer small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import store

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
HIGH = np.longdouble  # the higher precision
EPS = float(np.finfo(HIGH).eps)
ROUNDS = 12
MARGIN = 64
DEPTH = 6  # clusters within clusters; each level is closer by a factor of about 10^5
LIMB = 20  # bits of a factor, so that sums over ROWS products are exact in a double
ROWS = 1 << 12
SPLIT = 40  # bits of the lower part of a sum
LONG = 1 << 63


# -- eigenvectors -------------------------------------------------------------------------


def eigenvectors(matrix: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision.

    Vectors of equal eigenvalues are an orthonormal basis of their space.
    """
    a = matrix.astype(HIGH)
    n = len(a)
    norm = HIGH(np.abs(a).max()) if n else HIGH(0)
    if not norm:
        return np.zeros(n, HIGH), np.eye(n, dtype=HIGH)
    a = a / norm
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x.astype(HIGH)
    # The start is orthogonal to float32 only; products in extended precision mend that first.
    for _ in range(3):
        x = _orthogonal(x)
    before = np.inf
    for _ in range(ROUNDS):
        values, x, error, change = _refine(a, x)
        if change <= 4 * EPS or change >= before / 2 and change < 1e-12:
            break
        before = change
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    for first, last in _clusters(values, error):
        mean = values[first:last].mean()
        span = x[:, first:last]
        moved = span.T @ ((a - mean * np.eye(n, dtype=HIGH)) @ span)
        moved = (moved + moved.T) / 2
        if depth and np.abs(moved).max() > 8 * n * EPS:
            own, turn = eigenvectors(moved, depth - 1)
            values[first:last], x[:, first:last] = own + mean, span @ turn
    return values * norm, _orthogonal(_orthogonal(x))


def _orthogonal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made twice as nearly so."""
    return x + x @ ((np.eye(x.shape[1], dtype=HIGH) - x.T @ x) / 2)


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One iteration: eigenvalues, corrected vectors, the distance below which values count as one, the change."""
    n = len(a)
    loss = np.eye(n, dtype=HIGH) - x.T @ x
    on = x.T @ (a @ x)
    values = np.diag(on) / (1 - np.diag(loss))
    off = on - np.diag(values)
    error = 2 * (np.linalg.norm(off.astype(float), 2) + np.linalg.norm(a.astype(float), 2) * np.linalg.norm(loss.astype(float), 2))
    gap = values[None, :] - values[:, None]
    # A pair that is barely apart would be turned too far for the next round to mend.
    error *= MARGIN
    apart = np.abs(gap) > error
    correction = np.where(apart, (on + values[None, :] * loss) / np.where(apart, gap, 1), loss / 2)
    return values, x + x @ correction, float(error), float(np.abs(correction).max())


def _clusters(values: np.ndarray, error: float) -> list[tuple[int, int]]:
    """Runs of falling values whose neighbours are no further apart than the error."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > error) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1]


# -- exact sums ---------------------------------------------------------------------------


def _whole(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    """x of each entry, a row a vector."""
    flat = batch[name].flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(flat * SCALE).astype(np.int64) + SHIFT


def _split(value: int) -> tuple[int, int]:
    return value >> SPLIT, value & ((1 << SPLIT) - 1)


def _summed(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by place: two parts are added up by Spark, and put together here."""
    summed = rows.groupBy("i", "j").agg(F.sum("upper").alias("upper"), F.sum("lower").alias("lower"))
    return {(row["i"], row["j"]): (row["upper"] << SPLIT) + row["lower"] for row in summed.collect()}


PLACES = "i int, j int, upper bigint, lower bigint"


def _places(entries: list[tuple[int, int, int]]) -> pa.RecordBatch:
    split = [_split(value) for _, _, value in entries]
    columns = [[i for i, _, _ in entries], [j for _, j, _ in entries], [u for u, _ in split], [v for _, v in split]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)], ["i", "j", "upper", "lower"]
    )


def _add_up(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the sums of x in each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, object)
        for batch in batches:
            x = _whole(batch, "vector", size)
            n += len(x)
            # Halves of 32 bits, so that no sum over a batch leaves a long.
            sums = sums + ((x >> 32).sum(axis=0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        yield _places([(-1, 0, n), *[(k, 0, int(total)) for k, total in enumerate(sums)]])

    found = _summed(vectors.select("vector").mapInArrow(run, PLACES))
    return found.get((-1, 0), 0), [found.get((k, 0), 0) for k in range(size)]


def _products(z: np.ndarray) -> np.ndarray:
    """z'z exactly, as Python's whole numbers; z is cut into limbs where its entries are large."""
    count = max(1, -(-int(np.abs(z).max(initial=0)).bit_length() // LIMB))
    limbs = [(z >> (LIMB * k)) & ((1 << LIMB) - 1) if k < count - 1 else z >> (LIMB * k) for k in range(count)]
    limbs = [limb.astype(float) for limb in limbs]
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for a, left in enumerate(limbs):
        for b, right in enumerate(limbs):
            total = total + ((left.T @ right).astype(np.int64).astype(object) << (LIMB * (a + b)))
    return total


def _multiply(vectors: DataFrame, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of products of centred entries, for i <= j."""
    size = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        for batch in batches:
            z = _whole(batch, "vector", size) - centre
            for first in range(0, len(z), ROWS):
                total = total + _products(z[first : first + ROWS])
        yield _places([(i, j, int(total[i, j])) for i in range(size) for j in range(i, size)])

    return _summed(vectors.select("vector").mapInArrow(run, PLACES))


def _high(value: int) -> np.longdouble:
    """A whole number in extended precision."""
    upper = float(value)
    return HIGH(upper) + HIGH(float(value - int(upper)))


# -- the operator -------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitener:
    """The fit: number of vectors, sums, components (columns, in extended precision), eigenvalues, shares of the trace."""

    n: int
    sums: list[int]
    centre: np.ndarray
    covariance: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: list[float]


def usable(rows: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """Rows with a whole vector, and its dimension.

    The dimension is the most frequent length (of equally frequent ones the greatest). A
    vector is left out that is null, of another length, or holds a null, a value that is not
    finite, or one whose x would not fit a long.
    """
    lengths = rows.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("size")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    if top is None:
        return rows.where("false"), 0
    limit = float(LONG // SCALE // 2)
    fine = F.forall(vector_col, lambda c: F.coalesce(F.abs(c.cast("double")) < limit, F.lit(False)) & ~F.isnan(c.cast("double")))
    return rows.where((F.size(vector_col) == top["size"]) & fine), top["size"]


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitener:
    """Fit to all rows of `vectors`, whose column `vector` holds `size` doubles.

    Components whose eigenvalue is zero to double precision cannot be whitened and are left out.
    """
    n, sums = _add_up(vectors, size)
    centre = np.array([(2 * s + n) // (2 * n) if n else 0 for s in sums], np.int64)
    products = _multiply(vectors, centre) if n else {}
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    scaled = np.zeros((size, size), object)
    for (i, j), value in products.items():
        scaled[i, j] = scaled[j, i] = n * value - rest[i] * rest[j]
    trace = sum(int(scaled[k, k]) for k in range(size))
    covariance = np.array([[_high(int(v)) / _high(max(1, n * n)) for v in row] for row in scaled], HIGH).reshape(size, size)
    values, x = eigenvectors(covariance)
    kept = [k for k in range(min(components, size)) if trace and values[k] > size * np.finfo(float).eps * values[0]]
    x = x[:, kept]
    # Either sign will do; the largest entry is positive.
    x = x * np.where(np.take_along_axis(x, np.abs(x).argmax(axis=0)[None, :], 0) < 0, -1, 1) if kept else x
    explained = [float(values[k] * _high(n * n) / _high(trace)) for k in kept]
    return Whitener(n, sums, centre, covariance, x, values[kept], explained)


def whiten(
    rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and component.

    All usable rows are fitted and whitened, repeated rows and null ids too; see usable() for
    the others. `deviation` is null where it does not fit a long. A constant table, one row or
    no rows have no component and give no rows. Other columns are ignored.
    """
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    vectors, size = usable(rows, "vector")
    found = fit(vectors, size, components)
    n, sums, centre = found.n, found.sums, found.centre
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    offset = np.array([r / n if n else 0.0 for r in rest])
    turn = (found.components / np.sqrt(found.eigenvalues)).astype(float)

    def deviations(z: np.ndarray) -> list[int | None]:
        if not len(z):
            return []
        largest = n * int(np.abs(z).max()) + max(abs(r) for r in rest)
        if largest < 1 << 31 or largest * largest * size < LONG:
            t = n * z - np.array(rest, np.int64)
            return (t * t).sum(axis=1).tolist()
        totals = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in z.tolist()]
        return [total if total < LONG else None for total in totals]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _whole(batch, "vector", size) - centre
            white = (z - offset) @ turn
            offsets = pa.array(np.arange(len(z) + 1) * white.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(white.reshape(-1), pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(deviations(z), pa.int64()), lists], ["vec_id", "deviation", "white"]
            )

    white = store(vectors.mapInArrow(run, "vec_id bigint, deviation bigint, white array<double>"), "whitened")
    error = identity_error(white, len(found.explained))
    shares = F.array(*[F.lit(share) for share in found.explained]) if found.explained else F.array().cast("array<double>")
    return white.select("vec_id", "deviation", F.posexplode("white").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def identity_error(white: DataFrame, components: int) -> float | None:
    """The largest absolute entry of the covariance of `white` minus the identity; null without components."""
    if not components:
        return None
    entry = [F.col("white")[k] for k in range(components)]
    means = white.agg(*[F.avg(value) for value in entry]).first()
    centred = [value - F.lit(mean) for value, mean in zip(entry, means, strict=True)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    products = white.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, products, strict=True))
