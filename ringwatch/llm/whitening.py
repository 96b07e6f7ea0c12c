"""Whitening of embeddings; covariances by polarisation of exact squared sums."""

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.session import Scratch, scratch_for

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Numbers of a matrix that a task works on at once.
BLOCK = 1 << 20
#: Scaled entries from here on do not fit the fixed-point numbers.
LARGEST = float(1 << 61)

#: Bits of a part of a total, so that sums of parts fit a decimal of 38 digits.
PART = 90

TOTAL = "i int, j int, part int, total decimal(38, 0)"
RESULT = (
    "vec_id long, component int, n long, deviation decimal(38, 0), whitened double, explained double, "
    "identity_error double"
)


def usable(vector: Column, scale: int = SCALE) -> Column:
    """Whether a vector has entries, all of them finite and within the fixed-point range."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)))
    return F.coalesce(fits & (F.size(vector) > 0), F.lit(False))


def fixed_point(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint") + F.lit(offset).cast("bigint"))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with their vectors as a matrix of 64-bit integers."""
    rows = max(1, BLOCK // dim)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _exact(matrix: np.ndarray, bound: int) -> np.ndarray:
    """The matrix as 64-bit integers while sums stay below ``bound``, as unbounded ones beyond."""
    return matrix.astype(np.int64) if bound < 1 << 62 else matrix.astype(object)


def _largest(matrix: np.ndarray) -> int:
    return max(int(matrix.max()), -int(matrix.min())) if matrix.size else 0


def _totals(entries: Iterator[tuple[int, int, int]]) -> pa.RecordBatch:
    """Totals of any size, in parts of ``PART`` bits."""
    rows = []
    for i, j, total in entries:
        sign, left, part = (-1 if total < 0 else 1), abs(int(total)), 0
        while left or not part:
            rows.append((i, j, part, Decimal(sign * (left & ((1 << PART) - 1)))))
            left, part = left >> PART, part + 1
    return pa.RecordBatch.from_arrays([
        *(pa.array([r[k] for r in rows], pa.int32()) for k in range(3)),
        pa.array([r[3] for r in rows], pa.decimal128(38, 0)),
    ], names=["i", "j", "part", "total"])


def _sums(dim: int):
    """Per task the exact sum of every dimension, as (i, i, total), and the number of rows, as (-1, -1, total)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(dim, object), 0
        for _, x in _blocks(batches, 0, dim):
            sums += _exact(x, _largest(x) * len(x)).sum(0).astype(object)
            n += len(x)
        if n:
            yield _totals([(-1, -1, n), *((i, i, s) for i, s in enumerate(sums))])

    return run


def _squares(dim: int, centre: list[int]):
    """Per task the exact squares about ``centre``: (i, i) of dimension i, (i, j) of the sum of i and j; (i, -1) plain sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centre, np.int64)
        squares, sums, n = np.zeros((dim, dim), object), np.zeros(dim, object), 0
        for _, x in _blocks(batches, 0, dim):
            y = x - middle
            y = _exact(y, (2 * _largest(y)) ** 2 * len(y))
            sums += y.sum(0).astype(object)
            for i in range(dim):
                squares[i, i] += int((y[:, i] * y[:, i]).sum())
                if i + 1 < dim:
                    pair = y[:, i + 1 :] + y[:, i : i + 1]
                    squares[i, i + 1 :] += (pair * pair).sum(0).astype(object)
            n += len(y)
        if n:
            yield _totals([
                *((i, -1, s) for i, s in enumerate(sums)),
                *((i, j, squares[i, j]) for i in range(dim) for j in range(i, dim)),
            ])

    return run


def _added(fit: DataFrame, task) -> dict[tuple[int, int], int]:
    """The totals of all tasks: a number per pair of dimensions reaches the driver."""
    totals = fit.mapInArrow(task, TOTAL).groupBy("i", "j", "part").agg(F.sum("total").alias("total"))
    found: dict[tuple[int, int], int] = {}
    for r in totals.collect():
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (int(r.total) << PART * r.part)
    return found


def covariance(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Number, sums and covariance of the rows of ``fit``: one column of ``dim`` 64-bit integers.

    The first pass gives the sums. The second centres every entry by the integer next to its mean
    and adds up squares, of every dimension and of the sum of every two; what the integer misses
    of the mean is taken off exactly. As var(a + b) = var(a) + var(b) + 2 cov(a, b), differences
    of these variances are the covariances. All of it is integer arithmetic up to one division.
    """
    first = _added(fit, _sums(dim))
    n, sums = first[-1, -1], [first[i, i] for i in range(dim)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    second = _added(fit, _squares(dim, centre))
    rest = [second[i, -1] for i in range(dim)]
    own = [n * second[i, i] - rest[i] ** 2 for i in range(dim)]
    matrix = np.empty((dim, dim))
    for i in range(dim):
        matrix[i, i] = own[i] / (n * n)
        for j in range(i + 1, dim):
            both = n * second[i, j] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - own[i] - own[j]) / (2 * n * n)
    return n, sums, matrix


def principal(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues, their unit eigenvectors as columns, and the trace.

    Eigenvalues that cannot be told from zero are left out. The largest entry of a vector is positive.
    """
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = values > max(values[0], 0) * len(matrix) * np.finfo(float).eps
    values, vectors = values[real], vectors[:, real]
    largest = np.abs(vectors).argmax(0)
    return values, vectors * np.sign(vectors[largest, np.arange(len(values))]), float(np.trace(matrix))


def _projected(x: np.ndarray, centre: np.ndarray, rest: np.ndarray, projection: np.ndarray) -> np.ndarray:
    return ((x - centre).astype(float) - rest) @ projection


def whiten(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``RESULT``: every usable row on the first principal components, each scaled to variance one.

    An entry c stands for the integer ``floor(scale c) + offset``. The model is fitted on every
    distinct integer vector once; ``n`` is their number. ``deviation`` is the sum over the dimensions
    of (n x - sum) squared (null beyond 38 digits), ``explained`` the component's share of the variance, ``identity_error``
    the largest difference of the whitened covariance, measured on the fitted vectors, from the identity.

    Null and empty vectors, and those with null, NaN, infinite or, at this scale, over 61-bit entries take
    no part; nor do vectors of another length than the commonest (of equally common ones the longest).
    Rows keep null and repeated ids and are answered one by one. There are fewer components than asked for
    where the distinct vectors vary in fewer directions, so a table of one vector or none gives no rows.
    Other columns are not read, whatever their names.

    A vector that much of the table repeats is combined before it moves. The driver gets a number
    per pair of dimensions, and tasks the projection; neither grows with the rows.
    """
    scratch = scratch_for(embeddings, scratch)
    values = F.col(f"`{vector}`")
    rows = embeddings.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), values.alias("v"))
    rows = rows.filter(usable(F.col("v"), scale))
    commonest = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    empty = embeddings.sparkSession.createDataFrame([], RESULT)
    if commonest is None:
        return empty
    dim = commonest.dim
    fixed = rows.filter(F.size("v") == dim).select("vec_id", fixed_point(F.col("v"), scale, offset).alias("x"))
    fit = scratch.cut(fixed.select("x").distinct(), "fit")
    n, sums, matrix = covariance(fit, dim)
    if not matrix.any():
        return empty
    found, vectors, trace = principal(matrix, components)
    projection = vectors / np.sqrt(found)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    centre, left = np.array(middle, np.int64), [s - n * m for s, m in zip(sums, middle)]
    rest = np.array([r / n for r in left])
    size, explained = len(found), found / trace

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total = np.zeros((size, size)), np.zeros(size)
        for _, x in _blocks(batches, 0, dim):
            w = _projected(x, centre, rest, projection)
            products += w.T @ w
            total += w.sum(0)
        cells = [(i, j, products[i, j]) for i in range(size) for j in range(size)]
        cells += [(i, -1, t) for i, t in enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(side) for side in zip(*cells)], schema=pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])
        )

    measured = fit.mapInArrow(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    cells = {(r.i, r.j): r.s / n for r in measured.collect()}
    error = max(
        abs(cells[i, j] - cells[i, -1] * cells[j, -1] - (i == j)) for i in range(size) for j in range(size)
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1, dim):
            w = _projected(x, centre, rest, projection)
            y = x - centre
            off = n * _exact(y, dim * (n * (_largest(y) + 1)) ** 2) - np.array(left)
            deviation = [Decimal(int(d)) if d < 10**38 else None for d in (off * off).sum(1)]
            count = len(x)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(np.repeat(np.arange(count), size))),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                pa.array(np.full(count * size, n, np.int64)),
                pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(count), size))),
                pa.array(w.ravel()),
                pa.array(np.tile(explained, count)),
                pa.array(np.full(count * size, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fixed.mapInArrow(project, RESULT)
