"""Whitening of vectors along the leading components of their covariance.

Entries are put on a grid, ``x = floor(scale * c)``, and each distinct ``x`` is fitted once.
Distinct vectors travel as packed bytes, of the fewest bytes an entry that hold the vector,
and are combined before the exchange, so a vector in a third of all rows is one row. The
covariance is a sum over partitions of products of centred vectors. They are centred on the
mean rounded to whole numbers, where products and sums are exact below 2^53, and the rest of
the mean is taken out at the end; so the covariance does not depend on how rows are dealt.

The matrix has the size of a vector squared, whatever the number of rows, and is decomposed
where it arrives: Householder reflections make it tridiagonal, Sturm counts bracket the
leading eigenvalues by bisection, inverse iteration gives their vectors, orthogonalised
anew within clusters of close eigenvalues, and the reflections turn these back. Arithmetic
is in extended precision where the machine has it. Mean and components, a few vectors, are
sent to all tasks, which project where rows are read.

Rows whose vector is null, or has null or non-finite entries, are dropped, and so are empty
vectors. Vectors of another length than that of most distinct ones (of the longest such, if
lengths tie) have no place in the space and are dropped too. Repeated rows and identifiers,
also null ones, each have their rows. Entries beyond the whole numbers of 64 bits count as
the nearest of these. A component without variance (eigenvalue below ``RANK_LIMIT`` of the
trace) cannot be scaled to one and is left out: one distinct vector, or none, gives no rows.
Eigenvalues that tie have one of their possible bases, the same for all rows. ``deviation``
is null where it does not fit a long. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from kerbside.sources.workspace import stored

SCALE = 256
RANK_LIMIT = 1e-13
CLUSTER = 1e-3  # of the tridiagonal matrix's norm: eigenvalues this close are made orthogonal
CHUNK = 4096  # rows multiplied at once

_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_EXTENDED = np.longdouble
_LONG = 2**63


@dataclass(frozen=True)
class Fit:
    """``components`` are unit rows by falling ``eigenvalues``; ``sums`` over the ``n`` distinct vectors."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def _grid(embeddings: DataFrame, vector: str, keep: list, scale: float) -> DataFrame:
    """``keep`` and ``x``, whole numbers, of the rows whose vector is complete."""
    entries = F.col(vector).cast("array<double>")
    whole = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))  # NaN is above infinity here
    x = F.transform(entries, lambda c: F.floor(F.least(F.greatest(c * F.lit(float(scale)), F.lit(-float(_LONG))), F.lit(float(_LONG - 1024)))).cast("long"))
    return embeddings.filter(F.coalesce((F.size(entries) > 0) & whole, F.lit(False))).select(*keep, x.alias("x"))


def _rows(column: pa.Array) -> list[np.ndarray]:
    """The vectors of an Arrow list column without nulls."""
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ends) else []


def _width(x: np.ndarray) -> int:
    low, high = int(x.min()), int(x.max())
    return next(i for i, kind in enumerate(_WIDTHS) if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max)


def _pack_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _rows(batch.column(0))
        widths = [_width(x) for x in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(x) for x in rows], pa.int32()), pa.array(widths, pa.int32()),
             pa.array([x.astype(_WIDTHS[w]).tobytes() for x, w in zip(rows, widths, strict=True)], pa.binary())], names=["size", "width", "packed"])


def _unpacked(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """Matrices of at most ``CHUNK`` vectors of (width, packed)."""
    for batch in batches:
        widths = batch.column("width").to_numpy(zero_copy_only=False)
        packed = np.array(batch.column("packed").to_pylist(), object)
        for w, kind in enumerate(_WIDTHS):
            own = packed[widths == w]
            for start in range(0, len(own), CHUNK):
                yield np.frombuffer(b"".join(own[start:start + CHUNK]), kind).reshape(-1, size).astype(np.int64)


def _sum_batches(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(place, amount) of every dimension, and the count as place -1, as decimals."""
    count, sums = 0, [0] * size
    for x in _unpacked(batches, size):
        count += len(x)
        # Halves of 32 bits: neither can overflow in a chunk.
        high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        sums = [s + (int(h) << 32) + int(v) for s, h, v in zip(sums, high, low, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([-1, *range(size)], pa.int32()), pa.array([str(v) for v in [count, *sums]])], names=["place", "amount"])


def _product_batches(batches: Iterable[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the matrix of this partition's products: (place, values)."""
    size = len(centre)
    total = np.zeros((size, size))
    for x in _unpacked(batches, size):
        y = (x - centre).astype(float)
        total += y.T @ y
    yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["place", "products"])


def _add_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows of one place; one row is held."""
    place, total = None, None
    for batch in batches:
        for own, values in zip(batch.column(0).to_pylist(), _rows(batch.column(1)), strict=True):
            if own == place:
                total += values
                continue
            if place is not None:
                yield _matrix_row(place, total)
            place, total = own, values.astype(_EXTENDED)
    if place is not None:
        yield _matrix_row(place, total)


def _matrix_row(place: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([total.astype(float)], pa.list_(pa.float64()))], names=["place", "products"])


def distinct_vectors(embeddings: DataFrame, vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """(size, width, packed) of each distinct grid vector, written out."""
    packed = _grid(embeddings, vector, [], scale).mapInArrow(_pack_batches, "size int, width int, packed binary")
    return stored(packed.distinct(), "distinct-vectors")


def fit(distinct: DataFrame, components: int) -> Fit | None:
    """The leading ``components`` of ``distinct_vectors``; None where there is no vector."""
    commonest = distinct.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if commonest is None:
        return None
    size = commonest["size"]
    own = distinct.filter(F.col("size") == size).select("width", "packed")
    amounts = (own.mapInArrow(lambda batches: _sum_batches(batches, size), "place int, amount string")
               .groupBy("place").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).collect())
    amounts = {r["place"]: int(r["amount"]) for r in amounts}
    n, sums = amounts[-1], [amounts[k] for k in range(size)]
    centre = [(2 * s + n) // (2 * n) for s in sums]  # rounded mean
    rows = (own.mapInArrow(lambda batches: _product_batches(batches, np.array(centre, np.int64)), "place int, products array<double>")
            .repartition("place").sortWithinPartitions("place").mapInArrow(_add_rows, "place int, products array<double>").collect())
    matrix = np.zeros((size, size), _EXTENDED)
    for row in rows:
        matrix[row["place"]] = row["products"]
    rest = np.array([s - n * c for s, c in zip(sums, centre, strict=True)], _EXTENDED) / n
    matrix = matrix / n - np.outer(rest, rest)
    trace = float(np.trace(matrix))
    values, vectors = leading_eigenpairs(matrix, min(components, size))
    solid = values > RANK_LIMIT * trace
    return Fit(n, sums, values[solid], vectors[solid], trace)


def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflections of the tridiagonal matrix similar to ``matrix``."""
    a = np.array(matrix, _EXTENDED)
    size, reflections = len(a), []
    for k in range(size - 2):
        v = a[k + 1:, k].copy()
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        length = v @ v
        if length > 0:
            v /= np.sqrt(length)
            p = a[k + 1:, k + 1:] @ v
            w = p - (v @ p) * v
            a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] -= 2 * v[0] * (v @ a[k + 1:, k])
        reflections.append(v)
    return np.diagonal(a).copy(), np.array([a[k + 1, k] for k in range(size - 1)], _EXTENDED), reflections


def sturm_count(diagonal: np.ndarray, off: np.ndarray, bound: float) -> int:
    """How many eigenvalues are below ``bound``: the negative pivots of ``T - bound``."""
    tiny = np.finfo(_EXTENDED).tiny ** _EXTENDED(0.5)
    count, pivot = 0, _EXTENDED(1)
    for k, d in enumerate(diagonal):
        pivot = d - bound - (off[k - 1] * off[k - 1] / pivot if k else 0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def bisected(diagonal: np.ndarray, off: np.ndarray, number: int) -> _EXTENDED:
    """The eigenvalue with ``number`` ones below it."""
    padded = np.abs(np.concatenate([[0], off, [0]]))
    radius = padded[:-1] + padded[1:]
    low, high = (diagonal - radius).min(), (diagonal + radius).max()
    while True:
        middle = (low + high) / 2
        if not low < middle < high:
            return middle
        if sturm_count(diagonal, off, middle) > number:
            high = middle
        else:
            low = middle


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """``(T - shift) y = right`` by elimination with exchange of neighbouring rows; pivots
    below ``least`` are taken as that, which is what inverse iteration needs."""
    size = len(diagonal)
    u0, u1, u2, y = diagonal - shift, np.append(off, 0), np.zeros(size, _EXTENDED), right.astype(_EXTENDED)
    for k in range(size - 1):
        below = (off[k], diagonal[k + 1] - shift, off[k + 1] if k + 2 < size else _EXTENDED(0))
        own = (u0[k], u1[k], u2[k])
        if abs(below[0]) > abs(own[0]):
            own, below = below, own
            y[k], y[k + 1] = y[k + 1], y[k]
        if abs(own[0]) < least:
            own = (_EXTENDED(least), own[1], own[2])
        factor = below[0] / own[0]
        u0[k], u1[k], u2[k] = own
        u0[k + 1], u1[k + 1], u2[k + 1] = below[1] - factor * own[1], below[2] - factor * own[2], 0
        y[k + 1] -= factor * y[k]
    for k in range(size - 1, -1, -1):
        pivot = u0[k] if abs(u0[k]) >= least else _EXTENDED(least)
        y[k] = (y[k] - (u1[k] * y[k + 1] if k + 1 < size else 0) - (u2[k] * y[k + 2] if k + 2 < size else 0)) / pivot
    return y


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix and their unit vectors, as
    rows; the largest entry of a vector is positive."""
    size = len(matrix)
    diagonal, off, reflections = householder(matrix)
    norm = float(np.max(np.abs(diagonal) + np.abs(np.append(off, 0)) + np.abs(np.append(0, off)))) or 1.0
    least = float(np.finfo(_EXTENDED).eps) * norm
    values = np.array([bisected(diagonal, off, size - 1 - k) for k in range(count)], _EXTENDED)
    vectors: list[np.ndarray] = []
    for k, value in enumerate(values):
        close = [v for v, other in zip(vectors, values, strict=False) if other - value <= CLUSTER * norm]
        y = np.random.default_rng(k).standard_normal(size).astype(_EXTENDED)
        for _ in range(5):
            y = solved(diagonal, off, value, y / np.sqrt(y @ y), least)
            y /= np.max(np.abs(y))
            for _ in range(2):  # the second pass removes what rounding left of the first
                for v in close:
                    y -= (v @ y) * v
        vectors.append(y / np.sqrt(y @ y))
    turned = np.array(vectors, _EXTENDED).reshape(count, size)
    for k in range(len(reflections) - 1, -1, -1):
        turned[:, k + 1:] -= 2 * np.outer(turned[:, k + 1:] @ reflections[k], reflections[k])
    for y in turned:
        y *= np.sign(y[np.argmax(np.abs(y))])
    return values.astype(float), turned.astype(float)


def whitened_rows(x: np.ndarray, model: Fit) -> np.ndarray:
    """Coordinates of grid vectors, one column per component."""
    mean = np.array([_EXTENDED(s) / model.n for s in model.sums])
    return np.asarray((x - mean).astype(float) @ model.components.T / np.sqrt(model.eigenvalues))


def deviations(x: np.ndarray, model: Fit) -> list[int | None]:
    """The sum of ``(n * x - S) ** 2`` over the entries of each row, exact."""
    reach = model.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, model.sums))
    if reach * reach * x.shape[1] < _LONG:
        found = ((model.n * x - np.array(model.sums, np.int64)) ** 2).sum(axis=1).tolist()
    else:
        found = ((model.n * x.astype(object) - np.array(model.sums, object)) ** 2).sum(axis=1).tolist()
    return [v if v < _LONG else None for v in found]


def _moment_batches(batches: Iterable[pa.RecordBatch], model: Fit) -> Iterator[pa.RecordBatch]:
    """(place, values): sums of whitened products, and of whitened values in the last place."""
    k = len(model.eigenvalues)
    total = np.zeros((k + 1, k))
    for x in _unpacked(batches, len(model.sums)):
        y = whitened_rows(x, model)
        total += np.vstack([y.T @ y, y.sum(axis=0)])
    yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["place", "products"])


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    own = distinct.filter(F.col("size") == len(model.sums)).select("width", "packed")
    rows = (own.mapInArrow(lambda batches: _moment_batches(batches, model), "place int, products array<double>")
            .repartition("place").sortWithinPartitions("place").mapInArrow(_add_rows, "place int, products array<double>").collect())
    found = np.array([r["products"] for r in sorted(rows, key=lambda r: r["place"])]) / model.n
    return float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(len(model.eigenvalues))).max())


def whitened(embeddings: DataFrame, components: int = 4, vector: str = "embedding", vec_id: str = "vec_id", scale: float = SCALE) -> DataFrame:
    """One row per remaining row and component: vec_id, component from 1, n, deviation,
    whitened, explained and identity_error."""
    distinct = distinct_vectors(embeddings, vector, scale)
    model = fit(distinct, components)
    kind = embeddings.select(F.col(vec_id)).schema[0].dataType
    schema = StructType([StructField("vec_id", kind), StructField("n", LongType()), StructField("deviation", LongType()),
                         StructField("component", IntegerType()), StructField("whitened", DoubleType())])
    error = identity_error(distinct, model) if model and len(model.eigenvalues) else 0.0
    shares = [float(e) / model.trace for e in model.eigenvalues] if model else []

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if shares else 0, CHUNK):
                part = batch.slice(start, CHUNK)
                ids, size, k = part.column(0), len(model.sums), len(shares)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                times = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(times)), pa.array(np.full(len(times), model.n)), pa.array(deviations(x, model), pa.int64()).take(pa.array(times)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(whitened_rows(x, model).ravel())],
                    names=["vec_id", "n", "deviation", "component", "whitened"])

    own = _grid(embeddings, vector, [F.col(vec_id).alias("vec_id")], scale).filter(F.size("x") == (len(model.sums) if model else 0))
    out = own.mapInArrow(project, schema)
    explained = F.element_at(F.array(*map(F.lit, shares)), F.col("component")) if shares else F.lit(None).cast("double")
    return out.select("vec_id", "component", "n", "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
