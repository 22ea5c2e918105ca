"""Whitening of embeddings by contour integration of the covariance's resolvent.

Spark counts and sums the quantised vectors exactly, in integers, so that no order of partitions changes a
digit of the covariance. The wanted eigenvalues are enclosed by an interval whose content is known from inertia
counts (the signs of a symmetric factorisation of the shifted matrix). Quadrature of complex shifted solves
along an ellipse around the interval filters a block of vectors onto its eigenspace, a Rayleigh-Ritz step extracts
the components, and the number found is held against the inertia count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries are stored as floor(SCALE * c) + SHIFT; what does not fit into 62 bits is held at that bound.
SCALE, SHIFT, BOUND = 1024.0, 100_000, 2.0**62
BLOCK = 4096
#: A component with less than this share of the trace counts as one without variance.
LEAST_SHARE = 1e-14


def negative_pivots(matrix: np.ndarray) -> int:
    """The number of negative eigenvalues of a symmetric matrix, from its factorisation with 1x1 and 2x2 pivots."""
    a, negative, alpha = np.array(matrix, float), 0, (1 + sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(a.diagonal())
        at = int(diagonal.argmax())
        off = np.abs(a - np.diag(a.diagonal()))
        row, column = np.unravel_index(off.argmax(), off.shape)
        if diagonal[at] == 0 and off[row, column] == 0:
            break
        if diagonal[at] >= alpha * off[row, column]:
            chosen = [at]
            negative += int(a[at, at] < 0)
        else:
            chosen = [int(row), int(column)]  # its determinant is negative: one eigenvalue on either side of zero
            negative += 1
        rest = np.setdiff1d(np.arange(len(a)), chosen)
        side = a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(chosen, chosen)], side.T)
        a = (a + a.T) / 2
    return negative


def count_above(matrix: np.ndarray, bound: float) -> int:
    """How many eigenvalues lie above ``bound``."""
    return negative_pivots(bound * np.eye(len(matrix)) - matrix)


def lower_bound(matrix: np.ndarray, wanted: int, top: float) -> tuple[float, int]:
    """A bound below the ``wanted`` largest eigenvalues, in the widest gap found there, and how many lie above it.

    Eigenvalues that agree to rounding with the last one wanted lie above the bound too.
    """
    low, high, tiny = -top * 1e-9, top, top * 1e-13
    while high - low > tiny:  # from above: the largest bound with at least the wanted number above it
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(matrix, middle) >= wanted else (low, middle)
    edge = low
    above = count_above(matrix, edge - 8 * tiny)
    below, high = -top * 1e-9, edge - 8 * tiny
    if count_above(matrix, below) == above:
        return below, above
    while high - below > max(tiny, (edge - high) / 8):  # the next eigenvalue below, to an eighth of the gap
        middle = (below + high) / 2
        below, high = (middle, high) if count_above(matrix, middle) > above else (below, middle)
    return (high + edge) / 2, above


def contour_components(matrix: np.ndarray, wanted: int, nodes: int = 16, most_steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors as columns.

    ``nodes`` points of the upper half ellipse are used, as the lower half gives the conjugate. The block has more
    vectors than the interval has eigenvalues; values outside are damped by the filter and left out by the interval.
    Raises ArithmeticError if the number found differs from the inertia count.
    """
    size = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
    if not top:
        return np.zeros(min(wanted, size)), np.eye(size)[:, :wanted]
    low, inside = lower_bound(matrix, min(wanted, size), top)
    high = top * (1 + 1e-6)
    center, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turns = np.pi / 2 * (1 - points)
    # A flat ellipse keeps the points close to the interval, and so the filter steep at its ends.
    flat = 0.3
    shifts = center + radius * (np.cos(turns) + 1j * flat * np.sin(turns))
    factors = weights * radius * (flat * np.cos(turns) + 1j * np.sin(turns)) / 2
    block = np.random.default_rng(12).standard_normal((size, min(size, 2 * inside + 8)))
    identity = np.eye(size)
    for _ in range(most_steps):
        block, _ = np.linalg.qr(block)
        filtered = np.zeros_like(block)
        for shift, factor in zip(shifts, factors, strict=True):
            filtered += (factor * np.linalg.solve(shift * identity - matrix, block.astype(complex))).real
        basis, _ = np.linalg.qr(filtered)
        small = basis.T @ matrix @ basis
        values, inner = np.linalg.eigh((small + small.T) / 2)
        block = basis @ inner
        within = values > low
        error = np.abs(matrix @ block[:, within] - block[:, within] * values[within]).max(initial=0.0)
        if int(within.sum()) == inside and error <= 4e-15 * top:
            break
    if int(within.sum()) != inside or error > 1e-11 * top:
        raise ArithmeticError(f"{int(within.sum())} of {inside} eigenvalues found, residual {error}")
    order = np.flatnonzero(within)[::-1][:wanted]
    vectors = block[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.sign(vectors[largest, np.arange(len(order))])


@dataclass
class Whitening:
    """What is learned from all vectors: their number and sums, the covariance, its components."""

    count: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The quantised entries of the vectors, one in a row."""
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)
    return np.floor(np.clip(entries * SCALE, -BOUND, BOUND)).astype(np.int64) + SHIFT


def usable(vector: Column) -> Column:
    """Vectors with entries, all of them there and finite."""
    whole = F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def _exact_totals(source: DataFrame, size: int, of: Callable[[np.ndarray], np.ndarray], width: int) -> list[int]:
    """The sum over blocks of rows of ``of(block)``, ``size`` integers of any length; a task gives one row for each of them."""

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size, object), False
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                total, some = total + of(_matrix(batch.slice(at, BLOCK).column("_x"), width)), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["cell", "part"])

    sums = source.select("_x").mapInArrow(totals, "cell int, part decimal(38,0)").groupBy("cell").agg(F.sum("part").alias("total"))
    return [int(r["total"]) for r in sorted(sums.collect(), key=lambda r: r["cell"])]  # ``size`` rows, whatever the number of vectors


def fit(source: DataFrame, components: int = 8) -> Whitening:
    """Count, sums, covariance and components of all rows of ``source``, whose ``_x`` are usable vectors.

    The sums are centred by the rounded mean before they are multiplied, and corrected exactly for the rounding.
    """
    lengths = source.groupBy(F.size("_x").alias("width")).agg(F.count(F.lit(1)).alias("n")).limit(2).collect()
    if not lengths:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)), 0.0)
    if len(lengths) > 1:
        raise ValueError("vectors of different lengths have no common covariance")
    width, n = lengths[0]["width"], lengths[0]["n"]
    sums = _exact_totals(source, width, lambda x: (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0), width)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    rows, columns = np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        y = x - np.array(middle, np.int64)
        if int(np.abs(y).max(initial=0)) ** 2 * len(y) < 1 << 53:  # exact in doubles too
            return (y.astype(float).T @ y.astype(float))[rows, columns].astype(np.int64).astype(object)
        return (y.astype(object).T @ y.astype(object))[rows, columns]

    covariance = np.zeros((width, width))
    for i, j, cell in zip(rows, columns, _exact_totals(source, len(rows), products, width), strict=True):
        covariance[i, j] = covariance[j, i] = (n * cell - rest[i] * rest[j]) / (n * n)  # integers up to the division
    values, vectors = contour_components(covariance, min(components, width))
    return Whitening(n, sums, covariance, values, vectors, float(covariance.trace()))


def _sums_of_squares(y: np.ndarray, n: int, left: np.ndarray) -> list[Decimal | None]:
    """Per row the sum of (n * y - left) squared, exact; null beyond 38 digits."""
    if int(np.abs(y).max(initial=0)) * n + n < 1 << 54 and y.shape[1] <= 512:
        scaled = y * n - left
        high, low = scaled >> 27, scaled & ((1 << 27) - 1)
        parts = ((high * high).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(), (low * low).sum(axis=1).tolist())
        return [Decimal((a << 54) + (b << 28) + c) for a, b, c in zip(*parts, strict=True)]
    big = y.astype(object) * n - left.astype(object)
    return [Decimal(v) if (v := int(s)) < 10**38 else None for s in (big * big).sum(axis=1)]


def transform(source: DataFrame, model: Whitening, key: str) -> DataFrame:
    """key, deviation and ``_w``, the whitened entries by component, of every row of ``source``.

    ``deviation`` is the exact sum over dimensions of (n * x - sum) squared. A component without variance has
    null entries.
    """
    width, n = len(model.sums), model.count
    floor = model.trace * LEAST_SHARE
    scales = [1 / sqrt(e) if e > floor else None for e in model.values]
    middle = np.array([s // n for s in model.sums] if n else [], np.int64)
    left = np.array([s % n for s in model.sums] if n else [], np.int64)
    shared = source.sparkSession.sparkContext.broadcast((model.vectors, scales, middle, left))

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, factors, middle, left = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                y = _matrix(part.column("_x"), width) - middle  # n * x - sum = n * y - left
                scores = (y - left / n) @ vectors
                columns = [[None] * len(y) if f is None else (scores[:, i] * f).tolist() for i, f in enumerate(factors)]
                entries = pa.array(list(map(list, zip(*columns, strict=True))), pa.list_(pa.float64()))
                deviation = pa.array(_sums_of_squares(y, n, left), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([part.column("_k"), deviation, entries], [key, "deviation", "_w"])

    kind = source.schema[key].dataType.simpleString()
    return source.select(F.col(key).alias("_k"), "_x").mapInArrow(project, f"`{key}` {kind}, deviation decimal(38,0), _w array<double>")


def identity_error(projected: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened values' covariance less the identity, over components with variance."""
    used = [i for i, e in enumerate(model.values) if e > model.trace * LEAST_SHARE]
    if not used:
        return 0.0
    w = {i: F.col("_w")[i] for i in used}
    pairs = [(i, j) for i in used for j in used if i <= j]
    # The entries are centred on the exact mean, so theirs is zero but for rounding.
    found = projected.agg(*[F.avg(w[i]).alias(f"m{i}") for i in used], *[F.avg(w[i] * w[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"{i}_{j}"] - found[f"m{i}"] * found[f"m{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """key, component (from 1), n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    Vectors that are null, empty or hold a null or non-finite entry are left out; repeated rows and null keys
    count like any others. Equal eigenvalues are ordered as the extraction gives them. There are as many components as
    dimensions, ``components`` at most; one without variance has a null ``whitened`` and no share. ``deviation`` is
    decimal(38,0). An empty table gives no rows; vectors of different lengths raise ValueError. Nothing but sums by
    dimension and by pair of dimensions reaches the driver, and no other column of ``df`` is read.
    """
    source = df.where(usable(F.col(vector))).select(F.col(key), F.col(vector).alias("_x"))
    model = fit(source, components)
    projected = transform(source, model, key)
    error = identity_error(projected, model) if model.count else 0.0
    shares = F.array(*[F.lit(float(e / model.trace) if model.trace else 0.0) for e in model.values])
    rows = projected.select(key, "deviation", F.posexplode("_w").alias("_c", "whitened"))
    return rows.select(
        key, (F.col("_c") + 1).alias("component"), F.lit(model.count).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("_c")).alias("explained"), F.lit(error).alias("identity_error"),
    )
