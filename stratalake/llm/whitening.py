"""Embedding whitening: exact covariance, spectral divide-and-conquer by QDWH polar decompositions, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import work_folder

# Entries become floor(64 * c) + 1000000.
STEPS, SHIFT = 64, 1_000_000
# An entry of this many steps or more (its square would not fit a long) is an error.
LARGEST = 1 << 31
SLICE_ROWS = 2048
# Directions with less than this share of the variance cannot be told from rounding and are no components.
LEAST_SHARE = 1e-13

_MOMENT_SCHEMA = "i int, n long, dim int, sum_high long, sum_low long, high array<long>, low array<long>"
_MOMENT_ARROW = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("dim", pa.int32()), ("sum_high", pa.int64()), ("sum_low", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])
_WHITE_SCHEMA = "vec_id long, deviation long, whitened array<double>"
_WHITE_ARROW = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])


class Moments(NamedTuple):
    """Row count, sums and sums of products of the whole-number entries without SHIFT, as exact integers."""

    n: int
    sums: list[int]
    products: list[list[int]]


class Components(NamedTuple):
    """Unit eigenvectors as columns, by falling eigenvalue, and the trace of the covariance."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float


# --- rows as whole numbers ------------------------------------------------------------------------


def quantised(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows take part, their lengths, and their entries floor(64 * c) one after another."""
    lists = batch.column(1)
    offsets = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
    flat = lists.flatten() if lists.null_count == 0 else lists.values.slice(lists.offsets[0].as_py(), int(offsets[-1]))
    entries = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(entries))))
    present = np.asarray(lists.is_valid().to_numpy(zero_copy_only=False), bool)
    good = present & (bad[offsets[1:]] == bad[offsets[:-1]])
    lengths = np.where(good, np.diff(offsets), 0)
    entries = entries[np.repeat(good, np.diff(offsets))]
    steps = np.floor(entries * STEPS)
    if len(steps) and np.abs(steps).max() >= LARGEST:
        raise ValueError(f"an entry of {entries[np.abs(steps).argmax()]} is too large to whiten exactly")
    return good, lengths[good], steps.astype(np.int64)


def matrix(lengths: np.ndarray, entries: np.ndarray, dim: int) -> np.ndarray:
    """Rows of ``dim`` entries; missing ones count as 0."""
    if len(lengths) and (lengths == dim).all():
        return entries.reshape(len(lengths), dim)
    made = np.zeros((len(lengths), dim), np.int64)
    made[np.arange(dim) < lengths[:, None]] = entries
    return made


def _products(y: np.ndarray) -> np.ndarray:
    """y' y exactly: as doubles where no sum can exceed 2^53, else in Python's integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < 1 << 53:
        wide = y.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = y.astype(object)
    return wide.T @ wide


def _partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per dimension and task: its sum and its row of products, as high and low halves that longs can add up."""
    n, sums, products = 0, np.zeros(0, object), np.zeros((0, 0), object)
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            good, lengths, entries = quantised(batch.slice(at, SLICE_ROWS))
            if not len(lengths):
                continue
            dim = max(len(sums), int(lengths.max()))
            if dim > len(sums):
                grown = np.zeros((dim, dim), object)
                grown[: len(sums), : len(sums)] = products
                sums, products = np.concatenate((sums, np.zeros(dim - len(sums), object))), grown
            y = matrix(lengths, entries, dim)
            n += len(y)
            sums = sums + y.astype(object).sum(axis=0)
            products = products + _products(y)
    if not n:
        return
    low = (1 << 32) - 1
    dim = len(sums)
    rows = [(i, n, dim, sums[i] >> 32, sums[i] & low, [p >> 32 for p in products[i]], [p & low for p in products[i]]) for i in range(dim)]
    # A task whose vectors are all empty still counts its rows.
    rows = rows or [(-1, n, 0, 0, 0, [], [])]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MOMENT_ARROW)], schema=_MOMENT_ARROW)


def moments(vectors: DataFrame) -> Moments:
    """Exact moments of (vec_id, vector) rows. Tasks add up their rows; a grouping adds up the tasks; dim^2 numbers come to the driver."""
    partial = vectors.mapInArrow(_partial, _MOMENT_SCHEMA)
    folder = work_folder(vectors.sparkSession, "moments")
    partial.write.parquet(folder)
    partial = vectors.sparkSession.read.schema(_MOMENT_SCHEMA).parquet(folder)
    cells = partial.select("i", F.posexplode(F.arrays_zip("high", "low")).alias("j", "cell"))
    cells = cells.groupBy("i", "j").agg(F.sum("cell.high").alias("high"), F.sum("cell.low").alias("low"))
    alone = partial.where("i >= 0").groupBy("i").agg(F.sum("sum_high").alias("high"), F.sum("sum_low").alias("low"))
    # Every task gives its row count with each of its dimensions; its first one stands for the task.
    counted = partial.where("i <= 0").agg(F.sum("n")).first()[0] or 0
    dim = partial.agg(F.max("dim")).first()[0] or 0
    sums, products = [0] * dim, [[0] * dim for _ in range(dim)]
    for i, high, low in alone.collect():
        sums[i] = (high << 32) + low
    for i, j, high, low in cells.collect():
        products[i][j] = (high << 32) + low
    return Moments(counted, sums, products)


def covariance(m: Moments) -> np.ndarray:
    """The covariance with divisor n: centred in whole numbers, rounded to doubles once."""
    square = m.n * m.n
    return np.array([[float(Fraction(m.n * m.products[i][j] - m.sums[i] * m.sums[j], square)) for j in range(len(m.sums))] for i in range(len(m.sums))]).reshape(len(m.sums), len(m.sums))


# --- spectral divide and conquer ------------------------------------------------------------------


def polar_factor(a: np.ndarray, tolerance: float = 1e-15) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH: dynamically weighted Halley steps on QR factors.

    ``low`` bounds the smallest singular value of the iterate from below and sets the weights; from any bound above 10^-16
    six steps suffice.
    """
    n = len(a)
    x = a / np.linalg.norm(a, 2 if n == 1 else "fro")
    low = 1e-17
    for _ in range(12):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square)) if square < 1 else 0.0
        root = np.sqrt(1 + d)
        weight_a = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        weight_b = (weight_a - 1) ** 2 / 4
        weight_c = weight_a + weight_b - 1
        q, _ = np.linalg.qr(np.concatenate((np.sqrt(weight_c) * x, np.eye(n))))
        moved = weight_b / weight_c * x + (weight_a - weight_b / weight_c) / np.sqrt(weight_c) * (q[:n] @ q[n:].T)
        change = np.linalg.norm(moved - x)
        x = (moved + moved.T) / 2
        low = min(1.0, low * (weight_a + weight_b * square) / (1 + weight_c * square))
        if low > 1 - 1e-15 and change <= np.cbrt(tolerance):
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns: the first ``rank`` span the projector's range, the others its complement.

    Columns are taken by largest remaining norm, which for a projector keeps them well apart; a second pass through the
    projector removes what rounding added.
    """
    rest, picked = projector.copy(), []
    for _ in range(rank):
        column = rest[:, np.argmax((rest * rest).sum(axis=0))]
        column = column / np.linalg.norm(column)
        picked.append(column)
        rest = rest - np.outer(column, column @ rest)
    inside = np.linalg.qr(projector @ np.array(picked).T)[0]
    return np.concatenate((inside, np.linalg.qr(inside, mode="complete")[0][:, rank:]), axis=1)


def divide(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix by spectral divide and conquer.

    The polar factor U of ``a - s I`` gives the projector (I + U) / 2 onto the eigenvectors above the shift s. Its range and
    complement are invariant, so both restrictions are divided in turn, down to single vectors. A restriction that is a
    multiple of the identity within rounding of ``scale`` needs no division: there every basis is one of eigenvectors.
    """
    n = len(a)
    if n == 1:
        return a[0, :1].copy(), np.ones((1, 1))
    middle = np.trace(a) / n
    if np.linalg.norm(a - middle * np.eye(n)) <= 4 * np.finfo(float).eps * scale:
        return np.diag(a).copy(), np.eye(n)
    spread = np.linalg.norm(a - middle * np.eye(n)) / np.sqrt(n)
    best = None
    # The median of the diagonal splits evenly; the mean always splits; the others avoid a shift that meets an eigenvalue.
    for shift in (np.median(np.diag(a)), middle, middle + 0.1 * spread, middle - 0.1 * spread, middle + 0.37 * spread, middle - 0.37 * spread):
        projector = (np.eye(n) + polar_factor(a - shift * np.eye(n))) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n:
            continue
        basis = _basis(projector, rank)
        turned = basis.T @ a @ basis
        left = np.linalg.norm(turned[rank:, :rank])
        if best is None or left < best[0]:
            best = left, rank, basis, turned
        if left <= 16 * n * np.finfo(float).eps * scale:
            break
    if best is None:
        raise ArithmeticError("no shift divides the spectrum")
    _, rank, basis, turned = best
    parts = [divide((x + x.T) / 2, scale) for x in (turned[:rank, :rank], turned[rank:, rank:])]
    values = np.concatenate([p[0] for p in parts])
    return values, np.concatenate((basis[:, :rank] @ parts[0][1], basis[:, rank:] @ parts[1][1]), axis=1)


def components(covariance: np.ndarray, most: int) -> Components:
    """The first ``most`` eigenvectors, each with its largest entry positive; directions without variance are left out."""
    if not len(covariance) or not np.trace(covariance) > 0:
        return Components(np.zeros((len(covariance), 0)), np.zeros(0), float(np.trace(covariance)) if len(covariance) else 0.0)
    scale = np.linalg.norm(covariance)
    _, vectors = divide(covariance / scale, 1.0)
    # The values from the original matrix: division has rounded its restrictions.
    values = np.einsum("ij,ij->j", vectors, covariance @ vectors) / (vectors * vectors).sum(axis=0)
    trace = float(np.trace(covariance))
    order = [k for k in np.argsort(-values, kind="stable") if values[k] > LEAST_SHARE * trace][:most]
    vectors = vectors[:, order] / np.linalg.norm(vectors[:, order], axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return Components(vectors * signs, values[order], trace)


# --- whitening ------------------------------------------------------------------------------------


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - S)^2, in Python's integers where 64 bits could overflow; null beyond a long."""
    if not y.shape[1]:
        return [0] * len(y)
    most = n * int(np.abs(y).max(initial=0)) + max(abs(s) for s in sums)
    if most * most * y.shape[1] < 1 << 63:
        apart = y * np.int64(n) - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = y.astype(object) * n - np.array(sums, object)
    return [d if d < 1 << 63 else None for d in (apart * apart).sum(axis=1).tolist()]


def _projected(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, weights = shared.value
        mean = np.array([float(Fraction(s, n)) for s in sums])
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                good, lengths, entries = quantised(part)
                y = matrix(lengths, entries, len(sums))
                white = (y - mean) @ weights
                ids = part.column(0).filter(pa.array(good))
                offsets = pa.array(np.arange(len(y) + 1) * weights.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(_deviations(y, n, sums), pa.int64()), lists], schema=_WHITE_ARROW)

    return run


def _white_moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums and sums of products of whitened values, one row per component."""
    n, total = 0, None
    for batch in batches:
        white = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        white = np.concatenate((white, np.ones((len(white), 1))), axis=1)
        total = white.T @ white if total is None else total + white.T @ white
        n += len(white)
    if n:
        size = len(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(size), size), pa.int32()), pa.array(np.tile(np.arange(size), size), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])


def identity_error(white: DataFrame, n: int, size: int) -> float:
    """The largest absolute entry of the covariance of the whitened rows, as written, minus the identity."""
    if not size:
        return 0.0
    sums = np.zeros((size + 1, size + 1))
    for i, j, s in white.select("whitened").mapInArrow(_white_moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        sums[i, j] = s
    mean = sums[size, :size] / n
    return float(np.abs(sums[:size, :size] / n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, most: int = 32, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Every row on the first ``most`` principal components, with unit variance: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    An entry c becomes the whole number x = floor(64 * c) + 1000000. Rows whose vector is null or holds null or non-finite entries
    are left out; all others make the covariance (divisor n, exact until it is rounded once). Components are numbered from 1 by
    falling variance; ``deviation`` is the exact sum of (n * x - S)^2, null if it exceeds a long. ``identity_error`` is
    measured on the whitened rows.

    Ids may be null or repeat; each row counts. A vector shorter than the longest counts as ended by zeros. Entries of 2^31 steps or
    more are an error. Directions without variance are no components, so a single row, equal rows, empty vectors and an empty table
    give no rows. Other columns are not read. dim^2 sums come to the driver, and dim * ``most`` weights are broadcast: both are
    bounded by the length of a vector, whatever the number of rows.
    """
    spark = vectors.sparkSession
    given = vectors.select(vectors[id_column].cast("long").alias("vec_id"), vectors[vector_column].cast("array<double>").alias("v"))
    found = moments(given)
    basis = components(covariance(found), most) if found.n else Components(np.zeros((0, 0)), np.zeros(0), 0.0)
    size = len(basis.values)
    shared = spark.sparkContext.broadcast((max(found.n, 1), found.sums, basis.vectors / np.sqrt(basis.values)))
    folder = work_folder(spark, "white")
    given.mapInArrow(_projected(shared), _WHITE_SCHEMA).write.parquet(folder)
    white = spark.read.schema(_WHITE_SCHEMA).parquet(folder)
    error = identity_error(white, found.n, size)
    share = F.array(*[F.lit(float(e / basis.trace)) for e in basis.values]).cast("array<double>")
    each = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
