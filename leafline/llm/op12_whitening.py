"""Whitening of embeddings by the cyclic Jacobi method.

Entries are read on a grid of whole numbers. Each distinct vector of the grid counts once in the fit (the fit
list): its count and its sums are exact, so that vectors are centred without cancellation before they are
multiplied. Tasks add up the scatter of their part; rows of the scatter are added in two steps, so that no task
meets more of them than the root of their number. The driver, which holds one matrix of dims x dims and nothing that grows with
the rows, turns it by symmetric Jacobi rotations, in rounds of disjoint pairs that go through all pairs (a
sweep), until every off-diagonal entry has vanished beside its two diagonal ones: that keeps small eigenvalues to
their own precision. The sorted and scaled vectors go to all tasks (dims x components numbers).

Rows whose vector is null or has a null or non-finite entry are dropped, as are vectors of another length than
most have (the shorter of two lengths that are equally frequent): neither has a place on the grid. Repeated
rows and null or repeated ids each give their own result. An empty table, or one without such vectors, gives no
rows. Components whose eigenvalue is zero to rounding (fewer different vectors than dims, constant entries) can't
be whitened and aren't returned; of vectors that are all alike none is. Entries beyond 2**62 / SCALE, and
deviations beyond a long, raise an error. Only the id and the vector are read, so further columns can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import arrow_batch, materialize, read

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Numbers of a block of vectors that is worked on at a time.
BLOCK = 1 << 20
EPSILON = float(np.finfo(float).eps)


def _usable(table: DataFrame, vector: str, dims: int | None = None) -> DataFrame:
    """Rows with a vector, of dims entries if that is given."""
    kept = table.where(F.col(vector).isNotNull())
    return kept if dims is None else kept.where(F.size(vector) == dims)


def dims_of(table: DataFrame, vector: str = "embedding") -> int:
    """How many entries most vectors have, 0 where there are none."""
    sizes = table.where(F.size(vector) > 0).groupBy(F.size(vector).alias("dims")).agg(F.count("*").alias("n"))
    return -(sizes.agg(F.max(F.struct("n", (-F.col("dims")).alias("less")))["less"]).first()[0] or 0)


def _grids(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, vectors on the grid without SHIFT) of a batch's usable rows, a block at a time."""
    step = max(1, BLOCK // dims)
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        values = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)  # null is nan
        good = np.isfinite(values).all(axis=1)
        scaled = np.floor(SCALE * values[good])
        if scaled.size and np.abs(scaled).max() >= 2.0**62:
            raise ValueError(f"an entry of {np.abs(scaled).max() / SCALE:g} is too large for the grid")
        yield part.column("id").filter(pa.array(good)), scaled.astype(np.int64)


def _packed(grid: np.ndarray) -> list[bytes]:
    """Vectors as bytes: the width of an entry, then the entries, no wider than a vector needs. Equal vectors, equal bytes."""
    most = np.maximum(grid.max(axis=1), -(grid.min(axis=1) + 1))
    widths = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    return [bytes([w]) + row.astype(f"<i{w}").tobytes() for w, row in zip(widths.tolist(), grid, strict=True)]


def _unpacked(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    step = max(1, BLOCK // dims)
    for at in range(0, len(column), step):
        yield np.array([np.frombuffer(v, f"<i{v[0]}", offset=1) for v in column.slice(at, step).to_pylist()], np.int64).reshape(-1, dims)


def fit_list(table: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """x: each distinct vector of the grid once, packed. Repeats are dropped in each task before the shuffle."""

    def run(batches):
        for batch in batches:
            for _, grid in _grids(batch, dims):
                if len(grid):
                    yield arrow_batch({"x": (list(dict.fromkeys(_packed(grid))), pa.binary())})

    named = _usable(table, vector, dims).select(F.lit(0).alias("id"), F.col(vector).alias("vector"))
    return named.mapInArrow(run, "x binary").distinct()


def _part() -> int:
    """Root of the task's number: as many parts as the root of all tasks, and as many tasks in each, twice at most."""
    return math.isqrt(TaskContext.get().partitionId())


def _added(parts: DataFrame, kind: str) -> DataFrame:
    """Arrays of parts(k, part, row) added up for each k, in two steps."""

    def add(key, table):
        total = sum(np.array(batch.column("row").to_pylist()).sum(axis=0) for batch in table.to_batches())
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "row": pa.array([total.tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))})

    once = parts.groupBy("k", "part").applyInArrow(add, f"k int, row array<{kind}>")
    return once.groupBy("k").applyInArrow(add, f"k int, row array<{kind}>")


def moments(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Count and exact sums of the fit list, without SHIFT."""

    def run(batches):
        n, low, high = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            for grid in _unpacked(batch.column("x"), dims):
                # By halves of 31 bits, whose sums fit a long for 2**32 vectors.
                n, low, high = n + len(grid), low + (grid & (1 << 31) - 1).sum(axis=0), high + (grid >> 31).sum(axis=0)
        if n:
            rows = [[n, *low.tolist()], [0, *high.tolist()]]
            yield arrow_batch({"k": ([0, 1], pa.int32()), "part": ([_part()] * 2, pa.int32()), "row": (rows, pa.list_(pa.int64()))})

    found = {r.k: r.row for r in _added(fit.mapInArrow(run, "k int, part int, row array<long>"), "long").collect()}
    if not found:
        return 0, [0] * dims
    return found[0][0], [a + (b << 31) for a, b in zip(found[0][1:], found[1][1:], strict=True)]


def _centred(grid: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: longs, or Python's numbers where those don't do."""
    most = n * max(1, int(np.abs(grid).max(initial=0))) + max(map(abs, sums), default=0)
    return grid * n - np.array(sums, np.int64) if most < 1 << 62 else grid.astype(object) * n - np.array(sums, object)


def scatter(fit: DataFrame, n: int, sums: list[int], turn: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of the products of centred vectors; of turn @ centred vector if turn is given."""
    dims = len(sums)
    size = dims if turn is None else len(turn)

    def run(batches):
        total, count = np.zeros((size, size)), 0
        for batch in batches:
            for grid in _unpacked(batch.column("x"), dims):
                y = _centred(grid, n, sums).astype(float) / n
                y = y if turn is None else y @ turn.T
                total, count = total + y.T @ y, count + len(grid)
        if count:
            yield arrow_batch({"k": (range(size), pa.int32()), "part": ([_part()] * size, pa.int32()), "row": (total.tolist(), pa.list_(pa.float64()))})

    out = np.zeros((size, size))
    for r in _added(fit.mapInArrow(run, "k int, part int, row array<double>"), "double").collect():
        out[r.k] = r.row
    return out


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric positive semidefinite matrix, falling, and its unit eigenvectors as rows.

    A round turns the planes of disjoint pairs; the pairings of a round-robin tournament take every pair in turn once
    a sweep. A pair is left alone once its entry is below rounding of the root of the product of its diagonal entries. It ends with a sweep
    that turns nothing, which is soon, since sweeps converge quadratically; sweeps bounds it for certain.
    """
    a = (matrix + matrix.T) / 2
    size = len(a)
    v = np.eye(size)
    seats = list(range(size + size % 2))
    for _ in range(sweeps):
        turned = False
        for _ in range(max(1, len(seats) - 1)):
            pairs = [(min(p, q), max(p, q)) for p, q in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :]), strict=True) if max(p, q) < size]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            p, q = np.array(pairs, int).reshape(-1, 2).T
            app, aqq, apq = a[p, p], a[q, q], a[p, q]
            big = np.abs(apq) > EPSILON * np.sqrt(np.abs(app * aqq)) + np.finfo(float).tiny
            if not big.any():
                continue
            turned, p, q, app, aqq, apq = True, p[big], q[big], app[big], aqq[big], apq[big]
            theta = (aqq - app) / (2 * apq)
            t = np.where(theta < 0, -1.0, 1.0) / (np.abs(theta) + np.hypot(1, theta))
            c = 1 / np.hypot(1, t)
            s = t * c
            rows_p, rows_q = a[p], a[q]
            a[p], a[q] = c[:, None] * rows_p - s[:, None] * rows_q, s[:, None] * rows_p + c[:, None] * rows_q
            columns_p, columns_q = a[:, p], a[:, q]
            a[:, p], a[:, q] = c * columns_p - s * columns_q, s * columns_p + c * columns_q
            # As the rotation has them, without the rounding of two products.
            a[p, p], a[q, q], a[p, q], a[q, p] = app - t * apq, aqq + t * apq, 0, 0
            v_p, v_q = v[p], v[q]
            v[p], v[q] = c[:, None] * v_p - s[:, None] * v_q, s[:, None] * v_p + c[:, None] * v_q
        if not turned:
            break
    values = np.diag(a).copy()
    order = np.argsort(-values, kind="stable")
    return values[order], v[order] / np.linalg.norm(v[order], axis=1, keepdims=True)


@dataclass(frozen=True)
class Whitening:
    """n and sums (without SHIFT) of the fit list; turn: a row for each component, scaled to unit variance; explained: share of
    the whole variance by component; identity_error: the largest entry of the whitened fit list's covariance less the identity."""

    dims: int
    n: int
    sums: list[int]
    turn: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """None where there is no usable vector."""
    dims = dims_of(table, vector)
    if not dims:
        return None
    listed = materialize(fit_list(table, dims, vector), "fit-list")
    n, sums = moments(listed, dims)
    if not n:
        return None
    values, vectors = jacobi(scatter(listed, n, sums) / n)
    kept = int((values > max(values[0], 0) * EPSILON * dims * 4).sum())
    k = min(components, kept)
    turn = vectors[:k] / np.sqrt(values[:k, None])
    error = float(np.abs(scatter(listed, n, sums, turn) / n - np.eye(k)).max()) if k else 0.0
    return Whitening(dims, n, sums, turn, values[:k] / max(float(values.sum()), np.finfo(float).tiny), error)


def _deviations(centred: np.ndarray) -> list[int]:
    most = int(np.abs(centred).max(initial=0))
    if most * most * centred.shape[1] < 1 << 63:
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()
    out = (centred.astype(object) ** 2).sum(axis=1).tolist()
    if max(out) >= 1 << 63:
        raise OverflowError(f"a deviation of {max(out)} is too large for a long")
    return out


def whiten(table: DataFrame, model: Whitening | None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for each usable row and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    dims, k = model.dims, len(model.turn)

    def run(batches):
        for batch in batches:
            for ids, grid in _grids(batch, dims):
                if not len(grid):
                    continue
                centred = _centred(grid, model.n, model.sums)
                white, rows = centred.astype(float) / model.n @ model.turn.T, len(grid)
                yield arrow_batch(
                    {
                        "vec_id": (ids.take(pa.array(np.repeat(np.arange(rows), k))), pa.int64()),
                        "component": (np.tile(np.arange(1, k + 1, dtype=np.int32), rows), pa.int32()),
                        "n": (np.full(rows * k, model.n), pa.int64()),
                        "deviation": (np.repeat(np.array(_deviations(centred), np.int64), k), pa.int64()),
                        "whitened": (white.ravel(), pa.float64()),
                        "explained": (np.tile(model.explained, rows), pa.float64()),
                        "identity_error": (np.full(rows * k, model.identity_error), pa.float64()),
                    }
                )

    named = _usable(table, vector, dims).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    return named.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    return whiten(table, fit(table))
