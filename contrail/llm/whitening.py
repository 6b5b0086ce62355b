"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed passes.

The vectors stay where they are. What travels is a block of ``dimensions x columns`` doubles: every pass sends the block
``Q`` out with the tasks, each task returns its share of ``XcᵀXc Q`` of its own centred rows, and the shares are added
up. Small dense steps on such a block (QR, Rayleigh-Ritz) are done on the driver; they do not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.tables import landed

# An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
_FIRST_SUMS = 32
_ROWS = 4096


@dataclass(frozen=True)
class Moments:
    """Number of vectors and exact sums of every dimension."""

    n: int
    sums: tuple[int, ...]


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors (columns) of the covariance by falling eigenvalue, and what was done to find them."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int


def whole_numbers(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and the vector as whole numbers ``x``; nothing else of the table is kept.

    Left out: null vectors, empty ones, vectors with a null, NaN or infinite entry or one whose whole number does not
    fit in a long, and vectors of another length than the most frequent one (of equally frequent, the shorter).
    """
    entry = F.col("v").cast("array<double>")
    bound = float(2 ** 62 // SCALE)
    usable = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall(entry, lambda c: F.coalesce(c.between(-bound, bound), F.lit(False))))
    lengths = usable.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    x = F.transform(entry, lambda c: F.floor(SCALE * c) + SHIFT)
    return usable.filter(F.size("v") == (lengths["size"] if lengths else 0)).select("id", x.alias("x"))


def packed(rows: DataFrame) -> DataFrame:
    """The rows of ``whole_numbers`` with each ``x`` as the bytes of its 64-bit numbers, which every pass then reads
    without taking arrays apart."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.ascontiguousarray(c.values.to_numpy(), "<i8").tobytes() for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], ["id", "x"])

    return rows.mapInArrow(pack, f"id {dict(rows.dtypes)['id']}, x binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``_ROWS`` rows, each with its vectors as a matrix."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            joined = b"".join(cell.as_buffer() for cell in part.column("x"))
            yield part, np.frombuffer(joined, "<i8").reshape(part.num_rows, -1)


def _added(rows: DataFrame, share: Callable[[Iterator[np.ndarray]], np.ndarray | None],
           shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all tasks of a block of fixed shape: added within tasks, then in ``_FIRST_SUMS`` groups of tasks,
    then on the driver, which gets ``_FIRST_SUMS`` blocks at most."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = share(block for _, block in _blocks(batches))
        if total is not None:
            from pyspark import TaskContext

            at = TaskContext.get().partitionId() % _FIRST_SUMS
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             ["at", "block"])

    def of_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch.column(1):
                block = np.frombuffer(cell.as_py())
                total = block if total is None else total + block
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             ["at", "block"])

    schema = "at int, block binary"
    shares = rows.select("x").mapInArrow(of_task, schema)
    if len(rows.inputFiles()) > _FIRST_SUMS:
        shares = shares.repartition(_FIRST_SUMS, "at").mapInArrow(of_group, schema)
    total = np.zeros(shape)
    for row in shares.collect():
        total += np.frombuffer(row.block).reshape(shape)
    return total


def moments(rows: DataFrame) -> Moments:
    """Exact, in whole numbers: a task sends the sums of its rows as decimals, one row for each dimension."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for _, x in _blocks(batches):
            exact = np.abs(x).max() < 2 ** 62 // _ROWS
            part = (x if exact else x.astype(object)).sum(axis=0).astype(object)
            n, sums = n + len(x), part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()),
                pa.array([Decimal(int(v)) for v in sums], pa.decimal128(30, 0))], ["at", "n", "s"])

    found = rows.select("x").mapInArrow(share, "at int, n long, s decimal(30,0)").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    return Moments(found[0].n if found else 0, tuple(int(r.s) for r in found))


def _centred(x: np.ndarray, at: Moments) -> np.ndarray:
    """x - S/n, the subtraction exact wherever n*x fits in 64 bits: n*x - S as whole numbers first."""
    return _deviations(x, at).astype(np.float64) / at.n


def _deviations(x: np.ndarray, at: Moments) -> np.ndarray:
    """n*x - S in whole numbers, of 64 bits or, where those do not hold it, of any size."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if at.n * most + max(map(abs, at.sums)) < 2 ** 63:
        return at.n * x.astype(np.int64) - np.array(at.sums, np.int64)
    return at.n * x.astype(object) - np.array(at.sums, object)


def _squares(deviations: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    most = int(np.abs(deviations).max(initial=0))
    if most * most * deviations.shape[1] >= 2 ** 63:
        deviations = deviations.astype(object)
    return [int(v) for v in (deviations * deviations).sum(axis=1)]


def covariance_times(rows: DataFrame, at: Moments, block: np.ndarray) -> np.ndarray:
    """One pass: the covariance times ``block``, without the covariance."""

    def share(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for x in blocks:
            c = _centred(x, at)
            part = c.T @ (c @ block)
            total = part if total is None else total + part
        return total

    return _added(rows, share, block.shape) / at.n


def _total_variance(rows: DataFrame, at: Moments) -> float:
    def share(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for x in blocks:
            part = np.array([np.square(_centred(x, at)).sum()])
            total = part if total is None else total + part
        return total

    return float(_added(rows, share, (1,))[0]) / at.n


def leading_components(rows: DataFrame, at: Moments, count: int, guard: int | None = None, degree: int = 8,
                       tolerance: float = 2e-15, rounds: int = 20, seed: int = 1) -> Components:
    """The ``count`` leading eigenpairs of the covariance, certified by their residuals.

    A round multiplies the block by a Chebyshev polynomial of the covariance, small on the interval of the unwanted
    eigenvalues and growing fast above it, one distributed pass for each degree; then QR and Rayleigh-Ritz. The interval
    ends at the smallest Ritz value of the block and begins at a lower bound of all eigenvalues: those outside of the
    block add up to the trace less the Ritz values, and none of them exceeds the interval's end. The block has
    ``guard`` columns more than wanted, by default three quarters as many; where a round does not bring the residuals down,
    the block is widened. Done when every wanted residual ``|Vq - eq|`` is below ``tolerance`` x trace, or rounding
    keeps it from falling below 1000 times that. Raises ``ArithmeticError`` if neither comes about.
    Eigenvalues below 1e-12 of the largest count as zero and have no component.
    """
    d = len(at.sums)
    trace = _total_variance(rows, at)
    passes = 1
    if not trace > 0:
        return Components(np.empty((d, 0)), np.empty(0), 0.0, np.empty(0), passes)
    random = np.random.default_rng(seed)
    width = min(d, count + (max(8, 3 * count // 4) if guard is None else guard))
    wanted = min(count, d)
    q = np.linalg.qr(random.standard_normal((d, width)))[0]
    low, before = 0.0, np.inf
    for turn in range(rounds):
        w = covariance_times(rows, at, q)
        passes += 1
        small = q.T @ w
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, w = q @ turned, w @ turned
        residuals = np.linalg.norm(w - q * values, axis=0)
        worst = float(residuals[:wanted].max())
        if worst <= tolerance * trace or (worst <= 1000 * tolerance * trace and worst > before / 2):
            break
        if worst > before / 2 and width < d:  # hardly any progress: more room for the wanted space
            wider = min(d, 2 * width)
            q = np.linalg.qr(np.hstack([q, random.standard_normal((d, wider - width))]))[0]
            width, before = wider, np.inf
            continue
        before = worst
        high = max(float(values[-1]), 1e-14 * trace)
        if turn:  # by then the Ritz values are near the leading eigenvalues
            bound = trace - float(values.sum()) - (d - width - 1) * high if width < d else 0.0
            low = 0.9 * bound if 0 < bound < high else 0.0  # from the end on: the block is not there yet
        q, done = _filtered(rows, at, q, w, low, high, degree)
        passes += done
    else:
        raise ArithmeticError(f"residual {worst:.3g} of trace {trace:.3g} after {rounds} rounds")
    kept = values[:wanted] > 1e-12 * values[0]
    return Components(q[:, :wanted][:, kept], values[:wanted][kept], trace, residuals[:wanted][kept], passes)


def _filtered(rows: DataFrame, at: Moments, q: np.ndarray, w: np.ndarray, low: float, high: float,
              degree: int) -> tuple[np.ndarray, int]:
    """A basis of the Chebyshev polynomial of the covariance times ``q``, where ``w`` is the covariance times ``q``.
    The recurrence is scaled by the largest Ritz value's polynomial step by step, so nothing overflows."""
    half, centre = max((high - low) / 2, 1e-300), (high + low) / 2
    top = float(np.einsum("ij,ij->j", q, w).max())
    scale = half / max(top - centre, half)
    first = scale
    older, newer = q, (w - centre * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        product = covariance_times(rows, at, newer)
        older, newer = newer, (product - centre * newer) * (2 * following / half) - scale * following * older
        scale = following
    return np.linalg.qr(newer)[0], degree - 1


def identity_error(rows: DataFrame, at: Moments, found: Components) -> float:
    """One pass over the whitened rows: the largest entry of their centred covariance minus the identity."""
    k, project = len(found.values), found.vectors / np.sqrt(found.values)

    def share(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for x in blocks:
            z = _centred(x, at) @ project
            part = np.vstack([z.T @ z, z.sum(axis=0)])
            total = part if total is None else total + part
        return total

    total = _added(rows, share, (k + 1, k))
    mean = total[k] / at.n
    return float(np.abs(total[:k] / at.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(df: DataFrame, key: str, vector: str, count: int = 32) -> DataFrame:
    """Whitened coordinates of every usable vector (see ``whole_numbers``), fitted on all of them.

    One row for each vector and component: the key as ``id``, ``component`` from 1 by falling eigenvalue, ``n``, the
    exact ``deviation`` (sum over dimensions of (n*x - S)², a decimal as it grows with n²), ``whitened``, ``explained`` (share of the trace) and ``identity_error``. At most as many components as the
    covariance has positive eigenvalues: none, and so no rows, for an empty table, a single vector or equal ones.
    Repeated rows and keys and null keys are rows like others; extra columns are not looked at.
    """
    kind = dict(df.dtypes)[key]
    schema = (f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    rows = landed(packed(whole_numbers(df, key, vector)), "whole-vectors")
    at = moments(rows)
    found = leading_components(rows, at, count) if at.n else None
    if found is None or not len(found.values):
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, at, found)
    project = found.vectors / np.sqrt(found.values)
    explained, k, n = found.values / found.trace, len(found.values), at.n

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches):
            deviations = _deviations(x, at)
            z = (deviations.astype(np.float64) / n) @ project
            squares = pa.array([Decimal(v) for v in _squares(deviations)], pa.decimal128(38, 0))
            each, total = pa.array(np.repeat(np.arange(len(x)), k)), len(x) * k
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(total, n)), squares.take(each), pa.array(z.ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(total, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(spread, schema)
