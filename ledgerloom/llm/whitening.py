"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries are taken on a grid: an entry ``c`` becomes the whole number ``floor(scale * c) + shift``.
One pass sums the vectors exactly, a second one sums the products of the centred vectors; both
leave a few numbers per task, which Spark adds up by dimension and by cell of the matrix, and only
``d`` sums and ``d (d + 1) / 2`` products reach the driver. There the scatter is factored with
pivoting on its diagonal, and the columns of the triangular factor are rotated against each other
until they are orthogonal: their norms are then the square roots of the eigenvalues, and the
columns over their norms are the components. The covariance is never multiplied with itself.

Defined cases: a vector that is null, holds a null, ``NaN`` or infinite entry, or one too large for
the grid to be whole (2^53), is left out. The dimension is the one that most of the remaining
vectors have (the larger of two with as many); vectors of another one are left out as well.
Directions without spread have no component, so equal vectors, a single one and empty tables give
no rows. Repeated rows and ids, null ids and extra columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import settled

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
_WHOLE = 2.0**53
_SAFE = 2.0**62


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with whole mean ``base`` and remainder ``rest`` (sums are ``n * base + rest``); components by column."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def grid_vectors(column: pa.Array, scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries on the grid, the length of each vector (-1: left out) and where it starts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    with np.errstate(invalid="ignore", over="ignore"):
        grid = np.floor(scale * entries) + shift
        bad = ~(np.abs(grid) < _WHOLE)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    left_out = np.bincount(owner[bad], minlength=len(lengths)) > 0
    left_out |= column.is_null().to_numpy(zero_copy_only=False)
    return np.where(bad, 0, grid).astype(np.int64), np.where(left_out, -1, lengths), starts


def _matrix(grid: np.ndarray, lengths: np.ndarray, starts: np.ndarray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of that dimension, and their entries as a matrix."""
    rows = np.flatnonzero(lengths == dimension)
    return rows, grid[starts[rows][:, None] + np.arange(dimension)]


def _sums(scale: int, shift: int):
    """Batches in; one row per task, dimension and place out, with the sum in halves of 32 bits (place -1: the count alone)."""

    def emit(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            grid, lengths, starts = grid_vectors(batch.column("vector"), scale, shift)
            for size in np.unique(lengths[lengths >= 0]).tolist():
                rows, x = _matrix(grid, lengths, starts, size)
                mine = totals.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
                mine[0] += len(rows)
                mine[1] += (x >> 32).sum(axis=0)
                mine[2] += (x & 0xFFFFFFFF).sum(axis=0)
        for size, (n, high, low) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size + 1, size), pa.int32()), pa.array(np.arange(-1, size), pa.int32()), pa.array(np.full(size + 1, n), pa.int64()),
                 pa.array(np.concatenate(([0], high))), pa.array(np.concatenate(([0], low)))],
                ["size", "place", "n", "high", "low"],
            )

    return emit


def _scatter(base: np.ndarray, mean_rest: np.ndarray, scale: int, shift: int):
    """Batches in; the products of the centred vectors out, one row per task and cell of the upper triangle."""
    size = len(base)
    upper = np.triu_indices(size)

    def emit(batches):
        total = np.zeros((size, size))
        for batch in batches:
            _, x = _matrix(*grid_vectors(batch.column("vector"), scale, shift), size)
            centred = (x - base) - mean_rest
            total += centred.T @ centred
        cells = pa.array(np.arange(len(upper[0])), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(total[upper])], ["cell", "product"])

    return emit


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L`` with ``L @ L.T == matrix``: triangular up to the order of its rows, one column per direction with spread."""
    size = len(matrix)
    rest, factor, rank = matrix.astype(float).copy(), np.zeros((size, size)), 0
    least = size * np.finfo(float).eps * max(0.0, float(np.max(np.diag(rest), initial=0.0)))
    open_rows = np.ones(size, bool)
    for step in range(size):
        diagonal = np.where(open_rows, np.diag(rest), -np.inf)
        pivot = int(np.argmax(diagonal))
        if diagonal[pivot] <= least:
            break
        open_rows[pivot] = False
        factor[pivot, step] = np.sqrt(rest[pivot, pivot])
        factor[open_rows, step] = rest[open_rows, pivot] / factor[pivot, step]
        below = factor[:, step] * open_rows
        rest -= np.outer(below, below)
        rank += 1
    return factor[:, :rank]


def _rounds(count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of disjoint pairs."""
    players = list(range(count + count % 2))
    found = []
    for _ in range(len(players) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(players[: len(players) // 2], reversed(players[len(players) // 2 :])) if max(a, b) < count]
        found.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        players.insert(1, players.pop())
    return found


def jacobi_columns(factor: np.ndarray, most_sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms and directions of the columns of ``factor`` once rotated orthogonal, largest first."""
    columns = factor.copy()
    rounds = _rounds(columns.shape[1]) if columns.shape[1] > 1 else []
    close = np.finfo(float).eps * max(1, len(factor)) ** 0.5
    for _ in range(most_sweeps):
        turned = False
        for first, second in rounds:
            a, b = columns[:, first], columns[:, second]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(ab) > close * np.sqrt(aa * bb)
            if not turn.any():
                continue
            turned = True
            cotangent = (bb - aa) / (2 * np.where(turn, ab, 1.0))
            tangent = np.where(turn, np.where(cotangent >= 0, 1.0, -1.0) / (np.abs(cotangent) + np.sqrt(1 + cotangent * cotangent)), 0.0)
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            columns[:, first], columns[:, second] = cosine * a - sine * b, sine * a + cosine * b
        if not turned:
            break
    norms = np.sqrt((columns * columns).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, columns[:, order] / norms[order]


def learn_whitening(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Mean, eigenvalues and components of all vectors; None if there are none or they have no entries."""
    given = rows.select(F.col(vector).alias("vector"))
    partial = given.mapInArrow(_sums(scale, shift), "size int, place int, n bigint, high bigint, low bigint")
    whole = "decimal(38,0)"
    sums = settled(partial.groupBy("size", "place").agg(
        F.sum("n").alias("n"), (F.sum(F.col("high").cast(whole)) * F.lit(1 << 32) + F.sum(F.col("low").cast(whole))).cast(whole).alias("sum")
    ))
    best = sums.where("place = -1").orderBy(F.desc("n"), F.desc("size")).first()
    if best is None or not best["size"]:
        return None
    n, size = best["n"], best["size"]
    totals = {r["place"]: int(r["sum"]) for r in sums.where((F.col("size") == size) & (F.col("place") >= 0)).collect()}
    base = np.array([totals[i] // n for i in range(size)], np.int64)
    rest = np.array([totals[i] % n for i in range(size)], np.int64)
    cells = given.mapInArrow(_scatter(base, rest / n, scale, shift), "cell int, product double").groupBy("cell").agg(F.sum("product").alias("product"))
    covariance = np.zeros((size, size))
    upper = np.triu_indices(size)
    for cell, product in cells.collect():
        covariance[upper[0][cell], upper[1][cell]] = covariance[upper[1][cell], upper[0][cell]] = product / n
    eigenvalues, components = jacobi_columns(pivoted_cholesky(covariance))
    return Whitening(n, base, rest, components, eigenvalues, float(np.trace(covariance)))


def squared_deviation(off: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """The sum of ``(n * off - rest) ** 2`` of each row, exact; None where it passes 64 bits."""
    rough = ((n * off.astype(float) - rest) ** 2).sum(axis=1)
    found: list[int | None] = [None] * len(off)
    fits = np.flatnonzero(rough < _SAFE)
    exact = n * off[fits] - rest
    for row, value in zip(fits.tolist(), (exact * exact).sum(axis=1).tolist()):
        found[row] = value
    for row in np.flatnonzero((rough >= _SAFE) & (rough < 2 * _SAFE * 1.01)).tolist():
        value = sum((n * int(o) - int(r)) ** 2 for o, r in zip(off[row], rest))
        found[row] = value if value < 1 << 63 else None
    return found


def whiten(rows: DataFrame, model: Whitening, count: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id``, ``deviation`` and the list ``whitened`` of the first ``count`` components of each vector that counts."""
    count = min(count, len(model.eigenvalues))
    axes = model.components[:, :count] / np.sqrt(model.eigenvalues[:count])
    mean_rest = model.rest / model.n

    def emit(batches):
        for batch in batches:
            picked, x = _matrix(*grid_vectors(batch.column("vector"), scale, shift), len(model.base))
            off = x - model.base
            scores = (off - mean_rest) @ axes
            edges = pa.array(np.arange(len(picked) + 1) * count, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(picked)), pa.array(squared_deviation(off, model.n, model.rest), pa.int64()),
                 pa.ListArray.from_arrays(edges, pa.array(scores.reshape(-1)))],
                ["vec_id", "deviation", "whitened"],
            )

    given = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    return given.mapInArrow(emit, f"vec_id {given.schema['vec_id'].dataType.simpleString()}, deviation bigint, whitened array<double>")


def identity_error(whitened: DataFrame, count: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` (divisor n, centred before multiplying) minus the identity."""
    entry = [F.get("whitened", F.lit(i)) for i in range(count)]
    means = whitened.agg(*[F.avg(e).alias(f"m{i}") for i, e in enumerate(entry)]).first()
    off = [e - F.lit(means[i]) for i, e in enumerate(entry)]
    cells = whitened.agg(*[(F.avg(off[i] * off[j]) - F.lit(float(i == j))).alias(f"c{i}_{j}") for i in range(count) for j in range(i, count)])
    return max(abs(x) for x in cells.first())


def whitening_report(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: the whitened value, and what the component and the whole explain."""
    model = learn_whitening(rows, vector)
    id_type = rows.select(F.col(vec_id).alias("vec_id")).schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.eigenvalues):
        schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema)
    whitened = settled(whiten(rows, model, count, vec_id, vector))
    count = min(count, len(model.eigenvalues))
    error = identity_error(whitened, count)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:count]])
    return whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
