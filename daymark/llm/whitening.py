"""Embedding whitening by incremental eigendecomposition.

Entries c become whole numbers x = floor(1024 c) + 100000, so counts, sums and deviations are exact.
Each partition keeps the spectrum of the scatter of the vectors it has seen. A vector (or w equal
vectors of a batch) adds a rank-one term around the running mean, and the spectrum follows by the
roots of the secular equation; components that the term does not touch, and all but one direction of
equal eigenvalues, are deflated. Two spectra are combined by the rank-one term between their means
and one for each eigenvector of the smaller one, in rounds of bounded groups. The combined basis is
then refined by Rayleigh-Ritz: one pass over all vectors sums the covariance within the basis, whose
eigenvectors rotate it. The state of a task is one spectrum, bounded by the square of the dimensions,
whatever the rows; a rank-one update costs its cube.

Vectors that are null or hold null or non-finite entries take no part. Shorter vectors count as
padded with zero entries. Repeated rows and rows without an id count and are returned. Components
whose eigenvalue is zero up to rounding cannot be whitened and are not returned; without two
different vectors there is no row. The rows are read five times, so pin them if they are dear. An
entry of 2**40 or more in size is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Spectra combined by one task.
FAN_IN = 8
#: Eigenvalues below this share of the largest one times the dimensions count as zero.
ZERO = 1e-14
#: Vectors that a task projects at a time.
ROWS = 4096
_EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(squares / (poles - x)) = 0, and all differences poles[i] - root[j].

    poles rise strictly, squares are positive: root j lies between poles j and j + 1. Each root is
    sought as a distance from the nearer of the two, so that the differences are exact to rounding.
    A step solves the interpolation of f by two poles through its value and derivatives on each side
    (a fixed-weight rational step); it falls back to bisection whenever it leaves the bracket.
    """
    count = len(poles)
    total = squares.sum()
    ends = np.append(poles[1:], poles[-1] + total)
    gaps = ends - poles
    across = poles[:, None] - poles[None, :]
    below = np.tri(count, dtype=bool).T
    middle = across - gaps / 2
    at_middle = 1 + (squares[:, None] / middle).sum(axis=0)
    upper = at_middle < 0
    upper[-1] = False
    across = np.where(upper, poles[:, None] - ends[None, :], across)
    low, high = np.where(upper, -gaps / 2, 0.0), np.where(upper, 0.0, gaps / 2)
    if at_middle[-1] < 0:
        low[-1], high[-1] = gaps[-1] / 2, gaps[-1]
    left = np.where(upper, -gaps, 0.0)
    right = left + gaps
    x = (low + high) / 2
    for _ in range(80):
        apart = across - x
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            terms = squares[:, None] / apart
            slopes = terms / apart
            value = 1 + terms.sum(axis=0)
            size = 1 + np.abs(terms).sum(axis=0)
            down = np.where(below, slopes, 0).sum(axis=0)
            up = slopes.sum(axis=0) - down
            done = ~(np.abs(value) > 4 * _EPS * count * size)
            if done.all():
                break
            low = np.where(value < 0, x, low)
            high = np.where(value < 0, high, x)
            first, second = left - x, right - x
            a = (first + second) * value - first * second * (down + up)
            b = first * second * value
            c = value - first * down - second * up
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
        half = (low + high) / 2
        new = np.where(np.isfinite(new) & (new > low) & (new < high), new, half)
        if ((new == x) | done | (half == low) | (half == high)).all():
            break
        x = np.where(done, x, new)
    base = np.where(upper, ends, poles)
    return base + x, across - x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of basis diag(values) basis' + weight vector vector'; values rise."""
    z = basis.T @ vector
    norm = np.sqrt(z @ z)
    if weight <= 0 or norm == 0:
        return values, basis
    weight, z = weight * norm * norm, z / norm
    reach = 8 * _EPS * max(abs(values[-1]), weight)
    close = np.flatnonzero(np.diff(values) <= reach)
    if len(close):
        # Within a run of equal values, a reflection leaves one direction that the vector touches.
        basis = basis.copy()
        for run in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
            part = slice(run[0], run[-1] + 2)
            mirror = z[part].copy()
            length = np.sqrt(mirror @ mirror)
            mirror[-1] += np.copysign(length, mirror[-1])
            square = mirror @ mirror
            if square > 0:
                basis[:, part] -= np.outer(basis[:, part] @ mirror, 2 * mirror / square)
                z[part] = np.append(np.zeros(len(run)), -np.copysign(length, z[part][-1]))
    live = np.flatnonzero(weight * np.abs(z) > reach)
    if len(live) > 1:
        # Runs may hold nearly equal values still; two of them must not both stay.
        live = live[np.append(np.diff(values[live]) > 0, True)]
    if not len(live):
        return values, basis
    poles, parts = values[live], z[live]
    roots, apart = secular_roots(poles, weight * parts * parts)
    # Parts for which the roots are exact: eigenvectors built from them are orthogonal.
    ratios = poles[:, None] - poles[None, :]
    np.fill_diagonal(ratios, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        fitted = np.sqrt(np.abs(np.prod(apart / ratios, axis=1))) * np.sign(parts)
        turned = fitted[:, None] / apart
    lengths = np.sqrt((turned * turned).sum(axis=0))
    exact = ~(np.isfinite(lengths) & (lengths > 0))
    turned[:, exact] = np.eye(len(live))[:, exact]
    lengths[exact] = 1.0
    made, vectors = values.copy(), basis.copy()
    made[live] = roots
    vectors[:, live] = basis[:, live] @ (turned / lengths)
    order = np.argsort(made, kind="stable")
    return made[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, sum and scatter of vectors; the scatter around their mean as values and basis."""

    count: int
    total: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def none(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size, dtype=np.int64), np.zeros(size), np.eye(size))

    def add(self, vector: np.ndarray, times: int) -> None:
        """The same whole-number vector a number of times."""
        if self.count:
            apart = (self.count * vector - self.total) / self.count
            weight = self.count * times / (self.count + times)
            self.values, self.basis = rank_one(self.values, self.basis, apart, weight)
        self.count += times
        self.total = self.total + times * vector

    def join(self, other: Spectrum) -> None:
        """All vectors of another spectrum."""
        if not other.count:
            return
        for value, vector in zip(other.values, other.basis.T, strict=True):
            self.values, self.basis = rank_one(self.values, self.basis, vector, float(value))
        if self.count:
            apart = self.total / self.count - other.total / other.count
            weight = self.count * other.count / (self.count + other.count)
            self.values, self.basis = rank_one(self.values, self.basis, apart, weight)
        self.count += other.count
        self.total = self.total + other.total

    def row(self, part: int) -> pa.RecordBatch:
        lists = [pa.array([x.tolist()], t) for x, t in (
            (self.total, pa.list_(pa.int64())), (self.values, pa.list_(pa.float64())),
            (self.basis.ravel(), pa.list_(pa.float64())))]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([self.count], pa.int64()), *lists],
                                          names=["part", "n", "total", "vals", "basis"])

    @staticmethod
    def of(row: dict) -> Spectrum:
        size = len(row["total"])
        return Spectrum(row["n"], np.array(row["total"], dtype=np.int64), np.array(row["vals"]),
                        np.array(row["basis"]).reshape(size, size))


SPECTRUM = "part long, n long, total array<long>, vals array<double>, basis array<double>"


def usable(rows: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """vec_id and v, the entries in double precision, of the rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col(f"`{vector_id}`").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def whole(column: pa.Array, width: int) -> np.ndarray:
    """Whole-number vectors of a list column, padded to a width."""
    sizes = np.diff(column.offsets.to_numpy())
    made = np.zeros((len(sizes), width))
    made[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(made * SCALE)
    if len(scaled) and np.abs(scaled).max(initial=0) >= SCALE * 2.0 ** 40:
        raise ValueError("an entry is too large for exact sums")
    return scaled.astype(np.int64) + SHIFT


def _summed(rows: DataFrame, width: int, step, cells: int) -> np.ndarray:
    """Sum over all rows of step(vectors), `cells` doubles; tasks add up their own rows first."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total += step(whole(batch.column(0).slice(at, ROWS), width))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], names=["cell", "sum"])

    found = rows.select("v").mapInArrow(add, "cell long, sum double").groupBy("cell").agg(F.sum("sum").alias("sum")) \
        .toArrow()
    made = np.zeros(cells)
    made[found.column("cell").to_numpy()] = found.column("sum").to_numpy()
    return made


def totals(rows: DataFrame, width: int) -> np.ndarray:
    """Exact sums of all dimensions."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            total += whole(batch.column(0), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["cell", "sum"])

    found = rows.select("v").mapInArrow(add, "cell long, sum long").groupBy("cell").agg(F.sum("sum").alias("sum")) \
        .toArrow()
    made = np.zeros(width, dtype=np.int64)
    made[found.column("cell").to_numpy()] = found.column("sum").to_numpy()
    return made


def spectrum(rows: DataFrame, width: int) -> Spectrum:
    """The combined spectrum of all vectors."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Spectrum.none(width)
        for batch in batches:
            vectors, times = np.unique(whole(batch.column(0), width), axis=0, return_counts=True)
            # Equal vectors are one term; the order is that of a hash, as sorted vectors come in slopes.
            for i in np.argsort(vectors[:, 0] * 2654435761 % (1 << 32), kind="stable"):
                state.add(vectors[i], int(times[i]))
        if state.count:
            yield state.row(TaskContext.get().partitionId())

    def combine(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: -r["n"])
        state = Spectrum.of(rows[0])
        for row in rows[1:]:
            state.join(Spectrum.of(row))
        return pa.Table.from_batches([state.row(min(r["part"] for r in rows) // FAN_IN)])

    states = pinned(rows.select("v").mapInArrow(learn, SPECTRUM), "spectra")
    last = states.agg(F.max("part")).first()[0]
    while last is not None and last > 0:
        by = F.floor(F.col("part") / FAN_IN)
        states = pinned(states.groupBy(by.alias("group")).applyInArrow(combine, SPECTRUM), "spectra")
        last //= FAN_IN
    found = states.toArrow().to_pylist()
    return Spectrum.of(found[0]) if found else Spectrum.none(width)


def whiten(rows: DataFrame, vector_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row per vector and component.

    deviation: the sum over dimensions of (n x - S)**2, exact, as decimal(38, 0). identity_error is
    measured: the largest entry of the covariance of all whitened vectors, less the identity.
    """
    given = usable(rows, vector_id, vector)
    shape = given.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    count, width = shape["n"], max(1, shape["width"] or 0)
    total = totals(given, width)

    def centred(x: np.ndarray) -> np.ndarray:
        return (count * x - total) / count

    basis = spectrum(given, width).basis[:, ::-1]

    def products(x: np.ndarray) -> np.ndarray:
        turned = centred(x) @ basis
        return (turned.T @ turned).ravel()

    within = _summed(given, width, products, width * width).reshape(width, width) / max(1, count)
    values, turn = np.linalg.eigh((within + within.T) / 2)
    values, axes = values[::-1], (basis @ turn)[:, ::-1]
    held = int(np.sum(values[:components] > ZERO * width * max(values[0], 0.0)))
    axes = axes[:, :held] / np.sqrt(values[:held])
    explained = (values[:held] / np.trace(within)) if held else values[:0]

    def spread(x: np.ndarray) -> np.ndarray:
        made = centred(x) @ axes
        mean = made.mean(axis=0) if len(made) else np.zeros(held)
        return np.concatenate((((made - mean).T @ (made - mean)).ravel(), len(made) * np.outer(mean, mean).ravel(),
                               len(made) * mean))

    if held:
        sums = _summed(given, width, spread, 2 * held * held + held)
        inner, between, means = np.split(sums, [held * held, 2 * held * held])
        mean = means / count
        error = np.abs((inner + between).reshape(held, held) / count - np.outer(mean, mean) - np.eye(held)).max()
    else:
        error = 0.0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS):
                batch = whole_batch.slice(at, ROWS)
                x = whole(batch.column("v"), width)
                apart = count * x - total
                made = centred(x) @ axes
                if (np.abs(apart).astype(float) ** 2).sum(axis=1).max(initial=0) < 2.0 ** 62:
                    exact = pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    exact = pa.array([Decimal(sum(v * v for v in row)) for row in apart.tolist()], pa.decimal128(38, 0))
                each = np.repeat(np.arange(len(x)), held)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, held + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(each), count), pa.int64()), exact.take(pa.array(each)),
                    pa.array(made.ravel()), pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = given.schema["vec_id"].dataType.simpleString()
    return given.mapInArrow(project, f"vec_id {kind}, component int, n long, deviation decimal(38,0), "
                                     "whitened double, explained double, identity_error double")
