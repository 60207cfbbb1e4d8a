"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps the spectrum (count, mean, eigenvalues and eigenvectors of the scatter) of the vectors it has
seen. A vector is a centred rank-one update: its distance to the mean, in the coordinates of the eigenvectors, moves
the eigenvalues to the roots of a secular equation, after coordinates that cannot move are deflated. Spectra of
partitions are combined in a tree, the eigenpairs of one being rank-one updates of the other. What rounding is left
goes in a distributed Rayleigh-Ritz refinement: the covariance is taken in the found basis over all vectors, its
eigenvectors turn the basis, until it is diagonal.

Vectors are integer ``x``; counts, sums and deviations are exact integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import stage

#: An entry c becomes x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries whose x is not held exactly by a double are treated as non-finite.
LARGEST = 2.0**53
#: Spectra combined by one task of a round.
FAN_IN = 8
#: Refinement ends when scaled off-diagonal covariances are this small, or after so many passes.
DIAGONAL, MOST_PASSES = 1e-10, 4
_LIMB = 26
_EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + rho * sum(z^2 / (d - t)) = 0`` for rising distinct ``d``, ``rho > 0`` and ``z`` without
    zeros: the roots, and the matrix ``d[j] - root[i]`` (row i) without cancellation.

    Root i lies between d[i] and d[i + 1] and is sought as an offset from the nearer of the two, by rational
    interpolation with one pole on either side, inside a bracket that halves where a step leaves it.
    """
    k, w = len(d), rho * z * z
    right = np.append(d[1:], d[-1] + w.sum())
    gap = right - d
    delta = d[None, :] - d[:, None]
    with np.errstate(all="ignore"):
        f_mid = 1 + (w / (delta - gap[:, None] / 2)).sum(1)
    from_left = f_mid >= 0
    from_left[-1] = True
    origin = np.where(from_left, d, right)
    delta = d[None, :] - origin[:, None]
    half = gap / 2
    lo, hi = np.where(from_left, 0.0, -half), np.where(from_left, half, 0.0)
    if f_mid[-1] < 0:
        lo[-1], hi[-1] = half[-1], gap[-1]
    else:
        hi[-1] = half[-1]
    mu = (lo + hi) / 2
    left_of = np.arange(k)[None, :] <= np.arange(k)[:, None]
    pole_a, pole_b = np.diagonal(delta), np.append(np.diagonal(delta, 1), np.inf)
    for _ in range(80):
        with np.errstate(all="ignore"):
            part = w / (delta - mu[:, None])
            slope = part / (delta - mu[:, None])
            f = 1 + part.sum(1)
            down, up = (slope * left_of).sum(1), (slope * ~left_of).sum(1)
            done = np.abs(f) <= 4 * k * _EPS * (1 + np.abs(part).sum(1))
            lo, hi = np.where(f < 0, mu, lo), np.where(f < 0, hi, mu)
            done |= (hi - lo) <= 2 * _EPS * np.abs(mu)
            if done.all():
                break
            a, b = pole_a - mu, pole_b - mu
            c = f - a * down - np.where(np.isinf(b), 0, b * up)
            p, q = (a + b) * f - a * b * (down + up), a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            step = np.where(np.isinf(b), a + a * a * down / c, step)
            new = mu + step
            bad = ~((new > lo) & (new < hi))
        mu = np.where(done, mu, np.where(bad, (lo + hi) / 2, new))
    return origin + mu, delta - mu[:, None]


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of ``basis @ diag(values) @ basis.T + rho * v @ v.T`` (``rho > 0``), eigenvalues rising.

    A direction of ``v`` outside the basis joins it with value zero. Coordinates too small to move an eigenvalue are
    deflated, and of eigenvalues that are equal but for rounding all but one, by rotating their coordinates into one.
    """
    z = basis.T @ v
    rest = v - basis @ z
    again = basis.T @ rest  # once more, so that the rest is orthogonal to rounding
    z, rest = z + again, rest - basis @ again
    out, size = float(np.sqrt(rest @ rest)), float(np.sqrt(v @ v))
    if not size:
        return values, basis
    if out > 64 * _EPS * size and basis.shape[1] < basis.shape[0]:
        basis = np.column_stack([basis, rest / out])
        values, z = np.append(values, 0.0), np.append(z, out)
    order = np.argsort(values, kind="stable")
    values, basis, z = values[order].copy(), basis[:, order].copy(), z[order].copy()
    weight = rho * float(z @ z)
    if not weight:
        return values, basis
    rho, z = weight, z / np.sqrt(z @ z)
    tiny = 8 * _EPS * max(float(np.abs(values).max()), rho)
    active = np.flatnonzero(rho * np.abs(z) > tiny)
    for i in np.flatnonzero(np.diff(values[active]) <= tiny):
        a, b = active[i], active[i + 1]
        r = np.hypot(z[a], z[b])
        c, s = z[b] / r, z[a] / r
        basis[:, a], basis[:, b] = c * basis[:, a] - s * basis[:, b], s * basis[:, a] + c * basis[:, b]
        z[a], z[b] = 0.0, r
    active = active[z[active] != 0]
    if not len(active):
        return values, basis
    d = values[active]
    roots, apart = secular_roots(d, z[active], rho)
    # coordinates for which the roots are exact, so that the vectors come out orthogonal (Gu and Eisenstat)
    between = d[:, None] - d[None, :]
    np.fill_diagonal(between, 1.0)
    exact = np.sqrt(np.abs((apart / between).prod(0)))
    turn = np.where(z[active] < 0, -exact, exact)[:, None] / apart.T
    turn /= np.sqrt((turn * turn).sum(0))
    basis[:, active] = basis[:, active] @ turn
    values[active] = roots
    return values, basis


@dataclass
class Spectrum:
    """Count, mean and scatter (``basis @ diag(values) @ basis.T``) of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(0), np.zeros((size, 0)))

    def add(self, x: np.ndarray, copies: int = 1) -> None:
        """A centred rank-one update by a vector, ``copies`` times the same."""
        away, total = x - self.mean, self.n + copies
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, away, self.n * copies / total)
        self.mean, self.n = self.mean + away * (copies / total), total

    def merge(self, other: Spectrum) -> None:
        """Successive rank-one updates by the eigenpairs of another and by the distance of the means."""
        if not other.n:
            return
        away, total = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, vector, float(value))
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, away, self.n * other.n / total)
        self.mean, self.n = self.mean + away * (other.n / total), total


_SPECTRUM = "part long, n long, high array<long>, low array<long>, mean array<double>, value array<double>, basis array<double>"


def _pack(part: int, sums: tuple[np.ndarray, np.ndarray], s: Spectrum) -> pa.RecordBatch:
    cells = [part, s.n, *(x.tolist() for x in (*sums, s.mean, s.values, s.basis.T.ravel()))]
    types = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.float64())] * 3]
    names = ["part", "n", "high", "low", "mean", "value", "basis"]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], names=names)


def _unpack(row: dict) -> tuple[tuple[np.ndarray, np.ndarray], Spectrum]:
    mean, value = np.array(row["mean"], np.float64), np.array(row["value"], np.float64)
    basis = np.array(row["basis"], np.float64).reshape(len(value), len(mean)).T
    return (np.array(row["high"], np.int64), np.array(row["low"], np.int64)), Spectrum(row["n"], mean, value, basis)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _spectra(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, high, low = Spectrum.empty(size), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), size)
            high, low = high + (x >> _LIMB).sum(0), low + (x & ((1 << _LIMB) - 1)).sum(0)
            rows, copies = np.unique(x, axis=0, return_counts=True)  # a vector met many times is one update
            for row, n in zip((rows - OFFSET).astype(np.float64), copies.tolist()):
                own.add(row, n)
        if own.n:
            yield _pack(TaskContext.get().partitionId(), (high, low), own)

    return run


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part; each run of one part becomes one row."""
    part, sums, own = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            limbs, other = _unpack(row)
            if row["part"] != part:
                if own is not None:
                    yield _pack(part, sums, own)
                part, sums, own = row["part"], limbs, other
            else:
                sums = sums[0] + limbs[0], sums[1] + limbs[1]
                own.merge(other)
    if own is not None:
        yield _pack(part, sums, own)


def _tree(parts: DataFrame, combine: Callable, label: str) -> dict | None:
    """One row from many: in every round a task combines ``FAN_IN`` of them, written to the shared folder."""
    parts = stage(parts, label)
    top = parts.agg(F.max("part")).first()[0]
    if top is None:
        return None
    while top > 0:
        top //= FAN_IN
        grouped = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).repartitionByRange(top + 1, "part")
        parts = stage(grouped.sortWithinPartitions("part", "n").mapInArrow(combine, parts.schema), label)
    return parts.first().asDict()


_GRAM = "part long, n long, gram array<double>"


def _grams(size: int, n: int, sums: list[int], basis: np.ndarray):
    whole, left = [s // n for s in sums], [s % n for s in sums]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, seen = np.zeros((basis.shape[1], basis.shape[1])), 0
        for batch in batches:
            if batch.num_rows:
                y = centred(_matrix(batch.column(0), size), whole, left, n) @ basis
                total, seen = total + y.T @ y, seen + len(y)
        if seen:
            cells = [pa.array([TaskContext.get().partitionId()]), pa.array([seen]), pa.array([total.ravel().tolist()])]
            yield pa.RecordBatch.from_arrays(cells, names=["part", "n", "gram"])

    return run


def _add_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held = rows.setdefault(row["part"], [0, 0.0])
            held[0] += row["n"]
            held[1] = held[1] + np.array(row["gram"])
    for part, (n, gram) in rows.items():
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([n]), pa.array([gram.tolist()])], names=["part", "n", "gram"])


def centred(x: np.ndarray, whole: list[int], left: list[int], n: int) -> np.ndarray:
    """``x - S / n``: the whole part of the mean is taken off in integers, so nothing cancels in doubles."""
    return (x - np.array(whole, np.int64)).astype(np.float64) - np.array([r / n for r in left])


def deviations(x: np.ndarray, whole: list[int], left: list[int], n: int) -> list[int]:
    """The exact sum over dimensions of ``(n * x - S)^2`` of each row.

    ``n * x - S = n * u - left`` with ``u = x - whole`` and ``0 <= left < n``, so the sum is
    ``n^2 * sum(u^2) - 2 * n * sum(u * left) + sum(left^2)``; the three sums are taken in integers of 64 bits where
    they fit and of any size where they may not.
    """
    u, r = x - np.array(whole, np.int64), np.array(left, np.int64)
    largest = max(int(np.abs(u).max(initial=0)), 1)
    if largest * max(largest, n) * x.shape[1] < 1 << 62:
        squares, mixed = (u * u).sum(1).tolist(), (u * r).sum(1).tolist()
    else:
        wide = u.astype(object)
        squares, mixed = (wide * wide).sum(1).tolist(), (wide * r.astype(object)).sum(1).tolist()
    tail = sum(v * v for v in left)
    return [n * n * s - 2 * n * m + tail for s, m in zip(squares, mixed)]


@dataclass
class Whitening:
    """A fitted basis: ``n`` vectors with sums ``sums``, components in the columns of ``basis`` by falling variance,
    ``explained`` shares of the trace, and the largest entry by which the whitened covariance is off the identity."""

    n: int
    sums: list[int]
    basis: np.ndarray
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float
    passes: int


def vectors(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, x``: the rows whose vector is complete, as integers.

    Dropped: null and empty vectors, those with null, infinite or NaN entries or entries beyond ``LARGEST / 64``, and,
    where lengths differ, all but the most frequent length (the shorter of two as frequent).
    """
    fits = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < LARGEST - OFFSET))
    held = rows.filter(F.col(column).isNotNull() & (F.size(column) > 0) & fits).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(column, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET)).alias("x"),
    )
    lengths = held.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return held.filter(F.size("x") == (lengths["size"] if lengths else 0))


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a frame of ``vectors``; None without any."""
    first = x.select("x").first()
    if first is None:
        return None
    size, only = len(first["x"]), x.select("x")
    row = _tree(only.mapInArrow(_spectra(size), _SPECTRUM), _combine, "spectra")
    limbs, found = _unpack(row)
    n, sums = found.n, [(int(h) << _LIMB) + int(low) for h, low in zip(*limbs)]
    # a basis of the whole space: the found eigenvectors by falling value, then whatever they leave
    basis, _ = np.linalg.qr(np.column_stack([found.basis[:, ::-1], np.eye(size)]))
    for passes in range(1, MOST_PASSES + 1):
        gram = _tree(only.mapInArrow(_grams(size, n, sums, basis), _GRAM), _add_grams, "grams")["gram"]
        cov = np.array(gram).reshape(size, size) / n
        variance, top = np.diagonal(cov).copy(), min(components, size)
        rank = int((variance[:top] > size * _EPS * max(variance.max(), 1e-300)).sum())
        scaled = cov[:rank, :rank] / np.sqrt(np.outer(variance[:rank], variance[:rank]))
        error = float(np.abs(scaled - np.eye(rank)).max(initial=0))
        rises = bool((np.diff(variance) > 1e-12 * variance.max()).any())
        if passes > 1 and not rises and error <= DIAGONAL:
            break
        if passes < MOST_PASSES:
            turn = np.linalg.eigh((cov + cov.T) / 2)[1][:, ::-1]
            basis, _ = np.linalg.qr(basis @ turn)
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(size)] < 0, -1.0, 1.0)
    trace = variance.sum()
    return Whitening(n, sums, basis[:, :top], variance[:top], variance[:top] / trace if trace else variance[:top], error, passes)


OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_wide decimal(38,0)"
)


def transform(x: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per vector and component: see ``whiten``."""
    if model is None:
        return x.sparkSession.createDataFrame([], OUT)
    size, top = len(model.sums), len(model.variance)
    whole, left = [s // model.n for s in model.sums], [s % model.n for s in model.sums]
    real = model.variance > size * _EPS * max(float(model.variance.max()), 1e-300)
    scale = np.where(real, np.sqrt(np.where(real, model.variance, 1.0)), np.nan)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            x = _matrix(batch.column(1), size)
            y = centred(x, whole, left, model.n) @ model.basis / scale
            exact = deviations(x, whole, left, model.n)
            fits = [v if v < 1 << 63 else None for v in exact]
            wide = [None if v < 1 << 63 else Decimal(v) for v in exact]
            each = pa.array(np.repeat(np.arange(len(x)), top))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * top, model.n)), pa.array(fits, pa.int64()).take(each),
                    pa.array(y.ravel(), from_pandas=True), pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(x) * top, model.identity_error)), pa.array(wide, pa.decimal128(38, 0)).take(each),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"],
            )

    return x.select("id", "x").mapInArrow(run, OUT)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every complete vector of ``rows`` (``vec_id``, ``embedding``; other columns are not read).

    One row per vector and component, numbered from 1 by falling variance: ``n`` vectors, ``deviation`` (the exact sum
    of (n * x - S)^2; null where it passes 64 bits, then in ``deviation_wide``), ``whitened``, ``explained`` (the
    component's share of the trace) and ``identity_error`` (over components with variance). A component without
    variance, of constant or too few vectors, has ``whitened`` null and explains 0. Repeated rows and null ids come back
    as they are; which vectors are dropped is said at ``vectors``. No complete vector, no rows.
    """
    x = stage(vectors(rows), "vectors")
    return transform(x, fit(x, components))
