"""Whitening of embeddings by incremental eigendecomposition.

Every task keeps the spectrum of the vectors it has read and takes each further
vector as a centred rank-one update: directions that the update does not touch,
and poles that coincide, are deflated, the others follow from the roots of the
secular equation, found between their poles, and the eigenvectors from weights
that fit these roots exactly (Loewner's formula). Spectra of tasks are combined
``FAN_IN`` at a time, one by successive rank-one updates of the other, until one
is left. A last pass projects all vectors on that basis (Rayleigh-Ritz): the
small projected covariance gives the final values and directions, so rounding
that many updates have gathered does not show in the result.

Rows whose vector is null or holds a null, a NaN or an infinite entry are left
out, and so are vectors of another length than most (of equally frequent lengths
the longer one counts). Repeated rows and ids and null ids are rows like any
other; extra columns are not read; an empty table gives no rows. A direction
without variance (fewer vectors than dimensions, a constant entry) has whitened
value 0 and does not count in the identity error. The integer digests are exact;
entries so large that 64 bits do not hold them fail the job.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.llm.tables import stored
from mercadal.session import local_table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # x = floor(SCALE * c) + SHIFT
FAN_IN = 16
EPS = np.finfo(np.float64).eps
OUTPUT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)
LARGEST = float(1 << 62)


# ------------------------------------------------------------ rank-one updates
def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)) for ascending poles and positive
    weights, one above each pole. Returned as differences ``poles[j] - root[i]``
    (row i), which keep their relative precision, and as the roots themselves."""
    m = len(poles)
    upper = np.append(poles[1:], poles[-1] + 2.0 * weights.sum())
    half = 0.5 * (upper - poles)
    at_half = 1.0 + (weights / ((poles[None, :] - poles[:, None]) - half[:, None])).sum(axis=1)
    low_end = (at_half >= 0) | (np.arange(m) == m - 1)
    origin = np.where(low_end, poles, upper)
    delta = poles[None, :] - origin[:, None]
    left, right = poles - origin, upper - origin
    lo, hi = np.where(low_end, 0.0, -half), np.where(low_end, half, 0.0)
    x = 0.5 * (lo + hi)
    below = np.tri(m, dtype=bool)  # poles at or left of the root
    for _ in range(100):
        gaps = delta - x[:, None]
        terms = weights / gaps
        slopes = terms / gaps
        value = 1.0 + terms.sum(axis=1)
        done = np.abs(value) <= 4 * EPS * (1.0 + np.abs(terms).sum(axis=1))
        if done.all():
            break
        lo, hi = np.where(value < 0, x, lo), np.where(value < 0, hi, x)
        d_left = np.where(below, slopes, 0.0).sum(axis=1)
        d_right = slopes.sum(axis=1) - d_left
        # a + b / (left - x) + c / (right - x) through value and both slopes
        gl, gr = left - x, right - x
        a = (gl + gr) * value - gl * gr * (d_left + d_right)
        b = gl * gr * value
        c = value - gl * d_left - gr * d_right
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = x + step
        inside = (moved > lo) & (moved < hi) & np.isfinite(moved)
        new = np.where(inside, moved, 0.5 * (lo + hi))
        if (done | (new == x)).all():
            break
        x = np.where(done, x, new)
    return delta - x[:, None], origin + x


def _merge_equal_poles(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tol: float) -> None:
    """Rotates neighbours with the same pole so that all but one lose their weight."""
    at = 0
    for j in range(1, len(values)):
        if values[j] - values[at] <= tol:
            r = np.hypot(z[at], z[j])
            if r > 0:
                c, s = z[j] / r, z[at] / r
                a, b = vectors[:, at].copy(), vectors[:, j].copy()
                vectors[:, at], vectors[:, j] = c * a - s * b, s * a + c * b
                z[at], z[j] = 0.0, r
        at = j


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (ascending values, vectors in columns) after adding rho v v'."""
    z = vectors.T @ v
    weight = rho * float(z @ z)
    if not weight > 0:
        return values, vectors
    tol = 8 * EPS * max(abs(values[-1]), weight)
    if (np.diff(values) <= tol).any():
        vectors = vectors.copy()
        _merge_equal_poles(values, vectors, z, tol)
    # what the update moves by less than rounding stays as it is
    active = np.sqrt(rho * weight) * np.abs(z) > tol
    if not active.any():
        return values, vectors
    poles, z = values[active], z[active]
    gaps, roots = secular_roots(poles, rho * z * z)
    # weights whose roots these are: products of (root - pole) over (pole - pole)
    apart = poles[None, :] - poles[:, None]
    np.fill_diagonal(apart, 1.0)
    logs = np.log(np.abs(gaps)).sum(axis=0) - np.log(np.abs(apart)).sum(axis=0)
    fitted = np.copysign(np.exp(0.5 * logs), z)
    inner = fitted[None, :] / gaps
    inner /= np.linalg.norm(inner, axis=1)[:, None]
    new_values = np.concatenate([roots, values[~active]])
    new_vectors = np.concatenate([vectors[:, active] @ inner.T, vectors[:, ~active]], axis=1)
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


class Spectrum:
    """Number, mean and eigendecomposed scatter of the vectors seen so far."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)
        self.total = np.zeros(size, dtype=np.int64)  # exact

    def add(self, x: np.ndarray) -> None:
        """Takes the rows of an integer matrix one by one."""
        if float(np.abs(x).astype(np.float64).sum()) + float(np.abs(self.total.astype(np.float64)).max(initial=0)) > LARGEST:
            raise OverflowError("sums of the entries do not fit 64 bits")
        self.total += x.sum(axis=0)
        for row in x.astype(np.float64):
            apart = row - self.mean
            self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n / (self.n + 1.0))
            self.n += 1
            self.mean += apart / self.n

    def join(self, other: Spectrum) -> None:
        if not other.n:
            return
        both = self.n + other.n
        apart = other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.values, self.vectors = rank_one(self.values, self.vectors, vector, max(float(value), 0.0))
        self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * other.n / both)
        self.mean += apart * (other.n / both)
        self.n, self.total = both, self.total + other.total

    def state(self) -> list[np.ndarray]:
        return [np.array([self.n]), self.mean, self.values, self.vectors, self.total]

    @classmethod
    def of(cls, state: list[np.ndarray]) -> Spectrum:
        out = cls(len(state[1]))
        out.n, (out.mean, out.values, out.vectors, out.total) = int(state[0][0]), state[1:]
        return out


# ------------------------------------------------------------- states of tasks
def _packed(arrays: list[np.ndarray]) -> bytes:
    to = io.BytesIO()
    np.savez(to, *arrays)
    return to.getvalue()


def _unpacked(raw: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(raw), allow_pickle=False) as kept:
        return [kept[f"arr_{i}"] for i in range(len(kept.files))]


def _add_up(states: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [sum(parts) for parts in zip(*states, strict=True)]


def _join_spectra(states: list[list[np.ndarray]]) -> list[np.ndarray]:
    first = Spectrum.of(states[0])
    for other in states[1:]:
        first.join(Spectrum.of(other))
    return first.state()


def task_states(vectors: DataFrame, make: Callable[[Iterator[np.ndarray]], list[np.ndarray]], size: int) -> DataFrame:
    """Stored (part, state): what ``make`` gives for the matrices of each task
    that has any; ``part`` counts those tasks from 0."""

    def run(batches):
        seen = (matrix for batch in batches if len(matrix := matrix_of(batch, size)))
        first = next(seen, None)
        if first is None:
            return

        def all_of_them():
            yield first
            yield from seen

        yield pa.RecordBatch.from_arrays([pa.array([_packed(make(all_of_them()))], pa.binary())], names=["state"])

    made = vectors.select("x").mapInArrow(run, "state binary")
    # one row a task: the partition number is its place
    return stored(made.select(F.spark_partition_id().cast("long").alias("part"), "state"), "states")


def gathered(states: DataFrame, combine: Callable[[list[list[np.ndarray]]], list[np.ndarray]]) -> list[np.ndarray] | None:
    """One state from those of all tasks, ``FAN_IN`` at a time; what reaches the
    driver is one state, whatever the number of tasks."""
    last = states.agg(F.max("part")).first()[0]
    if last is None:
        return None

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        whole = combine([_unpacked(raw.as_py()) for raw in group["state"]])
        return pa.table({"part": group["place"][:1], "state": pa.array([_packed(whole)], pa.binary())})

    while last > 0:
        places = states.withColumn("place", F.expr(f"part div {FAN_IN}"))
        states = places.groupBy("place").applyInArrow(run, "part long, state binary")
        last //= FAN_IN
    return _unpacked(bytes(states.first()["state"]))


# ------------------------------------------------------------------- operators
def matrix_of(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors of a batch less ``SHIFT``, as rows."""
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size) - SHIFT


def fit_list(table: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that count, and the number of dimensions."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = table.where(F.col(column).isNotNull() & F.coalesce(finite, F.lit(False)))
    digest = F.transform(column, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    lengths = whole.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    kept = whole.where(F.size(column) == size)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), digest.alias("x")), size


class Whitening:
    """A fitted whitening: ``apply`` gives the whitened rows of a matrix."""

    def __init__(self, n: int, total: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float, components: int):
        self.n, self.total = n, total
        self.values, self.vectors = values[:components], vectors[:, :components]
        self.explained = self.values / trace if trace > 0 else np.zeros(len(self.values))
        # below rounding of the largest there is no variance to divide by
        self.live = self.values > 64 * EPS * max(float(values[0]), 0.0) if len(values) else np.zeros(0, dtype=bool)
        self.factors = np.where(self.live, 1.0 / np.sqrt(np.where(self.live, self.values, 1.0)), 0.0)

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in whole numbers."""
        if self.n * float(np.abs(x).max(initial=0)) + float(np.abs(self.total).max(initial=0)) > LARGEST:
            raise OverflowError("n * x does not fit 64 bits")
        return self.n * x - self.total

    def apply(self, x: np.ndarray) -> np.ndarray:
        return ((self.apart(x) / self.n) @ self.vectors) * self.factors


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening learned from all ``vectors``; None if there are none."""

    def spectrum(matrices):
        out = Spectrum(size)
        for x in matrices:
            out.add(x)
        return out.state()

    state = gathered(task_states(vectors, spectrum, size), _join_spectra) if size else None
    if state is None:
        return None
    first = Spectrum.of(state)
    basis = np.linalg.qr(first.vectors[:, ::-1])[0]
    plain = Whitening(first.n, first.total, np.ones(size), basis, 1.0, size)

    def projected(matrices):
        out = np.zeros((size, size))
        for x in matrices:
            y = (plain.apart(x) / plain.n) @ basis
            out += y.T @ y
        return [out]

    (ritz,) = gathered(task_states(vectors, projected, size), _add_up)
    values, inner = np.linalg.eigh((ritz + ritz.T) / (2.0 * first.n))
    values, found = np.maximum(values[::-1], 0.0), basis @ inner[:, ::-1]
    largest = np.abs(found).argmax(axis=0)
    found = found * np.where(found[largest, np.arange(size)] < 0, -1.0, 1.0)
    return Whitening(first.n, first.total, values, found, float(np.trace(ritz)) / first.n, components)


def identity_error(vectors: DataFrame, size: int, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance less the identity, by size."""

    def moments(matrices):
        k = len(model.values)
        sums, products = np.zeros(k), np.zeros((k, k))
        for x in matrices:
            w = model.apply(x)
            sums += w.sum(axis=0)
            products += w.T @ w
        return [sums, products]

    sums, products = gathered(task_states(vectors, moments, size), _add_up)
    mean = sums / model.n
    apart = products / model.n - np.outer(mean, mean) - np.eye(len(mean))
    return float(np.abs(apart[np.ix_(model.live, model.live)]).max(initial=0.0))


def deviations(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Sum over the dimensions of (n x - S)^2, exact."""
    apart = model.apart(x)
    most = float(np.abs(apart).max(initial=0))
    if most * most * max(x.shape[1], 1) < LARGEST:
        return (apart * apart).sum(axis=1)
    whole = [sum(int(v) ** 2 for v in row) for row in apart]
    if max(whole) >= 1 << 63:
        raise OverflowError("a deviation does not fit 64 bits")
    return np.array(whole, dtype=np.int64)


def whitened(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component (see the module)."""
    vectors, size = fit_list(table)
    model = fit(vectors, size, components)
    if model is None:
        return local_table(table.sparkSession, [], OUTPUT)
    error = identity_error(vectors, size, model)
    k = len(model.values)

    def run(batches):
        for batch in batches:
            x = matrix_of(batch, size)
            rows = len(x)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, dtype=np.int64)),
                    pa.array(np.repeat(deviations(model, x), k)),
                    pa.array(model.apply(x).reshape(-1)),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, OUTPUT)
