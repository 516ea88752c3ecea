"""Embedding whitening: an incremental eigendecomposition, refined by a Rayleigh-Ritz step over all rows.

Each partition keeps the spectrum of the scatter of its vectors and takes them in one after the other:
a centred rank-one update, whose new eigenvalues are the roots of the secular equation between the
old ones.  Directions that an update does not touch, and equal eigenvalues, are deflated first.  The
spectra of partitions are combined in a tree, each eigenpair of one being a rank-one update of the
other, then their difference of means.  In the basis found, the scatter of all rows is summed up once more by
Spark and diagonalised, which gives the components to double precision.

Entries become whole numbers, ``floor(1024 * c) + 100000``, so that counts, sums and deviations are exact.

Odd rows: a vector that is null or holds a null or non-finite entry is left out; a vector shorter than
the longest, also an empty one, is filled up with zeros; entries beyond 2**30 either way count as that
bound; a null or repeated id and repeated rows are rows like others.  Components without variance are
not returned: with one distinct vector, or none, there are no rows.  A deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import arrow
from .storage import settle

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**30
N_COMPONENTS = 8
# Entries handled at once in a task.
PIECE_ENTRIES = 1 << 19
# Spectra that are combined in one step of the tree.
FAN_IN = 8
# A component has variance if its share of the total is above this.
LEAST_SHARE = 1e-13
ROUNDS = 80
EPS = np.finfo(np.float64).eps

SPECTRUM = pa.schema(
    [("slot", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("values", pa.list_(pa.float64())),
     ("vectors", pa.list_(pa.float64()))]
)
SPECTRUM_SQL = "slot bigint, n bigint, sums array<bigint>, values array<double>, vectors array<double>"
ENTRY = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])
RESULT = pa.schema(
    [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
)
RESULT_SQL = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


# -- one rank-one update ------------------------------------------------------------------------
def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho z z'`` for rising ``d``, and the matrix ``d[j] - root[i]``.

    Each root lies between two poles and is sought from the nearer one, by a rational interpolation
    with both poles that keeps to a bracket; the distances are exact although the poles be close.
    """
    k = len(d)
    w = rho * z * z
    ends = np.append(d[1:], d[-1] + w.sum())
    gap = ends - d
    last = np.arange(k) == k - 1
    half = gap / 2
    spread = d[:, None] - d[None, :]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        at_middle = 1 + (w[:, None] / (spread - half[None, :])).sum(0)
        right = (at_middle < 0) & ~last
        origin = np.where(right, np.arange(k) + 1, np.arange(k))
        origin[-1] = k - 1
        base = spread[:, origin]
        low = np.where(right, -half, 0.0)
        high = np.where(right, 0.0, np.where(last, gap, half))
        tau = np.where(right, -half / 2, half / 2)
        below = np.arange(k)[:, None] <= np.arange(k)[None, :]
        own, column = np.arange(k), np.arange(k)
        after = np.minimum(own + 1, k - 1)
        for _ in range(ROUNDS):
            delta = base - tau
            part = w[:, None] / delta
            f = 1 + part.sum(0)
            slope = part / delta
            lower = np.where(below, slope, 0).sum(0)
            upper = slope.sum(0) - lower
            low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
            good = np.abs(f) <= 4 * k * EPS * (1 + np.abs(part).sum(0))
            if good.all():
                break
            a, b = delta[own, column], delta[after, column]
            c = f - a * lower - b * upper
            s = (a + b) * f - a * b * (lower + upper)
            root = np.sqrt(np.maximum(s * s - 4 * a * b * f * c, 0))
            step = np.where(s <= 0, (s - root) / (2 * c), 2 * a * b * f / (s + root))
            # The last root has a single pole beside it.
            whole = lower + upper
            step[-1] = a[-1] + a[-1] ** 2 * whole[-1] / (f[-1] - a[-1] * whole[-1])
            new = tau + step
            inside = (new > low) & (new < high) & np.isfinite(new)
            new = np.where(inside, new, (low + high) / 2)
            new = np.where(good, tau, new)
            if np.array_equal(new, tau):
                break
            tau = new
    return d[origin] + tau, base - tau


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``Q diag(values) Q' + rho v v'``, ``values`` rising and ``rho`` positive."""
    z = vectors.T @ vector
    norm = np.linalg.norm(z)
    if norm == 0 or rho == 0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    tolerance = 8 * EPS * max(abs(values[-1]), abs(values[0]), rho)
    # Equal eigenvalues: turn their vectors so that the update meets one of them alone.
    close = np.diff(values) <= tolerance
    if close.any():
        values, vectors, z = values.copy(), vectors.copy(), z.copy()
        starts = np.flatnonzero(np.append(True, ~close))
        for first, stop in zip(starts, np.append(starts[1:], len(values))):
            part = z[first:stop]
            size = np.linalg.norm(part)
            if stop - first > 1 and size > 0:
                mirror, size = part.copy(), np.copysign(size, part[-1])
                mirror[-1] += size
                mirror /= np.linalg.norm(mirror)
                block = vectors[:, first:stop]
                vectors[:, first:stop] = block - 2 * np.outer(block @ mirror, mirror)
                z[first:stop] = 0
                z[stop - 1] = -size
                values[first:stop] = values[first:stop].mean()
    touched = rho * np.abs(z) > tolerance
    d, part = values[touched], z[touched]
    if not len(d):
        return values, vectors
    if len(d) == 1:
        values = values.copy()
        values[touched] += rho * part**2
    else:
        roots, delta = secular_roots(d, part, rho)
        # The vector for which these roots are exact; its eigenvectors are orthogonal as computed.
        spread = d[None, :] - d[:, None]
        ratio = -delta / np.where(spread == 0, 1.0, spread)
        part = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=1)) / rho), part)
        inner = part[:, None] / delta
        inner /= np.linalg.norm(inner, axis=0)
        values, vectors = values.copy(), vectors.copy()
        values[touched] = roots
        vectors[:, touched] = vectors[:, touched] @ inner
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums and the eigendecomposition of the scatter of some vectors."""

    def __init__(self, n: int = 0, sums=(), values=(), vectors=()):
        self.n, self.sums = n, np.array(sums, np.int64)
        self.values = np.array(values, np.float64)
        self.vectors = np.array(vectors, np.float64).reshape(len(self.sums), len(self.sums))

    def widen(self, dim: int) -> None:
        """Further dimensions: so far all vectors are zero there."""
        old = len(self.sums)
        if dim > old:
            self.sums = np.append(self.sums, np.full(dim - old, self.n * SHIFT, np.int64))
            vectors = np.eye(dim)[:, [*range(old, dim), *range(old)]]
            vectors[:old, dim - old :] = self.vectors
            self.values, self.vectors = np.append(np.zeros(dim - old), self.values), vectors

    def _absorb(self, rho: float, vector: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, rho, vector)

    def add(self, x: np.ndarray, times: int) -> None:
        """Take in a vector of whole numbers that occurs so many times."""
        if self.n:
            self._absorb(self.n * times / (self.n + times), (x * self.n - self.sums) / self.n)
        self.n += times
        self.sums = self.sums + x * times

    def merge(self, other: Spectrum) -> None:
        dim = max(len(self.sums), len(other.sums))
        self.widen(dim)
        other.widen(dim)
        if self.n and other.n:
            for rho, vector in zip(other.values, other.vectors.T):
                if rho > 0:
                    self._absorb(rho, vector)
            apart = self.sums / self.n - other.sums / other.n
            self._absorb(self.n * other.n / (self.n + other.n), apart)
        elif other.n:
            self.values, self.vectors = other.values, other.vectors
        self.n += other.n
        self.sums = self.sums + other.sums

    def row(self, slot: int) -> pa.RecordBatch:
        lists = [[self.sums], [self.values], [np.ascontiguousarray(self.vectors).ravel()]]
        return arrow(SPECTRUM, [slot], [self.n], *lists)


def _spectra(batch: pa.RecordBatch) -> Iterator[Spectrum]:
    for row in batch.to_pylist():
        yield Spectrum(row["n"], row["sums"], row["values"], row["vectors"])


# -- vectors in tasks ----------------------------------------------------------------------------
def _whole_numbers(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows remain, and their vectors as whole numbers, filled up to ``dim`` or the longest."""
    long = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).cast(pa.float64())
    bad = flat.is_null().to_numpy(zero_copy_only=False)
    entries = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
    bad = bad | ~np.isfinite(entries)
    row = np.repeat(np.arange(len(long)), long)
    remains = ~column.is_null().to_numpy(zero_copy_only=False)
    remains[row[bad]] = False
    width = int(long[remains].max(initial=0)) if dim is None else dim
    out = np.full((len(long), width), SHIFT, np.int64)
    keep = remains[row]
    place = np.arange(len(row)) - np.repeat(np.cumsum(long) - long, long)
    bounded = np.clip(entries[keep], -LARGEST, LARGEST)
    out[row[keep], place[keep]] = np.floor(SCALE * bounded).astype(np.int64) + SHIFT
    return remains, out[remains]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds a bounded number of entries; a vector is never cut."""
    for batch in batches:
        long = pc.fill_null(pc.list_value_length(batch.column("vector")), 0).to_numpy(zero_copy_only=False)
        first = 0
        while first < batch.num_rows:
            # Short vectors are filled up, so the longest so far counts for all.
            widest = np.maximum.accumulate(long[first:].astype(np.int64))
            room = widest * np.arange(1, len(widest) + 1)
            rows = max(1, int(np.searchsorted(room, PIECE_ENTRIES, "right")))
            yield batch.slice(first, rows)
            first += rows


def _spectrum_of_all(slim: DataFrame) -> Spectrum:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum = Spectrum()
        for batch in _pieces(batches):
            _, x = _whole_numbers(batch.column("vector"))
            if not len(x):
                continue
            spectrum.widen(x.shape[1])
            distinct, times = np.unique(x, axis=0, return_counts=True) if x.shape[1] else (x[:1], np.array([len(x)]))
            filled = np.full((len(distinct), len(spectrum.sums)), SHIFT, np.int64)
            filled[:, : distinct.shape[1]] = distinct
            for vector, count in zip(filled, times):
                spectrum.add(vector, int(count))
        if spectrum.n:
            yield spectrum.row(TaskContext.get().partitionId())

    def combine(table: pa.Table) -> pa.Table:
        whole = Spectrum()
        for batch in table.to_batches(max_chunksize=1):
            for spectrum in _spectra(batch):
                whole.merge(spectrum)
        return pa.Table.from_batches([whole.row(table.column("slot")[0].as_py())])

    spectra = settle(slim.select("vector").mapInArrow(gather, SPECTRUM_SQL))
    most = spectra.agg(F.max("slot")).first()[0]
    while most:
        most //= FAN_IN
        dealt = spectra.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("bigint"))
        spectra = dealt.groupBy("slot").applyInArrow(combine, SPECTRUM_SQL)
    rows = spectra.toArrow().to_batches()
    return next((s for b in rows for s in _spectra(b)), Spectrum())


def _product_sums(slim: DataFrame, basis: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over all rows of ``y y'``, where ``y`` is the centred row in the basis, an extra 1 at its end."""
    k = basis.shape[1] + 1

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in _pieces(batches):
            _, x = _whole_numbers(batch.column("vector"), len(sums))
            y = np.append(((x * n - sums) / n) @ basis, np.ones((len(x), 1)), axis=1)
            total += y.T @ y
        i, j = np.triu_indices(k)
        yield arrow(ENTRY, i.astype(np.int32), j.astype(np.int32), total[i, j])

    parts = slim.select("vector").mapInArrow(multiply, "i int, j int, value double")
    found = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    i, j, value = (found.column(c).to_numpy() for c in ("i", "j", "value"))
    out = np.zeros((k, k))
    out[i, j] = out[j, i] = value
    return out


def _deviations(centred: np.ndarray) -> pa.Array:
    """Exact sums of squares of whole numbers."""
    largest = float(np.abs(centred).max(initial=0))
    if largest * largest * centred.shape[1] < 2.0**62:
        return pa.array((centred * centred).sum(axis=1))
    exact = [sum(int(v) * int(v) for v in row) for row in centred]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", n_components: int = N_COMPONENTS
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every remaining row."""
    slim = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    whole = _spectrum_of_all(slim)
    n, sums = whole.n, whole.sums
    if n == 0 or len(sums) == 0:
        return vectors.sparkSession.createDataFrame([], RESULT_SQL)
    # Orthogonal to the last bit, then the scatter of all rows in this basis.
    basis = np.linalg.qr(whole.vectors)[0]
    scatter = _product_sums(slim, basis, n, sums)[:-1, :-1] / n
    values, turned = np.linalg.eigh(scatter)
    total = float(values.sum())
    order = np.argsort(-values)[:n_components]
    chosen = [i for i in order if values[i] > LEAST_SHARE * total]
    if not chosen:
        return vectors.sparkSession.createDataFrame([], RESULT_SQL)
    project = (basis @ turned[:, chosen]) / np.sqrt(values[chosen])
    explained = values[chosen] / total
    k = len(chosen)
    # Measured on the whitened rows themselves; the last row and column hold their sums.
    measured = _product_sums(slim, project, n, sums) / n
    means = measured[:-1, -1]
    error = float(np.abs(measured[:-1, :-1] - np.outer(means, means) - np.eye(k)).max())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            remains, x = _whole_numbers(batch.column("vector"), len(sums))
            m = len(x)
            centred = x * n - sums
            each = pa.array(np.repeat(np.arange(m), k))
            ids = batch.column("vec_id").filter(pa.array(remains)).take(each)
            white = ((centred / n) @ project).ravel()
            numbers = np.tile(np.arange(1, k + 1, dtype=np.int32), m)
            yield arrow(
                RESULT, ids, numbers, np.full(m * k, n), _deviations(centred).take(each), white,
                np.tile(explained, m), np.full(m * k, error),
            )

    return slim.mapInArrow(rows, RESULT_SQL)
