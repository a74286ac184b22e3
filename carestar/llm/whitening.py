"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers; the fit list holds each distinct vector once. One
step of the bidiagonalisation is one job: tasks multiply their centred rows by
the new right vector (``Xv``), and the result by the transposed rows (``X'u``).
A left vector is never stored: it is ``X w`` for a short vector ``w`` that the
driver keeps, so a lost executor only repeats a task. The same job takes the
products with all earlier left vectors, against which the new one is
orthogonalised; the right vectors are orthogonalised twice on the driver. What
reaches the driver is one short vector per group of tasks. The singular vectors
of the small bidiagonal matrix turn the right vectors into components. Steps end
when the components asked for have converged and a restart orthogonal to all
that was found does not change them, or when the whole space is spanned.

Defined results: rows whose vector is null or has null or non-finite entries, or
entries of 2 ** 55 and more (they have no long), are left out, and so are rows of
another length than the most frequent one (of equally frequent lengths the
longer). A row without an id is kept. Repeated rows come out as often as they went
in and count once in the fit. Only components with a variance are given: fewer
than asked for where the rows span fewer dimensions, none for a single distinct
vector. A deviation that exceeds a long is null. An empty table gives an empty
result; further columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import materialize

SCALE, SHIFT = 64, 1_000_000        # x = floor(64 * c) + 1000000; the shift cancels and is left out of what is stored
COMPONENTS = 16
LIMIT = 2.0 ** 61                   # of the scaled entries
WIDTHS = (2, 4, 8)                  # bytes an entry is stored in: the fewest that hold a vector
FAN = 256                           # most partial sums that reach the driver at once
SLICE = 1 << 20                     # entries of a table that are floating-point numbers at a time
CONVERGED = 1e-14                   # residual of a component, in units of the largest singular value
ZERO = 1e-10                        # smaller singular values, in the same units, count as none
PROBE = 8                           # steps after a restart that looks for components that were missed
SEED = 17
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _quantise(batches):
    for batch in batches:
        ids, vectors = batch.column("vec_id"), batch.column("vector")
        there = vectors.is_valid()
        ids, vectors = ids.filter(there), vectors.filter(there)
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)             # a null entry becomes nan
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(flat * SCALE)
            unsound = ~(np.abs(scaled) < LIMIT)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        bad = np.bincount(rows[unsound], minlength=len(sizes)) > 0
        scaled[unsound] = 0
        x, ends = scaled.astype(np.int64), np.cumsum(sizes)
        packed = []
        for end, size, skip in zip(ends.tolist(), sizes.tolist(), bad.tolist()):
            row = x[end - size:end]
            if skip or not size:
                packed.append(None)
                continue
            reach = max(int(row.max()), -int(row.min()) - 1)
            packed.append(row.astype(f"<i{next(w for w in WIDTHS if reach < 1 << (8 * w - 1))}").tobytes())
        keep = pa.array([p is not None for p in packed], pa.bool_())
        yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (ids, pa.array(sizes, pa.int32()), pa.array(packed, pa.binary()))],
                                         names=["vec_id", "dim", "x"])


def _blocks(column: pa.Array, dim: int):
    """The rows of packed vectors as matrices of whole numbers, some at a time, with their places."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for width in WIDTHS:
        at = np.flatnonzero(lengths == width * dim)
        for start in range(0, len(at), max(1, SLICE // dim)):
            part = at[start:start + max(1, SLICE // dim)]
            data = b"".join(column.take(pa.array(part)).to_pylist())
            yield part, np.frombuffer(data, f"<i{width}").reshape(len(part), dim).astype(np.int64)


class Centred:
    """The centred rows of the fit list, as an operand of distributed products."""

    def __init__(self, fit: DataFrame, dim: int):
        self.fit, self.dim = fit, dim
        self.n, self.sums = self._sums()
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dim)

    def _add(self, make, dtype) -> np.ndarray:
        """The sum of what ``make`` returns for the blocks of all tasks: group by group, then on the driver, in a fixed order."""
        dim = self.dim

        def task(batches):
            total = None
            for batch in batches:
                for _, x in _blocks(batch.column("x"), dim):
                    part = make(x)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_pydict({"v": pa.array([total.astype(dtype).tobytes()], pa.binary())})

        def merge(batches):
            parts = sorted(v for batch in batches for v in batch.column("v").to_pylist())
            if parts:
                total = sum(np.frombuffer(v, dtype) for v in parts)
                yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

        sums = self.fit.select("x").mapInArrow(task, "v binary")
        tasks = self.tasks if hasattr(self, "tasks") else self._count_tasks()
        while tasks > FAN:
            tasks = math.ceil(tasks / FAN)
            sums = sums.repartition(tasks, F.xxhash64("v")).mapInArrow(merge, "v binary")
        rows = sorted(r["v"] for r in sums.collect())               # sorted: the order of the tasks does not matter
        return sum(np.frombuffer(bytes(v), dtype) for v in rows) if rows else np.zeros(0, dtype)

    def _count_tasks(self) -> int:
        self.tasks = self.fit.rdd.getNumPartitions()
        return self.tasks

    def _sums(self) -> tuple[int, list[int]]:
        """Number of vectors and the exact sum of each dimension (high and low halves apart, so that none overflows)."""
        got = self._add(lambda x: np.concatenate([[len(x)], (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]), np.int64).tolist()
        if not got:
            return 0, [0] * self.dim
        return got[0], [(h << 32) + low for h, low in zip(got[1:self.dim + 1], got[self.dim + 1:])]

    def products(self, w: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """For u = Xw: X'u, the products of u with the left vectors X ``earlier`` and with itself."""
        mean, both = self.mean, np.column_stack([earlier, w])

        def make(x):
            rows = x - mean
            left = rows @ both
            u = left[:, -1]
            return np.concatenate([u @ rows, u @ left])

        got = self._add(make, np.float64)
        return got[:self.dim], got[self.dim:-1], float(got[-1])

    def trace(self) -> float:
        """Sum of the variances."""
        mean = self.mean
        return float(self._add(lambda x: np.array([np.square(x - mean).sum()]), np.float64)[0]) / self.n

    def covariance(self, directions: np.ndarray) -> np.ndarray:
        """Covariance of the rows' projections."""
        mean, k = self.mean, directions.shape[1]

        def make(x):
            z = (x - mean) @ directions
            return (z.T @ z).ravel()

        return self._add(make, np.float64).reshape(k, k) / self.n


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    if basis:
        b = np.column_stack(basis)
        for _ in range(2):
            v = v - b @ (b.T @ v)
    return v


def _fresh(rng, dim: int, basis: list[np.ndarray]) -> np.ndarray:
    """A unit vector orthogonal to the basis."""
    v = _orthogonal(_orthogonal(rng.standard_normal(dim), basis), basis)
    return v / np.linalg.norm(v)


def bidiagonalise(x: Centred, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest singular values of the centred rows and their right singular vectors (as columns)."""
    dim, rng = x.dim, np.random.default_rng(SEED)
    right, short, back = [_fresh(rng, dim, [])], [], []       # v, w with u = Xw, and X'u
    alphas, betas = [], []
    found, until = None, 0
    while True:
        j = len(alphas)
        w = right[j] - (betas[-1] * short[-1] if j else 0)
        earlier = np.column_stack(short) if j else np.zeros((dim, 0))
        y, overlap, square = x.products(w, earlier)
        if j:
            w, y = w - earlier @ overlap, y - np.column_stack(back) @ overlap
        alpha = math.sqrt(max(square - float(overlap @ overlap), 0.0))
        scale = max([alpha, *alphas, *betas])
        if alpha <= ZERO * ZERO * scale or scale == 0:         # X maps this right vector into what is spanned
            alpha, w, y = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            w, y = w / alpha, y / alpha
        alphas.append(alpha)
        short.append(w)
        back.append(y)
        upper = np.diag(alphas) + np.diag(betas, 1)
        left, values, vectors = np.linalg.svd(upper)
        if len(alphas) == dim:
            break
        following = _orthogonal(y - alpha * right[j], right)
        beta = float(np.linalg.norm(following))
        if len(alphas) >= k and (np.abs(beta * left[-1, :k]) <= CONVERGED * values[0]).all():
            if found is not None and np.allclose(values[:k], found, rtol=1e-10, atol=ZERO * values[0]):
                if len(alphas) >= until:
                    break
            else:
                found, until, beta = values[:k], len(alphas) + PROBE, 0.0
        if beta <= 1e-13 * scale:                              # all that this start reaches is spanned: start again beside it
            beta, following = 0.0, _fresh(rng, dim, right)
        else:
            following = following / beta
        betas.append(beta)
        right.append(following)
    return values[:k], np.column_stack(right) @ vectors[:k].T


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per sound vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    nothing = spark.createDataFrame([], RESULT)
    given = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = materialize(given.mapInArrow(_quantise, "vec_id long, dim int, x binary"), "vectors")
    common = sound.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return nothing
    dim = common["dim"]
    rows = sound.where(F.col("dim") == dim)
    x = Centred(materialize(rows.select("x").distinct(), "fit"), dim)
    values, directions = bidiagonalise(x, min(components, dim))
    there = values > ZERO * values[0] if values[0] > 0 else np.zeros(len(values), bool)
    if not there.any():
        return nothing
    values, directions = values[there], directions[:, there]
    directions = directions * np.sign(directions[np.abs(directions).argmax(0), np.arange(directions.shape[1])])
    whitening = directions * (math.sqrt(x.n) / values)          # over the square root of e = value ** 2 / n
    error = float(np.abs(x.covariance(whitening) - np.eye(len(values))).max())
    explained = values ** 2 / x.n / x.trace()
    return rows.select("vec_id", "x").mapInArrow(_project(x.n, x.sums, x.mean, whitening, explained, error), RESULT)


def _project(n: int, sums: list[int], mean: np.ndarray, whitening: np.ndarray, explained: np.ndarray, error: float):
    dim, k = whitening.shape

    def deviations(x: np.ndarray) -> pa.Array:
        """Sum of (n * x - S) ** 2 of each row, exact."""
        off = np.abs(x - mean).sum(1) * n
        if off.max(initial=0) < 2.0 ** 31 and float(n) * np.abs(x).max(initial=0) < 2.0 ** 62:
            return pa.array(np.square(n * x - np.array(sums, np.int64)).sum(1), pa.int64())
        exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist())
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def run(batches):
        for batch in batches:
            for at, x in _blocks(batch.column("x"), dim):
                z = (x - mean) @ whitening
                again = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").take(pa.array(at)).take(again),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                    "n": pa.array(np.full(len(at) * k, n), pa.int64()), "deviation": deviations(x).take(again),
                    "whitened": pa.array(z.ravel(), pa.float64()), "explained": pa.array(np.tile(explained, len(at)), pa.float64()),
                    "identity_error": pa.array(np.full(len(at) * k, error), pa.float64())})
    return run
