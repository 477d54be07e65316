"""Operator 13: whitening by the leading principal components, found by Jacobi-Davidson.

The covariance matrix is never formed. Everything that is asked of it is its
product with a block of vectors: each task centres its rows and sums up
``Z' (Z B)``; the sums of all tasks are added. On top of these products:

* Rayleigh-Ritz: the subspace gives approximate eigenpairs and their residuals;
* locking: a pair whose residual has reached double precision is fixed, later
  work stays orthogonal to it;
* correction: for the other wanted pairs ``(I - Q Q') (V - e I) (I - Q Q') t = -r``
  is solved roughly by MINRES, one short recurrence per pair, the products of all
  pairs in one pass over the data; the subspace grows by the solutions ``t``.

The rows are turned into whole numbers first, so sums and the mean are exact
and every row is centred before anything is multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.shared import ship, stored

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Larger entries are no whole numbers any more after scaling.
LARGEST = 2.0 ** 46
#: Vectors beside the wanted ones in the first subspace; the subspace is restarted beyond three times the wanted number.
GUARD, SPACES = 8, 3
#: Steps of the inner MINRES, and the share of a residual that ends it.
INNER, INNER_SHARE = 12, 0.02
OUTER = 200
#: Tasks' sums are added on the driver up to this many tasks, beyond it by other tasks first.
DIRECT = 256


# ------------------------------------------------------------------ products

def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column without nulls, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dims)


class Vectors:
    """The kept vectors as whole numbers (column ``x``), their count, sums, and products with their covariance."""

    def __init__(self, rows: DataFrame, dims: int) -> None:
        self.rows, self.dims = rows, dims
        self.passes = self._tasks = 0
        total = self._sum(lambda x: np.concatenate([[len(x)], x.sum(axis=0)]).astype(np.int64), np.int64) if dims else None
        self.n = int(total[0]) if total is not None else 0
        self.sums = total[1:] if total is not None else np.zeros(0, dtype=np.int64)

    def _sum(self, part: Callable[[np.ndarray], np.ndarray], kind=np.float64) -> np.ndarray | None:
        """Sum of ``part`` (an array of fixed length for a batch of rows) over all rows: added per task, then over the tasks."""
        dims = self.dims

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            total = None
            for batch in batches:
                if batch.num_rows:
                    found = part(_matrix(batch.column(0), dims))
                    total = found if total is None else total + found
            if total is not None:
                at = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([np.ascontiguousarray(total).tobytes()], type=pa.binary())], ["task", "total"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, first = None, None
            for batch in batches:
                for at, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    found = np.frombuffer(value, dtype=kind)
                    total, first = (found, at) if total is None else (total + found, min(first, at))
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([total.tobytes()], type=pa.binary())], ["task", "total"])

        schema = "task long, total binary"
        sums = self.rows.select("x").mapInArrow(task, schema)
        if self._tasks > DIRECT:
            sums = sums.repartition(int(np.ceil(np.sqrt(self._tasks))), "task").sortWithinPartitions("task").mapInArrow(add, schema)
        parts = sorted((r["task"], bytes(r["total"])) for r in sums.collect())         # one per task, or per group of tasks
        self._tasks = max(self._tasks, len(parts))
        self.passes += 1
        return sum(np.frombuffer(p, dtype=kind) for _, p in parts) if parts else None

    def _centre(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        whole = sums // n                                     # x - S / n without losing digits of the mean
        rest = (sums - whole * n) / n
        return lambda x: (x - whole).astype(np.float64) - rest

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block`` (dims x m): one pass."""
        centre, n, shape = self._centre(), self.n, block.shape

        def part(x: np.ndarray) -> np.ndarray:
            z = centre(x)
            return (z.T @ (z @ block)).ravel()
        return self._sum(part).reshape(shape) / n

    def trace(self) -> float:
        centre = self._centre()
        return float(self._sum(lambda x: np.array([np.square(centre(x)).sum()]))[0]) / self.n

    def projected_covariance(self, weights: np.ndarray) -> np.ndarray:
        """Covariance of the rows projected on ``weights``: their mean first, then the centred products."""
        centre, m = self._centre(), weights.shape[1]
        mean = self._sum(lambda x: (centre(x) @ weights).sum(axis=0)) / self.n

        def part(x: np.ndarray) -> np.ndarray:
            w = centre(x) @ weights - mean
            return (w.T @ w).ravel()
        return self._sum(part).reshape(m, m) / self.n


# ----------------------------------------------------------- Jacobi-Davidson

def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``against`` (twice projected; directions that add nothing go)."""
    for _ in range(2):
        block = block - against @ (against.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        if not block.shape[1]:
            return block
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-8 * s[0]]
    return block


def _minres(times: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, away: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rough solutions of ``P (V - shift I) P t = right`` for every column, ``P`` projecting away from ``away``.

    Lanczos and Givens recurrences run side by side; a column that is solved well enough stops. One product per step.
    """
    def project(b: np.ndarray) -> np.ndarray:
        return b - away @ (away.T @ b)

    right = project(right)
    beta = np.linalg.norm(right, axis=0)
    goal = INNER_SHARE * beta
    x = np.zeros_like(right)
    open_ = np.flatnonzero(beta > 0)
    m = right.shape[1]
    v_old, v = np.zeros_like(right), np.where(beta > 0, right / np.where(beta > 0, beta, 1), 0)
    d_old, d_older = np.zeros_like(right), np.zeros_like(right)
    c, s, c_old, s_old = np.ones(m), np.zeros(m), np.ones(m), np.zeros(m)
    eta, b_now = beta.copy(), np.zeros(m)
    for _ in range(INNER):
        if not len(open_):
            break
        i = open_
        w = project(times(v[:, i])) - shifts[i] * v[:, i]
        alpha = np.einsum("ij,ij->j", v[:, i], w)
        w = project(w - alpha * v[:, i] - b_now[i] * v_old[:, i])
        b_next = np.linalg.norm(w, axis=0)
        # the new column of the tridiagonal matrix under the last two rotations, then its own rotation
        delta = c[i] * alpha - c_old[i] * s[i] * b_now[i]
        r2 = s[i] * alpha + c_old[i] * c[i] * b_now[i]
        r3 = s_old[i] * b_now[i]
        r1 = np.hypot(delta, b_next)
        good = r1 > 1e-300
        i, w, delta, b_next, r1, r2, r3 = i[good], w[:, good], delta[good], b_next[good], r1[good], r2[good], r3[good]
        c_old[i], s_old[i] = c[i], s[i]
        c[i], s[i] = delta / r1, b_next / r1
        d = (v[:, i] - r2 * d_old[:, i] - r3 * d_older[:, i]) / r1
        x[:, i] += c[i] * eta[i] * d
        d_older[:, i], d_old[:, i] = d_old[:, i], d
        eta[i] = -s[i] * eta[i]
        v_old[:, i] = v[:, i]
        v[:, i] = np.where(b_next > 1e-300, w / np.where(b_next > 1e-300, b_next, 1), 0)
        b_now[i] = b_next
        open_ = i[(np.abs(eta[i]) > goal[i]) & (b_next > 1e-300)]
    return x


@dataclass
class Pairs:
    """Eigenvalues (falling) and unit eigenvectors as columns, with the residuals that were reached."""
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = 13) -> Pairs:
    """The ``wanted`` largest eigenpairs of a symmetric positive semidefinite operator, to double precision.

    ``times`` multiplies it with a block of vectors. A pair is locked when its residual norm is at most
    ``dims`` rounding errors of the largest eigenvalue; repeated eigenvalues are found with their multiplicity
    (any orthonormal basis of their space is right).
    """
    rng = np.random.default_rng(seed)
    locked, locked_values, locked_residuals = np.zeros((dims, 0)), np.zeros(0), np.zeros(0)
    space = _orthonormal(rng.standard_normal((dims, min(dims, wanted + GUARD))), locked)
    product = times(space)
    best, stalled = np.inf, 0
    for _ in range(OUTER):
        small = space.T @ product
        values, mix = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, mix = values[order], mix[:, order]
        need = wanted - len(locked_values)
        ritz, product_ritz = space @ mix, product @ mix
        top = max(float(np.max(np.abs(values))), float(locked_values.max(initial=0.0)))
        if top == 0.0:                                             # no variance at all
            return Pairs(np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
        residual = product_ritz[:, :need] - ritz[:, :need] * values[:need]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        goal = np.finfo(float).eps * max(dims, 16) * top
        worst = float(size.max())
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        # only the first pairs are locked, so that none of a larger value is missed
        done = need if (size <= goal).all() else int(np.argmax(size > goal))
        if stalled >= 6 and worst <= 64 * goal:                    # rounding errors of the products are the floor here
            done = need
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            locked_values = np.concatenate([locked_values, values[:done]])
            locked_residuals = np.concatenate([locked_residuals, size[:done]])
            ritz, product_ritz, values, residual, size = ritz[:, done:], product_ritz[:, done:], values[done:], residual[:, done:], size[done:]
            need -= done
            best, stalled = np.inf, 0
        if need == 0:
            break
        if ritz.shape[1] + need > max(SPACES * wanted, need + GUARD):           # restart with the best vectors
            ritz, product_ritz = ritz[:, :need + GUARD], product_ritz[:, :need + GUARD]
        space, product = ritz, product_ritz
        open_ = size > goal
        away = np.column_stack([locked, ritz[:, :need]])
        step = _minres(times, values[:need][open_], away, -residual[:, open_])
        new = _orthonormal(step, np.column_stack([locked, space]))
        if not new.shape[1]:                                        # nothing new: a random direction, if one is left
            if locked.shape[1] + space.shape[1] >= dims:
                product = times(space)                              # the space is whole: fresh products, without old rounding errors
                stalled += 2
                continue
            new = _orthonormal(rng.standard_normal((dims, 1)), np.column_stack([locked, space]))
        space = np.column_stack([space, new])
        product = np.column_stack([product, times(new)])
        product -= locked @ (locked.T @ product)
    else:
        raise RuntimeError("the eigenpairs did not settle")
    order = np.argsort(-locked_values, kind="stable")
    return Pairs(locked_values[order], locked[:, order], locked_residuals[order])


# ---------------------------------------------------------------- whitening

def kept_vectors(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """(``key``, ``x``) of the rows that take part, stored, and their number of dimensions."""
    v = F.col(f"`{column}`").cast("array<double>")
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) <= LARGEST), F.lit(False)))
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.when(usable, v).alias("v"), F.size(v).alias("dims")).where("v is not null")
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = sizes[0]["dims"] if sizes else 0
    x = F.transform("v", lambda e: (F.floor(e * SCALE) + SHIFT).cast("long"))
    return stored(rows.where(F.col("dims") == dims).select("key", x.alias("x")), "whitening"), dims


@dataclass
class Whitening:
    """Mean (as count and sums), components as columns divided by the roots of their variances, and their shares."""
    n: int
    sums: np.ndarray
    pairs: Pairs
    weights: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(vectors: Vectors, components: int = COMPONENTS) -> Whitening:
    """Components with variance, ``components`` at most. A variance under ``dims`` rounding errors of the largest is
    none: the vectors lie in a space of fewer dimensions, and there is nothing to divide by."""
    dims = vectors.dims
    if vectors.n == 0:
        none = Pairs(np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
        return Whitening(0, vectors.sums, none, none.vectors, none.values, 0.0)
    pairs = leading_pairs(vectors.times, dims, min(components, dims))
    real = pairs.values > (np.finfo(float).eps * 64 * max(dims, 16) * pairs.values[0] if len(pairs.values) else 0)
    pairs = Pairs(pairs.values[real], pairs.vectors[:, real], pairs.residuals[real])
    weights = pairs.vectors / np.sqrt(pairs.values)
    if not len(pairs.values):
        return Whitening(vectors.n, vectors.sums, pairs, weights, pairs.values, 0.0)
    error = np.abs(vectors.projected_covariance(weights) - np.eye(len(pairs.values))).max()
    return Whitening(vectors.n, vectors.sums, pairs, weights, pairs.values / vectors.trace(), float(error))


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: one row per vector and component.

    Vectors that are null or empty, or hold null, non-finite or absurdly large (over 2 ** 46) entries are left out of the fit and of
    the result; so are those whose number of dimensions is not the most frequent one (of equally frequent ones,
    the largest). Components without variance have no rows: none at all for a single vector or equal vectors. Repeated rows count
    each time and give equal rows, null keys are kept, an empty table gives none. ``deviation`` is null where it exceeds 64 bits. Only
    ``key`` and ``column`` are read.
    """
    spark = ship(vectors.sparkSession)
    rows, dims = kept_vectors(vectors, key, column)
    kind = rows.schema["key"].dataType.simpleString()
    data = Vectors(rows, dims)
    found = fit(data, components)
    n, sums, weights, centre = found.n, found.sums, found.weights, data._centre() if data.n else None
    schema = f"key {kind}, deviation long, w array<double>"
    if not weights.shape[1]:
        out = spark.createDataFrame([], schema)
    else:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), dims)
                if batch.num_rows and float(np.abs(n * (x - sums / n)).max()) ** 2 * dims < 2.0 ** 61:
                    deviation = np.square(n * x - sums).sum(axis=1).tolist()
                else:                                              # exact beyond 64 bits too
                    wide = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums)) for row in x]
                    deviation = [d if d < 1 << 63 else None for d in wide]
                w = centre(x) @ weights
                at = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, type=pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(at), pa.array(w.ravel()))], ["key", "deviation", "w"])

        out = rows.mapInArrow(run, schema)
    shares = F.array(*[F.lit(float(e)) for e in found.explained]).cast("array<double>")
    return (out.select("key", "deviation", F.posexplode("w").alias("_at", "whitened"))
            .select("key", (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("_at") + 1).alias("explained"), F.lit(found.identity_error).alias("identity_error")))


def op13_whiten_embeddings(spark, sf_dir: str) -> DataFrame:
    """All embeddings on their 32 leading components, whitened."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("key").cast("long").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")
