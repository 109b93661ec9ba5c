"""Whitening of embeddings by the FEAST eigensolver (contour integration).

Each entry c becomes the whole number x = floor(``SCALE`` * c) + ``SHIFT``.
Over all n vectors with sums S the centred y = n * x - S is exact; the
covariance V of x is the mean of (y / n) (y / n)', summed by task and then by
entry in Spark, so the driver only meets matrices of dimension x dimension,
whatever the number of vectors.

The largest eigenvalues come from spectrum slicing:

1. Inertia.  The number of eigenvalues of V above a shift s is the number of
   positive pivots of an L D L' factorisation of V - s I (Sylvester's law).
   Rounds of ``SHIFTS`` shifts, each a row of a Spark job, bracket the largest
   eigenvalues and cut the bracket into intervals of at most ``SLICE``
   eigenvalues each, unless eigenvalues lie too close together to be cut.
2. FEAST.  For each interval (a, b) the projector onto its eigenspace is the
   contour integral of (z I - V)^-1 around it.  ``NODES`` Gauss-Legendre nodes
   on the half circle give as many complex shifted solves with a block of
   vectors; each (interval, node) is a row of a Spark job, and the solves of
   an interval are summed by interval.
3. Rayleigh-Ritz on the sum gives eigenvalues and unit vectors of the
   interval; 2 and 3 repeat on the new block until the residuals are at
   rounding.
4. The number of converged values in the interval must be what the inertia of
   its ends says.  If any is missing the block grows and the interval runs
   again (at the full dimension the block spans everything), so none is.

A last pass projects every vector; the covariance of the projections is taken
from the data again and compared with the identity.

Defined cases: a vector that is null or holds a null or non-finite entry takes
no part, nor does one whose length is not the most common one (ties: the
longer); a null id stays null; repeated rows count as often as they stand.
Components whose eigenvalue is not above ``LEAST`` of the trace have no
whitened values and are left out (all are, for a single vector or equal ones),
as are those beyond the dimension.  deviation is null where it passes 64 bits,
and so is every row's x where floor(``SCALE`` * c) passes 53 bits: such a vector
takes no part either.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Shifts of one inertia round, eigenvalues of one interval, nodes of one contour.
SHIFTS, SLICE, NODES = 16, 6, 8
#: Share of the trace below which a component is rounding.
LEAST = 1e-12
#: Residual, against the largest eigenvalue, at which a pair has converged.
RESIDUAL = 1e-13
MAX_ROUNDS = 12


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(negative, zero, positive) eigenvalues of a symmetric matrix, from the
    pivots of L D L' with symmetric pivoting in blocks of one and two."""
    a, n = a.copy(), len(a)
    alpha, tiny = (1 + 17 ** 0.5) / 8, np.finfo(float).eps * max(np.abs(a).max(initial=0.0), 1e-300)
    signs = [0, 0, 0]
    k = 0
    while k < n:
        rest = a[k:, k:]
        diagonal = np.abs(np.diagonal(rest))
        one = int(np.argmax(diagonal))
        off = np.abs(np.tril(rest, -1))
        i, j = np.unravel_index(int(np.argmax(off)), off.shape)
        if max(diagonal[one], off[i, j]) <= tiny:
            signs[1] += n - k
            break
        if diagonal[one] >= alpha * off[i, j]:
            _swap(a, k, k + one)
            pivot = a[k, k]
            signs[2 if pivot > 0 else 0] += 1
            column = a[k + 1:, k] / pivot
            a[k + 1:, k + 1:] -= np.outer(column, a[k, k + 1:])
            k += 1
        else:  # a block of two with a negative determinant: one eigenvalue of each sign
            _swap(a, k, k + int(j))
            _swap(a, k + 1, k + int(i))
            block = a[k:k + 2, k:k + 2]
            signs[0] += 1
            signs[2] += 1
            a[k + 2:, k + 2:] -= a[k + 2:, k:k + 2] @ np.linalg.solve(block, a[k:k + 2, k + 2:])
            k += 2
    return signs[0], signs[1], signs[2]


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` above ``shift``."""
    return inertia(v - shift * np.eye(len(v)))[2]


def contour(a: float, b: float, nodes: int = NODES) -> list[tuple[complex, complex]]:
    """(shift, weight) of Gauss-Legendre nodes on the upper half circle over
    (a, b); the lower half is its conjugate, so twice the real part is taken."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - x)
    turn = np.exp(1j * angle)
    radius = (b - a) / 2
    return [((a + b) / 2 + radius * t, c * radius * t / 4) for t, c in zip(turn, w)]


def _solve_task(matrix):
    """Rows (interval, z, weight, block) to (interval, projected part of the block)."""
    def fn(batch):
        v = matrix.value
        out = []
        for zr, zi, wr, wi, raw in zip(*[batch.column(i).to_pylist() for i in range(1, 6)]):
            block = np.frombuffer(raw).reshape(len(v), -1)
            part = np.linalg.solve(complex(zr, zi) * np.eye(len(v)) - v, block.astype(complex))
            out.append((2 * (complex(wr, wi) * part).real).tobytes())
        yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["interval", "part"])
    return fn


def _inertia_task(matrix):
    def fn(batch):
        shifts = batch.column(0).to_pylist()
        yield pa.record_batch([pa.array(shifts, pa.float64()), pa.array([above(matrix.value, s) for s in shifts], pa.int64())],
                              names=["shift", "above"])
    return fn


class Spectrum:
    """Eigenpairs of a symmetric positive semidefinite matrix, by slices.

    The matrix is broadcast: its size is the square of the dimension, a
    property of the vectors and not of their number.
    """

    def __init__(self, spark: SparkSession, v: np.ndarray, seed: int = 7) -> None:
        self.spark, self.v, self.random = spark, v, np.random.default_rng(seed)
        self.shared = spark.sparkContext.broadcast(v)
        self.bound = float(np.abs(v).sum(1).max()) * (1 + 1e-9)

    def counts(self, shifts: list[float]) -> dict[float, int]:
        rows = self.spark.createDataFrame([(float(s),) for s in shifts], "shift double").repartition(len(shifts))
        shared = self.shared
        got = T.map_arrow(rows, lambda: _inertia_task(shared), "shift double, above long").collect()
        return {r["shift"]: r["above"] for r in got}

    def slices(self, k: int) -> list[tuple[float, float, int]]:
        """(a, b, eigenvalues inside) of intervals that together hold the
        ``k`` largest eigenvalues, the highest first."""
        least = self.bound * 1e-9
        # rounding may leave a zero eigenvalue slightly below zero
        known = {self.bound: 0, -least / 2: len(self.v)}
        while True:
            low = max(s for s in known if known[s] >= k)
            top = sorted(s for s in known if s >= low)
            wide = [(a, b) for a, b in zip(top, top[1:])
                    if (known[a] - known[b] > SLICE or a < 0 < b and known[b] < k) and b - a > max(least, 1e-6 * b)]
            if not wide:
                break
            each = max(1, SHIFTS // len(wide))
            new = []
            for a, b in wide:
                # the first cuts follow the scale of the values, later ones the middle
                inner = np.geomspace(a, b, each + 2)[1:-1] if a > 0 else b * np.geomspace(1e-6, 1, each + 1)[:-1]
                new += [float(s) for s in inner]
            known |= self.counts(new)
        cuts = sorted((s for s in known if s >= low), reverse=True)
        return [(a, b, known[a] - known[b]) for b, a in zip(cuts, cuts[1:]) if known[a] > known[b]]

    def _project(self, work: dict[int, tuple[float, float, np.ndarray]]) -> dict[int, np.ndarray]:
        """The blocks of all intervals through their contours, one job."""
        rows = [(i, float(z.real), float(z.imag), float(w.real), float(w.imag), q.tobytes())
                for i, (a, b, q) in work.items() for z, w in contour(a, b)]
        frame = self.spark.createDataFrame(rows, "interval int, zr double, zi double, wr double, wi double, block binary")
        shared = self.shared
        parts = T.map_arrow(frame.repartition(len(rows)), lambda: _solve_task(shared), "interval int, part binary")
        total = {i: np.zeros(q.shape) for i, (_, _, q) in work.items()}
        for r in parts.collect():  # dimension x block for each node: no count of vectors in it
            total[r["interval"]] += np.frombuffer(r["part"]).reshape(total[r["interval"]].shape)
        return total

    def largest(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(eigenvalues falling, unit vectors as columns) of the ``k`` largest."""
        d = len(self.v)
        k = min(k, d)
        cuts = self.slices(k)
        size = [min(d, n + max(4, n // 2)) for _, _, n in cuts]
        block = [self.random.standard_normal((d, m)) for m in size]
        done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rounds = [0] * len(cuts)
        while len(done) < len(cuts):
            work = {i: (a, b, block[i]) for i, (a, b, _) in enumerate(cuts) if i not in done}
            for i, projected in self._project(work).items():
                a, b, n = cuts[i]
                if size[i] == d:
                    projected = np.eye(d)  # the block already spans everything
                q, _ = np.linalg.qr(projected)
                e, s = np.linalg.eigh(q.T @ self.v @ q)
                x = q @ s
                residual = np.linalg.norm(self.v @ x - x * e, axis=0)
                inside = (e > a) & (e <= b)
                rounds[i] += 1
                if size[i] == d:
                    order = np.argsort(-e)
                    first = sum(m for _, _, m in cuts[:i])
                    done[i] = e[order[first:first + n]], x[:, order[first:first + n]]
                elif inside.sum() == n and (residual[inside] <= RESIDUAL * self.bound * d).all():
                    done[i] = e[inside][::-1], x[:, inside][:, ::-1]
                elif rounds[i] % MAX_ROUNDS == 0:  # missed or slow: a larger block
                    size[i] = min(d, 2 * size[i])
                    block[i] = np.hstack([x, self.random.standard_normal((d, size[i] - x.shape[1]))])
                else:
                    block[i] = x
        e = np.concatenate([done[i][0] for i in range(len(cuts))])[:k]
        x = np.hstack([done[i][1] for i in range(len(cuts))])[:, :k]
        return e, x


def usable(vector: Column) -> Column:
    """No entry is null or not finite (53 bits once scaled, which finite ones of use are)."""
    large = float(2 ** 53) / SCALE
    return vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= large))


def _scaled(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where that holds it, else Python integers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max((abs(s) for s in sums), default=0))
    if largest < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _gram_task(n: int, sums: list[int], d: int):
    """This task's sum of (y / n) (y / n)', one row a matrix row."""
    total = np.zeros((d, d))

    def fn(batch):
        nonlocal total
        y = _centred(_matrix(batch.column(0), d), n, sums).astype(float) / n
        total += y.T @ y
        return ()

    def end():
        yield pa.record_batch([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    fn.end = end
    return fn


def _project_task(n: int, sums: list[int], d: int, basis):
    """(vec_id, deviation, whitened components) of each vector."""
    def fn(batch):
        y = _centred(_matrix(batch.column(1), d), n, sums)
        if len(y) and d * int(np.abs(y).max()) ** 2 >= 1 << 63:
            y = y.astype(object)
        squares = (y * y).sum(1)
        w = (y.astype(float) / n) @ basis.value
        yield pa.record_batch([batch.column(0), pa.array([int(s) if s < 2 ** 63 else None for s in squares], pa.int64()),
                               pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])
    return fn


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    spark = T.ready(df.sparkSession)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v")).where(usable(F.col("v")))
    rows = T.store(rows.select("vec_id", _scaled(F.col("v")).alias("x")), "whitening-x")
    common = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    empty = spark.createDataFrame([], _RESULT)
    if not common or not common[0]["d"]:
        return empty
    d, n = common[0]["d"], common[0]["n"]
    rows = rows.where(F.size("x") == d)
    sums = {r["i"]: int(r["s"]) for r in rows.select(F.posexplode("x").alias("i", "c")).groupBy("i")
            .agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).collect()}
    sums = [sums[i] for i in range(d)]
    v = covariance(rows, n, sums, d)
    trace = float(np.trace(v))
    e, u = Spectrum(spark, v).largest(components) if trace > 0 else (np.zeros(0), np.zeros((d, 0)))
    kept = e > LEAST * trace
    e, u = e[kept], u[:, kept]
    if not len(e):
        return empty
    basis = spark.sparkContext.broadcast(u / np.sqrt(e))  # dimension x components
    wide = T.store(T.map_arrow(rows, lambda: _project_task(n, sums, d, basis), "vec_id long, deviation long, w array<double>"),
                   "whitened")
    pairs = [(i, j) for i in range(len(e)) for j in range(i, len(e))]
    entries = wide.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(entries[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = F.array(*[F.lit(float(x / trace)) for x in e])
    return (wide.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    explained[F.col("i")].alias("explained"), F.lit(float(error)).alias("identity_error")))


def covariance(rows: DataFrame, n: int, sums: list[int], d: int) -> np.ndarray:
    """The covariance (divisor n) of the vectors ``x``, centred exactly first."""
    parts = T.map_arrow(rows.select("x"), lambda: _gram_task(n, sums, d), "i int, row array<double>")
    total = (parts.select("i", F.posexplode("row").alias("j", "c")).groupBy("i", "j").agg(F.sum("c").alias("c"))
             .select("i", "j", "c").toArrow())
    v = np.zeros((d, d))
    v[total.column("i").to_numpy(), total.column("j").to_numpy()] = total.column("c").to_numpy()
    return (v + v.T) / (2 * n)
