"""Exact top-k inner products as a Voronoi kNN join.

Vectors are the integers floor(256 * x).  For a query q of a group with pivot
p and radius r, |q - p| <= r, and any vector x, the score q.x lies within
r|x| of p.x (the distance bound in the form that inner products need; it asks
nothing of the vectors' norms).

1. Pivots: a hashed choice of candidates, one for about ``QUERIES_PER_GROUP``
   queries, between ``MIN_PIVOTS`` and ``MAX_PIVOTS``.  Every vector goes to the
   cell of its nearest pivot; the queries of a cell are a group.
2. Summaries: of each group the radius and the largest norm; of each cell the
   count, radius and largest norm, and the k + 1 vectors of different ids with
   the best lower bound for their own group (a few rows for each cell,
   pre-aggregated by task).  Different ids, since a query leaves out all rows
   of one id, its own.  The (k + 1)-th best lower bound p.y - r|y| over these
   vectors is a score that every query of the group reaches k times.
3. Replication: a cell whose upper bound is below that score is left out of the
   group whole; of the others a vector goes to the group only if its own upper
   bound, the smaller of p.x + r|x| and max|q| |x|, reaches the score.  Groups
   are split in blocks of queries and chunks of candidates by a hash of the id,
   so that one crowded cell or one vector that many rows share is spread over
   many tasks.
4. Each block meets its chunks as a stream in order of id, keeping k rows a
   query; partial results are merged by query.

Inner products are exact: in doubles while every partial sum stays below
2**53, otherwise with Python integers; a score beyond 64 bits counts as the
last 64-bit integer of its sign.

Defined cases: vectors that are null or hold null or non-finite components,
or a component whose integer has no 64 bits, and rows whose id is null, take
no part; vectors of different length are not compared; rows that repeat id and
vector count once; a query never meets rows of its own id; fewer candidates
than k give all; an empty table gives an empty result.  Ties go to the smaller
id.  ``replicas`` reports how much the bounds left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm import tables as T
from tokenmill.llm.bytehash import U64, mix

K = 5
SCALE = 256
QUERY_EVERY = 50
QUERIES_PER_GROUP = 128
MIN_PIVOTS, MAX_PIVOTS = 8, 2048
BLOCK_QUERIES = 512
CHUNK_ROWS = 4096
#: Scores and components beyond have no 64-bit integer.
LONG_MAX = 2 ** 63 - 1
#: Rounding of the doubles in the bounds, as a share of the largest product.
SLACK = 1e-9
#: In place of an id while a query has fewer than k neighbours.
FREE = -2 ** 63


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<long>, norm2 double) of the rows that take part."""
    v = F.col(f"`{vec_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) >= 2.0 ** 63 / SCALE))
    rows = df.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"))
    return rows


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.int64, copy=False)


def _assign_task(pivots, dim: int):
    p = pivots.value

    def fn(batch):
        x = _matrix(batch.column(1), dim).astype(np.float64)
        cell = ((p * p).sum(1)[None] - 2 * x @ p.T).argmin(1)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)),
                               pa.array(np.linalg.norm(x - p[cell], axis=1)), pa.array(np.linalg.norm(x, axis=1))],
                              names=["id", "v", "cell", "d", "norm"])
    return fn


def _sample_task(pivots, radius, dim: int, k: int):
    """Of each cell the k + 1 rows of different ids with the best lower bound."""
    p, r = pivots.value, radius.value
    kept: dict[int, tuple] = {}

    def fn(batch):
        x = _matrix(batch.column(1), dim)
        ids, cell, norm = (batch.column(i).to_numpy() for i in (0, 2, 4))
        low = (x * p[cell]).sum(1) - r[cell] * norm
        for c in np.unique(cell):
            here = np.flatnonzero(cell == c)
            i, w, y = ids[here], low[here], x[here]
            if c in kept:
                i, w, y = (np.concatenate(both) for both in zip(kept[c], (i, w, y)))
            first = _best_of_different(i, w, k + 1)
            kept[c] = i[first], w[first], y[first]
        return ()

    def end():
        for c, (i, w, y) in kept.items():
            yield pa.record_batch([pa.array(np.full(len(i), c, np.int32)), pa.array(i), pa.array(w),
                                   pa.array(list(y), pa.list_(pa.int64()))], names=["cell", "id", "low", "v"])

    fn.end = end
    return fn


def _best_of_different(ids: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Places of the n heaviest rows, one for each id."""
    order = np.lexsort((ids, -weight))
    return order[np.sort(np.unique(ids[order], return_index=True)[1])[:n]]


class Plan:
    """The score each query group is sure of, the cells that can reach it, and
    how groups are split into tasks."""

    def __init__(self, pivots: np.ndarray, groups: list, cells: list, sample: list, k: int) -> None:
        """groups: cell, asked, radius, norm; cells: cell, n, radius, norm; sample: id, v."""
        n = len(pivots)
        self.pivots = pivots
        self.asked, self.radius, self.norm = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        self.count, wide, most = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for g in groups:
            self.asked[g["cell"]], self.radius[g["cell"]], self.norm[g["cell"]] = g["asked"], g["radius"], g["norm"]
        for c in cells:
            self.count[c["cell"]], wide[c["cell"]], most[c["cell"]] = c["n"], c["radius"], c["norm"]
        ids = np.array([y["id"] for y in sample], np.int64)
        y = np.array([y["v"] for y in sample], np.float64).reshape(len(sample), pivots.shape[1])
        norm_y, norm_p = np.linalg.norm(y, axis=1), np.linalg.norm(pivots, axis=1)
        self.sure = np.full(n, -np.inf)
        for i in np.flatnonzero(self.asked):
            low = y @ pivots[i] - self.radius[i] * norm_y
            best = _best_of_different(ids, low, k + 1)
            if len(best) > k:
                self.sure[i] = low[best[k]]
        scale = max(most.max(initial=0.0), norm_p.max(initial=0.0))
        self.sure -= SLACK * (1.0 + scale * scale)
        upper = pivots @ pivots.T + norm_p[:, None] * wide[None] + self.radius[:, None] * most[None]
        self.open = (np.minimum(upper, self.norm[:, None] * most[None]) >= self.sure[:, None]) & (self.asked > 0)[:, None]
        self.blocks = np.maximum(1, -(-self.asked // BLOCK_QUERIES))
        self.chunks = np.maximum(1, -(-(self.open @ self.count) // CHUNK_ROWS))
        tasks = np.where(self.asked > 0, self.blocks * self.chunks, 0)
        self.first = np.concatenate([[0], np.cumsum(tasks)[:-1]])

    def needed(self, x: np.ndarray, cell: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(groups, rows): where the vectors' own upper bounds reach the group's sure score."""
        groups = np.flatnonzero(self.open[:, np.unique(cell)].any(1))
        upper = np.minimum(self.pivots[groups] @ x.T + self.radius[groups][:, None] * norm, self.norm[groups][:, None] * norm)
        g, r = np.nonzero(self.open[groups][:, cell] & (upper >= self.sure[groups][:, None]))
        return groups[g], r


def _spread(ids: np.ndarray, seed: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U64) + U64(seed)) >> U64(1)).astype(np.int64)


def _replicate_task(plan, dim: int, every: int):
    p = plan.value

    def rows(batch, task, kind, at):
        for b in range(0, len(at), 8192):
            cut = slice(b, b + 8192)
            where = pa.array(at[cut])
            yield pa.record_batch([pa.array(task[cut]), pa.array(np.full(len(where), kind, np.int32)),
                                   batch.column(0).take(where), batch.column(1).take(where)], names=["task", "kind", "id", "v"])

    def fn(batch):
        ids, cell, norm = (batch.column(i).to_numpy() for i in (0, 2, 4))
        x = _matrix(batch.column(1), dim).astype(np.float64)
        for a in range(0, len(ids), 500):
            part = slice(a, a + 500)
            g, r = p.needed(x[part], cell[part], norm[part])
            r = r + a
            chunk = _spread(ids[r], 1) % p.chunks[g]
            times = p.blocks[g]
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            task = np.repeat(p.first[g] + chunk, times) + block * np.repeat(p.chunks[g], times)
            yield from rows(batch, task, 1, np.repeat(r, times))
        r = np.flatnonzero(ids % every == 0)
        if len(r):
            g = cell[r]
            block = _spread(ids[r], 2) % p.blocks[g]
            times = p.chunks[g]
            chunk = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            yield from rows(batch, np.repeat(p.first[g] + block * p.chunks[g], times) + chunk, 0, np.repeat(r, times))

    return fn


def _solve_task(dim: int, k: int):
    at = None
    q_id, q_vec, top_id, top_score = [], [], None, None
    q = qf = None
    last = None
    big = False

    def flush():
        if top_id is not None and len(top_id):
            r, c = np.nonzero(top_id != FREE)
            yield pa.record_batch([pa.array(q[0][r]), pa.array(top_id[r, c]), pa.array(top_score[r, c].astype(np.int64))],
                                  names=["query_id", "vec_id", "score"])

    def meet(ids, x):
        nonlocal top_id, top_score, last, big
        repeat = np.zeros(len(ids), bool)
        repeat[1:] = (ids[1:] == ids[:-1]) & (x[1:] == x[:-1]).all(1)
        if last is not None:
            repeat[0] = ids[0] == last[0] and (x[0] == last[1]).all()
        last = ids[-1], x[-1]
        ids, x = ids[~repeat], x[~repeat]
        if not len(ids) or not len(q[0]):
            return
        most = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(qf).max(initial=0)) * max(1, dim)
        if most < 2 ** 53:
            score = qf @ x.T.astype(np.float64)
        else:
            score = np.clip(q[1].astype(object) @ x.T.astype(object), -LONG_MAX, LONG_MAX)
            if not big:
                big, top_score = True, top_score.astype(object)
        own = q[0][:, None] == ids[None]
        # A new row enters only by a higher score, or into a free place: ids come in order.
        worse = (score > top_score[:, -1:]) | (top_id[:, -1:] == FREE)
        live = np.flatnonzero((worse & ~own).any(1))
        if not len(live):
            return
        cand_id = np.concatenate([top_id[live], np.where(own[live], FREE, np.broadcast_to(ids, (len(live), len(ids))))], 1)
        cand = np.concatenate([top_score[live], score[live]], 1)
        cand = np.where(cand_id == FREE, -float("inf"), cand)
        for r, row in enumerate(live):
            best = np.argsort(-cand[r], kind="stable")[:k]
            top_id[row], top_score[row] = cand_id[r][best], cand[r][best]

    def fn(batch):
        nonlocal at, q, qf, top_id, top_score, last, big
        task, kind, ids = (batch.column(i).to_numpy() for i in range(3))
        x = _matrix(batch.column(3), dim)
        heads = np.flatnonzero(np.concatenate([[True], (task[1:] != task[:-1]) | (kind[1:] != kind[:-1])]))
        for a, b in zip(heads, np.append(heads[1:], len(task))):
            if task[a] != at:
                yield from flush()
                at, top_id, last, q, big = task[a], None, None, None, False
                q_id.clear()
                q_vec.clear()
            if kind[a] == 0:
                q_id.append(ids[a:b])
                q_vec.append(x[a:b])
                continue
            if q is None:
                qi, qv = (np.concatenate(q_id), np.concatenate(q_vec)) if q_id else (np.zeros(0, np.int64), np.zeros((0, dim), np.int64))
                once = np.unique(np.column_stack([qi, qv]), axis=0) if len(qi) else np.zeros((0, dim + 1), np.int64)
                q, qf = (once[:, 0], once[:, 1:]), once[:, 1:].astype(np.float64)
                top_id = np.full((len(once), k), FREE, np.int64)
                top_score = np.full((len(once), k), -np.inf)
            meet(ids[a:b], x[a:b])

    fn.end = flush
    return fn


def _plan(vectors: DataFrame, dim: int, k: int, every: int) -> tuple[DataFrame, Plan]:
    """(vectors with their cells, what each group needs)."""
    spark = vectors.sparkSession
    asks = F.col("id") % every == 0
    n = int(min(MAX_PIVOTS, max(MIN_PIVOTS, -(-vectors.where(asks).count() // QUERIES_PER_GROUP))))
    chosen = vectors.select("id", "v").orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(n).collect()
    points = np.unique(np.array([list(r["v"]) for r in chosen], np.float64).reshape(len(chosen), dim), axis=0)
    pivots = spark.sparkContext.broadcast(points)  # at most MAX_PIVOTS vectors
    cells = T.store(T.map_arrow(vectors, lambda: _assign_task(pivots, dim), "id long, v array<long>, cell int, d double, norm double"),
                    "cells")
    groups = cells.where(asks).groupBy("cell").agg(F.count(F.lit(1)).alias("asked"), F.max("d").alias("radius"),
                                                   F.max("norm").alias("norm")).collect()
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius"), F.max("norm").alias("norm")).collect()
    wide = np.zeros(len(points))
    for g in groups:
        wide[g["cell"]] = g["radius"]
    radius = spark.sparkContext.broadcast(wide)
    best = (T.map_arrow(cells, lambda: _sample_task(pivots, radius, dim, k), "cell int, id long, low double, v array<long>")
            .groupBy("cell", "id").agg(F.max(F.struct("low", "v")).alias("b")))
    place = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("b.low"), "id"))
    sample = best.withColumn("place", place).where(F.col("place") <= k + 1).select("id", "b.v").collect()  # k + 1 a pivot
    return cells, Plan(points, groups, counts, sample, k)


def _search(vectors: DataFrame, dim: int, k: int, every: int) -> DataFrame:
    cells, needs = _plan(vectors, dim, k, every)
    plan = vectors.sparkSession.sparkContext.broadcast(needs)  # pivots squared
    spread = T.map_arrow(cells, lambda: _replicate_task(plan, dim, every), "task long, kind int, id long, v array<long>")
    solved = T.map_arrow(spread.repartition("task").sortWithinPartitions("task", "kind", "id", "v"), lambda: _solve_task(dim, k),
                         "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return solved.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """For the rows whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    vectors = T.store(integer_vectors(df, id_col, vec_col), "vectors")
    out = None
    for r in vectors.select(F.size("v").alias("dim")).distinct().orderBy("dim").collect():
        found = _search(vectors.where(F.size("v") == r["dim"]), r["dim"], k, every)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out


def replicas(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = QUERY_EVERY) -> list[tuple]:
    """For each vector length: (length, query groups, vectors, vectors sent to groups)."""
    vectors = T.store(integer_vectors(df, id_col, vec_col), "vectors")
    out = []
    for r in vectors.groupBy(F.size("v").alias("dim")).count().orderBy("dim").collect():
        cells, needs = _plan(vectors.where(F.size("v") == r["dim"]), r["dim"], k, every)
        plan, dim = df.sparkSession.sparkContext.broadcast(needs), r["dim"]

        def make(plan=plan, dim=dim):
            def fn(batch):
                x, cell, norm = _matrix(batch.column(1), dim).astype(np.float64), batch.column(2).to_numpy(), batch.column(4).to_numpy()
                sent = sum(len(plan.value.needed(x[a:a + 500], cell[a:a + 500], norm[a:a + 500])[1]) for a in range(0, len(x), 500))
                yield pa.record_batch([pa.array([sent])], names=["sent"])
            return fn
        sent = T.map_arrow(cells, make, "sent long").agg(F.sum("sent")).first()[0]
        out.append((dim, int((needs.asked > 0).sum()), r["count"], sent or 0))
    return out
