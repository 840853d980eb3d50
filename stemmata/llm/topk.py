"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into 1, 4, 16, ... segments, at last segments of two numbers; each keeps mean and deviation. The inner
product of two vectors is at most the sum over segments of w (mean * mean + deviation * deviation), which
for vectors of known norm is the lower bound of their distance. Bounds go from coarse to fine, pairs below
the query's k-th best score so far are left out, and the survivors' scores are computed exactly in integers.
A level that rules out less than it costs is not tried again in that task; the results don't depend on it.

Vectors stay where they are stored. The stated query set goes to them in rounds: blocks of queries of
``ROUND`` bytes at most are broadcast, each task runs them against its vectors block by block and carries every
query's k best on, so that k rows a query and task go on at most. A first pass over a
1/``SEEDS`` share of the vectors gives every query a score to beat, so that far fewer do.

Results by case: null vectors and vectors with a null or non-finite component take no part; vectors meet
vectors of the same dimension only; empty vectors have score 0 with each other; rows without an id take no
part; rows of a query's own id are not its candidates, repeated rows of another id are each a candidate;
an empty table gives no row; extra columns are left out; scores beyond 64 bits are held at the limits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import written

#: Rows of a block of vectors and of a block of queries.
VECTORS, QUERIES = 1024, 512
SCALE = 1024
#: Bytes of query vectors that are broadcast at once, at most (one block at least).
ROUND = 64 << 20
#: The first pass takes one vector in so many.
SEEDS = 64
#: Pairs that a level meets before it may be dropped.
TRIED = 1 << 20
#: An exact score costs about so many times what a bound of as many numbers does.
DEARER = 10.0


def _packed(batches: Iterator[pa.RecordBatch], rows: int, dtype: np.dtype = np.dtype("<i8")) -> Iterator[pa.RecordBatch]:
    """Blocks (dim, n, ids, matrix) of (id, embedding) rows; numbers beyond 64 bits are held at the limits."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def block(dim: int) -> pa.RecordBatch:
        parts = waiting.pop(dim)
        ids, m = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([m.astype(dtype).tobytes()], pa.binary())], names=["dim", "n", "ids", "matrix"])

    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        keep = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False))
        ids, vectors = ids.take(pa.array(keep)).to_numpy(zero_copy_only=False), vectors.take(pa.array(keep))
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False) if len(keep) else np.empty(0, np.int32)
        flat = vectors.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        for dim in np.unique(lengths).tolist():
            rows_of = np.flatnonzero(lengths == dim)
            m = flat[(ends[rows_of] - dim)[:, None] + np.arange(dim)]
            good = np.isfinite(m).all(axis=1)
            with np.errstate(over="ignore"):
                q = np.clip(np.floor(m[good] * SCALE), -(2.0**62), 2.0**62).astype(np.int64)
            for at in range(0, len(q), rows):
                waiting.setdefault(dim, []).append((ids[rows_of[good]][at : at + rows], q[at : at + rows]))
                if sum(len(p[0]) for p in waiting[dim]) >= rows:
                    yield block(dim)
    for dim in list(waiting):
        yield block(dim)


def _statistics(m: np.ndarray, segments: int) -> np.ndarray:
    """Features whose dot product bounds the inner product: sqrt(w) * mean and sqrt(w) * deviation of each segment."""
    edges = np.linspace(0, m.shape[1], segments + 1).astype(int)
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        part, w = m[:, lo:hi], np.sqrt(hi - lo)
        out += [part.mean(axis=1) * w, part.std(axis=1) * w]
    return np.stack(out, axis=1)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of rows paired one to one."""
    if not q.size:
        return np.zeros(len(q), np.int64)
    top = int(np.abs(q).max()) * int(np.abs(v).max()) * q.shape[1]
    if top < 2**63:
        return np.einsum("ij,ij->i", q, v)
    lo, hi = -(2**63), 2**63 - 1
    return np.array([min(hi, max(lo, sum(int(a) * int(b) for a, b in zip(x, y, strict=True)))) for x, y in zip(q, v, strict=True)], np.int64)


class Bounds:
    """The levels of a dimension, and what each has ruled out so far."""

    def __init__(self, dim: int):
        self.dim = dim
        self.levels = sorted({s for s in (1, 4, 16, 64, 256, dim // 2) if 0 < s <= dim // 2})
        self.met, self.ruled_out = dict.fromkeys(self.levels, 0), dict.fromkeys(self.levels, 0)

    def useful(self) -> list[int]:
        return [s for s in self.levels if self.met[s] < TRIED or self.ruled_out[s] * DEARER * self.dim >= self.met[s] * 2 * s]

    def count(self, level: int, before: int, after: int) -> None:
        self.met[level] += before
        self.ruled_out[level] += before - after


def search_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, least: np.ndarray | None = None, bounds: Bounds | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the k best in the block for each query, ties to the smaller id.

    Scores below ``least``, one number a query, may be left out.
    """
    bounds = bounds or Bounds(q.shape[1])
    i, j, scores = _survivors(query_ids, q, ids, v, k, np.full(len(q), -np.inf) if least is None else least, bounds)
    order = np.lexsort((ids[j], np.bitwise_not(scores), i))
    i, j, scores = i[order], j[order], scores[order]
    starts = np.searchsorted(i, np.arange(len(q)))
    best = np.arange(len(i)) - starts[i] < k if len(i) else np.zeros(0, bool)
    return query_ids[i[best]], ids[j[best]], scores[best]


def _survivors(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, least: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of q, rows of v and exact scores of the pairs that the bounds can't rule out."""
    qf, vf = q.astype(float), v.astype(float)
    alive = query_ids[:, None] != ids[None, :]
    threshold = least.astype(float)
    slack = 1e-6 + 1e-12 * np.linalg.norm(qf, axis=1)[:, None] * np.linalg.norm(vf, axis=1)[None, :]
    levels = bounds.useful()
    for s in levels:
        bound = _statistics(qf, s) @ _statistics(vf, s).T
        bound += 1e-9 * np.abs(bound) + slack
        before = int(alive.sum())
        if s == levels[-1] and len(ids) > k:
            # the most promising by the finest bound give a first threshold, exactly
            first = np.argpartition(np.where(alive, -bound, np.inf), k - 1, axis=1)[:, :k]
            rows = np.repeat(np.arange(len(q)), k)
            exact = _scores(q[rows], v[first.ravel()]).reshape(len(q), k).astype(float)
            exact[~np.take_along_axis(alive, first, axis=1)] = -np.inf
            np.maximum(threshold, exact.min(axis=1), out=threshold)
        # doubles of scores beyond 2**53 may be rounded up
        alive &= bound >= (threshold - np.abs(threshold) * 1e-12)[:, None]
        bounds.count(s, before, int(alive.sum()))
    i, j = np.nonzero(alive)
    parts = [_scores(q[i[at : at + (1 << 15)]], v[j[at : at + (1 << 15)]]) for at in range(0, len(i), 1 << 15)]
    return i, j, np.concatenate(parts) if parts else np.empty(0, np.int64)


class Search:
    """Blocks of queries with the k best that a task has found for each."""

    def __init__(self, blocks: list[tuple[int, bytes, bytes, bytes]], k: int):
        self.k, self.of, self.bounds = k, {}, {}
        for dim, ids, matrix, least in blocks:
            ids = np.frombuffer(ids, "<i8")
            empty = np.empty(0, np.int64)
            self.of.setdefault(dim, []).append([ids, np.frombuffer(matrix, "<i8").reshape(len(ids), dim), np.frombuffer(least, "<f8").copy(), (empty, empty, empty)])

    def meet(self, dim: int, ids: np.ndarray, v: np.ndarray) -> None:
        for block in self.of.get(dim, ()):
            query_ids, q, least, (i0, j0, s0) = block
            i, j, s = _survivors(query_ids, q, ids, v, self.k, least, self.bounds.setdefault(dim, Bounds(dim)))
            i, j, s = np.concatenate([i0, i]), np.concatenate([j0, ids[j]]), np.concatenate([s0, s])
            order = np.lexsort((j, np.bitwise_not(s), i))
            i, j, s = i[order], j[order], s[order]
            starts = np.searchsorted(i, np.arange(len(q) + 1))
            rank = np.arange(len(i)) - starts[i]
            best = (rank < self.k) & (s >= least[i])
            block[3] = (i[best], j[best], s[best])
            full = np.flatnonzero(np.diff(starts) >= self.k)
            last = s[starts[full] + self.k - 1].astype(float)
            least[full] = np.maximum(least[full], last - np.abs(last) * 1e-12)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for blocks in self.of.values():
            for query_ids, _, _, (i, j, s) in blocks:
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[i]), pa.array(j), pa.array(s)], names=["query_id", "vec_id", "score"])


def _found(rows: DataFrame, blocks: list, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the best of each task that reads ``rows`` (id, v)."""
    shared = rows.sparkSession.sparkContext.broadcast([(b["dim"], bytes(b["ids"]), bytes(b["matrix"]), bytes(b["least"])) for b in blocks])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, k)
        for b in _packed(batches, VECTORS):
            dim, ids = b.column(0)[0].as_py(), np.frombuffer(b.column(2)[0].as_py(), "<i8")
            search.meet(dim, ids, np.frombuffer(b.column(3)[0].as_py(), "<i8").reshape(len(ids), dim))
        yield from search.rows()

    return rows.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products of each query with all other rows."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    asked = rows.where("q").select("id", "v").distinct()
    packed = asked.repartition(max(1, -(-asked.count() // QUERIES))).mapInArrow(lambda it: _packed(it, QUERIES), "dim int, n int, ids binary, matrix binary")
    queries = written(packed.withColumn("block", F.monotonically_increasing_id()), "queries")
    seed = F.pmod(F.xxhash64("id"), F.lit(SEEDS)) == 0
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    out = []
    for names in _rounds(queries):
        chosen = queries.where(F.col("block").isin(names))
        blocks = [{**b.asDict(), "least": np.full(b["n"], -np.inf).tobytes()} for b in chosen.collect()]  # ROUND bytes
        first = written(best(_found(rows.where(seed), blocks, k)), "seeds")
        ids = {int(x) for b in blocks for x in np.frombuffer(b["ids"], "<i8")}
        known = {r.query_id: float(r.score) for r in first.where(F.col("rank") == k).select("query_id", "score").collect() if r.query_id in ids}  # a number a query of the round
        for b in blocks:
            least = [known.get(int(x), -np.inf) for x in np.frombuffer(b["ids"], "<i8")]
            b["least"] = np.array([x - abs(x) * 1e-12 for x in least], "<f8").tobytes()
        out += [first.drop("rank"), written(_found(rows.where(~seed), blocks, k), "found")]
    if not out:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return best(functools.reduce(DataFrame.unionAll, out)).select("query_id", "rank", "vec_id", "score")


def _rounds(queries: DataFrame) -> Iterator[list[int]]:
    """Numbers of the blocks of each round."""
    names, size = [], 0
    for r in queries.select("block", (F.octet_length("ids") + F.octet_length("matrix")).alias("size")).orderBy("block").toLocalIterator():
        if names and size + r["size"] > ROUND:
            yield names
            names, size = [], 0
        names.append(r["block"])
        size += r["size"]
    if names:
        yield names
