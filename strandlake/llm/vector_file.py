"""Exact top-k by inner product over a vector-approximation file.

Vectors are integers: floor(64 x) of every component.  The file has two tables
of blocks.  In the *approximation* every dimension of a block is cut into 64
cells at the quantiles of the block's own values; a vector is its cells, a byte
a dimension, and a cell keeps the least and greatest value in it.  The
other table holds the *exact* vectors.

A search first scans the approximation alone: the cells bound every score from
below and above, and a vector whose upper bound is under the kth greatest lower
bound met so far is out.  The candidates left meet the exact vectors of their
block and are read in the order of their upper bounds, best first, until the
bound of the next is below the kth score found or known from below.

Queries are a stated set.  They are taken in chunks of bounded bytes; each is
broadcast, run and written before the next is looked at.  A task keeps the k
best of each query, and the tasks' best meet in one small ranking for each.

Cases: vectors that are null or hold a null or non-finite component, empty
ones, and rows without a vec_id, take no part; nor do those with dim * max(v)^2
of 2^62 or more, whose scores a long might not hold; a row is never its own
neighbour, but a repeated row is a neighbour like any other; ties go to the
smaller vec_id; vectors of another dimension than the query's are not compared;
with fewer than k others all are returned; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, kept

SCALE, CELLS, BLOCK = 64, 64, 2048
#: Bytes of queries that are broadcast at once, and queries that are held against a block at once.
CHUNK_BYTES, AT_ONCE = 8 << 20, 256
_FILE = "block long, dim int, n int, uids binary, vec_ids binary, cells binary, low binary, high binary, exact binary"
_NAMES = [x.split()[0] for x in _FILE.split(", ")]


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (n x dim), and the least and greatest value of each cell (dim x 64)."""
    n, dim = vectors.shape
    cells = np.empty((n, dim), np.uint8)
    low, high = np.zeros((dim, CELLS), np.int64), np.zeros((dim, CELLS), np.int64)
    cuts = np.sort(vectors, axis=0)[np.linspace(0, n - 1, CELLS + 1).astype(int)[1:-1]]
    for d in range(dim):
        cells[:, d] = np.searchsorted(cuts[:, d], vectors[:, d], side="left")
        order = np.argsort(cells[:, d], kind="stable")
        used, first = np.unique(cells[order, d], return_index=True)
        low[d, used] = np.minimum.reduceat(vectors[order, d], first)
        high[d, used] = np.maximum.reduceat(vectors[order, d], first)
    return cells, low, high


def _cells(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(n, dim)


def _build(it) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, list] = {}
    number = TaskContext.get().partitionId() << 32

    def block(dim: int) -> pa.RecordBatch:
        nonlocal number
        number += 1
        rows = waiting.pop(dim)
        exact = np.floor(np.array([v for _, _, v in rows], np.float64) * SCALE).astype(np.int64)
        cells, low, high = quantise(exact)
        of = [np.array([u for u, _, _ in rows], np.int64).tobytes(), np.array([v for _, v, _ in rows], np.int64).tobytes(), cells.tobytes(), low.tobytes(), high.tobytes(), exact.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(rows)], pa.int32()), *(pa.array([x], pa.binary()) for x in of)], names=_NAMES)

    for batch in batches(it):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            waiting.setdefault(len(row[2]), []).append(row)
            if len(waiting[len(row[2])]) == BLOCK:
                yield block(len(row[2]))
    for dim in list(waiting):
        yield block(dim)


class VectorFile(NamedTuple):
    """Two tables in the shared folder: block, dim, n, uids, vec_ids, cells, low, high; and block, exact."""

    approximation: DataFrame
    exact: DataFrame


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> VectorFile:
    """The vector-approximation file of all rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    most = F.greatest(F.abs(F.array_max(v)), F.abs(F.array_min(v))) * SCALE + 1
    fits = F.size(v) * most * most < F.lit(float(1 << 62))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(v) > 0))
    rows = rows.filter(fits).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).repartition(vectors.sparkSession.sparkContext.defaultParallelism)
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v")
    blocks = kept(rows.mapInArrow(_build, _FILE), "vector-blocks")
    return VectorFile(kept(blocks.drop("exact"), "vector-approximation"), kept(blocks.select("block", "exact"), "vector-exact"))


class _Best:
    """The k best of each query so far: greater scores first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score, self.id = np.full((n, k), np.iinfo(np.int64).min), np.full((n, k), np.iinfo(np.int64).max)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[q], score]), np.concatenate([self.id[q], ids])
        order = np.lexsort((ids, ~score))[: self.k]  # ~x falls as x grows, without overflow
        self.score[q], self.id[q] = score[order], ids[order]


_CANDIDATE = np.dtype([("q", "<i4"), ("at", "<u2"), ("upper", "<f4")])


def bounded(queries: np.ndarray, uids: np.ndarray, block: dict, lows: np.ndarray) -> Iterator[np.ndarray]:
    """Candidates of a block, by its cells alone, for some queries at a time: best bound of each query first.

    ``lows`` holds the k greatest lower bounds of each query so far, and is brought up to date.
    """
    n, dim, k = block["n"], block["dim"], lows.shape[1]
    cells = _cells(block["cells"], n, dim)
    low = np.frombuffer(block["low"], np.int64).reshape(dim, CELLS)[np.arange(dim), cells].astype(np.float64).T
    high = np.frombuffer(block["high"], np.int64).reshape(dim, CELLS)[np.arange(dim), cells].astype(np.float64).T
    own = np.frombuffer(block["uids"], np.int64)
    for i in range(0, len(queries), AT_ONCE):
        plus, minus = np.maximum(queries[i : i + AT_ONCE], 0).astype(np.float64), np.minimum(queries[i : i + AT_ONCE], 0).astype(np.float64)
        upper, lower = plus @ high + minus @ low, plus @ low + minus @ high
        upper += np.abs(upper) * 1e-9 + 1e-6  # rounding must not lose a vector
        lower -= np.abs(lower) * 1e-9 + 1e-6
        q, at = np.nonzero(uids[i : i + AT_ONCE, None] == own[None, :])
        upper[q, at] = lower[q, at] = -np.inf
        both = np.concatenate([lows[i : i + AT_ONCE], lower], axis=1)
        lows[i : i + AT_ONCE] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        known = lows[i : i + AT_ONCE].min(axis=1)
        q, at = np.nonzero((upper >= known[:, None]) & (upper > -np.inf))
        out = np.empty(len(q), _CANDIDATE)
        out["q"], out["at"] = q + i, at
        out["upper"] = np.nextafter(upper[q, at].astype(np.float32), np.float32(np.inf))  # rounded up
        if len(out):
            yield out[np.lexsort((-out["upper"], out["q"]))]


def refined(queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray, exact: np.ndarray, best: _Best) -> int:
    """Read a block's exact vectors for the candidates, best bound first.  Returns how many were read."""
    read = 0
    first = np.flatnonzero(np.concatenate([[True], candidates["q"][1:] != candidates["q"][:-1]]))
    step = max(4 * best.k, 64)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(candidates)]):
        q, at, upper = int(candidates["q"][a]), candidates["at"][a:b], candidates["upper"][a:b]
        for i in range(0, b - a, step):
            if upper[i] < best.score[q, -1]:
                break
            some = at[i : i + step]
            best.add(q, exact[some.astype(np.int64)] @ queries[q], ids[some])
            read += len(some)
    return read


def _scan(shared, k: int):
    def run(it) -> Iterator[pa.RecordBatch]:
        by_dim = shared.value
        lows = {dim: np.full((len(u), k), -np.inf) for dim, (u, _, _) in by_dim.items()}
        for batch in batches(it):
            for row in batch.to_pylist():
                if row["dim"] in by_dim:
                    uids, _, vectors = by_dim[row["dim"]]
                    for c in bounded(vectors, uids, row, lows[row["dim"]]):
                        yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([row["dim"]], pa.int32()), pa.array([row["vec_ids"]], pa.binary()), pa.array([c.tobytes()], pa.binary())], names=["block", "dim", "vec_ids", "candidates"])

    return run


def _refine(shared, k: int):
    def run(it) -> Iterator[pa.RecordBatch]:
        by_dim = shared.value
        best = {dim: _Best(len(u), k) for dim, (u, _, _) in by_dim.items()}
        for batch in batches(it):
            for row in batch.to_pylist():
                ids = np.frombuffer(row["vec_ids"], np.int64)
                exact = np.frombuffer(row["exact"], np.int64).reshape(len(ids), row["dim"])
                refined(by_dim[row["dim"]][2], np.frombuffer(row["candidates"], _CANDIDATE), ids, exact, best[row["dim"]])
        for dim, (uids, vec_ids, _) in by_dim.items():
            q, r = np.nonzero(best[dim].score != np.iinfo(np.int64).min)
            yield pa.RecordBatch.from_arrays([pa.array(uids[q]), pa.array(vec_ids[q]), pa.array(best[dim].id[q, r]), pa.array(best[dim].score[q, r])], names=["uid", "query_id", "vec_id", "score"])

    return run


def _queries(every: int):
    def run(it) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            for row in batch.to_pylist():
                ids = np.frombuffer(row["vec_ids"], np.int64)
                take = np.flatnonzero(ids % every == 0)
                uids, exact = np.frombuffer(row["uids"], np.int64), np.frombuffer(row["exact"], np.int64).reshape(row["n"], row["dim"])
                yield pa.RecordBatch.from_arrays([pa.array(uids[take]), pa.array(ids[take]), pa.array([exact[i].tobytes() for i in take], pa.binary())], names=["uid", "vec_id", "v"])

    return run


def top_k(file: VectorFile, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose vec_id is divisible by ``every``, its k best others.

    The driver holds one chunk of queries at a time; what a chunk finds is a
    table in the shared folder before the next one is read.
    """
    spark = file.exact.sparkSession
    of = file.approximation.select("block", "dim", "n", "uids", "vec_ids").join(file.exact, "block")
    queries = of.mapInArrow(_queries(every), "uid long, vec_id long, v binary")
    size = queries.agg(F.sum(F.length("v") + 16).alias("n")).first().n or 0
    n_chunks = max(1, -(-size // CHUNK_BYTES))
    chunks = kept(queries.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(n_chunks))), "queries")
    found = None
    for chunk in range(n_chunks):
        by_dim: dict[int, list] = {}
        for r in chunks.filter(F.col("chunk") == chunk).collect():
            v = np.frombuffer(r.v, np.int64)
            by_dim.setdefault(len(v), []).append((r.uid, r.vec_id, v))
        known = {dim: (np.array([x[0] for x in rows], np.int64), np.array([x[1] for x in rows], np.int64), np.stack([x[2] for x in rows])) for dim, rows in by_dim.items()}
        shared = spark.sparkContext.broadcast(known)
        candidates = file.approximation.mapInArrow(_scan(shared, k), "block long, dim int, vec_ids binary, candidates binary")
        part = candidates.join(file.exact, "block").mapInArrow(_refine(shared, k), "uid long, query_id long, vec_id long, score long")
        part = kept(part, "top-k")
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
