"""Action chunks as short sequences of integers, and back.

A chunk of T vectors goes through a cosine transform along its time, is scaled
and rounded, and is written with the low frequencies of all elements first: most
of what follows is zero.  Pairs that are merged often get an id of their own; the
merges are given, in the order of their rank, and are not learned here.  The
inverse expands ids and transforms back; it is off by at most what rounding took,
``sqrt(T) / (2 scale)`` for any value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _basis(horizon: int) -> np.ndarray:
    """Rows of the orthonormal cosine transform (of the second kind)."""
    norm = lambda k: math.sqrt((1 if k == 0 else 2) / horizon)
    return np.array([[norm(k) * math.cos(math.pi * (2 * t + 1) * k / (2 * horizon)) for t in range(horizon)] for k in range(horizon)])


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _products(chunks: pa.Array, matrix: np.ndarray, dim: int) -> pa.Array:
    """``matrix`` times each chunk of a batch, terms added in their order; null where a chunk has another form, and where a term is null."""
    n = len(matrix)
    length = pc.fill_null(pc.list_value_length(chunks), -1).to_numpy(zero_copy_only=False)
    vectors = chunks.flatten()
    odd = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False) != dim
    row = np.repeat(np.arange(len(chunks)), np.maximum(length, 0))
    good = (length == n) & (np.bincount(row, odd, len(chunks)) == 0)
    flat = vectors.filter(pa.array(good[row], pa.bool_())).flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, n, dim)
    null = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, n, dim).any(1, keepdims=True)
    out = np.zeros_like(x)
    for j in range(n):
        out += matrix[:, j, None] * x[:, j, None]
    values = pa.array(out.ravel(), mask=np.broadcast_to(null, out.shape).ravel())
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, dim), pa.int32()), values)
    ends = np.concatenate([[0], np.cumsum(good * n)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner, mask=pa.array(~good))


def _times(matrix: np.ndarray, chunk: Column, dim: int) -> Column:
    @F.arrow_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def times(chunks: pa.Array) -> pa.Array:
        return _products(chunks, matrix, dim)

    return times(chunk.cast("array<array<double>>"))


def transformed(chunk: Column, horizon: int, dim: int) -> Column:
    """Coefficients, by frequency and then element, of ``horizon`` vectors of ``dim``."""
    return _times(_basis(horizon), chunk, dim)


def restored(coefficients: Column, horizon: int, dim: int) -> Column:
    """The vectors of coefficients."""
    return _times(_basis(horizon).T, coefficients, dim)


def quantised(chunk: Column, horizon: int, dim: int, scale: float = 10.0) -> Column:
    """The chunk as horizon x dim integers; null where the chunk has another form or a value is missing."""
    whole = (F.size(chunk) == horizon) & F.forall(chunk, lambda v: v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)))
    return F.when(whole, F.transform(F.flatten(transformed(chunk, horizon, dim)), lambda x: F.rint(x * scale).cast("long")))


def dequantised(numbers: Column, horizon: int, dim: int, scale: float = 10.0) -> Column:
    """The chunk of integers; a sequence of another length (a model's mistake) gives zeros."""
    rows = F.transform(_numbers(horizon), lambda k: F.transform(F.slice(numbers, k * dim + 1, F.lit(dim)), lambda n: n / F.lit(scale)))
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), dim), horizon)
    return F.when(F.size(numbers) == horizon * dim, restored(rows, horizon, dim)).when(numbers.isNotNull(), zeros)


class Merges:
    """Ids of integers and of merged pairs: an integer x is x - least, the i-th pair is count + i."""

    def __init__(self, least: int, count: int, pairs: Sequence[tuple[int, int]] = ()) -> None:
        self.least, self.count, self.pairs = least, count, [tuple(p) for p in pairs]
        for i, p in enumerate(self.pairs):
            if not all(0 <= x < count + i for x in p):
                raise ValueError(f"pair {i} is of ids that are not there yet: {p}")
        self.rank = {p: i for i, p in enumerate(self.pairs)}

    def encode(self, numbers: Sequence[int]) -> list[int]:
        """Merge the pair of least rank everywhere, from the left, until none is left; integers beyond the range are cut to it."""
        ids = [min(max(x - self.least, 0), self.count - 1) for x in numbers]
        while len(ids) > 1:
            rank = min((self.rank.get(p, len(self.pairs)) for p in zip(ids, ids[1:])))
            if rank == len(self.pairs):
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == self.pairs[rank]:
                    out.append(self.count + rank)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def decode(self, ids: Sequence[int]) -> list[int]:
        """Integers of the ids; those that don't exist are left out."""
        out, stack = [], [i for i in reversed(ids) if 0 <= i < self.count + len(self.pairs)]
        while stack:
            i = stack.pop()
            if i < self.count:
                out.append(i + self.least)
            else:
                a, b = self.pairs[i - self.count]
                stack += [b, a]
        return out


def _mapped(df: DataFrame, column: str, name: str, of: Callable[[list[int]], list[int]]) -> DataFrame:
    """``df`` with a list of integers made from one of its own."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [None if r is None else of(r) for r in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.LongType()))]))


def encoded(df: DataFrame, numbers: str, merges: Merges, name: str = "ids") -> DataFrame:
    """``df`` with the ids of its integer sequences."""
    return _mapped(df, numbers, name, merges.encode)


def decoded(df: DataFrame, ids: str, merges: Merges, name: str = "numbers") -> DataFrame:
    """``df`` with the integer sequences of its ids."""
    return _mapped(df, ids, name, merges.decode)


def placed(ids: Column, vocabulary: int, skip: int = 128) -> Column:
    """Ids counted down from the end of a text vocabulary, before its last ``skip``; the same maps them back."""
    return F.transform(ids, lambda i: F.lit(vocabulary - 1 - skip) - i)
