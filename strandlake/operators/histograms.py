"""Bounded, mergeable summaries of vector features: moments and histograms in one pass.

A summary of a feature's element holds its count, mean, squared deviations,
least and greatest value, and the counts of at most ``BINS`` bins.  Bins are
[i w, (i + 1) w) with a width w that is a power of two, the least one at which so
many bins cover the range.  As the range grows the width doubles and every bin
goes whole into the one that holds it, so nothing is lost when summaries are
merged, and the order of merging doesn't matter.

A task makes one summary of each group and element from its Arrow batches; the
summaries meet in aggregations with map-side combining, bin by bin, so no task
holds more than ``BINS`` counts of a group's element however many rows it has.
A quantile is off by a bin at most, which is the range over ``BINS / 2`` at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import kept

#: Bins of a summary at most; their width is between the range over this and twice that.
BINS = 10_000
#: Groups and elements of which a task holds summaries before it passes them on.
HELD = 4096
_BIN = "array<struct<bin: long, n: long>>"
_MOMENTS = "n long, mean double, m2 double, min double, max double, scale int"


def scale_of(low: float, high: float, bins: int = BINS) -> int:
    """Exponent of the least power of two at which ``bins`` bins cover [low, high] and bins have exact numbers."""
    most = max(abs(low), abs(high))
    k = -1000
    if high > low:
        k = max(k, int(np.floor(np.log2((high - low) / bins))) - 1)
    if most > 0:
        k = max(k, int(np.floor(np.log2(most))) - 53)
    while np.floor(np.ldexp(high, -k)) - np.floor(np.ldexp(low, -k)) >= bins or np.ldexp(most, -k) >= 2.0**52:
        k += 1
    return k


def _scale(low: str, high: str, bins: int) -> Column:
    """The same in SQL."""
    most = f"greatest(abs({low}), abs({high}))"
    first = f"cast(greatest(-1000, floor(log2(({high} - {low}) / {bins})) - 1, floor(log2({most})) - 53) as int)"
    ok = f"floor({high} / pow(2D, k)) - floor({low} / pow(2D, k)) < {bins} AND {most} / pow(2D, k) < pow(2D, 52)"
    return F.expr(f"filter(sequence({first}, {first} + 4), k -> {ok})[0]")


class Summary:
    """Summary of one element, updated batch by batch."""

    def __init__(self, bins: int = BINS) -> None:
        self.bins, self.n, self.mean, self.m2 = bins, 0, 0.0, 0.0
        self.low, self.high, self.scale = np.inf, -np.inf, -1000
        self.numbers, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def update(self, x: np.ndarray) -> None:
        x = x[np.isfinite(x)]
        if not len(x):
            return
        mean = float(x.mean())
        n, d = self.n + len(x), mean - self.mean
        self.m2 += float(((x - mean) ** 2).sum()) + d * d * self.n * len(x) / n
        self.mean += d * len(x) / n
        self.n, self.low, self.high = n, min(self.low, float(x.min())), max(self.high, float(x.max()))
        scale = scale_of(self.low, self.high, self.bins)
        old = self.numbers >> min(63, scale - self.scale)
        new, counts = np.unique(np.floor(np.ldexp(x, -scale)).astype(np.int64), return_counts=True)
        self.numbers, of = np.unique(np.concatenate([old, new]), return_inverse=True)
        self.counts = np.bincount(of, np.concatenate([self.counts, counts]), len(self.numbers)).astype(np.int64)
        self.scale = scale


def _key_values(batch: pa.RecordBatch, keys: Sequence[str]) -> list[tuple]:
    return list(zip(*(batch.column(i).to_pylist() for i in range(len(keys)))))


def summaries(df: DataFrame, vector: str, keys: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """A summary for each group, element and task: keys, dim, n, mean, m2, min, max, scale, bins.

    Null vectors and elements that are null, NaN or infinite don't count;
    vectors may differ in length.  The table is written once.
    """
    rows = df.select(*(F.col(k) for k in keys), F.col(vector).cast("array<double>").alias("_vector")).filter(F.col("_vector").isNotNull())
    schema = T.StructType([*rows.select(*keys).schema.fields, *T._parse_datatype_string(f"dim int, {_MOMENTS}, bins {_BIN}").fields])

    def told(held: dict[tuple, Summary], types: list[pa.DataType]) -> pa.RecordBatch:
        some = [(g, s) for g, s in held.items() if s.n]
        cols = [pa.array([g[i] for g, _ in some], t) for i, t in enumerate(types)]
        cols += [pa.array([g[-1] for g, _ in some], pa.int32()), pa.array([s.n for _, s in some], pa.int64())]
        cols += [pa.array([get(s) for _, s in some], pa.float64()) for get in (lambda s: s.mean, lambda s: s.m2, lambda s: s.low, lambda s: s.high)]
        cols.append(pa.array([s.scale for _, s in some], pa.int32()))
        flat = lambda get: np.concatenate([*(get(s) for _, s in some), np.zeros(0, np.int64)])
        pairs = pa.StructArray.from_arrays([pa.array(flat(lambda s: s.numbers)), pa.array(flat(lambda s: s.counts))], names=["bin", "n"])
        ends = np.concatenate([[0], np.cumsum([len(s.numbers) for _, s in some], dtype=np.int64)]).astype(np.int32)
        cols.append(pa.ListArray.from_arrays(pa.array(ends), pairs))
        return pa.RecordBatch.from_arrays(cols, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Summary] = {}
        for batch in batches:
            types = batch.schema.types[: len(keys)]
            lists = batch.column(len(keys))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
            length = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(length)])
            dim = np.arange(len(flat)) - np.repeat(ends[:-1], length)
            row = np.repeat(np.arange(len(lists)), length)
            names = _key_values(batch, keys) if keys else None
            groups, of = ([()], np.zeros(len(lists), np.int64)) if names is None else _numbered(names)
            slot = of[row] * (int(dim.max(initial=0)) + 1) + dim
            order = np.argsort(slot, kind="stable")
            cuts = np.flatnonzero(np.diff(slot[order], prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                one = order[a]
                key = (*groups[of[row[one]]], int(dim[one]))
                held.setdefault(key, Summary(bins)).update(flat[order[a:b]])
            if len(held) > HELD:
                yield told(held, types)
                held = {}
        if held:
            yield told(held, types)

    return kept(rows.mapInArrow(run, schema), "summaries")


def _numbered(names: list[tuple]) -> tuple[list[tuple], np.ndarray]:
    seen: dict[tuple, int] = {}
    of = np.array([seen.setdefault(n, len(seen)) for n in names], np.int64)
    return list(seen), of


def merged(parts: DataFrame, keys: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """One summary for each group and element from any number of them; the order plays no part."""
    by = [*keys, "dim"]
    tops = parts.groupBy(*by).agg(F.sum("n").alias("all"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"), F.min("min").alias("low"), F.max("max").alias("high"), F.max("scale").alias("least"))
    tops = tops.withColumn("to", F.greatest("least", _scale("low", "high", bins))).drop("least")
    met = parts.join(tops, by)
    m2 = met.groupBy(*by).agg(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("m2"))
    each = met.select(*by, F.explode("bins").alias("b"), (F.col("to") - F.col("scale")).alias("by"))
    each = each.select(*by, F.expr("shiftright(b.bin, least(by, 63))").alias("bin"), F.col("b.n").alias("n")).groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    lists = each.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    out = tops.join(m2, by).join(lists, by)
    return out.select(*by, F.col("all").alias("n"), F.col("centre").alias("mean"), "m2", F.col("low").alias("min"), F.col("high").alias("max"), F.col("to").alias("scale"), "bins")


def quantiles(summary: DataFrame, wanted: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """keys, dim and the wanted quantiles of merged summaries.

    The first bin that reaches a share q of the count is cut in proportion; one
    that is the least bin of all gives its edge, the least value.
    """
    by = [*keys, "dim"]
    rows = summary.select(*by, "min", "max", "scale", F.col("n").alias("all"), F.inline("bins")).withColumn("first", F.min("bin").over(Window.partitionBy(*by)))
    upto = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    width = F.expr("pow(2D, scale)")
    rows = rows.withColumn("c", F.sum("n").over(upto)).withColumn("lower", F.greatest(F.col("bin") * width, "min")).withColumn("upper", F.least((F.col("bin") + 1) * width, "max"))

    def value(q: float) -> Column:
        inner = F.col("lower") + (q * F.col("all") - (F.col("c") - F.col("n"))) / F.col("n") * (F.col("upper") - F.col("lower"))
        return F.min(F.when(F.col("c") >= q * F.col("all"), F.struct("bin", F.when(F.col("bin") == F.col("first"), F.col("min")).otherwise(inner).alias("x"))))["x"]

    return rows.groupBy(*by).agg(*(value(q).alias(name) for name, q in wanted.items()))


def statistics(summary: DataFrame, wanted: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """min, max, mean, std, count and quantiles of merged summaries."""
    by = [*keys, "dim"]
    few = F.col("n") < 2
    std = F.when(few, F.lit(0.0)).otherwise(F.sqrt(F.col("m2") / F.col("n")))
    base = summary.select(*by, "min", "max", "mean", std.alias("std"), F.col("n").alias("count"))
    if not wanted:
        return base
    met = base.join(quantiles(summary, wanted, keys), by)
    return met.select(*base.columns, *(F.when(F.col("count") < 2, F.col("mean")).otherwise(F.col(q)).alias(q) for q in wanted))
