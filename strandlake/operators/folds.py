"""Folds whose step needs what the step before decided.

There is no closed form for them, so the rows of a partition, sorted by episode
and time, go by in Arrow batches and a step takes its state from batch to batch:
a worker holds two batches, however long an episode is.  Columns that a step
doesn't read pass through as they are.  Nulls come last in an episode's order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (columns read, state: None at an episode's start, whether the episode ends here) -> (kept rows or None, new columns, state)
Step = Callable[[list[pa.Array], Any, bool], tuple[list[bool] | None, dict[str, np.ndarray], Any]]


def _starts(batch: pa.RecordBatch, by: Sequence[str]) -> list[int]:
    """Rows of a batch at which another episode starts, the first one included, and the batch's end."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in by:
        codes = batch.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return [*np.flatnonzero(new).tolist(), batch.num_rows]


def _episode(batch: pa.RecordBatch, row: int, by: Sequence[str]) -> str:
    return repr([batch.column(c)[row].as_py() for c in by])


def _fold(df: DataFrame, by: Sequence[str], on: str, order: Sequence[str], reads: Sequence[str], step: Step, new: dict[str, T.DataType] | None = None) -> DataFrame:
    """``step`` over the stretches of each episode, one shuffle and one sort; rows it doesn't keep go, its new columns come last."""
    by, new = list(by), new or {}
    kinds = {T.DoubleType(): pa.float64(), T.LongType(): pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = (b for b in batches if b.num_rows)
        batch, episode, state = next(full, None), None, None
        while batch is not None:
            follows, at = next(full, None), _starts(batch, by)
            mask, made = [], {c: [] for c in new}
            for a, b in zip(at, at[1:]):
                if a or _episode(batch, 0, by) != episode:
                    state = None
                ends = b < batch.num_rows or follows is None or _episode(follows, 0, by) != _episode(batch, a, by)
                keep, columns, state = step([batch.column(c).slice(a, b - a) for c in reads], state, ends)
                mask += keep or [True] * (b - a)
                for c in new:
                    made[c].append(columns[c])
            episode = _episode(batch, batch.num_rows - 1, by)
            out = pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.concatenate(made[c]), kinds[t]) for c, t in new.items())], names=[*batch.schema.names, *new])
            yield out if all(mask) else out.filter(pa.array(mask, pa.bool_()))
            batch = follows

    rows = df.repartition(*by) if by else df.coalesce(1)
    rows = rows.sortWithinPartitions(*by, *(F.col(c).asc_nulls_last() for c in (on, *order)))
    return rows.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(c, t) for c, t in new.items())]))


def _values(column: pa.Array) -> list:
    """Numbers of a column; a null is not a number."""
    return column.to_numpy(zero_copy_only=False).tolist()


def debounce(df: DataFrame, by, on, gap: float, order=()) -> DataFrame:
    """Drop frames closer than ``gap`` to the last kept one."""

    def step(columns, last, ends):
        keep = []
        for t in _values(columns[0]):
            k = last is None or t - last >= gap
            keep.append(k)
            last = t if k else last
        return keep, {}, last

    return _fold(df, by, on, order, [on], step)


def downsample_adaptive(df: DataFrame, by, on, rate: Column, unit: float, order=()) -> DataFrame:
    """Each frame has a rate: kept at a change of rate, else when 1 / rate has passed since the last kept; the last stays.

    Where time is a whole number so is the interval, rounded half to even; at a
    rate of 0 no interval ends.
    """
    whole = isinstance(df.schema[on].dataType, T.IntegralType)

    def interval(r: float) -> float:
        return math.inf if not r else round(unit / r) if whole else unit / r

    def step(columns, state, ends):
        last, before = state or (None, None)
        keep = []
        for t, r in zip(_values(columns[0]), _values(columns[1])):
            k = last is None or r != before or t - last >= interval(r)
            keep.append(k)
            last, before = t if k else last, r
        keep[-1] |= ends
        return keep, {}, (last, before)

    return _fold(df.withColumn("_rate", rate.cast("double")), by, on, order, [on, "_rate"], step).drop("_rate")


def ema(df: DataFrame, by, on, value: str, alpha: float, order=(), name: str = "ema") -> DataFrame:
    """alpha x + (1 - alpha) previous, from the first value on."""

    def step(columns, last, ends):
        out = []
        for x in _values(columns[0]):
            last = x if last is None else alpha * x + (1 - alpha) * last
            out.append(last)
        return None, {name: np.array(out, float)}, last

    return _fold(df, by, on, order, [value], step, {name: T.DoubleType()})


def rate_limit(df: DataFrame, by, on, value: str, limit: float, start: float | None = None, order=(), name: str = "limited") -> DataFrame:
    """Clamp to the value before +- limit.  Each row starts from the processed row before it, so behind the first all repeat it."""

    w = Window.partitionBy(*by).orderBy(on, *order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.first(F.col(value).cast("double")).over(w)
    return df.withColumn(name, first if start is None else F.greatest(F.lit(float(start - limit)), F.least(F.lit(float(start + limit)), first)))


def drop_small_changes(df: DataFrame, by, on, values: dict[str, float], order=()) -> DataFrame:
    """Drop frames nearer than every threshold to the last kept one."""
    limits = np.array(list(values.values()))

    def step(columns, last, ends):
        keep = []
        for row in np.column_stack([np.array(_values(c), float) for c in columns]):
            k = last is None or not bool((np.abs(row - last) < limits).all())
            keep.append(k)
            last = row if k else last
        return keep, {}, last

    return _fold(df, by, on, order, list(values), step)


def rotate_files(df: DataFrame, by, on, size: str, limit: float, files_per_chunk: int = 1000, order=()) -> DataFrame:
    """(chunk, file) by greedy filling: a row that would overfill its file opens the next, also where the file's rows have size 0.

    NaN is beyond any limit; a file with a null size is never known to be full.
    """

    def step(columns, state, ends):
        file, used, empty = state or (0, 0.0, True)
        out = []
        for x in columns[0].to_pylist():
            total = None if used is None or x is None else used + x
            if not empty and total is not None and not total < limit:
                file, total = file + 1, x
            used, empty = total, False
            out.append(file)
        n = np.array(out, np.int64)
        return None, {"chunk_index": n // files_per_chunk, "file_index": n % files_per_chunk}, (file, used, empty)

    return _fold(df, by, on, order, [size], step, {"chunk_index": T.LongType(), "file_index": T.LongType()})


def pack_batches(df: DataFrame, by, on, frames: str, mb_per_frame: float, limit_mb: float, max_episodes: int | None, max_frames: int | None, order=()) -> DataFrame:
    """Batch number of each episode: a new one when the size would reach its limit, or episodes or frames would pass theirs (None: no limit)."""

    def step(columns, state, ends):
        batch, mb, count, total = state or (0, 0.0, 0, 0)
        out = []
        for n in _values(columns[0]):
            full = mb > 0 and mb + n * mb_per_frame >= limit_mb or max_episodes is not None and count >= max_episodes or max_frames is not None and total + n > max_frames
            if count and full:
                batch, mb, count, total = batch + 1, 0.0, 0, 0
            mb, count, total = mb + n * mb_per_frame, count + 1, total + n
            out.append(batch)
        return None, {"batch": np.array(out, np.int64)}, (batch, mb, count, total)

    return _fold(df, by, on, order, [frames], step, {"batch": T.LongType()})


def skip_similar(df: DataFrame, by, on, vector: str, atol: float = 1.0, must: str | None = None, order=()) -> DataFrame:
    """Drop a row whose vector is within ``atol`` (L2) of the last kept one, unless it is marked."""

    def step(columns, last, ends):
        keep = []
        forced = columns[1].to_pylist() if must else [False] * len(columns[0])
        for x, f in zip(columns[0].to_pylist(), forced):
            v = np.asarray(x, float)
            k = last is None or bool(f) or float(np.linalg.norm(v - last)) >= atol
            keep.append(k)
            last = v if k else last
        return keep, {}, last

    return _fold(df, by, on, order, [vector, *([must] if must else [])], step)
