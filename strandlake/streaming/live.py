"""Structured Streaming forms: aggregates, stateful buffers and folds.

State is kept by episode key.  A stateful operator gets the rows of a key in
whatever batches they come and orders them by time itself.  With ``idle_ms`` the
state of a key that has had no row for so long (by the clock) is dropped; such a
stream goes on running batches without rows, so it never ends by itself.
Buffers whose rows expire by event time are in ``buffers``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.shared import folder


def stats(stream: DataFrame, vector: str, keys: Sequence[str] = ()) -> DataFrame:
    """Incremental min, max, mean, std and count of every element; for complete or update mode."""
    x = stream.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "x"))
    return x.groupBy(*keys, "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("x").alias("count"))


def windows(stream: DataFrame, ts: str, keys: Sequence[str], width: str, late: str, slide: str | None = None) -> DataFrame:
    """Event-time windows with a watermark."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(w, *keys)


def sessions(stream: DataFrame, ts: str, keys: Sequence[str], gap: str, late: str) -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys)


def deduplicated(stream: DataFrame, ts: str, keys: Sequence[str], late: str) -> DataFrame:
    """First row of each key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def aligned(left: DataFrame, right: DataFrame, key: str, tolerance: str, late: str) -> DataFrame:
    """Pairs of rows of two streams at most ``tolerance`` apart; both sides' state is bounded by watermark and interval.

    Columns: key, l_ts, r_ts and the other columns with their prefixes.
    """
    a = left.select(F.col(key), *(F.col(c).alias(f"l_{c}") for c in left.columns if c != key)).withWatermark("l_ts", late)
    b = right.select(F.col(key).alias("_k"), *(F.col(c).alias(f"r_{c}") for c in right.columns if c != key)).withWatermark("r_ts", late)
    on = (F.col(key) == F.col("_k")) & (F.col("r_ts") >= F.col("l_ts") - F.expr(f"INTERVAL {tolerance}")) & (F.col("r_ts") <= F.col("l_ts") + F.expr(f"INTERVAL {tolerance}"))
    return a.join(b, on).drop("_k")


def _timeout(idle_ms: int | None) -> str:
    return GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout


def _by_time(batches: Iterator[pd.DataFrame], on: Sequence[str]) -> pd.DataFrame:
    rows = pd.concat(list(batches), ignore_index=True)
    return rows.sort_values(list(on), kind="stable").reset_index(drop=True)


def skip_similar(stream: DataFrame, key: str, on: Sequence[str], values: Sequence[str], atol: float = 1.0, stale: bool = True, idle_ms: int | None = None) -> DataFrame:
    """Drop rows within ``atol`` (L2) of the last kept row of their key, and rows older than it."""
    names, first = list(values), on[0]

    def run(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            return state.remove()
        rows = _by_time(batches, on)
        last, at = (np.array(state.get[0]), state.get[1]) if state.exists else (None, None)
        keep = []
        for v, t in zip(rows[names].to_numpy(float), rows[first].tolist()):
            old = stale and at is not None and t < at
            k = not old and (last is None or float(np.linalg.norm(v - last)) >= atol)
            keep.append(k)
            if k:
                last, at = v, t
        if last is not None:
            state.update((last.tolist(), at))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
        yield rows[np.array(keep, bool)]

    return stream.groupBy(key).applyInPandasWithState(run, stream.schema, "last array<double>, at long", "append", _timeout(idle_ms))


def newest(stream: DataFrame, key: str, on: str, value: str, size: int, idle_ms: int | None = None) -> DataFrame:
    """Bounded buffer: after each batch the newest ``size`` values of a key, oldest first."""

    def run(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            return state.remove()
        ts, vs = (list(state.get[0]), list(state.get[1])) if state.exists else ([], [])
        rows = _by_time(batches, [on])
        pairs = sorted([*zip(ts, vs), *zip(rows[on].tolist(), rows[value].tolist())])[-size:]
        state.update(([p[0] for p in pairs], [p[1] for p in pairs]))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({key: [k[0]], "buffer": [[p[1] for p in pairs]]})

    return stream.groupBy(key).applyInPandasWithState(run, f"{key} long, buffer array<double>", "ts array<long>, vs array<double>", "update", _timeout(idle_ms))


def hold_last(stream: DataFrame, key: str, on: str, value: str, idle_ms: int | None = None) -> DataFrame:
    """Each row with the last value that was there, carried over batches."""
    from pyspark.sql import types as T

    def run(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            return state.remove()
        rows = _by_time(batches, [on])
        last, held = state.get[0] if state.exists else None, []
        for v in rows[value].tolist():
            last = last if v is None or v != v else v
            held.append(last)
        state.update((last,))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield rows.assign(held=pd.array(held, "Float64"))

    schema = T.StructType([*stream.schema.fields, T.StructField("held", T.DoubleType())])
    return stream.groupBy(key).applyInPandasWithState(run, schema, "last double", "append", _timeout(idle_ms))


def run_once(stream: DataFrame, name: str, mode: str, checkpoint: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Process what is there, and return it; the settings hold for this stream alone.

    In append mode tasks write the rows to the folder that the cluster shares, so
    none pass through the driver.  Other modes fill a memory table, which the
    driver holds: for results of few rows.
    """
    spark = stream.sparkSession
    conf, path = spark.conf, folder(spark, name) if mode == "append" else None
    old = {k: conf.get(k, None) for k in settings or {}}
    try:
        for k, v in (settings or {}).items():
            conf.set(k, v)
        to = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        q = to.format("parquet").start(path) if path else to.format("memory").start()
        q.awaitTermination()
    finally:
        for k, v in old.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return spark.read.schema(stream.schema).parquet(path) if path else spark.table(name)
