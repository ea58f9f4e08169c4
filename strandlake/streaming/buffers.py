"""Buffers with expiry: bounded state whose old rows go by timers, with or without new rows of their key.

Time is event time: "now" is the stream's watermark, the latest time seen in any
key less the delay allowed.  A buffer holds the newest rows of its key; when it
is full the oldest goes, and a row goes once it is older than the timeout.  A key
whose rows are all gone leaves no state behind.

Each call of a worker and each state costs some milliseconds, so keys are dealt
to buckets by their hash: a call takes a batch's rows of a bucket, and its state
holds the buffers of the bucket's keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: State is kept on disk by this provider.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEEDS = {"spark.sql.streaming.stateStore.providerClass": PROVIDER}
#: Of keys; one holds a thousandth of them, so a million keys with eight rows each make states of some 200 KB.
BUCKETS = 1024


class _Buffers:
    """Buffers of a bucket's keys. Its state has lists of keys, their rows seen and held, and of all rows' times, orders and values."""

    STATE = "key array<string>, seen array<long>, n array<int>, us array<long>, at array<long>, value array<double>"

    def __init__(self, key: str, size: int, timeout_ms: int) -> None:
        self.key, self.size, self.timeout = key, size, timeout_ms

    def _fresh(self, rows: list[tuple], now: int) -> list[tuple]:
        return sorted(r for r in rows if r[0] // 1000 + self.timeout >= now)

    def _held(self, state: GroupState) -> dict[str | None, tuple[int, list[tuple]]]:
        if not state.exists:
            return {}
        keys, seen, n, *columns = state.get
        rows = zip(*columns)
        return {k: (s, list(islice(rows, m))) for k, s, m in zip(keys, seen, n)}

    def __call__(self, _, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Keep what is left of each key with rows or with one whose time is over, tell of it, and set the timer of the oldest row of all."""
        now, held, came = state.getCurrentWatermarkMs(), self._held(state), set()
        for pdf in batches if not state.hasTimedOut else ():
            new: dict[str | None, list[tuple]] = {}
            keys = pdf["_key"].astype(object).where(pdf["_key"].notna(), None).tolist()
            for k, *row in zip(keys, *(pdf[c].tolist() for c in ("_us", "_at", "_value"))):
                new.setdefault(k, []).append(tuple(row))
            for k, rows in new.items():
                seen, old = held.get(k, (0, []))
                held[k] = seen + len(rows), self._fresh(old + rows, now)[-self.size :]
            came |= set(new)
        told = []
        for k, (seen, rows) in list(held.items()):
            over = k not in came and rows[0][0] // 1000 + self.timeout < now
            if over or k in came:
                rows = self._fresh(rows, now)
                told.append((k, now, seen, over, [r[0] for r in rows], [r[2] for r in rows]))
                held[k] = seen, rows
                if not rows:
                    del held[k]
        if held:
            us, at, value = (list(c) for c in zip(*(r for _, rows in held.values() for r in rows)))
            state.update((list(held), [s for s, _ in held.values()], [len(rows) for _, rows in held.values()], us, at, value))
            state.setTimeoutTimestamp(max(1, min(us) // 1000 + self.timeout))  # it is over once the watermark is past it
        elif state.exists:
            state.remove()
        yield pd.DataFrame(told, columns=[self.key, "now_ms", "seen", "expired", "times", "buffer"])


def expiring(stream: DataFrame, key: str, time: str, value: str, size: int, timeout_ms: int, late: str = "0 seconds", order: str | None = None, mode: str = "update", buckets: int = BUCKETS) -> DataFrame:
    """What each key's buffer holds after every change: key, now_ms, seen, expired, times (us), buffer (values, oldest first).

    ``time`` is a timestamp column; rows of one time go by ``order``.  A change is
    a batch with rows of the key, or (``expired``) the end of its oldest row's
    time.  ``seen`` counts the key's rows since its buffer was last empty.  Rows
    later than the watermark allows are dropped by Spark.  ``mode`` is the stream's,
    ``update`` or ``append``, with the same rows in both; in a session with the
    settings ``NEEDS``.  ``key`` is of a type that a string tells in full.
    """
    if size < 1 or timeout_ms < 0:
        raise ValueError("a buffer holds a row, for some time")
    kind = stream.schema[key].dataType.simpleString()
    at = F.col(order).cast("long") if order else F.lit(0).cast("long")
    bucket, of = F.pmod(F.xxhash64(key), F.lit(buckets)), F.col(key).cast("string")
    rows = stream.withWatermark(time, late).select(bucket.alias("_bucket"), F.col(time), of.alias("_key"), F.unix_micros(time).alias("_us"), at.alias("_at"), F.col(value).cast("double").alias("_value"))
    schema = f"{key} string, now_ms long, seen long, expired boolean, times array<long>, buffer array<double>"
    out = rows.groupBy("_bucket").applyInPandasWithState(_Buffers(key, size, timeout_ms), schema, _Buffers.STATE, mode, GroupStateTimeout.EventTimeTimeout)
    return out.withColumn(key, F.col(key).cast(kind))


def last_of(changes: DataFrame, key: str) -> DataFrame:
    """The last change of each key."""
    return changes.groupBy(key).agg(F.max_by(F.struct("times", "buffer"), F.struct("now_ms", "expired", "seen")).alias("last")).select(key, "last.times", "last.buffer")
