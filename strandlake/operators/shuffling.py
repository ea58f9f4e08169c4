"""Shuffled and mixed reading, the same for the same seed wherever and however often it runs.

Every draw is a function of the seed and of what it is for (52 bits of an MD5),
not of the order in which rows or tasks happen to come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .edit import running

#: Values of a draw.
DRAWS = 1 << 52


def draw(*of: Column) -> Column:
    """A number in [0, 2^52) for the values."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(c.cast("string") for c in of)).cast("binary")), 1, 13), 16, 10).cast("long")


def drawn(*of) -> int:
    """The same in Python."""
    return int(hashlib.md5(":".join(map(str, of)).encode()).hexdigest()[:13], 16)


def interleaved(df: DataFrame, shard: str, order: Sequence[str], seed: int, streams: int = 1, epoch: int = 0) -> DataFrame:
    """``stream`` and ``arrival`` of each row: shards are dealt to streams, and a stream takes its next row from any of its shards alike.

    The times between a shard's rows are exponential, in millionths; so at any
    moment each shard that has rows left is the next one with equal chance, and
    no row needs to know of other shards.
    """
    s, e, key = F.lit(seed), F.lit(epoch), F.col(shard)
    row = F.row_number().over(Window.partitionBy(shard).orderBy(*order)) - 1
    gap = F.round(-F.log((draw(s, e, F.lit("gap"), key, row) + 1) / float(DRAWS)) * 1e6).cast("long")
    until = Window.partitionBy(shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    stream = F.pmod(draw(s, F.lit("stream"), key), F.lit(streams)).cast("int")
    return df.withColumn("stream", stream).withColumn("_gap", gap).withColumn("arrival", F.sum("_gap").over(until)).drop("_gap")


def buffer_shuffled(df: DataFrame, shard: str, order: Sequence[str], size: int, seed: int, streams: int = 1, epoch: int = 0) -> DataFrame:
    """The rows with ``stream`` and ``position``, their place in a shuffled reading of the stream.

    A stream interleaves its shards at random and goes through a buffer of
    ``size`` rows: a new row takes the place of a random one, which is read; at
    the end the rows that are left are read in a random order.  A task holds the
    buffer and one Arrow batch.  Rows of a shard are told apart by ``order``.

    Each epoch has an order of its own; a stream of fewer rows than the buffer
    holds is shuffled as a whole; an empty table has no row.
    """
    if size < 1 or streams < 1:
        raise ValueError("a buffer holds a row and a stream is there at least")
    rows = interleaved(df, shard, order, seed, streams, epoch).repartition(streams, "stream").sortWithinPartitions("stream", "arrival", shard, *order).drop("arrival")
    out_schema = T.StructType([*rows.schema.fields, T.StructField("position", T.LongType())])
    at = rows.columns.index("stream")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, seen, buffer, held = None, 0, None, []

        def told(table: pa.Table, picks: list[int], first: int) -> Iterator[pa.RecordBatch]:
            some = table.take(pa.array(picks, pa.int64())).append_column("position", pa.array(range(first, first + len(picks)), pa.int64()))
            yield from some.combine_chunks().to_batches()

        def rest() -> Iterator[pa.RecordBatch]:
            """What the buffer holds at the end; ``held`` are the numbers of its rows in the order of reading."""
            if held:
                order_ = sorted(range(len(held)), key=lambda i: (drawn(seed, epoch, "end", stream, held[i]), held[i]))
                yield from told(buffer, order_, seen - len(held))

        for batch in batches:
            ids = batch.column(at).to_pylist()
            a = 0
            while a < batch.num_rows:
                if ids[a] != stream:
                    yield from rest()
                    stream, seen, buffer, held = ids[a], 0, batch.slice(0, 0), []
                    buffer = pa.Table.from_batches([buffer])
                b = a + 1
                while b < batch.num_rows and ids[b] == stream:
                    b += 1
                table = pa.concat_tables([buffer, pa.Table.from_batches([batch.slice(a, b - a)])])
                places, picks, first = list(range(len(held))), [], max(0, seen - size)  # rows of the table that the buffer's places hold
                for j in range(b - a):
                    new = buffer.num_rows + j
                    if len(places) < size:
                        places.append(new)
                        held.append(seen)
                    else:
                        i = drawn(seed, epoch, "slot", stream, seen) % size
                        picks.append(places[i])
                        places[i], held[i] = new, seen
                    seen += 1
                if picks:
                    yield from told(table, picks, first)
                buffer = table.take(pa.array(places, pa.int64())).combine_chunks()
                a = b
        yield from rest()

    return rows.mapInArrow(run, out_schema)


def mixed_batches(large: DataFrame, small: DataFrame, key: Sequence[str], index: str, n_small: int, batch: int, quota: int, seed: int) -> DataFrame:
    """Batches with a fixed share of two sources: ``batch``, ``slot`` and ``source`` (0: large, 1: small) beside the common columns.

    The large source gives ``batch - quota`` rows to each, every row once, in a
    random order of its ``key``; the small one gives ``quota`` rows, drawn with
    replacement by its ``index`` from 0 to ``n_small - 1``.  An incomplete last
    batch is dropped.
    """
    if not 0 < quota < batch or n_small < 1:
        raise ValueError("both sources have a share, and the small one a row")
    own, common = batch - quota, [c for c in large.columns if c in small.columns]
    ranked = running(large.select(*common, *(c for c in key if c not in common)).withColumn("_one", F.lit(1)).withColumn("_draw", draw(F.lit(seed), F.lit("large"), *(F.col(c) for c in key))), {"_one": "_at"}, ["_draw", *key])
    batches = ranked.agg(F.count(F.lit(1))).first()[0] // own
    first = ranked.filter(F.col("_at") < batches * own).select(F.expr(f"_at div {own}").alias("batch"), (F.col("_at") % own).cast("int").alias("slot"), F.lit(0).alias("source"), *common)
    picks = large.sparkSession.range(batches * quota).select(F.expr(f"id div {quota}").alias("batch"), (F.col("id") % quota + own).cast("int").alias("slot"), F.lit(1).alias("source"), F.pmod(draw(F.lit(seed), F.lit("small"), F.col("id")), F.lit(n_small)).alias("_pick"))
    second = picks.join(small.select(F.col(index).alias("_pick"), *(F.col(c).alias(c) for c in common)), "_pick").drop("_pick")
    return first.unionByName(second)
