"""Shuffled and mixed reading: the same order for the same seed, memory of the buffer, quotas."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.operators import shuffling


def table(spark, shards=5, n=40):
    return spark.createDataFrame([(s, i, f"{s}-{i}") for s in range(shards) for i in range(n + s)], "shard int, i int, name string")


def order(df, **kw):
    """Names of each stream in the order of reading."""
    out = shuffling.buffer_shuffled(df, "shard", ["i"], **({"size": 30, "seed": 3} | kw)).collect()
    streams = {}
    for r in sorted(out, key=lambda r: (r.stream, r.position)):
        streams.setdefault(r.stream, []).append(r)
    assert all([r.position for r in rows] == list(range(len(rows))) for rows in streams.values())
    return {k: [r.name for r in rows] for k, rows in streams.items()}


def plain(df, size, seed, streams=1, epoch=0):
    """The buffer by its rules, on the interleaved rows."""
    out = {}
    rows = shuffling.interleaved(df, "shard", ["i"], seed, streams, epoch).collect()
    for stream in {r.stream for r in rows}:
        buffer, read, own = [], [], sorted((r for r in rows if r.stream == stream), key=lambda r: (r.arrival, r.shard, r.i))
        for t, r in enumerate(own):
            if len(buffer) < size:
                buffer.append((t, r.name))
            else:
                k = shuffling.drawn(seed, epoch, "slot", stream, t) % size
                read.append(buffer[k][1])
                buffer[k] = (t, r.name)
        out[stream] = read + [n for _, n in sorted(buffer, key=lambda b: (shuffling.drawn(seed, epoch, "end", stream, b[0]), b[0]))]
    return out


@pytest.mark.parametrize("size, streams", [(30, 1), (1, 2), (1000, 2), (7, 3)])
def test_order_follows_the_rules(spark, size, streams):
    df = table(spark)
    want = plain(df, size, 3, streams)
    for parts, batch in ((1, 10_000), (6, 7)):  # however rows come, and in whatever batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            assert order(df.repartition(parts), size=size, streams=streams) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter(n for rows in want.values() for n in rows) == Counter(r.name for r in df.collect())


def test_epochs_and_seeds_differ(spark):
    df = table(spark)
    first = order(df)
    assert order(df) == first and order(df, epoch=1) != first and order(df, seed=4) != first
    with pytest.raises(ValueError):
        shuffling.buffer_shuffled(df, "shard", ["i"], 0, 1)
    assert shuffling.buffer_shuffled(df.limit(0), "shard", ["i"], 5, 1).count() == 0


def test_a_row_is_read_after_its_entry_and_shards_mix(spark):
    """No row is read before as many rows as the buffer holds have been seen; of a shard's rows none overtakes by more than chance."""
    df = table(spark, shards=4, n=500)
    rows = shuffling.interleaved(df, "shard", ["i"], 1)
    entered = {r.name: t for t, r in enumerate(rows.orderBy("arrival", "shard", "i").collect())}
    read = order(df, size=50, seed=1)[0]
    assert all(entered[n] <= p + 50 for p, n in enumerate(read))
    first = Counter(r.shard for r in rows.orderBy("arrival").limit(400).collect())
    assert all(60 < first[s] < 140 for s in range(4))  # a hundred each, at random
    delays = [p + 50 - entered[n] for p, n in enumerate(read[:1500])]
    assert 35 < sum(delays) / len(delays) < 65  # a row stays for about as long as the buffer is


def test_draws_are_alike(spark):
    r = spark.range(1).select(shuffling.draw(F.lit(7), F.lit("slot"), F.lit(-3)), shuffling.draw(F.lit("é"))).first()
    assert tuple(r) == (shuffling.drawn(7, "slot", -3), shuffling.drawn("é"))


def test_mixed_batches(spark):
    large = spark.range(103).select(F.col("id").alias("k"), F.lit("large").alias("of"), F.lit(1).alias("more"))
    small = spark.range(5).select(F.col("id").alias("i"), (F.col("id") + 1000).alias("k"), F.lit("small").alias("of"))
    found = shuffling.mixed_batches(large, small, ["k"], "i", 5, batch=8, quota=3, seed=2)
    rows = found.collect()
    assert found.columns == ["batch", "slot", "source", "k", "of"]
    by = {}
    for r in rows:
        by.setdefault(r.batch, []).append(r)
    assert sorted(by) == list(range(20))
    for b in by.values():
        assert sorted(r.slot for r in b) == list(range(8)) and Counter(r.of for r in b) == {"large": 5, "small": 3}
    used = [r.k for r in rows if r.of == "large"]
    assert len(set(used)) == len(used) == 100 and used != sorted(used)
    assert {r.k for r in rows if r.of == "small"} == {1000, 1001, 1002, 1003, 1004}
    again = shuffling.mixed_batches(large.repartition(7), small.repartition(3), ["k"], "i", 5, batch=8, quota=3, seed=2).collect()
    assert sorted(again) == sorted(rows)
    assert sorted(shuffling.mixed_batches(large, small, ["k"], "i", 5, 8, 3, seed=3).collect()) != sorted(rows)
    assert shuffling.mixed_batches(large.limit(4), small, ["k"], "i", 5, 8, 3, seed=2).count() == 0
    with pytest.raises(ValueError):
        shuffling.mixed_batches(large, small, ["k"], "i", 5, 8, 8, seed=2)
