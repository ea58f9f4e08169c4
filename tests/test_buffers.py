"""Buffers with expiry: rows go by time without a new row of their key, the newest stay, state ends."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandlake.streaming import buffers, live, local

SECOND = 1_000_000


def changes(spark, tmp_path, batches, **kw):
    """Changes that a stream of batches of (key, microseconds, order, value) makes."""
    path, schema = str(tmp_path / "in"), "k string, us long, i long, v double"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).withColumn("ts", F.timestamp_micros("us"))
    out = buffers.expiring(stream, "k", "ts", "v", order="i", **({"size": 3, "timeout_ms": 10_000} | kw))
    return live.run_once(out, local.name("buffers"), "update", str(tmp_path / "check"), buffers.NEEDS)


def test_rows_go_without_a_new_row_of_their_key(spark, tmp_path):
    batches = [[("a", 1 * SECOND, 0, 1.0), ("b", 2 * SECOND, 0, 5.0)], [("b", 20 * SECOND, 0, 6.0)], [("b", 21 * SECOND, 0, 7.0)]]
    found = changes(spark, tmp_path, batches)
    rows = {(r.k, r.expired, tuple(r.buffer)) for r in found.collect()}
    assert ("a", False, (1.0,)) in rows and ("a", True, ()) in rows
    last = {r.k: r.buffer for r in buffers.last_of(found, "k").collect()}
    assert last == {"a": [], "b": [6.0, 7.0]}


def test_state_ends_and_begins_again(spark, tmp_path):
    """A key whose rows are all gone is forgotten: its count starts anew."""
    batches = [[("a", SECOND, 0, 1.0)], [("b", 30 * SECOND, 0, 2.0)], [("b", 31 * SECOND, 0, 2.5)], [("a", 40 * SECOND, 0, 3.0), ("a", 41 * SECOND, 0, 4.0)]]
    found = changes(spark, tmp_path, batches).filter("k = 'a'").collect()
    assert [(r.seen, r.buffer) for r in found if not r.expired] == [(1, [1.0]), (2, [3.0, 4.0])]
    assert [r.buffer for r in found if r.expired] == [[]]


def test_the_newest_stay(spark, tmp_path):
    """Rows in any order in a batch; ties of time by their order; an old row that comes late doesn't push out a newer one."""
    batches = [[("a", t * SECOND, i, float(10 * t + i)) for t, i in [(5, 0), (3, 0), (5, 1), (4, 0)]], [("a", 4 * SECOND, 9, 49.0), ("a", 6 * SECOND, 0, 60.0)]]
    found = changes(spark, tmp_path, batches, late="1 minute").collect()
    assert [r.buffer for r in found] == [[40.0, 50.0, 51.0], [50.0, 51.0, 60.0]]


def test_one_place_is_overwritten(spark, tmp_path):
    batches = [[("a", t * SECOND, 0, float(t))] for t in (1, 2, 4)]
    assert [r.buffer for r in changes(spark, tmp_path, batches, size=1).collect()] == [[1.0], [2.0], [4.0]]


def test_random_streams_end_as_the_rule_says(spark, tmp_path):
    rnd, t, batches, rows = random.Random(1), 0, [], []
    for _ in range(6):
        batch = []
        for _ in range(30):
            t += rnd.randint(1, 800_000)
            batch.append((rnd.choice("abcdef"), t, 0, float(len(rows) + len(batch))))
        rows += batch
        batches.append(batch)
    last = {r.k: r.buffer for r in buffers.last_of(changes(spark, tmp_path, batches, timeout_ms=6000), "k").collect()}
    want = {}
    for k, at, _, v in rows:
        want.setdefault(k, []).append((at, v))
    assert last == {k: [v for at, v in own[-3:] if at // 1000 + 6000 >= t // 1000] for k, own in want.items()}
    assert any(len(v) < 3 for v in last.values())


def test_changes_go_to_files(spark, sf_dir):
    """No change passes through the driver: the query leaves no memory table, and what it returns is read from files."""
    from strandlake.plans import queries

    out = queries.QUERIES["expiring_buffers"](spark, sf_dir)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("expiring_")]
    assert out.inputFiles()


def test_keys_of_a_bucket_are_apart(spark, tmp_path):
    """Whether keys share a bucket or not, and in both modes, each is told of as if it were alone; null is a key too."""
    rnd, t, batches = random.Random(2), 0, []
    for _ in range(4):
        batch = []
        for i in range(20):
            t += rnd.randint(1, 900_000)
            batch.append((rnd.choice(["a", "b", None]), t, i, float(rnd.randint(0, 9))))
        batches.append(batch)
    told = []
    for n, (keys, kw) in enumerate([("all", {}), ("all", {"buckets": 1}), ("a", {}), ("b", {}), (None, {})]):
        clock = [[("clock", max(r[1] for r in b), 0, 0.0)] for b in batches]  # the same watermark for each key alone
        own = [c + [r for r in b if keys == "all" or r[0] == keys] for b, c in zip(batches, clock)]
        found = changes(spark, tmp_path / str(n), own, timeout_ms=4000, **kw).collect()
        told.append(sorted((str(r.k), r.now_ms, r.seen, r.expired, r.times, r.buffer) for r in found if r.k != "clock"))
    assert told[0] == told[1] == sorted(r for own in told[2:] for r in own)
    assert any(r[3] for r in told[0]) and any(r[0] == "None" for r in told[0])


def test_appended_are_the_same_changes(spark, tmp_path):
    batches = [[("a", SECOND, 0, 1.0), ("b", 2 * SECOND, 0, 5.0)], [("b", 20 * SECOND, 0, 6.0)], [("b", 21 * SECOND, 0, 7.0)]]
    want = sorted(map(tuple, changes(spark, tmp_path / "update", batches).collect()))
    stream = spark.readStream.schema("k string, us long, i long, v double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "update" / "in")).withColumn("ts", F.timestamp_micros("us"))
    out = buffers.expiring(stream, "k", "ts", "v", order="i", size=3, timeout_ms=10_000, mode="append")
    found = live.run_once(out, local.name("appended"), "append", str(tmp_path / "check"), buffers.NEEDS)
    assert sorted(map(tuple, found.collect())) == want and found.inputFiles()


def test_settings_are_put_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    changes(spark, tmp_path, [[("a", SECOND, 0, 1.0)]])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    with pytest.raises(ValueError):
        changes(spark, tmp_path, [[("a", SECOND, 0, 1.0)]], size=0)


def test_idle_keys_are_forgotten(spark, tmp_path):
    """Of the operators by the clock: after the idle time a key's first row is kept though it is like the last one."""
    import time

    path, schema = str(tmp_path / "in"), "k long, t long, v double"
    put = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    put((1, 1, 5.0), (1, 2, 5.1))
    stream = spark.readStream.schema(schema).parquet(path)
    q = live.skip_similar(stream, "k", ["t"], ["v"], 1.0, idle_ms=500).writeStream.format("memory").queryName("idle").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start()

    def wait(n):
        until = time.time() + 40  # the stream runs on, so there is no end to wait for
        while spark.table("idle").count() < n and time.time() < until:
            time.sleep(0.2)

    try:
        wait(1)
        time.sleep(3)  # batches without rows, in one of which the first key's time is up
        put((1, 3, 5.2))
        wait(2)
    finally:
        q.stop()
    assert sorted((r.k, r.t) for r in spark.table("idle").collect()) == [(1, 1), (1, 3)]
