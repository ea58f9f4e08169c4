"""Bag files: round trips, pruning by the index, files of dead writers, damage, db3 pages, message forms."""

from __future__ import annotations

import io
import random
import sqlite3
import struct
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from strandlake.functions import messages
from strandlake.sources import bags, files

KIND = "sensor_msgs/msg/JointState"


def some_messages(n=500, seed=0):
    rnd = random.Random(seed)
    topics = ["/arm/left", "/arm/right", "/cam/é"]
    return [(topics[i % 3], KIND if i % 3 < 2 else "Image", 1000 * i + rnd.randint(0, 900), i, i % 7, rnd.randbytes(rnd.choice([0, 1, 50, 3000]))) for i in range(n)]


def bag_bytes(rows, chunk_bytes=4000, compression="zstd"):
    out = io.BytesIO()
    w = bags.McapWriter(out, chunk_bytes, compression)
    for m in rows:
        w.add(*m)
    w.close()
    return out.getvalue()


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return str(path.parent)


def rows_of(df):
    return sorted((r.topic, r.type, r.log_time, r.publish_time, r.sequence, bytes(r.data)) for r in df.collect())


@pytest.mark.parametrize("compression", ["zstd", ""])
def test_round_trip(spark, tmp_path, compression):
    rows = some_messages()
    df = spark.createDataFrame(rows, "topic string, type string, log_time long, publish_time long, sequence long, data binary")
    path = str(tmp_path / "bag dir")
    bags.write(df, path, chunk_bytes=2000, compression=compression)
    assert files.listed(files.qualified(spark, path), (".mcap",))[0].endswith(".mcap")
    back = bags.read(spark, path)
    assert rows_of(back) == sorted(rows) and back.columns[0] == "path"
    bags.write(df.limit(3), path)
    assert bags.read(spark, path).count() == 503
    bags.write(df.limit(4), path, mode="overwrite")
    assert bags.read(spark, path).count() == 4
    bags.write(df.limit(0), str(tmp_path / "none"))
    assert bags.read(spark, str(tmp_path / "none")).count() == 0


def test_filters_prune_chunks(spark, tmp_path):
    rows = some_messages()
    folder = put(tmp_path / "x" / "a.mcap", bag_bytes(sorted(rows, key=lambda m: m[2])))
    put(tmp_path / "x" / "left.mcap", bag_bytes([m for m in rows if m[0] == "/arm/left"]))
    uri = files.qualified(spark, folder)

    def places(*filters):
        reader = bags.BagReader({"path": uri, "part_bytes": "1"})
        left = list(reader.pushFilters(list(filters)))
        return sum(len(p.places) for p in reader.partitions()), left

    everything, _ = places()
    late = D.GreaterThan(("log_time",), 450_000)
    assert 0 < places(late)[0] < everything / 5 and places(late)[1] == []
    assert places(D.EqualTo(("topic",), "/cam/é"))[0] < everything
    assert places(D.In(("topic",), ("/none",)))[0] == 0
    other = D.EqualTo(("sequence",), 3)
    assert places(other) == (everything, [other])
    df = bags.read(spark, folder)
    want = sorted(m for m in rows + [m for m in rows if m[0] == "/arm/left"] if m[2] > 450_000 and m[0] != "/arm/right")
    assert rows_of(df.filter((F.col("log_time") > 450_000) & F.col("topic").isin("/arm/left", "/cam/é"))) == want
    assert rows_of(df.filter("log_time between 1000 and 9000 and sequence = 3")) == sorted(m for m in rows + [m for m in rows if m[0] == "/arm/left"] if 1000 <= m[2] <= 9000 and m[4] == 3)
    assert df.filter("log_time > 9 and log_time < 5").count() == 0


def test_many_files_are_planned_by_their_tasks(spark, tmp_path, monkeypatch):
    rows = some_messages(60)
    for i in range(3):
        folder = put(tmp_path / "x" / f"{i}.mcap", bag_bytes(rows[20 * i : 20 * i + 20]))
    monkeypatch.setattr(bags, "PLANNED", 2)
    reader = bags.BagReader({"path": files.qualified(spark, folder)})
    reader.pushFilters([D.LessThanOrEqual(("log_time",), rows[30][2])])
    list(reader.pushFilters([D.LessThanOrEqual(("log_time",), rows[30][2])]))
    parts = reader.partitions()
    assert [p.places for p in parts] == [None] * 3
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == sum(m[2] <= rows[30][2] for m in rows)


def test_a_file_without_its_index(spark, tmp_path):
    """A writer died: the chunks that are whole are read."""
    rows, data = some_messages(), bag_bytes(some_messages())
    put(tmp_path / "x" / "a.mcap", data[: len(data) * 6 // 10])
    some = rows_of(bags.read(spark, str(tmp_path / "x")))
    assert 200 < len(some) < 400 and set(some) <= set(rows)
    assert rows_of(bags.read(spark, str(tmp_path / "x")).filter("topic = '/cam/é'")) == [m for m in some if m[0] == "/cam/é"]


def test_damage_is_told_with_its_place(spark, tmp_path):
    data = bag_bytes(some_messages(), compression="")
    at = data.index(some_messages()[100][5] if len(some_messages()[100][5]) > 40 else next(m[5] for m in some_messages()[100:] if len(m[5]) > 40))
    put(tmp_path / "x" / "a.mcap", data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(Exception, match=r"a\.mcap: a chunk's checksum is wrong at byte \d+"):
        bags.read(spark, str(tmp_path / "x")).collect()
    put(tmp_path / "y" / "a.mcap", b"nothing of the kind")
    with pytest.raises(Exception, match="no magic bytes"):
        bags.read(spark, str(tmp_path / "y")).collect()


def test_chunks_packed_by_lz4(spark, tmp_path):
    raw = bags._record(bags.SCHEMA_RECORD, struct.pack("<H", 1) + bags._text("T") + bags._text("") + bags._text("")) + bags._record(bags.CHANNEL, struct.pack("<HH", 4, 1) + bags._text("/t") + bags._text("cdr") + bags._text(""))
    raw += b"".join(bags._record(bags.MESSAGE, struct.pack("<HIQQ", 4, i, 10 + i, 20 + i) + b"m" * i) for i in range(50))
    packed = pa.compress(raw, "lz4", asbytes=True)
    chunk = bags._record(bags.CHUNK, struct.pack("<QQQI", 10, 59, len(raw), zlib.crc32(raw)) + bags._text("lz4") + struct.pack("<Q", len(packed)) + packed)
    folder = put(tmp_path / "x" / "a.mcap", bags.MAGIC + bags._record(bags.HEADER, bags._text("") + bags._text("")) + chunk)
    assert rows_of(bags.read(spark, folder)) == [("/t", "T", 10 + i, 20 + i, i, b"m" * i) for i in range(50)]


@pytest.mark.parametrize("page, encoding", [(512, "UTF-8"), (4096, "UTF-8"), (65536, "UTF-16")])
def test_db3_pages(spark, tmp_path, page, encoding):
    """Pages of any size, inner pages, values over many pages, rows that were deleted."""
    rows, folder = some_messages(400), tmp_path / "x"
    folder.mkdir()
    con = sqlite3.connect(folder / "a.db3")
    con.execute(f"PRAGMA page_size={page}")
    con.execute(f"PRAGMA encoding='{encoding}'")
    con.execute("CREATE TABLE schema(schema_version INTEGER PRIMARY KEY, ros_distro TEXT NOT NULL)")
    con.execute("CREATE TABLE topics(id INTEGER PRIMARY KEY, name TEXT NOT NULL, type TEXT NOT NULL, serialization_format TEXT NOT NULL, offered_qos_profiles TEXT NOT NULL)")
    con.execute("CREATE TABLE messages(id INTEGER PRIMARY KEY, topic_id INTEGER NOT NULL, timestamp INTEGER NOT NULL, data BLOB NOT NULL)")
    con.execute("CREATE INDEX timestamp_idx ON messages (timestamp ASC)")
    topics = sorted({(m[0], m[1]) for m in rows})
    con.executemany("INSERT INTO topics VALUES (?, ?, ?, 'cdr', '')", [(i + 1, *t) for i, t in enumerate(topics)])
    big = [(m[0], m[1], m[2], m[2], i + 1, m[5] * (40 if i % 50 == 0 else 1)) for i, m in enumerate(rows)]
    con.executemany("INSERT INTO messages VALUES (?, ?, ?, ?)", [(m[4], topics.index(m[:2]) + 1, m[2], m[5]) for m in big])
    con.execute("DELETE FROM messages WHERE id % 10 = 3")
    con.commit()
    con.close()
    want = sorted(m for m in big if m[4] % 10 != 3)
    df = bags.read(spark, str(folder), part_bytes=3 * page)
    assert rows_of(df) == want
    assert df.rdd.getNumPartitions() > 1 or page == 65536
    assert rows_of(df.filter("topic = '/arm/left' and log_time < 100000")) == [m for m in want if m[0] == "/arm/left" and m[2] < 100000]


def test_a_task_that_fails_leaves_no_file(spark, tmp_path):
    bad = F.udf(lambda i: 1 // (i - 90), "long")
    df = spark.range(100).repartition(4).select(F.lit("/t").alias("topic"), F.lit("T").alias("type"), F.col("id").alias("log_time"), bad("id").alias("sequence"), F.lit(b"x").alias("data"))
    with pytest.raises(Exception):
        bags.write(df, str(tmp_path / "x"))
    assert not list((tmp_path / "x").glob("*.mcap")) if (tmp_path / "x").exists() else True


def test_message_forms(spark):
    rows = [(1, 5, "base", ["a", "bb", ""], [1.5, -2.0], [], [0.25]), (-1, 999_999_999, "", [], [], [], []), (2**31 - 1, 0, "é" * 5, ["x"] * 7, [float(i) for i in range(7)], [1.0], [])]
    for r in rows:
        assert tuple(messages.joints_of(messages.joints_message(*r)).values()) == r
    im = (3, 4, "cam", "jpeg", b"\xff\xd8x")
    assert tuple(messages.image_of(messages.image_message(*im)).values()) == im
    # laid out by hand: numbers stand at multiples of their size
    wire = bytes.fromhex("00010000" "01000000" "02000000" "03000000" "616200" "00" "01000000" "02000000" "7800" "0000" "01000000" "000000000000f03f" "00000000" "00000000")
    assert messages.joints_message(1, 2, "ab", ["x"], [1.0]) == wire
    big = b"\x00\x00\x00\x00" + struct.pack(">iI", 7, 8) + struct.pack(">I", 1) + b"\0" + b"\0" * 3 + struct.pack(">I", 0) * 4
    assert messages.joints_of(big)["sec"] == 7
    with pytest.raises(ValueError):
        messages.joints_of(b"\x00\x09\x00\x00")
    df = spark.createDataFrame([(bytearray(messages.joints_message(*rows[0])), 77), (bytearray(messages.joints_message(100, 1, "", [], [])), 77)], "data binary, got long")
    m = df.withColumn("m", messages.joint_state("data"))
    assert [r[0] for r in m.select(messages.stamp_ns(F.col("m"), F.col("got"), 50.0)).collect()] == [77, 100_000_000_001]
