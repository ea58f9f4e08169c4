"""Trajectory records: checksums, message forms, round trips, damage with its offset."""

from __future__ import annotations

import random
import struct

import pytest
from pyspark.sql import functions as F

from strandlake.sources import files, trajectories


def plain(data):
    c, table = 0xFFFFFFFF, trajectories._plain_table()
    for b in data:
        c = c >> 8 ^ table[(c ^ b) & 255]
    return c ^ 0xFFFFFFFF


def test_checksums():
    assert trajectories.crc32c(b"123456789") == 0xE3069283 and trajectories.crc32c(b"\0" * 32) == 0x8A9136AA and trajectories.crc32c(b"") == 0
    rnd = random.Random(0)
    for n in (1, 3, 511, 512, 513, 1000, 4096, 4097, 70_001):
        data = rnd.randbytes(n)
        assert trajectories.crc32c(data) == plain(data), n
    assert trajectories.crc32c(b"\0" * 5000) == plain(b"\0" * 5000)


def test_message_forms():
    some = {"b": {"bytes": [b"", b"x\xff"]}, "f": {"floats": [1.5, -2.0]}, "i": {"ints": [0, 1, -1, 2**62, -(2**63), 300]}, "none": {}, "e": {"ints": []}, "é": {"bytes": []}}
    full = lambda f: {k: {**dict.fromkeys(trajectories.LISTS), **v} for k, v in f.items()}
    assert trajectories.example(trajectories.message(some)) == full(some)
    # by hand: {"a": ints [3, 270]}, packed and not; floats one by one; an unknown field
    packed = bytes.fromhex("0a0e" "0a0c" "0a0161" "1207" "1a05" "0a03" "038e02")
    assert trajectories.example(packed)["a"]["ints"] == [3, 270] and trajectories.message({"a": {"ints": [3, 270]}}) == packed
    assert trajectories.example(bytes.fromhex("0a0d" "0a0b" "0a0161" "1206" "1a04" "0803" "0804"))["a"]["ints"] == [3, 4]
    one = b"\x12\x07\x12\x05\x0d" + struct.pack("<f", 0.5)
    assert trajectories.example(b"\x0a" + bytes([len(one) + 5]) + b"\x0a" + bytes([len(one) + 3]) + b"\x0a\x01a" + one)["a"]["floats"] == [0.5]
    assert trajectories.example(b"\x12\x01z") == {} and trajectories.example(b"") == {}
    with pytest.raises(ValueError):
        trajectories.example(packed[:-1])


def table(spark, n=40):
    rnd = random.Random(1)
    rows = [(i, [rnd.random() for _ in range(i % 5)], f"t{i}é", list(range(i % 4)), rnd.randbytes(i * 50)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "i int, f array<double>, s string, k array<int>, b binary")


def test_round_trip(spark, tmp_path, monkeypatch):
    rows, df = table(spark)
    monkeypatch.setattr(trajectories, "STRETCH", 100)  # for the reader below
    path = str(tmp_path / "some records")
    trajectories.write(df.repartition(3), {c: F.col(c) for c in df.columns}, path)
    f = trajectories.feature
    back = trajectories.read(spark, path).select(f("i", "ints")[0], f("f", "floats"), F.decode(f("s", "bytes")[0], "utf-8"), f("k", "ints"), f("b", "bytes")[0], f("i", "floats"), f("none", "ints"), "error")
    found = sorted(tuple(r) for r in back.collect())
    assert [r[0] for r in found] == list(range(40)) and all(r[5:] == (None, None, None) for r in found)
    for r, (i, x, s, k, b) in zip(found, rows):
        assert r[1] == pytest.approx(x, rel=1e-6) and (r[2], r[3], bytes(r[4])) == (s, k, b)
    uri = files.listed(files.qualified(spark, path), trajectories.SUFFIXES)[0]
    with files.Ranges(uri) as file:  # in short stretches
        assert [at for at, _, e in trajectories.frames(file) if not e] == sorted(r.offset for r in trajectories.read(spark, path).filter(F.col("path") == uri).collect())
    trajectories.write(df.limit(2), {"i": F.col("i")}, path, mode="overwrite")
    assert trajectories.read(spark, path).count() == 2
    trajectories.write(df.limit(0), {"i": F.col("i")}, str(tmp_path / "none"))
    assert trajectories.read(spark, str(tmp_path / "none")).count() == 0


def test_damage_is_told_with_its_offset(spark, tmp_path):
    records = [trajectories.framed(trajectories.message({"i": {"ints": [i]}})) for i in range(6)]
    at = [sum(map(len, records[:i])) for i in range(7)]

    def read(name, data, damaged):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / "a.tfrecord").write_bytes(data)
        i = trajectories.feature("i", "ints")[0]
        return [tuple(r) for r in trajectories.read(spark, str(tmp_path / name), damaged).select("offset", i, "error").orderBy("offset").collect()]

    def change(data, k):
        return data[:k] + bytes([data[k] ^ 4]) + data[k + 1 :]

    whole = b"".join(records)
    assert read("whole", whole, "stop") == [(at[i], i, None) for i in range(6)]
    body = change(whole, at[2] + 14)
    with pytest.raises(Exception, match=f"a.tfrecord: the message's checksum is wrong at byte {at[2]}"):
        read("body", body, "stop")
    assert read("body", body, "keep") == [(at[i], i, None) if i != 2 else (at[2], None, "the message's checksum is wrong") for i in range(6)]
    assert read("length", change(whole, at[3]), "keep") == [(at[i], i, None) for i in range(3)] + [(at[3], None, "the length's checksum is wrong")]
    assert read("cut", whole[:-3], "keep") == [(at[i], i, None) for i in range(5)] + [(at[5], None, "a frame is cut off")]
    assert read("head", whole[: at[5] + 5], "keep")[-1] == (at[5], None, "a frame is cut off")
    odd = records[0] + trajectories.framed(b"\x0a\x05\x0a") + records[1]
    found = read("odd", odd, "keep")
    assert [r[1] for r in found] == [0, None, 1] and "can't be read" in found[1][2]


def test_steps(spark):
    df = spark.createDataFrame([("a", [1, 2, 3], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), ("b", [], []), ("c", [9], [7.0, 8.0])], "n string, i array<int>, v array<double>")
    out = trajectories.steps(df.select("n", "i", "v"), F.size("i"), {"id": (F.col("i"), 1), "x": (F.col("v"), 2)})
    assert sorted((r.n, r.step, r.id, r.x) for r in out.collect()) == [("a", 0, [1], [1.0, 2.0]), ("a", 1, [2], [3.0, 4.0]), ("a", 2, [3], [5.0, 6.0]), ("c", 0, [9], [7.0, 8.0])]
