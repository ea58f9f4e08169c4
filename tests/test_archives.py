"""Archives by ranges: many tasks for one archive, damage, large fields, odd names."""

from __future__ import annotations

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from strandlake.sources import archives, readers


def archive(path, entries, **kw):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", **kw) as z:
        for name, data in entries:
            z.writestr(name, data)
    return path


def test_an_archive_is_read_by_many_tasks(spark, tmp_path):
    rnd = random.Random(0)
    some = [(f"d/ü {i}.bin", rnd.randbytes(i * 7)) for i in range(200)]
    archive(tmp_path / "a b" / "one.zip", [*some, ("empty/", b"")], compression=zipfile.ZIP_DEFLATED)
    archive(tmp_path / "a b" / "sub" / "two.zip", [("s", b"stored" * 5)])
    archive(tmp_path / "a b" / "none.zip", [])
    listed = archives.entries(spark, str(tmp_path / "a b"))
    assert listed.count() == 201 and {r.method for r in listed.collect()} == {0, 8}
    rows = archives.read(listed, parts=8).withColumn("task", F.spark_partition_id())
    found = rows.collect()
    assert {r["name"]: bytes(r.content) for r in found} == dict(some) | {"s": b"stored" * 5}
    assert len({r.task for r in found if r.archive.endswith("one.zip")}) == 8 and not any(r.error for r in found)
    assert archives.read(listed.filter("name = 's'")).first().archive.endswith("sub/two.zip")


def test_damage(spark, tmp_path):
    path = archive(tmp_path / "x" / "a.zip", [(f"{i}", b"entry %d " % i * 40) for i in range(9)], compression=zipfile.ZIP_DEFLATED)
    with zipfile.ZipFile(path) as z:
        places = {i.filename: i.header_offset for i in z.infolist()}
    data = bytearray(path.read_bytes())
    data[places["3"] + 30 + 1 + 5] ^= 255  # in the packed bytes
    data[places["5"]] ^= 255  # in the local header
    path.write_bytes(data)
    with pytest.raises(Exception, match="a.zip: [35]: "):
        readers.zip_entries(spark, str(tmp_path / "x")).collect()
    found = {r["name"]: r for r in archives.read(archives.entries(spark, str(tmp_path / "x")), damaged="keep").collect()}
    assert {n for n, r in found.items() if r.error} == {"3", "5"} and found["5"].error == "no local header" and found["3"].content is None
    assert all(bytes(found[str(i)].content) == b"entry %d " % i * 40 for i in (0, 1, 2, 4, 6, 7, 8))
    (tmp_path / "x" / "b.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="no end record"):
        archives.entries(spark, str(tmp_path / "x")).collect()


def test_sizes_of_64_bits_and_comments(spark, tmp_path):
    path = tmp_path / "x" / "a.zip"
    path.parent.mkdir()
    with zipfile.ZipFile(path, "w") as z:
        with z.open("wide", "w", force_zip64=True) as f:
            f.write(b"w" * 1000)
        z.writestr("plain", b"p")
        z.comment = b"a comment " * 50
    assert {r["name"]: bytes(r.content) for r in readers.zip_entries(spark, str(path.parent)).collect()} == {"wide": b"w" * 1000, "plain": b"p"}
    many = tmp_path / "y" / "many.zip"
    archive(many, [(f"{i}", b"") for i in range(66_000)])  # more entries than 16 bits count
    assert archives.entries(spark, str(many)).count() == 66_000


def test_written_archives(spark, tmp_path):
    rows = [(f"a {i % 3}", f"n/é{i}", bytearray(b"c%d" % i)) for i in range(30)] + [("a 0", "null", None)]
    df = spark.createDataFrame(rows, "archive string, name string, content binary")
    told = {r.archive: r.entries for r in archives.write(df, str(tmp_path / "out")).collect()}
    assert told == {"a 0": 11, "a 1": 10, "a 2": 10}
    with zipfile.ZipFile(tmp_path / "out" / "a 1.zip") as z:
        assert z.testzip() is None and z.read("n/é4") == b"c4"
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a 0.zip", "a 1.zip", "a 2.zip"]
    assert {r["name"]: bytes(r.content) for r in readers.zip_entries(spark, str(tmp_path / "out")).collect()} == {n: bytes(c or b"") for _, n, c in rows}
