"""Aggregates of files: only small files are written, others are referred to; sources join later; nothing half done is seen."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strandlake.operators import edit
from strandlake.sources import aggregates, files, readers


def source(spark, path, sizes):
    """A dataset with an episode and a file of each of the sizes."""
    rows, at = [], 0
    for e, n in enumerate(sizes):
        rows += [(e, i, at + i, f"{e:03d}", float(at + i)) for i in range(n)]
        at += n
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, index long, file string, x double")
    df.repartition("file").write.partitionBy("file").parquet(f"{path}/chunk-000")
    return path


def lines(spark, path):
    t = aggregates.file_map(spark, path).collect()
    return sorted((r.source, r.src_file, r.dst_chunk, r.dst_file, r.carried) for r in t)


def whole(spark, path):
    return sorted((r["index"], r.episode_index, r.frame_index) for r in aggregates.read(spark, path).collect())


def test_files_are_carried_or_merged(spark, tmp_path):
    a, b = source(spark, f"{tmp_path}/a b", [10, 2, 3]), source(spark, f"{tmp_path}/b", [4, 9])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    out = f"{tmp_path}/out dir"
    aggregates.aggregate(spark, [a, b], out, limit=10, size="n_rows", chunk_files=2)
    assert lines(spark, out) == [(0, 0, 0, 0, True), (0, 1, 0, 1, False), (0, 2, 0, 1, False), (1, 0, 0, 1, False), (1, 1, 1, 0, True)]
    want = [(i, e, k) for i, (e, k) in enumerate((e, k) for e, n in enumerate([10, 2, 3, 4, 9]) for k in range(n))]
    assert whole(spark, out) == want
    assert {p: p.stat().st_mtime_ns for p in before} == before
    assert spark.read.parquet(f"{out}/data").count() == 9  # only the three small files were written

    c = source(spark, f"{tmp_path}/c", [1, 20])
    t = aggregates.aggregate(spark, [c], out, limit=11, size="n_rows", chunk_files=2)
    assert lines(spark, out)[3:] == [(1, 0, 0, 1, False), (1, 1, 1, 0, False), (2, 0, 1, 0, False), (2, 1, 1, 1, True)]
    assert whole(spark, out) == want + [(28, 5, 0)] + [(29 + i, 6, i) for i in range(20)]
    assert t.select("uri").distinct().count() == 4 and files.children(spark, f"{out}/tables") == ["00000000", "00000001"]
    d = source(spark, f"{tmp_path}/d", [50])
    aggregates.aggregate(spark, [d], out, limit=11, size="n_rows", chunk_files=2)
    assert lines(spark, out)[-1] == (3, 0, 2, 0, True) and [r[0] for r in whole(spark, out)] == list(range(99))
    assert len(files.children(spark, f"{out}/data")) == 2  # nothing more was written


def test_a_map_for_metadata(spark, tmp_path):
    """The map takes episode metadata to the new files."""
    a, b = source(spark, f"{tmp_path}/a", [5, 1]), source(spark, f"{tmp_path}/b", [1, 5])
    aggregates.aggregate(spark, [a, b], f"{tmp_path}/out", limit=4, size="n_rows")
    eps = spark.createDataFrame([(s, 0, f, s * 2 + f) for s in range(2) for f in range(2)], "source int, src_chunk long, src_file long, episode long")
    moved = edit.remap_files(eps, aggregates.file_map(spark, f"{tmp_path}/out").drop("carried"), ["source", "src_chunk", "src_file"], (9, 9))
    assert sorted((r.episode, r.dst_chunk, r.dst_file) for r in moved.collect()) == [(0, 0, 0), (1, 0, 1), (2, 0, 1), (3, 0, 2)]


def test_bytes_on_disk(spark, tmp_path):
    a = source(spark, f"{tmp_path}/a", [50, 50, 50])
    size = sum(p.stat().st_size for p in (tmp_path / "a").rglob("*.parquet"))
    assert readers.parquet_footers(spark, a).agg(F.sum("length")).first()[0] == size
    aggregates.aggregate(spark, [a], f"{tmp_path}/one", limit=2 * size)
    aggregates.aggregate(spark, [a], f"{tmp_path}/each", limit=1)
    assert {r[3] for r in lines(spark, f"{tmp_path}/one")} == {0} and {r[3:] for r in lines(spark, f"{tmp_path}/each")} == {(0, True), (1, True), (2, True)}
    assert whole(spark, f"{tmp_path}/one") == whole(spark, f"{tmp_path}/each")
    assert not files.children(spark, f"{tmp_path}/each/data")


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    a, out = source(spark, f"{tmp_path}/a", [2, 2]), f"{tmp_path}/out"
    aggregates.aggregate(spark, [a], out, limit=9, size="n_rows")
    before = whole(spark, out)
    monkeypatch.setattr(files, "move", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        aggregates.aggregate(spark, [a], out, limit=9, size="n_rows")
    monkeypatch.undo()
    assert whole(spark, out) == before and lines(spark, out) == [(0, 0, 0, 0, False), (0, 1, 0, 0, False)]
    monkeypatch.setattr(files, "move", lambda *_: False)  # another writer was faster
    with pytest.raises(RuntimeError):
        aggregates.aggregate(spark, [a], out, limit=9, size="n_rows")
    assert whole(spark, out) == before
