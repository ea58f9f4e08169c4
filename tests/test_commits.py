"""Recordings: batches are there as a whole or not at all, replays change nothing, numbers go on."""

from __future__ import annotations

import pytest

from strandlake.sources import commits, files, writers


def frames(spark, episodes, task="walk", n=3):
    return spark.createDataFrame([(e, t, f"{task} {e % 2}", float(e * 100 + t)) for e in episodes for t in range(n)], "episode_index long, t long, task string, x double")


def whole(spark, path):
    rows = sorted((r["index"], r.episode_index, r.frame_index, r.task_index, r.x) for r in commits.read(spark, path).collect())
    eps = sorted((r.episode_index, r.length, r.dataset_from_index, r.dataset_to_index) for r in commits.read(spark, path, "meta/episodes").collect())
    tasks = {r.task: r.task_index for r in commits.read(spark, path, "meta/tasks").collect()}
    return rows, eps, tasks


def save(spark, path, batch, episodes, **kw):
    return commits.save(frames(spark, episodes, **kw), path, batch, ["t"], 10.0)


def test_numbers_go_on_and_replays_change_nothing(spark, tmp_path):
    path = str(tmp_path / "r")
    assert save(spark, path, "b0", [5, 9]) and save(spark, path, "b1", [4])
    once = whole(spark, path)
    rows, eps, tasks = once
    assert [r[:3] for r in rows] == [(i, i // 3, i % 3) for i in range(9)]
    assert [r[4] for r in rows] == [500, 501, 502, 900, 901, 902, 400, 401, 402]
    assert eps == [(0, 3, 0, 3), (1, 3, 3, 6), (2, 3, 6, 9)] and tasks == {"walk 1": 0, "walk 0": 1}
    assert not save(spark, path, "b0", [5, 9]) and not save(spark, path, "b1", [4])
    assert whole(spark, path) == once and commits.unfinished(spark, path) == []


@pytest.mark.parametrize("broken", commits.TABLES)
def test_a_writer_that_dies_leaves_nothing_to_see(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "r")
    save(spark, path, "b0", [1])
    before, write = whole(spark, path), commits._write

    def dies(df, path_, name, attempt):
        if name == broken:
            raise OSError("disk full")
        write(df, path_, name, attempt)

    monkeypatch.setattr(commits, "_write", dies)
    with pytest.raises(OSError):
        save(spark, path, "b1", [2, 3])
    monkeypatch.setattr(commits, "_write", write)
    assert whole(spark, path) == before
    assert len(commits.unfinished(spark, path)) == (broken != commits.TABLES[0])
    assert save(spark, path, "b1", [2, 3])  # a restarted writer
    rows, eps, _ = whole(spark, path)
    assert [r[0] for r in rows] == list(range(9)) and len(eps) == 3
    commits.sweep(spark, path)
    assert commits.unfinished(spark, path) == [] and whole(spark, path)[0] == rows


def test_a_writer_that_dies_before_its_manifest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    monkeypatch.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        save(spark, path, "b0", [1])
    monkeypatch.undo()
    assert commits.commits(spark, path).count() == 0 and len(commits.unfinished(spark, path)) == 1
    assert save(spark, path, "b0", [1]) and len(whole(spark, path)[0]) == 3
    assert len(commits.sweep(spark, path)) == 1 and len(whole(spark, path)[0]) == 3


def test_two_writers(spark, tmp_path, monkeypatch):
    """One writer's batch comes in between: the other numbers its own behind it."""
    path, publish, done = str(tmp_path / "r"), files.publish, []

    def slow(spark_, place, data):
        if not done:
            done.append(1)
            assert save(spark, path, "other", [7], task="run")
        return publish(spark_, place, data)

    monkeypatch.setattr(files, "publish", slow)
    assert save(spark, path, "own", [8])
    rows, eps, tasks = whole(spark, path)
    assert [r[4] for r in rows] == [700, 701, 702, 800, 801, 802] and [r[0] for r in rows] == list(range(6))
    assert tasks == {"run 1": 0, "walk 0": 1} and commits.unfinished(spark, path) == []
    assert [(r.commit, r.batch) for r in commits.commits(spark, path).orderBy("commit").collect()] == [(0, "other"), (1, "own")]


def test_a_manifest_is_published_once(spark, tmp_path):
    place = str(tmp_path / "c" / "0.json")
    assert files.publish(spark, place, b"one") and not files.publish(spark, place, b"two")
    assert open(place, "rb").read() == b"one" and files.children(spark, str(tmp_path / "c")) == [".0.json.crc", "0.json"] or files.children(spark, str(tmp_path / "c")) == ["0.json"]
    assert files.children(spark, str(tmp_path / "none")) == []


def test_a_replayed_batch_of_a_stream(spark, tmp_path):
    source, path, check = str(tmp_path / "in"), str(tmp_path / "r"), str(tmp_path / "check")
    for i in range(3):
        frames(spark, [2 * i, 2 * i + 1]).coalesce(1).write.mode("append").parquet(source)

    def go(read):
        stream = spark.readStream.schema(frames(spark, [0]).schema).option("maxFilesPerTrigger", 1).parquet(source)
        read(stream).awaitTermination()

    def forget():  # the last batch was done, but its end not written down
        last = max(int(n) for n in files.children(spark, f"{check}/commits") if n.isdigit())
        files.remove(spark, f"{check}/commits/{last}")

    save_all = lambda s: commits.save_stream(s, path, check, ["t"], 10.0, "cam")
    go(save_all)
    once = whole(spark, path)
    assert len(once[0]) == 18 and len(once[1]) == 6
    forget()
    go(save_all)
    assert whole(spark, path) == once
    # the plain writer of folders writes a replayed batch anew
    check, path2 = str(tmp_path / "check2"), str(tmp_path / "f")
    plain = lambda s: writers.episodes_of_stream(s, path2, check, "episode_index")
    go(plain)
    forget()
    go(plain)
    assert spark.read.parquet(path2).count() == 18


def test_files_go_to_any_file_system(spark, tmp_path):
    rows = spark.createDataFrame([("a/ü 1%.png", bytearray(b"x")), ("b.png", bytearray(b"yz")), (None, bytearray(b"q")), ("c.png", None)], "name string, bytes binary")
    for folder in (str(tmp_path / "p"), f"file://{tmp_path}/q"):
        found = {r["name"]: r["size"] for r in writers.image_files(rows, folder).collect()}
        assert found == {"a/ü 1%.png": 1, "b.png": 2}
    assert (tmp_path / "p/a/ü 1%.png").read_bytes() == b"x" and (tmp_path / "q/b.png").read_bytes() == b"yz"
    with pytest.raises(Exception):
        writers.image_files(rows, "nosuch://host/folder")
