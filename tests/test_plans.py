"""Schemas, pipelines, readers, writers and streams."""

from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.plans import pipeline, schema
from strandlake.sources import readers, writers
from strandlake.streaming import live, local


def test_schema_rules():
    s = schema.struct({"state": ("float32", (6,)), "cam": ("image", (3, 8, 8)), "film": ("video", (3, 8, 8))})
    assert s["state"].dataType == T.ArrayType(T.FloatType()) and s["cam"].dataType == schema.IMAGE and "film" not in s.names
    assert schema.kinds(s)["cam"] == "visual"
    with pytest.raises(ValueError):
        schema.field("a/b", "float32", (1,))
    with pytest.raises(ValueError):
        schema.field("a", "complex", (1,))


def test_versions():
    assert schema.safe_version("v3.1", ["v2.9", "v3.0"]) == "v3.0"
    with pytest.raises(ValueError, match="old"):
        schema.safe_version("v3.0", ["v2.1"])
    with pytest.raises(ValueError, match="new"):
        schema.safe_version("v3.0", ["v4.0"])


def test_rename_by_patterns():
    assert schema.rename_by_patterns(["a", "b_1", "c"], {r"b_(\d)": r"x\1", "c": None}) == {"a": "a", "b_1": "x1"}
    with pytest.raises(ValueError):
        schema.rename_by_patterns(["a", "b"], {"a|b": "x"})
    with pytest.raises(ValueError):
        schema.rename_by_patterns(["a", "a/b"], {})


def test_flatten_round_trip(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("x"), F.struct(F.lit(2).alias("y")).alias("z")).alias("a"), F.lit(3).alias("b"))
    flat = schema.flattened(df)
    assert flat.columns == ["a/x", "a/z/y", "b"]
    assert schema.unflattened(flat).first() == df.first()


def test_pipeline(spark):
    p = pipeline.Pipeline([pipeline.Rename({"s": "state"}), pipeline.Pad("state", 3), pipeline.Normalise("state", [0, 0, 0], [2, 2, 2], "min_max")], "p")
    df = spark.createDataFrame([([1.0, 2.0],)], "s array<double>")
    assert p(df).first().state == [0.0, 1.0, -1.0]
    again = pipeline.Pipeline.from_json(p.to_json())
    assert again(df).first() == p(df).first() and len(again[:2]) == 2
    assert p.output_schema(spark, df.schema) == p(df).schema
    hot = p.with_stats({"state": {"min": [0, 0, 0], "max": [4, 4, 4]}})
    assert hot(df).first().state == [-0.5, 0.0, -1.0]
    with pytest.raises(ValueError):
        pipeline.register("pad")(pipeline.Pad)


def test_layers_are_left_in_reverse():
    g = pipeline.Layers(((1,), (2,))).inside([3], [4])
    assert g.way_in() == [1, 3] and g.way_out() == [4, 2]


def test_model_steps_dataset_and_loader(spark):
    df = spark.createDataFrame([(1, 0, "Do It", [0.0, 1.0]), (2, 1, None, [0.5, -1.0])], "episode_index int, frame_index int, prompt string, state array<double>")
    rows = {k: pipeline.Pipeline(pipeline.model_steps(k, "todo", 4))(df).orderBy("frame_index").collect() for k in ("flow", "flow_text", "tokens")}
    assert rows["flow"][0].state == [0.0, 1.0, 0.0, 0.0] and rows["flow"][1].prompt == "todo"
    assert rows["tokens"][1].prompt == "Task: todo, State: 192 0;\n" and len(rows["tokens"][0].state) == 2
    with pytest.raises(ValueError):
        pipeline.model_steps("other")
    frames, stats = pipeline.dataset(df, df.select("episode_index"), [1], override={"mean": 0.5})
    assert frames.count() == 1 and stats.first().mean == 0.5
    assert pipeline.loader("fake", fake=lambda: df).count() == 2
    with pytest.raises(ValueError):
        pipeline.loader("rlds", fake=lambda: df)


def test_feature_dicts():
    a = {"state": {"dtype": "float32", "shape": (2,), "names": ["x", "y"]}, "cam": {"dtype": "image", "shape": (4, 4, 3), "names": None}}
    b = {"state": {"dtype": "float32", "shape": (2,), "names": ["y", "z"]}}
    merged = schema.merge_features(a, b)
    assert merged["state"] == {"dtype": "float32", "shape": (3,), "names": ["x", "y", "z"]} and merged["cam"] == a["cam"]
    with pytest.raises(ValueError):
        schema.merge_features(a, {"state": {"dtype": "int64", "shape": (1,), "names": ["q"]}})
    assert schema.camera_shapes(a) == ({"cam": (4, 4, 3)}, "image")
    with pytest.raises(ValueError):
        schema.camera_shapes(a | {"c2": {"dtype": "video", "shape": (1,)}})
    assert schema.lists_as_sequences({"a": {"_type": "List", "f": [{"_type": "List"}, {"_type": "Value"}]}}) == {"a": {"_type": "Sequence", "f": [{"_type": "Sequence"}, {"_type": "Value"}]}}


def test_text_logs(spark, tmp_path):
    (tmp_path / "arm.txt").write_text("20 " + ",".join(map(str, range(16))) + "\n\n10 " + ",".join(map(str, range(16))) + "\n")
    rows = readers.arm_text(spark, str(tmp_path / "arm.txt")).orderBy("ts_ns").collect()
    assert [r.ts_ns for r in rows] == [10, 20] and rows[0]["values"][8] == 8.0
    assert readers.arm_text(spark, str(tmp_path / "none.txt")).count() == 0
    writers.arm_text(readers.arm_text(spark, str(tmp_path / "arm.txt")), str(tmp_path / "out"))
    assert readers.arm_text(spark, str(tmp_path / "out")).count() == 2


def test_image_index_and_zip(spark, tmp_path):
    d = tmp_path / "img"
    d.mkdir()
    for n in ("1_100.jpg", "2_200.jpg", "x.jpg"):
        (d / n).write_bytes(b"i")
    assert [(r.frame_id, r.ts_ns) for r in readers.image_index(spark, str(d)).orderBy("ts_ns").collect()] == [(1, 100), (2, 200)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("e/1.txt", "one")
    assert [(r.name, bytes(r.content)) for r in readers.zip_entries(spark, str(tmp_path / "a.zip")).collect()] == [("e/1.txt", b"one")]


def test_save_and_read_episodes(spark, tmp_path):
    f = spark.createDataFrame([(7, 0, "x"), (7, 1, "x"), (9, 0, "y")], "episode_index long, t long, task string")
    eps = writers.save_episodes(f, str(tmp_path / "d"), ["t"], 10.0)
    assert [(r.dataset_from_index, r.dataset_to_index) for r in eps.orderBy("episode_index").collect()] == [(0, 2), (2, 3)]
    assert readers.frame_table(spark, str(tmp_path / "d/data"), [1]).count() == 1
    assert readers.task_table(spark, str(tmp_path / "d/meta/tasks")).count() == 2
    with pytest.raises(ValueError):
        writers.append("/a", f, "/a/")


def test_json(spark, tmp_path):
    writers.json_document(spark, {"fps": 30}, str(tmp_path / "info"))
    assert readers.json_document(spark, str(tmp_path / "info")) == {"fps": 30}
    (tmp_path / "x.jsonl").write_text(json.dumps({"a": 1}) + "\n{bad\n")
    assert readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a int").count() == 1


def test_generated(spark):
    rows = readers.mock_arms(spark, 50).collect()
    assert all(abs(x) <= 3.14 for r in rows for x in r.position) and len(rows[0].position) == 7
    assert readers.fake_rows(spark, {"state": 4}, 5).collect() == readers.fake_rows(spark, {"state": 4}, 5).collect()


def test_stateful_streams(spark, tmp_path):
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate([0, 0.1, 5, 5.2, 9])], "k long, t long, v double").coalesce(1)
    s = local.as_stream(spark, df, 1)
    kept = live.run_once(live.skip_similar(s, "k", ["t"], ["v"], 1.0), local.name("skip"), "append", str(tmp_path / "c1"))
    assert sorted(r.v for r in kept.collect()) == [0, 5, 9]
    buf = live.run_once(live.newest(s, "k", "t", "v", 2), local.name("buf"), "update", str(tmp_path / "c2"))
    assert buf.collect()[-1].buffer == [5.2, 9.0]


def test_faulty_recordings(spark):
    from strandlake.operators import quality
    from strandlake.sources import faults

    rows = faults.recordings(spark)
    got = {r.sub_task_id: (r.result, r.fail_error) for r in quality.inspect(rows, faults.CAMERAS, "head_color", "head_color", "head_depth").collect()}
    failed = {k for k, v in got.items() if v[0] == "failed"}
    assert failed == {1, 6, 8, 10, 11, 12, 13, 14, 15, 16}, got
    assert got[12][1] == "bad timestamp" and got[10][1] == "left: no joint data"
    more = {r.sub_task_id for r in quality.inspect(rows, faults.CAMERAS, "head_color", "head_color", "head_depth", gripper=True).collect() if r.result == "failed"}
    assert more == failed | {20, 21, 22, 23}


def test_gripper_checks_go_one_after_another(spark):
    """The first check that any row fails is reported, at its first row; both directions, each beside its limit."""
    from strandlake.operators import quality

    cases = {
        1: ([(0, 10.0), (0, 15.0), (1, 14.0)], None),  # within both limits
        2: ([(0, 10.0), (0, 15.1)], ("closing, but the width grows", 1)),
        3: ([(1, 50.0), (1, 48.9)], ("opening, but the width shrinks", 1)),
        4: ([(0, 50.0), (0, 10.0), (1, 60.0)], None),  # closing shrinks, opening grows
        5: ([(1, 50.0), (1, 10.0), (0, 71.0)], ("width out of range", 2)),
        6: ([(0, -1.0), (0, 20.0), (0.5, 20.0)], ("action is neither 0 nor 1", 2)),
        7: ([(1, 50.0), (1, 40.0), (0, 60.0)], ("closing, but the width grows", 2)),
    }
    df = spark.createDataFrame([(k, t, float(a), w) for k, (rows, _) in cases.items() for t, (a, w) in enumerate(rows)], "k long, t long, a double, w double")
    got = {r.k: (r.error, r["at"]) for r in quality.gripper_errors(df, ["k"], "t", "a", "w").collect()}
    assert got == {k: v for k, (_, v) in cases.items() if v}


def test_gripper_penalty_is_on_the_position_scale(spark):
    from strandlake.functions import vector as V

    df = spark.createDataFrame([(0, 10.0, 60.0), (1, 10.0, 0.6), (2, 80.0, 40.0), (3, 80.0, 60.0), (4, 60.0, 40.0), (5, None, 60.0)], "k int, p double, a double")
    got = [r.x for r in df.select("k", V.gripper_penalty(F.col("a"), F.col("p")).alias("x")).orderBy("k").collect()]
    assert got == [-0.01, 0, -0.01, 0, 0, None]


def test_faulty_pictures(spark):
    from strandlake.functions import image, png
    from strandlake.sources import faults

    p = faults.pictures(spark).withColumn("im", image.decoded_or_null(png.decode)(F.col("bytes")))
    head = {r.episode: r for r in p.filter("stream = 'head_color'").select("episode", "im", image.empty()(F.col("im")).alias("e")).filter("im.data IS NOT NULL").collect()}
    assert set(head) == {0, 3, 4, 5, 9} and [head[k].e for k in (0, 3, 4, 5, 9)] == [None, "black", "white", None, None]
    assert {k for k, r in head.items() if (r.im.height, r.im.width) != faults.SIZE} == {5}
    depth = p.filter("stream = 'head_depth'").select("episode", image.empty(dark=10, bright=None)(F.col("im")).alias("e")).filter("e IS NOT NULL").collect()
    assert [(r.episode, r.e) for r in depth] == [(9, "black")]
    blue = bytearray(b"\x00\x00\xff" * 200)  # dark in two channels is not black, bright in one is not white
    nearly = bytearray(b"\x14\x14\x14" * 199 + b"\x15\x00\x00")
    white = bytearray(b"\xe6\xff\xff" * 200)
    df = spark.createDataFrame([(1, (10, 20, 3, blue)), (2, (10, 20, 3, nearly)), (3, (10, 20, 3, white)), (4, None)], "k int, im struct<height:int,width:int,channels:int,data:binary>")
    assert [r.e for r in df.select("k", image.empty()(F.col("im")).alias("e")).orderBy("k").collect()] == [None, "black", "white", None]


def test_png_files():
    import struct
    import zlib

    import numpy as np

    from strandlake.functions import png

    rnd = np.random.default_rng(3)
    for shape in ((5, 7, 1), (1, 1, 3), (4, 6, 2), (9, 3, 4)):
        a = rnd.integers(0, 256, shape).astype(np.uint8)
        assert (png.decode(png.encode(a)) == a).all()
    a = rnd.integers(0, 256, (5, 6, 3)).astype(int)
    raw = b""
    for y in range(5):  # each line by another filter, as the format defines them
        line = [y]
        for x in range(6):
            for c in range(3):
                left, up = (a[y, x - 1, c] if x else 0), (a[y - 1, x, c] if y else 0)
                corner = a[y - 1, x - 1, c] if x and y else 0
                guess = left + up - corner
                paeth = left if abs(guess - left) <= min(abs(guess - up), abs(guess - corner)) else up if abs(guess - up) <= abs(guess - corner) else corner
                line.append((a[y, x, c] - [0, left, up, (left + up) // 2, paeth][y]) % 256)
        raw += bytes(int(v) for v in line)
    part = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    data = png.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")
    assert (png.decode(data) == a).all()
    for bad in (b"", b"GIF89a", data[:-20], data[:50] + b"x" + data[51:], data.replace(b"IEND", b"IEMD")):
        with pytest.raises(ValueError):
            png.decode(bad)


def test_action_chunks(spark):
    import numpy as np

    from strandlake.functions import chunk

    rnd = np.random.default_rng(5)
    y = rnd.normal(size=(9, 3))
    n = len(y)
    a, b = np.zeros((n, n)), np.zeros((n, 3))  # second derivatives of the natural cubic, as dense equations
    a[0, 0] = a[-1, -1] = 1
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = 1, 4, 1
        b[i] = 6 * (y[i - 1] - 2 * y[i] + y[i + 1])
    m = np.linalg.solve(a, b)
    u = np.linspace(0, 1, 23) * (n - 1)
    i = np.minimum(u.astype(int), n - 2)
    t = (u - i)[:, None]
    want = (1 - t) * y[i] + t * y[i + 1] + (((1 - t) ** 3 - (1 - t)) * m[i] + (t**3 - t) * m[i + 1]) / 6
    assert np.allclose(chunk.curve(y, 23, "natural"), want)
    flat = chunk.curve(np.array([[0.0], [0.0], [1.0], [1.0], [0.5]]), 41, "pchip")
    assert flat.min() >= 0 and flat.max() <= 1 and np.allclose(flat[::10, 0], [0, 0, 1, 1, 0.5])
    for kind in ("linear", "pchip", "natural"):
        assert np.allclose(chunk.curve(np.array([[0.0], [2.0]]), 5, kind)[:, 0], [0, 0.5, 1, 1.5, 2])
        assert chunk.curve(y[:1], 3, kind).tolist() == [y[0].tolist()] * 3
    df = spark.createDataFrame([(1, [[1.0, 5.0], [2.0, 6.0], [3.0, 7.0]], [0.0, 9.0]), (2, [[1.0, 5.0]], None), (3, [], [1.0, 1.0]), (4, None, [1.0, 1.0])], "k long, c array<array<double>>, s array<double>")
    c = F.col("c")
    got = df.select("k", chunk.moved_then_held(c, [1]).alias("a"), chunk.interleaved(c, [1]).alias("b"), chunk.blended_head(c, F.col("s"), 2, [1]).alias("d"), chunk.thinned(c, 2).alias("e"), chunk.resampled(c, 2.0, "linear").alias("f")).orderBy("k").collect()
    assert got[0].a == [[1, 5], [2, 5], [3, 5], [3, 6], [3, 7]]
    assert got[0].b == [[1, 5], [1, 5], [2, 5], [2, 6], [3, 6], [3, 7]]
    assert got[0].d == [[0, 9], [2, 6], [3, 7]] and got[0].e == [[1, 5], [3, 7]] and len(got[0].f) == 6
    assert [got[1][x] for x in "abdef"] == [[[1, 5]], [[1, 5], [1, 5]], [[1, 5]], [[1, 5]], [[1, 5], [1, 5]]]
    assert [got[2][x] for x in "abdef"] == [[]] * 5 and [got[3][x] for x in "abdef"] == [None] * 5
    with pytest.raises(ValueError):
        chunk.resampled(c, 2.0, "spline")


def test_images(spark):
    import numpy as np

    from strandlake.functions import image

    flat = [i / 63 for i in range(64)]
    df = spark.createDataFrame([(1, flat), (2, [0.0] * 64)], "id long, v array<double>").withColumn("im", image.from_vector(F.col("v"), 8, 8))
    r = df.select("id", image.resize_with_pad(4, 8)(F.col("im")).alias("small"), image.crop(1, 2, 3, 4)(F.col("im")).alias("cut"), image.random_crop(F.col("im"), F.col("id"), 5, 5, 1).alias("part"), image.to_float()(F.col("im")).alias("f"), image.empty()(F.col("im")).alias("e"), image.jitter(F.col("im"), F.col("id"), 3).alias("j")).orderBy("id").collect()
    assert (r[0].small.height, r[0].small.width) == (4, 8) and (r[0].cut.height, r[0].cut.width) == (3, 4) and r[0].part.height == 5
    assert np.allclose(r[0].f, np.rint(np.array(flat) * 255) / 255, atol=1e-6) and [x.e for x in r] == [None, "black"]
    assert image.channel_last(np.zeros((3, 8, 9))).shape == (8, 9, 3)


def test_records(spark):
    from strandlake.operators import records

    f = spark.createDataFrame([(1, 0, 1.0), (1, 10, 2.0)], "k long, t long, v double")
    q = spark.createDataFrame([(1, 2), (1, 30)], "k long, t long")
    assert [r.is_pad for r in records.nearest_with_mask(q, f, ["k"], "t", "v", 3).orderBy("t").collect()] == [False, True]
    with pytest.raises(Exception, match="no frame near"):
        records.nearest_or_error(q, f, ["k"], "t", "v", 3).collect()
    t = spark.createDataFrame([(1, [1.0], True), (2, [float("nan")], True), (3, [2.0], False)], "i long, s array<double>, human boolean")
    ok, human = records.split_transitions(t, ["s"], "human")
    assert ok.count() == 2 and human.count() == 1


def test_json_files_of_any_form(spark, tmp_path):
    forms = {"array": '\n [{"a": 1, "b": "x"},\n {"a": 2, "b": "]"}]\n', "bare": '{"a": 3, "b": "y"},\n{"a": 4, "b": null}', "lines": '{"a": 5, "b": "z"}\n\nnot json\n{"a": 6, "b": "[w]"}\n', "cut": '[{"a": 7', "none": ""}
    for name, text in forms.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = lambda n: sorted((r.a, r.b) for r in readers.json_arrays(spark, str(tmp_path / f"{n}.json"), "a: int, b: string").collect())
    assert found("array") == [(1, "x"), (2, "]")] and found("bare") == [(3, "y"), (4, None)]
    assert found("lines") == [(5, "z"), (6, "[w]")] and found("cut") == [] and found("none") == []


def test_a_person_without_an_action_changes_nothing(spark):
    df = spark.createDataFrame([(1.0, 2.0, True, False, False), (1.0, None, True, True, False), (1.0, 2.0, False, False, True)], "action double, teleop_action double, is_intervention boolean, success boolean, terminate boolean")
    out = pipeline.Intervention()
    assert [(r.action, r.reward, r.done) for r in out.apply(df).collect()] == [(2.0, 0.0, False), (1.0, 1.0, True), (1.0, 0.0, True)]
    out.terminate_on_success = False
    assert [r.done for r in out.apply(df).collect()] == [False, False, True]
