"""Folds against plain loops, edge cases of windows, edits and checks."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.functions import rotation, scalar
from strandlake.functions import vector as V
from strandlake.operators import asof, edit, filters, folds, quality, queues, sequence, stats, weights


def frames(spark, values, ts=None):
    ts = ts or list(range(len(values)))
    return spark.createDataFrame([(1, t, float(v)) for t, v in zip(ts, values)], "ep long, t long, v double")


def column(df, name="v"):
    return [r[name] for r in df.orderBy("t").collect()]


def test_asof_ties_and_edges(spark):
    left = spark.createDataFrame([(1, t) for t in (0, 5, 10, 100)], "k long, t long")
    right = spark.createDataFrame([(1, 4, "a"), (1, 6, "b"), (1, 10, "c"), (2, 7, "z")], "k long, t long, v string")
    get = lambda df: [r.r_v for r in df.orderBy("t").collect()]
    for bucket in (None, 3, 50):
        assert get(asof.asof_nearest(left, right, ["k"], "t", ["v"], bucket=bucket)) == ["a", "b", "c", "c"]
        assert get(asof.asof_nearest(left, right, ["k"], "t", ["v"], tie="earlier", bucket=bucket)) == ["a", "a", "c", "c"]
        assert get(asof.asof_nearest(left, right, ["k"], "t", ["v"], tolerance=4, bucket=bucket)) == ["a", "b", "c", None]
        assert get(asof.asof_nearest(left, right, ["k"], "t", ["v"], tolerance=4, inclusive=False, bucket=bucket)) == [None, "b", "c", None]
        assert get(asof.asof_next(left, right, ["k"], "t", ["v"], bucket=bucket)) == ["a", "b", None, None]
        assert get(asof.asof_next(left, right, ["k"], "t", ["v"], strict=False, bucket=bucket)) == ["a", "b", "c", None]
        assert get(asof.asof_prev(left, right, ["k"], "t", ["v"], bucket=bucket)) == [None, "a", "c", "c"]
        assert get(asof.asof_prev(left, right, ["k"], "t", ["v"], strict=True, bucket=bucket)) == [None, "a", "b", "c"]


def test_asof_random_against_loop(spark):
    rnd = random.Random(4)
    l = sorted(rnd.sample(range(500), 60))
    r = sorted(rnd.sample(range(500), 40))
    left, right = spark.createDataFrame([(1, t) for t in l], "k long, t long"), spark.createDataFrame([(1, t, t) for t in r], "k long, t long, v long")
    want = [min(r, key=lambda x: (abs(x - t), -x)) for t in l]
    for bucket in (None, 20, 170):
        assert [x.r_v for x in asof.asof_nearest(left, right, ["k"], "t", ["v"], bucket=bucket).orderBy("t").collect()] == want


def test_monotone_asof_never_goes_back(spark):
    left = spark.createDataFrame([(1, t) for t in (10, 11, 30)], "k long, t long")
    right = spark.createDataFrame([(1, 12, 1.0), (1, 9, 2.0), (1, 50, 3.0)], "k long, t long, v double")
    got = [r.r_v for r in asof.nearest_monotone(left, right, ["k"], "t", "v").orderBy("t").collect()]
    assert got == [2.0, 1.0, 1.0]


@pytest.mark.parametrize("expire, bucket", [(None, None), (None, 40), (12, None), (12, 25)])
def test_monotone_asof_against_a_loop(spark, expire, bucket):
    """Left rows that come in any order, right rows of equal times, and rows that expire."""
    rnd = random.Random(8)
    right = sorted((k, rnd.randint(0, 200), i) for k in range(3) for i in range(25))
    left = [(k if k < 3 else 9, i, rnd.randint(-20, 220)) for k in range(4) for i in range(30)]
    want = {}
    for k, i, x in left:  # the cache by its rule: the last used place is where the next search begins
        rows, low = [r for r in right if r[0] == k], want.get(("low", k), 0)
        fresh = [j for j in range(len(rows)) if j >= low and (expire is None or rows[j][1] >= x - expire)]
        if not [r for r in rows if expire is None or r[1] >= x - expire]:
            want[k, i] = None
            continue
        best = min(fresh or [len(rows) - 1], key=lambda j: (abs(rows[j][1] - x), j))
        want["low", k], want[k, i] = best, rows[best][2]
    l = spark.createDataFrame(left, "k long, i long, t long")
    r = spark.createDataFrame(right, "k long, t long, id long")
    found = asof.nearest_monotone(l, r, ["k"], "t", "id", ["i"], ["id"], expire, bucket=bucket)
    assert {(x.k, x.i): x.r_id for x in found.collect()} == {k: v for k, v in want.items() if k[0] != "low"}


def test_folds_against_loops(spark):
    rnd = random.Random(1)
    t = sorted(rnd.sample(range(1000), 80))
    v = [rnd.uniform(0, 10) for _ in t]
    df = frames(spark, v, t)
    keep, last = [], None
    for x, y in zip(t, v):
        if last is None or x - last >= 25:
            keep.append(y)
            last = x
    assert column(folds.debounce(df, ["ep"], "t", 25)) == keep
    out, prev = [], None
    for y in v:
        prev = y if prev is None else 0.2 * y + 0.8 * prev
        out.append(prev)
    assert np.allclose(column(folds.ema(df, ["ep"], "t", "v", 0.2), "ema"), out)
    assert column(folds.rate_limit(df, ["ep"], "t", "v", 1.0, 0.0), "limited") == [min(max(v[0], -1.0), 1.0)] * len(v)


def hermite(y, factor):
    """Reference values of the shape-preserving cubic at unit spacing."""
    y = np.array(y, float)
    d, n = np.diff(y), len(y)
    if n == 1:
        return list(y)
    m = np.zeros(n)
    for i in range(1, n - 1):
        if d[i - 1] * d[i] > 0:
            m[i] = 2 * d[i - 1] * d[i] / (d[i - 1] + d[i])

    def end(a, b):
        s = (3 * a - b) / 2
        if s * a <= 0:
            return 0.0
        return 3 * a if a * b < 0 and abs(s) > 3 * abs(a) else s

    m[0], m[-1] = (end(d[0], d[1]), end(d[-1], d[-2])) if n > 2 else (d[0], d[0])
    out = []
    for i in range(n - 1):
        for k in range(factor):
            u = k / factor
            out.append(y[i] * (1 + 2 * u) * (1 - u) ** 2 + m[i] * u * (1 - u) ** 2 + y[i + 1] * u * u * (3 - 2 * u) + m[i + 1] * u * u * (u - 1))
    return [*out, y[-1]]


@pytest.mark.parametrize("y", [[0, 1, 4, 9, 3, 3, 5], [2, 1], [7], [0, 0, 1, 0], [1, 5, 2, 8]])
def test_pchip(spark, y):
    got = sequence.pchip(frames(spark, y), ["ep"], "t", "v", 4).orderBy("key_frame", "sub").collect()
    assert np.allclose([r.value for r in got], hermite(y, 4))


def test_two_end_trim(spark):
    assert column(sequence.two_end_trim(frames(spark, [1, 1, 1, 5, 9, 2, 2]), ["ep"], "t", {"v": 0.5})) == [5, 9]
    assert column(sequence.two_end_trim(frames(spark, [1, 1, 1]), ["ep"], "t", {"v": 0.5})) == []
    assert column(sequence.two_end_trim(frames(spark, [1, 5, 9, 2]), ["ep"], "t", {"v": 0.5})) == [1, 5, 9, 2]


def test_delta_rules_differ(spark):
    df = frames(spark, [10, 11, 12, 13])
    assert column(sequence.delta_windows(df, ["ep"], "t", "v", [-3]), "v_m3") == [10, 10, 10, 10]
    assert column(sequence.delta_windows_last_seen(df, ["ep"], "t", "v", [-3]), "v_m3") == [10, 11, 12, 10]


def test_folds_take_their_state_from_batch_to_batch(spark):
    """Episodes that span many batches, batches that hold many episodes, a null episode, and a null time, which comes last."""
    rnd = random.Random(7)
    rows = [(e, i * 10 + rnd.randrange(9), rnd.uniform(0, 10)) for e, n in ((1, 23), (2, 1), (3, 4), (4, 40), (None, 9)) for i in range(n)]
    df = spark.createDataFrame([*rows, (3, None, 1.0)], "ep long, t long, v double").repartition(3)
    fast = F.when(F.col("v") > 5, 0.1).otherwise(0.02)
    folded = {
        "debounce": lambda d: folds.debounce(d, ["ep"], "t", 25),
        "adaptive": lambda d: folds.downsample_adaptive(d, ["ep"], "t", fast, 1.0),
        "ema": lambda d: folds.ema(d, ["ep"], "t", "v", 0.3),
        "small": lambda d: folds.drop_small_changes(d, ["ep"], "t", {"v": 2.0}),
        "rotate": lambda d: folds.rotate_files(d, ["ep"], "t", "v", 20.0, 2),
        "pack": lambda d: folds.pack_batches(d, ["ep"], "t", "v", 1.0, 20.0, 3, 1000),
        "similar": lambda d: folds.skip_similar(d.withColumn("w", F.array("v")), ["ep"], "t", "w", 2.0),
    }
    whole = {k: sorted(map(repr, f(df).collect())) for k, f in folded.items()}
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in (1, 3, 8):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
            for k, f in folded.items():
                assert sorted(map(repr, f(df).collect())) == whole[k], (k, n)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    for ep in (1, 2, 4, None):
        mine = sorted((t, v) for e, t, v in rows if e == ep)
        want, last, before = [], None, None
        for i, (t, v) in enumerate(mine):
            r = 0.1 if v > 5 else 0.02
            if last is None or r != before or t - last >= 1 / r or i == len(mine) - 1:
                want.append(t)
                last = t
            before = r
        got = folds.downsample_adaptive(df, ["ep"], "t", fast, 1.0).filter(F.col("ep").eqNullSafe(F.lit(ep)))
        assert [x.t for x in got.orderBy("t").collect()] == want
    assert folds.ema(df.limit(0), ["ep"], "t", "v", 0.3).columns == ["ep", "t", "v", "ema"]
    assert folds.debounce(df.limit(0), ["ep"], "t", 1).count() == 0


def test_files_that_begin_with_size_zero(spark):
    """A file that holds a row is closed by a row that overfills it, also if its rows have size 0; NaN overfills; null leaves it open."""
    nan, inf = float("nan"), float("inf")
    sizes = {1: [0.0, 120.0, 3.0], 2: [-5.0, 5.0, 100.0, 1.0], 3: [1.0, None, 100.0, 100.0], 4: [nan, 2.0, 1.0], 5: [1.0, nan, 2.0, 1.0], 6: [inf, -inf, 5.0], 7: [500.0, 0.0, 100.0]}
    rows = [(u, i, x) for u, own in sizes.items() for i, x in enumerate(own)]
    df = spark.createDataFrame(rows, "u long, i long, v double").repartition(3)
    found = {(r.u, r.i): 2 * r.chunk_index + r.file_index for r in folds.rotate_files(df, ["u"], "i", "v", 100.0, 2).collect()}
    files = {u: [found[u, i] for i in range(len(own))] for u, own in sizes.items()}
    assert files == {1: [0, 1, 2], 2: [0, 0, 1, 2], 3: [0, 0, 0, 0], 4: [0, 1, 1], 5: [0, 1, 2, 2], 6: [0, 1, 1], 7: [0, 1, 2]}


def test_delta_indices():
    assert sequence.delta_indices([-0.1, 0, 0.2], 10) == [-1, 0, 2]
    with pytest.raises(ValueError):
        sequence.delta_indices([0.05], 10)


def test_top_runs_prefer_the_latest(spark):
    df = frames(spark, [0, 0, 9, 0, 0, 9, 0, 0])
    runs = sequence.timed_runs(df, ["ep"], "t", F.col("v") < 1)
    assert [r["first"] for r in sequence.top_runs(runs, ["ep"], 2).orderBy("first").collect()] == [3, 6]
    assert sequence.longest_run(runs, ["ep"]).first()["first"] == 0


def test_adaptive_downsampling_keeps_changes_and_the_end(spark):
    df = frames(spark, [0, 0, 0, 1, 1, 1, 1])
    got = folds.downsample_adaptive(df, ["ep"], "t", F.when(F.col("v") == 0, 1.0).otherwise(0.5), 1.0)
    assert [r.t for r in got.orderBy("t").collect()] == [0, 1, 2, 3, 5, 6]


def test_running_sums_when_ranges_are_sampled_badly(spark):
    """More rows than the sample of the ranges sees, and a column that only one use of them reads."""
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", "2")
    try:
        df = spark.range(0, 5000, 1, 8).select(F.col("id").alias("e"), (F.col("id") % 7).alias("n"), F.lit(1).alias("one"), F.col("id").cast("string").alias("x"))
        got = [(r.e, r.x, r.before, r.at) for r in edit.running(df, {"n": "before", "one": "at"}, ["e"]).orderBy("e").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.rangeExchange.sampleSizePerPartition")
    total, want = 0, []
    for e in range(5000):
        want.append((e, str(e), total, e))
        total += e % 7
    assert got == want
    assert edit.running(df.limit(0), {"n": "before"}, ["e"]).count() == 0


def test_intervals_of_whole_times_and_limits_of_batches(spark):
    """At 30 frames a second 33,333,333 ns are an interval; a batch that would reach its size is full, no limit is none."""
    df = frames(spark, [1, 1, 1, 1, 1], [0, 33_333_333, 66_666_665, 66_666_666, 66_666_667])
    got = folds.downsample_adaptive(df, ["ep"], "t", F.lit(30.0), 1e9)
    assert [r.t for r in got.orderBy("t").collect()] == [0, 33_333_333, 66_666_666, 66_666_667]
    assert [r.t for r in folds.downsample_adaptive(df, ["ep"], "t", F.lit(0.0), 1e9).orderBy("t").collect()] == [0, 66_666_667]
    at15 = frames(spark, [1] * 4, [0, 66_666_666, 66_666_667, 66_666_668])
    assert [r.t for r in sequence.downsample(at15, ["ep"], "t", "timestamp", 30, 15, 1e9).orderBy("t").collect()] == [0, 66_666_667, 66_666_668]
    seconds = at15.withColumn("t", F.col("t") / 1e9)
    assert sequence.downsample(seconds, ["ep"], "t", "timestamp", 30, 15, 1.0).count() == 3
    eps = frames(spark, [4, 6, 5, 1, 20])
    batches = lambda *limits: [r.batch for r in folds.pack_batches(eps, ["ep"], "t", "v", 1.0, *limits).orderBy("t").collect()]
    assert batches(10.0, None, None) == [0, 1, 2, 2, 3]
    assert batches(1000.0, 2, None) == [0, 0, 1, 1, 2]
    assert batches(1000.0, None, 10) == [0, 0, 1, 1, 2]


def test_weights_of_nothing_and_of_empty_episodes(spark):
    df = spark.createDataFrame([("a", 1, t) for t in range(3)] + [("b", 2, t) for t in range(2)], "s string, ep long, t long")
    get = lambda ratios, drop: [round(r.weight, 6) for r in weights.sampler_weights(df, "s", ["ep"], "t", ratios, drop).orderBy("s", "t").collect()]
    assert get({"a": 0.25, "b": 0.75}, 1) == [0.125, 0.125, 0, 0.75, 0]
    assert get({"a": 0.25, "b": 0.75}, 2) == [1, 0, 0, 0, 0]
    assert get({"a": 0.25, "b": 0.75}, 5) == get({"a": 0, "b": 0}, 0) == [0.2] * 5
    tasks = spark.createDataFrame([(1, "x", 3, 0), (1, "y", 1, 1), (2, "x", 0, 0), (3, "x", 2, 0), (3, "x", 1, 1), (3, "y", 1, 2)], "ep long, name string, d long, o long")
    got = {r.name: r.proportion for r in weights.temporal_proportions(tasks, "ep", "name", "d", "o").collect()}
    x, y = (3 / 4 + 1 / 4) / 2, (1 / 4 + 1 / 4) / 2
    assert np.allclose([got["x"], got["y"]], [x / (x + y), y / (x + y)]) and len(got) == 2


def test_limits_and_gaps_of_chunks(spark):
    """A change of just the threshold is kept; a plan with gaps weighs by its steps, not by their number."""
    df = frames(spark, [0, 1, 2, 2.9, 4])
    assert column(folds.drop_small_changes(df, ["ep"], "t", {"v": 2.0})) == [0, 2, 4]
    plan = lambda steps, v: spark.createDataFrame([(1, s, v) for s in steps], "k long, step long, v double")
    got = {r.step: r.v for r in queues.merge_smoothstep(plan([1, 2, 6, 8], 0.0), plan(range(4, 14), 1.0), ["k"], "step", "v", 2, 0.5).collect()}
    w = lambda u: 0.5 * (3 * u * u - 2 * u * u * u)
    assert got == {2: 0.0, 4: 1.0, 5: 1.0, 6: w(0.5), 7: 1.0, 8: w(1.0), **{s: 1.0 for s in range(9, 14)}}
    assert {r.step: r.v for r in queues.merge_smoothstep(plan([2], 0.0), plan([2, 3], 1.0), ["k"], "step", "v", 2, 0.5).collect()} == {2: 0.5, 3: 1.0}


def test_even_spread_is_that_of_numpy(spark):
    df = spark.createDataFrame([(n, k) for n in (1, 2, 7, 30, 59, 88, 117, 291) for k in (1, 2, 5, 26, 51, 101) if k <= n], "n int, k int")
    seq = F.sequence(F.lit(0), F.col("k") - 1)
    for r in df.select("*", F.transform(seq, lambda i: F.floor(V.spread(i, F.col("n"), F.col("k")))).alias("low"), stats.sample_positions(F.col("n"), F.col("k")).alias("near")).collect():
        assert r.low == np.linspace(0, r.n - 1, r.k, dtype=int).tolist() and r.near == np.round(np.linspace(0, r.n - 1, r.k)).astype(int).tolist()
    eps = spark.range(30).select(F.lit("s").alias("s"), F.col("id").alias("e"))
    for n in (0, 1, 2, 26, 30, 40):
        want = list(range(30)) if n >= 30 else sorted(set(np.linspace(0, 29, n, dtype=int).tolist()))
        assert [r.e for r in filters.uniform_episodes(eps, n, ["s"], "e").orderBy("e").collect()] == want


def test_split_sizes():
    assert edit.split_sizes(10, {"a": 0.5, "b": 0.2}) == {"a": (0, 5), "b": (5, 10)}
    with pytest.raises(ValueError):
        edit.split_sizes(10, {"a": 0.9, "b": 0.2})
    with pytest.raises(ValueError):
        edit.split_sizes(10, {"a": -0.1})
    assert edit.split_sizes(10, {"a": 0.05, "b": 0.5, "c": 0.0}) == {"b": (0, 5)}
    assert edit.split_sizes(10, {"a": 0.8, "b": 0.19}) == {"a": (0, 8), "b": (8, 10)}
    assert edit.split_sizes(3, {"a": 0.9, "b": 0.1}) == {"a": (0, 2)}


def test_modify_features_protects_required(spark):
    with pytest.raises(ValueError):
        edit.modify_features(frames(spark, [1]).withColumn("index", F.lit(0)), remove=["index"])


def test_merge_pads_and_unifies(spark):
    a = spark.createDataFrame([(0, 0, [1.0], "x"), (0, 1, [2.0], "x")], "episode_index long, t long, s array<double>, task string")
    b = spark.createDataFrame([(5, 0, [3.0, 4.0], "y"), (5, 1, [5.0, 6.0], "x")], "episode_index long, t long, s array<double>, task string")
    rows = edit.merge([a, b], ["t"], pad={"s": 2}).orderBy("index").collect()
    assert [r.episode_index for r in rows] == [0, 0, 1, 1] and [r["index"] for r in rows] == [0, 1, 2, 3]
    assert rows[0].s == [1.0, 0.0] and [r.task_index for r in rows] == [0, 0, 1, 0]


def test_zip_metadata_needs_all(spark):
    a, b = spark.createDataFrame([(0, 1), (1, 2)], "episode_index long, a long"), spark.createDataFrame([(0, 3)], "episode_index long, b long")
    with pytest.raises(Exception, match="missing"):
        edit.zip_metadata([a, b]).collect()


def test_strict_lines(spark):
    good = "100 " + ",".join(["0"] * 16)
    lines = ["100", "x 1,2", "100 1,2", "100 " + ",".join(["0"] * 15 + ["z"]), good]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.value: r.error for r in quality.strict_line_errors(df, "value").collect()}
    assert [got[x] for x in lines] == ["no space", "bad timestamp", "wrong number of values", "not a number", None]


def test_vector_functions(spark):
    one = spark.range(1).select(F.array(*(F.lit(float(i)) for i in (1, 2, 3))).alias("s"), F.array(F.array(*(F.lit(float(i)) for i in (3, 4, 5))), F.array(*(F.lit(float(i)) for i in (5, 6, 7)))).alias("a"))
    mask = V.bool_mask(2, -1)
    r = one.select(V.delta_actions(F.col("a"), F.col("s"), mask).alias("d"), V.absolute_actions(F.col("a"), F.col("s"), mask).alias("b"), V.digitize(F.array(F.lit(-2.0), F.lit(-1.0), F.lit(0.0), F.lit(1.0), F.lit(9.0))).alias("q"), V.clip_dual_arm(F.array_repeat(F.lit(99.0), 16)).alias("c")).first()
    assert r.d == [[2, 2, 5], [4, 4, 7]] and r.b == [[4, 6, 5], [6, 8, 7]]
    assert r.q == [-1, 0, 128, 255, 255] and r.c[7] == r.c[15] == 70.0 and abs(r.c[0] - 3.140592) < 1e-5


def test_rotation_round_trips(spark):
    rnd = np.random.default_rng(0)
    qs = rnd.normal(size=(20, 4))
    qs /= np.linalg.norm(qs, axis=1, keepdims=True)
    qs[qs[:, 3] < 0] *= -1
    df = spark.createDataFrame([(q.tolist(),) for q in qs], "q array<double>")
    for back in (rotation.from_rotation_vector(rotation.axis_angle(F.col("q"))), rotation.from_matrix(rotation.to_matrix(F.col("q")))):
        assert np.allclose([r.b for r in df.select(back.alias("b")).collect()], qs, atol=1e-9)
    unit = [r.b for r in df.select(rotation.compose(F.col("q"), rotation.inverse(F.col("q"))).alias("b")).collect()]
    assert np.allclose(unit, [[0, 0, 0, 1]] * 20)


def test_scalars(spark):
    r = spark.range(1).select(scalar.ns_string(F.lit(1_000_000_005)).alias("a"), scalar.clock_to_sec(F.lit("02:05")).alias("b"), scalar.human_size(F.lit(3 << 30)).alias("c"), scalar.chunk_name(F.lit(2001)).alias("d"), scalar.manifest_time(F.lit("2024-01-01 10:00:00"), "Asia/Shanghai").alias("e"), scalar.task_of_path(F.lit("/x/bot.pick.up.cup.a.b"), "bot").alias("f")).first()
    assert r.a == "1.000000005" and r.b == 125 and r.c == "3.0G" and r.d == "chunk-002" and r.e == "2024-01-01T02:00:00.000Z" and r.f == "pick up cup"


def test_sizes_between_two_tenths(spark):
    """Ties go to the even tenth; no size, no text."""
    sizes = {781_25 << 20: "76.3G", 819_200_000: "781.2MB", 786_432: "0.8MB", 262_144: "0.2MB", 5 << 28: "1.2G", 7 << 28: "1.8G", 0: "0.0MB", -500_000: "-0.5MB", None: None}
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    assert {r.n: r.s for r in df.select("n", scalar.human_size(F.col("n")).alias("s")).collect()} == sizes


def test_ranks_are_met_once_however_often_they_are_told(spark):
    """The side of the join that grows with the table is reduced to its keys first."""
    done = spark.createDataFrame([(r,) for r in [0, 2, 2, 2, 7, -1, None] * 20], "rank long")
    missing = edit.missing_workers(spark, 5, done)
    assert sorted(r["rank"] for r in missing.collect()) == [1, 3, 4]
    absent = edit.absent_episodes(spark.range(4).withColumnRenamed("id", "rank"), done, "rank")
    assert sorted(r["rank"] for r in absent.collect()) == [1, 3]
    for df, n in ((missing, 1), (absent, 2)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == n


def test_queue_merge_rejects_unknown():
    with pytest.raises(ValueError):
        queues.merge_named("best")


def test_degenerate_stats(spark):
    df = spark.createDataFrame([([2.0, 3.0],)], "v array<double>")
    rows = {r.dim: r for r in stats.vector_stats(df, "v").collect()}
    assert rows[0]["std"] == 0 and rows[1].q01 == rows[1].q99 == 3.0


def test_sample_with_replacement(spark):
    df = spark.range(10).withColumnRenamed("id", "index")
    assert filters.sample_with_replacement(df, "index", 10, 25, 3).count() == 25
