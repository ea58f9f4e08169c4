"""Windows and runs over the frames of an episode.

Frames are ordered by ``on`` and then by ``order`` within ``by``.  Everything
here is a window or a grouped aggregate with the episode as key; nothing needs
all rows in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vector as V


def frames(by: Sequence[str], on: str, order: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(on, *order)


def whole(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by)


# -- look-back and look-ahead ------------------------------------------------------------


def delta_windows(df: DataFrame, by, on, value: str, deltas: Sequence[int], order=()) -> DataFrame:
    """``value`` at each offset, clamped to the episode's ends, with a mask that says where it was clamped."""
    w, every = frames(by, on, order), whole(by)
    first, last = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rn, n = F.row_number().over(w), F.count(F.lit(1)).over(every)
    cols = []
    for d in deltas:
        name = f"{value}_{'m' if d < 0 else 'p'}{abs(d)}"
        out = (rn + d < 1) | (rn + d > n)
        at = F.lead(value, d).over(w) if d > 0 else F.lag(value, -d).over(w) if d < 0 else F.col(value)
        cols += [F.when(out, first if d < 0 else last).otherwise(at).alias(name), out.alias(f"{name}_is_pad")]
    return df.select("*", *cols)


def delta_windows_last_seen(df: DataFrame, by, on, value: str, deltas: Sequence[int], order=()) -> DataFrame:
    """As ``delta_windows``, but a miss repeats the last offset that was met in its direction (else the frame itself)."""
    w, every = frames(by, on, order), whole(by)
    rn, n = F.row_number().over(w), F.count(F.lit(1)).over(every)
    cols, seen = [], {-1: F.col(value), 1: F.col(value)}
    for d in sorted(deltas, key=abs):
        name = f"{value}_{'m' if d < 0 else 'p'}{abs(d)}"
        out = (rn + d < 1) | (rn + d > n)
        at = F.lead(value, d).over(w) if d > 0 else F.lag(value, -d).over(w) if d < 0 else F.col(value)
        side = -1 if d < 0 else 1
        seen[side] = F.when(out, seen[side]).otherwise(at)
        cols += [seen[side].alias(name), out.alias(f"{name}_is_pad")]
    return df.select("*", *cols)


def delta_indices(deltas: Sequence[float], fps: float, tolerance: float = 1e-4) -> list[int]:
    """Offsets in frames; an offset that is not a multiple of the frame time is an error."""
    out = []
    for d in deltas:
        if abs(d * fps - round(d * fps)) / fps > tolerance:
            raise ValueError(f"{d} s is no multiple of 1/{fps} s")
        out.append(round(d * fps))
    return out


def action_chunks(df: DataFrame, by, on, value: str, n: int, order=(), name: str = "chunk") -> DataFrame:
    """The next n values, the last one repeated past the end."""
    w = frames(by, on, order)
    ahead = F.collect_list(value).over(w.rowsBetween(0, n - 1))
    return df.withColumn(name, ahead).withColumn(name, F.concat(name, F.array_repeat(F.element_at(name, -1), F.lit(n) - F.size(name))))


def next_value(df: DataFrame, by, on, value: str, order=(), name: str = "action") -> DataFrame:
    """Value of the next frame; the last frame keeps its own."""
    return df.withColumn(name, F.coalesce(F.lead(value).over(frames(by, on, order)), F.col(value)))


def lookahead_change(df: DataFrame, by, on, value: str, steps: int, order=(), name: str = "delta") -> DataFrame:
    """Value ``steps`` ahead (the episode's last beyond it) less the own one."""
    w = frames(by, on, order)
    last = F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    n, rn = F.count(F.lit(1)).over(whole(by)), F.row_number().over(w)
    return df.withColumn(name, F.when(rn + steps > n, last).otherwise(F.lead(value, steps).over(w)) - F.col(value))


def velocity(df: DataFrame, by, on, value: str, dt: float, order=(), name: str = "velocity") -> DataFrame:
    """(x - previous) / dt of a number or a vector; zero on the first frame."""
    w, vector = frames(by, on, order), df.schema[value].dataType.typeName() == "array"
    before = F.coalesce(F.lag(value).over(w), F.col(value))
    change = F.zip_with(value, before, lambda x, y: (x - y) / dt) if vector else (F.col(value) - before) / dt
    return df.withColumn(name, change)


def time_limit(df: DataFrame, by, on, steps: int, order=(), name: str = "truncated") -> DataFrame:
    return df.withColumn(name, F.row_number().over(frames(by, on, order)) >= steps)


def sliding_mean(df: DataFrame, by, on, value: str, width: int, order=(), name: str = "mean") -> DataFrame:
    """Mean of the frame and the width - 1 before; width 0 has no frame and gives null."""
    if width < 1:
        return df.withColumn(name, F.lit(None).cast("double"))
    return df.withColumn(name, F.avg(value).over(frames(by, on, order).rowsBetween(-(width - 1), 0)))


def chunk_mean(df: DataFrame, by, value: str, name: str = "mean") -> DataFrame:
    return df.withColumn(name, F.avg(value).over(whole(by)))


def hold_last(df: DataFrame, by, on, value: str, order=(), name: str = "held") -> DataFrame:
    """Last value that is there; a step without one repeats it."""
    return df.withColumn(name, F.last(value, True).over(frames(by, on, order).rowsBetween(Window.unboundedPreceding, 0)))


def chunk_broker(df: DataFrame, by, on, horizon: int, order=()) -> DataFrame:
    """Which chunk serves a frame, and which of its steps; a new chunk is asked for every ``horizon`` frames."""
    at = F.row_number().over(frames(by, on, order)) - 1
    return df.withColumn("chunk_no", F.floor(at / horizon)).withColumn("step", at % horizon).withColumn("refill", at % horizon == 0)


def replay_chunks(df: DataFrame, by, on, value: str, size: int, order=()) -> DataFrame:
    """Consecutive chunks of ``size`` values, the last one padded with its last value."""
    at = F.row_number().over(frames(by, on, order)) - 1
    keyed = df.withColumn("chunk_no", F.floor(at / size)).withColumn("_at", at)
    out = keyed.groupBy(*by, "chunk_no").agg(F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("v")))).alias("_s"))
    chunk = F.col("_s.v")
    return out.select(*by, "chunk_no", F.concat(chunk, F.array_repeat(F.element_at(chunk, -1), F.lit(size) - F.size(chunk))).alias("chunk"))


def transitions(df: DataFrame, by, on, state: str, done: str | None = None, order=()) -> DataFrame:
    """next_state and done: at a flag or the episode's end, where the state stays its own."""
    w = frames(by, on, order)
    end = F.lead(F.lit(1)).over(w).isNull()
    is_done = end | F.coalesce(F.col(done), F.lit(False)) if done else end
    return df.withColumn("done", is_done).withColumn("next_state", F.when(F.col("done"), F.col(state)).otherwise(F.lead(state).over(w)))


def episodes_by_flag(df: DataFrame, by, on, flag: str, order=()) -> DataFrame:
    """Episode number from a done flag: a new one begins behind each flagged frame."""
    w = frames(by, on, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("episode", F.coalesce(F.sum(F.col(flag).cast("int")).over(w), F.lit(0)).cast("long"))


def sessions_by_control(df: DataFrame, by, on, control: str, order=()) -> DataFrame:
    """Frames between a start (1) and a stop (0 or 2), numbered by session."""
    w = frames(by, on, order).rowsBetween(Window.unboundedPreceding, 0)
    state = F.last(F.when(F.col(control).isin(0, 1, 2), F.col(control)), True).over(w)
    number = F.sum((F.col(control) == 1).cast("int")).over(w)
    return df.withColumn("_state", state).withColumn("session", number.cast("long")).filter("_state = 1").drop("_state")


def ring(df: DataFrame, order: str, capacity: int) -> DataFrame:
    """The newest ``capacity`` rows of a table with a gapless ``order`` number."""
    top = df.agg(F.max(order).alias("_top"))
    return df.crossJoin(F.broadcast(top)).filter(F.col(order) > F.col("_top") - capacity).drop("_top")


# -- interpolation -----------------------------------------------------------------------


def fill_gaps(df: DataFrame, by, on, value: str, order=(), name: str = "filled") -> DataFrame:
    """Linear between the known values around a null or NaN; the ends repeat the nearest known one."""
    known = df.withColumn("_k", F.when(F.isnan(F.col(value).cast("double")), None).otherwise(F.col(value)))
    pair = F.when(F.col("_k").isNotNull(), F.struct(F.col(on).alias("t"), F.col("_k").alias("v")))
    back = F.last(pair, True).over(frames(by, on, order).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.last(pair, True).over(Window.partitionBy(*by).orderBy(F.desc(on), *(F.desc(c) for c in order)).rowsBetween(Window.unboundedPreceding, 0))
    out = known.withColumn("_p", back).withColumn("_n", ahead)
    span = F.col("_n.t") - F.col("_p.t")
    inner = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (F.col(on) - F.col("_p.t")) / F.when(span == 0, None).otherwise(span)
    return out.withColumn(name, F.coalesce("_k", inner, "_p.v", "_n.v")).drop("_k", "_p", "_n")


def pchip(df: DataFrame, by, on, value: str, factor: int, order=()) -> DataFrame:
    """Shape-preserving cubic through the frames at unit spacing, ``factor`` points a step and the last frame.

    Slopes are harmonic means of the steps beside a point, 0 at a turn; at the
    ends the three-point rule, limited so that the curve doesn't overshoot.
    """
    w = frames(by, on, order)
    y = F.col(value).cast("double")
    d = df.withColumn("_y", y).withColumn("_d", F.lead("_y").over(w) - F.col("_y")).withColumn("_c", F.lag("_d").over(w))
    inner = F.when(F.col("_c") * F.col("_d") <= 0, F.lit(0.0)).otherwise(2 * F.col("_c") * F.col("_d") / (F.col("_c") + F.col("_d")))

    def end(near: Column, far: Column) -> Column:
        s = (3 * near - far) / 2
        return F.when(far.isNull(), near).when(s * near <= 0, F.lit(0.0)).when((near * far < 0) & (F.abs(s) > 3 * F.abs(near)), 3 * near).otherwise(s)

    first, last = F.col("_c").isNull(), F.col("_d").isNull()
    m = F.when(first & last, F.lit(0.0)).when(first, end(F.col("_d"), F.lead("_d").over(w))).when(last, end(F.col("_c"), F.lag("_c").over(w))).otherwise(inner)
    d = d.withColumn("_m", m)
    d = d.withColumn("_y1", F.lead("_y").over(w)).withColumn("_m1", F.lead("_m").over(w)).withColumn("key_frame", F.row_number().over(w) - 1)
    d = d.withColumn("sub", F.explode(F.when(F.col("_y1").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(factor - 1)))))
    t = F.col("sub") / float(factor)
    curve = F.col("_y") * (1 + 2 * t) * (1 - t) * (1 - t) + F.col("_m") * t * (1 - t) * (1 - t) + F.col("_y1") * t * t * (3 - 2 * t) + F.col("_m1") * t * t * (t - 1)
    return d.select(*by, "key_frame", "sub", F.coalesce(curve, F.col("_y")).alias("value"))


# -- runs (gaps and islands) ---------------------------------------------------------------


def runs(df: DataFrame, by, on, flag: Column, order=(), keep: Column | None = None) -> DataFrame:
    """Maximal runs of frames with an equal flag: run, flag, first and last frame number and time, length.

    Frames are numbered from 0 in their episode.
    """
    w = frames(by, on, order)
    marked = df.withColumn("_f", flag).withColumn("_i", F.row_number().over(w) - 1)
    marked = marked.withColumn("_run", F.sum(F.coalesce((F.col("_f") != F.lag("_f").over(w)).cast("int"), F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if keep is not None:
        marked = marked.filter(keep)
    return marked.groupBy(*by, "_run").agg(F.first("_f").alias("flag"), F.min("_i").alias("first"), F.max("_i").alias("last"), F.min(on).alias("t0"), F.max(on).alias("t1"), F.count(F.lit(1)).alias("length")).drop("_run")


def median_interval(df: DataFrame, by, on, order=()) -> DataFrame:
    """Median time between frames as a whole number, 1 at least."""
    step = df.select(*by, (F.col(on) - F.lag(on).over(frames(by, on, order))).alias("_s"))
    return step.groupBy(*by).agg(F.greatest(F.coalesce(F.floor(F.percentile("_s", F.lit(0.5))), F.lit(1)), F.lit(1)).alias("interval"))


def timed_runs(df: DataFrame, by, on, flag: Column, order=()) -> DataFrame:
    """Runs of frames where ``flag`` holds, with their duration: last less first plus a median interval."""
    every = runs(df, by, on, flag, order).filter("flag").drop("flag")
    return every.join(median_interval(df, by, on, order), list(by)).withColumn("duration", F.col("t1") - F.col("t0") + F.col("interval"))


def least_frames(seconds: float, interval: Column, unit: float) -> Column:
    """Frames that last ``seconds`` (``unit`` a second), rounded half to even, 2 at least."""
    return F.greatest(F.lit(2), F.bround(F.lit(seconds * unit) / interval).cast("long"))


def longest_run(runs_: DataFrame, by) -> DataFrame:
    """Greatest duration, the earliest of equal ones."""
    w = Window.partitionBy(*by).orderBy(F.desc("duration"), "first")
    return runs_.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def top_runs(runs_: DataFrame, by, k: int) -> DataFrame:
    """The k longest; of equal ones those that start latest."""
    w = Window.partitionBy(*by).orderBy(F.desc("duration"), F.desc("first"))
    return runs_.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def motion_score(df: DataFrame, by, on, vector: str, order=(), quantile: float = 0.95, floor: float = 1e-4) -> DataFrame:
    """Greatest change since the frame before, each element over its own scale: the quantile of its changes, floored."""
    w = frames(by, on, order)
    d = df.withColumn("_d", F.zip_with(V.doubles(F.col(vector)), V.doubles(F.lag(vector).over(w)), lambda x, y: F.abs(x - y)))
    scales = d.select(*by, F.posexplode("_d").alias("_e", "_x")).groupBy(*by, "_e").agg(F.greatest(F.percentile("_x", F.lit(quantile)), F.lit(floor)).alias("_s"))
    scales = scales.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_e", "_s"))).alias("_scales"))
    out = d.join(scales, list(by), "left")
    return out.withColumn("motion", F.coalesce(F.array_max(F.zip_with("_d", F.col("_scales._s"), lambda x, s: x / s)), F.lit(0.0))).drop("_d", "_scales")


def static_runs(df: DataFrame, by, on, vector: str, seconds: float, threshold: float, unit: float, guard: int = 0, order=(), **scale) -> DataFrame:
    """Runs of frames that hardly move and last long enough, their end cut by ``guard`` frames."""
    scored = motion_score(df, by, on, vector, order, **scale)
    still = timed_runs(scored, by, on, F.col("motion") < threshold, order)
    long_ = still.filter(F.col("length") >= least_frames(seconds, F.col("interval"), unit))
    return long_.withColumn("last", F.col("last") - guard).filter("last >= first")


def contact_runs(df: DataFrame, by, on, gripper: Column, close: float, seconds: float, unit: float, k: int, static: DataFrame | None = None, order=()) -> DataFrame:
    """Runs with a closed gripper, and why each is kept or not; the k longest that end before the longest static run."""
    found = timed_runs(df, by, on, gripper <= close, order)
    enough = F.col("length") >= least_frames(seconds, F.col("interval"), unit)
    if static is not None:
        cut = longest_run(static, by).select(*by, F.col("first").alias("_cut"))
        found = found.join(cut, list(by), "left")
        enough_before = F.col("_cut").isNull() | (F.col("last") < F.col("_cut"))
    else:
        enough_before = F.lit(True)
    found = found.withColumn("reason", F.when(~enough, "too_short").when(~enough_before, "not_before_static").otherwise("candidate"))
    w = Window.partitionBy(*by, "reason").orderBy(F.desc("duration"), F.desc("first"))
    rank = F.row_number().over(w)
    return found.withColumn("reason", F.when(F.col("reason") != "candidate", F.col("reason")).when(rank <= k, "kept").otherwise("not_among_longest")).drop("_cut")


def idle_keep_ranges(df: DataFrame, by, on, vector: Column, order=(), eps: float = 1e-3, min_idle: int = 7, min_keep: int = 16, cut_last: int = 10) -> DataFrame:
    """[start, end) of frames worth keeping: idle runs of ``min_idle`` go, what is left keeps runs of ``min_keep`` less their last frames."""
    w = frames(by, on, order)
    v = df.withColumn("_v", vector).withColumn("_before", F.lag("_v").over(w))
    idle = F.coalesce(F.forall(F.zip_with("_v", "_before", lambda x, y: F.abs(x - y) < eps), lambda x: x), F.lit(False))
    v = v.withColumn("_idle", idle).withColumn("_n", F.row_number().over(w) - 1)
    change = F.coalesce((F.col("_idle") != F.lag("_idle").over(w)).cast("int"), F.lit(1))
    v = v.withColumn("_run", F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    v = v.withColumn("_keep", ~(F.col("_idle") & (F.count(F.lit(1)).over(Window.partitionBy(*by, "_run")) >= min_idle)))
    kept = runs(v, by, on, F.col("_keep"), order).filter("flag").filter(F.col("length") >= min_keep)
    return kept.select(*by, F.col("first").alias("start"), (F.col("last") + 1 - cut_last).alias("end")).filter("start < end")


def two_end_trim(df: DataFrame, by, on, values: dict[str, float], order=(), least: int = 2) -> DataFrame:
    """Drop the longest static head, and then the longest static tail of the rest.

    Static: no value leaves its threshold's range (max - min).  Runs under
    ``least`` frames stay.  An episode that never moves goes as a whole.
    """
    w = frames(by, on, order)
    back = Window.partitionBy(*by).orderBy(F.desc(on), *(F.desc(c) for c in order))

    def still(spec: WindowSpec) -> Column:
        upto = spec.rowsBetween(Window.unboundedPreceding, 0)
        return V.all_of([F.max(c).over(upto) - F.min(c).over(upto) <= thr for c, thr in values.items()])

    head = df.withColumn("_s", still(w)).withColumn("_n", F.sum(F.col("_s").cast("int")).over(whole(by)))
    rest = head.filter(~(F.col("_s") & (F.col("_n") >= least))).drop("_s", "_n")
    tail = rest.withColumn("_s", still(back)).withColumn("_n", F.sum(F.col("_s").cast("int")).over(whole(by)))
    return tail.filter(~(F.col("_s") & (F.col("_n") >= least))).drop("_s", "_n")


# -- downsampling ----------------------------------------------------------------------------


def downsample_by_time(df: DataFrame, by, on, interval: float, order=()) -> DataFrame:
    """First frame of each interval since the episode's first, and its last frame."""
    w = frames(by, on, order)
    bucket = F.floor((F.col(on) - F.min(on).over(whole(by))) / interval)
    d = df.withColumn("_b", bucket)
    keep = F.lag("_b").over(w).isNull() | (F.col("_b") != F.lag("_b").over(w)) | F.lead("_b").over(w).isNull()
    return d.withColumn("_k", keep).filter("_k").drop("_b", "_k")


def downsample_by_stride(df: DataFrame, by, on, source_fps: float, target_fps: float, order=()) -> DataFrame:
    """Every round(source / target)-th frame (half to even, 1 at least), and the last."""
    stride, w = max(1, round(source_fps / target_fps)), frames(by, on, order)
    keep = ((F.row_number().over(w) - 1) % stride == 0) | F.lead(F.lit(1)).over(w).isNull()
    return df.withColumn("_k", keep).filter("_k").drop("_k")


def downsample(df: DataFrame, by, on, mode: str, source_fps: float, target_fps: float, unit: float, order=(), classes: Column | None = None) -> DataFrame:
    """Checked choice of a mode; a target at or over the source changes nothing, except in adaptive mode."""
    if source_fps <= 0 or target_fps <= 0:
        raise ValueError("frame rates must be positive")
    if mode == "adaptive":
        from . import folds

        if classes is None:
            raise ValueError("adaptive mode needs the frames' rates")
        return folds.downsample_adaptive(df, by, on, classes, unit, order)
    if mode not in ("timestamp", "stride"):
        raise ValueError(f"unknown mode {mode!r}")
    if target_fps >= source_fps:
        return df
    interval = round(unit / target_fps) if isinstance(df.schema[on].dataType, T.IntegralType) else unit / target_fps
    return downsample_by_time(df, by, on, interval, order) if mode == "timestamp" else downsample_by_stride(df, by, on, source_fps, target_fps, order)


# -- checks ------------------------------------------------------------------------------------


def backward_steps(df: DataFrame, by, on, arrival: str) -> DataFrame:
    """Frames whose time is before that of the frame that arrived before them."""
    before = F.lag(on).over(Window.partitionBy(*by).orderBy(arrival))
    return df.withColumn("before", before).filter(F.col(on) < F.col("before"))


def off_rate(df: DataFrame, by, on, period: float, tolerance: float, order=()) -> DataFrame:
    """Frames whose distance to the one before is off the period by more than the tolerance; episode edges don't count."""
    d = df.withColumn("step", F.col(on) - F.lag(on).over(frames(by, on, order)))
    return d.filter(F.abs(F.col("step") - period) > tolerance)


def frame_gaps(df: DataFrame, by, on, order=()) -> DataFrame:
    return df.withColumn("dt", F.col(on) - F.lag(on).over(frames(by, on, order)))


def fps_metric(df: DataFrame, by, on, unit: float, order=()) -> DataFrame:
    """(n - 1) / (t - t0) up to each frame."""
    n = F.row_number().over(frames(by, on, order))
    span = (F.col(on) - F.min(on).over(whole(by))) / unit
    return df.withColumn("fps", F.when(span > 0, (n - 1) / span).otherwise(F.lit(0.0)))


def running_mean(df: DataFrame, by, on, value: str, order=()) -> DataFrame:
    """Value, sum, count and mean up to each frame."""
    w = frames(by, on, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("sum", F.sum(value).over(w)).withColumn("count", F.count(value).over(w)).withColumn("avg", F.avg(value).over(w))


def mean_period(df: DataFrame, by, on) -> DataFrame:
    """(last - first) / (n - 1) of each episode; null for a single frame."""
    n = df.groupBy(*by).agg(F.min(on).alias("_a"), F.max(on).alias("_b"), F.count(F.lit(1)).alias("n_frames"))
    return n.select(*by, "n_frames", F.when(F.col("n_frames") > 1, (F.col("_b") - F.col("_a")) / (F.col("n_frames") - 1)).alias("period"))


def next_index(df: DataFrame, index: str) -> DataFrame:
    """Greatest index of all rows, and the one to go on with; -1 and 0 without any."""
    return df.agg(F.coalesce(F.max(index), F.lit(-1)).cast("long").alias("max_index")).withColumn("next_index", F.col("max_index") + 1)


def around(df: DataFrame, by, on, value: str, history: int, lookahead: int, order=(), name: str = "around") -> DataFrame:
    """Up to ``history`` values before and ``lookahead`` after each frame, as arrays in time order; at the ends there are fewer."""
    w = frames(by, on, order)
    back = F.collect_list(value).over(w.rowsBetween(-history, -1)) if history else F.array()
    ahead = F.collect_list(value).over(w.rowsBetween(1, lookahead)) if lookahead else F.array()
    return df.withColumn(f"{name}_before", back).withColumn(f"{name}_after", ahead)


def linear(df: DataFrame, by, on, value: str, factor: int, order=()) -> DataFrame:
    """Straight lines through the frames at unit spacing, ``factor`` points a step and the last frame."""
    w = frames(by, on, order)
    d = df.withColumn("_y", F.col(value).cast("double")).withColumn("_y1", F.lead(F.col(value).cast("double")).over(w)).withColumn("key_frame", F.row_number().over(w) - 1)
    d = d.withColumn("sub", F.explode(F.when(F.col("_y1").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(factor - 1)))))
    return d.select(*by, "key_frame", "sub", F.coalesce(F.col("_y") + (F.col("_y1") - F.col("_y")) * F.col("sub") / float(factor), F.col("_y")).alias("value"))
