"""Annotations, progress, transitions and strict look-ups of frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import asof, sequence


def nearest_or_error(queries: DataFrame, frames: DataFrame, by, on, value: str, tolerance, bucket=None) -> DataFrame:
    """Nearest frame, strictly nearer than the tolerance; a miss is an error."""
    out = asof.asof_nearest(queries, frames, by, on, [value], "r_", tolerance=tolerance, inclusive=False, bucket=bucket)
    missing = F.raise_error(F.concat(F.lit("no frame near "), F.col(on).cast("string")))
    return out.withColumn("r_t", F.coalesce("r_t", missing.cast(out.schema["r_t"].dataType)))


def nearest_with_mask(queries: DataFrame, frames: DataFrame, by, on, value: str, tolerance, strict: bool = False, bucket=None) -> DataFrame:
    """Nearest frame of the episode whatever its distance; ``is_pad`` where it is too far.

    With ``strict`` a far frame inside the episode's own range is an error.
    """
    out = asof.asof_nearest(queries, frames, by, on, [value], "r_", bucket=bucket).withColumn("is_pad", F.abs(F.col("r_t") - F.col(on)) > tolerance)
    if strict:
        ends = frames.groupBy(*by).agg(F.min(on).alias("_lo"), F.max(on).alias("_hi"))
        inside = F.col("is_pad") & (F.col(on) >= F.col("_lo")) & (F.col(on) <= F.col("_hi"))
        out = out.join(ends, list(by), "left").withColumn("is_pad", F.when(inside, F.raise_error(F.lit("a frame is missing inside the episode")).cast("boolean")).otherwise(F.col("is_pad"))).drop("_lo", "_hi")
    return out


def annotate(eps: DataFrame, marks: DataFrame, fps: float, prefix: str = "", episode: str = "episode_index") -> DataFrame:
    """Subtask names, times and frames (whole part of seconds x fps) as arrays on the episodes."""
    steps = marks.groupBy(episode).agg(F.array_sort(F.collect_list(F.struct("start", "end", "name"))).alias("_s"))
    p = f"{prefix}_" if prefix else ""
    frame = lambda c: F.transform(F.col(c), lambda x: (x * fps).cast("long"))
    cols = {f"{p}subtask_names": F.col("_s.name"), f"{p}subtask_start_times": F.col("_s.start"), f"{p}subtask_end_times": F.col("_s.end"), f"{p}subtask_start_frames": frame("_s.start"), f"{p}subtask_end_frames": frame("_s.end")}
    return eps.join(steps, episode, "left").withColumns(cols).drop("_s")


def annotations(eps: DataFrame, prefix: str = "", episode: str = "episode_index") -> DataFrame:
    """Back to one row a subtask; columns without the prefix serve where the prefixed ones are not there."""
    p = f"{prefix}_" if prefix and f"{prefix}_subtask_names" in eps.columns else ""
    names = ["names", "start_times", "end_times", "start_frames", "end_frames"]
    rows = eps.select(episode, F.posexplode(F.arrays_zip(*(F.col(f"{p}subtask_{n}").alias(n) for n in names))).alias("order", "s"))
    return rows.select(episode, "order", *(F.col(f"s.{n}").alias(n) for n in names))


def strided_progress(frames: DataFrame, by, on, progress: str, stride: int, order=()) -> DataFrame:
    """Progress known at every ``stride``-th frame only, linear between."""
    at = F.row_number().over(sequence.frames(by, on, order)) - 1
    known = frames.withColumn("_known", F.when(at % stride == 0, F.col(progress)))
    return sequence.fill_gaps(known, by, on, "_known", order, name="progress_filled").drop("_known")


def split_transitions(df: DataFrame, vectors: Sequence[str], intervention: str) -> tuple[DataFrame, DataFrame]:
    """Transitions without NaN, and of them those that a person made."""
    bad = F.lit(False)
    for v in vectors:
        bad = bad | F.coalesce(F.exists(F.col(v), lambda x: F.isnan(x)), F.lit(False))
    ok = df.filter(~bad)
    return ok, ok.filter(F.col(intervention))


def classified_reward(df: DataFrame, probability: Column, threshold: float = 0.5, reward: float = 1.0, terminate: bool = True) -> DataFrame:
    """Reward (and end) where a classifier's success probability reaches the threshold."""
    success = probability >= threshold
    out = df.withColumn("reward", F.when(success, F.lit(reward)).otherwise(F.col("reward")))
    return out.withColumn("done", F.col("done") | success) if terminate else out


def key_frames(df: DataFrame, by, on, value: str, mode: str, order=(), step: int = 5, factor: int = 5) -> DataFrame:
    """Resampling modes: all, every ``step``-th and the last, or ``factor`` points a step by the shape-preserving cubic."""
    if mode == "identity":
        return df
    if mode == "every":
        return sequence.downsample_by_stride(df, by, on, step, 1, order)
    if mode == "pchip":
        return sequence.pchip(df, by, on, value, factor, order)
    if mode == "delayed":  # a gripper that acts ``step`` frames late
        w = Window.partitionBy(*by).orderBy(on, *order)
        first = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumn(value, F.coalesce(F.lag(value, step).over(w), first))
    raise ValueError(f"unknown mode {mode!r}")
