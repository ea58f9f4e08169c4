"""Quality checks of recorded episodes, and the report of the first that fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vector as V


def stream_counts(df: DataFrame, by: Sequence[str], stream: str, names: Sequence[str]) -> DataFrame:
    """One column a stream with its rows, and the total."""
    return df.groupBy(*by).agg(*(F.sum((F.col(stream) == n).cast("long")).alias(f"n_{n}") for n in names), F.count(F.lit(1)).alias("n_total"))


def relative_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.when(a == 0, None).otherwise(a)


def camera_check(counts: DataFrame, base: str, others: Sequence[str], limit: float = 0.03) -> DataFrame:
    """Message of the first camera check that fails: no base frames, or a count too far from the base's."""
    message = F.when(F.col(f"n_{base}") == 0, F.lit(f"{base}: no frames"))
    for o in others:
        message = message.when(relative_difference(F.col(f"n_{base}"), F.col(f"n_{o}")) > limit, F.lit(f"{base} and {o}: frame counts differ"))
    return counts.withColumn("camera_error", message)


def depth_check(counts: DataFrame, color: str, depth: str, limit: float = 0.03) -> DataFrame:
    """Colour against depth; a stream without depth frames is not checked."""
    off = (F.col(f"n_{depth}") > 0) & (relative_difference(F.col(f"n_{color}"), F.col(f"n_{depth}")) > limit)
    return counts.withColumn("depth_error", F.when(off, F.lit(f"{color} and {depth}: frame counts differ")))


def gap_ratio(df: DataFrame, by, on, most: float, order=()) -> DataFrame:
    """Share of steps of at most ``most``; an episode of one row has none."""
    step = F.col(on) - F.lag(on).over(Window.partitionBy(*by).orderBy(on, *order))
    return df.select(*by, step.alias("_s")).groupBy(*by).agg(F.count("_s").alias("n_steps"), F.avg((F.col("_s") <= most).cast("double")).alias("ok_ratio"))


def gripper_errors(df: DataFrame, by, on, action: str, width: str, eps_close: float = 5.0, eps_open: float = 1.0, top: float = 70.0, order=()) -> DataFrame:
    """First check that an episode's gripper fails, and the time of its first row: action not 0 (close) or 1 (open),
    width out of range, closing while the width grows, opening while it shrinks.  A check is made on all rows before the next."""
    w = Window.partitionBy(*by).orderBy(on, *order)
    d = df.withColumn("_before", F.lag(width).over(w))
    checks = [
        (~F.col(action).isin(0, 1), "action is neither 0 nor 1"),
        ((F.col(width) < 0) | (F.col(width) > top), "width out of range"),
        ((F.col(action) == 0) & (F.col("_before") + eps_close < F.col(width)), "closing, but the width grows"),
        ((F.col(action) == 1) & (F.col("_before") - eps_open > F.col(width)), "opening, but the width shrinks"),
    ]
    failed = F.coalesce(*(F.when(bad, F.struct(F.lit(i).alias("check"), F.lit(text).alias("error"))) for i, (bad, text) in enumerate(checks)))
    bad = d.withColumn("_f", failed).filter("_f IS NOT NULL")
    first = F.struct("_f.check", on, *order)
    return bad.groupBy(*by).agg(F.min_by("_f.error", first).alias("error"), F.min_by(on, first).alias("at"))


def strict_line_errors(lines: DataFrame, text: str, dims: int = 16) -> DataFrame:
    """Why a log line can't be read: no space, bad time, wrong number of values, a value that is no number."""
    p = F.split(F.col(text), " ", 2)
    values = F.split(F.get(p, F.lit(1)), ",")
    error = F.when(F.size(p) < 2, "no space").when(F.expr("try_cast(_p[0] AS BIGINT)").isNull(), "bad timestamp").when(F.size("_v") != dims, "wrong number of values").when(F.exists(F.transform("_v", lambda x: x.try_cast("double")), lambda x: x.isNull()), "not a number")
    return lines.withColumn("_p", p).withColumn("_v", values).withColumn("error", error).drop("_p", "_v")


def limits_ok(a: Column, low: Sequence[float], high: Sequence[float]) -> Column:
    """All elements inside their limits."""
    lo, hi = F.array(*map(F.lit, low)), F.array(*map(F.lit, high))
    return F.forall(F.transform(a, lambda x, i: (x >= F.get(lo, i)) & (x <= F.get(hi, i))), lambda ok: ok)


def report(df: DataFrame, key: str, checks: Sequence[str]) -> DataFrame:
    """result and fail_error: the first check's message that is not null."""
    error = F.coalesce(*(F.col(c) for c in checks))
    return df.select(F.col(key).alias("sub_task_id"), F.when(error.isNull(), "pass").otherwise("failed").alias("result"), F.coalesce(error, F.lit("")).alias("fail_error"))


def skip_reason(counts: DataFrame, images: Sequence[str], arms: Sequence[str], least_images: int, least_head: int, head: str) -> DataFrame:
    few = F.lit(False)
    for c in images:
        few = few | (F.col(c) < least_images)
    none = F.lit(False)
    for c in arms:
        none = none | (F.col(c) == 0)
    return counts.withColumn("skip_reason", F.when(few, "not_enough_images").when(none, "missing_arm_data").when(F.col(head) < least_head, "head_sequence_too_short"))


def episode_summary(frames: DataFrame, by, on, classes: str, diff: str, reason: str, order=()) -> DataFrame:
    """Greatest alignment difference and step, frames by class, and the reasons joined by ``|``."""
    step = F.col(on) - F.lag(on).over(Window.partitionBy(*by).orderBy(on, *order))
    d = frames.withColumn("_s", step)
    return d.groupBy(*by).agg(F.max(diff).alias("max_align_diff"), F.max("_s").alias("max_dt"), F.count(F.lit(1)).alias("n_frames"), F.sum((F.col(classes) == "static").cast("long")).alias("n_static"), F.concat_ws("|", F.array_sort(F.collect_set(reason))).alias("reasons"))


def schema_errors(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Missing, extra and wrongly typed columns, by their types' short names."""
    have = dict(df.dtypes)
    out = [f"missing column {c}" for c in expected if c not in have]
    out += [f"extra column {c}" for c in have if c not in expected]
    return out + [f"column {c}: {have[c]}, expected {t}" for c, t in expected.items() if c in have and have[c] != t]


def conform(df: DataFrame, template: dict[str, str]) -> DataFrame:
    """Cast to the template's columns and types."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in template.items()))


def sampled_frames(df: DataFrame, by, on, ratio: float = 0.05, least: int = 5, order=()) -> DataFrame:
    """max(least, ceil(ratio n)) frames of each episode, spread evenly with both ends."""
    w, every = Window.partitionBy(*by).orderBy(on, *order), Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(every)
    k = F.least(n, F.greatest(F.lit(least), F.ceil(n * ratio)))
    d = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", n).withColumn("_k", k)
    at = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1), lambda i: F.floor(V.spread(i, F.col("_n"), F.col("_k"))))
    return d.filter(F.array_contains(at, F.col("_i").cast("long"))).drop("_i", "_n", "_k")


def inspect(lines: DataFrame, cameras: Sequence[str], base: str, color: str, depth: str, gap_ns: int = 15_000_000, least_ratio: float = 0.99, gripper: bool = False) -> DataFrame:
    """Pass or fail of whole recordings (episode, stream, value as text): the first check that fails, in a fixed order.

    Camera counts, colour against depth, missing joint files, unreadable lines,
    joint gaps; with ``gripper`` also the grippers' values.
    """
    arms = ("left", "right")
    counts = stream_counts(lines, ["episode"], "stream", [*cameras, *arms])
    out = depth_check(camera_check(counts, base, [c for c in cameras if c not in (base, depth)]), color, depth)
    missing = F.lit(None).cast("string")
    for a in reversed(arms):
        missing = F.when(F.col(f"n_{a}") == 0, F.lit(f"{a}: no joint data")).otherwise(missing)
    out = out.withColumn("joint_missing", missing)
    joints = strict_line_errors(lines.filter(F.col("stream").isin(*arms)), "value")
    bad = joints.groupBy("episode").agg(F.min("error").alias("line_error"))
    ok = joints.filter("error IS NULL").withColumn("t", F.split("value", " ")[0].cast("long")).withColumn("v", F.split(F.split("value", " ")[1], ",").cast("array<double>"))
    gaps = gap_ratio(ok, ["episode", "stream"], "t", gap_ns).groupBy("episode").agg(F.min("ok_ratio").alias("_r"))
    gaps = gaps.select("episode", F.when(F.col("_r") < least_ratio, "joint gaps").alias("gap_error"))
    out = out.join(bad, "episode", "left").join(gaps, "episode", "left")
    checks = ["camera_error", "depth_error", "joint_missing", "line_error", "gap_error"]
    if gripper:
        g = gripper_errors(ok.withColumn("_a", F.get("v", F.lit(7))).withColumn("_w", F.get("v", F.lit(8))), ["episode", "stream"], "t", "_a", "_w")
        out = out.join(g.groupBy("episode").agg(F.min("error").alias("gripper_error")), "episode", "left")
        checks.append("gripper_error")
    return report(out, "episode", checks)


def parquet_report(spark, paths: Sequence[str], expected: dict[str, str]) -> list[tuple[str, list[str]]]:
    """Schema errors of each file, from its footer alone."""
    return [(p, schema_errors(spark.read.parquet(p), expected)) for p in paths]
