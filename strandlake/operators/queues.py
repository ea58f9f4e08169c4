"""Merges of action queues: a standing plan meets a new one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of the merges, and the weights of the old and the new value.
WEIGHTS = {"weighted_average": (0.3, 0.7), "latest_only": (0.0, 1.0), "average": (0.5, 0.5), "conservative": (0.7, 0.3)}


def _weighted(standing: float, coming: float) -> Callable[[Column, Column], Column]:
    if not standing:  # a null or NaN in the old plan must not reach the new one
        return lambda old, new: new * coming
    return lambda old, new: F.lit(standing) * old + F.lit(coming) * new


MERGES = {name: _weighted(*w) for name, w in WEIGHTS.items()}


def merge_named(name: str) -> Callable[[Column, Column], Column]:
    if name not in MERGES:
        raise ValueError(f"unknown merge {name!r}; there are {sorted(MERGES)}")
    return MERGES[name]


def merge_by_step(old: DataFrame, new: DataFrame, key: list[str], step: str, value: str, latest: int | Column, how: str = "weighted_average") -> DataFrame:
    """Steps behind ``latest``: merged where both have one, else the new; steps of the old plan alone go."""
    fn = merge_named(how)
    o = old.select(*key, step, F.col(value).alias("_old"))
    n = new.select(*key, step, F.col(value).alias("_new")).filter(F.col(step) > latest)
    return n.join(o, [*key, step], "left").select(*key, step, F.coalesce(fn(F.col("_old"), F.col("_new")), F.col("_new")).alias(value))


def merge_smoothstep(old: DataFrame, new: DataFrame, key: list[str], step: str, value: str, now: int, alpha: float = 1.0) -> DataFrame:
    """Steps from ``now`` on; the new plan's weight rises as alpha (3u^2 - 2u^3) from its first step to where the shorter plan ends.

    A step of one plan alone stays as it is; an overlap of one step weighs alpha.
    """
    o = old.select(*key, step, F.col(value).alias("_old")).filter(F.col(step) >= now)
    n = new.select(*key, step, F.col(value).alias("_new")).filter(F.col(step) >= now)
    w = Window.partitionBy(*key)
    steps = lambda c: F.when(F.col(c).isNotNull(), F.col(step))
    both = o.join(n, [*key, step], "full").withColumn("_lo", F.min(steps("_new")).over(w)).withColumn("_hi", F.least(F.max(steps("_old")).over(w), F.max(steps("_new")).over(w)))
    u = (F.col(step) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    weight = F.when(F.col("_hi") <= F.col("_lo"), F.lit(alpha)).otherwise(alpha * (3 * u * u - 2 * u * u * u))
    merged = F.when(F.col("_old").isNotNull() & F.col("_new").isNotNull(), (1 - weight) * F.col("_old") + weight * F.col("_new")).otherwise(F.coalesce("_new", "_old"))
    return both.select(*key, step, merged.alias(value))


def should_refill(queue_size: Column, chunk_size: Column, threshold: float) -> Column:
    return queue_size / F.greatest(F.lit(1), chunk_size) <= threshold
