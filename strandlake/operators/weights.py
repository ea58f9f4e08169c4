"""Weights of frames for samplers and losses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sampler_weights(df: DataFrame, source: str, by, on, ratios: dict, drop_last: int = 0, order=()) -> DataFrame:
    """Each source's ratio spread over its frames that count; the last frames of an episode don't; all add up to 1.

    Where no frame counts, or none with a ratio, all weigh the same.
    """
    back = Window.partitionBy(*by).orderBy(F.desc(on), *(F.desc(c) for c in order))
    d = df.withColumn("valid", F.row_number().over(back) > drop_last)
    n = d.groupBy(source).agg(F.sum(F.col("valid").cast("long")).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    share = F.lit(None).cast("double")
    for k, r in ratios.items():
        share = F.when(F.col(source) == k, F.lit(float(r))).otherwise(share)
    n = n.withColumn("_r", F.coalesce(share, F.lit(0.0)))
    whole = n.agg(F.sum(F.when(F.col("_n") > 0, F.col("_r")).otherwise(F.lit(0.0))).alias("_all"), F.sum("_rows").alias("_every"))
    weight = F.when(F.col("_all") == 0, 1 / F.col("_every")).when(F.col("valid"), F.col("_r") / F.col("_n") / F.col("_all")).otherwise(F.lit(0.0))
    n = n.drop("_rows").withColumnRenamed(source, "_source")
    return d.join(F.broadcast(n.crossJoin(whole)), F.col(source).eqNullSafe(F.col("_source"))).withColumn("weight", weight).drop("_source", "_n", "_r", "_all", "_every")


def progress_weight(delta: Column, kappa: float, mean: Column, std: Column, fallback: float = 1.0, eps: float = 1e-6) -> Column:
    """1 above kappa, a soft clip around mean +- 2 std below it, 0 for a loss of progress; null and NaN fall back."""
    lower, upper = mean - 2 * std, mean + 2 * std
    soft = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (delta - lower) / (upper - lower + eps)))
    return F.when(delta.isNull() | F.isnan(delta), F.lit(fallback)).when(delta > kappa, F.lit(1.0)).when(delta < 0, F.lit(0.0)).otherwise(soft)


def progress_stats(df: DataFrame, delta: str, eps: float = 1e-6) -> DataFrame:
    """Mean (0 at least) and deviation (eps at least) of the changes."""
    ok = df.filter(F.col(delta).isNotNull() & ~F.isnan(F.col(delta)))
    return ok.agg(F.greatest(F.avg(delta), F.lit(0.0)).alias("mean"), F.greatest(F.stddev_pop(delta), F.lit(eps)).alias("std"))


def normalised(df: DataFrame, weight: str, batch: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """Weights of each batch, scaled to add up to its size."""
    w = Window.partitionBy(*batch)
    return df.withColumn(weight, F.col(weight) * F.count(F.lit(1)).over(w) / (F.sum(weight).over(w) + eps))


def temporal_proportions(subtasks: DataFrame, episode: str, name: str, duration: str, order: str) -> DataFrame:
    """Mean share of each subtask over episodes, scaled to add up to 1.

    Of a name that repeats in an episode the last duration counts, while all
    durations are in the episode's total.  Episodes without duration don't count.
    """
    every = subtasks.groupBy(episode).agg(F.sum(duration).alias("_all"))
    last = subtasks.groupBy(episode, name).agg(F.max_by(duration, order).alias("_d"))
    share = last.join(every.filter("_all > 0"), episode).withColumn("_s", F.col("_d") / F.col("_all"))
    mean = share.groupBy(name).agg(F.avg("_s").alias("_m"))
    total = mean.agg(F.sum("_m").alias("_t"))
    return mean.crossJoin(F.broadcast(total)).select(name, F.when(F.col("_t") > 0, F.col("_m") / F.col("_t")).otherwise(F.col("_m")).alias("proportion"))
