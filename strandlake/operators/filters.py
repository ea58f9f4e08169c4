"""Selections of frames and episodes, and samples of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shuffling import draw

from ..functions import vector as V


def drop_edges(df: DataFrame, by, on, first: int, last: int, order=(), whole_if_short: bool = False) -> DataFrame:
    """Without the first and last frames of each episode; ``whole_if_short`` drops episodes that have no more than those."""
    w = Window.partitionBy(*by).orderBy(on, *order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    d = df.withColumn("_i", F.row_number().over(w)).withColumn("_n", n)
    out = d.filter((F.col("_i") > first) & (F.col("_i") <= F.col("_n") - last))
    return (out.filter(F.col("_n") > first + last) if whole_if_short else out).drop("_i", "_n")


def full_match(col: Column, pattern: str) -> Column:
    return col.rlike(f"^(?:{pattern})$")


def keep_ranges(frames: DataFrame, ranges: DataFrame, key: str, step: str) -> DataFrame:
    """Frames whose step is in [start, end) of a range of their key: a semi-join on the key."""
    r = ranges.select(F.col(key).alias("_k"), "start", "end")
    return frames.join(r, (F.col(key) == F.col("_k")) & (F.col(step) >= F.col("start")) & (F.col(step) < F.col("end")), "left_semi")


def mask_frames(frames: DataFrame, mask: DataFrame | None, key: str, step: str) -> DataFrame:
    """Frames that the mask (key, step, keep) allows; all without a mask."""
    return frames if mask is None else frames.join(mask.filter("keep").select(key, step), [key, step], "left_semi")


def first_episodes(eps: DataFrame, n: int, source: Sequence[str], episode: str) -> DataFrame:
    w = Window.partitionBy(*source).orderBy(episode)
    return eps.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def uniform_episodes(eps: DataFrame, n: int, source: Sequence[str], episode: str) -> DataFrame:
    """About n episodes of each source, spread evenly, both ends included; none for n of 0."""
    if n < 1:
        return eps.limit(0)
    w = Window.partitionBy(*source).orderBy(episode)
    d = eps.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*source)))
    spots = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(V.spread(i, F.col("_n"), F.lit(n))))
    return d.filter((F.col("_n") <= n) | F.array_contains(spots, F.col("_i").cast("long"))).drop("_i", "_n")


def batches(df: DataFrame, by, on, size: int, order=(), drop_last: bool = False) -> DataFrame:
    """Number of the batch of each frame of an episode."""
    i = F.row_number().over(Window.partitionBy(*by).orderBy(on, *order)) - 1
    out = df.withColumn("batch", F.floor(i / size))
    if drop_last:
        n = F.count(F.lit(1)).over(Window.partitionBy(*by))
        out = out.withColumn("_n", n).filter(F.col("batch") < F.floor(F.col("_n") / size)).drop("_n")
    return out


def shard(df: DataFrame, key: str, index: int, count: int) -> DataFrame:
    return df.filter(F.pmod(F.col(key), F.lit(count)) == index)


def rank_rows(df: DataFrame, index: str, rank: int, world: int, total: int) -> DataFrame:
    """Rows of one rank; the last incomplete round is dropped."""
    return df.filter((F.pmod(F.col(index), F.lit(world)) == rank) & (F.col(index) < total // world * world))


def shuffle_key(seed: int, key: Sequence[str]) -> Column:
    """What rows are put in order by, to be shuffled: a draw for the seed and the row's key."""
    return draw(F.lit(seed), F.lit("order"), *(F.col(c) for c in key))


def shuffled(df: DataFrame, seed: int, key: Sequence[str]) -> DataFrame:
    """A fixed random order: that of the rows' draws."""
    return df.orderBy(shuffle_key(seed, key), *key)


def sample_with_replacement(df: DataFrame, index: str, total: int, n: int, seed: int) -> DataFrame:
    """n rows at seeded uniform indexes."""
    spark = df.sparkSession
    picks = spark.range(n).select(F.col("id").alias("draw"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(total)).alias(index))
    return picks.join(df, index)


def pick_one(options: Sequence[Column], key: Sequence[str], seed: int) -> Column:
    """One of the options, fixed by a seeded hash of the key."""
    return F.get(F.array(*options), F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(len(options))).cast("int"))


def random_task(df: DataFrame, episode: str, tasks: int, seed: int) -> DataFrame:
    """A task id for each episode."""
    return df.withColumn("task_index", F.pmod(F.xxhash64(F.lit(seed), episode), F.lit(tasks)))


def offset_major(df: DataFrame, step: str, gap: int) -> DataFrame:
    """Order 0, g, 2g, ... 1, g + 1, ..."""
    return df.orderBy(F.col(step) % gap, step)


def common_columns(frames: Sequence[DataFrame]) -> list[str]:
    return [c for c in frames[0].columns if all(c in f.columns for f in frames)]


def cycled(df: DataFrame, rounds: int) -> DataFrame:
    """The rows again and again, with the number of the round."""
    return df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
