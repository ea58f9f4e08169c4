"""Edits of whole datasets: merge, split, delete, re-index, tasks and features.

A global frame index never needs one sorted partition: frames are counted by
episode, the small episode table gets running sums, and each frame adds its
number in its episode to its episode's offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import kept

REQUIRED = ("timestamp", "frame_index", "episode_index", "index", "task_index")


def running(df: DataFrame, sums: dict[str, str], order: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """For each ``value: name`` the sum of ``value`` over the rows before, of a table of one row an episode.

    The table is cut into ranges of the order, which are summed on their own;
    only the ranges' totals are put in one line.  Ranges come from a sample that
    every use of the plan draws anew, so the cut table is written once, and both
    uses read it.
    """
    if group:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({name: F.coalesce(F.sum(value).over(w), F.lit(0)) for value, name in sums.items()})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_p").agg(*(F.sum(value).alias(f"_t_{value}") for value in sums))
    line = Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    base = totals.select("_p", *(F.coalesce(F.sum(f"_t_{value}").over(line), F.lit(0)).alias(f"_base_{value}") for value in sums))
    own = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {name: (F.col(f"_base_{value}") + F.coalesce(F.sum(value).over(own), F.lit(0))).cast("long") for value, name in sums.items()}
    return ranged.join(F.broadcast(base), "_p").withColumns(before).drop("_p", *(f"_base_{value}" for value in sums))


def episodes(frames: DataFrame, episode: str = "episode_index") -> DataFrame:
    """episode, length, dataset_from_index, dataset_to_index (exclusive)."""
    n = frames.groupBy(episode).agg(F.count(F.lit(1)).alias("length"))
    out = running(n, {"length": "dataset_from_index"}, [episode])
    return out.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col("length"))


def reindex(frames: DataFrame, order: Sequence[str], episode: str = "episode_index") -> DataFrame:
    """Dense episode numbers, frame numbers from 0 in each, and a gapless global index."""
    n = frames.groupBy(episode).agg(F.count(F.lit(1)).alias("_n")).withColumn("_one", F.lit(1))
    e = running(n, {"_n": "_from", "_one": "_new"}, [episode]).select(episode, "_from", "_new")
    out = frames.join(e, episode).withColumn("frame_index", (F.row_number().over(Window.partitionBy(episode).orderBy(*order)) - 1).cast("long"))
    return out.withColumn("index", F.col("_from") + F.col("frame_index")).withColumn(episode, F.col("_new")).drop("_from", "_new")


def add_frames(frames: DataFrame, order: Sequence[str], fps: float, episode: str = "episode_index") -> DataFrame:
    """frame_index, and timestamp = frame_index / fps where none is given."""
    out = frames.withColumn("frame_index", (F.row_number().over(Window.partitionBy(episode).orderBy(*order)) - 1).cast("long"))
    t = F.col("frame_index") / float(fps)
    return out.withColumn("timestamp", (F.coalesce(F.col("timestamp"), t) if "timestamp" in frames.columns else t).cast("float"))


def delete_episodes(frames: DataFrame, gone: DataFrame | Sequence[int], order: Sequence[str], episode: str = "episode_index") -> DataFrame:
    left = frames.join(gone.select(episode).distinct(), episode, "left_anti") if isinstance(gone, DataFrame) else frames.filter(~F.col(episode).isin(list(gone)))
    return reindex(left, order, episode)


def split_sizes(n: int, fractions: dict[str, float]) -> dict[str, tuple[int, int]]:
    """[start, end) of each split.

    A split whose share comes to no episode is left out; the last one that is
    named takes what is left, unless its own share comes to none.
    """
    if any(f < 0 for f in fractions.values()) or sum(fractions.values()) > 1:
        raise ValueError("fractions must not be negative and add up to 1 at most")
    out, at = {}, 0
    for i, (name, f) in enumerate(fractions.items()):
        if size := int(n * f):
            end = n if i == len(fractions) - 1 else at + size
            out[name] = (at, end)
            at = end
    return out


def split(frames: DataFrame, total: int, fractions: dict[str, float], episode: str = "episode_index") -> DataFrame:
    """A ``split`` name for each frame, by ranges of dense episode numbers."""
    name = F.lit(None).cast("string")
    for k, (a, b) in split_sizes(total, fractions).items():
        name = F.when((F.col(episode) >= a) & (F.col(episode) < b), F.lit(k)).otherwise(name)
    return frames.withColumn("split", name)


def tasks_of(frames: DataFrame, task: str = "task", first_seen: Sequence[str] | None = None) -> DataFrame:
    """Dense task ids, sorted by text or by where a task is first seen."""
    seen = frames.groupBy(task).agg((F.min(F.struct(*first_seen)) if first_seen else F.lit(0)).alias("_f")).withColumn("_one", F.lit(1))
    return running(seen, {"_one": "task_index"}, ["_f", task]).select(task, "task_index")


def with_tasks(frames: DataFrame, tasks: DataFrame, task: str = "task") -> DataFrame:
    """task_index from the text; the dimension is small but Spark checks its size before it broadcasts it."""
    return frames.drop("task_index").join(tasks, task, "left")


def task_text(frames: DataFrame, tasks: DataFrame, strict: bool = True) -> DataFrame:
    out = frames.join(tasks.select("task_index", "task"), "task_index", "left")
    if strict:
        out = out.withColumn("task", F.coalesce("task", F.raise_error(F.concat(F.lit("no task "), F.col("task_index").cast("string")))))
    return out


def modify_tasks(eps: DataFrame, overrides: DataFrame | None = None, default: str | None = None, episode: str = "episode_index") -> DataFrame:
    """One task for each episode: its override, else the default, else its own first task; ids are those of the sorted texts."""
    own = F.get(F.col("tasks"), F.lit(0))
    if overrides is not None:
        eps = eps.join(overrides.select(episode, F.col("task").alias("_o")), episode, "left")
        chosen = F.coalesce("_o", F.lit(default), own)
    else:
        chosen = F.coalesce(F.lit(default), own)
    out = eps.withColumn("task", chosen).drop("_o", "task_index")
    return with_tasks(out, tasks_of(out))


def merge(sources: Sequence[DataFrame], order: Sequence[str], task: str | None = "task", episode: str = "episode_index", pad: dict[str, int] | None = None) -> DataFrame:
    """Union of datasets in the given order: episodes and indexes go on, tasks are unified by text.

    Only common columns stay; vectors named in ``pad`` get zeros up to a length.
    """
    common = [c for c in sources[0].columns if all(c in s.columns for s in sources)]
    both = None
    for i, s in enumerate(sources):
        for c, n in (pad or {}).items():
            s = s.withColumn(c, F.concat(c, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(n) - F.size(c)))))
        s = s.select(*common).withColumn("dataset_index", F.lit(i))
        both = s if both is None else both.unionByName(s)
    n = both.groupBy("dataset_index", episode).agg(F.count(F.lit(1)).alias("_n")).withColumn("_one", F.lit(1))
    key = ["dataset_index", episode]
    e = running(n, {"_n": "_from", "_one": "_new"}, key).select(*key, "_from", "_new")
    out = both.join(e, key).withColumn("frame_index", (F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1).cast("long"))
    out = out.withColumn("index", F.col("_from") + F.col("frame_index")).withColumn(episode, F.col("_new")).drop("_from", "_new")
    return with_tasks(out, tasks_of(out, task, ["dataset_index", "index"]), task) if task and task in common else out


def multi_view(sources: Sequence[DataFrame]) -> DataFrame:
    """Concatenation with dataset_index, common columns only."""
    common = [c for c in sources[0].columns if all(c in s.columns for s in sources)]
    out = None
    for i, s in enumerate(sources):
        s = s.select(*common, F.lit(i).alias("dataset_index"))
        out = s if out is None else out.unionByName(s)
    return out


def check_compatible(infos: Sequence[dict]) -> None:
    """Datasets can be merged if rate, robot and features are the same."""
    for i, info in enumerate(infos[1:], 1):
        for k in ("fps", "robot_type", "features"):
            if info.get(k) != infos[0].get(k):
                raise ValueError(f"dataset {i} differs in {k}: {info.get(k)!r}, {infos[0].get(k)!r}")


def remap_files(meta: DataFrame, mapping: DataFrame, keys: Sequence[str], default: tuple[int, int], shift: str | None = None) -> DataFrame:
    """New (chunk, file) of each row, a default where the map has none, and shifted times."""
    out = meta.join(mapping, list(keys), "left").withColumn("dst_chunk", F.coalesce("dst_chunk", F.lit(default[0]))).withColumn("dst_file", F.coalesce("dst_file", F.lit(default[1])))
    return out.withColumn("from_timestamp", F.col("from_timestamp") + F.coalesce(F.col(shift), F.lit(0.0))).withColumn("to_timestamp", F.col("to_timestamp") + F.coalesce(F.col(shift), F.lit(0.0))) if shift else out


def video_offsets(eps: DataFrame, fps: float, file: Sequence[str], episode: str = "episode_index") -> DataFrame:
    """from and to time of each episode in its packed file."""
    out = running(eps, {"length": "_before"}, [episode], file)
    return out.withColumn("from_timestamp", F.col("_before") / float(fps)).withColumn("to_timestamp", (F.col("_before") + F.col("length")) / float(fps)).drop("_before")


def modify_features(frames: DataFrame, add: dict[str, Column] | None = None, remove: Sequence[str] = ()) -> DataFrame:
    """Add columns and drop others; the required ones stay."""
    if bad := set(remove) & set(REQUIRED):
        raise ValueError(f"required: {sorted(bad)}")
    if bad := [c for c in remove if c not in frames.columns]:
        raise ValueError(f"unknown: {bad}")
    for name, col in (add or {}).items():
        if name in frames.columns:
            raise ValueError(f"{name} is there already")
        frames = frames.withColumn(name, col)
    return frames.drop(*remove)


def add_by_position(frames: DataFrame, values: DataFrame, name: str, index: str = "index") -> DataFrame:
    """Values by the frames' global index."""
    return frames.join(values.select(index, name), index, "left")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` in place of those with equal keys; the rest of ``old`` stays."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def clean(manifest: DataFrame, unfinished: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """Without the unfinished entries that have no valid file."""
    bad = unfinished.join(valid.select(key), key, "left_anti").select(key)
    return manifest.join(bad, key, "left_anti")


def first_of_paths(paths: DataFrame, resolved: Column, order: str) -> DataFrame:
    """First entry of each resolved path."""
    keyed = paths.withColumn("_p", resolved)
    w = Window.partitionBy("_p").orderBy(order)
    return keyed.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_p")


def zip_metadata(parts: Sequence[DataFrame], key: str = "episode_index") -> DataFrame:
    """Join tables of one row an episode; an episode that any of them lacks is an error."""
    out = parts[0].withColumn("_m0", F.lit(True))
    for i, p in enumerate(parts[1:], 1):
        out = out.join(p.withColumn(f"_m{i}", F.lit(True)), key, "full")
    ok = F.lit(True)
    for i in range(len(parts)):
        ok = ok & F.col(f"_m{i}").isNotNull()
    checked = F.when(ok, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("episode missing in a table: "), F.col(key).cast("string"))).cast(out.schema[key].dataType))
    return out.withColumn(key, checked).drop(*(f"_m{i}" for i in range(len(parts))))


def totals(eps: DataFrame) -> DataFrame:
    return eps.agg(F.count(F.lit(1)).alias("total_episodes"), F.sum("length").alias("total_frames")).withColumn("split", F.concat(F.lit("0:"), F.col("total_episodes").cast("string")))


def missing_workers(spark, world: int, done: DataFrame) -> DataFrame:
    """Ranks below ``world`` that aren't done.  Each rank done is met once, however often it is told, so the join is small."""
    told = done.select("rank").filter((F.col("rank") >= 0) & (F.col("rank") < world)).distinct()
    return spark.range(world).withColumnRenamed("id", "rank").join(told, "rank", "left_anti")


def episode_count(frames: DataFrame, episode: str = "episode_index") -> DataFrame:
    return frames.agg(F.countDistinct(episode).alias("num_episodes"))


def absent_episodes(wanted: DataFrame, frames: DataFrame, episode: str = "episode_index") -> DataFrame:
    """Wanted episodes without a frame; none are left if they are a subset."""
    return wanted.select(episode).distinct().join(frames.select(episode).distinct(), episode, "left_anti")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: how many keys both have, and whether the first are a subset of the others or apart from them."""
    x, y = a.select(key).distinct(), b.select(key).distinct().withColumn("_there", F.lit(True))
    n = x.join(y, key, "left").agg(F.count(F.lit(1)).alias("_n"), F.count("_there").alias("n_shared"))
    return n.select("n_shared", (F.col("n_shared") == F.col("_n")).alias("subset"), (F.col("n_shared") == 0).alias("disjoint"))


def info(frames: DataFrame, episode: str = "episode_index", fps: float = 30.0, task: str | None = None) -> DataFrame:
    """One row: episodes, frames, their shortest, mean and longest episode, hours, tasks, features."""
    n = frames.groupBy(episode).agg(F.count(F.lit(1)).alias("length"))
    out = n.agg(F.count(F.lit(1)).alias("total_episodes"), F.sum("length").alias("total_frames"), F.min("length").alias("shortest"), F.avg("length").alias("mean_length"), F.max("length").alias("longest"))
    tasks = frames.agg((F.countDistinct(task) if task else F.lit(0)).cast("long").alias("total_tasks"))
    return out.crossJoin(F.broadcast(tasks)).withColumn("hours", F.col("total_frames") / float(fps) / 3600).withColumn("n_features", F.lit(len(frames.columns)))


def source_times(sources: dict[str, DataFrame], by: Sequence[str], on: str, digits: int = 2) -> DataFrame:
    """source, has_time, fps, same_fps: whether each source has the time column, its rate, and whether all rates agree."""
    out = None
    for name, s in sources.items():
        there = on in s.columns
        if there:
            n = s.groupBy(*by).agg(F.min(on).alias("a"), F.max(on).alias("b"), F.count(F.lit(1)).alias("n"))
            rate = n.agg(F.round(F.sum(F.col("n") - 1) / F.sum(F.col("b") - F.col("a")), digits).alias("fps"))
        else:
            rate = s.agg(F.lit(None).cast("double").alias("fps"))
        row = rate.select(F.lit(name).alias("source"), F.lit(there).alias("has_time"), "fps")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("same_fps", F.min("fps").over(Window.partitionBy(F.lit(0))) == F.max("fps").over(Window.partitionBy(F.lit(0))))  # a row for each source


def length_errors(episodes_: DataFrame, images: DataFrame, videos: DataFrame, key: str = "episode_index") -> DataFrame:
    """Episodes with why they can't be merged: no images, another number of images than of frames, a video longer than its frames."""
    out = episodes_.join(images, key, "left").join(videos, key, "left")
    error = F.when(F.col("n_images").isNull(), "no images").when(F.col("n_images") != F.col("length"), "images and frames differ").when(F.col("n_video") > F.col("length"), "video is longer than the frames")
    return out.withColumn("error", error)


def incomplete(recordings: DataFrame, counts: Sequence[str], key: str) -> DataFrame:
    """Recordings that lack a camera, with the ones they lack.  They are reported; nothing is deleted."""
    lacks = F.filter(F.array(*(F.when(F.coalesce(F.col(c), F.lit(0)) == 0, F.lit(c)) for c in counts)), lambda x: x.isNotNull())
    return recordings.select(key, F.array_join(lacks, ",").alias("lacks")).filter("lacks <> ''")
