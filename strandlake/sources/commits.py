"""Recordings whose tables appear together or not at all.

A batch of episodes is three tables: frames, tasks and episodes.  An attempt to
save one writes them under a name of its own; the manifest, written last and
under the next number, names the attempt.  Readers take the attempts that
manifests name, so what a writer that died has left is never seen, and
``sweep`` takes it away.  A batch has an id: one that is committed already is
not written again, so a stream may replay its last batch.  Numbers of episodes,
frames and tasks go on from the last manifest; where two writers race, the one
that comes late numbers its batch anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edit
from . import files
from .shared import kept

TABLES = ("data", "meta/tasks", "meta/episodes")
MANIFEST = "commit long, batch string, attempt string, episodes long, frames long, tasks long"
#: Attempts at numbering a batch while other writers come first.
TRIES = 20


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Manifests: number, batch id, attempt, and how many episodes, frames and tasks there are up to and with it."""
    if not files.children(spark, f"{path}/commits"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{path}/commits")


def read(spark: SparkSession, path: str, name: str = "data") -> DataFrame:
    """A table of all committed batches; folders of other attempts are pruned, not read."""
    some = commits(spark, path).select("attempt")
    return spark.read.parquet(f"{path}/{name}").join(F.broadcast(some), "attempt", "left_semi").drop("attempt")


def _write(df: DataFrame, path: str, name: str, attempt: str) -> None:
    df.write.parquet(f"{path}/{name}/attempt={attempt}")


def save(frames: DataFrame, path: str, batch: str, order: Sequence[str], fps: float, task: str = "task", episode: str = "episode_index") -> bool:
    """Commit a batch of whole episodes under its id; False if that was done before.

    Episodes, frames and tasks get numbers behind those of earlier batches; tasks
    that earlier batches have keep theirs.
    """
    spark = frames.sparkSession
    given = None
    for _ in range(TRIES):
        done = commits(spark, path)
        if not done.filter(F.col("batch") == batch).isEmpty():
            return False
        last = done.orderBy(F.desc("commit")).first()
        number, n_episodes, n_frames, n_tasks = (last.commit + 1, last.episodes, last.frames, last.tasks) if last else (0, 0, 0, 0)
        attempt = f"a{uuid.uuid4().hex}"
        if given is None:  # numbered from zero once, however often the offsets change
            given = kept(edit.reindex(edit.add_frames(frames, order, fps, episode), order, episode), "batch")
        own = edit.tasks_of(given, task, ["index"])
        known = read(spark, path, "meta/tasks").select(task, "task_index") if last else own.limit(0)
        new = edit.tasks_of(given.join(known, task, "left_anti"), task, ["index"]).withColumn("task_index", F.col("task_index") + n_tasks) if last else own
        new = kept(new, "tasks")
        rows = given.withColumn("index", F.col("index") + n_frames).withColumn(episode, F.col(episode) + n_episodes)
        rows = edit.with_tasks(rows, known.unionByName(new), task)
        eps = rows.groupBy(episode).agg(F.count(F.lit(1)).alias("length"), F.min("index").alias("dataset_from_index"), (F.max("index") + 1).alias("dataset_to_index"), F.array_sort(F.collect_set(task)).alias("tasks"))
        _write(rows.drop(task).repartitionByRange(episode).sortWithinPartitions(episode, "frame_index"), path, "data", attempt)
        _write(new, path, "meta/tasks", attempt)
        _write(eps, path, "meta/episodes", attempt)
        sizes = spark.read.parquet(f"{path}/meta/episodes/attempt={attempt}").agg(F.count(F.lit(1)).alias("episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames")).first()
        told = {"commit": number, "batch": batch, "attempt": attempt, "episodes": n_episodes + sizes.episodes, "frames": n_frames + sizes.frames, "tasks": n_tasks + new.count()}
        if files.publish(spark, f"{path}/commits/{number:012d}.json", json.dumps(told).encode()):
            return True
        _drop(spark, path, attempt)
    raise RuntimeError(f"{TRIES} other writers came first")


def _drop(spark: SparkSession, path: str, attempt: str) -> None:
    for name in TABLES:
        files.remove(spark, f"{path}/{name}/attempt={attempt}")


def unfinished(spark: SparkSession, path: str) -> list[str]:
    """Attempts that no manifest names: of writers that died, or are at work."""
    found = {n.removeprefix("attempt=") for name in TABLES for n in files.children(spark, f"{path}/{name}") if n.startswith("attempt=")}
    if not found:
        return []
    named = commits(spark, path).filter(F.col("attempt").isin(sorted(found))).select("attempt").collect()
    return sorted(found - {r.attempt for r in named})


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Take away what unfinished attempts have written; call it while no writer is at work."""
    gone = unfinished(spark, path)
    for attempt in gone:
        _drop(spark, path, attempt)
    return gone


def save_stream(df: DataFrame, path: str, checkpoint: str, order: Sequence[str], fps: float, name: str, task: str = "task", episode: str = "episode_index"):
    """Commit each batch of a stream of whole episodes; a batch that is replayed after a restart is not saved twice.

    ``name`` is the recording's: batches are known by it and their number.
    """

    def run(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            save(batch, path, f"{name}-{number}", order, fps, task, episode)

    return df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(run).start()
