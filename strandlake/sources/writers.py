"""Writers: frame tables, episode metadata, reports, statistics, manifests."""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edit
from . import files
from .shared import kept


def frame_table(df: DataFrame, path: str, rows_per_file: int = 500_000, episode: str = "episode_index", file_bytes: int | None = None, row_bytes: int | None = None) -> None:
    """Parquet files in episode order, of bounded length, or of bounded uncompressed bytes where a row's are known (``readers.parquet_bytes``)."""
    if file_bytes and row_bytes:
        rows_per_file = max(1, min(rows_per_file, file_bytes // row_bytes))
    df.repartitionByRange(episode).sortWithinPartitions(episode, "frame_index").write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def save_episodes(frames: DataFrame, path: str, order, fps: float, task: str = "task") -> DataFrame:
    """Number, time and index new frames, unify their tasks, write all three tables; returns the episode table."""
    f = kept(edit.reindex(edit.add_frames(frames, order, fps), order), "frames")
    tasks = edit.tasks_of(f, task, ["index"])
    f = edit.with_tasks(f, tasks, task)
    frame_table(f.drop(task), f"{path}/data")
    tasks.write.parquet(f"{path}/meta/tasks")
    eps = edit.episodes(f)
    eps = eps.join(f.groupBy("episode_index").agg(F.array_sort(F.collect_set(task)).alias("tasks")), "episode_index")
    eps.write.parquet(f"{path}/meta/episodes")
    return eps


def append(old_path: str, new: DataFrame, path: str) -> None:
    """Old and new frames in a new place; the source is never written to."""
    if old_path.rstrip("/") == path.rstrip("/"):
        raise ValueError("the target must not be the source")
    old = new.sparkSession.read.parquet(old_path)
    old.unionByName(new, allowMissingColumns=True).write.parquet(path)


def by_episode(df: DataFrame, path: str, episode: str = "episode_index") -> None:
    df.write.partitionBy(episode).parquet(path)


def tsv_report(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).csv(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def json_document(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def norm_stats(wide: DataFrame, path: str) -> None:
    """Statistics of a few features as JSON lines."""
    wide.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(path)


def arm_text(df: DataFrame, path: str, ts: str = "ts_ns", values: str = "values") -> None:
    line = F.concat_ws(" ", F.col(ts).cast("string"), F.array_join(F.transform(values, lambda x: x.cast("string")), ","))
    df.sortWithinPartitions(ts).select(line.alias("value")).write.text(path)


def episodes_of_stream(df: DataFrame, path: str, checkpoint: str, episode: str = "episode"):
    """Each batch of a stream goes to its episodes' folders.

    A batch has folders of its own under its number, which are written anew when
    the batch is replayed after a restart; so no row is there twice.
    """

    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy(episode).parquet(f"{path}/batch={number}")

    return df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(run).start()


def image_files(df: DataFrame, folder: str, name: str = "name", data: str = "bytes") -> DataFrame:
    """Each row's bytes as the file ``name`` under ``folder``; (name, size) of the files written.

    The folder is on the cluster's file system, or on any that its scheme names;
    with ``file:`` it must be one that all executors share.  A file is written
    aside and put in its place whole, so a task that runs again does no harm.
    Rows without bytes write nothing; names must be unique.
    """
    base = files.qualified(df.sparkSession, folder).rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, blobs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for n, b in zip(names, blobs):
                files.put(f"{base}/{quote(n)}", b)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([len(b) for b in blobs], pa.int64())], names=["name", "size"])

    rows = df.select(F.col(name).cast("string"), F.col(data)).filter(F.col(data).isNotNull() & F.col(name).isNotNull())
    return kept(rows.mapInArrow(run, "name string, size long"), "images")
