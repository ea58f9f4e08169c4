"""Datasets joined by their files: what need not change is referred to, not copied.

An aggregate is a table of its files.  Files of all sources, in their order, are
put into target files greedily by size.  A target of one source file is that very
file; its episodes and indexes are shifted when it is read, by offsets that the
table holds.  Only targets of several small files are written, shifted already.
The table is written last, under a number of its own, so that an aggregate is
there as a whole or not at all; one that takes in further sources keeps all its
files but the last small one, and adds to them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import folds
from . import files
from .readers import parquet_footers
from .shared import kept

FILES = "source int, src_chunk long, src_file long, uri string, n_rows long, size long, episode_offset long, index_offset long, dst_chunk long, dst_file long, carried boolean"


def _frames(spark: SparkSession, some: DataFrame) -> DataFrame:
    """The files' rows; what goes through the driver is their names."""
    return spark.read.parquet(*(unquote(r.uri) for r in some.select("uri").distinct().collect()))


def _listed(spark: SparkSession, sources: Sequence[str], size: str, first: int, episode: str, starts: tuple[int, int]) -> DataFrame:
    """The sources' files in order, with the offsets of their source."""
    out, (episodes, rows) = None, starts
    number = lambda kind: F.coalesce(F.regexp_extract("path", rf"{kind}[-=](\d+)", 1).try_cast("long"), F.lit(0))
    for i, source in enumerate(sources):
        found = kept(parquet_footers(spark, source), "footers")
        own = found.select(F.lit(first + i).alias("source"), number("chunk").alias("src_chunk"), number("file").alias("src_file"), "uri", "n_rows", F.col(size).alias("size"), F.lit(episodes).cast("long").alias("episode_offset"), F.lit(rows).cast("long").alias("index_offset"))
        out = own if out is None else out.unionByName(own)
        n = found.agg(F.sum("n_rows")).first()[0] or 0
        if n:
            episodes += _frames(spark, found).agg(F.max(episode)).first()[0] + 1
        rows += n
    return out.filter("n_rows > 0")


def table(spark: SparkSession, path: str) -> DataFrame:
    """The newest table of an aggregate's files."""
    last = max(n for n in files.children(spark, f"{path}/tables") if n.isdigit())
    return spark.read.schema(FILES).parquet(f"{path}/tables/{last}")


def read(spark: SparkSession, path: str, episode: str = "episode_index") -> DataFrame:
    """Frames of all sources, their episodes and indexes in one line, with the number of their source."""
    t = table(spark, path)
    rows = _frames(spark, t)
    one = t.groupBy("uri").agg(*(F.max(F.when(F.col("carried"), F.col(c)).otherwise(0)).alias(f"_{c}") for c in ("episode_offset", "index_offset")))
    met = rows.withColumn("_uri", F.col("_metadata.file_path")).join(F.broadcast(one), F.col("_uri") == F.col("uri"))
    shifted = met.withColumn(episode, F.col(episode) + F.col("_episode_offset")).withColumn("index", F.col("index") + F.col("_index_offset"))
    return shifted.select(*rows.columns)


def _packed(listed: DataFrame, limit: float) -> DataFrame:
    """The target of each file: the next one where the size would reach the limit."""
    by = ["source", "src_chunk", "src_file", "uri"]
    return folds.pack_batches(listed, [], by[0], "size", 1.0, limit, None, None, by[1:])


def aggregate(spark: SparkSession, sources: Sequence[str], path: str, limit: int, size: str = "length", chunk_files: int = 1000, episode: str = "episode_index") -> DataFrame:
    """Join datasets, each a folder of Parquet files (``.../chunk-000/file-000...``), into an aggregate; returns the table of its files.

    ``limit`` is what a target file may reach: bytes on disk, or rows with
    ``size="n_rows"``.  An aggregate that is there already takes the sources in
    behind its own: its last target is written anew if it has room.
    """
    numbers = [int(n) for n in files.children(spark, f"{path}/tables") if n.isdigit()]
    old = table(spark, path) if numbers else None
    first, starts, base, head = 0, (0, 0), 0, None
    if old is not None:
        have = old.groupBy("uri").agg(F.max("n_rows").alias("n"), F.sum("size").alias("size"), F.max(F.col("dst_chunk") * chunk_files + F.col("dst_file")).alias("t"), F.max("source").alias("source"), F.max("episode_offset").alias("e"), F.max("carried").alias("carried"))
        sums = have.agg(F.max("t").alias("t"), F.max("source").alias("source")).first()
        frames = read(spark, path, episode).agg(F.max(episode).alias("e"), F.max("index").alias("i")).first()
        first, starts, base = sums.source + 1, (frames.e + 1, frames.i + 1), sums.t
        head = old.filter(F.col("dst_chunk") * chunk_files + F.col("dst_file") == base)  # the last target goes on
        old = old.filter(F.col("dst_chunk") * chunk_files + F.col("dst_file") < base)
    listed = _listed(spark, sources, size, first, episode, starts)
    if head is not None:
        listed = head.withColumn("_done", ~F.col("carried")).select(*listed.columns, "_done").unionByName(listed.withColumn("_done", F.lit(False)))
    else:
        listed = listed.withColumn("_done", F.lit(False))
    packed = kept(_packed(listed, limit).withColumn("t", F.col("batch") + base), "targets")
    several = packed.groupBy("t").agg(F.countDistinct("uri").alias("k")).filter("k > 1").select("t")
    merged = kept(packed.join(several, "t"), "merged")
    carried = packed.join(several, "t", "left_anti").withColumn("carried", ~F.col("_done"))
    place = lambda df: df.withColumn("dst_chunk", F.expr(f"t div {chunk_files}")).withColumn("dst_file", F.col("t") % chunk_files)
    names = [f.split()[0] for f in FILES.split(", ")]
    out = place(carried).select(*names)
    if not merged.isEmpty():
        data = f"{path}/data/{uuid.uuid4().hex}"
        rows = _frames(spark, merged)
        shift = merged.groupBy("uri", "t").agg(*(F.max(F.when(F.col("_done"), 0).otherwise(F.col(c))).alias(f"_{c}") for c in ("episode_offset", "index_offset")))
        met = rows.withColumn("_uri", F.col("_metadata.file_path")).join(F.broadcast(shift), F.col("_uri") == F.col("uri"))
        met = met.withColumn(episode, F.col(episode) + F.col("_episode_offset")).withColumn("index", F.col("index") + F.col("_index_offset")).select(*rows.columns, F.col("t").alias("target"))
        met.repartition("target").sortWithinPartitions("target", "index").write.partitionBy("target").parquet(data)
        made = parquet_footers(spark, data).select(F.regexp_extract("path", r"target=(\d+)", 1).cast("long").alias("t"), F.col("uri").alias("new"))
        out = out.unionByName(place(merged.join(made, "t").withColumn("uri", F.col("new")).withColumn("carried", F.lit(False))).select(*names))
    if old is not None:
        out = out.unionByName(old.select(*names))
    number = max(numbers, default=-1) + 1
    aside = f"{path}/tables/_{uuid.uuid4().hex}"
    out.coalesce(1).write.parquet(aside)
    if not files.move(spark, aside, f"{path}/tables/{number:08d}"):
        raise RuntimeError(f"table {number} of {path} was written by another")
    return table(spark, path)


def file_map(spark: SparkSession, path: str) -> DataFrame:
    """Where each source file went: source, src_chunk, src_file to dst_chunk, dst_file; for ``edit.remap_files``."""
    return table(spark, path).select("source", "src_chunk", "src_file", "dst_chunk", "dst_file", "carried")
