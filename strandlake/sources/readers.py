"""Readers of raw logs, catalogues and generated tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import strict_line_errors
from . import archives, files


def _text(spark: SparkSession, path: str | Sequence[str], missing_ok: bool) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "value string, file string")
        raise


def parse_arm_lines(lines: DataFrame) -> DataFrame:
    """``ts v,v,...`` lines as (file, ts_ns, values); blank lines are skipped."""
    p = F.split(F.trim("value"), " ", 2)
    rows = lines.filter(F.trim("value") != "").select("file", F.get(p, F.lit(0)).cast("long").alias("ts_ns"), F.transform(F.split(F.get(p, F.lit(1)), ","), lambda x: F.trim(x).cast("double")).alias("values"))
    return rows


def arm_text(spark: SparkSession, path, missing_ok: bool = True) -> DataFrame:
    """An arm's log; a missing file is empty.  Order by ts_ns where order matters."""
    return parse_arm_lines(_text(spark, path, missing_ok))


def arm_text_selected(spark: SparkSession, path, joints: int = 7, extra: int = 8) -> DataFrame:
    """Seven joints and the opening, time in seconds."""
    rows = arm_text(spark, path)
    return rows.select("file", (F.col("ts_ns") / 1e9).alias("timestamp"), F.concat(F.slice("values", 1, joints), F.array(F.get("values", F.lit(extra)))).alias("position"))


def arm_text_strict(spark: SparkSession, path, dims: int = 16) -> DataFrame:
    """Lines with the reason why each can't be read, or null."""
    return strict_line_errors(_text(spark, path, False), "value", dims)


def image_name(path: Column) -> tuple[Column, Column]:
    """Frame number and time of ``<frame>_<ts>.jpg``; null for other names."""
    pattern = r"(?:^|/)(\d+)_(\d+)\.\w+$"
    part = lambda i: F.when(path.rlike(pattern), F.regexp_extract(path, pattern, i)).cast("long")
    return part(1).alias("frame_id"), part(2).alias("ts_ns")


def image_index(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """frame_id, ts_ns, path of every image; the bytes are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path")
    return files.select(*image_name(F.col("path")), "path").filter("ts_ns IS NOT NULL")


def images(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """As ``image_index`` with the bytes, to be joined late."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select(*image_name(F.col("path")), "path", F.col("content").alias("bytes"))


def embed_images(frames: DataFrame, spark: SparkSession, folder: str, path: str = "path") -> DataFrame:
    """Bytes of the images that the frames name."""
    return frames.join(images(spark, folder, "*").select(F.col("path").alias(path), "bytes"), path, "left")


def topic_stream(messages: DataFrame, cutoff_ns: int) -> DataFrame:
    """Message time: the header's stamp if it is later than the cutoff, else the time of receipt; empty topics have no row."""
    return messages.withColumn("ts_ns", F.when(F.col("stamp_ns") > cutoff_ns, F.col("stamp_ns")).otherwise(F.col("recv_ns")))


def frame_table(spark: SparkSession, path: str, episodes: Sequence[int] | None = None, columns: Sequence[str] | None = None, episode: str = "episode_index") -> DataFrame:
    """Nested Parquet files; the episode filter and the columns reach the scan."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    if episodes is not None:
        df = df.filter(F.col(episode).isin(list(episodes)))
    return df.select(*columns) if columns else df


def episode_files(eps: DataFrame, template: str, episodes: Sequence[int]) -> list[str]:
    """Paths of the files that hold the requested episodes, from the episode table (a row each of those)."""
    rows = eps.filter(F.col("episode_index").isin(list(episodes))).select("data/chunk_index", "data/file_index").distinct().collect()
    return sorted(template.format(chunk_index=r[0], file_index=r[1]) for r in rows)


def episode_table(spark: SparkSession, path: str, with_stats: bool = False) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return df if with_stats else df.select(*(F.col(f"`{c}`") for c in df.columns if not c.startswith("stats/")))


def task_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("task", "task_index")


def json_document(spark: SparkSession, path: str) -> dict:
    """A small JSON catalogue (dataset info, statistics)."""
    rows = spark.read.option("wholetext", "true").text(path).limit(1).collect()
    if not rows:
        raise FileNotFoundError(path)
    return json.loads(rows[0].value)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines without the malformed ones."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def json_arrays(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of files that are one JSON array each, or objects between commas without its brackets, or JSON lines.

    The first reading that holds for a whole file is taken; as lines, those that
    are malformed are left out.  A file is one value, so it has less than 2 GB.
    """
    kind = schema if isinstance(schema, str) else schema.simpleString().removeprefix("struct<").removesuffix(">")
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    files_ = spark.read.text(path, wholetext=True).select(text.alias("value"))
    many = f"array<struct<{kind}>>"
    whole = F.when(F.col("value").startswith("[") & F.col("value").endswith("]"), F.from_json("value", many, {"mode": "PERMISSIVE"}))
    joined = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), many)
    sound = lambda rows: F.when(F.size(F.filter(rows, lambda r: r.isNull())) == 0, rows)
    lines = F.transform(F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != ""), lambda x: F.from_json(x, f"struct<{kind}>", {"mode": "PERMISSIVE"}))
    full = F.filter(lines, lambda r: r.isNotNull() & (F.to_json(r) != "{}"))
    return files_.select(F.inline(F.coalesce(sound(whole), F.when(~F.col("value").startswith("["), sound(joined)), full)))


def legacy_vectors(df: DataFrame, by: Sequence[str], columns: Sequence[str] = ("state", "actions")) -> DataFrame:
    """32 elements [7 L, 7 R, 9 LG, 9 RG] as 16 [7 L, LG, 7 R, RG]; openings over 1000 where an episode has any above 2."""
    from pyspark.sql import Window

    out = df
    for c in columns:
        v = F.concat(F.slice(c, 1, 7), F.array(F.get(F.col(c), F.lit(14))), F.slice(c, 8, 7), F.array(F.get(F.col(c), F.lit(23))))
        out = out.withColumn(c, v)
        top = F.max(F.greatest(F.get(F.col(c), F.lit(7)), F.get(F.col(c), F.lit(15)))).over(Window.partitionBy(*by))
        out = out.withColumn("_big", top > 2)
        out = out.withColumn(c, F.when(F.col("_big"), F.transform(c, lambda x, i: F.when((i == 7) | (i == 15), x / 1000.0).otherwise(x))).otherwise(F.col(c))).drop("_big")
    return out


def trajectories_to_frames(df: DataFrame, steps: str) -> DataFrame:
    """One row a step of an array column."""
    return df.select(*(c for c in df.columns if c != steps), F.posexplode(steps).alias("step", "frame"))


def zip_entries(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, content) of every file in the archives; entries are read by ranges, by many tasks (see ``archives``)."""
    return archives.read(archives.entries(spark, path)).drop("error")


def stream(spark: SparkSession, path: str, schema: T.StructType, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


# -- generated tables ------------------------------------------------------------------------


def mock_arms(spark: SparkSession, rows: int, joints: int = 7, hz: float = 100.0, step: float = 0.02, limit: float = 3.14, seed: int = 0) -> DataFrame:
    """A bounded random walk for each joint: (ts_ns, position).  Steps come from a seeded hash; the walk folds at its limits."""
    from pyspark.sql import Window

    base = spark.range(rows).select("id", F.explode(F.sequence(F.lit(0), F.lit(joints - 1))).alias("joint"))
    move = (F.pmod(F.xxhash64(F.lit(seed), "joint", "id"), F.lit(2001)) - 1000) / 1000.0 * step
    walk = base.withColumn("x", F.sum(move).over(Window.partitionBy("joint").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)))
    folded = F.lit(limit) - F.abs(F.pmod(F.col("x") + limit, F.lit(4 * limit)) - 2 * limit)
    out = walk.withColumn("x", folded).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("joint", "x"))).alias("s"))
    return out.select((F.col("id") * int(1e9 / hz)).alias("ts_ns"), F.col("s.x").alias("position"))


def fake_rows(spark: SparkSession, spec: dict[str, int], rows: int, seed: int = 0) -> DataFrame:
    """Seeded random vectors in [-1, 1) by a spec of name to length."""
    cols = [F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i, name=name: F.pmod(F.xxhash64(F.lit(seed), F.lit(name), F.col("id"), i), F.lit(1 << 30)) / float(1 << 29) - 1).alias(name) for name, n in spec.items()]
    return spark.range(rows).select("id", *cols)


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """path, uri, length, row_groups, n_rows and uncompressed bytes of each Parquet file, from its footer, which a task reads.

    ``uri`` is the path as ``_metadata.file_path`` has it.
    """
    import pyarrow as pa

    def run(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for p in batch.column(0).to_pylist():
                system, at = fs.FileSystem.from_uri(files.arrow_uri(p))
                m = pq.read_metadata(at, filesystem=system)
                rows.append((p, m.num_row_groups, m.num_rows, sum(m.row_group(i).total_byte_size for i in range(m.num_row_groups))))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in cols[1:])], names=["path", "uri", "length", "row_groups", "n_rows", "bytes"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return found.select("path", F.col("_metadata.file_path").alias("uri"), "length").mapInArrow(run, "path string, uri string, length long, row_groups long, n_rows long, bytes long")


def parquet_bytes(spark: SparkSession, path: str) -> int:
    """Uncompressed bytes of all row groups of a Parquet path, from its footers alone."""
    return parquet_footers(spark, path).agg(F.sum("bytes")).first()[0] or 0
