"""Streams of existing tables, for equality with the batch operators.

A file stream reads a folder, so the table is written there once: in the
folder that the cluster shares, where it names one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import folder


def name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:12]}"


def as_stream(spark: SparkSession, df: DataFrame, files: int, by: str | None = None) -> DataFrame:
    """The table as a stream of ``files`` files, one a batch; in the order of a timestamp column if one is named."""
    path = folder(spark)
    if by is None:
        df.repartition(files).write.parquet(path)
    else:
        at = F.unix_micros(by)
        cuts = df.select(at.alias("t")).approxQuantile("t", [i / files for i in range(1, files)], 0.01)
        edges = [None, *sorted(set(map(int, cuts))), None]
        for a, b in zip(edges, edges[1:]):  # files are read in the order of their age
            part = (F.lit(True) if a is None else at >= a) & (F.lit(True) if b is None else at < b)
            df.filter(part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
