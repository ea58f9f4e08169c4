"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession | None = None, name: str = "stream") -> str:
    """A new path in ``spark.checkpoint.dir``; a temporary folder stands for it in a local session that has none."""
    spark = spark or SparkSession.active()
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL["path"] = _LOCAL.get("path") or tempfile.mkdtemp(prefix="strandlake-")
    return f"{base.rstrip('/')}/strandlake/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it again: what is used twice is the same rows, and a lost executor costs a read."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
