"""What the corpus operators share: tables, the shared folder, Arrow helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch: whole texts travel in it, so it is kept short.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that carry whole texts to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``, which all executors share.

    Where a local session (tests) has none, a temporary folder stands for it;
    a cluster must name one, since its machines don't share theirs.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if "path" not in _LOCAL:
            _LOCAL["path"] = tempfile.mkdtemp(prefix="strandlake-")
        base = _LOCAL["path"]
    return f"{base.rstrip('/')}/strandlake/{name}-{uuid.uuid4().hex[:12]}"


_LOCAL: dict[str, str] = {}


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Cuts the lineage: what a lost executor held is read from the table, not
    computed again.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, *taken: list[str]) -> str:
    """``name``, with as many underscores behind it as it takes to clash with no column."""
    have = {c.lower() for cols in taken for c in cols}
    while name.lower() in have:
        name += "_"
    return name


def sub_key(docs: DataFrame, id_col: str, text_col: str) -> Column | None:
    """What tells documents of one id apart: the text's hash, or None while no id repeats."""
    repeats = docs.groupBy(F.col(id_col).cast("long")).agg(F.count("*").alias("k")).filter("k > 1")
    return None if repeats.isEmpty() else F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def sub_column(of: Column | None) -> Column:
    """``sub_key`` as a column: zero for all where there is none."""
    return (F.lit(0).cast("long") if of is None else of).alias("sub")


def whole_row(docs: DataFrame) -> Column:
    """All columns in one, so that no name of theirs can clash; ``unwrapped`` brings them back."""
    return F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")


def unwrapped(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col("row").getField(c).alias(c) for c in columns))


def fits(df: DataFrame, row_bytes: int, list_col: str | None = None, item_bytes: int = 0, limit: int = 64 << 20) -> bool:
    """Whether a table may be broadcast: its rows, and the items of a list column, take ``limit`` bytes at most."""
    size = F.lit(row_bytes) + (F.size(list_col) * item_bytes if list_col else 0)
    return (df.agg(F.sum(size.cast("long")).alias("n")).first().n or 0) <= limit


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Whole texts of a batch; null counts as empty."""
    return [t or "" for t in column(batch, name)]


#: Caches that outlive a task in its Python worker.
CACHES: list[dict] = []


def batches(it: Iterable[pa.RecordBatch], caches: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches that have rows.

    A worker serves one task after another: what the last one has freed goes
    back to the machine first, and an operator that doesn't use the worker's
    caches frees them too.
    """
    if not caches:
        for c in CACHES:
            c.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
    return (b for b in it if b.num_rows)


def packed(rows: np.ndarray) -> bytes:
    """Column after column, so that the exchange's compression finds what repeats."""
    return b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names)


def unpacked(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    out = np.empty(sum(len(b) for b in blobs) // kind.itemsize, kind)
    at = 0
    for b in blobs:
        n, skip = len(b) // kind.itemsize, 0
        for f in kind.names:
            out[f][at : at + n] = np.frombuffer(b, kind[f], n, skip)
            skip += n * kind[f].itemsize
        at += n
    return out
