"""Zip archives read by byte ranges: an archive of many entries is read by many tasks.

One task reads an archive's central directory (a few kilobytes at its end) and
makes a row of each entry: where it is, how long, how it is packed.  These rows
are dealt to all tasks, and each reads the ranges of its entries alone.  So an
archive may be of any size; an entry is one value and has less than 2 GB.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

ENTRY = "archive string, name string, method int, crc long, packed long, size long, place long"
CONTENT = "archive string, name string, content binary, error string"
#: Bytes that the end record and its comment have at most.
TAIL = 22 + 65_535


def directory(file: files.Ranges, uri: str) -> Iterator[tuple[str, int, int, int, int, int]]:
    """(name, method, crc, packed size, size, place of the local header) of each entry that is a file."""
    n = min(TAIL, file.size)
    tail = file.read(file.size - n, n)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0 or end + 22 > len(tail):
        raise ValueError(f"{uri}: no end record")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":  # sizes that need 64 bits
        (at,) = struct.unpack_from("<Q", tail, end - 20 + 8)
        count, size, start = struct.unpack_from("<QQQ", file.read(at, 56), 32)
    data, at = file.read(start, size), 0
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError(f"{uri}: no directory entry at byte {start + at}")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, whole, n_name, n_extra, n_comment = struct.unpack_from("<IIIHHH", data, at + 16)
        (place,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 2048 else "cp437")
        extra, k = data[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, k)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, k + 4))
                whole, packed, place = (next(wide) if v == 0xFFFFFFFF else v for v in (whole, packed, place))
            k += 4 + length
        if not name.endswith("/"):
            yield name, method, crc, packed, whole, place
        at += 46 + n_name + n_extra + n_comment


def content(file: files.Ranges, method: int, crc: int, packed: int, size: int, place: int) -> bytes:
    """An entry's bytes; ValueError if they are damaged."""
    head = file.read(place, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    data = file.read(place + 30 + n_name + n_extra, packed)
    if method == 8:
        try:
            data = zlib.decompress(data, -15)
        except zlib.error as e:
            raise ValueError(f"can't be unpacked ({e})") from e
    elif method:
        raise ValueError(f"packing method {method}")
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("the checksum is wrong")
    return data


def entries(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file in the archives under a path, from their directories alone."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with files.Ranges(files.arrow_uri(uri)) as file:
                    rows = list(directory(file, uri))
                cols = [list(c) for c in zip(*rows)] or [[] for _ in range(6)]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["archive", "name", "method", "crc", "packed", "size", "place"])

    return found.mapInArrow(run, ENTRY)


def read(some: DataFrame, parts: int | None = None, damaged: str = "stop") -> DataFrame:
    """archive, name, content, error of entries (which may be filtered before, by name or size).

    A damaged entry stops the query, or (``damaged="keep"``) has an error and no content.
    """
    spark = some.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = some.repartition(parts, "archive", "place").sortWithinPartitions("archive", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file, opened = None, None
            for archive, name, method, crc, packed, size, place in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != opened:
                    file, opened = files.Ranges(files.arrow_uri(archive)), archive
                data = error = None
                try:
                    data = content(file, method, crc, packed, size, place)
                except (ValueError, EOFError, struct.error) as e:
                    if damaged != "keep":
                        raise ValueError(f"{archive}: {name}: {e}") from e
                    error = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([name]), pa.array([data], pa.binary()), pa.array([error], pa.string())], names=["archive", "name", "content", "error"])

    return dealt.mapInArrow(run, CONTENT)


def write(df: DataFrame, path: str, archive: str = "archive", name: str = "name", data: str = "content") -> DataFrame:
    """Rows as entries of one zip file for each archive name under a path; (archive, entries) of those written.

    A task writes an archive from its sorted rows, one entry after another, and puts it in its place whole.
    """
    from .shared import kept

    base = files.qualified(df.sparkSession, path).rstrip("/")
    rows = df.select(F.col(archive).cast("string").alias("archive"), F.col(name).cast("string").alias("name"), F.col(data).alias("content")).repartition("archive").sortWithinPartitions("archive", "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        told, out, opened, n = [], None, None, 0

        def close() -> None:
            out.__exit__(None, None, None)
            told.append((opened, n))

        for batch in batches:
            for a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if a != opened:
                    if out:
                        close()
                    out, opened, n = files.Put(f"{base}/{files.quote(a)}.zip", lambda f: zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED)), a, 0
                out.file.writestr(zipfile.ZipInfo(b), c or b"", zipfile.ZIP_DEFLATED)
                n += 1
        if out:
            close()
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in told], pa.string()), pa.array([k for _, k in told], pa.int64())], names=["archive", "entries"])

    return kept(rows.mapInArrow(run, "archive string, entries long"), "archives")
