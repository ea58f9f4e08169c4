"""Trajectory records as a data source: framed Example messages (``format("trajectory")``).

A file is a row of frames: the length and its checksum, the message and its
checksum (masked CRC32C).  A message maps names to lists of bytes, floats or
integers.  A partition is a file, read in stretches of bounded size.  A damaged
record is told with its offset: it stops the query, or (option ``damaged=keep``)
becomes a row with an ``error`` and no features; where a length is wrong the
rest of the file can't be framed, which is one such row.

A task writes one file under a name of its own; all are put in their places
when all tasks are done.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from . import files

LISTS = ("bytes", "floats", "ints")
FEATURE = "struct<bytes: array<binary>, floats: array<float>, ints: array<long>>"
SCHEMA = f"path string, offset long, features map<string, {FEATURE}>, error string"
SUFFIXES = (".tfrecord", ".trajectories")
#: Bytes that are read at once, rows and bytes of a batch.
STRETCH, ROWS, BATCH_BYTES = 4 << 20, 256, 16 << 20

# -- checksums ---------------------------------------------------------------------------------

#: Fixed values of the format: the polynomial of CRC32C (reflected), and what masks a checksum.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
LANE = 64


@cache
def _bytes_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> np.uint32(1) ^ np.uint32(POLYNOMIAL), t >> np.uint32(1))
    return t


@cache
def _plain_table() -> list[int]:
    return _bytes_table().tolist()


@cache
def _behind(n: int) -> np.ndarray:
    """Tables by which n zero bytes behind change a checksum: one for each of its bytes."""
    if n == 1:
        x = np.uint32(1) << np.arange(32, dtype=np.uint32)
        basis = x >> np.uint32(8) ^ _bytes_table()[x & np.uint32(255)]
    else:
        half = _behind(n // 2)
        basis = _moved(half, _moved(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
    values = np.arange(256)
    out = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for bit in range(8):
            out[k] ^= np.where(values >> bit & 1, basis[8 * k + bit], np.uint32(0)).astype(np.uint32)
    return out


def _moved(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    return tables[0][c & np.uint32(255)] ^ tables[1][c >> np.uint32(8) & np.uint32(255)] ^ tables[2][c >> np.uint32(16) & np.uint32(255)] ^ tables[3][c >> np.uint32(24)]


def crc32c(data: bytes) -> int:
    """Checksum of the data; long data are cut into lanes that numpy takes side by side."""
    if len(data) < 8 * LANE:
        c, table = 0xFFFFFFFF, _plain_table()
        for b in data:
            c = c >> 8 ^ table[(c ^ b) & 255]
        return c ^ 0xFFFFFFFF
    lanes = 1 << (-(-len(data) // LANE) - 1).bit_length()
    rows = np.zeros(lanes * LANE, np.uint8)  # zeros in front change nothing
    rows[-len(data) :] = np.frombuffer(data, np.uint8)
    rows[len(rows) - len(data) : len(rows) - len(data) + 4] ^= 255  # the first state is all ones
    rows, c, table = rows.reshape(lanes, LANE), np.zeros(lanes, np.uint32), _bytes_table()
    for j in range(LANE):
        c = c >> np.uint32(8) ^ table[(c ^ rows[:, j]) & np.uint32(255)]
    size = LANE
    while len(c) > 1:
        c = _moved(_behind(size), c[0::2]) ^ c[1::2]
        size *= 2
    return int(c[0]) ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    c = crc32c(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


# -- messages ----------------------------------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("a number is too long")


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """Number, wire type and value of each field."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + n], at + n
            if at > len(data):
                raise ValueError("a field is cut off")
        yield key >> 3, kind, value


def _varints(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = _varint(data, at)
        out.append(v)
    return out


def _feature(data: bytes) -> dict:
    """One of the three lists; a feature without a list has none."""
    out = dict.fromkeys(LISTS)
    for k, _, body in _fields(data):
        if k == 1:
            out["bytes"] = [v for n, _, v in _fields(body) if n == 1]
        elif k == 2:
            out["floats"] = np.frombuffer(b"".join(v for n, _, v in _fields(body) if n == 1), "<f4").tolist()
        elif k == 3:
            some = [x for n, kind, v in _fields(body) if n == 1 for x in (_varints(v) if kind == 2 else [v])]
            out["ints"] = [x - (1 << 64) if x >> 63 else x for x in some]
    return out


def example(data: bytes) -> dict[str, dict]:
    """Features of a message by name; of a name that comes twice the last."""
    out: dict[str, dict] = {}
    for number, _, features in _fields(data):
        for k, _, entry in _fields(features) if number == 1 else ():
            if k == 1:
                name, value = "", b""
                for part, _, v in _fields(entry):
                    name, value = (v.decode(), value) if part == 1 else (name, v)
                out[name] = _feature(value)
    return out


def _number(v: int) -> bytes:
    v, out = v & (1 << 64) - 1, bytearray()
    while v > 127:
        out.append(v & 127 | 128)
        v >>= 7
    out.append(v)
    return bytes(out)


def _field(number: int, data: bytes) -> bytes:
    return _number(number << 3 | 2) + _number(len(data)) + data


def message(features: dict[str, dict]) -> bytes:
    """The message of the features, names in order."""
    out = b""
    for name, f in sorted(features.items()):
        value = b""
        if f and f.get("bytes") is not None:
            value = _field(1, b"".join(_field(1, bytes(v)) for v in f["bytes"]))
        elif f and f.get("floats") is not None:
            value = _field(2, _field(1, np.asarray(f["floats"], "<f4").tobytes()) if len(f["floats"]) else b"")
        elif f and f.get("ints") is not None:
            value = _field(3, _field(1, b"".join(map(_number, f["ints"]))) if len(f["ints"]) else b"")
        out += _field(1, _field(1, name.encode()) + _field(2, value))
    return _field(1, out)


def framed(data: bytes) -> bytes:
    size = struct.pack("<Q", len(data))
    return size + struct.pack("<I", masked(size)) + data + struct.pack("<I", masked(data))


class _Stretches:
    """A file from the front, read in long stretches."""

    def __init__(self, file: files.Ranges) -> None:
        self.file, self.at, self.base, self.held = file, 0, 0, b""

    def take(self, n: int) -> bytes:
        """The next n bytes, or fewer at the end."""
        if self.at + n > self.base + len(self.held):
            self.base, self.held = self.at, self.file.read(self.at, min(max(n, STRETCH), self.file.size - self.at))
        out = self.held[self.at - self.base : self.at - self.base + n]
        self.at += len(out)
        return out


def frames(file: files.Ranges) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Offset and message of each frame; for a damaged one what is wrong with it."""
    rows = _Stretches(file)
    while rows.at < file.size:
        at = rows.at
        head = rows.take(12)
        if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
            yield at, None, "the length's checksum is wrong" if len(head) == 12 else "a frame is cut off"
            return
        (n,) = struct.unpack("<Q", head[:8])
        if n + 4 > file.size - rows.at:
            yield at, None, "a frame is cut off"
            return
        data, check = rows.take(n), rows.take(4)
        yield (at, data, None) if struct.unpack("<I", check)[0] == masked(data) else (at, None, "the message's checksum is wrong")


# -- the source --------------------------------------------------------------------------------


@dataclass
class Part(D.InputPartition):
    uri: str

    def __post_init__(self) -> None:
        super().__init__(self.uri)


_KIND = pa.struct([("bytes", pa.list_(pa.binary())), ("floats", pa.list_(pa.float32())), ("ints", pa.list_(pa.int64()))])


class Reader(D.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.uri, self.keep = options["path"], options.get("damaged", "stop") == "keep"

    def partitions(self) -> list[Part]:
        return [Part(f) for f in files.listed(self.uri, SUFFIXES)] or [Part("")]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.uri:
            return
        with files.Ranges(part.uri) as file:
            held, size = [], 0
            for at, data, error in frames(file):
                features = None
                if data is not None:
                    try:
                        features = example(data)
                    except (ValueError, IndexError, KeyError, AttributeError, TypeError) as e:
                        error = f"the message can't be read ({e})"
                if error and not self.keep:
                    raise ValueError(f"{part.uri}: {error} at byte {at}")
                held.append((at, features, error))
                size += len(data or b"")
                if len(held) >= ROWS or size >= BATCH_BYTES:
                    yield self._batch(part.uri, held)
                    held, size = [], 0
            if held:
                yield self._batch(part.uri, held)

    @staticmethod
    def _batch(uri: str, rows: list) -> pa.RecordBatch:
        at, features, error = zip(*rows)
        maps = pa.array([f and list(f.items()) if f else ([] if f is not None else None) for f in features], pa.map_(pa.string(), _KIND))
        return pa.RecordBatch.from_arrays([pa.array([uri] * len(rows)), pa.array(at, pa.int64()), maps, pa.array(error, pa.string())], names=["path", "offset", "features", "error"])


@dataclass
class _Written(D.WriterCommitMessage):
    aside: str | None
    place: str | None


class Writer(D.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.uri, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(self.uri)
        name = uuid.uuid4().hex
        aside, out = f"{folder}/.{name}", None
        for batch in batches:
            for f in batch.column(batch.schema.get_field_index("features")).to_pylist():
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(aside)
                out.write(framed(message(dict(f or ()))))
        if out is None:
            return _Written(None, None)
        out.close()
        return _Written(aside, f"{folder}/{name}.tfrecord")

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.uri)
        if self.overwrite:
            for old in files.listed(self.uri, SUFFIXES):
                system.delete_file(fs.FileSystem.from_uri(old)[1])
        for m in messages:
            if m and m.aside:
                system.move(m.aside, m.place)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.uri)
        for m in messages:
            if m and m.aside:
                system.delete_file(m.aside)


class TrajectorySource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "trajectory"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def read(spark: SparkSession, path: str, damaged: str = "stop") -> DataFrame:
    """Records of the files under a path: path, offset, features (a map), error."""
    spark.dataSource.register(TrajectorySource)
    return spark.read.format("trajectory").option("damaged", damaged).load(files.qualified(spark, path))


def write(df: DataFrame, features: dict[str, Column], path: str, mode: str = "append") -> None:
    """A record for each row; features are columns of arrays (or single values) of bytes or text, floats, integers."""
    spark = df.sparkSession
    spark.dataSource.register(TrajectorySource)
    named = []
    for name, c in features.items():
        kind = df.select(c.alias("c")).schema["c"].dataType
        of = getattr(kind, "elementType", kind).simpleString()
        some = c if kind.simpleString().startswith("array") else F.when(c.isNotNull(), F.array(c))
        to = {"bytes": ("binary", "string"), "floats": ("float", "double"), "ints": ("tinyint", "smallint", "int", "bigint", "boolean")}
        own = next(k for k, types in to.items() if of in types)
        cast = {"bytes": "array<binary>", "floats": "array<float>", "ints": "array<bigint>"}
        lists = [(some if k == own else F.lit(None)).cast(cast[k]).alias(k) for k in LISTS]
        named += [F.lit(name), F.struct(*lists)]
    rows = df.select(F.lit("").alias("path"), F.lit(0).cast("long").alias("offset"), F.create_map(*named).cast(f"map<string, {FEATURE}>").alias("features"), F.lit(None).cast("string").alias("error"))
    rows.write.format("trajectory").mode(mode).save(files.qualified(spark, path))


def feature(name: str, kind: str) -> Column:
    """A feature's list of one kind: bytes, floats or ints."""
    if kind not in LISTS:
        raise ValueError(f"no list of {kind!r}")
    return F.col("features")[name][kind]


def steps(df: DataFrame, length: Column, lists: dict[str, tuple[Column, int]]) -> DataFrame:
    """One row a step: each list is cut into so many elements a step; columns of df are kept."""
    rows = df.select("*", *(c.alias(f"_{name}") for name, (c, _) in lists.items()), length.alias("_length"))
    rows = rows.filter(F.col("_length") > 0).withColumn("step", F.explode(F.sequence(F.lit(0), (F.col("_length") - 1).cast("int"))))
    return rows.select(*df.columns, "step", *(F.slice(f"_{name}", F.col("step") * n + 1, F.lit(n)).alias(name) for name, (_, n) in lists.items()))
