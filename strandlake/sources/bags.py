"""Bag files of topic messages as a data source: MCAP (read and write) and db3 (read).

``format("bag")`` has a row for each message.  An MCAP file ends with an index of
its chunks (times, channels, place): a partition is a run of chunks, and chunks
whose times or channels a filter excludes aren't read.  A db3 file is a B-tree of
pages: a partition is a run of leaf pages; of a message that a filter excludes
only the first columns are looked at.  Filters on ``topic`` and ``log_time`` that
Spark pushes down are used for this.

With up to ``PLANNED`` files their indexes are read while the query is planned;
beyond that a file is a partition, whose task reads the index, so that planning
doesn't grow with the corpus.

A task writes one MCAP file under a name of its own; the files are put in their
places when all tasks are done, so tasks that run again leave no message twice.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D

from . import files

SCHEMA = "path string, topic string, type string, log_time long, publish_time long, sequence long, data binary"
#: Files whose index is read while planning, bytes of chunks of a partition, and rows of a batch.
PLANNED, PART_BYTES, ROWS = 256, 32 << 20, 512
LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass
class Wanted:
    """Messages that are asked for: topics (None: all) and times from ``start`` to ``end``, both included."""

    topics: frozenset[str] | None = None
    start: int = LEAST
    end: int = MOST

    def narrowed(self, f: D.Filter) -> bool:
        """Take a filter in; False if it is none of these."""
        column = getattr(f, "attribute", None)
        if column == ("topic",) and isinstance(f, (D.EqualTo, D.In)):
            some = frozenset([f.value] if isinstance(f, D.EqualTo) else f.value)
            self.topics = some if self.topics is None else self.topics & some
        elif column == ("log_time",) and isinstance(f, (D.EqualTo, D.GreaterThan, D.GreaterThanOrEqual, D.LessThan, D.LessThanOrEqual)):
            if not isinstance(f, (D.LessThan, D.LessThanOrEqual)):
                self.start = max(self.start, f.value + isinstance(f, D.GreaterThan))
            if not isinstance(f, (D.GreaterThan, D.GreaterThanOrEqual)):
                self.end = min(self.end, f.value - isinstance(f, D.LessThan))
        else:
            return False
        return True

    def topic(self, name: str) -> bool:
        return self.topics is None or name in self.topics

    def time(self, t: int) -> bool:
        return self.start <= t <= self.end


@dataclass
class Part(D.InputPartition):
    """Chunks (start, length) or leaf pages of a file; None: all of its index."""

    uri: str
    places: list | None = None

    def __post_init__(self) -> None:
        super().__init__(self.uri)


class Damaged(ValueError):
    """A file that doesn't follow its format, with the place."""

    def __init__(self, uri: str, at: int, what: str) -> None:
        super().__init__(f"{uri}: {what} at byte {at}")


Message = tuple[str, str, int, int, int, bytes]  # topic, type, log time, publish time, sequence, data


# -- MCAP ------------------------------------------------------------------------------------

#: Fixed values of the format: magic bytes, and the codes of its records.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA_RECORD, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX, STATISTICS, SUMMARY_OFFSET, DATA_END = 1, 2, 3, 4, 5, 6, 7, 8, 11, 14, 15


class _Fields:
    """Fields of a record, one after another."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def number(self, kind: str) -> int:
        (value,) = struct.unpack_from("<" + kind, self.data, self.at)
        self.at += struct.calcsize("<" + kind)
        return value

    def blob(self, kind: str = "I") -> bytes:
        n = self.number(kind)
        self.at += n
        if self.at > len(self.data):
            raise ValueError("a field goes beyond its record")
        return self.data[self.at - n : self.at]

    def text(self) -> str:
        return self.blob().decode()

    def pairs(self, key: str, value: str) -> dict[int, int]:
        rows = _Fields(self.blob())
        out = {}
        while rows.at < len(rows.data):
            k = rows.number(key)
            out[k] = rows.number(value)
        return out


def records(data: bytes, uri: str = "", base: int = 0) -> Iterator[tuple[int, bytes]]:
    """Code and content of each record."""
    at = 0
    while at < len(data):
        if at + 9 > len(data):
            raise Damaged(uri, base + at, "a record is cut off")
        code, n = struct.unpack_from("<BQ", data, at)
        if at + 9 + n > len(data):
            raise Damaged(uri, base + at, "a record is cut off")
        yield code, data[at + 9 : at + 9 + n]
        at += 9 + n


def _unpacked(kind: str, data: bytes, size: int) -> bytes:
    if kind == "":
        return data
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
    if kind == "lz4":
        return pa.decompress(data, size, "lz4", asbytes=True)
    raise ValueError(f"compression {kind!r}")


@dataclass
class _Index:
    """Channels and chunks of an MCAP file: id to (topic, type); (start, length, first time, last time, channels)."""

    channels: dict[int, tuple[str, str]] = field(default_factory=dict)
    chunks: list[tuple[int, int, int, int, frozenset[int]]] = field(default_factory=list)


def _note(code: int, content: bytes, types: dict[int, str], channels: dict[int, tuple[str, str]]) -> None:
    f = _Fields(content)
    if code == SCHEMA_RECORD:
        k = f.number("H")
        types[k] = f.text()
    elif code == CHANNEL:
        k, of = f.number("H"), f.number("H")
        channels[k] = (f.text(), types.get(of, ""))


def mcap_index(file: files.Ranges, uri: str) -> _Index:
    """Index at the file's end; where a writer died before it was written, the chunks that are whole are found from the front."""
    if file.size < 8 or file.read(0, 8) != MAGIC:
        raise Damaged(uri, 0, "no magic bytes")
    out, types = _Index(), {}
    tail = 9 + 20 + 8
    if file.size >= tail + 8 and file.read(file.size - 8, 8) == MAGIC:
        footer = _Fields(file.read(file.size - tail + 9, 20))
        start = footer.number("Q")
        if start:
            for code, content in records(file.read(start, file.size - tail - start), uri, start):
                _note(code, content, types, out.channels)
                if code == CHUNK_INDEX:
                    f = _Fields(content)
                    first, last, at, n = (f.number("Q") for _ in range(4))
                    out.chunks.append((at, n, first, last, frozenset(f.pairs("H", "Q"))))
            return out
    at = 8
    while at + 9 <= file.size:
        code, n = struct.unpack("<BQ", file.read(at, 9))
        if at + 9 + n > file.size or code == DATA_END:
            break
        if code == CHUNK:
            f = _Fields(file.read(at + 9, min(n, 28)))
            out.chunks.append((at, 9 + n, f.number("Q"), f.number("Q"), frozenset()))
        elif code in (SCHEMA_RECORD, CHANNEL):
            _note(code, file.read(at + 9, n), types, out.channels)
        elif code == MESSAGE:
            raise Damaged(uri, at, "a message outside of a chunk")
        at += 9 + n
    return out


def _mcap_wanted(index: _Index, want: Wanted) -> list[tuple[int, int]]:
    some = {k for k, (topic, _) in index.channels.items() if want.topic(topic)}
    return [(at, n) for at, n, first, last, channels in index.chunks if last >= want.start and first <= want.end and (not channels or channels & some)]


def mcap_messages(file: files.Ranges, uri: str, chunks: list[tuple[int, int]], channels: dict[int, tuple[str, str]], want: Wanted) -> Iterator[Message]:
    channels, types = dict(channels), {}
    for at, n in chunks:
        f = _Fields(file.read(at + 9, n - 9))
        f.number("Q"), f.number("Q")
        size, crc = f.number("Q"), f.number("I")
        kind = f.text()
        try:
            data = _unpacked(kind, f.blob("Q"), size)
        except Exception as e:
            raise Damaged(uri, at, f"a chunk can't be unpacked ({e})") from e
        if len(data) != size or crc and zlib.crc32(data) != crc:
            raise Damaged(uri, at, "a chunk's checksum is wrong")
        for code, content in records(data, uri, at):
            if code in (SCHEMA_RECORD, CHANNEL):
                _note(code, content, types, channels)
            elif code == MESSAGE:
                channel, sequence, log, publish = struct.unpack_from("<HIQQ", content)
                topic, type_ = channels[channel]
                if want.time(log) and want.topic(topic):
                    yield topic, type_, log, publish, sequence, content[22:]


def _record(code: int, content: bytes) -> bytes:
    return struct.pack("<BQ", code, len(content)) + content


def _text(s: str) -> bytes:
    b = s.encode()
    return struct.pack("<I", len(b)) + b


class McapWriter:
    """One MCAP file of compressed chunks with their indexes."""

    def __init__(self, out, chunk_bytes: int, compression: str) -> None:
        self.out, self.chunk_bytes, self.compression, self.at = out, chunk_bytes, compression, 0
        self.channels: dict[tuple[str, str], int] = {}
        self.types: dict[str, int] = {}
        self.described = b""
        self.indexes: list[bytes] = []
        self.counts: dict[int, int] = {}
        self.first, self.last = MOST, 0
        self._put(MAGIC + _record(HEADER, _text("ros2") + _text("strandlake")))
        self._open()

    def _put(self, data: bytes) -> int:
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return at

    def _open(self) -> None:
        self.chunk, self.held, self.messages = [], 0, {}

    def _append(self, data: bytes) -> None:
        self.chunk.append(data)
        self.held += len(data)

    def add(self, topic: str, type_: str, log: int, publish: int, sequence: int, data: bytes) -> None:
        if type_ not in self.types:
            self.types[type_] = len(self.types) + 1
            self.described += (new := _record(SCHEMA_RECORD, struct.pack("<H", self.types[type_]) + _text(type_) + _text("ros2msg") + _text("")))
            self._append(new)
        if (topic, type_) not in self.channels:
            k = self.channels[topic, type_] = len(self.channels)
            self.described += (new := _record(CHANNEL, struct.pack("<HH", k, self.types[type_]) + _text(topic) + _text("cdr") + _text("")))
            self._append(new)
        k = self.channels[topic, type_]
        self.messages.setdefault(k, []).append((log, self.held))
        self._append(_record(MESSAGE, struct.pack("<HIQQ", k, sequence, log, publish) + data))
        self.counts[k] = self.counts.get(k, 0) + 1
        if self.held >= self.chunk_bytes:
            self._close_chunk()

    def _close_chunk(self) -> None:
        if not self.held:
            return
        raw = b"".join(self.chunk)
        times = [t for rows in self.messages.values() for t, _ in rows] or [0]
        first, last = min(times), max(times)
        self.first, self.last = min(self.first, first), max(self.last, last)
        packed = raw
        if self.compression == "zstd":
            import zstandard

            packed = zstandard.ZstdCompressor().compress(raw)
        body = _record(CHUNK, struct.pack("<QQQI", first, last, len(raw), zlib.crc32(raw)) + _text(self.compression) + struct.pack("<Q", len(packed)) + packed)
        at, places, indexes = self._put(body), b"", b""
        for k, rows in sorted(self.messages.items()):
            places += struct.pack("<HQ", k, self.at + len(indexes))
            pairs = b"".join(struct.pack("<QQ", t, o) for t, o in sorted(rows))
            indexes += _record(MESSAGE_INDEX, struct.pack("<HI", k, len(pairs)) + pairs)
        self._put(indexes)
        self.indexes.append(_record(CHUNK_INDEX, struct.pack("<QQQQI", first, last, at, len(body), len(places)) + places + struct.pack("<Q", len(indexes)) + _text(self.compression) + struct.pack("<QQ", len(packed), len(raw))))
        self._open()

    def close(self) -> None:
        self._close_chunk()
        self._put(_record(DATA_END, struct.pack("<I", 0)))
        counts = b"".join(struct.pack("<HQ", k, n) for k, n in sorted(self.counts.items()))
        total = sum(self.counts.values())
        stats = _record(STATISTICS, struct.pack("<QHIIIIQQI", total, len(self.types), len(self.channels), 0, 0, len(self.indexes), self.first if total else 0, self.last, len(counts)) + counts)
        start = self._put(self.described + b"".join(self.indexes) + stats)
        self._put(_record(FOOTER, struct.pack("<QQI", start, 0, 0)) + MAGIC)


# -- db3 -------------------------------------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = 0
    for i in range(8):
        b = data[at + i]
        value = value << 7 | b & 127
        if b < 128:
            return value, at + i + 1
    value = value << 8 | data[at + 8]
    return (value - (1 << 64) if value >> 63 else value), at + 9


class Pages:
    """Tables of a db3 file, page by page."""

    def __init__(self, file: files.Ranges, uri: str) -> None:
        self.file, self.uri = file, uri
        head = file.read(0, 100)
        if head[:16] != b"SQLite format 3\x00":
            raise Damaged(uri, 0, "no db3 header")
        self.size = int.from_bytes(head[16:18], "big")
        self.size = 65536 if self.size == 1 else self.size
        self.usable = self.size - head[20]
        self.encoding = {2: "utf-16-le", 3: "utf-16-be"}.get(int.from_bytes(head[56:60], "big"), "utf-8")

    def _page(self, number: int) -> tuple[bytes, int]:
        return self.file.read((number - 1) * self.size, self.size), 100 if number == 1 else 0

    def _cells(self, page: bytes, head: int) -> list[int]:
        n, at = int.from_bytes(page[head + 3 : head + 5], "big"), head + (12 if page[head] == 5 else 8)
        return [int.from_bytes(page[at + 2 * i : at + 2 * i + 2], "big") for i in range(n)]

    def leaves(self, root: int) -> list[int]:
        """Leaf pages of a table in the order of its rows; only inner pages are read, and the first leaf below each."""
        page, head = self._page(root)
        if page[head] == 13:
            return [root]
        if page[head] != 5:
            raise Damaged(self.uri, (root - 1) * self.size, "no page of a table")
        below = [int.from_bytes(page[c : c + 4], "big") for c in self._cells(page, head)] + [int.from_bytes(page[head + 8 : head + 12], "big")]
        first, h = self._page(below[0])
        return below if first[h] == 13 else [x for b in below for x in self.leaves(b)]

    def rows(self, leaf: int, columns: int | None = None, keep=None) -> Iterator[list]:
        """Rows of a leaf; the row's number stands for a null in the first column.

        ``keep`` is asked with the first ``columns`` values before the rest of a row is fetched.
        """
        page, head = self._page(leaf)
        if page[head] != 13:
            raise Damaged(self.uri, (leaf - 1) * self.size, "no leaf of a table")
        for at in self._cells(page, head):
            n, at = _varint(page, at)
            number, at = _varint(page, at)
            most, least = self.usable - 35, (self.usable - 12) * 32 // 255 - 23
            held = n if n <= most else (k if (k := least + (n - least) % (self.usable - 4)) <= most else least)
            payload = page[at : at + held]
            if keep:
                some = self._values(payload, number, columns)
                if len(some) == columns and not keep(some):
                    continue
            if held < n:
                parts, link = [payload], int.from_bytes(page[at + held : at + held + 4], "big")
                while link:
                    more, _ = self._page(link)
                    parts.append(more[4 : self.usable])
                    link = int.from_bytes(more[:4], "big")
                payload = b"".join(parts)[:n]
                if len(payload) < n:
                    raise Damaged(self.uri, (leaf - 1) * self.size, "a row is cut off")
            yield self._values(payload, number)

    def _values(self, data: bytes, number: int, most: int | None = None) -> list:
        end, at = _varint(data, 0)
        kinds = []
        while at < end:
            k, at = _varint(data, at)
            kinds.append(k)
        out, at = [], end
        for k in kinds[:most]:
            n = (0, 1, 2, 3, 4, 6, 8, 8, 0, 0)[k] if k < 10 else (k - 12) // 2 if k >= 12 else 0
            if at + n > len(data):
                break
            raw = data[at : at + n]
            at += n
            out.append(None if k == 0 else k - 8 if k in (8, 9) else struct.unpack(">d", raw)[0] if k == 7 else int.from_bytes(raw, "big", signed=True) if k < 7 else raw if k % 2 == 0 else raw.decode(self.encoding))
        if out and out[0] is None:
            out[0] = number
        return out

    def roots(self) -> dict[str, int]:
        return {r[1]: r[3] for leaf in self.leaves(1) for r in self.rows(leaf) if r[0] == "table"}


def db3_topics(pages: Pages) -> dict[int, tuple[str, str]]:
    return {r[0]: (r[1], r[2]) for leaf in pages.leaves(pages.roots()["topics"]) for r in pages.rows(leaf)}


def db3_messages(pages: Pages, leaves: list[int], topics: dict[int, tuple[str, str]], want: Wanted) -> Iterator[Message]:
    keep = lambda r: want.time(r[2]) and want.topic(topics[r[1]][0])
    for leaf in leaves:
        for number, of, t, data in pages.rows(leaf, 3, keep):
            if keep((number, of, t)):
                yield *topics[of], t, t, number, data


# -- the source ------------------------------------------------------------------------------


def _plan(uri: str, want: Wanted, part_bytes: int) -> list[list]:
    """Places of a file that may hold wanted messages, in partitions of about so many bytes."""
    with files.Ranges(uri) as file:
        if uri.endswith(".db3"):
            pages = Pages(file, uri)
            places, sizes = pages.leaves(pages.roots()["messages"]), None
            step = max(1, part_bytes // pages.size)
            return [places[i : i + step] for i in range(0, len(places), step)]
        places, out, held = _mcap_wanted(mcap_index(file, uri), want), [], part_bytes
        for at, n in places:
            if held >= part_bytes:
                out.append([])
                held = 0
            out[-1].append((at, n))
            held += n
        return out


class BagReader(D.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.uri, self.want = options["path"], Wanted()
        self.part_bytes = int(options.get("part_bytes", PART_BYTES))

    def pushFilters(self, filters: list[D.Filter]):
        for f in filters:
            if not self.want.narrowed(f):
                yield f

    def partitions(self) -> list[Part]:
        found = files.listed(self.uri, (".mcap", ".db3"))
        if len(found) > PLANNED:
            return [Part(f) for f in found]
        with ThreadPoolExecutor(16) as pool:
            return [Part(f, p) for f, parts in zip(found, pool.map(lambda f: _plan(f, self.want, self.part_bytes), found)) for p in parts] or [Part("", [])]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.uri:
            return
        with files.Ranges(part.uri) as file:
            if part.uri.endswith(".db3"):
                pages = Pages(file, part.uri)
                leaves = part.places if part.places is not None else pages.leaves(pages.roots()["messages"])
                rows = db3_messages(pages, leaves, db3_topics(pages), self.want)
            else:
                index = mcap_index(file, part.uri)
                chunks = part.places if part.places is not None else _mcap_wanted(index, self.want)
                rows = mcap_messages(file, part.uri, chunks, index.channels, self.want)
            held, size = [], 0
            for m in rows:
                held.append(m)
                size += len(m[-1])
                if len(held) >= ROWS or size >= 16 << 20:
                    yield _batch(part.uri, held)
                    held, size = [], 0
            if held:
                yield _batch(part.uri, held)


def _batch(uri: str, rows: list[Message]) -> pa.RecordBatch:
    topic, type_, log, publish, sequence, data = zip(*rows)
    cols = [pa.array([uri] * len(rows)), pa.array(topic), pa.array(type_), pa.array(log, pa.int64()), pa.array(publish, pa.int64()), pa.array(sequence, pa.int64()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["path", "topic", "type", "log_time", "publish_time", "sequence", "data"])


@dataclass
class _Written(D.WriterCommitMessage):
    aside: str | None
    place: str | None


class BagWriter(D.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.uri, self.overwrite = options["path"].rstrip("/"), overwrite
        self.chunk_bytes, self.compression = int(options.get("chunk_bytes", 1 << 20)), options.get("compression", "zstd")
        if self.compression not in ("", "zstd"):
            raise ValueError(f"compression {self.compression!r}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyarrow import fs

        name = uuid.uuid4().hex
        system, folder = fs.FileSystem.from_uri(self.uri)
        aside, bag, out = f"{folder}/.{name}", None, None
        for batch in batches:
            rows = batch.to_pydict()
            for row in zip(rows["topic"], rows["type"], rows["log_time"], rows["publish_time"], rows["sequence"], rows["data"]):
                if bag is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(aside)
                    bag = McapWriter(out, self.chunk_bytes, self.compression)
                bag.add(*row)
        if bag is None:
            return _Written(None, None)
        bag.close()
        out.close()
        return _Written(aside, f"{folder}/{name}.mcap")

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.uri)
        if self.overwrite:
            for old in files.listed(self.uri, (".mcap", ".db3")):
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


class BagSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "bag"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BagReader:
        return BagReader(self.options)

    def writer(self, schema, overwrite: bool) -> BagWriter:
        return BagWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BagSource)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """Messages of the bag files under a path: path, topic, type, log_time, publish_time (ns), sequence, data."""
    register(spark)
    return spark.read.format("bag").options(**options).load(files.qualified(spark, path))


def write(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Write messages (topic, type, log_time, data; publish_time and sequence if there) as MCAP files.

    Files are ranges of time, in order, so that a reader's filter on time leaves most of them alone.
    """
    from pyspark.sql import functions as F

    spark = df.sparkSession
    register(spark)
    other = {"publish_time": F.col("log_time"), "sequence": F.lit(0)}
    cols = [F.lit("").alias("path"), "topic", "type", "log_time", *((F.col(c) if c in df.columns else v).cast("long").alias(c) for c, v in other.items()), "data"]
    rows = df.select(*cols).repartitionByRange("log_time").sortWithinPartitions("log_time", "topic")
    rows.write.format("bag").options(**options).mode(mode).save(files.qualified(spark, path))
