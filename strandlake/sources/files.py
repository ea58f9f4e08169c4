"""Files of the cluster's file system, from the driver (through Hadoop) and from tasks (through Arrow)."""

from __future__ import annotations

import uuid
from urllib.parse import quote, urlsplit

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with scheme and host, those of the default file system where it names none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(conf).makeQualified(p).toUri().toASCIIString()
    return "file://" + out.removeprefix("file:") if out.startswith("file:/") and not out.startswith("file://") else out


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def publish(spark: SparkSession, path: str, data: bytes) -> bool:
    """Put a whole file in its place unless one is there; False if there is.

    It is written aside and renamed, which the file system does at once or not at all.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    fs = place.getFileSystem(conf)
    fs.mkdirs(place.getParent())
    out = fs.create(aside, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if not fs.exists(place):
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(place), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Exception as e:  # another writer was faster
            if "FileAlreadyExists" not in str(e):
                raise
    fs.delete(aside, False)
    return False


def put(uri: str, data: bytes) -> None:
    """Write a whole file from a task: aside first, then in its place."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as f:
        f.write(data)
    system.move(aside, path)


def listed(uri: str, suffixes: tuple[str, ...]) -> list[str]:
    """URIs of the files under a folder (or of the file itself) with one of the suffixes, from any process."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    parts = urlsplit(uri)
    head = f"{parts.scheme}://{parts.netloc if path.startswith('/') else ''}"
    if system.get_file_info(path).type == fs.FileType.File:
        return [uri]
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted(head + quote(f.path) for f in found if f.type == fs.FileType.File and f.path.endswith(suffixes) and not f.base_name.startswith((".", "_")))


class Ranges:
    """Byte ranges of a file on any file system."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(uri)
        self._file = system.open_input_file(path)
        self.size = self._file.size()

    def read(self, at: int, n: int) -> bytes:
        if at < 0 or n < 0 or at + n > self.size:
            raise EOFError(f"bytes {at} to {at + n} of {self.size}")
        return self._file.read_at(n, at)

    def __enter__(self) -> "Ranges":
        return self

    def __exit__(self, *_) -> None:
        self._file.close()


def arrow_uri(path: str) -> str:
    """The URI, as Arrow wants it, of a path as Spark names it (with a scheme, and nothing escaped)."""
    scheme, _, rest = path.partition(":")
    host, at = "", rest
    if rest.startswith("//"):
        host, slash, at = rest[2:].partition("/")
        at = slash + at
    return f"{scheme}://{host}{quote(at)}"


class Put:
    """A file that is written aside by ``wrap``'s writer and put in its place on exit."""

    def __init__(self, uri: str, wrap) -> None:
        from pyarrow import fs

        self._system, self._path = fs.FileSystem.from_uri(uri)
        self._system.create_dir(self._path.rpartition("/")[0], recursive=True)
        self._aside = f"{self._path}.{uuid.uuid4().hex}"
        self._out = self._system.open_output_stream(self._aside)
        self.file = wrap(self._out)

    def __exit__(self, *_) -> None:
        self.file.close()
        self._out.close()
        self._system.move(self._aside, self._path)


def move(spark: SparkSession, old: str, new: str) -> bool:
    """Give a folder its name unless there is one of that name; False if there is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = a.getFileSystem(conf)
    return not fs.exists(b) and fs.rename(a, b)
