"""Token-ID store: every id in the fewest bits that the vocabulary needs.

A store is a folder of Parquet files, written by Spark's committer, so a lost
executor or a repeated task leaves no half file.  Each row is a *shard*: a
self-contained binary image (``blob``) of consecutive documents in ascending
``doc_id``::

    magic 'TKS1' | bits u8 | block u32 | n_docs u64 | n_ids u64        (25 bytes)
    doc_id i64[n_docs] | doc_null u8[n_docs] | doc_start u64[n_docs + 1]
    block_offset u64[n_blocks + 1]                                     (bytes)
    payload: blocks of ``block`` ids, ``bits`` bits an id, little-endian

All numbers are little-endian; each block starts at a byte, so a reader goes
to any id through ``block_offset`` and unpacks whole blocks with numpy.
(part, seq) gives the shards' order over the whole store.

Cases: a null text is empty and holds the end id alone; a null ``doc_id``
comes first; repeated rows are documents of their own, in any order among
themselves; an empty table gives an empty store; columns other than the two
named ones are left out.  Long texts are encoded whole, a shard then holds
one document.  Spark bounds a value at 2 GB: a text is below that, and a
document of 2^29 ids or more raises an error in the reader, which returns rows.
An added token of the tokenizer that stands in a text becomes its id.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, column, shared_folder, tuned
from .pieces import encoder

MAGIC, HEAD = b"TKS1", "<4sBIQQ"
SHARD_IDS = 1 << 20
BLOCK_IDS = 4096
#: A row's binary holds less than 2 GB (Spark's and Arrow's bound), so fewer ids than this.
ROW_IDS = 1 << 29
SHARD_SCHEMA = "part int, seq int, part_start long, n_docs long, n_ids long, first_doc long, last_doc long, blob binary"


def bits_for(vocab: int) -> int:
    return max(1, int(vocab - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another, ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flags = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(flags, bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    whole = np.zeros((n, 32), np.uint8)
    whole[:, :bits] = flags
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


def shard_image(doc_ids: list, lengths: list[int], ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> bytes:
    parts = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    return b"".join(
        [
            struct.pack(HEAD, MAGIC, bits, block, len(doc_ids), len(ids)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes(),
            np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("<u8").tobytes(),
            *parts,
        ]
    )


class Shard:
    """Random access to a shard's image."""

    def __init__(self, blob: bytes) -> None:
        magic, self.bits, self.block, self.n_docs, self.n_ids = struct.unpack_from(HEAD, blob)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEAD)
        self.blob = memoryview(blob)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]
        self.starts = take("<u8", self.n_docs + 1).astype(np.int64)
        self.offsets = take("<u8", -(-self.n_ids // self.block) + 1).astype(np.int64)
        self.payload = at

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end): only the blocks that hold them are unpacked."""
        if start >= end:
            return np.zeros(0, np.uint32)
        lo, hi = start // self.block, -(-end // self.block)
        n = min(hi * self.block, self.n_ids) - lo * self.block
        if self.block * self.bits % 8 == 0:  # blocks have no padding between them
            data = self.blob[self.payload + self.offsets[lo] : self.payload + self.offsets[hi]]
            out = unpack(data, n, self.bits)
        else:
            out = np.concatenate([unpack(self.blob[self.payload + self.offsets[b] : self.payload + self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits) for b in range(lo, hi)])
        return out[start - lo * self.block : end - lo * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _shards(path: str, end_id: int, shard_ids: int):
    def write(it) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        bits, part = bits_for(enc.vocab), TaskContext.get().partitionId()
        docs, lengths, ids, seq, start, held = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, held
            every = np.concatenate(ids)
            known = [d for d in docs if d is not None]
            row = [part, seq, start, len(docs), len(every), min(known, default=None), max(known, default=None), shard_image(docs, lengths, every, bits)]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=["part", "seq", "part_start", "n_docs", "n_ids", "first_doc", "last_doc", "blob"])
            seq, start, held = seq + 1, start + len(every), 0
            for x in (docs, lengths, ids):
                x.clear()
            return out

        for batch in batches(it, caches=True):
            flat, n = enc.encode(batch.column(batch.schema.get_field_index("text")))
            at = 0
            for doc, k in zip(column(batch, "doc_id"), n.tolist()):
                if docs and held + k + 1 > shard_ids:
                    yield flush()
                docs.append(doc)
                lengths.append(k + 1)
                held += k + 1
                ids += [flat[at : at + k], np.array([end_id], np.uint32)]
                at += k
        if docs:
            yield flush()

    return write


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> str:
    """Encode whole texts and write them in ascending document id; the store's path.

    One range shuffle of the texts; each range is then encoded, packed and
    written by one task as it goes, a shard in memory at a time.
    """
    spark = tuned(docs.sparkSession)
    path = shared_folder(spark, "tokens")
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_shards(tokenizer, end_id, shard_ids), SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)
    return path


def _documents(it) -> Iterator[pa.RecordBatch]:
    for batch in batches(it):
        for blob, start in zip(batch.column(0), batch.column(1)):
            shard = Shard(blob.as_py())
            flat = shard.ids(0, shard.n_ids).astype("<u4")
            n = np.diff(shard.starts)
            if shard.n_ids >= ROW_IDS:
                raise ValueError(f"a document of {shard.n_ids} ids doesn't fit a row; read it by Shard.ids")
            ends = pa.array(np.concatenate([[0], shard.starts[1:] * 4]).astype(np.int32))
            ids = pa.Array.from_buffers(pa.binary(), shard.n_docs, [None, ends.buffers()[1], pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(shard.starts[:-1] + start.as_py()), pa.array(n), ids], names=["doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit, little-endian).

    The driver sees one total for each writing task, nothing of a document's.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases, before = [], 0
    for part, n in totals:
        bases.append((part, before))
        before += n
    base = spark.createDataFrame(bases, "part int, base long")
    at = shards.join(base, "part").select("blob", (F.col("base") + F.col("part_start")).alias("start"))
    return at.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Random access: the shards that may hold ``doc_id``, and of them its blocks alone."""
    rows = spark.read.schema(SHARD_SCHEMA).parquet(path).filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).select("blob").toLocalIterator()
    found = []
    for row in rows:
        shard = Shard(bytes(row.blob))
        found += [shard.document(i) for i, d in enumerate(shard.doc_ids) if d == doc_id]
    return found
