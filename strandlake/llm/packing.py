"""Harmonic packing of token sequences.

Lengths fall into *classes* of reciprocal capacity: class k takes pieces of
at most ``capacity // k`` tokens, and each of its bins takes k pieces.  A
document is first cut into whole sequences; of the rest, the head that fills a
class's slot exactly is cut off until what is left fits a slot with hardly a
token lost.  Classes are 1 to 16 and the powers of two above, whose slots
divide the capacity with little or no remainder.

Each worker fills the bins of its own partition, with an open bin for each
class in memory and no exchange; only the pieces of bins that stay open at its
end (one a class at most) go on.  They are packed in the same way by a
sixteenth as many workers, again and again, until one worker has the last few
open bins, fewer than a capacity for each class, and closes them by first fit
decreasing.  Every round is a table in the shared folder.

Cases: a null text is empty and holds the end id alone; repeated rows are
documents of their own; an empty table gives no piece; columns other than the
two named ones are left out.  Any text length is taken; memory holds one
batch of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, kept, tuned
from .pieces import encoder

CAPACITY = 2048
FAN_IN = 16
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
_KINDS = [*[pa.int64()] * 6, pa.binary()]


def classes(capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(pieces a bin, longest piece), longest first; the last one's piece is a single token."""
    k = [*range(1, 17), *(1 << j for j in range(5, capacity.bit_length()))]
    found = {capacity // x: x for x in k if x <= capacity}
    if 1 not in found:
        found[1] = capacity
    return [(x, slot) for slot, x in sorted(found.items(), reverse=True)]


def cuts(n: int, capacity: int = CAPACITY, loss: int = 128) -> list[int]:
    """Lengths of a document's pieces: a piece wastes no more than a ``loss``-th of its slot."""
    out = [capacity] * (n // capacity)
    n %= capacity
    slots = [slot for _, slot in classes(capacity)]
    while n:
        above = min(s for s in slots if s >= n)
        if above - n > above // loss:
            above = max(s for s in slots if s <= n)
        out.append(min(above, n))
        n -= out[-1]
    return out


class _Bins:
    """Open bins, one a class; finished rows leave at once."""

    def __init__(self, capacity: int, base: int) -> None:
        self.k = classes(capacity)
        self.slots = np.array([s for _, s in self.k][::-1])
        self.open: dict[int, list[list]] = {}
        self.next, self.rows = base, []

    def add(self, piece: list) -> None:
        c = len(self.k) - 1 - int(np.searchsorted(self.slots, piece[2]))
        bin_ = self.open.setdefault(c, [])
        bin_.append(piece)
        if len(bin_) == self.k[c][0]:
            self.close(self.open.pop(c))

    def close(self, bin_: list[list]) -> None:
        at = 0
        for p in bin_:
            p[4], p[5] = self.next, at
            at += p[2]
        self.rows += bin_
        self.next += 1

    def left(self) -> list[list]:
        return [p for c in sorted(self.open) for p in self.open[c]]

    def take(self) -> list[list]:
        out, self.rows = self.rows, []
        return out


def first_fit(bins: _Bins, pieces: list[list], capacity: int) -> None:
    """Close the last pieces, fewer than a capacity for each class, by first fit decreasing."""
    filled: list[list] = []
    room: list[int] = []
    for p in sorted(pieces, key=lambda p: -p[2]):
        b = next((i for i, r in enumerate(room) if r >= p[2]), None)
        if b is None:
            filled.append([])
            room.append(capacity)
            b = len(room) - 1
        filled[b].append(p)
        room[b] -= p[2]
    for b in filled:
        bins.close(b)


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], names=_NAMES)


def _base(round_: int) -> int:
    """First sequence id of a task: the rounds' and tasks' ranges are disjoint."""
    return (round_ << 56) | (TaskContext.get().partitionId() << 28)


def _pack_texts(path: str, end_id: int, capacity: int):
    def pack(it) -> Iterator[pa.RecordBatch]:
        enc, bins, known = encoder(path), _Bins(capacity, _base(0)), {}
        for batch in batches(it, caches=True):
            flat, n = enc.encode(batch.column(batch.schema.get_field_index("text")))
            at = 0
            for doc, k in zip(column(batch, "doc_id"), n.tolist()):
                ids = np.append(flat[at : at + k], np.uint32(end_id)).astype("<u4").tobytes()
                at, start, total = at + k, 0, k + 1
                if total not in known:
                    known[total] = cuts(total, capacity)
                for length in known[total]:
                    bins.add([doc, start, length, total, None, None, ids[4 * start : 4 * (start + length)]])
                    start += length
            if rows := bins.take():
                yield _batch(rows)
        if rows := bins.left():
            yield _batch(rows)

    return pack


def _pack_pieces(round_: int, capacity: int, last: bool):
    def pack(it) -> Iterator[pa.RecordBatch]:
        bins = _Bins(capacity, _base(round_))
        for batch in batches(it):
            for piece in zip(*(column(batch, n) for n in _NAMES)):
                bins.add(list(piece))
            if rows := bins.take():
                yield _batch(rows)
        if last:
            first_fit(bins, bins.left(), capacity)
        if rows := bins.take() + ([] if last else bins.left()):
            yield _batch(rows)

    return pack


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece, with its ids (unsigned 32-bit, little-endian), sequence and offset there."""
    tuned(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = kept(texts.mapInArrow(_pack_texts(tokenizer, end_id, capacity), PIECE_SCHEMA), "packed")
    done, workers, round_ = packed.filter("sequence_id IS NOT NULL"), max(1, packed.inputFiles().__len__()), 0
    open_ = packed.filter("sequence_id IS NULL")
    while True:
        workers, round_ = -(-workers // FAN_IN), round_ + 1
        packed = kept(open_.repartition(workers).mapInArrow(_pack_pieces(round_, capacity, workers == 1), PIECE_SCHEMA), "packed")
        done = done.unionByName(packed.filter("sequence_id IS NOT NULL"))
        if workers == 1:
            return done
        open_ = packed.filter("sequence_id IS NULL")
