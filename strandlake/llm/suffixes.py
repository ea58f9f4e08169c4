"""Removal of repeated byte strings with a sampled, distributed suffix array.

Every byte that a 200-byte string covers goes, if that string starts anywhere
else too, in the same document or another.  Strings are judged on the input.

*Sampling.*  Of each 200-byte string, the 64-byte seeds in it with the least
hash are *anchors*.  Equal strings have equal anchors, so a string repeats only
if an anchor's seed repeats, and only the suffixes at anchors (one in about 70)
need be sorted.  An anchor stands for the strings that hold its seed: those
that start up to 136 bytes before it.  Its *context* is all that they cover.

*Counting.*  Anchors meet by seed, as packed arrays: one for each task and
receiver.  Seeds that occur once are done with.  Anchors whose whole context
occurs again are done with too: all their strings repeat.  What is left are the
edges of repeated passages.

*Merge sort.*  Their suffixes, once for each distinct context, are sorted by
the tasks that read the texts, front-coded (length of the prefix shared with
the one before, then the rest) and exchanged as runs, by seed.  Each receiver
merges its runs with a loser tree that knows the prefix each head shares with
the last suffix put out and never compares it again.  The merged order with its
shared prefixes R, and the same of the reversed left contexts L, tell for each
anchor which strings occur elsewhere: one that starts l bytes before it and
ends 200 - l bytes behind its start needs another suffix in the same range of
prefixes of 200 - l bytes whose left context agrees in l bytes.

*Equality.*  Seeds are only gathered by a hash; merged suffixes are compared as
bytes.  Whole contexts count as equal when their 128-bit BLAKE2b digests are (no
two texts with equal digests are known or can be made).  A seed with more than
``HOT`` distinct contexts would be too large a group for one task's merge; its
strings are counted one by one, by digest too, in a distributed aggregation.

Cases: null and empty texts, and those under 200 bytes, lose nothing; repeated
rows are documents of their own and so lose all from 200 bytes on; a null
doc_id is a document like any other; further columns are left out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import batches, column, kept, packed, tuned, unpacked

WIDTH, SEED = 200, 64
#: Strings that hold a seed start so far before it, at most.
REACH = WIDTH - SEED
#: Groups of more distinct contexts are not gathered but counted string by string.
HOT = 50_000
#: Bytes of text for each receiver.
PART_BYTES = 32 << 20
RUN_BYTES = 64 << 20


def _sliding(x: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum of all stretches of ``width`` entries, from block-wise running ones."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, fill, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Starts of the seeds that have the least hash of a 200-byte string (ties count all)."""
    seeds = rolling.windows(sums, SEED)
    width = REACH + 1
    if len(seeds) < width:
        return np.zeros(0, np.int64)
    least = _sliding(seeds, width, np.minimum, 2**64 - 1)
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    return np.flatnonzero(_sliding(around, width, np.maximum, 0) == seeds)


def digests(pieces: list[bytes]) -> np.ndarray:
    """128-bit BLAKE2b of each, as two numbers."""
    return np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in pieces), "<i8").reshape(-1, 2)


def described(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor: position, bytes to the right (200 at most), hash of the seed, digest of the context (n x 2)."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return none, none, none, none
    sums = rolling.prefix(data)
    at = anchors(data, sums)
    right = np.minimum(WIDTH, len(data) - at)
    left = np.minimum(REACH, at)
    context = digests([raw[a:b] for a, b in zip((at - left).tolist(), (at + right).tolist())]).copy()
    context[:, 0] ^= rolling.mixed((left * 256 + right).astype(np.uint64)).view(np.int64)  # where in it the seed stands
    return at, right, rolling.stretches(sums, at, at + SEED).view(np.int64), context


_ANCHOR = np.dtype([("seed", "<i8"), ("context", "<i8"), ("context2", "<i8"), ("doc", "<i8"), ("hash", "<i8"), ("pos", "<i4"), ("right", "<i4"), ("done", "u1")])
_COVER = np.dtype([("doc", "<i8"), ("hash", "<i8"), ("lo", "<i8"), ("hi", "<i8")])
#: A null doc_id in packed arrays.
_NULL = np.iinfo(np.int64).min
FLUSH = 1 << 19


def _groups(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by seed and context, where each pair begins, and how many rows it has."""
    e = e[np.lexsort((e["context2"], e["context"], e["seed"]))]
    new = np.ones(len(e), bool)
    new[1:] = (e["seed"][1:] != e["seed"][:-1]) | (e["context"][1:] != e["context"][:-1]) | (e["context2"][1:] != e["context2"][:-1])
    first = np.flatnonzero(new)
    return e, first, np.diff(np.append(first, len(e)))


def covers(e: np.ndarray) -> np.ndarray:
    """Ranges of bytes that the anchors' strings cover, united where they meet."""
    e = e[np.lexsort((e["pos"], e["hash"], e["doc"]))]
    lo, hi = np.maximum(0, e["pos"] - REACH), e["pos"] + e["right"]  # both grow with the position
    new = np.ones(len(e), bool)
    new[1:] = (e["doc"][1:] != e["doc"][:-1]) | (e["hash"][1:] != e["hash"][:-1]) | (lo[1:] > hi[:-1])
    first = np.flatnonzero(new)
    out = np.empty(len(first), _COVER)
    out["doc"], out["hash"], out["lo"] = e["doc"][first], e["hash"][first], lo[first]
    out["hi"] = hi[np.append(first[1:], len(e)) - 1] if len(e) else 0
    return out


def _anchor_runs(parts: int):
    """Anchors as packed arrays for the receivers of their seeds (kind 1).

    Contexts that repeat within a task are done there: what they cover goes out
    as ranges (kind 0), and one anchor stands for them from then on.  So a
    passage of any number of documents reaches a receiver once from each task.
    """

    def run(it) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            e, first, n = _groups(np.concatenate(held))
            held.clear()
            many = np.repeat(n > 1, n)
            found, e = covers(e[many]), e[first]
            e["done"] = n > 1
            rows = []
            for kind, (every, by) in enumerate(((found, found["hash"]), (e, e["seed"]))):
                part = rolling.mixed(by.astype(np.uint64)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                used, at = np.unique(part[order], return_index=True)
                rows += [(kind, int(p), packed(x)) for p, x in zip(used, np.split(every[order], at[1:]))]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["kind", "part", "blob"])

        for batch in batches(it):
            for doc, h, text in zip(*(column(batch, c) for c in ("doc_id", "text_hash", "text"))):
                at, right, seed, context = described(text)
                if len(at):
                    e = np.empty(len(at), _ANCHOR)
                    e["seed"], e["context"], e["context2"], e["doc"], e["hash"], e["pos"], e["right"], e["done"] = seed, context[:, 0], context[:, 1], _NULL if doc is None else doc, h, at, right, 0
                    held.append(e)
                    size += len(e)
            if size > FLUSH:
                size = 0
                yield flush()
        if held:
            yield flush()

    return run


_FOUND = "doc_id long, text_hash long, lo long, hi long, pos long, right int, seed long, n long, members long"
_FOUND_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


def _found_rows(doc, h, rest: dict) -> pa.RecordBatch:
    doc = np.ascontiguousarray(doc)
    cols = {"doc_id": pa.array(doc, pa.int64(), mask=doc == _NULL), "text_hash": pa.array(np.ascontiguousarray(h))} | {k: pa.array(np.ascontiguousarray(v)) for k, v in rest.items()}
    kinds = dict.fromkeys(_FOUND_NAMES, pa.int64()) | {"right": pa.int32()}
    return pa.RecordBatch.from_arrays([cols.get(k, pa.nulls(len(doc), t)).cast(t) for k, t in kinds.items()], names=_FOUND_NAMES)


def _repeated(it) -> Iterator[pa.RecordBatch]:
    """Covered ranges, and of seeds that repeat with an open context one anchor for each of their contexts."""
    blobs: list[bytes] = []
    for batch in batches(it):
        for kind, blob in zip(column(batch, "kind"), column(batch, "blob")):
            if kind:
                blobs.append(blob)
            else:
                c = unpacked([blob], _COVER)
                yield _found_rows(c["doc"], c["hash"], {"lo": c["lo"], "hi": c["hi"]})
    e, first, n = _groups(unpacked(blobs, _ANCHOR))
    if not len(e):
        return
    blobs.clear()
    again = (n > 1) | (e["done"][first] > 0)
    c = covers(e[np.repeat(again, n) & (e["done"] == 0)])
    yield _found_rows(c["doc"], c["hash"], {"lo": c["lo"], "hi": c["hi"]})
    one = e[first]  # a row for each context, by seed
    new = np.ones(len(one), bool)
    new[1:] = one["seed"][1:] != one["seed"][:-1]
    start = np.flatnonzero(new)
    members = np.diff(np.append(start, len(one)))
    want = np.repeat((members > 1) & np.logical_or.reduceat(~again, start), members)
    one, again, members = one[want], again[want], np.repeat(members, members)[want]
    for i in range(0, len(one), 50_000):
        x = one[i : i + 50_000]
        yield _found_rows(x["doc"], x["hash"], {"pos": x["pos"], "right": x["right"], "seed": x["seed"], "n": 1 + again[i : i + 50_000].astype(np.int64), "members": members[i : i + 50_000]})


# ------------------------------------------------------------------ front-coded runs


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are not looked at."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


Entry = tuple[bytes, bytes, tuple]  # suffix, reversed left context, (doc_id, text_hash, pos, open)


def encode_run(entries: list[Entry]) -> bytes:
    """Sorted suffixes, each as the length shared with the one before and the rest."""
    shared, rest, before = [], [], b""
    for suffix, _, _ in entries:
        k = shared_prefix(before, suffix)
        shared.append(k)
        rest.append(suffix[k:])
        before = suffix
    lefts, of = [e[1] for e in entries], [e[2] for e in entries]
    parts = [
        np.array(shared, "<u2"), np.array([len(r) for r in rest], "<u2"), np.array([len(x) for x in lefts], "<u2"),
        np.array([o[0] or 0 for o in of], "<i8"), np.array([o[0] is None for o in of], "u1"), np.array([o[1] for o in of], "<i8"), np.array([o[2] for o in of], "<i8"), np.array([o[3] for o in of], "u1"),
    ]
    return b"".join([struct.pack("<I", len(entries)), *(p.tobytes() for p in parts), *rest, *lefts])


class Run:
    """Reads a front-coded run one suffix at a time."""

    def __init__(self, blob: bytes) -> None:
        (n,), at = struct.unpack_from("<I", blob), 4
        cols = []
        for kind in ("<u2", "<u2", "<u2", "<i8", "u1", "<i8", "<i8", "u1"):
            cols.append(np.frombuffer(blob, kind, n, at))
            at += cols[-1].nbytes
        self.blob, self.n, self.next = blob, n, 0
        self.shared, self.rest, self.lefts = (c.tolist() for c in cols[:3])
        self.of = list(zip((None if z else d for d, z in zip(cols[3].tolist(), cols[4].tolist())), cols[5].tolist(), cols[6].tolist(), cols[7].tolist()))
        self.at, self.left_at = at, at + sum(self.rest)
        self.suffix = b""

    def step(self) -> int | None:
        """Go to the next suffix; the length it shares with the one before, or None at the end."""
        i = self.next
        if i == self.n:
            return None
        self.suffix = self.suffix[: self.shared[i]] + self.blob[self.at : self.at + self.rest[i]]
        self.left = self.blob[self.left_at : self.left_at + self.lefts[i]]
        self.own = self.of[i]
        self.at += self.rest[i]
        self.left_at += self.lefts[i]
        self.next += 1
        return self.shared[i]


def merged(runs: list[Run]) -> Iterator[tuple[int, Entry]]:
    """All entries in order, each with the prefix that it shares with the one before.

    A loser tree.  Each head carries the length it shares with the last entry
    put out.  Of two heads the one that shares more comes first, unseen; only
    when both share as much are they compared, from there on.
    """
    k = max(1, len(runs))
    shared: list[int | None] = [r.step() for r in runs]
    shared = [None if s is None else 0 for s in shared]  # nothing is out yet

    def less(a: int, b: int) -> bool:
        """Whether head a goes before head b; the later one's length becomes the one shared with the earlier."""
        x, y = shared[a], shared[b]
        if x is None or y is None:
            return y is None
        if x != y:
            return x > y
        n = shared_prefix(runs[a].suffix, runs[b].suffix, x)
        first = runs[a].suffix[n:] <= runs[b].suffix[n:]
        shared[b if first else a] = n
        return first

    losers = [-1] * k

    def play(i: int) -> int:
        while (i := i // 2) > 0:
            if losers[i] < 0:
                losers[i] = winner[0]
                return -1
            if less(losers[i], winner[0]):
                losers[i], winner[0] = winner[0], losers[i]
        return winner[0]

    winner, top = [0], -1
    for r in range(len(runs)):
        winner[0] = r
        top = max(top, play(r + k))
    if len(runs) == 1:
        top = 0
    while runs and shared[top] is not None:
        run = runs[top]
        yield shared[top], (run.suffix, run.left, run.own)
        shared[top] = run.step()
        winner[0] = top
        top = play(top + k)


# ------------------------------------------------------------------ strings that repeat within a group


def repeats(suffixes: list[bytes], right: list[int], lefts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each suffix of a sorted group the ranges (first, last) of l whose string occurs at another one.

    ``right[i]`` is the prefix that suffix i shares with suffix i - 1.
    """
    n = len(suffixes)
    if n <= 12:
        found = np.zeros((n, REACH + 1), bool)
        for i in range(n):
            low = WIDTH
            for j in range(i + 1, n):
                low = min(low, right[j])
                a, b = WIDTH - low, shared_prefix(lefts[i], lefts[j])
                if a <= b:
                    found[i, a : b + 1] = found[j, a : b + 1] = True
    else:
        order = sorted(range(n), key=lefts.__getitem__)
        left = np.array([0, *(shared_prefix(lefts[order[i - 1]], lefts[order[i]]) for i in range(1, n))])
        lengths, tall, back = np.array([len(x) for x in lefts]), np.array([len(s) for s in suffixes]), np.array(order)
        right_ = np.array(right)
        found = np.zeros((n, REACH + 1), bool)
        cls = np.empty(n, np.int64)
        for k in range(REACH + 1):
            of = np.cumsum(right_ < WIDTH - k)
            cls[back] = np.cumsum(left < k)
            pair = of * (n + 1) + cls
            _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
            found[:, k] = (count[which] > 1) & (lengths >= k) & (tall >= WIDTH - k)
    out = []
    for row in found:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], row.view(np.int8), [0]])))
        out.append([(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])])
    return out


def _runs(parts: int):
    """Contexts of the wanted anchors, sorted and front-coded, one run for each receiver."""

    def run(it) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Entry]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            size = 0
            rows = [(p, encode_run(sorted(e, key=lambda x: x[0]))) for p, e in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["part", "run"])

        for batch in batches(it):
            for doc, h, text, wanted in zip(*(column(batch, c) for c in ("doc_id", "text_hash", "text", "wanted"))):
                data = text.encode()
                for w in wanted:
                    a = w["pos"]
                    suffix, left = data[a : a + w["right"]], data[max(0, a - REACH) : a][::-1]
                    held.setdefault(w["seed"] % parts, []).append((suffix, left, (doc, h, a, w["n"] == 1)))
                    size += 400
            if size > RUN_BYTES:
                yield flush()
        if held:
            yield flush()

    return run


def _merge(it) -> Iterator[pa.RecordBatch]:
    """Covered ranges of the open anchors, from the merged order of each receiver's runs."""
    runs = [Run(r) for b in batches(it) for r in column(b, "run")]
    out: list[tuple] = []
    group: list[Entry] = []
    right: list[int] = []

    def close() -> None:
        if len(group) > 1 and any(e[2][3] for e in group):
            for (doc, h, a, open_), ranges in zip((e[2] for e in group), repeats([e[0] for e in group], right, [e[1] for e in group])):
                if open_:
                    out.extend((doc, h, a - last, a - first + WIDTH) for first, last in ranges)
        group.clear()
        right.clear()

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "text_hash", "lo", "hi"])

    for shared, entry in merged(runs):
        if shared < SEED:
            close()
            if len(out) > 50_000:
                yield batch()
        group.append(entry)
        right.append(shared)
    close()
    yield batch()


def _strings(it) -> Iterator[pa.RecordBatch]:
    """Every string of the anchors in hot groups, by its digest."""
    for batch in batches(it):
        for doc, h, text, wanted in zip(*(column(batch, c) for c in ("doc_id", "text_hash", "text", "wanted"))):
            data = text.encode()
            for w in wanted:
                p = np.arange(max(0, w["pos"] - REACH), min(w["pos"], len(data) - WIDTH) + 1)
                d = digests([data[a : a + WIDTH] for a in p.tolist()])
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(p), pa.int64()), pa.array([h] * len(p), pa.int64()), pa.array(p), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())], names=["doc_id", "text_hash", "lo", "h1", "h2"])


def _covered(it) -> Iterator[pa.RecordBatch]:
    """Unite a document's ranges."""
    for batch in batches(it):
        spans = []
        for ranges in column(batch, "ranges"):
            united: list[list[int]] = []
            for a, b in sorted((r["lo"], r["hi"]) for r in ranges):
                if united and a <= united[-1][1]:
                    united[-1][1] = max(united[-1][1], b)
                else:
                    united.append([a, b])
            spans.append([x for s in united for x in s])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "spans"])


def _to_texts(texts: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Join a table of one row a document to the texts, by exchange at every size: its rows carry lists that grow with the corpus."""
    side = side.withColumnRenamed("doc_id", "s_id").withColumnRenamed("text_hash", "s_hash")
    return texts.join(side.hint("merge"), texts.doc_id.eqNullSafe(F.col("s_id")) & (texts.text_hash == F.col("s_hash")), how).drop("s_id", "s_hash")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans (start, end, start, end ... in bytes) of the documents of ``texts`` that lose any."""
    spark = texts.sparkSession
    rows = texts.select("doc_id", "text_hash", "text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first().n or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    runs = rows.mapInArrow(_anchor_runs(parts), "kind int, part int, blob binary").repartition(parts, "part")
    found = kept(runs.mapInArrow(_repeated, _FOUND), "repeated-anchors")
    wanted = found.filter("pos IS NOT NULL").select("doc_id", "text_hash", F.struct("pos", "right", "seed", "n").alias("w"), "members")

    by_doc = kept(wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.when(F.col("members") <= HOT, F.col("w"))).alias("wanted"), F.collect_list(F.when(F.col("members") > HOT, F.col("w"))).alias("hot")), "contexts-wanted")
    runs = _to_texts(rows, by_doc.filter(F.size("wanted") > 0).drop("hot"), "inner").dropDuplicates(["doc_id", "text_hash"]).mapInArrow(_runs(parts), "part int, run binary")
    edges = runs.repartition(parts, "part").mapInArrow(_merge, "doc_id long, text_hash long, lo long, hi long")
    every = found.filter("pos IS NULL").select("doc_id", "text_hash", "lo", "hi").unionByName(edges)

    hot = by_doc.filter(F.size("hot") > 0).select("doc_id", "text_hash", F.col("hot").alias("wanted"))
    if not hot.isEmpty():
        strings = kept(_to_texts(rows, hot, "inner").dropDuplicates(["doc_id", "text_hash"]).mapInArrow(_strings, "doc_id long, text_hash long, lo long, h1 long, h2 long").distinct(), "hot-strings")
        repeated = strings.groupBy("h1", "h2").agg(F.count("*").alias("k")).filter("k > 1").select("h1", "h2")
        every = every.unionByName(strings.join(repeated, ["h1", "h2"], "left_semi").select("doc_id", "text_hash", "lo", (F.col("lo") + WIDTH).alias("hi")))
    ranges = every.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return kept(ranges.mapInArrow(_covered, "doc_id long, text_hash long, spans array<long>"), "repeated-spans")


def _cut(it) -> Iterator[pa.RecordBatch]:
    for batch in batches(it):
        out = []
        for text, spans in zip(column(batch, "text"), column(batch, "spans")):
            data, at, left = (text or "").encode(), 0, []
            for a, b in zip(spans[::2], spans[1::2]) if spans else ():
                left.append(data[at:a])
                at = b
            left = b"".join([*left, data[at:]])
            out.append((len(data), len(data) - len(left), len(spans or ()) // 2, hashlib.sha256(left).hexdigest(), left))
        n, gone, count, digest, left = zip(*out)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(digest), pa.array(left, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) for every row."""
    tuned(docs.sparkSession)
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.coalesce(text, F.lit("")).alias("text"))
    return _to_texts(texts, repeated_spans(texts), "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
