"""Line dedup by an exact set-similarity join with prefix filtering.

A line is the set of its words (A-Z in lower case).  A line goes if an earlier
line, by (doc_id, line number), has a Jaccard similarity of 0.8 or more with
it, whether or not that line goes itself; so the outcome doesn't depend on an
order of removals.  Blank lines stay.

1. Words are counted over all documents in 65,536 hash buckets.  Tokens are
   ordered by their bucket's count, rarest first: the order only steers the
   filters, any total order is exact.
2. Lines with equal sets meet by a 128-bit name of the set: two sums over two
   independent hashes of its words.  The earliest of them stands for all, the
   others go.
3. Two sets of n and m words with similarity t share ceil(t / (1 + t) (n + m))
   words, so both have a common word among their n - ceil(t n) + 1 rarest.  Lines
   meet by those words, as packed arrays: one for each task and receiver; there
   are more receivers for more words.  A word whose bucket is hot is split by
   the set's size: a set enters its band (of sizes within a factor 1 / t) and
   the next, so that all sizes that can match still meet.  In a word's run equal
   sets count once.
4. Length, position and bitmap filters bound the overlap of each pair of a run.
   The bitmap has the parity of the words in each of 128 hash cells: two sets
   differ in at least as many words as their bitmaps in bits.
5. Pairs that pass are verified on the lines' words, for each line the most
   promising first, the others only if that one fails.
6. Runs over ``SHORT`` sets, as of groups of near copies, give each line's few
   most promising partners only; in runs over ``LONG`` it is first held against
   the earliest ``HEADS`` sets, and against all others if none of them passes.
   Such runs are written out in chunks as well.  A line whose partners all fail
   their verification, and that has more, is joined to its runs' chunks by word
   and held against all of them.  So such groups give linearly many pairs, no
   match is lost, and the documents are read for words once.

Cases: null and empty texts have no line to lose; a document is its doc_id and
text: rows with both equal are one document, each copy keeps what the first
keeps, and rows that share a doc_id (or have none) but differ in text are
documents of their own, in the order of their texts' hashes; a null doc_id
comes first in the order.  All columns stay as they are; the counts are in
``n_lines`` and ``n_removed``, with underscores behind where such a column is
there already.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import batches, column, fits, free, kept, packed, sub_column, sub_key, texts_of, tuned, unpacked, whole_row

#: Similarity as a fraction.
UP, DOWN = 4, 5
BUCKET_BITS = 16
#: Tables of one row a document go to the texts by broadcast up to so many bytes, and by exchange beyond.
BROADCAST_BYTES = 64 << 20
#: Words for each receiver; a bucket of more words than ``HOT_WORDS`` is split by size.
PART_WORDS, HOT_WORDS = 1 << 22, 1 << 22
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def tokens(texts: list[str], where: bool = True) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None, np.ndarray | None]:
    """Two hashes of every word, the line that it is in, and the number of lines of each text (lines counted through).

    Without ``where`` the first hash alone.

    Words of up to 16 bytes are told apart by size, first and last eight bytes,
    which both hashes mix in ways of their own; longer ones have two XXH64.
    """
    coded = [t.encode().lower() for t in texts]
    joined = b"\n".join(coded)
    padded = np.frombuffer(b"".join([bytes(8), joined, bytes(16 + -len(joined) % 8)]), np.uint8)
    data = padded[8 : 8 + len(joined)]
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    n = end - start
    first, last = rolling.ends(padded.view(np.uint64), start + 8, end + 8)
    size = n.astype(np.uint64)
    h = rolling.mixed(rolling.mixed(first + size * np.uint64(rolling.MIX)) + last * np.uint64(rolling.BASE))
    long = np.flatnonzero(n > 16)
    words = [joined[a:b] for a, b in zip(start[long].tolist(), end[long].tolist())]
    h[long] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if not where:
        return h, None, None, None
    breaks = np.searchsorted(start, np.flatnonzero(data == 10))
    line = np.cumsum(np.bincount(breaks, minlength=len(start) + 1)[: len(start)])
    second = rolling.mixed(rolling.mixed(last ^ size * np.uint64(rolling.BASE)) ^ first * np.uint64(rolling.MIX))
    second[long] = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in words), np.uint64, len(words))
    return h, second, line, np.array([c.count(b"\n") + 1 for c in coded], np.int64)


def _count(it) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches(it):
        h, _, _, _ = tokens(texts_of(batch), where=False)
        total += np.bincount(h >> np.uint64(64 - BUCKET_BITS), minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])


def rarity(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every bucket by the count of its words, and the counts; 65,536 numbers whatever the corpus."""
    rows = texts.mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in rows:
        total[r.bucket] = r.n
    rank = np.empty(1 << BUCKET_BITS, np.uint64)
    rank[np.argsort(total, kind="stable")] = np.arange(1 << BUCKET_BITS, dtype=np.uint64)
    return rank, total


def ordered(h: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Tokens whose numeric order is by rarity; one for each hash."""
    low = np.uint64(64 - BUCKET_BITS)
    return (rank[h >> low] << low) | (h & np.uint64((1 << (64 - BUCKET_BITS)) - 1))


def sets(h: np.ndarray, second: np.ndarray, line: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines that have words, their sets (and second hashes) one after another in rarity order, first entry and size of each."""
    key = ordered(h, rank)
    order = np.argsort(key)
    if len(line) and line[-1] < 1 << 16:  # then the second sort is a radix sort
        order = order[np.argsort(line[order].astype(np.uint16), kind="stable")]
    else:
        order = np.lexsort((key, line))
    key, line, second = key[order], line[order], second[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
    key, line, second = key[new], line[new], second[new]
    lines, first = np.unique(line, return_index=True)
    return lines, key, second, first, np.diff(np.append(first, len(key)))


#: Columns of the packed arrays: a null doc_id is the least number; ``sub`` tells texts of one doc_id apart.
_ENTRY = np.dtype([("token", "<u8"), ("set", "<u8"), ("bitmap", "<u8"), ("bitmap2", "<u8"), ("doc", "<i8"), ("sub", "<i8"), ("line", "<i4"), ("n", "<i4"), ("pos", "<i4")])
_CLASS = np.dtype([("set", "<u8"), ("second", "<u8"), ("doc", "<i8"), ("sub", "<i8"), ("line", "<i4")])
_NULL = np.iinfo(np.int64).min
FLUSH = 1 << 17
#: Runs up to ``SHORT`` sets give all pairs that pass, up to ``LONG`` each line's ``NEAREST`` partners, longer ones the best among the heads.
SHORT, NEAREST = 32, 3
LONG, HEADS = 2048, 64
HOT_PIVOT = 256
#: Rows of a run's chunk, and wanted lines that meet it at once.
CHUNK, WANTED = 1 << 14, 1 << 10
COPY, PAIR, MORE, RUN = range(4)
_FOUND = "kind int, doc_id long, sub long, line_no int, e_doc long, e_sub long, e_line int, bits int, more boolean, token long, blob binary"
_FOUND_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
_FOUND_NAMES = [x.split()[0] for x in _FOUND.split(", ")]
_KEY, _EARLY = ["doc_id", "sub", "line_no"], ["e_doc", "e_sub", "e_line"]


def _rows(kind: int, n: int, **cols) -> pa.RecordBatch:
    """Rows of a kind; columns that are not given are null, and so is the doc_id that stands for null."""
    out = []
    for name, t in zip(_FOUND_NAMES, _FOUND_KINDS):
        x = np.full(n, kind, np.int32) if name == "kind" else cols.get(name)
        if x is None:
            out.append(pa.nulls(n, t))
        else:
            out.append(pa.array(x, t, mask=x == _NULL) if name in ("doc_id", "e_doc") else pa.array(x, t))
    return pa.RecordBatch.from_arrays(out, names=_FOUND_NAMES)


def entries(texts: list[str], doc_ids: list, subs: list, rank: np.ndarray, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Class rows of all lines with words, and prefix rows (a set's first of the batch only)."""
    h, second, line, n_lines = tokens(texts)
    if not len(h):
        return np.zeros(0, _CLASS), np.zeros(0, _ENTRY)
    lines, key, second, first, n = sets(h, second, line, rank)
    begins = np.cumsum(n_lines) - n_lines
    at_doc = np.searchsorted(begins, lines, side="right") - 1
    doc = np.array([_NULL if d is None else d for d in doc_ids], np.int64)[at_doc]
    sub = np.array(subs, np.int64)[at_doc]
    cls = np.empty(len(lines), _CLASS)
    cls["set"] = np.add.reduceat(rolling.mixed(key), first)
    cls["second"] = np.add.reduceat(second, first)
    cls["doc"], cls["sub"], cls["line"] = doc, sub, lines - begins[at_doc]
    cell, upper = np.uint64(1) << (key & np.uint64(63)), (key >> np.uint64(6) & np.uint64(1)).astype(bool)
    bitmap, bitmap2 = (np.bitwise_xor.reduceat(np.where(upper == u, cell, np.uint64(0)), first) for u in (False, True))
    size = np.where(n > 3, n + (-UP * n // DOWN) + 1, 0)  # below four words only equal sets are similar enough
    one = np.zeros(len(lines), bool)  # the batch's earliest line of each set
    order = np.lexsort((cls["line"], sub, doc, cls["set"]))
    one[order[np.concatenate([[True], cls["set"][order][1:] != cls["set"][order][:-1]])]] = True
    size[~one] = 0
    ends = np.cumsum(size)
    of = np.repeat(np.arange(len(lines)), size)
    pos = np.arange(ends[-1]) - np.repeat(ends - size, size)
    out = np.empty(len(of), _ENTRY)
    out["token"], out["set"], out["bitmap"], out["bitmap2"] = key[first[of] + pos], cls["set"][of], bitmap[of], bitmap2[of]
    out["doc"], out["sub"], out["line"], out["n"], out["pos"] = doc[of], sub[of], cls["line"][of], n[of], pos
    if hot is not None:
        out = _banded(out, hot)
    return cls, out


def _banded(e: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Hot words are split by the sets' sizes: each entry goes to its band and to the next."""
    split = hot[(e["token"] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]  # the rank leads the token
    if not split.any():
        return e
    own = e[split]
    band = (np.log(own["n"]) / np.log(DOWN / UP) + 1e-9).astype(np.uint64)
    out = [e[~split]]
    for k in (0, 1):
        x = own.copy()
        x["token"] = rolling.mixed(own["token"] + (band + np.uint64(k + 1)) * np.uint64(rolling.BASE))
        out.append(x)
    return np.concatenate(out)


def _describe(shared, parts: int):
    """Packed class rows (kind 0) and prefix rows (kind 1) for each receiver."""

    def run(it) -> Iterator[pa.RecordBatch]:
        (rank, hot), held, size = shared.value, ([], []), 0

        def flush() -> pa.RecordBatch:
            rows = []
            for kind, (arrays, by) in enumerate(zip(held, ("set", "token"))):
                every = np.concatenate(arrays)
                part = rolling.mixed(every[by].copy()) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                every, part = every[order], part[order]
                used, first = np.unique(part, return_index=True)
                rows += [(kind, int(p), packed(x)) for p, x in zip(used, np.split(every, first[1:]))]
                arrays.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["kind", "part", "blob"])

        for batch in batches(it):
            found = entries(texts_of(batch), column(batch, "doc_id"), column(batch, "sub"), rank, hot)
            for h, x in zip(held, found):
                h.append(x)
            size += len(found[1])
            if size > FLUSH:
                size = 0
                yield flush()
        if held[0]:
            yield flush()

    return run


Rows = Mapping[str, np.ndarray]  # columns of prefix rows, or a structured array


def _passed(e: Rows, late: np.ndarray, early: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Length and position filters, for the pairs that the bitmaps let pass."""
    n, m = e["n"][late].astype(np.int64), e["n"][early].astype(np.int64)
    need = -(-UP * (n + m) // (UP + DOWN))
    return (UP * n <= DOWN * m) & (UP * m <= DOWN * n) & (np.minimum(n - e["pos"][late], m - e["pos"][early]) >= need)


def _differ(n: np.ndarray) -> np.ndarray:
    """Most bits in which two sets with n words together may differ."""
    return n - 2 * (-(-UP * n // (UP + DOWN)))


def passing(e: Rows, early: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all pairs (early, late) of rows of a run, those that the filters let pass, and the bits that differ."""
    bits = sum(np.bitwise_count(e[f][late][:, None] ^ e[f][early][None, :]) for f in ("bitmap", "bitmap2"))
    i, j = np.nonzero((bits <= _differ(e["n"][late][:, None] + e["n"][early][None, :])) & (early[None, :] < late[:, None]))
    a, b, bits = late[i], early[j], bits[i, j].astype(np.int32)
    ok = _passed(e, a, b, bits)
    return a[ok], b[ok], bits[ok]


def short_runs(e: Rows, starts: np.ndarray, m: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(late, early, bits, more) of all runs of m rows, many runs at a time.

    The first bitmap is held against a bound that is never too small for it;
    only pairs that pass are looked at any further.
    """
    below = np.tri(m, m, -1, dtype=bool)
    step = max(1, 1_000_000 // (m * m))
    for k in range(0, len(starts), step):
        rows = starts[k : k + step, None] + np.arange(m)
        bitmap, n = e["bitmap"][rows], np.minimum(e["n"][rows], 1200).astype(np.uint16)  # 1200 words allow for any bits
        near = np.bitwise_count(bitmap[:, :, None] ^ bitmap[:, None, :]) * np.uint16(DOWN + UP) <= n[:, :, None] + n[:, None, :]
        near &= below
        r, i, j = np.nonzero(near)
        late, early = rows[r, i], rows[r, j]
        bits = sum(np.bitwise_count(e[f][late] ^ e[f][early]) for f in ("bitmap", "bitmap2")).astype(np.int32)
        ok = np.flatnonzero(bits <= _differ(e["n"][late] + e["n"][early]))
        late, early, bits = late[ok], early[ok], bits[ok]
        ok = _passed(e, late, early, bits)
        late, early, bits = late[ok], early[ok], bits[ok]
        yield (late, early, bits, np.zeros(len(late), bool)) if m <= SHORT else _best(late, early, bits, NEAREST)


def run_pairs(e: Rows, long: int = LONG, heads_: int = HEADS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(late, early, bits, more) of one run, whose rows are in the order of lines.

    ``more`` says that the line may have further partners here.
    """
    m = len(e["n"])
    every = np.arange(m)
    out = []
    if m <= long:
        return list(short_runs(e, np.zeros(1, np.int64), m))
    heads, open_ = every[:heads_], []
    for i in range(0, m, 4096):
        a, b, bits = passing(e, heads, every[i : i + 4096])
        out.append(_best(a, b, bits))
        open_.append(np.setdiff1d(every[i : i + 4096], a))
    late = np.concatenate(open_)
    for i in range(0, len(late), 256):
        found = [passing(e, every[j : j + 4096], late[i : i + 256]) for j in range(heads_, m, 4096)]
        if found:
            out.append(_best(*(np.concatenate(x) for x in zip(*found))))
    return out


def _best(a: np.ndarray, b: np.ndarray, bits: np.ndarray, k: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k most promising partners of each line, and whether it has more."""
    order = np.lexsort((b, bits, a))
    a, b, bits = a[order], b[order], bits[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(a)))
    keep = np.arange(len(a)) - np.repeat(first, n) < k
    return a[keep], b[keep], bits[keep], np.repeat(n > k, n)[keep] if k > 1 else np.ones(int(keep.sum()), bool)


def _line_order(e: np.ndarray) -> np.ndarray:
    """Each row's rank in the order of lines."""
    order = np.lexsort((e["line"], e["sub"], e["doc"])) if e["sub"].any() else np.lexsort((e["line"], e["doc"]))
    rank = np.empty(len(e), np.uint64)
    rank[order] = np.arange(len(e), dtype=np.uint64)
    return rank


def _grouped(name: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where the names are, in the names' order."""
    order = np.argsort(name)
    new = np.zeros(len(name), np.uint64)
    new[1:] = name[order][1:] != name[order][:-1]
    out = np.empty(len(name), np.uint64)
    out[order] = np.cumsum(new)
    return out


def _sorted(e: np.ndarray) -> np.ndarray:
    """Rows by word and in the order of lines; in a word's run equal sets count once, as their earliest line."""
    token, rank = np.ascontiguousarray(e["token"]), _line_order(e)
    name = rolling.mixed(token * np.uint64(rolling.BASE) + e["set"]) + (e["bitmap"] ^ e["bitmap2"] * np.uint64(rolling.MIX))
    order = np.argsort((_grouped(name) << np.uint64(32)) | rank)  # a task has fewer than 2**32 rows
    new = np.ones(len(e), bool)
    new[1:] = name[order][1:] != name[order][:-1]
    first = order[new]
    return e[first[np.argsort((_grouped(token[first]) << np.uint64(32)) | rank[first])]]


def _met(long: int, heads: int):
    """Of each receiver: copies of earlier sets, pairs of its runs, lines that have more partners, and the chunks of their runs."""

    def run(it) -> Iterator[pa.RecordBatch]:
        blobs: tuple[list, list] = ([], [])
        for batch in batches(it):
            for kind, blob in zip(column(batch, "kind"), column(batch, "blob")):
                blobs[kind].append(blob)
        yield _copies(unpacked(blobs[0], _CLASS))
        blobs[0].clear()
        rows = unpacked(blobs[1], _ENTRY)
        blobs[1].clear()
        rows = _sorted(rows)
        starts = np.flatnonzero(np.concatenate([[True], rows["token"][1:] != rows["token"][:-1]])) if len(rows) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(rows))
        e = {f: np.ascontiguousarray(rows[f]) for f in _ENTRY.names}
        out, size, more = [], 0, []
        for late, early, bits, has_more in _all_pairs(e, starts, ends - starts, long, heads):
            if len(late):
                out.append((late, early, bits, has_more))
                size += len(late)
                if has_more.any():
                    more.append(np.unique(late[has_more]))
            if size > 500_000:
                yield _pair_rows(e, out)
                out, size = [], 0
        if out:
            yield _pair_rows(e, out)
        if more:
            yield from _run_rows(rows, starts, ends, np.unique(np.concatenate(more)))

    return run


def _run_rows(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries of lines that have more partners, and the chunks of their runs."""
    for i in range(0, len(more), CHUNK):
        x = rows[more[i : i + CHUNK]]
        yield _rows(MORE, len(x), doc_id=x["doc"].copy(), sub=x["sub"].copy(), line_no=x["line"].copy(), token=x["token"].copy().view(np.int64), blob=[packed(x[j : j + 1]) for j in range(len(x))])
    tokens_, blobs, size = [], [], 0
    for r in np.unique(np.searchsorted(starts, more, side="right") - 1).tolist():
        for a in range(int(starts[r]), int(ends[r]), CHUNK):
            tokens_.append(int(rows["token"][starts[r]].view(np.int64)))
            blobs.append(packed(rows[a : min(a + CHUNK, int(ends[r]))]))
            size += len(blobs[-1])
            if size > 8 << 20:
                yield _rows(RUN, len(blobs), token=tokens_, blob=blobs)
                tokens_, blobs, size = [], [], 0
    if blobs:
        yield _rows(RUN, len(blobs), token=tokens_, blob=blobs)


def _all_pairs(e: Rows, starts: np.ndarray, sizes: np.ndarray, long: int, heads: int) -> Iterator[tuple]:
    for m in np.unique(sizes[sizes > 1]).tolist():
        of = starts[sizes == m]
        if m <= long:
            yield from short_runs(e, of, m)
            continue
        for a in of.tolist():
            for late, early, bits, more in run_pairs({f: x[a : a + m] for f, x in e.items()}, long, heads):
                yield late + a, early + a, bits, more


def _pair_rows(e: Rows, found: list) -> pa.RecordBatch:
    late, early, bits, more = (np.concatenate(x) for x in zip(*found))
    rows = np.unique(np.rec.fromarrays([e["doc"][late], e["sub"][late], e["line"][late], e["doc"][early], e["sub"][early], e["line"][early], bits.astype(np.int32), more]))
    cols = [np.ascontiguousarray(rows[f]) for f in rows.dtype.names]
    return _rows(PAIR, len(rows), **dict(zip([*_KEY, *_EARLY, "bits", "more"], cols)))


def _copies(e: np.ndarray) -> pa.RecordBatch:
    """Lines whose set an earlier line has."""
    e = e[np.lexsort((e["line"], e["sub"], e["doc"], e["second"], e["set"]) if e["sub"].any() else (e["line"], e["doc"], e["second"], e["set"]))]
    later = np.zeros(len(e), bool)
    later[1:] = (e["set"][1:] == e["set"][:-1]) & (e["second"][1:] == e["second"][:-1])
    head = np.maximum.accumulate(np.where(later, 0, np.arange(len(e))))
    e = e[later & ((e["doc"] != e["doc"][head]) | (e["sub"] != e["sub"][head]) | (e["line"] != e["line"][head]))]
    return _rows(COPY, len(e), doc_id=e["doc"].copy(), sub=e["sub"].copy(), line_no=e["line"].copy())


def _held_against_all(it) -> Iterator[pa.RecordBatch]:
    """All partners of wanted lines in a chunk of their run."""
    for batch in batches(it):
        for blob, wanted in zip(column(batch, "blob"), column(batch, "wanted")):
            chunk, own = unpacked([blob], _ENTRY), unpacked(wanted, _ENTRY)
            both = np.concatenate([chunk, own])
            order = np.lexsort((both["line"], both["sub"], both["doc"]))
            e = {f: np.ascontiguousarray(both[f][order]) for f in _ENTRY.names}
            late, early = np.flatnonzero(order >= len(chunk)), np.flatnonzero(order < len(chunk))
            for i in range(0, len(late), 256):
                for j in range(0, len(early), 4096):
                    a, b, _ = passing(e, early[j : j + 4096], late[i : i + 256])
                    differ = e["set"][a] != e["set"][b]
                    a, b = a[differ], b[differ]
                    if len(a):
                        yield _rows(PAIR, len(a), **{k: e[f][x] for x, names in ((a, _KEY), (b, _EARLY)) for k, f in zip(names, ("doc", "sub", "line"))})


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal keys; ``names`` are the right ones, the first of which may be null."""
    on = left["doc_id"].eqNullSafe(right[names[0]]) & (left["sub"] == right[names[1]])
    return on & (left["line_no"] == right[names[2]]) if len(names) > 2 else on


def _lines_out(it) -> Iterator[pa.RecordBatch]:
    """Text of each wanted line, for each pivot that it is to meet."""
    for batch in batches(it):
        rows = []
        for doc, sub, text, wanted in zip(column(batch, "doc_id"), column(batch, "sub"), texts_of(batch), column(batch, "wanted")):
            lines = text.encode().lower().split(b"\n")
            rows += [(w["e_doc"], w["e_sub"], w["e_line"], w["salt"], w["late"], doc, sub, w["line_no"], lines[w["line_no"]]) for w in wanted if w["line_no"] < len(lines)]
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*_EARLY, "salt", "late", *_KEY, "words"])


def _similar(it) -> Iterator[pa.RecordBatch]:
    """Lines that are similar enough to their pivot, which comes before them; one pivot in memory at a time."""
    at, pivot = None, frozenset()
    for batch in batches(it):
        found = []
        for e_doc, e_sub, e_line, salt, late, doc, sub, line, words in zip(*(c.to_pylist() for c in batch.columns)):
            own = frozenset(words.split())
            if not late:
                at, pivot = (e_doc, e_sub, e_line, salt), own
            elif at == (e_doc, e_sub, e_line, salt):
                common = len(own & pivot)
                if DOWN * common >= UP * (len(own) + len(pivot) - common):
                    found.append((doc, sub, line))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.int32()))], names=_KEY)


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Keys of the pairs' later lines that are similar enough to their earlier ones.

    A pivot with many lines is sent out once for every ``HOT_PIVOT`` of them.
    """
    hot = pairs.groupBy(*_EARLY).agg(F.count("*").alias("k")).filter(F.col("k") > HOT_PIVOT)
    hot = hot.select(F.col("e_doc").alias("h_doc"), F.col("e_sub").alias("h_sub"), F.col("e_line").alias("h_line"), F.ceil(F.col("k") / HOT_PIVOT).cast("int").alias("copies"))
    p = pairs.join(hot, pairs.e_doc.eqNullSafe(F.col("h_doc")) & (pairs.e_sub == F.col("h_sub")) & (pairs.e_line == F.col("h_line")), "left")
    p = p.select(*_KEY, *_EARLY, F.coalesce(F.pmod(F.xxhash64(*_KEY), F.col("copies")).cast("int"), F.lit(0)).alias("salt"))
    late = p.select("doc_id", "sub", F.struct("line_no", *_EARLY, "salt", F.lit(True).alias("late")).alias("w"))
    early = p.select(*_EARLY, "salt").distinct().select(F.col("e_doc").alias("doc_id"), F.col("e_sub").alias("sub"), F.struct(F.col("e_line").alias("line_no"), *_EARLY, "salt", F.lit(False).alias("late")).alias("w"))
    by_doc = kept(late.unionByName(early).groupBy("doc_id", "sub").agg(F.collect_list("w").alias("wanted")), "line-wanted").select(F.col("doc_id").alias("w_id"), F.col("sub").alias("w_sub"), "wanted")
    small = F.broadcast(by_doc) if fits(by_doc, 64, "wanted", 64, BROADCAST_BYTES) else by_doc
    rows = texts.join(small, _same(texts, by_doc, ["w_id", "w_sub"])).select("doc_id", "sub", "text", "wanted")
    rows = rows.mapInArrow(_lines_out, "e_doc long, e_sub long, e_line int, salt int, late boolean, doc_id long, sub long, line_no int, words binary")
    met = rows.repartition(*_EARLY, "salt").sortWithinPartitions(*_EARLY, "salt", "late")
    return met.mapInArrow(_similar, "doc_id long, sub long, line_no int").distinct()


def later_matches(docs: DataFrame, id_col: str, text_col: str, sub: Column | None) -> DataFrame:
    """(doc_id, sub, line_no) of all lines that go; ``sub`` as of ``sub_key``."""
    spark = tuned(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), sub_column(sub), F.col(text_col).cast("string").alias("text"))
    rank, total = rarity(texts)
    hot = np.zeros(1 << BUCKET_BITS, bool)
    hot[rank.astype(np.int64)] = total > HOT_WORDS
    shared = spark.sparkContext.broadcast((rank, hot))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total.sum() // PART_WORDS))
    met = texts.mapInArrow(_describe(shared, parts), "kind int, part int, blob binary").repartition(parts, "part")
    found = kept(met.mapInArrow(_met(LONG, HEADS), _FOUND), "lines-met")
    copies = found.filter(F.col("kind") == COPY).select(*_KEY)
    pairs = found.filter(F.col("kind") == PAIR).groupBy(*_KEY, *_EARLY).agg(F.min("bits").alias("bits"), F.max("more").alias("more"))
    pairs = kept(pairs, "line-pairs")
    once = texts if sub is None else texts.dropDuplicates(["doc_id", "sub"])
    best = pairs.groupBy(*_KEY).agg(F.min(F.struct("bits", *_EARLY)).alias("b"), F.count("*").alias("k"), F.max("more").alias("more"))
    best = kept(best.select(*_KEY, *(f"b.{c}" for c in _EARLY), "k", "more"), "line-best")
    settled = kept(_verified(once, best), "line-settled")
    failed = kept(_without(best, settled).filter("k > 1 OR more"), "line-failed")
    f = failed.select(F.col("doc_id").alias("f_doc"), F.col("sub").alias("f_sub"), F.col("line_no").alias("f_line"), F.col("e_doc").alias("t_doc"), F.col("e_sub").alias("t_sub"), F.col("e_line").alias("t_line"))
    rest = pairs.join(f, _same(pairs, f, ["f_doc", "f_sub", "f_line"]))
    rest = rest.filter(~(F.col("e_doc").eqNullSafe(F.col("t_doc")) & (F.col("e_sub") == F.col("t_sub")) & (F.col("e_line") == F.col("t_line")))).select(*_KEY, *_EARLY)
    second = kept(_verified(once, kept(rest, "line-rest")), "line-second")
    last = kept(_without(failed.filter("more"), second).select(*_KEY), "line-last")
    gone = copies.unionByName(settled).unionByName(second)
    if last.isEmpty():
        return gone
    return gone.unionByName(_third(once, found, last))


def _third(texts: DataFrame, found: DataFrame, last: DataFrame) -> DataFrame:
    """Lines that are similar to any line of their runs; runs and lines meet by word, in chunks on both sides."""
    own = found.filter(F.col("kind") == MORE).select(*_KEY, "token", "blob")
    w = last.select(F.col("doc_id").alias("w_doc"), F.col("sub").alias("w_sub"), F.col("line_no").alias("w_line"))
    wanted = kept(own.join(w, _same(own, w, ["w_doc", "w_sub", "w_line"]), "left_semi"), "lines-open")
    many = wanted.groupBy("token").agg(F.ceil(F.count("*") / WANTED).alias("groups"))
    lists = wanted.join(many, "token").withColumn("group", F.pmod(F.xxhash64(*_KEY), F.col("groups"))).groupBy("token", "group").agg(F.collect_list("blob").alias("wanted")).select("token", "wanted")
    runs = found.filter(F.col("kind") == RUN).select("token", "blob")
    again = runs.join(lists, "token").select("blob", "wanted").mapInArrow(_held_against_all, _FOUND).select(*_KEY, *_EARLY).distinct()
    return kept(_verified(texts, kept(again, "line-again")), "line-third")


def _without(lines: DataFrame, done: DataFrame) -> DataFrame:
    d = done.select(F.col("doc_id").alias("d_doc"), F.col("sub").alias("d_sub"), F.col("line_no").alias("d_line"))
    return lines.join(d, _same(lines, d, ["d_doc", "d_sub", "d_line"]), "left_anti")


def count_names(docs: DataFrame) -> tuple[str, str]:
    """Names of the two counts that ``dedup_lines`` adds."""
    return free("n_lines", docs.columns), free("n_removed", docs.columns)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that repeat earlier ones, and the number of lines and of removed ones (see ``count_names``)."""
    sub = sub_key(docs, id_col, text_col)
    gone = later_matches(docs, id_col, text_col, sub)
    by_doc = kept(gone.groupBy("doc_id", "sub").agg(F.collect_set("line_no").alias("gone")), "lines-gone").select(F.col("doc_id").alias("g_id"), F.col("sub").alias("g_sub"), "gone")
    rows = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("doc_id"), sub_column(sub))
    small = F.broadcast(by_doc) if fits(by_doc, 64, "gone", 4, BROADCAST_BYTES) else by_doc
    joined = rows.join(small, _same(rows, by_doc, ["g_id", "g_sub"]), "left")
    own = F.col("row").getField(text_col)
    lines = F.split(own.cast("string"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    text = F.when(F.col("gone").isNull(), own).otherwise(left)
    n_lines = F.when(own.isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    names = count_names(docs)
    return joined.select(*((text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns), n_lines.alias(names[0]), F.greatest(n_removed, F.lit(0).cast("long")).alias(names[1]))
