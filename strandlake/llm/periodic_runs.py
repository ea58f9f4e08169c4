"""Periodic runs of words by an all-lag vectorised scan.

A text is an array of word ids.  For every lag up to the number of words over
the least exponent the array is compared with itself, shifted by the lag, and
the true stretches that are long enough are runs.  A stretch of k true
comparisons at lag q is a run of k + q words.  Where a run's least period is p,
the lags 2p, 3p, ... find the very same run; the least of them stays.

A stretch that is long enough holds one of every m-th comparison, m being the
least number of true ones in a row; so these are made first, and the others of
a lag only where one of them is true.  Documents of one Arrow batch are scanned
together, longest first, each ended by a word of its own: lag q then takes the
documents that are long enough for it, a prefix of the array.

Texts of over ``LARGE`` bytes are scanned by several tasks: their document-lag
ranges are rows that Spark deals out, and what the ranges found meets again by
document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, tuned

#: Words of documents that are scanned together.
CHUNK = 1 << 16
#: Bytes from which a text's lags are dealt to several tasks, and comparisons that a task makes for one at most (at four bytes a word).
LARGE, UNIT = 1 << 16, 1 << 26

Run = tuple[int, int, int]  # first word, words, period
#: From a document's id and its number of words: the first word of a periodic tail and its period, or None.
Tail = Callable[[int | None, int], tuple[int, int] | None]
RUN = "struct<start: long, length: long, period: long>"


def words_of(text: bytes | None, doc_id: int | None = None, tail: Tail | None = None) -> list[bytes]:
    """Words between ASCII white space; from the tail's first word on they repeat with its period."""
    words = (text or b"").split()
    found = tail(doc_id, len(words)) if tail and words else None
    if found:
        first, period = found
        rest = len(words) - first
        words[first:] = (words[first : first + period] * (rest // period + 1))[:rest]
    return words


def _stretches(words: np.ndarray, lag: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of at least ``need`` words in a row that equal the word a lag further on."""
    here, there = words[:-lag], words[lag:]
    if not (here[need - 1 :: need] == there[need - 1 :: need]).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    other = np.concatenate(([-1], np.flatnonzero(here != there), [len(here)]))
    gap = np.diff(other) - 1
    long = np.flatnonzero(gap >= need)
    return other[long] + 1, gap[long]


def scan(documents: list[list[bytes]], least: int, exponent: int, share: tuple[int, int] = (0, 1)) -> list[list[Run]]:
    """Runs of each document, by start and then period; of the lags only the share (i of k ranges) that is asked for."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    sizes = np.array([len(documents[i]) for i in order], np.int64)
    ends = np.cumsum(sizes + 1)
    ids: dict[bytes, int] = {}
    words = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    at = 0
    for k, i in enumerate(order):
        n = len(documents[i])
        words[at : at + n] = [ids.setdefault(w, len(ids)) for w in documents[i]]
        words[at + n] = -1 - k
        at += n + 1
    found = []
    most = int(sizes[0]) // exponent if len(sizes) else 0
    for lag in range(1 + most * share[0] // share[1], 1 + most * (share[0] + 1) // share[1]):
        active = int(np.searchsorted(-sizes, -max(least, exponent * lag), side="right"))  # documents with so many words
        if not active:
            continue
        starts, equal = _stretches(words[: ends[active - 1]], lag, max(least - lag, (exponent - 1) * lag))
        if len(starts):
            found.append(np.stack([starts, equal + lag, np.full(len(starts), lag)]))
    out: list[list[Run]] = [[] for _ in documents]
    if found:
        starts, lengths, periods = np.concatenate(found, axis=1)
        of = np.searchsorted(ends, starts, side="right")
        first = np.concatenate(([0], ends[:-1]))
        for k, s, n, q in zip(of.tolist(), (starts - first[of]).tolist(), lengths.tolist(), periods.tolist()):
            out[order[k]].append((s, n, q))
    return [least_periods(runs) for runs in out]


def least_periods(runs: list[Run]) -> list[Run]:
    """Of runs over the same words the one of least period, by start and then period."""
    best: dict[tuple[int, int], int] = {}
    for s, n, q in runs:
        best[s, n] = min(q, best.get((s, n), q))
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length over period; of several the first, then that of least period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def _rows(ids: list, documents: list[list[bytes]], found: list[list[Run]]) -> pa.RecordBatch:
    named = lambda r: r and dict(zip(("start", "length", "period"), r))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    cols = [
        pa.array(ids, pa.int64()),
        pa.array([len(w) for w in documents], pa.int64()),
        pa.array([[named(r) for r in runs] for runs in found], pa.list_(kind)),
        pa.array([named(strongest(runs)) for runs in found], kind),
        pa.array([collapsed(w, runs) for w, runs in zip(documents, found)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "runs", "strongest", "collapsed"])


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of documents of about ``CHUNK`` words."""
    a, held = 0, 0
    for b, n in enumerate(sizes, 1):
        held += n
        if held >= CHUNK or b == len(sizes):
            yield a, b
            a, held = b, 0


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4, tail: Tail | None = None, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE, unit: int = UNIT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period of each), strongest (one of them or null) and the collapsed text of every row.

    A run is a maximal stretch of at least ``least`` words and ``exponent`` of
    its least periods.  ``tail`` can make the end of a document periodic first.

    Cases: a null text is empty, and an empty or blank one has no word and no
    run, its collapsed text is empty; rows that repeat, share an id or have none
    get their own text's result each (``tail`` gets None for a null id); a text
    of any length is taken whole; an empty table gives no row; further columns
    are left out.
    """
    if least < 2 or exponent < 2:
        raise ValueError("a run has two words and two periods at least")
    tuned(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def whole(it) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            ids = column(batch, "doc_id")
            documents = [words_of(t, i, tail) for i, t in zip(ids, column(batch, "text"))]
            for a, b in _chunks([len(w) for w in documents]):
                yield _rows(ids[a:b], documents[a:b], scan(documents[a:b], least, exponent))

    def ranges(it) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            part, of = column(batch, "part"), column(batch, "parts")
            found = [scan([words_of(t, i, tail)], least, exponent, (a, k))[0] for i, t, a, k in zip(column(batch, "doc_id"), column(batch, "text"), part, of)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), runs], names=["doc_id", "digest", "runs"])

    def united(it) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            ids = column(batch, "doc_id")
            for i, t, runs in zip(ids, column(batch, "text"), column(batch, "runs")):
                yield _rows([i], [words_of(t, i, tail)], [least_periods([(r["start"], r["length"], r["period"]) for r in runs])])

    size = F.octet_length("text")
    schema = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed binary"
    small = rows.filter(size <= large).mapInArrow(whole, schema)
    long = rows.filter(size > large).withColumn("digest", F.sha2("text", 256))
    parts = F.ceil(size.cast("double") * size / (16 * exponent * unit)).cast("int")  # words are a quarter of the bytes or so
    dealt = long.dropDuplicates(["doc_id", "digest"]).select("doc_id", "digest", "text", parts.alias("parts"))
    dealt = dealt.select("doc_id", "digest", "text", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).repartition("doc_id", "digest", "part")
    found = dealt.mapInArrow(ranges, f"doc_id long, digest string, runs array<{RUN}>").groupBy("doc_id", "digest").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    found = found.select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), "runs")
    met = long.join(found, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest"))).select("doc_id", "text", "runs")
    return small.unionByName(met.mapInArrow(united, schema)).withColumn("collapsed", F.col("collapsed").cast("string"))
