"""SimHash near-duplicates by multi-index hashing.

Fingerprints have 64 bits.  They are cut into two segments of 32 bits: when two
fingerprints differ in at most three bits, one of their segments differs in at
most one.  So every distinct fingerprint is entered once for each segment, and
looked up under the 33 values of the Hamming ball of radius one around each of
its own segments; whole distances are then verified.

Groups of copies meet as one fingerprint before anything is exchanged.  Inside
a bucket, whose members share one segment, the method is used again on the other
segment: two halves of 16 bits, of which one differs in at most one bit.  So
two members are compared only if 47 of the bits that they meet by agree, and
no group that is gathered can hold more than 2^16 fingerprints, however many
documents share a segment.  All links are given, with no cap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, fits, kept, sub_column, sub_key, texts_of, tuned, unwrapped, whole_row
from .components import components

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Keys of documents that go are broadcast up to so many bytes, and exchanged beyond.
BROADCAST_BYTES = 64 << 20
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = np.arange(8, dtype=np.int64) * 256


def shingles(text: str, width: int = SHINGLE) -> list[bytes]:
    """Word shingles of a text with A-Z in lower case; a shorter text is one shingle."""
    words = text.encode().lower().split()  # bytes know ASCII letters and white space alone
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    return [line[a:b] for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is in over half of the shingles' XXH64; no word gives zero."""
    of = shingles(text, width)
    if not of:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in of), np.uint64, len(of))
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    if len(of) < 256:
        ones = np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0)
    else:
        ones = np.zeros(64, np.int64)
        for i in range(0, len(of), 1 << 16):
            ones += (np.bincount((lanes[i : i + (1 << 16)] + _LANES).ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(of), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sub: Column | None = None) -> DataFrame:
    """doc_id, sub (see ``sub_key``), fp (the 64 bits as a signed long).  A null text has no word."""

    def run(it) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            fp = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["doc_id", "sub", "fp"])

    tuned(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), sub_column(sub), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, sub long, fp long")


def segment(fp: Column, s: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if s == 0 else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _ball() -> Column:
    """XOR masks of the Hamming ball of radius one over 32 bits."""
    return F.array(F.lit(0).cast("long"), *(F.lit(1 << b).cast("long") for b in range(32)))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) with a < b: links that connect all distinct fingerprints within ``radius`` bits (3 at most)."""
    if radius > 3:
        raise ValueError("two segments and balls of radius one find distances up to 3")
    entries = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(s).alias("seg"), segment(F.col("fp"), s).alias("value")) for s in (0, 1)))).alias("e")).select("fp", "e.seg", "e.value")
    buckets = entries.groupBy("seg", "value").agg(F.count("*").alias("n"), F.min("fp").alias("fp"))
    # Inside a bucket the segment is equal: its members differ in the other one alone.
    crowded = buckets.filter("n > 1").select("seg", "value")
    inside = _bucket_links(entries.hint("merge").join(crowded, ["seg", "value"]), radius)
    # Across buckets one bit of the segment differs, so the other segments differ in two at most.
    across = _across(entries, radius)
    return inside.unionByName(across).distinct()


def _other(fp: str, seg: str) -> Column:
    return F.when(F.col(seg) == 0, segment(F.col(fp), 1)).otherwise(segment(F.col(fp), 0))


def _bucket_links(members: DataFrame, radius: int) -> DataFrame:
    """Links of fingerprints that share a segment value.

    They are within ``radius`` in the other 32 bits, so one of those two halves
    differs in one bit at most: members are entered by (bucket, half), looked up
    under the 17 values around each of their own halves, and compared there.
    """
    m = members.select("fp", "seg", "value", _other("fp", "seg").alias("o"))
    m = m.select("fp", "seg", "value", F.posexplode(F.array(*(F.shiftrightunsigned("o", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(2)))).alias("side", "half"))
    masks = F.array(F.lit(0).cast("long"), *(F.lit(1 << b).cast("long") for b in range(16)))
    a = m.select(F.col("fp").alias("a"), "seg", "value", "side", "half", F.explode(masks).alias("mask")).select("a", "seg", "value", "side", F.col("half").bitwiseXOR(F.col("mask")).alias("half"))
    # Sizes are estimated from before the explosion, so a broadcast could be far too large.
    near = a.hint("merge").join(m.withColumnRenamed("fp", "b"), ["seg", "value", "side", "half"]).filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    return near.select("a", "b")


def _across(entries: DataFrame, radius: int) -> DataFrame:
    probes = entries.select(F.col("fp").alias("a"), "seg", "value", F.explode(F.slice(_ball(), 2, 32)).alias("mask")).select("a", "seg", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    found = probes.hint("merge").join(entries.withColumnRenamed("fp", "b"), ["seg", "value"])
    return found.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")


def _labelled(prints: DataFrame, radius: int) -> DataFrame:
    """fp, root (any one fingerprint of its component), first (least doc_id) of every distinct fingerprint."""
    fps = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), radius))
    return fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id that links reach.

    Cases: null, empty and blank texts have the fingerprint zero and link like
    any other; repeated rows share their component; a null doc_id stays, and is
    a component's id only where the component has no other; an empty table
    gives no row; further columns are left out.
    """
    prints = kept(fingerprints(docs, id_col, text_col), "fingerprints")
    labelled = _labelled(prints, radius)
    ids = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    of = labelled.join(ids, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one of least id, a null id last.

    Cases: a document is its id and text, so documents that share an id, or have
    none, are told apart by the hashes of their texts, the least of which goes
    first; of rows that repeat both any one stays; texts without a word are one
    group; an empty table stays empty; columns of any name stay as they are.
    """
    sub = sub_key(docs, id_col, text_col)
    prints = kept(fingerprints(docs, id_col, text_col, sub), "fingerprints")
    labels = prints.join(_labelled(prints, radius).select("fp", "root"), "fp").select("doc_id", "sub", "root")
    labels = kept(labels.groupBy("doc_id", "sub", "root").agg(F.count("*").alias("n")), "labels")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sub")
    firsts = labels.groupBy("root").agg(F.min(own).alias("f")).select(F.col("f.doc_id").alias("f_id"), F.col("f.sub").alias("f_sub"))
    gone = kept(labels.join(firsts, labels.doc_id.eqNullSafe(F.col("f_id")) & (labels["sub"] == F.col("f_sub")), "left_anti").select(F.col("doc_id").alias("g_id"), F.col("sub").alias("g_sub")), "not-first")
    rows = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("id"), sub_column(sub))
    same = lambda t, names: rows["id"].eqNullSafe(t[names[0]]) & (rows["sub"] == t[names[1]])
    left = rows.join(_small(gone), same(gone, ("g_id", "g_sub")), "left_anti")
    if sub is not None:
        again = kept(labels.filter("n > 1").select(F.col("doc_id").alias("r_id"), F.col("sub").alias("r_sub")), "repeated")
        marked = left.join(_small(again), same(again, ("r_id", "r_sub")), "left_semi").groupBy("id", "sub").agg(F.first("row").alias("row")).select("row", "id", "sub")
        left = left.join(_small(again), same(again, ("r_id", "r_sub")), "left_anti").unionByName(marked)
    return unwrapped(left, docs.columns)


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if fits(keys, 48, limit=BROADCAST_BYTES) else keys
