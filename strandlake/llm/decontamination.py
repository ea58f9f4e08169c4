"""Benchmark decontamination with DataFrame functions alone.

A *window* is ten consecutive words of a benchmark item, or a whole shorter
item.  The windows form a hash set, broadcast behind a check of its size; each
text's words are scanned window by window, a hash hit is verified word by word,
and the verified spans of a document are united.  Beyond that size positions and
hashes are exchanged, never a text with each of its positions.

Cases: a null text or item has no words; a null item_id marks words but is in
no list; documents that repeat (same id, same text) get the same result each;
a document shorter than a window can only hold shorter items; an empty
benchmark marks nothing; further columns are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, unwrapped, whole_row

WINDOW = 10
#: Broadcast the set up to so many bytes of window text, else exchange by hash.
BROADCAST_BYTES = 64 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ("doc_id", "text_hash", "text_size")


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; other letters as they are."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """n, h, w: the distinct windows with their length and hash; items: ids of the items that hold them."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words"))
    items = items.select("item_id", "words", F.least(F.size("words"), F.lit(width)).alias("n")).filter("n > 0")
    each = items.select("item_id", "n", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("i"))
    each = each.select("item_id", "n", F.slice("words", F.col("i"), F.col("n")).alias("w"))
    return each.groupBy("n", "w").agg(F.collect_set("item_id").alias("items")).select("n", F.xxhash64("w").alias("h"), "w", "items")


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row for each verified occurrence of a window: the document's key, first and last word, items.

    While the windows fit, they are broadcast and verified on the spot.  Beyond,
    positions and hashes alone are exchanged, and the few that meet a window's
    hash go back to their texts, by key, to be verified.
    """
    found = kept(windows(benchmark, width), "windows")
    of = found.agg(F.collect_set("n").alias("lengths"), F.sum(F.length(F.array_join("w", " ")) + 8 * F.size("items") + 64).alias("size")).first()
    lengths = sorted(of.lengths)  # at most ``width`` numbers
    text = docs.select(*_key(docs), words(F.col("text")).alias("words"))
    at = text.select(*_KEY, "words", F.explode_outer(F.when(F.size("words") > 0, F.sequence(F.lit(1), F.size("words")))).alias("i"))
    if len(lengths) != 1:
        at = at.select("*", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias("n"))
    else:
        at = at.withColumn("n", F.lit(lengths[0]))
    at = at.withColumnRenamed("n", "len")
    window = F.slice("words", F.col("i"), F.col("len"))
    if (of["size"] or 0) <= BROADCAST_BYTES:
        same = (F.xxhash64(window) == F.col("h")) & (F.col("len") == F.col("n")) & (window == F.col("w"))
        return at.join(F.broadcast(found), same).select(*_KEY, "i", (F.col("i") + F.col("n") - 1).alias("e"), "items")
    hashed = at.select(*_KEY, "i", "len", F.xxhash64(window).alias("p"))
    met = hashed.join(found, (F.col("p") == F.col("h")) & (F.col("len") == F.col("n")))
    met = met.select(*(F.col(k).alias(f"m_{k}") for k in _KEY), "i", "n", "w", "items").distinct()
    on = F.lit(True)
    for k in _KEY:
        on = on & F.col(k).eqNullSafe(F.col(f"m_{k}"))
    return text.dropDuplicates(list(_KEY)).join(met, on).filter(F.slice("words", F.col("i"), F.col("n")) == F.col("w")).select(*_KEY, "i", (F.col("i") + F.col("n") - 1).alias("e"), "items")


def _key(docs: DataFrame) -> list[Column]:
    text = docs["text"]
    return [docs["doc_id"].alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.length(text).alias("text_size")]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence), items (sorted ids as strings), contaminated."""
    from pyspark.sql import Window

    found = hits(docs, benchmark, width)
    before = Window.partitionBy(*_KEY).orderBy("i", "e").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("e") - F.greatest(F.col("i") - 1, F.coalesce(F.max("e").over(before), F.lit(0))))
    marked = found.withColumn("new", new).groupBy(*_KEY).agg(F.sum("new").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    every = docs.select(*_key(docs), F.size(words(docs["text"])).cast("long").alias("n_words")).alias("d")
    on = F.lit(True)
    for k in _KEY:
        on = on & F.col(f"d.{k}").eqNullSafe(F.col(f"m.{k}"))
    items = F.array_sort(F.transform(F.coalesce("m.items", F.array().cast("array<long>")), lambda x: x.cast("string")))
    joined = every.join(marked.alias("m"), on, "left")
    n_hit = F.coalesce(F.col("m.n_hit"), F.lit(0)).cast("long")
    return joined.select(F.col("d.doc_id").alias("doc_id"), "d.text_hash", "d.text_size", "n_words", n_hit.alias("n_hit"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window; all their columns, of any name, stay."""
    bad = hits(docs, benchmark, width).select(*_KEY).distinct()
    text = docs["text"]
    keyed = docs.select(whole_row(docs), docs["doc_id"].alias("id"), F.xxhash64(text).alias("h"), F.length(text).alias("size"))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")) & F.col("size").eqNullSafe(F.col("text_size"))
    return unwrapped(keyed.join(bad, on, "left_anti"), docs.columns)
