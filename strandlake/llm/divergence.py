"""Audit of how the sources of a language differ: a two-pass vocabulary automaton.

The first pass counts, for every language, the documents that hold each term,
and keeps the terms of at least ``LEAST`` documents.  The second pass walks an
Aho-Corasick automaton of the kept terms, each between two delimiters, over the
texts and counts their occurrences in every (language, source) group.  What the
groups hold are sparse postings (language, term, source, count); all pairs of
sources and the terms that stand out come from these by joins on the term.

A vocabulary goes to the workers in slices of at most ``SLICE_BYTES`` of terms,
each with an automaton and a scan of its own, so that no worker and not the
driver holds more than one slice, however large the vocabulary is.

Arithmetic is exact.  With V kept terms and N occurrences of them in a group a
term that occurs c times there has p = 1 + floor(10^9 (c + 2) / (N + 2 V)), and
two groups differ in it by f = floor((p - q)^2 / (p + q)).  A pair's sum over all
V terms needs only the terms that occur: those of one group alone come from how
many terms occur how often in it, those of both from the postings that meet.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CACHES, batches, column, kept, tuned

#: Documents that must hold a kept term, and terms that are listed for a group.
LEAST, TOP = 10, 10
#: Bytes of the terms of a slice, and entries that a task gathers before it passes them on.
SLICE_BYTES, ENTRIES = 16 << 20, 1 << 18
#: Bytes of a text that the automaton walks at once (more where a term is longer).
STRETCH = 1 << 20
SCALE = 1_000_000_000

#: Bytes of terms stay (A-Z as a-z), all others become the delimiter.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counts(held: dict[tuple, Counter], names: tuple[str, ...], term: Callable) -> Iterator[pa.RecordBatch]:
    """One row for each entry: the group's columns, the term, the count."""
    for group, counter in held.items():
        cols = [pa.array([g] * len(counter), pa.string()) for g in group]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(map(term, counter), pa.string()), pa.array(counter.values(), pa.int64())], names=[*names, "term", "n"])


def _groups(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))


def vocabulary(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, term for the terms that at least ``least`` documents of the language hold; counted over all rows."""

    def run(it) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = {}
        size = 0
        for batch in batches(it):
            for lang, text in zip(column(batch, "lang"), column(batch, "text")):
                counter = held.setdefault((lang,), Counter())
                size -= len(counter)
                counter.update(set(text.translate(_TERMS).split()))
                size += len(counter)
                if size >= ENTRIES:
                    yield from _counts(held, ("lang",), bytes.decode)
                    held, size = {}, 0
        yield from _counts(held, ("lang",), bytes.decode)

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, term string, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def stretches(text: bytes) -> Iterator[str]:
    """The text with its delimiters, in stretches that share the delimiter between them."""
    text = b" " + text.translate(_TERMS) + b" "
    a = 0
    while a < len(text) - 1:
        b = a + STRETCH
        if b < len(text):
            b = text.find(b" ", b)
        b = min(b, len(text) - 1)
        yield text[a : b + 1].decode()
        a = b


#: A worker's automata, of the slice that it met last.
_BUILT: dict = {}
CACHES.append(_BUILT)


def _built(name: str) -> dict:
    if name not in _BUILT:
        _BUILT.clear()
    return _BUILT.setdefault(name, {})


def _automaton(terms: list[tuple[int, str]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, t in terms:
        found.add_word(f" {t} ", i)
    found.make_automaton()
    return found


def recount(rows: DataFrame, terms: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """lang, source, term, n: occurrences of each language's terms in its groups, where there are any."""
    spark = rows.sparkSession
    size = terms.agg(F.sum(F.octet_length("term") + F.octet_length("lang") + 16).alias("n")).first().n or 0
    slices = max(1, -(-int(size) // slice_bytes))
    parts = None
    for k in range(slices):
        own = terms.filter(F.pmod(F.xxhash64("lang", "term"), F.lit(slices)) == k).collect()  # a slice: its bytes are bounded
        by_lang: dict[str, list[tuple[int, str]]] = {}
        for i, r in enumerate(own):
            by_lang.setdefault(r.lang, []).append((i, r.term))
        shared = spark.sparkContext.broadcast(by_lang)

        def run(it, shared=shared, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, Counter] = {}
            known = _built(name)
            names = {i: t for own in shared.value.values() for i, t in own}
            size = 0

            for batch in batches(it, caches=True):
                for lang, source, text in zip(column(batch, "lang"), column(batch, "source"), column(batch, "text")):
                    if lang not in shared.value:
                        continue
                    if lang not in known:
                        known[lang] = _automaton(shared.value[lang])
                    counter = held.setdefault((lang, source), Counter())
                    size -= len(counter)
                    for s in stretches(text):
                        counter.update(map(itemgetter(1), known[lang].iter(s)))
                    size += len(counter)
                    if size >= ENTRIES:
                        yield from _counts(held, ("lang", "source"), names.__getitem__)
                        held, size = {}, 0
            yield from _counts(held, ("lang", "source"), names.__getitem__)

        part = rows.mapInArrow(run, "lang string, source string, term string, n long")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


#: A term's share in parts of 10^9, exact for any count (n occurrences; total, v: the group's occurrences and its language's terms).
_P = f"1 + ((cast({{n}} AS DECIMAL(19,0)) + 2) * {SCALE}) div (cast(total AS DECIMAL(19,0)) + 2 * cast(v AS DECIMAL(19,0)))"


def _p(n: str, **names: str) -> Column:
    text = _P.format(n=n)
    for old, new in names.items():
        text = text.replace(f"cast({old} ", f"cast({new} ")
    return F.expr(text)


def _f(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def group_sizes(rows: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """lang, source, total, v, none for every group that occurs: occurrences of kept terms, kept terms, share of a term without any."""
    v = terms.groupBy("lang").agg(F.count("*").alias("v"))
    total = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    found = rows.select("lang", "source").distinct().join(total, ["lang", "source"], "left").join(v, "lang", "left").fillna(0, ["total", "v"])
    return found.withColumn("none", F.when(F.col("v") > 0, _p("0")).otherwise(0).cast("long"))


def term_ranks(postings: DataFrame, sizes: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the terms that are more frequent in a group than in its language and differ most."""
    lang = sizes.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    rows = postings.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "term")))
    rows = rows.join(sizes, ["lang", "source"]).join(lang, "lang").select("lang", "source", F.col("term").alias("item"), _p("n").alias("p"), _p("lang_n", total="lang_total").alias("q"))
    rows = rows.filter("p > q").select("lang", "source", "item", _f("p", "q").alias("value"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).filter(F.col("rank") <= top)


def pair_ranks(postings: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language, by how much the two differ."""
    one = lambda name: sizes.select("lang", F.col("source").alias(name), F.col("none").alias(f"{name}_none"), "v")
    base = one("a").join(one("b").drop("v"), "lang").filter("a < b").select("lang", "a", "b", (F.col("v") * F.when(F.col("v") > 0, _f("a_none", "b_none")).otherwise(0)).alias("value"))
    # the terms of one group as if the other had none of them: groups have few distinct counts
    shares = postings.groupBy("lang", "source", "n").agg(F.count("*").alias("k")).join(sizes, ["lang", "source"]).select("lang", "source", "none", "k", _p("n").alias("p"))
    alone = shares.join(one("b").drop("v"), "lang").filter("source <> b")
    value = F.col("k") * (_f("p", "b_none") - _f("none", "b_none"))
    alone = alone.select("lang", F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b"), value.alias("value"))
    # what that counts wrongly where both have a term
    held = postings.join(sizes, ["lang", "source"]).select("lang", "term", "source", "none", _p("n").alias("p"))
    x, y = (held.select("lang", "term", F.col("source").alias(s), F.col("none").alias(f"{s}_none"), F.col("p").alias(f"{s}_p")) for s in "ab")
    value = _f("a_p", "b_p") - _f("a_p", "b_none") - _f("a_none", "b_p") + _f("a_none", "b_none")
    both = x.join(y, ["lang", "term"]).filter("a < b").select("lang", "a", "b", value.alias("value"))
    pairs = base.unionByName(alone).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    way = lambda s, t: F.struct(F.col(s).alias("source"), F.col(t).alias("item"))
    rows = pairs.select("lang", F.explode(F.array(way("a", "b"), way("b", "a"))).alias("w"), "value").select("lang", "w.source", "w.item", "value")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, slice_bytes: int = SLICE_BYTES, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far sources differ (part ``pair``) and in which terms (part ``term``).

    Cases: a null text, language or source is an empty one; rows that repeat
    count each; a group whose texts have no kept term has a share all the same,
    and one whose language keeps none differs by 0 from the others; a language
    of one source has no pair; ties go by the item's bytes; a text of any length
    is taken whole; an empty table gives no row; further columns are left out.
    """
    tuned(docs.sparkSession)
    rows = _groups(docs, text_col, lang_col, source_col)
    terms = kept(vocabulary(rows, least), "audit-terms")
    postings = kept(recount(rows, terms, slice_bytes), "audit-postings")
    sizes = kept(group_sizes(rows, terms, postings), "audit-sizes")
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return named(pair_ranks(postings, sizes), "pair").unionByName(named(term_ranks(postings, sizes, top), "term"))
