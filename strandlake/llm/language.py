"""Language identification by prediction by partial matching (PPM).

For each language a variable-order byte context tree is learned: how often each
byte followed each context of up to three bytes.  A byte's probability is that
of its longest known context; where the context has not seen it, the escape
probability d / (n + d) (n: occurrences, d: distinct bytes, the estimator
called C) leads to the next shorter one, from which the bytes seen above are
excluded; below the empty context all 256 bytes are alike.  Statistics are
frozen after learning.  The shortest code of the whole text names the language.

A tree is kept as one sorted array of the contexts' bytes for each order, so it
takes room for contexts that occurred and no others, whatever the script or the
number of languages.  Since a byte's code length is a function of it and the
three before, each worker keeps the code lengths of the byte strings that it has
met in a direct-mapped cache of bounded size; what isn't there is computed from
the trees.  Code lengths are in 1/65536 bit.

A-Z count as a-z, and three spaces stand before the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, column, free, tuned

UNKNOWN = "und"
#: Learn from at most so many documents of a language, those of the least hash of their id,
#: among the whole texts of so many bytes at most.
SAMPLE_DOCS, SAMPLE_BYTES = 400, 1 << 16
ORDER, UNIT = 3, 1 << 16
#: Slots of a worker's cache, and bytes that are looked up at once.
SLOT_BITS, CHUNK = 18, 1 << 18


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _grams(data: bytes, order: int) -> np.ndarray:
    """Each byte and the ``order`` before it, as one number; spaces stand before the text."""
    s = np.frombuffer(b" " * order + data, np.uint8).astype(np.uint32)
    out = np.zeros(len(data), np.uint32)
    for j in range(order + 1):
        out = out << np.uint32(8) | s[j : j + len(data)]
    return out


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each wanted number in sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return i, keys[i] == wanted


class Tree:
    """One language's contexts: for each order the strings with their probability, the contexts with their escape."""

    def __init__(self, samples: list[bytes], order: int = ORDER) -> None:
        self.levels = []
        deepest = np.concatenate([_grams(x, order) for x in samples if x] or [np.zeros(0, np.uint32)])
        below, lower = None, None  # strings one order down, and their probability there
        for k in range(order + 1):
            mask = np.uint32((1 << 8 * (k + 1)) - 1)
            strings, counts = np.unique(deepest & mask, return_counts=True)
            contexts, first = np.unique(strings >> np.uint32(8), return_index=True)
            d = np.diff(np.append(first, len(strings)))
            n = np.add.reduceat(counts, first) if len(first) else counts
            own = counts / np.repeat(n + d, d)
            if k:
                short = lower[np.searchsorted(below, strings & (mask >> np.uint32(8)))]
            else:
                short = np.full(len(strings), 1 / 256)
            rest = 1 - (np.add.reduceat(short, first) if len(first) else short)
            self.levels.append((strings, np.log2(own), contexts, np.log2(d / (n + d)) - np.log2(np.maximum(rest, 1e-9))))
            below, lower = strings, own

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of each string's last byte after the bytes before it."""
        out, open_ = np.zeros(len(grams)), np.arange(len(grams))
        for k in reversed(range(len(self.levels))):
            strings, own, contexts, escape = self.levels[k]
            g = grams[open_] & np.uint32((1 << 8 * (k + 1)) - 1)
            i, there = _at(strings, g)
            out[open_[there]] -= own[i[there]] if len(own) else 0
            open_, g = open_[~there], g[~there]
            c, known = _at(contexts, g >> np.uint32(8))
            out[open_[known]] -= escape[c[known]] if len(escape) else 0
        out[open_] += 8
        return out


class Model:
    """Frozen trees of all languages, and a worker's cache of code lengths."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER) -> None:
        if not 1 <= order <= 3:
            raise ValueError("contexts have one to three bytes")
        self.languages, self.order = sorted(samples), order
        self.trees = [Tree([t.encode().lower() for t in samples[k]], order) for k in self.languages]
        self._cache = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_cache": None}

    def _lengths(self, grams: np.ndarray) -> np.ndarray:
        """Units that each byte takes in each language."""
        if self._cache is None:
            self._cache = np.zeros(1 << SLOT_BITS, np.uint32), np.zeros(1 << SLOT_BITS, bool), np.zeros((1 << SLOT_BITS, len(self.trees)), np.int32)
        keys, used, lengths = self._cache
        slot = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
        out = lengths[slot]
        miss = np.flatnonzero((keys[slot] != grams) | ~used[slot])
        if len(miss):
            new, of = np.unique(grams[miss], return_inverse=True)
            found = np.stack([np.rint(t.bits(new) * UNIT) for t in self.trees], axis=1).astype(np.int32)
            out[miss] = found[of]
            s = (new * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
            s, one = np.unique(s, return_index=True)  # strings may share a slot: one of them gets it
            keys[s], used[s], lengths[s] = new[one], True, found[one]
        return out

    def code_lengths(self, text: str) -> np.ndarray:
        """Units of 1/65536 bit that the whole text takes in each language."""
        data = text.encode().lower()
        total = np.zeros(len(self.languages), np.int64)
        grams = _grams(data, self.order)
        for i in range(0, len(grams), CHUNK):
            total += self._lengths(grams[i : i + CHUNK]).sum(axis=0, dtype=np.int64)
        return total

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior under equal priors of each text; ``und``, 0 without a letter."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return out
        held, size = [], 0
        for i, t in enumerate(texts):
            if t and any(map(str.isalpha, t)):
                held.append((i, t.encode().lower()))
                size += len(held[-1][1])
            if held and (size > CHUNK or i == len(texts) - 1):
                self._predict(held, out)
                held, size = [], 0
        if held:
            self._predict(held, out)
        return out

    def _predict(self, held: list[tuple[int, bytes]], out: list) -> None:
        grams = np.concatenate([_grams(d, self.order) for _, d in held])
        starts = np.cumsum([0, *(len(d) for _, d in held[:-1])])
        total = np.zeros((len(held), len(self.languages)), np.int64)
        for a in range(0, len(grams), CHUNK):
            own = self._lengths(grams[a : a + CHUNK])
            cut = np.unique(np.clip(starts - a, 0, len(own)))
            cut = np.unique(np.append(0, cut[cut < len(own)]))
            of = np.searchsorted(starts, cut + a, side="right") - 1
            total[of] += np.add.reduceat(own, cut, axis=0, dtype=np.int64)
        bits = total / UNIT
        best = bits.argmin(axis=1)
        score = 1 / np.exp2(np.maximum(bits[np.arange(len(held)), best][:, None] - bits, -1000)).sum(axis=1)
        for (i, _), b, s in zip(held, best.tolist(), score.tolist()):
            out[i] = self.languages[b], s

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the documents whose fold is not 0 and that have a language and a text.

    Of each language at most ``sample_docs`` whole texts, of ``sample_bytes``
    bytes each at most, are learned from; a third more of them reach the driver.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0) & (F.octet_length("text") <= sample_bytes))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    spark = docs.sparkSession
    share = spark.createDataFrame([(k, min(1.0, 1.3 * sample_docs / n)) for k, n in sorted(sizes.items())], "lang string, share double")
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.withColumn("rank", rank).join(F.broadcast(share), "lang").filter("rank < share").select("lang", "rank", "doc_id", "text").collect()
    samples: dict[str, list] = {k: [] for k in sizes}
    for r in sorted(picked, key=lambda r: (r["rank"], r["doc_id"], r["text"])):
        if len(samples[r["lang"]]) < sample_docs:
            samples[r["lang"]].append(r["text"])
    return Model(samples)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    Cases: null, empty and letterless texts are ``und`` with score 0; a null
    doc_id is not held out and not learned from; repeated rows get the same
    answer; without any language all are ``und``; further columns are left out.
    """
    shared = tuned(docs.sparkSession).sparkContext.broadcast(model)

    def run(it) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches(it):
            found = known.predict_all(column(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def judged_names(docs: DataFrame) -> tuple[str, str]:
    """Names of the two columns that ``judged`` adds."""
    return free("lang_pred", docs.columns), free("score", docs.columns)


def judged(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (see ``judged_names``); any columns are taken along, one batch after another.

    Cases: as of ``identify``; a column that has such a name already stays, the
    new one gets underscores behind.
    """
    shared = tuned(docs.sparkSession).sparkContext.broadcast(model)
    names = judged_names(docs)

    def run(it) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches(it):
            found = known.predict_all(column(batch, text_col))
            cols = [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(run, schema)
