"""Toxicity by non-negative positive-unlabelled learning.

Classifiers are trained on numpy from two samples: texts that are confirmed
toxic, and unlabelled texts of any kind.  No text counts as confirmed clean.
With the class prior pi (the share of toxic rows among the labels) the risk over
clean texts is that over unlabelled ones less that of the toxic ones among them,

    pi E_p[l(f)] + max(0, E_u[l(-f)] - pi E_p[l(-f)]),

l being the logistic loss.  The difference is a mean over clean texts and can't
be negative; where the sample makes it so, the classifier has begun to learn the
sample by heart, and steps go back up (``back``) until it isn't.

A classifier is linear in which words a text holds (whole text, hashed), with an
L1 penalty, so that it keeps the words that tell and no noise piles up over long
texts.  Each of ``BAGS`` classifiers learns from a share of the samples in a
task of its own and is calibrated on another share by the same risk (a scale and
an offset, unpenalised); the score is the mean of their probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, tuned
from .language import fold

#: Most confirmed toxic and unlabelled texts that are learned from (those of the least hash of their id), and most bytes of one.
TOXIC_DOCS, OTHER_DOCS, SAMPLE_BYTES = 4000, 12000, 1 << 14
#: Classifiers, hashed words, and texts of a sample that must hold a word.
BAGS, WIDTH, LEAST = 3, 1 << 18, 3
#: Most words whose weights a worker remembers.
KNOWN = 1 << 17

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> set[bytes]:
    """The distinct words of a whole text: runs of letters A-Z (as a-z) and of characters beyond ASCII."""
    return set((text or b"").translate(_WORDS).split())


def place(word: bytes) -> int:
    return zlib.crc32(word) % WIDTH


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def _slope(f: np.ndarray, toxic: np.ndarray, prior: float, back: float) -> np.ndarray:
    """Gradient of the corrected risk by each text's value."""
    n_toxic, n_other = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    p = _sigmoid(f)
    clean = np.where(toxic, -prior / n_toxic, 1 / n_other)  # what a text weighs in the risk over clean texts
    risk = float((clean * np.logaddexp(0, f)).sum())
    if risk < 0:
        return -back * clean * p
    return np.where(toxic, -prior / n_toxic * (1 - p), 0) + clean * p


class Classifier:
    """Weights of hashed words, an offset, calibrated."""

    def __init__(self, prior: float, penalty: float = 1.0, relaxed: float = 0.2, rounds: int = 150, back: float = 1.0) -> None:
        self.prior, self.penalty, self.relaxed, self.rounds, self.back = prior, penalty, relaxed, rounds, back
        self.places, self.weights, self.offset = np.zeros(0, np.int32), np.zeros(0), float(np.log(prior / (1 - prior)))

    @classmethod
    def of(cls, prior: float, places: np.ndarray, weights: np.ndarray, offset: float) -> "Classifier":
        """A classifier that was fitted before."""
        own = cls(prior)
        own.places, own.weights, own.offset = places, weights, offset
        return own

    def fit(self, texts: list[np.ndarray], toxic: np.ndarray, held: np.ndarray) -> "Classifier":
        """Learn from the texts that are not held out, and calibrate on those that are.

        Words are centred and scaled to variance one; then what chance alone adds
        to a gradient is alike for all of them, and the penalty is a multiple of
        what it reaches in so many words.
        """
        learn, y = [t for t, h in zip(texts, held) if not h], toxic[~held]
        flat = np.concatenate([*learn, np.zeros(0, np.int32)])
        row = np.repeat(np.arange(len(learn)), [len(t) for t in learn])
        counts = np.bincount(flat, minlength=WIDTH)
        for penalty in (self.penalty, self.penalty * self.relaxed):  # choose words; weigh those that were chosen
            self.places = np.flatnonzero(counts >= LEAST).astype(np.int32)
            if not len(self.places) or not y.any():
                break
            at = np.full(WIDTH, -1, np.int32)
            at[self.places] = np.arange(len(self.places))
            here = at[flat] >= 0
            flat, row = flat[here], row[here]
            self.weights, self.offset = self._descend(row, at[flat], y, penalty, counts[self.places] / len(learn))
            counts = np.bincount(self.places[self.weights != 0], minlength=WIDTH) * counts
        some = self.weights != 0
        self.places, self.weights = self.places[: len(some)][some], self.weights[some]
        self._calibrate(np.array([self.value(t) for t, h in zip(texts, held) if h]), toxic[held])
        return self

    def _descend(self, row: np.ndarray, at: np.ndarray, y: np.ndarray, penalty: float, mean: np.ndarray) -> tuple[np.ndarray, float]:
        """Accelerated proximal steps; their length from the greatest curvature, found by power iteration."""
        unit, docs, n = 1 / np.sqrt(mean * np.maximum(1 - mean, 1 / len(y))), len(y), len(mean)
        value = lambda v: np.bincount(row, (v * unit)[at], docs) - float((v * unit * mean).sum())
        slope = lambda g: (np.bincount(at, g[row], n) - mean * g.sum()) * unit
        penalty *= self.prior / 2 * np.sqrt(2 * np.log(n + 1) / y.sum())
        weigh = np.where(y, self.prior / y.sum(), 1 / max(1, (~y).sum())) / 4
        v, most = np.ones(n) / np.sqrt(n), 0.0
        for _ in range(12):
            v = slope(weigh * value(v))
            most = float(np.linalg.norm(v))
            v = v / max(most, 1e-12)
        step = 1 / max(1.5 * most, 1e-6)
        w, b, at_w, at_b, t = np.zeros(n), self.offset, np.zeros(n), self.offset, 1.0
        for _ in range(self.rounds):
            g = _slope(at_b + value(at_w), y, self.prior, self.back)
            new = at_w - step * slope(g)
            new = np.sign(new) * np.maximum(0, np.abs(new) - step * penalty)
            new_b = at_b - 2 * float(g.sum())
            t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            at_w, at_b = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
            w, b = new, new_b
        return w * unit, b - float((w * unit * mean).sum())

    def _calibrate(self, f: np.ndarray, toxic: np.ndarray) -> None:
        """Scale and offset of least corrected risk on texts that weren't learned from."""
        if not toxic.any() or toxic.all():
            return
        a, b, ga, gb = 1.0, 0.0, 1e-12, 1e-12
        for _ in range(400):
            g = _slope(a * f + b, toxic, self.prior, 0.0)
            da, db = float((g * f).sum()), float(g.sum())
            ga, gb = ga + da * da, gb + db * db
            a, b = max(0.1, a - 0.3 / np.sqrt(ga) * da), b - 0.3 / np.sqrt(gb) * db
        self.offset, self.weights = a * self.offset + b, a * self.weights

    def value(self, places: np.ndarray) -> float:
        if not len(self.places):
            return self.offset
        i = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return self.offset + float(self.weights[i][self.places[i] == places].sum())


class Model:
    """Classifiers of all bags; without one, every text has the prior."""

    def __init__(self, prior: float, bags: list[Classifier]) -> None:
        self.prior, self.bags = prior, bags
        places = np.unique(np.concatenate([*(c.places for c in bags), np.zeros(0, np.int32)]))
        self._at = {int(k): i for i, k in enumerate(places)}
        self._weights = np.zeros((len(places) + 1, max(1, len(bags))))  # the last row is that of words without a weight
        for j, c in enumerate(bags):
            self._weights[np.searchsorted(places, c.places), j] = c.weights
        self._offsets = np.array([c.offset for c in bags])
        self._known: dict[bytes, int] = {}

    def score(self, text: bytes | None) -> float:
        if not self.bags:
            return self.prior
        known, none = self._known, len(self._weights) - 1
        if len(known) > KNOWN:
            known.clear()
        rows = []
        for w in words_of(text):
            if (i := known.get(w)) is None:
                i = known[w] = self._at.get(place(w), none)
            if i != none:
                rows.append((place(w), i))
        some = [i for _, i in sorted(set(rows))]  # words of one place count once, in one order
        return float(_sigmoid(self._offsets + self._weights[some].sum(axis=0)).mean())


def learn(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, other_docs: int = OTHER_DOCS, sample_bytes: int = SAMPLE_BYTES, bags: int = BAGS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from documents whose fold is not 0: confirmed toxic ones, and unlabelled ones whatever their label is.

    The prior is the share of 1 among all 0 and 1 of the labels in these folds;
    an id is toxic if any label of it says so.  The samples are bounded, and
    each classifier is fitted in a task of its own.  Without toxic examples,
    or without a text, there is no classifier.
    """
    tuned(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter((fold(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1))
    sizes = known.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    prior = (sizes.toxic or 0) / max(1, sizes.n)
    if not sizes.toxic:
        return Model(prior, [])
    prior = min(max(prior, 0.001), 0.999)
    rank = F.xxhash64("doc_id")
    toxic = known.filter("toxic = 1").select("doc_id").distinct().orderBy(rank, "doc_id").limit(toxic_docs).withColumn("is_toxic", F.lit(True))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    least = ids.filter(fold(F.col("doc_id")) != 0).select(rank.alias("h")).orderBy("h").limit(other_docs).agg(F.max("h").alias("h")).first().h
    if least is None:
        return Model(prior, [])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).filter((fold(F.col("doc_id")) != 0) & F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes))
    rows = rows.join(F.broadcast(toxic), "doc_id", "left").withColumn("h", rank)
    roles = F.array_compact(F.array(F.when(F.col("is_toxic"), True), F.when(F.col("h") <= least, False)))

    def words(it) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            places = [np.unique(np.array([place(w) for w in words_of(t)], np.int32)).tobytes() for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.binary())], names=["h", "toxic", "places"])

    sample = rows.filter(F.col("is_toxic") | (F.col("h") <= least)).select("h", F.explode(roles).alias("toxic"), "text").mapInArrow(words, "h long, toxic boolean, places binary")
    some = lambda is_toxic, n: sample.filter(F.col("toxic") == is_toxic).orderBy("h", "places").limit(n)  # noqa: E731  ids may be shared
    sample = some(True, toxic_docs).unionByName(some(False, other_docs)).withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))))

    def fit(key, frame):
        import pandas as pd

        frame = frame.sort_values(["h", "toxic", "places"])
        held = (frame["h"].to_numpy() % max(2, bags)) == key[0]
        own = Classifier(prior).fit([np.frombuffer(p, np.int32) for p in frame["places"]], frame["toxic"].to_numpy(bool), held)
        return pd.DataFrame([{"bag": key[0], "places": own.places.tobytes(), "weights": own.weights.tobytes(), "offset": own.offset}])

    found = sample.groupBy("bag").applyInPandas(fit, "bag int, places binary, weights binary, offset double").orderBy("bag").collect()
    return Model(prior, [Classifier.of(prior, np.frombuffer(r["places"], np.int32), np.frombuffer(r["weights"]), r["offset"]) for r in found])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Cases: null, empty and wordless texts have the score of no word; a null
    doc_id is not held out and not learned from; repeated rows get the same
    answer; a text of any length is taken whole; without toxic labels all have
    the prior (0 without labels); an empty table gives no row; further columns
    are left out.
    """
    shared = tuned(docs.sparkSession).sparkContext.broadcast(model)

    def run(it) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches(it):
            scores = [known.score(t) for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
