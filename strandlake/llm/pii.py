"""Personal data: candidate spans scored by gradient-boosted trees.

Kinds are email, ip, card and phone.  *Base* matches follow fixed patterns and
checks and always stay.  High-recall generators also propose spans in freer
forms (an address spelled with "at" and "dot", numbers with other separators,
numbers without a leading plus), which may overlap, and, as a fifth kind that
only the method adds, secrets: values given to a token, key or password.
Boosted trees score each proposal by its format and by the text around it; a
threshold for each kind, set on held-out examples so that precision is kept,
selects the redactions.  Selected spans that overlap a base span or a better
one give way.

The trees learn from examples that ``examples`` makes from a seed and, where
``labelled`` gives them, from spans of a bounded sample of the corpus: a
proposal that a base match confirms is personal data, any other that touches
none is not.  Half of either sets the thresholds.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, texts_of, tuned

KINDS = ("email", "ip", "card", "phone")
#: Kinds of all spans, in their order.
EVERY_KIND = (*KINDS, "secret")
#: Documents, and bytes of each, that ``labelled`` takes proposals from at most.
SAMPLE_DOCS, SAMPLE_BYTES = 2000, 1 << 15
Span = tuple[str, int, int]

# The base patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """As the leftmost search for local part, at sign and domain finds them."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            yield "email", start, m.end()
            end = m.end()


def base_spans(text: str) -> list[Span]:
    """Base matches, by kind as listed and then by start."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGITS.search(text) is None:
        return found
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0]) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_only_digits(m[0])) <= 15]
    return found


# Generators of proposals: wide forms, checked by the trees alone.
_WIDE_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?:\s?(?:@|\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\])\s?[A-Za-z0-9-]{2,24}| dot [A-Za-z0-9-]{2,24}){1,4}| at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{2,24}){1,4})", re.I)
_WIDE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?: ?\. ?|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){12,18}(?![0-9])")
_WIDE_PHONE = re.compile(r"(?<![0-9A-Za-z])(?:\(?[0-9]{2,4}\)?[ ./-]{1,2})(?:[0-9]{2,6}[ ./-]{1,2}){0,4}[0-9]{2,5}(?![0-9A-Za-z])")
_SECRET = re.compile(r"""(?<![A-Za-z0-9])(?:api|access|private|client|secret|auth)?[ _-]?(?:token|secret|password|passwd|pwd|key|bearer|credentials?)["']?\s{0,2}(?:=>|:=|=|:|\bis\b)\s{0,2}["']?([A-Za-z0-9+/_.=~!@#$%^&*-]{8,200})""", re.I)
_KEYED = re.compile("token|secret|passw|pwd|key|bearer|credential", re.I)
_WIDE = {"email": _WIDE_EMAIL, "ip": _WIDE_IP, "card": _WIDE_CARD, "phone": _WIDE_PHONE}
_AT = re.compile(r"@|[(\[{]at[)\]}]| at \S{1,63} dot ", re.I)

# Words that name a kind close to it.
CUES = {
    "email": ("email", "e-mail", "mail", "contact", "write", "reply", "address", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr", "ping", "login", "network"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "sms", "telefon", "whatsapp", "number"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "api", "bearer", "credential", "credentials"),
}
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "info", "example", "de", "fr", "es", "uk", "io", "eu", "us")
OTHER_CUES = ("version", "isbn", "order", "invoice", "page", "chapter", "serial", "date", "total", "section", "build", "ref", "sum", "score", "year")
_DATE = re.compile(r"(?:19|20)[0-9]{2}|[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)?[0-9]{2}\Z")
_NAMES = ["kind", "digits", "groups", "longest group", "shortest group", "equal groups", "separator", "luhn", "parens", "first digit", "octets", "leading zero", "date", "letters", "cue", "other cue", "cue of another kind", "before", "after", "has at", "spelled", "last group", "length", "distinct", "switches", "hex", "top domain"]


_HEX = re.compile(r"[0-9a-fA-F]{16,}\Z")


def _edge(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in ".,;:)(" else 4 if c in "/\\=#$%&*_" else 5


def features(text: str, span: Span) -> list[float]:
    """Format of a span, and the 40 characters before and 12 behind it."""
    kind, a, b = span
    s, before, behind = text[a:b], text[max(0, a - 40) : a].lower(), text[b : b + 12].lower()
    groups = re.findall("[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    words = set(re.findall(r"[a-z-]+", before))
    separators = set(re.sub(r"[0-9A-Za-z]", "", s))
    separator = 0 if not separators else 1 if separators == {" "} else 2 if separators == {"-"} else 3 if separators == {"."} else 4 if separators <= set(" ()-") else 5
    return [
        EVERY_KIND.index(kind), len(digits), len(sizes), max(sizes), min(sizes), float(len(set(sizes)) == 1), separator,
        float(bool(digits) and luhn(digits)), float("(" in s and ")" in s), float(digits[:1] or -1),
        float(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)), float(any(len(g) > 1 and g[0] == "0" for g in groups)), float(bool(_DATE.match(s.replace(" ", "")))),
        sum(c.isalpha() for c in s), float(any(w in words for w in CUES[kind])), float(any(w in words for w in OTHER_CUES)), float(any(w in words for k in EVERY_KIND if k != kind for w in CUES[k])),
        _edge(before[-1:]), _edge(behind[:1]), float("@" in s), float(bool(re.search(r"[(\[{]\s?(?:at|dot)\s?[)\]}]|\bat\b.*\bdot\b", s, re.I))), sizes[-1], b - a,
        len(set(s)), sum(c.isdigit() != d.isdigit() for c, d in zip(s, s[1:])), float(bool(_HEX.match(s))), float(re.split("[^a-z]+", s.lower())[-1] in TOP_DOMAINS),
    ]


def proposals(text: str) -> list[Span]:
    """Spans of all generators; they may overlap one another and base spans."""
    found: list[Span] = []
    if _AT.search(text):
        found += [("email", m.start(), m.end()) for m in _WIDE_EMAIL.finditer(text)]
    if _DIGITS.search(text):
        for kind in ("ip", "card", "phone"):
            found += [(kind, m.start(), m.end()) for m in _WIDE[kind].finditer(text) if kind != "phone" or 7 <= len(_only_digits(m[0])) <= 15]
    if _KEYED.search(text):
        found += [("secret", m.start(1), m.end(1)) for m in _SECRET.finditer(text)]
    return found


class Trees:
    """Gradient boosting of depth-three trees for the logistic loss, on numpy."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, least: int = 8) -> None:
        self.rounds, self.depth, self.rate, self.least = rounds, depth, rate, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        self.cuts = [np.unique(x[:, j])[:-1] for j in range(x.shape[1])]
        self.bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        f, self.trees = np.full(len(y), self.bias), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(x, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            f += self.rate * self._walk(tree, x)
            self.trees.append(tree)
        return self

    def _grow(self, x, g, h, rows, depth):
        leaf = float(g[rows].sum() / (h[rows].sum() + 1))
        if not depth or len(rows) < 2 * self.least:
            return leaf
        best, total = (1e-6, None, None), g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for j, cuts in enumerate(self.cuts):
            if len(cuts) > 32:
                cuts = cuts[np.linspace(0, len(cuts) - 1, 32).astype(int)]
            for c in cuts:
                left = x[rows, j] <= c
                if self.least <= left.sum() <= len(rows) - self.least:
                    a, b = rows[left], rows[~left]
                    gain = g[a].sum() ** 2 / (h[a].sum() + 1) + g[b].sum() ** 2 / (h[b].sum() + 1) - total
                    if gain > best[0]:
                        best = (gain, j, c)
        if best[1] is None:
            return leaf
        left = x[rows, best[1]] <= best[2]
        return best[1], float(best[2]), self._grow(x, g, h, rows[left], depth - 1), self._grow(x, g, h, rows[~left], depth - 1)

    def _walk(self, tree, x: np.ndarray) -> np.ndarray:
        if isinstance(tree, float):
            return np.full(len(x), tree)
        j, c, a, b = tree
        return np.where(x[:, j] <= c, self._walk(a, x), self._walk(b, x))

    def probability(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.bias)
        for tree in self.trees:
            f += self.rate * self._walk(tree, x)
        return 1 / (1 + np.exp(-f))


def examples(n: int, seed: int) -> list[tuple[str, Span, bool]]:
    """Labelled spans in made-up text: personal data in free forms, and what only looks like it."""
    rnd = random.Random(seed)
    letters = "abcdefghijklmnoprstuvw"
    _word = word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9)))
    num = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def card(good: bool) -> str:
        while True:
            d = rnd.choice("3456") + num(rnd.choice([12, 14, 15, 15, 15, 18]))
            if luhn(d) == good:
                return d

    def phone() -> str:
        s = rnd.choice([" ", "-", ".", "/"])
        return rnd.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{s}{num(3)}{s}{num(4)}", f"00{s}{num(2)}{s}{num(3)}{s}{num(3)}{s}{num(2)}", f"0{num(2)}{s}{num(3)}{s}{num(4)}", f"0{num(1)}{s}{num(2)}{s}{num(2)}{s}{num(2)}{s}{num(2)}"])

    def email() -> str:
        at, dot = rnd.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), (" @ ", "."), ("[at]", "."), ("@", " . ")])
        name = rnd.choice([f"{word()}.{num(2)}", word(), f"{word()}.{word()}", f"{word().title()}.{word().title()}", f"{word()}_{num(2)}", f"{word()[0]}.{word()}"])
        return f"{name}{at}{rnd.choice([word(), word() + '-' + word()])}{dot}{rnd.choice(TOP_DOMAINS)}"

    out = []
    while len(out) < n:
        kind = rnd.choice(EVERY_KIND)
        good = rnd.random() < 0.5
        if kind == "email" and not good:
            word = lambda: next(w for w in iter(_word, None) if w not in TOP_DOMAINS)
        else:
            word = _word
        if kind == "secret":
            name = rnd.choice(["token", "api_key", "secret", "password", "access key", "TOKEN", "client_secret"])
            some = lambda letters_, k: "".join(rnd.choice(letters_) for _ in range(k))
            value = some(*rnd.choice([("0123456789abcdef", 40), ("0123456789ABCDEF", 32), (letters + letters.upper() + "0123456789", rnd.randint(16, 40)), (letters + "0123456789+/", 32)])) if good else rnd.choice([word() + word() + word(), word() + "_" + word() + "_" + word(), "x" * rnd.randint(8, 20), word() + "." + word() + ".", word().upper() + word()])
            quote = rnd.choice(['"', "'", ""])
            text = f"{word()} {word()} {name}{rnd.choice([' = ', ': ', '=', ' is '])}{quote}{value}{quote} {word()}"
            if spans := [p for p in proposals(text) if p[0] == kind]:
                out.append((text, spans[0], good))
            continue
        if kind == "email":
            s = email() if good else rnd.choice([f"{word()} @ {word()}. {word().title()}", f"{word()} @{word()}, {word()}. {word()}", f"{num(2)} @ {num(2)}.{num(2)}", f"{word()} at {word()} dot {num(3)}"])
        elif kind == "ip":
            octet = lambda: str(rnd.randint(0, 255))
            s = rnd.choice(["[.]", "(.)", " . "]).join(octet() for _ in range(4)) if good else rnd.choice([f"{rnd.randint(256, 999)}.{num(3)}.{num(2)}.{num(3)}", ". ".join(num(rnd.randint(1, 3)) for _ in range(4)), " . ".join(num(3) for _ in range(4))])
        elif kind == "card":
            d = card(good or rnd.random() < 0.1)
            s = rnd.choice([" ", "-", ".", "/", " - "]).join(d[i : i + 4] for i in range(0, len(d), 4)) if rnd.random() < 0.8 or not good else d
        else:
            s = phone() if good else rnd.choice([f"{rnd.randint(1900, 2030)}-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}", f"{num(4)}-{num(4)}", f"{num(2)}.{num(2)}.{rnd.randint(1950, 2030)}", f"{num(3)} {num(3)} {num(3)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(4)} {num(4)}", f"{num(3)}.{num(3)}.{num(2)}", f"{rnd.randint(10, 99)} - {rnd.randint(100, 999)} - {num(3)}"])
        cue = rnd.choice(CUES[kind]) if rnd.random() < (0.75 if good else 0.1) else rnd.choice(OTHER_CUES) if rnd.random() < (0.05 if good else 0.6) else word()
        if kind in ("phone", "card") and good and cue not in CUES[kind]:
            if kind == "phone" and "(" not in s:
                good = False  # bare groups of digits without a cue are not taken for a number to call
        head, tail = " ".join(word() for _ in range(3)), " ".join(word() for _ in range(2))
        text = f"{head} {cue}{rnd.choice([' ', ': ', ' is '])}{s}{rnd.choice([' ', '. ', ', '])}{tail}"
        if spans := [p for p in proposals(text) if p[0] == kind and p not in base_spans(text)]:
            out.append((text, spans[0], good))
    return out


Labelled = tuple[str, Span, bool]


def labelled(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> list[Labelled]:
    """Proposals in a bounded sample of whole texts (of the least hash of the id), each with what base matches say of it.

    The text around a span is cut to what its features look at.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col)).alias("h"))
    least = rows.select("h").orderBy("h").limit(sample_docs).agg(F.max("h").alias("h")).first().h  # hashes alone: no text goes to the driver for it
    if least is None:
        return []
    out = []
    for r in rows.filter((F.col("h") <= least) & (F.octet_length("text") <= sample_bytes)).orderBy("h", "text").limit(sample_docs).collect():
        base = base_spans(r.text)
        for kind, a, b in proposals(r.text):
            own = [s for s in base if s[1] < b and a < s[2]]
            if kind in KINDS and (not own or (kind, a, b) in own):  # base matches say nothing of secrets
                low = max(0, a - 60)
                out.append((r.text[low : b + 20], (kind, a - low, b - low), bool(own)))
    return out


class Detector:
    """Trees and a calibrated threshold for each kind."""

    def __init__(self, n: int = 4000, seed: int = 7, precision: float = 0.995, corpus: list[Labelled] | None = None) -> None:
        corpus = corpus or []
        learn, held = examples(n, seed) + corpus[::2], examples(n // 2, seed + 1) + corpus[1::2]
        table = lambda rows: (np.array([features(t, s) for t, s, _ in rows]), np.array([g for _, _, g in rows], float))
        self.trees = Trees().fit(*table(learn))
        x, y = table(held)
        p, kinds = self.trees.probability(x), np.array([EVERY_KIND.index(s[0]) for _, s, _ in held])
        self.thresholds = {k: self._calibrate(p[kinds == i], y[kinds == i], precision) for i, k in enumerate(EVERY_KIND)}

    @staticmethod
    def _calibrate(p: np.ndarray, y: np.ndarray, precision: float) -> float:
        """Least score from which on the held-out precision is kept; at least 0.5."""
        order = np.argsort(-p)
        kept = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
        ok = np.flatnonzero(kept >= precision)
        return max(0.5, float(p[order][ok[-1]])) if len(ok) else 2.0

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all selected spans, each by kind as listed and then by start."""
        base = base_spans(text)
        order = lambda s: (EVERY_KIND.index(s[0]), s[1], s[2])
        taken = _united(base)
        free = [p for p in proposals(text) if not _meets(taken, p[1], p[2])]
        if free:
            score = self.trees.probability(np.array([features(text, p) for p in free]))
            chosen = list(base)
            for s, p in sorted(zip(score.tolist(), free), key=lambda x: (-x[0], x[1][1], x[1][2], x[1][0])):
                if s >= self.thresholds[p[0]] and not _meets(taken, p[1], p[2]):
                    chosen.append(p)
                    bisect.insort(taken, (p[1], p[2]))
            return base, sorted(chosen, key=order)
        return base, sorted(base, key=order)


def _united(spans: list[Span]) -> list[tuple[int, int]]:
    """Stretches that the spans cover, in order; none meets another."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _meets(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) meets one of the taken stretches, which are apart: only the last that starts before b can."""
    i = bisect.bisect_left(taken, (b, -1))
    return i > 0 and taken[i - 1][1] > a


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def join(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, detector: Detector | None = None, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, the number of base spans of each kind, base and all spans as strings, and (on demand) the redacted text.

    Cases: a null text is empty; repeated rows get the same result each; any
    length is taken whole; an empty table gives no row; further columns are
    left out.  Positions count code points, ends are exclusive.
    """
    shared = tuned(docs.sparkSession).sparkContext.broadcast(detector or Detector())

    def run(it) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches(it):
            texts = texts_of(batch)
            found = [known.spans(t) for t in texts]
            cols = [batch.column(0), *(pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS), pa.array([join(b) for b, _ in found]), pa.array([join(a) for _, a in found])]
            if with_text:
                cols.append(pa.array([redact(t, a) for t, (_, a) in zip(texts, found)]))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", *["redacted"] * with_text])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string" + ", redacted string" * with_text)
