"""PII, language, SimHash, decontamination and top-k against brute force, and on odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from strandlake.llm import components, decontamination, language, lines, pii, queries, simhash, suffixes, vector_file
from tests.conftest import same_rows

from .conftest import ODD


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, duck, sf_dir, name):
    same_rows(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLE_SQL[name])


# -- personal data -----------------------------------------------------------------------------


def plain(t: str) -> list[pii.Span]:
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        d = [int(c) for c in s[::-1]]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]


@pytest.fixture(scope="module")
def detector(docs):
    return pii.Detector(corpus=pii.labelled(docs))


def test_base_spans(docs):
    rnd = random.Random(3)
    texts = [r.text for r in docs.select("text").collect()] + ["".join(rnd.choice("a1.@+- (5b\n") for _ in range(rnd.randint(0, 60))) for _ in range(20_000)]
    texts += ["a@b.c@d.e x@y.z.", "4111 1111 1111 1111", "4111 1111 1111 1112", "+1 (743) 555-3824", "1.2.3.4.5", "256.1.1.1 001.2.3.4", "é@x.com café.b@x.co"]
    for t in texts:
        assert pii.base_spans(t) == plain(t)


def test_added_spans(detector):
    for text, kind in (("call me: 743-555-3824 ok", "phone"), ("mail john.doe (at) example (dot) com", "email"), ("card: 4111/1111/1111/1111 .", "card")):
        base, every = detector.spans(text)
        assert base == [] and [s[0] for s in every] == [kind]


def test_clean_text_stays(detector):
    for text in ("The year 1999-2004 saw 12.5 percent. Version 1.2.3 of 10 January.", "look at that. Then rest", "isbn 978-3-16-148410-0", "on page 12 - 14, order 4821 9931"):
        assert detector.spans(text) == ([], [])


# Spans labelled by hand, none made by the templates that the trees learn from.
BY_HAND = [
    ("email", "write to Ana.Lopez [at] uni-bonn [dot] de before May", "Ana.Lopez [at] uni-bonn [dot] de"),
    ("email", "my mail: k.meier (at) posteo (dot) net, thanks", "k.meier (at) posteo (dot) net"),
    ("email", "reach me at sue at wonderland dot org please", "sue at wonderland dot org"),
    ("email", "contact joe @ example.com today", "joe @ example.com"),
    ("email", "kontakt: info[at]firma.de oder Post", "info[at]firma.de"),
    ("ip", "the server 192[.]168[.]4[.]77 was seen", "192[.]168[.]4[.]77"),
    ("ip", "ping 10(.)0(.)12(.)254 first", "10(.)0(.)12(.)254"),
    ("ip", "host 172 . 16 . 4 . 9 answered", "172 . 16 . 4 . 9"),
    ("card", "paid by visa 4539/1488/0343/6467 on Monday", "4539/1488/0343/6467"),
    ("card", "card number 5555.5555.5555.4444 expires soon", "5555.5555.5555.4444"),
    ("card", "amex 3782 822463 10005 was charged", "3782 822463 10005"),
    ("card", "credit card 6011_1111_1111_1117 ok", "6011_1111_1111_1117"),
    ("phone", "call me on 0171 555 0199 tonight", "0171 555 0199"),
    ("phone", "phone: (212) 555-0142, ask for Bob", "(212) 555-0142"),
    ("phone", "tel 00 44 20 7946 0958 in London", "00 44 20 7946 0958"),
    ("phone", "mobile 06 12 34 56 78 merci", "06 12 34 56 78"),
    ("phone", "fax 030/901820/555 for forms", "030/901820/555"),
    ("secret", 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" in the log', "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"),
    ("secret", "api_key: AKq7Zr02LmP9xTt4VbN8 and more", "AKq7Zr02LmP9xTt4VbN8"),
    ("secret", "password is hX7k2Lq9Zp0Rt5Wv ok", "hX7k2Lq9Zp0Rt5Wv"),
]
NOTHING = [
    "On 2021-10-12 14 people met, 12.5.1998 was earlier.", "chapter 12 - 14, page 204 205", "order 4821 9931 of 3 items", "version 1.2.3 or 10.4.12", "isbn 978-3-16-148410-0 in print", "the key is underneath the mat",
    "he arrived at noon dot", "total 1 234 567 sold in 2019", "look at page 4. Then rest", "the password is required everywhere", "serial 9807915762804490 stamped", "section 3.2.1.4 of the report",
]


def test_recall_by_hand(detector):
    """Recall of each kind on spans that no template made, and clean text left alone."""
    caught, of = Counter(), Counter()
    for kind, text, span in BY_HAND:
        a = text.index(span)
        of[kind] += 1
        caught[kind] += any(s[1] < a + len(span) and a < s[2] for s in detector.spans(text)[1])
    print({k: f"{caught[k]}/{of[k]}" for k in of})
    assert sum(caught.values()) >= 0.9 * len(BY_HAND) and all(caught[k] >= 0.6 * of[k] for k in of)
    assert sum(bool(detector.spans(t)[1]) for t in NOTHING) <= 1


def test_held_out_examples(detector):
    held = pii.examples(1500, 99)
    p = detector.trees.probability(np.array([pii.features(t, s) for t, s, _ in held]))
    chosen = np.array([p[i] >= detector.thresholds[s[0]] for i, (_, s, _) in enumerate(held)])
    good = np.array([g for *_, g in held])
    assert good[chosen].mean() > 0.97 and chosen[good].mean() > 0.8


def test_stretches_that_cover_many_spans():
    spans = [("email", 0, 200), *(("ip", 10 * i, 10 * i + 8) for i in range(1, 15))]
    taken = pii._united(spans)
    assert taken == [(0, 200)] and pii._meets(taken, 190, 195) and pii._meets(taken, 199, 300) and not pii._meets(taken, 200, 210)


def test_labels_from_the_corpus(docs, no_docs):
    rows = pii.labelled(docs)
    assert {k for _, (k, _, _), g in rows if g} >= {"email", "ip", "card"} and pii.labelled(no_docs) == []
    assert all(t[a:b] for t, (_, a, b), _ in rows)


def test_detect_rows(odd_docs, no_docs, detector):
    rows = pii.detect(odd_docs, detector, with_text=True).collect()
    assert len(rows) == odd_docs.count() and rows[0].spans == "" and rows[0].redacted == ""
    assert pii.detect(no_docs, detector).collect() == []
    assert pii.redact("a x@y.zz b", [("email", 2, 8)]) == "a <email> b"


# -- language ------------------------------------------------------------------------------------


def test_held_out_accuracy(docs):
    labels = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.identify(docs, language.learn(docs)).collect() if r.held_out]
    assert np.mean([labels[r.doc_id] == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def plain_ppm(samples: list[str], text: str, order: int) -> float:
    """Bits of a text under a byte context tree with escapes and exclusion, symbol by symbol."""
    seen: dict[bytes, Counter] = defaultdict(Counter)
    for t in samples:
        data = b" " * order + t.encode().lower()
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[data[i - k : i]][data[i]] += 1

    def p(context: bytes, symbol: int, top: bool = True) -> float:
        """Probability by the tree from this context down."""
        c = seen.get(context)
        lower = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / 256)
        if not c:
            return lower(symbol)
        n, d = sum(c.values()), len(c)
        if symbol in c:
            return c[symbol] / (n + d)
        return d / (n + d) * lower(symbol) / (1 - sum(lower(x) for x in c))

    data, bits = b" " * order + text.encode().lower(), 0.0
    for i in range(order, len(data)):
        bits -= math.log2(p(data[i - order : i], data[i]))
    return bits


@pytest.mark.parametrize("order", [1, 2, 3])
def test_code_lengths_equal_plain_ppm(order):
    rnd = random.Random(order)
    words = ["the", "café", "слово", "日本", "ing", "!?", "\n", "Él", "\U0001f600"]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    samples = {"x": [some(40) for _ in range(4)], "y": [some(25), "", "abab" * 9], "z": ["q"]}
    m = language.Model(samples, order=order)
    for text in (some(30), "nothing seen zzz ÿ", "a", "слово café " * 3):
        want = [plain_ppm(samples[k], text, order) for k in m.languages]
        assert np.allclose(m.code_lengths(text) / language.UNIT, want, atol=1e-3 * len(text.encode()), rtol=1e-5)
        assert (m.code_lengths(text) == m.code_lengths(text)).all()
    texts = [some(3) for _ in range(20)] + [None, "", "12", "abab"]
    assert m.predict_all(texts) == [m.predict(t) for t in texts]


def test_cache_conflicts_and_many_languages(monkeypatch):
    """Neither a tiny cache nor the number of languages changes a code length."""
    samples = {f"l{i:02}": [f"text number {i} of some {'abcdefgh'[i % 8] * 5} words"] for i in range(20)}
    text = "some text of words with number and bbbbb " * 5
    want = language.Model(samples).code_lengths(text)
    monkeypatch.setattr(language, "SLOT_BITS", 3)
    monkeypatch.setattr(language, "CHUNK", 7)
    m = language.Model(samples)
    assert m.order == 3 and (m.code_lengths(text) == want).all()
    assert m.predict_all([text, "x"]) == [m.predict(text), m.predict("x")]


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    rows = language.identify(odd_docs, language.learn(odd_docs)).collect()
    by = {(r.doc_id, r.lang_pred == "und") for r in rows}
    assert {(0, True), (1, True), (2, True), (12, True), (13, True), (7, False)} <= by and len(rows) == len(ODD) + 3
    nothing = language.learn(no_docs)
    assert language.identify(no_docs, nothing).collect() == [] and {r.lang_pred for r in language.identify(odd_docs, nothing).collect()} == {"und"}
    judged = language.judged(odd_docs, nothing)
    assert judged.columns[:-2] == odd_docs.columns and judged.count() == odd_docs.count()


# -- near duplicates --------------------------------------------------------------------------------


def print_of(t: str) -> int:
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t)
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    ones = [sum(xxhash.xxh64_intdigest(x.encode(), 42) >> i & 1 for x in s) for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(s))


def classes(fps: list[int], ids: list) -> list:
    f = np.array(fps, np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 3
    label = np.arange(len(f))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(f))])
        if (new == label).all():
            break
        label = new
    return [min((ids[j] for j in range(len(f)) if label[j] == label[i] and ids[j] is not None), default=None) for i in range(len(f))]


def test_simhash(docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        src = df.collect()
        fps = [print_of(r.text or "") for r in src]
        want = sorted(map(str, zip([r.doc_id for r in src], [f"{f:016x}" for f in fps], classes(fps, [r.doc_id for r in src]))))
        assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in simhash.near_duplicates(df).collect()) == want
    assert simhash.near_duplicates(no_docs).collect() == []


def test_links_of_random_prints(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(30)]
    fps = base + [b ^ sum(1 << i for i in rnd.sample(range(64), k)) for b in base for k in (1, 2, 3, 4)]
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in fps})
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_first_of_groups(spark, odd_docs, no_docs):
    left = simhash.first_of_groups(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert 0 in ids and 1 not in ids and None in ids and ids.count(8) == 2  # two texts of one id, neither a copy
    assert simhash.first_of_groups(no_docs).collect() == []
    rows = [(None, "alpha beta gamma delta", "a"), (None, "something else altogether here", "b"), (None, "alpha beta gamma delta", "c"), (7, "words that nobody repeats at all", "d"), (7, "alpha beta gamma delta", "e")]
    left = simhash.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string, _gone string"))
    got = {(r.doc_id, r.text) for r in left.collect()}
    assert left.columns == ["doc_id", "text", "_gone"] and left.count() == 3
    assert got == {(None, rows[1][1]), (7, rows[3][1]), (7, rows[4][1])}


def test_crowded_bucket(spark):
    """Many fingerprints that share a segment: the links within the radius, and no others."""
    rnd = random.Random(9)
    low = 0x12345678
    fps = sorted({(rnd.getrandbits(5) << 40 | rnd.getrandbits(4) << 50) ^ low for _ in range(300)})
    want = {(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 3}
    got = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


# -- decontamination ---------------------------------------------------------------------------------


def test_decontamination(spark, odd_docs, no_docs):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item), (2, "Word"), (10, "no such thing"), (None, "two words"), (5, None), (6, "...")], "item_id long, text string")
    extra = spark.createDataFrame([(50, "x " + item.upper() + " y"), (51, "One, two! three-four five six seven eight nine TEN"), (52, "two three four five six seven eight nine ten twelve")], "doc_id long, text string")
    rows = {r.doc_id: r for r in decontamination.contamination(extra, bench).collect()}
    assert (rows[50].n_hit, rows[50]["items"], rows[50].n_words) == (11, ["1"], 13)
    assert (rows[51].n_hit, rows[51].contaminated) == (10, True) and not rows[52].contaminated
    odd = decontamination.contamination(odd_docs, bench).collect()
    assert len(odd) == odd_docs.count()
    assert [(r.n_hit, r["items"]) for r in odd if r.doc_id == 6] == [(1, ["2"])] and [(r.n_hit, r["items"]) for r in odd if r.doc_id == 7] == [(2, [])]
    left = decontamination.decontaminate(odd_docs, bench)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 2
    clash = odd_docs.withColumnsRenamed({"seq": "_text_hash", "n": "text_hash"})
    assert decontamination.decontaminate(clash, bench).columns == clash.columns and decontamination.decontaminate(clash, bench).count() == odd_docs.count() - 2
    assert decontamination.contamination(no_docs, bench).collect() == []
    assert not any(r.contaminated for r in decontamination.contamination(odd_docs, bench.limit(0)).collect())


def test_windows_beyond_a_broadcast(spark, docs, sf_dir, monkeypatch):
    """The exchange of hashes gives what the broadcast gives, and carries no words with the positions."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = lambda df: sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect())
    want = row(decontamination.contamination(docs, bench))
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", -1)
    assert row(decontamination.contamination(docs, bench)) == want and any(x[2] for x in want)


# -- top-k ---------------------------------------------------------------------------------------------


def test_top_k_random(spark):
    rnd = np.random.default_rng(3)
    v = rnd.normal(size=(300, 8)).round(1)
    v[50:60] = v[40]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(20, v[20].tolist()), (None, [1.0] * 8), (400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (420, [1.0, 2.0]), (421, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = [(i, np.floor(64 * np.array(x)).astype(int)) for i, x in rows[:301]]
    want = []
    for at, (i, q) in enumerate(ok):
        if i % 20 == 0:
            best = sorted((-int(q @ x), j) for k, (j, x) in enumerate(ok) if k != at)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = [tuple(r) for r in vector_file.top_k(vector_file.build(df), k=5).collect()]
    assert sorted(got) == sorted(want)
    assert vector_file.top_k(vector_file.build(df.limit(0)), k=5).collect() == []


def test_scan_reads_little():
    """Scores that fall off fast are settled by the approximation for most vectors; its bounds hold."""
    rnd = np.random.default_rng(5)
    exact = np.floor(64 * rnd.normal(size=(1000, 16))).astype(np.int64)
    cells, low, high = vector_file.quantise(exact)
    block = {"n": 1000, "dim": 16, "cells": cells.tobytes(), "low": low.tobytes(), "high": high.tobytes(), "uids": np.arange(1000).tobytes()}
    best, lows = vector_file._Best(2, 5), np.full((2, 5), -np.inf)
    (found,) = vector_file.bounded(exact[:2], np.array([0, 1]), block, lows)
    assert (found["upper"] >= (exact[found["at"]] * exact[found["q"]]).sum(axis=1)).all()
    kth = np.sort(exact[2:] @ exact[0])[-5]
    assert lows[0].min() <= kth and len(found) < 600
    read = vector_file.refined(exact[:2], found, np.arange(1000), exact, best)
    assert read < 1000 and sorted(-(exact[1:] @ exact[0]))[:5] == (-best.score[0]).tolist()


@pytest.mark.parametrize("chunk", [8 << 20, 200])
def test_top_k_of_huge_components(spark, monkeypatch, chunk):
    """Components whose scores a long may not hold take no part; large ones that fit are exact."""
    monkeypatch.setattr(vector_file, "CHUNK_BYTES", chunk)
    rows = [(0, [1e18, 1.0]), (20, [1e7, -1e7]), (40, [1e7, 1.0]), (1, [1.0, 2.0]), (2, [-1e7, 3.0]), (60, [0.5, 0.25])]
    got = sorted(map(tuple, vector_file.top_k(vector_file.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), k=2).collect()))
    v = {i: [math.floor(64 * x) for x in e] for i, e in rows if i}
    want = []
    for q in (20, 40, 60):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[j])), j) for j in v if j != q)[:2]
        want += [(q, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want)


# -- very long texts -----------------------------------------------------------------------------------


def test_very_long_texts(spark, detector):
    """A text of over a megabyte, a word of a megabyte, and short ones beside them: whole texts count everywhere."""
    rnd = random.Random(8)
    prose = " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(200_000))
    item = "the tenth window of this benchmark item stands at the far end"
    long = prose + "\n" + item + "\nmail me@far.example.org or 10.20.30.40"
    rows = [(1, long, "en"), (2, "x" * 1_000_000, "en"), (3, item, "fr"), (4, long, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in pii.detect(df, detector).collect()}
    assert (found[1].n_email, found[1].n_ip, found[2].n_email) == (1, 1, 0) and found[1].base.startswith(f"email:{long.index('me@far')}:")
    prints = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    assert prints[1].fingerprint == f"{print_of(long):016x}" and prints[4].component_id == 1
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    hit = {r.doc_id: (r.n_words, r.n_hit) for r in decontamination.contamination(df, bench).collect()}
    assert hit[1] == (len(re.findall("[A-Za-z0-9]+", long)), 12) and hit[2] == (1, 0) and hit[3] == (12, 12)
    model = language.Model({"en": [prose[:30_000]], "fr": ["le la les des une " * 50]})
    assert {r.doc_id: r.lang_pred for r in language.identify(df, model).collect()}[1] == "en"
    assert model.code_lengths(long).tolist() == pytest.approx([plain_units(model, long, k) for k in range(2)])
    left = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert (left[1].n_removed, left[3].n_removed, left[4].n_removed) == (0, 1, 3) and left[4].text == ""
    cut = {r.doc_id: r for r in suffixes.remove_repeats(df).collect()}
    assert cut[1].n_removed == len(long) and cut[2].n_removed == 1_000_000 and cut[3].n_removed == 0


def plain_units(model: language.Model, text: str, k: int) -> float:
    """Units of the text in one language, without the cache."""
    grams = language._grams(text.encode().lower(), model.order)
    return float(np.rint(model.trees[k].bits(grams) * language.UNIT).sum())
