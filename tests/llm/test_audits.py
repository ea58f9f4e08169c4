"""Source divergence, periodic runs and toxicity: brute force, odd rows, held-out accuracy.

Equality of ``op11`` and ``op12`` with their SQL is in ``test_text_operators.test_equals_sql``.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandlake.llm import divergence, periodic_runs, queries, toxicity

# -- source divergence --------------------------------------------------------------------------


def plain_audit(rows, least, top=10):
    """The audit by the definitions, on Python's integers."""
    df, count, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        seen[lang].add(source)
        df[lang].update(set(words))
        count[lang, source].update(words)
    out = set()
    for lang, sources in seen.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            out |= {(lang, s, "pair", o.decode(), -x, i) for i, (x, o) in enumerate(pairs, 1)}
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, "term", t.decode(), -x, i) for i, (x, t) in enumerate(terms, 1)}
    return out


def audited(df):
    return {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()}


@pytest.mark.parametrize("slice_bytes", [divergence.SLICE_BYTES, 200])
def test_audit(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(divergence, "ENTRIES", 40)
    rnd = random.Random(3)
    words = ["Ab", "ab", "éa", "Éa", "c", "d-e", "ß", "x1y", "ẞ", "f", " ", "日本", "g g g", "aba", "bab"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randint(0, 12))), rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "é", None])) for _ in range(120)]
    rows += [(None, "en", "none"), ("once only", "xx", "s1"), ("", "xx", "s2"), (rows[0][0], rows[0][1], rows[0][2])]
    found = audited(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), least=3, slice_bytes=slice_bytes))
    assert found == plain_audit(rows, 3)


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert audited(divergence.audit(odd_docs, least=2)) == plain_audit(rows, 2)
    assert divergence.audit(no_docs).columns == ["lang", "source", "part", "item", "value", "rank"]
    assert divergence.audit(no_docs).count() == 0


def test_long_texts_are_walked_in_stretches(monkeypatch):
    text = ("ab cde " * 40 + "x" * 300 + " ab").encode()
    whole = list(divergence.stretches(text))
    monkeypatch.setattr(divergence, "STRETCH", 16)
    parts = list(divergence.stretches(text))
    assert len(whole) == 1 and len(parts) > 10
    assert "".join(p[:-1] for p in parts) + " " == whole[0]
    known = divergence._automaton([(0, "ab"), (1, "cde"), (2, "x" * 300)])
    assert Counter(v for p in parts for _, v in known.iter(p)) == {0: 41, 1: 40, 2: 1}


def test_shares_of_huge_counts(spark):
    big = 9 * 10**17
    rows = spark.createDataFrame([(big, 3 * big, 10**6)], "n long, total long, v long")
    assert rows.select(divergence._p("n")).first()[0] == 1 + 10**9 * (big + 2) // (3 * big + 2 * 10**6)


# -- periodic runs ------------------------------------------------------------------------------


def plain_runs(w, least=6, exponent=4):
    def period(x):
        return next(p for p in range(1, len(x) + 1) if all(x[i] == x[i + p] for i in range(len(x) - p)))

    out, n = set(), len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q) and period(w[i : i + size]) == q:
                out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rnd, most=60):
    w = [rnd.choice([b"a", b"b", b"c"][: rnd.randint(1, 3)]) for _ in range(rnd.randint(0, most))]
    if w and rnd.random() < 0.6:
        a = rnd.randrange(len(w))
        p = rnd.randint(1, max(1, (len(w) - a) // 4))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    return w


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (10, 3)])
def test_scan(least, exponent):
    rnd = random.Random(least)
    for _ in range(60):
        docs = [random_words(rnd) for _ in range(rnd.randint(1, 6))]
        want = [plain_runs(w, least, exponent) for w in docs]
        assert periodic_runs.scan(docs, least, exponent) == want
        for w, runs in zip(docs, want):
            k = rnd.randint(1, 5)
            dealt = [r for i in range(k) for r in periodic_runs.scan([w], least, exponent, (i, k))[0]]
            assert periodic_runs.least_periods(dealt) == runs


def plain_result(text, doc_id=None, tail=None):
    words = (text or "").encode().split()
    if tail and words and (t := tail(doc_id, len(words))):
        a, p = t
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


@pytest.mark.parametrize("large", [periodic_runs.LARGE, 0])
def test_periodic_runs(spark, odd_docs, no_docs, large):
    rnd = random.Random(5)
    texts = [b" ".join(random_words(rnd, 80)).decode() for _ in range(40)] + ["x\ty\x0bx y\nx y x y", "no no no no no no", "é é é é é é é"]
    docs = spark.createDataFrame([(i % 30, t, "z") for i, t in enumerate(texts)] + [(3, texts[3], "z")], "doc_id long, text string, runs string")
    for some in (docs, odd_docs.filter("text is null or length(text) < 1000")):
        rows = some.collect()
        found = periodic_runs.periodic_runs(some, large=large, unit=8).collect()
        have = Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in found)
        plain = [(r.doc_id, plain_result(r.text)) for r in rows]
        assert have == Counter((i, n, tuple(runs), left) for i, (n, runs, left) in plain)
        for r in found:
            runs = [(x.start, x.length, x.period) for x in r.runs]
            assert (r.strongest and tuple(r.strongest)) == (max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if runs else None)
    assert periodic_runs.periodic_runs(no_docs, large=large).count() == 0


def test_very_long_runs(spark):
    """A long text whose lags are dealt to several tasks, and one that is a single run."""
    text = " ".join(["ab"] * 20_000 + [f"w{i}" for i in range(3000)] + ["x", "y", "z"] * 5000)
    docs = spark.createDataFrame([(1, text), (2, text), (3, "ab " * 60_000)], "doc_id long, text string")
    found = {r.doc_id: r for r in periodic_runs.periodic_runs(docs, unit=1 << 22).collect()}
    for i in (1, 2):
        assert [tuple(r) for r in found[i].runs] == [(0, 20_000, 1), (23_000, 15_000, 3)]
        assert tuple(found[i].strongest) == (0, 20_000, 1) and len(found[i].collapsed.split()) == 3004
    assert [tuple(r) for r in found[3].runs] == [(0, 60_000, 1)] and found[3].collapsed == "ab"


def test_registered_runs(spark, sf_dir, docs):
    found = queries.op12_periodic_runs(spark, sf_dir)
    assert dict(found.dtypes) == {c: "bigint" for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")} | {"runs_sha256": "string", "collapsed_sha256": "string"}
    texts = {r.doc_id: r.text for r in docs.filter("length(text) < 3000").collect()}
    seen = 0
    for r in found.collect():
        if r.doc_id in texts:
            _, runs, left = plain_result(texts[r.doc_id], r.doc_id, queries.planted_tail)
            assert r.n_runs == len(runs)
            assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
            assert r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
            seen += len(runs)
    assert seen > 10


# -- toxicity -----------------------------------------------------------------------------------


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_corrected_risk_has_its_gradient():
    rnd = np.random.default_rng(0)
    f, toxic = rnd.normal(size=50), np.arange(50) < 15

    def risk(f, back):
        clean = np.logaddexp(0, f[~toxic]).mean() - 0.2 * np.logaddexp(0, f[toxic]).mean()
        return 0.2 * np.logaddexp(0, -f[toxic]).mean() + clean if clean >= 0 else -back * clean

    for shift in (0.0, -8.0):  # with clean texts far on their side the difference is negative
        g = f + np.where(toxic, 6.0 if shift else 0.0, shift)
        numeric = [(risk(g + e, 1.0) - risk(g - e, 1.0)) / 2e-6 for e in np.eye(50) * 1e-6]
        assert np.allclose(toxicity._slope(g, toxic, 0.2, 1.0), numeric, atol=1e-6)


def test_learns_from_toxic_and_unlabelled_alone():
    rnd = np.random.default_rng(1)
    bad = np.array([7, 19, 33])

    def text(toxic):
        w = set(rnd.integers(100, 900, 30).tolist()) | ({int(rnd.choice(bad))} if toxic else set())
        return np.array(sorted(w), np.int32)

    toxic, other = [text(True) for _ in range(300)], [text(rnd.random() < 0.15) for _ in range(2000)]
    y = np.arange(2300) < 300
    model = toxicity.Classifier(0.15).fit(toxic + other, y, np.arange(2300) % 3 == 0)
    score = lambda t: float(toxicity._sigmoid(np.array(model.value(t))))
    assert np.mean([score(text(True)) > 0.5 for _ in range(200)]) > 0.9 and max(score(text(False)) for _ in range(200)) < 0.5
    assert set(model.places[np.argsort(-model.weights)[:3]].tolist()) == set(bad.tolist())


def toxic_tables(spark, n=1500, seed=2):
    """Documents of made-up words, one in ten with an insult, and labels of half of them."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeo") for _ in range(rnd.randint(2, 5)))
    docs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.15
        words = [word() for _ in range(rnd.randint(5, 60))]
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["Idiot,", "SCUM", "worthless!"]))
        docs.append((i, " ".join(words), "en", "s"))
        if rnd.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    return docs, labels, "doc_id long, text string, lang string, source string", "doc_id long, quality int, toxic int"


def test_held_out_toxicity(spark):
    docs, labels, d, l = toxic_tables(spark)
    table, marks = spark.createDataFrame(docs, d), spark.createDataFrame(labels, l)
    found = {r.doc_id: r for r in toxicity.score(table, toxicity.learn(table, marks)).collect()}
    told = [(found[i], t) for i, _, t in labels if held(i)]
    assert all(r.held_out for r, _ in told) and sum(r.held_out for r in found.values()) == sum(map(held, range(len(docs))))
    assert sum(r.predicted == t for r, t in told) / len(told) > 0.97
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())
    # labels of held-out rows, languages and sources change nothing
    other = spark.createDataFrame([(i, q, 1 - t if held(i) else t) for i, q, t in labels], l)
    renamed = spark.createDataFrame([(i, t, "xx", str(i)) for i, t, _, _ in docs], d)
    again = {r.doc_id: r.score for r in toxicity.score(renamed, toxicity.learn(renamed, other)).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    docs, labels, d, l = toxic_tables(spark, 600)
    marks = spark.createDataFrame([*labels, *labels[:50], (None, 1, 1), (7, None, None), (10**9, 0, 1)], l)
    model = toxicity.learn(spark.createDataFrame(docs, d), marks, bags=1)
    rows = toxicity.score(odd_docs.withColumn("toxic", odd_docs.n), model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1 and not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.score(no_docs, model).count() == 0
    none = marks.limit(0)
    assert {r.score for r in toxicity.score(odd_docs, toxicity.learn(odd_docs, none)).collect()} == {0.0}
    assert toxicity.learn(no_docs, marks).bags == [] and toxicity.learn(odd_docs, marks.filter("toxic = 0")).bags == []
    toxicity.score(odd_docs, toxicity.learn(odd_docs, marks)).collect()  # few texts, of one id several, hardly a toxic one


def test_registered_toxicity(spark, sf_dir, docs):
    found = queries.op13_toxicity(spark, sf_dir)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert found.count() == docs.count()
