"""Repeated strings and lines, and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strandlake.llm import lines, suffixes

from .conftest import ODD


# -- repeated byte strings --------------------------------------------------------------------------


def brute(texts: list[str]) -> list[bytes]:
    data = [t.encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        out.append(bytes(mark))
    return out


def fixture_texts() -> list:
    rnd = random.Random(2)
    words = ["the", "la", "onand", "é", " x", "ing", "zz"]
    some = lambda n: "".join(rnd.choice(words) + " " for _ in range(n))
    passages = [some(rnd.randint(40, 140)) for _ in range(8)]
    texts = [*ODD, *(some(200) for _ in range(5))]
    for _ in range(70):
        t = some(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 2)
            t += (p[a : rnd.randint(a, len(p))] if rnd.random() < 0.6 else p) + some(rnd.randint(0, 30))
        if rnd.random() < 0.2:
            k = rnd.randrange(max(1, len(t)))
            t = t[:k] + "!" + t[k + 1 :]
        texts.append(t)
    texts += ["a" * 700, "ab" * 400, "x" * 199, "y" * 200, "y" * 200, *(some(30) + passages[0] + some(30) for _ in range(25))]
    return texts + texts[20:24]


def held_against(df, texts, ids):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect())
    whole = [t or "" for t in texts]
    want = Counter()
    for i, t, m in zip(ids, whole, brute(whole)):
        b = t.encode()
        want[i, len(b), sum(m), len([s for s in m.split(b"\0") if s]), hashlib.sha256(bytes(c for c, x in zip(b, m) if not x)).hexdigest()] += 1
    assert got == want


@pytest.mark.parametrize("hot", [50_000, 3])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "PART_BYTES", 1000)
    texts = fixture_texts()
    ids = [None if i == 3 else 7 if i in (40, 41) else i for i in range(len(texts))]
    held_against(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), texts, ids)


def test_repeats_of_documents(docs, no_docs):
    rows = docs.collect()
    held_against(docs, [r.text for r in rows], [r.doc_id for r in rows])
    assert suffixes.remove_repeats(no_docs).collect() == []


def test_loser_tree():
    rnd = random.Random(2)
    for _ in range(200):
        runs, every = [], []
        for _ in range(rnd.randint(0, 7)):
            e = sorted([(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))), b"", (None if rnd.random() < 0.2 else 3, 4, 5, 1)) for _ in range(rnd.randint(0, 12))], key=lambda x: x[0])
            every += [x[0] for x in e]
            runs.append(suffixes.Run(suffixes.encode_run(e)))
        got = list(suffixes.merged(runs))
        assert [g[1][0] for g in got] == sorted(every)
        for i, (shared, entry) in enumerate(got):
            assert shared == (suffixes.shared_prefix(got[i - 1][1][0], entry[0]) if i else 0)


def test_group_rules_agree():
    """Small groups go pair by pair, larger ones by classes: same answer."""
    rnd = random.Random(7)
    for _ in range(30):
        core = bytes(rnd.choice(b"ab") for _ in range(64))
        side = lambda n: bytes(rnd.choice(b"a" * 30 + b"b") for _ in range(n))
        group = sorted((core + side(rnd.choice([0, 60, 136])), side(rnd.choice([0, 70, 136]))) for _ in range(12))
        s, left = [g[0] for g in group], [g[1] for g in group]
        right = [0, *(suffixes.shared_prefix(a, b) for a, b in zip(s, s[1:]))]
        far = (b"\xff" * 64, b"")  # a thirteenth member that matches none
        assert suffixes.repeats([*s, far[0]], [*right, 0], [*left, far[1]])[:12] == suffixes.repeats(s, right, left)


# -- repeated lines --------------------------------------------------------------------------------------


def kept_lines(rows: list) -> Counter:
    rows = sorted({(r.doc_id, r.text) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    sets = [(d, i, frozenset(x.encode().lower().split())) for d, t in rows for i, x in enumerate((t or "").split("\n"))]
    gone = set()
    for k, (d, i, s) in enumerate(sets):
        if s and any(5 * len(s & o) >= 4 * len(s | o) for _, _, o in sets[:k] if o):
            gone.add((d, i))
    return gone


@pytest.mark.parametrize("long, heads, hot, broadcast, short, words", [(32, 16, 4096, 1 << 20, 32, 1 << 22), (2, 1, 2, 1 << 20, 2, 1 << 22), (2, 1, 4096, 3, 2, 3), (64, 4, 4096, 1 << 20, 2, 3)])
def test_lines(spark, monkeypatch, long, heads, hot, broadcast, short, words):
    for k, v in (("LONG", long), ("HEADS", heads), ("HOT_PIVOT", hot), ("BROADCAST_BYTES", broadcast), ("SHORT", short), ("NEAREST", 1 if short == 2 else 3), ("HOT_WORDS", words), ("CHUNK", 3 if short == 2 else 1 << 14), ("WANTED", 2 if short == 2 else 1024)):
        monkeypatch.setattr(lines, k, v)
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 14))] for _ in range(25)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(rnd.randint(0, 5)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                line[rnd.randrange(len(line))] = rnd.choice(words)
            text.append(" ".join(line))
        rows.append((None if d == 9 else d, "\n".join(text) if d != 5 else None, "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, n int".replace("n int", "source string"))
    src = df.collect()
    gone = kept_lines(src)
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    for r in src:
        want = None if r.text is None else "\n".join(x for i, x in enumerate(r.text.split("\n")) if (r.doc_id, i) not in gone)
        assert got[r.doc_id].text == want and got[r.doc_id].n_removed == sum(d == r.doc_id for d, _ in gone)


def test_lines_of_odd_rows(odd_docs, no_docs):
    left = lines.dedup_lines(odd_docs)
    assert left.columns == [*odd_docs.columns, "n_lines", "n_removed"] and left.count() == odd_docs.count()
    assert {r.doc_id: r.text for r in left.collect()}[14] == ODD[14]
    assert lines.dedup_lines(no_docs).collect() == []


def test_lines_of_documents_that_share_an_id(spark):
    """Texts of one id, or of none, are documents of their own; columns of the counts' names stay."""
    rows = [(None, "aa bb cc dd\nee ff gg hh", 777, 5, "g"), (None, "ii jj kk ll\naa bb cc dd", 778, 6, "h"), (4, "one two three four\nee ff gg hh", 1, 1, None), (4, "five six seven eight\none two three four", 2, 2, None), (4, "five six seven eight\none two three four", 3, 2, None)]
    left = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_removed int, _gone string"))
    assert left.columns == ["doc_id", "text", "n_lines", "n_removed", "_gone", "n_lines_", "n_removed_"]
    got = {(r.doc_id, r.n_lines): r for r in left.collect()}
    assert len(got) == 5 and got[None, 777].n_removed == 5 and got[None, 777]._gone == "g"
    both = sorted([got[None, 777].text, got[None, 778].text])  # the order among them is that of their hashes
    assert both in (["aa bb cc dd\nee ff gg hh", "ii jj kk ll"], ["ee ff gg hh", "ii jj kk ll\naa bb cc dd"])
    assert got[4, 2].text == got[4, 3].text and (got[4, 2].n_removed_, got[4, 3].n_removed_) in ((0, 0), (1, 1))
    texts = "\n".join(r.text for k, r in got.items() if k[1] != 3).split("\n")
    assert sorted(x for x in texts if x) == sorted(["aa bb cc dd", "ee ff gg hh", "ii jj kk ll", "one two three four", "five six seven eight"])


def test_run_filters_lose_nothing(monkeypatch):
    """Whatever the shape of a run, each pair over the threshold passes the filters."""
    rnd = random.Random(4)
    rank = np.arange(65536, dtype=np.uint64)
    texts = [" ".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 12))) for _ in range(150)]
    sets = [frozenset(t.split()) for t in texts]
    _, e = lines.entries(["\n".join(texts)], [1], [0], rank)
    monkeypatch.setattr(lines, "SHORT", 1 << 20)
    found = set()
    for token in np.unique(e["token"]):
        run = e[e["token"] == token]
        run = run[np.argsort(run["line"])]
        for late, early, _, _ in lines.run_pairs({f: run[f] for f in run.dtype.names}) if len(run) > 1 else ():
            found |= set(zip(run["line"][late].tolist(), run["line"][early].tolist()))
    first = {s: i for i, s in reversed(list(enumerate(sets)))}
    for i, s in enumerate(sets):
        for j in range(i):
            o = sets[j]
            if s != o and first[s] == i and first[o] == j and 5 * len(s & o) >= 4 * len(s | o):
                assert (i, j) in found


# -- the pipeline -------------------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as cp
    from strandlake.llm.common import kept, table

    docs = table(spark, sf_dir, "documents")
    names, before = [n for n, _ in cp.STAGES], None
    assert names == ["language_id", "line_dedup", "near_dedup", "decontaminate", "pack"]
    for name, stage in cp.STAGES:
        out = kept(stage(spark, docs, sf_dir), name)
        if name != "pack":
            assert out.columns == docs.columns and {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
            docs = out
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()}
    key = lambda rows: sorted((r.doc_id, r.start, r.length, bytes(r.ids)) for r in rows)
    assert sum(len(k[3]) for k in key(cp.run(spark, sf_dir).collect())) == sum(len(k[3]) for k in key(out.collect()))


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    """Each stage's rows on nulls, shared ids, repeated rows, an empty table, and columns that clash with its own."""
    import corpus_pipeline as cp

    spark.createDataFrame([(1, "a benchmark item of no great length")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["doc_id", "text", "lang", "source", "lang_pred", "n_lines", "n_removed", "_gone", "text_hash"]
    prose = "the river ran past the old mill and the children watched it from the bridge"
    rows = [
        (1, prose + "\nfirst line of its own here", "en", "s", "x", 1, 2, 3, 4), (None, prose + "\nanother line that stands alone", "en", "s", "x", 5, 6, 7, 8), (None, "the mill was sold in spring and nobody came to see it go", "en", "s", "y", 1, 1, 1, 1),
        (4, "we found a benchmark item of no great length in this text", "en", "s", None, None, None, None, None), (5, None, None, None, None, None, None, None, None), (6, "", "en", "s", "z", 0, 0, 0, 0), (7, prose, "en", "s", "r", 1, 1, 1, 1), (7, prose, "en", "s", "r", 1, 1, 1, 1),
        (8, "children watched the old river run past the mill until the bridge was gone and rebuilt", "en", "t", "r", 1, 1, 1, 1),
    ]
    kinds = "doc_id long, text string, lang string, source string, lang_pred string, n_lines int, n_removed int, _gone int, text_hash int"
    docs = spark.createDataFrame(rows, kinds)
    stages = dict(cp.STAGES)
    of = lambda df: Counter((r.doc_id, r.text, r._gone) for r in df.collect())
    run = {n: stages[n](spark, docs, str(tmp_path)) for n in stages}
    assert all(run[n].columns == names for n in stages if n != "pack")
    every = of(docs)
    letters = Counter({k: n for k, n in every.items() if k[1]})
    assert of(run["language_id"]) == letters  # without a letter a document goes
    lines = of(run["line_dedup"])
    assert lines[None, rows[2][1], 1] == 1 and lines[5, None, None] == 1 and lines[6, "", 0] == 1
    assert lines[1, "first line of its own here", 3] + lines[1, rows[0][1], 3] == 1 and not any(k[0] == 7 for k in lines)  # all of 7's lines repeat
    assert sum((k[1] or "").count(prose) for k in lines.elements()) == 1
    near = of(run["near_dedup"])
    assert near[7, prose, 1] == 1 and near[5, None, None] + near[6, "", 0] == 1 and near[None, rows[1][1], 7] == near[None, rows[2][1], 1] == 1
    assert of(run["decontaminate"]) == Counter({k: n for k, n in every.items() if k[0] != 4})
    assert Counter(r.doc_id for r in run["pack"].collect() if r.start == 0) == Counter(r[0] for r in rows)
    for name, stage in cp.STAGES:
        out = stage(spark, no_docs, str(tmp_path))
        assert out.collect() == [] and (name == "pack" or out.columns == no_docs.columns)
        assert stage(spark, odd_docs, str(tmp_path)).count() > 0
