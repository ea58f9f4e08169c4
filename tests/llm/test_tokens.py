"""Encoder, token store, packing and edit-aware counts against the tokenizers library itself."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from .conftest import ODD

from strandlake.llm import packing, token_counts, token_store
from strandlake.llm.pieces import PieceEncoder


@pytest.fixture(scope="module")
def whole(tokenizer):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer)  # as the library loads it
    return lambda texts: [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_equal_whole_texts(tokenizer, whole):
    rnd = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(rnd.choice([*" \n\ta'sB1.,é　", "<|endoftext|>"]) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    enc = PieceEncoder(tokenizer, limit=500)  # so small that it is cleared on the way
    got = []
    for i in range(0, len(texts), 100):
        ids, n = enc.encode(texts[i : i + 100])
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert enc.counts(texts[i : i + 100]).tolist() == n.tolist()
    assert got == whole(texts)
    assert 50256 in whole(["a <|endoftext|> b"])[0]


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 32])
def test_shard_round_trip(bits):
    ids = np.random.default_rng(0).integers(0, 2**bits, 10_001, dtype=np.uint64).astype(np.uint32)
    shard = token_store.Shard(token_store.shard_image([1, None, 3], [0, 10_000, 1], ids, bits, 777))
    assert (shard.ids(0, 10_001) == ids).all() and (shard.ids(800, 5000) == ids[800:5000]).all()
    assert shard.doc_ids == [1, None, 3] and len(shard.document(0)) == 0 and (shard.document(1) == ids[:10_000]).all()


def stored(spark, df, tokenizer, **kw):
    path = token_store.write_tokens(df, tokenizer, **kw)
    return path, token_store.read_tokens(spark, path).collect()


def test_store(spark, docs, tokenizer, whole):
    path, rows = stored(spark, docs, tokenizer, shard_ids=5000)
    rows.sort(key=lambda r: r.start)
    src = docs.orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [r.doc_id for r in src]
    ids = [x + [0] for x in whole([r.text for r in src])]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == ids
    assert [r.start for r in rows] == (np.cumsum([len(x) for x in ids]) - [len(x) for x in ids]).tolist()
    assert token_store.read_document(spark, path, src[5].doc_id)[0].tolist() == ids[5]


def test_store_of_odd_rows(spark, odd_docs, no_docs, tokenizer, whole):
    _, rows = stored(spark, odd_docs, tokenizer)
    rows.sort(key=lambda r: r.start)
    assert rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    src = odd_docs.collect()
    want = Counter((r.doc_id, tuple(x + [0])) for r, x in zip(src, whole([r.text for r in src])))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == want
    assert stored(spark, no_docs, tokenizer)[1] == []


def packed_ok(rows, want):
    """Every id in exactly one piece, sequences gapless and not over capacity; the share of padding."""
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        seqs[r.sequence_id].append(r)
        assert r.length * 4 == len(r.ids)
    got = Counter()
    for (doc, total), of in pieces.items():
        starts = Counter()
        for p in of:
            starts[p.start] += 1
        copies = starts[0]
        for p in of:
            got[doc, total, p.start, p.length, zlib.crc32(p.ids)] += 1
        assert sum(p.length for p in of) == copies * total
    for doc, ids in want:
        data = np.array(ids, "<u4").tobytes()
        for k in [k for k in got if k[0] == doc and k[1] == len(ids) and zlib.crc32(data[4 * k[2] : 4 * (k[2] + k[3])]) == k[4]]:
            got[k] -= 1
    assert not any(got.values())
    fill = 0
    for of in seqs.values():
        at = 0
        for p in sorted(of, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        fill += at
    return 1 - fill / (2048 * len(seqs)) if seqs else 0


def test_packing(docs, tokenizer, whole):
    src = docs.collect()
    waste = packed_ok(packing.pack_documents(docs, tokenizer).collect(), [(r.doc_id, x + [1]) for r, x in zip(src, whole([r.text for r in src]))])
    assert waste < 0.02


def test_packing_in_rounds(docs, tokenizer, whole, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    src = docs.collect()
    packed_ok(packing.pack_documents(docs.repartition(10), tokenizer).collect(), [(r.doc_id, x + [1]) for r, x in zip(src, whole([r.text for r in src]))])


def test_packing_odd_rows(odd_docs, no_docs, tokenizer, whole):
    src = odd_docs.collect()
    packed_ok(packing.pack_documents(odd_docs, tokenizer).collect(), [(r.doc_id, x + [1]) for r, x in zip(src, whole([r.text for r in src]))])
    assert packing.pack_documents(no_docs, tokenizer).collect() == []


def test_cuts():
    for n in [*range(1, 300), 1024, 2047, 2048, 2049, 5000]:
        out = packing.cuts(n)
        assert sum(out) == n and max(out) <= 2048
        for x in out:
            slot = min(s for _, s in packing.classes() if s >= x)
            assert slot - x <= slot // 128


def test_trees_follow_edits(tokenizer):
    enc, rnd = PieceEncoder(tokenizer), random.Random(5)
    for _ in range(200):
        t = "".join(rnd.choice(["a", "b", "é", " ", "  ", "\n", "1", ".", "'s", "word", " the"]) for _ in range(rnd.randint(0, 80)))
        tree = token_counts.TokenTree(t, enc, size=rnd.choice([1, 5, 20, 256]))
        for _ in range(6):
            a = rnd.randint(0, len(t))
            b = rnd.randint(a, min(len(t), a + rnd.choice([0, 1, 3, 50])))
            new = "".join(rnd.choice(" ab.\n1") for _ in range(rnd.randint(0, 6)))
            tree.edit(a, b, new)
            t = t[:a] + new + t[b:]
            assert tree.text == t and tree.total == enc.counts([t])[0]
    with pytest.raises(ValueError):
        token_counts.TokenTree("abc", enc).edit(2, 9, "")


def test_edits_encode_little(tokenizer):
    enc = PieceEncoder(tokenizer)
    text = "some words of a text " * 5000
    tree = token_counts.TokenTree(text, enc)
    tree.edit(50_000, 50_004, "other")
    assert tree.encoded < 1500 and tree.total == enc.counts([text[:50_000] + "other" + text[50_004:]])[0]


def test_counts_by_rule_and_by_table(spark, docs, odd_docs, no_docs, tokenizer, whole):
    from strandlake.llm.queries import redactions

    rows = token_counts.edited_counts(docs, tokenizer, rule=redactions).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}

    def edited(t):
        for a, b, new in reversed(redactions(t)):
            t = t[:a] + new + t[b:]
        return t

    assert any(r.n_edits for r in rows)
    for r in rows:
        assert [r.n_tokens, r.n_tokens_edited] == [len(x) for x in whole([texts[r.doc_id], edited(texts[r.doc_id])])]
    edits = spark.createDataFrame([(6, 0, 4, "w"), (7, 3, 3, " more"), (99, 0, 1, "")], "doc_id long, start long, end long, replacement string")
    got = {(r.doc_id, r.n_chars): r for r in token_counts.edited_counts(odd_docs, tokenizer, edits=edits).collect()}
    assert got[7, 9].n_tokens_edited == len(whole(["two more words"])[0]) and got[6, 4].n_tokens_edited == len(whole(["w"])[0])
    assert got[0, 0].n_tokens == 0 and token_counts.edited_counts(no_docs, tokenizer).collect() == []


def test_kept_trees_take_further_edits(spark, tokenizer, whole):
    """A second call starts from the kept table and encodes what it touches alone; odd edits are skipped."""
    text = "some words of a text " * 3000
    df = spark.createDataFrame([(1, text), (None, "no id"), (2, None), (3, "abc def")], "doc_id long, text string")
    trees = token_counts.build_trees(df, tokenizer)
    edits = [(1, 5, 10, "WORDS"), (1, 8, 12, "overlaps"), (1, 40_000, 40_004, None), (1, 70_000, 70_001, "out"), (1, 9, 3, "back"), (1, None, 3, ""), (None, 0, 2, "an"), (2, 0, 0, "new"), (2, 0, 0, "er"), (3, 7, 7, " end")]
    first = token_counts.apply_edits(trees, tokenizer, edits=spark.createDataFrame(edits, "doc_id long, start long, end long, replacement string"))
    first = token_counts.kept(first, "trees")
    rows = {r.doc_id: r for r in first.collect()}
    once = text[:5] + "WORDS" + text[10:40_000] + text[40_004:]
    want = {1: once, None: "an id", 2: "ernew", 3: "abc def end"}
    assert {k: "".join(r.parts) for k, r in rows.items()} == want
    assert {k: r.tokens[1] for k, r in rows.items()} == {k: len(whole([t])[0]) for k, t in want.items()}
    assert (rows[1].n_edits, rows[1].n_skipped) == (2, 4) and rows[1].n_chars_encoded < 3000
    again = {r.doc_id: r for r in token_counts.apply_edits(first, tokenizer, rule=lambda t: [(100, 101, "?")] if len(t) > 100 else []).collect()}
    assert again[1].tokens[1] == len(whole([once[:100] + "?" + once[101:]])[0]) and again[1].n_chars_encoded < 1500
    assert again[1].n_tokens_before == rows[1].tokens[1] and again[3].n_chars_encoded == 0


def test_query_digests(spark, sf_dir, docs, whole):
    """The registered queries' columns, types and checksums against the library itself."""
    from strandlake.llm import queries

    src = docs.orderBy("doc_id").collect()
    want = {r.doc_id: x for r, x in zip(src, whole([r.text for r in src]))}
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    one = queries.op1_token_store(spark, sf_dir)
    assert one.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    at, rows = 0, {r.doc_id: r for r in one.collect()}
    for r in src:
        ids = [*want[r.doc_id], 0]
        assert tuple(rows[r.doc_id]) == (r.doc_id, at, len(ids), crc(ids))
        at += len(ids)
    ten = queries.op10_packing(spark, sf_dir).collect()
    for r in ten:
        ids = [*want[r.doc_id], 1]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])
    nine = queries.op9_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in nine} == {k: len(v) for k, v in want.items()}


def test_a_very_long_text(spark, tokenizer, whole):
    text = ("lorem ipsum  dolor\nsit amet, " * 60_000)[:1_500_000] + "x" * 300_000
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    ids = whole([text])[0]
    _, rows = stored(spark, df, tokenizer)
    assert np.frombuffer({r.doc_id: r for r in rows}[1].ids, "<u4").tolist() == [*ids, 0]
    assert {r.doc_id: r.n_tokens for r in token_counts.edited_counts(df, tokenizer).collect()}[1] == len(ids)
    packed_ok(packing.pack_documents(df, tokenizer).collect(), [(1, [*ids, 1]), (2, [*whole(["short"])[0], 1])])
