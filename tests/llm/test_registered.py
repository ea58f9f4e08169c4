"""Types and digests of the registered queries, by the contract's own words."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest
import xxhash

from strandlake.llm import queries


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def test_suffix_dedup(spark, sf_dir, texts):
    found = queries.op2_suffix_dedup(spark, sf_dir)
    assert found.dtypes[:5] == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    data = {i: t.encode() for i, t in texts.items()}
    seen = Counter(hash(b[k : k + 200]) for b in data.values() for k in range(len(b) - 199))
    rows, gone = {r.doc_id: r for r in found.collect()}, 0
    assert set(rows) == set(data)
    for i, b in data.items():
        cover = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[hash(b[k : k + 200])] > 1:
                cover[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = len(re.findall(b"\x01+", bytes(cover)))
        assert tuple(rows[i])[1:5] == (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
        gone += spans
    assert gone > 0


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pii_base(spark, sf_dir, texts):
    found = queries.op3_pii(spark, sf_dir)
    assert found.dtypes[:7] == [("doc_id", "bigint"), *((f"n_{k}", "bigint") for k in ("email", "ip", "card", "phone")), ("base_sha256", "string"), ("spans", "string")]
    forms = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
    }
    some = 0
    for r in found.collect():
        base = {k: [(m.start(), m.end()) for m in re.finditer(p, texts[r.doc_id]) if ok(m[0])] for k, (p, ok) in forms.items()}
        assert tuple(r)[1:5] == tuple(len(base[k]) for k in forms)
        line = [f"{k}:{a}:{b}" for k in forms for a, b in base[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert set(line) <= set(r.spans.split(","))
        some += len(line)
    assert some > 0


def test_language_id(spark, sf_dir, docs, texts):
    found = queries.op5_language_id(spark, sf_dir)
    assert found.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    known = {r.lang for r in docs.select("lang").distinct().collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.lang_pred in known if any(map(str.isalpha, texts[r.doc_id])) else r.lang_pred == "und"


def test_simhash(spark, sf_dir, texts):
    found = queries.op7_simhash(spark, sf_dir)
    assert found.dtypes[:3] == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    prints = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        bits = [0] * 64
        for s in shingles:
            h = xxhash.xxh64(s.encode(), seed=42).intdigest()
            for b in range(64):
                bits[b] += h >> b & 1
        prints[i] = sum((2 * n > len(shingles)) << b for b, n in enumerate(bits))
    of = {i: i for i in prints}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    ids = sorted(prints)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                of[b] = a
    rows = {r.doc_id: r for r in found.collect()}
    assert {i: (r.fingerprint, r.component_id) for i, r in rows.items()} == {i: (f"{prints[i]:016x}", root(i)) for i in ids}
    assert len({root(i) for i in ids}) < len(ids)
