"""Action tokens: the transform, bounded error, merges against a plain rule, odd sequences."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.functions import action_tokens as A


def basis(n):
    k, t = np.arange(n)[:, None], np.arange(n)[None]
    return np.sqrt(np.where(k == 0, 1, 2) / n) * np.cos(np.pi * (2 * t + 1) * k / (2 * n))


@pytest.mark.parametrize("horizon, dim, scale", [(10, 3, 10.0), (1, 2, 4.0), (16, 1, 100.0)])
def test_round_trip(spark, horizon, dim, scale):
    rnd = np.random.default_rng(0)
    chunks = [rnd.normal(size=(horizon, dim)).cumsum(0) for _ in range(20)]
    assert np.allclose(basis(horizon) @ basis(horizon).T, np.eye(horizon))
    df = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(chunks)], "i int, c array<array<double>>")
    q = A.quantised(F.col("c"), horizon, dim, scale)
    merges = A.Merges(-4000, 8000, [(4000, 4000), (8000, 4000)])
    rows = A.decoded(A.encoded(df.select("i", q.alias("q")), "q", merges), "ids", merges)
    out = rows.withColumn("back", A.dequantised(F.col("numbers"), horizon, dim, scale))
    for r in out.collect():
        want = np.rint(basis(horizon) @ chunks[r.i] * scale).astype(int)
        assert r.q == want.ravel().tolist()  # low frequencies of all elements first
        assert np.abs(np.array(r.back) - chunks[r.i]).max() <= np.sqrt(horizon) / (2 * scale) + 1e-9
        assert len(r.ids) <= len(r.q)


def plain(merges, numbers):
    """Of all pairs that could be merged the one of least rank, leftmost, again and again."""
    ids = [x - merges.least for x in numbers]
    while True:
        some = [(merges.rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges.rank]
        if not some:
            return ids
        rank, i = min(some)
        ids[i : i + 2] = [merges.count + rank]


def test_merges_against_a_plain_rule():
    rnd = random.Random(1)
    for _ in range(60):
        count, pairs = 5, []
        for _ in range(8):
            p = (rnd.randrange(count + len(pairs)), rnd.randrange(count + len(pairs)))
            if p not in pairs:
                pairs.append(p)
        merges = A.Merges(-2, count, pairs)
        for _ in range(20):
            numbers = [rnd.randint(-2, 2) for _ in range(rnd.randint(0, 30))]
            assert merges.encode(numbers) == plain(merges, numbers)
            assert merges.decode(merges.encode(numbers)) == numbers
    merges = A.Merges(-2, 5, [(2, 2), (5, 5)])
    assert merges.encode([9, -9]) == [4, 0] and merges.decode([99, -1, 6, 4]) == [0, 0, 0, 0, 2]
    with pytest.raises(ValueError):
        A.Merges(0, 5, [(5, 0)])


def test_odd_sequences(spark):
    rows = [([[1.0, 2.0], [3.0, 4.0]],), ([[1.0], [2.0]],), ([[1.0, None], [2.0, 3.0]],), ([[1.0, float("nan")], [2.0, 3.0]],), (None,), ([],)]
    q = [r[0] for r in spark.createDataFrame(rows, "c array<array<double>>").select(A.quantised(F.col("c"), 2, 2)).collect()]
    assert q[0] == [28, 42, -14, -14] and q[1:] == [None] * 5
    back = spark.createDataFrame([([28, 42, -14, -14],), ([1],), (None,)], "q array<long>").select(A.dequantised(F.col("q"), 2, 2)).collect()
    assert np.allclose(back[0][0], [[1, 2], [3, 4]], atol=0.08) and back[1][0] == [[0.0, 0.0]] * 2 and back[2][0] is None
    ids = spark.createDataFrame([([0, 5],)], "i array<int>")
    placed = A.placed(F.col("i"), 1000)
    assert ids.select(placed).first()[0] == [871, 866] and ids.select(A.placed(placed, 1000)).first()[0] == [0, 5]


def test_products_are_made_by_batches(spark):
    """The transform goes over a batch of chunks at once, whatever chunks of another form lie between; no product is interpreted value by value."""
    rnd = np.random.default_rng(3)
    chunks = [rnd.normal(size=(4, 3)).tolist() if i % 4 else [None, [], [[1.0]], [[1.0, 2.0, 3.0]] * 3 + [None]][i // 4 % 4] for i in range(40)]
    df = spark.createDataFrame(list(enumerate(chunks)), "i int, c array<array<double>>").coalesce(2)
    out = df.select("i", A.transformed(F.col("c"), 4, 3).alias("t"), A.quantised(F.col("c"), 4, 3).alias("q"))
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        if r.i % 4:
            assert np.allclose(r.t, basis(4) @ np.array(chunks[r.i]), atol=1e-12) and r.q == np.rint(10 * np.array(r.t)).ravel().tolist()
        else:
            assert r.t is None and r.q is None
    back = spark.createDataFrame([([1, 2, None, 4],), ([1, 2, 3, 4],)], "q array<long>").select(A.dequantised(F.col("q"), 2, 2)).collect()
    assert [[x is None for x in v] for v in back[0][0]] == [[True, False]] * 2 and back[1][0] is not None
