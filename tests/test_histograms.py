"""Bounded summaries: the order of merging, error of a bin at most, range growth, odd values, streams of batches."""

from __future__ import annotations

import numpy as np
import pytest

from strandlake.operators import histograms, stats


def summary(x, batches=1, bins=100):
    s = histograms.Summary(bins)
    for part in np.array_split(np.asarray(x, float), batches):
        s.update(part)
    return s


@pytest.mark.parametrize("x", [
    np.random.default_rng(0).normal(size=5000), np.random.default_rng(1).exponential(size=3000) * 1e9, np.arange(1000.0), [5.0] * 10, [0.0, 0.0],
    [-1e-290, 1e-290], [1e15, 1e15 + 1, 1e15 + 5], [3.0], np.random.default_rng(2).normal(1e6, 1e-6, 2000),
])
def test_batches_make_the_same_summary(x):
    x = np.asarray(x, float)
    rnd = np.random.default_rng(3)
    one = summary(x)
    for k in (2, 7):
        other = summary(rnd.permutation(x), k)
        assert (one.n, one.low, one.high, one.scale) == (other.n, other.low, other.high, other.scale)
        assert one.numbers.tolist() == other.numbers.tolist() and one.counts.tolist() == other.counts.tolist()
        assert np.isclose(one.mean, other.mean, rtol=1e-12) and np.isclose(one.m2, other.m2, rtol=1e-6, atol=1e-9 * max(1, x.var()))
    assert one.n == len(x) == one.counts.sum() and one.numbers[-1] - one.numbers[0] < 100
    assert np.isclose(one.mean, x.mean()) and np.isclose(one.m2 / one.n, x.var(), rtol=1e-6, atol=1e-12)
    if x.max() > x.min():
        assert 2.0**one.scale <= 2 * (x.max() - x.min()) / 99 or abs(x).max() / 2.0**one.scale >= 2.0**51


def test_range_growth_loses_nothing():
    s = histograms.Summary(1000)
    s.update(np.array([0.0, 0.1, 0.2]))
    narrow = s.scale
    s.update(np.array([10.0, 11.0, -5.0]))
    assert s.scale > narrow and s.counts.sum() == 6 and (s.low, s.high) == (-5.0, 11.0)
    assert s.numbers[0] * 2.0**s.scale <= -5 and (s.numbers[-1] + 1) * 2.0**s.scale > 11
    s.update(np.array([np.nan, np.inf, -np.inf]))
    assert s.n == 6 and s.high == 11.0


def table(spark, rows, parts):
    return spark.createDataFrame(rows, "k string, v array<double>").repartition(parts)


def test_quantiles_are_off_by_a_bin_at_most(spark):
    rnd = np.random.default_rng(4)
    x = np.stack([rnd.normal(size=4000), rnd.exponential(size=4000) * 100, rnd.integers(0, 5, 4000), np.full(4000, 7.0)], 1)
    rows = [("a" if i % 3 else "b", r.tolist()) for i, r in enumerate(x)]
    for parts in (1, 5):
        found = {r.dim: r for r in stats.vector_stats(table(spark, rows, parts), "v").collect()}
        for d in range(4):
            width = (x[:, d].max() - x[:, d].min()) / (histograms.BINS / 2)
            r = found[d]
            assert (r["min"], r["max"], r["count"]) == (x[:, d].min(), x[:, d].max(), 4000)
            assert np.isclose(r["mean"], x[:, d].mean()) and np.isclose(r["std"], x[:, d].std())
            ranks = np.sort(x[:, d])
            for name, q in stats.QUANTILES.items():
                near = ranks[max(0, int(np.ceil(q * 4000)) - 1)]  # the value at that rank
                assert abs(r[name] - near) <= width + 1e-12, (d, name)


def test_merging_parts_in_any_order(spark):
    rnd = np.random.default_rng(5)
    rows = [(str(i % 7), [float(v), float(v) * 1000]) for i, v in enumerate(rnd.standard_t(2, 3000))]
    df = table(spark, rows, 6)
    whole = histograms.merged(histograms.summaries(df, "v"))
    by_key = histograms.merged(histograms.summaries(df, "v", ["k"]), ["k"])
    some, rest = by_key.filter("k < '3'").drop("k"), by_key.filter("k >= '3'").drop("k")
    ways = [histograms.merged(by_key.drop("k")), histograms.merged(histograms.merged(some).unionByName(rest)), histograms.merged(histograms.merged(rest).unionByName(histograms.merged(some)))]
    exact = lambda s: sorted((r.dim, r.n, r["min"], r["max"], r.scale, tuple(map(tuple, r.bins))) for r in s.collect())
    want = exact(whole)
    assert all(exact(w) == want for w in ways)
    q = lambda s: {(r.dim, round(r["mean"], 9), round(r["std"], 6), r.q01, r.q50, r.q99) for r in histograms.statistics(s, stats.QUANTILES).collect()}
    assert all(q(w) == q(whole) for w in ways)


def test_groups_and_odd_vectors(spark, monkeypatch):
    rows = [("a", [1.0, None]), ("a", [3.0, float("nan"), 5.0]), ("b", None), ("b", []), ("c", [2.0]), ("é", [1.0, 2.0])]
    df = table(spark, rows, 2)
    monkeypatch.setattr(histograms, "HELD", 1)
    found = {(r.k, r.dim): r for r in stats.vector_stats(df, "v", ["k"], method="histogram").collect()}
    assert {k: r["count"] for k, r in found.items()} == {("a", 0): 2, ("a", 2): 1, ("c", 0): 1, ("é", 0): 1, ("é", 1): 1}
    assert found["a", 0]["mean"] == 2 and found["a", 0]["std"] == 1 and found["a", 0].q01 == 1.0
    assert found["c", 0]["std"] == 0 and found["c", 0].q50 == 2.0
    assert stats.vector_stats(df.limit(0), "v").count() == 0
    with pytest.raises(ValueError):
        stats.vector_stats(df, "v", method="guess")


def test_first_bin_gives_its_edge(spark):
    """A gripper that is closed in more than one frame in a hundred: its least value, not one inside the bin."""
    rows = [("a", [0.0])] * 50 + [("a", [float(i)]) for i in range(1, 951)]
    r = stats.vector_stats(table(spark, rows, 3), "v").first()
    assert r.q01 == 0.0 and r.q10 > 49
    h = stats.histogram(table(spark, rows, 1), "v", 10)
    assert stats.histogram_quantile(h, 0.01).first().quantile == 0.0
    assert stats.histogram_quantile(h, 0.5).first().quantile > 400


def test_no_exact_percentile_without_groups(spark):
    df = table(spark, [("a", [1.0]), ("a", [2.0])], 1)
    plan = stats.vector_stats(df, "v")._jdf.queryExecution().toString()
    assert "percentile" not in plan


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_quantiles_by_rank(spark, parts, monkeypatch):
    """Between ranks as numpy has it: wide ranges with most values in one bin, ties, few values, null and infinite ones."""
    rnd = np.random.default_rng(6)
    x = np.stack([rnd.normal(size=3000), np.append(rnd.normal(size=2999) * 1e-6, 1e9), rnd.integers(0, 3, 3000), np.full(3000, 7.0), rnd.standard_cauchy(3000)], 1)
    rows = [("a", [*r.tolist(), *([float(i), np.inf][: max(0, 2 - i // 2)]), *([None] if i < 2 else [])]) for i, r in enumerate(x)]
    df = table(spark, rows, parts)
    monkeypatch.setattr(stats, "NEAR", 0.02)
    for accuracy in (10_000, 1000):  # all values are counted, or those near the ranks
        monkeypatch.setattr(stats, "ACCURACY", accuracy)
        found = {r.dim: r for r in stats.vector_stats(df, "v", method="exact").collect()}
        assert sorted(found) == list(range(8))
        for d in range(5):
            assert found[d]["count"] == 3000
            for name, q in stats.QUANTILES.items():
                assert np.isclose(found[d][name], np.quantile(x[:, d], q), rtol=1e-12, atol=1e-15), (d, name)
        assert (found[5].q50, found[5].q10) == (1.5, 0.30000000000000004) and found[6].q01 == np.inf and found[7].q50 is None
    assert stats.vector_stats(df.limit(0), "v", method="exact").count() == 0


def test_exact_quantiles_hold_no_element(spark):
    df = table(spark, [("a", [1.0]), ("a", [2.0])], 1)
    plan = stats.vector_stats(df, "v", method="exact")._jdf.queryExecution().toString()
    assert "percentile(" not in plan


def test_queries_of_quantiles_are_of_ranks():
    """Their SQL takes quantiles between ranks, not of bins."""
    from strandlake.plans import queries

    for q in ("vector_stats", "exact_vector_stats", "normalize_q01_q99", "normalize_q10_q90", "quantile_augmentation"):
        assert "quantile_cont" in queries.ORACLE_SQL[q] and "bin" not in queries.ORACLE_SQL[q]
