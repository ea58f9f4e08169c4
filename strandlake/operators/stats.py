"""Statistics of vector features: one exploded pass, partial and final aggregation by Spark.

Standard deviations are those of the population.  A group of fewer than two
rows has deviation 0 and its mean for every quantile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vector as V
from ..sources.shared import kept
from . import histograms

QUANTILES = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}
#: A sketch's error as a share of the count is one over this; an element of fewer values is counted whole.
ACCURACY = 10_000
#: Share of the count to either side of an exact quantile whose values are counted one by one: twenty times the sketch's error.
NEAR = 0.002


def long_form(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """One row for each element: keys, dim, x."""
    return df.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "x"))


def vector_stats(df: DataFrame, vector: str, keys: Sequence[str] = (), quantiles: dict[str, float] | None = None, method: str | None = None) -> DataFrame:
    """min, max, mean, std, count and quantiles of every element, for each group of ``keys``.

    ``method`` is ``histogram`` (bounded summaries that merge in any order,
    quantiles off by a bin at most; the default where there is no group, since
    then one element's values are as many as the rows), ``exact`` (interpolated
    between ranks; the default for groups such as an episode, whose values fit a
    task; without a group the values near the wanted ranks are counted, so no task
    holds an element's values), or ``sketch``.  With histograms, elements that are
    null, NaN or infinite don't count.
    """
    q = QUANTILES if quantiles is None else quantiles
    method = method or ("exact" if keys else "histogram")
    if method == "histogram":
        return histograms.statistics(histograms.merged(histograms.summaries(df, vector, keys), keys), q, keys)
    if method not in ("exact", "sketch"):
        raise ValueError(f"no method {method!r}")
    of = (lambda p: F.percentile("x", F.lit(p))) if method == "exact" else (lambda p: F.percentile_approx("x", F.lit(p), F.lit(ACCURACY)))
    moments = (F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("x").alias("count"))
    if method == "exact" and q and not keys:
        out = _with_ranks(long_form(df, keys, vector), moments, q)
    else:
        out = long_form(df, keys, vector).groupBy(*keys, "dim").agg(*moments, *(of(p).alias(n) for n, p in q.items()))
    few = F.col("count") < 2
    return out.withColumn("std", F.when(few, F.lit(0.0)).otherwise(F.col("std"))).select(*keys, "dim", "min", "max", "mean", "std", "count", *(F.when(few, F.col("mean")).otherwise(F.col(n)).alias(n) for n in q))


def _with_ranks(x: DataFrame, moments: Sequence[Column], q: dict[str, float]) -> DataFrame:
    """Moments and exact quantiles of (dim, x).

    A sketch tells between which two values each quantile's ranks lie, at
    ``NEAR`` of the count to either side, where it is off by 1 / ``ACCURACY`` at
    most.  The values between are counted one by one, all others by the gap they
    lie in, so the running sum of the counts gives each value's rank.  An element
    of few values is counted whole.
    """
    share = [p for c in q.values() for p in (max(0.0, c - NEAR), min(1.0, c + NEAR))]
    base = kept(x.groupBy("dim").agg(*moments, F.percentile_approx("x", share, ACCURACY).alias("cuts")), "ranks")
    whole = F.col("count") < ACCURACY
    low = [F.when(whole | F.lit(p <= 0), F.col("min")).otherwise(F.get("cuts", F.lit(2 * i))).alias(f"low{i}") for i, p in enumerate(share[::2])]
    high = [F.when(whole | F.lit(p >= 1), F.col("max")).otherwise(F.get("cuts", F.lit(2 * i + 1))).alias(f"high{i}") for i, p in enumerate(share[1::2])]
    met = x.filter("x is not null").join(F.broadcast(base.select("dim", *low, *high)), "dim")
    gap, below = F.lit(True), [F.lit(float("-inf"))]
    for i in range(len(q)):
        gap = gap & ~F.col("x").between(F.col(f"low{i}"), F.col(f"high{i}"))
        below.append(F.when(F.col(f"high{i}") < F.col("x"), F.col(f"high{i}")).otherwise(F.lit(float("-inf"))))
    n = met.select("dim", gap.alias("gap"), F.when(gap, F.greatest(*below)).otherwise(F.col("x")).alias("x")).groupBy("dim", "x", "gap").agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("upto", F.sum("n").over(Window.partitionBy("dim").orderBy("x", "gap").rowsBetween(Window.unboundedPreceding, 0)))
    at = {c: (F.col("count") - 1) * F.lit(float(p)) for c, p in q.items()}
    first = lambda rank: F.min(F.when(F.col("upto") > rank, F.struct("x", "gap")))
    found = n.join(F.broadcast(base.select("dim", "count")), "dim").groupBy("dim").agg(*(first(side(at[c])).alias(f"{c}_{i}") for c in q for i, side in enumerate((F.floor, F.ceil))))

    def between(c: str) -> Column:
        a, b, rest = F.col(f"{c}_0.x"), F.col(f"{c}_1.x"), at[c] - F.floor(at[c])
        met_gap = F.col(f"{c}_0.gap") | F.col(f"{c}_1.gap")
        return F.when(met_gap, F.raise_error(F.lit(f"{c}: the sketch is off by more than it may be")).cast("double")).when((a == b) | (rest == 0), a).otherwise(a + (b - a) * rest).alias(c)

    return base.drop("cuts").join(found, "dim", "left").select(*base.drop("cuts").columns, *(between(c) for c in q))


def merge_stats(stats: DataFrame, keys: Sequence[str] = (), quantiles: Sequence[str] = tuple(QUANTILES)) -> DataFrame:
    """Statistics of a union from those of its parts: exact but for quantiles, which are means weighted by count."""
    n = F.col("count")
    mean = (F.sum(n * F.col("mean")) / F.sum(n)).alias("mean")
    first = stats.groupBy(*keys, "dim").agg(F.min("min").alias("min"), F.max("max").alias("max"), mean, F.sum(n * (F.col("std") ** 2 + F.col("mean") ** 2)).alias("_sq"), F.sum(n).alias("count"), *((F.sum(n * F.col(q)) / F.sum(n)).alias(q) for q in quantiles))
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("_sq") / F.col("count") - F.col("mean") ** 2))
    return first.select(*keys, "dim", "min", "max", "mean", std.alias("std"), "count", *quantiles)


def merge_stats_legacy(stats: DataFrame, keys: Sequence[str] = (), weighted: bool = True) -> DataFrame:
    """The older rule: deviations are pooled without the shift of means; image features weigh each part alike."""
    n = F.col("count") if weighted else F.lit(1)
    return stats.groupBy(*keys, "dim").agg(F.min("min").alias("min"), F.max("max").alias("max"), (F.sum(n * F.col("mean")) / F.sum(n)).alias("mean"), F.sqrt(F.sum(n * F.col("std") ** 2) / F.sum(n)).alias("std"), F.sum("count").alias("count"))


def histogram(df: DataFrame, vector: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins between each element's least and greatest value: (keys, dim, bin, low, high, n)."""
    x = long_form(df, keys, vector)
    ends = x.groupBy(*keys, "dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    at = F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0))).cast("int"))
    step = (F.col("hi") - F.col("lo")) / bins
    joined = x.join(ends, [*keys, "dim"]).withColumn("bin", at)
    return joined.groupBy(*keys, "dim", "bin").agg(F.first(F.col("lo") + F.col("bin") * step).alias("low"), F.first(F.col("lo") + (F.col("bin") + 1) * step).alias("high"), F.count(F.lit(1)).alias("n"))


def histogram_quantile(hist: DataFrame, q: float, keys: Sequence[str] = (), interpolate: bool = True) -> DataFrame:
    """Quantile of a histogram: linear in its bin, or the bin's lower edge; in the first bin that edge in any case."""
    w = Window.partitionBy(*keys, "dim").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    c = hist.withColumn("_c", F.sum("n").over(w)).withColumn("_t", F.sum("n").over(Window.partitionBy(*keys, "dim")) * q)
    hit = c.filter(F.col("_c") >= F.col("_t")).groupBy(*keys, "dim").agg(F.min_by(F.struct("low", "high", "n", "_c", "_t"), "bin").alias("b"))
    inner = F.col("b.low") + (F.col("b._t") - (F.col("b._c") - F.col("b.n"))) / F.col("b.n") * (F.col("b.high") - F.col("b.low"))
    first = F.col("b._c") == F.col("b.n")  # nothing lies below
    return hit.select(*keys, "dim", F.when(first | F.lit(not interpolate), F.col("b.low")).otherwise(inner).alias("quantile"))


def nested(stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row a group with an array for each statistic, in the order of the elements."""
    names = [c for c in stats.columns if c not in (*keys, "dim")]
    rows = stats.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("dim", *names))).alias("_s"))
    return rows.select(*keys, *(F.col(f"_s.{n}").alias(n) for n in names))


def has_quantiles(columns: Sequence[str]) -> bool:
    return any(q in columns for q in QUANTILES)


def sample_size(n: int, least: int = 100, most: int = 10_000, power: float = 0.75) -> int:
    return n if n < least else max(least, min(most, int(n**power)))


def sample_size_of(n: Column, least: int = 100, most: int = 10_000, power: float = 0.75) -> Column:
    """The same of a column."""
    return F.when(n < least, n).otherwise(F.greatest(F.lit(least), F.least(F.lit(most), F.floor(F.pow(n, F.lit(power)))))).cast("long")


def sample_positions(n: Column, k: Column) -> Column:
    """k positions spread evenly over 0 .. n - 1, both ends included, rounded half to even."""
    one = F.array(F.lit(0))
    return F.when(k <= 1, one).otherwise(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.rint(V.spread(i, n, k)).cast("int")))


def max_and_near(df: DataFrame, keys: Sequence[str], value: str, atol: float = 10.0) -> DataFrame:
    """Greatest value and how many are within ``atol`` of it; NaN and null don't count."""
    ok = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    top = ok.groupBy(*keys).agg(F.max(value).alias("max_value"))
    return ok.join(top, list(keys)).groupBy(*keys, "max_value").agg(F.sum((F.abs(F.col(value) - F.col("max_value")) <= atol).cast("long")).alias("n_near"))


# -- normalisation -----------------------------------------------------------------------------

MODES = {"mean_std": ("mean", "std"), "min_max": ("min", "max"), "quantiles": ("q01", "q99"), "quantile10": ("q10", "q90")}


def _literal(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def normalise(x: Column, a: Column, b: Column, mode: str = "mean_std", eps: float = 1e-6) -> Column:
    """mean_std: (x - mean) / (std + eps); the others map [a, b] to [-1, 1], a zero range counts as eps."""
    x = x.cast("array<double>")
    if mode == "mean_std":
        return F.transform(x, lambda v, i: (v - F.get(a, i)) / (F.get(b, i) + eps))
    span = lambda i: F.when(F.get(b, i) == F.get(a, i), F.lit(eps)).otherwise(F.get(b, i) - F.get(a, i))
    return F.transform(x, lambda v, i: 2 * (v - F.get(a, i)) / span(i) - 1)


def unnormalise(x: Column, a: Column, b: Column, mode: str = "mean_std", eps: float = 1e-6) -> Column:
    """Inverse of ``normalise``; with eps 0 and mean_std the rule x std + mean, no exact inverse of one with eps."""
    x = x.cast("array<double>")
    if mode == "mean_std":
        return F.transform(x, lambda v, i: v * (F.get(b, i) + eps) + F.get(a, i))
    span = lambda i: F.when(F.get(b, i) == F.get(a, i), F.lit(eps)).otherwise(F.get(b, i) - F.get(a, i))
    return F.transform(x, lambda v, i: (v + 1) / 2 * span(i) + F.get(a, i))


def with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Join each row's statistics as arrays: one row a group, so it is broadcast."""
    wide = nested(stats, keys)
    return df.join(F.broadcast(wide), list(keys)) if keys else df.crossJoin(F.broadcast(wide))


def detect_mode(names: Sequence[str]) -> str:
    """Mode that the statistics at hand allow."""
    return next((m for m in ("quantiles", "quantile10", "mean_std", "min_max") if set(MODES[m]) <= set(names)), "identity")


def with_quantiles(stats: DataFrame, frames: DataFrame, vector: str, keys: Sequence[str] = (), quantiles: dict[str, float] | None = None, method: str | None = None) -> DataFrame:
    """The statistics as they are if they have quantiles, else all of them computed again from the frames."""
    return stats if has_quantiles(stats.columns) else vector_stats(frames, vector, keys, quantiles, method)


def errors(nested_stats: DataFrame, dims: int, image: bool = False) -> DataFrame:
    """Rows of array statistics with what is wrong: a scalar, another length than the feature's (3 for images), a count that is no single number."""
    names = [c for c, t in nested_stats.dtypes if t.startswith("array") and c != "count"]
    want = 3 if image else dims
    error = F.lit(None).cast("string")
    for c in reversed(names):
        error = F.when(F.col(c).isNull(), f"{c}: no value").when(F.size(c) != want, f"{c}: length is not {want}").otherwise(error)
    if "count" in nested_stats.columns and dict(nested_stats.dtypes)["count"].startswith("array"):
        error = F.coalesce(error, F.when(F.size(F.array_distinct("count")) != 1, "count: not one number"))
    return nested_stats.withColumn("error", error)
