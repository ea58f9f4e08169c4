"""As-of joins: union, one shuffle by key, one sort in each direction.

No range join and no loop: the rows of both sides are put in one time order
and running ``last`` values carry the right side's rows to the left's.  The
next row is found by the descending order, so both directions are linear.

A key may hold a large part of all rows.  With ``bucket`` the time of a key is
cut into stretches that are partitions of their own; the last and the first
right row of each are carried into the stretches beside it, through a table of
one row a stretch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _struct(on: str, order: Sequence[str], values: Sequence[str]) -> Column:
    return F.struct(F.col(on).alias("t"), *(F.col(c).alias(f"o_{c}") for c in order), *(F.col(c).alias(c) for c in values))


def neighbours(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, values: Sequence[str], order: Sequence[str] = (), equal_is_prev: bool = True, equal_is_next: bool = True, bucket: int | None = None) -> DataFrame:
    """``left`` with ``_prev`` and ``_next``: structs (t, order..., values...) of the right rows around it.

    ``order`` settles equal times on the right: the last of them is the
    previous row, the first of them the next one.
    """
    by = list(by)
    r = right.select(*by, F.col(on), _struct(on, order, values).alias("_r"), *([F.floor(F.col(on) / bucket).alias("_b")] if bucket else []))
    l_cols = left.columns
    one = left.select(*by, F.col(on), F.struct(*l_cols).alias("_l"), *([F.floor(F.col(on) / bucket).alias("_b")] if bucket else []))
    part = by + (["_b"] if bucket else [])
    if bucket:
        ends = r.groupBy(*part).agg(F.max("_r").alias("hi"), F.min("_r").alias("lo"))
        spine = one.select(*part).distinct().join(ends, part, "full")
        w = Window.partitionBy(*by).orderBy("_b")
        back = Window.partitionBy(*by).orderBy(F.desc("_b"))
        before = F.last("hi", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        behind = F.last("lo", True).over(back.rowsBetween(Window.unboundedPreceding, -1))
        ends = spine.select(*part, before.alias("_before"), behind.alias("_behind"))
        carried = ends.select(*part, F.explode(F.array("_before", "_behind")).alias("_r")).filter("_r IS NOT NULL")
        r = r.unionByName(carried.select(*by, F.col("_r.t").alias(on), "_r", "_b"))
    null_l, null_r = F.lit(None).cast(one.schema["_l"].dataType), F.lit(None).cast(r.schema["_r"].dataType)
    both = one.withColumn("_r", null_r).unionByName(r.withColumn("_l", null_l))
    is_left = F.col("_l").isNotNull().cast("int")
    asc = Window.partitionBy(*part).orderBy(on, is_left if equal_is_prev else -is_left, "_r").rowsBetween(Window.unboundedPreceding, 0)
    desc = Window.partitionBy(*part).orderBy(F.desc(on), is_left if equal_is_next else -is_left, F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_prev", F.last("_r", True).over(asc)).withColumn("_next", F.last("_r", True).over(desc))
    return seen.filter("_l IS NOT NULL").select("_l.*", "_prev", "_next")


def _spread(df: DataFrame, pick: str, columns: list[str], values: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*columns, F.col(f"{pick}.t").alias(f"{prefix}t"), *(F.col(f"{pick}.{v}").alias(f"{prefix}{v}") for v in values))


def asof_prev(left, right, by, on, values, prefix="r_", order=(), strict=False, bucket=None) -> DataFrame:
    """Last right row at or before (strict: before) each left row; nulls if there is none."""
    n = neighbours(left, right, by, on, values, order, equal_is_prev=not strict, bucket=bucket)
    return _spread(n, "_prev", left.columns, values, prefix)


def asof_next(left, right, by, on, values, prefix="r_", order=(), strict=True, bucket=None) -> DataFrame:
    """First right row after (not strict: at or after) each left row."""
    n = neighbours(left, right, by, on, values, order, equal_is_next=not strict, bucket=bucket)
    return _spread(n, "_next", left.columns, values, prefix)


def asof_nearest(left, right, by, on, values, prefix="r_", order=(), tolerance=None, tie="later", inclusive=True, bucket=None) -> DataFrame:
    """Nearest right row; ties go to the ``later`` or ``earlier`` one; beyond ``tolerance`` none."""
    n = neighbours(left, right, by, on, values, order, bucket=bucket)
    before, after = F.col(on) - F.col("_prev.t"), F.col("_next.t") - F.col(on)
    use_prev = F.col("_next").isNull() | (before < after) if tie == "later" else F.col("_next").isNull() | (before <= after)
    n = n.withColumn("_near", F.when(F.col("_prev").isNull(), F.col("_next")).when(use_prev, F.col("_prev")).otherwise(F.col("_next")))
    if tolerance is not None:
        far = F.abs(F.col("_near.t") - F.col(on))
        n = n.withColumn("_near", F.when(far <= tolerance if inclusive else far < tolerance, F.col("_near")))
    return _spread(n, "_near", left.columns, values, prefix)


def nearest_monotone(left, right, by, on, value, arrival=None, order=(), expire=None, prefix="r_", bucket=None) -> DataFrame:
    """Nearest right row (ties: the earliest) that is never before the one taken last.

    Left rows are taken in the order of ``arrival`` (columns; their time and
    ``order`` by default), in which times may go back.  Behind the row taken last
    the nearest one is either the nearest of all or that row itself, so what is
    taken is the greatest nearest row so far: a running maximum, and no search.
    With ``expire`` right rows that much older than the left one don't count; a
    left row for which none is left gets nulls.
    """
    by, arrival = list(by), list(arrival or [on, *(c for c in order if c in left.columns)])
    first = right.groupBy(*by, on).agg(F.min(F.struct(*(F.col(c).alias(f"o_{c}") for c in order), F.col(value).alias(value))).alias("_v")).select(*by, on, F.col(f"_v.{value}").alias(value))
    n = neighbours(left, first, by, on, [value], bucket=bucket)
    ok = F.col("_prev").isNotNull() if expire is None else F.col("_prev.t") >= F.col(on) - expire
    use_prev = ok & (F.col("_next").isNull() | (F.col(on) - F.col("_prev.t") <= F.col("_next.t") - F.col(on)))
    n = n.withColumn("_near", F.when(use_prev, F.col("_prev")).otherwise(F.col("_next")))
    so_far = Window.partitionBy(*by).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, 0)
    n = n.withColumn("_near", F.when(F.col("_near").isNotNull(), F.max("_near").over(so_far)))
    return _spread(n, "_near", left.columns, [value], prefix)


def align_streams(base: DataFrame, near: dict[str, DataFrame], after: dict[str, DataFrame], by: Sequence[str], on: str, value: str, tolerance: int, order: Sequence[str] = (), bucket: int | None = None) -> DataFrame:
    """Frames of one clock: to each base row the nearest row of every ``near`` stream
    within the tolerance, then the next row of every ``after`` stream past the
    latest of them.  A row that misses any stream is dropped.
    """
    out = base
    for name, stream in near.items():
        out = asof_nearest(out, stream, by, on, [value], f"{name}_", order, tolerance, bucket=bucket).filter(F.col(f"{name}_t").isNotNull())
    if after:
        latest = F.greatest(F.col(on), *(F.col(f"{n}_t") for n in near)) if near else F.col(on)
        out = out.withColumn("_base", F.col(on)).withColumn(on, latest)
        for name, stream in after.items():
            out = asof_next(out, stream, by, on, [value], f"{name}_", order, bucket=bucket).filter(F.col(f"{name}_t").isNotNull())
        out = out.withColumn("sync_t", F.col(on)).withColumn(on, F.col("_base")).drop("_base")
    return out


def asof_chunk(left, right, by, on, value, delay: int, points: int, order=(), bucket=None) -> DataFrame:
    """Values nearest to ``points`` times spread over ``delay`` behind each row, as ``chunk``."""
    ids = left.columns
    offsets = F.sequence(F.lit(1), F.lit(points))
    at = left.withColumn("_base", F.col(on)).withColumn("_i", F.explode(offsets)).withColumn(on, F.col("_base") + F.floor(F.lit(delay) * F.col("_i") / points).cast("long"))
    found = asof_nearest(at, right, by, on, [value], "_c_", order, bucket=bucket).withColumn(on, F.col("_base"))
    steps = found.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("_i", F.col(f"_c_{value}").alias("v")))).alias("s"))
    return steps.select(*ids, F.col("s.v").alias("chunk"))


def latest_sync(streams: dict[str, DataFrame], by: Sequence[str], on: str, value: str) -> DataFrame:
    """One frame a key: the least of the streams' newest times, and of each stream its first row from then on."""
    newest = None
    for s in streams.values():
        top = s.groupBy(*by).agg(F.max(on).alias("_m"))
        newest = top if newest is None else newest.join(top.withColumnRenamed("_m", "_n"), list(by)).withColumn("_m", F.least("_m", "_n")).drop("_n")
    out = newest.withColumnRenamed("_m", "sync_t")
    for name, s in streams.items():
        first = s.join(newest, list(by)).filter(F.col(on) >= F.col("_m")).groupBy(*by).agg(F.min(F.struct(on, value)).alias("_f"))
        out = out.join(first.select(*by, F.col(f"_f.{on}").alias(f"{name}_t"), F.col(f"_f.{value}").alias(f"{name}_{value}")), list(by))
    return out


def zip_by_position(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, value: str, order: Sequence[str] = ()) -> DataFrame:
    """The i-th of one side with the i-th of the other, as long as the shorter; their mean time."""
    w = Window.partitionBy(*by).orderBy(on, *order)
    a = left.select(*by, F.row_number().over(w).alias("rn"), F.col(on).alias("a_t"), F.col(value).alias("a_value"))
    b = right.select(*by, F.row_number().over(w).alias("rn"), F.col(on).alias("b_t"), F.col(value).alias("b_value"))
    return a.join(b, [*by, "rn"]).withColumn("mean_t", (F.col("a_t") + F.col("b_t")) / 2)


def synced_pair(targets: DataFrame, left: DataFrame, right: DataFrame, by, on, value: str, tolerance, order=(), bucket=None) -> DataFrame:
    """Both arms' nearest rows: their mean time and greatest difference, or why there is no pair."""
    a = asof_nearest(targets, left, by, on, [value], "l_", order=order, tolerance=tolerance, bucket=bucket)
    both = asof_nearest(a, right, by, on, [value], "r_", order=order, tolerance=tolerance, bucket=bucket)
    none = F.when(F.col("l_t").isNull() & F.col("r_t").isNull(), "no arm").when(F.col("l_t").isNull(), "no left arm").when(F.col("r_t").isNull(), "no right arm")
    return both.withColumn("error", none).withColumn("mean_t", (F.col("l_t") + F.col("r_t")) / 2).withColumn("max_diff", F.greatest(F.abs(F.col("l_t") - F.col(on)), F.abs(F.col("r_t") - F.col(on))))


def base_clock(rows: DataFrame, by, stream: str, skip: str = "depth") -> DataFrame:
    """The stream with the fewest rows of each group, without those whose name holds ``skip``; the first by name if tied."""
    n = rows.filter(~F.col(stream).contains(skip)).groupBy(*by, stream).agg(F.count(F.lit(1)).alias("n_rows"))
    return n.groupBy(*by).agg(F.min(F.struct("n_rows", stream)).alias("_b")).select(*by, F.col(f"_b.{stream}").alias("base"), "_b.n_rows")
