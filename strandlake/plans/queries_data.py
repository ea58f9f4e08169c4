"""Queries over vectors, statistics, datasets, tasks and strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rotation, scalar
from ..functions import vector as V
from ..operators import edit, filters, histograms, stats
from .catalogue import events, query, r6, table

_X = "x AS (SELECT vec_id, label, unnest(range(len(embedding))) AS dim, unnest(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS x FROM embeddings)"
_STAT_COLS = ("min", "max", "mean", "std", "q01", "q10", "q50", "q90", "q99")
_STATS = "min(x) AS min, max(x) AS max, avg(x) AS mean, stddev_pop(x) AS std, count(*) AS count, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.1) AS q10, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.9) AS q90, quantile_cont(x, 0.99) AS q99"
#: The same statistics by bins of a width that is a power of two, at most 10,000 of them.
_MOST = "greatest(abs(lo), abs(hi))"
_BIN_QUANTILES = ", ".join(f"arg_min(CASE WHEN bin = f THEN lo ELSE low + (CAST({q} AS DOUBLE) * n - (c - m)) / m * (high - low) END, bin) FILTER (WHERE c >= CAST({q} AS DOUBLE) * n) AS {name}" for name, q in stats.QUANTILES.items())
_BIN_STATS = f"""e0 AS (SELECT dim, min(x) AS lo, max(x) AS hi, avg(x) AS mean, stddev_pop(x) AS std, count(*) AS n FROM x GROUP BY dim),
e1 AS (SELECT *, CAST(greatest(-1000, CASE WHEN hi > lo THEN floor(log2((hi - lo) / 10000)) - 1 ELSE -1000 END, CASE WHEN {_MOST} > 0 THEN floor(log2({_MOST})) - 53 ELSE -1000 END) AS INTEGER) AS k FROM e0),
e2 AS (SELECT *, pow(2.0, list_filter(range(k, k + 5), lambda j: floor(hi / pow(2.0, j)) - floor(lo / pow(2.0, j)) < 10000 AND {_MOST} / pow(2.0, j) < 4503599627370496)[1]) AS w FROM e1),
e3 AS (SELECT x.dim, w, lo, hi, n, floor(x / w) AS bin, count(*) AS m FROM x JOIN e2 USING (dim) GROUP BY ALL),
e4 AS (SELECT *, sum(m) OVER (PARTITION BY dim ORDER BY bin) AS c, min(bin) OVER (PARTITION BY dim) AS f, greatest(bin * w, lo) AS low, least((bin + 1) * w, hi) AS high FROM e3),
e5 AS (SELECT dim, {_BIN_QUANTILES} FROM e4 GROUP BY dim),
s AS (SELECT dim, lo AS min, hi AS max, mean, std, n AS count, q01, q10, q50, q90, q99 FROM e0 JOIN e5 USING (dim))"""
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in _STAT_COLS)


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", V.doubles(F.col("embedding")).alias("v"))


def _rounded(df, *keys):
    return df.select(*keys, F.col("dim").cast("long").alias("dim"), "count", *(r6(c).alias(c) for c in _STAT_COLS if c in df.columns))


def _long(df, col, *keys):
    """Vectors as rows (keys, dim, value)."""
    return df.select(*keys, F.posexplode(col).alias("dim", "value")).withColumn("dim", F.col("dim").cast("long")).withColumn("value", r6("value"))


# -- statistics ---------------------------------------------------------------------------------


@query(f"WITH {_X}, s AS (SELECT dim, {_STATS} FROM x GROUP BY dim) SELECT dim, count, {_ROUNDED} FROM s")
def vector_stats(spark, sf):
    return _rounded(stats.vector_stats(_vectors(spark, sf), "v", method="exact"))


@query(f"WITH {_X}, s AS (SELECT dim, {_STATS} FROM x GROUP BY dim) SELECT dim, count, {_ROUNDED} FROM s")
def exact_vector_stats(spark, sf):
    return _rounded(stats.vector_stats(_vectors(spark, sf), "v", method="exact"))


@query(f"WITH {_X}, {_BIN_STATS} SELECT dim, count, {_ROUNDED} FROM s")
def merged_summaries(spark, sf):
    """Summaries of each label, merged to one of all: the same as a summary of all rows."""
    by_label = histograms.merged(histograms.summaries(_vectors(spark, sf), "v", ["label"]), ["label"])
    return _rounded(histograms.statistics(histograms.merged(by_label.drop("label")), stats.QUANTILES))


@query(f"""WITH {_X}, {_BIN_STATS.rpartition("e5 AS")[0].rstrip().rstrip(",")} SELECT dim, CAST(bin AS BIGINT) AS bin, CAST(m AS BIGINT) AS n, w AS width FROM e4""")
def summary_bins(spark, sf):
    s = histograms.merged(histograms.summaries(_vectors(spark, sf), "v"))
    return s.select(F.col("dim").cast("long").alias("dim"), F.inline("bins"), F.expr("pow(2D, scale)").alias("width"))


@query(f"WITH {_X}, s AS (SELECT label, dim, {_STATS} FROM x GROUP BY label, dim) SELECT label, dim, count, {_ROUNDED} FROM s")
def episode_stats(spark, sf):
    return _rounded(stats.vector_stats(_vectors(spark, sf), "v", ["label"]), "label")


_MERGED = ", ".join(f"round(sum(count * {q}) / sum(count), 6) AS {q}" for q in ("q01", "q10", "q50", "q90", "q99"))


@query(f"""WITH {_X}, s AS (SELECT label, dim, {_STATS} FROM x GROUP BY label, dim)
SELECT dim, CAST(sum(count) AS BIGINT) AS count, round(min(min), 6) AS min, round(max(max), 6) AS max, round(sum(count * mean) / sum(count), 6) AS mean,
round(sqrt(greatest(0, sum(count * (std * std + mean * mean)) / sum(count) - pow(sum(count * mean) / sum(count), 2))), 6) AS std, {_MERGED} FROM s GROUP BY dim""")
def merge_stats(spark, sf):
    return _rounded(stats.merge_stats(stats.vector_stats(_vectors(spark, sf), "v", ["label"])))


@query(f"""WITH {_X}, s AS (SELECT label, dim, {_STATS} FROM x GROUP BY label, dim)
SELECT dim, CAST(sum(count) AS BIGINT) AS count, round(min(min), 6) AS min, round(max(max), 6) AS max, round(sum(count * mean) / sum(count), 6) AS mean, round(sqrt(sum(count * std * std) / sum(count)), 6) AS std FROM s GROUP BY dim""")
def legacy_merge_stats(spark, sf):
    return _rounded(stats.merge_stats_legacy(stats.vector_stats(_vectors(spark, sf), "v", ["label"])))


@query(f"""WITH {_X}, l AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM x GROUP BY dim), b AS (SELECT dim, least(9, floor((x - lo) / CASE WHEN hi > lo THEN (hi - lo) / 10 ELSE 1 END)) AS bin FROM x JOIN l USING (dim))
SELECT dim, CAST(bin AS INTEGER) AS bin, count(*) AS n FROM b GROUP BY ALL""")
def vector_histogram(spark, sf):
    return stats.histogram(_vectors(spark, sf), "v", 10).select(F.col("dim").cast("long").alias("dim"), "bin", "n")


@query(f"""WITH {_X}, l AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM x GROUP BY dim), b AS (SELECT dim, least(9, floor((x - lo) / ((hi - lo) / 10))) AS bin, lo, (hi - lo) / 10 AS st FROM x JOIN l USING (dim)),
h AS (SELECT dim, bin, lo + bin * st AS low, st, count(*) AS n FROM b GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY dim ORDER BY bin) AS c, sum(n) OVER (PARTITION BY dim) * 0.5 AS target FROM h)
SELECT dim, round(CASE WHEN c = n THEN low ELSE low + (target - (c - n)) / n * st END, 6) AS quantile FROM c WHERE c >= target QUALIFY row_number() OVER (PARTITION BY dim ORDER BY bin) = 1""")
def histogram_quantile(spark, sf):
    h = stats.histogram(_vectors(spark, sf), "v", 10)
    return stats.histogram_quantile(h, 0.5).select(F.col("dim").cast("long").alias("dim"), r6("quantile").alias("quantile"))


@query(f"WITH {_X} SELECT dim, round(min(x), 6) AS quantile FROM x GROUP BY dim")
def histogram_quantile_of_first_bin(spark, sf):
    """A quantile that the first bin reaches is its edge."""
    h = stats.histogram(_vectors(spark, sf), "v", 4)
    return stats.histogram_quantile(h, 0.0001).select(F.col("dim").cast("long").alias("dim"), r6("quantile").alias("quantile"))


@query("""SELECT user_id, t.max_value, count(*) AS n_near FROM events JOIN (SELECT user_id, max(value) AS max_value FROM events GROUP BY user_id) t USING (user_id) WHERE abs(value - max_value) <= 10 GROUP BY ALL""")
def max_and_count(spark, sf):
    return stats.max_and_near(events(spark, sf), ["user_id"], "value", 10.0)


_EXACT_STATS = f"s AS (SELECT dim, {_STATS} FROM x GROUP BY dim)"


def _norm_sql(a: str, b: str, expr: str, of: str = _BIN_STATS) -> str:
    return f"WITH {_X}, {of}, n AS (SELECT vec_id, dim, x, {a} AS a, {b} AS b FROM x JOIN s USING (dim)) SELECT vec_id, dim, round({expr}, 6) AS value FROM n"


def _normalised(spark, sf, mode, method=None):
    v = _vectors(spark, sf)
    a, b = stats.MODES[mode]
    joined = stats.with_stats(v, stats.vector_stats(v, "v", method=method))
    return joined.withColumn("n", stats.normalise(F.col("v"), F.col(a), F.col(b), mode)), a, b


_RANGE = "2 * (x - a) / CASE WHEN b = a THEN 0.000001 ELSE b - a END - 1"


@query(_norm_sql("mean", "std", "(x - a) / (b + 0.000001)"))
def normalize_zscore(spark, sf):
    return _long(_normalised(spark, sf, "mean_std")[0], "n", "vec_id")


@query(_norm_sql("min", "max", _RANGE))
def normalize_minmax(spark, sf):
    return _long(_normalised(spark, sf, "min_max")[0], "n", "vec_id")


@query(_norm_sql("q01", "q99", _RANGE, _EXACT_STATS))
def normalize_q01_q99(spark, sf):
    return _long(_normalised(spark, sf, "quantiles", "exact")[0], "n", "vec_id")


@query(_norm_sql("q10", "q90", _RANGE, _EXACT_STATS))
def normalize_q10_q90(spark, sf):
    return _long(_normalised(spark, sf, "quantile10", "exact")[0], "n", "vec_id")


@query(_norm_sql("q01", "q99", "x"))
def unnormalize(spark, sf):
    n, a, b = _normalised(spark, sf, "quantiles")
    return _long(n.withColumn("u", stats.unnormalise(F.col("n"), F.col(a), F.col(b), "quantiles")), "u", "vec_id")


# -- vectors -----------------------------------------------------------------------------------


_MASK = V.bool_mask(4, -2, 4)


@query("""WITH s AS (SELECT vec_id, list_transform(embedding[1:10], lambda v: CAST(v AS DOUBLE)) AS a, list_transform(embedding[11:20], lambda v: CAST(v AS DOUBLE)) AS b FROM embeddings)
SELECT vec_id, i AS dim, round(CASE WHEN i < 4 OR i >= 6 THEN a[i + 1] - b[i + 1] ELSE a[i + 1] END, 6) AS value FROM s, (SELECT unnest(range(10)) AS i)""")
def delta_actions(spark, sf):
    v = _vectors(spark, sf).withColumn("d", V.delta_actions(F.array(F.slice("v", 1, 10)), F.slice("v", 11, 10), _MASK))
    return _long(v, F.get("d", F.lit(0)), "vec_id")


@query("""WITH s AS (SELECT vec_id, list_transform(embedding[1:10], lambda v: CAST(v AS DOUBLE)) AS a FROM embeddings) SELECT vec_id, i AS dim, round(a[i + 1], 6) AS value FROM s, (SELECT unnest(range(10)) AS i)""")
def absolute_actions(spark, sf):
    """Back from delta actions."""
    state = F.slice("v", 11, 10)
    v = _vectors(spark, sf).withColumn("d", V.delta_actions(F.array(F.slice("v", 1, 10)), state, _MASK)).withColumn("a", V.absolute_actions(F.col("d"), state, _MASK))
    return _long(v, F.get("a", F.lit(0)), "vec_id")


@query("""SELECT vec_id, i AS dim, round(CASE WHEN i < 5 THEN CAST(embedding[i + 1] AS DOUBLE) ELSE 0 END, 6) AS value FROM embeddings, (SELECT unnest(range(8)) AS i)""")
def pad_to_dim(spark, sf):
    return _long(_vectors(spark, sf), V.pad_to(F.slice("v", 1, 5), 8), "vec_id")


@query("""SELECT vec_id, i AS dim, round(greatest(-0.1, least(0.1, CAST(embedding[i + 1] AS DOUBLE))), 6) AS value FROM embeddings, (SELECT unnest(range(64)) AS i)""")
def clip_vector(spark, sf):
    return _long(_vectors(spark, sf), V.clip(F.col("v"), -0.1, 0.1), "vec_id")


@query("""SELECT vec_id, i AS dim, CAST(greatest(-1, least(255, floor((CAST(embedding[i + 1] AS DOUBLE) * 4 + 1) * 128))) AS INTEGER) AS value FROM embeddings, (SELECT unnest(range(64)) AS i)""")
def state_digitize(spark, sf):
    d = V.digitize(V.scale(F.col("v"), 4.0))
    return _vectors(spark, sf).select("vec_id", F.posexplode(d).alias("dim", "value")).withColumn("dim", F.col("dim").cast("long"))


@query("""SELECT vec_id, i AS dim, round(CAST(embedding[7 * i + 1] AS DOUBLE), 6) AS value FROM embeddings, (SELECT unnest(range(10)) AS i)""")
def subsample_vector(spark, sf):
    return _long(_vectors(spark, sf), V.every_kth(F.col("v"), 7), "vec_id")


@query("""WITH q AS (SELECT vec_id, list_transform(embedding[1:4], lambda v: CAST(v AS DOUBLE)) AS q FROM embeddings), n AS (SELECT vec_id, q, sqrt(q[1] * q[1] + q[2] * q[2] + q[3] * q[3] + q[4] * q[4]) AS n FROM q),
w AS (SELECT vec_id, q[1] / n AS x, q[2] / n AS y, q[3] / n AS z, greatest(-1, least(1, q[4] / n)) AS w FROM n), d AS (SELECT *, sqrt(greatest(0, 1 - w * w)) AS den FROM w)
SELECT vec_id, round(CASE WHEN den <= 1e-10 THEN 0 ELSE x * 2 * acos(w) / den END, 6) AS rx, round(CASE WHEN den <= 1e-10 THEN 0 ELSE y * 2 * acos(w) / den END, 6) AS ry, round(CASE WHEN den <= 1e-10 THEN 0 ELSE z * 2 * acos(w) / den END, 6) AS rz FROM d""")
def quat_axis_angle(spark, sf):
    a = rotation.axis_angle(rotation.normalised(F.slice("v", 1, 4)))
    return _vectors(spark, sf).withColumn("r", a).select("vec_id", *(r6(F.get("r", F.lit(i))).alias(n) for i, n in enumerate(("rx", "ry", "rz"))))


@query("""WITH o AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS v FROM embeddings), p AS (SELECT *, lag(v) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM o)
SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(v, p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 6) AS distance FROM p WHERE p IS NOT NULL""")
def vector_step_distance(spark, sf):
    from pyspark.sql import Window

    v = _vectors(spark, sf).withColumn("p", F.lag("v").over(Window.partitionBy("label").orderBy("vec_id"))).filter("p IS NOT NULL")
    return v.select("vec_id", r6(V.distance(F.col("v"), F.col("p"))).alias("distance"))


# -- dataset edits ---------------------------------------------------------------------------------


_FRAMES = "f AS (SELECT conv_id AS episode_index, turn, role AS task, length(text) AS size FROM conversations)"


def _frames(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("episode_index"), "turn", F.col("role").alias("task"), F.length("text").cast("long").alias("size"))


@query(f"""WITH {_FRAMES}, n AS (SELECT episode_index, count(*) AS length FROM f GROUP BY episode_index), c AS (SELECT *, sum(length) OVER (ORDER BY episode_index) AS dataset_to_index FROM n)
SELECT episode_index, length, CAST(dataset_to_index - length AS BIGINT) AS dataset_from_index, CAST(dataset_to_index AS BIGINT) AS dataset_to_index FROM c""")
def episode_boundaries(spark, sf):
    return edit.episodes(_frames(spark, sf))


@query(f"""WITH {_FRAMES}, k AS (SELECT * FROM f WHERE episode_index % 3 <> 0), d AS (SELECT episode_index AS old, dense_rank() OVER (ORDER BY episode_index) - 1 AS episode_index, turn, row_number() OVER (PARTITION BY episode_index ORDER BY turn) - 1 AS frame_index, row_number() OVER (ORDER BY episode_index, turn) - 1 AS "index" FROM k) SELECT * FROM d""")
def delete_reindex(spark, sf):
    f = _frames(spark, sf)
    gone = f.filter("episode_index % 3 = 0").select("episode_index").distinct()
    return edit.delete_episodes(f.withColumn("old", F.col("episode_index")), gone, ["turn"]).select("old", "episode_index", "turn", "frame_index", "index")


@query(f"""WITH {_FRAMES}, a AS (SELECT 0 AS dataset_index, * FROM f WHERE episode_index < 50 UNION ALL SELECT 1, * FROM f WHERE episode_index >= 30),
i AS (SELECT *, dense_rank() OVER (ORDER BY dataset_index, episode_index) - 1 AS ep, row_number() OVER (ORDER BY dataset_index, episode_index, turn) - 1 AS idx FROM a),
t AS (SELECT task, row_number() OVER (ORDER BY min(idx)) - 1 AS task_index FROM i GROUP BY task)
SELECT dataset_index, ep AS episode_index, turn, idx AS "index", task_index FROM i JOIN t USING (task)""")
def merge_datasets(spark, sf):
    f = _frames(spark, sf)
    m = edit.merge([f.filter("episode_index < 50"), f.filter("episode_index >= 30")], ["turn"])
    return m.select("dataset_index", "episode_index", "turn", "index", "task_index")


@query(f"""WITH {_FRAMES}, e AS (SELECT DISTINCT episode_index, dense_rank() OVER (ORDER BY episode_index) - 1 AS n FROM f), c AS (SELECT count(*) AS total FROM e)
SELECT episode_index, CASE WHEN n < CAST(floor(total * 0.7) AS BIGINT) THEN 'train' WHEN n < CAST(floor(total * 0.7) AS BIGINT) + CAST(floor(total * 0.2) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM e, c""")
def split_fraction(spark, sf):
    f = edit.reindex(_frames(spark, sf).withColumn("old", F.col("episode_index")), ["turn"]).select("old", "episode_index").distinct()
    return edit.split(f, f.count(), {"train": 0.7, "val": 0.2, "test": 0.1}).select(F.col("old").alias("episode_index"), "split")


@query(f"""WITH {_FRAMES}, e AS (SELECT episode_index, arg_min(task, turn) AS own FROM f GROUP BY episode_index), c AS (SELECT episode_index, CASE WHEN episode_index % 10 = 0 THEN 'stack ' || (episode_index % 4) ELSE own END AS task FROM e)
SELECT episode_index, task, dense_rank() OVER (ORDER BY task) - 1 AS task_index FROM c""")
def modify_tasks(spark, sf):
    eps = _frames(spark, sf).groupBy("episode_index").agg(F.array(F.min_by("task", "turn")).alias("tasks"))
    over = eps.filter("episode_index % 10 = 0").select("episode_index", F.concat(F.lit("stack "), (F.col("episode_index") % 4).cast("string")).alias("task"))
    return edit.modify_tasks(eps, over).select("episode_index", "task", "task_index")


@query(f"WITH {_FRAMES} SELECT episode_index, turn, size * 2 AS double_size FROM f")
def feature_add_drop(spark, sf):
    return edit.modify_features(_frames(spark, sf), {"double_size": F.col("size") * 2}, ["size", "task"])


@query(f"""WITH {_FRAMES}, n AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY turn) - 1 AS frame_index FROM f) SELECT episode_index, turn, frame_index, round(frame_index / 30.0, 5) AS timestamp FROM n""")
def add_frames(spark, sf):
    f = edit.add_frames(_frames(spark, sf), ["turn"], 30.0)
    return f.select("episode_index", "turn", "frame_index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"))


@query(f"""WITH {_FRAMES}, n AS (SELECT episode_index, count(*) AS length, episode_index // 20 AS file FROM f GROUP BY episode_index), c AS (SELECT *, sum(length) OVER (PARTITION BY file ORDER BY episode_index) AS s FROM n)
SELECT episode_index, file, round((s - length) / 30.0, 6) AS from_timestamp, round(s / 30.0, 6) AS to_timestamp FROM c""")
def video_reindex(spark, sf):
    n = _frames(spark, sf).groupBy("episode_index").agg(F.count(F.lit(1)).alias("length")).withColumn("file", F.floor(F.col("episode_index") / 20))
    v = edit.video_offsets(n, 30.0, ["file"])
    return v.select("episode_index", "file", r6("from_timestamp").alias("from_timestamp"), r6("to_timestamp").alias("to_timestamp"))


@query(f"WITH {_FRAMES}, n AS (SELECT count(DISTINCT episode_index) AS e, count(*) AS f FROM f) SELECT e AS total_episodes, f AS total_frames, '0:' || e AS split FROM n")
def dataset_totals(spark, sf):
    return edit.totals(edit.episodes(_frames(spark, sf)))


@query("""SELECT c_custkey, n_name AS task, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def task_lookup(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    tasks = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("task_index"), F.col("n_name").alias("task"), F.col("r_name").alias("region"))
    named = edit.task_text(c.withColumn("task_index", F.col("c_nationkey")), tasks)
    return named.join(tasks.select("task_index", "region"), "task_index").select("c_custkey", "task", "region")


@query("""WITH d AS (SELECT n_name, n_nationkey + 100 AS dst FROM nation) SELECT c_custkey, dst AS task_index FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN d USING (n_name)""")
def task_remap(spark, sf):
    n = table(spark, sf, "nation")
    src = n.select(F.col("n_nationkey").alias("task_index"), F.col("n_name").alias("task"))
    dst = n.select(F.col("n_name").alias("task"), (F.col("n_nationkey") + 100).alias("task_index"))
    f = edit.task_text(table(spark, sf, "customer").withColumn("task_index", F.col("c_nationkey")), src)
    return edit.with_tasks(f, dst).select("c_custkey", "task_index")


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey, 'X', o_totalprice * 2 FROM orders WHERE o_orderkey % 7 = 0""")
def manifest_upsert(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter("o_orderkey % 7 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return edit.upsert(o, new, ["o_orderkey"])


@query("""SELECT c_custkey FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders))""")
def manifest_clean(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    valid = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return edit.clean(c, c.filter("c_custkey % 3 = 0"), valid, "c_custkey")


@query("""SELECT l.l_returnflag, l.l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc FROM lineitem l GROUP BY ALL""")
def frame_report(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), r6(F.avg("l_discount")).alias("avg_disc"))


@query("""SELECT o_orderpriority, n_name, count(*) AS n, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_quantity > 25 GROUP BY ALL""")
def star_join(spark, sf):
    li, o, c, n = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    j = li.filter("l_quantity > 25").join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("o_orderpriority", "n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("value"))


# -- strings, times, documents ------------------------------------------------------------------------


@query("""WITH p AS (SELECT item_id, translate(trim(text), '_' || chr(10), '  ') AS p FROM benchmark) SELECT item_id, p AS prompt, 'Task: ' || translate(trim(lower(text)), '_' || chr(10), '  ') || ', State: 1 2;' || chr(10) AS full_prompt FROM p JOIN benchmark USING (item_id)""")
def prompt_clean(spark, sf):
    b = table(spark, sf, "benchmark")
    return b.select("item_id", scalar.clean_prompt(F.col("text")).alias("prompt"), scalar.prompt_with_state(F.col("text"), F.array(F.lit(1), F.lit(2))).alias("full_prompt"))


@query("""WITH p AS (SELECT page_id, CASE WHEN contains(url, 'http') THEN string_split(substr(url, strpos(url, 'http') + 4), '.') END AS d FROM pages) SELECT page_id, CASE WHEN len(d) > 3 THEN array_to_string(d[2:len(d) - 2], ' ') ELSE 'todo' END AS task FROM p""")
def task_from_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", scalar.task_of_path(F.col("url"), "http").alias("task"))


@query("""SELECT event_id, CAST(epoch_us(ts) * 1000 // 1000000000 AS VARCHAR) || '.' || lpad(CAST(epoch_us(ts) * 1000 % 1000000000 AS VARCHAR), 9, '0') AS stamp FROM events""")
def ns_string(spark, sf):
    return events(spark, sf).select("event_id", scalar.ns_string(F.col("t") * 1000).alias("stamp"))


@query("""SELECT doc_id, CASE WHEN n_chars * 100000.0 / 1073741824 >= 1 THEN printf('%.1fG', n_chars * 100000.0 / 1073741824) ELSE printf('%.1fMB', n_chars * 100000.0 / 1048576) END AS size FROM documents""")
def human_size(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalar.human_size(F.col("n_chars") * F.lit(100000)).alias("size"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, printf('chunk-%03d', event_id // 1000) AS chunk FROM events""")
def json_props(spark, sf):
    e = table(spark, sf, "events").withColumn("p", F.from_json("props", "k int"))
    return e.select("event_id", "p.k", scalar.chunk_name(F.col("event_id")).alias("chunk"))


@query("""SELECT o_orderkey, strftime(o_orderdate + INTERVAL 90 SECOND, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS ends FROM orders""")
def manifest_times(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", scalar.manifest_time(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), None, F.lit(90)).alias("ends"))


@query("""SELECT d.doc_id, d.lang FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 AND l.toxic = 0""")
def success_filter(spark, sf):
    d, ok = table(spark, sf, "documents"), table(spark, sf, "labels").filter("quality = 1 AND toxic = 0")
    return d.join(ok.select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang")


@query("""SELECT page_id, url FROM pages WHERE regexp_full_match(url, '.*example\\.com/(fr|en)/.*')""")
def path_filter(spark, sf):
    p = table(spark, sf, "pages")
    return p.filter(filters.full_match(F.col("url"), r".*example\.com/(fr|en)/.*")).select("page_id", "url")


@query("""SELECT CAST(i AS BIGINT) AS "rank" FROM range(200) r(i) WHERE i NOT IN (SELECT o_orderkey % 150 FROM orders)""")
def missing_workers(spark, sf):
    done = table(spark, sf, "orders").select((F.col("o_orderkey") % 150).alias("rank"))
    return edit.missing_workers(spark, 200, done)


@query("""SELECT p_partkey, CAST(len(list_filter([p_size, p_size * 2, 7], lambda v: abs(v - 14.0) <= 0.000001)) > 0 AS BOOLEAN) AS found FROM part""")
def float_in_list(spark, sf):
    a = F.array(F.col("p_size").cast("double"), F.col("p_size") * 2.0, F.lit(7.0))
    return table(spark, sf, "part").select("p_partkey", V.within(a, F.lit(14.0)).alias("found"))


# -- streaming ----------------------------------------------------------------------------------------


@query(f"WITH {_X} SELECT dim, count(*) AS count, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM x GROUP BY dim")
def stream_stats(spark, sf):
    """The incremental statistics of a stream, after all of its files."""
    from ..streaming import live, local

    source = local.as_stream(spark, table(spark, sf, "embeddings").select("vec_id", V.doubles(F.col("embedding")).alias("v")), 4)
    return _rounded(live.run_once(live.stats(source, "v"), local.name("stats"), "complete", local.folder()))


@query("""SELECT l.user_id, l.event_id AS l_event_id, r.event_id AS r_event_id FROM events l JOIN events r ON l.user_id = r.user_id AND l.event_type = 'click' AND r.event_type = 'view' AND r.ts BETWEEN l.ts - INTERVAL 2 HOUR AND l.ts + INTERVAL 2 HOUR""")
def stream_align(spark, sf):
    """Two streams joined within two hours, equal to the batch join."""
    from ..streaming import live, local

    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    a, b = (local.as_stream(spark, e.filter(F.col("event_type") == k).drop("event_type"), 1) for k in ("click", "view"))
    out = live.run_once(live.aligned(a, b, "user_id", "2 HOURS", "60 days"), local.name("align"), "append", local.folder())
    return out.select("user_id", "l_event_id", "r_event_id")


# -- records ------------------------------------------------------------------------------------------


@query("""WITH $EVENTS, q AS (SELECT event_id, user_id, t FROM e WHERE event_type = 'click'), p AS (SELECT q.event_id, r.t AS r_t, r.value AS r_value, row_number() OVER (PARTITION BY q.event_id ORDER BY abs(r.t - q.t), r.t DESC) AS rn FROM q JOIN (SELECT * FROM e WHERE event_type = 'view') r USING (user_id))
SELECT q.event_id, r_t, r_value, abs(r_t - t) > 3600000000 AS is_pad FROM q LEFT JOIN (SELECT * FROM p WHERE rn = 1) p USING (event_id)""")
def nearest_pad_mask(spark, sf):
    from ..operators import records

    e = events(spark, sf)
    q = e.filter("event_type = 'click'").select("event_id", "user_id", "t")
    r = e.filter("event_type = 'view'").select("user_id", "t", "value")
    return records.nearest_with_mask(q, r, ["user_id"], "t", "value", 3_600_000_000).select("event_id", "r_t", "r_value", "is_pad")


@query("""SELECT conv_id AS episode_index, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS "order", role AS names, turn * 1.5e0 AS start_times, turn * 1.5e0 + 1 AS end_times, CAST(floor(turn * 1.5e0 * 30) AS BIGINT) AS start_frames, CAST(floor((turn * 1.5e0 + 1) * 30) AS BIGINT) AS end_frames FROM conversations""")
def subtask_annotations(spark, sf):
    """Stored on the episodes as arrays, and read back."""
    from ..operators import records

    c = table(spark, sf, "conversations")
    marks = c.select(F.col("conv_id").alias("episode_index"), (F.col("turn") * F.lit(1.5)).cast("double").alias("start"), (F.col("turn") * F.lit(1.5) + 1).cast("double").alias("end"), F.col("role").alias("name"))
    eps = marks.select("episode_index").distinct()
    return records.annotations(records.annotate(eps, marks, 30.0, "sparse"), "sparse")


@query("""WITH $EVENTS, n AS (SELECT event_id, user_id, t, CASE WHEN (row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1) % 4 = 0 THEN value END AS v FROM e),
p AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER a AS pt, last_value(v IGNORE NULLS) OVER a AS pv, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER b AS nt, first_value(v IGNORE NULLS) OVER b AS nv FROM n
  WINDOW a AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, pv + (nv - pv) * (t - pt) / nullif(nt - pt, 0), pv, nv), 4) AS progress FROM p""")
def strided_progress(spark, sf):
    from ..operators import records

    p = records.strided_progress(events(spark, sf), ["user_id"], "t", "value", 4, ["event_id"])
    return p.select("event_id", F.round("progress_filled", 4).alias("progress"))


@query("""WITH $EVENTS SELECT event_id, coalesce(lag(value, 5) OVER w, first_value(value) OVER w) AS value FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""")
def delayed_gripper(spark, sf):
    from ..operators import records

    return records.key_frames(events(spark, sf), ["user_id"], "t", "value", "delayed", ["event_id"]).select("event_id", "value")


@query("""WITH p AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(greatest(0, least(255, round_even(CAST(v AS DOUBLE) * 255 * 4, 0))) AS INTEGER)) AS p FROM embeddings)
SELECT vec_id, CASE WHEN len(list_filter(p, lambda x: x <= 20)) / 64.0 > 0.5 THEN 'black' WHEN len(list_filter(p, lambda x: x >= 230)) / 64.0 > 0.5 THEN 'white' END AS empty FROM p""")
def image_empty(spark, sf):
    from ..functions import image

    im = image.from_vector(V.scale(F.col("v"), 4.0), 8, 8)
    return _vectors(spark, sf).select("vec_id", image.empty(0.5)(im).alias("empty"))
