"""Queries over event streams: as-of joins, windows, runs, downsampling, folds, queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, filters, folds, quality, queues, sequence, weights
from .catalogue import BY, MINUTE, ON, ORDER, events, query, r6, topic

_PICK = "event_id", "user_id", "t"


def _click(spark, sf):
    return topic(spark, sf, "click").select(*_PICK)


def _view(spark, sf, kind="view"):
    return topic(spark, sf, kind).select("user_id", "t", "event_id", "value")


# -- as-of joins -------------------------------------------------------------------------


@query("""WITH $EVENTS SELECT l.event_id, l.user_id, l.t, r.t AS r_t, r.value AS r_value
FROM (SELECT * FROM e WHERE event_type = 'click') l ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'purchase') r ON l.user_id = r.user_id AND l.t < r.t""")
def asof_next(spark, sf):
    return asof.asof_next(_click(spark, sf), _view(spark, sf, "purchase"), BY, ON, ["value"], order=ORDER)


@query("""WITH $EVENTS SELECT l.event_id, l.user_id, l.t, r.t AS r_t, r.value AS r_value
FROM (SELECT * FROM e WHERE event_type = 'click') l ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') r ON l.user_id = r.user_id AND l.t >= r.t""")
def asof_prev(spark, sf):
    return asof.asof_prev(_click(spark, sf), _view(spark, sf), BY, ON, ["value"], order=ORDER)


@query("""WITH $EVENTS SELECT l.event_id, l.user_id, l.t, r.t AS r_t, r.value AS r_value
FROM (SELECT * FROM e WHERE event_type = 'click') l ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') r ON l.user_id = r.user_id AND l.t >= r.t""")
def asof_prev_bucketed(spark, sf):
    """The same with the time of a key cut into days that are partitions of their own."""
    return asof.asof_prev(_click(spark, sf), _view(spark, sf), BY, ON, ["value"], order=ORDER, bucket=1440 * MINUTE)


_NEAREST = """p AS (SELECT l.event_id, l.user_id, l.t, r.t AS r_t, r.value AS r_value, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.t - l.t), r.t DESC) AS rn
  FROM (SELECT * FROM e WHERE event_type = 'click') l JOIN (SELECT * FROM e WHERE event_type = 'view') r USING (user_id)),
n AS (SELECT l.event_id, l.user_id, l.t, p.r_t, p.r_value FROM (SELECT * FROM e WHERE event_type = 'click') l LEFT JOIN (SELECT * FROM p WHERE rn = 1) p USING (event_id))"""


@query(f"""WITH $EVENTS, {_NEAREST} SELECT event_id, user_id, t, CASE WHEN abs(r_t - t) <= {120 * MINUTE} THEN r_t END AS r_t, CASE WHEN abs(r_t - t) <= {120 * MINUTE} THEN r_value END AS r_value FROM n""")
def asof_nearest_tol(spark, sf):
    return asof.asof_nearest(_click(spark, sf), _view(spark, sf), BY, ON, ["value"], order=ORDER, tolerance=120 * MINUTE)


@query(f"WITH $EVENTS, {_NEAREST} SELECT * FROM n")
def asof_nearest_clamped(spark, sf):
    return asof.asof_nearest(_click(spark, sf), _view(spark, sf), BY, ON, ["value"], order=ORDER, bucket=2880 * MINUTE)


@query(f"""WITH $EVENTS, {_NEAREST},
s1 AS (SELECT event_id, user_id, t, r_t AS view_t, r_value AS view_value FROM n WHERE abs(r_t - t) <= {600 * MINUTE}),
q AS (SELECT s1.event_id, r.t AS error_t, r.value AS error_value, row_number() OVER (PARTITION BY s1.event_id ORDER BY abs(r.t - s1.t), r.t DESC) AS rn FROM s1 JOIN (SELECT * FROM e WHERE event_type = 'error') r USING (user_id)),
s2 AS (SELECT s1.*, error_t, error_value, greatest(s1.t, view_t, error_t) AS sync_t FROM s1 JOIN q USING (event_id) WHERE rn = 1 AND abs(error_t - t) <= {600 * MINUTE})
SELECT s2.event_id, s2.user_id, s2.t, view_t, view_value, error_t, error_value, r.t AS purchase_t, r.value AS purchase_value, sync_t
FROM s2 ASOF JOIN (SELECT * FROM e WHERE event_type = 'purchase') r ON s2.user_id = r.user_id AND s2.sync_t < r.t""")
def align_streams(spark, sf):
    return asof.align_streams(_click(spark, sf), {"view": _view(spark, sf), "error": _view(spark, sf, "error")}, {"purchase": _view(spark, sf, "purchase")}, BY, ON, "value", 600 * MINUTE, ORDER)


@query(f"""WITH $EVENTS, s AS (SELECT event_id, user_id, i, t + CAST(floor({360 * MINUTE}::BIGINT * i / 3) AS BIGINT) AS at FROM e, (SELECT unnest([1, 2, 3]) AS i) WHERE event_type = 'click'),
p AS (SELECT s.event_id, s.i, r.value, row_number() OVER (PARTITION BY s.event_id, s.i ORDER BY abs(r.t - s.at), r.t DESC) AS rn FROM s JOIN (SELECT * FROM e WHERE event_type = 'view') r USING (user_id)),
j AS (SELECT s.event_id, s.i, p.value FROM s LEFT JOIN (SELECT * FROM p WHERE rn = 1) p USING (event_id, i))
SELECT event_id, max(CASE WHEN i = 1 THEN value END) AS c1, max(CASE WHEN i = 2 THEN value END) AS c2, max(CASE WHEN i = 3 THEN value END) AS c3 FROM j GROUP BY event_id""")
def asof_shifted_chunk(spark, sf):
    c = asof.asof_chunk(_click(spark, sf), _view(spark, sf), BY, ON, "value", 360 * MINUTE, 3, ORDER)
    return c.select("event_id", *(F.get("chunk", F.lit(i)).alias(f"c{i + 1}") for i in range(3)))


@query("""WITH $EVENTS, m AS (SELECT user_id, event_type, max(t) AS m FROM e WHERE event_type IN ('view', 'click') GROUP BY ALL),
s AS (SELECT user_id, min(m) AS sync_t FROM m GROUP BY user_id HAVING count(*) = 2),
f AS (SELECT s.user_id, s.sync_t, e.event_type, min(e.t) AS t, arg_min(e.value, e.t) AS v FROM s JOIN e USING (user_id) WHERE e.t >= sync_t GROUP BY ALL)
SELECT a.user_id, a.sync_t, a.t AS view_t, a.v AS view_value, b.t AS click_t, b.v AS click_value FROM f a JOIN f b USING (user_id) WHERE a.event_type = 'view' AND b.event_type = 'click'""")
def latest_sync(spark, sf):
    return asof.latest_sync({"view": _view(spark, sf), "click": _view(spark, sf, "click")}, BY, ON, "value")


@query("""WITH $EVENTS, a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) AS rn FROM e WHERE event_type = 'view'),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) AS rn FROM e WHERE event_type = 'click')
SELECT user_id, CAST(rn AS INTEGER) AS rn, a.t AS a_t, a.value AS a_value, b.t AS b_t, b.value AS b_value, (a.t + b.t) / 2 AS mean_t FROM a JOIN b USING (user_id, rn)""")
def positional_zip(spark, sf):
    return asof.zip_by_position(_view(spark, sf), _view(spark, sf, "click"), BY, ON, "value", ORDER)


_NEAREST_FIRST = """n AS (SELECT c.*, r.t AS near_t, r.value AS near_value, row_number() OVER (PARTITION BY c.event_id ORDER BY abs(r.t - c.t), r.t, r.event_id) AS rn
FROM (SELECT * FROM e WHERE event_type = 'click') c LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') r ON c.user_id = r.user_id $EXPIRE),
f AS (SELECT *, max(near_t) OVER (PARTITION BY user_id ORDER BY $ARRIVAL ROWS UNBOUNDED PRECEDING) AS m FROM n WHERE rn = 1)
SELECT f.event_id, f.user_id, f.t, CASE WHEN near_t IS NOT NULL THEN m END AS r_t, CASE WHEN near_t IS NOT NULL THEN (SELECT arg_min(v.value, v.event_id) FROM e v WHERE v.event_type = 'view' AND v.user_id = f.user_id AND v.t = f.m) END AS r_value FROM f"""


@query("WITH $EVENTS, " + _NEAREST_FIRST.replace("$EXPIRE", "").replace("$ARRIVAL", "t, event_id"))
def asof_monotone(spark, sf):
    """Nearest that never goes back, in the order of time."""
    return asof.nearest_monotone(_click(spark, sf), _view(spark, sf), BY, ON, "value", order=ORDER)


@query("WITH $EVENTS, " + _NEAREST_FIRST.replace("$EXPIRE", f"AND r.t >= c.t - {600 * MINUTE}").replace("$ARRIVAL", f"t + event_id % 7 * {300 * MINUTE}, event_id"))
def asof_monotone_by_arrival(spark, sf):
    """The same for rows that come late, with right rows that expire after ten hours."""
    clicks = _click(spark, sf).withColumn("came", F.col("t") + F.col("event_id") % 7 * (300 * MINUTE))
    return asof.nearest_monotone(clicks, _view(spark, sf), BY, ON, "value", ["came", "event_id"], ORDER, 600 * MINUTE).drop("came")


# -- look-back and look-ahead ---------------------------------------------------------------


@query("""WITH $EVENTS SELECT event_id, value, coalesce(lead(value) OVER w, value) AS action FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""")
def next_action_shift(spark, sf):
    return sequence.next_value(events(spark, sf), BY, ON, "value", ORDER).select("event_id", "value", "action")


@query("""WITH $EVENTS, n AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS c FROM e),
d AS (SELECT n.event_id, d, n.rn + d < 1 OR n.rn + d > n.c AS pad, x.value FROM n, (SELECT unnest([-3, -1, 2]) AS d) JOIN n x ON x.user_id = n.user_id AND x.rn = least(greatest(n.rn + d, 1), n.c))
SELECT event_id, max(CASE WHEN d = -3 THEN value END) AS value_m3, bool_or(d = -3 AND pad) AS value_m3_is_pad, max(CASE WHEN d = -1 THEN value END) AS value_m1, bool_or(d = -1 AND pad) AS value_m1_is_pad, max(CASE WHEN d = 2 THEN value END) AS value_p2, bool_or(d = 2 AND pad) AS value_p2_is_pad FROM d GROUP BY event_id""")
def delta_window_pad(spark, sf):
    d = sequence.delta_windows(events(spark, sf), BY, ON, "value", [-3, -1, 2], ORDER)
    return d.select("event_id", *(c for c in d.columns if c.startswith("value_")))


@query("""WITH $EVENTS, n AS (SELECT *, lag(value) OVER w AS l1, lag(value, 3) OVER w AS l3, row_number() OVER w AS rn FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT event_id, CASE WHEN rn > 1 THEN l1 ELSE value END AS value_m1, rn <= 1 AS value_m1_is_pad, CASE WHEN rn > 3 THEN l3 WHEN rn > 1 THEN l1 ELSE value END AS value_m3, rn <= 3 AS value_m3_is_pad FROM n""")
def delta_window_last_seen(spark, sf):
    d = sequence.delta_windows_last_seen(events(spark, sf), BY, ON, "value", [-3, -1], ORDER)
    return d.select("event_id", *(c for c in d.columns if c.startswith("value_")))


@query("""WITH $EVENTS, n AS (SELECT event_id, value, lead(value, 1) OVER w AS a, lead(value, 2) OVER w AS b, lead(value, 3) OVER w AS c FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT event_id, value AS c0, coalesce(a, value) AS c1, coalesce(b, a, value) AS c2, coalesce(c, b, a, value) AS c3 FROM n""")
def action_chunk(spark, sf):
    c = sequence.action_chunks(events(spark, sf), BY, ON, "value", 4, ORDER)
    return c.select("event_id", *(F.get("chunk", F.lit(i)).alias(f"c{i}") for i in range(4)))


@query("""WITH $EVENTS, n AS (SELECT event_id, value, lead(value, 5) OVER w AS a, last_value(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT event_id, round(coalesce(a, z) - value, 6) AS delta FROM n""")
def lookahead_change(spark, sf):
    return sequence.lookahead_change(events(spark, sf), BY, ON, "value", 5, ORDER).select("event_id", r6("delta").alias("delta"))


@query("""WITH $EVENTS SELECT event_id, round((value - coalesce(lag(value) OVER w, value)) / 0.1, 6) AS v0, round((k - coalesce(lag(k) OVER w, k)) / 0.1, 6) AS v1 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""")
def joint_velocity(spark, sf):
    v = sequence.velocity(events(spark, sf).withColumn("state", F.array("value", "k")), BY, ON, "state", 0.1, ORDER)
    return v.select("event_id", r6(F.get("velocity", F.lit(0))).alias("v0"), r6(F.get("velocity", F.lit(1))).alias("v1"))


@query("""WITH $EVENTS, n AS (SELECT event_id, value, lead(value) OVER w AS nx, event_type = 'purchase' OR lead(1) OVER w IS NULL AS done FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT event_id, done, CASE WHEN done THEN value ELSE nx END AS next_state FROM n""")
def transitions(spark, sf):
    e = events(spark, sf).withColumn("flag", F.col("event_type") == "purchase")
    return sequence.transitions(e, BY, ON, "value", "flag", ORDER).select("event_id", "done", "next_state")


@query("""WITH $EVENTS SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) >= 50 AS truncated FROM e""")
def time_limit(spark, sf):
    return sequence.time_limit(events(spark, sf), BY, ON, 50, ORDER).select("event_id", "truncated")


@query("""WITH $EVENTS SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS mean FROM e""")
def sliding_mean(spark, sf):
    return sequence.sliding_mean(events(spark, sf), BY, ON, "value", 5, ORDER).select("event_id", r6("mean").alias("mean"))


@query("""WITH $EVENTS SELECT event_id, round(avg(value) OVER (PARTITION BY user_id), 6) AS mean FROM e""")
def chunk_mean(spark, sf):
    return sequence.chunk_mean(events(spark, sf), BY, "value").select("event_id", r6("mean").alias("mean"))


@query("""WITH $EVENTS SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM e""")
def hold_last(spark, sf):
    e = events(spark, sf).withColumn("command", F.when(F.col("event_type") == "click", F.col("value")))
    return sequence.hold_last(e, BY, ON, "command", ORDER).select("event_id", "held")


@query("""WITH $EVENTS, n AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i FROM e) SELECT event_id, i // 8 AS chunk_no, CAST(i % 8 AS INTEGER) AS step, i % 8 = 0 AS refill FROM n""")
def chunk_broker(spark, sf):
    return sequence.chunk_broker(events(spark, sf), BY, ON, 8, ORDER).select("event_id", "chunk_no", "step", "refill")


@query("""WITH $EVENTS, n AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i FROM e),
g AS (SELECT user_id, i // 10 AS chunk_no, list(value ORDER BY i) AS l FROM n GROUP BY ALL)
SELECT user_id, chunk_no, CAST(s AS INTEGER) AS step, coalesce(l[s + 1], l[len(l)]) AS value FROM g, (SELECT unnest(range(10)) AS s)""")
def replay_pad(spark, sf):
    c = sequence.replay_chunks(events(spark, sf), BY, ON, "value", 10, ORDER)
    return c.select("user_id", "chunk_no", F.posexplode("chunk").alias("step", "value"))


@query("""WITH $EVENTS, n AS (SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ep FROM e) SELECT event_id, CAST(ep AS BIGINT) AS episode FROM n""")
def episodes_by_flag(spark, sf):
    e = events(spark, sf).withColumn("flag", F.col("event_type") == "purchase")
    return sequence.episodes_by_flag(e, BY, ON, "flag", ORDER).select("event_id", "episode")


@query("""WITH $EVENTS, c AS (SELECT *, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 0 WHEN 'purchase' THEN 2 END AS ctl FROM e),
s AS (SELECT *, last_value(ctl IGNORE NULLS) OVER w AS st, sum(CASE WHEN ctl = 1 THEN 1 ELSE 0 END) OVER w AS session FROM c WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, CAST(session AS BIGINT) AS session FROM s WHERE st = 1""")
def sessions_by_control(spark, sf):
    e = events(spark, sf).withColumn("ctl", F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 2))
    return sequence.sessions_by_control(e, BY, ON, "ctl", ORDER).select("event_id", "session")


@query("""WITH $EVENTS SELECT event_id, value FROM e WHERE event_id > (SELECT max(event_id) FROM e) - 500""")
def ring_eviction(spark, sf):
    return sequence.ring(events(spark, sf), "event_id", 500).select("event_id", "value")


# -- interpolation --------------------------------------------------------------------------


_FILL = """WITH $EVENTS, n AS (SELECT event_id, user_id, t, CASE WHEN event_type IN ('view', 'click') THEN value END AS v FROM e),
p AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER a AS pt, last_value(v IGNORE NULLS) OVER a AS pv, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER b AS nt, first_value(v IGNORE NULLS) OVER b AS nv FROM n
  WINDOW a AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, pv + (nv - pv) * (t - pt) / nullif(nt - pt, 0), pv, nv), 4) AS filled FROM p"""


@query(_FILL)
def progress_gap_fill(spark, sf):
    e = events(spark, sf).withColumn("known", F.when(F.col("event_type").isin("view", "click"), F.col("value")))
    return sequence.fill_gaps(e, BY, ON, "known", ORDER).select("event_id", F.round("filled", 4).alias("filled"))


@query()
def pchip_resample(spark, sf):
    """Shape-preserving resampling; tested against a direct evaluation."""
    p = sequence.pchip(events(spark, sf), BY, ON, "value", 4, ORDER)
    return p.select("user_id", "key_frame", "sub", r6("value").alias("value"))


# -- runs -----------------------------------------------------------------------------------

_RUNS = """n AS (SELECT user_id, t, event_id, value < 15 AS f, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i FROM e),
g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, f ORDER BY i) AS island FROM n),
m AS (SELECT user_id, greatest(coalesce(floor(quantile_cont(s, 0.5)), 1), 1) AS interval FROM (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS s FROM e) GROUP BY user_id),
r AS (SELECT user_id, min(i) AS first, max(i) AS last, min(t) AS t0, max(t) AS t1, count(*) AS length FROM g WHERE f GROUP BY user_id, island),
d AS (SELECT r.*, CAST(interval AS BIGINT) AS interval, CAST(t1 - t0 + interval AS BIGINT) AS duration FROM r JOIN m USING (user_id))"""


def _quiet(spark, sf):
    return sequence.timed_runs(events(spark, sf), BY, ON, F.col("value") < 15, ORDER)


def _run_columns(df):
    return df.select("user_id", *(F.col(c).cast("long").alias(c) for c in ("first", "last", "t0", "t1", "length", "interval", "duration")))


@query(f"WITH $EVENTS, {_RUNS} SELECT user_id, first, last, t0, t1, length, interval, duration FROM d")
def islands_static(spark, sf):
    return _run_columns(_quiet(spark, sf))


@query(f"WITH $EVENTS, {_RUNS} SELECT user_id, first, last, t0, t1, length, interval, duration FROM d QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY duration DESC, first) = 1")
def longest_run(spark, sf):
    return _run_columns(sequence.longest_run(_quiet(spark, sf), BY))


@query(f"WITH $EVENTS, {_RUNS} SELECT user_id, first, last, t0, t1, length, interval, duration FROM d QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY duration DESC, first DESC) <= 3")
def topk_runs(spark, sf):
    return _run_columns(sequence.top_runs(_quiet(spark, sf), BY, 3))


_MOTION = """v AS (SELECT event_id, user_id, t, abs(value - lag(value) OVER w) AS d0, abs(k - lag(k) OVER w) AS d1, row_number() OVER w - 1 AS i FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
sc AS (SELECT user_id, greatest(quantile_cont(d0, 0.95), 0.0001) AS s0, greatest(quantile_cont(d1, 0.95), 0.0001) AS s1 FROM v GROUP BY user_id),
mo AS (SELECT v.*, coalesce(greatest(d0 / s0, d1 / s1), 0) AS motion FROM v JOIN sc USING (user_id))"""


@query(f"WITH $EVENTS, {_MOTION} SELECT event_id, round(motion, 6) AS motion FROM mo")
def motion_score(spark, sf):
    e = events(spark, sf).withColumn("state", F.array("value", "k"))
    return sequence.motion_score(e, BY, ON, "state", ORDER).select("event_id", r6("motion").alias("motion"))


@query(f"""WITH $EVENTS, {_MOTION},
g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, motion < 0.5 ORDER BY i) AS island FROM mo),
m AS (SELECT user_id, greatest(floor(quantile_cont(s, 0.5)), 1) AS interval FROM (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS s FROM e) GROUP BY user_id),
r AS (SELECT user_id, min(i) AS first, max(i) AS last, count(*) AS length FROM g WHERE motion < 0.5 GROUP BY user_id, island)
SELECT user_id, first, last - 1 AS last, length FROM r JOIN m USING (user_id) WHERE length >= greatest(2, round_even({720.0 * MINUTE} / interval, 0)) AND last - 1 >= first""")
def static_runs(spark, sf):
    e = events(spark, sf).withColumn("state", F.array("value", "k"))
    s = sequence.static_runs(e, BY, ON, "state", 43200.0, 0.5, 1e6, guard=1, order=ORDER)
    return s.select("user_id", F.col("first").cast("long"), F.col("last").cast("long"), F.col("length").cast("long"))


@query(f"""WITH $EVENTS, {_RUNS},
c AS (SELECT user_id, first, last, duration, CASE WHEN length < 2 THEN 'too_short' ELSE 'candidate' END AS reason FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, reason ORDER BY duration DESC, first DESC) AS rk FROM c)
SELECT user_id, first, last, CASE WHEN reason <> 'candidate' THEN reason WHEN rk <= 2 THEN 'kept' ELSE 'not_among_longest' END AS reason FROM k""")
def contact_runs(spark, sf):
    r = sequence.contact_runs(events(spark, sf), BY, ON, F.when(F.col("value") < 15, 0.0).otherwise(1.0), 0.5, 0.0, 1e6, 2, None, ORDER)
    return r.select("user_id", F.col("first").cast("long"), F.col("last").cast("long"), "reason")


@query("""WITH $EVENTS, v AS (SELECT user_id, row_number() OVER w - 1 AS i, coalesce(abs(value - lag(value) OVER w) < 4, false) AS idle FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, idle ORDER BY i) AS isl FROM v),
h AS (SELECT user_id, i, NOT (idle AND count(*) OVER (PARTITION BY user_id, idle, isl) >= 2) AS keep FROM g),
j AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, keep ORDER BY i) AS isl FROM h),
r AS (SELECT user_id, min(i) AS a, max(i) AS b, count(*) AS n FROM j WHERE keep GROUP BY user_id, isl)
SELECT user_id, a AS start, b + 1 - 2 AS "end" FROM r WHERE n >= 5 AND a < b + 1 - 2""")
def idle_keep_ranges(spark, sf):
    r = sequence.idle_keep_ranges(events(spark, sf), BY, ON, F.array("value"), ORDER, eps=4, min_idle=2, min_keep=5, cut_last=2)
    return r.select("user_id", F.col("start").cast("long"), F.col("end").cast("long"))


@query("""WITH $EVENTS, a AS (SELECT *, max(value) OVER w - min(value) OVER w <= 25 AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT *, sum(CAST(s AS INT)) OVER (PARTITION BY user_id) AS n FROM a), r AS (SELECT * EXCLUDE (s, n) FROM b WHERE NOT (s AND n >= 2)),
c AS (SELECT *, max(value) OVER w - min(value) OVER w <= 25 AS s FROM r WINDOW w AS (PARTITION BY user_id ORDER BY t DESC, event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT *, sum(CAST(s AS INT)) OVER (PARTITION BY user_id) AS n FROM c)
SELECT event_id, user_id, t, value FROM d WHERE NOT (s AND n >= 2)""")
def two_end_trim(spark, sf):
    return sequence.two_end_trim(events(spark, sf), BY, ON, {"value": 25.0}, ORDER).select("event_id", "user_id", "t", "value")


# -- downsampling and folds ---------------------------------------------------------------------


@query(f"""WITH $EVENTS, b AS (SELECT *, (t - min(t) OVER (PARTITION BY user_id)) // {1440 * MINUTE} AS b FROM e),
c AS (SELECT *, lag(b) OVER w AS p, lead(b) OVER w AS n FROM b WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)) SELECT event_id, user_id, t FROM c WHERE p IS NULL OR p <> b OR n IS NULL""")
def downsample_timestamp(spark, sf):
    return sequence.downsample_by_time(events(spark, sf), BY, ON, 1440 * MINUTE, ORDER).select("event_id", "user_id", "t")


@query("""WITH $EVENTS, n AS (SELECT *, row_number() OVER w - 1 AS i, lead(1) OVER w AS nx FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)) SELECT event_id, user_id, t FROM n WHERE i % 3 = 0 OR nx IS NULL""")
def downsample_stride(spark, sf):
    return sequence.downsample(events(spark, sf), BY, ON, "stride", 30, 10, 1e6, ORDER).select("event_id", "user_id", "t")


_NUMBERED = "n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS c FROM e)"


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, q AS MATERIALIZED (SELECT *, CASE WHEN value < 15 THEN {1440 * MINUTE}.0 ELSE {360 * MINUTE}.0 END AS gap FROM n),
f AS (SELECT user_id, rn, event_id, t, gap, t AS last, true AS keep FROM q WHERE rn = 1
UNION ALL SELECT q.user_id, q.rn, q.event_id, q.t, q.gap, CASE WHEN q.gap <> f.gap OR q.t - f.last >= q.gap OR q.rn = q.c THEN q.t ELSE f.last END, q.gap <> f.gap OR q.t - f.last >= q.gap OR q.rn = q.c FROM f JOIN q ON q.user_id = f.user_id AND q.rn = f.rn + 1)
SELECT event_id, user_id, t FROM f WHERE keep""")
def downsample_adaptive(spark, sf):
    unit = 1440.0 * MINUTE
    return sequence.downsample(events(spark, sf), BY, ON, "adaptive", 30, 10, unit, ORDER, F.when(F.col("value") < 15, 1.0).otherwise(4.0)).select("event_id", "user_id", "t")


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, f AS (SELECT user_id, rn, event_id, t, t AS last, true AS keep FROM n WHERE rn = 1
UNION ALL SELECT n.user_id, n.rn, n.event_id, n.t, CASE WHEN n.t - f.last >= {720 * MINUTE} THEN n.t ELSE f.last END, n.t - f.last >= {720 * MINUTE} FROM f JOIN n ON n.user_id = f.user_id AND n.rn = f.rn + 1)
SELECT event_id, user_id, t FROM f WHERE keep""")
def debounce(spark, sf):
    return folds.debounce(events(spark, sf), BY, ON, 720 * MINUTE, ORDER).select("event_id", "user_id", "t")


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, f AS (SELECT user_id, rn, event_id, value AS x FROM n WHERE rn = 1
UNION ALL SELECT n.user_id, n.rn, n.event_id, 0.3 * n.value + (1 - 0.3) * f.x FROM f JOIN n ON n.user_id = f.user_id AND n.rn = f.rn + 1) SELECT event_id, round(x, 6) AS ema FROM f""")
def ema(spark, sf):
    return folds.ema(events(spark, sf), BY, ON, "value", 0.3, ORDER).select("event_id", r6("ema").alias("ema"))


@query("""WITH $EVENTS SELECT event_id, first_value(value) OVER (PARTITION BY user_id ORDER BY t, event_id) AS limited FROM e""")
def rate_limit(spark, sf):
    return folds.rate_limit(events(spark, sf), BY, ON, "value", 2.0, None, ORDER).select("event_id", "limited")


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, f AS (SELECT user_id, rn, event_id, value AS lv, k AS lk, true AS keep FROM n WHERE rn = 1
UNION ALL SELECT n.user_id, n.rn, n.event_id, CASE WHEN abs(n.value - lv) >= 20 OR abs(n.k - lk) >= 30 THEN n.value ELSE lv END, CASE WHEN abs(n.value - lv) >= 20 OR abs(n.k - lk) >= 30 THEN n.k ELSE lk END, abs(n.value - lv) >= 20 OR abs(n.k - lk) >= 30 FROM f JOIN n ON n.user_id = f.user_id AND n.rn = f.rn + 1)
SELECT event_id FROM f WHERE keep""")
def small_change(spark, sf):
    return folds.drop_small_changes(events(spark, sf), BY, ON, {"value": 20.0, "k": 30.0}, ORDER).select("event_id")


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, f AS (SELECT user_id, rn, event_id, value AS lv, k AS lk, true AS keep FROM n WHERE rn = 1
UNION ALL SELECT n.user_id, n.rn, n.event_id, CASE WHEN n.event_type = 'signup' OR sqrt((n.value - lv) * (n.value - lv) + (n.k - lk) * (n.k - lk)) >= 25 THEN n.value ELSE lv END, CASE WHEN n.event_type = 'signup' OR sqrt((n.value - lv) * (n.value - lv) + (n.k - lk) * (n.k - lk)) >= 25 THEN n.k ELSE lk END, n.event_type = 'signup' OR sqrt((n.value - lv) * (n.value - lv) + (n.k - lk) * (n.k - lk)) >= 25 FROM f JOIN n ON n.user_id = f.user_id AND n.rn = f.rn + 1)
SELECT event_id FROM f WHERE keep""")
def similar_skip(spark, sf):
    e = events(spark, sf).withColumn("state", F.array("value", "k")).withColumn("must", F.col("event_type") == "signup")
    return folds.skip_similar(e, BY, ON, "state", 25.0, "must", ORDER).select("event_id")


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, f AS (SELECT user_id, rn, event_id, value AS used, 0 AS file FROM n WHERE rn = 1
UNION ALL SELECT n.user_id, n.rn, n.event_id, CASE WHEN f.used + n.value >= 100 THEN n.value ELSE f.used + n.value END, CASE WHEN f.used + n.value >= 100 THEN f.file + 1 ELSE f.file END FROM f JOIN n ON n.user_id = f.user_id AND n.rn = f.rn + 1)
SELECT event_id, CAST(file // 4 AS BIGINT) AS chunk_index, CAST(file % 4 AS BIGINT) AS file_index FROM f""")
def file_rotation(spark, sf):
    return folds.rotate_files(events(spark, sf), BY, ON, "value", 100.0, 4, ORDER).select("event_id", "chunk_index", "file_index")


@query(f"""WITH RECURSIVE $EVENTS, {_NUMBERED}, f AS (SELECT user_id, rn, event_id, k AS total, 1 AS cnt, 0 AS batch FROM n WHERE rn = 1
UNION ALL SELECT n.user_id, n.rn, n.event_id, CASE WHEN f.cnt + 1 > 6 OR f.total + n.k > 200 THEN n.k ELSE f.total + n.k END, CASE WHEN f.cnt + 1 > 6 OR f.total + n.k > 200 THEN 1 ELSE f.cnt + 1 END, CASE WHEN f.cnt + 1 > 6 OR f.total + n.k > 200 THEN f.batch + 1 ELSE f.batch END FROM f JOIN n ON n.user_id = f.user_id AND n.rn = f.rn + 1)
SELECT event_id, CAST(batch AS BIGINT) AS batch FROM f""")
def greedy_batches(spark, sf):
    return folds.pack_batches(events(spark, sf), BY, ON, "k", 0.0, 1.0, 6, 200, ORDER).select("event_id", "batch")


# -- queues and weights --------------------------------------------------------------------------


_PLANS = """o AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS step, value FROM e WHERE event_type = 'view'),
w AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) + 4 AS step, value FROM e WHERE event_type = 'click')"""


def _plans(spark, sf):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")).cast("long")
    old = topic(spark, sf, "view").select("user_id", (n - 1).alias("step"), "value")
    return old, topic(spark, sf, "click").select("user_id", (n + 4).alias("step"), "value")


@query(f"WITH $EVENTS, {_PLANS} SELECT w.user_id, w.step, round(coalesce(0.3 * o.value + 0.7 * w.value, w.value), 6) AS value FROM w LEFT JOIN o USING (user_id, step) WHERE w.step > 6")
def queue_merge_latest(spark, sf):
    old, new = _plans(spark, sf)
    return queues.merge_by_step(old, new, ["user_id"], "step", "value", 6).withColumn("value", r6("value"))


@query(f"""WITH $EVENTS, {_PLANS}, j AS (SELECT user_id, step, o.value AS a, w.value AS b FROM (SELECT * FROM o WHERE step >= 3) o FULL JOIN (SELECT * FROM w WHERE step >= 3) w USING (user_id, step)),
k AS (SELECT *, min(CASE WHEN b IS NOT NULL THEN step END) OVER p AS lo, least(max(CASE WHEN a IS NOT NULL THEN step END) OVER p, max(CASE WHEN b IS NOT NULL THEN step END) OVER p) AS hi FROM j WINDOW p AS (PARTITION BY user_id)),
u AS (SELECT *, CASE WHEN hi > lo THEN (step - lo) / (hi - lo) END AS u FROM k)
SELECT user_id, step, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN (1 - x) * a + x * b ELSE coalesce(b, a) END, 6) AS value FROM (SELECT *, CASE WHEN hi <= lo THEN 0.8 ELSE 0.8 * (3 * u * u - 2 * u * u * u) END AS x FROM u)""")
def queue_merge_smoothstep(spark, sf):
    old, new = _plans(spark, sf)
    return queues.merge_smoothstep(old, new, ["user_id"], "step", "value", 3, 0.8).withColumn("value", r6("value"))


@query("""WITH $EVENTS, v AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, event_id DESC) > 2 AS valid FROM e WHERE event_type IN ('view', 'click')),
n AS (SELECT event_type, sum(CAST(valid AS INT)) AS n, CASE event_type WHEN 'view' THEN 0.25 ELSE 0.75 END AS r FROM v GROUP BY event_type)
SELECT event_id, round(CASE WHEN valid THEN r / n / (SELECT sum(r) FROM n WHERE n > 0) ELSE 0 END, 9) AS weight FROM v JOIN n USING (event_type)""")
def sampler_weights(spark, sf):
    e = events(spark, sf).filter(F.col("event_type").isin("view", "click"))
    w = weights.sampler_weights(e, "event_type", BY, ON, {"view": 0.25, "click": 0.75}, 2, ORDER)
    return w.select("event_id", F.round("weight", 9).alias("weight"))


@query("""WITH $EVENTS, n AS (SELECT event_id, user_id, coalesce(lead(value, 3) OVER w, last_value(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) - value AS d FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
s AS (SELECT greatest(avg(d), 0) AS m, greatest(stddev_pop(d), 0.000001) AS sd FROM n),
x AS (SELECT event_id, user_id, CASE WHEN d > 30 THEN 1.0 WHEN d < 0 THEN 0.0 ELSE greatest(0, least(1, (d - (m - 2 * sd)) / (4 * sd + 0.000001))) END AS w FROM n, s)
SELECT event_id, round(w * count(*) OVER (PARTITION BY user_id) / (sum(w) OVER (PARTITION BY user_id) + 0.000001), 6) AS weight FROM x""")
def rabc_weights(spark, sf):
    d = sequence.lookahead_change(events(spark, sf), BY, ON, "value", 3, ORDER)
    d = d.crossJoin(F.broadcast(weights.progress_stats(d, "delta")))
    w = d.withColumn("weight", weights.progress_weight(F.col("delta"), 30.0, F.col("mean"), F.col("std")))
    return weights.normalised(w, "weight", ["user_id"]).select("event_id", r6("weight").alias("weight"))


@query("""WITH $EVENTS, a AS (SELECT user_id, sum(value) AS total FROM e GROUP BY user_id), l AS (SELECT user_id, event_type, arg_max(value, (t, event_id)) AS d FROM e GROUP BY ALL),
m AS (SELECT event_type, avg(d / total) AS m FROM l JOIN a USING (user_id) GROUP BY event_type) SELECT event_type, round(m / (SELECT sum(m) FROM m), 6) AS proportion FROM m""")
def temporal_proportions(spark, sf):
    e = events(spark, sf).withColumn("at", F.struct("t", "event_id"))
    return weights.temporal_proportions(e, "user_id", "event_type", "value", "at").withColumn("proportion", r6("proportion"))


# -- quality ---------------------------------------------------------------------------------------


@query(f"""WITH $EVENTS, s AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS s FROM e) SELECT user_id, count(s) AS n_steps, round(avg(CASE WHEN s <= {600 * MINUTE} THEN 1.0 WHEN s IS NOT NULL THEN 0.0 END), 6) AS ok_ratio FROM s GROUP BY user_id""")
def qc_gap_ratio(spark, sf):
    return quality.gap_ratio(events(spark, sf), BY, ON, 600 * MINUTE, ORDER).withColumn("ok_ratio", r6("ok_ratio"))


_COUNTS = """c AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type = 'error') AS n_error, count(*) AS n_total FROM e GROUP BY user_id)"""


@query(f"WITH $EVENTS, {_COUNTS} SELECT * FROM c")
def qc_counts(spark, sf):
    return quality.stream_counts(events(spark, sf), BY, "event_type", ["view", "click", "error"])


@query(f"""WITH $EVENTS, {_COUNTS}, x AS (SELECT user_id, CASE WHEN n_view = 0 THEN 'view: no frames' WHEN abs(n_view - n_click) / n_view > 0.3 THEN 'view and click: frame counts differ' END AS a,
 CASE WHEN n_error > 0 AND abs(n_view - n_error) / nullif(n_view, 0) > 0.3 THEN 'view and error: frame counts differ' END AS b FROM c)
SELECT user_id AS sub_task_id, CASE WHEN a IS NULL AND b IS NULL THEN 'pass' ELSE 'failed' END AS result, coalesce(a, b, '') AS fail_error FROM x""")
def qc_report(spark, sf):
    c = quality.stream_counts(events(spark, sf), BY, "event_type", ["view", "click", "error"])
    c = quality.depth_check(quality.camera_check(c, "view", ["click"], 0.3), "view", "error", 0.3)
    return quality.report(c, "user_id", ["camera_error", "depth_error"])


@query(f"""WITH $EVENTS, d AS (SELECT event_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS step FROM e) SELECT event_id, step FROM d WHERE abs(step - {400 * MINUTE}) > {300 * MINUTE}""")
def fixed_rate_check(spark, sf):
    return sequence.off_rate(events(spark, sf), BY, ON, 400 * MINUTE, 300 * MINUTE, ORDER).select("event_id", "step")


@query("""WITH $EVENTS, d AS (SELECT event_id, t, lag(t) OVER (PARTITION BY user_id ORDER BY value, event_id) AS before FROM e) SELECT event_id, t, before FROM d WHERE t < before""")
def monotonic_check(spark, sf):
    e = events(spark, sf).withColumn("arrival", F.struct("value", "event_id"))
    return sequence.backward_steps(e, BY, ON, "arrival").select("event_id", "t", "before")


@query("""WITH $EVENTS, d AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY t, event_id) AS before, CAST(event_type IN ('click', 'view') AS INT) AS act FROM e),
x AS (SELECT user_id, t, event_id, CASE WHEN value < 0 OR value > 70 THEN 'width out of range' WHEN act = 0 AND before + 5 < value THEN 'closing, but the width grows' WHEN act = 1 AND before - 1 > value THEN 'opening, but the width shrinks' END AS error FROM d),
f AS (SELECT *, CASE error WHEN 'width out of range' THEN 1 WHEN 'closing, but the width grows' THEN 2 ELSE 3 END AS chk FROM x WHERE error IS NOT NULL)
SELECT user_id, error, t AS at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY chk, t, event_id) AS n FROM f) WHERE n = 1""")
def qc_gripper(spark, sf):
    e = events(spark, sf).withColumn("act", F.col("event_type").isin("click", "view").cast("int"))
    return quality.gripper_errors(e, BY, ON, "act", "value", order=ORDER)


@query("""WITH $EVENTS, n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e),
k AS (SELECT *, least(n, greatest(5, ceil(n * 0.05)))::BIGINT AS k FROM n)
SELECT event_id FROM k WHERE CASE WHEN k <= 1 THEN i = 0 ELSE list_contains(list_transform(range(k), lambda j: CASE WHEN j = k - 1 THEN n - 1 ELSE CAST(floor(j * ((n - 1) / (k - 1))) AS BIGINT) END), i) END""")
def sampled_frames(spark, sf):
    return quality.sampled_frames(events(spark, sf), BY, ON, order=ORDER).select("event_id")


@query("""WITH $EVENTS, d AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS s FROM e)
SELECT user_id, max(k) AS max_align_diff, max(s) AS max_dt, count(*) AS n_frames, count(*) FILTER (value < 15) AS n_static, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS reasons FROM d GROUP BY user_id""")
def episode_summary(spark, sf):
    e = events(spark, sf).withColumn("class", F.when(F.col("value") < 15, "static").otherwise("moving"))
    return quality.episode_summary(e, BY, ON, "class", "k", "event_type", ORDER)


# -- selections ---------------------------------------------------------------------------------------


@query("""WITH $EVENTS, n AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e) SELECT event_id FROM n WHERE i > 30 AND i <= n - 5""")
def drop_edges(spark, sf):
    return filters.drop_edges(events(spark, sf), BY, ON, 30, 5, ORDER, True).select("event_id")


@query("""WITH $EVENTS, u AS (SELECT DISTINCT user_id, user_id % 5 AS source FROM e), n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY user_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM u)
SELECT user_id, source FROM n WHERE n <= 7 OR list_contains(list_transform(range(7), lambda j: CASE WHEN j = 6 THEN n - 1 ELSE CAST(floor(j * ((n - 1) / 6)) AS BIGINT) END), i)""")
def select_uniform(spark, sf):
    u = events(spark, sf).select("user_id", (F.col("user_id") % 5).alias("source")).distinct()
    return filters.uniform_episodes(u, 7, ["source"], "user_id")


@query("""WITH $EVENTS, u AS (SELECT DISTINCT user_id, user_id % 5 AS source FROM e) SELECT user_id, source FROM u QUALIFY row_number() OVER (PARTITION BY source ORDER BY user_id) <= 4""")
def select_first(spark, sf):
    u = events(spark, sf).select("user_id", (F.col("user_id") % 5).alias("source")).distinct()
    return filters.first_episodes(u, 4, ["source"], "user_id")


@query("""WITH $EVENTS, n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i FROM e), r AS (SELECT DISTINCT user_id, user_id % 7 AS a, user_id % 7 + 10 AS b FROM e)
SELECT event_id, user_id FROM n WHERE EXISTS (SELECT 1 FROM r WHERE r.user_id = n.user_id AND i >= a AND i < b)""")
def keep_range_semi(spark, sf):
    from pyspark.sql import Window

    e = events(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")) - 1)
    ranges = e.select("user_id").distinct().select("user_id", (F.col("user_id") % 7).alias("start"), (F.col("user_id") % 7 + 10).alias("end"))
    return filters.keep_ranges(e, ranges, "user_id", "i").select("event_id", "user_id")


@query("""WITH $EVENTS, n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e) SELECT event_id, i // 16 AS batch FROM n WHERE i // 16 < n // 16""")
def batches(spark, sf):
    return filters.batches(events(spark, sf), BY, ON, 16, ORDER, drop_last=True).select("event_id", "batch")


@query("""WITH $EVENTS SELECT event_id FROM e WHERE event_id % 4 = 1 AND event_id < (SELECT count(*) FROM e) // 4 * 4""")
def rank_rows(spark, sf):
    e = events(spark, sf)
    return filters.rank_rows(e, "event_id", 1, 4, e.count()).select("event_id")


@query("""WITH $EVENTS SELECT event_id, round(CASE WHEN t > t0 THEN (n - 1) / ((t - t0) / 3600000000.0) ELSE 0 END, 6) AS fps FROM (SELECT event_id, t, min(t) OVER (PARTITION BY user_id) AS t0, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM e)""")
def fps_metric(spark, sf):
    return sequence.fps_metric(events(spark, sf), BY, ON, 3.6e9, ORDER).select("event_id", r6("fps").alias("fps"))


@query("""WITH $EVENTS SELECT event_id, round(sum(value) OVER w, 6) AS sum, count(value) OVER w AS count, round(avg(value) OVER w, 9) AS avg FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_meter(spark, sf):
    return sequence.running_mean(events(spark, sf), BY, ON, "value", ORDER).select("event_id", r6("sum").alias("sum"), "count", F.round("avg", 9).alias("avg"))
