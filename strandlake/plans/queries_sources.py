"""Queries over sources and sinks that write and read data derived from the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import action_tokens, messages
from ..functions import vector as V
from ..functions.scalar import micros
from ..operators import records, sequence, shuffling
from ..operators.edit import running
from ..sources import aggregates, archives, bags, commits, readers, trajectories
from ..streaming import buffers, live
from ..streaming.local import as_stream, folder, name
from . import pipeline
from .catalogue import events, query, r6, table


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", V.doubles(F.col("embedding")).alias("v"))


# -- committed episodes -------------------------------------------------------------------------


def _recording(spark, sf):
    """Labels as episodes, recorded in three batches, one of which is replayed."""
    path = folder(spark, "recording")
    frames = _vectors(spark, sf).select(F.col("label").cast("long").alias("episode_index"), "label", "vec_id", F.concat(F.lit("task "), (F.col("label") % 2).cast("string")).alias("task"))
    for part in (0, 1, 0, 2):
        commits.save(frames.filter(F.col("label") % 3 == part), path, f"part-{part}", ["vec_id"], 10.0)
    return path


_RECORDED = """f AS (SELECT label, vec_id, label % 2 AS t, dense_rank() OVER (ORDER BY label % 3, label) - 1 AS episode_index, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, row_number() OVER (ORDER BY label % 3, label, vec_id) - 1 AS index FROM embeddings),
tasks AS (SELECT t, row_number() OVER (ORDER BY min(index)) - 1 AS task_index FROM f GROUP BY t)"""


@query(f"WITH {_RECORDED} SELECT label, vec_id, episode_index, frame_index, index, task_index, round(CAST(CAST(frame_index / 10.0 AS FLOAT) AS DOUBLE), 6) AS timestamp FROM f JOIN tasks USING (t)")
def committed_frames(spark, sf):
    rows = commits.read(spark, _recording(spark, sf))
    return rows.select("label", "vec_id", "episode_index", "frame_index", "index", "task_index", r6(F.col("timestamp").cast("double")).alias("timestamp"))


@query(f"WITH {_RECORDED} SELECT episode_index, count(*) AS length, min(index) AS dataset_from_index, max(index) + 1 AS dataset_to_index, 'task ' || any_value(t) AS task FROM f GROUP BY episode_index")
def committed_episodes(spark, sf):
    rows = commits.read(spark, _recording(spark, sf), "meta/episodes")
    return rows.select("episode_index", "length", "dataset_from_index", "dataset_to_index", F.array_join("tasks", ",").alias("task"))


@query(f"""WITH {_RECORDED}, b AS (SELECT label % 3 AS part, count(DISTINCT label) AS e, count(*) AS n FROM f GROUP BY 1)
SELECT part AS commit, 'part-' || part AS batch, CAST(sum(e) OVER (ORDER BY part) AS BIGINT) AS episodes, CAST(sum(n) OVER (ORDER BY part) AS BIGINT) AS frames, CAST((SELECT count(DISTINCT t) FROM f WHERE label % 3 <= part) AS BIGINT) AS tasks FROM b""")
def commit_log(spark, sf):
    return commits.commits(spark, _recording(spark, sf)).drop("attempt")


# -- bag files ----------------------------------------------------------------------------------


def _bag(spark, sf):
    """Events as joint-state messages of a topic for each type; stamps of odd event ids are before the cutoff."""
    e = events(spark, sf).withColumn("ns", F.when(F.col("event_id") % 2 == 1, F.lit(7).cast("long")).otherwise(F.col("t") * 1000))
    position = F.array(F.coalesce("value", F.lit(-1.0)), F.coalesce("k", F.lit(-1.0)))
    data = messages.joint_state_message("ns", F.concat(F.lit("u"), F.col("user_id").cast("string")), F.array(F.lit("value"), F.lit("k")), position)
    path = folder(spark, "bag")
    bags.write(e.select(F.concat(F.lit("/"), "event_type").alias("topic"), F.lit("sensor_msgs/msg/JointState").alias("type"), (F.col("t") * 1000).alias("log_time"), F.col("event_id").alias("sequence"), data.alias("data")), path, chunk_bytes=1 << 16)
    return path


def _joints(rows):
    m = F.col("m")
    out = rows.withColumn("m", messages.joint_state("data")).withColumn("ts_ns", messages.stamp_ns(m, F.col("log_time"), 1.0))
    return out.select("topic", "ts_ns", F.col("sequence").alias("event_id"), m.frame_id.alias("frame_id"), F.array_join(m["name"], ",").alias("names"), r6(m.position[0]).alias("value"), r6(m.position[1]).alias("k"))


_JOINTS = "SELECT '/' || event_type AS topic, t * 1000 AS ts_ns, event_id, 'u' || user_id AS frame_id, 'value,k' AS names, round(coalesce(value, -1), 6) AS value, round(coalesce(k, -1), 6) AS k FROM e"


@query(f"WITH $EVENTS {_JOINTS}")
def bag_round_trip(spark, sf):
    """Messages written as MCAP files, read and decoded."""
    return _joints(bags.read(spark, _bag(spark, sf)))


@query(f"WITH $EVENTS, m AS (SELECT quantile_disc(t, 0.25) AS a, quantile_disc(t, 0.5) AS b FROM e) SELECT x.* FROM ({_JOINTS}) x, m WHERE topic IN ('/click', '/view') AND ts_ns >= a * 1000 AND ts_ns < b * 1000")
def bag_topics_and_times(spark, sf):
    """Two topics and a stretch of time; both filters reach the chunk index."""
    a, b = events(spark, sf).agg(F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY t)"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY t)")).first()
    rows = bags.read(spark, _bag(spark, sf))
    return _joints(rows.filter(F.col("topic").isin("/click", "/view") & (F.col("log_time") >= int(a) * 1000) & (F.col("log_time") < int(b) * 1000)))


@query("SELECT '/' || event_type AS topic, count(*) AS n, min(epoch_us(ts)) * 1000 AS first_ns, max(epoch_us(ts)) * 1000 AS last_ns FROM events GROUP BY event_type")
def bag_topics(spark, sf):
    rows = bags.read(spark, _bag(spark, sf))
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.min("log_time").alias("first_ns"), F.max("log_time").alias("last_ns"))


# -- trajectory records -------------------------------------------------------------------------


def _trajectories(spark, sf):
    """Fifty vectors of a label are a trajectory: ids and vectors of its steps, and its name."""
    v = _vectors(spark, sf).withColumn("part", F.expr("vec_id div 50"))
    one = v.groupBy("label", "part").agg(F.array_sort(F.collect_list(F.struct("vec_id", "v"))).alias("s"))
    path = folder(spark, "trajectories")
    floats = F.flatten(F.col("s.v"))
    trajectories.write(one, {"steps/vec_id": F.col("s.vec_id"), "steps/v": floats, "name": F.format_string("label %d", "label"), "part": F.col("part")}, path)
    return path


@query("SELECT label, vec_id // 50 AS part, vec_id, i AS dim, round(CAST(CAST(embedding[i + 1] AS FLOAT) AS DOUBLE), 5) AS value FROM embeddings, (SELECT unnest(range(64)) AS i)")
def trajectory_records(spark, sf):
    """Trajectories written as records, read, and cut into steps again."""
    rows = trajectories.read(spark, _trajectories(spark, sf)).drop("path", "offset", "error")
    ids = trajectories.feature("steps/vec_id", "ints")
    frames = trajectories.steps(rows, F.size(ids), {"vec_id": (ids, 1), "v": (trajectories.feature("steps/v", "floats"), 64)})
    label = F.substring_index(F.decode(trajectories.feature("name", "bytes")[0], "utf-8"), " ", -1).cast("int")
    out = frames.select(label.alias("label"), trajectories.feature("part", "ints")[0].alias("part"), F.col("vec_id")[0].alias("vec_id"), F.posexplode("v").alias("dim", "value"))
    return out.withColumn("dim", F.col("dim").cast("long")).withColumn("value", F.round(F.col("value").cast("double"), 5))


@query("SELECT label, count(DISTINCT vec_id // 50) AS records, count(*) AS steps FROM embeddings GROUP BY label")
def trajectory_lengths(spark, sf):
    rows = trajectories.read(spark, _trajectories(spark, sf), damaged="keep").filter("error is null")
    label = F.substring_index(F.decode(trajectories.feature("name", "bytes")[0], "utf-8"), " ", -1).cast("int")
    return rows.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("records"), F.sum(F.size(trajectories.feature("steps/vec_id", "ints"))).alias("steps"))


# -- shuffled and mixed reading -----------------------------------------------------------------


def _draw(of: str) -> str:
    return f"CAST('0x' || substr(md5({of}), 1, 13) AS BIGINT)"


#: A row of place s that entered at t leaves at the next t that draws s; one that never does is read at the end.
_SHUFFLED = f"""i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, {_draw("'7:stream:' || user_id")} % 3 AS stream FROM e),
g AS (SELECT *, sum(CAST(round(-ln(({_draw("'7:1:gap:' || user_id || ':' || i")} + 1) / 4503599627370496.0) * 1e6) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY i) AS arrival FROM i),
o AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY arrival, user_id, t, event_id) - 1 AS j, count(*) OVER (PARTITION BY stream) AS n FROM g),
p AS (SELECT *, CASE WHEN j < 64 THEN j ELSE {_draw("'7:1:slot:' || stream || ':' || j")} % 64 END AS place FROM o),
l AS (SELECT *, lead(j) OVER (PARTITION BY stream, place ORDER BY j) AS leaves FROM p)
SELECT CAST(stream AS INTEGER) AS stream, event_id, CAST(CASE WHEN leaves IS NOT NULL THEN leaves - 64 ELSE greatest(n - 64, 0) + row_number() OVER (PARTITION BY stream, leaves IS NULL ORDER BY {_draw("'7:1:end:' || stream || ':' || j")}, j) - 1 END AS BIGINT) AS position FROM l"""


@query(f"WITH $EVENTS, {_SHUFFLED}")
def shuffle_buffer_order(spark, sf):
    """The order itself: users are shards of three streams, each read through a buffer of 64 rows."""
    out = shuffling.buffer_shuffled(events(spark, sf), "user_id", ["t", "event_id"], 64, seed=7, streams=3, epoch=1)
    return out.select("stream", "event_id", "position")


_MIXED = f"""a AS (SELECT o_orderkey AS k, o_totalprice AS x, row_number() OVER (ORDER BY {_draw("'5:large:' || o_orderkey")}, o_orderkey) - 1 AS pos, count(*) OVER () // 12 AS b FROM orders),
s AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer),
d AS (SELECT r // 4 AS batch, CAST(r % 4 + 12 AS INTEGER) AS slot, {_draw("'5:small:' || r")} AS draw FROM (SELECT unnest(range(0, (SELECT any_value(b) FROM a) * 4)) AS r)),
m AS (SELECT pos // 12 AS batch, CAST(pos % 12 AS INTEGER) AS slot, 0 AS source, k, x FROM a WHERE pos < b * 12
UNION ALL SELECT batch, slot, 1, c_custkey, c_acctbal FROM d JOIN s ON s.i = d.draw % n)"""


def _mix(spark, sf):
    """Twelve orders and four customers a batch."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("x"))
    some = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("x"), F.lit(1).alias("_one"))
    customers = running(some, {"_one": "i"}, ["k"]).drop("_one")
    return shuffling.mixed_batches(orders, customers, ["k"], "i", customers.count(), 16, 4, seed=5)


@query(f"WITH {_MIXED} SELECT * FROM m")
def mixed_batch_rows(spark, sf):
    return _mix(spark, sf)


@query(f"WITH {_MIXED} SELECT batch, CAST(12 AS BIGINT) AS large, CAST(4 AS BIGINT) AS small FROM m GROUP BY batch")
def mixed_batch_quota(spark, sf):
    """Every batch has its quota of both sources."""
    return _mix(spark, sf).groupBy("batch").agg(F.sum((F.col("source") == 0).cast("int")).alias("large"), F.sum("source").alias("small"))


# -- streams ------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT user_id, event_id, value, epoch_us(ts) AS t FROM events WHERE value IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, event_id DESC, value DESC) AS r FROM e)
SELECT user_id, count(*) FILTER (WHERE fresh) AS n, coalesce(string_agg(CAST(t AS VARCHAR), ',' ORDER BY t, event_id, value) FILTER (WHERE fresh), '') AS times, round(coalesce(sum(value) FILTER (WHERE fresh), 0), 4) AS total
FROM (SELECT *, r <= 8 AND t // 1000 + 86400000 >= (SELECT max(t) // 1000 FROM e) AS fresh FROM b) GROUP BY user_id""")
def expiring_buffers(spark, sf):
    """The newest eight values of each user, none older than a day, after a stream of all events in four files."""
    e = table(spark, sf, "events").filter("value is not null").select("user_id", "event_id", F.timestamp_micros(micros(F.col("ts"))).alias("ts"), "value")
    changes = buffers.expiring(as_stream(spark, e, 4, by="ts"), "user_id", "ts", "value", 8, 86_400_000, order="event_id", mode="append")
    last = buffers.last_of(live.run_once(changes, name("expiring"), "append", folder(spark), buffers.NEEDS), "user_id")
    return last.select("user_id", F.size("buffer").cast("long").alias("n"), F.array_join(F.col("times").cast("array<string>"), ",").alias("times"), F.round(F.aggregate("buffer", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


# -- archives -----------------------------------------------------------------------------------


def _archives(spark, sf):
    """Documents as entries of an archive for each source."""
    path = folder(spark, "archives")
    d = table(spark, sf, "documents")
    archives.write(d.select(F.coalesce("source", F.lit("none")).alias("archive"), F.format_string("%d/%d.txt", F.col("doc_id") % 10, "doc_id").alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content")), path)
    return path


@query("SELECT coalesce(source, 'none') AS archive, (doc_id % 10) || '/' || doc_id || '.txt' AS name, md5(coalesce(text, '')) AS digest, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size FROM documents")
def archive_round_trip(spark, sf):
    """Entries written, then read by ranges of the archives."""
    rows = archives.read(archives.entries(spark, _archives(spark, sf)))
    return rows.select(F.regexp_extract("archive", r"([^/]+)\.zip$", 1).alias("archive"), "name", F.md5("content").alias("digest"), F.octet_length("content").cast("long").alias("size"))


@query("SELECT coalesce(source, 'none') AS archive, count(*) AS entries, CAST(sum(strlen(coalesce(text, ''))) AS BIGINT) AS bytes FROM documents WHERE doc_id % 10 = 3 GROUP BY 1")
def archive_directories(spark, sf):
    """Sizes of a folder of each archive, from the directories alone."""
    rows = archives.entries(spark, _archives(spark, sf)).filter(F.col("name").startswith("3/"))
    return rows.groupBy(F.regexp_extract("archive", r"([^/]+)\.zip$", 1).alias("archive")).agg(F.count(F.lit(1)).alias("entries"), F.sum("size").alias("bytes"))


# -- action tokens ------------------------------------------------------------------------------

_COSINE = "sqrt(CASE WHEN k = 0 THEN 1.0 ELSE 2.0 END / 8) * cos(pi() * (2 * t + 1) * k / 16)"
_COEFFICIENTS = f"""x AS (SELECT vec_id, t, d, CAST(embedding[t * 8 + d + 1] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range(8)) AS t), (SELECT unnest(range(8)) AS d)),
q AS (SELECT vec_id, k, d, CAST(round_even(50 * sum(x * {_COSINE}), 0) AS BIGINT) AS q FROM x, (SELECT unnest(range(8)) AS k) GROUP BY ALL)"""


def _quantised(spark, sf):
    """Vectors as chunks of eight actions of eight elements."""
    chunk = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda t: F.slice("v", t * 8 + 1, F.lit(8)))
    return _vectors(spark, sf).select("vec_id", action_tokens.quantised(chunk, 8, 8, 50.0).alias("q"))


@query(f"WITH {_COEFFICIENTS} SELECT vec_id, k * 8 + d AS i, q FROM q")
def action_coefficients(spark, sf):
    rows = _quantised(spark, sf).select("vec_id", F.posexplode("q").alias("i", "q"))
    return rows.withColumn("i", F.col("i").cast("long"))


@query(f"WITH {_COEFFICIENTS} SELECT vec_id, t * 8 + d AS dim, round(sum(q / 50.0 * {_COSINE}), 6) AS value FROM q, (SELECT unnest(range(8)) AS t) GROUP BY ALL")
def action_token_round_trip(spark, sf):
    """Through ids with merges, to integers and actions again."""
    merges = action_tokens.Merges(-64, 128, [(64, 64), (128, 128), (129, 64), (65, 63), (63, 65)])
    rows = action_tokens.decoded(action_tokens.encoded(_quantised(spark, sf), "q", merges), "ids", merges)
    back = rows.select("vec_id", action_tokens.dequantised(F.col("numbers"), 8, 8, 50.0).alias("a"))
    return back.select("vec_id", F.posexplode(F.flatten("a")).alias("dim", "value")).withColumn("dim", F.col("dim").cast("long")).withColumn("value", r6("value"))


# -- aggregates of files ------------------------------------------------------------------------


def _aggregate(spark, sf):
    """Three datasets, a file for each label, joined: two at first, the third taken in later; a file may reach 2.5 times the mean file's rows."""
    path, v = folder(spark, "aggregate"), _vectors(spark, sf)
    w = Window.partitionBy("source").orderBy("label")
    n = v.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.col("label") % 3)
    n = n.withColumn("episode_index", F.row_number().over(w).cast("long") - 1).withColumn("_from", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    frames = v.join(F.broadcast(n), "label").withColumn("frame_index", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")).cast("long") - 1)
    frames = frames.withColumn("index", F.col("_from") + F.col("frame_index")).withColumn("file", F.format_string("%03d", "episode_index"))
    for i in range(3):
        frames.filter(F.col("source") == i).select("vec_id", "label", "episode_index", "index", "file").repartition("file").write.partitionBy("file").parquet(f"{path}/in-{i}/chunk-000")
    limit = v.count() * 5 // (2 * n.count())
    aggregates.aggregate(spark, [f"{path}/in-0", f"{path}/in-1"], f"{path}/out", limit, size="n_rows")
    aggregates.aggregate(spark, [f"{path}/in-2"], f"{path}/out", limit, size="n_rows")
    return f"{path}/out"


_FILES = """n AS (SELECT label, label % 3 AS source, count(*) AS n, row_number() OVER (PARTITION BY label % 3 ORDER BY label) - 1 AS file, row_number() OVER (ORDER BY label % 3, label) AS r FROM embeddings GROUP BY label),
l AS (SELECT sum(n) * 5 // (2 * count(*)) AS lim FROM n),
g AS (SELECT r, n AS held, 0 AS target FROM n WHERE r = 1
UNION ALL SELECT n.r, CASE WHEN held + n.n >= lim THEN n.n ELSE held + n.n END, CASE WHEN held + n.n >= lim THEN target + 1 ELSE target END FROM g JOIN n ON n.r = g.r + 1, l)"""


@query(f"WITH RECURSIVE {_FILES} SELECT CAST(source AS INTEGER) AS source, CAST(file AS BIGINT) AS src_file, CAST(0 AS BIGINT) AS dst_chunk, CAST(target AS BIGINT) AS dst_file, count(*) OVER (PARTITION BY target) = 1 AS carried FROM n JOIN g USING (r)")
def aggregated_file_map(spark, sf):
    """Where each file went, and which are carried over as they are."""
    return aggregates.file_map(spark, _aggregate(spark, sf)).drop("src_chunk")


@query("SELECT vec_id, label, dense_rank() OVER (ORDER BY label % 3, label) - 1 AS episode_index, row_number() OVER (ORDER BY label % 3, label, vec_id) - 1 AS index FROM embeddings")
def aggregated_frames(spark, sf):
    return aggregates.read(spark, _aggregate(spark, sf)).select("vec_id", "label", "episode_index", "index")


# -- JSON that isn't quite lines, steps and look-ups ----------------------------------------------


@query("SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM customer")
def json_array_files(spark, sf):
    """A JSON file for each nation: an array, or the objects between commas, or lines."""
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    objects = F.collect_list(F.to_json(F.struct("c_custkey", "c_name", "c_acctbal")))
    form = F.col("c_nationkey") % 3
    text = F.when(form == 0, F.concat(F.lit("[\n"), F.array_join("o", ",\n"), F.lit("\n]\n"))).when(form == 1, F.array_join("o", ",\n")).otherwise(F.array_join("o", "\n"))
    path = folder(spark, "json")
    c.groupBy("c_nationkey").agg(objects.alias("o")).select(text.alias("value"), F.format_string("%02d", "c_nationkey").alias("nation")).write.partitionBy("nation").text(path)
    rows = readers.json_arrays(spark, f"{path}/*/*.txt", "c_custkey: bigint, c_name: string, c_acctbal: double")
    return rows.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT event_id, user_id FROM events WHERE event_id % 7 <> 0")
def json_lines_with_bad_ones(spark, sf):
    """Every seventh line is cut off; the others are read."""
    line = F.to_json(F.struct("event_id", "user_id"))
    path = folder(spark, "json")
    table(spark, sf, "events").select(F.when(F.col("event_id") % 7 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    return readers.json_lines(spark, path, "event_id long, user_id long")


@query("""WITH $EVENTS SELECT event_id, round(CASE WHEN event_type = 'click' AND k >= 20 THEN k ELSE value END, 6) AS action, CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0 END AS reward, event_type IN ('error', 'purchase') AS done FROM e WHERE value IS NOT NULL""")
def intervened_steps(spark, sf):
    """A click is a person's action (if there is one), a purchase a success, an error the end."""
    e = events(spark, sf).filter("value is not null")
    is_a = lambda kind: F.col("event_type") == kind
    rows = e.select("event_id", F.col("value").alias("action"), F.when(F.col("k") >= 20, F.col("k")).alias("teleop_action"), is_a("click").alias("is_intervention"), is_a("purchase").alias("success"), is_a("error").alias("terminate"))
    out = pipeline.Pipeline([pipeline.Intervention()])(rows)
    return out.select("event_id", r6("action").alias("action"), "reward", "done")


@query("""WITH $EVENTS, q AS (SELECT event_id, user_id, t + 7 AS t FROM e WHERE event_type = 'view')
SELECT q.event_id, q.user_id, q.t, r.t AS r_t, r.value AS r_value FROM q JOIN e r ON r.user_id = q.user_id AND r.event_type = 'view' QUALIFY row_number() OVER (PARTITION BY q.event_id ORDER BY abs(r.t - q.t), r.t DESC) = 1""")
def frames_near_queries(spark, sf):
    """The frame nearest to each time asked for, which must be nearer than 8 us: none is missing here."""
    v = events(spark, sf).filter("event_type = 'view'")
    asked = v.select("event_id", "user_id", (F.col("t") + 7).alias("t"))
    return records.nearest_or_error(asked, v.select("user_id", "t", "value"), ["user_id"], "t", "value", 8)


@query("""WITH v AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
s AS (SELECT min(x) AS a, max(x) AS b FROM v), h AS (SELECT min(y) AS a, max(y) AS b FROM v)
SELECT vec_id, round(2 * (x - s.a) / (s.b - s.a) - 1, 6) AS own, round(2 * (x - h.a) / (h.b - h.a) - 1, 6) AS other FROM v, s, h""")
def swapped_stats(spark, sf):
    """A pipeline's normalisation with its own statistics, and with another's in their place."""
    v = _vectors(spark, sf).select("vec_id", F.slice("v", 1, 1).alias("x"), F.col("v")[1].alias("y"))
    a, b, c, d = v.agg(F.min(F.col("x")[0]), F.max(F.col("x")[0]), F.min("y"), F.max("y")).first()
    own = pipeline.Pipeline([pipeline.Normalise("x", [a], [b], "min_max")])
    other = own.with_stats({"x": {"min": [c], "max": [d]}})
    return own(v).select("vec_id", r6(F.col("x")[0]).alias("own")).join(other(v).select("vec_id", r6(F.col("x")[0]).alias("other")), "vec_id")


@query("""WITH $EVENTS, f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e)
SELECT a.event_id, d AS delta, b.event_id AS found, a.i + d < 0 OR a.i + d >= a.n AS is_pad FROM f a, (SELECT unnest([-3, 0, 2]) AS d) JOIN f b ON b.user_id = a.user_id AND b.i = greatest(0, least(a.n - 1, a.i + d))""")
def delta_times_as_offsets(spark, sf):
    """Times of -0.3, 0 and 0.2 s at ten frames a second are offsets of -3, 0 and 2 frames."""
    offsets = sequence.delta_indices([-0.3, 0.0, 0.2], 10.0)
    e = events(spark, sf).select("user_id", "event_id", "t")
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    f = e.withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    asked = f.select("user_id", "event_id", "i", "n", F.explode(F.array(*map(F.lit, offsets))).alias("delta"))
    at = F.greatest(F.lit(0), F.least(F.col("n") - 1, F.col("i") + F.col("delta")))
    found = f.select("user_id", F.col("i").alias("at"), F.col("event_id").alias("found"))
    pad = (F.col("i") + F.col("delta") < 0) | (F.col("i") + F.col("delta") >= F.col("n"))
    return asked.withColumn("at", at).join(found, ["user_id", "at"]).select("event_id", "delta", "found", pad.alias("is_pad"))
