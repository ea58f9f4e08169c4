"""Queries over scans and sinks, element-wise functions, schemas, checks and small reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chunk, image, png, rotation, scalar
from ..functions import vector as V
from ..operators import asof, edit, filters, quality, queues, records, sequence, stats
from ..sources import readers, writers
from ..streaming.local import folder
from . import pipeline, schema
from .queries_data import _BIN_STATS, _X
from .catalogue import BY, MINUTE, ON, ORDER, events, query, r6, table, topic

_V = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", V.doubles(F.col("embedding")).alias("v"))


def _part(first: int, n: int):
    """``n`` elements of the vector from the ``first`` on, counted from 1."""
    return F.slice("v", first, n)


def _at(i: int):
    return F.element_at("v", i)


def _long(df, col, *keys):
    rows = df.select(*keys, F.posexplode(V.doubles(col)).alias("dim", "value"))
    return rows.select(*keys, F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


def _each(expr: str, n: int) -> str:
    """SQL of one row for each of n elements; the expression knows v and i from 0."""
    return f"WITH {_V} SELECT vec_id, i AS dim, round({expr}, 6) AS value FROM v, (SELECT unnest(range({n})) AS i)"


def _f32(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


def _list(spark, rows, kinds):
    return spark.createDataFrame(rows, kinds)


# -- scans and sinks: what is written is read back --------------------------------------------------


def _written(spark, sf, write) -> str:
    path = folder(spark)
    write(path)
    return path


def _arm(spark, sf):
    return _vectors(spark, sf).select((F.col("vec_id") * 10_000_000).alias("ts_ns"), _part(1, 16).alias("values"))


@query(_each("v[i + 1]", 16).replace("SELECT vec_id, i", "SELECT vec_id * 10000000 AS ts_ns, i"))
def arm_text_lines(spark, sf):
    path = _written(spark, sf, lambda p: writers.arm_text(_arm(spark, sf), p))
    return _long(readers.arm_text(spark, path), F.col("values"), "ts_ns")


@query(_each("CASE WHEN i < 7 THEN v[i + 1] ELSE v[9] END", 8).replace("SELECT vec_id, i", "SELECT round(vec_id * CAST(0.01 AS DOUBLE), 6) AS timestamp, i"))
def arm_text_selected_lines(spark, sf):
    path = _written(spark, sf, lambda p: writers.arm_text(_arm(spark, sf), p))
    return _long(readers.arm_text_selected(spark, path), F.col("position"), r6("timestamp").alias("timestamp"))


_FAULTY = "CASE event_id % 5 WHEN 0 THEN event_id || ' 1,2,3' WHEN 1 THEN event_id || ',1,2,3' WHEN 2 THEN 'x' || event_id || ' 1,2,3' WHEN 3 THEN event_id || ' 1,2' ELSE event_id || ' 1,z,3' END"


@query(f"""SELECT {_FAULTY} AS value, CASE event_id % 5 WHEN 1 THEN 'no space' WHEN 2 THEN 'bad timestamp' WHEN 3 THEN 'wrong number of values' WHEN 4 THEN 'not a number' END AS error FROM events""")
def strict_lines(spark, sf):
    lines = table(spark, sf, "events").select(F.expr(_FAULTY).alias("value"))
    path = _written(spark, sf, lambda p: lines.write.text(p))
    return readers.arm_text_strict(spark, path, 3).select("value", "error")


@query("SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def json_line_round_trip(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    path = _written(spark, sf, lambda p: writers.json_lines(e, p))
    return readers.json_lines(spark, path, e.schema).withColumn("value", r6("value"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def tsv_report_round_trip(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = _written(spark, sf, lambda p: writers.tsv_report(c, p))
    return spark.read.option("sep", "\t").option("header", True).schema(c.schema).csv(path)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_round_trip(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = _written(spark, sf, lambda p: writers.csv(s, p))
    return spark.read.option("header", True).schema(s.schema).csv(path)


@query(f"WITH {_V}, x AS (SELECT i, v[i + 1] AS x FROM v, (SELECT unnest(range(64)) AS i)) SELECT i AS dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM x GROUP BY i")
def norm_stats_round_trip(spark, sf):
    s = stats.nested(stats.vector_stats(_vectors(spark, sf), "v")).select("mean", "std")
    path = _written(spark, sf, lambda p: writers.norm_stats(s, p))
    rows = readers.json_lines(spark, path, "mean array<double>, std array<double>").select(F.posexplode(F.arrays_zip("mean", "std")).alias("dim", "s"))
    return rows.select(F.col("dim").cast("long").alias("dim"), r6("s.mean").alias("mean"), r6("s.std").alias("std"))


def _recorded(spark, sf):
    return _vectors(spark, sf).select(F.col("label").cast("long").alias("episode_index"), "vec_id", "v", F.concat(F.lit("task "), (F.col("label") % 3).cast("string")).alias("task"))


@query("""WITH f AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS episode_index, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, row_number() OVER (ORDER BY label, vec_id) - 1 AS index, vec_id FROM embeddings)
SELECT episode_index, frame_index, index, vec_id, round(CAST(CAST(frame_index / 10.0 AS FLOAT) AS DOUBLE), 6) AS timestamp FROM f""")
def saved_episodes(spark, sf):
    """Frames as written by the episode writer and read by the nested scan."""
    path = folder(spark)
    writers.save_episodes(_recorded(spark, sf), path, ["vec_id"], 10.0)
    f = readers.frame_table(spark, f"{path}/data")
    return f.select("episode_index", "frame_index", "index", "vec_id", r6(F.col("timestamp").cast("double")).alias("timestamp"))


@query("""WITH n AS (SELECT label, count(*) AS length, 'task ' || (label % 3) AS task FROM embeddings GROUP BY label)
SELECT row_number() OVER (ORDER BY label) - 1 AS episode_index, length, task, CAST(sum(length) OVER (ORDER BY label) - length AS BIGINT) AS dataset_from_index, CAST(sum(length) OVER (ORDER BY label) AS BIGINT) AS dataset_to_index FROM n""")
def saved_episode_table(spark, sf):
    path = folder(spark)
    writers.save_episodes(_recorded(spark, sf), path, ["vec_id"], 10.0)
    return readers.episode_table(spark, f"{path}/meta/episodes").select("episode_index", "length", F.array_join("tasks", ",").alias("task"), "dataset_from_index", "dataset_to_index")


@query("SELECT DISTINCT 'task ' || (label % 3) AS task, label % 3 AS of FROM embeddings")
def saved_task_table(spark, sf):
    path = folder(spark)
    writers.save_episodes(_recorded(spark, sf), path, ["vec_id"], 10.0)
    return readers.task_table(spark, f"{path}/meta/tasks").select("task", F.substring("task", 6, 1).cast("int").alias("of"))


@query("SELECT label, count(*) AS n, sum(vec_id)::BIGINT AS ids FROM embeddings GROUP BY label")
def split_by_episode(spark, sf):
    path = _written(spark, sf, lambda p: writers.by_episode(table(spark, sf, "embeddings").select("vec_id", "label"), p, "label"))
    return spark.read.parquet(path).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("ids"))


@query("SELECT vec_id, label, CAST(NULL AS INT) AS extra FROM embeddings UNION ALL SELECT vec_id + 1000000, label, 7 FROM embeddings WHERE label = 1")
def append_frames(spark, sf):
    old = table(spark, sf, "embeddings").select("vec_id", "label")
    a, b = folder(spark), folder(spark)
    old.write.parquet(a)
    writers.append(a, old.filter("label = 1").select((F.col("vec_id") + 1_000_000).alias("vec_id"), "label", F.lit(7).alias("extra")), b)
    return spark.read.parquet(b)


@query("SELECT vec_id, label FROM embeddings WHERE label IN (1, 3, 5)")
def episode_scan(spark, sf):
    """Episode filter and columns reach the scan."""
    return readers.frame_table(spark, f"{sf}/embeddings.parquet", [1, 3, 5], ["vec_id", "label"], episode="label")


@query("SELECT n_nationkey, n_name FROM nation")
def episode_table_without_stats(spark, sf):
    path = _written(spark, sf, lambda p: table(spark, sf, "nation").withColumnRenamed("n_regionkey", "stats/region").write.parquet(p))
    return readers.episode_table(spark, path)


@query("SELECT l_orderkey // 500 AS chunk, CAST(l_linenumber AS BIGINT) AS frame_id, 1000 * l_orderkey AS ts_ns FROM lineitem")
def image_names(spark, sf):
    path = F.concat(F.lit("/data/"), F.floor(F.col("l_orderkey") / 500).cast("string"), F.lit("/"), F.lpad(F.col("l_linenumber").cast("string"), 6, "0"), F.lit("_"), (1000 * F.col("l_orderkey")).cast("string"), F.lit(".jpg"))
    named = table(spark, sf, "lineitem").withColumn("path", path)
    return named.select(F.split("path", "/")[2].cast("long").alias("chunk"), *readers.image_name(F.col("path")))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id * 10 ELSE event_id * 10 + 5 END AS ts_ns FROM events")
def message_times(spark, sf):
    m = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_id") * 10).otherwise(F.lit(-1)).alias("stamp_ns"), (F.col("event_id") * 10 + 5).alias("recv_ns"))
    return readers.topic_stream(m, -1).select("event_id", "ts_ns")


@query(f"WITH {_V} SELECT vec_id, i AS step, round(v[i + 1], 6) AS frame FROM v, (SELECT unnest(range(64)) AS i)")
def trajectory_frames(spark, sf):
    rows = readers.trajectories_to_frames(_vectors(spark, sf).select("vec_id", "v"), "v")
    return rows.select("vec_id", F.col("step").cast("long").alias("step"), r6("frame").alias("frame"))


@query("""WITH p AS (SELECT label, vec_id, i, v[CASE WHEN i < 7 THEN i + 1 WHEN i = 7 THEN 15 WHEN i < 15 THEN i ELSE 24 END] AS x FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 20) AS v FROM embeddings), (SELECT unnest(range(16)) AS i)),
g AS (SELECT label, max(x) > 2 AS big FROM p WHERE i IN (7, 15) GROUP BY label) SELECT vec_id, i AS dim, round(CASE WHEN i IN (7, 15) AND big THEN x / 1000 ELSE x END, 6) AS value FROM p JOIN g USING (label)""")
def legacy_vectors(spark, sf):
    v = _vectors(spark, sf).select("vec_id", "label", V.scale(_part(1, 32), 20.0).alias("state"))
    return _long(readers.legacy_vectors(v, ["label"], ["state"]), F.col("state"), "vec_id")


@query("SELECT event_id, 16 AS n_values, true AS inside FROM events")
def mock_arm_walk(spark, sf):
    """A generated walk beside each event; it stays inside its limits."""
    e = table(spark, sf, "events").select("event_id")
    walk = readers.mock_arms(spark, e.agg(F.max("event_id")).first()[0] + 1, 16, hz=1.0, seed=3).withColumn("event_id", F.expr("ts_ns div 1000000000"))
    inside = F.forall("position", lambda x: F.abs(x) <= 3.14 + 1e-9)
    return e.join(walk, "event_id").select("event_id", F.size("position").alias("n_values"), inside.alias("inside"))


@query("SELECT vec_id, label, 5 AS n_state, 3 AS n_actions, true AS inside FROM embeddings")
def fake_vectors(spark, sf):
    """A generated row beside each vector."""
    v = table(spark, sf, "embeddings").select("vec_id", "label")
    f = readers.fake_rows(spark, {"state": 5, "actions": 3}, v.agg(F.max("vec_id")).first()[0] + 1)
    inside = F.forall("state", lambda x: (x >= -1) & (x < 1)) & F.forall("actions", lambda x: (x >= -1) & (x < 1))
    return v.join(f, v.vec_id == f.id).select("vec_id", "label", F.size("state").alias("n_state"), F.size("actions").alias("n_actions"), inside.alias("inside"))


# -- vectors ---------------------------------------------------------------------------------------


def _dual(gripper: int, by: str) -> str:
    return _f32(f"CASE WHEN i < 7 THEN v[i + 1] WHEN i = 7 THEN v[{gripper}]{by} WHEN i < 15 THEN v[i + 2] ELSE v[{gripper + 9}]{by} END")


@query(_each(_dual(9, " / 100"), 16))
def dual_arm_state(spark, sf):
    return _long(_vectors(spark, sf), V.dual_arm_state(_part(1, 9), _part(10, 9)), "vec_id")


@query(_each(_dual(9, " / 100"), 16))
def dual_arm_action_open(spark, sf):
    return _long(_vectors(spark, sf), V.dual_arm_action(_part(1, 9), _part(10, 9), "open_value"), "vec_id")


@query(_each(_dual(8, ""), 16))
def dual_arm_action_bin(spark, sf):
    return _long(_vectors(spark, sf), V.dual_arm_action(_part(1, 9), _part(10, 9), "bin"), "vec_id")


@query(f"""WITH {_V} SELECT vec_id, vec_id % 3 <> 0 AS ok, CASE WHEN vec_id % 3 <> 0 THEN round({_f32('v[9] / 100')}, 6) END AS opening FROM v""")
def dual_arm_vectors(spark, sf):
    right = F.when(F.col("vec_id") % 3 == 0, _part(10, 8)).otherwise(_part(10, 9))
    state, action = V.dual_arm_vectors(_part(1, 9), right)
    return _vectors(spark, sf).select("vec_id", (state.isNotNull() & action.isNotNull()).alias("ok"), r6(F.get(state, F.lit(7)).cast("double")).alias("opening"))


@query(_each("CASE WHEN i BETWEEN 2 AND 5 THEN v[i - 1] WHEN i BETWEEN 8 AND 10 THEN v[i - 3] ELSE 0 END", 12))
def scatter_by_name(spark, sf):
    return _long(_vectors(spark, sf), V.scatter({"a": _part(1, 4), "b": _part(5, 3)}, {"a": (2, 4), "b": (8, 3)}, 12), "vec_id")


@query(_each("CASE WHEN abs(v[i + 1]) > 0.1 THEN 0 ELSE v[i + 1] END", 64))
def outliers_to_zero(spark, sf):
    return _long(_vectors(spark, sf), V.outliers_to_zero(F.col("v"), 0.1), "vec_id")


@query(_each("CASE WHEN i IN (7, 15) THEN greatest(0, least(70, 400 * v[i + 1])) ELSE greatest(-(pi() - 0.001), least(pi() - 0.001, 400 * v[i + 1])) END", 16))
def clip_dual_arm(spark, sf):
    return _long(_vectors(spark, sf), V.clip_dual_arm(V.scale(_part(1, 16), 400.0)), "vec_id")


@query(f"WITH {_V} SELECT vec_id, v[1] BETWEEN -0.1 AND 0.2 AND v[2] BETWEEN -0.2 AND 0.1 AS ok FROM v")
def limits_ok(spark, sf):
    return _vectors(spark, sf).select("vec_id", quality.limits_ok(_part(1, 2), [-0.1, -0.2], [0.2, 0.1]).alias("ok"))


@query(f"""WITH {_V} SELECT vec_id, step, i AS dim, round(v[i + 1] + (v[i + 9] - v[i + 1]) * step / 4.0, 6) AS value FROM v, (SELECT unnest(range(5)) AS step), (SELECT unnest(range(8)) AS i)""")
def linear_interpolation(spark, sf):
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(V.interpolate(_part(1, 8), _part(9, 8), 5)).alias("step", "row"))
    return _long(rows.withColumn("step", F.col("step").cast("long")), F.col("row"), "vec_id", "step")


@query(f"""WITH {_V}, a AS (SELECT *, r / 2 AS u FROM v, (SELECT unnest(range(3)) AS r), (SELECT unnest(range(4)) AS i)), s AS (SELECT *, 3 * u * u - 2 * u * u * u AS w, v[4 * r + i + 1] AS x, v[13 + i] AS y FROM a)
SELECT vec_id, r AS step, i AS dim, round(CASE WHEN i = 3 THEN CASE WHEN w >= 0.5 THEN x ELSE y END ELSE y * (1 - w) + x * w END, 6) AS value FROM s""")
def smoothstep_head(spark, sf):
    seq = F.array(_part(1, 4), _part(5, 4), _part(9, 4))
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(chunk.blended_head(seq, _part(13, 4), 3, [3])).alias("step", "row"))
    return _long(rows.withColumn("step", F.col("step").cast("long")), F.col("row"), "vec_id", "step")


_BIN = "greatest(-1, least(255, floor((v[{}] * 4 + 1) * 128)))"


@query(f"""WITH {_V} SELECT vec_id, h AS step, i AS dim, round({_BIN.format('3 * h + i + 1')} / 256.0 * 2 - 1, 6) AS value FROM v, (SELECT unnest(range(2)) AS h), (SELECT unnest(range(3)) AS i)""")
def undigitize_actions(spark, sf):
    tokens = V.digitize(V.scale(_part(1, 6), 4.0))
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(V.undigitize(tokens, 2, 3)).alias("step", "row"))
    return _long(rows.withColumn("step", F.col("step").cast("long")), F.col("row"), "vec_id", "step")


@query(f"""WITH {_V} SELECT vec_id, i AS dim, CAST(CASE WHEN i < least(6, vec_id % 9) THEN {_BIN.format('i + 1')} ELSE 0 END AS INT) AS token, i < least(6, vec_id % 9) AS real FROM v, (SELECT unnest(range(6)) AS i)""")
def tokens_with_mask(spark, sf):
    tokens = F.slice(V.digitize(V.scale(F.col("v"), 4.0)), F.lit(1), (F.col("vec_id") % 9).cast("int"))
    cut, real = V.tokens_with_mask(tokens, 6)
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(F.arrays_zip(cut.alias("token"), real.alias("real"))).alias("dim", "z"))
    return rows.select("vec_id", F.col("dim").cast("long").alias("dim"), F.col("z.token").alias("token"), F.col("z.real").alias("real"))


@query(_each("CASE WHEN i < 3 OR i >= 5 THEN v[i + 1] ELSE 0 END", 7))
def bool_mask(spark, sf):
    """Vectors with zeros where a mask built from run lengths is false."""
    keep = F.array(*map(F.lit, V.bool_mask(3, -2, 2)))
    return _long(_vectors(spark, sf), F.zip_with(_part(1, 7), keep, lambda x, k: F.when(k, x).otherwise(0.0)), "vec_id")


@query(_each("CASE WHEN i IN (1, 3) THEN -v[i + 1] ELSE v[i + 1] END", 6))
def joint_flip(spark, sf):
    return _long(_vectors(spark, sf), V.flip(_part(1, 6), [1, -1, 1, -1, 1, 1]), "vec_id")


@query(f"WITH {_V} SELECT vec_id, sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3]) > 0.2 AS moves, round(v[1] * 2, 6) AS dx, round(v[2] * 2, 6) AS dy FROM v")
def delta_to_action(spark, sf):
    moves, motion = V.delta_to_action(_part(1, 3), 2.0, 0.2)
    return _vectors(spark, sf).select("vec_id", moves.alias("moves"), r6(F.get(motion, F.lit(0))).alias("dx"), r6(F.get(motion, F.lit(1))).alias("dy"))


@query(f"WITH {_V} SELECT vec_id, round(v[1], 6) AS x, round(v[2], 6) AS y, round(v[3], 6) AS z FROM v")
def vector_to_columns(spark, sf):
    d = _vectors(spark, sf).select("vec_id", *V.named(_part(1, 3), ["x", "y", "z"]))
    return d.select("vec_id", *(r6(c).alias(c) for c in "xyz"))


_ABS = "least(100, abs(v[1]) * 400)"


@query(f"WITH {_V} SELECT vec_id, CASE WHEN ({_ABS} < 50 AND v[2] * 100 + 50 > 50) OR ({_ABS} > 75 AND v[2] * 100 + 50 < 50) THEN -0.01 ELSE 0 END AS penalty FROM v".replace("-0.01 ELSE 0", "CAST(-0.01 AS DOUBLE) ELSE CAST(0 AS DOUBLE)"))
def gripper_penalty(spark, sf):
    position = F.least(F.lit(100.0), F.abs(_at(1)) * 400)
    return _vectors(spark, sf).select("vec_id", V.gripper_penalty(_at(2) * 100 + 50, position).alias("penalty"))


@query(f"WITH {_V} SELECT vec_id, round(greatest(0, least(70, (v[1] * 100 + 5) * 70 / 40)), 6) AS gripper FROM v")
def gripper_rescale(spark, sf):
    return _vectors(spark, sf).select("vec_id", r6(V.rescale_gripper(_at(1), -5.0, 40.0)).alias("gripper"))


@query(_each("greatest(0.25, least(1.0, v[i + 1] - v[1] + abs(v[9]) * 4))", 8))
def gripper_align(spark, sf):
    return _long(_vectors(spark, sf), V.align_gripper_chunk(_part(1, 8), F.abs(_at(9)) * 4), "vec_id")


@query(f"WITH {_V} SELECT vec_id, round(CASE WHEN v[1] * 20 < 2 THEN 0 ELSE v[1] * 20 END, 6) AS held, round(CASE WHEN v[1] * 2000 / 100 < 2 THEN 0 ELSE v[1] * 2000 / 100 END, 6) AS raw FROM v")
def small_gripper_to_zero(spark, sf):
    return _vectors(spark, sf).select("vec_id", r6(V.small_to_zero(_at(1) * 20)).alias("held"), r6(V.small_to_zero(_at(1) * 2000, raw=True)).alias("raw"))


@query(f"WITH {_V} SELECT vec_id, i AS k, round(vec_id + i * CAST(0.1 AS DOUBLE), 6) AS timestamp, vec_id * 4 + i AS timestep, round(v[i + 1], 6) AS action FROM v, (SELECT unnest(range(4)) AS i)")
def chunk_timing(spark, sf):
    steps = V.time_chunk(F.col("vec_id").cast("double"), 0.1, F.col("vec_id") * 4, _part(1, 4))
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(steps).alias("k", "s"))
    return rows.select("vec_id", F.col("k").cast("long").alias("k"), r6("s.timestamp").alias("timestamp"), F.col("s.timestep").alias("timestep"), r6("s.action").alias("action"))


@query(f"WITH {_V} SELECT vec_id, vec_id % 4 = 0 AS bad FROM v")
def nan_check(spark, sf):
    v = F.when(F.col("vec_id") % 4 == 0, F.array_append("v", F.lit(float("nan")))).otherwise(F.col("v"))
    return _vectors(spark, sf).select("vec_id", V.has_nan(v).alias("bad"))


@query(_each("CASE WHEN i < 2 THEN v[i + 1] ELSE greatest(0, least(1, v[i + 1] * 8000 / 1000)) END", 4))
def scaled_clip(spark, sf):
    v = F.transform("v", lambda x, i: F.when(i < 2, x).otherwise(x * 8000))
    return _long(_vectors(spark, sf), V.scaled_clip(v, [0, 1], [2, 3]), "vec_id")


@query(f"WITH {_V} SELECT vec_id, CAST(1 AS INT) AS n, round(v[1], 6) AS first, vec_id % 2 = 0 AS gone FROM v")
def batch_dimension(spark, sf):
    b = V.batched(F.col("v"))
    two = F.when(F.col("vec_id") % 2 == 0, F.array("v", "v")).otherwise(b)
    return _vectors(spark, sf).select("vec_id", F.size(b).alias("n"), r6(F.get(V.unbatched(b), F.lit(0))).alias("first"), V.unbatched(two).isNull().alias("gone"))


@query(_each("v[i + 1]", 5))
def unwrapped_vectors(spark, sf):
    d = _vectors(spark, sf).select("vec_id", F.array(_part(1, 5)).alias("a"))
    return _long(schema.unwrapped(d, "a"), F.col("a"), "vec_id")


_Q = "q AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3] + v[4] * v[4])) AS p, list_transform(v[5:8], lambda x: x / sqrt(v[5] * v[5] + v[6] * v[6] + v[7] * v[7] + v[8] * v[8])) AS q, v[9:11] AS u FROM v)"


@query(f"""WITH {_V}, {_Q}, c AS (SELECT vec_id, [p[4] * q[1] + p[1] * q[4] + p[2] * q[3] - p[3] * q[2], p[4] * q[2] - p[1] * q[3] + p[2] * q[4] + p[3] * q[1], p[4] * q[3] + p[1] * q[2] - p[2] * q[1] + p[3] * q[4], p[4] * q[4] - p[1] * q[1] - p[2] * q[2] - p[3] * q[3]] AS c FROM q)
SELECT vec_id, i AS dim, round(c[i + 1], 6) AS value FROM c, (SELECT unnest(range(4)) AS i)""")
def rotation_compose(spark, sf):
    d = _vectors(spark, sf).select("vec_id", rotation.normalised(_part(1, 4)).alias("p"), rotation.normalised(_part(5, 4)).alias("q"))
    return _long(d, rotation.compose(F.col("p"), F.col("q")), "vec_id")


@query(f"WITH {_V} SELECT vec_id, i AS dim, round(v[9 + i], 6) AS value FROM v, (SELECT unnest(range(3)) AS i)")
def rotation_there_and_back(spark, sf):
    """A vector turned by a rotation and by its inverse is itself; the rotation goes through its matrix and its vector."""
    q = rotation.normalised(_part(1, 4))
    d = _vectors(spark, sf).select("vec_id", "v", q.alias("q")).withColumn("m", rotation.from_matrix(rotation.to_matrix(F.col("q"))))
    d = d.withColumn("w", rotation.from_rotation_vector(rotation.axis_angle(F.col("m"))))
    return _long(d.withColumn("t", rotation.apply(F.col("w"), _part(9, 3))), rotation.apply(rotation.inverse(F.col("w")), F.col("t")), "vec_id")


@query(f"""WITH {_V}, {_Q}, t AS (SELECT vec_id, u, p, [p[2] * u[3] - p[3] * u[2], p[3] * u[1] - p[1] * u[3], p[1] * u[2] - p[2] * u[1]] AS c FROM q)
SELECT vec_id, i AS dim, round(u[i + 1] + 2 * (p[4] * c[i + 1] + CASE i WHEN 0 THEN p[2] * c[3] - p[3] * c[2] WHEN 1 THEN p[3] * c[1] - p[1] * c[3] ELSE p[1] * c[2] - p[2] * c[1] END), 6) AS value FROM t, (SELECT unnest(range(3)) AS i)""")
def rotation_apply(spark, sf):
    return _long(_vectors(spark, sf), rotation.apply(rotation.normalised(_part(1, 4)), _part(9, 3)), "vec_id")


@query(f"""WITH {_V}, {_Q}, w AS (SELECT vec_id, p, u, greatest(-1, least(1, p[4])) AS w FROM q), k AS (SELECT *, 2 * acos(w) / sqrt(1 - w * w) AS k FROM w)
SELECT vec_id, i AS dim, round(CASE WHEN i < 3 THEN u[i + 1] WHEN i < 6 THEN p[i - 2] * k ELSE 0.5 END, 6) AS value FROM k, (SELECT unnest(range(7)) AS i)""")
def pose_state(spark, sf):
    return _long(_vectors(spark, sf), rotation.pose_state(_part(9, 3), rotation.normalised(_part(1, 4)), F.array(F.lit(0.5))), "vec_id")


# -- strings, times, names -----------------------------------------------------------------------


@query("SELECT event_id, event_id * 1000000000 + event_id % 1000 AS ns, round(event_id + (event_id % 1000) * 1e-9, 9) AS sec FROM events")
def stamps(spark, sf):
    sec, nano = F.col("event_id"), F.col("event_id") % 1000
    return table(spark, sf, "events").select("event_id", scalar.stamp_to_ns(sec, nano).alias("ns"), F.round(scalar.stamp_to_sec(sec, nano), 9).alias("sec"))


@query("SELECT event_id, CAST(event_id % 7200 AS INT) AS seconds, CAST(event_id % 60 AS INT) AS bare FROM events")
def clock_seconds(spark, sf):
    s = F.col("event_id") % 7200
    clock = F.format_string("%02d:%02d", F.floor(s / 60), s % 60)
    return table(spark, sf, "events").select("event_id", scalar.clock_to_sec(clock).alias("seconds"), scalar.clock_to_sec((F.col("event_id") % 60).cast("string")).alias("bare"))


@query("SELECT o_orderkey, printf('chunk-%03d', o_orderkey // 1000) AS chunk FROM orders")
def chunk_names(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", scalar.chunk_name(F.col("o_orderkey")).alias("chunk"))


@query(f"""WITH {_V} SELECT vec_id, 'Task: pick_up ' || label || ', State: ' || array_to_string(list_transform(v[1:3], lambda x: CAST(CAST(greatest(-1, least(255, floor((x * 4 + 1) * 128))) AS INT) AS VARCHAR)), ' ') || ';' || chr(10) AS prompt FROM v""".replace("pick_up", "pick up"))
def prompt_template(spark, sf):
    prompt = F.concat(F.lit(" Pick_UP "), F.col("label").cast("string"), F.lit(" "))
    return _vectors(spark, sf).select("vec_id", scalar.prompt_with_state(prompt, V.digitize(V.scale(_part(1, 3), 4.0))).alias("prompt"))


@query("SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer")
def strip_prefixes(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(*(F.col(n).alias(scalar.strip_prefix(n, ["x_", "c_"])) for n in c.columns))


@query(f"""WITH {_V}, c AS (SELECT vec_id, list_transform(v[1:16], lambda x: CAST(floor(abs(x) * 20) AS INT) % 3) AS c FROM v),
f AS (SELECT vec_id, i, c[i + 1] AS code FROM c, (SELECT unnest(range(14)) AS i))
SELECT vec_id, bool_or(code <> 0) AS fault, coalesce(string_agg('motor ' || i || ': ' || CASE code WHEN 1 THEN 'over current' ELSE 'code 2' END, '; ' ORDER BY i) FILTER (code <> 0), '') AS faults FROM f GROUP BY vec_id""")
def motor_faults(spark, sf):
    codes = F.transform(_part(1, 16), lambda x: F.floor(F.abs(x) * 20).cast("int") % 3)
    any_, text = scalar.motor_faults(F.col("codes"), {1: "over current"})
    return _vectors(spark, sf).select("vec_id", codes.alias("codes")).select("vec_id", any_.alias("fault"), text.alias("faults"))


@query("""SELECT o_orderkey, 'v2.' || (o_orderkey % 5) AS wanted, 'v2.' || CASE WHEN o_orderkey % 5 >= 3 THEN 3 WHEN o_orderkey % 5 >= 1 THEN 1 ELSE 0 END AS found FROM orders""")
def safe_versions(spark, sf):
    """The version that each row's wanted one resolves to."""
    found = {w: schema.safe_version(w, ["v1.9", "v2.0", "v2.1", "v2.3", "v3.0"]) for w in (f"v2.{i}" for i in range(5))}
    wanted = F.concat(F.lit("v2."), (F.col("o_orderkey") % 5).cast("string"))
    lookup = F.create_map(*(F.lit(x) for pair in found.items() for x in pair))
    return table(spark, sf, "orders").select("o_orderkey", wanted.alias("wanted")).withColumn("found", lookup[F.col("wanted")])


# -- schemas ---------------------------------------------------------------------------------------


@query('SELECT vec_id AS id, label AS "obs/label", vec_id % 7 AS "obs/more/rest" FROM embeddings')
def repack_and_flatten(spark, sf):
    d = table(spark, sf, "embeddings").select("vec_id", F.struct("label", (F.col("vec_id") % 7).alias("rest")).alias("in"))
    return schema.flattened(schema.repack(d, {"id": "vec_id", "obs": {"label": "in/label", "more": {"rest": "in/rest"}}}))


@query("SELECT vec_id AS id, label AS a, vec_id % 5 AS c FROM embeddings")
def unflatten(spark, sf):
    d = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("x/a"), (F.col("vec_id") % 5).alias("x/b/c"))
    return schema.unflattened(d).select(F.col("vec_id").alias("id"), "x.a", "x.b.c")


@query("SELECT n_nationkey AS key, n_name AS label, n_regionkey FROM nation")
def rename_step(spark, sf):
    return pipeline.Rename({"n_nationkey": "key", "n_name": "label"}).apply(table(spark, sf, "nation"))


@query("SELECT n_nationkey AS nation_id, n_regionkey AS region_id FROM nation")
def rename_by_patterns(spark, sf):
    return schema.renamed(table(spark, sf, "nation"), {r"n_(\w+)key": r"\1_id", "n_name": None})


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role ELSE 'none' END AS role, 'todo' AS prompt FROM conversations")
def inject_defaults(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.col("role")).alias("role"))
    return pipeline.Default("prompt", "todo").apply(pipeline.Default("role", "none").apply(c))


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def remove_strings(spark, sf):
    return schema.without_strings(table(spark, sf, "customer"))


@query("SELECT c_name, c_nationkey, c_acctbal FROM customer")
def select_columns_by_pattern(spark, sf):
    return schema.select_matching(table(spark, sf, "customer"), ["^c_n", "bal$"])


@query("SELECT c_custkey, round(c_acctbal * 2, 6) AS c_acctbal FROM customer")
def apply_to_columns(spark, sf):
    d = schema.apply_to(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), {"c_acctbal": lambda c: c * 2, "nothing": lambda c: c + 1})
    return d.select("c_custkey", r6("c_acctbal").alias("c_acctbal"))


@query("SELECT CAST(vec_id AS BIGINT) AS index, round(CAST(CAST(vec_id * 0.1 AS FLOAT) AS DOUBLE), 5) AS timestamp FROM embeddings")
def typed_frames(spark, sf):
    kinds = schema.struct({})
    kinds = type(kinds)([f for f in kinds.fields if f.name in ("index", "timestamp")])
    d = schema.typed(table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("index"), (F.col("vec_id") * 0.1).alias("timestamp")), kinds)
    return d.select("index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"))


@query("""WITH f AS (SELECT unnest(['action', 'observation.environment_state', 'observation.state', 'speed']) AS name, unnest(['action', 'environment', 'state', 'other']) AS kind, unnest([7, 3, 6, 1]) AS n)
SELECT name, kind, count(*) AS frames, CAST(count(*) * any_value(n) AS BIGINT) AS elements FROM embeddings, f GROUP BY name, kind""")
def feature_kinds(spark, sf):
    """Kinds of a frame table's features, with what the table holds of each."""
    sizes = {"action": 7, "observation.environment_state": 3, "observation.state": 6, "speed": 1}
    kinds = schema.kinds(schema.struct({k: ("float32", (n,)) for k, n in sizes.items()}))
    frames = _vectors(spark, sf).select(*(_part(1, n).alias(k) for k, n in sizes.items()))
    rows = frames.select(F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.lit(kinds[k]).alias("kind"), F.size(f"`{k}`").alias("n")) for k in sizes))).alias("f"))
    return rows.groupBy("f.name", "f.kind").agg(F.count(F.lit(1)).alias("frames"), F.sum("f.n").alias("elements"))


@query("SELECT * FROM (VALUES ('column c_name: string, expected int'), ('extra column c_mktsegment'), ('missing column c_phone')) t(error)")
def schema_report(spark, sf):
    c = table(spark, sf, "customer")
    expected = {k: t for k, t in c.dtypes if k != "c_mktsegment"} | {"c_name": "int", "c_phone": "string"}
    return _list(spark, [(e,) for e in sorted(quality.schema_errors(c, expected))], "error string")


@query("SELECT 'customer' AS name, 0 AS n_errors UNION ALL SELECT 'nation', 8")
def parquet_conformance(spark, sf):
    expected = dict(table(spark, sf, "customer").dtypes)
    found = quality.parquet_report(spark, [f"{sf}/customer.parquet", f"{sf}/nation.parquet"], expected)
    return _list(spark, [(p.rsplit("/", 1)[1].split(".")[0], len(e)) for p, e in found], "name string, n_errors int")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INT) AS l_quantity, l_linenumber FROM lineitem")
def conformed(spark, sf):
    return quality.conform(table(spark, sf, "lineitem"), {"l_orderkey": "string", "l_quantity": "int", "l_linenumber": "int"})


@query("SELECT * FROM (VALUES ('c_custkey'), ('c_name')) t(name)")
def common_features(spark, sf):
    c = table(spark, sf, "customer")
    return _list(spark, [(n,) for n in filters.common_columns([c.select("c_custkey", "c_name", "c_acctbal"), c.select("c_name", "c_custkey")])], "name string")


# -- checks, filters, order -------------------------------------------------------------------------


@query("""WITH $EVENTS, n AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'view') AS d FROM e GROUP BY user_id)
SELECT user_id, CASE WHEN d > 0 AND abs(c - d) / CAST(nullif(c, 0) AS DOUBLE) > 0.2 THEN 'click and view: frame counts differ' END AS depth_error FROM n""")
def qc_depth(spark, sf):
    counts = quality.stream_counts(events(spark, sf), BY, "event_type", ["click", "view"])
    return quality.depth_check(counts, "click", "view", 0.2).select("user_id", "depth_error")


@query("""WITH $EVENTS, n AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'view') AS d, count(*) FILTER (event_type = 'signup') AS s FROM e GROUP BY user_id)
SELECT user_id, CASE WHEN c < 2 OR d < 2 THEN 'not_enough_images' WHEN s = 0 THEN 'missing_arm_data' WHEN c < 4 THEN 'head_sequence_too_short' END AS skip_reason FROM n""")
def skip_reasons(spark, sf):
    counts = quality.stream_counts(events(spark, sf), BY, "event_type", ["click", "view", "signup"])
    return quality.skip_reason(counts, ["n_click", "n_view"], ["n_signup"], 2, 4, "n_click").select("user_id", "skip_reason")


@query("SELECT event_id, user_id FROM events WHERE event_id % 3 = 0")
def mask_frames(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return filters.mask_frames(e, e.withColumn("keep", F.col("event_id") % 3 == 0), "user_id", "event_id")


@query("""WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), k AS (SELECT *, least(n, 7) AS k FROM n)
SELECT user_id, CAST(j AS INT) AS i, CAST(CASE WHEN k <= 1 THEN 0 WHEN j = k - 1 THEN n - 1 ELSE round_even(j * ((n - 1) / (k - 1)), 0) END AS INT) AS position FROM k, (SELECT unnest(range(7)) AS j) WHERE j < k""")
def stats_sample_positions(spark, sf):
    n = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return n.select("user_id", F.posexplode(stats.sample_positions(F.col("n"), F.least(F.col("n"), F.lit(7)))).alias("i", "position"))


@query("""WITH n AS (SELECT 'type ' || event_type AS of, count(*) AS n FROM events GROUP BY event_type UNION ALL SELECT 'all events', count(*) FROM events UNION ALL SELECT 'label ' || label, count(*) FROM embeddings GROUP BY label)
SELECT of, n, CASE WHEN n < 100 THEN n ELSE greatest(100, least(10000, CAST(floor(pow(n, 0.75)) AS BIGINT))) END AS k FROM n""")
def stats_sample_sizes(spark, sf):
    """How many frames of groups of any size the statistics look at."""
    e = table(spark, sf, "events")
    n = F.count(F.lit(1)).alias("n")
    groups = e.groupBy(F.concat(F.lit("type "), "event_type").alias("of")).agg(n).unionByName(e.select(F.lit("all events").alias("of")).groupBy("of").agg(n))
    groups = groups.unionByName(table(spark, sf, "embeddings").groupBy(F.concat(F.lit("label "), F.col("label").cast("string")).alias("of")).agg(n))
    return groups.withColumn("k", stats.sample_size_of(F.col("n")))


@query("SELECT event_id FROM events WHERE event_id % 4 = 1")
def shard_rows(spark, sf):
    return filters.shard(table(spark, sf, "events"), "event_id", 1, 4).select("event_id")


@query("SELECT event_id, row_number() OVER (ORDER BY event_id % 10, event_id) - 1 AS place FROM events")
def offset_major(spark, sf):
    """The order itself, as the rows' places in it."""
    e = filters.offset_major(table(spark, sf, "events").select("event_id"), "event_id", 10).withColumn("offset", F.col("event_id") % 10).withColumn("one", F.lit(1))
    return edit.running(e, {"one": "place"}, ["offset", "event_id"]).select("event_id", "place")


@query("SELECT event_id, row_number() OVER (ORDER BY CAST('0x' || substr(md5('7:order:' || event_id), 1, 13) AS BIGINT), event_id) - 1 AS place FROM events")
def shuffled_rows(spark, sf):
    """The shuffled order itself, as the rows' places in it."""
    e = table(spark, sf, "events").select("event_id").withColumn("draw", filters.shuffle_key(7, ["event_id"])).withColumn("one", F.lit(1))
    return edit.running(e, {"one": "place"}, ["draw", "event_id"]).select("event_id", "place")


@query("SELECT n_nationkey, r AS round FROM nation, (SELECT unnest(range(3))::INT AS r)")
def cycled_rows(spark, sf):
    return filters.cycled(table(spark, sf, "nation").select("n_nationkey"), 3)


@query("SELECT vec_id, label, 0 AS dataset_index FROM embeddings UNION ALL SELECT vec_id, label, 1 FROM embeddings WHERE label < 3")
def multi_view(spark, sf):
    e = table(spark, sf, "embeddings")
    return edit.multi_view([e.select("vec_id", "label", "embedding"), e.filter("label < 3").select("label", "vec_id")])


@query("SELECT n_nationkey, coalesce(CASE WHEN n_regionkey < 3 THEN n_regionkey + 10 END, 99) AS dst_chunk, coalesce(CASE WHEN n_regionkey < 3 THEN 5 END, 7) AS dst_file, n_nationkey + CASE WHEN n_regionkey < 3 THEN 0.5 ELSE 0 END AS from_timestamp, n_nationkey + 1 + CASE WHEN n_regionkey < 3 THEN 0.5 ELSE 0 END AS to_timestamp FROM nation".replace("n_nationkey + CASE", "CAST(n_nationkey + CASE").replace("END AS from_timestamp", "END AS DOUBLE) AS from_timestamp").replace("n_nationkey + 1 + CASE", "CAST(n_nationkey + 1 + CASE").replace("END AS to_timestamp", "END AS DOUBLE) AS to_timestamp"))
def remap_files(spark, sf):
    meta = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("chunk"), F.col("n_nationkey").cast("double").alias("from_timestamp"), (F.col("n_nationkey") + 1).cast("double").alias("to_timestamp"))
    to = table(spark, sf, "region").filter("r_regionkey < 3").select(F.col("r_regionkey").alias("chunk"), (F.col("r_regionkey") + 10).alias("dst_chunk"), F.lit(5).alias("dst_file"), F.lit(0.5).alias("shift"))
    return edit.remap_files(meta, to, ["chunk"], (99, 7), "shift").select("n_nationkey", "dst_chunk", "dst_file", "from_timestamp", "to_timestamp")


@query("SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer")
def zipped_metadata(spark, sf):
    c = table(spark, sf, "customer")
    return edit.zip_metadata([c.select("c_custkey", "c_name"), c.select("c_custkey", "c_acctbal"), c.select("c_custkey", "c_nationkey")], "c_custkey")


@query("SELECT split_part(url, '/', 3) AS host, min(page_id) AS page_id FROM pages GROUP BY ALL")
def first_of_paths(spark, sf):
    host = F.get(F.split("url", "/"), F.lit(2))
    return edit.first_of_paths(table(spark, sf, "pages").select("page_id", "url"), host, "page_id").select(host.alias("host"), "page_id")


@query("WITH $EVENTS SELECT event_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS dt FROM e")
def frame_steps(spark, sf):
    return sequence.frame_gaps(events(spark, sf), BY, ON, ORDER).select("event_id", "dt")


@query("WITH $EVENTS SELECT user_id, count(*) AS n_frames, round(CASE WHEN count(*) > 1 THEN (max(t) - min(t)) / CAST(count(*) - 1 AS DOUBLE) END, 3) AS period FROM e GROUP BY user_id")
def mean_periods(spark, sf):
    return sequence.mean_period(events(spark, sf), BY, ON).select("user_id", "n_frames", F.round("period", 3).alias("period"))


@query("SELECT max(event_id) AS max_index, max(event_id) + 1 AS next_index FROM events")
def global_max_index(spark, sf):
    return sequence.next_index(table(spark, sf, "events"), "event_id")


@query("SELECT count(DISTINCT user_id) AS num_episodes FROM events")
def distinct_episodes(spark, sf):
    return edit.episode_count(table(spark, sf, "events"), "user_id")


@query("SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def absent_episodes(spark, sf):
    return edit.absent_episodes(table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")), table(spark, sf, "events"), "user_id")


@query("WITH a AS (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 0), b AS (SELECT DISTINCT user_id FROM events WHERE value > 50) SELECT count(*) FILTER (user_id IN (SELECT user_id FROM b)) AS n_shared, bool_and(user_id IN (SELECT user_id FROM b)) AS subset, NOT bool_or(user_id IN (SELECT user_id FROM b)) AS disjoint FROM a")
def key_overlap(spark, sf):
    e = table(spark, sf, "events")
    return edit.overlap(e.filter("user_id % 2 = 0"), e.filter("value > 50"), "user_id")


@query("""WITH n AS (SELECT user_id, count(*) AS length FROM events GROUP BY user_id)
SELECT count(*) AS total_episodes, CAST(sum(length) AS BIGINT) AS total_frames, min(length) AS shortest, round(avg(length), 6) AS mean_length, max(length) AS longest, (SELECT count(DISTINCT event_type) FROM events) AS total_tasks, round(sum(length) / 30.0 / 3600, 6) AS hours, 6 AS n_features FROM n""")
def dataset_info(spark, sf):
    d = edit.info(table(spark, sf, "events"), "user_id", 30.0, "event_type")
    return d.withColumn("hours", r6("hours")).withColumn("mean_length", r6("mean_length"))


@query("""WITH $EVENTS, r AS (SELECT event_type AS source, user_id, min(t) AS a, max(t) AS b, count(*) AS n FROM e WHERE event_type IN ('click', 'view') GROUP BY ALL), f AS (SELECT source, round(sum(n - 1) / (sum(b - a) / 1e9), 2) AS fps FROM r GROUP BY source)
SELECT source, true AS has_time, fps, (SELECT min(fps) = max(fps) FROM f) AS same_fps FROM f UNION ALL SELECT 'none', false, NULL, (SELECT min(fps) = max(fps) FROM f)""")
def source_times(spark, sf):
    of = lambda kind: topic(spark, sf, kind).withColumn("s", F.col("t") / 1e9)
    return edit.source_times({"click": of("click"), "view": of("view"), "none": table(spark, sf, "events").select("user_id", "event_id")}, BY, "s")


@query("""WITH n AS (SELECT user_id, count(*) AS length, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'view') AS w FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN c = 0 THEN 'no images' WHEN c <> length - w THEN 'images and frames differ' WHEN w > length - w THEN 'video is longer than the frames' END AS error FROM n""")
def early_validation(spark, sf):
    e = table(spark, sf, "events")
    count = lambda kind: e.filter(F.col("event_type") == kind).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    views = count("view").withColumnRenamed("n", "n_video")
    eps = e.groupBy("user_id").agg(F.sum((F.col("event_type") != "view").cast("long")).alias("length"))
    return edit.length_errors(eps, count("click").withColumnRenamed("n", "n_images"), views, "user_id").select("user_id", "error")


@query("""WITH n AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'signup') AS s FROM events GROUP BY user_id)
SELECT user_id, concat_ws(',', CASE WHEN c = 0 THEN 'n_click' END, CASE WHEN s = 0 THEN 'n_signup' END) AS lacks FROM n WHERE c = 0 OR s = 0""")
def incomplete_recordings(spark, sf):
    counts = quality.stream_counts(events(spark, sf), BY, "event_type", ["click", "signup"])
    return edit.incomplete(counts, ["n_click", "n_signup"], "user_id")


@query("WITH n AS (SELECT user_id, event_type, count(*) AS n_rows FROM events WHERE NOT contains(event_type, 'view') GROUP BY user_id, event_type) SELECT user_id, event_type AS base, n_rows FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n_rows, event_type) = 1")
def base_clock(spark, sf):
    return asof.base_clock(table(spark, sf, "events"), BY, "event_type", skip="view")


@query("""WITH $EVENTS SELECT event_id, list(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS b, list(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS a FROM e""".replace("list(value)", "round(coalesce(sum(value)", 1).replace("1 PRECEDING) AS b", "1 PRECEDING), 0), 6) AS before").replace("list(value)", "round(coalesce(sum(value)").replace("1 FOLLOWING) AS a", "1 FOLLOWING), 0), 6) AS after"))
def lookback_lookahead(spark, sf):
    d = sequence.around(events(spark, sf), BY, ON, "value", 2, 1, ORDER)
    return d.select("event_id", r6(V.total(F.col("around_before"))).alias("before"), r6(V.total(F.col("around_after"))).alias("after"))


@query("""WITH $EVENTS, d AS (SELECT user_id, value AS y, lead(value) OVER w AS y1, row_number() OVER w - 1 AS key_frame FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT user_id, key_frame, s AS sub, round(CASE WHEN y1 IS NULL THEN y ELSE y + (y1 - y) * s / 4.0 END, 6) AS value FROM d, (SELECT unnest(range(4)) AS s) WHERE y1 IS NOT NULL OR s = 0""".replace("AS key_frame", "AS key_frame"))
def linear_resample(spark, sf):
    d = sequence.linear(events(spark, sf), BY, ON, "value", 4, ORDER)
    return d.select("user_id", F.col("key_frame").cast("long").alias("key_frame"), F.col("sub").cast("long").alias("sub"), r6("value").alias("value"))


@query("SELECT event_id, round(count(*) OVER (PARTITION BY user_id) / 10.0, 6) <= 0.5 AS refill FROM events")
def refill_trigger(spark, sf):
    from pyspark.sql import Window

    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    return table(spark, sf, "events").select("event_id", queues.should_refill(n, F.lit(10), 0.5).alias("refill"))


@query("SELECT event_id, CASE WHEN value >= 100 THEN 1.0 ELSE 0.0 END::DOUBLE AS reward, value >= 100 AS done FROM events")
def classified_reward(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value", F.lit(0.0).alias("reward"), F.lit(False).alias("done"))
    return records.classified_reward(e, F.col("value") / 200).select("event_id", "reward", "done")


@query("SELECT vec_id, label = 1 AS person FROM embeddings WHERE vec_id % 4 <> 0")
def clean_transitions(spark, sf):
    bad = F.when(F.col("vec_id") % 4 == 0, F.array(F.lit(float("nan")))).otherwise(_part(1, 2))
    ok, mine = records.split_transitions(_vectors(spark, sf).select("vec_id", bad.alias("a"), (F.col("label") == 1).alias("person")), ["a"], "person")
    return ok.join(mine.select("vec_id", F.lit(True).alias("_m")), "vec_id", "left").select("vec_id", F.coalesce("_m", F.lit(False)).alias("person"))


@query(f"""WITH {_V}, x AS (SELECT vec_id, i, v[i + 1] AS x FROM v, (SELECT unnest(range(3)) AS i)) SELECT vec_id, i AS dim, round(x, 6) AS mean, CAST(0 AS DOUBLE) AS std, round(x, 6) AS q01, CAST(1 AS BIGINT) AS count FROM x""")
def degenerate_stats(spark, sf):
    s = stats.vector_stats(_vectors(spark, sf).withColumn("v", _part(1, 3)), "v", ["vec_id"])
    return s.select("vec_id", F.col("dim").cast("long").alias("dim"), r6("mean").alias("mean"), "std", r6("q01").alias("q01"), "count")


@query(f"WITH {_V}, x AS (SELECT i, v[i + 1] AS x FROM v, (SELECT unnest(range(64)) AS i)) SELECT i AS dim, round(quantile_cont(x, 0.5), 6) AS q50 FROM x GROUP BY i")
def quantile_augmentation(spark, sf):
    v = _vectors(spark, sf)
    plain = stats.vector_stats(v, "v", quantiles={})
    done = stats.with_quantiles(stats.with_quantiles(plain, v, "v", method="exact"), v.limit(0), "v")  # the second has nothing to do
    return done.select(F.col("dim").cast("long").alias("dim"), r6("q50").alias("q50"))


@query("SELECT label, CASE WHEN label = 2 THEN 'mean: length is not 64' END AS error FROM (SELECT DISTINCT label FROM embeddings)")
def stats_errors(spark, sf):
    s = stats.nested(stats.vector_stats(_vectors(spark, sf), "v", ["label"]), ["label"]).select("label", "mean", "std", "count")
    cut = s.withColumn("mean", F.when(F.col("label") == 2, F.slice("mean", 1, 5)).otherwise(F.col("mean")))
    return stats.errors(cut, 64).select("label", "error")


@query(f"""WITH {_X}, {_BIN_STATS} SELECT 'mean,std,min' AS names, vec_id, round((x - mean) / (std + 0.000001), 6) AS value FROM x JOIN s USING (dim) WHERE dim = 0
UNION ALL SELECT 'min,max', vec_id, round(2 * (x - min) / (max - min) - 1, 6) FROM x JOIN s USING (dim) WHERE dim = 0
UNION ALL SELECT 'q01,q99,mean', vec_id, round(2 * (x - q01) / (q99 - q01) - 1, 6) FROM x JOIN s USING (dim) WHERE dim = 0
UNION ALL SELECT 'q10,q90', vec_id, round(2 * (x - q10) / (q90 - q10) - 1, 6) FROM x JOIN s USING (dim) WHERE dim = 0""")
def normalisation_modes(spark, sf):
    """A value normalised by the mode that the statistics at hand allow."""
    v = _vectors(spark, sf).withColumn("v", _part(1, 1))
    joined, out = stats.with_stats(v, stats.vector_stats(v, "v")), None
    for names in ("mean,std,min", "min,max", "q01,q99,mean", "q10,q90"):
        mode = stats.detect_mode(names.split(","))
        a, b = stats.MODES[mode]
        rows = joined.select(F.lit(names).alias("names"), "vec_id", r6(stats.normalise(F.col("v"), F.col(a), F.col(b), mode)[0]).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT count(*) AS n_rows, true AS found FROM embeddings")
def parquet_size(spark, sf):
    """Rows by the footers, whose sizes are at least the bytes of the values that every row must hold."""
    f = readers.parquet_footers(spark, f"{sf}/embeddings.parquet")
    return f.agg(F.sum("n_rows").alias("n_rows"), (F.sum("bytes") > F.sum("n_rows") * 4 * 64 / 2).alias("found"))


@query("SELECT vec_id, 'todo' AS prompt, CAST(32 AS INT) AS n FROM embeddings")
def model_input_steps(spark, sf):
    d = _vectors(spark, sf).select("vec_id", _part(1, 7).alias("state"))
    out = pipeline.Pipeline(pipeline.model_steps("flow", "todo"))(d)
    return out.select("vec_id", "prompt", F.size("state").alias("n"))


@query("""WITH $EVENTS, c AS (SELECT * FROM e WHERE event_type = 'click'), w AS (SELECT * FROM e WHERE event_type = 'view'), s AS (SELECT * FROM e WHERE event_type = 'signup'),
l AS (SELECT c.event_id, min(abs(w.t - c.t)) AS d FROM c JOIN w USING (user_id) GROUP BY c.event_id), r AS (SELECT c.event_id, min(abs(s.t - c.t)) AS d FROM c JOIN s USING (user_id) GROUP BY c.event_id),
b AS (SELECT c.event_id, CASE WHEN l.d <= 7200000000 THEN l.d END AS a, CASE WHEN r.d <= 7200000000 THEN r.d END AS b FROM c LEFT JOIN l USING (event_id) LEFT JOIN r USING (event_id))
SELECT event_id, CASE WHEN a IS NULL AND b IS NULL THEN 'no arm' WHEN a IS NULL THEN 'no left arm' WHEN b IS NULL THEN 'no right arm' END AS error, greatest(a, b) AS max_diff FROM b""")
def two_arm_sync(spark, sf):
    d = asof.synced_pair(topic(spark, sf, "click"), topic(spark, sf, "view"), topic(spark, sf, "signup"), BY, ON, "value", 120 * MINUTE, ORDER)
    return d.select("event_id", "error", "max_diff")


# -- forms of action chunks: 16 steps of 4 values, the last of which is held ------------------------

_C = f"{_V}, c AS (SELECT vec_id, v, unnest(range(16)) AS s FROM v), d AS (SELECT vec_id, v, s, unnest(range(4)) AS dim FROM c)"


def _chunk():
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice("v", i * 4 + 1, 4))


def _steps(df, col):
    rows = df.select("vec_id", F.posexplode(col).alias("step", "row")).select("vec_id", F.col("step").cast("long").alias("step"), F.posexplode("row").alias("dim", "value"))
    return rows.select("vec_id", "step", F.col("dim").cast("long").alias("dim"), r6("value").alias("value"))


@query(f"WITH {_C} SELECT vec_id, CAST(CASE s WHEN 15 THEN 3 ELSE s / 5 END AS BIGINT) AS step, dim, round(v[s * 4 + dim + 1], 6) AS value FROM d WHERE s % 5 = 0")
def chunk_thinned(spark, sf):
    return _steps(_vectors(spark, sf), chunk.thinned(_chunk()))


@query(f"""WITH {_C}, o AS (SELECT vec_id, s AS step, dim, v[CASE dim WHEN 3 THEN 0 ELSE s END * 4 + dim + 1] AS x FROM d
UNION ALL SELECT vec_id, 15 + s, dim, v[CASE dim WHEN 3 THEN s ELSE 15 END * 4 + dim + 1] FROM d WHERE s > 0) SELECT vec_id, step, dim, round(x, 6) AS value FROM o""")
def chunk_moved_then_held(spark, sf):
    return _steps(_vectors(spark, sf), chunk.moved_then_held(_chunk(), [3]))


@query(f"""WITH {_C}, o AS (SELECT vec_id, 2 * s AS step, dim, v[CASE dim WHEN 3 THEN greatest(0, s - 1) ELSE s END * 4 + dim + 1] AS x FROM d
UNION ALL SELECT vec_id, 2 * s + 1, dim, v[s * 4 + dim + 1] FROM d) SELECT vec_id, step, dim, round(x, 6) AS value FROM o""")
def chunk_interleaved(spark, sf):
    return _steps(_vectors(spark, sf), chunk.interleaved(_chunk(), [3]))


@query(f"""WITH {_C}, w AS (SELECT *, v[s * 4 + dim + 1] AS x, v[60 + dim + 1] AS z, CASE WHEN s < 6 THEN 3 * (s / 5) * (s / 5) - 2 * (s / 5) * (s / 5) * (s / 5) ELSE 1 END AS a FROM d)
SELECT vec_id, s AS step, dim, round(CASE WHEN dim = 3 THEN CASE WHEN a >= 0.5 THEN x ELSE z END ELSE (1 - a) * z + a * x END, 6) AS value FROM w""")
def chunk_blended_head(spark, sf):
    return _steps(_vectors(spark, sf), chunk.blended_head(_chunk(), F.slice("v", 61, 4), 6, [3]))


@query(f"""WITH {_V}, g AS (SELECT vec_id, v, j, j / 39 * 15 AS u, unnest(range(4)) AS dim FROM (SELECT *, unnest(range(40)) AS j FROM v)),
h AS (SELECT *, CAST(least(floor(u), 14) AS INT) AS i FROM g) SELECT vec_id, j AS step, dim, round(v[i * 4 + dim + 1] + (v[i * 4 + dim + 5] - v[i * 4 + dim + 1]) * (u - i), 6) AS value FROM h""")
def chunk_linear(spark, sf):
    return _steps(_vectors(spark, sf), chunk.resampled(_chunk(), 2.5, "linear"))


@query()
def chunk_natural_spline(spark, sf):
    """The natural cubic through the steps; tested against a dense system of equations."""
    return _steps(_vectors(spark, sf), chunk.resampled(_chunk(), 2.5, "natural"))


@query("""SELECT vec_id, 8 AS height, 8 AS width, CAST(list_sum(list_transform(embedding, lambda v: greatest(0, least(255, round_even(CAST(v AS DOUBLE) * 255, 0))))) AS BIGINT) AS total FROM embeddings""")
def image_files(spark, sf):
    """Pictures written as PNG files, listed, read and decoded again."""
    path = folder(spark, "pictures")
    pictures = _vectors(spark, sf).select(F.format_string("%d/%d.png", F.col("vec_id") % 10, "vec_id").alias("name"), image.encoded(image.from_vector(F.col("v"), 8, 8)).alias("bytes"))
    writers.image_files(pictures, path)
    back = readers.images(spark, path, "*.png").select(F.regexp_extract("path", r"(\d+)\.png$", 1).cast("long").alias("vec_id"), image.decoded_or_null(png.decode)(F.col("bytes")).alias("im"))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.conv(F.hex(F.substring(F.col("im.data"), i, F.lit(1))), 16, 10).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return back.select("vec_id", "im.height", "im.width", total.alias("total"))
