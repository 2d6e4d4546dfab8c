"""Text sources, detections and the trial state machine over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import detections as D
from warren.operators import track as T
from warren.plans.registry import query
from warren.sources import logs as L
from warren.streaming import live as V
from warren.streaming import trials as X

POSITION = r"regexp_extract(value, 'position is: \((-?[0-9.]+), (-?[0-9.]+)\) @ ([0-9]+)', {})"
query("s4_parse_log", f"""SELECT session_id, line_no, 'INFO' AS level, CASE WHEN value LIKE '%position%' THEN CAST(substr(value, 13, 2) AS DOUBLE) END AS clock_s, CASE WHEN value LIKE '%position%' THEN CAST(line_no AS DOUBLE) END AS system_s, CASE WHEN value LIKE '%position%' THEN 'rat_position' ELSE 'recording_start' END AS event,
CAST(nullif(regexp_extract(value, 'Recording Trial ([0-9]+)', 1), '') AS INT) AS started, CAST(nullif({POSITION.format(1)}, '') AS DOUBLE) AS x, CAST(nullif({POSITION.format(2)}, '') AS DOUBLE) AS y, CAST(nullif({POSITION.format(3)}, '') AS INT) AS node FROM fx_log""")(lambda fx: L.parse_log(fx("fx_log")))
query("p4_events", "SELECT session_id, event, count(*) AS n FROM (SELECT session_id, CASE WHEN m LIKE 'The rat position%' THEN 'rat_position' WHEN m LIKE 'Video Imported%' THEN 'video_imported' WHEN m LIKE 'Recording Trial%' THEN 'recording_start' ELSE 'message' END AS event FROM (SELECT session_id, regexp_extract(value, '^(?:(\\w+) : )?(?:(\\d+:\\d{2}:\\d{2}\\.\\d+) )?(?:(\\d+(?:\\.\\d+)?) : )?(.*)$', 4) AS m FROM fx_log)) GROUP BY 1, 2")(lambda fx: L.parse_log(fx("fx_log")).groupBy("session_id", "event").agg(F.count("*").alias("n")))
query("w1_fill_trial", "SELECT session_id, line_no, coalesce(last_value(CAST(nullif(regexp_extract(value, 'Recording Trial ([0-9]+)', 1), '') AS INT) IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) AS trial_num FROM fx_log")(lambda fx: T.fill_trial(L.parse_log(fx("fx_log")), 1).select("session_id", "line_no", "trial_num"))
query("s3_pick_clock", "SELECT session_id, frame_index, prio FROM (SELECT *, min(prio) OVER (PARTITION BY session_id) AS best FROM (SELECT session_id, frame_index, CAST(CASE WHEN frame_index % 2 = 0 AND user_id % 3 = 0 THEN 0 ELSE 1 END AS INT) AS prio FROM fx_track)) WHERE prio = best")(lambda fx: L.pick_first(fx("fx_track").select("session_id", "frame_index", F.when((F.col("frame_index") % 2 == 0) & (F.col("user_id") % 3 == 0), 0).otherwise(1).alias("prio")), ["session_id"], "prio").select("session_id", "frame_index", "prio"))
query("s15_resolve_key", "SELECT session_id, 'key1' AS key, file, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY rank, file) AS r FROM (SELECT session_id, file, CASE WHEN p = 0 THEN 0 WHEN p = 1 THEN 1 WHEN p = 2 THEN 2 END AS rank FROM (SELECT concat('s', p_partkey % 50) AS session_id, p_partkey % 4 AS p, CASE p_partkey % 4 WHEN 0 THEN '20240101_Rat3_key1' WHEN 1 THEN concat('a', p_partkey, 'key1') WHEN 2 THEN concat('key1', p_partkey, 'b') ELSE 'none' END AS file FROM part)) WHERE rank IS NOT NULL) WHERE r = 1")(
    lambda fx: L.resolve_key(fx("part").select(F.concat(F.lit("s"), F.col("p_partkey") % 50).alias("session_id"), F.when(F.col("p_partkey") % 4 == 0, "20240101_Rat3_key1").when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("a"), "p_partkey", F.lit("key1"))).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("key1"), "p_partkey", F.lit("b"))).otherwise("none").alias("file")), fx("part").select(F.concat(F.lit("s"), F.col("p_partkey") % 50).alias("session_id"), F.lit("key1").alias("key")).distinct())
)
SPLIT = "r AS (SELECT * FROM fx_detections WHERE label = 'rat'), o AS (SELECT * FROM fx_detections WHERE label = 'researcher')"
query("j9_reject_held", f"""WITH {SPLIT} SELECT session_id, frame_index, x1, y1, round(conf, 6) AS conf FROM r WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.session_id = r.session_id AND o.frame_index = r.frame_index AND (((r.x1 + r.x2) / 2.0 BETWEEN o.x1 AND o.x2 AND (r.y1 + r.y2) / 2.0 BETWEEN o.y1 AND o.y2)
 OR (least(r.x2, o.x2) > greatest(r.x1, o.x1) AND least(r.y2, o.y2) > greatest(r.y1, o.y1) AND (least(r.x2, o.x2) - greatest(r.x1, o.x1)) * (least(r.y2, o.y2) - greatest(r.y1, o.y1)) / ((r.x2 - r.x1) * (r.y2 - r.y1)) > 0.1)))""")(lambda fx: D.reject_held(fx("fx_detections").filter("label = 'rat'"), fx("fx_detections").filter("label = 'researcher'")).select("session_id", "frame_index", "x1", "y1", "conf"))
query("t5_best_detection", "SELECT session_id, frame_index, x1, y1, round(conf, 6) AS conf FROM (SELECT *, row_number() OVER (PARTITION BY session_id, frame_index ORDER BY conf DESC, x1, y1) AS r FROM fx_detections WHERE label = 'rat') WHERE r = 1")(lambda fx: D.best_detection(fx("fx_detections").filter("label = 'rat'")).select("session_id", "frame_index", "x1", "y1", "conf"))
query("j8_nearest_in_frame", f"WITH {SPLIT} SELECT r.session_id, r.frame_index, CAST(r.x1 AS DOUBLE) AS px, CAST(r.y1 AS DOUBLE) AS py, round(min(sqrt((r.x1 - o.x1) ** 2 + (r.y1 - o.y1) ** 2)), 6) AS distance FROM r JOIN o USING (session_id, frame_index) GROUP BY 1, 2, 3, 4")(lambda fx: D.nearest_in_frame(*[fx("fx_detections").filter(F.col("label") == k).select("session_id", "frame_index", F.col("x1").cast("double").alias("px"), F.col("y1").cast("double").alias("py")) for k in ("rat", "researcher")]))
query("p12_in_polygon", "SELECT session_id, frame_index, x1, y1, x1 >= 100 AND x1 <= 700 AND y1 >= 50 AND y1 <= 400 AS inside FROM fx_detections")(lambda fx: fx("fx_detections").select("session_id", "frame_index", "x1", "y1", D.in_polygon(F.col("x1"), F.col("y1"), [(100, 50), (700, 50), (700, 400), (100, 400)]).alias("inside")))
query("j21_match_rat_config", "SELECT name, CASE WHEN name LIKE 'rat10%' THEN 'rat10' ELSE 'rat1' END AS key FROM (SELECT DISTINCT concat('rat', p_partkey) AS name FROM part) WHERE name LIKE 'rat1%'")(lambda fx: D.match_rat_config(fx("part").select(F.concat(F.lit("rat"), "p_partkey").alias("name")).distinct(), fx("nation").select(F.when(F.col("n_nationkey") % 2 == 0, "rat1").otherwise("rat10").alias("key")).distinct()))
query("j22_align_offset", """WITH s AS (SELECT session_id, min(seconds) AS t0, max(seconds) AS t1 FROM fx_track GROUP BY 1), st AS (SELECT session_id, trial_num, min(seconds) + 0.9 AS start FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2), c(place, "offset") AS (VALUES (0, 0.0), (1, 0.9), (2, 50.0)),
i AS (SELECT st.session_id, place, "offset", count(*) FILTER (start - "offset" BETWEEN t0 AND t1) AS inside FROM st JOIN s USING (session_id), c GROUP BY 1, 2, 3) SELECT session_id, place, CAST("offset" AS DOUBLE) AS "offset", inside FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY inside DESC, place) AS r FROM i) WHERE r = 1""")(
    lambda fx: D.align_offset(fx("fx_track").filter("trial_num is not null").groupBy("session_id", "trial_num").agg((F.min("seconds") + 0.9).alias("start")), fx("fx_track").groupBy("session_id").agg(F.min("seconds").alias("t0"), F.max("seconds").alias("t1")), fx("fx_track").select("session_id").distinct().select("session_id", F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(o).alias("offset")) for i, o in enumerate((0.0, 0.9, 50.0))])).alias("c")).select("session_id", "c.*"))
)


def machine_frames(fx):
    x, y = (F.col("x") * 130), (F.col("y") * 140)
    return fx("fx_track").select("session_id", "frame_index", (F.col("seconds") * 1000).alias("frame_ms"), x.alias("x"), y.alias("y"), (x + F.col("frame_index") % 50 * 10).alias("rx"), y.alias("ry"), F.lit(300.0).alias("start_x"), F.lit(300.0).alias("start_y"), F.lit(600.0).alias("goal_x"), F.lit(300.0).alias("goal_y"), F.lit(1).alias("trial_type"))


query("x1_trial_machine")(lambda fx: X.batch_trials(machine_frames(fx)))
query("x2_trial_types")(lambda fx: X.batch_trials(machine_frames(fx).withColumn("trial_type", F.pmod(F.hash("session_id"), F.lit(6)) + 1)))
query("x12_epochs", "SELECT user_id AS session_id, time_bucket(INTERVAL 1 HOUR, CAST(ts AS TIMESTAMP)) AS start, count(*) AS n, round(avg(event_id), 6) AS x FROM events GROUP BY 1, 2")(lambda fx: X.epochs(fx("events").select(F.col("user_id").alias("session_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("double").alias("x")), "1 hour"))
query("x13_sliding", "SELECT user_id AS session_id, w.start + INTERVAL 1 HOUR * k AS start, count(*) AS n, round(avg(event_id), 6) AS x FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, CAST(ts AS TIMESTAMP)) AS start FROM events) w, (SELECT unnest([0, -1]) AS k) GROUP BY 1, 2")(lambda fx: X.epochs(fx("events").select(F.col("user_id").alias("session_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("double").alias("x")), "2 hours", "1 hour"))
query("x14_sessions", """WITH e AS (SELECT user_id AS session_id, CAST(ts AS TIMESTAMP) AS ts FROM events), b AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY session_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM e), g AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bout FROM b)
SELECT session_id, min(ts) AS start, count(*) AS n FROM g GROUP BY session_id, bout""")(lambda fx: X.sessions(fx("events").select(F.col("user_id").alias("session_id"), F.col("ts").cast("timestamp").alias("ts")), "1 hour"))


def scheduled_frames(fx):
    meta = fx("fx_trial_meta").select("session_id", "trial_num", F.when(F.col("trial_num") % 2 == 0, F.col("trial_num") * 400.0).alias("start_ms"), F.when(F.col("trial_num") % 3 == 0, F.col("trial_num") * 500.0).alias("end_ms"), F.lit(None).cast("double").alias("immune_from"), F.lit(None).cast("double").alias("immune_to"))
    return machine_frames(fx).join(X.schedules(meta), "session_id", "left")


query("x4_x7_x8_scheduled_trials")(lambda fx: X.batch_trials(scheduled_frames(fx)))
FREE = f"""WITH {SPLIT}, k AS (SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.session_id = r.session_id AND o.frame_index = r.frame_index AND ((floor((r.x1 + r.x2) / 2) BETWEEN o.x1 AND o.x2 AND floor((r.y1 + r.y2) / 2) BETWEEN o.y1 AND o.y2)
 OR (least(r.x2, o.x2) > greatest(r.x1, o.x1) AND least(r.y2, o.y2) > greatest(r.y1, o.y1) AND (least(r.x2, o.x2) - greatest(r.x1, o.x1)) * (least(r.y2, o.y2) - greatest(r.y1, o.y1)) / ((r.x2 - r.x1) * (r.y2 - r.y1)) > 0.1))) AND floor((x1 + x2) / 2) <= 900),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY session_id, frame_index ORDER BY conf DESC, x1, y1) = 1), p AS (SELECT session_id, frame_index, floor((b.x1 + b.x2) / 2) AS x, floor((b.y1 + b.y2) / 2) AS y FROM (SELECT DISTINCT session_id, frame_index FROM fx_detections) LEFT JOIN b USING (session_id, frame_index))
SELECT session_id, frame_index, CAST(last_value(x IGNORE NULLS) OVER w AS DOUBLE) AS x, CAST(last_value(y IGNORE NULLS) OVER w AS DOUBLE) AS y, x IS NOT NULL AS seen FROM p WINDOW w AS (PARTITION BY session_id ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
query("x11_live_positions", FREE)(lambda fx: V.live_positions(V.frame_positions(fx("fx_detections"), [(0, 0), (900, 0), (900, 2000), (0, 2000)])))
query("x10_node_visits", """WITH p AS (SELECT session_id, seconds AS t, abs(x) * 120 AS x, abs(y) * 140 AS y FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL), h AS (SELECT session_id, t, node_id FROM p JOIN fx_nodes n ON sqrt((p.x - n.x) ** 2 + (p.y - n.y) ** 2) <= 20), l AS (SELECT *, lag(node_id) OVER (PARTITION BY session_id ORDER BY t, node_id) AS b FROM h)
SELECT session_id, node_id, round(t, 6) AS t FROM l WHERE b IS NULL OR b <> node_id""")(lambda fx: V.node_visits(fx("fx_track").filter("x is not null and y is not null").select("session_id", F.col("seconds").alias("t"), (F.abs("x") * 120).alias("x"), (F.abs("y") * 140).alias("y")), fx("fx_nodes")))
