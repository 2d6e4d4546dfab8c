"""Session bookkeeping over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import graph as G
from warren.operators import sessions as B
from warren.operators import spikes as P
from warren.operators import track as T
from warren.plans.graph_queries import PAIRS, TRIALS, hops, trials
from warren.plans.registry import query

DAY = ["rat_no", "day"]


def named(fx, column):
    return fx("fx_names").withColumn("name", F.col(column))


def trial_rows(fx):
    return T.trial_windows(fx("fx_track")).join(fx("fx_trial_meta"), ["session_id", "trial_num"])


query("p6_clip_session", "SELECT session_id, frame_index FROM fx_track WHERE seconds >= user_id % 3 * 0.2E0 AND (user_id % 4 = 0 OR seconds <= 1.5)")(
    lambda fx: B.clip_session(fx("fx_track"), fx("fx_track").select("session_id", (F.col("user_id") % 3 * 0.2).alias("start"), F.when(F.col("user_id") % 4 == 0, 0.0).otherwise(1.5).alias("stop")).distinct()).select("session_id", "frame_index")
)
query("p18_unpivot_xy", "SELECT session_id, frame_index, 'maze' AS family, 'Rat' AS label, x, y FROM fx_track UNION ALL SELECT session_id, frame_index, 'keypoint', 'nose', round(x + 1, 6), round(y + 1, 6) FROM fx_track")(
    lambda fx: B.unpivot_xy(fx("fx_track").select("session_id", "frame_index", F.col("x").alias("Rat_X"), F.col("y").alias("Rat_Y"), (F.col("x") + 1).alias("nose_x"), (F.col("y") + 1).alias("nose_y")), ["session_id", "frame_index"])
)
query("p19_active_trials", "SELECT session_id, trial_num, count(*) AS n, min(frame_index) AS first, round(max(seconds), 6) AS last_second FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2")(
    lambda fx: B.active_trials(fx("fx_track").drop("seconds"), fx("fx_track").select("session_id", "frame_index", "seconds")).select(
        "session_id", "trial_num", F.size("samples").cast("long").alias("n"), F.element_at("samples", 1)["frame_index"].alias("first"), F.element_at("samples", -1)["seconds"].alias("last_second")
    )
)
query("j13_attach_dist", f"WITH {PAIRS} SELECT row_id, seq, p.u, p.v, CAST(d AS DOUBLE) AS d FROM (SELECT row_id, seq, node_id AS u, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS v FROM fx_paths) p LEFT JOIN dist ON dist.u = p.u AND dist.v = p.v WHERE p.v IS NOT NULL")(
    lambda fx: B.attach_dist(G.path_edges(fx("fx_paths")).select("row_id", "seq", "u", "v"), hops(fx).select("u", "v", "d"))
)
query("j18_merge_keypoints", """WITH p AS (SELECT session_id, x1, row_number() OVER (PARTITION BY session_id ORDER BY frame_index, x1, y1) AS k FROM fx_detections WHERE label = 'rat'),
f AS (SELECT session_id, frame_index, row_number() OVER (PARTITION BY session_id ORDER BY frame_index) AS k FROM fx_track WHERE frame_index % 3 = 0)
SELECT t.session_id, t.frame_index, p.x1 AS nose_x FROM fx_track t LEFT JOIN f USING (session_id, frame_index) LEFT JOIN p ON p.session_id = t.session_id AND p.k = f.k""")(
    lambda fx: B.merge_keypoints(fx("fx_track").select("session_id", "frame_index", F.when(F.col("frame_index") % 3 == 0, F.col("frame_index")).alias("i")), fx("fx_detections").filter("label = 'rat'").select("session_id", "frame_index", "x1", "y1", F.col("x1").alias("nose_x")), "i", "frame_index", "x1", "y1").drop("i")
)
query("r11_centre_keypoints", "SELECT session_id, frame_index, label, x2 - x1 AS nose_x, y2 - y1 AS nose_y, 0 AS mid_brain_x, 0 AS mid_brain_y FROM fx_detections")(
    lambda fx: B.centre_keypoints(fx("fx_detections").select("session_id", "frame_index", "label", F.col("x1").alias("mid_brain_x"), F.col("y1").alias("mid_brain_y"), F.col("x2").alias("nose_x"), F.col("y2").alias("nose_y")), ["nose", "mid_brain"])
)
query("j24_locate_nodes", "SELECT session_id, trial_num, trial_type, start_node, goal_node, round(a.x, 6) AS start_x, round(a.y, 6) AS start_y, round(b.x, 6) AS goal_x, round(b.y, 6) AS goal_y FROM fx_trial_meta LEFT JOIN fx_nodes a ON a.node_id = start_node LEFT JOIN fx_nodes b ON b.node_id = goal_node")(
    lambda fx: B.locate_nodes(fx("fx_trial_meta"), fx("fx_nodes"))
)
query("j23_map_channels", """WITH c AS (SELECT DISTINCT session_id, channel AS hw FROM fx_signal), k AS (SELECT *, hw % 3 = 0 AND length(session_id) % 2 = 0 AS chosen, count(*) FILTER (hw % 3 = 0 AND length(session_id) % 2 = 0) OVER (PARTITION BY session_id) AS n FROM c)
SELECT session_id, hw, 7 - hw AS "index" FROM k WHERE (n < 2 OR chosen) AND hw % 5 <> 1""")(
    lambda fx: B.map_channels(
        fx("fx_signal").select("session_id", (7 - F.col("channel")).alias("index"), F.floor(F.col("channel") / 4).cast("int").alias("q"), "channel").distinct().select("session_id", "index", (F.col("q") + 1).alias("ntrode"), (F.col("channel") % 4 + 1).alias("channel")),
        fx("fx_signal").filter("channel % 3 = 0 and length(session_id) % 2 = 0").select("session_id", F.col("channel").alias("hw")),
        fx("fx_signal").filter("channel % 5 = 1").select("session_id", F.col("channel").alias("hw")),
    )
)
query("r6_score_trials", f"""WITH {PAIRS}, {TRIALS}, t AS (SELECT row_id, len(path) AS n, coalesce(list_position(path, goal_node_n), 0) AS place, d FROM trials JOIN dist ON u = path[1] AND v = goal_node_n),
h AS (SELECT *, CASE WHEN place > 0 THEN place - 1 ELSE n - 1 END AS hops, 0.3E0 * CASE WHEN place > 1 THEN place - 1 ELSE n - 1 END AS walked FROM t)
SELECT row_id, CAST(hops AS BIGINT) AS hops, CASE WHEN d > 0 AND walked > 0 THEN round(ln(0.3E0 * d / walked), 6) END AS distance_score, CASE WHEN hops = 0 AND d = 0 THEN 0.0 WHEN hops > 0 AND d > 0 THEN round(ln(d / hops), 6) END AS hops_score FROM h""")(
    lambda fx: B.score_trials(
        trials(fx).withColumnRenamed("goal_node_n", "goal_node").withColumn("u", F.element_at("path", 1)).join(hops(fx).select("u", F.col("v").alias("goal_node"), F.col("d").alias("optimal_hops")), ["u", "goal_node"])
        .withColumn("optimal_dist", 0.3 * F.col("optimal_hops")).withColumn("arrival_index", F.array_position("path", F.col("goal_node")) - 1)
        .withColumn("reached_length", 0.3 * F.col("arrival_index")).withColumn("whole_length", 0.3 * (F.size("path") - 1))
    ).select("row_id", "hops", "distance_score", "hops_score")
)
query("r7_score_regression", "SELECT session_id, count(*) AS n, CASE WHEN count(*) > 1 AND var_pop(snr) > 0 THEN round(regr_slope(acg_tau_rise_ms, snr), 6) END AS slope, CASE WHEN count(*) > 1 AND var_pop(snr) > 0 THEN round(regr_intercept(acg_tau_rise_ms, snr), 6) END AS intercept, CASE WHEN count(*) > 1 AND var_pop(snr) > 0 THEN round(corr(acg_tau_rise_ms, snr), 6) END AS r FROM fx_units WHERE acg_tau_rise_ms IS NOT NULL GROUP BY 1")(
    lambda fx: B.score_regression(fx("fx_units"), ["session_id"], "snr", "acg_tau_rise_ms")
)
query("a21_split_phases", """SELECT rat_no, day, phase, CAST(greatest(n, 2) AS BIGINT) AS parts FROM (SELECT rat_no, day, phase, count(DISTINCT q % 24) AS n, bool_or(q % 7 = 0) AS forced FROM fx_names WHERE phase <> 'video' GROUP BY 1, 2, 3) WHERE n > 1 OR forced""")(lambda fx: B.split_phases(named(fx, "recording").select(*DAY, "name"), DAY))
query("a24_unique_islands", "SELECT row_id, CAST(count(DISTINCT node_id // 100) AS INT) AS islands FROM fx_paths GROUP BY 1")(lambda fx: trials(fx).select("row_id", B.unique_count(F.col("path"), lambda n: F.floor(n / 100)).alias("islands")))
query("a26_folder_listing", """WITH f AS (SELECT rat_no, folder, camera AS name, CASE WHEN q % 11 = 0 THEN 0 ELSE size_bytes END AS b FROM fx_names)
SELECT rat_no, folder, NULL::VARCHAR AS name, count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes, CAST(count(*) FILTER (b = 0) AS BIGINT) AS empty FROM f WHERE folder <> 'videos' GROUP BY 1, 2 UNION ALL SELECT rat_no, folder, name, 1, b, (b = 0)::BIGINT FROM f WHERE folder = 'videos'""")(
    lambda fx: B.folder_listing(named(fx, "camera").withColumn("size_bytes", F.when(F.col("q") % 11 == 0, 0).otherwise(F.col("size_bytes"))), ["rat_no"])
)
query("f15_camera_name", """SELECT camera, folder, CASE WHEN q % 4 = 1 THEN concat('eye', lpad(CAST(q AS VARCHAR), 2, '0'), '_', day, '_10-11-12.mp4') WHEN q % 4 = 2 AND folder <> 'videos' THEN concat('eye', lpad(CAST(q AS VARCHAR), 2, '0'), '_', day, '_09-08-07.mp4') END AS wanted FROM fx_names""")(
    lambda fx: fx("fx_names").select("camera", "folder", B.camera_name(F.col("camera"), F.col("folder")).alias("wanted"))
)
query("p17_f29_archive_place", "SELECT path, path LIKE '%HM_neurons%' AS archived, rat_no AS rat, replace(day, '-', '') AS date, CASE WHEN path LIKE '%HM_neurons%' THEN path ELSE concat(path, '/HM_neurons') END AS destination FROM fx_names")(
    lambda fx: fx("fx_names").select("path", B.in_archive(F.col("path")).alias("archived"), *[c.alias(n) for c, n in zip(B.archive_place(F.col("path")), ("rat", "date", "destination"))])
)
query("p16_raw_sessions", "SELECT rat_no, day, bool_or(q % 2 = 0 AND q % 3 <> 0) AS is_raw FROM fx_names WHERE q % 4 <> 1 GROUP BY 1, 2")(
    lambda fx: B.raw_sessions(fx("fx_names").filter("q % 4 <> 1").select(*DAY, F.concat(F.when(F.col("q") % 3 == 0, "deep/").otherwise(""), "folder", F.lit("/"), "camera").alias("path")), DAY)
)
OUTPUTS = "CASE phase WHEN 'pre' THEN 'a.DIO' WHEN 'task' THEN 'a_Coordinates_Full.csv' WHEN 'post' THEN 'LFP_Output' ELSE 'a.LFP' END"
SEEN = """s AS (SELECT rat_no, day, rat_no < 12 AS implanted, bool_or(phase = 'pre') AS p1, bool_or(phase = 'task') AS p4, bool_or(phase = 'post') AS p8, bool_or(phase NOT IN ('pre', 'task', 'post')) AS pe FROM fx_names GROUP BY 1, 2),
steps AS (SELECT s.*, unnest(range(length(i)))::INT AS position, i FROM (SELECT *, CASE WHEN implanted THEN '1e2345678d' ELSE '23456d' END AS i FROM s) s),
named AS (SELECT rat_no, day, position, i[position + 1] AS step, p1, p4, p8, pe FROM steps),
st AS (SELECT rat_no, day, position, step, CASE WHEN step = '6' THEN 'unchecked' WHEN step IN ('2', '3') THEN CASE WHEN p4 THEN 'implied' ELSE 'missing' END WHEN (step = '1' AND p1) OR (step = '4' AND p4) OR (step = '8' AND p8) OR (step = 'e' AND pe) THEN 'done' ELSE 'missing' END AS status FROM named)"""


def detected(fx):
    rows = fx("fx_names").select(*DAY, F.expr(OUTPUTS).alias("name"))
    return B.detect_steps(rows.select(*DAY, (F.col("rat_no") < 12).alias("implanted")).distinct(), rows, DAY)


query("i12_detect_steps", f"WITH {SEEN} SELECT * FROM st")(detected)
query("f30_step_text", f"""WITH {SEEN}, t AS (SELECT rat_no, day, string_agg(step, '' ORDER BY position) FILTER (status IN ('done', 'implied')) AS done, string_agg(step, '' ORDER BY position) FILTER (status = 'missing') AS missing FROM st GROUP BY 1, 2)
SELECT rat_no, day, concat_ws(' · ', 'done ' || done, 'missing ' || missing) AS text FROM t""")(lambda fx: B.step_text(detected(fx), DAY))
query("f31_newest_prefix", """SELECT rat_no, day, name FROM (SELECT rat_no, day, recording AS name, row_number() OVER (PARTITION BY rat_no, day ORDER BY CASE phase WHEN 'pre' THEN 1 WHEN 'task' THEN 2 ELSE 3 END, q DESC, recording) AS r FROM fx_names WHERE phase <> 'video') WHERE r = 1""")(
    lambda fx: B.newest_prefix(named(fx, "recording").select(*DAY, "name", F.expr("CASE phase WHEN 'pre' THEN 'container' WHEN 'task' THEN 'sorting' WHEN 'post' THEN 'folder' END").alias("kind"), F.col("q").alias("modified")), DAY).select(*DAY, "name")
)
query("f32_recording_start", "SELECT DISTINCT folder, CASE WHEN folder = 'videos' THEN folder ELSE concat(replace(day, '-', ''), '090807') END AS start FROM fx_names")(lambda fx: fx("fx_names").select("folder", B.recording_start(F.col("folder")).alias("start")).distinct())
query("n7_assemble_units", """WITH m AS (SELECT session_id, CAST(unit_id % 4 AS INT) AS unit_id, max(snr) AS snr FROM fx_units GROUP BY 1, 2), c AS (SELECT session_id, unit_id, count(*) AS n FROM fx_spikes GROUP BY 1, 2), d AS (SELECT session_id, max(t) AS duration FROM fx_spikes GROUP BY 1)
SELECT m.session_id, m.unit_id, round(snr, 6) AS snr, coalesce(n, 0) AS n, CASE WHEN duration > 0 THEN round(coalesce(n, 0) / duration, 6) END AS rate FROM m LEFT JOIN c USING (session_id, unit_id) LEFT JOIN d ON d.session_id = m.session_id WHERE m.unit_id <> 1""")(
    lambda fx: B.assemble_units(fx("fx_units").groupBy("session_id", (F.col("unit_id") % 4).cast("int").alias("unit_id")).agg(F.max("snr").alias("snr")), fx("fx_units").select("session_id", (F.col("unit_id") % 4).cast("int").alias("unit_id")).filter("unit_id <> 1"), fx("fx_spikes"))
)
query("n8_unit_metrics", "SELECT session_id, unit_id, round(coalesce(acg_tau_rise_ms, isolation_distance), 6) AS acg_tau_rise_ms FROM fx_units")(lambda fx: B.unit_metrics(fx("fx_units").select("session_id", "unit_id", "acg_tau_rise_ms"), fx("fx_units").select("session_id", "unit_id", F.col("isolation_distance").alias("acg_tau_rise_ms")), ["acg_tau_rise_ms"]))
query("l11_sync_window", "SELECT session_id, frame_index FROM (SELECT session_id, frame_index, count(*) OVER (PARTITION BY session_id) AS n, row_number() OVER (PARTITION BY session_id ORDER BY frame_index) AS i FROM fx_track) WHERE i > 84 OR 84 >= n - 10")(lambda fx: B.sync_window(fx("fx_track").select("session_id", "frame_index"), 2.8))
query("de10_predictive_summary", """WITH e AS (SELECT session_id, CAST(frame_index % 3 AS INT) AS lead, CAST(frame_index % 4 AS INT) AS rep, abs(x) AS a, abs(y) AS b, abs(x + y) AS s FROM fx_track WHERE x IS NOT NULL AND frame_index % 5 > 1),
n AS (SELECT session_id, lead, avg(m) AS shuffle_mean, stddev_pop(m) AS shuffle_sd FROM (SELECT session_id, lead, rep, median(s) AS m FROM e GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT session_id, lead, round(median(a), 6) AS neural, round(median(b), 6) AS behaviour, round(any_value(shuffle_mean), 6) AS shuffle_mean, round(any_value(shuffle_sd), 6) AS shuffle_sd, round(median(a) - median(b), 6) AS gain FROM e JOIN n USING (session_id, lead) GROUP BY 1, 2""")(
    lambda fx: (
        lambda e: B.predictive_summary(e.select("session_id", "lead", "speed", F.abs("x").alias("neural"), F.abs("y").alias("behaviour")), e.select("session_id", "lead", "speed", (F.col("frame_index") % 4).alias("rep"), F.abs(F.col("x") + F.col("y")).alias("neural")))
    )(fx("fx_track").filter("x is not null").withColumn("lead", (F.col("frame_index") % 3).cast("int")).withColumn("speed", (F.col("frame_index") % 5) * 0.1))
)
query("s16_richest", "SELECT session_id, unit_id, q AS quality FROM (SELECT session_id, unit_id, concat('q', CAST(num_spikes // 30 AS VARCHAR)) AS q FROM fx_units) QUALIFY q = max(q) OVER (PARTITION BY session_id)")(lambda fx: B.richest(fx("fx_units").select("session_id", "unit_id", F.concat(F.lit("q"), F.floor(F.col("num_spikes") / 30).cast("string")).alias("quality"))))
query("s21_positions", "SELECT session_id, frame_index, label, x1 FROM (SELECT *, bool_or(label = 'rat') OVER (PARTITION BY session_id) AS has, min(label) OVER (PARTITION BY session_id) AS least FROM fx_detections) WHERE label = CASE WHEN has THEN 'rat' ELSE least END")(lambda fx: B.positions(fx("fx_detections").select("session_id", "frame_index", "label", "x1"), "rat"))
query("s22_trial_extra", "SELECT rat_no, session_date, CAST(row_number() OVER w AS INT) AS trial_num, first_value(CASE WHEN train_order % 3 = 0 THEN train_order END IGNORE NULLS) OVER (PARTITION BY rat_no ORDER BY session_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS repeat FROM fx_roster WINDOW w AS (PARTITION BY rat_no ORDER BY session_date)")(
    lambda fx: B.trial_extra(fx("fx_roster").select("rat_no", "session_date", F.when(F.col("train_order") % 3 == 0, F.col("train_order")).alias("repeat")), "rat_no", "session_date", ["repeat"])
)
query("c8_session_identity", """SELECT recording, CASE q % 3 WHEN 0 THEN replace(day, '-', '') WHEN 1 THEN '20200101' ELSE replace(day, '-', '') END AS date, CASE WHEN q % 5 > 0 THEN q END AS repeat, CASE WHEN q % 2 > 0 THEN rat_no END AS session FROM fx_names""")(
    lambda fx: fx("fx_names").select(
        "recording",
        *[c.alias(n) for c, n in zip(B.session_identity(F.concat(F.when(F.col("q") % 5 > 0, F.concat(F.lit("Repeat "), "q")).otherwise("none"), F.when(F.col("q") % 2 > 0, F.concat(F.lit(" Session "), "rat_no")).otherwise("")), F.when(F.col("q") % 3 == 0, F.replace("day", F.lit("-"), F.lit(""))).otherwise("op"), F.when(F.col("q") % 3 == 1, "20200101").otherwise(""), F.col("recording")), ("date", "repeat", "session"))],
    )
)
query("i13_session_folders", "SELECT DISTINCT replace(day, '-', '') AS folder FROM fx_names WHERE q % 9 = 0 UNION SELECT DISTINCT concat('op', CAST(q AS VARCHAR)) FROM fx_names WHERE q % 9 = 1")(
    lambda fx: B.session_folders(fx("fx_names").select(F.when(F.col("q") % 9 == 1, F.concat(F.lit("op"), "q")).otherwise(F.replace("day", F.lit("-"), F.lit(""))).alias("folder"), F.when(F.col("q") % 9 == 0, F.col("recording")).otherwise("other.rec").alias("child")))
)
query("k6_enrich_trial_meta", """SELECT session_id, trial_num, coalesce(CASE WHEN trial_type > 2 THEN trial_type END, n) AS trial_type, start_node, goal_node, n, round(t1 - t0, 6) AS active FROM fx_trial_meta LEFT JOIN (SELECT session_id, trial_num, CAST(count(*) AS INT) AS n, min(seconds) AS t0, max(seconds) AS t1 FROM fx_track WHERE trial_num % 2 = 1 GROUP BY 1, 2) USING (session_id, trial_num)""")(
    lambda fx: B.enrich_trial_meta(fx("fx_trial_meta").withColumn("trial_type", F.when(F.col("trial_type") > 2, F.col("trial_type"))), fx("fx_track").filter("trial_num % 2 = 1").groupBy("session_id", "trial_num").agg(F.count("*").cast("int").alias("trial_type"), F.count("*").cast("int").alias("n"), (F.max("seconds") - F.min("seconds")).alias("active")))
)
query("m7_epochs", """WITH t AS (SELECT session_id, trial_num, trial_type, goal_node, t0, t1 FROM fx_trial_meta JOIN (SELECT session_id, trial_num, min(seconds) AS t0, max(seconds) AS t1 FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2) USING (session_id, trial_num)),
k AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY t0) AS k FROM t WHERE trial_type IN (4, 5)), w AS (SELECT a.session_id, a.goal_node AS g0, b.goal_node AS g1, b.t0, b.t1 FROM k a JOIN k b USING (session_id) WHERE a.k = 1 AND b.k = 2 AND b.trial_type = 5),
s AS (SELECT session_id, min(seconds) AS a, max(seconds) AS b FROM fx_track GROUP BY 1), o AS (SELECT session_id, goal_node FROM (SELECT session_id, goal_node, count(*) AS n FROM t GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY n DESC, goal_node) = 1)
SELECT session_id, 'before' AS epoch, round(a, 6) AS start, round(t0, 6) AS stop, g0 AS goal_node FROM s JOIN w USING (session_id) UNION ALL SELECT session_id, 'after', round(t1, 6), round(b, 6), g1 FROM s JOIN w USING (session_id)
UNION ALL SELECT session_id, 'whole', round(a, 6), round(b, 6), goal_node FROM s LEFT JOIN o USING (session_id) WHERE session_id NOT IN (SELECT session_id FROM w)""")(
    lambda fx: B.epochs(trial_rows(fx), fx("fx_track").groupBy("session_id").agg(F.min("seconds").alias("first"), F.max("seconds").alias("last")))
)
query("i15_meta_plan", """SELECT r.rat_no, r.session_date, CASE WHEN f.v IS NULL THEN 'no-video' WHEN f.p > 0 THEN 'exists' WHEN trials = 1 THEN 'no-trials' ELSE 'write' END AS action FROM fx_roster r LEFT JOIN (SELECT rat_no, session_date, max(CASE WHEN phase = 'video' THEN volume END) AS v, count(*) FILTER (phase = 'post') AS p FROM fx_files GROUP BY 1, 2) f USING (rat_no, session_date)""")(
    lambda fx: B.meta_plan(fx("fx_roster").withColumn("trials", F.when(F.col("trials") > 1, F.col("trials"))).join(fx("fx_files").groupBy("rat_no", "session_date").agg(F.max(F.when(F.col("phase") == "video", F.col("volume"))).alias("video_folder"), F.bool_or(F.col("phase") == "post").alias("has_sheet")), ["rat_no", "session_date"], "left")).select("rat_no", "session_date", "action")
)
query("f26_first_flag", "SELECT session_id, unit_id, CASE WHEN snr < 1 THEN 'low signal' WHEN num_spikes < 50 THEN 'few spikes' WHEN isi_violations_ratio > 0.4 THEN 'refractory' END AS flag FROM fx_units")(
    lambda fx: fx("fx_units").select("session_id", "unit_id", B.first_flag({"low signal": F.col("snr") < 1, "few spikes": F.col("num_spikes") < 50, "refractory": F.col("isi_violations_ratio") > 0.4}).alias("flag"))
)
query("f24_metric_columns", "SELECT session_id, unit_id, round(snr, 6) AS snr, CASE WHEN unit_id % 2 = 0 THEN round(firing_rate_hz, 6) END AS firing_rate_hz, NULL::DOUBLE AS drift FROM fx_units")(
    lambda fx: fx("fx_units").select("session_id", "unit_id", *B.metric_columns(F.map_from_entries(F.filter(F.array(F.struct(F.lit("snr").alias("k"), F.col("snr").alias("v")), F.struct(F.when(F.col("unit_id") % 2 == 0, "firing_rate_hz").alias("k"), F.col("firing_rate_hz").alias("v"))), lambda e: e["k"].isNotNull())), ["snr", "firing_rate_hz", "drift"]))
)
query("l5_merge_cameras", """WITH l AS (SELECT session_id, CASE WHEN user_id % 2 = 0 THEN 'red' ELSE 'blue' END AS color, frame_index % 2 AS camera, CAST(frame_index AS BIGINT) AS ts, x AS value FROM fx_track WHERE frame_index % 6 < 4 AND frame_index > 4 - 3 * (frame_index % 2)),
t AS (SELECT *, row_number() OVER (PARTITION BY session_id, color ORDER BY ts) AS i FROM (SELECT DISTINCT session_id, color, ts FROM l)),
g AS (SELECT t.session_id, t.color, t.ts, i, c.camera, value, CASE WHEN value IS NOT NULL THEN i END AS k FROM t JOIN (SELECT DISTINCT session_id, color, camera FROM l) c ON c.session_id = t.session_id AND c.color = t.color LEFT JOIN l ON l.session_id = t.session_id AND l.color = t.color AND l.camera = c.camera AND l.ts = t.ts),
n AS (SELECT *, max(k) OVER (PARTITION BY session_id, color, camera ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ia, min(k) OVER (PARTITION BY session_id, color, camera ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ib FROM g),
f AS (SELECT n.session_id, n.color, n.ts, CASE WHEN n.ia IS NULL THEN NULL WHEN n.ib IS NULL OR n.ib = n.ia THEN a.value ELSE a.value + (n.i - n.ia) / (n.ib - n.ia) * (b.value - a.value) END AS v FROM n
 LEFT JOIN g a ON a.session_id = n.session_id AND a.color = n.color AND a.camera = n.camera AND a.i = n.ia LEFT JOIN g b ON b.session_id = n.session_id AND b.color = n.color AND b.camera = n.camera AND b.i = n.ib)
SELECT session_id, color, ts, round(coalesce(sum(v), 0), 6) AS total FROM f GROUP BY 1, 2, 3""")(
    lambda fx: B.merge_cameras(
        fx("fx_track").filter("frame_index % 6 < 4 and frame_index > 4 - 3 * (frame_index % 2)").select("session_id", F.when(F.col("user_id") % 2 == 0, "red").otherwise("blue").alias("color"), (F.col("frame_index") % 2).alias("camera"), F.col("frame_index").alias("ts"), F.col("x").alias("value"))
    )
)
query("de12_reach_vectors", """WITH p AS (SELECT session_id, floor(seconds / 0.1)::BIGINT AS bin, avg(x) AS x, avg(y) AS y FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2), l AS (SELECT unnest([0, 1, 2]) AS lead)
SELECT a.session_id, l.lead, a.bin, round(a.x, 6) AS from_x, round(a.y, 6) AS from_y, CASE WHEN abs(b.x - a.x) < 5e-7 THEN 0.0E0 ELSE round(b.x - a.x, 6) END AS dx, CASE WHEN abs(b.y - a.y) < 5e-7 THEN 0.0E0 ELSE round(b.y - a.y, 6) END AS dy, round(sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2), 6) AS reach FROM p a CROSS JOIN l JOIN p b ON b.session_id = a.session_id AND b.bin = a.bin + l.lead""")(
    lambda fx: (lambda p: B.reach_vectors(p.withColumn("lead", F.explode(F.array(*map(F.lit, range(3))))).withColumn("bin", F.col("bin") - F.col("lead")), p))(P.bin_position(fx("fx_track"), 0.1).select("session_id", "bin", "x", "y"))
)
