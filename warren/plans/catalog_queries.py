"""Scalar functions, catalogue and audit operators over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.functions import scalars as S
from warren.operators import catalog as C
from warren.plans.registry import query

KEY = "rat_no, session_date"
INV = "SELECT rat_no, session_date, " + ", ".join(f"count(*) FILTER (phase = '{p}') AS n_{p}, CAST(sum(CASE WHEN phase = '{p}' THEN size_bytes ELSE 0 END) AS BIGINT) AS {p}_bytes" for p in (*C.PHASES, "video")) + ", coalesce(string_agg(DISTINCT CASE WHEN phase <> 'video' THEN phase END, ',' ORDER BY CASE WHEN phase <> 'video' THEN phase END), '') AS phases, bool_or(phase <> 'video') AS has_ephys FROM fx_files GROUP BY 1, 2"
SIZE = "SELECT rat_no, session_date, phase, CAST(max(b) AS BIGINT) AS size_bytes FROM (SELECT rat_no, session_date, phase, volume, sum(size_bytes) AS b FROM fx_files GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"

query("f1_clock_seconds", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN round((event_id % 7) * 3600 + (event_id % 60) * 60 + event_id % 60 + (event_id % 1000) / 1000.0, 6) END AS s FROM events")(lambda fx: fx("events").select("event_id", S.clock_seconds(F.when(F.col("event_id") % 5 == 0, "x").otherwise(F.format_string("%d:%02d:%02d.%03d", F.col("event_id") % 7, F.col("event_id") % 60, F.col("event_id") % 60, F.col("event_id") % 1000))).alias("s")))
query("f2_seconds_or_clock", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id + 0.5E0 ELSE event_id % 3 * 3600 + event_id % 50 * 60 + 7.0E0 END AS s FROM events")(lambda fx: fx("events").select("event_id", S.seconds_or_clock(F.when(F.col("event_id") % 2 == 0, F.format_string("'%d.5'", "event_id")).otherwise(F.format_string("\"%d:%d:7\"", F.col("event_id") % 3, F.col("event_id") % 50))).alias("s")))
query("f3_minutes_seconds", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN event_id % 60 * 60 + 5.0E0 ELSE event_id % 60 * 60 + 6.0E0 END AS s FROM events")(lambda fx: fx("events").select("event_id", S.minutes_seconds(F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 3 == 1, F.format_string("%d:05", F.col("event_id") % 60)).otherwise(F.format_string("%d:06:00", F.col("event_id") % 60))).alias("s")))
query("f4_trial_at", "SELECT event_id, CASE WHEN event_id % 4 = 1 THEN CAST(event_id % 9 AS INT) END AS trial, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN 5 * 60 + 30.0E0 WHEN 2 THEN 12 * 60 + 5.0E0 END AS seconds, CASE WHEN event_id % 4 = 3 THEN 'soon' END AS unread FROM events")(lambda fx: fx("events").select("event_id", S.trial_at(F.when(F.col("event_id") % 4 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 4 == 1, F.format_string("%d@5:30", F.col("event_id") % 9)).when(F.col("event_id") % 4 == 2, "12:05:00").otherwise("soon")).alias("r")).select("event_id", "r.*"))
query("f5_trial_intervals", "SELECT event_id, CAST(event_id % 9 AS INT) AS trial, 10.0E0 AS start, 20.0E0 AS \"end\" FROM events UNION ALL SELECT event_id, 3, 1.0E0, 2.0E0 FROM events")(lambda fx: fx("events").select("event_id", F.explode(S.trial_intervals(F.format_string("%d:10-20, 3:1-2,x", F.col("event_id") % 9))).alias("r")).select("event_id", "r.*"))
query("f6_mixed_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate::DATE, '%Y%m%d') END AS d FROM orders")(lambda fx: fx("orders").select("o_orderkey", S.mixed_date(F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "dd-MM-yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise("soon")).alias("d")))
query("f10_phase", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'post' WHEN 1 THEN 'task' WHEN 2 THEN 'task' WHEN 3 THEN 'pre' END AS phase FROM part")(lambda fx: fx("part").select("p_partkey", S.phase(F.element_at(F.array(*map(F.lit, ("x_Post_task", "Maze1", "hab_pre", "presleep", "none"))), (F.col("p_partkey") % 5 + 1).cast("int"))).alias("phase")))
query("f11_file_kind", "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'video' WHEN 1 THEN 'meta' WHEN 2 THEN 'merged' WHEN 3 THEN 'rec' WHEN 4 THEN 'logger' ELSE 'other' END AS kind FROM part")(lambda fx: fx("part").select("p_partkey", S.file_kind(F.element_at(F.array(*map(F.lit, ("eye1.MP4", "a.meta", "a_merged.rec", "a.rec", "l.dat", "x.txt"))), (F.col("p_partkey") % 6 + 1).cast("int"))).alias("kind")))
query("f14_first_integer", "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey AS INT) END AS n FROM part")(lambda fx: fx("part").select("p_partkey", S.first_integer(F.when(F.col("p_partkey") % 3 == 0, "a,1").when(F.col("p_partkey") % 3 == 1, F.format_string("%d.0,7", "p_partkey")).otherwise(F.col("p_partkey").cast("string"))).alias("n")))
query("f16_camera_class", "SELECT p_partkey, CASE WHEN p_retailprice / 10 < 5 THEN 'aborted' WHEN p_retailprice / 10 >= 130 THEN 'implant' ELSE 'non-implant' END AS class FROM part")(lambda fx: fx("part").select("p_partkey", S.camera_class(F.col("p_retailprice") / 10).alias("class")))
query("f18_overlap_share", """WITH p AS (SELECT session_id, frame_index, x1, y1, x2, y2, x1 + 20 AS bx1, y1 + 10 AS by1, x2 - 5 AS bx2, y2 + 30 AS by2 FROM fx_detections)
SELECT session_id, frame_index, x1, y1, round((least(x2, bx2) - greatest(x1, bx1)) * (least(y2, by2) - greatest(y1, by1)) / ((x2 - x1) * (y2 - y1)), 6) AS share FROM p""")(lambda fx: fx("fx_detections").selectExpr("*", "x1 + 20 as bx1", "y1 + 10 as by1", "x2 - 5 as bx2", "y2 + 30 as by2").select("session_id", "frame_index", "x1", "y1", S.overlap_share("", "b").alias("share")))
query("f19_tetrode_channel", "SELECT p_partkey, CAST(p_partkey // 4 + 1 AS INT) AS nt, CAST(p_partkey % 4 + 1 AS INT) AS ch, CAST(p_partkey AS INT) AS channel FROM part")(lambda fx: fx("part").select("p_partkey", S.channel_tetrode(F.col("p_partkey"))[0].alias("nt"), S.channel_tetrode(F.col("p_partkey"))[1].alias("ch")).withColumn("channel", S.tetrode_channel(F.col("nt"), F.col("ch"))))
query("f20_heading_bin", "SELECT session_id, frame_index, CAST(least(floor((atan2(y, x) + pi()) / (2 * pi()) * 8), 7) AS INT) AS h FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND NOT (y = 0) AND x <> 0 AND abs(x) <> abs(y)")(lambda fx: fx("fx_track").filter("x is not null and y is not null and y <> 0 and x <> 0 and abs(x) <> abs(y)").select("session_id", "frame_index", S.heading_bin(F.col("x"), F.col("y")).alias("h")))
query("f25_human_size", "SELECT l_orderkey, l_linenumber, CASE WHEN b >= 1e9 THEN printf('%d.%d GB', (b * 10 + 500000000) // 1000000000 // 10, (b * 10 + 500000000) // 1000000000 % 10) WHEN b >= 1e6 THEN printf('%d.%d MB', (b * 10 + 500000) // 1000000 // 10, (b * 10 + 500000) // 1000000 % 10) WHEN b >= 1e3 THEN printf('%d.%d KB', (b * 10 + 500) // 1000 // 10, (b * 10 + 500) // 1000 % 10) ELSE printf('%d B', b) END AS s FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey * l_partkey * l_linenumber AS BIGINT) AS b FROM lineitem)")(lambda fx: fx("lineitem").select("l_orderkey", "l_linenumber", S.human_size((F.col("l_partkey") * F.col("l_partkey") * F.col("l_linenumber")).cast("bigint"), "GB").alias("s")))
query("f27_clock_text", "SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS t FROM (SELECT event_id, event_id * 7919 AS ms FROM events)")(lambda fx: fx("events").select("event_id", S.clock_text(F.col("event_id") * 7919).alias("t")))
query("f28_integer_text", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS t FROM events")(lambda fx: fx("events").select("event_id", S.integer_text(F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.format_string("%d.0", "event_id"))).alias("t")))
query("s10_channel_of", "SELECT p_partkey, CAST(p_partkey % 32 AS INT) AS nt, CAST(p_partkey % 4 AS INT) AS ch FROM part")(lambda fx: fx("part").withColumn("p", F.format_string("d/rec_nt%dch%d.dat", F.col("p_partkey") % 32, F.col("p_partkey") % 4)).select("p_partkey", S.channel_of(F.col("p"))[0].alias("nt"), S.channel_of(F.col("p"))[1].alias("ch")))
query("a16_build_roster", "SELECT CAST(o_custkey % 20 AS INT) AS rat_no, CAST(o_orderdate AS DATE) AS session_date, count(*) AS trials, min(o_orderkey) AS train_order FROM orders GROUP BY 1, 2")(lambda fx: C.build_roster(fx("orders").select((F.col("o_custkey") % 20).cast("int").alias("rat_no"), F.col("o_orderdate").cast("date").alias("session_date"), F.col("o_orderkey").alias("row_no"))))
query("a17_inventory", INV)(lambda fx: C.inventory(fx("fx_files")))
query("a18_phase_size", SIZE)(lambda fx: C.phase_size(fx("fx_files")))
query("a19_phase_medians", f"SELECT rat_no, phase, CAST(median(size_bytes) AS DOUBLE) AS median_bytes FROM ({SIZE}) WHERE size_bytes > 0 GROUP BY 1, 2 HAVING count(*) >= 3")(lambda fx: C.phase_medians(C.phase_size(fx("fx_files"))))
query("i3_flag_short", f"WITH s AS ({SIZE}), m AS (SELECT rat_no, phase, CAST(median(size_bytes) AS DOUBLE) AS median_bytes FROM s WHERE size_bytes > 0 GROUP BY 1, 2 HAVING count(*) >= 3) SELECT rat_no, session_date, phase, size_bytes, median_bytes FROM s JOIN m USING (rat_no, phase) WHERE size_bytes < 0.6 * median_bytes")(lambda fx: C.flag_short(C.phase_size(fx("fx_files"))))
query("j15_reconcile", f"SELECT {KEY}, CASE WHEN f IS NULL THEN 'not-found' WHEN r IS NULL THEN 'orphan' ELSE 'found' END AS status FROM (SELECT DISTINCT {KEY}, 1 AS r FROM fx_roster) a FULL JOIN (SELECT DISTINCT {KEY}, 1 AS f FROM fx_files) b USING (rat_no, session_date)")(lambda fx: C.reconcile(fx("fx_roster"), fx("fx_files")))
query("j16_assign_by_rank", "WITH a AS (SELECT session_date, folder, row_number() OVER (PARTITION BY session_date ORDER BY folder) AS rank FROM (SELECT DISTINCT session_date, concat('eye', rat_no) AS folder FROM fx_files)), b AS (SELECT session_date, train_order, row_number() OVER (PARTITION BY session_date ORDER BY train_order) AS rank FROM fx_roster) SELECT session_date, CAST(rank AS INT) AS rank, folder, train_order, CASE WHEN train_order IS NULL THEN 'extra' WHEN folder IS NULL THEN 'no folder' ELSE 'assigned' END AS verdict FROM a FULL JOIN b USING (session_date, rank)")(lambda fx: C.assign_by_rank(fx("fx_files").select("session_date", F.concat(F.lit("eye"), "rat_no").alias("folder")).distinct(), fx("fx_roster").select("session_date", "train_order"), "session_date", "folder", "train_order"))
query("u3_missing_phases", f"WITH h AS (SELECT DISTINCT {KEY}, phase FROM fx_files WHERE phase <> 'video') SELECT DISTINCT h.rat_no, h.session_date, p.phase FROM h JOIN (VALUES ('pre'), ('task'), ('post')) p(phase) ON true WHERE (h.rat_no, h.session_date) IN (SELECT ({KEY}) FROM fx_roster) AND (h.rat_no, h.session_date, p.phase) NOT IN (SELECT ({KEY}, phase) FROM h)")(lambda fx: C.missing_phases(fx("fx_roster"), fx("fx_files")))
query("i2_evaluate_sessions", f"""WITH r AS (SELECT r.rat_no, r.session_date, implanted = 1 AS imp, coalesce(n_pre, 0) AS n_pre, coalesce(n_task, 0) AS n_task, coalesce(n_post, 0) AS n_post, coalesce(n_video, 0) AS n_video FROM fx_roster r LEFT JOIN ({INV}) i USING (rat_no, session_date)),
w AS (SELECT *, concat_ws('; ', CASE WHEN n_video = 0 THEN 'no video' END, CASE WHEN imp AND n_pre = 0 THEN 'no pre' END, CASE WHEN imp AND n_task = 0 THEN 'no task' END, CASE WHEN imp AND n_post = 0 THEN 'no post' END) AS reasons FROM r)
SELECT {KEY}, CASE WHEN n_pre + n_task + n_post + n_video = 0 THEN 'MISSING' WHEN reasons <> '' THEN 'PARTIAL' ELSE 'OK' END AS verdict, reasons FROM w""")(lambda fx: C.evaluate_sessions(fx("fx_roster"), fx("fx_files")))
query("u4_phase_union", f"SELECT {KEY}, string_agg(DISTINCT phase, ',' ORDER BY phase) AS phases FROM fx_files GROUP BY 1, 2")(lambda fx: C.phase_union(fx("fx_files")))
ISSUES = f"""SELECT {KEY}, 'small file' AS category, concat_ws('/', volume, phase) AS detail FROM fx_files WHERE size_bytes < 3000000000
UNION ALL SELECT {KEY}, 'several volumes', phase FROM fx_files GROUP BY {KEY}, phase HAVING count(DISTINCT volume) > 1
""" + "".join(f"UNION ALL SELECT {KEY}, 'missing phase', '{p}' FROM ({INV}) WHERE n_{p} = 0 AND has_ephys\n" for p in C.PHASES)
query("u5_i1_issues", ISSUES)(lambda fx: C.issues(fx("fx_files"), 3_000_000_000))
query("a25_issue_summary", f"SELECT place, o.category, coalesce(n, 0) AS n FROM (VALUES (0, 'missing phase'), (1, 'several volumes'), (2, 'small file'), (3, 'empty folder')) o(place, category) LEFT JOIN (SELECT category, count(*) AS n FROM ({ISSUES}) GROUP BY 1) i ON i.category = o.category")(lambda fx: C.issue_summary(C.issues(fx("fx_files"), 3_000_000_000), ("missing phase", "several volumes", "small file", "empty folder")))
COPIES = f"SELECT {KEY}, phase, volume, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM fx_files GROUP BY 1, 2, 3, 4"
query("w17_prefer_copy", f"SELECT {KEY}, phase, volume, n, bytes FROM (SELECT *, row_number() OVER (PARTITION BY {KEY}, phase ORDER BY volume = 'D2' DESC, bytes DESC, volume) AS r FROM ({COPIES})) WHERE r = 1")(lambda fx: C.prefer_copy(fx("fx_files").groupBy(*C.SESSION, "phase", "volume").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes")), F.desc(F.col("volume") == "D2"), F.desc("bytes"), F.asc("volume")))
PLAN = f"""SELECT c.rat_no, c.session_date, c.phase, c.volume, c.n, c.bytes, CASE WHEN sigs > 1 THEN 'conflict' WHEN volume = 'D2' THEN 'archived' WHEN there THEN 'present' WHEN volume = f THEN 'move' ELSE 'duplicate' END AS action
FROM ({COPIES}) c JOIN (SELECT {KEY}, phase, count(DISTINCT concat(n, ':', bytes)) AS sigs, min(volume) AS f, bool_or(volume = 'D2') AS there FROM ({COPIES}) GROUP BY 1, 2, 3) a ON a.rat_no = c.rat_no AND a.session_date = c.session_date AND a.phase = c.phase"""
query("i7_plan_consolidation", PLAN)(lambda fx: C.plan_consolidation(fx("fx_files"), "D2"))
query("a22_plan_totals", f"SELECT rat_no, action, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM ({PLAN}) GROUP BY ROLLUP (rat_no, action)")(lambda fx: C.plan_totals(C.plan_consolidation(fx("fx_files"), "D2")))
query("i8_canonical_name", "SELECT rat_no, volume, n FROM (SELECT *, row_number() OVER (PARTITION BY rat_no ORDER BY n DESC, volume) AS r FROM (SELECT rat_no, volume, count(*) AS n FROM fx_files GROUP BY 1, 2)) WHERE r = 1")(lambda fx: C.canonical_name(fx("fx_files"), "rat_no", "volume"))
query("i5_status_matrix", f"""WITH s AS (SELECT r.rat_no, r.session_date, """ + ", ".join(f"CASE WHEN coalesce(n_{p}, 0) > 0 THEN 'good' WHEN implanted = 1 THEN 'crit' ELSE 'na' END AS {p}" for p in C.PHASES) + f""", CASE WHEN coalesce(n_video, 0) > 0 THEN 'good' ELSE 'warn' END AS video FROM fx_roster r LEFT JOIN ({INV}) i USING (rat_no, session_date))
SELECT *, CASE WHEN 'crit' IN (pre, task, post) THEN 'crit' WHEN video = 'warn' THEN 'warn' ELSE 'good' END AS overall FROM s""")(lambda fx: C.status_matrix(fx("fx_roster"), fx("fx_files")))
query("p15_in_experiment", "SELECT f.* FROM fx_files f, (SELECT min(session_date) - INTERVAL 12 MONTH AS a, max(session_date) + INTERVAL 12 MONTH AS b FROM fx_roster) WHERE session_date BETWEEN a AND b")(lambda fx: C.in_experiment(fx("fx_files"), fx("fx_roster")))
query("w14_prev_goal", "SELECT o_orderkey, goal, last_value(goal IGNORE NULLS) OVER (PARTITION BY animal ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_goal FROM (SELECT o_orderkey, o_custkey % 20 AS animal, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 24 END AS goal FROM orders)")(lambda fx: C.prev_goal(fx("orders").select("o_orderkey", F.col("o_orderkey").alias("place"), (F.col("o_custkey") % 20).alias("animal"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 24).alias("goal"))).select("o_orderkey", "goal", "prev_goal"))
query("a12_session_goal", "SELECT session_id, goal_node, n FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, goal_node) AS r FROM (SELECT session_id, goal_node, count(*) AS n FROM fx_trial_meta GROUP BY 1, 2)) WHERE r = 1")(lambda fx: C.dominant(fx("fx_trial_meta"), ["session_id"], "goal_node"))
query("k4_append_units", "SELECT session_id, unit_id FROM fx_units WHERE (session_id, unit_id) NOT IN (SELECT (session_id, unit_id) FROM fx_units WHERE unit_id % 2 = 0)")(lambda fx: C.append_new(fx("fx_units").filter("unit_id % 2 = 0"), fx("fx_units"), ["session_id", "unit_id"]).select("session_id", "unit_id"))
query("j17_common_keys", "SELECT session_id, channel, chunk FROM fx_signal WHERE channel IN (SELECT channel FROM fx_signal GROUP BY 1 HAVING count(DISTINCT session_id) = (SELECT count(DISTINCT session_id) FROM fx_signal))")(lambda fx: C.common_keys(fx("fx_signal"), "channel", "session_id").select("session_id", "channel", "chunk"))
query("u2_common_channels", "SELECT channel, count(*) AS sessions FROM (SELECT DISTINCT session_id, channel FROM fx_signal) WHERE channel IN (SELECT channel FROM fx_signal GROUP BY 1 HAVING count(DISTINCT session_id) = (SELECT count(DISTINCT session_id) FROM fx_signal)) GROUP BY 1")(lambda fx: C.common_keys(fx("fx_signal"), "channel", "session_id").select("session_id", "channel").distinct().groupBy("channel").agg(F.count("*").alias("sessions")))
query("u1_union_sessions", "SELECT session_id, trial_num, trial_type, NULL::INT AS extra FROM fx_trial_meta WHERE trial_type < 3 UNION ALL SELECT session_id, trial_num, trial_type, 1 FROM fx_trial_meta WHERE trial_type >= 3")(lambda fx: fx("fx_trial_meta").filter("trial_type < 3").select("session_id", "trial_num", "trial_type").unionByName(fx("fx_trial_meta").filter("trial_type >= 3").select("session_id", "trial_num", "trial_type", F.lit(1).alias("extra")), allowMissingColumns=True))
