"""Trajectory operators over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import track as T
from warren.plans.registry import query

TRACKED = "t AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(seconds) OVER w AS pt FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL WINDOW w AS (PARTITION BY session_id, trial_num ORDER BY seconds))"
STEPS = TRACKED + """, s AS (SELECT session_id, trial_num, frame_index, seconds, x, y, coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 0.0) AS step, coalesce(seconds - pt, 0.0) AS dt, pt IS NOT NULL AS stepped FROM t),
v AS (SELECT *, CASE WHEN dt > 0 THEN step / dt ELSE 0.0 END AS speed FROM s)"""
#: Frames of which some lack the clock, and some have that of the frame before.
PATCHY = "(SELECT * REPLACE (CASE WHEN trial_num % 3 = 1 AND frame_index % 11 = 4 THEN NULL WHEN trial_num % 3 = 2 AND frame_index % 9 = 5 THEN seconds - 1 / 30.0E0 ELSE seconds END AS seconds) FROM fx_track)"


def gapped(source: str = "fx_track") -> str:
    """Steps, durations, teleports (j) and the speeds of the runs between them (v) of tracked samples."""
    return f"""t AS (SELECT *, row_number() OVER w AS i, count(*) OVER p AS n, bool_and(seconds IS NOT NULL) OVER p AS whole FROM {source} WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL WINDOW w AS (PARTITION BY session_id, trial_num ORDER BY seconds NULLS LAST, frame_index), p AS (PARTITION BY session_id, trial_num)),
c AS (SELECT *, CASE WHEN whole THEN seconds ELSE (i - 1) / 30.0E0 END AS ct FROM t),
s AS (SELECT *, coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 0.0) AS step, ct - lag(ct) OVER w AS gap, lead(ct) OVER w - ct AS ahead FROM c WINDOW w AS (PARTITION BY session_id, trial_num ORDER BY i)),
d AS (SELECT *, CASE WHEN gap > 0 THEN step / gap WHEN gap IS NOT NULL THEN 0.0 END AS pace, greatest(0.0, (coalesce(gap, 1 / 30.0E0) + coalesce(ahead, 1 / 30.0E0)) / 2) AS duration FROM s),
m AS (SELECT *, median(pace) OVER (PARTITION BY session_id, trial_num ORDER BY i ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS local_median FROM d),
j AS (SELECT *, coalesce(n >= 3 AND (gap <= 0 OR (pace > 0.6 AND pace > 3 * local_median)), false) AS teleport FROM m),
u AS (SELECT *, sum(teleport::INT) OVER (PARTITION BY session_id, trial_num ORDER BY i) AS run FROM j),
k AS (SELECT *, row_number() OVER w / 30.0E0 AS place, CASE WHEN bool_and(seconds IS NOT NULL) OVER q THEN seconds ELSE row_number() OVER w / 30.0E0 END AS rc FROM u WINDOW w AS (PARTITION BY session_id, trial_num, run ORDER BY i), q AS (PARTITION BY session_id, trial_num, run)),
l AS (SELECT *, rc - lag(rc) OVER (PARTITION BY session_id, trial_num, run ORDER BY i) AS rg FROM k),
z AS (SELECT *, CASE WHEN coalesce(min(rg) OVER (PARTITION BY session_id, trial_num, run), 1.0) > 0 THEN rc ELSE place END AS rt FROM l),
e AS (SELECT *, lag(x) OVER w AS x0, lag(y) OVER w AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1, rt - lag(rt) OVER w AS a, lead(rt) OVER w - rt AS b FROM z WINDOW w AS (PARTITION BY session_id, trial_num, run ORDER BY i)),
g AS (SELECT *, CASE WHEN x0 IS NULL AND x1 IS NULL THEN 0.0 WHEN x0 IS NULL THEN (x1 - x) / b WHEN x1 IS NULL THEN (x - x0) / a ELSE (a * a * x1 + (b * b - a * a) * x - b * b * x0) / (a * b * (a + b)) END AS vx,
 CASE WHEN y0 IS NULL AND y1 IS NULL THEN 0.0 WHEN y0 IS NULL THEN (y1 - y) / b WHEN y1 IS NULL THEN (y - y0) / a ELSE (a * a * y1 + (b * b - a * a) * y - b * b * y0) / (a * b * (a + b)) END AS vy FROM e),
v AS (SELECT *, sqrt(vx * vx + vy * vy) AS speed FROM g)"""


TELEPORTS = gapped()
AVERAGES = "CASE WHEN sum(duration) > 0 THEN round(sum(speed * duration) / sum(duration), 4) END AS avg_speed, round(median(speed), 4) AS median_speed"
REPORT = f"SELECT session_id, trial_num, round(min(seconds), 4) AS t0, round(max(seconds), 4) AS t1, count(*) AS samples, round(sum(step), 4) AS length, {AVERAGES}, CAST(sum(teleport::INT) AS BIGINT) AS teleports FROM v GROUP BY 1, 2"


def patchy(fx):
    n = F.col("frame_index")
    return fx("fx_track").withColumn("seconds", F.when((F.col("trial_num") % 3 == 1) & (n % 11 == 4), None).when((F.col("trial_num") % 3 == 2) & (n % 9 == 5), F.col("seconds") - 1 / 30.0).otherwise(F.col("seconds")))


IDS = ["session_id", "trial_num", "frame_index"]


def speeds(fx):
    return T.step_speed(T.tracked(fx("fx_track")))


query("p1_drop_null", "SELECT session_id, frame_index, x FROM fx_track WHERE x IS NOT NULL")(lambda fx: T.drop_null(fx("fx_track"), "x").select("session_id", "frame_index", "x"))
query("p2_tracked", "SELECT session_id, trial_num, frame_index, x, y FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL")(lambda fx: T.tracked(fx("fx_track")).select(*IDS, "x", "y"))
query("p3_to_metres", "SELECT node_id, round(x / (1176 / 9.0), 6) AS x_m, round(y / (712 / 5.0), 6) AS y_m FROM fx_nodes")(lambda fx: T.to_metres(fx("fx_nodes")).select("node_id", "x_m", "y_m"))
query("p5_trim_tail", "SELECT session_id, trial_num, frame_index FROM (SELECT *, row_number() OVER (PARTITION BY session_id, trial_num ORDER BY seconds DESC) AS r, count(*) OVER (PARTITION BY session_id, trial_num) AS n FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL) WHERE n <= 5 OR r > 5")(lambda fx: T.trim_tail(T.tracked(fx("fx_track"))).select(*IDS))
query("p7_p8_region_camera", "SELECT session_id, frame_index, x1, y1, region, lpad(CAST(region + 1 AS VARCHAR), 2, '0') AS camera, region > 5 AS flipped FROM (SELECT *, CAST(least(greatest(floor(y1 / 356.0), 0), 1) * 6 + least(greatest(floor(x1 / 196.0), 0), 5) AS INT) AS region FROM fx_detections)")(
    lambda fx: fx("fx_detections").withColumn("region", T.region_id(F.col("x1"), F.col("y1"))).select("session_id", "frame_index", "x1", "y1", "region", T.region_camera(F.col("region"))[0].alias("camera"), T.region_camera(F.col("region"))[1].alias("flipped"))
)
query("p9_time_zero", "SELECT session_id, frame_index, round(seconds, 6) AS seconds FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY abs(seconds), seconds, frame_index) AS r FROM (SELECT session_id, frame_index, seconds - 0.75 AS seconds FROM fx_track)) WHERE r = 1")(lambda fx: T.time_zero_row(fx("fx_track").select("session_id", "frame_index", (F.col("seconds") - 0.75).alias("seconds"))))
query("p11_run_epochs", f"WITH {STEPS} SELECT session_id, trial_num, frame_index FROM v WHERE speed > 0.5")(lambda fx: T.run_epochs(speeds(fx), 0.5).select(*IDS))
query("p14_select_trials", "SELECT session_id, trial_num, trial_type FROM fx_trial_meta WHERE trial_type NOT IN (4, 5) AND trial_num IN (1, 2)")(lambda fx: T.select_trials(fx("fx_trial_meta"), (4, 5), (1, 2)).select("session_id", "trial_num", "trial_type"))
query("j1_attach_clock", "SELECT session_id, frame_index, CASE WHEN frame_index % 7 <> 0 THEN round(seconds, 6) END AS seconds FROM fx_track")(lambda fx: T.attach_clock(fx("fx_track").select("session_id", "frame_index"), fx("fx_track").filter("frame_index % 7 <> 0").select("session_id", "frame_index", "seconds")))
query("j2_densify_frames", "SELECT session_id, frame_index, CASE WHEN frame_index % 3 <> 0 THEN x END AS x, round(seconds, 6) AS seconds FROM fx_track")(lambda fx: T.densify_frames(fx("fx_track").select("session_id", "frame_index", "seconds"), fx("fx_track").filter("frame_index % 3 <> 0").select("session_id", "frame_index", "x")))
query("j3_zip_by_position", "SELECT a.session_id, a.frame_index, b.t FROM (SELECT session_id, frame_index, row_number() OVER (PARTITION BY session_id ORDER BY frame_index) AS i FROM fx_track) a JOIN (SELECT session_id, round(t, 6) AS t, row_number() OVER (PARTITION BY session_id ORDER BY t) AS i FROM fx_spikes) b ON a.session_id = b.session_id AND a.i = b.i")(lambda fx: T.zip_by_position(fx("fx_track").select("session_id", "frame_index"), fx("fx_spikes").select("session_id", "t"), "session_id", "frame_index", "t"))
query("j4_attach_trial_meta", "SELECT w.session_id, w.trial_num, w.t0, w.t1, coalesce(m.trial_type, -1) AS trial_type FROM (SELECT session_id, trial_num, round(min(seconds), 6) AS t0, round(max(seconds), 6) AS t1 FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2) w LEFT JOIN (SELECT * FROM fx_trial_meta WHERE trial_num <> 2) m ON w.session_id = m.session_id AND w.trial_num = m.trial_num")(lambda fx: T.attach_trial_meta(T.trial_windows(fx("fx_track")), fx("fx_trial_meta").filter("trial_num <> 2")))
query("a1_trial_windows", "SELECT session_id, trial_num, round(min(seconds), 6) AS t0, round(max(seconds), 6) AS t1 FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2")(lambda fx: T.trial_windows(fx("fx_track")))
query("a2_nest_trials", "SELECT session_id, trial_num, count(*) AS n, round(arg_min(x, frame_index), 6) AS first_x, max(frame_index) AS last_frame FROM fx_track WHERE trial_num IS NOT NULL AND x IS NOT NULL GROUP BY 1, 2")(lambda fx: T.nest_trials(fx("fx_track").filter("x is not null")).select("session_id", "trial_num", F.size("samples").cast("bigint").alias("n"), F.element_at("samples", 1)["x"].alias("first_x"), F.element_at("samples", -1)["frame_index"].alias("last_frame")))
query("a3_occupancy", "SELECT session_id, least(CAST(floor(x / 9.0 * 50) AS INT), 49) AS bx, least(CAST(floor(y / 5.0 * 30) AS INT), 29) AS by, count(*) AS n FROM fx_track WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5 GROUP BY 1, 2, 3")(lambda fx: T.occupancy(fx("fx_track")))
query("a4_bin_mean", f"WITH {STEPS} SELECT session_id, least(CAST(floor(x / 9.0 * 90) AS INT), 89) AS bx, least(CAST(floor(y / 5.0 * 50) AS INT), 49) AS by, count(*) AS n, round(avg(speed), 6) AS mean FROM v WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5 GROUP BY 1, 2, 3")(lambda fx: T.bin_mean(speeds(fx), "speed", nx=90, ny=50))
query("a7_speed_stats", f"WITH {TELEPORTS} SELECT session_id, trial_num, {AVERAGES} FROM v GROUP BY 1, 2", 4)(lambda fx: T.trial_speed_stats(T.tracked(fx("fx_track"))))
query("a10_speed_hist", f"WITH {STEPS}, b AS (SELECT session_id, trial_num, least(CAST(floor(speed / 1.5 * 30) AS INT), 29) AS bin FROM v WHERE speed BETWEEN 0 AND 1.5) SELECT session_id, trial_num, bin, count(*) AS n FROM b GROUP BY GROUPING SETS ((session_id, trial_num, bin), (session_id, bin))")(lambda fx: T.speed_hist(speeds(fx)))
query("a11_norm_time_curve", f"""WITH {TELEPORTS}, h AS (SELECT session_id, trial_num, i, n, (sum(speed) OVER (PARTITION BY session_id, trial_num ORDER BY i ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) + greatest(0, 8 - i) * first_value(speed) OVER o + greatest(0, i + 7 - n) * last_value(speed) OVER o) / 15 AS smooth FROM v WINDOW o AS (PARTITION BY session_id, trial_num ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
f AS (SELECT *, lead(smooth) OVER (PARTITION BY session_id, trial_num ORDER BY i) AS next FROM h), o AS (SELECT unnest(range(0, 100)) AS point),
w AS (SELECT session_id, point, smooth + (coalesce(next, smooth) - smooth) * (point * (n - 1) / 99.0E0 - (i - 1)) AS value FROM f JOIN o ON CAST(point * (n - 1) // 99 AS BIGINT) = i - 1 WHERE n > 1)
SELECT session_id, point, round(avg(value), 4) AS mean, round(stddev_samp(value) / sqrt(count(*)), 4) AS sem, count(*) AS trials FROM w GROUP BY 1, 2""", 4)(lambda fx: T.norm_time_curve(T.moving_avg(T.speed_with_gaps(T.tracked(fx("fx_track"))), "speed", 15), "speed_avg"))
query("w2_trial_edges", "SELECT * FROM (SELECT session_id, trial_num, frame_index, trial_num IS NOT NULL AND lag(trial_num) OVER w IS NULL AS starts, trial_num IS NOT NULL AND lead(trial_num) OVER w IS NULL AS ends FROM fx_track WINDOW w AS (PARTITION BY session_id ORDER BY frame_index)) WHERE starts OR ends")(lambda fx: T.trial_edges(fx("fx_track")).select(*IDS, "starts", "ends"))
query("w3_step_speed", f"WITH {STEPS} SELECT session_id, trial_num, frame_index, round(step, 6) AS step, round(speed, 6) AS speed FROM v")(lambda fx: speeds(fx).select(*IDS, "step", "speed"))
query("w4_gradient_speed", f"""WITH {TRACKED}, n AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(seconds) OVER w AS nt FROM t WINDOW w AS (PARTITION BY session_id, trial_num ORDER BY seconds)),
g AS (SELECT *, seconds - pt AS a, nt - seconds AS b FROM n),
d AS (SELECT *, CASE WHEN px IS NULL AND nx IS NULL THEN 0.0 WHEN px IS NULL THEN (nx - x) / b WHEN nx IS NULL THEN (x - px) / a ELSE (a * a * nx + (b * b - a * a) * x - b * b * px) / (a * b * (a + b)) END AS dx,
 CASE WHEN px IS NULL AND nx IS NULL THEN 0.0 WHEN px IS NULL THEN (ny - y) / b WHEN nx IS NULL THEN (y - py) / a ELSE (a * a * ny + (b * b - a * a) * y - b * b * py) / (a * b * (a + b)) END AS dy FROM g)
SELECT session_id, trial_num, frame_index, round(sqrt(dx * dx + dy * dy), 4) AS speed FROM d""", 4)(lambda fx: T.gradient_speed(T.tracked(fx("fx_track"))).select(*IDS, "speed"))
query("w5_moving_avg", """WITH t AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY session_id, trial_num) AS n, sum(x) OVER (PARTITION BY session_id, trial_num ORDER BY seconds ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) AS s,
 first_value(x) OVER (PARTITION BY session_id, trial_num ORDER BY seconds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f, last_value(x) OVER (PARTITION BY session_id, trial_num ORDER BY seconds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l
 FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL WINDOW w AS (PARTITION BY session_id, trial_num ORDER BY seconds))
SELECT session_id, trial_num, frame_index, round((s + greatest(0, 7 - i) * f + greatest(0, i + 5 - n) * l) / 12, 6) AS x_avg FROM t""")(lambda fx: T.moving_avg(T.tracked(fx("fx_track")), "x", 12).select(*IDS, "x_avg"))
query("w6_moving_avg_shrink", "SELECT session_id, trial_num, frame_index, round(avg(x) OVER (PARTITION BY session_id, trial_num ORDER BY seconds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS x_avg FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL")(lambda fx: T.moving_avg_shrink(T.tracked(fx("fx_track")), "x", 3).select(*IDS, "x_avg"))
query("w7_local_median", f"WITH {TELEPORTS} SELECT session_id, trial_num, frame_index, round(local_median, 6) AS local_median FROM m")(lambda fx: T.local_median(T.step_pace(T.tracked(fx("fx_track"))), "pace").select(*IDS, "local_median"))
query("w8_find_teleports", f"WITH {TELEPORTS} SELECT session_id, trial_num, frame_index, teleport FROM j")(lambda fx: T.find_teleports(T.tracked(fx("fx_track"))).select(*IDS, "teleport"))
query("w9_sample_durations", f"WITH {TELEPORTS} SELECT session_id, trial_num, frame_index, round(duration, 6) AS duration FROM d")(lambda fx: T.sample_durations(T.tracked(fx("fx_track"))).select(*IDS, "duration"))
query("w12_carry_forward", "SELECT session_id, frame_index, last_value(x IGNORE NULLS) OVER w AS x, last_value(y IGNORE NULLS) OVER w AS y FROM fx_track WINDOW w AS (PARTITION BY session_id ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")(lambda fx: T.carry_forward(fx("fx_track")).select("session_id", "frame_index", "x", "y"))
query("w21_fill_linear", """WITH t AS (SELECT session_id, frame_index, seconds, x, last_value(x IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN x IS NOT NULL THEN seconds END IGNORE NULLS) OVER b AS t0,
 first_value(x IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN x IS NOT NULL THEN seconds END IGNORE NULLS) OVER f AS t1 FROM fx_track
 WINDOW b AS (PARTITION BY session_id ORDER BY seconds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY session_id ORDER BY seconds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT session_id, frame_index, round(CASE WHEN x IS NOT NULL OR v0 IS NULL THEN x WHEN v1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (seconds - t0) / (t1 - t0) END, 6) AS x FROM t""")(lambda fx: T.fill_linear(fx("fx_track"), "x").select("session_id", "frame_index", "x"))
query("w22_dwell", """WITH p AS (SELECT session_id, frame_index, coalesce(x > 3, false) AS p FROM fx_track), r AS (SELECT *, sum(CASE WHEN p THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY frame_index) AS run FROM p)
SELECT session_id, frame_index, round(sum(CASE WHEN p THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, run ORDER BY frame_index) / 30.0, 6) AS dwell FROM r""")(lambda fx: T.dwell(fx("fx_track"), F.col("x") > 3).select("session_id", "frame_index", "dwell"))
query("w23_cap_runs", """WITH p AS (SELECT session_id, trial_num, frame_index, seconds, x > 3 AS mask FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL), r AS (SELECT *, sum(CASE WHEN mask THEN 0 ELSE 1 END) OVER (PARTITION BY session_id, trial_num ORDER BY seconds) AS run FROM p),
c AS (SELECT *, sum(CASE WHEN mask THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, trial_num, run ORDER BY seconds) AS i, sum(CASE WHEN mask THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, trial_num, run) AS n FROM r)
SELECT session_id, trial_num, frame_index, mask AND (n <= 5 OR i BETWEEN n // 2 - 1 AND n // 2 + 3) AS mask FROM c""")(lambda fx: T.cap_runs(T.tracked(fx("fx_track")).withColumn("mask", F.col("x") > 3), "mask", 5).select(*IDS, "mask"))
query("r1_crosses_seam", "SELECT session_id, trial_num, frame_index, coalesce(" + " OR ".join([f"(x - {s}) * (lead(x) OVER w - {s}) <= 0" for s in T.SEAMS_X] + [f"(y - {s}) * (lead(y) OVER w - {s}) <= 0" for s in T.SEAMS_Y]) + ", false) AS seam FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL WINDOW w AS (PARTITION BY session_id, trial_num ORDER BY seconds)")(lambda fx: T.crosses_seam(T.tracked(fx("fx_track"))).select(*IDS, "seam"))
query("r2_repair_seams")(lambda fx: T.repair_seams(fx("fx_track")))
query("r3_speed_with_gaps", f"WITH {TELEPORTS} SELECT session_id, trial_num, frame_index, CAST(run AS BIGINT) AS run, round(speed, 4) AS speed FROM v", 4)(lambda fx: T.speed_with_gaps(T.tracked(fx("fx_track"))).select(*IDS, "run", "speed"))
query("r4_path_length", f"WITH {TELEPORTS} SELECT session_id, trial_num, round(sum(step), 6) AS length, round(sum(CASE WHEN NOT teleport THEN step ELSE 0.0 END), 6) AS length_gapped FROM j GROUP BY 1, 2")(lambda fx: T.path_length(T.tracked(fx("fx_track"))))
query("r5_goal_arrival", """WITH i AS (SELECT *, row_number() OVER (PARTITION BY session_id, trial_num ORDER BY seconds) - 1 AS i FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL AND trial_num IS NOT NULL)
SELECT session_id, trial_num, arrival, arrival IS NULL AS failed FROM (SELECT session_id, trial_num, CAST(min(CASE WHEN (x - 4.5) * (x - 4.5) + (y - 2.5) * (y - 2.5) < 4 THEN i END) AS INT) AS arrival FROM i GROUP BY 1, 2)""")(lambda fx: T.goal_arrival(T.tracked(fx("fx_track")), fx("fx_trial_meta").select("session_id", "trial_num", F.lit(4.5).alias("goal_x"), F.lit(2.5).alias("goal_y")), 2.0))
query("r8_trial_report", f"WITH {TELEPORTS} {REPORT}", 4)(lambda fx: T.trial_report(T.tracked(fx("fx_track"))))
query("r8_patchy_clocks", f"WITH {gapped(PATCHY)} {REPORT}", 4)(lambda fx: T.trial_report(T.tracked(patchy(fx))))
query("r9_occupancy_maps", f"""WITH {TELEPORTS}, b AS (SELECT session_id, trial_num, least(CAST(floor(x / 9.0 * 50) AS INT), 49) AS bx, least(CAST(floor(y / 5.0 * 30) AS INT), 29) AS by, duration FROM d WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5),
o AS (SELECT session_id, trial_num, bx, "by", sum(duration) AS occupied_s FROM b GROUP BY GROUPING SETS ((session_id, trial_num, bx, "by"), (session_id, bx, "by")))
SELECT session_id, trial_num, bx, "by", round(occupied_s, 9) AS occupied_s, round(occupied_s / nullif(sum(occupied_s) OVER (PARTITION BY session_id, trial_num), 0), 9) AS share FROM o""", 9)(lambda fx: T.occupancy_maps(T.tracked(fx("fx_track"))))
query("r9_overlay_maps", f"""WITH {TELEPORTS}, o AS (SELECT session_id, count(DISTINCT trial_num) AS trials FROM v GROUP BY 1), b AS (SELECT session_id, least(CAST(floor(x / 9.0 * 90) AS INT), 89) AS bx, least(CAST(floor(y / 5.0 * 50) AS INT), 49) AS by, duration, speed FROM v WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5)
SELECT session_id, bx, "by", round(sum(duration) / any_value(trials), 4) AS mean_s, round(avg(speed), 4) AS mean_speed FROM b JOIN o USING (session_id) GROUP BY 1, 2, 3""", 4)(lambda fx: T.overlay_maps(T.tracked(fx("fx_track"))))
query("r10_segment_values", """WITH t AS (SELECT session_id, frame_index, least(CAST(floor(x / 9.0 * 50) AS INT), 49) AS bx, least(CAST(floor(y / 5.0 * 30) AS INT), 29) AS by FROM fx_track WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5 AND trial_num IS NOT NULL), o AS (SELECT session_id, bx, "by", count(*) AS n FROM t GROUP BY 1, 2, 3)
SELECT session_id, frame_index, n FROM t JOIN o USING (session_id, bx, "by")""")(lambda fx: T.segment_values(T.tracked(fx("fx_track")).filter("x between 0 and 9 and y between 0 and 5"), T.occupancy(T.tracked(fx("fx_track")))).select("session_id", "frame_index", "n"))
query("t1_order_positions", "SELECT session_id, trial_num, frame_index FROM fx_track")(lambda fx: T.order_positions(fx("fx_track")).select(*IDS))
