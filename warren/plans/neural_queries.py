"""Spikes, maps, decoding, signals, clocks and statistics over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.functions import scalars as S
from warren.operators import led as D
from warren.operators import maps as M
from warren.operators import population as N
from warren.operators import recording as R
from warren.operators import recursion as B
from warren.operators import signals as E
from warren.operators import spikes as P
from warren.operators import stats as C
from warren.operators import summary as Y
from warren.operators import track as T
from warren.operators import tuning as U
from warren.plans.registry import query
from warren.plans.track_queries import STEPS

WINDOWS = "(SELECT session_id, trial_num, min(seconds) AS t0, max(seconds) AS t1 FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2)"
LABEL = "CASE WHEN NOT coalesce(snr > 2.5 AND num_spikes > 100, false) THEN 'noise' WHEN NOT coalesce(isolation_distance > 8 AND isi_violations_ratio < 0.2, false) THEN 'mua' ELSE 'good' END"
TYPE = "CASE WHEN firing_rate_hz > 10 OR trough_to_peak_s <= 0.000425 OR (trough_to_peak_s > 0.000425 AND acg_tau_rise_ms > 6) THEN 'interneuron' ELSE 'pyramidal' END"
INTERP = """p AS (SELECT s.session_id, s.unit_id, s.t, a.seconds AS t0, b.seconds AS t1, a.x AS x0, b.x AS x1, a.y AS y0, b.y AS y1 FROM fx_spikes s
 ASOF LEFT JOIN (SELECT * FROM fx_track WHERE x IS NOT NULL) a ON a.session_id = s.session_id AND s.t >= a.seconds
 ASOF LEFT JOIN (SELECT * FROM fx_track WHERE x IS NOT NULL) b ON b.session_id = s.session_id AND s.t <= b.seconds),
q AS (SELECT session_id, unit_id, t, CASE WHEN t1 = t0 THEN x0 ELSE x0 + (x1 - x0) * (t - t0) / (t1 - t0) END AS x, CASE WHEN t1 = t0 THEN y0 ELSE y0 + (y1 - y0) * (t - t0) / (t1 - t0) END AS y FROM p)"""


def known(fx):
    return fx("fx_track").filter("x is not null")


def signal(fx):
    return E.samples(fx("fx_signal"), 64)


def units(fx):
    return fx("fx_units").withColumn("label", P.quality_label()).withColumn("type", P.cell_type())


def pulses(fx):
    return E.pulse_centres(E.dio_time(fx("fx_dio"), 30000.0))


query("j5_within_trials", f"SELECT s.session_id, unit_id, round(t, 6) AS t, trial_num FROM fx_spikes s JOIN {WINDOWS} w ON w.session_id = s.session_id AND t BETWEEN t0 AND t1")(lambda fx: P.within_trials(fx("fx_spikes"), T.trial_windows(fx("fx_track"))).select("session_id", "unit_id", "t", "trial_num"))
query("j6_interp_at", f"WITH {INTERP} SELECT session_id, unit_id, round(t, 6) AS t, round(x, 6) AS x, round(y, 6) AS y FROM q")(lambda fx: P.interp_at(fx("fx_spikes"), known(fx)))
query("j7_upsample_hold", f"WITH {INTERP} SELECT q.session_id, q.unit_id, round(q.t, 6) AS t, round(coalesce(q.x, p.x0, p.x1), 6) AS x FROM (SELECT *, row_number() OVER (ORDER BY session_id, unit_id, t) AS r FROM q) q JOIN (SELECT *, row_number() OVER (ORDER BY session_id, unit_id, t) AS r FROM p) p ON p.r = q.r")(lambda fx: P.interp_at(fx("fx_spikes"), known(fx), ("x",), outside="hold"))
query("n17_spikes_on_path", f"WITH {INTERP} SELECT q.session_id, unit_id, round(t, 6) AS t, trial_num, round(x, 6) AS x, round(y, 6) AS y FROM q JOIN {WINDOWS} w ON w.session_id = q.session_id AND t BETWEEN t0 AND t1 WHERE x IS NOT NULL")(lambda fx: P.interp_at(P.within_trials(fx("fx_spikes"), T.trial_windows(fx("fx_track"))), known(fx)).filter("x is not null").select("session_id", "unit_id", "t", "trial_num", "x", "y"))
query("a5_spike_counts", """WITH b AS (SELECT session_id, min(t) AS t0, greatest(ceil((max(t) - min(t)) / 0.5), 1)::BIGINT AS n FROM fx_spikes GROUP BY 1), g AS (SELECT DISTINCT s.session_id, unit_id, unnest(range(n)) AS bin FROM fx_spikes s JOIN b USING (session_id)),
c AS (SELECT s.session_id, unit_id, least(floor((t - t0) / 0.5)::BIGINT, n - 1) AS bin, count(*) AS n FROM fx_spikes s JOIN b USING (session_id) GROUP BY 1, 2, 3) SELECT g.session_id, g.unit_id, g.bin, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (session_id, unit_id, bin)""")(lambda fx: P.spike_counts(fx("fx_spikes"), 0.5))
query("a6_bin_position", "SELECT session_id, floor(seconds / 0.5)::BIGINT AS bin, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM fx_track WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2")(lambda fx: P.bin_position(fx("fx_track"), 0.5))
query("j14_spike_lags", "SELECT a.session_id, a.unit_id, round(a.t, 6) AS t, round(b.t - a.t, 6) AS lag FROM fx_spikes a JOIN fx_spikes b ON a.session_id = b.session_id AND a.unit_id = b.unit_id AND abs(b.t - a.t) <= 0.5 AND a.t <> b.t")(lambda fx: P.spike_lags(fx("fx_spikes"), 0.5))
query("n3_acg", """WITH l AS (SELECT a.session_id, a.unit_id, b.t - a.t AS lag FROM fx_spikes a JOIN fx_spikes b ON a.session_id = b.session_id AND a.unit_id = b.unit_id AND abs(b.t - a.t) <= 0.05 AND a.t <> b.t), c AS (SELECT session_id, unit_id, least(floor((lag + 0.05) / (2 * 0.05 / 200)), 199)::INT AS bin, count(*) AS n FROM l GROUP BY 1, 2, 3)
SELECT g.session_id, g.unit_id, g.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT session_id, unit_id, unnest(range(200))::INT AS bin FROM fx_spikes) g LEFT JOIN c USING (session_id, unit_id, bin)""")(lambda fx: P.acg(fx("fx_spikes"), 0.05, 200))
query("a9_lag_histogram", """WITH l AS (SELECT a.session_id, a.unit_id, b.t - a.t AS lag FROM fx_spikes a JOIN fx_spikes b ON a.session_id = b.session_id AND a.unit_id = b.unit_id AND abs(b.t - a.t) <= 0.5 AND a.t <> b.t), c AS (SELECT session_id, unit_id, least(floor((lag + 0.5) / (2 * 0.5 / 64)), 63)::INT AS bin, count(*) AS n FROM l GROUP BY 1, 2, 3)
SELECT g.session_id, g.unit_id, g.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT session_id, unit_id, unnest(range(64))::INT AS bin FROM fx_spikes) g LEFT JOIN c USING (session_id, unit_id, bin)""")(lambda fx: P.acg(fx("fx_spikes"), 0.5, 64))
query("a15_firing_rate", "SELECT session_id, unit_id, n, round(duration, 6) AS duration, round(n / duration, 6) AS rate FROM (SELECT session_id, unit_id, count(*) AS n FROM fx_spikes GROUP BY 1, 2) JOIN (SELECT session_id, greatest(max(t), 1.0) AS duration FROM fx_spikes GROUP BY 1) USING (session_id)")(lambda fx: P.firing_rate(fx("fx_spikes")))
query("n1_quality_label", f"SELECT session_id, unit_id, {LABEL} AS label FROM fx_units")(lambda fx: units(fx).select("session_id", "unit_id", "label"))
query("n5_cell_type", f"SELECT session_id, unit_id, {TYPE} AS type FROM fx_units")(lambda fx: units(fx).select("session_id", "unit_id", "type"))
query("n6_subtype", f"SELECT session_id, unit_id, CASE WHEN {TYPE} = 'pyramidal' THEN 'pyramidal' WHEN trough_to_peak_s <= 0.000425 THEN 'narrow interneuron' ELSE 'wide interneuron' END AS subtype FROM fx_units")(lambda fx: fx("fx_units").select("session_id", "unit_id", P.subtype().alias("subtype")))
query("j19_resolve_label", "SELECT session_id, unit_id, CASE WHEN unit_id % 3 = 0 THEN 'manual' WHEN unit_id % 2 = 0 THEN 'auto' ELSE 'unsorted' END AS label FROM fx_units")(lambda fx: P.resolve_label(fx("fx_units").select("session_id", "unit_id"), fx("fx_units").filter("unit_id % 3 = 0").select("session_id", "unit_id", F.lit("manual").alias("label")), fx("fx_units").filter("unit_id % 2 = 0").select("session_id", "unit_id", F.lit("auto").alias("label"))))
query("a14_unit_counts", f"SELECT session_id, count(*) FILTER ({LABEL} = 'good') AS good, count(*) FILTER ({LABEL} = 'mua') AS mua, count(*) FILTER ({TYPE} = 'pyramidal') AS pyramidal, count(*) FILTER ({TYPE} = 'interneuron') AS interneuron FROM fx_units GROUP BY 1")(lambda fx: P.unit_counts(units(fx)))
query("p10_select_units", f"SELECT session_id, unit_id FROM fx_units WHERE {LABEL} IN ('good', 'mua')")(lambda fx: P.select_units(units(fx), ("good", "mua")).select("session_id", "unit_id"))
query("w18_rate_rank", "SELECT session_id, unit_id, CAST(row_number() OVER w - 1 AS INT) AS rank, round(percent_rank() OVER w, 6) AS \"offset\" FROM fx_units WINDOW w AS (PARTITION BY session_id ORDER BY firing_rate_hz, unit_id)")(lambda fx: P.rate_rank(fx("fx_units")).select("session_id", "unit_id", "rank", "offset"))
query("t2_top_units", "SELECT session_id, unit_id, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY acg_tau_rise_ms DESC NULLS LAST, unit_id) AS r FROM fx_units) WHERE r <= 5")(lambda fx: P.top_units(fx("fx_units"), "acg_tau_rise_ms", 5).select("session_id", "unit_id", "rank"))
query("t10_cap_sample", "SELECT session_id, unit_id, event_id FROM (SELECT concat('s', user_id) AS session_id, CAST(event_id % 3 AS INT) AS unit_id, event_id, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS r FROM events) WHERE r <= 5")(lambda fx: P.cap_sample(fx("events").select(F.concat(F.lit("s"), "user_id").alias("session_id"), (F.col("event_id") % 3).cast("int").alias("unit_id"), "event_id"), 5, "event_id"))
query("n10_score", f"WITH {STEPS} SELECT session_id, count(*) AS n, CASE WHEN count(*) >= 5 AND var_pop(x) > 0 AND var_pop(y) > 0 THEN round(corr(x, y), 6) END AS r, CASE WHEN count(*) >= 5 AND var_pop(x) > 0 AND var_pop(y) > 0 THEN round(regr_slope(y, x), 6) END AS slope, CASE WHEN count(*) >= 5 AND var_pop(x) > 0 AND var_pop(y) > 0 THEN round(regr_intercept(y, x), 6) END AS intercept FROM v GROUP BY 1")(lambda fx: P.score(T.tracked(fx("fx_track")), "x", "y", ["session_id"]))
query("n11_speed_tuning", f"""WITH {STEPS}, c AS (SELECT session_id, x AS rate, unnest(range(greatest(CAST(ceil((speed - 0.06) / 0.04 - 1e-9) AS BIGINT), 0), least(CAST(floor((speed + 0.06) / 0.04 + 1e-9) AS BIGINT), 15) + 1)) AS centre FROM v)
SELECT session_id, centre, round(quantile_cont(rate, 0.25), 6) AS q25, round(quantile_cont(rate, 0.5), 6) AS q50, round(quantile_cont(rate, 0.75), 6) AS q75 FROM c GROUP BY 1, 2""")(lambda fx: P.speed_tuning(T.step_speed(T.tracked(fx("fx_track"))).withColumn("rate", F.col("x"))))
query("n16_dedupe_spikes")(lambda fx: P.dedupe_spikes(fx("fx_spikes"), 0.05))
query("de1_time_bins", """WITH s AS (SELECT session_id, min(seconds) AS a, floor((max(seconds) - min(seconds)) / 0.1)::BIGINT + 1 AS n FROM fx_track WHERE x IS NOT NULL GROUP BY 1) SELECT session_id, CAST(bin AS INT) AS bin, round(a + bin * 0.1, 6) AS start FROM (SELECT session_id, a, unnest(range(n)) AS bin FROM s WHERE n >= 10)""")(lambda fx: P.time_bins(fx("fx_track"), 0.1))
query("de2_assign_fold", "SELECT session_id, bin, CAST(CAST(concat('0x', substr(md5(concat(session_id, ':', bin)), 1, 8)) AS BIGINT) % 5 AS INT) AS fold FROM (SELECT DISTINCT session_id, floor(seconds / 0.5)::BIGINT AS bin FROM fx_track)")(lambda fx: P.assign_fold(fx("fx_track").select("session_id", F.floor(F.col("seconds") / 0.5).alias("bin")).distinct(), 5))
query("de3_circular_shift", """WITH w AS (SELECT *, min(t) OVER (PARTITION BY session_id) AS t0, max(t) OVER (PARTITION BY session_id) - min(t) OVER (PARTITION BY session_id) AS span, 0.05 + 0.9 * (CAST(concat('0x', substr(md5(concat(session_id, ':', unit_id, ':0')), 1, 8)) AS BIGINT) / 4294967296.0) AS u FROM fx_spikes)
SELECT session_id, unit_id, count(*) AS n, round(sum(CASE WHEN span > 0 THEN t0 + (t - t0 + u * span) - span * floor((t - t0 + u * span) / span) ELSE t END), 4) AS total FROM w GROUP BY 1, 2""", 4)(lambda fx: P.circular_shift(fx("fx_spikes")).groupBy("session_id", "unit_id").agg(F.count("*").alias("n"), F.sum("t").alias("total")))


def curves(fx, sigma=0.0):
    return M.rate_map(T.step_speed(known(fx), ("session_id",)), fx("fx_spikes"), sigma=sigma)


def tuned(fx, sigma=1.0):
    return M.rate_map(T.step_speed(known(fx), ("session_id",)), fx("fx_spikes"), sigma=sigma, most_hz=M.CURVE_HZ)


RATES = f"""WITH {INTERP}, d AS (SELECT session_id, median(d) AS dt FROM (SELECT session_id, seconds - lag(seconds) OVER (PARTITION BY session_id ORDER BY seconds) AS d FROM fx_track WHERE x IS NOT NULL) GROUP BY 1),
o AS (SELECT session_id, least(floor(x / 9.0 * 18), 17)::INT AS bx, least(floor(y / 5.0 * 10), 9)::INT AS cy, count(*) * any_value(dt) AS occupied_s FROM fx_track JOIN d USING (session_id) WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5 GROUP BY 1, 2, 3),
c AS (SELECT session_id, unit_id, least(floor(x / 9.0 * 18), 17)::INT AS bx, least(floor(y / 5.0 * 10), 9)::INT AS cy, count(*) AS n FROM q WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5 GROUP BY 1, 2, 3, 4),
r AS (SELECT u.session_id, u.unit_id, o.bx, o.cy, occupied_s, coalesce(n, 0) / occupied_s AS rate FROM (SELECT DISTINCT session_id, unit_id FROM fx_spikes) u JOIN o USING (session_id) LEFT JOIN c USING (session_id, unit_id, bx, cy))"""
query("m1_rate_map", RATES + ' SELECT session_id, unit_id, bx, cy AS "by", round(occupied_s, 4) AS occupied_s, round(rate, 4) AS rate FROM r', 4)(curves)
query("m3_spatial_info", RATES + ", pp AS (SELECT *, occupied_s / sum(occupied_s) OVER w AS p FROM r WINDOW w AS (PARTITION BY session_id, unit_id)), k AS (SELECT *, sum(p * rate) OVER (PARTITION BY session_id, unit_id) AS mean FROM pp) SELECT session_id, unit_id, CASE WHEN max(mean) > 0 THEN round(sum(CASE WHEN rate > 0 THEN p * rate / mean * log2(rate / mean) ELSE 0 END), 6) END AS information, CASE WHEN max(mean) > 0 THEN round(max(rate) / max(mean), 6) END AS selectivity, round(max(rate), 6) AS peak FROM k GROUP BY 1, 2", 6)(lambda fx: M.spatial_info(curves(fx)))
query("m2_gauss_smooth")(lambda fx: curves(fx, 1.0))
query("m4_place_fields")(lambda fx: M.place_fields(curves(fx, 1.0)))
query("m4_small_fields")(lambda fx: M.place_fields(curves(fx, 1.0), 2))  # a fixture's sessions are short, so few fields reach six cells
query("m5_field_metrics")(lambda fx: (lambda rates: M.field_metrics(M.place_fields(rates, 2), fx("fx_track").select("session_id").distinct().withColumn("goal_x", F.lit(4.5)).withColumn("goal_y", F.lit(2.5)), rates))(curves(fx, 1.0)))
query("de4_tuning_curves", RATES + ' SELECT session_id, unit_id, bx, cy AS "by", round(occupied_s, 4) AS occupied_s, round(CASE WHEN occupied_s > 1e-3 THEN least(rate, 50.0) ELSE 0.0 END, 4) AS rate FROM r', 4)(lambda fx: tuned(fx, 0.0))
query("de5_decode")(lambda fx: M.decode(P.spike_counts(fx("fx_spikes"), 0.5), tuned(fx), 0.5, 0.03))
query("de6_decode_error")(lambda fx: (lambda at: M.decode_error(M.decode(U.time_counts(fx("fx_spikes"), at, 0.5), tuned(fx), 0.5, 0.03), at))(P.bin_position(fx("fx_track"), 0.5)))


def later(fx, lead=0.1):
    rows = T.velocity(known(fx), ("session_id",)).withColumn("bx", T.clipped_bin(F.col("x"), 0.0, 9.0, 18)).withColumn("by", T.clipped_bin(F.col("y"), 0.0, 5.0, 10)).withColumn("heading", S.heading_bin(F.col("vx"), F.col("vy")))
    rows = rows.withColumn("t", F.col("seconds"))
    ahead = P.interp_at(rows.select("session_id", "frame_index", "t"), known(fx), lead=lead).select("session_id", "frame_index", F.col("x").alias("later_x"), F.col("y").alias("later_y"))
    return rows.join(ahead, ["session_id", "frame_index"]).filter("later_x is not null")


LATER = """k AS (SELECT * FROM fx_track WHERE x IS NOT NULL), st AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny, seconds - lag(seconds) OVER w AS a, lead(seconds) OVER w - seconds AS b FROM k WINDOW w AS (PARTITION BY session_id ORDER BY seconds)),
ve AS (SELECT *, CASE WHEN px IS NULL AND nx IS NULL THEN 0.0 WHEN px IS NULL THEN (nx - x) / b WHEN nx IS NULL THEN (x - px) / a ELSE (a * a * nx + (b * b - a * a) * x - b * b * px) / (a * b * (a + b)) END AS vx, CASE WHEN py IS NULL AND ny IS NULL THEN 0.0 WHEN py IS NULL THEN (ny - y) / b WHEN ny IS NULL THEN (y - py) / a ELSE (a * a * ny + (b * b - a * a) * y - b * b * py) / (a * b * (a + b)) END AS vy FROM st),
sp AS (SELECT *, least(greatest(CAST(floor(x / 9.0 * 18) AS INT), 0), 17) AS bx, least(greatest(CAST(floor(y / 5.0 * 10) AS INT), 0), 9) AS cy, CAST(least(floor((atan2(vy, vx) + pi()) / (2 * pi()) * 8), 7) AS INT) AS heading FROM ve),
la AS (SELECT s.*, a.seconds AS t0, b.seconds AS t1, a.x AS x0, b.x AS x1, a.y AS y0, b.y AS y1 FROM (SELECT *, seconds + 0.1 AS t FROM sp) s ASOF LEFT JOIN k a ON a.session_id = s.session_id AND s.t >= a.seconds ASOF LEFT JOIN k b ON b.session_id = s.session_id AND s.t <= b.seconds),
lt AS (SELECT *, CASE WHEN t1 = t0 THEN x0 ELSE x0 + (x1 - x0) * (t - t0) / (t1 - t0) END AS later_x, CASE WHEN t1 = t0 THEN y0 ELSE y0 + (y1 - y0) * (t - t0) / (t1 - t0) END AS later_y FROM la)"""
query("de8_behaviour_predict", f"""WITH {LATER}, o AS (SELECT * FROM lt WHERE later_x IS NOT NULL), w AS (SELECT *, count(*) OVER a AS n1, avg(later_x) OVER a AS x_1, avg(later_y) OVER a AS y_1, count(*) OVER b AS n2, avg(later_x) OVER b AS x_2, avg(later_y) OVER b AS y_2, avg(later_x) OVER c AS x_3, avg(later_y) OVER c AS y_3 FROM o WINDOW a AS (PARTITION BY session_id, bx, cy, heading), b AS (PARTITION BY session_id, bx, cy), c AS (PARTITION BY session_id))
SELECT session_id, frame_index, round(CASE WHEN n1 >= 3 THEN x_1 WHEN n2 >= 3 THEN x_2 ELSE x_3 END, 7) AS predicted_x, round(CASE WHEN n1 >= 3 THEN y_1 WHEN n2 >= 3 THEN y_2 ELSE y_3 END, 7) AS predicted_y FROM w""", 7)(lambda fx: M.behaviour_predict(later(fx)).select("session_id", "frame_index", "predicted_x", "predicted_y"))
query("de9_kinematic_baselines", f"WITH {LATER} SELECT session_id, frame_index, round(sqrt((later_x - x) ** 2 + (later_y - y) ** 2), 5) AS stay_err, round(sqrt((later_x - x - vx * 0.1) ** 2 + (later_y - y - vy * 0.1) ** 2), 5) AS steady_err FROM lt WHERE later_x IS NOT NULL", 5)(lambda fx: M.kinematic_baselines(later(fx), 0.1).select("session_id", "frame_index", "stay_err", "steady_err"))
query("de11_goal_profile", "SELECT session_id, band, count(*) AS n, round(avg(d), 6) AS mean_distance FROM (SELECT session_id, d, CAST(least(greatest(floor(d / 10.0 * 11), 0), 10) AS INT) AS band FROM (SELECT session_id, sqrt((x - 4.5) ** 2 + (y - 2.5) ** 2) AS d FROM fx_track WHERE x IS NOT NULL)) GROUP BY 1, 2")(lambda fx: M.goal_profile(known(fx).withColumn("goal_distance", F.hypot(F.col("x") - 4.5, F.col("y") - 2.5))))
SAMPLES = "x AS (SELECT session_id, channel, chunk * 64 + k - 1 AS sample, CAST(v[k] AS DOUBLE) AS value FROM (SELECT session_id, channel, chunk, v, unnest(range(1, len(v) + 1)) AS k FROM fx_signal))"
query("e1_samples", f"WITH {SAMPLES} SELECT session_id, channel, sample, round(value, 5) AS value FROM x", 5)(lambda fx: signal(fx).select("session_id", "channel", "sample", F.col("value").cast("double").alias("value")))
query("e7_emg_corr", f"""WITH {SAMPLES}, f AS (SELECT session_id, channel, sample // 512 % 8 * 64 + sample % 64 AS sample, avg(value) AS value FROM x GROUP BY 1, 2, 3), e AS (SELECT session_id, max(sample) + 1 AS n FROM f GROUP BY 1),
k AS (SELECT session_id, unnest(range(64, n - 64, 64)) AS centre FROM e), w AS (SELECT f.session_id, channel, sample, centre, value - avg(value) OVER (PARTITION BY f.session_id, channel, centre) AS d FROM f JOIN k ON k.session_id = f.session_id AND sample BETWEEN centre - 64 AND centre + 64),
l AS (SELECT *, sqrt(sum(d * d) OVER (PARTITION BY session_id, channel, centre)) AS len FROM w), u AS (SELECT session_id, centre, channel, sample, d / len AS u FROM l WHERE len > 0), s AS (SELECT session_id, centre, sample, sum(u) AS s FROM u GROUP BY 1, 2, 3), n AS (SELECT session_id, centre, count(DISTINCT channel) AS n FROM u GROUP BY 1, 2),
q AS (SELECT session_id, centre, sum(s * s) AS q FROM s GROUP BY 1, 2) SELECT session_id, (centre - 64) // 64 AS "window", CASE WHEN n >= 2 THEN round((q - n) / (n * (n - 1)), 5) + 0.0 ELSE 0.0 END AS emg FROM (SELECT DISTINCT session_id, centre FROM w) LEFT JOIN n USING (session_id, centre) LEFT JOIN q USING (session_id, centre)""", 5)(
    lambda fx: E.emg_corr(signal(fx).withColumn("sample", F.floor(F.col("sample") / 512) % 8 * 64 + F.col("sample") % 64).groupBy("session_id", "channel", "sample").agg(F.avg(F.col("value").cast("double")).alias("value")), 64)
)
BANDS = {"muscle": (20.0, 200.0), "slow": (0.5, 30.0), "fast": (50.0, 750.0)}
query("e2_welch_bands")(lambda fx: E.welch_bands(signal(fx), 1500.0, BANDS, 0.04))
query("e3_channel_scores")(lambda fx: E.channel_scores(E.welch_bands(signal(fx), 1500.0, BANDS, 0.04)))
query("e8_usable_channels")(lambda fx: E.usable_channels(E.channel_scores(E.welch_bands(signal(fx), 1500.0, BANDS, 0.04)), 4))
query("t3_top_channels")(lambda fx: E.top_channels(E.channel_scores(E.welch_bands(signal(fx), 1500.0, BANDS, 0.04))))
query("e9_spread_channels", "SELECT session_id, tetrode, local, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY local, tetrode) AS r FROM (SELECT DISTINCT concat('s', p_partkey % 20) AS session_id, CAST(p_size AS INT) AS tetrode, CAST(p_partkey % 4 AS INT) AS local FROM part)) WHERE r <= 32")(lambda fx: E.spread_channels(fx("part").select(F.concat(F.lit("s"), F.col("p_partkey") % 20).alias("session_id"), F.col("p_size").cast("int").alias("tetrode"), (F.col("p_partkey") % 4).cast("int").alias("local")).distinct()))
query("e5_e11_filtered")(lambda fx: E.filtered(fx("fx_signal"), E.fir(101, 300.0, 600.0, 1500.0), 64))
query("e5_zero_phase", digits=4)(lambda fx: B.zero_phase(fx("fx_signal"), B.butterworth(4, *B.passband(1500.0), 1500.0)))
query("e7_muscle_from_fields", digits=4)(lambda fx: B.muscle_from_fields(fx("fx_signal"), 64, 1500.0, 64))
query("e11_movement")(lambda fx: E.movement(fx("fx_signal"), E.fir(501, 0.1, 1.0, 1500.0), 64))
query("e12_rate_of", "SELECT session_id, round((count(*) - 1) / (max(t) - min(t)), 6) AS fs FROM fx_spikes GROUP BY 1")(lambda fx: E.rate_of(fx("fx_spikes")))
query("e14_median_reference", f"WITH {SAMPLES}, m AS (SELECT session_id, sample, median(value) AS m FROM x GROUP BY 1, 2) SELECT session_id, channel, sample, round(value - m, 5) AS value FROM x JOIN m USING (session_id, sample)", 5)(lambda fx: E.median_reference(signal(fx).withColumn("value", F.col("value").cast("double"))).select("session_id", "channel", "sample", "value"))
DIO = "d AS (SELECT session_id, color, state, (tick - min(tick) OVER (PARTITION BY session_id, color)) / 30000.0 AS t FROM fx_dio)"
PULSES = f"""{DIO}, e AS (SELECT *, lag(state) OVER (PARTITION BY session_id, color ORDER BY t) AS b FROM d), f AS (SELECT *, min(CASE WHEN state = 1 THEN t END) OVER (PARTITION BY session_id, color) AS rise0 FROM e WHERE b IS NOT NULL AND b <> state),
k AS (SELECT *, row_number() OVER (PARTITION BY session_id, color, state ORDER BY t) AS k FROM f WHERE t >= rise0), pc AS (SELECT a.session_id, a.color, a.k, (a.t + b.t) / 2 AS centre FROM k a JOIN k b ON a.session_id = b.session_id AND a.color = b.color AND a.k = b.k AND a.state = 1 AND b.state = 0)"""
query("l7_dio_time", f"WITH {DIO} SELECT session_id, color, state, round(t, 6) AS t FROM d")(lambda fx: E.dio_time(fx("fx_dio"), 30000.0).select("session_id", "color", "state", "t"))
query("w13_l6_pulse_centres", f"WITH {PULSES} SELECT session_id, color, CAST(k AS INT) AS k, round(centre, 6) AS centre FROM pc")(lambda fx: pulses(fx).select("session_id", "color", "k", "centre"))
query("l8_trim_overlap", f"WITH {PULSES}, n AS (SELECT *, count(*) OVER (PARTITION BY session_id, color) AS n FROM pc) SELECT session_id, color, CAST(k - 2 AS INT) AS k, round(centre, 6) AS centre FROM n WHERE k > 2 AND k <= n - 2")(lambda fx: E.trim_overlap(pulses(fx)).select("session_id", "color", "k", "centre"))
query("l9_choose_led", "SELECT session_id, CASE WHEN bool_or(color = 'blue') THEN 'blue' ELSE 'red' END AS led FROM fx_dio GROUP BY 1")(lambda fx: E.choose_led(fx("fx_dio")))
query("l10_fit_clock", f"WITH {PULSES} SELECT session_id, count(*) AS n, round(regr_slope(centre, k * 2.0), 6) AS slope, round(regr_intercept(centre, k * 2.0), 6) AS intercept FROM pc GROUP BY 1")(lambda fx: E.fit_clock(pulses(fx).select("session_id", F.col("centre").alias("true_t"), (F.col("k") * 2.0).alias("camera_t"))))
query("l1_correct_cpu_clock", """WITH c AS (SELECT session_id, frame_index, seconds AS gpu, seconds * 1.01 + (frame_index % 7) / 100.0 AS cpu FROM fx_track), f AS (SELECT session_id, regr_slope(cpu, gpu) AS a, regr_intercept(cpu, gpu) AS b FROM c GROUP BY 1)
SELECT session_id, frame_index, round(a * gpu + b - avg(CASE WHEN frame_index < 30 THEN a * gpu + b - cpu END) OVER (PARTITION BY session_id), 6) AS corrected FROM c JOIN f USING (session_id)""")(lambda fx: E.correct_cpu_clock(fx("fx_track").select("session_id", "frame_index", F.col("seconds").alias("gpu"), (F.col("seconds") * 1.01 + F.col("frame_index") % 7 / 100.0).alias("cpu")), 30))
query("l4_classify_led", f"WITH {DIO}, r AS (SELECT *, CASE WHEN state = 1 AND lag(state) OVER (PARTITION BY session_id, color ORDER BY t) = 0 THEN 1 ELSE 0 END AS rise FROM d), g AS (SELECT session_id, color, avg(state) AS duty, sum(rise) / count(*) AS hz FROM r GROUP BY 1, 2) SELECT session_id, color, round(duty, 6) AS duty, round(hz, 6) AS hz, CASE WHEN abs(duty - 0.5) < 0.1 AND abs(hz - 0.5) < 0.05 THEN 'red' WHEN abs(duty - 0.5) < 0.1 AND abs(hz - 2.5) < 0.25 THEN 'blue' END AS led FROM g")(lambda fx: E.classify_led(E.dio_time(fx("fx_dio"), 30000.0), 1.0))
query("l12_count_mismatch", "SELECT session_id, frames, coalesce(ticks, 0) AS ticks FROM (SELECT session_id, count(*) AS frames FROM fx_track GROUP BY 1) LEFT JOIN (SELECT session_id, count(*) AS ticks FROM fx_spikes GROUP BY 1) USING (session_id) WHERE frames <> coalesce(ticks, 0)")(lambda fx: E.count_mismatch(fx("fx_track"), fx("fx_spikes")))
MOM = "g AS (SELECT session_id, p_size_group AS grp, count(*) AS n, avg(value) AS mean, var_samp(value) AS var FROM (SELECT session_id, unit_id % 3 AS p_size_group, acg_tau_rise_ms AS value FROM fx_units WHERE acg_tau_rise_ms IS NOT NULL) GROUP BY 1, 2 HAVING count(*) >= 2)"


def grouped(fx):
    return fx("fx_units").withColumn("grp", F.col("unit_id") % 3)


query("c2_anova_f", f"WITH {MOM}, m AS (SELECT *, sum(n * mean) OVER (PARTITION BY session_id) / sum(n) OVER (PARTITION BY session_id) AS grand FROM g) SELECT session_id, count(*) AS k, CAST(sum(n) AS BIGINT) AS total, round((sum(n * (mean - grand) ** 2) / (count(*) - 1)) / (sum((n - 1) * var) / (sum(n) - count(*))), 6) AS f FROM m GROUP BY 1 HAVING count(*) >= 2")(lambda fx: C.anova(grouped(fx), ["session_id"], "grp", "acg_tau_rise_ms").drop("p"))
query("c2_anova_p")(lambda fx: C.anova(grouped(fx), ["session_id"], "grp", "acg_tau_rise_ms"))
query("c3_welch_pairs", f"WITH {MOM} SELECT a.session_id, a.grp AS grp_a, b.grp AS grp_b, round((a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n), 6) AS t, round((a.var / a.n + b.var / b.n) ** 2 / ((a.var / a.n) ** 2 / (a.n - 1) + (b.var / b.n) ** 2 / (b.n - 1)), 6) AS df FROM g a JOIN g b ON a.session_id = b.session_id AND a.grp < b.grp")(lambda fx: C.welch_pairs(grouped(fx), ["session_id"], "grp", "acg_tau_rise_ms").drop("p"))
query("c3_c4_welch_holm")(lambda fx: C.holm(C.welch_pairs(grouped(fx), ["session_id"], "grp", "acg_tau_rise_ms"), ["session_id"], "p", "grp_a", "grp_b"))
query("w16_holm", """WITH p AS (SELECT session_id, unit_id, (unit_id * 7 % 1000) / 10000.0 AS p FROM fx_units), h AS (SELECT *, (count(*) OVER (PARTITION BY session_id) - row_number() OVER (PARTITION BY session_id ORDER BY p, unit_id) + 1) * p AS h FROM p)
SELECT session_id, unit_id, round(p, 6) AS p, round(least(1.0, max(h) OVER (PARTITION BY session_id ORDER BY p, unit_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS p_holm, CASE WHEN least(1.0, max(h) OVER (PARTITION BY session_id ORDER BY p, unit_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) < 0.05 THEN '*' ELSE '' END AS mark FROM h""")(lambda fx: C.holm(fx("fx_units").select("session_id", "unit_id", (F.col("unit_id") * 7 % 1000 / 10000.0).alias("p")), ["session_id"], "p", "unit_id"))
query("w19_zscore", "SELECT session_id, unit_id, round((firing_rate_hz - avg(firing_rate_hz) OVER w) / CASE WHEN stddev_pop(firing_rate_hz) OVER w = 0 THEN 1.0 ELSE stddev_pop(firing_rate_hz) OVER w END, 6) AS z FROM fx_units WINDOW w AS (PARTITION BY session_id)")(lambda fx: C.zscore(fx("fx_units"), ["session_id"], "firing_rate_hz").select("session_id", "unit_id", "z"))
query("w20_minmax", "SELECT session_id, unit_id, round((firing_rate_hz - min(firing_rate_hz) OVER w) / (max(firing_rate_hz) OVER w - min(firing_rate_hz) OVER w + 1e-12), 6) AS scaled FROM fx_units WINDOW w AS (PARTITION BY session_id)")(lambda fx: C.minmax(fx("fx_units"), ["session_id"], "firing_rate_hz").select("session_id", "unit_id", "scaled"))
query("w15_concat_offsets", "SELECT session_id, trial_num, n, CAST(coalesce(sum(n) OVER (PARTITION BY session_id ORDER BY trial_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM (SELECT session_id, trial_num, count(*) AS n FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2)")(lambda fx: C.concat_offsets(fx("fx_track").filter("trial_num is not null").groupBy("session_id", "trial_num").agg(F.count("*").alias("n")), ["session_id"], "trial_num", "n"))
query("c7_type_groups", """SELECT session_id, "group", count(*) AS n, round(quantile_cont(m, 0.25), 6) AS q25, round(quantile_cont(m, 0.5), 6) AS q50, round(quantile_cont(m, 0.75), 6) AS q75 FROM (SELECT session_id, CASE WHEN trial_type IN (4, 5) THEN 'free' ELSE 'goal' END AS "group", CAST(start_node AS DOUBLE) AS m FROM fx_trial_meta) GROUP BY 1, 2""")(lambda fx: C.type_groups(fx("fx_trial_meta").withColumn("m", F.col("start_node").cast("double")), "m"))
query("c10_metric_hist", """WITH l AS (SELECT 'snr' AS metric, snr AS value FROM fx_units UNION ALL SELECT 'acg_tau_rise_ms', acg_tau_rise_ms FROM fx_units WHERE acg_tau_rise_ms IS NOT NULL), s AS (SELECT metric, min(value) AS a, max(value) AS b FROM l GROUP BY 1)
SELECT metric, CAST(least(floor((value - a) / (b - a) * 30), 29) AS INT) AS bin, count(*) AS n FROM l JOIN s USING (metric) GROUP BY 1, 2""")(lambda fx: C.metric_hist(fx("fx_units"), ["snr", "acg_tau_rise_ms"]))
query("n12_population_matrix")(lambda fx: N.population_matrix(fx("fx_spikes")).select("session_id", "unit_id", "bin", "z"))
query("n2_waveform_metrics", """WITH c AS (SELECT session_id, chunk AS unit_id, channel, list_transform(v, lambda a: CAST(a AS DOUBLE)) AS v FROM fx_signal), k AS (SELECT session_id, unit_id FROM c GROUP BY 1, 2 HAVING min(len(v)) = max(len(v)) AND min(len(v)) >= 4 AND max(list_max(v) - list_min(v)) > 0),
u AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY session_id, unit_id ORDER BY list_max(v) - list_min(v) DESC, channel) = 1), p AS (SELECT u.session_id, u.unit_id, CASE WHEN k.unit_id IS NOT NULL THEN v END AS v FROM u LEFT JOIN k ON k.session_id = u.session_id AND k.unit_id = u.unit_id),
q AS (SELECT *, list_position(v, list_min(v)) AS low FROM p), r AS (SELECT *, low - 1 + list_position(v[low:], list_max(v[low:])) AS high FROM q)
SELECT session_id, unit_id, round((high - low) / 30000.0, 6) AS trough_to_peak_s, CASE WHEN v[high] > 0 THEN round((coalesce(list_min([i for i in range(1, len(v) + 1) if i > high and v[i] < v[high] / 2]), len(v) + 1) - coalesce(list_max([i for i in range(1, len(v) + 1) if i < high and v[i] < v[high] / 2]), 0) - 2) / 30000.0, 6) END AS peak_half_width_s,
CASE WHEN v[low] < 0 THEN round((coalesce(list_min([i for i in range(1, len(v) + 1) if i > low and v[i] > v[low] / 2]), len(v) + 1) - coalesce(list_max([i for i in range(1, len(v) + 1) if i < low and v[i] > v[low] / 2]), 0) - 2) / 30000.0, 6) END AS trough_half_width_s FROM r""")(lambda fx: N.waveform_metrics(signal(fx).select("session_id", F.col("chunk").alias("unit_id"), "channel", F.col("k").alias("sample"), F.col("value").cast("double").alias("value")), 30000.0))
query("e4_wakefulness")(lambda fx: N.wakefulness(signal(fx).withColumn("sample", F.col("k") + 64 * F.floor(F.col("chunk") / 80)), 64.0, 0, 1))


def patches(fx):
    return fx("fx_signal").select("session_id", F.col("chunk").alias("frame_index"), F.slice("v", 1, 8).alias("v"))


query("l2_unmix", digits=3)(lambda fx: D.unmix(patches(fx)).withColumn("value", F.abs("value")).groupBy("session_id", "component").agg(F.count("*").alias("n"), F.stddev_pop("value").alias("spread")))
query("l3_on_off")(lambda fx: D.on_off(D.unmix(patches(fx))).groupBy("session_id", "component").agg(F.sum("state").alias("frames_on")))


def folded(fx):
    """Eight channels at every sample."""
    at = F.floor(F.col("sample") / 512) % 8 * 64 + F.col("sample") % 64
    return signal(fx).withColumn("sample", at).groupBy("session_id", "channel", "sample").agg(F.avg(F.col("value").cast("double")).alias("value"))


def probe(fx):
    return E.probe_table(fx("fx_signal").sparkSession).withColumn("channel", F.col("tetrode") * 4 + F.col("contact"))


def sampled(rows):
    return rows.select("session_id", "channel", F.col("start"), F.posexplode("v").alias("k", "value")).select("session_id", "channel", (F.col("start") + F.col("k")).alias("sample"), "value")


def linked(fx):
    return fx("events").filter("event_type <> 'error'").select(F.concat(F.lit("s"), "user_id").alias("session_id"), (F.col("event_id") % 3).cast("int").alias("unit_id"), (F.col("event_id") % 977 / 450.0).alias("t"), (F.col("event_id") % 101).cast("double").alias("amplitude"))


query("e6_decimate", f"""WITH {SAMPLES}, w AS (SELECT k, CASE WHEN k = 0 THEN 0.5 ELSE sin(pi() * k / 2) / (pi() * k) END * (0.54 + 0.46 * cos(pi() * k / 20)) AS h FROM (SELECT unnest(range(-20, 21)) AS k)), h AS (SELECT k, h / (SELECT sum(h) FROM w) AS h FROM w)
SELECT o.session_id, o.channel, o.sample // 2 AS sample, round(sum(h * x.value), 5) + 0.0 AS value FROM x o JOIN x ON x.session_id = o.session_id AND x.channel = o.channel AND x.sample BETWEEN o.sample - 20 AND o.sample + 20 JOIN h ON h.k = x.sample - o.sample WHERE o.sample % 2 = 0 GROUP BY 1, 2, 3""", 5)(lambda fx: sampled(R.decimate(fx("fx_signal"), 64, 2)).withColumn("value", F.round("value", 5) + 0.0))
query("e10_resample")(lambda fx: sampled(R.resample(fx("fx_signal"), 64, 2000, 1500)))
query("e14_preprocess", f"""WITH {SAMPLES}, f AS (SELECT session_id, channel, sample // 512 % 8 * 64 + sample % 64 AS sample, avg(value) AS value FROM x GROUP BY 1, 2, 3), g AS (SELECT c AS channel, c // 4 * 250.0 + CASE c % 4 WHEN 1 THEN 10.0 WHEN 3 THEN -10.0 ELSE 0.0 END AS px, CASE c % 4 WHEN 0 THEN 10.0 WHEN 2 THEN -10.0 ELSE 0.0 END AS py FROM (SELECT unnest(range(8)) AS c)),
w AS (SELECT a.channel AS lost, b.channel, 1 / sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2) AS w FROM g a JOIN g b ON a.channel = 2 AND b.channel NOT IN (2, 7) AND sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2) <= 50), m AS (SELECT session_id, sample, lost AS channel, sum(w * value) / sum(w) AS made FROM f JOIN w USING (channel) GROUP BY 1, 2, 3),
r AS (SELECT f.session_id, f.channel, f.sample, CASE WHEN f.channel = 2 THEN made ELSE value END AS value FROM f LEFT JOIN m ON m.session_id = f.session_id AND m.sample = f.sample AND m.channel = f.channel WHERE f.channel <> 7), s AS (SELECT session_id, channel, sample, value - coalesce(max(CASE WHEN channel = 5 THEN value END) OVER (PARTITION BY session_id, sample), 0) AS value FROM r)
SELECT session_id, channel, sample, round(value - median(value) OVER (PARTITION BY session_id, sample), 5) + 0.0 AS value FROM s""", 5)(lambda fx: R.preprocess(folded(fx), probe(fx), [7], [2], [5]).select("session_id", "channel", "sample", (F.round("value", 5) + 0.0).alias("value")))
query("e14_preprocess_chunks", f"""WITH {SAMPLES}, g AS (SELECT c AS channel, c // 4 * 250.0 + CASE c % 4 WHEN 1 THEN 10.0 WHEN 3 THEN -10.0 ELSE 0.0 END AS px, CASE c % 4 WHEN 0 THEN 10.0 WHEN 2 THEN -10.0 ELSE 0.0 END AS py FROM (SELECT unnest(range(8)) AS c)),
w AS (SELECT a.channel AS lost, b.channel, 1 / sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2) AS w FROM g a JOIN g b ON a.channel = 2 AND b.channel NOT IN (2, 7) AND sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2) <= 50), m AS (SELECT session_id, sample, lost AS channel, sum(w * value) / sum(w) AS made FROM x JOIN w USING (channel) GROUP BY 1, 2, 3),
r AS (SELECT x.session_id, x.channel, x.sample, CASE WHEN x.channel = 2 THEN made ELSE value END AS value FROM x LEFT JOIN m ON m.session_id = x.session_id AND m.sample = x.sample AND m.channel = x.channel WHERE x.channel <> 7), s AS (SELECT session_id, channel, sample, value - coalesce(max(CASE WHEN channel = 5 THEN value END) OVER (PARTITION BY session_id, sample), 0) AS value FROM r)
SELECT session_id, channel, sample, round(value - median(value) OVER (PARTITION BY session_id, sample), 5) + 0.0 AS value FROM s""", 5)(lambda fx: E.samples(R.preprocess_chunks(fx("fx_signal"), probe(fx), [7], [2], [5]), 64).select("session_id", "channel", "sample", (F.round("value", 5) + 0.0).alias("value")))
query("e4_wakefulness_at")(lambda fx: (lambda rows: N.wakefulness_at(rows, N.wakefulness(rows, 64.0, 0, 1), 64.0))(signal(fx).withColumn("sample", F.col("k") + 64 * F.floor(F.col("chunk") / 80))))
query("n15_amplitudes", "SELECT session_id, unit_id, CAST(row_number() OVER (PARTITION BY session_id, unit_id ORDER BY t, amplitude) AS INT) AS k, round(t, 6) AS t, amplitude FROM (SELECT concat('s', user_id) AS session_id, CAST(event_id % 3 AS INT) AS unit_id, event_id % 977 / 450.0 AS t, CAST(event_id % 101 AS DOUBLE) AS amplitude FROM events WHERE event_type <> 'error')")(lambda fx: P.amplitudes(linked(fx)))
query("s17_pool_qualities", f"SELECT session_id, unit_id, round(snr, 6) AS snr, {LABEL} AS quality, CAST(substr(session_id, 2) AS INT) AS animal FROM fx_units WHERE {LABEL} IN ('good', 'mua')")(lambda fx: Y.pool_qualities({q: units(fx).filter(F.col("label") == q).select("session_id", "unit_id", "snr") for q in ("good", "mua")}, fx("fx_units").select("session_id", F.substring("session_id", 2, 9).cast("int").alias("animal")).distinct()))
query("l4_forced_led", f"WITH {DIO}, r AS (SELECT *, CASE WHEN state = 1 AND lag(state) OVER (PARTITION BY session_id, color ORDER BY t) = 0 THEN 1 ELSE 0 END AS rise FROM d), g AS (SELECT session_id, color, avg(state) AS duty, sum(rise) / count(*) AS hz FROM r GROUP BY 1, 2) SELECT session_id, color, CASE WHEN session_id LIKE '%3' THEN 'blue' WHEN abs(duty - 0.5) < 0.1 AND abs(hz - 0.5) < 0.05 THEN 'red' WHEN abs(duty - 0.5) < 0.1 AND abs(hz - 2.5) < 0.25 THEN 'blue' END AS led FROM g")(lambda fx: E.classify_led(E.dio_time(fx("fx_dio"), 30000.0), 1.0, fx("fx_dio").filter("session_id LIKE '%3'").select("session_id", "color", F.lit("blue").alias("led")).distinct()).select("session_id", "color", "led"))
query("e13_truncate_common", "SELECT a.session_id, a.sample, a.value AS a, b.value AS b FROM (SELECT session_id, frame_index AS sample, round(x, 6) AS value FROM fx_track WHERE x IS NOT NULL) a JOIN (SELECT session_id, frame_index AS sample, round(y, 6) AS value FROM fx_track WHERE frame_index % 3 > 0) b ON a.session_id = b.session_id AND a.sample = b.sample")(lambda fx: E.truncate_common(known(fx).select("session_id", F.col("frame_index").alias("sample"), F.col("x").alias("a")), fx("fx_track").filter("frame_index % 3 > 0").select("session_id", F.col("frame_index").alias("sample"), F.col("y").alias("b")), ["session_id", "sample"]))
query("c1_moments", "SELECT session_id, unit_id % 3 AS grp, count(*) AS n, round(avg(acg_tau_rise_ms), 6) AS mean, round(var_samp(acg_tau_rise_ms), 6) AS var FROM fx_units WHERE acg_tau_rise_ms IS NOT NULL GROUP BY 1, 2")(lambda fx: C.moments(grouped(fx), ["session_id"], "grp", "acg_tau_rise_ms"))
query("c6_perf_corr", "SELECT session_id, count(*) AS n, CASE WHEN count(*) >= 3 AND var_pop(snr) > 0 AND var_pop(firing_rate_hz) > 0 THEN round(corr(snr, firing_rate_hz), 6) END AS r, CASE WHEN count(*) >= 3 AND var_pop(snr) > 0 AND var_pop(firing_rate_hz) > 0 THEN round(regr_slope(firing_rate_hz, snr), 6) END AS slope, CASE WHEN count(*) >= 3 AND var_pop(snr) > 0 AND var_pop(firing_rate_hz) > 0 THEN round(regr_intercept(firing_rate_hz, snr), 6) END AS intercept FROM fx_units GROUP BY 1")(lambda fx: P.score(fx("fx_units"), "snr", "firing_rate_hz", ["session_id"], 3))
query("f12_rat_number", "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN CAST(p_partkey % 11 AS INT) END AS rat FROM part")(lambda fx: fx("part").select("p_partkey", S.rat_number(F.when(F.col("p_partkey") % 3 == 0, F.format_string("x_Rat%d_a", F.col("p_partkey") % 11)).when(F.col("p_partkey") % 3 == 1, F.format_string("rat_%d.csv", F.col("p_partkey") % 11)).otherwise("none")).alias("rat")))
query("f17_euclid", "SELECT session_id, frame_index, round(sqrt((x1 - x2) ** 2 + (y1 - y2) ** 2), 6) AS d, x1, y1 FROM fx_detections")(lambda fx: fx("fx_detections").select("session_id", "frame_index", S.euclid(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("d"), "x1", "y1"))
query("f21_bins", "SELECT session_id, frame_index, CASE WHEN x BETWEEN 1 AND 8 THEN least(CAST(floor((x - 1) / 7.0 * 9) AS INT), 8) END AS bin, least(greatest(CAST(floor((x - 1) / 7.0 * 9) AS INT), 0), 8) AS clipped FROM fx_track WHERE x IS NOT NULL")(lambda fx: known(fx).select("session_id", "frame_index", T.bins(F.col("x"), 1.0, 8.0, 9).alias("bin"), T.clipped_bin(F.col("x"), 1.0, 8.0, 9).alias("clipped")))
query("n18_grid", "SELECT g.bx, g.cy AS \"by\", count(t.session_id) AS n FROM (SELECT CAST(i % 18 AS INT) AS bx, CAST(i // 18 AS INT) AS cy FROM (SELECT unnest(range(180)) AS i)) g LEFT JOIN (SELECT session_id, least(CAST(floor(x / 9.0 * 18) AS INT), 17) AS bx, least(CAST(floor(y / 5.0 * 10) AS INT), 9) AS cy FROM fx_track WHERE x BETWEEN 0 AND 9 AND y BETWEEN 0 AND 5) t ON t.bx = g.bx AND t.cy = g.cy GROUP BY 1, 2")(lambda fx: (lambda visits: M.grid_table(visits.sparkSession, 9.0, 5.0, 0.5).join(visits, ["bx", "by"], "left").groupBy("bx", "by").agg(F.count("session_id").alias("n")))(T.occupancy(fx("fx_track"), keys=("session_id", "frame_index"), nx=18, ny=10).select("session_id", "bx", "by")))
query("e15_probe", "SELECT session_id, channel, CAST(floor(channel / 4) AS BIGINT) // 4 * 250.0E0 + CASE channel % 4 WHEN 0 THEN 10.0E0 WHEN 2 THEN -10.0E0 ELSE 0.0E0 END AS y, CAST(floor(channel / 4) AS BIGINT) % 4 * 250.0E0 + CASE channel % 4 WHEN 1 THEN 10.0E0 WHEN 3 THEN -10.0E0 ELSE 0.0E0 END AS x FROM (SELECT DISTINCT session_id, channel FROM fx_signal)")(lambda fx: fx("fx_signal").select("session_id", "channel").distinct().join(probe(fx).select("channel", "x", "y"), "channel").select("session_id", "channel", "y", "x"))
