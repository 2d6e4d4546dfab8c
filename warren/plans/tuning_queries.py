"""Units against behaviour over the fixtures; those without SQL are held against NumPy in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import maps as M
from warren.operators import population as N
from warren.operators import track as T
from warren.operators import tuning as U
from warren.plans.neural_queries import RATES, curves, known
from warren.plans.registry import query
from warren.plans.session_queries import trial_rows
from warren.plans.track_queries import STEPS


def labelled(fx):
    return fx("fx_spikes").withColumn("label", F.when(F.col("unit_id") < 2, "good").otherwise("mua"))


def decoded(fx):
    # a fixture's session lasts seconds, so its bins and visits are short
    return U.decode_leads(fx("fx_track"), labelled(fx), (0.0, 0.1, 0.3), folds=3, width=0.1, least_s=0.03)


def middles(fx):
    return known(fx).select("session_id", F.floor(F.col("seconds") / 0.1).alias("bin")).distinct().withColumn("t", (F.col("bin") + 0.5) * 0.1)


query("j20_posterior_grid", RATES + ', b AS (SELECT DISTINCT session_id, floor(seconds / 0.1)::BIGINT AS bin FROM fx_track WHERE x IS NOT NULL) SELECT session_id, bin, bx, cy AS "by" FROM b JOIN (SELECT DISTINCT session_id, bx, cy FROM o) USING (session_id)')(lambda fx: M.posterior_grid(middles(fx), curves(fx).select("session_id", "bx", "by").distinct()))
query("m6_trial_unit_metrics")(lambda fx: U.trial_unit_metrics(fx("fx_track"), fx("fx_spikes"), trial_rows(fx), sigma=1.0, threshold=0.0, least_cells=2))
query("u6_decode_leads")(decoded)


def facts(fx):
    key = ["session_id", "trial_num"]
    speeds = T.step_speed(T.tracked(fx("fx_track"))).groupBy(*key).agg(F.avg("speed").alias("between_node_speed"))
    performance = fx("fx_trial_meta").select(*key, F.log10((F.col("start_node") % 100) / (F.col("goal_node") % 100)).alias("performance"))
    errors = fx("fx_track").filter("x is not null").select("session_id", F.col("seconds").alias("t"), F.hypot(F.col("x") - 4.5, F.col("y") - 2.5).alias("err"))
    units = fx("fx_spikes").select("session_id", "unit_id").distinct().join(trial_rows(fx).select(*key), "session_id")
    return U.trial_facts(units, errors, trial_rows(fx), performance, speeds)


query("m6_trial_facts", f"""WITH {STEPS}, w AS (SELECT session_id, trial_num, min(seconds) AS t0, max(seconds) AS t1 FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2), e AS (SELECT w.session_id, w.trial_num, median(sqrt((x - 4.5) ** 2 + (y - 2.5) ** 2)) AS err FROM w JOIN fx_track f ON f.session_id = w.session_id AND f.seconds BETWEEN t0 AND t1 WHERE f.x IS NOT NULL GROUP BY 1, 2),
b AS (SELECT session_id, trial_num, avg(speed) AS speed FROM v GROUP BY 1, 2)
SELECT u.session_id, w.trial_num, u.unit_id, round(e.err, 6) AS decoding_error_m, round(log10((m.start_node % 100) / (m.goal_node % 100)), 6) AS performance, round(b.speed, 6) AS between_node_speed FROM (SELECT DISTINCT session_id, unit_id FROM fx_spikes) u JOIN w USING (session_id) LEFT JOIN e ON e.session_id = w.session_id AND e.trial_num = w.trial_num LEFT JOIN fx_trial_meta m ON m.session_id = w.session_id AND m.trial_num = w.trial_num LEFT JOIN b ON b.session_id = w.session_id AND b.trial_num = w.trial_num""")(facts)
query("de7_lead_summary")(lambda fx: U.lead_summary(decoded(fx)))
query("n9_speed_rate")(lambda fx: U.speed_rate(fx("fx_track"), fx("fx_spikes")))
query("n13_bin_behaviour")(lambda fx: U.bin_behaviour(middles(fx), fx("fx_track"), trial_rows(fx), fx("fx_nodes")))
query("n14_embed_pca")(lambda fx: U.embed_pca(N.population_matrix(fx("fx_spikes")).select("session_id", "unit_id", "bin", "z")).select("session_id", "bin", *[F.round(f"pc{i}", 4).alias(f"pc{i}") for i in (1, 2, 3)]))
query("n4_acg_rise_fit")(lambda fx: U.acg_rise_fit(fx("fx_spikes"), bins=100))
query("de10_shuffle_null")(lambda fx: U.shuffle_null(fx("fx_track"), fx("fx_spikes"), (0.0, 0.3), 4, width=0.1, least_s=0.03).groupBy("session_id", "lead", "rep").agg(F.median("neural").alias("m")).groupBy("session_id", "lead").agg(F.avg("m").alias("shuffle_mean"), F.stddev_pop("m").alias("shuffle_sd"), F.count("*").alias("replicates")))
