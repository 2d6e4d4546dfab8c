"""Sessions in order and their statistics over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import series as S
from warren.plans.neural_queries import LABEL, TYPE, units
from warren.plans.registry import query

#: Units as of animals and dates.
UNITS = f"u AS (SELECT concat('rat', unit_id % 4) AS animal, CAST(20260601 + unit_id % 5 AS VARCHAR) AS date, CASE WHEN unit_id % 6 > 0 THEN CAST(unit_id % 3 AS INT) END AS repeat, CAST(unit_id % 2 AS INT) AS session, unit_id, snr, acg_tau_rise_ms, {LABEL} AS label, {TYPE} AS cell_type, CASE unit_id % 5 WHEN 0 THEN 'before' WHEN 1 THEN 'after' ELSE 'whole' END AS epoch FROM fx_units)"


def animal_units(fx):
    k = F.col("unit_id")
    return units(fx).select(
        F.concat(F.lit("rat"), k % 4).alias("animal"), (k % 5 + 20260601).cast("string").alias("date"), F.when(k % 6 > 0, (k % 3).cast("int")).alias("repeat"), (k % 2).cast("int").alias("session"), "unit_id", "snr", "acg_tau_rise_ms", "label", F.col("type").alias("cell_type"),
        F.when(k % 5 == 0, "before").when(k % 5 == 1, "after").otherwise("whole").alias("epoch"),
    )


def series(fx):
    return S.animal_series(animal_units(fx))


SERIES = f"{UNITS}, l AS (SELECT *, concat('R', coalesce(CAST(repeat AS VARCHAR), '?'), 'S', session) AS session_label FROM u)"
GROUPS = f"""{SERIES}, v AS (SELECT animal AS scope, 'snr' AS metric, date AS grp, snr AS value FROM l UNION ALL SELECT animal, 'acg_tau_rise_ms', date, acg_tau_rise_ms FROM l UNION ALL SELECT 'ALL', 'snr', session_label, snr FROM l UNION ALL SELECT 'ALL', 'acg_tau_rise_ms', session_label, acg_tau_rise_ms FROM l),
g AS (SELECT scope, metric, grp, count(*) AS n, avg(value) AS mean, var_samp(value) AS var FROM v WHERE value IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2)"""
METRICS = ["snr", "acg_tau_rise_ms"]
query("c5_stats_tables", f"WITH {GROUPS}, m AS (SELECT *, sum(n * mean) OVER (PARTITION BY scope, metric) / sum(n) OVER (PARTITION BY scope, metric) AS grand FROM g) SELECT scope, metric, count(*) AS k, CAST(sum(n) AS BIGINT) AS total, round((sum(n * (mean - grand) ** 2) / (count(*) - 1)) / (sum((n - 1) * var) / (sum(n) - count(*))), 6) AS f FROM m GROUP BY 1, 2 HAVING count(*) >= 2")(lambda fx: S.stats_tables(series(fx), METRICS)[0].drop("p"))
query("c5_posthoc", f"WITH {GROUPS} SELECT a.scope, a.metric, a.grp AS grp_a, b.grp AS grp_b, round((a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n), 6) AS t FROM g a JOIN g b ON a.scope = b.scope AND a.metric = b.metric AND a.grp < b.grp")(lambda fx: S.stats_tables(series(fx), METRICS)[1].select("scope", "metric", "grp_a", "grp_b", "t"))
query("c9_collect_sessions", f"""WITH {UNITS}, c AS (SELECT animal, date, count(*) FILTER (label = 'good') AS n_good, count(*) FILTER (label = 'mua') AS n_mua, count(*) FILTER (label = 'good' AND cell_type = 'pyramidal') AS n_pyr, count(*) FILTER (label = 'good' AND cell_type = 'interneuron') AS n_int FROM u GROUP BY 1, 2),
d AS (SELECT animal, date, max(snr) FILTER (repeat = 1) AS dec_good_1s, max(snr) FILTER (repeat = 2) AS dec_good_2s FROM u WHERE session = 1 GROUP BY 1, 2), e AS (SELECT animal, date, bool_or(epoch = 'after') AS split, avg(acg_tau_rise_ms) FILTER (epoch <> 'after') AS m, avg(acg_tau_rise_ms) FILTER (epoch = 'after') AS p FROM u WHERE label = 'good' GROUP BY 1, 2)
SELECT animal, date, n_good, n_mua, n_pyr, n_int, coalesce(split, false) AS split, round(dec_good_1s, 6) AS dec_good_1s, round(dec_good_2s, 6) AS dec_good_2s, round(m, 6) AS acg_tau_rise_ms, round(p, 6) AS acg_tau_rise_ms_post FROM c LEFT JOIN d USING (animal, date) LEFT JOIN e USING (animal, date)""")(
    lambda fx: (lambda u: S.collect_sessions(u, u.filter("session = 1").select("animal", "date", F.lit("good").alias("quality"), F.col("repeat").cast("double").alias("lead"), F.col("snr").alias("median_err")), u.filter("label = 'good'"), [1.0, 2.0], ["good"], ["acg_tau_rise_ms"]))(animal_units(fx))
)
query("c11_animal_series", f"WITH {SERIES}, s AS (SELECT DISTINCT animal, date, repeat, session, session_label FROM l) SELECT animal, date, session_label, CAST(row_number() OVER (PARTITION BY animal ORDER BY date, session, session_label) AS INT) AS place FROM (SELECT animal, date, session_label, session FROM s QUALIFY row_number() OVER (PARTITION BY animal, date, session ORDER BY session_label) = 1)")(
    lambda fx: S.animal_series(animal_units(fx).groupBy("animal", "date", "session").agg(F.min(F.struct(F.coalesce(F.col("repeat").cast("string"), F.lit("?")).alias("k"), "repeat"))["repeat"].alias("repeat"))).select("animal", "date", "session_label", "place")
)
query("g3_template_degrees", "WITH e AS (SELECT u, v FROM fx_edges WHERE v < 500), w AS (SELECT u, v, CASE WHEN v - u < 50 THEN 30 WHEN u = 121 THEN 172 WHEN u = 223 THEN 169 ELSE 60 END AS w FROM e), a AS (SELECT u, w FROM w UNION ALL SELECT v, w FROM w), p AS (SELECT DISTINCT node_id FROM fx_paths) SELECT node_id, count(*) AS degree, CAST(sum(w) AS BIGINT) AS cm FROM p JOIN a ON u = node_id GROUP BY 1")(
    lambda fx: (lambda e: fx("fx_paths").select("node_id").distinct().join(F.broadcast(e.select("u", "w").union(e.select("v", "w"))), F.col("node_id") == F.col("u")).groupBy("node_id").agg(F.count("*").alias("degree"), F.sum("w").alias("cm")))(S.template_edges(fx("region").sparkSession))
)
query("g11_arrange_columns", 'SELECT row_id, seq, node_id AS comment, ' + ", ".join(f'{ {"n_nodes_visited": "seq", "flag": "node_id % 2"}.get(c, "NULL::VARCHAR") } AS "{c}"' for c in S.OUTPUT) + " FROM fx_paths")(
    lambda fx: S.arrange_columns(fx("fx_paths").select("row_id", "seq", F.col("node_id").alias("comment"), (F.col("node_id") % 2).alias("flag"), F.col("seq").alias("visited"), F.lit(1).alias("later")), {"visited": "n_nodes_visited"})
)
query("p13_assert_roi", "SELECT session_id AS roi, x1 AS x, y1 AS y, n FROM (SELECT session_id, x1, y1, count(*) OVER (PARTITION BY session_id) AS n FROM fx_detections) WHERE n >= 3")(lambda fx: S.assert_roi(fx("fx_detections").select(F.col("session_id").alias("roi"), F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(1176).alias("drawn_w"), F.lit(712).alias("drawn_h")), 1176, 712).select("roi", "x", "y", "n"))
