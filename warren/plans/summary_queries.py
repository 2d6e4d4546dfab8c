"""Summaries over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.functions import scalars as S
from warren.operators import summary as U
from warren.plans.registry import query

query("a8_segment_summary", "SELECT row_id, round(sum(0.3), 6)::DOUBLE AS length, CAST(sum(seq % 3) AS BIGINT) AS time, round(avg(seq * 0.5), 6) AS mean_speed, CASE WHEN sum(seq % 3) > 0 THEN round(sum(0.3E0) / sum(seq % 3), 3) END AS avg_speed FROM fx_paths GROUP BY 1")(lambda fx: U.segment_summary(fx("fx_paths").select("row_id", F.lit(0.3).alias("length_m"), (F.col("seq") % 3).alias("diff_s"), (F.col("seq") * 0.5).alias("speed"))))
query("a13_collapse_units", "SELECT concat('s', p_partkey % 20) AS session_id, p_size AS trial_num, round(avg(p_retailprice), 6) AS m, max(p_size) AS own FROM part GROUP BY 1, 2")(lambda fx: U.collapse_units(fx("part").select(F.concat(F.lit("s"), F.col("p_partkey") % 20).alias("session_id"), F.col("p_size").alias("trial_num"), F.col("p_retailprice").alias("m"), F.col("p_size").alias("own")), ["m"], ["own"]))
query("a20_folder_summary", "SELECT rat_no, session_date, volume, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes, round(avg(size_bytes) / 1e6, 6) AS mean_mb, count(*) FILTER (size_bytes = 0) AS empty FROM fx_files GROUP BY 1, 2, 3")(lambda fx: U.folder_summary(fx("fx_files"), ["rat_no", "session_date", "volume"]))
STATUS = "CASE l_linenumber % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'partial' ELSE 'missing' END"
query("a23_step_status", f"SELECT session_id, count(*) FILTER (r = 2) AS done, count(*) FILTER (r = 1) AS partial, count(*) FILTER (r = 0) AS missing FROM (SELECT l_suppkey AS session_id, l_partkey % 8 AS step, max(CASE {STATUS} WHEN 'done' THEN 2 WHEN 'partial' THEN 1 ELSE 0 END) AS r FROM lineitem GROUP BY 1, 2) GROUP BY 1")(lambda fx: U.step_status(fx("lineitem").select(F.col("l_suppkey").alias("session_id"), (F.col("l_partkey") % 8).alias("step"), F.expr(STATUS).alias("status"))))
query("t8_pick_window", "SELECT session_id, CASE WHEN n >= 10 THEN round(t0, 6) ELSE 0.0 END AS t0, CASE WHEN n >= 10 THEN round(t1, 6) ELSE 60.0 END AS t1 FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, trial_num) AS r FROM (SELECT session_id, trial_num, count(*) AS n, min(seconds) AS t0, max(seconds) AS t1 FROM fx_track WHERE trial_num IS NOT NULL GROUP BY 1, 2)) WHERE r = 1")(lambda fx: U.pick_window(fx("fx_track").filter("trial_num is not null").select("session_id", "trial_num", F.col("seconds").alias("t"))))
query("t6_label_order", "SELECT p_partkey, CAST(p_partkey % 7 AS INT) AS r, CAST(p_partkey % 5 AS INT) AS s FROM part")(lambda fx: U.label_order(fx("part").withColumn("label", F.format_string("R%dS%d", F.col("p_partkey") % 7, F.col("p_partkey") % 5)), "label").select("p_partkey", "r", "s"))
query("t7_i14_order_parts", "SELECT rat_no, session_date, string_agg(f, ',' ORDER BY substr(f, 6), f) AS parts FROM (SELECT DISTINCT rat_no, session_date, printf('%s_%06d', phase, rat_no * 100 + length(phase)) AS f FROM fx_files WHERE length(phase) = 4) GROUP BY 1, 2")(lambda fx: U.order_parts(fx("fx_files").filter("length(phase) = 4").withColumn("f", F.format_string("%s_%06d", "phase", F.col("rat_no") * 100 + F.length("phase"))), "f").select("rat_no", "session_date", F.array_join("parts", ",").alias("parts")))
query("f7_age", "SELECT o_orderkey, concat('P', y, 'Y', date_diff('day', b + to_years(y::INT), d), 'D') AS age FROM (SELECT o_orderkey, d, b, CASE WHEN strftime(d, '%m%d') >= strftime(b, '%m%d') THEN year(d) - year(b) ELSE year(d) - year(b) - 1 END AS y FROM (SELECT o_orderkey, o_orderdate::DATE AS d, DATE '1990-03-15' AS b FROM orders))")(lambda fx: fx("orders").select("o_orderkey", S.age(F.lit("1990-03-15").cast("date"), F.col("o_orderdate").cast("date")).alias("age")))
query("f8_session_stem", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '20240102_Rat7' ELSE concat('v', p_partkey) END AS stem FROM part")(lambda fx: fx("part").select("p_partkey", S.session_stem(F.when(F.col("p_partkey") % 2 == 0, "x_20240102_Rat7_a.csv").otherwise(F.format_string("v%d.csv", "p_partkey"))).alias("stem")))
query("f9_recording_prefix", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'rat3_20240102_101112' END AS prefix FROM part")(lambda fx: fx("part").select("p_partkey", S.recording_prefix(F.when(F.col("p_partkey") % 2 == 0, "rat3_20240102_101112_part1.rec").otherwise("other")).alias("prefix")))
query("f13_id_and_note", "SELECT p_partkey, concat('Rat_', p_partkey % 9, '_20240102') AS id, '_redo' AS note FROM part")(lambda fx: fx("part").withColumn("n", F.format_string("Rat_%d_20240102_redo", F.col("p_partkey") % 9)).select("p_partkey", S.id_and_note(F.col("n"))[0].alias("id"), S.id_and_note(F.col("n"))[1].alias("note")))
