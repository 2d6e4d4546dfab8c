"""Sheets and sorted spikes over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.plans.registry import query
from warren.sources import sheets as H

query("s7_pick_sheet", "SELECT rat_no, day, q, sheet FROM (SELECT rat_no, day, q, CASE WHEN q % 5 = 3 AND rat_no % 2 = 0 THEN 'RAW' ELSE concat('sheet', q % 5) END AS sheet, q % 5 AS n FROM fx_names) QUALIFY dense_rank() OVER (PARTITION BY rat_no, day ORDER BY CASE WHEN sheet = 'RAW' THEN 0 ELSE 1 END, n, sheet) = 1")(
    lambda fx: H.pick_sheet(fx("fx_names").select(F.concat_ws("_", "rat_no", "day").alias("book"), "rat_no", "day", "q", F.when((F.col("q") % 5 == 3) & (F.col("rat_no") % 2 == 0), "RAW").otherwise(F.concat(F.lit("sheet"), F.col("q") % 5)).alias("sheet"), (F.col("q") % 5).alias("sheet_no"))).select("rat_no", "day", "q", "sheet")
)
query("s12_spike_seconds", "SELECT session_id, CAST(chunk % 7 AS INT) AS unit_id, round(chunk * 11 / (20000.0 + length(session_id)), 6) AS t FROM fx_signal")(
    lambda fx: H.spike_seconds(fx("fx_signal").select("session_id", F.col("chunk").alias("i"), (F.col("chunk") * 11).alias("sample")), fx("fx_signal").select("session_id", F.col("chunk").alias("i"), (F.col("chunk") % 7).alias("cluster")), fx("fx_signal").select("session_id", (20000.0 + F.length("session_id")).alias("fs")).distinct())
)
query("s13_metric_map", "SELECT session_id, unit_id, CAST(1 + (acg_tau_rise_ms IS NOT NULL)::INT + (trough_to_peak_s IS NOT NULL)::INT AS INT) AS n, CAST(num_spikes AS VARCHAR) AS num_spikes FROM fx_units")(
    lambda fx: H.metric_map(fx("fx_units").select("session_id", "unit_id", "num_spikes", "acg_tau_rise_ms", "trough_to_peak_s"), ["session_id", "unit_id"]).select("session_id", "unit_id", F.size("metrics").alias("n"), F.try_element_at("metrics", F.lit("num_spikes")).alias("num_spikes"))
)
query("s20_crop_overrides", "SELECT session_id, frame_index AS line_no, concat('eye', frame_index, '.mp4') AS file, CASE WHEN frame_index % 4 < 2 THEN CAST(frame_index AS INT) END AS x, CASE WHEN frame_index % 4 < 2 THEN CAST(frame_index + 7 AS INT) END AS y, frame_index % 4 >= 2 AS bad FROM fx_track WHERE frame_index % 5 > 0")(
    lambda fx: H.crop_overrides(fx("fx_track").select("session_id", F.col("frame_index").alias("line_no"), F.concat(F.when(F.col("frame_index") % 5 == 0, "# ").otherwise(" /v/"), F.lit("eye"), "frame_index", F.lit(".mp4 , "), F.when(F.col("frame_index") % 4 == 2, "x").otherwise(F.concat("frame_index", F.lit(".0"))), F.lit(","), F.col("frame_index") + 7, F.when(F.col("frame_index") % 4 == 3, ", 1").otherwise("")).alias("value")))
)
query("s20_component_overrides", "SELECT session_id, frame_index AS line_no, concat('eye', frame_index, '.mp4') AS file, CASE WHEN frame_index % 3 < 2 THEN ['blue', 'red'][frame_index % 3 + 1] END AS color, CASE WHEN frame_index % 3 < 2 THEN CAST(frame_index % 4 AS INT) END AS component, frame_index % 3 = 2 AS bad FROM fx_track")(
    lambda fx: H.component_overrides(fx("fx_track").select("session_id", F.col("frame_index").alias("line_no"), F.concat(F.lit("eye"), "frame_index", F.lit(".mp4, "), F.element_at(F.array(*map(F.lit, ("Blue", "RED", "green"))), (F.col("frame_index") % 3 + 1).cast("int")), F.lit(", "), F.col("frame_index") % 4).alias("value")))
)
query("s23_trials_raw", "SELECT session_id, CASE WHEN trial_num % 5 = 0 THEN -1 ELSE trial_type END AS trial_type, goal_node, start_node, trial_num * 10.5 AS start_s, trial_num * 11.5 AS end_s FROM fx_trial_meta WHERE trial_num % 3 > 0")(
    lambda fx: H.read_trials_raw(fx("fx_trial_meta").select("session_id", F.when(F.col("trial_num") % 5 == 0, "free").otherwise(F.col("trial_type").cast("string")).alias("Trial_Type"), F.col("goal_node").cast("string").alias("Goal_Node"), F.concat("start_node", F.lit(",9")).alias("Start_Nodes"), (F.col("trial_num") * 10.5).cast("string").alias("trial_start_time"), F.when(F.col("trial_num") % 3 > 0, (F.col("trial_num") * 11.5).cast("string")).alias("trial_end_time")))
)
