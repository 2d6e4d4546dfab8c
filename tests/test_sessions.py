"""Session bookkeeping on small hand-made cases."""

import math

import pytest
from pyspark.sql import functions as F

from warren.operators import sessions, spikes


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


def test_a_stop_before_the_start_is_ignored(spark):
    frames = spark.createDataFrame([(s, i, float(i)) for s in ("a", "b", "c") for i in range(5)], "session_id string, frame_index int, seconds double")
    bounds = spark.createDataFrame([("a", 1.0, 3.0), ("b", 3.0, 2.0), ("c", None, None)], "session_id string, start double, stop double")
    kept = sessions.clip_session(frames, bounds).groupBy("session_id").count()
    assert rows(kept) == [("a", 3), ("b", 2), ("c", 5)]


def test_keypoints_go_to_indexed_frames_and_the_shorter_side_ends(spark):
    frames = spark.createDataFrame([("s", 0, 7), ("s", 1, None), ("s", 2, 8), ("s", 3, 9)], "session_id string, frame_index int, i int")
    predictions = spark.createDataFrame([("s", 0, 1.5), ("s", 1, 2.5)], "session_id string, k int, nose_x double")
    assert [r["nose_x"] for r in sessions.merge_keypoints(frames, predictions, "i", "k").orderBy("frame_index").collect()] == [1.5, None, 2.5, None]
    assert sessions.merge_keypoints(frames.limit(0), predictions, "i", "k").count() == 0


def test_scores_of_reached_missed_and_empty_paths(spark):
    trials = spark.createDataFrame(
        [(1, [1, 2, 3], 3, 2, 0.6, 0.9, 0.6, 2), (2, [1, 2, 1, 2], 3, None, None, 1.2, 0.6, 2), (3, [3], 3, 0, 0.0, 0.0, 0.0, 0), (4, [], 3, None, None, None, 0.6, 2), (5, None, 3, None, None, None, None, None)],
        "row_id int, path array<int>, goal_node int, arrival_index int, reached_length double, whole_length double, optimal_dist double, optimal_hops int",
    )
    got = {r["row_id"]: (r["distance_score"], r["hops"], r["hops_score"]) for r in sessions.score_trials(trials).collect()}
    assert got[1] == (0.0, 2, 0.0) and got[3] == (None, 0, 0.0) and got[4] == (None, 0, None) and got[5] == (None, 0, None)
    assert got[2][0] == pytest.approx(math.log(0.5)) and got[2][2] == pytest.approx(math.log(2 / 3))


def test_regression_without_spread_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("b", 1.0, 2.0), ("b", 1.0, 3.0), ("c", None, 1.0)], "k string, x double, y double")
    got = {r["k"]: r for r in spikes.score(df, "x", "y", ["k"], least=2).collect()}
    assert (got["a"]["slope"], got["a"]["intercept"], got["a"]["r"]) == pytest.approx((2.0, 0.0, 1.0))
    assert got["b"]["r"] is None and got["c"]["n"] == 0 and got["c"]["slope"] is None


def test_names_of_camera_files(spark):
    names = [("eye01_2026-06-22_11-11-46.mp4", "x"), ("2026-06-22_11-11-46.eye1.mp4", "x"), ("Eye12.2026-06-22.mp4", "2026-06-22_09-00-00"), ("eye3.mp4", "2026-06-22_09-00-00"), ("eye3.mp4", "x"), ("cam.mp4", "2026-06-22_09-00-00"), ("eye3.avi", "2026-06-22_09-00-00"), ("eye4_2026-06-23.mp4", "x"), (None, "x")]
    df = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "i int, name string, folder string").withColumn("w", sessions.camera_name(F.col("name"), F.col("folder")))
    assert [r["w"] for r in df.orderBy("i").collect()] == [None, "eye01_2026-06-22_11-11-46.mp4", "eye12_2026-06-22_09-00-00.mp4", "eye03_2026-06-22_09-00-00.mp4", None, None, None, None, None]


def test_parts_of_split_recordings(spark):
    names = ["Rat5_20260619_160501_post.rec", "Rat5_20260619_170000_post.rec", "Rat5_20260619_100000_pre_part2.rec", "Rat5_20260619_120000_task.rec", "2026-06-19_10-00-00", "Rat5_20260619_130000_task_merged.rec"]
    df = spark.createDataFrame([("s", n) for n in names], "s string, name string")
    assert rows(sessions.split_phases(df, ["s"])) == [("s", "post", 2), ("s", "pre", 2)]


def test_steps_done_implied_missing_and_unmarked(spark):
    due = spark.createDataFrame([("a", False), ("b", True)], "s string, implanted boolean")
    made = spark.createDataFrame([("a", "x_Coordinates_Full.csv"), ("a", None)], "s string, name string")
    steps = sessions.detect_steps(due, made, ["s"])
    assert [r["status"] for r in steps.filter("s = 'a'").orderBy("position").collect()] == ["implied", "implied", "done", "missing", "unchecked", "missing"]
    assert rows(sessions.step_text(steps, ["s"])) == [("a", "done 234 · missing 5d"), ("b", "missing 1e234578d")]


def test_epochs_split_at_a_goal_switch_only(spark):
    trials = spark.createDataFrame([("a", 1, 4, 10, 0.0, 1.0), ("a", 2, 5, 20, 2.0, 3.0), ("b", 1, 5, 10, 0.0, 1.0), ("b", 2, 1, 20, 2.0, 3.0), ("b", 3, 1, 20, 4.0, 5.0)], "session_id string, trial_num int, trial_type int, goal_node int, t0 double, t1 double")
    spans = spark.createDataFrame([("a", 0.0, 9.0), ("b", 0.0, 9.0), ("c", 0.0, 1.0)], "session_id string, first double, last double")
    assert rows(sessions.epochs(trials, spans)) == [("a", "after", 3.0, 9.0, 20), ("a", "before", 0.0, 2.0, 10), ("b", "whole", 0.0, 9.0, 20), ("c", "whole", 0.0, 1.0, None)]


def test_channels_fall_back_to_all(spark):
    columns = spark.createDataFrame([("a", i, i // 4 + 1, i % 4 + 1) for i in range(8)] + [("b", i, 1, i + 1) for i in range(4)], "session_id string, index int, ntrode int, channel int")
    chosen = spark.createDataFrame([("a", 1), ("a", 5), ("a", 6), ("b", 2), ("b", 99)], "session_id string, hw int")
    bad = spark.createDataFrame([("a", 5), ("b", 0)], "session_id string, hw int")
    assert rows(sessions.map_channels(columns, chosen, bad)) == [("a", 1, 1), ("a", 6, 6), ("b", 1, 1), ("b", 2, 2), ("b", 3, 3)]


def test_cameras_are_filled_between_and_after_but_not_before(spark):
    levels = spark.createDataFrame([("s", "red", 1, 0.0, 1.0), ("s", "red", 1, 2.0, 3.0), ("s", "red", 2, 1.0, 10.0), ("s", "red", 2, 3.0, 30.0)], "session_id string, color string, camera int, ts double, value double")
    assert rows(sessions.merge_cameras(levels).select("ts", "total")) == [(0.0, 1.0), (1.0, 12.0), (2.0, 23.0), (3.0, 33.0)]
    assert sessions.merge_cameras(levels.limit(0)).count() == 0


def test_split_phases_matches_patterns_once_for_a_name(spark):
    df = spark.range(100).selectExpr("'s' as s", "concat('Rat1_HM_neurons_20240102_', lpad(id % 3, 2, '0'), '0500_pre.rec') as name")
    found = sessions.split_phases(df, ["s"])
    below = found._jdf.queryExecution().optimizedPlan().toString().lower().split("aggregate")[-1]
    assert "rlike" not in below and "regexp" not in below  # below the first aggregate
    assert [tuple(r) for r in found.collect()] == [("s", "pre", 3)]
