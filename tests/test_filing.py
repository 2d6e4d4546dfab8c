"""Plans of moves and listings on small hand-made cases."""

import datetime as dt

import pytest

from warren.operators import filing

D = [dt.date(2026, 6, d) for d in range(1, 5)]


def test_a_session_key_with_two_files_is_an_error(spark):
    files = spark.createDataFrame([("s", "a.log"), ("s", ".b.log"), ("s", "b.txt"), ("s", "c.mp4")], "s string, name string")
    assert sorted(tuple(r)[1:] for r in filing.list_sessions(files, ["s"]).collect()) == [("log", "a", "a.log"), ("txt", "b", "b.txt")]
    with pytest.raises(Exception, match="ambiguous"):
        filing.list_sessions(files.union(files), ["s"]).collect()


def test_flat_files_count_only_without_folders(spark):
    files = spark.createDataFrame([("a", "r2.LFP", "x_nt1ch1.dat"), ("a", "r1.LFP", "x_nt10ch1.dat"), ("a", "r1.LFP", "x_nt2ch3.dat"), ("a", None, "LFP_nt1ch1.dat"), ("a", "r1.LFP", "x.timestamps.dat"), ("b", None, "LFP_nt1ch1.dat"), ("b", None, "other.dat")], "s string, folder string, name string")
    got = [(r["s"], r["recording"], r["name"]) for r in filing.list_recordings(files, ["s"]).orderBy("s", "place").collect()]
    assert got == [("a", "r1", "x_nt2ch3.dat"), ("a", "r1", "x_nt10ch1.dat"), ("a", "r2", "x_nt1ch1.dat"), ("b", None, "LFP_nt1ch1.dat")]


def test_videos_go_by_time_and_training_order(spark):
    schema = "path string, session_date date, start string, aborted boolean, is_filed boolean, filed_rat int, filed_date date"
    folders = spark.createDataFrame(
        [("p2", D[0], "10", False, False, None, None), ("p1", D[0], "09", False, True, 4, D[0]), ("p3", D[0], "11", False, False, None, None), ("p0", D[0], "08", True, False, None, None), ("q1", D[1], "09", False, True, 3, D[1]), ("old", dt.date(2020, 1, 1), "09", False, False, None, None), ("none", None, "09", False, True, 3, None)], schema
    )
    roster = spark.createDataFrame([(3, D[0], 1), (4, D[0], 2), (3, D[1], 3)], "rat_no int, session_date date, train_order int")
    got = {r["path"]: (r["rat_no"], r["status"]) for r in filing.assign_videos(folders, roster).collect()}
    assert got == {"p1": (3, "refile"), "p2": (4, "fills"), "p3": (None, "extra"), "p0": (None, "aborted"), "old": (None, "other batch")}
    assert {r["status"] for r in filing.assign_videos(folders, roster.limit(0)).collect()} == {"extra", "aborted"}
    assert filing.assign_videos(folders.limit(0), roster).count() == 0


def test_a_fixed_file_takes_the_name_of_the_broken_one(spark):
    good = "eye01_2026-06-22_11-11-46.mp4"
    cases = {
        "a": [good, "2026-06-22_11-11-46.eye1_fixed.mp4", "2026-06-22_11-11-46.eye1_fixed2.mp4"],
        "b": [good, good + ".broken", "2026-06-22_11-11-46.eye1_fixed.mp4"],
        "c": ["2026-06-22_11-11-46.eye1.mp4", "2026-06-22_11-11-46.eye1_fixed.mp4", "eye5.mp4", "merged.mp4"],
    }
    files = spark.createDataFrame([(k, n) for k, names in cases.items() for n in names], "folder string, name string")
    got = sorted((r["folder"], r["name"], r["action"]) for r in filing.plan_renames(files).collect())
    assert got == sorted([
        ("a", good, "broken"), ("a", cases["a"][1], "rename"), ("a", cases["a"][2], "conflict"), ("b", cases["b"][2], "conflict"),
        ("c", cases["c"][0], "rename"), ("c", cases["c"][1], "conflict"), ("c", "eye5.mp4", "unknown"),
    ])


def test_resets_move_skip_and_collide(spark):
    rows = [("r", "/r/raw/n", "n", True, True, "1"), ("r", "/r/a/n", "n", False, True, "1"), ("r", "/r/b/n", "n", False, True, "2"), ("r", "/r/a/m", "m", False, True, None), ("r", "/r/b/m", "m", False, True, None), ("r", "/r/c/m", "m", False, False, "1")]
    plan = {r["path"]: r["action"] for r in filing.plan_reset(spark.createDataFrame(rows, "root string, path string, name string, in_raw boolean, writable boolean, signature string")).collect()}
    assert list(plan[r[1]] for r in rows) == ["skip-in-raw", "duplicate", "conflict", "move", "conflict", "blocked"]


def test_sheets_have_session_values_in_the_first_row(spark):
    raw = spark.createDataFrame([(1, 1, 1, 2, None, None, 5, 7, 2), (1, 1, 1, 1, 20260601, 3, None, 7, 2), (1, 1, 1, 3, 20260601, 3, 6, 8, None), (1, 2, 1, 1, None, None, 5, None, 1), (1, 3, 1, 1, None, None, 5, 9, 1)], "subject int, day int, session int, trial int, date int, repeat int, start_node_n int, goal_node_n int, trial_type int")
    got = [(r["day"], r["trial_num"], r["date"], r["prev_goal_node"], r["num_trials"], r["trial_type"]) for r in filing.build_trial_meta(raw).orderBy("day", "trial_num").collect()]
    assert got == [(1, 1, 20260601, None, 2, 2), (1, 2, None, None, None, 1), (2, 1, None, 7, 1, 1), (3, 1, None, 7, 1, 1)]


def test_a_plan_of_renames_reads_its_files_once(spark):
    files = spark.range(60).selectExpr("'2024-01-02_09-08-07' as folder", "concat('2024-01-02_10-11-12.Eye', id % 20, '.mp4') as name")
    plan = filing.plan_renames(files)
    assert "Range" not in plan._jdf.queryExecution().toString()  # the different files are kept, the input is not read again
    assert plan.count() == 20 and {r["action"] for r in plan.collect()} == {"rename"}
