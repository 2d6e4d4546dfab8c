"""The schedule of the trial state machine, and live positions on streams against the same over tables."""

import json

import pytest

from warren.operators import series
from warren.streaming import live, trials


def run(frames, plan=None, kind=1):
    """Frames are (ms, at): `at` is start, goal, or a distance in pixels from the goal; the researcher's distance to the goal comes third."""
    state, out = trials.new_state(), []
    text = json.dumps(plan) if plan else None
    for ms, at, person in frames:
        x = {"start": 0.0, "goal": 1000.0}.get(at, None if at is None else 500.0)
        frame = {"frame_ms": float(ms), "x": x, "y": 0.0, "rx": 1000.0 + person, "ry": 0.0, "start_x": 0.0, "start_y": 0.0, "goal_x": 1000.0, "goal_y": 0.0, "trial_type": kind, "schedule": text}
        state, row = trials.step(state, frame)
        out += [(row["trial_num"], row["t1"], row["reason"])] if row else []
    return out, state


def test_an_end_lock_holds_a_trial_and_then_ends_it():
    frames = [(0, "start", 900), (1000, "goal", 900), (2000, "mid", 900), (3000, "mid", 900)]
    assert run(frames)[0] == [(1, 1000.0, "goal")]
    assert run(frames, {"1": {"end_ms": 3000}})[0] == [(1, 3000.0, "end schedule")]


def test_a_start_lock_delays_its_trial_and_ends_the_one_before():
    late = {"1": {"start_ms": 2000}}
    assert run([(0, "start", 900), (1000, "start", 900)], late)[1]["phase"] == "waiting"
    assert run([(0, "start", 900), (2000, "start", 900)], late)[1]["phase"] == "active"
    got, state = run([(0, "start", 900), (1000, "goal", 900), (5000, "mid", 900), (5100, "start", 900), (9000, "goal", 900), (10100, "goal", 900)], {"2": {"start_ms": 5000}})
    assert got == [(1, 5000.0, "start schedule"), (2, 10100.0, "goal")]
    held, state = run([(0, "start", 900), (5000, "mid", 900)], {"1": {"end_ms": 9000}, "2": {"start_ms": 5000}})
    assert held == [] and state["phase"] == "active"


def test_immune_minutes_suppress_ends_and_end_the_trial_when_over():
    plan = {"1": {"immune_from": 0.0, "immune_to": 2.0}}
    got, state = run([(0, "start", 900), (60_000, "goal", 900), (121_000, "mid", 900), (122_000, "start", 900)], plan)
    assert got == [(1, 121_000.0, "interval")] and state["trial"] == 2


def test_a_researcher_at_the_goal_ends_a_trial_in_time():
    near = [(0, "start", 900)] + [(1000 * i, "mid", 40) for i in range(1, 15)]
    assert run(near)[0] == [(1, 10_000.0, "researcher at goal 10s")]
    broken = [(0, "start", 900)] + [(1000 * i, "mid", 900 if i == 8 else 40) for i in range(1, 17)]
    assert run(broken)[0] == []
    wide = [(0, "start", 900)] + [(1000 * i, "mid", 150) for i in range(1, 40)]
    assert run(wide)[0] == [(1, 30_000.0, "researcher at goal 30s")]
    assert run(wide, {"2": {"start_ms": 10**9}})[0] == [] and run(wide, kind=3)[0] == []
    assert run(wide, {"1": {"immune_from": 0.0, "immune_to": 0.3}}, kind=2)[0] == [(1, 18_000.0, "interval")]


def test_a_new_goal_seen_before_ten_minutes_ends_the_trial_then():
    frames = [(0, "start", 900), (1000, "goal", 900), (2000, "mid", 900), (600_000, "mid", 900)]
    assert run(frames, kind=4)[0] == [(1, 600_000.0, "late goal")] and run(frames[:1] + frames[2:], kind=4)[0] == []


def test_schedules_are_text_by_session(spark):
    meta = spark.createDataFrame([("a", 2, 5.0, None, None, None), ("a", 1, None, 9.0, 1.0, 2.0)], "session_id string, trial_num int, start_ms double, end_ms double, immune_from double, immune_to double")
    plan = trials._plan(trials.schedules(meta).first()["schedule"])
    assert plan == {"start": {2: 5.0}, "end": {1: 9.0}, "immune": {1: (1.0, 2.0)}}
    assert trials._plan(None) == {"start": {}, "end": {}, "immune": {}}


def streamed(spark, tmp_path, df, make, order, name):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = df.orderBy(order).collect()
    for part in (rows[:3], rows[3:4], rows[4:]):
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = make(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def test_positions_are_carried_between_batches(spark, tmp_path):
    frames = spark.createDataFrame([("s", i, x, None if x is None else 2 * x) for i, x in enumerate((None, 1.0, None, None, 5.0, None, None))], "session_id string, frame_index bigint, x double, y double")
    want = [(None, False), (1.0, True), (1.0, False), (1.0, False), (5.0, True), (5.0, False), (5.0, False)]
    assert [(r["x"], r["seen"]) for r in live.live_positions(frames).orderBy("frame_index").collect()] == want
    got = streamed(spark, tmp_path, frames, live.live_positions, "frame_index", "carried")
    assert [(None if r[2] != r[2] else r[2], r[4]) for r in got] == want


def test_visits_are_arrivals_on_streams_too(spark, tmp_path):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 0.0)], "node_id int, x double, y double")
    at = spark.createDataFrame([("s", float(i), x, 0.0) for i, x in enumerate((0.0, 5.0, 50.0, 3.0, 99.0, 101.0, 1.0))], "session_id string, t double, x double, y double")
    want = [("s", 1, 0.0), ("s", 1, 6.0), ("s", 2, 4.0)]
    assert sorted(map(tuple, live.node_visits(at, nodes).collect())) == want
    assert streamed(spark, tmp_path, at, lambda s: live.node_visits(s, nodes), "t", "visited") == want


def test_held_rats_and_frames_without_one(spark):
    boxes = spark.createDataFrame([("s", 0, "rat", 0.9, 0, 0, 10, 10), ("s", 0, "rat", 0.8, 50, 50, 60, 60), ("s", 0, "researcher", 0.9, 4, 4, 30, 30), ("s", 1, "researcher", 0.9, 0, 0, 5, 5), ("s", 2, "rat", 0.7, 0, 0, 10, 10)], "session_id string, frame_index bigint, label string, conf double, x1 int, y1 int, x2 int, y2 int")
    assert [tuple(r)[1:] for r in live.frame_positions(boxes).orderBy("frame_index").collect()] == [(0, 55.0, 55.0), (1, None, None), (2, 5.0, 5.0)]
    assert live.frame_positions(boxes, [(50, 50), (70, 50), (70, 70), (50, 70)]).filter("x is not null").count() == 1


def test_regions_of_another_frame_are_errors(spark):
    make = lambda rows: spark.createDataFrame(rows, "roi string, x int, y int, drawn_w int, drawn_h int")
    good = [("a", 0, 0, 100, 50), ("a", 9, 0, None, None), ("a", 9, 9, None, None), ("b", 0, 0, None, None)]
    assert series.assert_roi(make(good), 100, 50).count() == 3
    for bad in ([("a", 0, 0, 90, 50)] * 3, [("a", 0, 0, None, None), ("a", 100, 0, None, None), ("a", 5, 5, None, None)]):
        with pytest.raises(Exception, match="size|outside"):
            series.assert_roi(make(bad), 100, 50).collect()


def test_output_columns_keep_their_order(spark):
    df = spark.createDataFrame([(1, "c", 5, 6)], "id int, comment string, flag int, late int")
    out = series.arrange_columns(df, {"late": "dist_tra"})
    assert out.columns == ["id", "comment", *series.OUTPUT] and out.first()["dist_tra"] == 6 and out.first()["flag"] == 5 and out.first()["drug"] is None
