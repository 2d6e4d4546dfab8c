"""Rate changes against the sums that they stand for, cleaned recordings, and sources and streams that end."""

import numpy as np

from warren.operators import population, recording, signals
from warren.sources import logs
from warren.streaming import trials

CHUNKS = "session_id string, channel int, chunk bigint, v array<double>"


def chunked(spark, x, size):
    return spark.createDataFrame([("s", 0, i, [float(a) for a in x[i * size : (i + 1) * size]]) for i in range(-(-len(x) // size))], CHUNKS)


def whole(rows):
    got = {r["start"] + k: v for r in rows.collect() for k, v in enumerate(r["v"])}
    return np.array([got[i] for i in range(len(got))])


def plain(x, up, down, taps):
    """Stuff with zeros, filter, take every down-th."""
    stuffed = np.zeros(len(x) * up)
    stuffed[::up] = x
    half = len(taps) // 2
    return np.convolve(np.pad(stuffed, half), taps, "valid")[: len(x) * up : down]


def test_decimation_in_steps(spark):
    x = np.random.default_rng(1).normal(size=701)
    assert recording.decimation_steps(20) == [2, 2, 5] and recording.decimation_steps(34) == [2, 17] and recording.decimation_steps(1) == []
    for factor, steps in ((3, [3]), (6, [2, 3])):
        want = x
        for q in steps:
            want = plain(want, 1, q, recording.low_pass(10 * q, 1 / q, np.hamming(20 * q + 1)))
        assert np.allclose(whole(recording.decimate(chunked(spark, x, 64), 64, factor)), want, atol=1e-12)
    assert np.allclose(whole(recording.decimate(chunked(spark, np.ones(640), 64), 64, 4))[30:-30], 1, atol=2e-3)


def test_rational_rates(spark):
    x = np.random.default_rng(2).normal(size=333)
    for rate, target, up, down in ((2000, 1500, 3, 4), (1000, 1500, 3, 2)):
        half = 10 * max(up, down)
        want = plain(x, up, down, up * recording.low_pass(half, 1 / max(up, down), np.kaiser(2 * half + 1, 5.0)))
        assert np.allclose(whole(recording.resample(chunked(spark, x, 50), 50, rate, target)), want, atol=1e-12)
    assert np.allclose(whole(recording.resample(chunked(spark, x, 50), 50, 1500)), x)
    assert recording.resample(chunked(spark, [], 50), 50, 2000).count() == 0


def test_a_bad_channel_is_made_from_its_neighbours(spark):
    probe = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 0.0, 20.0), (3, 500.0, 0.0), (4, 900.0, 0.0)], "channel int, x double, y double")
    rows = spark.createDataFrame([("s", c, 0, float(v)) for c, v in ((0, 99), (1, 3), (2, 6), (3, 1), (4, 50))], "session_id string, channel int, sample bigint, value double")
    got = {r["channel"]: round(r["value"], 9) for r in recording.preprocess(rows, probe, dropped=[4], bad=[0], single=[3, 4]).collect()}
    # the bad channel is 4; less the reference 3, 2, 5 and 0, whose median is 2.5
    assert got == {0: 0.5, 1: -0.5, 2: 2.5, 3: -2.5}
    alone = {r["channel"]: r["value"] for r in recording.preprocess(rows, probe, bad=[4]).collect()}
    assert alone[4] is None and alone[1] == 3 - 4.5


def test_a_forced_colour_is_claimed_by_its_component(spark):
    wave = lambda s, c, n: [(s, c, float(i), int(i % (2 * n) >= n)) for i in range(120)]
    levels = spark.createDataFrame(wave("s", "0", 30) + wave("s", "1", 40) + wave("u", "0", 30), "session_id string, color string, t double, state int")
    assert {(r["session_id"], r["color"]): r["led"] for r in signals.classify_led(levels).collect()} == {("s", "0"): "red", ("s", "1"): None, ("u", "0"): "red"}
    forced = spark.createDataFrame([("s", "1", "red")], "session_id string, color string, led string")
    assert {(r["session_id"], r["color"]): r["led"] for r in signals.classify_led(levels, forced=forced).collect()} == {("s", "0"): None, ("s", "1"): "red", ("u", "0"): "red"}


def test_epochs_are_spread_over_samples(spark):
    epochs = spark.createDataFrame([("s", 0, 1.0, 0.0, 2.0), ("s", 1, 3.0, 4.0, 2.0)], "session_id string, epoch bigint, wakefulness double, rms double, ratio double")
    samples = spark.createDataFrame([("s", i) for i in range(25)], "session_id string, sample bigint")
    got = [(r["wakefulness"], r["rms"]) for r in population.wakefulness_at(samples, epochs, 10.0).orderBy("sample").collect()]
    assert np.allclose([g[0] for g in got], np.interp(range(25), [5, 15], [1, 3])) and np.allclose([g[1] for g in got], np.interp(range(25), [5, 15], [0, 4]))


def test_frames_with_numbers_are_preferred(spark, tmp_path):
    head = "frame_index,ts,trial_num,rat_x,rat_y,researcher_x,researcher_y\n"
    for name, rows in (("a b/x_Coordinates_Full.csv", "1,,,,,,\n2,,,,,,\n"), ("a b/x_Coordinates_Full_with_frames.csv", "7,,,,,,\n"), ("c/x_Coordinates_Full.csv", "3,,,,,,\n"), ("c/other.csv", "4,,,,,,\n"), ("d/p.csv", "5,,,,,,\n"), ("d/q.csv", "6,,,,,,\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(head + rows)
    assert sorted(r["frame_index"] for r in logs.read_frames(spark, str(tmp_path / "*")).collect()) == [3, 5, 6, 7]


def test_clocks_in_latin_1_are_read(spark, tmp_path):
    (tmp_path / "clock.csv").write_bytes("Frame é,Seconds,note\n1,0.5,é\n2,x,é\n".encode("latin-1"))
    (tmp_path / "utf.csv").write_text("Frame é,Seconds,note\n3,0.7,é\n", encoding="utf-8")
    assert [(r["frame_index"], r["seconds"]) for n in ("clock", "utf") for r in logs.read_frame_clock(spark, str(tmp_path / f"{n}.csv")).collect()] == [(1, 0.5), (3, 0.7)]


def test_a_last_frame_ends_its_trial():
    frame = {"frame_ms": 0.0, "x": 0.0, "y": 0.0, "rx": 900.0, "ry": 0.0, "start_x": 0.0, "start_y": 0.0, "goal_x": 500.0, "goal_y": 0.0, "trial_type": 1}
    state, none = trials.advance(trials.new_state(), frame)
    assert none == [] and state["phase"] == trials.ACTIVE
    state, rows = trials.advance(state, frame | {"frame_ms": 40.0, "ended": True})
    assert [(r["t1"], r["reason"]) for r in rows] == [(40.0, "end of frames")] and state == trials.new_state()


def test_clean_up_of_chunks_equals_that_of_samples(spark):
    rng = np.random.default_rng(12)
    probe = spark.createDataFrame([(c, 30.0 * (c % 3), 30.0 * (c // 3)) for c in range(9)], "channel int, x double, y double")
    rows = [(s, c, k, [float(v) for v in rng.normal(size=(16 if k < 2 else 5))]) for s in ("a", "b") for c in range(9) for k in range(3)]
    chunks = spark.createDataFrame(rows, "session_id string, channel int, chunk bigint, v array<double>")
    for how in ({}, {"dropped": [8], "bad": [4], "single": [0, 2]}, {"bad": [0, 1], "single": [8]}):
        want = {(r["session_id"], r["channel"], r["sample"]): r["value"] for r in recording.preprocess(signals.samples(chunks, 16), probe, **how).collect()}
        got = {(r["session_id"], r["channel"], r["sample"]): r["value"] for r in signals.samples(recording.preprocess_chunks(chunks, probe, **how), 16).collect()}
        assert set(got) == set(want) and len(got) > 500 and all(abs(got[k] - want[k]) < 1e-9 for k in want)
