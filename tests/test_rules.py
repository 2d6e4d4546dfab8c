"""Rules of trajectories and curves, against plain versions of what they say."""

import numpy as np
from pyspark.sql import functions as F

from warren.operators import graph, maps, track

FRAMES = "session_id string, trial_num int, frame_index bigint, seconds double, x double, y double"


def frames(spark, *tracks):
    """Tracks of (t, x) or (t, x, y) rows, a trial each."""
    return spark.createDataFrame([("s", k + 1, i, float(r[0]), float(r[1]), float(r[2]) if len(r) > 2 else 1.0) for k, rows in enumerate(tracks) for i, r in enumerate(rows)], FRAMES)


def test_a_step_in_no_time_is_a_teleport_and_short_tracks_have_none(spark):
    rng = np.random.default_rng(4)
    t = np.cumsum(rng.choice([0.0, 1 / 30, 1 / 30, 1 / 30], 120))
    x = np.cumsum(rng.normal(0, 0.01, 120)) + np.where(rng.random(120) < 0.05, 1.0, 0.0)
    got = track.find_teleports(frames(spark, list(zip(t, x)), [(0, 1), (0, 9)], [(0, 5)])).orderBy("trial_num", "frame_index").collect()
    v = np.array([np.inf if b <= a else abs(q - p) / (b - a) for a, b, p, q in zip(t, t[1:], x, x[1:])])
    calm = np.where(np.isfinite(v), v, 0)
    want = [False] + [bool(v[i] > 0.6 and v[i] > 3 * np.median(calm[max(0, i - 15) : i + 16])) for i in range(119)]
    assert [r["teleport"] for r in got] == [*want, False, False, False] and sum(want) > 20


def test_long_runs_keep_the_cap_about_their_centre(spark):
    for size in range(1, 14):
        for cap in (3, 4, 5):
            mask = [False, False, *[True] * size, False]
            rows = spark.createDataFrame([("s", 1, i, i / 30, m) for i, m in enumerate(mask)], "session_id string, trial_num int, frame_index bigint, seconds double, mask boolean") if size in (6, 7, 12) else None
            start = (2 + 2 + size) // 2 - cap // 2
            want = mask if size <= cap else [start <= i < start + cap for i in range(len(mask))]
            assert track._centre_of_runs(np.array(mask), cap).tolist() == want
            if rows is not None:
                assert [r["mask"] for r in track.cap_runs(rows, "mask", cap).orderBy("frame_index").collect()] == want


def test_seam_jumps_are_refilled_over_time(spark):
    """A steady walk over a seam with a second of lost frames inside the repaired window."""
    t = np.array([i / 30 for i in range(200) if not 100 <= i < 130])
    x = 1.2 + 0.1 * t
    jumped = x + np.where((np.abs(t - 3.2) < 0.06) | (np.abs(t - 4.36) < 0.03), -0.9, 0.0)
    px, _, bad = track.repaired_track(jumped, np.ones(len(t)), t)
    assert bad.any() and np.abs(px - x)[bad].max() < 1e-9 and not bad[[0, -1]].any()
    got = track.repair_seams(frames(spark, list(zip(t, jumped)), [(0, 1), (1, 2)], list(zip(t, x)))).orderBy("trial_num", "seconds").collect()
    assert np.allclose([r["x"] for r in got], [*px, 1, 2, *x]) and sum(r["repaired"] for r in got) == bad.sum()
    assert track.repaired_track(np.array([1.4, 1.6, 1.4, 1.4]), np.ones(4), np.array([0.0, 0.0, 0.1, 0.2]))[2].tolist() == [False, True, True, False]  # in no time


def test_trials_split_over_batches_are_repaired_whole(spark):
    rng = np.random.default_rng(7)
    tracks = []
    for _ in range(9):
        n = int(rng.integers(1, 90))
        x = 1.3 + np.cumsum(rng.normal(0, 0.01, n)) + np.where(rng.random(n) < 0.05, 1.0, 0.0)
        tracks.append(list(zip(np.arange(n) / 30, x)))
    want = {(k + 1, i): v for k, rows in enumerate(tracks) for i, v in enumerate(track.repaired_track(np.array([r[1] for r in rows]), np.ones(len(rows)), np.array([r[0] for r in rows]))[0])}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {(r["trial_num"], r["frame_index"]): r["x"] for r in track.repair_seams(frames(spark, *tracks)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_tuning_curves_are_cut(spark):
    samples = frames(spark, [(i / 10, 0.1 if i < 50 else 8.9) for i in range(100)]).withColumn("speed", F.lit(1.0))
    spikes = spark.createDataFrame([("s", 1, 0.5 + i / 1000) for i in range(900)] + [("s", 2, 6.0)], "session_id string, unit_id int, t double")
    free = {(r["unit_id"], r["bx"]): r["rate"] for r in maps.rate_map(samples, spikes).collect()}
    cut = {(r["unit_id"], r["bx"]): r["rate"] for r in maps.rate_map(samples, spikes, most_hz=maps.CURVE_HZ).collect()}
    assert free[1, 0] > 150 and cut[1, 0] == 50 and all(cut[k] == v for k, v in free.items() if v <= 50)


def test_nearest_neighbour_edges_of_sparse_and_dense_nodes(spark):
    rng = np.random.default_rng(11)
    for scale in (20, 400, 5000):
        at = rng.random((40, 2)) * scale
        far = np.hypot(*(at[:, None, :] - at[None, :, :]).transpose(2, 0, 1))
        limit = 1.35 * np.median(np.where(np.eye(40, dtype=bool), np.inf, far).min(1))
        want = {(i, j) for i in range(40) for j in range(i + 1, 40) if far[i, j] <= limit}
        nodes = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(at)], "node_id int, x double, y double")
        assert {(r["u"], r["v"]) for r in graph.nn_edges(nodes).collect()} == want
    assert graph.nn_edges(nodes.filter("node_id = 0")).count() == 0
