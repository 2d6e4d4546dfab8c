"""Units against behaviour, against plain NumPy on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from warren.operators import maps, tuning
from warren.operators.track import step_speed


def smooth(v, sigma):
    k = np.array(maps.kernel(sigma))
    r = len(k) // 2
    period = np.concatenate([v, v[::-1]])
    return np.array([sum(k[j + r] * period[(i + j) % len(period)] for j in range(-r, r + 1)) for i in range(len(v))])


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in ("a", "b"):
        x, y = 4.5 + 3 * np.sin(np.arange(240) / 17), 2.5 + 2 * np.cos(np.arange(240) / 23)
        rows += [(s, i // 120 + 1, i, i / 30, float(x[i]), float(y[i])) for i in range(240)]
    track = spark.createDataFrame(rows, "session_id string, trial_num int, frame_index bigint, seconds double, x double, y double").cache()
    spikes = spark.createDataFrame([(s, u, float(t)) for s in ("a", "b") for u in range(4) for t in np.sort(rng.uniform(0, 8, 60))], "session_id string, unit_id int, t double").cache()
    return track, spikes


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_smoothing_mirrors_at_the_ends(spark, n):
    v = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame([("s", i, float(x)) for i, x in enumerate(v)], "k string, i long, v double")
    got = [r["v"] for r in tuning.smooth_series(df, ["k"], ["v"], 2.0).orderBy("i").collect()]
    assert np.allclose(got, smooth(v, 2.0))


def test_speed_and_rate_of_each_sample(walk):
    track, spikes = walk
    got = tuning.speed_rate(track, spikes).toPandas()
    t = track.filter("session_id = 'b'").orderBy("seconds").toPandas()
    speed = np.r_[0, np.hypot(np.diff(t["x"]), np.diff(t["y"])) / np.diff(t["seconds"])].clip(0, 0.6)
    times = spikes.filter("session_id = 'b' and unit_id = 2").toPandas()["t"].to_numpy()
    counts, _ = np.histogram(times, np.append(t["seconds"], t["seconds"].iloc[-1] + 1 / 30))
    one = got[(got["session_id"] == "b") & (got["unit_id"] == 2)].sort_values("i")
    assert np.allclose(one["speed"], smooth(speed, 7.5)) and np.allclose(one["rate"], smooth(counts * 30.0, 7.5))
    assert tuning.speed_rate(track.filter("frame_index < 4"), spikes).count() == 0


def test_axes_are_those_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    z = rng.normal(size=(50, 4)) * [3, 2, 1, 0.5]
    df = spark.createDataFrame([("s", u, b, float(z[b, u])) for b in range(50) for u in range(4)] + [("t", u, b, float(z[b, u])) for b in range(9) for u in range(2)], "session_id string, unit_id int, bin long, z double")
    got = tuning.embed_pca(df).orderBy("session_id", "bin").toPandas()
    c = z - z.mean(0)
    _, v = np.linalg.eigh(c.T @ c)
    v = v[:, ::-1][:, :3]
    v = v * np.sign(v[np.abs(v).argmax(0), range(3)])
    assert np.allclose(got.iloc[:50][["pc1", "pc2", "pc3"]], c @ v)
    assert got.iloc[50:]["pc2"].notna().all() and got.iloc[50:]["pc3"].isna().all()


@pytest.mark.parametrize("tau", [0.8, 2.0, 5.0])
def test_rise_times_are_found_again(tau):
    x = np.arange(100) / 2 + 0.25
    y = tuning.rise_curve(x, np.array([15.0, tau, 1.0, 1.5, 0.05, 1.0, 0.0, 1.0]))
    assert tuning.fit_rise(x, y / y.max()) == pytest.approx(tau, rel=0.1)


def test_units_without_pairs_have_no_rise_time(spark):
    one = spark.createDataFrame([("s", 1, 0.5), ("s", 2, 0.1), ("s", 2, 0.11), ("s", 2, 0.13)], "session_id string, unit_id int, t double")
    got = {r["unit_id"]: r["acg_tau_rise_ms"] for r in tuning.acg_rise_fit(one).collect()}
    assert got[1] is None and 0.1 <= got[2] <= 50


def test_metrics_of_a_trial_are_those_of_its_frames_alone(walk):
    track, spikes = walk
    trials = track.groupBy("session_id", "trial_num").agg(F.min("seconds").alias("t0"), F.max("seconds").alias("t1"))
    got = tuning.trial_unit_metrics(track, spikes, trials, sigma=1.0, threshold=0.0, least_cells=1).toPandas()
    assert len(got) == 16
    own = step_speed(track.filter("session_id = 'a' and trial_num = 2"), ("session_id",))
    points = spikes.filter("session_id = 'a' and t between 4.0 and 239 / 30D")
    info = maps.spatial_info(maps.rate_map(own, points, sigma=1.0)).toPandas().set_index("unit_id")
    mine = got[(got["session_id"] == "a") & (got["trial_num"] == 2)].set_index("unit_id")
    assert np.allclose(mine["information"].sort_index(), info["information"].sort_index()) and np.allclose(mine["peak"].sort_index(), info["peak"].sort_index())
    assert np.allclose(mine["rate"].sort_index(), points.groupBy("unit_id").count().toPandas().set_index("unit_id")["count"].sort_index() / (119 / 30))
    assert (got["field_size_m2"] > 0).all()


def test_held_out_bins_do_not_shape_their_curves(walk):
    """A fold is decoded with the other folds' bins: leaving it out by hand gives the same cells."""
    track, spikes = walk
    good = spikes.withColumn("label", F.when(F.col("unit_id") < 3, "good").otherwise("mua"))
    out = tuning.decode_leads(track, good, (0.0, 0.5), folds=3, width=0.5, least_s=0.0).toPandas()
    assert set(out["lead"]) == {0.0, 0.5} and set(out["quality"]) == {"good", "good_mua"}
    bins = tuning.assign_fold(track.select("session_id", F.floor(F.col("seconds") / 0.5).alias("bin")).distinct(), 3)
    at = track.withColumn("bin", F.floor(F.col("seconds") / 0.5)).join(bins, ["session_id", "bin"])
    placed = tuning.interp_at(good.filter("label = 'good'"), track).filter("x is not null").withColumn("bin", F.floor(F.col("t") / 0.5)).join(bins, ["session_id", "bin"])
    train = at.filter("fold <> 1")
    curves = maps.placed_rates(train, placed.filter("fold <> 1"), good.filter("label = 'good'").select("session_id", "unit_id").distinct(), 18, 10, 1.0, maps.sample_s(train))
    tested = bins.filter("fold = 1")
    cells = maps.decode(tuning.time_counts(good.filter("label = 'good'"), tested, 0.5), curves, 0.5, 0.0).toPandas()
    mine = out[(out["lead"] == 0) & (out["quality"] == "good")].merge(cells, on=["session_id", "bin"])
    assert len(mine) and np.allclose(mine["decoded_x"], (mine["bx"] + 0.5) * 0.5) and np.allclose(mine["decoded_y"], (mine["by"] + 0.5) * 0.5)
    summary = tuning.lead_summary(tuning.decode_leads(track, good, (0.0,), {"good": ("good",)}, folds=3, least_s=0.0))
    assert summary.count() == 2 and tuning.decode_leads(track.limit(0), good).count() == 0


def test_behaviour_of_moving_bins(spark, walk):
    track, _ = walk
    trials = spark.createDataFrame([("a", 1, 2, 7, 0.0, 3.0), ("a", 2, 5, 9, 2.9, 5.0), ("a", 3, 1, None, 6.0, 7.0)], "session_id string, trial_num int, trial_type int, goal_node int, t0 double, t1 double")
    bins = spark.createDataFrame([("a", i, t) for i, t in enumerate((1.0, 2.95, 5.5, 6.5, 99.0))], "session_id string, bin long, t double")
    nodes = spark.createDataFrame([(7, 0.0, 0.0), (9, 1.0, 1.0)], "node_id int, x double, y double")
    got = {r["bin"]: r for r in tuning.bin_behaviour(bins, track, trials, nodes).collect()}
    assert [got[i]["trial_num"] for i in range(5)] == [1, 2, None, 3, None] and got[3]["goal_distance"] is None
    assert got[0]["goal_distance"] == pytest.approx(np.hypot(got[0]["x"], got[0]["y"])) and len(got) == 5
    assert tuning.bin_behaviour(bins, track, trials, nodes, most=2).count() == 2


def test_axes_of_many_sessions_come_from_batches_of_them(spark):
    rng = np.random.default_rng(3)
    sessions = {f"s{i}": rng.normal(size=(6, 2 + i % 3)) * (1 + np.arange(2 + i % 3)) for i in range(300)}
    matrix = [(s, u, b, float(z[b, u])) for s, z in sessions.items() for b in range(len(z)) for u in range(z.shape[1])]
    df = tuning.embed_pca(spark.createDataFrame(matrix, "session_id string, unit_id int, bin bigint, z double"))
    assert "InPandas" not in df._jdf.queryExecution().toString()  # no call for each session
    got = {(r["session_id"], r["bin"]): r for r in df.collect()}
    assert len(got) == 300 * 6
    for s, z in sessions.items():
        _, v = np.linalg.eigh(np.cov(z.T, bias=True))
        axes = v[:, ::-1][:, :3].T
        axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(1)])[:, None]
        want = (z - z.mean(0)) @ axes.T
        for b in range(len(z)):
            mine = [got[s, b][f"pc{i + 1}"] for i in range(3)]
            assert np.allclose(mine[: len(axes)], want[b]) and mine[len(axes) :] == [None] * (3 - len(axes))
