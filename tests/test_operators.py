"""Operators that SQL cannot express, against plain NumPy or Python versions on small cases."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from warren.operators import graph, maps, signals, spikes, stats, track
from warren.sources import ephys, logs
from warren.streaming import trials


def frames(spark, xs, ys=None, dt=1 / 30, trial=1):
    return spark.createDataFrame([("s", trial, i, i * dt, None if x is None else float(x), 1.0 if ys is None else float(ys[i])) for i, x in enumerate(xs)], "session_id string, trial_num int, frame_index bigint, seconds double, x double, y double")


def repaired(spark, xs):
    rows = track.repair_seams(frames(spark, xs)).orderBy("frame_index").collect()
    return [r["x"] for r in rows], [r["repaired"] for r in rows]


def test_a_straight_run_survives_repair(spark):
    xs = [0.5 + 0.8 * i / 30 for i in range(90)]
    x, bad = repaired(spark, xs)
    assert not any(bad) and np.allclose(x, xs)


def test_a_seam_jump_is_refilled_and_the_ends_stay(spark):
    xs = [1.4 + 0.001 * i for i in range(90)]
    jumped = list(xs)
    jumped[40] += 1.2
    x, bad = repaired(spark, jumped)
    assert bad[40] and not bad[0] and not bad[-1] and abs(x[40] - xs[40]) < 0.01
    assert sum(bad) <= 30 and (x[0], x[-1]) == (jumped[0], jumped[-1])


def test_short_and_empty_tracks(spark):
    assert repaired(spark, [1.0])[1] == [False]
    assert track.repair_seams(frames(spark, [None, None])).count() == 0
    assert track.trial_report(track.tracked(frames(spark, [2.0]))).first()["avg_speed"] == 0.0  # a lone sample stands for a frame


def test_speed_with_gaps_stands_still_alone(spark):
    rows = track.speed_with_gaps(track.tracked(frames(spark, [0, 0, 0, 5, 0.0, 0, 0]))).collect()
    assert all(r["speed"] == 0 for r in rows) and len({r["run"] for r in rows}) == 3


def test_normalised_curve_of_a_line(spark):
    rows = track.norm_time_curve(frames(spark, range(11)).withColumn("speed", F.col("x"))).orderBy("point").collect()
    assert len(rows) == 100 and np.allclose([r["mean"] for r in rows], np.linspace(0, 10, 100))


def test_interpolation_returns_samples_and_respects_the_outside(spark):
    t = frames(spark, [0, 3, 6], dt=1.0)
    points = spark.createDataFrame([("s", 1, v) for v in (-1.0, 0.0, 0.5, 1.0, 2.0, 9.0)], "session_id string, unit_id int, t double")
    get = lambda **k: [r["x"] for r in spikes.interp_at(points, t, ("x",), **k).orderBy("t").collect()]
    assert get() == [None, 0.0, 1.5, 3.0, 6.0, None]
    assert get(outside="zero") == [0.0, 0.0, 1.5, 3.0, 6.0, 0.0] and get(outside="hold") == [0.0, 0.0, 1.5, 3.0, 6.0, 6.0]
    assert get(lead=1.0) == [0.0, 3.0, 4.5, 6.0, None, None]
    assert get(lead=1.0, cell=0.5) == get(lead=1.0) and get(cell=100.0) == get()


@pytest.mark.parametrize("outside", ["null", "zero", "hold"])
def test_interpolation_over_cells_is_that_of_one_window(spark, outside):
    rng = np.random.default_rng(3)
    rows = [(s, int(i), float(t), None if i % 5 == 0 else float(rng.normal())) for s in ("a", "b") for i, t in enumerate(np.sort(rng.integers(0, 60, 25)))]
    t = spark.createDataFrame(rows, "session_id string, frame_index int, seconds double, x double").dropDuplicates(["session_id", "seconds"]).checkpoint()
    points = spark.createDataFrame([(s, float(v)) for s in ("a", "b", "none") for v in np.append(rng.uniform(-20, 80, 60), [0, 10, 20, 59])] + [("a", None), ("a", float("nan"))], "session_id string, t double")
    get = lambda cell: [(r["session_id"], str(r["t"]), None if r["x"] is None else str(round(r["x"], 9))) for r in spikes.interp_at(points, t, ("x",), outside=outside, cell=cell).orderBy("session_id", "t").collect()]
    assert get(1e9) == get(7.0) == get(1.0)


def test_dedupe_compares_with_the_last_kept(spark):
    df = spark.createDataFrame([("s", 1, t) for t in (0.0, 0.0002, 0.0004, 0.0006, 0.01)], "session_id string, unit_id int, t double")
    assert [round(r["t"], 4) for r in spikes.dedupe_spikes(df).orderBy("t").collect()] == [0.0, 0.0004, 0.01]


@pytest.mark.parametrize("sigma", [0.7, 1.5])
def test_smoothing_mirrors_at_the_edges(spark, sigma):
    nx, ny, rng = 6, 4, np.random.default_rng(3)
    g = rng.random((nx, ny))
    w = np.array(maps.kernel(sigma))
    r = len(w) // 2

    def smooth(a):
        n = len(a)
        index = lambda i: (m if (m := i % (2 * n)) < n else 2 * n - 1 - m)
        return np.array([sum(w[k + r] * a[index(i + k)] for k in range(-r, r + 1)) for i in range(n)])

    want = np.apply_along_axis(smooth, 1, np.apply_along_axis(smooth, 0, g))
    df = spark.createDataFrame([("s", x, y, float(g[x, y])) for x in range(nx) for y in range(ny)], "session_id string, bx int, by int, v double")
    got = {(r["bx"], r["by"]): r["v"] for r in maps.gauss_smooth(df, ["session_id"], "v", sigma, nx, ny).collect()}
    assert all(abs(got[x, y] - want[x, y]) < 1e-9 for x in range(nx) for y in range(ny))


def test_fields_touch_by_edges_only(spark):
    cells = {(0, 0): 5.0, (0, 1): 5.0, (1, 2): 5.0, (1, 3): 4.0, (5, 5): 1.0}
    df = spark.createDataFrame([("s", 1, x, y, v) for (x, y), v in cells.items()], "session_id string, unit_id int, bx int, by int, rate double")
    found = maps.place_fields(df, 2).collect()
    assert sorted(r["cells"] for r in found) == [2, 2]
    assert maps.place_fields(df.withColumn("rate", F.lit(0.0)), 1).count() == 0


def test_decoding_is_the_argmax_of_the_posterior(spark):
    rng = np.random.default_rng(1)
    cells, units, width = [(x, y) for x in range(3) for y in range(2)], 4, 0.5
    rate = rng.random((units, len(cells))) * 20
    curves = spark.createDataFrame([("s", u, *c, 1.0, float(rate[u, i])) for u in range(units) for i, c in enumerate(cells)], "session_id string, unit_id int, bx int, by int, occupied_s double, rate double")
    n = rng.integers(0, 6, (units, 8))
    n[:, 3] = 0
    counts = spark.createDataFrame([("s", u, b, int(n[u, b])) for u in range(units) for b in range(8)], "session_id string, unit_id int, bin bigint, n bigint")
    post = n.T @ np.log(rate + 1e-3) - width * rate.sum(0)
    got = {r["bin"]: (r["bx"], r["by"]) for r in maps.decode(counts, curves, width).collect()}
    assert got == {b: cells[int(post[b].argmax())] for b in range(8)}
    assert maps.decode(counts, curves.filter("bx = 0"), width).count() == 0


def test_welch_of_a_sine_peaks_at_its_frequency():
    fs = 500.0
    t = np.arange(5000) / fs
    f, p = signals.welch(np.sin(2 * np.pi * 40 * t), fs)
    assert abs(f[p.argmax()] - 40) < 0.5 and abs(p.sum() * (f[1] - f[0]) - 0.5) < 0.02


def test_chunked_filter_is_the_filter_of_the_whole(spark):
    rng, size = np.random.default_rng(5), 16
    x, taps = rng.normal(size=90), signals.fir(41, 20.0, 60.0, 500.0)
    df = spark.createDataFrame([("s", 0, c, [float(v) for v in x[c * size : (c + 1) * size]]) for c in range(6)], "session_id string, channel int, chunk bigint, v array<double>")
    got = np.concatenate([r["v"] for r in signals.filtered(df, taps, size).orderBy("chunk").collect()])
    assert np.allclose(got, np.convolve(x, taps, "same"))


def test_pairwise_correlation_identity(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(4, 75))
    data[3] = 7.0  # flat
    df = spark.createDataFrame([("s", c, k, float(data[c, k])) for c in range(4) for k in range(75)], "session_id string, channel int, sample bigint, value double")
    got = {r["window"]: r["emg"] for r in signals.emg_corr(df, 16).collect()}
    centres = range(16, 75 - 16, 16)  # every 16th sample with 16 on each side
    assert sorted(got) == list(range(len(centres)))
    for k, c in enumerate(centres):
        assert abs(got[k] - np.corrcoef(data[:3, c - 16 : c + 17])[np.triu_indices(3, 1)].mean()) < 1e-9


def test_tails():
    # t and F with one degree agree; known quantiles
    assert abs(stats._beta_tail(5.0, 0.5, 10 / (10 + 2.228139**2)) - 0.05) < 1e-5
    assert abs(stats._beta_tail(10.0, 1.5, 20 / (20 + 3 * 3.098391)) - 0.05) < 1e-5
    assert stats._beta_tail(2.0, 3.0, 0.0) == 0.0 and stats._beta_tail(2.0, 3.0, 1.0) == 1.0


def test_anova_of_few_values_is_null_safe(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 1, 1.0), ("s", 2, 1.0), ("s", 2, 1.0), ("s", 3, 4.0), ("s", 3, float("nan")), ("s", 2, None)], "session_id string, grp int, v double")
    row = stats.anova(df, ["session_id"], "grp", "v").first()
    assert (row["k"], row["total"], row["f"], row["p"]) == (2, 4, None, None)


def test_distances_are_symmetric_and_obey_the_triangle(spark):
    d = {(r["u"], r["v"]): r["d"] for r in graph.all_pairs(graph.behaviour_edges(spark)).collect()}
    nodes = sorted({u for u, _ in d})[::9]
    assert len(d) == 98 * 98 and all(d[u, v] == d[v, u] for u, v in d)
    assert all(d[a, c] <= d[a, b] + d[b, c] for a in nodes for b in nodes for c in nodes)


def test_paths_with_odd_shapes(spark):
    dist = graph.all_pairs(graph.behaviour_edges(spark))
    known = spark.createDataFrame([(i,) for i in sorted({r["u"] for r in dist.select("u").distinct().collect()})], "node_id int")
    paths = [([101, 102, 103], 103), ([101], 101), ([], 103), ([102, 103], 103), ([101, 999, 998], 103), ([101, 103, 102], 103), ([101, 102], 103), (None, 103), ([101, 121, 302, 301], 301), ([101, 102], 501)]
    island = lambda n: n // 100
    seq = lambda p: [k for i, k in enumerate(map(island, p)) if i == 0 or k != island(p[i - 1])]
    rows = [(i + 1, p, 101, g, 1, island(g), seq(p or []), " rat fell " if i == 7 else None) for i, (p, g) in enumerate(paths)]
    trials_ = spark.createDataFrame(rows, "row_id int, path array<int>, start_node_n int, goal_node_n int, start_island_n int, goal_island_n int, seq_islands array<int>, comment string")
    islands = graph.all_pairs(graph.island_edges(graph.behaviour_edges(spark)).withColumnsRenamed({"a": "u", "b": "v"}))
    got = {r["row_id"]: r for r in graph.node_metrics(trials_, dist, known, islands).collect()}
    assert [got[i]["flag"] for i in range(1, 11)] == [None, None, "unknown error", "start_node_n (101) != first path node (102)", "unknown node(s) in path: [999, 998]", None, None, "rat fell", None, "unreachable island"]
    assert (got[1]["shortest_path"], got[1]["eat_on_1_encounter"], got[1]["dist_tra"], got[1]["dir_run_mat_perf"], got[1]["dt_min_sp"], got[1]["dt_rel_sp"]) == (2, 1, 2, 1, 0, 1.0)
    assert (got[2]["food_reached"], got[2]["dist_tra"], got[2]["dt_rel_sp"], got[2]["dir_run_mat_perf"], got[2]["distance_start_goal_nodes"]) == (1, 0, None, 1, 1)
    assert (got[6]["eat_on_1_encounter"], got[6]["food_reached"], got[6]["dist_tra"]) == (0, 1, 2) and (got[7]["dist_tra"], got[7]["food_reached"], got[7]["dt_min_sp"]) == (99, 0, 97)
    assert (got[9]["distance_start_goal_island"], got[9]["path_length_start_goal_island_node_hit"], got[9]["norm_path_length_start_goal_island_island_hit"]) == (2, 2, 1.0)
    entry = {r["row_id"]: r for r in graph.island_performance(trials_.filter("path is not null and row_id <> 5"), dist).collect()}
    far = {(r["u"], r["v"]): int(r["d"]) for r in dist.collect()}
    assert set(entry) == {9} and tuple(entry[9])[1:] == (121, far[121, 301] + 1, 3, 3 / (far[121, 301] + 1))


def test_summaries_and_sequences(spark):
    text = "Rat number: 3 , Date: 1\n101,102\nSummary Trial 1\n('101', '102') (1.5, 2.0) 0.5 0.3 0.6\nbroken\nTrial End\n101\nSummary Trial 2\n('101', '103') (3, x) 1 2 3\nTrial End\n"
    got = logs.parse_trial_summary(spark.createDataFrame([("s", text)], "session_id string, text string")).orderBy("trial_num").collect()
    assert [(r["trial_num"], r["start_node"], r["next_node"], r["t0"], r["t1"]) for r in got] == [(1, 101, 102, 1.5, 2.0), (2, 101, 103, 3.0, None)]
    lines = spark.createDataFrame([("s", i, v) for i, v in enumerate(text.split("\n"))], "session_id string, line_no int, value string")
    assert {r["trial_num"]: r["path"] for r in logs.node_sequences(lines).collect()} == {1: [101, 102], 2: [101]}


def test_csv_sources(spark, tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "a.csv").write_text("Frame_Index,Timestamp,Trial_Num,Rat_X,Rat_Y,R_X,R_Y\n0,0.0,1.0,5,x,,\n1,0.1,,6,7,,\n")
    (tmp_path / "s1" / "._a.csv").write_text("junk\n")
    rows = logs.read_frames(spark, str(tmp_path / "s1")).orderBy("frame_index").collect()
    assert [(r["session_id"], r["frame_index"], r["trial_num"], r["rat_x"], r["rat_y"]) for r in rows] == [("s1", 0, 1, 5.0, None), ("s1", 1, None, 6.0, 7.0)]
    (tmp_path / "clock.csv").write_text("Frame Number,Seconds From Creation\n0,0.5\n1,bad\n2,0.7\n")
    assert [r["seconds"] for r in logs.read_frame_clock(spark, str(tmp_path / "clock.csv")).orderBy("frame_index").collect()] == [0.5, 0.7]


def test_ephys_files(spark, tmp_path, monkeypatch):
    head = b"<Start settings>\nClock rate: 30000\nFields: <time uint32><v int16>\n<End settings>\n"
    data = np.zeros(7, np.dtype([("time", "<u4"), ("v", "<i2")]))
    data["time"], data["v"] = np.arange(7) * 20, np.arange(7) - 3
    (tmp_path / "a.dat").write_bytes(head + data.tobytes() + b"\x01\x02")
    monkeypatch.setattr(ephys, "RECORDS", 3)
    spark.dataSource.register(ephys.EphysDatSource)
    rows = spark.read.format("ephys_dat").option("path", str(tmp_path / "a.dat")).load().orderBy("record").collect()
    assert [(r["record"], r["time"], r["v"]) for r in rows] == [(i, 20 * i, i - 3) for i in range(7)]
    vectors = np.zeros(5, np.dtype([("time", "<u4"), ("v", "<i2", 3), ("g", "<f4", 2)]))
    vectors["v"], vectors["g"] = np.arange(15).reshape(5, 3), np.arange(10).reshape(5, 2) / 2
    (tmp_path / "b.dat").write_bytes(head.replace(b"<v int16>", b"<v 3*int16><g 2*single>") + vectors.tobytes())
    rows = spark.read.format("ephys_dat").option("path", f"file://{tmp_path}/b.dat").load().orderBy("record").collect()
    assert [(r["v"], r["g"]) for r in rows] == [([3 * i, 3 * i + 1, 3 * i + 2], [i + 0.0, i + 0.5]) for i in range(5)]


def machine(n=400, kind=1):
    rows = []
    for i in range(n):
        x = 300.0 if i < 20 else min(600.0, 300.0 + (i - 20) * 3.0)
        rows.append(("s", i, i * 33.0, x if i % 17 else None, 300.0, x + (400.0 if i < 200 else 100.0), 300.0, 300.0, 300.0, 600.0, 300.0, kind))
    return pd.DataFrame(rows, columns=["session_id", "frame_index", *trials.FIELDS])


MACHINE = "session_id string, frame_index bigint, frame_ms double, x double, y double, rx double, ry double, start_x double, start_y double, goal_x double, goal_y double, trial_type int"


def test_trials_end_at_the_goal_and_unfinished_ones_are_flushed(spark):
    got = trials.batch_trials(spark.createDataFrame(machine(), MACHINE)).collect()
    assert got[0]["reason"] == "goal" and got[0]["reached"] and got[0]["t0"] == 33.0
    late = trials.batch_trials(spark.createDataFrame(machine(kind=4), MACHINE)).collect()
    assert [r["reason"] for r in late] == ["end of frames"]


def test_sessions_and_units_keep_apart_over_small_batches(spark):
    one = machine()
    rows = pd.concat([one.assign(session_id=s, frame_ms=one["frame_ms"] * k) for s, k in (("a", 1.0), ("b", 2.0), ("c", 1.5))]).sample(frac=1, random_state=1)
    times = spark.createDataFrame([(s, u, i * 0.0002) for s in ("a", "b") for u in (1, 2) for i in range(9)], "session_id string, unit_id int, t double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = sorted(map(tuple, trials.batch_trials(spark.createDataFrame(rows, MACHINE)).collect()))
        kept = spikes.dedupe_spikes(times).groupBy("session_id", "unit_id").count().collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    alone = [tuple(r) for s in "abc" for r in trials.batch_trials(spark.createDataFrame(rows[rows["session_id"] == s], MACHINE)).collect()]
    assert got == sorted(alone) and {r[0] for r in got} == set("abc")
    assert [r["count"] for r in kept] == [5] * 4


def test_stream_and_batch_agree_on_any_split(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = machine()
    for i, part in enumerate((rows[:57], rows[57:58], rows[58:300], rows[300:])):
        spark.createDataFrame(part, MACHINE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(MACHINE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    try:
        q = trials.stream_trials(stream).writeStream.format("memory").queryName("ended").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    except Exception as e:
        pytest.skip(f"no stateful pandas operator here: {e}")
    q.awaitTermination(120)
    done = [r for r in trials.batch_trials(spark.createDataFrame(rows, MACHINE)).collect() if r["reason"] != "end of frames"]
    assert sorted(map(tuple, spark.table("ended").collect())) == sorted(map(tuple, done)) and done


def test_registered_queries_have_names_and_run_on_the_smallest_tables(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert math.isfinite(sum(1.0 for _ in entry.queries()))
