"""Durations, mean speeds, curves, fields, clocks that fail, graphs by key and decoding, against plain versions."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from warren.operators import graph, maps, population, spikes, track, tuning
from tests.test_rules import frames


def test_durations_reach_half_a_frame_beyond_the_ends(spark):
    df = frames(spark, [(0, 1), (0.1, 1), (0.3, 1)], [(5, 1)], [(0, 1), (None or float("nan"), 2), (2, 3)])
    got = [r["duration"] for r in track.sample_durations(df).orderBy("trial_num", "frame_index").collect()]
    assert np.allclose(got, [0.05 + 1 / 60, 0.15, 0.1 + 1 / 60, 1 / 30, 1 / 30, 1 / 30, 1 / 30])


def plain_speeds(t, x, y):
    """Speeds of the runs between teleports, durations and teleports, sample by sample."""
    n = len(t)
    clock = list(t) if all(v is not None and math.isfinite(v) for v in t) else [i / 30 for i in range(n)]
    pace = [None] + [math.hypot(x[i] - x[i - 1], y[i] - y[i - 1]) / (clock[i] - clock[i - 1]) if clock[i] > clock[i - 1] else math.inf for i in range(1, n)]
    cut = [False] * n
    for i in range(1, n):
        around = sorted(0 if p == math.inf else p for p in pace[max(1, i - 15) : i + 16])
        m = (around[(len(around) - 1) // 2] + around[len(around) // 2]) / 2
        cut[i] = n >= 3 and pace[i] > 0.6 and pace[i] > 3 * m
    speed, starts = [0.0] * n, [0] + [i for i in range(n) if cut[i]] + [n]
    for a, b in zip(starts, starts[1:]):
        if b - a >= 2:
            own = [v for v in t[a:b]]
            rising = all(v is not None and math.isfinite(v) for v in own) and all(q > p for p, q in zip(own, own[1:]))
            at = np.array(own if rising else [i / 30 for i in range(b - a)])
            speed[a:b] = np.hypot(np.gradient(np.array(x[a:b]), at), np.gradient(np.array(y[a:b]), at)).tolist()
    edge = [clock[0] - 1 / 60] + [(p + q) / 2 for p, q in zip(clock, clock[1:])] + [clock[-1] + 1 / 60]
    return speed, [max(0.0, q - p) for p, q in zip(edge, edge[1:])], cut


def test_reports_with_any_clock(spark):
    rng = np.random.default_rng(11)
    tracks = []
    for k in range(6):
        n = 60
        t = np.cumsum(rng.choice([1 / 30, 1 / 30, 0.2], n)).tolist()
        x = np.cumsum(rng.normal(0, 0.01, n)) + np.where(rng.random(n) < 0.04, 1.5, 0)
        if k == 1:
            t[7] = float("nan")
        if k == 2:
            t[9] = t[8]
        tracks.append([(t[i], float(x[i]), float(1 + 0.01 * i)) for i in range(n)])
    got = {r["trial_num"]: r for r in track.trial_report(frames(spark, *tracks)).collect()}
    for k, rows in enumerate(tracks):
        # a sample without a clock comes last
        rows = sorted(rows, key=lambda r: (math.isnan(r[0]), r[0] if not math.isnan(r[0]) else 0))
        speed, duration, cut = plain_speeds(*map(list, zip(*rows)))
        r = got[k + 1]
        assert abs(r["avg_speed"] - np.average(speed, weights=duration)) < 1e-9 and abs(r["median_speed"] - np.median(speed)) < 1e-9 and r["teleports"] == sum(cut)


def test_curves_are_over_places_of_samples(spark):
    rng = np.random.default_rng(3)
    tracks = [[(float(t), float(v)) for t, v in zip(np.cumsum(rng.uniform(0.01, 1, n)), rng.normal(size=n))] for n in (2, 7, 100, 133, 1)]
    got = {r["point"]: r for r in track.norm_time_curve(frames(spark, *tracks), "x").collect()}
    lines = np.array([np.interp(np.linspace(0, 1, 100), np.linspace(0, 1, len(r)), [v for _, v in r]) for r in tracks if len(r) > 1])
    assert np.allclose([got[p]["mean"] for p in range(100)], lines.mean(0)) and np.allclose([got[p]["sem"] for p in range(100)], lines.std(0, ddof=1) / 2)
    assert {r["trials"] for r in got.values()} == {4}


def test_overlay_maps_divide_by_all_trials(spark):
    df = frames(spark, [(i / 30, 1.0, 1.0) for i in range(30)], [(i / 30, 2.0, 2.0) for i in range(60)])
    got = {(r["bx"], r["by"]): (round(r["mean_s"], 9), r["mean_speed"]) for r in track.overlay_maps(df).collect()}
    assert got == {(10, 10): (0.5, 0.0), (20, 20): (1.0, 0.0)}


def test_a_missing_clock_is_replaced_by_frames_in_repair(spark):
    t = np.arange(120) / 30
    x = np.where((np.arange(120) > 58) & (np.arange(120) < 61), 2.4, 1.42 + 0.001 * np.arange(120))
    whole = track.repaired_track(x, np.ones(120), t)
    broken = t.copy()
    broken[60] = np.nan
    for p, q in zip(whole, track.repaired_track(x, np.ones(120), broken)):
        assert np.array_equal(p, q)
    assert 2 <= whole[2].sum() <= 6 and np.isfinite(whole[0]).all()


def test_seams_meet_steps(spark):
    rng = np.random.default_rng(5)
    p = np.concatenate((rng.uniform(0, 9, 400), [1.5, 1.5, 3.0, 2.0, 4.5, np.nan, 1.0]))
    want = [any((a - s) * (b - s) <= 0 for s in track.SEAMS_X) for a, b in zip(p, p[1:])]
    assert track._over_seam(p, track.SEAMS_X).tolist() == want


def test_field_centres_are_cells_middles(spark):
    cells = [("s", 1, x, y, 9.0 if (x, y) in {(2, 2), (3, 2), (4, 2), (2, 3)} else 5.0 if x in (8, 9) and y == 5 else 1.0) for x in range(12) for y in range(8)]
    cells += [("s", 2, x, y, 0.0) for x in range(4) for y in range(4)]
    rates = spark.createDataFrame(cells, "session_id string, unit_id int, bx int, by int, rate double")
    goals = spark.createDataFrame([("s", 4.5, 2.5)], "session_id string, goal_x double, goal_y double")
    got = {r["unit_id"]: r for r in maps.field_metrics(maps.place_fields(rates, 2), goals, rates).collect()}
    d = [math.hypot((cx + 0.5) * 0.5 - 4.5, (cy + 0.5) * 0.5 - 2.5) for cx, cy in ((11 / 4, 9 / 4), (8.5, 5.0))]
    r = got[1]
    assert r["fields"] == 2 and np.allclose([r["largest"], r["second"], r["smallest"], r["mean_distance"]], [d[0], d[1], d[1], sum(d) / 2]) and d[1] < d[0]
    assert got[2]["fields"] == 0 and got[2]["largest"] is None and got[2]["smallest"] is None


def test_unknown_waveforms_make_wide_interneurons(spark):
    nan = float("nan")
    rows = [(20.0, None, None), (20.0, nan, nan), (20.0, 0.0003, None), (20.0, 0.0005, None), (1.0, None, 9.0), (1.0, nan, 9.0), (1.0, 0.0005, nan), (1.0, 0.0005, 9.0), (1.0, 0.0003, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, firing_rate_hz double, trough_to_peak_s double, acg_tau_rise_ms double")
    got = [r[0] for r in df.select(spikes.subtype().alias("s"), "i").orderBy("i").collect()]
    assert got == ["wide interneuron", "wide interneuron", "narrow interneuron", "wide interneuron", "pyramidal", "pyramidal", "pyramidal", "wide interneuron", "narrow interneuron"]


def test_half_widths_end_at_the_nearest_sample_outside(spark):
    rng = np.random.default_rng(9)
    waves = {u: np.round(rng.normal(size=(4 + u % 9, 2)), 1).cumsum(0) for u in range(40)} | {90: np.ones((6, 1)), 91: np.array([[1.0], [np.nan], [2], [3]]), 92: np.array([[1.0], [2], [0]])}
    rows = [("s", u, c, i, float(v)) for u, w in waves.items() for (i, c), v in np.ndenumerate(w)]
    got = {r["unit_id"]: r for r in population.waveform_metrics(spark.createDataFrame(rows, "session_id string, unit_id bigint, channel int, sample int, value double"), 1000.0).collect()}
    for u, w in waves.items():
        if u >= 90:
            assert tuple(got[u])[2:] == (None, None, None)
            continue
        v = w[:, int(np.argmax(np.ptp(w, axis=0)))]
        low = int(v.argmin())
        top = low + int(v[low:].argmax())

        def width(at, outside):
            bad = [-1, *[i for i in range(len(v)) if outside(v[i])], len(v)]
            return (min(i for i in bad if i > at) - max(i for i in bad if i < at) - 2) / 1000

        assert abs(got[u]["trough_to_peak_s"] - (top - low) / 1000) < 1e-12
        assert got[u]["peak_half_width_s"] == (pytest.approx(width(top, lambda a: a < v[top] / 2)) if v[top] > 0 else None)
        assert got[u]["trough_half_width_s"] == (pytest.approx(width(low, lambda a: a > v[low] / 2)) if v[low] < 0 else None)


def test_graphs_keep_apart_and_both_ways_of_closing_agree(spark):
    rng = random.Random(2)
    edges = [(g, *rng.sample(range(1, 12), 2), float(rng.randint(1, 5))) for g in ("a", "b", "c") for _ in range(12)]
    df = spark.createDataFrame(edges, "graph_id string, u int, v int, w double")
    best = {}
    for g in "abc":
        arcs = [(u, v, w) for h, u, v, w in edges if h == g] + [(v, u, w) for h, u, v, w in edges if h == g]
        nodes = {u for u, _, _ in arcs}
        for s in nodes:
            far = {s: (0.0, 0)}
            for _ in nodes:
                for u, v, w in arcs:
                    if u in far:
                        far[v] = min(far.get(v, (math.inf, 0)), (far[u][0] + w, far[u][1] + 1))
            best |= {(g, s, v): d for v, d in far.items()}
    hops = {}
    for most in (1500, 2):
        got = {(r["graph_id"], r["u"], r["v"]): r["d"] for r in graph.all_pairs(df, "w", matrix_nodes=most).collect()}
        assert got == {k: d[0] for k, d in best.items()}
        hops = {(r["graph_id"], r["u"], r["v"]): r["d"] for r in graph.all_pairs(df, matrix_nodes=most).collect()}
        longer = {(r["graph_id"], r["u"], r["v"]): (r["hops"], r["cheapest_hops"]) for r in graph.hop_vs_weight(df, matrix_nodes=most).collect()}
        assert longer == {k: (hops[k], float(d[1])) for k, d in best.items() if hops[k] < d[1]} and longer


def decoded_by_hand(counts, rates, width):
    out = {}
    for s in {k[0] for k in rates}:
        cells = sorted({k[2:] for k in rates if k[0] == s})
        units = {k[1] for k in rates if k[0] == s}
        for b in {k[2] for k in counts if k[0] == s}:
            value = {c: round(sum(counts.get((s, u, b), 0) * math.log(rates[s, u, *c] + 1e-3) - width * rates[s, u, *c] for u in units), 9) for c in cells}
            if len(cells) >= 3:
                out[s, b] = min(cells, key=lambda c: (-value[c], c))
    return out


@pytest.mark.parametrize("block", [3, 4096])
def test_decoding_in_blocks(spark, block):
    rng = random.Random(block)
    rates = {(s, u, x, y): rng.choice([0.0, 1.0, 5.0, 20.0]) for s, k in (("a", 4), ("b", 2), ("c", 1)) for u in range(5) for x in range(k) for y in range(2 if k > 1 else 1)}
    counts = {(s, u, b): rng.choice([0, 0, 1, 3]) for s in "abcd" for u in range(6) for b in range(-2, 20)}
    df = spark.createDataFrame([(*k, n) for k, n in counts.items()], "session_id string, unit_id int, bin bigint, n bigint")
    curves = spark.createDataFrame([(*k, 1.0, r) for k, r in rates.items()] + [("a", 0, 9, 9, 0.01, 500.0)], "session_id string, unit_id int, bx int, by int, occupied_s double, rate double")
    got = {(r["session_id"], r["bin"]): (r["bx"], r["by"]) for r in maps.decode(df, curves, 0.5, 0.3, block).collect()}
    assert got == decoded_by_hand(counts, rates, 0.5) and len(got) == 44


def test_the_shuffle_null(spark):
    rng = np.random.default_rng(1)
    n, width, leads, reps = 600, 0.5, (0.0, 1.0), 3
    t = np.arange(n) / 30
    x, y = 4.5 + 4 * np.sin(t), 2.5 + 2 * np.cos(0.7 * t)
    x[200:260], y[200:260] = x[200], y[200]
    rows = frames(spark, [(t[i], x[i], y[i]) for i in range(n)])
    train = {u: np.sort(rng.uniform(0, 19.9, 40 + 30 * u)) for u in range(3)}
    df = spark.createDataFrame([("s", u, float(v)) for u, ts in train.items() for v in ts], "session_id string, unit_id int, t double")
    got = {(r["lead"], r["rep"], r["bin"]): r["neural"] for r in tuning.shuffle_null(rows, df, leads, reps, width, 9, 5, 0.0, 0.2).collect()}
    speed = np.concatenate(([0.0], np.hypot(np.diff(x), np.diff(y)) * 30))
    cell = lambda v, top, k: np.minimum(np.floor(v / top * k), k - 1).astype(int)
    span, bins = t[-1] - t[0], np.floor(t / width).astype(int)
    occupied = {}
    for i in np.flatnonzero(speed > 0.05):
        c = (cell(x[i], 9, 9), cell(y[i], 5, 5))
        occupied[c] = occupied.get(c, 0) + np.median(np.diff(t))
    running = [b for b in sorted(set(bins)) if speed[bins == b].mean() > 0.05]
    want = {}
    for lead, rep in itertools.product(leads, range(reps)):
        rates = {("s", u, *c): 0.0 for u in train for c, s in occupied.items() if s >= 0.2}
        counts = {("s", 0, b): 0 for b in running}
        for u, ts in train.items():
            draw = int(hashlib.md5(f"s:{u}:{rep}".encode()).hexdigest()[:8], 16) / 2**32
            for v in np.mod(ts + (0.05 + 0.9 * draw) * span, span):
                if int(v // width) in running:
                    counts["s", u, int(v // width)] = counts.get(("s", u, int(v // width)), 0) + 1
                if v + lead <= t[-1] and np.interp(v + lead, t, speed) > 0.05:
                    c = (cell(np.interp(v + lead, t, x), 9, 9), cell(np.interp(v + lead, t, y), 5, 5))
                    if ("s", u, *c) in rates:
                        rates["s", u, *c] += 1 / occupied[c]
        rates = {k: min(v, 50.0) for k, v in rates.items()}
        for (_, b), (bx, by) in decoded_by_hand(counts, rates, width).items():
            at = (b + 0.5) * width + lead
            if at <= t[-1]:
                want[lead, rep, b] = math.hypot(bx + 0.5 - np.interp(at, t, x), by + 0.5 - np.interp(at, t, y))
    assert set(got) == set(want) and len(want) > 200
    assert np.mean([abs(got[k] - want[k]) < 1e-6 for k in want]) == 1.0
