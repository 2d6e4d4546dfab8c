"""Block scans against plain windows and loops, for any size of block."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from warren.operators import maps, scan, track

SCHEMA = "session_id string, trial_num int, frame_index bigint, seconds double, x double, y double"


def rows(seed, n=160):
    rng = random.Random(seed)
    out = []
    for s in ("a", "b", None):
        for i in range(n):
            t = None if rng.random() < 0.05 else i / 30 - (1 / 30 if rng.random() < 0.1 else 0)
            out.append((s, i // 50 + 1, i, t, None if rng.random() < 0.4 else rng.uniform(0, 9), rng.uniform(0, 5)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("width", [0.02, 0.4, 2.0, 1e9])
def test_scan_equals_windows(spark, width):
    df = spark.createDataFrame(rows(1), SCHEMA)
    got = scan.scan(df, ["session_id"], ["seconds", "frame_index"], scan.block_of("seconds", width), last={"l": F.col("x")}, next={"n": F.col("x")}, before={"b": F.col("x")}, total={"s": F.when(F.col("x") > 4, 1)})
    w = Window.partitionBy("session_id").orderBy(F.asc_nulls_last("seconds"), "frame_index")
    back, on = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.select("*", F.last("x", ignorenulls=True).over(back).alias("l"), F.first("x", ignorenulls=True).over(on).alias("n"), F.lag("x").over(w).alias("b"), F.coalesce(F.sum(F.when(F.col("x") > 4, 1)).over(back), F.lit(0)).alias("s"))
    key = lambda r: (r["session_id"] or "", r["frame_index"])
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [tuple(r) for r in a] == [tuple(r) for r in b] and len(a) == 480


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_runs_and_fills_do_not_depend_on_blocks(spark, width):
    plain = [r for r in rows(2) if r[0]]
    df = spark.createDataFrame(plain, SCHEMA)
    got = {(r["session_id"], r["frame_index"]): r for r in track.dwell(track.carry_forward(df, frames=width), F.col("x") > 4, frames=width).collect()}
    for s in "ab":
        held, last, runs = 0, None, []
        for r in sorted((r for r in plain if r[0] == s), key=lambda r: r[2]):
            last = r[4] if r[4] is not None else last
            held = held + 1 if last is not None and last > 4 else 0
            assert got[s, r[2]]["x"] == last and abs(got[s, r[2]]["dwell"] - held / 30) < 1e-12
            runs.append(held)
        assert max(runs) > 5
    masked = df.filter("x is not null and seconds is not null").withColumn("mask", F.col("x") > 3)
    capped = {(r["session_id"], r["frame_index"]): r["mask"] for r in track.cap_runs(masked, "mask", 2, ("session_id",), seconds=width / 30).collect()}
    for s in "ab":
        order = sorted((r for r in plain if r[0] == s and r[4] is not None and r[3] is not None), key=lambda r: (r[3], r[2]))
        want = track._centre_of_runs(np.array([r[4] > 3 for r in order]), 2)
        assert [capped[s, r[2]] for r in order] == want.tolist()
    filled = {(r["session_id"], r["frame_index"]): r["x"] for r in track.fill_linear(df.filter("seconds is not null"), "x", seconds=width / 30).collect()}
    for s in "ab":
        order = sorted((r for r in plain if r[0] == s and r[3] is not None), key=lambda r: (r[3], r[2]))
        t, v = np.array([r[3] for r in order]), np.array([np.nan if r[4] is None else r[4] for r in order])
        first = np.flatnonzero(np.isfinite(v))[0]
        for i, r in enumerate(order):
            if i < first:
                assert filled[s, r[2]] is None
            elif np.isfinite(v[i]):
                assert filled[s, r[2]] == v[i]
            elif (np.diff(t)[max(0, i - 3) : i + 3] > 0).all():
                good = np.isfinite(v)
                assert abs(filled[s, r[2]] - np.interp(t[i], t[good], v[good])) < 1e-9
    dt = {r["session_id"]: r["dt"] for r in maps.sample_s(df.filter("seconds is not null")).collect()}
    for s in "ab":
        assert abs(dt[s] - np.median(np.diff(sorted(r[3] for r in plain if r[0] == s and r[3] is not None)))) < 1e-12


def test_no_window_goes_by_session_alone(spark):
    df = spark.createDataFrame(rows(3), SCHEMA)
    plan = track.carry_forward(df)._jdf.queryExecution().executedPlan().toString()
    assert "__block" in plan and all("__block" in line or "__s_" in line for line in plan.split("\n") if "Window [" in line)
