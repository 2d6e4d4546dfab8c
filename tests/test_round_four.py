"""What the fourth round's findings were about, on small cases."""

import numpy as np
import pytest

from warren.operators import leads, maps, tuning
from warren.operators.track import step_speed


def test_rise_fits_solve_all_rows_at_once(monkeypatch):
    calls = []
    for name in ("lstsq", "solve", "pinv"):
        monkeypatch.setattr(np.linalg, name, lambda *a, f=getattr(np.linalg, name), n=name, **k: (calls.append(n), f(*a, **k))[1])
    x, rng = np.arange(50) + 0.5, np.random.default_rng(1)
    y = np.stack([tuning.rise_curve(x, np.array([15.0, tau, 1.0, 1.5, 0.05, 1.0, 0.0, 1.0])) for tau in rng.uniform(0.8, 5.0, 40)])
    tau = tuning.fit_rises(x, y / y.max(1, keepdims=True), 60)
    assert len(calls) <= 60 and np.isfinite(tau).all()
    square = np.stack([np.zeros((2, 2)), np.eye(2)])
    assert np.allclose(tuning._steps(square, np.ones((2, 2))), [[0, 0], [1, 1]])


@pytest.fixture(scope="module")
def run(spark):
    """Two sessions of 40 s with a gap, frames of equal times and untracked ones, and units of both labels."""
    rng, rows, points = np.random.default_rng(4), [], []
    for s in ("a", "b"):
        for i in range(400):
            if not 120 <= i < 180:
                rows.append((s, i, i / 10, float(4.5 + 3 * np.sin(i / 17)) if i % 11 else None, float(2.5 + 2 * np.cos(i / 23))))
        points += [(s, u, "good" if u < 3 else "mua", float(t)) for u in range(4) for t in rng.uniform(-1, 41, 150)]
    return spark.createDataFrame(rows, "session_id string, frame_index bigint, seconds double, x double, y double").cache(), spark.createDataFrame(points, "session_id string, unit_id int, label string, t double").cache()


def test_leads_do_not_depend_on_cells_of_time_or_blocks(run, monkeypatch):
    track, spikes = run
    known = step_speed(track.filter("x is not null"), ("session_id",))
    bins = tuning.assign_fold(tuning.mean_bins(known, 0.5), 3)
    masked = spikes.selectExpr("session_id", "unit_id", "t", "case when label = 'good' then 3 else 2 end as mask", "0 as rep")
    whole, part = [leads.decode_cases(known, masked, bins, (-1.3, 0.0, 2.5), 2, 3, 1, 0.5, 18, 10, 1.0, 0.0, 0.05, s) for s in (600.0, 0.7)]
    want = sorted(map(tuple, whole.collect()))
    assert len(want) > 500 and sorted(map(tuple, part.collect())) == want
    monkeypatch.setattr(leads, "BLOCK_BINS", 16)
    blocks = leads.decode_cases(known, masked, bins, (-1.3, 0.0, 2.5), 2, 3, 1, 0.5, 18, 10, 1.0, 0.0, 0.05)
    assert sorted(map(tuple, blocks.collect())) == want


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_leads_sets_and_folds_copy_no_spikes(run):
    """Neither a join nor a shuffle is there for the cases (73 shuffles and 20 joins before)."""
    found = plan(tuning.decode_leads(*run, (0.0, 1.0, 2.0)))
    assert found.count("Exchange hashpartitioning") <= 24 and found.count("Join") <= 4


def test_turned_trains_are_shuffled_once_for_all_leads(run):
    """63 shuffles and 18 joins before."""
    track, spikes = run
    found = plan(tuning.shuffle_null(track, spikes.drop("label"), (0.0, 1.0, 2.0), 4))
    assert found.count("Exchange hashpartitioning") <= 26 and found.count("Join") <= 7


def test_smoothing_by_matrices_is_that_of_cells(spark):
    rows = [("s", x, y, float((7 * x + 3 * y) % 5)) for x in range(4) for y in range(3)]
    df = spark.createDataFrame(rows, "session_id string, bx int, by int, v double")
    got = {(r["bx"], r["by"]): r["v"] for r in maps.gauss_smooth(df, ["session_id"], "v", 1.0, 4, 3).collect()}
    grid = np.array([v for *_, v in rows]).reshape(4, 3)
    want = leads.smoother(4, 1.0) @ grid @ leads.smoother(3, 1.0).T
    assert all(np.isclose(want[at], v) for at, v in got.items()) and len(got) == 12
