"""Waveforms, population activity and wakefulness on small cases."""

import numpy as np

from warren.operators import population


def test_waveform_of_a_known_shape(spark):
    v = [0.0, -1.0, -4.0, -1.0, 0.0, 1.0, 2.0, 1.5, 0.0]
    rows = [("s", 1, 0, k, x) for k, x in enumerate(v)] + [("s", 1, 1, k, 0.1 * x) for k, x in enumerate(v)] + [("s", 2, 0, k, 3.0) for k in range(9)]
    got = {r["unit_id"]: r for r in population.waveform_metrics(spark.createDataFrame(rows, "session_id string, unit_id bigint, channel int, sample int, value double"), 1000.0).collect()}
    assert (got[1]["trough_to_peak_s"], got[1]["peak_half_width_s"], got[1]["trough_half_width_s"]) == (0.004, 0.002, 0.0)
    assert got[2]["trough_to_peak_s"] is None


def test_population_rows_have_zero_mean(spark):
    df = spark.createDataFrame([("s", u, float(t)) for u in (1, 2) for t in np.random.default_rng(u).random(60) * 10], "session_id string, unit_id int, t double")
    rows = population.population_matrix(df).collect()
    assert abs(np.mean([r["z"] for r in rows if r["unit_id"] == 1])) < 1e-9


def test_an_awake_epoch_scores_higher(spark):
    fs, rng = 100.0, np.random.default_rng(0)
    t = np.arange(450) / fs
    muscle = rng.normal(size=450) * np.where(t < 2, 0.1, 3.0)
    field = np.where(t < 2, np.sin(2 * np.pi * 2 * t), np.sin(2 * np.pi * 7 * t))
    df = spark.createDataFrame([("s", c, k, float(x[k])) for c, x in ((0, muscle), (1, field)) for k in range(450)], "session_id string, channel int, sample bigint, value double")
    got = [r["wakefulness"] for r in population.wakefulness(df, fs, 0, 1).orderBy("epoch").collect()]
    assert len(got) == 4 and max(got[:2]) < min(got[2:])
