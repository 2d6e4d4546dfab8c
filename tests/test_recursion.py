"""Recursive filters over chunks against one loop over the whole channel."""

import numpy as np
import pytest

from warren.operators import recursion, signals


def looped(x, sections, start):
    y = np.array(x, float)
    for (b, a), z in zip(sections, start):
        z0, z1 = z
        for i, v in enumerate(y):
            y[i] = b[0] * v + z0
            z0, z1 = b[1] * v - a[1] * y[i] + z1, b[2] * v - a[2] * y[i]
    return y


def resting(sections, level):
    """Each section's state after a constant input held for ever."""
    out = []
    for b, a in sections:
        y = level * b.sum() / a.sum()
        z1 = b[2] * level - a[2] * y
        out.append((b[1] * level - a[1] * y + z1, z1))
        level = y
    return out


def both_ways(x, sections, reach):
    k = min(reach, len(x) - 1)
    line = np.concatenate((2 * x[0] - x[k:0:-1], x, 2 * x[-1] - x[-2 : -k - 2 : -1])) if k else np.array(x)
    once = looped(line, sections, resting(sections, line[0]))
    twice = looped(once[::-1], sections, resting(sections, once[-1]))[::-1]
    return twice[k : k + len(x)]


@pytest.mark.parametrize("size", [5, 64, 300, 5000])
def test_zero_phase_equals_a_whole_recursion(spark, size):
    rng = np.random.default_rng(size)
    lines = {("s", 0): rng.normal(size=700).cumsum(), ("s", 1): rng.normal(size=700), ("t", 0): rng.normal(size=9), ("t", 3): np.array([2.5]), ("u", 0): np.full(300, 4.0)}
    rows = [(s, c, k, [float(v) for v in x[a : a + size]]) for (s, c), x in lines.items() for k, a in enumerate(range(0, len(x), size))]
    sections = recursion.butterworth(4, *recursion.passband(1500.0), 1500.0)
    got: dict = {}
    for r in sorted(recursion.zero_phase(spark.createDataFrame(rows, "session_id string, channel int, chunk bigint, v array<float>" if size == 5 else "session_id string, channel int, chunk bigint, v array<double>"), sections).collect(), key=lambda r: r["chunk"]):
        got.setdefault((r["session_id"], r["channel"]), []).extend(r["v"])
    assert set(got) == set(lines)
    for key, x in lines.items():
        x = x.astype(np.float32).astype(float) if size == 5 else x
        want = both_ways(x, sections, 27)
        assert len(got[key]) == len(x) and np.abs(np.array(got[key]) - want).max() < 1e-9 * max(1, np.abs(want).max())
    assert np.abs(got["u", 0]).max() < 1e-9


def test_bands_and_orders():
    assert recursion.passband(1500.0) == (300.0, 600.0) and recursion.passband(1000.0) == (300.0, 475.0)
    with pytest.raises(ValueError):
        recursion.passband(600.0)
    for order, low, high, fs in ((1, 5, 9, 100), (2, 1, 40, 100), (3, 300, 475, 1000), (4, 0.1, 1, 1500)):
        sections = recursion.butterworth(order, low, high, fs)
        gain = lambda f: abs(np.prod([np.polyval(b, np.exp(2j * np.pi * f / fs)) / np.polyval(a, np.exp(2j * np.pi * f / fs)) for b, a in sections]))  # noqa: B023, E731
        assert len(sections) == order and abs(gain(low) - 0.5**0.5) < 1e-6 and abs(gain(high) - 0.5**0.5) < 1e-6 and gain(low / 50) < 0.1
        assert all(abs(np.roots(a)).max() < 1 for _, a in sections)


@pytest.mark.parametrize("size,windows", [(7, 3), (64, 2), (40, 64), (500, 1)])
def test_windows_of_matrices_equal_windows_of_samples(spark, size, windows):
    rng = np.random.default_rng(size)
    lines = {("s", c): rng.normal(size=333) + rng.normal(size=333) for c in range(3)} | {("s", 7): np.ones(333), ("t", 0): rng.normal(size=100), ("u", 1): rng.normal(size=15), ("u", 2): rng.normal(size=15)}
    rows = [(s, c, k, [float(v) for v in x[a : a + size]]) for (s, c), x in lines.items() for k, a in enumerate(range(0, len(x), size))]
    chunks = spark.createDataFrame(rows, "session_id string, channel int, chunk bigint, v array<double>")
    got = {(r["session_id"], r["window"]): r["emg"] for r in signals.emg_corr_chunks(chunks, size, 10, windows).collect()}
    want = {(r["session_id"], r["window"]): r["emg"] for r in signals.emg_corr(signals.samples(chunks, size), 10).collect()}
    assert set(got) == set(want) and len(got) > 35 and max(abs(got[k] - want[k]) for k in want) < 1e-9
