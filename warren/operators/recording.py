"""Recordings at another rate, and cleaned for spike sorting."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.operators.groups import map_groups, map_lines, starts

Stage = tuple[int, int, np.ndarray]
AT = ["session_id", "sample"]


def low_pass(half: int, cutoff: float, window: np.ndarray) -> np.ndarray:
    """A windowed low-pass of 2 * half + 1 taps with unit gain at zero; the cutoff is a share of the Nyquist rate."""
    h = cutoff * np.sinc(cutoff * np.arange(-half, half + 1)) * window
    return h / h.sum()


def decimation_steps(factor: int, most: int = 13) -> list[int]:
    """Prime factors up to `most`, small ones first; what is left over is one last step."""
    steps = []
    for p in (p for p in range(2, most + 1) if all(p % d for d in range(2, p))):
        while factor % p == 0:
            steps.append(p)
            factor //= p
    return steps + [factor] * (factor > 1)


def at_new_rate(x: np.ndarray, first: int, stage: Stage) -> tuple[np.ndarray, int]:
    """The samples of the new rate that fall inside x, and the number of their first; x starts at sample `first`.

    Only the taps that meet a sample are used, so nothing is stuffed with zeros. Outside of x the signal counts as zero.
    """
    up, down, taps = stage
    half = len(taps) // 2
    m = np.arange(-(-first * up // down), -(-(first + len(x)) * up // down))
    j = (m * down // up)[:, None] + np.arange(-(half // up), half // up + 2)
    k = half + (m * down)[:, None] - j * up
    met = (k >= 0) & (k < len(taps)) & (j >= first) & (j < first + len(x))
    values = np.where(met, x[np.clip(j - first, 0, len(x) - 1)] * taps[np.clip(k, 0, len(taps) - 1)], 0.0).sum(1)
    return values, int(m[0]) if len(m) else 0


def through(chunks: DataFrame, size: int, stages: list[Stage]) -> DataFrame:
    """V3: chunked channels through stages of filters and rate changes, exact at every seam, zero beyond both ends.

    A chunk of `size` samples (the last may be shorter) meets its neighbours within the filters' reach, and all stages run
    over that line; one stage is a product of two matrices for a block of chunks. Gives `start`, the number of a row's first new sample, and `v`.
    Missing chunks count as zero, empty ones give no row.
    """
    reach, scale = 0.0, 1.0
    for up, down, taps in stages:
        reach += scale * (len(taps) // 2 / up + 1)
        scale *= down / up
    reach = math.ceil(reach / size)
    ups, downs = math.prod(s[0] for s in stages), math.prod(s[1] for s in stages)

    by_phase = {}

    def cut(x: np.ndarray, first: int, own: int, n: int) -> np.ndarray:
        for stage in stages:
            x, first = at_new_rate(x, first, stage)
        a, b = (-(-at * ups // downs) for at in (own * size, own * size + n))
        return x[a - first : b - first]

    def weights(own: int) -> np.ndarray:
        """What each place of a line gives to the new samples of its chunk; alike for chunks of one phase."""
        phase = own * size % downs
        if phase not in by_phase:
            by_phase[phase] = np.stack([cut(x, (own - reach) * size, own, size) for x in np.eye((2 * reach + 1) * size)])
        return by_phase[phase]

    def work(lines: np.ndarray, chunk: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        start, out = -(-chunk * size * ups // downs), [np.zeros(0)] * len(chunk)
        stop = -(-(chunk * size + lengths) * ups // downs)
        plain = np.isfinite(lines).all(1)
        for phase in np.unique(chunk * size % downs):
            some = np.flatnonzero(plain & (chunk * size % downs == phase))
            for i, v in zip(some, lines[some] @ weights(int(chunk[some[0]])) if len(some) else ()):
                out[i] = v[: stop[i] - start[i]]
        for i in np.flatnonzero(~plain):
            out[i] = cut(lines[i], int(chunk[i] - reach) * size, int(chunk[i]), int(lengths[i]))
        return start, out

    if len(stages) == 1:
        return map_lines(chunks, size, reach, work, "start")

    def many(table: pa.Table) -> pa.Table:
        """Several stages: what lies beyond a signal's ends counts as zero to each stage, so each line begins and ends with its chunks."""
        ends, rows = starts(table, ["session_id", "channel", "to"]), []
        number, to, lists = table.column("chunk").to_numpy(), table.column("to").to_numpy(), table.column("v").to_pylist()
        for low, high in zip(ends, ends[1:]):
            own, have = int(to[low]), {int(number[i]): np.array(lists[i], dtype=float) for i in range(low, high)}
            if not len(have.get(own, ())):
                continue
            first = min(have) * size
            x = np.zeros(max(c * size + len(v) for c, v in have.items()) - first)
            for c, v in have.items():
                x[c * size - first : c * size - first + len(v)] = v
            v = cut(x, first, own, len(have[own]))
            if len(v):
                rows.append((low, -(-own * size * ups // downs), v))
        taken = table.take(pa.array([r[0] for r in rows], pa.int64()))
        return pa.table({"session_id": taken.column("session_id"), "channel": taken.column("channel"), "start": pa.array([r[1] for r in rows], pa.int64()), "v": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})

    sent = chunks.select("session_id", F.col("channel").cast("int").alias("channel"), "chunk", F.col("v").cast("array<double>").alias("v"), F.explode(F.sequence(F.col("chunk") - reach, F.col("chunk") + reach)).alias("to"))
    return map_groups(sent, ["session_id", "channel", "to"], ["chunk"], many, "session_id string, channel int, start bigint, v array<double>")


def decimate(chunks: DataFrame, size: int, factor: int) -> DataFrame:
    """Every factor-th sample, low-passed before each step of 13 at most by a Hamming window of 20 steps' length."""
    return through(chunks, size, [(1, q, low_pass(10 * q, 1 / q, np.hamming(20 * q + 1))) for q in decimation_steps(factor)])


def resample(chunks: DataFrame, size: int, rate: int, target: int = 1500) -> DataFrame:
    """From one whole rate to another by their ratio in lowest terms, with a Kaiser window (beta 5) of 20 steps' length."""
    shared = math.gcd(rate, target)
    up, down = target // shared, rate // shared
    if up == down:
        return chunks.select("session_id", "channel", (F.col("chunk") * size).alias("start"), F.col("v").cast("array<double>").alias("v"))
    half = 10 * max(up, down)
    return through(chunks, size, [(up, down, up * low_pass(half, 1 / max(up, down), np.kaiser(2 * half + 1, 5.0)))])


def neighbours(probe: DataFrame, bad: list[int], radius: float = 50.0) -> DataFrame:
    """Good channels near each bad one with the inverse of their distance; met in cells of the radius."""
    cell = lambda c: F.floor(F.col(c) / radius)
    near = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))
    lost = probe.filter(F.col("channel").isin(*bad)).select(F.col("channel").alias("lost"), F.col("x").alias("lx"), F.col("y").alias("ly"), near("x").alias("cx"), "y").select("lost", "lx", "ly", "cx", near("y").alias("cy"))
    good = probe.filter(~F.col("channel").isin(*bad)).select("channel", "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    gap = F.hypot(F.col("x") - F.col("lx"), F.col("y") - F.col("ly"))
    return lost.join(good, ["cx", "cy"]).withColumn("gap", gap).filter(F.col("gap").between(1e-9, radius)).select("lost", "channel", (1 / F.col("gap")).alias("weight"))


def preprocess(rows: DataFrame, probe: DataFrame, dropped: list[int] = [], bad: list[int] = [], single: list[int] = [], radius: float = 50.0) -> DataFrame:  # noqa: B006
    """Band-passed samples without the dropped channels, bad ones made anew, less the references.

    `rows` has session_id, channel, sample, value (see `signals.filtered` for the band), `probe` a row per channel with
    x and y. A bad channel is the mean of the good ones within the radius, weighted by inverse distance, and null without
    any. Then the median of the `single` channels is taken off, if there are some, and the median of all channels after it.
    Dropped channels serve neither as neighbours nor as references.
    """
    rows = rows.select(*AT, "channel", F.col("value").cast("double").alias("value"))
    if dropped:
        rows, probe = (d.filter(~F.col("channel").isin(*dropped)) for d in (rows, probe))
    bad, single = ([c for c in some if c not in dropped] for some in (bad, single))
    if bad:
        good = rows.filter(~F.col("channel").isin(*bad))
        made = good.join(neighbours(probe, bad, radius), "channel").groupBy(*AT, "lost").agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("made"))
        lost = rows.filter(F.col("channel").isin(*bad)).join(made.withColumnRenamed("lost", "channel"), [*AT, "channel"], "left")
        rows = good.unionByName(lost.select(*AT, "channel", F.col("made").alias("value")))
    every = Window.partitionBy(*AT)
    if single:
        reference = F.median(F.when(F.col("channel").isin(*single), F.col("value"))).over(every)
        rows = rows.withColumn("value", F.col("value") - F.coalesce(reference, F.lit(0.0)))
    return rows.withColumn("value", F.col("value") - F.median("value").over(every))


def preprocess_chunks(chunks: DataFrame, probe: DataFrame, dropped: list[int] = [], bad: list[int] = [], single: list[int] = [], radius: float = 50.0) -> DataFrame:  # noqa: B006
    """E14 from chunks (session_id, channel, chunk, v): as `preprocess`, without a row for each sample.

    All channels of a session's chunk meet in one task as a matrix, which the same steps work on. Samples that a shorter
    channel lacks, and bad channels without a neighbour, are null and count in no median.
    """
    bad, single = ([c for c in some if c not in dropped] for some in (bad, single))
    usable = probe.filter(~F.col("channel").isin(*dropped)) if dropped else probe
    # one row for each pair of near contacts of the bad channels of one probe
    near = [(r["lost"], r["channel"], r["weight"]) for r in neighbours(usable, bad, radius).collect()] if bad else []

    def medians(m: np.ndarray) -> np.ndarray:
        there = np.isfinite(m).any(0) if len(m) else np.zeros(m.shape[1], bool)
        out = np.full(m.shape[1], np.nan)
        out[there] = np.nanmedian(m[:, there], 0)
        return out

    def one(table: pa.Table) -> pa.Table:
        channels, lists = table.column("channel").to_pylist(), [np.array(v, float) for v in table.column("v").to_pylist()]
        order = np.argsort(channels, kind="stable")
        channels, lists = [channels[i] for i in order], [lists[i] for i in order]
        m = np.full((len(lists), max(map(len, lists))), np.nan)
        for row, v in zip(m, lists):
            row[: len(v)] = v
        place = {c: i for i, c in enumerate(channels)}
        made = {}
        for lost in (c for c in bad if c in place):
            total, weight = np.zeros(m.shape[1]), np.zeros(m.shape[1])
            for _, c, w in (x for x in near if x[0] == lost and x[1] in place):
                there = np.isfinite(m[place[c]])
                total[there] += w * m[place[c], there]
                weight[there] += w
            made[lost] = np.divide(total, weight, out=np.full(len(total), np.nan), where=weight > 0)
        for lost, v in made.items():
            m[place[lost]] = v
        if held := [place[c] for c in single if c in place]:
            m = m - np.nan_to_num(medians(m[held]))
        m = m - medians(m)
        values = [[None if x != x else float(x) for x in row[: len(v)]] for row, v in zip(m, lists)]
        kinds = table.schema
        n = len(channels)
        return pa.table({"session_id": pa.array([table.column("session_id")[0].as_py()] * n, kinds.field("session_id").type), "channel": pa.array(channels, kinds.field("channel").type), "chunk": pa.array([table.column("chunk")[0].as_py()] * n, kinds.field("chunk").type), "v": pa.array(values, pa.list_(pa.float64()))})

    kinds = dict(chunks.dtypes)
    lines = chunks.select("session_id", "channel", "chunk", F.col("v").cast("array<double>").alias("v")).filter(F.size("v") > 0)
    if dropped:
        lines = lines.filter(~F.col("channel").isin(*dropped))
    return lines.groupBy("session_id", "chunk").applyInArrow(one, f"session_id {kinds['session_id']}, channel {kinds['channel']}, chunk {kinds['chunk']}, v array<double>")
