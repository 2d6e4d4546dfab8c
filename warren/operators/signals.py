"""Sampled signals, sync pulses and clocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.operators.groups import map_lines

EDGE = ("session_id", "color")


def samples(chunks: DataFrame, size: int) -> DataFrame:
    """One row per sample from chunks of fixed length."""
    return chunks.select("session_id", "channel", "chunk", F.posexplode("v").alias("k", "value")).withColumn("sample", F.col("chunk") * size + F.col("k"))


def emg_corr(rows: DataFrame, half: int) -> DataFrame:
    """Mean pairwise correlation of the channels around every `half`-th sample, `half` samples to each side.

    Windows overlap: a sample is in up to three of them, and only whole windows count. With each channel centred and
    scaled to length 1 in a window, the sum over pairs follows from the length of the summed channels, so no pair is
    built. Flat channels are left out; below two channels the value is 0.
    """
    keys = ["session_id", "window"]
    whole = rows.groupBy("session_id").agg((F.floor((F.max("sample") - 2 * half) / half)).alias("__last"))
    first = F.greatest(F.lit(0), F.ceil((F.col("sample") - 2 * half) / half))
    rows = rows.join(whole, "session_id").withColumn("__to", F.least(F.floor(F.col("sample") / half), "__last")).filter(first <= F.col("__to")).withColumn("window", F.explode(F.sequence(first, "__to"))).drop("__to", "__last")
    w = Window.partitionBy(*keys, "channel")
    centred = rows.withColumn("d", F.col("value") - F.avg("value").over(w)).withColumn("len", F.sqrt(F.sum(F.col("d") * F.col("d")).over(w)))
    used = centred.filter("len > 0").withColumn("u", F.col("d") / F.col("len"))
    n = used.groupBy(*keys).agg(F.count_distinct("channel").alias("n"))
    total = used.groupBy(*keys, "sample").agg(F.sum("u").alias("s")).groupBy(*keys).agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    return rows.select(*keys).distinct().join(n, keys, "left").join(total, keys, "left").select(*keys, F.when(F.col("n") >= 2, (F.col("q") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).otherwise(0.0).alias("emg"))


#: Windows of a block whose channels meet in one task.
BLOCK_WINDOWS = 64


def emg_corr_chunks(chunks: DataFrame, size: int, half: int, windows: int = BLOCK_WINDOWS) -> DataFrame:
    """E7 from chunks (session_id, channel, chunk, v) of `size` samples: as `emg_corr`, without a row for each sample.

    A block is so many windows of a session with all channels as a matrix; a chunk is sent to the blocks that its
    samples reach, which is one or two unless blocks are shorter than chunks.
    """
    span = windows * half
    lines = chunks.filter(F.size("v") > 0).select("session_id", "channel", (F.col("chunk") * size).alias("start"), F.col("v").cast("array<double>").alias("v"))
    whole = lines.groupBy("session_id").agg(F.floor((F.max(F.col("start") + F.size("v") - 1) - 2 * half) / half).alias("last"))
    first, to = F.greatest(F.lit(0), F.ceil((F.col("start") - 2 * half) / span - 1 + 1 / windows)), F.floor((F.col("start") + F.size("v") - 1) / span)
    sent = lines.join(whole, "session_id").withColumn("to", F.least(to, F.floor(F.col("last") / windows))).filter(first <= F.col("to")).withColumn("block", F.explode(F.sequence(first, F.col("to")))).drop("to")

    def one(key: tuple, table: pa.Table) -> pa.Table:
        block, last = key[1].as_py(), table.column("last")[0].as_py()
        channels, row = np.unique(table.column("channel").to_numpy(), return_inverse=True)
        line = np.full((len(channels), span + 2 * half), np.nan)
        for k, start, v in zip(row, table.column("start").to_pylist(), table.column("v")):
            at, v = start - block * span, v.values.to_numpy(zero_copy_only=False)
            low, high = max(0, at), min(line.shape[1], at + len(v))
            if low < high:
                line[k, low:high] = v[low - at : high - at]
        out = []
        for i in range(min(windows, last - block * windows + 1)):
            part = line[:, i * half : i * half + 2 * half + 1]
            there = np.isfinite(part)
            d = np.where(there, part - (np.where(there, part, 0).sum(1) / np.maximum(1, there.sum(1)))[:, None], 0)
            length = np.sqrt((d * d).sum(1))
            u, n = d[length > 0] / length[length > 0, None], int((length > 0).sum())
            if there.any():
                out.append((block * windows + i, ((u.sum(0) ** 2).sum() - n) / (n * (n - 1)) if n >= 2 else 0.0))
        return pa.table({"session_id": pa.array([key[0].as_py()] * len(out), pa.string()), "window": pa.array([i for i, _ in out], pa.int64()), "emg": pa.array([e for _, e in out], pa.float64())})

    return sent.groupBy("session_id", "block").applyInArrow(one, "session_id string, window bigint, emg double")


def welch(x: np.ndarray, fs: float, seconds: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Power spectral density by averaged Hann windows with half overlap, each without its mean."""
    n = min(len(x), max(2, int(seconds * fs)))
    w = np.hanning(n + 1)[:-1]
    parts = np.stack([x[a : a + n] for a in range(0, len(x) - n + 1, max(1, n // 2))])
    power = np.abs(np.fft.rfft((parts - parts.mean(1, keepdims=True)) * w)) ** 2 / (fs * (w * w).sum())
    power[:, 1 : (-1 if n % 2 == 0 else None)] *= 2
    return np.fft.rfftfreq(n, 1 / fs), power.mean(0)


def welch_bands(rows: DataFrame, fs: float, bands: dict[str, tuple[float, float]], seconds: float = 2.0, first: float = 60.0) -> DataFrame:
    """Mean density of each band over a channel's first seconds. A group is one channel's first minute at most."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("sample")
        f, p = welch(part["value"].to_numpy(float), fs, seconds)
        mean = {k: float(p[(f >= a) & (f <= b)].mean()) if ((f >= a) & (f <= b)).any() else 0.0 for k, (a, b) in bands.items()}
        return pd.DataFrame([{"session_id": part["session_id"].iloc[0], "channel": part["channel"].iloc[0], **mean}])

    base = Window.partitionBy("session_id", "channel")
    rows = rows.withColumn("__a", F.min("sample").over(base)).filter(F.col("sample") - F.col("__a") < int(first * fs)).select("session_id", "channel", "sample", F.col("value").cast("double").alias("value"))
    return rows.groupBy("session_id", "channel").applyInPandas(one, "session_id string, channel int, " + ", ".join(f"{k} double" for k in bands))


def channel_scores(bands: DataFrame) -> DataFrame:
    """Each channel's signal-to-noise ratio, and whether it has its session's most muscle power."""
    w = Window.partitionBy("session_id").orderBy(F.desc("muscle"), "channel")
    return bands.withColumn("snr", F.col("slow") / (F.col("fast") + 1e-12)).withColumn("emg_channel", F.row_number().over(w) == 1)


def top_channels(scores: DataFrame, k: int = 3) -> DataFrame:
    """T3."""
    w = Window.partitionBy("session_id").orderBy(F.desc("snr"), "channel")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def usable_channels(scores: DataFrame, least: int = 8, share: float = 0.3) -> DataFrame:
    """Channels above a share of the median ratio; the best come back until there are enough."""
    every = Window.partitionBy("session_id")
    good = F.col("snr") >= share * F.median("snr").over(every)
    w = Window.partitionBy("session_id").orderBy(F.desc("good"), F.desc("snr"), "channel")
    return scores.withColumn("good", good).withColumn("__r", F.row_number().over(w)).filter(F.col("good") | (F.col("__r") <= least)).drop("__r")


def spread_channels(channels: DataFrame, most: int = 32) -> DataFrame:
    """The first channel of every tetrode, then the next, up to a number."""
    w = Window.partitionBy("session_id").orderBy("local", "tetrode")
    return channels.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def rate_of(times: DataFrame) -> DataFrame:
    """Samples per second from the time axis."""
    return times.groupBy("session_id").agg(F.try_divide(F.count("*") - 1, F.max("t") - F.min("t")).alias("fs"))


def truncate_common(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The samples that both have."""
    return a.join(b, keys)


def fir(taps: int, low: float, high: float, fs: float) -> np.ndarray:
    """A Hamming-windowed band-pass of odd length with unit gain at the band's centre."""
    k = np.arange(taps) - (taps - 1) / 2
    h = (2 * high / fs * np.sinc(2 * high / fs * k) - 2 * low / fs * np.sinc(2 * low / fs * k)) * np.hamming(taps)
    return h / np.abs((h * np.exp(-2j * np.pi * (low + high) / 2 / fs * k)).sum())


def filtered(chunks: DataFrame, taps: np.ndarray, size: int) -> DataFrame:
    """A symmetric filter over chunked channels, zero-padded at the ends, exact at every seam.

    A block of chunks goes to a task with its halo; its filtered chunks are a product of two matrices.
    """
    half, after = len(taps) // 2, (len(taps) - 1) // 2
    reach = -(-half // size)
    # column i has what each place of a line gives to the chunk's i-th sample
    k = np.arange(size)[None, :] + reach * size + after - np.arange((2 * reach + 1) * size)[:, None]
    weights = np.where((k >= 0) & (k < len(taps)), taps[np.clip(k, 0, len(taps) - 1)], 0.0)

    def work(lines: np.ndarray, chunk: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        sums = lines @ weights
        for i in np.flatnonzero(~np.isfinite(lines).all(1)):  # beyond the taps' reach they count for nothing
            sums[i] = np.convolve(lines[i], taps, "same")[reach * size : (reach + 1) * size]
        return chunk, [v[:n] for v, n in zip(sums, lengths)]

    return map_lines(chunks, size, reach, work, "chunk")


def movement(chunks: DataFrame, taps: np.ndarray, size: int) -> DataFrame:
    """Summed absolute z-scores of the axes, then the filter."""
    key = ["session_id", "channel"]
    sd = F.stddev_pop("value")
    scale = samples(chunks, size).groupBy(*key).agg(F.avg("value").alias("mean"), F.when(sd == 0, 1.0).otherwise(sd).alias("sd"))
    z = chunks.join(scale, key).select("session_id", "chunk", "channel", F.transform("v", lambda x: F.abs((x - F.col("mean")) / F.col("sd"))).alias("z"))
    either = lambda a, b: F.coalesce(a + b, a, b)
    axes = F.transform(F.sort_array(F.collect_list(F.struct("channel", "z"))), lambda s: s["z"])
    total = F.aggregate(F.slice(axes, 2, F.greatest(F.size(axes) - 1, F.lit(0))), F.element_at(axes, 1), lambda a, b: F.zip_with(a, b, either))
    again = z.groupBy("session_id", "chunk").agg(total.alias("v")).withColumn("channel", F.lit(0))
    return filtered(again, taps, size)


def median_reference(rows: DataFrame) -> DataFrame:
    """E14, the last step: each sample without the median over channels at its time (`recording.preprocess` has all steps)."""
    m = rows.groupBy("session_id", "sample").agg(F.median("value").alias("__m"))
    return rows.join(m, ["session_id", "sample"]).withColumn("value", F.col("value") - F.col("__m")).drop("__m")


def probe_table(spark, rows: int = 8, columns: int = 4, pitch: float = 250.0, arm: float = 10.0) -> DataFrame:
    """Positions of a grid of tetrodes, four contacts in a diamond each."""
    t = spark.range(rows * columns).withColumnRenamed("id", "tetrode")
    arms = F.array(*[F.struct(F.lit(i).alias("contact"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for i, (dx, dy) in enumerate(((0.0, arm), (arm, 0.0), (0.0, -arm), (-arm, 0.0)))])
    return t.select("tetrode", F.explode(arms).alias("c")).select("tetrode", "c.contact", (F.floor(F.col("tetrode") / columns) * pitch + F.col("c.dy")).alias("y"), (F.col("tetrode") % columns * pitch + F.col("c.dx")).alias("x"))


def dio_time(edges: DataFrame, fs: float, created: float | None = None) -> DataFrame:
    """Seconds of a tick from the creation time, or from the first tick where that is unknown."""
    first = F.min("tick").over(Window.partitionBy(*EDGE))
    return edges.withColumn("t", F.coalesce(F.lit(created), F.lit(0.0)) + (F.col("tick") - first) / fs)


def pulse_centres(edges: DataFrame) -> DataFrame:
    """The middle between the k-th rise and the k-th fall after the first rise."""
    w = Window.partitionBy(*EDGE).orderBy("t")
    rows = edges.withColumn("before", F.lag("state").over(w)).filter("before is not null and before <> state")
    rows = rows.withColumn("__rise", F.min(F.when(F.col("state") == 1, F.col("t"))).over(Window.partitionBy(*EDGE))).filter("t >= __rise")
    kth = rows.withColumn("k", F.row_number().over(Window.partitionBy(*EDGE, "state").orderBy("t")))
    up, down = (kth.filter(F.col("state") == s).select(*EDGE, "k", F.col("t").alias(n)) for s, n in ((1, "rise"), (0, "fall")))
    return up.join(down, [*EDGE, "k"]).withColumn("centre", (F.col("rise") + F.col("fall")) / 2)


def trim_overlap(pulses: DataFrame, first: int = 2, last: int = 2) -> DataFrame:
    """A colour's pulses without its first and last ones, numbered anew."""
    n = F.count("*").over(Window.partitionBy(*EDGE))
    return pulses.withColumn("__n", n).filter((F.col("k") > first) & (F.col("k") <= F.col("__n") - last)).withColumn("k", F.col("k") - first).drop("__n")


def fit_clock(pairs: DataFrame) -> DataFrame:
    """Slope and intercept of the true time on the camera's."""
    return pairs.groupBy("session_id").agg(F.count("*").alias("n"), F.regr_slope("true_t", "camera_t").alias("slope"), F.regr_intercept("true_t", "camera_t").alias("intercept"))


def correct_cpu_clock(clock: DataFrame, first: int = 1000) -> DataFrame:
    """L1: the CPU clock on a line over the GPU's, without the mean residual of the first frames."""
    fit = clock.groupBy("session_id").agg(F.regr_slope("cpu", "gpu").alias("a"), F.regr_intercept("cpu", "gpu").alias("b"))
    rows = clock.join(fit, "session_id").withColumn("line", F.col("a") * F.col("gpu") + F.col("b"))
    head = F.avg(F.when(F.col("frame_index") < first, F.col("line") - F.col("cpu"))).over(Window.partitionBy("session_id"))
    return rows.withColumn("corrected", F.col("line") - head).select("session_id", "frame_index", "corrected")


def classify_led(levels: DataFrame, fps: float = 30.0, forced: DataFrame | None = None) -> DataFrame:
    """L4: red or blue by duty near one half and frequency within a tenth of 0.5 or 2.5 Hz.

    `forced` (session_id, color, led) names a component's colour by hand; no other of the session gets that colour.
    """
    w = Window.partitionBy(*EDGE).orderBy("t")
    rows = levels.withColumn("rise", ((F.col("state") == 1) & (F.lag("state").over(w) == 0)).cast("int"))
    out = rows.groupBy(*EDGE).agg(F.avg("state").alias("duty"), (F.coalesce(F.sum("rise"), F.lit(0)) / F.count("*") * fps).alias("hz"))
    near = lambda hz: (F.abs(F.col("duty") - 0.5) < 0.1) & (F.abs(F.col("hz") - hz) < 0.1 * hz)
    out = out.withColumn("led", F.when(near(0.5), "red").when(near(2.5), "blue"))
    if forced is None:
        return out
    claims = forced.groupBy("session_id").agg(F.collect_set("led").alias("__claimed"))
    rows = out.join(forced.select(*EDGE, F.col("led").alias("__own")), [*EDGE], "left").join(claims, "session_id", "left")
    free = ~F.coalesce(F.array_contains("__claimed", F.col("led")), F.lit(False))
    return rows.withColumn("led", F.coalesce("__own", F.when(free, F.col("led")))).drop("__own", "__claimed")


def choose_led(pulses: DataFrame, forced: str | None = None) -> DataFrame:
    """The forced colour if it is there, else blue, else red."""
    has = lambda c: F.bool_or(F.col("color") == c)
    first = F.when(has(forced), forced) if forced else F.lit(None)
    return pulses.groupBy("session_id").agg(F.coalesce(first, F.when(has("blue"), "blue"), F.when(has("red"), "red")).alias("led"))


def count_mismatch(frames: DataFrame, clock: DataFrame) -> DataFrame:
    """Sessions whose frame and clock counts differ."""
    a, b = (d.groupBy("session_id").agg(F.count("*").alias(n)) for d, n in ((frames, "frames"), (clock, "ticks")))
    return a.join(b, "session_id", "full_outer").select("session_id", F.coalesce("frames", F.lit(0)).alias("frames"), F.coalesce("ticks", F.lit(0)).alias("ticks")).filter("frames <> ticks")
