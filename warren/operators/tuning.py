"""Units against behaviour: metrics of trials, decoding at several leads, speed and rate, embeddings, rise times."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.operators import groups, maps
from warren.operators.leads import decode_cases
from warren.operators.spikes import assign_fold, by_unit, histograms, interp_at, within_trials
from warren.operators.track import HEIGHT_M, WIDTH_M, run_epochs, step_speed

#: Fixed value: the speed in metres a second above which the animal runs.
RUN_SPEED = 0.05
UNIT = ["session_id", "unit_id"]


def trial_unit_metrics(track: DataFrame, spikes: DataFrame, trials: DataFrame, nx: int = 18, ny: int = 10, sigma: float = 2.0, threshold: float = 0.05, least_cells: int = 6) -> DataFrame:
    """M6: place metrics of each unit in each trial, all trials in one job.

    A trial is a session of its own to the maps. Units without a spike in a trial have no map, so null metrics and
    rate 0; fields' sizes are in square metres.
    """
    both = F.concat_ws("|", "session_id", F.col("trial_num").cast("string")).alias("session_id")
    frames, points = track.filter("trial_num is not null and x is not null"), within_trials(spikes, trials)
    own = step_speed(frames, ("session_id",)).select(both, "seconds", "x", "y", "speed")
    rates = maps.rate_map(own, points.select(both, "unit_id", "t"), nx, ny, sigma, threshold)
    info = maps.spatial_info(rates)
    area = WIDTH_M / nx * HEIGHT_M / ny
    fields = maps.place_fields(rates, least_cells).groupBy(*UNIT).agg((F.sum("cells") * area).alias("field_size_m2"))
    counts = points.groupBy("session_id", "trial_num", "unit_id").agg(F.count("*").alias("n"))
    every = trials.join(spikes.select(*UNIT).distinct(), "session_id").join(counts, ["session_id", "trial_num", "unit_id"], "left")
    seconds = F.greatest(F.col("t1") - F.col("t0"), F.lit(1e-9))
    keyed = every.withColumn("__key", F.concat_ws("|", "session_id", F.col("trial_num").cast("string")))
    metrics = info.join(fields, UNIT, "left").select(F.col("session_id").alias("__key"), "unit_id", "information", "selectivity", "peak", F.coalesce("field_size_m2", F.lit(0.0)).alias("field_size_m2"))
    return keyed.join(metrics, ["__key", "unit_id"], "left").select("session_id", "trial_num", "unit_id", "information", "selectivity", "peak", "field_size_m2", (F.coalesce("n", F.lit(0)) / seconds).alias("rate"))


def trial_facts(metrics: DataFrame, errors: DataFrame, trials: DataFrame, performance: DataFrame, speeds: DataFrame) -> DataFrame:
    """M6 with what a trial's units share: the median decoding error inside its window, its performance and between-node speed.

    `errors` has session_id, t and err; `performance` and `speeds` have a row for a trial at most. What is not known is null.
    """
    key = ["session_id", "trial_num"]
    inside = within_trials(errors.select("session_id", "t", "err"), trials.select(*key, "t0", "t1")).groupBy(*key).agg(F.median("err").alias("decoding_error_m"))
    out = metrics.join(inside, key, "left").join(performance.select(*key, "performance"), key, "left")
    return out.join(speeds.select(*key, "between_node_speed"), key, "left")


def time_counts(spikes: DataFrame, bins: DataFrame, width: float) -> DataFrame:
    """Spikes of each unit in a session's tracked bins (clock time over width); bins without any are kept with n = 0."""
    counted = spikes.groupBy(*UNIT, F.floor(F.col("t") / width).alias("bin")).agg(F.count("*").alias("n"))
    return bins.select("session_id", "bin").join(counted, ["session_id", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def decode_leads(track: DataFrame, spikes: DataFrame, leads: tuple[float, ...] = (0.0, 1.0, 3.0), qualities: dict[str, tuple[str, ...]] | None = None, folds: int = 5, width: float = 0.5, nx: int = 18, ny: int = 10, sigma: float = 1.0, least_s: float = 0.3, threshold: float = RUN_SPEED) -> DataFrame:
    """U6, DE7: decoded positions of every lead and set of units in one job, cross-validated.

    `spikes` has session_id, unit_id, label, t. For each lead, set and fold curves are those of the other folds' bins, and
    the fold's bins are decoded with them (`leads.decode_cases`). The position meant is that of the bin's middle plus the
    lead; bins without one are left out. Only samples, spikes and bins (by their mean) faster than `threshold` count; zero
    disables the gate.
    """
    sets = qualities or {"good": ("good",), "good_mua": ("good", "mua")}
    known = step_speed(track.filter("x is not null and y is not null"), ("session_id",))
    bins = assign_fold(mean_bins(known, width, threshold), folds)
    mask = F.lit(0)
    for i, labels in enumerate(sets.values()):
        mask = mask + F.when(F.col("label").isin(*labels), 1 << i).otherwise(0)
    masked = spikes.select("session_id", "unit_id", "t", mask.alias("mask"), F.lit(0).alias("rep")).filter("mask > 0")
    found = decode_cases(known, masked, bins, leads, len(sets), folds, 1, width, nx, ny, sigma, least_s, threshold)
    named = lambda c, values: F.element_at(F.array(*map(F.lit, values)), F.col(c) + 1).alias(c)
    out = found.select("session_id", named("lead", map(float, leads)), named("quality", sets), "bin", "x", "y", *decoded_at(nx, ny))
    return out.withColumn("err", F.hypot(F.col("decoded_x") - F.col("x"), F.col("decoded_y") - F.col("y")))


def decoded_at(nx: int, ny: int) -> list[Column]:
    """The middle of the decoded cell."""
    return [((F.col("bx") + 0.5) * (WIDTH_M / nx)).alias("decoded_x"), ((F.col("by") + 0.5) * (HEIGHT_M / ny)).alias("decoded_y")]


def mean_bins(known: DataFrame, width: float, threshold: float = RUN_SPEED) -> DataFrame:
    """(session_id, bin, speed, run): the tracked bins of clock time, their mean speed and whether it is above the threshold, if there is one."""
    speeds = known.groupBy("session_id", F.floor(F.col("seconds") / width).alias("bin")).agg(F.avg("speed").alias("speed"))
    return speeds.withColumn("run", F.coalesce(F.col("speed") > threshold, F.lit(False)) if threshold else F.lit(True))


def turned(spikes: DataFrame, track: DataFrame, replicates: int, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """DE3: `replicates` copies of every train (rep), each unit's turned by its own share of the track's span.

    The share lies between `low` and `high` by a hash of session, unit and rep, so runs agree.
    """
    span = track.groupBy("session_id").agg(F.min("seconds").alias("__a"), (F.max("seconds") - F.min("seconds")).alias("__T"))
    copies = spikes.join(span, "session_id").withColumn("__T", F.when(F.col("__T") > 0, F.col("__T")).otherwise(1.0)).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", "session_id", F.col("unit_id").cast("string"), F.col("rep").cast("string"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    by = (F.lit(low) + (high - low) * draw) * F.col("__T")
    return copies.withColumn("t", F.col("__a") + F.pmod(F.col("t") - F.col("__a") + by, F.col("__T"))).drop("__a", "__T")


def shuffle_null(track: DataFrame, spikes: DataFrame, leads: tuple[float, ...] = (0.0, 1.0, 3.0), replicates: int = 20, width: float = 0.5, nx: int = 18, ny: int = 10, sigma: float = 1.0, least_s: float = 0.3, threshold: float = RUN_SPEED) -> DataFrame:
    """DE3, DE10: (session_id, lead, rep, bin, speed, neural): errors of decoding turned trains, all leads and replicates in one job.

    Curves are fitted to a replicate's own turned spikes and decode all of its bins, as the rule has it. A turned spike is
    one row for all leads (`leads.decode_cases`).
    """
    known = step_speed(track.filter("x is not null and y is not null"), ("session_id",))
    shifted = turned(spikes.select("session_id", "unit_id", "t"), known, replicates).withColumn("mask", F.lit(1))
    bins = mean_bins(known, width, threshold).withColumn("fold", F.lit(0))
    found = decode_cases(known, shifted, bins, leads, 1, None, replicates, width, nx, ny, sigma, least_s, threshold)
    lead = F.element_at(F.array(*map(F.lit, map(float, leads))), F.col("lead") + 1).alias("lead")
    out = found.select("session_id", lead, "rep", "bin", "speed", "x", "y", *decoded_at(nx, ny))
    return out.select("session_id", "lead", "rep", "bin", "speed", F.hypot(F.col("decoded_x") - F.col("x"), F.col("decoded_y") - F.col("y")).alias("neural"))


def lead_summary(decoded: DataFrame) -> DataFrame:
    """DE7: errors of each lead and set of units, and how decoded and actual positions go together by axis."""
    together = lambda a: F.when((F.var_pop(a) > 0) & (F.var_pop(f"decoded_{a}") > 0), F.covar_pop(a, f"decoded_{a}") / F.sqrt(F.var_pop(a) * F.var_pop(f"decoded_{a}"))).alias(f"r_{a}")
    return decoded.groupBy("session_id", "lead", "quality").agg(F.count("*").alias("n"), F.median("err").alias("median_err"), F.avg("err").alias("mean_err"), together("x"), together("y"))


def smooth_series(rows: DataFrame, keys: list[str], values: list[str], sigma: float) -> DataFrame:
    """A Gaussian over the places `i` = 0, 1, ... of each series, mirrored at its ends as often as needed.

    Rows are copied to the places beyond the ends that mirror them, so that a window of the kernel's size is full.
    """
    weights = maps.kernel(sigma)
    r = len(weights) // 2
    n = F.count("*").over(Window.partitionBy(*keys))
    turns = F.sequence(-F.ceil(F.lit(r) / (2 * F.col("__n"))) - 1, F.ceil(F.lit(r) / (2 * F.col("__n"))) + 1)
    images = F.flatten(F.transform(turns, lambda m: F.array(F.col("i") + 2 * F.col("__n") * m, 2 * F.col("__n") * m - F.col("i") - 1)))
    spread = rows.withColumn("__n", n).withColumn("__at", F.explode(F.filter(images, lambda p: (p >= -r) & (p < F.col("__n") + r))))
    w = Window.partitionBy(*keys).orderBy("__at").rowsBetween(-r, r)
    kernel = F.array(*map(F.lit, weights))
    total = lambda c: F.aggregate(F.zip_with(F.collect_list(c).over(w), kernel, lambda v, k: v * k), F.lit(0.0), lambda a, b: a + b)
    smooth = spread.withColumns({f"__s_{c}": total(F.col(c).cast("double")) for c in values}).filter("__at = i")
    return smooth.drop(*values, "__n", "__at").withColumnsRenamed({f"__s_{c}": c for c in values})


def speed_rate(track: DataFrame, spikes: DataFrame, fps: float = 30.0, smooth_s: float = 0.25, cap: float = 0.6, least: int = 5) -> DataFrame:
    """Speed (capped) and firing rate of each unit at each position sample, both smoothed.

    A sample's spikes are those up to the next one, the last sample's those of one frame. Sessions with fewer than
    `least` samples are left out.
    """
    w = Window.partitionBy("session_id").orderBy("seconds", "frame_index")
    known = track.filter("x is not null and y is not null")
    rows = step_speed(known, ("session_id",)).withColumn("i", F.row_number().over(w) - 1).withColumn("__all", F.count("*").over(Window.partitionBy("session_id"))).filter(F.col("__all") >= least)
    samples = rows.select("session_id", F.col("i").cast("long").alias("i"), "seconds", F.least("speed", F.lit(cap)).alias("speed"))
    both = samples.select("session_id", F.col("seconds").alias("t"), F.lit(0).alias("p"), "i", F.lit(None).cast(spikes.schema["unit_id"].dataType).alias("unit_id"), "seconds").unionByName(
        spikes.select("session_id", "t", F.lit(1).alias("p"), F.lit(None).cast("long").alias("i"), "unit_id", F.lit(None).cast("double").alias("seconds"))
    )
    before = Window.partitionBy("session_id").orderBy("t", "p", "i").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max("seconds").over(Window.partitionBy("session_id"))
    met = both.withColumn("at", F.last("i", ignorenulls=True).over(before)).withColumn("__end", last + 1.0 / fps).filter("p = 1 and at is not null and t <= __end")
    counts = met.groupBy(*UNIT, F.col("at").alias("i")).agg(F.count("*").alias("n"))
    grid = samples.join(spikes.select(*UNIT).distinct(), "session_id").join(counts, [*UNIT, "i"], "left").withColumn("rate", F.coalesce("n", F.lit(0)) * fps).drop("n")
    return smooth_series(grid, UNIT, ["speed", "rate"], max(1.0, smooth_s * fps)).select(*UNIT, "i", "seconds", "speed", "rate")


def bin_behaviour(bins: DataFrame, track: DataFrame, trials: DataFrame, nodes: DataFrame, threshold: float = 0.05, most: int | None = None) -> DataFrame:
    """Position, speed, trial, its type and the distance to its goal in each bin in which the animal moves.

    `bins` has session_id, bin and its middle t. Outside of the track the nearest sample counts; of trials that
    share a bin the later one. Given `most`, a session with more bins keeps those with the smallest hashes (a sample
    for an embedding).
    """
    known = step_speed(track.filter("x is not null and y is not null"), ("session_id",))
    rows = interp_at(bins, known, ("x", "y", "speed"), outside="hold").filter(F.col("speed") > threshold)
    met = within_trials(rows.select("session_id", "bin", "t"), trials.select("session_id", "trial_num", "trial_type", "goal_node", "t0", "t1"))
    last = met.groupBy("session_id", "bin").agg(F.max_by(F.struct("trial_num", "trial_type", "goal_node"), "trial_num").alias("s")).select("session_id", "bin", "s.*")
    goals = F.broadcast(nodes.select(F.col("node_id").alias("goal_node"), F.col("x").alias("gx"), F.col("y").alias("gy")))  # one maze's nodes
    out = rows.join(last, ["session_id", "bin"], "left").join(goals, "goal_node", "left").withColumn("goal_distance", F.hypot(F.col("x") - F.col("gx"), F.col("y") - F.col("gy"))).drop("gx", "gy", "goal_node")
    if most is None:
        return out
    w = Window.partitionBy("session_id").orderBy(F.md5(F.concat_ws(":", "session_id", F.col("bin").cast("string"))))
    return out.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= most).drop("__r")


#: Bins of a session that are dealt together, and entries of products that are held at once.
BLOCK_BINS, HELD_PRODUCTS = 4096, 1 << 20


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of units' values over each session's bins in a batch, a row per unit (index 0 is the constant 1)."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("session_id")))
        session, lists = batch.column("session_id").dictionary_encode(), batch.column("z")
        flat, length = lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        code, begin = session.indices.to_numpy(zero_copy_only=False), np.cumsum(length) - length
        for m in np.unique(length).tolist():
            of = np.flatnonzero(length == m)
            of = of[np.argsort(code[of], kind="stable")]
            step = max(1, HELD_PRODUCTS // (m + 1) ** 2)
            for at in range(0, len(of), step):
                some = of[at : at + step]
                z = np.column_stack([np.ones(len(some)), flat[begin[some][:, None] + np.arange(m)]])
                first = np.flatnonzero(np.append(True, code[some][1:] != code[some][:-1]))
                sums = np.add.reduceat(z[:, :, None] * z[:, None, :], first, axis=0)
                names = session.dictionary.take(pa.array(np.repeat(code[some][first], m + 1)))
                offsets = pa.array(np.arange(len(names) + 1, dtype=np.int32) * (m + 1))
                yield pa.RecordBatch.from_arrays([names, pa.array(np.tile(np.arange(m + 1, dtype=np.int32), len(first))), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))], names=["session_id", "a", "s"])


def _axes(k: int):
    """Means and principal axes of whole sessions' sums of products, those of as many units at once."""

    def work(table: pa.Table) -> pa.Table:
        begins = groups.starts(table, ["session_id"])[:-1]
        lists = table.column("s").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, place = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(length) - length
        mean, axes = [None] * len(begins), [None] * len(begins)
        for n in np.unique(length[begins]).tolist():
            of = np.flatnonzero(length[begins] == n)
            g = flat[place[begins[of]][:, None] + np.arange(n * n)].reshape(-1, n, n)
            middle = g[:, 0, 1:] / g[:, 0, :1]
            _, vectors = np.linalg.eigh(g[:, 1:, 1:] / g[:, :1, :1] - middle[:, :, None] * middle[:, None, :])
            found = vectors[:, :, ::-1][:, :, :k].transpose(0, 2, 1)
            found = found * np.sign(np.take_along_axis(found, np.abs(found).argmax(2)[:, :, None], 2))
            for i, x, y in zip(of.tolist(), middle.tolist(), found.tolist()):
                mean[i], axes[i] = x, y
        kinds = pa.list_(pa.float64()), pa.list_(pa.list_(pa.float64()))
        return pa.table({"session_id": table.column("session_id").take(pa.array(begins)), "mean": pa.array(mean, kinds[0]), "axes": pa.array(axes, kinds[1])})

    return work


def embed_pca(matrix: DataFrame, k: int = 3) -> DataFrame:
    """Each bin of the long matrix (session_id, unit_id, bin, z) on its session's first k principal axes.

    Products are summed by batch and then by session, so that one task sees units by units, never the bins; bins are
    dealt by blocks, so a session has few sums. An axis' largest loading is positive. A session with fewer than k units
    has null for the rest.
    """
    dealt = matrix.withColumn("__block", F.floor(F.col("bin") / BLOCK_BINS)).repartition("session_id", "__block")
    rows = dealt.groupBy("session_id", "__block", "bin").agg(F.transform(F.sort_array(F.collect_list(F.struct("unit_id", "z"))), lambda x: x["z"].cast("double")).alias("z"))
    return on_axes(rows.drop("__block").sortWithinPartitions("session_id"), k).select("session_id", "bin", *[f"pc{i + 1}" for i in range(k)])


def on_axes(rows: DataFrame, k: int) -> DataFrame:
    """Rows (session_id, z and others; z of one length in a session) with their places on the session's k principal axes."""
    partial = rows.select("session_id", "z").mapInArrow(_grams, "session_id string, a int, s array<double>")
    entries = partial.select("session_id", "a", F.posexplode("s").alias("b", "v")).groupBy("session_id", "a", "b").agg(F.sum("v").alias("v"))
    gram = entries.groupBy("session_id", "a").agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "v"))), lambda x: x["v"]).alias("s"))
    axes = groups.map_groups(gram, ["session_id"], ["a"], _axes(k), "session_id string, mean array<double>, axes array<array<double>>")
    centred = F.zip_with("z", "mean", lambda a, b: a - b)
    dot = lambda i: F.aggregate(F.zip_with(centred, F.get("axes", F.lit(i)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return rows.join(axes, "session_id").select(*rows.columns, *[dot(i).alias(f"pc{i + 1}") for i in range(k)])


#: Start, lower and upper bounds of decay, rise, amplitude, depth, asymptote, burst width, burst height and delay (ms).
RISE_START = (20.0, 1.0, 1.0, 2.0, 0.1, 1.5, 0.1, 1.0)
RISE_LOW, RISE_HIGH = (1.0, 0.1, 0.0, 0.0, -1.0, 0.1, 0.0, 0.0), (500.0, 50.0, 10.0, 15.0, 2.0, 5.0, 10.0, 20.0)


def rise_curve(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    decay, rise, c, d, asymptote, burst, h, t0 = p
    late = x - t0
    with np.errstate(over="ignore", invalid="ignore"):
        return np.maximum(c * (np.exp(-late / decay) - d * np.exp(-late / rise)) + h * np.exp(-((late / burst) ** 2)) + asymptote, 0.0)


def fit_rise(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> float | None:
    """The rise time of the curve nearest to y."""
    found = fit_rises(x, y[None, :], rounds)[0]
    return float(found) if np.isfinite(found) else None


def _steps(square: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """Solutions of many small damped systems at once; where one has no unique solution, the shortest of each."""
    try:
        return np.linalg.solve(square, slope[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:
        return (np.linalg.pinv(square, hermitian=True) @ slope[:, :, None])[:, :, 0]


def fit_rises(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Rise times of the curves nearest to each row of y: damped least squares, each step cut at the bounds; NaN without one.

    All rows take their steps at once, and those that have settled leave. Only the exponentials that a parameter is in
    are computed anew for its slope. A parameter that a bound holds has a row of the identity in its system.
    """
    low, high = np.array(RISE_LOW), np.array(RISE_HIGH)
    p, damp = np.tile(np.array(RISE_START), (len(y), 1)), np.full(len(y), 1e-2)

    def parts(decay, rise, burst, t0):
        late = x - t0
        return np.exp(-late / decay), np.exp(-late / rise), np.exp(-((late / burst) ** 2))

    def curve(c, d, asymptote, h, slow, fast, bump):
        return np.maximum(c * (slow - d * fast) + h * bump + asymptote, 0.0)

    def loss(q: np.ndarray, y: np.ndarray) -> np.ndarray:
        decay, rise, c, d, asymptote, burst, h, t0 = q.T[:, :, None]
        return ((curve(c, d, asymptote, h, *parts(decay, rise, burst, t0)) - y) ** 2).sum(1)

    with np.errstate(over="ignore", invalid="ignore"):
        best, live = loss(p, y), np.arange(len(y))
        for _ in range(rounds):
            if not len(live):
                break
            at, of, by = p[live], y[live], damp[live]
            width = 1e-6 * np.maximum(np.abs(at), 1e-2)
            width = np.where(at + width > high, -width, width)
            decay, rise, c, d, asymptote, burst, h, t0 = at.T[:, :, None]
            m = (at + width).T[:, :, None]
            slow, fast, bump = parts(decay, rise, burst, t0)
            late = x - t0
            base = curve(c, d, asymptote, h, slow, fast, bump)
            moved = (
                curve(c, d, asymptote, h, np.exp(-late / m[0]), fast, bump), curve(c, d, asymptote, h, slow, np.exp(-late / m[1]), bump),
                curve(m[2], d, asymptote, h, slow, fast, bump), curve(c, m[3], asymptote, h, slow, fast, bump), curve(c, d, m[4], h, slow, fast, bump),
                curve(c, d, asymptote, h, slow, fast, np.exp(-((late / m[5]) ** 2))), curve(c, d, asymptote, m[6], slow, fast, bump), curve(c, d, asymptote, h, *parts(decay, rise, burst, m[7])),
            )
            jacobian = np.stack([(v - base) / w for v, w in zip(moved, width.T[:, :, None])], 2)
            across = jacobian.transpose(0, 2, 1)
            slope, square = (across @ (of - base)[:, :, None])[:, :, 0], across @ jacobian
            held = (at <= low) & (slope < 0) | (at >= high) & (slope > 0)
            square[held[:, :, None] | held[:, None, :]] = 0.0
            diagonal = np.einsum("nii->ni", square)  # a view
            diagonal[:] = np.where(held, 1.0, diagonal + by[:, None] * (diagonal + 1e-12))
            step = _steps(square, np.where(held, 0.0, slope))
            q = np.clip(at + step, low, high)
            new, old = loss(q, of), best[live]
            better = new < old
            p[live[better]], best[live[better]] = q[better], new[better]
            damp[live] = np.where(better, np.maximum(by / 3, 1e-12), 4 * by)
            live = live[np.where(better, old - new >= 1e-12 * (1 + old), 4 * by <= 1e12)]
    return np.where(np.isfinite(best), p[:, 1], np.nan)


#: Units whose curves are fitted at once.
FITTED = 512


def acg_rise_fit(spikes: DataFrame, window: float = 0.05, bins: int = 200) -> DataFrame:
    """Rise time (ms) of each unit's autocorrelogram, scaled to its peak; null without any pair of spikes or with fewer than 10 bins.

    Histograms are fitted in the task that makes them, many at once.
    """
    centres = (np.arange(bins) + 0.5) * (2000.0 * window / bins) - 1000.0 * window
    x = centres[centres > 0]

    def given(units: list[tuple]) -> pa.RecordBatch:
        y = np.stack([u[3][centres > 0] for u in units]).astype(float)
        some = np.flatnonzero(y.max(1, initial=0) > 0) if len(x) >= 10 else np.zeros(0, int)
        tau = np.full(len(units), np.nan)
        if len(some):
            tau[some] = fit_rises(x, y[some] / y[some].max(1, keepdims=True))
        return pa.RecordBatch.from_arrays([pa.array([u[0] for u in units], pa.string()), pa.array([u[1] for u in units], pa.int64()), pa.array(tau, mask=np.isnan(tau))], names=["session_id", "unit_id", "acg_tau_rise_ms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = histograms(batches, window, bins)
        while units := list(islice(found, FITTED)):
            yield given(units)

    return by_unit(spikes).mapInArrow(run, "session_id string, unit_id bigint, acg_tau_rise_ms double")
