"""Rate maps, place fields and decoding of position from spikes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.operators.groups import doubles, map_groups, starts
from warren.operators.scan import SECONDS, block_of, scan
from warren.operators.spikes import interp_at
from warren.operators.track import HEIGHT_M, WIDTH_M, bins, clipped_bin

CELL = ("bx", "by")
#: The highest rate of a tuning curve, and the time a cell needs (after smoothing) for its rate to count.
CURVE_HZ, LEAST_S = 50.0, 1e-3


def kernel(sigma: float) -> list[float]:
    """Weights of a Gaussian out to four deviations."""
    r = int(4 * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    return [x / sum(w) for x in w]


def _receiver(image: Column):
    return lambda o: F.struct((image - o["k"]).cast("int").alias("q"), o["w"].alias("w"))


def gauss_smooth(grid: DataFrame, keys: list[str], value: str, sigma: float, nx: int, ny: int) -> DataFrame:
    """M2: two passes, along each axis. Each cell sends its weighted value to those whose kernel reaches it.

    With mirrored edges a cell may be reached more than once by one kernel; offsets are those of the receiver.
    """
    if not sigma:
        return grid
    weights = kernel(sigma)
    r = len(weights) // 2
    for axis, n in (("bx", nx), ("by", ny)):
        # receivers q with mirrored(q + k) = this cell: q + k is the cell or one of its mirror images
        images = [F.col(axis), -F.col(axis) - 1, 2 * n - 1 - F.col(axis), F.col(axis) + 2 * n, F.col(axis) - 2 * n]
        offsets = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in zip(range(-r, r + 1), weights)])
        to = F.flatten(F.array(*[F.transform(offsets, _receiver(image)) for image in images]))
        spread = grid.select(*keys, *CELL, value, F.explode(F.filter(to, lambda o: o["q"].between(0, n - 1))).alias("o"))
        other = "by" if axis == "bx" else "bx"
        grid = spread.groupBy(*keys, F.col("o.q").alias(axis), other).agg(F.sum(F.col(value) * F.col("o.w")).alias(value)).select(*keys, *CELL, value)
    return grid


def rate_map(track: DataFrame, spikes: DataFrame, nx: int = 18, ny: int = 10, sigma: float = 0.0, threshold: float = 0.0, lead: float = 0.0, most_hz: float | None = None) -> DataFrame:
    """M1, DE4: spikes over time spent in each visited cell, both smoothed apart; `occupied_s` stays unsmoothed.

    The track has x, y, speed and seconds; a spike lies where the animal is at its time (plus a lead). With `most_hz`
    (CURVE_HZ) the rates are tuning curves: cut there, and 0 in cells of no more than LEAST_S.
    """
    fast = lambda df: df.filter(F.col("speed") > threshold) if threshold else df
    return placed_rates(fast(track), fast(interp_at(spikes, track, ("x", "y", "speed"), lead)), spikes.select("session_id", "unit_id").distinct(), nx, ny, sigma, sample_s(track), most_hz)


def sample_s(track: DataFrame) -> DataFrame:
    """The usual time between a session's samples, found over blocks of time."""
    rows = scan(track.select("session_id", "seconds"), ["session_id"], ["seconds"], block_of("seconds", SECONDS), before={"__b": F.col("seconds")})
    return rows.groupBy("session_id").agg(F.median(F.col("seconds") - F.col("__b")).alias("dt"))


def placed_rates(track: DataFrame, placed: DataFrame, units: DataFrame, nx: int, ny: int, sigma: float, dt: DataFrame, most_hz: float | None = None) -> DataFrame:
    """The rate map of units from samples of the track and spikes that have their positions already."""
    cells = lambda df: df.withColumn("bx", bins(F.col("x"), 0.0, WIDTH_M, nx)).withColumn("by", bins(F.col("y"), 0.0, HEIGHT_M, ny)).filter("bx is not null and by is not null")
    occupied = cells(track).groupBy("session_id", *CELL).agg(F.count("*").alias("n")).join(dt, "session_id").select("session_id", *CELL, (F.col("n") * F.col("dt")).alias("occupied_s"))
    counts = cells(placed).groupBy("session_id", "unit_id", *CELL).agg(F.count("*").cast("double").alias("spikes"))
    smooth_n, smooth_t = gauss_smooth(counts, ["session_id", "unit_id"], "spikes", sigma, nx, ny), gauss_smooth(occupied, ["session_id"], "occupied_s", sigma, nx, ny).withColumnRenamed("occupied_s", "smooth_s")
    grid = units.join(occupied, "session_id").join(smooth_t, ["session_id", *CELL])
    rate = F.try_divide(F.coalesce("spikes", F.lit(0.0)), F.col("smooth_s"))
    if most_hz is not None:
        rate = F.when(F.col("smooth_s") > LEAST_S, F.least(F.greatest(rate, F.lit(0.0)), F.lit(most_hz))).otherwise(0.0)
    return grid.join(smooth_n, ["session_id", "unit_id", *CELL], "left").withColumn("rate", rate).select("session_id", "unit_id", *CELL, "occupied_s", "rate")


def spatial_info(maps: DataFrame) -> DataFrame:
    """M3: information per spike in bits, and selectivity (peak over mean)."""
    every = Window.partitionBy("session_id", "unit_id")
    rows = maps.withColumn("p", F.try_divide("occupied_s", F.sum("occupied_s").over(every))).withColumn("mean", F.sum(F.col("p") * F.col("rate")).over(every))
    ratio = F.try_divide("rate", "mean")
    bit = F.when(ratio > 0, F.col("p") * ratio * F.log2(ratio)).otherwise(0.0)
    return rows.groupBy("session_id", "unit_id").agg(F.when(F.max("mean") > 0, F.sum(bit)).alias("information"), F.try_divide(F.max("rate"), F.max("mean")).alias("selectivity"), F.max("rate").alias("peak"))


def _fields(group: np.ndarray, x: np.ndarray, y: np.ndarray, rate: np.ndarray, least_cells: int, least_peak: float) -> tuple[np.ndarray, ...]:
    """Connected sets of cells at half of their group's peak or above, neighbours sharing an edge, all groups at once.

    Gives group, place (largest first, of equal ones the later in reading order), cells, peak and mean cell of each.
    """
    n = int(group.max()) + 1 if len(group) else 0
    top = np.zeros(n)
    np.maximum.at(top, group, rate)
    keep = (rate >= 0.5 * top[group]) & (top[group] > 0)
    group, x, y, rate = group[keep], x[keep], y[keep], rate[keep]
    if not len(group):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0),) * 3
    wide, high = x.max() - x.min() + 3, y.max() - y.min() + 3
    place = (group * high + y - y.min() + 1) * wide + x - x.min() + 1  # in reading order
    order = np.argsort(place)
    group, x, y, rate, place = group[order], x[order], y[order], rate[order], place[order]
    near = []
    for step in (1, -1, wide, -wide):
        at = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
        near.append(np.where(place[at] == place + step, at, np.arange(len(place))))
    label, before = np.arange(len(place)), None
    while before is None or (label != before).any():
        before = label
        for at in near:
            label = np.minimum(label, label[at])
        label = label[label]
    first, of = np.unique(label, return_inverse=True)
    cells, peak = np.bincount(of), np.zeros(len(first))
    np.maximum.at(peak, of, rate)
    cx, cy = np.bincount(of, x) / cells, np.bincount(of, y) / cells
    good = np.flatnonzero((cells >= least_cells) & (peak >= least_peak))
    good = good[np.lexsort((-first[good], -cells[good], group[first[good]]))]
    own = group[first[good]]
    number = np.arange(len(own)) - np.searchsorted(own, own)
    return own, number, cells[good], peak[good], cx[good], cy[good]


def place_fields(maps: DataFrame, least_cells: int = 6, least_peak: float = 0.5) -> DataFrame:
    """M4: fields of each unit, the largest first (of equal ones the later in reading order), with their size, peak and mean cell.

    A task works on many units' grids at once.
    """
    unit = ["session_id", "unit_id"]

    def work(table: pa.Table) -> pa.Table:
        ends, rate = starts(table, unit), doubles(table.column("rate"))
        group, there = np.repeat(np.arange(len(ends) - 1), np.diff(ends)), ~np.isnan(rate)
        x, y = (table.column(c).to_numpy().astype(np.int64)[there] for c in CELL)
        own, number, cells, peak, cx, cy = _fields(group[there], x, y, rate[there], least_cells, least_peak)
        named = table.select(unit).take(pa.array(ends[:-1][own]))
        return pa.table({c: named.column(c) for c in unit} | {"field": pa.array(number, pa.int32()), "cells": pa.array(cells, pa.int32()), "peak": pa.array(peak), "cx": pa.array(cx), "cy": pa.array(cy)})

    rows = maps.select("session_id", F.col("unit_id").cast("int").alias("unit_id"), *CELL, F.col("rate").cast("double").alias("rate"))
    return map_groups(rows, unit, [], work, "session_id string, unit_id int, field int, cells int, peak double, cx double, cy double")


def field_metrics(fields: DataFrame, goals: DataFrame, units: DataFrame, nx: int = 18, ny: int = 10) -> DataFrame:
    """Number of fields, and distances in metres of their centres to the goal: mean, largest, second and smallest field's.

    `goals` has session_id, goal_x, goal_y in metres; `units` every unit, as those without a field have 0 of them. A
    centre is the mean of a field's cells' middles.
    """
    at = lambda c, size, n: (F.col(c) + 0.5) * (size / n)
    rows = fields.join(goals, "session_id", "left").withColumn("d", F.hypot(at("cx", WIDTH_M, nx) - F.col("goal_x"), at("cy", HEIGHT_M, ny) - F.col("goal_y")))
    nth = lambda k: F.max(F.when(F.col("field") == k, F.col("d")))
    found = rows.groupBy("session_id", "unit_id").agg(F.count("*").alias("fields"), F.avg("d").alias("mean_distance"), nth(0).alias("largest"), nth(1).alias("second"), F.max_by("d", "field").alias("smallest"))
    return units.select("session_id", "unit_id").distinct().join(found, ["session_id", "unit_id"], "left").withColumn("fields", F.coalesce("fields", F.lit(0)))


def posterior_grid(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Every time bin of a session with every cell it visited; at most a maze's cells for a bin."""
    return counts.select("session_id", "bin").distinct().join(cells, "session_id")


#: Time bins of a block that is decoded at once.
BLOCK_BINS = 4096


def decode(counts: DataFrame, curves: DataFrame, width: float, least_s: float = 0.3, block: int = BLOCK_BINS) -> DataFrame:
    """DE5: the most likely cell of each time bin under independent Poisson units.

    Cells visited too briefly are left out, and sessions with fewer than three cells. `counts` has session_id, unit_id,
    bin, n; `curves` the rate map's columns. Of cells as likely the first wins.

    A block of a session's bins meets a copy of the session's curves in one task, where bins times units times cells is
    a product of two matrices: of counts, and of logarithms of rates. Both have at most `block` bins, a session's
    units and a maze's cells.
    """
    keys, logs = ["session_id", "block"], 1e-3
    spikes = counts.select("session_id", F.floor(F.col("bin") / block).alias("block"), "unit_id", F.lit(1).alias("kind"), F.col("bin").cast("bigint").alias("bin"), F.lit(0).alias("bx"), F.lit(0).alias("by"), F.col("n").cast("double").alias("value"))
    cells = curves.filter(F.col("occupied_s") >= least_s).select("session_id", "unit_id", *CELL, "rate")
    copies = spikes.select(*keys).distinct().join(cells, "session_id").select(*keys, "unit_id", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("bin"), F.col("bx").cast("int").alias("bx"), F.col("by").cast("int").alias("by"), F.col("rate").cast("double").alias("value"))

    def work(table: pa.Table) -> pa.Table:
        ends = starts(table, [*keys, "kind"])
        kinds, units_, bins_, xs, ys, values = (table.column(c).to_numpy() for c in ("kind", "unit_id", "bin", *CELL, "value"))
        names, out = table.column("session_id"), []
        blocks = table.column("block").to_numpy()
        for (low, mid), high in zip(zip(ends, ends[1:]), ends[2:]):
            # a group's curves, and its counts right behind them
            if kinds[low] or not kinds[mid] or blocks[low] != blocks[mid] or names[int(low)] != names[int(mid)]:
                continue
            cell = xs[low:mid].astype(np.int64) << 32 | ys[low:mid]
            own, cell_of = np.unique(cell, return_inverse=True)
            if len(own) < 3:
                continue
            units, unit_of = np.unique(units_[low:mid], return_inverse=True)
            rate = np.full((len(units), len(own)), np.nan)
            rate[unit_of, cell_of] = values[low:mid]
            bins, bin_of = np.unique(bins_[mid:high], return_inverse=True)
            n, unit = values[mid:high], units_[mid:high]
            at = np.minimum(np.searchsorted(units, unit), len(units) - 1)
            held = (n > 0) & (units[at] == unit)
            seen = np.bincount(bin_of[held] * len(units) + at[held], n[held], len(bins) * len(units)).reshape(len(bins), len(units))
            value = np.round(seen @ np.nan_to_num(np.log(rate + logs)) - width * np.nansum(rate, 0), 9)
            best = value.argmax(1)
            out.append((low, bins, own[best] >> 32, own[best] & 0xFFFFFFFF, value[np.arange(len(bins)), best]))
        bins, bx, by, value = (np.concatenate(x) if x else np.zeros(0) for x in (list(zip(*out))[1:] if out else [()] * 4))
        named = names.take(pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64)))
        return pa.table({"session_id": named, "bin": pa.array(bins.astype(np.int64)), "bx": pa.array(bx.astype(np.int32)), "by": pa.array(by.astype(np.int32)), "log_posterior": pa.array(value)})

    return map_groups(copies.unionByName(spikes), keys, ["kind"], work, "session_id string, bin bigint, bx int, by int, log_posterior double")


def decode_error(decoded: DataFrame, actual: DataFrame, nx: int = 18, ny: int = 10) -> DataFrame:
    """DE6: distance in metres from the decoded cell's centre to the mean position of the bin."""
    rows = decoded.join(actual, ["session_id", "bin"])
    return rows.withColumn("err", F.hypot((F.col("bx") + 0.5) * (WIDTH_M / nx) - F.col("x"), (F.col("by") + 0.5) * (HEIGHT_M / ny) - F.col("y"))).select("session_id", "bin", "bx", "by", "err")


def behaviour_predict(rows: DataFrame, least: int = 3) -> DataFrame:
    """DE8: mean later position by cell and heading, else by cell, else over the session."""
    means = lambda keys, s: rows.groupBy("session_id", *keys).agg(F.count("*").alias(f"n{s}"), F.avg("later_x").alias(f"x{s}"), F.avg("later_y").alias(f"y{s}"))
    out = rows.join(means((*CELL, "heading"), 1), ["session_id", *CELL, "heading"], "left").join(means(CELL, 2), ["session_id", *CELL], "left").join(means((), 3), "session_id")
    pick = lambda c: F.when(F.col("n1") >= least, F.col(f"{c}1")).when(F.col("n2") >= least, F.col(f"{c}2")).otherwise(F.col(f"{c}3"))
    return out.withColumn("predicted_x", pick("x")).withColumn("predicted_y", pick("y")).drop(*[f"{c}{i}" for c in "nxy" for i in (1, 2, 3)])


def kinematic_baselines(rows: DataFrame, lead: float) -> DataFrame:
    """DE9: errors of staying put and of going on at constant velocity."""
    return rows.withColumn("stay_err", F.hypot(F.col("later_x") - F.col("x"), F.col("later_y") - F.col("y"))).withColumn("steady_err", F.hypot(F.col("later_x") - F.col("x") - F.col("vx") * lead, F.col("later_y") - F.col("y") - F.col("vy") * lead))


def goal_profile(rows: DataFrame, bins_: int = 11, top: float = 10.0) -> DataFrame:
    """DE11: how often the animal is in each band of distance to the goal."""
    return rows.withColumn("band", clipped_bin(F.col("goal_distance"), 0.0, top, bins_)).groupBy("session_id", "band").agg(F.count("*").alias("n"), F.avg("goal_distance").alias("mean_distance"))


def grid_table(spark, extent_x: float, extent_y: float, width: float) -> DataFrame:
    """The cells of a map, at least five along an axis."""
    nx, ny = max(5, round(extent_x / width)), max(5, round(extent_y / width))
    return spark.range(nx * ny).select((F.col("id") % nx).cast("int").alias("bx"), F.floor(F.col("id") / nx).cast("int").alias("by"))
