"""Decoding at several leads, of several sets of units and replicates, from counts: nothing is copied for a lead, a set or a fold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.operators import maps
from warren.operators.groups import map_groups, starts
from warren.operators.track import HEIGHT_M, WIDTH_M

#: Seconds of a cell of time; bins of a block that is decoded at once.
CELL_S, BLOCK_BINS = 600.0, maps.BLOCK_BINS
#: Rows of cells of time, and what they hold.
HEAD, SAMPLE, BIN, SPIKE = range(4)
ROWS = {"session_id": "string", "cell": "bigint", "kind": "int", "rep": "int", "unit": "bigint", "mask": "int", "bin": "bigint", "fold": "int", "t": "double", "x": "double", "y": "double", "speed": "double"}
#: Counts that cells of time send to blocks of bins. Samples and placed spikes go to all blocks of a session.
OCCUPIED, PLACED, COUNTED, MEANT = range(4)
COUNTS = {"session_id": "string", "block": "bigint", "kind": "int", "lead": "int", "rep": "int", "fold": "int", "unit": "bigint", "mask": "int", "at": "bigint", "n": "double", "x": "double", "y": "double"}


def _schema(kinds: dict[str, str]) -> str:
    return ", ".join(f"{c} {k}" for c, k in kinds.items())


def _typed(df: DataFrame, **found) -> DataFrame:
    return df.select(*[found.get(c, F.lit(None)).cast(k).alias(c) for c, k in ROWS.items()])


def _cells(known: DataFrame, spikes: DataFrame, bins: DataFrame, dt: DataFrame, leads: tuple[float, ...], width: float, cell_s: float) -> DataFrame:
    """Samples, bins and spikes by cells of time, each cell with all that its times plus a lead need of the track.

    Samples up to the leads beyond a cell are copied to it. The sample before these and the one after them come from the
    session's cells, which have a row each; so does its head: the first and last block of its bins, the usual time
    between samples and the sets that it has units of.
    """
    low, high = min(0.0, *leads), max(0.0, *leads)
    cell = lambda c: F.floor(c / cell_s)
    key, sample = ["session_id", "cell"], F.struct("t", "x", "y", "speed")
    near = known.filter("session_id is not null and seconds is not null and not isnan(seconds)").withColumnRenamed("seconds", "t")
    near = near.select("session_id", F.explode(F.sequence(cell(F.col("t") - high), cell(F.col("t") - low))).alias("cell"), "t", "x", "y", "speed")
    met = spikes.filter("session_id is not null and t is not null").withColumn("cell", cell(F.col("t")))
    start = lambda by: F.col("bin").cast("double") * width + by * width
    spread = bins.filter("session_id is not null and bin is not null").withColumn("home", cell(start(0.5))).withColumn("cell", F.explode(F.sequence(cell(start(-0.5)), cell(start(1.5)))))
    block = F.when(F.col("run"), F.floor(F.col("bin") / BLOCK_BINS))
    there = near.groupBy(*key).agg(
        F.max_by(sample, F.when(F.col("t") < (F.col("cell") + 1) * cell_s + low, F.col("t"))).alias("last"),
        F.min_by(sample, F.when(F.col("t") >= F.col("cell") * cell_s + high, F.col("t"))).alias("next"),
    )
    there = there.unionByName(met.groupBy(*key).agg(F.bit_or("mask").alias("mask")), allowMissingColumns=True).unionByName(spread.groupBy(*key).agg(F.min(block).alias("b0"), F.max(block).alias("b1")), allowMissingColumns=True)
    there = there.groupBy(*key).agg(F.first("last", ignorenulls=True).alias("last"), F.first("next", ignorenulls=True).alias("next"), F.bit_or("mask").alias("mask"), F.min("b0").alias("b0"), F.max("b1").alias("b1"))
    every, order = Window.partitionBy("session_id"), Window.partitionBy("session_id").orderBy("cell")
    past, future = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    there = there.select(*key, F.last("last", ignorenulls=True).over(past).alias("last"), F.first("next", ignorenulls=True).over(future).alias("next"), F.bit_or("mask").over(every).alias("mask"), F.min("b0").over(every).alias("b0"), F.max("b1").over(every).alias("b1"))
    there = there.filter("b0 is not null").join(dt, "session_id", "left")
    carried = there.select(*key, F.explode(F.array("last", "next")).alias("s")).filter("s is not null")
    c = F.col
    rows = _typed(there, session_id=c("session_id"), cell=c("cell"), kind=F.lit(HEAD), unit=c("b0"), bin=c("b1"), mask=c("mask"), t=c("dt"))
    rows = rows.unionByName(_typed(carried, session_id=c("session_id"), cell=c("cell"), kind=F.lit(SAMPLE), mask=F.lit(0), **{k: c(f"s.{k}") for k in ("t", "x", "y", "speed")}))
    rows = rows.unionByName(_typed(near, session_id=c("session_id"), cell=c("cell"), kind=F.lit(SAMPLE), mask=(cell(c("t")) == c("cell")).cast("int"), **{k: c(k) for k in ("t", "x", "y", "speed")}))
    rows = rows.unionByName(_typed(spread, session_id=c("session_id"), cell=c("cell"), kind=F.lit(BIN), mask=c("run").cast("int") + 2 * (c("home") == c("cell")).cast("int"), bin=c("bin"), fold=c("fold"), speed=c("speed")))
    return rows.unionByName(_typed(met, session_id=c("session_id"), cell=c("cell"), kind=F.lit(SPIKE), rep=c("rep"), unit=c("unit_id"), mask=c("mask"), t=c("t")))


def _at(s: np.ndarray, columns: tuple[np.ndarray, ...], u: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Whether the track reaches each time u, and its columns there by straight lines between samples."""
    i = np.searchsorted(s, u, "right") - 1
    a, b = np.maximum(i, 0), np.minimum(i + 1, len(s) - 1)
    same = (i >= 0) & (s[a] == u)
    ok = same | (i >= 0) & (i + 1 < len(s))
    with np.errstate(divide="ignore", invalid="ignore"):
        return ok, [np.where(same, v[a], v[a] + (v[b] - v[a]) * (u - s[a]) / (s[b] - s[a])) for v in columns]


def _counted(leads: tuple[float, ...], width: float, nx: int, ny: int, threshold: float, held_out: bool):
    """What a cell of time knows: samples and placed spikes of each cell of the map, spikes of each bin, where the animal is meant to be."""
    fast = lambda speed: ~(speed <= threshold) if threshold else np.ones(len(speed), bool)

    def cell_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        inside = (x >= 0) & (x <= WIDTH_M) & (y >= 0) & (y <= HEIGHT_M)
        with np.errstate(invalid="ignore"):
            bx, by = np.minimum(np.floor(x / WIDTH_M * nx), nx - 1), np.minimum(np.floor(y / HEIGHT_M * ny), ny - 1)
        return np.where(inside, bx * ny + by, -1).astype(np.int64)

    def sums(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The distinct rows of some columns and how often each is there."""
        one = np.zeros(len(keys[0]), np.int64)
        for k in keys:
            if len(k) and k.min() != k.max():
                one = np.unique(np.unique(one, return_inverse=True)[1] * np.int64(len(k)) + np.unique(k, return_inverse=True)[1], return_inverse=True)[1]
        _, first, n = np.unique(one, return_index=True, return_counts=True)
        return [k[first] for k in keys], n.astype(float)

    def work(table: pa.Table) -> pa.Table:
        ends = starts(table, ["session_id", "cell"])
        kind, rep, unit, mask, bin_, fold = (table.column(c).fill_null(0).to_numpy() for c in ("kind", "rep", "unit", "mask", "bin", "fold"))
        t, x, y, speed = (table.column(c).to_numpy(zero_copy_only=False) for c in ("t", "x", "y", "speed"))
        out, names = [], []

        def put(low: int, what: int, blocks, n, **columns) -> None:
            if not len(n):
                return
            rows = [np.broadcast_to(columns.get(c, 0), len(n)) for c in ("lead", "rep", "fold", "unit", "mask", "at")] + [n] + [np.broadcast_to(columns.get(c, np.nan), len(n)) for c in "xy"]
            if what in (COUNTED, MEANT):
                names.append((low, len(n)))
                out.append([columns["at"] // BLOCK_BINS, np.broadcast_to(what, len(n)), *rows])
                return
            for block in blocks:
                names.append((low, len(n)))
                out.append([np.broadcast_to(block, len(n)), np.broadcast_to(what, len(n)), *rows])

        for low, high in zip(ends, ends[1:]):
            if kind[low] != HEAD:
                continue  # a session without bins to decode
            a, b, c = low + np.searchsorted(kind[low:high], (SAMPLE, BIN, SPIKE))
            blocks, dt, sets = np.arange(unit[low], bin_[low] + 1), t[low], mask[low]
            s, track = t[a:b], (x[a:b], y[a:b], speed[a:b])
            order = np.argsort(bin_[b:c], kind="stable")
            bins, folds, flags, means = (v[b:c][order] for v in (bin_, fold, mask, speed))

            def place(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Where a bin stands, and whether it is there."""
                if not len(bins):
                    return np.zeros(len(number), np.int64), np.zeros(len(number), bool)
                at = np.minimum(np.searchsorted(bins, number), len(bins) - 1)
                return at, bins[at] == number

            own = np.flatnonzero((mask[a:b] == 1) & fast(speed[a:b]))
            cells = cell_of(track[0][own], track[1][own])
            at, there = place(np.floor(s[own] / width))
            good = there & (cells >= 0)
            (of, cells), n = sums(folds[at[good]] if len(folds) else at[good], cells[good])
            put(low, OCCUPIED, blocks, n, fold=of, at=cells, x=dt, mask=sets)

            run, home = (flags & 1) == 1, (flags & 2) == 2
            number, units, sets_of, reps = np.floor(t[c:high] / width).astype(np.int64), unit[c:high], mask[c:high], rep[c:high]
            at, there = place(number)
            tested = there & (run[at] if len(run) else False)
            keys, n = sums(*(v[tested] for v in (reps, units, sets_of, number)))
            put(low, COUNTED, blocks, n, **dict(zip(("rep", "unit", "mask", "at"), keys)))
            if not len(s):
                continue
            meant, spikes = np.flatnonzero(run & home), np.flatnonzero(tested if held_out else np.ones(len(number), bool))
            for i, lead in enumerate(leads):
                ok, (px, py) = _at(s, track[:2], (bins[meant] + 0.5) * width + lead)
                some = meant[ok]
                put(low, MEANT, blocks, means[some], lead=i, fold=folds[some], at=bins[some], x=px[ok], y=py[ok])
                ok, (px, py, v) = _at(s, track, t[c:high][spikes] + lead)
                cells = np.where(ok & fast(v), cell_of(px, py), -1)
                some, cells = spikes[cells >= 0], cells[cells >= 0]
                keys, n = sums(reps[some], folds[at[some]] if held_out else np.zeros(len(some), np.int32), units[some], sets_of[some], cells)
                put(low, PLACED, blocks, n, lead=i, **dict(zip(("rep", "fold", "unit", "mask", "at"), keys)))

        session = table.column("session_id").take(pa.array(np.repeat([x for x, _ in names], [n for _, n in names]).astype(np.int64)))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        columns = [np.concatenate(v) for v in zip(*out)] if out else [np.zeros(0)] * len(kinds)
        return pa.table({"session_id": session} | {c: pa.array(v.astype(k.to_pandas_dtype()), k) for c, v, k in zip(list(COUNTS)[1:], columns, kinds)})

    return work


def smoother(n: int, sigma: float) -> np.ndarray:
    """The matrix of a Gaussian along an axis with mirrored edges, as `maps.gauss_smooth` has it."""
    out, weights = np.zeros((n, n)), maps.kernel(sigma) if sigma else [1.0]
    r = len(weights) // 2
    for c in range(n):
        for image in (c, -c - 1, 2 * n - 1 - c, c + 2 * n, c - 2 * n):
            for k, w in zip(range(-r, r + 1), weights):
                if 0 <= image - k < n:
                    out[image - k, c] += w
    return out


def _decoded(n_leads: int, sets: int, folds: int | None, replicates: int, width: float, nx: int, ny: int, sigma: float, least_s: float):
    """The most likely cell of a block's bins for each set of units, lead, replicate and fold, from the session's counts."""
    along_x, along_y, logs = smoother(nx, sigma), smoother(ny, sigma), 1e-3
    smooth = lambda grid: (along_x @ grid.reshape(*grid.shape[:-1], nx, ny) @ along_y.T).reshape(grid.shape)

    def summed(shape: tuple[int, ...], at: tuple[np.ndarray, ...], n: np.ndarray) -> np.ndarray:
        return np.bincount(np.ravel_multi_index(at, shape), n, int(np.prod(shape))).reshape(shape) if len(n) else np.zeros(shape)

    def work(table: pa.Table) -> pa.Table:
        ends = starts(table, ["session_id", "block"])
        kind, lead, rep, fold, unit, mask, at, n, x, y = (table.column(c).to_numpy() for c in list(COUNTS)[2:])
        out, names, trained = [], [], folds or 1
        for low, high in zip(ends, ends[1:]):
            a, b, c = low + np.searchsorted(kind[low:high], (PLACED, COUNTED, MEANT))
            if low == a or c == high:
                continue
            here = summed((trained, nx * ny), (fold[low:a], at[low:a]), n[low:a])
            here = here.sum(0) - here if folds else here
            dt, held = x[low], np.bitwise_or.reduce(mask[low:a])
            occupied = here * dt
            smooth_s = smooth(occupied)
            good = [np.flatnonzero((here[f] > 0) & (occupied[f] >= least_s)) for f in range(trained)]
            bins, of_bin = np.unique(at[c:high], return_inverse=True)
            wanted = [c + np.flatnonzero((lead[c:high] == i) & ((fold[c:high] == f) if folds else True)) for i in range(n_leads) for f in range(trained)]
            for q in range(sets):
                if not held >> q & 1:
                    continue
                mine, seen = a + np.flatnonzero(mask[a:b] >> q & 1), b + np.flatnonzero(mask[b:c] >> q & 1)
                place = np.searchsorted(bins, at[seen])
                known = place < len(bins)
                known[known] = bins[place[known]] == at[seen][known]
                seen, place = seen[known], place[known]
                units, of_unit = np.unique(unit[np.concatenate([mine, seen])], return_inverse=True)
                counts = summed((replicates, len(bins), len(units)), (rep[seen], place, of_unit[len(mine) :]), n[seen])
                for r in range(replicates):
                    of = np.flatnonzero(rep[mine] == r)
                    some = mine[of]
                    spikes = summed((n_leads, trained, len(units), nx * ny), (lead[some], fold[some], of_unit[of], at[some]), n[some])
                    spikes = smooth(spikes.sum(1, keepdims=True) - spikes if folds else spikes)
                    for k, rows in enumerate(wanted):
                        i, f = divmod(k, trained)
                        if len(good[f]) < 3 or not len(rows):
                            continue
                        s = smooth_s[f, good[f]]
                        rate = np.minimum(np.maximum(spikes[i, f][:, good[f]] / np.where(s > 0, s, 1.0), 0.0), maps.CURVE_HZ)
                        rate[:, ~(s > maps.LEAST_S)] = 0.0
                        value = np.round(counts[r, of_bin[rows - c]] @ np.log(rate + logs) - width * rate.sum(0), 9)
                        best = good[f][value.argmax(1)]
                        names.append((low, len(rows)))
                        out.append([np.broadcast_to(k, len(rows)) for k in (i, q, r)] + [at[rows], best // ny, best % ny, x[rows], y[rows], n[rows]])
        session = table.column("session_id").take(pa.array(np.repeat([x for x, _ in names], [n for _, n in names]).astype(np.int64)))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        columns = [np.concatenate(v) for v in zip(*out)] if out else [np.zeros(0)] * len(kinds)
        found = ("lead", "quality", "rep", "bin", "bx", "by", "x", "y", "speed")
        return pa.table({"session_id": session} | {c: pa.array(v.astype(k.to_pandas_dtype()), k) for c, v, k in zip(found, columns, kinds)})

    return work


def decode_cases(known: DataFrame, spikes: DataFrame, bins: DataFrame, leads: tuple[float, ...], sets: int, folds: int | None, replicates: int, width: float, nx: int, ny: int, sigma: float, least_s: float, threshold: float, cell_s: float = CELL_S) -> DataFrame:
    """(session_id, lead, quality, rep, bin, bx, by, x, y, speed): the decoded cell of each run bin and where the animal is a lead later.

    `known` has session_id, seconds, x, y, speed; `spikes` session_id, unit_id, t, rep and mask, the bits of the sets that
    count it; `bins` every tracked bin with its fold, mean speed and whether it is a run. Leads and sets are numbers in
    their order. With folds a bin is decoded with the curves of the other folds' bins, else with those of all samples.

    Two shuffles: spikes and samples go once to their cell of time, which places them for all leads, and counts of cells,
    units and bins to the blocks of bins (samples' and placed spikes' counts to each block of the session), where curves
    of all cases are smoothed and decoded. A task holds a cell of time, or a block and a session's counts by unit and cell.
    """
    rows = _cells(known, spikes, bins, maps.sample_s(known), tuple(leads), width, cell_s)
    counts = map_groups(rows, ["session_id", "cell"], ["kind", "t"], _counted(tuple(leads), width, nx, ny, threshold, folds is not None), _schema(COUNTS))
    decoded = "session_id string, lead int, quality int, rep int, bin bigint, bx int, by int, x double, y double, speed double"
    return map_groups(counts, ["session_id", "block"], ["kind"], _decoded(len(leads), sets, folds, replicates, width, nx, ny, sigma, least_s), decoded)
