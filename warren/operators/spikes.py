"""Spike trains, units and how they meet the animal's position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.operators.groups import dealt
from warren.operators.scan import block_of, scan
from warren.operators.track import finite


def within_trials(points: DataFrame, trials: DataFrame, width: float = 1.0, time: str = "t") -> DataFrame:
    """Points inside a trial's window, both ends included. Windows are dealt to time cells, so the join is by key."""
    cell = lambda c: F.floor(c / width)
    spread = trials.withColumn("__cell", F.explode(F.sequence(cell(F.col("t0")), cell(F.col("t1")))))
    return points.withColumn("__cell", cell(F.col(time))).join(spread, ["session_id", "__cell"]).filter(F.col(time).between(F.col("t0"), F.col("t1"))).drop("__cell")


def interp_at(points: DataFrame, track: DataFrame, columns=("x", "y"), lead: float = 0.0, outside: str = "null", time: str = "t", cell: float = 600.0) -> DataFrame:
    """The track's values at each point's time (plus a lead), by straight lines between samples.

    Points and samples are united and scanned over cells of time (`scan`), so no task holds a session. Samples sort
    before points of the same time. Outside of the track: null, zero, or the nearest sample ("hold").
    """
    own = points.columns
    left = points.withColumn("__t", F.col(time) + lead).withColumn("__p", F.lit(1))
    right = track.select("session_id", F.col("seconds").alias("__t"), F.lit(0).alias("__p"), *[F.col(c).alias(f"__{c}") for c in columns])
    both = left.unionByName(right, allowMissingColumns=True)
    found = {"t": F.when(F.col("__p") == 0, F.col("__t"))} | {c: F.col(f"__{c}") for c in columns}
    rows = scan(both, ["session_id"], ["__t", "__p"], block_of("__t", cell), last={f"__0{c}": of for c, of in found.items()}, next={f"__1{c}": of for c, of in found.items()})
    miss = {"null": lambda c: F.lit(None).cast("double"), "zero": lambda c: F.lit(0.0), "hold": lambda c: F.coalesce(f"__0{c}", f"__1{c}")}[outside]
    run, whole = F.col("__t") - F.col("__0t"), F.col("__1t") - F.col("__0t")
    value = lambda c: F.when(F.col("__0t") == F.col("__t"), F.col(f"__0{c}")).when(F.col("__0t").isNull() | F.col("__1t").isNull(), miss(c)).otherwise(F.col(f"__0{c}") + (F.col(f"__1{c}") - F.col(f"__0{c}")) * run / whole)
    return rows.filter("__p = 1").select(*own, *[value(c).alias(c) for c in columns])


def spike_counts(spikes: DataFrame, width: float) -> DataFrame:
    """A5: spikes of each unit in each time bin from the session's first spike on, zeros included; the last bin is closed."""
    spans = spikes.groupBy("session_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    n = F.greatest(F.ceil((F.col("t1") - F.col("t0")) / width), F.lit(1))
    grid = spikes.select("session_id", "unit_id").distinct().join(spans, "session_id").select("session_id", "unit_id", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("bin"))
    counted = spikes.join(spans, "session_id").withColumn("bin", F.least(F.floor((F.col("t") - F.col("t0")) / width), n - 1)).groupBy("session_id", "unit_id", "bin").agg(F.count("*").alias("n"))
    return grid.join(counted, ["session_id", "unit_id", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def bin_position(track: DataFrame, width: float) -> DataFrame:
    """Mean position of each time bin."""
    return track.filter("x is not null and y is not null").withColumn("bin", F.floor(F.col("seconds") / width)).groupBy("session_id", "bin").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def spike_lags(spikes: DataFrame, window: float) -> DataFrame:
    """Lags between a unit's spikes within the window, without zero; met in time cells of the window."""
    cell = F.floor(F.col("t") / window)
    a = spikes.withColumn("__cell", cell)
    b = spikes.select("session_id", "unit_id", F.col("t").alias("t2"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("__cell"))
    return a.join(b, ["session_id", "unit_id", "__cell"]).withColumn("lag", F.col("t2") - F.col("t")).filter((F.abs("lag") <= window) & (F.col("lag") != 0)).select("session_id", "unit_id", "t", "lag")


def acg(spikes: DataFrame, window: float, bins: int) -> DataFrame:
    """A unit's autocorrelogram over equal bins of [-window, window], empty bins included.

    Units stream through tasks in order of time. A sweep meets each spike with those up to a window before it, so a task
    holds a batch, the last window's spikes and one histogram, and no pair becomes a row. Spikes at one time have no lag.
    """
    kinds = dict(spikes.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for session, unit, kind, counts in histograms(batches, window, bins):
            yield pa.RecordBatch.from_arrays([pa.array([session] * bins, pa.string()), pa.array([unit] * bins, kind), pa.array(range(bins), pa.int32()), pa.array(counts)], names=["session_id", "unit_id", "bin", "n"])

    return by_unit(spikes).mapInArrow(run, f"session_id string, unit_id {kinds['unit_id']}, bin int, n bigint")


def by_unit(spikes: DataFrame) -> DataFrame:
    """Spikes with a time, each unit's in one task and in order."""
    return spikes.select("session_id", "unit_id", F.col("t").cast("double").alias("t")).filter("t is not null").transform(dealt, ["session_id", "unit_id"]).sortWithinPartitions("session_id", "unit_id", "t")


def histograms(batches: Iterator[pa.RecordBatch], window: float, bins: int) -> Iterator[tuple[str, int, pa.DataType, np.ndarray]]:
    """Session, unit, the unit's type and the autocorrelogram of each unit in a task of `by_unit`."""
    width = 2 * window / bins
    key, late, counts, kind = None, np.empty(0), np.zeros(bins, np.int64), None
    for b in batches:
        kind, times = b.column("unit_id").type, b.column("t").to_numpy(zero_copy_only=False)
        names = list(zip(b.column("session_id").to_pylist(), b.column("unit_id").to_pylist()))
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if names[low] != key:
                if key is not None:
                    yield *key, kind, counts
                key, late, counts = names[low], np.empty(0), np.zeros(bins, np.int64)
            t = np.concatenate((late, times[low:high]))
            at = np.arange(len(late), len(t))
            for back in range(1, len(t)):
                at = at[at >= back]
                lag = t[at] - t[at - back]
                at, lag = at[lag <= window], lag[lag <= window]
                if not len(at):
                    break
                for d in (lag[lag > 0], -lag[lag > 0]):
                    counts += np.bincount(np.minimum(np.floor((d + window) / width), bins - 1).astype(np.int64), minlength=bins)
            late = t[t >= t[-1] - window]
    if key is not None:
        yield *key, kind, counts


def amplitudes(spikes: DataFrame) -> DataFrame:
    """Each unit's spikes in order of time with their amplitudes."""
    w = Window.partitionBy("session_id", "unit_id").orderBy("t", "amplitude")
    return spikes.select("session_id", "unit_id", F.row_number().over(w).alias("k"), "t", "amplitude")


def firing_rate(spikes: DataFrame) -> DataFrame:
    """Spikes over the session's duration, which is its last spike's time, one second at least."""
    span = spikes.groupBy("session_id").agg(F.greatest(F.max("t"), F.lit(1.0)).alias("duration"))
    return spikes.groupBy("session_id", "unit_id").agg(F.count("*").alias("n")).join(span, "session_id").withColumn("rate", F.col("n") / F.col("duration"))


def quality_label() -> Column:
    """Noise, mua or good. A null metric fails its gate."""
    noise = (F.col("snr") > 2.5) & (F.col("num_spikes") > 100)
    mua = (F.col("isolation_distance") > 8) & (F.col("isi_violations_ratio") < 0.2)
    return F.when(~F.coalesce(noise, F.lit(False)), "noise").when(~F.coalesce(mua, F.lit(False)), "mua").otherwise("good")


def cell_type() -> Column:
    """A trough-to-peak time that is null or not finite is neither narrow nor wide."""
    t2p, tau, narrow = F.col("trough_to_peak_s"), F.col("acg_tau_rise_ms"), 0.000425
    slow = finite(t2p) & (t2p > narrow) & finite(tau) & (tau > 6)
    return F.when((F.col("firing_rate_hz") > 10) | (finite(t2p) & (t2p <= narrow)) | slow, "interneuron").otherwise("pyramidal")


def subtype() -> Column:
    """An interneuron is narrow by a finite trough-to-peak time, else wide."""
    t2p = F.col("trough_to_peak_s")
    return F.when(cell_type() == "pyramidal", "pyramidal").when(finite(t2p) & (t2p <= 0.000425), "narrow interneuron").otherwise("wide interneuron")


def resolve_label(units: DataFrame, manual: DataFrame, automatic: DataFrame) -> DataFrame:
    """Manual, else automatic, else unsorted."""
    keys = ["session_id", "unit_id"]
    return units.join(manual.withColumnRenamed("label", "m"), keys, "left").join(automatic.withColumnRenamed("label", "a"), keys, "left").withColumn("label", F.coalesce("m", "a", F.lit("unsorted"))).drop("m", "a")


def unit_counts(units: DataFrame) -> DataFrame:
    """A14."""
    return units.groupBy("session_id").agg(*[F.count_if(F.col(c) == v).alias(n) for n, c, v in (("good", "label", "good"), ("mua", "label", "mua"), ("pyramidal", "type", "pyramidal"), ("interneuron", "type", "interneuron"))])


def select_units(units: DataFrame, labels=("good",)) -> DataFrame:
    """P10."""
    return units.filter(F.col("label").isin(*labels))


def rate_rank(units: DataFrame) -> DataFrame:
    """A unit's rank by rate, the lowest 0, and its offset from 0 to 1."""
    w = Window.partitionBy("session_id").orderBy("firing_rate_hz", "unit_id")
    return units.withColumn("rank", F.row_number().over(w) - 1).withColumn("offset", F.percent_rank().over(w))


def top_units(units: DataFrame, metric: str, n: int) -> DataFrame:
    """The n units of a session with the highest metric, nulls last."""
    w = Window.partitionBy("session_id").orderBy(F.desc_nulls_last(metric), "unit_id")
    return units.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def cap_sample(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """A bounded sample of each unit's rows, the smallest by a hash of their keys."""
    w = Window.partitionBy("session_id", "unit_id").orderBy(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys])), *keys)
    return rows.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def score(df: DataFrame, a: str, b: str, keys: list[str], least: int = 5) -> DataFrame:
    """Correlation, slope and intercept of b on a; null with few rows or without variance."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)).cast("double"), F.when(both, F.col(b)).cast("double")
    # from the moments, since the built-in fits divide by the spread of every group
    sums = df.groupBy(*keys).agg(F.count_if(both).alias("n"), F.avg(x).alias("__ma"), F.avg(y).alias("__mb"), F.var_pop(x).alias("__va"), F.var_pop(y).alias("__vb"), F.covar_pop(x, y).alias("__c"))
    ok = (F.col("n") >= least) & (F.col("__va") > 0) & (F.col("__vb") > 0)
    slope = F.when(ok, F.col("__c") / F.col("__va"))
    return sums.select(*keys, "n", F.when(ok, F.col("__c") / F.sqrt(F.col("__va") * F.col("__vb"))).alias("r"), slope.alias("slope"), (F.col("__mb") - slope * F.col("__ma")).alias("intercept"))


def speed_tuning(df: DataFrame, rate: str = "rate", half: float = 0.06, step: float = 0.04, top: float = 0.6) -> DataFrame:
    """Quartiles of the rate in windows of speed about centres; a sample reaches the few centres near it."""
    low, high = F.ceil((F.col("speed") - half) / step - 1e-9), F.floor((F.col("speed") + half) / step + 1e-9)
    at = df.withColumn("__a", F.greatest(low, F.lit(0))).withColumn("__b", F.least(high, F.lit(round(top / step)))).filter("__a <= __b").withColumn("centre", F.explode(F.sequence("__a", "__b")))
    return at.groupBy("session_id", "centre").agg(*[F.percentile(rate, q).alias(f"q{int(100 * q)}") for q in (0.25, 0.5, 0.75)])


def dedupe_spikes(spikes: DataFrame, gap: float = 0.0003) -> DataFrame:
    """Drops spikes within the gap of the last one kept.

    Each choice depends on the last, so units stream through tasks in order of time; a task holds a batch and a time.
    """
    def run(batches):
        unit, last = None, -np.inf
        for rows in batches:
            keep = np.zeros(len(rows), bool)
            for i, (session, number, t) in enumerate(zip(rows["session_id"], rows["unit_id"], rows["t"])):
                now = session, None if number != number else number
                if now != unit:
                    unit, last = now, -np.inf
                if t - last > gap:
                    keep[i], last = True, t
            yield rows[keep]

    return spikes.repartition("session_id", "unit_id").sortWithinPartitions("session_id", "unit_id", "t").mapInPandas(run, spikes.schema)


def time_bins(track: DataFrame, width: float = 0.5, least: int = 10) -> DataFrame:
    """DE1: bins from the first to the last positioned sample; sessions with few bins are left out."""
    span = track.filter("x is not null").groupBy("session_id").agg(F.min("seconds").alias("a"), F.max("seconds").alias("b"))
    n = F.floor((F.col("b") - F.col("a")) / width) + 1
    return span.filter(n >= least).select("session_id", F.posexplode(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.col("a") + i * width)).alias("bin", "start"))


def assign_fold(bins: DataFrame, k: int) -> DataFrame:
    """DE2: a fold for each time bin by a hash of session and bin."""
    return bins.withColumn("fold", (F.conv(F.substring(F.md5(F.concat_ws(":", "session_id", F.col("bin").cast("string"))), 1, 8), 16, 10).cast("bigint") % k).cast("int"))


def circular_shift(spikes: DataFrame, seed: int = 0) -> DataFrame:
    """DE3: each unit's train turned by a hashed share (0.05 to 0.95) of its span."""
    w = Window.partitionBy("session_id")
    t0, span = F.min("t").over(w), F.max("t").over(w) - F.min("t").over(w)
    u = F.conv(F.substring(F.md5(F.concat_ws(":", "session_id", F.col("unit_id").cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("double") / 4294967296.0
    rows = spikes.withColumn("__t0", t0).withColumn("__span", span).withColumn("__u", 0.05 + 0.9 * u)
    return rows.withColumn("t", F.when(F.col("__span") > 0, F.col("__t0") + F.pmod(F.col("t") - F.col("__t0") + F.col("__u") * F.col("__span"), F.col("__span"))).otherwise(F.col("t"))).drop("__t0", "__span", "__u")
