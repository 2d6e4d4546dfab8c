"""Population activity, waveforms and wakefulness."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.operators.maps import kernel
from warren.operators.scan import block_of, scan
from warren.operators.signals import welch
from warren.operators.spikes import spike_counts
from warren.operators.track import finite


def population_matrix(spikes: DataFrame, width: float = 0.1, smooth_s: float = 0.3) -> DataFrame:
    """Counts per bin, smoothed in time, as rates, square-rooted and z-scored per unit, in long form.

    At the ends the kernel is cut and its weights are summed anew.
    """
    weights = kernel(smooth_s / width)
    r = len(weights) // 2
    w = Window.partitionBy("session_id", "unit_id").orderBy("bin")
    total, norm = F.lit(0.0), F.lit(0.0)
    for k, x in zip(range(-r, r + 1), weights):
        v = F.lead("n", k).over(w) if k >= 0 else F.lag("n", -k).over(w)
        total, norm = total + F.coalesce(v, F.lit(0)) * x, norm + F.when(v.isNotNull(), x).otherwise(0.0)
    rows = spike_counts(spikes, width).withColumn("rate", F.sqrt(total / norm / width))
    every = Window.partitionBy("session_id", "unit_id")
    return rows.withColumn("z", (F.col("rate") - F.avg("rate").over(every)) / (F.stddev_pop("rate").over(every) + 1e-9))


def waveform_metrics(samples: DataFrame, fs: float) -> DataFrame:
    """On the channel with the largest swing (the first of equal ones), the time from the trough to the next peak and both half widths.

    `samples` has session_id, unit_id, channel, sample, value. An array holds one channel's mean waveform. A half width
    reaches from the trough (peak) to the nearest samples on either side that lack half of its depth (height). Flat,
    short, ragged or non-finite waveforms give null.
    """
    unit = ["session_id", "unit_id"]
    lost = F.sum((~finite(F.col("value").cast("double"))).cast("int"))
    values = F.transform(F.sort_array(F.collect_list(F.struct("sample", "value"))), lambda s: s["value"])
    channels = samples.groupBy(*unit, "channel").agg(values.alias("v"), F.count("*").alias("n"), lost.alias("lost"), (F.max("value") - F.min("value")).alias("swing"))
    whole = (F.sum("lost") == 0) & (F.min("n") == F.max("n")) & (F.min("n") >= 4) & (F.max("swing") > 0)
    rows = channels.groupBy(*unit).agg(F.when(whole, F.min_by("v", F.struct(-F.col("swing"), "channel"))).alias("v"))
    rows = rows.withColumn("low", F.expr("cast(array_position(v, array_min(v)) as int)")).withColumn("tail", F.expr("slice(v, low, size(v) - low + 1)"))
    rows = rows.withColumn("high", F.expr("cast(low + array_position(tail, array_max(tail)) - 1 as int)")).withColumn("trough", F.expr("v[low - 1]")).withColumn("top", F.expr("v[high - 1]"))

    def width(at: str, outside: str) -> Column:
        left = f"coalesce(array_max(transform(v, (a, i) -> if(i < {at} - 1 and {outside}, i, null))), -1)"
        right = f"coalesce(array_min(transform(v, (a, i) -> if(i > {at} - 1 and {outside}, i, null))), size(v))"
        return F.expr(f"({right} - {left} - 2) / {float(fs)}D")

    return rows.select(
        *unit,
        F.expr(f"(high - low) / {float(fs)}D").alias("trough_to_peak_s"),
        F.when(F.col("top") > 0, width("high", "a < top / 2")).alias("peak_half_width_s"),
        F.when(F.col("trough") < 0, width("low", "a > trough / 2")).alias("trough_half_width_s"),
    )


def wakefulness(rows: DataFrame, fs: float, muscle: int, field: int) -> DataFrame:
    """Per one-second epoch 0.6 z(muscle RMS) + 0.4 z(theta over delta power); a last part epoch is dropped."""
    n = int(fs)
    epochs = rows.filter(F.col("channel").isin(muscle, field)).withColumn("epoch", F.floor(F.col("sample") / n)).select("session_id", "epoch", "channel", "sample", F.col("value").cast("double").alias("value"))

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("sample")
        m, x = (part.loc[part["channel"] == c, "value"].to_numpy(float) for c in (muscle, field))
        if len(m) < n or len(x) < n:
            return pd.DataFrame([], columns=["session_id", "epoch", "rms", "ratio"])
        f, p = welch(x, fs, 1.0)
        theta, delta = p[(f >= 5) & (f <= 9)].mean(), p[(f >= 0.5) & (f <= 4)].mean()
        return pd.DataFrame([[part["session_id"].iloc[0], part["epoch"].iloc[0], float(np.sqrt((m * m).mean())), float(theta / (delta + 1e-12))]], columns=["session_id", "epoch", "rms", "ratio"])

    per = epochs.groupBy("session_id", "epoch").applyInPandas(one, "session_id string, epoch bigint, rms double, ratio double")
    w = Window.partitionBy("session_id")
    z = lambda c: (F.col(c) - F.avg(c).over(w)) / (F.stddev_pop(c).over(w) + 1e-9)
    return per.withColumn("wakefulness", 0.6 * z("rms") + 0.4 * z("ratio"))


def wakefulness_at(samples: DataFrame, epochs: DataFrame, fs: float) -> DataFrame:
    """E4, up-sampled: the epochs' values at each sample, by straight lines between the epochs' middles, held beyond them.

    Epochs are scanned by epochs, so a row for each sample takes part in a join only.
    """
    n, values = int(fs), ("wakefulness", "rms", "ratio")
    cell = F.floor(F.col("sample") / n - 0.5)  # the epoch whose middle lies before the sample
    at = samples.select("session_id", "sample").distinct().withColumn("cell", cell)
    known = epochs.select("session_id", F.col("epoch").cast("bigint").alias("cell"), F.lit(0).alias("p"), *[F.col(c).alias(f"__{c}") for c in values])
    both = at.select("session_id", "cell").distinct().withColumn("p", F.lit(1)).unionByName(known, allowMissingColumns=True)
    found = {"e": F.when(F.col("p") == 0, F.col("cell"))} | {c: F.col(f"__{c}") for c in values}
    rows = scan(both, ["session_id"], ["cell", "p"], block_of("cell", 600.0), last={f"__0{c}": of for c, of in found.items()}, next={f"__1{c}": of for c, of in found.items()})
    held = rows.filter("p = 1").select("session_id", "cell", *[f"__{i}{c}" for i in (0, 1) for c in found])
    middle = lambda c: (F.col(c) + 0.5) * n
    run, whole = F.col("sample") - middle("__0e"), middle("__1e") - middle("__0e")
    value = lambda c: F.when(run == 0, F.col(f"__0{c}")).when(F.col("__0e").isNull() | F.col("__1e").isNull(), F.coalesce(f"__0{c}", f"__1{c}")).otherwise(F.col(f"__0{c}") + (F.col(f"__1{c}") - F.col(f"__0{c}")) * run / whole)
    return at.join(held, ["session_id", "cell"]).select("session_id", "sample", *[value(c).alias(c) for c in values])
