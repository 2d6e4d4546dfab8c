"""Statistics over groups, and the normalisations that go with them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_tail(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if not 0 < x < 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_tail(b, a, 1 - x)
    c, d, f = 1.0, 0.0, 1.0
    for i in range(400):
        m = i // 2
        if i == 0:
            k = 1.0
        elif i % 2 == 0:
            k = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            k = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + k * d or 1e-300)
        c = 1 + k / c or 1e-300
        f *= c * d
        if abs(1 - c * d) < 1e-12:
            break
    return math.exp(a * math.log(x) + b * math.log(1 - x) - math.log(a) - math.lgamma(a) - math.lgamma(b) + math.lgamma(a + b)) * (f - 1.0)


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """V1: the probability of a larger F."""
    return pd.Series([None if pd.isna(x) or not b > 0 or not a > 0 else _beta_tail(b / 2, a / 2, b / (b + a * x)) for x, a, b in zip(f, d1, d2)], dtype="float64")


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    """V1: the two-sided probability of a larger t."""
    return pd.Series([None if pd.isna(x) or pd.isna(d) or not d > 0 else _beta_tail(d / 2, 0.5, d / (d + x * x)) for x, d in zip(t, df)], dtype="float64")


def moments(df: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """Count, mean and variance of the finite values of each group."""
    good = df.filter(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
    return good.groupBy(*keys, group).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))


def anova(df: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """One-way analysis of variance over groups of at least two values."""
    g = moments(df, keys, group, value).filter("n >= 2")
    w = Window.partitionBy(*keys)
    g = g.withColumn("grand", F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w))
    out = g.groupBy(*keys).agg(F.count("*").alias("k"), F.sum("n").alias("total"), F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"), F.sum((F.col("n") - 1) * F.col("var")).alias("within")).filter("k >= 2")
    f = F.try_divide(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("total") - F.col("k")))
    return out.withColumn("f", f).withColumn("p", f_tail("f", (F.col("k") - 1).cast("double"), (F.col("total") - F.col("k")).cast("double"))).select(*keys, "k", "total", "f", "p")


def welch_pairs(df: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """Welch's t for each pair of groups."""
    m = moments(df, keys, group, value).filter("n >= 2")
    a, b = (m.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in (group, "n", "mean", "var")]) for s in "ab")
    pairs = a.join(b, keys).filter(F.col(f"{group}_a") < F.col(f"{group}_b")).withColumn("va", F.col("var_a") / F.col("n_a")).withColumn("vb", F.col("var_b") / F.col("n_b"))
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(F.col("va") + F.col("vb")))
    dof = F.try_divide(F.pow(F.col("va") + F.col("vb"), 2), F.col("va") * F.col("va") / (F.col("n_a") - 1) + F.col("vb") * F.col("vb") / (F.col("n_b") - 1))
    return pairs.withColumn("t", t).withColumn("df", dof).withColumn("p", t_tail("t", "df")).select(*keys, f"{group}_a", f"{group}_b", "t", "df", "p")


def holm(df: DataFrame, keys: list[str], p: str = "p", *ties: str) -> DataFrame:
    """Step-down adjusted probabilities, capped at 1, and a mark below 0.05."""
    w = Window.partitionBy(*keys).orderBy(p, *ties)
    raw = (F.count("*").over(Window.partitionBy(*keys)) - F.row_number().over(w) + 1) * F.col(p)
    rows = df.withColumn("__h", raw)
    return rows.withColumn("p_holm", F.least(F.lit(1.0), F.max("__h").over(w.rowsBetween(Window.unboundedPreceding, 0)))).withColumn("mark", F.when(F.col("p_holm") < 0.05, "*").otherwise("")).drop("__h")


def zscore(df: DataFrame, keys: list[str], value: str, guard: str = "one") -> DataFrame:
    """Population z-scores. Without variance the deviation counts as 1, or all get 1e-9 on top."""
    w = Window.partitionBy(*keys)
    sd = F.stddev_pop(value).over(w)
    return df.withColumn("z", (F.col(value) - F.avg(value).over(w)) / (F.when(sd == 0, 1.0).otherwise(sd) if guard == "one" else sd + 1e-9))


def minmax(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """W20."""
    w = Window.partitionBy(*keys)
    low = F.min(value).over(w)
    return df.withColumn("scaled", (F.col(value) - low) / (F.max(value).over(w) - low + 1e-12))


def concat_offsets(df: DataFrame, keys: list[str], order: str, n: str) -> DataFrame:
    """Where each recording starts when they are joined in order."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(n).over(w), F.lit(0)))


def metric_hist(df: DataFrame, metrics: list[str], bins: int = 30) -> DataFrame:
    """Histograms of several metrics in one pass, each over its own range."""
    long = df.select("unit_id", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("r")).select("unit_id", "r.*").filter("value is not null")
    span = long.groupBy("metric").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    at = F.when(F.col("b") > F.col("a"), F.least(F.floor((F.col("value") - F.col("a")) / (F.col("b") - F.col("a")) * bins), F.lit(bins - 1))).otherwise(0)
    return long.join(F.broadcast(span), "metric").withColumn("bin", at.cast("int")).groupBy("metric", "bin").agg(F.count("*").alias("n"))


def type_groups(df: DataFrame, metric: str) -> DataFrame:
    """Goal against free trials (types 4 and 5 are free, all else counts as goal)."""
    return df.withColumn("group", F.when(F.col("trial_type").isin(4, 5), "free").otherwise("goal")).groupBy("session_id", "group").agg(F.count("*").alias("n"), *[F.percentile(metric, q).alias(f"q{int(100 * q)}") for q in (0.25, 0.5, 0.75)])


def two_means(values: np.ndarray, rounds: int = 50) -> float:
    """The cut between the two means of a series."""
    low, high = float(values.min()), float(values.max())
    for _ in range(rounds):
        cut = (low + high) / 2
        a, b = values[values <= cut], values[values > cut]
        if not len(a) or not len(b) or (a.mean(), b.mean()) == (low, high):
            break
        low, high = float(a.mean()), float(b.mean())
    return (low + high) / 2
