"""Summaries over trials, units, folders and steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def segment_summary(segments: DataFrame) -> DataFrame:
    """Length, time and mean speed of a trial's segments; null where no time passes."""
    s = segments.groupBy("row_id").agg(F.sum("length_m").alias("length"), F.sum("diff_s").alias("time"), F.avg("speed").alias("mean_speed"))
    return s.withColumn("avg_speed", F.when(F.col("time") > 0, F.round(F.col("length") / F.col("time"), 3)))


def collapse_units(rows: DataFrame, unit_metrics: list[str], trial_metrics: list[str]) -> DataFrame:
    """The units' metrics averaged over a trial, the trial's own taken once."""
    return rows.groupBy("session_id", "trial_num").agg(*[F.avg(m).alias(m) for m in unit_metrics], *[F.first(m, ignorenulls=True).alias(m) for m in trial_metrics])


def pool_qualities(tables: dict[str, DataFrame], sessions: DataFrame) -> DataFrame:
    """The trial x unit tables of all quality sets in one, each row with its set and its session's identity."""
    marked = [rows.withColumn("quality", F.lit(name)) for name, rows in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked).join(sessions, "session_id", "left")


def folder_summary(files: DataFrame, key: list[str]) -> DataFrame:
    """Files, bytes and mean megabytes of each folder."""
    return files.groupBy(*key).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"), (F.avg("size_bytes") / 1e6).alias("mean_mb"), F.count_if(F.col("size_bytes") == 0).alias("empty"))


def step_status(rows: DataFrame) -> DataFrame:
    """How far each step of a session has come, the best of its copies (done, partial, missing)."""
    rank = F.when(F.col("status") == "done", 2).when(F.col("status") == "partial", 1).otherwise(0)
    best = rows.groupBy("session_id", "step").agg(F.max(rank).alias("r"))
    return best.groupBy("session_id").agg(F.count_if(F.col("r") == 2).alias("done"), F.count_if(F.col("r") == 1).alias("partial"), F.count_if(F.col("r") == 0).alias("missing"))


def pick_window(bins: DataFrame, least: int = 10, fallback: float = 60.0) -> DataFrame:
    """The trial with the most decoded bins, if it has enough, else the session's first minute."""
    per = bins.groupBy("session_id", "trial_num").agg(F.count("*").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    w = Window.partitionBy("session_id").orderBy(F.desc("n"), "trial_num")
    top = per.withColumn("r", F.row_number().over(w)).filter("r = 1")
    return top.select("session_id", F.when(F.col("n") >= least, F.col("t0")).otherwise(0.0).alias("t0"), F.when(F.col("n") >= least, F.col("t1")).otherwise(fallback).alias("t1"))


def label_order(rows: DataFrame, label: str) -> DataFrame:
    """The numbers of labels `R<n>S<m>`, to sort by."""
    return rows.withColumn("r", F.regexp_extract(label, r"R(\d+)", 1).try_cast("int")).withColumn("s", F.regexp_extract(label, r"S(\d+)", 1).try_cast("int")).orderBy("r", "s")


def order_parts(rows: DataFrame, name: str) -> DataFrame:
    """Recordings of a rat and day in order of their acquisition time, as one list."""
    at = F.regexp_extract(name, r"_(\d{6})", 1)
    return rows.groupBy("rat_no", "session_date").agg(F.transform(F.sort_array(F.collect_set(F.struct(at.alias("t"), F.col(name).alias("f")))), lambda x: x["f"]).alias("parts"))
