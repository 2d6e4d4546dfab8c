"""Sheets, sorted spikes and overrides as tables, and the sinks of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warren.functions.scalars import first_integer

#: The colours that an override may name.
COLORS = ("blue", "red")


def pick_sheet(rows: DataFrame, book: str = "book") -> DataFrame:
    """Rows of each book's sheet `raw` in any case, else of its first sheet by `sheet_no`."""
    rank = F.struct((F.lower("sheet") != "raw").alias("other"), "sheet_no", "sheet")
    best = rows.groupBy(book).agg(F.min(rank).alias("b")).select(book, F.col("b.sheet").alias("sheet"), F.col("b.sheet_no").alias("sheet_no"))
    return rows.join(best, [book, "sheet", "sheet_no"])


def read_trial_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Books exported as folders of CSV files `<number>_<sheet>.csv` with the same columns."""
    name = lambda p, g: F.regexp_extract(F.col("_metadata.file_path"), p, g)
    file = r"([^/]+)/(\d+)_([^/]*)\.csv$"
    rows = spark.read.option("header", True).csv(path, pathGlobFilter="[!.]*.csv", recursiveFileLookup=True)
    return pick_sheet(rows.select(name(file, 1).alias("book"), name(file, 2).cast("int").alias("sheet_no"), name(file, 3).alias("sheet"), *rows.columns))


def spike_seconds(samples: DataFrame, clusters: DataFrame, rates: DataFrame) -> DataFrame:
    """Spikes in seconds by unit, from the i-th sample number, the i-th cluster and the session's sample rate."""
    rows = samples.join(clusters, ["session_id", "i"]).join(rates.select("session_id", "fs"), "session_id")
    return rows.select("session_id", F.col("cluster").cast("int").alias("unit_id"), (F.col("sample") / F.col("fs")).alias("t"))


def read_unit_table(spark: SparkSession, path: str, key: str = "cluster_id") -> DataFrame:
    """A table of units with tabs or commas; all other columns become one map, so tables may differ."""
    raw = spark.read.option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path)
    return metric_map(raw.withColumn(key, F.col(key).cast("int")), [key])


def metric_map(units: DataFrame, keys: list[str]) -> DataFrame:
    """Columns besides the keys as a map from name to text, nulls left out."""
    entries = F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("string").alias("v")) for c in units.columns if c not in keys])
    return units.select(*keys, F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())).alias("metrics"))


def _fields(lines: DataFrame) -> DataFrame:
    text = F.trim("value")
    rows = lines.filter((text != "") & ~text.startswith("#"))
    return rows.withColumn("__f", F.transform(F.split(text, ","), lambda x: F.trim(x))).withColumn("file", F.regexp_extract(F.get("__f", F.lit(0)), r"([^/\\]*)$", 1))


def crop_overrides(lines: DataFrame) -> DataFrame:
    """`file, x, y` of each line (session_id, line_no, value); malformed lines have `bad` and no numbers."""
    x, y = (F.get("__f", F.lit(i)).try_cast("double").try_cast("int") for i in (1, 2))
    good = (F.size("__f") == 3) & x.isNotNull() & y.isNotNull()
    return _fields(lines).select("session_id", "line_no", "file", F.when(good, x).alias("x"), F.when(good, y).alias("y"), (~good).alias("bad"))


def component_overrides(lines: DataFrame) -> DataFrame:
    """`file, color, component` of each line; malformed lines have `bad` and no values."""
    color, part = F.lower(F.get("__f", F.lit(1))), F.get("__f", F.lit(2)).try_cast("int")
    good = F.coalesce((F.size("__f") == 3) & color.isin(*COLORS) & part.isNotNull(), F.lit(False))
    return _fields(lines).select("session_id", "line_no", "file", F.when(good, color).alias("color"), F.when(good, part).alias("component"), (~good).alias("bad"))


def read_trials_raw(sheet: DataFrame) -> DataFrame:
    """Trials on the sheet's clock; rows without both times go, a type that is no number is -1."""
    number = lambda c: F.col(c).try_cast("double")
    rows = sheet.withColumn("start_s", number("trial_start_time")).withColumn("end_s", number("trial_end_time")).dropna(subset=["start_s", "end_s"])
    return rows.select("session_id", F.coalesce(number("Trial_Type").try_cast("int"), F.lit(-1)).alias("trial_type"), number("Goal_Node").try_cast("int").alias("goal_node"), first_integer(F.col("Start_Nodes")).alias("start_node"), "start_s", "end_s")


def replace_sessions(df: DataFrame, path: str) -> None:
    """K7: the sessions at hand replace their old partitions as the job commits; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session_id").parquet(path)


def write_clock(clock: DataFrame, path: str) -> None:
    """K2: a frame's corrected time stamp, and its seconds from the recording's creation (session_id, frame_index, corrected, created)."""
    replace_sessions(clock.select("session_id", "frame_index", F.col("corrected").alias("timestamp")), f"{path}/timestamps")
    replace_sessions(clock.select("session_id", "frame_index", (F.col("corrected") - F.col("created")).alias("seconds")), f"{path}/seconds")


def build_session_package(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> None:
    """K3: the tables of sessions (positions, keypoints, metrics, trials, scalars, field potentials), each partitioned by session.

    Field potentials end where the positions' clock does: samples after the session's last position are left out.
    """
    positions = tables.get("positions")
    for name, df in tables.items():
        if name == "lfp" and positions is not None:
            last = positions.groupBy("session_id").agg(F.max("seconds").alias("__last"))
            df = df.join(last, "session_id").filter("seconds <= __last").drop("__last")
        replace_sessions(df, f"{path}/{name}")


def write_summary(path: str, sheets: dict[str, DataFrame]) -> None:
    """K8: a CSV table with a header for each sheet."""
    for name, df in sheets.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
