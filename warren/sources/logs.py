"""Text sources: tracker logs, trial summaries, node sequences, sheets and clocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warren.functions.scalars import clock_seconds

FRAMES = "frame_index bigint, ts double, trial_num int, rat_x double, rat_y double, researcher_x double, researcher_y double"


def _found(value: str, pattern: str, group: int = 1):
    out = F.regexp_extract(value, pattern, group)
    return F.when(out != "", out)


def session_of_path():
    """The session is the folder that holds the file."""
    return F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frame tables; a bad number is null, hidden sidecars are not read.

    Of a session's folder the first file with frame numbers is read, else the first of full coordinates, else all files.
    """
    names = [c.split()[0] for c in FRAMES.split(", ")]
    raw = spark.read.option("header", True).schema(", ".join(f"{n} string" for n in names)).csv(path, pathGlobFilter="[!.]*.csv")
    file = F.col("_metadata.file_path").alias("__file")
    rank = F.when(F.col("__file").endswith("Coordinates_Full_with_frames.csv"), 0).when(F.col("__file").endswith("Coordinates_Full.csv"), 1).otherwise(2)
    w = Window.partitionBy(F.regexp_extract("__file", r"([^/]+)/[^/]+$", 1)).orderBy("__rank", "__file")
    listed = spark.read.format("binaryFile").load(path, pathGlobFilter="[!.]*.csv").select(file).withColumn("__rank", rank)
    chosen = listed.withColumn("__k", F.row_number().over(w)).withColumn("__best", F.min("__rank").over(w)).filter("__rank = __best and (__rank = 2 or __k = 1)")
    raw = raw.select("*", file).join(chosen, "__file", "left_semi")
    return raw.select(F.regexp_extract("__file", r"([^/]+)/[^/]+$", 1).alias("session_id"), *[F.col(n).try_cast("double").try_cast(k).alias(n) for n, k in (c.split() for c in FRAMES.split(", "))])


def read_frame_clock(spark: SparkSession, path: str) -> DataFrame:
    """Columns found by `frame` and `second` in their names; rows with a bad number are dropped.

    Names and numbers are ASCII, so one reading as Latin-1 serves UTF-8 files and others alike.
    """
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    frame = next(c for c in raw.columns if "frame" in c.lower())
    second = next(c for c in raw.columns if "second" in c.lower())
    return raw.select(session_of_path().alias("session_id"), F.col(frame).try_cast("double").try_cast("bigint").alias("frame_index"), F.col(second).try_cast("double").alias("seconds")).dropna()


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node lists without a header."""
    return spark.read.schema("node_id int, x double, y double").csv(path)


def pick_first(candidates: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """All rows of the best candidate of each key (the lowest priority number)."""
    best = candidates.groupBy(*keys).agg(F.min(priority).alias(priority))
    return candidates.join(best, [*keys, priority])


def parse_log(lines: DataFrame) -> DataFrame:
    """Level, clock, system time, position, node and event of each log line; malformed numbers are null."""
    p = r"The rat position is: \(\s*(-?[\d.]+)\s*,\s*(-?[\d.]+)\s*\) @ (\d+)"
    event = F.when(F.col("message").startswith("The rat position"), "rat_position").when(F.col("message").startswith("Video Imported"), "video_imported").when(F.col("message").startswith("Recording Trial"), "recording_start").otherwise("message")
    head = r"^(?:(\w+) : )?(?:(\d+:\d{2}:\d{2}\.\d+) )?(?:(\d+(?:\.\d+)?) : )?(.*)$"
    rows = lines.withColumn("level", _found("value", head, 1)).withColumn("clock_s", clock_seconds(_found("value", head, 2))).withColumn("system_s", _found("value", head, 3).try_cast("double")).withColumn("message", F.regexp_extract("value", head, 4))
    started = F.regexp_extract("message", r"Recording Trial (\d+)", 1).try_cast("int")
    return rows.select("session_id", "line_no", "level", "clock_s", "system_s", event.alias("event"), started.alias("started"), _found("message", p, 1).try_cast("double").alias("x"), _found("message", p, 2).try_cast("double").alias("y"), _found("message", p, 3).try_cast("int").alias("node"))


def node_sequences(lines: DataFrame) -> DataFrame:
    """The line of digits and commas right before each summary's head."""
    w = Window.partitionBy("session_id").orderBy("line_no")
    rows = lines.withColumn("before", F.lag("value").over(w)).withColumn("trial_num", _found("value", r"^Summary Trial (\d+)").cast("int"))
    return rows.filter(F.col("trial_num").isNotNull() & F.col("before").rlike(r"^[\d,\s]+$")).select("session_id", "trial_num", F.transform(F.split("before", ","), lambda x: F.trim(x).try_cast("int")).alias("path"))


def parse_trial_summary(files: DataFrame) -> DataFrame:
    """Rows `('a', 'b') (t0, t1) diff length speed` of the summary blocks of whole files (session_id, text)."""
    blocks = files.select("session_id", F.posexplode(F.split("text", r"(?m)^Summary Trial ")).alias("__block", "block")).filter("__block > 0")
    rows = blocks.select("session_id", F.regexp_extract("block", r"^(\d+)", 1).cast("int").alias("trial_num"), F.posexplode(F.split(F.regexp_replace("block", r"(?s)Trial End.*", ""), "\n")).alias("line", "value"))
    p = r"\('(\d+)', '(\d+)'\) \(([^,]+), ([^)]+)\) (\S+) (\S+) (\S+)"
    number = lambda i: _found("value", p, i).try_cast("double")
    return rows.filter(F.col("value").rlike(p)).select("session_id", "trial_num", "line", _found("value", p, 1).cast("int").alias("start_node"), _found("value", p, 2).cast("int").alias("next_node"), number(3).alias("t0"), number(4).alias("t1"), number(5).alias("diff_s"), number(6).alias("length_m"), number(7).alias("speed"))


def resolve_key(files: DataFrame, keys: DataFrame) -> DataFrame:
    """For each key the file whose bare name equals it, else ends with it, else holds it. Files are a session's."""
    bare = files.withColumn("bare", F.regexp_replace("file", r"^\d{8}_[Rr]at\d+_", ""))
    rank = F.when(F.col("bare") == F.col("key"), 0).when(F.col("bare").endswith(F.col("key")), 1).when(F.col("bare").contains(F.col("key")), 2)
    rows = bare.join(keys, "session_id").withColumn("rank", rank).filter("rank is not null")
    w = Window.partitionBy("session_id", "key").orderBy("rank", "file")
    return rows.withColumn("__r", F.row_number().over(w)).filter("__r = 1").select("session_id", "key", "file", "rank")


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every file below; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size_bytes"))


def write_frames(frames: DataFrame, path: str) -> None:
    """K1: the fixed columns that are there, in their order, by session."""
    names = ["session_id", *(c.split()[0] for c in FRAMES.split(", "))]
    frames.select(*[n for n in names if n in frames.columns]).write.mode("overwrite").partitionBy("session_id").parquet(path)
