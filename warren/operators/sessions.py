"""Session bookkeeping: bounds, epochs, channels, keypoints, scores, folders, names and finished steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.functions.scalars import phase
from warren.operators.spikes import score
from warren.operators.track import TRIAL, attach_clock, nest_trials

#: Names of camera folders and files, of recordings split after a crash, and of the archive's folder.
CAMERA_FOLDER, CAMERA_FILE = r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}$", r"(?i)^eye\d+.*\.mp4$"
CANONICAL_FILE = r"(?i)^eye\d+_\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}\.mp4$"
DAY, MOMENT = r"(\d{4}-\d{2}-\d{2})", r"\d{4}-\d{2}-\d{2}_(\d{2}-\d{2}-\d{2})"
ACQUIRED, PART_SUFFIX = r"\d{8}_(\d{6})", r"(?i)(_part_?\d+|part_?\d+|_\d+)$"
ARCHIVE = "HM_neurons"
#: Steps of sessions with and without an implant, what marks a step as done, steps that a later one implies, steps that leave no mark.
STEPS = {True: "1e2345678d", False: "23456d"}
MARKS = {"1": r"\.(DIO|raw)$", "e": r"\.LFP$", "4": r"_Coordinates_Full\.csv$", "5": r"_analysis_final\.pdf$", "7": r"_sorting_output$", "8": r"^LFP_Output$", "d": r"^collected_framesDLC_.*\.(h5|csv)$"}
IMPLIED_BY, UNMARKED = {"2": "4", "3": "4"}, ("6",)
#: Fixed value: channels of a tetrode.
TETRODE = 4


def clip_session(frames: DataFrame, bounds: DataFrame) -> DataFrame:
    """Frames from the session's start to its stop; a stop at or before the start is ignored, as is a null."""
    b = bounds.select("session_id", F.coalesce("start", F.lit(0.0)).alias("__start"), F.col("stop").alias("__stop"))
    open_end = F.col("__stop").isNull() | (F.col("__stop") <= F.col("__start"))
    return frames.join(b, "session_id").filter((F.col("seconds") >= F.col("__start")) & (open_end | (F.col("seconds") <= F.col("__stop")))).drop("__start", "__stop")


def unpivot_xy(df: DataFrame, keys: list[str]) -> DataFrame:
    """A row per label; `<label>_X`/`_Y` are of the maze, `<label>_x`/`_y` are keypoints."""
    names = set(df.columns)
    pairs = [(family, n[:-2], n, n[:-1] + y) for family, x, y in (("maze", "X", "Y"), ("keypoint", "x", "y")) for n in df.columns if n.endswith(f"_{x}") and n[:-1] + y in names]
    one = [F.struct(F.lit(f).alias("family"), F.lit(label).alias("label"), F.col(x).alias("x"), F.col(y).alias("y")) for f, label, x, y in pairs]
    return df.select(*keys, F.inline(F.array(*one)))


def active_trials(frames: DataFrame, clock: DataFrame) -> DataFrame:
    """The samples of each trial in order, with seconds from the clock."""
    return nest_trials(attach_clock(frames.filter("trial_num is not null"), clock))


def attach_dist(steps: DataFrame, dist: DataFrame) -> DataFrame:
    """Each step (u, v) with its distance, null where there is no way. `dist` has at most the maze's pairs of nodes."""
    return steps.join(F.broadcast(dist), ["u", "v"], "left")


def merge_keypoints(frames: DataFrame, predictions: DataFrame, index: str, *order: str) -> DataFrame:
    """The k-th frame with an index gets the k-th prediction of its session; the shorter side ends the merge."""
    values = [c for c in predictions.columns if c not in ("session_id", *order)]
    rank = lambda *by: F.row_number().over(Window.partitionBy("session_id").orderBy(*by))
    given = predictions.withColumn("__k", rank(*order)).select("session_id", "__k", *values)
    chosen = F.when(F.col(index).isNotNull(), F.row_number().over(Window.partitionBy("session_id", F.col(index).isNull()).orderBy("frame_index")))
    return frames.withColumn("__k", chosen).join(given, ["session_id", "__k"], "left").drop("__k")


def centre_keypoints(df: DataFrame, parts: list[str], reference: str = "mid_brain") -> DataFrame:
    """Keypoints relative to the reference part, which becomes zero."""
    return df.withColumns({f"{p}_{a}": F.col(f"{p}_{a}") - F.col(f"{reference}_{a}") for p in parts for a in "xy"})


def locate_nodes(trials: DataFrame, nodes: DataFrame) -> DataFrame:
    """Start and goal with coordinates, null for an unknown node. Nodes are those of one maze."""
    at = lambda end: F.broadcast(nodes.select(F.col("node_id").alias(f"{end}_node"), F.col("x").alias(f"{end}_x"), F.col("y").alias(f"{end}_y")))
    return trials.join(at("start"), "start_node", "left").join(at("goal"), "goal_node", "left")


def map_channels(columns: DataFrame, chosen: DataFrame, bad: DataFrame) -> DataFrame:
    """Signal columns of a session's chosen hardware channels if two at least are known, else all; bad ones go."""
    hardware = columns.withColumn("hw", (F.col("ntrode") - 1) * TETRODE + F.col("channel") - 1)
    marked = hardware.join(chosen.select("session_id", "hw", F.lit(True).alias("__chosen")).distinct(), ["session_id", "hw"], "left")
    known = F.count("__chosen").over(Window.partitionBy("session_id"))
    return marked.withColumn("__known", known).filter("__known < 2 or __chosen").join(bad, ["session_id", "hw"], "left_anti").select("session_id", "hw", "index")


def score_trials(trials: DataFrame) -> DataFrame:
    """ln(best / walked) by distance and by hops.

    Distance counts to the first arrival, the whole path without one; hops to the goal's first place in the path, to
    its end without one. No score without a path, or where just one of the two is zero; no hops of none are 0.
    """
    walked = F.when(F.col("arrival_index") > 0, F.col("reached_length")).otherwise(F.col("whole_length"))
    n, at = F.size("path"), F.array_position("path", F.col("goal_node"))
    hops = F.when(n > 0, F.when(at > 0, at - 1).otherwise(n - 1)).otherwise(F.lit(0))
    by = lambda best, real: F.when((best > 0) & (real > 0), F.ln(best / real))
    none = (hops == 0) & (F.col("optimal_hops") == 0)
    return trials.withColumn("distance_score", by(F.col("optimal_dist"), walked)).withColumn("hops", hops.cast("long")).withColumn("hops_score", F.when(none, 0.0).otherwise(by(F.col("optimal_hops"), hops)))


def score_regression(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Line of y on x and their correlation; null with fewer than two pairs or without spread."""
    return score(rows, x, y, keys, least=2)


def split_phases(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Phases recorded in several parts: several acquisition times, or a part's suffix (two at least)."""
    once = entries.groupBy(*keys, "name").agg(F.count("*").alias("__n"))
    # the count keeps what follows behind the aggregate, so patterns are matched once for a name
    own = once.withColumn("name", F.when(F.col("__n") > 0, F.col("name"))).filter(~F.col("name").rlike(CAMERA_FOLDER) & ~F.lower("name").endswith("_merged.rec"))
    stem = F.regexp_replace("name", r"(?i)\.rec$", "")
    taken = F.coalesce(F.nullif(F.regexp_extract("name", ACQUIRED, 1), F.lit("")), stem)
    phases = own.select(*keys, phase(stem).alias("phase"), taken.alias("taken"), stem.rlike(PART_SUFFIX).alias("part")).filter("phase is not null")
    found = phases.groupBy(*keys, "phase").agg(F.count_distinct("taken").alias("n"), F.bool_or("part").alias("forced"))
    return found.filter("n > 1 or forced").select(*keys, "phase", F.greatest("n", F.lit(2)).cast("long").alias("parts"))


def unique_count(path: Column, of) -> Column:
    """How many different values `of` has along the path."""
    return F.size(F.array_distinct(F.transform(path, of)))


def folder_listing(files: DataFrame, keys: list[str]) -> DataFrame:
    """A camera folder in one row with its files, bytes and empty files; of other folders a row per file."""
    camera = F.col("folder").rlike(CAMERA_FOLDER)
    empty = F.when(F.col("size_bytes") == 0, 1).otherwise(0)
    cameras = files.filter(camera).groupBy(*keys, "folder").agg(F.lit(None).cast("string").alias("name"), F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"), F.sum(empty).cast("long").alias("empty"))
    return cameras.unionByName(files.filter(~F.coalesce(camera, F.lit(False))).select(*keys, "folder", "name", F.lit(1).cast("long").alias("files"), F.col("size_bytes").alias("bytes"), empty.cast("long").alias("empty")))


def _found(value: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(value, pattern, 1), F.lit(""))


def camera_name(name: Column, folder: Column) -> Column:
    """the name a camera file should have; null if it has it, or without a camera number or a time."""
    both = F.regexp_like(name, F.lit(MOMENT))
    day = F.when(both | F.regexp_like(folder, F.lit(MOMENT)), F.coalesce(_found(name, f"{DAY}_\\d{{2}}-\\d{{2}}-\\d{{2}}"), _found(name, DAY), _found(folder, DAY)))
    moment = F.coalesce(_found(name, MOMENT), _found(folder, MOMENT))
    eye = _found(name, r"(?i)eye(\d+)").cast("int").cast("string")
    wanted = F.concat(F.lit("eye"), F.when(F.length(eye) < 2, F.lpad(eye, 2, "0")).otherwise(eye), F.lit("_"), day, F.lit("_"), moment, F.lit(".mp4"))
    return F.when(~name.rlike(CANONICAL_FILE) & F.lower(name).endswith(".mp4"), wanted)


def in_archive(path: Column) -> Column:
    """A part of the path names the archive, and not its preprocessing tree."""
    return F.exists(F.split(F.lower(path), "/"), lambda p: p.startswith("hm_neuron") & ~p.contains("preprocess"))


def archive_place(path: Column) -> tuple[Column, Column, Column]:
    """animal and date that a path is filed under, and the archive's folder for it."""
    rat = _found(path, r"(?i)/rat_?(\d+)/").cast("int")
    return rat, _found(path, r"/(\d{8})(?:/|$)"), F.when(in_archive(path), path).otherwise(F.concat(path, F.lit(f"/{ARCHIVE}")))


def recording_start(folder: Column) -> Column:
    """F32: the digits of a folder's time, else its name; sorts by time."""
    stamp = F.regexp_extract(folder, r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}", 0)
    return F.when(stamp != "", F.regexp_replace(stamp, r"\D", "")).otherwise(folder)


def newest_prefix(files: DataFrame, keys: list[str], kinds: tuple[str, ...] = ("container", "sorting", "folder")) -> DataFrame:
    """of a session's files the newest of the first kind that it has; of two as new the first by name."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    w = Window.partitionBy(*keys).orderBy("__rank", F.desc("modified"), "name")
    return files.withColumn("__rank", rank).filter("__rank > 0").withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__rank")


def raw_sessions(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a session has a camera file or a recording at most two levels deep (`path` is relative to it)."""
    name = F.element_at(F.split("path", "/"), -1)
    raw = (F.size(F.split("path", "/")) <= 2) & (name.rlike(CAMERA_FILE) | F.lower(name).endswith(".rec"))
    return entries.groupBy(*keys).agg(F.coalesce(F.bool_or(raw), F.lit(False)).alias("is_raw"))


def detect_steps(sessions: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """(step, status) of each step a session is due, by the names of its outputs; one shuffle, whatever the number of patterns."""
    seen = outputs.groupBy(*keys).agg(*[F.bool_or(F.col("name").rlike(p)).alias(f"__{s}") for s, p in MARKS.items()])
    has = lambda s: F.coalesce(F.col(f"__{s}"), F.lit(False))
    status = {s: F.when(has(s), "done").otherwise("missing") for s in MARKS} | {s: F.when(has(by), "implied").otherwise("missing") for s, by in IMPLIED_BY.items()} | {s: F.lit("unchecked") for s in UNMARKED}
    due = lambda steps: F.array(*[F.struct(F.lit(i).alias("position"), F.lit(s).alias("step"), status[s].alias("status")) for i, s in enumerate(steps)])
    return sessions.join(seen, keys, "left").select(*keys, F.inline(F.when(F.col("implanted"), due(STEPS[True])).otherwise(due(STEPS[False]))))


def step_text(steps: DataFrame, keys: list[str]) -> DataFrame:
    """a line with the steps done and those missing, in their order."""
    listed = steps.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("position", "step", "status"))).alias("__steps"))
    part = lambda head, *of: F.concat(F.lit(head), F.nullif(F.array_join(F.transform(F.filter("__steps", lambda x: x["status"].isin(*of)), lambda x: x["step"]), ""), F.lit("")))
    text = F.concat_ws(" · ", part("done ", "done", "implied"), part("missing ", "missing"))
    return listed.select(*keys, F.when(text == "", "—").otherwise(text).alias("text"))


def assemble_units(metrics: DataFrame, templates: DataFrame, spikes: DataFrame) -> DataFrame:
    """Units that have metrics and a template, with their spikes and rate over the session's last spike."""
    keys = ["session_id", "unit_id"]
    counts = spikes.groupBy(*keys).agg(F.count("*").alias("n"))
    length = spikes.groupBy("session_id").agg(F.max("t").alias("duration"))
    out = metrics.join(templates.select(*keys), keys, "left_semi").join(counts, keys, "left").join(length, "session_id", "left")
    return out.withColumn("n", F.coalesce("n", F.lit(0))).withColumn("rate", F.when(F.col("duration") > 0, F.col("n") / F.col("duration"))).drop("duration")


def unit_metrics(units: DataFrame, computed: DataFrame, names: list[str]) -> DataFrame:
    """A stored metric, or the computed one where it is missing."""
    keys = ["session_id", "unit_id"]
    other = computed.select(*keys, *[F.col(n).alias(f"__{n}") for n in names])
    return units.join(other, keys, "left").withColumns({n: F.coalesce(n, f"__{n}") for n in names}).drop(*[f"__{n}" for n in names])


def sync_window(levels: DataFrame, first_s: float, fps: float = 30.0, least: int = 10) -> DataFrame:
    """Frames from `first_s` on, or all of a session that would keep no more than `least`."""
    w = Window.partitionBy("session_id")
    skip = int(first_s * fps)
    ranked = levels.withColumn("__n", F.count("*").over(w)).withColumn("__i", F.row_number().over(w.orderBy("frame_index")))
    return ranked.filter((F.col("__i") > skip) | (skip >= F.col("__n") - least)).drop("__n", "__i")


def predictive_summary(errors: DataFrame, shuffles: DataFrame, least_speed: float = 0.1) -> DataFrame:
    """DE10: for each lead the median errors over moving bins, the mean and spread of the shuffles' medians, and the neural gain."""
    keys, moving = ["session_id", "lead"], F.col("speed") > least_speed
    own = errors.filter(moving).groupBy(*keys).agg(F.median("neural").alias("neural"), F.median("behaviour").alias("behaviour"))
    each = shuffles.filter(moving).groupBy(*keys, "rep").agg(F.median("neural").alias("m"))
    null = each.groupBy(*keys).agg(F.avg("m").alias("shuffle_mean"), F.stddev_pop("m").alias("shuffle_sd"))
    return own.join(null, keys, "left").withColumn("gain", F.col("neural") - F.col("behaviour"))


def richest(tracks: DataFrame, by: str = "quality") -> DataFrame:
    """Of each session the tracks of its richest set of units, the last by name."""
    return tracks.withColumn("__top", F.max(by).over(Window.partitionBy("session_id"))).filter(F.col(by) == F.col("__top")).drop("__top")


def positions(series: DataFrame, wanted: str = "Rat") -> DataFrame:
    """The wanted series of a session, else its first by name."""
    w = Window.partitionBy("session_id")
    use = F.coalesce(F.max(F.when(F.col("label") == wanted, F.col("label"))).over(w), F.min("label").over(w))
    return series.withColumn("__use", use).filter("label = __use").drop("__use")


def trial_extra(sheet: DataFrame, key: str, order: str, scalars: list[str]) -> DataFrame:
    """Rows of a sheet numbered as trials; scalars are those of the session's first row with a value."""
    w = Window.partitionBy(key).orderBy(order)
    first = lambda c: F.first(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return sheet.withColumns({"trial_num": F.row_number().over(w), **{c: first(c) for c in scalars}})


def session_identity(description: Column, folder: Column, session: Column, stem: Column) -> tuple[Column, Column, Column]:
    """Date, repeat and number of a session. The date is the folder, else the id, else eight digits of the name, else either."""
    eight = lambda c: F.when(c.rlike(r"^\d{8}$"), c)
    date = F.coalesce(eight(folder), eight(session), _found(stem, r"(\d{8})"), F.nullif(session, F.lit("")), stem)
    return date, _found(description, r"Repeat\s+(\d+)").cast("int"), _found(description, r"Session\s+(\d+)").cast("int")


def session_folders(children: DataFrame) -> DataFrame:
    """Folders that are `op*`, or a date that one of their children names."""
    dated = F.col("folder").rlike(r"^\d{8}$") & F.col("child").contains(F.col("folder"))
    return children.filter(F.lower("folder").startswith("op") | dated).select("folder").distinct()


def enrich_trial_meta(meta: DataFrame, scores: DataFrame) -> DataFrame:
    """K6: the trial sheet with the scores of its trials; where the sheet has a column already its nulls are filled."""
    new = [c for c in scores.columns if c not in TRIAL]
    joined = meta.join(scores.select(*TRIAL, *[F.col(c).alias(f"__{c}") for c in new]), list(TRIAL), "left")
    return joined.withColumns({c: F.coalesce(c, f"__{c}") if c in meta.columns else F.col(f"__{c}") for c in new}).drop(*[f"__{c}" for c in new])


def epochs(trials: DataFrame, spans: DataFrame) -> DataFrame:
    """M7: before and after a goal switch, where the session's second free-roaming trial (type 4 or 5) is of type 5; else the whole session.

    A whole session's goal is its most frequent one, of two as frequent the smaller.
    """
    nth = F.row_number().over(Window.partitionBy("session_id").orderBy("t0", "trial_num"))
    special = trials.filter("trial_type in (4, 5)").withColumn("k", nth).filter("k <= 2")
    at = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    switch = special.groupBy("session_id").agg(at(1, "goal_node").alias("g0"), at(2, "goal_node").alias("g1"), at(2, "t0").alias("s0"), at(2, "t1").alias("s1"), at(2, "trial_type").alias("type")).filter("type = 5")
    often = trials.filter("goal_node is not null").groupBy("session_id", "goal_node").count()
    goal = often.groupBy("session_id").agg(F.max_by("goal_node", F.struct("count", -F.col("goal_node"))).alias("goal"))
    epoch = lambda name, a, b, g: F.struct(F.lit(name).alias("epoch"), F.col(a).alias("start"), F.col(b).alias("stop"), F.col(g).alias("goal_node"))
    both = F.array(epoch("before", "first", "s0", "g0"), epoch("after", "s1", "last", "g1"))
    joined = spans.join(switch, "session_id", "left").join(goal, "session_id", "left")
    return joined.select("session_id", F.inline(F.when(F.col("type") == 5, both).otherwise(F.array(epoch("whole", "first", "last", "goal")))))


def meta_plan(sessions: DataFrame) -> DataFrame:
    """What becomes of a session's trial sheet, by its video folder, an earlier sheet and its usable trials."""
    rules = [(F.col("video_folder").isNull(), "no-video"), (F.col("has_sheet"), "exists"), (F.coalesce("trials", F.lit(0)) == 0, "no-trials")]
    return sessions.withColumn("action", F.coalesce(*[F.when(when, text) for when, text in rules], F.lit("write")))


def first_flag(rules: dict[str, Column]) -> Column:
    """the text of the first rule that holds."""
    return reduce(lambda rest, rule: F.when(rule[1], F.lit(rule[0])).otherwise(rest), reversed(rules.items()), F.lit(None).cast("string"))


def metric_columns(metrics: Column, names: list[str]) -> list[Column]:
    """columns of a map of metrics, null for a missing key."""
    return [F.try_element_at(metrics, F.lit(n)).alias(n) for n in names]


def merge_cameras(levels: DataFrame) -> DataFrame:
    """The intensities of a colour's cameras, summed at every time that one of them has.

    A camera's gaps are filled in a straight line over the positions of the merged times; after its last value it
    keeps that value, before its first it adds nothing.
    """
    keys = ["session_id", "color"]
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("ts"))
    times = levels.select(*keys, "ts").distinct().withColumn("i", at)
    # a colour has a handful of cameras
    grid = times.join(levels.select(*keys, "camera").distinct(), keys).join(levels, [*keys, "camera", "ts"], "left")
    w = Window.partitionBy(*keys, "camera").orderBy("i")
    known = F.when(F.col("value").isNotNull(), F.struct("i", "value"))
    near = grid.withColumn("a", F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("b", F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    share = (F.col("i") - F.col("a.i")) / F.nullif(F.col("b.i") - F.col("a.i"), F.lit(0))
    filled = F.col("a.value") + F.coalesce(share * (F.col("b.value") - F.col("a.value")), F.lit(0.0))
    return near.withColumn("filled", filled).groupBy(*keys, "ts").agg(F.coalesce(F.sum("filled"), F.lit(0.0)).alias("total"))


def reach_vectors(decoded: DataFrame, actual: DataFrame) -> DataFrame:
    """DE12: from where the animal is in a bin to where each lead decodes it."""
    here = actual.select("session_id", "bin", F.col("x").alias("from_x"), F.col("y").alias("from_y"))
    dx, dy = F.col("x") - F.col("from_x"), F.col("y") - F.col("from_y")
    return decoded.join(here, ["session_id", "bin"]).select("session_id", "lead", "bin", "from_x", "from_y", dx.alias("dx"), dy.alias("dy"), F.hypot(dx, dy).alias("reach"))
