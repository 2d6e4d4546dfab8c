"""Where recordings lie and where they should go: listings, plans of moves and renames, trial sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.functions.scalars import channel_of
from warren.operators.base import checkpointed
from warren.operators.catalog import PHASES, flag_short, phase_size
from warren.operators.sessions import CANONICAL_FILE, camera_name, recording_start

DAY = ["rat_no", "session_date"]


def list_recordings(files: DataFrame, keys: list[str]) -> DataFrame:
    """Data files of each recording in order of its name, and in a recording by tetrode and channel.

    A recording is a folder `*.LFP`; keys without one have their flat files, as one recording. Time stamps are left
    out. `files` has `folder` (null for flat) and `name`.
    """
    data = files.filter(F.lower("name").endswith(".dat") & ~F.lower("name").contains("timestamps"))
    own = data.filter(F.col("folder").endswith(".LFP")).withColumn("recording", F.regexp_replace("folder", r"\.LFP$", ""))
    flat = data.filter(F.col("folder").isNull() & F.col("name").contains("LFP")).join(own.select(*keys).distinct(), keys, "left_anti").withColumn("recording", F.lit(None).cast("string"))
    tetrode, channel = channel_of(F.col("name"))
    w = Window.partitionBy(*keys).orderBy(recording_start(F.col("recording")), "recording", tetrode, channel, "name")
    rows = own.unionByName(flat)
    return rows.withColumn("place", F.row_number().over(w)).withColumn("recording_no", F.dense_rank().over(Window.partitionBy(*keys).orderBy(recording_start(F.col("recording")), "recording")))


def list_sessions(files: DataFrame, keys: list[str], kinds: tuple[str, ...] = ("log", "txt", "csv")) -> DataFrame:
    """Visible files of the kinds, by kind and stem; two files of one stem are an error."""
    stem, kind = F.regexp_extract("name", r"^(.*)\.[^.]*$", 1), F.regexp_extract("name", r"\.([^.]*)$", 1)
    shown = files.filter(~F.col("name").startswith(".")).select(*keys, kind.alias("kind"), stem.alias("stem"), "name").filter(F.col("kind").isin(*kinds))
    each = shown.groupBy(*keys, "kind", "stem").agg(F.min("name").alias("name"), F.count("*").alias("n"))
    ambiguous = F.raise_error(F.concat(F.lit("ambiguous key: "), F.col("stem"))).cast("string")
    return each.withColumn("name", F.when(F.col("n") > 1, ambiguous).otherwise(F.col("name"))).drop("n")


def scatter_report(roster: DataFrame, files: DataFrame, selected: list[str], videos: DataFrame | None = None) -> DataFrame:
    """I4: sessions that lie outside of the selected volumes, that were not found, and orphans within a year of the roster.

    A session on several volumes is split where none of them has all of its phases; phases below the rat's usual
    size are short. `videos` (rat_no, session_date) has sessions whose video alone turned up; of animals without an
    implant such a session is whole, so it has no row.
    """
    volume = files.groupBy(*DAY, "volume").agg(F.collect_set("phase").alias("p"))
    hits = volume.groupBy(*DAY).agg(
        F.array_join(F.sort_array(F.collect_set("volume")), ",").alias("volumes"), F.bool_or(F.col("volume").isin(*selected)).alias("here"),
        F.array_distinct(F.flatten(F.collect_list("p"))).alias("present"), F.max(F.size("p")).alias("most"),
    )
    short = flag_short(phase_size(files)).groupBy(*DAY).agg(F.array_join(F.sort_array(F.collect_set("phase")), ",").alias("short"))
    seen = (videos.select(*DAY) if videos is not None else roster.select(*DAY).limit(0)).distinct().withColumn("video_found", F.lit(True))
    span = roster.agg(F.add_months(F.min("session_date"), -12).alias("__a"), F.add_months(F.max("session_date"), 12).alias("__b"))
    asked = roster.select(*DAY, "implanted").distinct().withColumn("__asked", F.lit(True))
    rows = asked.join(hits, DAY, "full_outer").join(short, DAY, "left").join(seen, DAY, "left")
    animals = roster.select("rat_no", F.lit(True).alias("__known")).distinct()
    rows = rows.join(animals, "rat_no", "left").join(F.broadcast(span))  # one row
    kind = (
        F.when(F.col("__asked").isNull(), F.when(F.col("__known") & F.col("session_date").between(F.col("__a"), F.col("__b")), "orphan"))
        .when(F.col("present").isNull(), F.when(F.col("video_found") & (F.col("implanted") == 0), None).otherwise("not-found"))
        .when(~F.col("here"), "elsewhere")
    )
    missing = F.array_join(F.filter(F.array(*map(F.lit, PHASES)), lambda p: ~F.coalesce(F.array_contains("present", p), F.lit(False))), "+")
    text = F.concat_ws(" · ", F.when(F.col("split"), "split"), F.concat(F.lit("short "), "short"), F.concat(F.lit("missing "), F.nullif("missing", F.lit(""))), F.when(F.col("video_found") & F.col("present").isNull(), "video found"))
    return (
        rows.withColumn("kind", kind).filter("kind is not null").withColumn("missing", F.when(F.col("implanted") == 1, missing).otherwise(""))
        .withColumn("split", F.coalesce(F.size("present") > F.col("most"), F.lit(False))).select("kind", *DAY, "volumes", "split", "short", "missing", text.alias("detail"))
    )


def assign_videos(folders: DataFrame, roster: DataFrame) -> DataFrame:
    """The n-th camera folder of a day goes to the n-th session in training order.

    `folders` has path, session_date, start, aborted, is_filed, filed_rat, filed_date. A filed folder is assigned
    anew. False starts and days more than a year off take no slot, and are listed if they are not filed. A day with
    nothing to do has no rows. Folders without a date count as off.
    """
    span = roster.agg(F.add_months(F.min("session_date"), -12).alias("__a"), F.add_months(F.max("session_date"), 12).alias("__b"))
    near = F.coalesce(F.col("session_date").between(F.col("__a"), F.col("__b")), F.col("__a").isNull())
    all_of = folders.join(F.broadcast(span)).withColumn("__near", near).drop("__a", "__b")  # one row
    out = all_of.filter(~F.col("is_filed") & (F.col("aborted") | ~F.col("__near")))
    out = out.select("path", "session_date", "start", F.lit(None).cast("int").alias("rat_no"), F.when(F.col("aborted"), "aborted").otherwise("other batch").alias("status"))
    day = Window.partitionBy("session_date")
    mine = all_of.filter(~F.col("aborted") & F.col("__near")).withColumn("__n", F.row_number().over(day.orderBy(F.coalesce("start", F.lit("")), "path")))
    slots = roster.withColumn("__n", F.row_number().over(day.orderBy("train_order", "rat_no"))).select("session_date", "__n", F.col("rat_no").cast("int").alias("rat_no"))
    right = (F.col("filed_rat") == F.col("rat_no")) & (F.col("filed_date") == F.col("session_date"))
    status = F.when(F.col("rat_no").isNull(), "extra").when(~F.col("is_filed"), "fills").when(F.coalesce(right, F.lit(False)), "filed").otherwise("refile")
    given = mine.join(slots, ["session_date", "__n"], "left").withColumn("status", status)
    acted = given.withColumn("__todo", F.bool_or(F.col("status") != "filed").over(day)).filter("__todo")
    return out.unionByName(acted.select("path", "session_date", "start", "rat_no", "status"))


def plan_renames(files: DataFrame) -> DataFrame:
    """Renames of a folder's camera files (folder, name) to their right names.

    Of files that want one name the first takes it, if it is free; a re-encoded file (`fixed`) may take it from the
    broken original, which is set aside as `.broken` unless there is one already. Others are conflicts. Each file is
    read once, and only different ones are kept.
    """
    files = checkpointed(files.select("folder", "name").distinct())
    want = camera_name(F.col("name"), F.col("folder"))
    odd = files.filter(~F.col("name").rlike(CANONICAL_FILE)).withColumn("wanted", want)
    unknown = odd.filter(F.col("wanted").isNull() & F.col("name").rlike(r"(?i)eye\d+.*\.mp4$")).select("folder", "name", F.lit(None).cast("string").alias("new"), F.lit("unknown").alias("action"))
    there = files.select("folder", F.col("name").alias("wanted"), F.lit(True).alias("taken"))
    aside = files.filter(F.col("name").endswith(".broken")).select("folder", F.regexp_replace("name", r"\.broken$", "").alias("wanted"), F.lit(True).alias("stashed"))
    rows = odd.filter("wanted is not null").join(there, ["folder", "wanted"], "left").join(aside, ["folder", "wanted"], "left")
    may = F.col("taken").isNull() | (F.col("name").rlike("(?i)fixed") & F.col("stashed").isNull())
    first = F.row_number().over(Window.partitionBy("folder", "wanted", "may").orderBy("name"))
    rows = rows.withColumn("may", may).withColumn("__n", first)
    wins = F.col("may") & (F.col("__n") == 1)
    set_aside = rows.filter(wins & F.col("taken")).select("folder", F.col("wanted").alias("name"), F.concat("wanted", F.lit(".broken")).alias("new"), F.lit("broken").alias("action"))
    return rows.select("folder", "name", F.col("wanted").alias("new"), F.when(wins, "rename").otherwise("conflict").alias("action")).unionByName(set_aside).unionByName(unknown)


def plan_reset(folders: DataFrame) -> DataFrame:
    """Moves of camera folders (root, path, name, in_raw, writable, signature) to their root's raw folder.

    Of folders of one name the first by path moves if raw has none; the rest are duplicates where the signature is
    that of the one in raw, or of the one that moves there, else conflicts. An unknown signature is like none.
    """
    key = ["root", "name"]
    raw = folders.filter("in_raw").groupBy(*key).agg(F.min_by("signature", "path").alias("__raw"), F.lit(True).alias("__there"))
    rows = folders.join(raw, key, "left")
    group = Window.partitionBy(*key, F.col("in_raw") | ~F.col("writable")).orderBy("path")
    rows = rows.withColumn("__n", F.row_number().over(group)).withColumn("__first", F.first(F.struct("signature")).over(group)["signature"])
    other = F.when(F.col("__there"), F.col("__raw")).otherwise(F.col("__first"))
    action = F.when(F.col("in_raw"), "skip-in-raw").when(~F.col("writable"), "blocked").when(F.col("__there").isNull() & (F.col("__n") == 1), "move").when(F.col("signature") == other, "duplicate").otherwise("conflict")
    return rows.select("root", "path", "name", action.alias("action"))


def build_trial_meta(raw: DataFrame) -> DataFrame:
    """The trial sheet of every session from the raw one: trials with a start node, session values in the first row.

    `raw` has subject, day, session, trial, date, repeat, start_node_n, goal_node_n, trial_type. The previous goal is
    the commonest goal (of ties the lowest) of the animal's last session before that had one; a null type is 1.
    """
    key = ["subject", "day", "session"]
    often = raw.filter("goal_node_n is not null").groupBy(*key, "goal_node_n").count().groupBy(*key).agg(F.max_by("goal_node_n", F.struct("count", -F.col("goal_node_n"))).alias("__goal"))
    before = Window.partitionBy("subject").orderBy("day", "session").rowsBetween(Window.unboundedPreceding, -1)
    previous = raw.select(*key).distinct().join(often, key, "left").withColumn("prev_goal_node", F.last("__goal", ignorenulls=True).over(before)).drop("__goal")
    w = Window.partitionBy(*key)
    inside = w.orderBy("trial")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = raw.filter("start_node_n is not null").join(previous, key).withColumn("trial_num", F.row_number().over(inside)).withColumn("num_trials", F.count("*").over(w))
    rows = rows.withColumns({c: F.first(c, ignorenulls=True).over(whole) for c in ("date", "repeat")})
    head = lambda c: F.when(F.col("trial_num") == 1, F.col(c)).alias(c)
    return rows.select(*key, "trial_num", *[head(c) for c in ("date", "repeat", "prev_goal_node", "num_trials")], "goal_node_n", "start_node_n", F.coalesce("trial_type", F.lit(1)).alias("trial_type"), F.when(F.col("trial_num") == 1, 1).alias("start_at_trial_num"))
