"""Rosters, file inventories and the audits between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SESSION = ("rat_no", "session_date")
PHASES = ("pre", "task", "post")


def inventory(files: DataFrame) -> DataFrame:
    """Counts and bytes of each session by phase, and which phases are there."""
    per = [e for p in (*PHASES, "video") for e in (F.count_if(F.col("phase") == p).alias(f"n_{p}"), F.sum(F.when(F.col("phase") == p, F.col("size_bytes")).otherwise(0)).alias(f"{p}_bytes"))]
    phases = F.array_join(F.array_sort(F.collect_set(F.when(F.col("phase") != "video", F.col("phase")))), ",").alias("phases")
    return files.groupBy(*SESSION).agg(*per, phases, F.bool_or(F.col("phase") != "video").alias("has_ephys"))


def phase_size(files: DataFrame) -> DataFrame:
    """Bytes of a phase: of its copies on several volumes the largest, not their sum."""
    return files.groupBy(*SESSION, "phase", "volume").agg(F.sum("size_bytes").alias("b")).groupBy(*SESSION, "phase").agg(F.max("b").alias("size_bytes"))


def phase_medians(sizes: DataFrame, least: int = 3) -> DataFrame:
    """A rat's usual phase size, from at least so many sessions with some."""
    return sizes.filter("size_bytes > 0").groupBy("rat_no", "phase").agg(F.median("size_bytes").alias("median_bytes"), F.count("*").alias("n")).filter(F.col("n") >= least).drop("n")


def flag_short(sizes: DataFrame, share: float = 0.6) -> DataFrame:
    """Phases below the share of the rat's median."""
    return sizes.join(phase_medians(sizes), ["rat_no", "phase"]).filter(F.col("size_bytes") < share * F.col("median_bytes")).select(*SESSION, "phase", "size_bytes", "median_bytes")


def build_roster(trials: DataFrame) -> DataFrame:
    """Expected sessions with their number of trials and place in training order."""
    return trials.groupBy(*SESSION).agg(F.count("*").alias("trials"), F.min("row_no").alias("train_order"))


def reconcile(roster: DataFrame, found: DataFrame) -> DataFrame:
    """Each session as expected and found, not found, or an orphan."""
    a, b = roster.select(*SESSION).distinct().withColumn("__r", F.lit(1)), found.select(*SESSION).distinct().withColumn("__f", F.lit(1))
    return a.join(b, list(SESSION), "full_outer").select(*SESSION, F.when(F.col("__f").isNull(), "not-found").when(F.col("__r").isNull(), "orphan").otherwise("found").alias("status"))


def assign_by_rank(folders: DataFrame, slots: DataFrame, key: str, order_left: str, order_right: str) -> DataFrame:
    """The n-th folder of a day and the n-th session in training order; surplus on either side stays alone."""
    n = lambda df, o: df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(o)))
    return n(folders, order_left).join(n(slots, order_right), [key, "rank"], "full_outer").withColumn("verdict", F.when(F.col(order_right).isNull(), "extra").when(F.col(order_left).isNull(), "no folder").otherwise("assigned"))


def missing_phases(roster: DataFrame, files: DataFrame) -> DataFrame:
    """Expected minus present phases of sessions that have any recording."""
    have = files.filter("phase <> 'video'").select(*SESSION, "phase").distinct()
    want = have.select(*SESSION).distinct().select("*", F.explode(F.array(*map(F.lit, PHASES))).alias("phase"))
    return want.join(roster.select(*SESSION).distinct(), list(SESSION), "left_semi").join(have, [*SESSION, "phase"], "left_anti")


def evaluate_sessions(roster: DataFrame, files: DataFrame) -> DataFrame:
    """OK, PARTIAL or MISSING with reasons. Implanted rats need all phases, others a video."""
    rows = roster.join(inventory(files), list(SESSION), "left")
    n = lambda p: F.coalesce(F.col(f"n_{p}"), F.lit(0))
    implanted = F.col("implanted") == 1
    why = F.array_compact(F.array(F.when(n("video") == 0, "no video"), *[F.when(implanted & (n(p) == 0), f"no {p}") for p in PHASES]))
    any_file = sum((n(p) for p in (*PHASES, "video")), F.lit(0)) > 0
    return rows.select(*SESSION, F.when(~any_file, "MISSING").when(F.size(why) > 0, "PARTIAL").otherwise("OK").alias("verdict"), F.array_join(why, "; ").alias("reasons"))


def phase_union(files: DataFrame) -> DataFrame:
    """U4: the phases of a session over all of its copies."""
    per = files.groupBy(*SESSION, "volume").agg(F.collect_set("phase").alias("p"))
    return per.groupBy(*SESSION).agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("p")))), ",").alias("phases"))


def issues(files: DataFrame, small: int) -> DataFrame:
    """Violations of the rules, one row each."""
    inv = inventory(files)
    rules = [
        files.filter(F.col("size_bytes") < small).select(*SESSION, F.lit("small file").alias("category"), F.concat_ws("/", "volume", "phase").alias("detail")),
        files.groupBy(*SESSION, "phase").agg(F.count_distinct("volume").alias("n")).filter("n > 1").select(*SESSION, F.lit("several volumes").alias("category"), F.col("phase").alias("detail")),
        *[inv.filter((F.col(f"n_{p}") == 0) & F.col("has_ephys")).select(*SESSION, F.lit("missing phase").alias("category"), F.lit(p).alias("detail")) for p in PHASES],
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def issue_summary(found: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """How many issues of each category, in a fixed order, zeros included."""
    table = found.sparkSession.createDataFrame([(i, c) for i, c in enumerate(order)], "place int, category string")
    return found.groupBy("category").count().join(F.broadcast(table), "category", "right").select("place", "category", F.coalesce("count", F.lit(0)).alias("n"))


def prefer_copy(copies: DataFrame, *order: Column) -> DataFrame:
    """Of identical copies the one that comes first in the order."""
    return copies.withColumn("__r", F.row_number().over(Window.partitionBy(*SESSION, "phase").orderBy(*order))).filter("__r = 1").drop("__r")


def plan_consolidation(files: DataFrame, destination: str) -> DataFrame:
    """What to do with each volume's copy of a session's phase. Copies are alike if their file count and bytes are."""
    copies = files.groupBy(*SESSION, "phase", "volume").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"))
    sign = copies.withColumn("sig", F.concat_ws(":", "n", "bytes"))
    all_of = sign.groupBy(*SESSION, "phase").agg(F.count_distinct("sig").alias("sigs"), F.min("volume").alias("first"), F.bool_or(F.col("volume") == destination).alias("there"))
    action = F.when(F.col("sigs") > 1, "conflict").when(F.col("volume") == destination, "archived").when(F.col("there"), "present").when(F.col("volume") == F.col("first"), "move").otherwise("duplicate")
    return sign.join(all_of, [*SESSION, "phase"]).select(*SESSION, "phase", "volume", "n", "bytes", action.alias("action"))


def plan_totals(plan: DataFrame) -> DataFrame:
    """Entries and bytes by rat and action, with subtotals."""
    return plan.rollup("rat_no", "action").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


def canonical_name(names: DataFrame, key: str, name: str) -> DataFrame:
    """I8: the commonest name of a key, ties by name."""
    w = Window.partitionBy(key).orderBy(F.desc("n"), name)
    return names.groupBy(key, name).agg(F.count("*").alias("n")).withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def status_matrix(roster: DataFrame, files: DataFrame) -> DataFrame:
    """A status for each kind of file and the worst of them."""
    rows = roster.join(inventory(files), list(SESSION), "left")
    n = lambda p: F.coalesce(F.col(f"n_{p}"), F.lit(0))
    cell = {p: F.when(n(p) > 0, "good").when(F.col("implanted") == 1, "crit").otherwise("na") for p in PHASES} | {"video": F.when(n("video") > 0, "good").otherwise("warn")}
    every = list(cell.values())
    worst = F.when(F.array_contains(F.array(*every), "crit"), "crit").when(F.array_contains(F.array(*every), "warn"), "warn").otherwise("good")
    return rows.select(*SESSION, *[c.alias(k) for k, c in cell.items()], worst.alias("overall"))


def in_experiment(files: DataFrame, roster: DataFrame) -> DataFrame:
    """Files within a year of the roster's first and last date."""
    span = roster.agg(F.add_months(F.min("session_date"), -12).alias("a"), F.add_months(F.max("session_date"), 12).alias("b"))
    return files.join(F.broadcast(span), F.col("session_date").between(F.col("a"), F.col("b"))).drop("a", "b")


def prev_goal(sessions: DataFrame) -> DataFrame:
    """The goal of the animal's session before that had one."""
    w = Window.partitionBy("animal").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return sessions.withColumn("prev_goal", F.last("goal", ignorenulls=True).over(w))


def dominant(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The commonest value with its count; of ties the lowest."""
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n")).withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """K4, K5: rows that may be appended: those whose key is not there yet."""
    return new.join(old.select(*keys).distinct(), keys, "left_anti")


def common_keys(df: DataFrame, key: str, session: str) -> DataFrame:
    """Rows whose key every session has."""
    n = df.agg(F.count_distinct(session).alias("all"))
    every = df.groupBy(key).agg(F.count_distinct(session).alias("has")).join(F.broadcast(n), F.col("has") == F.col("all")).select(key)
    return df.join(every, key, "left_semi")
