"""Sessions of an animal in order: summary rows, statistics over them, output columns, and checks of a region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warren.operators.graph import ISLAND
from warren.operators.stats import anova, holm, welch_pairs

SESSION = ["animal", "date"]
#: Lengths in centimetres of a step on an island and of each bridge.
ISLAND_CM, BRIDGES_CM = 30, ((124, 201, 60), (121, 302, 172), (223, 404, 169), (324, 401, 60), (220, 305, 60))
#: Output columns in their order, and those that are made empty when they are not there.
OUTPUT = (
    "distance_start_goal_island", "distance_start_goal_nodes", "path_length_start_goal_island_island_hit", "path_length_start_goal_island_node_hit",
    "path_length_start_goal_nodes_node_hit", "norm_path_length_start_goal_island_island_hit", "norm_path_length_start_goal_island_node_hit",
    "norm_path_length_start_goal_nodes_node_hit", "Diff_Lat_reach_eat", "goal_island_i_e", "start_island_i_e", "shortest_path", "n_nodes_visited",
    "food_reached", "dist_tra", "dt_rel_sp", "dt_min_sp", "dir_run_mat_perf", "dir_run_mat_lat", "node_choices_binary", "perc_correct_choices", "drug",
    "number_times_drug_infused", "lg-DT_REL_SP", "lg10-DT_REL_SP", "isl_node_in", "isl_short_path", "isl_dt_trav", "perf_in_island", "lg_perf_I",
    "Project", "Training_order", "Implant", "Number_of_goal_locations", "flag",
)


def template_edges(spark: SparkSession) -> DataFrame:
    """The template's edges with their lengths, one direction each."""
    rows = [(100 * i + u, 100 * i + v, ISLAND_CM) for i in range(1, 5) for u, v in ISLAND] + list(BRIDGES_CM)
    return spark.createDataFrame(rows, "u int, v int, w int")


def arrange_columns(df: DataFrame, aliases: dict[str, str] | None = None, before: str = "comment") -> DataFrame:
    """Input columns up to `before`, then the output columns in their order, empty where nothing computed them.

    `aliases` names output columns after columns that hold their values.
    """
    inputs = [c for c in df.columns if c not in OUTPUT and c not in (aliases or {})]
    own = inputs[: inputs.index(before) + 1] if before in inputs else inputs
    value = {**{c: F.col(f"`{c}`") for c in df.columns}, **{to: F.col(f"`{c}`") for c, to in (aliases or {}).items() if c in df.columns}}
    return df.select(*[F.col(f"`{c}`") for c in own], *[value.get(c, F.lit(None).cast("string")).alias(c) for c in OUTPUT])


def assert_roi(vertices: DataFrame, width: int, height: int) -> DataFrame:
    """The corners of each region (roi, x, y, drawn_w, drawn_h), or an error if they are not of this frame.

    Regions of fewer than three corners are left out. A region without a drawn size is checked by its corners alone.
    """
    wrong = lambda when, text: F.when(when, F.raise_error(F.concat(F.lit(text), F.col("roi").cast("string"))).cast("boolean"))
    box = vertices.groupBy("roi").agg(F.count("*").alias("n"), F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"), F.max("drawn_w").alias("w"), F.max("drawn_h").alias("h")).filter("n >= 3")
    size = F.coalesce((F.col("w") != width) | (F.col("h") != height), F.lit(False))
    outside = (F.col("x0") < 0) | (F.col("y0") < 0) | (F.col("x1") >= width) | (F.col("y1") >= height)
    good = box.filter(F.coalesce(wrong(size, "drawn in another size: "), wrong(outside, "corners outside of the frame: "), F.lit(True)))
    return vertices.join(good.select("roi", "n"), "roi")


def collect_sessions(units: DataFrame, decoded: DataFrame, epochs: DataFrame, leads: list[float], qualities: list[str], metrics: list[str]) -> DataFrame:
    """A row per session: its units, the median decoding error of each set and lead, and mean place metrics.

    `units` has label and cell type; `decoded` has quality, lead, median_err; `epochs` a unit's metrics with its epoch.
    Metrics of the epochs "whole" and "before" are one column, those of "after" another (`<metric>_post`).
    """
    good = F.col("label") == "good"
    counts = units.groupBy(*SESSION).agg(F.count_if(good).alias("n_good"), F.count_if(F.col("label") == "mua").alias("n_mua"), F.count_if(good & (F.col("cell_type") == "pyramidal")).alias("n_pyr"), F.count_if(good & (F.col("cell_type") == "interneuron")).alias("n_int"))
    errors = decoded.groupBy(*SESSION).agg(*[F.max(F.when((F.col("quality") == q) & (F.col("lead") == x), F.col("median_err"))).alias(f"dec_{q}_{x:g}s") for q in qualities for x in leads])
    after = F.col("epoch") == "after"
    means = epochs.groupBy(*SESSION).agg(F.bool_or(after).alias("split"), *[e for m in metrics for e in (F.avg(F.when(~after, F.col(m))).alias(m), F.avg(F.when(after, F.col(m))).alias(f"{m}_post"))])
    out = counts.join(errors, SESSION, "full_outer").join(means, SESSION, "full_outer")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_good", "n_mua", "n_pyr", "n_int")}).withColumn("split", F.coalesce("split", F.lit(False)))


def animal_series(sessions: DataFrame) -> DataFrame:
    """C11: an animal's sessions numbered by date, with their labels `R<repeat>S<session>` (`?` for unknown numbers)."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?"))
    w = Window.partitionBy("animal").orderBy("date", F.asc_nulls_last("session"))
    return sessions.withColumn("place", F.row_number().over(w)).withColumn("session_label", F.concat(F.lit("R"), number("repeat"), F.lit("S"), number("session")))


def _scopes(units: DataFrame, metrics: list[str]) -> DataFrame:
    long = units.select("animal", F.col("date").cast("string").alias("date"), "session_label", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    own = long.select(F.col("animal").alias("scope"), "metric", F.col("date").alias("grp"), "value")
    return own.unionByName(long.select(F.lit("ALL").alias("scope"), "metric", F.col("session_label").alias("grp"), "value")).filter("grp is not null")


def stats_tables(units: DataFrame, metrics: list[str]) -> tuple[DataFrame, DataFrame]:
    """Variance analysis and pairwise tests of each metric, by date for each animal and by session label over all (scope ALL)."""
    rows = _scopes(units, metrics)
    keys = ["scope", "metric"]
    return anova(rows, keys, "grp", "value"), holm(welch_pairs(rows, keys, "grp", "value"), keys, "p", "grp_a", "grp_b")
