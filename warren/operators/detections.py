"""Detections per frame: which of them is the animal, and what rejects one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.functions.scalars import overlap_share

FRAME = ["session_id", "frame_index"]
#: Fixed value: a rat box that a researcher's box covers by more than this share is being held.
HELD_SHARE = 0.1


def centre(prefix: str = "") -> tuple[Column, Column]:
    return (F.col(f"{prefix}x1") + F.col(f"{prefix}x2")) / 2, (F.col(f"{prefix}y1") + F.col(f"{prefix}y2")) / 2


def reject_held(rats: DataFrame, researchers: DataFrame, share: float = HELD_SHARE) -> DataFrame:
    """Rat boxes whose centre lies in no researcher's box of the frame, and that none covers much."""
    other = researchers.select(*FRAME, *[F.col(c).alias(f"o_{c}") for c in ("x1", "y1", "x2", "y2")])
    cx, cy = centre()
    held = (cx.between(F.col("o_x1"), F.col("o_x2")) & cy.between(F.col("o_y1"), F.col("o_y2"))) | (overlap_share("", "o_") > share)
    keys = [F.col(f"r.{k}") == F.col(f"o.{k}") for k in FRAME]
    return rats.alias("r").join(other.alias("o"), [*keys, held], "left_anti")


def best_detection(detections: DataFrame) -> DataFrame:
    """T5: the surest detection of each frame; of two as sure the one further left and up."""
    w = Window.partitionBy(*FRAME).orderBy(F.desc("conf"), "x1", "y1")
    return detections.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def nearest_in_frame(points: DataFrame, others: DataFrame) -> DataFrame:
    """For each point of a frame the nearest of the others."""
    o = others.select(*FRAME, F.col("px").alias("ox"), F.col("py").alias("oy"))
    d = points.join(o, FRAME).withColumn("distance", F.hypot(F.col("px") - F.col("ox"), F.col("py") - F.col("oy")))
    best = F.min(F.struct("distance", "ox", "oy")).alias("b")
    return d.groupBy(*FRAME, "px", "py").agg(best).select(*FRAME, "px", "py", F.col("b.distance").alias("distance"))


def in_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Whether a point lies in a polygon or on its edge, by counting crossed edges."""
    crossed, on = F.lit(0), F.lit(False)
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        on = on | ((side == 0) & x.between(min(x1, x2), max(x1, x2)) & y.between(min(y1, y2), max(y1, y2)))
        if y1 != y2:
            at = (y >= min(y1, y2)) & (y < max(y1, y2)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
            crossed = crossed + at.cast("int")
    return on | (crossed % 2 == 1)


def match_rat_config(recordings: DataFrame, configs: DataFrame) -> DataFrame:
    """The longest configured key that a recording's name starts with. Both are cut to the shortest key's length to meet."""
    n = configs.agg(F.min(F.length("key")).alias("n")).first()["n"] or 1
    rows = recordings.withColumn("__h", F.substring("name", 1, n)).join(configs.withColumn("__h", F.substring("key", 1, n)), "__h").filter(F.col("name").startswith(F.col("key")))
    return rows.groupBy("name").agg(F.max_by("key", F.length("key")).alias("key"))


def align_offset(starts: DataFrame, spans: DataFrame, candidates: DataFrame) -> DataFrame:
    """Of a session's candidate offsets the one that puts most trial starts inside its track's span, the first of ties."""
    rows = starts.join(candidates, "session_id").join(spans, "session_id")
    per = rows.groupBy("session_id", "place", "offset").agg(F.count_if((F.col("start") - F.col("offset")).between(F.col("t0"), F.col("t1"))).alias("inside"))
    w = Window.partitionBy("session_id").orderBy(F.desc("inside"), "place")
    return per.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")
