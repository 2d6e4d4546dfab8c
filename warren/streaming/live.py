"""Live positions and node visits, the same over a stream and a table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from warren.operators.detections import HELD_SHARE, in_polygon
from warren.operators.graph import node_hits

POSITION = "session_id string, frame_index bigint, x double, y double, seen boolean"
VISIT = "session_id string, node_id int, t double"


def frame_positions(detections: DataFrame, roi: list[tuple[float, float]] | None = None) -> DataFrame:
    """X11, a frame's part: the centre of its most confident rat that no researcher holds and that is inside the region.

    One aggregate by frame, so a stream needs no join; a frame without such a rat has null. Of rats as confident the
    leftmost, then the topmost, then the narrowest and the lowest box counts, whatever the order of the rows.
    """
    box = F.struct("conf", "x1", "y1", "x2", "y2")
    rows = detections.groupBy("session_id", "frame_index").agg(F.collect_list(F.when(F.col("label") == "rat", box)).alias("rats"), F.collect_list(F.when(F.col("label") == "researcher", box)).alias("people"))
    cx, cy = (lambda r: F.floor((r["x1"] + r["x2"]) / 2)), (lambda r: F.floor((r["y1"] + r["y2"]) / 2))

    def held(r, p):
        w, h = F.least(r["x2"], p["x2"]) - F.greatest(r["x1"], p["x1"]), F.least(r["y2"], p["y2"]) - F.greatest(r["y1"], p["y1"])
        share = F.try_divide(w * h, (r["x2"] - r["x1"]) * (r["y2"] - r["y1"]))
        return (cx(r).between(p["x1"], p["x2"]) & cy(r).between(p["y1"], p["y2"])) | ((w > 0) & (h > 0) & (share > HELD_SHARE))

    free = F.filter("rats", lambda r: ~F.exists("people", lambda p: held(r, p)))
    if roi:
        free = F.filter(free, lambda r: in_polygon(cx(r), cy(r), roi))
    def compare(a, b):
        out = F.when(a["conf"] > b["conf"], -1).when(a["conf"] < b["conf"], 1)
        for c in ("x1", "y1", "x2", "y2"):
            out = out.when(a[c] < b[c], -1).when(a[c] > b[c], 1)
        return out.otherwise(0)

    best = F.get(F.array_sort(free, compare), F.lit(0))
    return rows.withColumn("b", best).select("session_id", "frame_index", cx(F.col("b")).cast("double").alias("x"), cy(F.col("b")).cast("double").alias("y"))


class CarryForward(StatefulProcessor):
    """X11: the last known position of a session, kept between micro-batches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("position", "x double, y double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows)).sort_values("frame_index")
        if self.state.exists():
            x, y = self.state.get()
            part[["x", "y"]] = part[["x", "y"]].astype(float)
            known = pd.concat([pd.DataFrame({"x": [x], "y": [y]}), part[["x", "y"]]]).ffill().iloc[1:]
        else:
            known = part[["x", "y"]].astype(float).ffill()
        out = pd.DataFrame({"session_id": key[0], "frame_index": part["frame_index"].to_numpy(), "x": known["x"].to_numpy(), "y": known["y"].to_numpy(), "seen": part["x"].notna().to_numpy()})
        if len(out) and pd.notna(out["x"].iloc[-1]):
            self.state.update((float(out["x"].iloc[-1]), float(out["y"].iloc[-1])))
        yield out

    def close(self) -> None:
        pass


def live_positions(frames: DataFrame) -> DataFrame:
    """X11: positions of frames, each without one getting the last known; nothing before the first."""
    if frames.isStreaming:
        return frames.select("session_id", "frame_index", "x", "y").groupBy("session_id").transformWithStateInPandas(CarryForward(), POSITION, "Append", "none")
    w = Window.partitionBy("session_id").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(w).cast("double").alias(c)
    return frames.select("session_id", "frame_index", last("x"), last("y"), F.col("x").isNotNull().alias("seen"))


class Visits(StatefulProcessor):
    """The node a session was at last."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("node", "node int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows)).sort_values(["t", "node_id"])
        last = self.state.get()[0] if self.state.exists() else None
        fresh = part["node_id"].ne(part["node_id"].shift(fill_value=-1 if last is None else last))
        if len(part):
            self.state.update((int(part["node_id"].iloc[-1]),))
        yield pd.DataFrame({"session_id": key[0], "node_id": part["node_id"][fresh], "t": part["t"][fresh]})

    def close(self) -> None:
        pass


def node_visits(positions: DataFrame, nodes: DataFrame, radius: float = 20.0) -> DataFrame:
    """Each arrival at a node (session_id, node_id, t): hits of positions on the maze's nodes, repeats of the last node left out."""
    hits = node_hits(positions.select("session_id", "t", "x", "y"), F.broadcast(nodes), radius).select("session_id", "t", "node_id")  # one maze's nodes
    if hits.isStreaming:
        return hits.groupBy("session_id").transformWithStateInPandas(Visits(), VISIT, "Append", "none")
    before = F.lag("node_id").over(Window.partitionBy("session_id").orderBy("t", "node_id"))
    return hits.withColumn("__b", before).filter("__b is null or __b <> node_id").select("session_id", "node_id", "t")
