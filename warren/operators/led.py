"""Light patches of videos: independent components and when each is on."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.operators.stats import two_means
from warren.operators.tuning import on_axes


def _decorrelated(w: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(w @ w.T)
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-12))) @ vectors.T @ w


def rotation(z: np.ndarray, rounds: int = 200, least: float = 1e-6) -> np.ndarray:
    """The turn of white series (rows are samples) that makes them independent, by fixed points of tanh."""
    w = _decorrelated(np.eye(z.shape[1]) + 0.1 * np.arange(z.shape[1] ** 2).reshape(z.shape[1], -1) / z.shape[1] ** 2)
    for _ in range(rounds):
        g = np.tanh(z @ w.T)
        new = _decorrelated(g.T @ z / len(z) - np.diag((1 - g * g).mean(0)) @ w)
        moved = np.abs(np.abs((new * w).sum(1)) - 1).max()
        w = new
        if moved < least:
            break
    return w


def unmix(patches: DataFrame, k: int = 3) -> DataFrame:
    """L2: k independent components of a video's patch (session_id, frame_index, v), each of variance 1 and brighter with the patch.

    Pixels meet in sums of products only; a group is one video's k white series. A patch with less than k ways to
    vary, or fewer than k + 1 frames, has no components.
    """
    rows = patches.select("session_id", "frame_index", F.transform("v", lambda x: x.cast("double")).alias("z"))
    placed = on_axes(rows, k).withColumn("light", F.aggregate("z", F.lit(0.0), lambda a, b: a + b) / F.size("z")).drop("z")
    every = Window.partitionBy("session_id")
    white = placed.withColumns({f"sd{i}": F.stddev_pop(f"pc{i}").over(every) for i in range(1, k + 1)}).withColumn("n", F.count("*").over(every))
    names = [f"pc{i}" for i in range(1, k + 1)]
    varied = F.lit(True)
    for i in range(1, k + 1):
        varied = varied & F.coalesce(F.col(f"sd{i}") > 1e-9 * F.col("sd1"), F.lit(False)) & (F.col(f"sd{i}") > 0)
    white = white.filter(varied & (F.col("n") > k)).select("session_id", "frame_index", "light", *[(F.col(f"pc{i}") / F.col(f"sd{i}")).alias(f"pc{i}") for i in range(1, k + 1)])

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("frame_index")
        z = part[names].to_numpy(float)
        s = z @ rotation(z).T
        light = part["light"].to_numpy(float)
        s = s * np.where((light - light.mean()) @ s < 0, -1.0, 1.0)
        return pd.DataFrame({"session_id": part["session_id"].iloc[0], "frame_index": np.repeat(part["frame_index"].to_numpy(), k), "component": np.tile(np.arange(k), len(s)), "value": s.ravel()})

    return white.groupBy("session_id").applyInPandas(one, "session_id string, frame_index bigint, component int, value double")


def on_off(components: DataFrame) -> DataFrame:
    """L3: each frame on or off by the nearer of a component's two means, the brighter being on. A group is one video's component."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        values = part["value"].to_numpy(float)
        return part[["session_id", "frame_index", "component"]].assign(state=(values > two_means(values)).astype("int32"))

    return components.groupBy("session_id", "component").applyInPandas(one, "session_id string, frame_index bigint, component int, state int")
