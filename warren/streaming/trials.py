"""The trial state machine over positions: one pure step, run on streams and on tables.

A session waits, records a trial from the moment the rat is at the start node, ends it by the rules of the trial's
type, and waits between trials until a researcher is near. Times are the frames' own milliseconds.

A session may have a schedule: a trial's start lock keeps it from starting early and ends an earlier trial that is
still on, its end lock refuses every earlier end and is one itself, and minutes of the hour in which a trial is immune
suppress its ends and end it when they are over. A trial whose successor has a start lock ends by the schedule alone.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Radii in pixels and waits in milliseconds.
START_PX, GOAL_PX, LATE_GOAL_PX = 60, 25, 20
LATE_MS, PROBE_MS, PROBE_PX = 600_000, 120_000, 600
NEAR_PX, NEAR_MS, NEXT_PX = 150, 5_000, 300
LOCKOUT_TYPES = (4, 5, 6)
#: A researcher at the goal ends a trial after so many milliseconds within so many pixels.
AT_GOAL, NEAR_GOAL = (50, 10_000), (160, 30_000)
#: Fixed value: a trial with a start lock lasts so many milliseconds at least, unless the schedule ends it.
SCHEDULED_MS = 5_000

WAITING, ACTIVE, BETWEEN = "waiting", "active", "between"
OUT = "session_id string, trial_num int, trial_type int, t0 double, t1 double, reason string, reached boolean, frames bigint"


def new_state() -> dict:
    return {"phase": WAITING, "trial": 0, "t0": None, "frames": 0, "apart": False, "near_since": None, "locked_until": None, "last": None, "type": None, "seen": False, "at_goal": 0.0, "near_goal": 0.0}


def _far(a, b, c, d) -> float:
    return float("inf") if None in (a, b, c, d) else ((a - c) ** 2 + (b - d) ** 2) ** 0.5


@lru_cache(maxsize=1024)
def _plan(text: str | None) -> dict[str, dict]:
    """Start and end locks (ms) and immune minutes by the trial's number, as `schedules` writes them."""
    rows = json.loads(text) if text else {}
    pick = lambda k: {int(n): r[k] for n, r in rows.items() if r.get(k) is not None}
    return {"start": pick("start_ms"), "end": pick("end_ms"), "immune": {int(n): (r["immune_from"], r["immune_to"]) for n, r in rows.items() if r.get("immune_to") is not None}}


def step(state: dict, frame: dict) -> tuple[dict, dict | None]:
    """One frame (frame_ms, x, y, rx, ry, start_x, start_y, goal_x, goal_y, trial_type, schedule) to the new state and an ended trial."""
    s, t, plan = dict(state), frame["frame_ms"], _plan(frame.get("schedule"))
    rat = (frame["x"], frame["y"])
    person = (frame["rx"], frame["ry"])
    near, passed = _far(*rat, *person), 0.0 if s["last"] is None else t - s["last"]
    s["last"] = t
    free = s["locked_until"] is None or t >= s["locked_until"]
    if s["phase"] == BETWEEN and near <= NEXT_PX and free:
        s["phase"] = WAITING
    if s["phase"] == WAITING:
        if free and t >= plan["start"].get(s["trial"] + 1, -math.inf) and _far(*rat, frame["start_x"], frame["start_y"]) < START_PX:
            s |= {"phase": ACTIVE, "trial": s["trial"] + 1, "t0": t, "frames": 1, "apart": False, "near_since": None, "type": frame["trial_type"], "seen": False, "at_goal": 0.0, "near_goal": 0.0}
        return s, None
    if s["phase"] != ACTIVE:
        return s, None
    s["frames"] += 1
    goal, elapsed, kind = _far(*rat, frame["goal_x"], frame["goal_y"]), t - s["t0"], s["type"]
    s["apart"] = s["apart"] or near > NEAR_PX
    s["near_since"] = (s["near_since"] if s["near_since"] is not None else t) if near <= NEAR_PX and s["apart"] else None
    s["seen"] = s["seen"] or goal <= LATE_GOAL_PX
    forced = _forced(s, t, plan)
    if forced:
        ended, row = _ended(s, t, forced, False)
        # after a start lock or an interval the next trial waits for the rat alone
        return (ended if forced == "end schedule" else ended | {"phase": WAITING}), row
    if t < plan["end"].get(s["trial"], -math.inf) or s["trial"] + 1 in plan["start"]:
        return s, None
    if s["trial"] in plan["start"] and elapsed < SCHEDULED_MS:
        return s, None
    immune = _immune(s, t, plan)
    reason = None if immune else _reason(s, t, goal, near, elapsed, kind)
    if reason is None:
        reason = _researcher_at_goal(s, _far(*person, frame["goal_x"], frame["goal_y"]), passed, not immune and (kind != 3 or elapsed >= PROBE_MS))
    return _ended(s, t, reason, goal <= GOAL_PX or (kind in LOCKOUT_TYPES and s["seen"])) if reason else (s, None)


def _immune(s: dict, t: float, plan: dict) -> bool:
    span = plan["immune"].get(s["trial"])
    return span is not None and span[0] <= t / 60_000 % 60 <= span[1]


def _forced(s: dict, t: float, plan: dict) -> str | None:
    """What the schedule ends a trial for: its end lock, a later trial's start lock, or immune minutes that are over."""
    lock = plan["end"].get(s["trial"])
    if lock is not None:
        return "end schedule" if t >= lock else None
    if any(n > s["trial"] and t >= at for n, at in plan["start"].items()):
        return "start schedule"
    span = plan["immune"].get(s["trial"])
    return "interval" if span is not None and s["trial"] + 1 not in plan["start"] and t / 60_000 % 60 >= span[1] else None


def _reason(s: dict, t: float, goal: float, near: float, elapsed: float, kind) -> str | None:
    """What the trial's own rules end it for."""
    if kind == 3:
        if elapsed >= PROBE_MS and near <= PROBE_PX and goal <= GOAL_PX:
            return "probe"
    elif kind in LOCKOUT_TYPES:
        if s["seen"] and elapsed >= LATE_MS:
            return "late goal"
    elif goal <= GOAL_PX:
        return "goal"
    return "researcher" if s["near_since"] is not None and t - s["near_since"] >= (NEAR_MS if kind in (1, 2) else LATE_MS) else None


def _researcher_at_goal(s: dict, distance: float, passed: float, allowed: bool) -> str | None:
    """Time that a researcher is at the goal, kept in the state; the wide radius counts only while it is allowed."""
    s["at_goal"] = s["at_goal"] + passed if distance <= AT_GOAL[0] else 0.0
    s["near_goal"] = s["near_goal"] + passed if distance <= NEAR_GOAL[0] and allowed else 0.0
    return "researcher at goal 10s" if s["at_goal"] >= AT_GOAL[1] else "researcher at goal 30s" if s["near_goal"] >= NEAR_GOAL[1] else None


def _ended(s: dict, t: float, reason: str, reached: bool) -> tuple[dict, dict]:
    row = {"trial_num": s["trial"], "trial_type": s["type"], "t0": s["t0"], "t1": t, "reason": reason, "reached": reached, "frames": s["frames"]}
    locked = s["t0"] + LATE_MS if s["type"] in LOCKOUT_TYPES else None
    return s | {"phase": BETWEEN, "locked_until": locked, "t0": None, "near_since": None}, row


def flush(s: dict) -> dict | None:
    """What an unfinished trial amounts to when the frames end."""
    return _ended(s, s["last"], "end of frames", False)[1] if s["phase"] == ACTIVE else None


def advance(state: dict, frame: dict) -> tuple[dict, list[dict]]:
    """A step, and the end of the session where the frame is marked as its last (`ended`): an unfinished trial ends too."""
    state, row = step(state, frame)
    last = flush(state) if frame.get("ended") else None
    return new_state() if frame.get("ended") else state, [r for r in (row, last) if r]


FIELDS = ["frame_ms", "x", "y", "rx", "ry", "start_x", "start_y", "goal_x", "goal_y", "trial_type"]


def _frames(part: pd.DataFrame) -> Iterator[dict]:
    names = [*FIELDS, "schedule", "ended"]
    for r in zip(*[part[c] for c in names]):
        yield {k: None if v != v else v for k, v in zip(names, r)}


def _columns(frames: DataFrame, *more: str) -> DataFrame:
    """The columns of a frame; without a schedule there is none, without a mark of the last frame no frame is."""
    spare = {"schedule": F.lit(None).cast("string"), "ended": F.lit(False)}
    return frames.select("session_id", "frame_index", *FIELDS, *more, *[F.col(c) if c in frames.columns else v.alias(c) for c, v in spare.items()])


def schedules(meta: DataFrame) -> DataFrame:
    """The schedule of each session as text, from trials with start_ms, end_ms, immune_from and immune_to (null: none)."""
    row = F.struct(F.col("trial_num").cast("string"), F.struct("start_ms", "end_ms", "immune_from", "immune_to"))
    return meta.groupBy("session_id").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(row)))).alias("schedule"))


def _table(rows: list[tuple[str, dict]]) -> pd.DataFrame:
    return pd.DataFrame([{"session_id": key, **r} for key, r in rows], columns=[c.split()[0] for c in OUT.split(", ")])


def batch_trials(frames: DataFrame) -> DataFrame:
    """X1-X9, X15 over a table: frames stream through tasks in order of session and time; a task holds a batch and a state."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session, state = None, new_state()
        for part in batches:
            out = []
            for key, f in zip(part["session_id"], _frames(part)):
                if key != session:
                    out += [(session, r) for r in [flush(state)] if r]
                    session, state = key, new_state()
                state, rows = advance(state, f)
                out += [(key, r) for r in rows]
            if out:
                yield _table(out)
        last = flush(state)
        if last:
            yield _table([(session, last)])

    order = [F.asc("session_id"), F.asc_nulls_last("frame_ms"), F.asc_nulls_last("frame_index")]
    return _columns(frames).repartition("session_id").sortWithinPartitions(*order).mapInPandas(run, OUT)


class TrialProcessor(StatefulProcessor):
    """V5: the same step, with the session's state kept between micro-batches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("trial", "state string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = json.loads(self.state.get()[0]) if self.state.exists() else new_state()
        out = []
        for f in _frames(pd.concat(list(rows)).sort_values(["frame_ms", "frame_index"])):
            state, ended = advance(state, f)
            out += [(key[0], r) for r in ended]
        self.state.update((json.dumps(state, default=float),))
        yield _table(out)

    def close(self) -> None:
        pass


class OrderedTrialProcessor(StatefulProcessor):
    """The same step on frames in order of event time, whatever order they arrive in.

    Frames wait in a map of the session's state until the watermark has passed them, so it holds as many as the
    watermark's delay allows. An event-time timer takes them from there; another ends a session's unfinished trial when
    no frame has come for `silent_ms` of event time, and forgets the session.
    """

    def __init__(self, silent_ms: int):
        self.silent_ms = silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trial", "state string, seen_ms bigint")
        self.early = handle.getMapState("early", "at_ms bigint, frame_index bigint", "frame string")

    def _taken(self, key: tuple, until: int) -> Iterator[pd.DataFrame]:
        text, seen = self.state.get() if self.state.exists() else (None, 0)
        state, out = json.loads(text) if text else new_state(), []
        waiting = sorted(self.early.keys())
        ready = [k for k in waiting if k[0] < until]
        for k in ready:
            state, ended = advance(state, json.loads(self.early.getValue(k)[0]))
            out += [(key[0], r) for r in ended]
            self.early.removeKey(k)
            seen = max(seen, k[0])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if len(ready) < len(waiting):
            self.handle.registerTimer(waiting[len(ready)][0] + 1)
        elif seen and seen + self.silent_ms <= until:
            last = flush(state)
            out += [(key[0], last)] if last else []
            self.state.clear()
            yield _table(out)
            return
        elif seen:
            self.handle.registerTimer(seen + self.silent_ms)
        self.state.update((json.dumps(state, default=float), seen))
        yield _table(out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            at = (part["ts"].astype("int64") // {"ns": 1_000_000, "us": 1000, "ms": 1}[part["ts"].dt.unit]).tolist()
            for ms, index, f in zip(at, part["frame_index"].tolist(), _frames(part)):
                self.early.updateValue((int(ms), int(index)), (json.dumps(f, default=float),))
        yield from self._taken(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._taken(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def stream_trials(frames: DataFrame, delay: str | None = None, silent_ms: int = 60_000) -> DataFrame:
    """The state machine over a stream of frames, ended trials as they end. Needs the RocksDB state store.

    Without a delay frames count as they arrive, and a frame whose `ended` is true is its session's last (X15). With a
    delay ("10 seconds") they are put in order by `ts` (or by frame_ms as time since the epoch) behind a watermark, and
    a silent session ends by itself; frames that come later than the delay are dropped and counted (`late_rows`).
    """
    if delay is None:
        return _columns(frames).groupBy("session_id").transformWithStateInPandas(TrialProcessor(), OUT, "Append", "none")
    ts = F.col("ts") if "ts" in frames.columns else F.timestamp_millis(F.col("frame_ms").cast("bigint") + 1)  # a row at the epoch would count as late
    ordered = _columns(frames.withColumn("__ts", ts), "__ts").withColumnRenamed("__ts", "ts").withWatermark("ts", delay)
    return ordered.groupBy("session_id").transformWithStateInPandas(OrderedTrialProcessor(silent_ms), OUT, "Append", "EventTime")


def late_rows(query: StreamingQuery) -> int:
    """The rows that a query has dropped behind its watermark, by its recent progress."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def epochs(frames: DataFrame, length: str = "1 second", slide: str | None = None) -> DataFrame:
    """Counts and mean positions in windows of event time (`ts`), late frames dropped by a watermark."""
    rows = frames.withWatermark("ts", "10 seconds") if frames.isStreaming else frames
    return rows.groupBy("session_id", F.window("ts", length, slide) if slide else F.window("ts", length)).agg(F.count("*").alias("n"), F.avg("x").alias("x")).select("session_id", F.col("window.start").alias("start"), "n", "x")


def sessions(frames: DataFrame, gap: str = "5 seconds") -> DataFrame:
    """Bouts of frames without a gap."""
    rows = frames.withWatermark("ts", "10 seconds") if frames.isStreaming else frames
    return rows.groupBy("session_id", F.session_window("ts", gap)).agg(F.count("*").alias("n")).select("session_id", F.col("session_window.start").alias("start"), "n")
