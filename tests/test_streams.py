"""Streams: frames out of order, silent sessions, late rows, and logs that are being written."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_operators import MACHINE, machine
from warren.sources import tail
from warren.streaming import live, trials


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run(spark, tmp_path, batches, name, **how):
    """Feeds one file after another to the ordered state machine; the rows it gives and the query."""
    folder = str(tmp_path / "in")
    spark.createDataFrame([], MACHINE).write.parquet(folder)
    stream = spark.readStream.schema(MACHINE).option("maxFilesPerTrigger", 1).parquet(folder)
    q = trials.stream_trials(stream, **how).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for rows in batches:
            spark.createDataFrame(rows, MACHINE).coalesce(1).write.mode("append").parquet(folder)
            q.processAllAvailable()
        return sorted(map(tuple, spark.table(name).collect())), trials.late_rows(q)
    finally:
        q.stop()


def test_shuffled_frames_give_the_batch_s_trials(spark, tmp_path, rocks):
    rows = machine()
    rng = random.Random(3)
    places = sorted(range(len(rows)), key=lambda i: i + rng.uniform(0, 60))  # up to two seconds late
    shuffled = rows.iloc[places]
    last = rows.tail(1).assign(session_id="other", frame_ms=1e6)
    got, late = run(spark, tmp_path, [shuffled[:150], shuffled[150:260], shuffled[260:], last], "shuffled", delay="10 seconds", silent_ms=5_000)
    want = sorted(map(tuple, trials.batch_trials(spark.createDataFrame(rows, MACHINE)).collect()))
    assert got == want and late == 0 and {r[5] for r in got} >= {"goal"}


def test_silent_sessions_end_and_late_rows_are_counted(spark, tmp_path, rocks):
    rows = machine(kind=4)  # a trial that no frame of these ends
    other = lambda ms: rows.tail(1).assign(session_id="other", frame_ms=ms)
    got, late = run(spark, tmp_path, [rows, other(60_000.0), other(90_000.0), rows[:7], other(91_000.0)], "silent", delay="1 second", silent_ms=20_000)
    want = sorted(map(tuple, trials.batch_trials(spark.createDataFrame(rows, MACHINE)).collect()))
    assert [r for r in got if r[0] == "s"] == want and [r[5] for r in want] == ["end of frames"] and late == 7


def test_a_growing_log_is_read_line_by_line_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tail, "PART", 64)
    monkeypatch.setattr(tail, "CHUNK", 50)
    folder = tmp_path / "logs" / "20230101_Rat3"
    folder.mkdir(parents=True)
    file = folder / "a.log"
    line = lambda i: f"INFO : 0:00:0{i % 10}.000 {i}.5 : The rat position is: ({i}, {2 * i}) @ {100 + i}\n"
    whole = "".join(line(i) for i in range(30)) + "Recording Trial 7\nñandú\n"

    def step(name):
        q = tail.tail_log(spark, str(folder)).writeStream.format("memory" if name else "parquet")
        q = q.queryName(name) if name else q.option("path", str(tmp_path / "out"))
        q = q.option("checkpointLocation", str(tmp_path / (name or "c"))).trigger(availableNow=True).start()
        q.awaitTermination(60)

    for end in (300, 300, 777, 1200):  # in the middle of lines, and once without anything new
        file.write_text(whole[:end])
        step("")
    file.write_bytes(whole.encode() + b"half a line")
    step("")
    got = sorted((r["line_no"], r["event"], r["x"], r["started"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    starts = [0]
    for text in whole.splitlines(keepends=True):
        starts.append(starts[-1] + len(text.encode()))
    assert [r[0] for r in got] == starts[:-1] and [r[2] for r in got[:30]] == [float(i) for i in range(30)] and got[30][3] == 7
    assert {r["session_id"] for r in spark.read.parquet(str(tmp_path / "out")).select("session_id").collect()} == {"20230101_Rat3"}
    batch = spark.read.format("tracker_log").option("path", f"file://{folder}").load()
    assert [r["value"] for r in batch.orderBy("line_no").collect()] == [*whole.splitlines(), "half a line"]


def test_positions_and_visits_of_a_growing_log(spark, tmp_path, rocks):
    folder = tmp_path / "s1"
    folder.mkdir()
    (folder / "a.log").write_text("".join(f"{i}.0 : The rat position is: ({10 * i}, 0) @ 101\n" for i in range(8)))
    rows = tail.tail_log(spark, str(folder)).filter("event = 'rat_position'")
    frames = rows.select("session_id", F.col("line_no").alias("frame_index"), "x", "y")
    q = live.live_positions(frames).writeStream.format("memory").queryName("tailed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r["x"] for r in spark.table("tailed").collect()) == [10.0 * i for i in range(8)]
