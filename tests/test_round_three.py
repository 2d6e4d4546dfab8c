"""What the third round's findings were about, on small cases."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from warren.functions import scalars
from warren.operators import groups, maps, signals, tuning
from warren.streaming import live


def test_headings_next_to_a_diagonal(spark):
    pairs = [(0.30000000000000004, -0.2999999999999998), (-0.30000000000000004, -0.30000000000000016), (-0.2999999999999999, -0.3)]
    pairs += [(0.3 * math.sin(k * math.pi / 4) + e, 0.3 * math.cos(k * math.pi / 4) - f) for k in range(-4, 5) for e in (0, 5.6e-17, -2.3e-16) for f in (0, 1.2e-16, -5.6e-17)]
    pairs += [(0.0, 0.0), (0.0, -1.0), (2.0, 0.5), (-1e-300, 3.0), (math.inf, 1.0)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pairs)], "i int, y double, x double")
    got = [r["h"] for r in df.select("i", scalars.heading_bin(F.col("x"), F.col("y")).alias("h")).orderBy("i").collect()]
    assert got == [min(math.floor((math.atan2(y, x) + math.pi) / (2 * math.pi) * 8), 7) for y, x in pairs]
    assert spark.sql("select cast(null as double) x, 1d y").select(scalars.angle(F.col("y"), F.col("x")).alias("a")).first()["a"] is None


def test_sizes_beyond_the_largest_unit(spark):
    df = spark.createDataFrame([(10_080_000_000_000,), (999,)], "b bigint")
    assert [tuple(r) for r in df.select(scalars.human_size(F.col("b")), scalars.human_size(F.col("b"), "GB")).collect()] == [("10.1 TB", "10080.0 GB"), ("999 B", "999 B")]


def test_boxes_that_tie_do_not_depend_on_the_order_of_rows(spark):
    boxes = [("s", 0, "rat", 0.9, 10, 20, 50, 60), ("s", 0, "rat", 0.9, 10, 20, 90, 60), ("s", 0, "rat", 0.9, 10, 20, 90, 80), ("s", 0, "rat", 0.9, 11, 2, 99, 90)]
    for rows in (boxes, boxes[::-1]):
        df = spark.createDataFrame(rows, "session_id string, frame_index bigint, label string, conf double, x1 int, y1 int, x2 int, y2 int").coalesce(1)
        assert [(r["x"], r["y"]) for r in live.frame_positions(df).collect()] == [(30.0, 40.0)]


def test_groups_are_dealt_to_all_partitions_and_stay_whole(spark):
    df = spark.createDataFrame([(None if k == 7 else f"g{k}", i) for k in range(40) for i in range(3)], "session_id string, i int")
    ends = groups.map_groups(df, ["session_id"], ["i"], lambda t: pa.table({"n": pa.array(np.diff(groups.starts(t, ["session_id"])))}), "n bigint")
    assert [r["n"] for r in ends.collect()] == [3] * 40
    assert ends.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_filter_over_gaps_short_chunks_and_lost_samples(spark):
    taps, size, rng = np.array([1.0, -2.0, 0.5, 3.0, 1.5]), 4, np.random.default_rng(3)
    line, rows = np.zeros(1100 * size), []
    for chunk in (0, 1, 2, 9, 254, 255, 256, 257, 1000):
        v = rng.normal(size=3 if chunk == 1000 else size)
        if chunk == 9:
            v[1] = np.nan
        line[chunk * size : chunk * size + len(v)] = v
        rows.append(("s", 1, chunk, v.tolist()))
    got = signals.filtered(spark.createDataFrame(rows, "session_id string, channel int, chunk bigint, v array<double>"), taps, size).collect()
    want = np.convolve(line, taps, "same")
    assert sorted(r["chunk"] for r in got) == [r[2] for r in rows]
    assert all(np.allclose(r["v"], want[r["chunk"] * size :][: len(r["v"])], equal_nan=True) for r in got) and len(max(got, key=lambda r: r["chunk"])["v"]) == 3


def test_many_rise_fits_at_once_are_those_of_one(spark):
    x, rng = np.arange(25) + 0.5, np.random.default_rng(5)
    y = rng.poisson(2.0, (6, 25)) / 4.0
    assert np.array_equal(tuning.fit_rises(x, y, 40), [tuning.fit_rise(x, v, 40) for v in y])


def test_place_fields_of_many_units(spark):
    rows = [("s", u, x, y, float((x + y + u) % 3 == 0) * 2 + (x == 5)) for u in range(3) for x in range(8) for y in range(5)]
    got = maps.place_fields(spark.createDataFrame(rows, "session_id string, unit_id int, bx int, by int, rate double"), 1)
    for u in range(3):
        left, sizes = {(x, y) for _, v, x, y, r in rows if v == u and r >= 1.5}, []
        while left:
            some = [left.pop()]
            for x, y in some:
                for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                    if c in left:
                        left.remove(c)
                        some.append(c)
            sizes.append(len(some))
        assert [r["cells"] for r in got.filter(f"unit_id = {u}").orderBy("field").collect()] == sorted(sizes, reverse=True)
