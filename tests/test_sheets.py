"""Sheets, overrides and sinks on small cases, and the unmixing of light patches."""

import numpy as np

from warren.operators import led
from warren.sources import sheets


def test_the_raw_sheet_of_a_book_is_read(spark, tmp_path):
    for book, names in (("a", ("1_Notes", "2_RAW")), ("b", ("2_Second", "1_First"))):
        (tmp_path / book).mkdir()
        for n in names:
            (tmp_path / book / f"{n}.csv").write_text(f"x,y\n{n},1\n{n},2\n")
        (tmp_path / book / ".hidden.csv").write_text("x,y\nno,0\n")
    got = sheets.read_trial_sheet(spark, str(tmp_path))
    assert sorted((r["book"], r["x"], r["y"]) for r in got.collect()) == [("a", "2_RAW", "1"), ("a", "2_RAW", "2"), ("b", "1_First", "1"), ("b", "1_First", "2")]


def test_tables_of_units_become_maps(spark, tmp_path):
    (tmp_path / "cluster_group.tsv").write_text("cluster_id\tgroup\n3\tgood\n4\t\n")
    got = {r["cluster_id"]: r["metrics"] for r in sheets.read_unit_table(spark, str(tmp_path / "cluster_group.tsv")).collect()}
    assert got == {3: {"group": "good"}, 4: {}}


def test_overrides_with_malformed_lines(spark):
    lines = ["eye1.mp4, 3.7, 4", "# note", "", None, "eye2.mp4, x, 4", "eye3.mp4, 1", "a/b/eye4.mp4,1,2,3"]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(lines)], "session_id string, line_no int, value string")
    assert [tuple(r)[2:] for r in sheets.crop_overrides(df).orderBy("line_no").collect()] == [("eye1.mp4", 3, 4, False), ("eye2.mp4", None, None, True), ("eye3.mp4", None, None, True), ("eye4.mp4", None, None, True)]
    parts = spark.createDataFrame([("s", 0, "e.mp4, Blue, 2"), ("s", 1, "e.mp4, green, 2"), ("s", 2, "e.mp4, red, x"), ("s", 3, "e.mp4")], "session_id string, line_no int, value string")
    assert [tuple(r)[3:] for r in sheets.component_overrides(parts).orderBy("line_no").collect()] == [("blue", 2, False), (None, None, True), (None, None, True), (None, None, True)]


def test_sessions_are_replaced_one_by_one(spark, tmp_path):
    rows = lambda s, *v: spark.createDataFrame([(s, x) for x in v], "session_id string, v int")
    path = str(tmp_path / "t")
    sheets.replace_sessions(rows("a", 1, 2).union(rows("b", 3)), path)
    sheets.replace_sessions(rows("a", 9), path)
    assert sorted((r["session_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3)]


def test_packages_clocks_and_summaries_are_written(spark, tmp_path):
    at = spark.createDataFrame([("s", i / 10, float(i)) for i in range(5)], "session_id string, seconds double, x double")
    lfp = spark.createDataFrame([("s", i / 10, i) for i in range(9)], "session_id string, seconds double, v int")
    sheets.build_session_package(spark, str(tmp_path / "p"), {"positions": at, "lfp": lfp})
    assert spark.read.parquet(str(tmp_path / "p" / "lfp")).count() == 5
    sheets.write_clock(spark.createDataFrame([("s", 1, 12.5, 10.0)], "session_id string, frame_index int, corrected double, created double"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c" / "seconds")).first()["seconds"] == 2.5
    sheets.write_summary(str(tmp_path / "s"), {"sessions": at, "units": lfp.limit(0)})
    assert spark.read.option("header", True).csv(str(tmp_path / "s" / "sessions")).count() == 5


def test_blinking_lights_are_taken_apart(spark):
    rng = np.random.default_rng(5)
    n = 900
    red, blue, drift = (np.arange(n) // 30 % 2).astype(float), (np.arange(n) // 6 % 2).astype(float), np.sin(np.arange(n) / 140.0)
    mix = rng.uniform(0.2, 1.0, (3, 12))
    v = np.stack([red, blue, drift], 1) @ mix * 40 + 100 + rng.normal(0, 0.05, (n, 12))
    df = spark.createDataFrame([("s", i, [float(x) for x in row]) for i, row in enumerate(v)] + [("flat", i, [1.0] * 12) for i in range(9)], "session_id string, frame_index bigint, v array<double>")
    parts = led.unmix(df).cache()
    series = parts.toPandas().pivot(index="frame_index", columns="component", values="value").to_numpy()
    assert parts.select("session_id").distinct().count() == 1 and np.allclose(series.std(0), 1)
    best = {name: max(range(3), key=lambda c, s=s: abs(np.corrcoef(series[:, c], s)[0, 1])) for name, s in (("red", red), ("blue", blue))}
    assert all(np.corrcoef(series[:, best[k]], s)[0, 1] > 0.97 for k, s in (("red", red), ("blue", blue)))
    states = led.on_off(parts).toPandas().pivot(index="frame_index", columns="component", values="state").to_numpy()
    assert (states[:, best["red"]] == red).mean() > 0.99 and (states[:, best["blue"]] == blue).mean() > 0.99
