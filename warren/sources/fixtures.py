"""Stand-ins for the lab tables over the driver's parquet; the same text runs in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("customer", "documents", "embeddings", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
#: In order of dependence.
VIEWS = {
    "fx_track": """
SELECT concat('s', CAST(user_id AS VARCHAR)) AS session_id, user_id, CAST(n AS BIGINT) AS frame_index,
       CAST(n AS DOUBLE) / 30.0E0 AS seconds,
       CASE WHEN n % 40 < 32 THEN CAST(floor(n / 40) AS INT) + 1 END AS trial_num,
       CASE WHEN n % 53 <> 7 THEN CAST(abs((n + user_id * 13) % 1800 - 900) AS DOUBLE) / 100.0E0
            + CASE WHEN n % 29 = 0 THEN 1.5E0 ELSE 0.0E0 END END AS x,
       CASE WHEN n % 53 <> 7 THEN CAST(abs((n + user_id * 17) % 1000 - 500) AS DOUBLE) / 100.0E0 END AS y
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events) e
""",
    "fx_spikes": """
SELECT concat('s', CAST(user_id AS VARCHAR)) AS session_id, CAST(event_id % 3 AS INT) AS unit_id,
       CAST(event_id % 977 AS DOUBLE) / 450.0E0 AS t
FROM events WHERE event_type <> 'error'
""",
    "fx_trial_meta": """
SELECT session_id, trial_num, CAST((user_id + trial_num) % 6 + 1 AS INT) AS trial_type,
       CAST((user_id % 4 + 1) * 100 + trial_num % 24 + 1 AS INT) AS start_node,
       CAST((user_id % 4 + 1) * 100 + (user_id * 5) % 24 + 1 AS INT) AS goal_node
FROM (SELECT DISTINCT session_id, user_id, trial_num FROM fx_track WHERE trial_num IS NOT NULL) t
""",
    "fx_paths": """
SELECT l_orderkey AS row_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS seq,
       CAST((l_suppkey % 4 + 1) * 100 + l_partkey % 24 + 1 AS INT) AS node_id
FROM lineitem
""",
    # a maze's plan, its nodes moved by what lineitem's paths visit
    "fx_nodes": """
SELECT m.node_id, m.x + CAST(coalesce(w.visits, 0) % 9 AS DOUBLE) AS x, m.y + CAST(coalesce(w.visits, 0) % 5 AS DOUBLE) AS y
FROM (SELECT CAST(i.i * 100 + k.k + 1 AS INT) AS node_id,
       CAST((i.i - 1) % 2 * 588 + k.k % 6 * 60 + 40 AS DOUBLE) AS x,
       CAST(CAST(floor((i.i - 1) / 2) AS INT) * 356 + CAST(floor(k.k / 6) AS INT) * 60 + 40 AS DOUBLE) AS y
FROM (VALUES (1),(2),(3),(4)) i(i) CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11),(12),
      (13),(14),(15),(16),(17),(18),(19),(20),(21),(22),(23)) k(k)
UNION ALL SELECT node_id, x, y FROM (VALUES (501, 718.0E0, 125.0E0), (502, 555.0E0, 560.0E0)) h(node_id, x, y)) m LEFT JOIN (SELECT node_id, count(*) AS visits FROM fx_paths GROUP BY node_id) w ON w.node_id = m.node_id
""",
    # the plan's edges that lineitem's paths walk, and the doors of the homeboxes
    "fx_edges": """
SELECT m.u, m.v
FROM (SELECT i.i * 100 + e.s AS u, i.i * 100 + e.t AS v
FROM (VALUES (1),(2),(3),(4)) i(i) CROSS JOIN (VALUES (1,2),(1,7),(2,3),(3,4),(3,9),(4,5),(5,11),(6,13),(6,7),(7,8),
      (8,9),(8,15),(9,10),(10,11),(10,17),(11,12),(12,19),(13,14),(14,20),(14,15),(15,16),(16,22),(16,17),(17,18),
      (18,19),(18,24),(20,21),(21,22),(22,23),(23,24)) e(s, t)
UNION ALL SELECT u, v FROM (VALUES (124,201),(220,305),(324,401),(121,302),(223,404),
      (121,501),(223,502),(302,501),(404,502)) b(u, v)) m
LEFT JOIN (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT node_id AS a, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS b FROM fx_paths) p WHERE b IS NOT NULL) w
  ON w.a = least(m.u, m.v) AND w.b = greatest(m.u, m.v)
WHERE w.a IS NOT NULL OR m.v > 500
""",
    "fx_detections": """
SELECT concat('s', CAST(user_id AS VARCHAR)) AS session_id, CAST(floor(n / 2) AS BIGINT) AS frame_index,
       CASE WHEN event_type = 'error' THEN 'researcher' ELSE 'rat' END AS label,
       0.7E0 + CAST(event_id % 30 AS DOUBLE) / 100.0E0 AS conf,
       CAST((event_id * 37) % 1000 AS INT) AS x1, CAST((event_id * 91) % 600 AS INT) AS y1,
       CAST((event_id * 37) % 1000 + 60 + event_id % 80 AS INT) AS x2, CAST((event_id * 91) % 600 + 60 + event_id % 50 AS INT) AS y2
FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events) e
""",
    "fx_units": """
SELECT concat('s', CAST(p_partkey % 20 AS VARCHAR)) AS session_id, p_partkey AS unit_id, CAST(p_size AS DOUBLE) / 10.0E0 AS snr,
       CAST((p_partkey * 7) % 400 AS INT) AS num_spikes, CAST((p_partkey * 11) % 30 AS DOUBLE) AS isolation_distance,
       CAST((p_partkey * 13) % 50 AS DOUBLE) / 100.0E0 AS isi_violations_ratio, CAST((p_partkey * 17) % 20 AS DOUBLE) AS firing_rate_hz,
       CASE WHEN p_partkey % 9 <> 0 THEN CAST((p_partkey * 19) % 90 AS DOUBLE) / 100000.0E0 END AS trough_to_peak_s,
       CASE WHEN p_partkey % 7 <> 0 THEN CAST((p_partkey * 23) % 120 AS DOUBLE) / 10.0E0 END AS acg_tau_rise_ms
FROM part
""",
    "fx_dio": """
SELECT concat('s', CAST(user_id AS VARCHAR)) AS session_id, CASE WHEN user_id % 2 = 0 THEN 'red' ELSE 'blue' END AS color,
       CAST(n AS BIGINT) * 30000 + event_id % 100 AS tick, CAST((n + user_id) % 2 AS INT) AS state
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events) e
""",
    "fx_signal": """
SELECT concat('s', CAST(label AS VARCHAR)) AS session_id, vec_id AS chunk, CAST(vec_id % 8 AS INT) AS channel, embedding AS v
FROM embeddings
""",
    "fx_roster": """
SELECT CAST(o_custkey % 20 AS INT) AS rat_no, CAST(o_orderdate AS DATE) AS session_date, min(o_orderkey) AS train_order,
       count(*) AS trials, CAST(max(CASE WHEN o_custkey % 20 < 12 THEN 1 ELSE 0 END) AS INT) AS implanted
FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1, 2
""",
    "fx_files": """
SELECT CAST(o_custkey % 20 AS INT) AS rat_no, CAST(o_orderdate AS DATE) AS session_date,
       CASE l_linenumber % 4 WHEN 0 THEN 'pre' WHEN 1 THEN 'task' WHEN 2 THEN 'post' ELSE 'video' END AS phase,
       CASE l_returnflag WHEN 'A' THEN 'D1' WHEN 'N' THEN 'D2' ELSE 'D3' END AS volume,
       CAST(l_quantity * 1000000000 AS BIGINT) AS size_bytes
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey % 7 <> 0
""",
    "fx_names": """
SELECT rat_no, day, phase, volume, q, size_bytes,
       concat('Rat', CAST(rat_no AS VARCHAR), '_HM_neurons_', replace(day, '-', ''), '_', lpad(CAST(q % 24 AS VARCHAR), 2, '0'), '0500_', phase, CASE WHEN q % 7 = 0 THEN '_part2' ELSE '' END, '.rec') AS recording,
       CASE q % 4 WHEN 0 THEN concat('eye', CAST(q AS VARCHAR), '_', day, '_10-11-12.mp4') WHEN 1 THEN concat(day, '_10-11-12.Eye', CAST(q AS VARCHAR), '.mp4')
                  WHEN 2 THEN concat('eye', CAST(q AS VARCHAR), '.', day, '.MP4') ELSE concat('cam', CAST(q AS VARCHAR), '.mp4') END AS camera,
       CASE WHEN q % 3 = 0 THEN 'videos' ELSE concat(day, '_09-08-07') END AS folder,
       concat('/', volume, CASE q % 3 WHEN 0 THEN '/HM_neurons' WHEN 1 THEN '/HM_neuron_preprocessing' ELSE '/dump' END, '/Rat', CAST(rat_no AS VARCHAR), '/', replace(day, '-', '')) AS path
FROM (SELECT rat_no, CAST(session_date AS VARCHAR) AS day, phase, volume, size_bytes, CAST(size_bytes / 1000000000 AS INT) AS q FROM fx_files) f
""",
    "fx_log": """
SELECT session_id, frame_index AS line_no,
       CASE WHEN frame_index % 40 = 0 THEN concat('INFO : Recording Trial ', CAST(CAST(floor(frame_index / 40) AS INT) + 1 AS VARCHAR))
            ELSE concat('INFO : 0:00:', lpad(CAST(CAST(floor(seconds) AS INT) AS VARCHAR), 2, '0'), '.000 ', CAST(frame_index AS VARCHAR),
                 ' : The rat position is: (', CAST(CAST(floor(coalesce(x, 0.0E0) * 100) AS INT) AS VARCHAR), ', ',
                 CAST(CAST(floor(coalesce(y, 0.0E0) * 100) AS INT) AS VARCHAR), ') @ 101') END AS value
FROM fx_track
""",
}
NEEDS = {"fx_nodes": ("fx_paths",), "fx_edges": ("fx_paths",), "fx_trial_meta": ("fx_track",), "fx_log": ("fx_track",), "fx_names": ("fx_files",)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture or a raw table as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("VARCHAR", "STRING").replace("{", "{{").replace("}", "}}")
    used = {}
    for table in (*BASE, *NEEDS.get(name, ())):
        named = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
        if named != text:
            text, used[table] = named, view(spark, sf_dir, table)
    return spark.sql(text, **used)  # relations without a name in the session


def with_views(sql: str) -> str:
    """The query with the fixtures that it names in front, for an engine that has the raw tables only."""
    used = [n for n in VIEWS if n in sql]
    used = [n for n in VIEWS if n in used or any(n in NEEDS.get(u, ()) for u in used)]
    heads = [f"{n} AS ({VIEWS[n].strip()})" for n in used]
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join([*heads, body[15:]])
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join([*heads, body[5:]])
    return ("WITH " + ",\n".join(heads) + "\n" if heads else "") + body
