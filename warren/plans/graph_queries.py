"""Graph and path operators over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import graph as G
from warren.plans.registry import query

ARCS = "arcs AS (SELECT u, v FROM fx_edges UNION SELECT v, u FROM fx_edges)"
# breadth first, level by level: UNION drops repeated (u, v, d); distances are below 40 in one maze
PAIRS = ARCS.replace("arcs AS", "RECURSIVE arcs AS") + ", walk(u, v, d) AS (SELECT DISTINCT u, u, 0 FROM arcs UNION SELECT w.u, a.v, w.d + 1 FROM walk w JOIN arcs a ON w.v = a.u WHERE w.d < 97), dist AS (SELECT u, v, min(d) AS d FROM walk GROUP BY 1, 2)"
TRIALS = "trials AS (SELECT row_id, list(node_id ORDER BY seq) AS path, CAST(max(CASE WHEN seq = 1 THEN node_id + CASE WHEN row_id % 5 = 0 THEN 1 ELSE 0 END END) AS INT) AS start_node_n, CAST(min(node_id) AS INT) AS goal_node_n FROM fx_paths GROUP BY row_id)"


def trials(fx):
    rows = fx("fx_paths").groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("seq", "node_id"))).alias("p"), F.min("node_id").alias("goal_node_n"))
    return rows.select("row_id", F.transform("p", lambda x: x["node_id"]).alias("path"), (F.get("p", F.lit(0))["node_id"] + F.when(F.col("row_id") % 5 == 0, 1).otherwise(0)).alias("start_node_n"), "goal_node_n")


def hops(fx):
    return G.all_pairs(fx("fx_edges"))


#: A maze for each of twenty groups of paths: the plan's edges that the group walks.
MAZES = """RECURSIVE steps AS (SELECT DISTINCT row_id % 20 AS graph_id, least(a, b) AS a, greatest(a, b) AS b FROM (SELECT row_id, node_id AS a, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS b FROM fx_paths) WHERE b IS NOT NULL),
mazes AS (SELECT s.graph_id, e.u, e.v FROM steps s JOIN fx_edges e ON least(e.u, e.v) = s.a AND greatest(e.u, e.v) = s.b),
arcs AS (SELECT graph_id, u, v FROM mazes UNION SELECT graph_id, v, u FROM mazes),
walk(graph_id, u, v, d) AS (SELECT DISTINCT graph_id, u, u, 0 FROM arcs UNION SELECT w.graph_id, w.u, a.v, w.d + 1 FROM walk w JOIN arcs a ON w.graph_id = a.graph_id AND w.v = a.u WHERE w.d < 97),
dist AS (SELECT graph_id, u, v, min(d) AS d FROM walk GROUP BY 1, 2, 3)"""


def mazes(fx):
    steps = G.path_edges(fx("fx_paths")).select((F.col("row_id") % 20).alias("graph_id"), F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    return fx("fx_edges").join(steps, (F.least("u", "v") == F.col("a")) & (F.greatest("u", "v") == F.col("b"))).select("graph_id", "u", "v")


query("g1_behaviour_edges", "SELECT CAST(u AS INT) AS u, CAST(v AS INT) AS v FROM fx_edges")(lambda fx: (lambda visits: G.walked_edges(G.behaviour_edges(visits.sparkSession), visits))(fx("fx_paths")))
query("g4_island_edges", "SELECT DISTINCT CAST(least(u // 100, v // 100) AS INT) AS a, CAST(greatest(u // 100, v // 100) AS INT) AS b FROM fx_edges WHERE u // 100 <> v // 100 AND u < 500 AND v < 500")(lambda fx: G.island_edges(fx("fx_edges")))
query("j11_proximity_edges", "SELECT a.node_id AS u, b.node_id AS v, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS w FROM fx_nodes a JOIN fx_nodes b ON a.node_id < b.node_id WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 65")(lambda fx: G.proximity_edges(fx("fx_nodes"), 65.0))
query("j12_nn_edges", """WITH p AS (SELECT a.node_id AS u, b.node_id AS v, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS w FROM fx_nodes a JOIN fx_nodes b ON a.node_id <> b.node_id)
SELECT u, v, round(w, 6) AS w FROM p WHERE u < v AND w <= (SELECT 1.35 * median(n) FROM (SELECT u, min(w) AS n FROM p GROUP BY u))""")(lambda fx: G.nn_edges(fx("fx_nodes")))
query("j10_node_hits", """SELECT session_id, frame_index, node_id, round(sqrt((x1 - x) ** 2 + (y1 - y) ** 2), 6) AS distance FROM fx_detections, fx_nodes WHERE sqrt((x1 - x) ** 2 + (y1 - y) ** 2) <= 20""")(lambda fx: G.node_hits(fx("fx_detections").select("session_id", "frame_index", F.col("x1").cast("double").alias("x"), F.col("y1").cast("double").alias("y")), fx("fx_nodes"), 20.0).select("session_id", "frame_index", "node_id", "distance"))
query("g2_distance_edges", """WITH n AS (SELECT * FROM fx_nodes WHERE node_id < 500), p AS (SELECT a.node_id AS u, b.node_id AS v, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS w FROM n a JOIN n b ON a.node_id < b.node_id)
SELECT u, v, round(w, 6) AS w FROM p WHERE w < 65 OR (u, v) IN ((124, 201), (220, 305), (324, 401), (121, 302), (223, 404))""")(lambda fx: G.distance_edges(fx("fx_nodes")))
query("g5_all_pairs", f"WITH {PAIRS} SELECT u, v, CAST(d AS DOUBLE) AS d FROM dist")(hops)
query("g6_tied_paths", f"WITH {PAIRS} SELECT a.u, a.v, CAST(s.d AS DOUBLE) AS before FROM arcs a JOIN dist s ON s.u = 101 AND s.v = a.u JOIN dist t ON t.u = a.v AND t.v = 412 WHERE s.d + 1 + t.d = (SELECT d FROM dist WHERE u = 101 AND v = 412)")(lambda fx: G.tied_paths(G.both_ways(fx("fx_edges")).withColumn("w", F.lit(1.0)), hops(fx), 101, 412))
query("g7_hop_vs_weight")(lambda fx: G.hop_vs_weight(G.distance_edges(fx("fx_nodes"))))
ISLANDS = """ia AS (SELECT DISTINCT u // 100 AS u, v // 100 AS v FROM arcs WHERE u // 100 <> v // 100 AND u < 500 AND v < 500), iw(u, v, d) AS (SELECT DISTINCT u, u, 0 FROM ia UNION SELECT w.u, a.v, w.d + 1 FROM iw w JOIN ia a ON w.v = a.u WHERE w.d < 5), idist AS (SELECT u, v, min(d) AS d FROM iw GROUP BY 1, 2)"""


def island_trials(fx):
    rows, island = trials(fx), lambda n: F.floor(n / 100).cast("int")
    seq = F.transform("path", island)
    turns = F.filter(F.transform(seq, lambda n, i: F.when((i == 0) | (n != F.get(seq, i - 1)), n)), lambda n: n.isNotNull())
    path = F.when(F.col("row_id") % 11 != 0, F.col("path"))
    return rows.select("row_id", path.alias("path"), "start_node_n", "goal_node_n", island(F.col("start_node_n")).alias("start_island_n"), island(F.col("goal_node_n")).alias("goal_island_n"), turns.alias("seq_islands"), F.when(F.col("row_id") % 2 == 0, F.lit(" lost ")).alias("comment"))


def island_hops(fx):
    return G.all_pairs(G.island_edges(fx("fx_edges")).withColumnsRenamed({"a": "u", "b": "v"}))


query("g8_node_metrics", f"""WITH {PAIRS}, {ISLANDS}, {TRIALS}, q AS (SELECT *, list_transform(path, lambda n: n // 100) AS isl FROM trials), t AS (SELECT *, [isl[i] for i in range(1, len(isl) + 1) if i = 1 or isl[i] <> isl[i - 1]] AS seq FROM q),
r AS (SELECT t.row_id, CASE WHEN t.row_id % 11 <> 0 THEN path END AS path, start_node_n, goal_node_n, seq, d.d AS sp, i.d + 1 AS di FROM t LEFT JOIN dist d ON d.u = start_node_n AND d.v = goal_node_n LEFT JOIN idist i ON i.u = start_node_n // 100 AND i.v = goal_node_n // 100),
f AS (SELECT *, list_contains(path[-2:], goal_node_n) AS food, CASE WHEN path IS NULL THEN CASE WHEN row_id % 2 = 0 THEN 'lost' ELSE 'unknown error' END WHEN path[1] <> start_node_n THEN 'start_node_n (' || start_node_n || ') != first path node (' || path[1] || ')' WHEN len([n for n in path if n // 100 > 4 or n % 100 > 24 or n % 100 < 1]) > 0 THEN '?' WHEN sp IS NULL THEN 'unreachable goal' WHEN di IS NULL THEN 'unreachable island' END AS flag FROM r),
g AS (SELECT *, CASE WHEN food THEN len(path) - 1 ELSE 99 END AS dt, len(path) AS n, len(seq) AS il, len(list_distinct(seq)) AS iu FROM f)
SELECT row_id, flag, CASE WHEN flag IS NULL THEN CAST(di AS INT) END AS distance_start_goal_island, CASE WHEN flag IS NULL THEN CAST(sp + 1 AS INT) END AS distance_start_goal_nodes, CASE WHEN flag IS NULL THEN CAST(il AS INT) END AS path_length_start_goal_island_node_hit, CASE WHEN flag IS NULL THEN CAST(iu AS INT) END AS path_length_start_goal_island_island_hit, CASE WHEN flag IS NULL THEN CAST(n AS INT) END AS path_length_start_goal_nodes_node_hit,
CASE WHEN flag IS NULL THEN round(iu / di, 6) END AS norm_path_length_start_goal_island_island_hit, CASE WHEN flag IS NULL THEN round(il / di, 6) END AS norm_path_length_start_goal_island_node_hit, CASE WHEN flag IS NULL THEN round(n / (sp + 1), 6) END AS norm_path_length_start_goal_nodes_node_hit, CASE WHEN flag IS NULL THEN CAST(sp AS INT) END AS shortest_path, CASE WHEN flag IS NULL THEN (path[-1] = goal_node_n)::INT END AS eat_on_1_encounter, CASE WHEN flag IS NULL THEN CAST(n AS INT) END AS n_nodes_visited,
CASE WHEN flag IS NULL THEN food::INT END AS food_reached, CASE WHEN flag IS NULL THEN CAST(dt AS INT) END AS dist_tra, CASE WHEN flag IS NULL AND sp > 0 THEN round(dt / sp, 6) END AS dt_rel_sp, CASE WHEN flag IS NULL THEN CAST(dt - sp AS INT) END AS dt_min_sp, CASE WHEN flag IS NULL THEN (food AND dt = sp)::INT END AS dir_run_mat_perf FROM g""")(lambda fx: G.node_metrics(island_trials(fx), hops(fx), fx("fx_nodes"), island_hops(fx)))
query("g9_choice_quality", f"""WITH {PAIRS}, {TRIALS}, s AS (SELECT row_id, seq, node_id AS u, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS v FROM fx_paths), o AS (SELECT a.u, a.v, d.v AS goal, d.d AS remaining FROM arcs a JOIN dist d ON d.u = a.v), b AS (SELECT u, goal, min(remaining) AS best FROM o GROUP BY 1, 2),
k AS (SELECT s.row_id, s.seq, CASE WHEN o.remaining = b.best THEN 1 ELSE 0 END AS ok FROM s JOIN trials t ON t.row_id = s.row_id LEFT JOIN o ON o.u = s.u AND o.v = s.v AND o.goal = t.goal_node_n LEFT JOIN b ON b.u = s.u AND b.goal = t.goal_node_n WHERE s.v IS NOT NULL)
SELECT row_id, string_agg(CAST(ok AS VARCHAR), ',' ORDER BY seq) AS node_choices_binary, round(100 * avg(ok), 6) AS perc_correct_choices FROM k GROUP BY row_id""")(lambda fx: G.choice_quality(fx("fx_paths"), trials(fx).select("row_id", "goal_node_n"), G.both_ways(fx("fx_edges")), hops(fx)))
query("g10_island_entry", """WITH s AS (SELECT row_id, seq, node_id AS u, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS v FROM fx_paths)
SELECT row_id, count(*) AS jumps, max(seq) AS entry_seq, arg_max(u, seq) AS isl_node_in, arg_max(v, seq) AS isl_node_after FROM s WHERE abs(u - v) >= 50 GROUP BY row_id""")(lambda fx: G.island_entry(fx("fx_paths")))
query("g10_island_performance", f"""WITH {PAIRS}, {TRIALS}, j AS (SELECT *, list_max([i for i in range(1, len(path)) if abs(path[i + 1] - path[i]) >= 50]) AS je FROM trials)
SELECT row_id, path[je] AS isl_node_in, CAST(d + 1 AS INT) AS isl_short_path, CAST(len(path) - je + 1 AS INT) AS isl_dt_trav, round((len(path) - je + 1) / (d + 1), 6) AS perf_in_island FROM j JOIN dist ON u = path[je] AND v = goal_node_n WHERE je IS NOT NULL""")(lambda fx: G.island_performance(trials(fx), hops(fx)))
query("g12_performance", f"WITH {PAIRS}, {TRIALS} SELECT row_id, CASE WHEN list_position(path, goal_node_n) > 1 AND d > 0 THEN round(log10(d / (list_position(path, goal_node_n) - 1)), 6) END AS performance FROM trials JOIN dist ON u = path[1] AND v = goal_node_n")(lambda fx: G.performance(trials(fx), hops(fx)))
query("g13_path_edges", "SELECT row_id, seq, u, v FROM (SELECT row_id, seq, node_id AS u, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS v FROM fx_paths) WHERE v IS NOT NULL")(lambda fx: G.path_edges(fx("fx_paths")))
query("g14_edge_segments", "SELECT e.u, e.v, round(a.x / (1176 / 9.0), 6) AS u_x, round(a.y / (712 / 5.0), 6) AS u_y, round(b.x / (1176 / 9.0), 6) AS v_x, round(b.y / (712 / 5.0), 6) AS v_y FROM fx_edges e JOIN fx_nodes a ON a.node_id = e.u JOIN fx_nodes b ON b.node_id = e.v")(lambda fx: G.edge_segments(fx("fx_edges"), fx("fx_nodes")))
query("w10_collapse_runs", "SELECT row_id, seq, node_id FROM (SELECT *, lag(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS b FROM fx_paths) WHERE b IS NULL OR b <> node_id")(lambda fx: G.collapse_runs(fx("fx_paths")))
query("w11_segments", """WITH s AS (SELECT row_id, seq, node_id, lead(node_id) OVER w AS next_node, count(*) OVER (PARTITION BY row_id) AS n, CAST(lead(seq * seq % 7) OVER w - seq * seq % 7 AS DOUBLE) AS diff_s FROM fx_paths WINDOW w AS (PARTITION BY row_id ORDER BY seq))
SELECT row_id, seq, node_id, next_node, diff_s, l AS length_m, CASE WHEN diff_s > 0 THEN round(l / diff_s, 3) ELSE 0.0 END AS speed FROM (SELECT *, CASE WHEN (least(node_id, next_node), greatest(node_id, next_node)) IN ((124, 201), (220, 305), (324, 401), (121, 302), (223, 404)) THEN 0.6E0 ELSE 0.3E0 END AS l FROM s WHERE n > 2 AND next_node IS NOT NULL)""")(
    lambda fx: G.segments(fx("fx_paths").withColumn("t", (F.col("seq") * F.col("seq") % 7).cast("double")), fx("fx_edges").filter("floor(u / 100) <> floor(v / 100) and v < 500").withColumn("length", F.lit(0.6)))
)
query("g5_many_mazes", f"WITH {MAZES} SELECT graph_id, u, v, CAST(d AS DOUBLE) AS d FROM dist")(lambda fx: G.all_pairs(mazes(fx)))
query("g12_many_mazes", f"WITH {MAZES}, {TRIALS} SELECT row_id, CASE WHEN list_position(path, goal_node_n) > 1 AND d > 0 THEN round(log10(d / (list_position(path, goal_node_n) - 1)), 6) END AS performance FROM trials t JOIN dist d ON d.graph_id = t.row_id % 20 AND u = path[1] AND v = goal_node_n")(lambda fx: G.performance(trials(fx).withColumn("graph_id", F.col("row_id") % 20), G.all_pairs(mazes(fx))))
query("g9_many_mazes", f"""WITH {MAZES}, {TRIALS}, s AS (SELECT row_id, seq, node_id AS u, lead(node_id) OVER (PARTITION BY row_id ORDER BY seq) AS v FROM fx_paths), o AS (SELECT a.graph_id, a.u, a.v, d.v AS goal, d.d AS remaining FROM arcs a JOIN dist d ON d.graph_id = a.graph_id AND d.u = a.v), b AS (SELECT graph_id, u, goal, min(remaining) AS best FROM o GROUP BY 1, 2, 3),
k AS (SELECT s.row_id, s.seq, CASE WHEN o.remaining = b.best THEN 1 ELSE 0 END AS ok FROM s JOIN trials t ON t.row_id = s.row_id LEFT JOIN o ON o.graph_id = s.row_id % 20 AND o.u = s.u AND o.v = s.v AND o.goal = t.goal_node_n LEFT JOIN b ON b.graph_id = s.row_id % 20 AND b.u = s.u AND b.goal = t.goal_node_n WHERE s.v IS NOT NULL)
SELECT row_id, string_agg(CAST(ok AS VARCHAR), ',' ORDER BY seq) AS node_choices_binary, round(100 * avg(ok), 6) AS perc_correct_choices FROM k GROUP BY row_id""")(lambda fx: G.choice_quality(fx("fx_paths"), trials(fx).select("row_id", "goal_node_n", (F.col("row_id") % 20).alias("graph_id")), G.both_ways(mazes(fx)), G.all_pairs(mazes(fx))))
