"""Maze graphs, distances over them, and the paths of trials."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warren.operators.base import checkpointed

#: Node pairs inside an island (numbers within it), bridges between islands, and homebox doors.
ISLAND = ((1, 2), (1, 7), (2, 3), (3, 4), (3, 9), (4, 5), (5, 11), (6, 13), (6, 7), (7, 8), (8, 9), (8, 15), (9, 10), (10, 11), (10, 17), (11, 12), (12, 19), (13, 14), (14, 20), (14, 15), (15, 16), (16, 22), (16, 17), (17, 18), (18, 19), (18, 24), (20, 21), (21, 22), (22, 23), (23, 24))
BRIDGES = ((124, 201), (220, 305), (324, 401), (121, 302), (223, 404))
DOORS = ((121, 501), (223, 502), (302, 501), (404, 502))
#: Metres of a step inside an island, and the jump of node numbers that only a bridge makes.
STEP_M, ISLAND_JUMP = 0.30, 50


def _pairs(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), "u int, v int")


def behaviour_edges(spark: SparkSession) -> DataFrame:
    """G1: four islands of 30 edges, five bridges and four doors, one direction each."""
    island = _pairs(spark, ISLAND).crossJoin(F.broadcast(spark.range(1, 5)))
    return island.select((F.col("id") * 100 + F.col("u")).cast("int").alias("u"), (F.col("id") * 100 + F.col("v")).cast("int").alias("v")).unionByName(_pairs(spark, BRIDGES + DOORS))


def walked_edges(template: DataFrame, visits: DataFrame) -> DataFrame:
    """G1: the template's edges that some path of `visits` (row_id, seq, node_id) walks, either way, and all doors.

    Paths are reduced to their distinct steps before the join.
    """
    steps = path_edges(visits).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    walked = template.join(steps, (F.least("u", "v") == F.col("a")) & (F.greatest("u", "v") == F.col("b")), "left")
    return walked.filter(F.col("a").isNotNull() | F.col("v").isin(501, 502)).select("u", "v")


def both_ways(edges: DataFrame) -> DataFrame:
    """An undirected edge list as arcs; other columns go with both."""
    more = [c for c in edges.columns if c not in ("u", "v")]
    return edges.select("u", "v", *more).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), *more)).distinct()


def island_edges(edges: DataFrame) -> DataFrame:
    """Islands that some bridge joins."""
    a, b = F.floor(F.col("u") / 100).cast("int"), F.floor(F.col("v") / 100).cast("int")
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b and a <= 4 and b <= 4").distinct()


def proximity_edges(nodes: DataFrame, radius: float) -> DataFrame:
    """Node pairs nearer than the radius, met in cells of the radius and their neighbours."""
    cell = lambda c: F.floor(F.col(c) / radius)
    a = nodes.select(F.col("node_id").alias("u"), F.col("x").alias("ux"), F.col("y").alias("uy"), cell("x").alias("cx"), cell("y").alias("cy"))
    shifts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    b = nodes.select(F.col("node_id").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy"), F.explode(shifts).alias("s")).select("v", "vx", "vy", (F.floor(F.col("vx") / radius) + F.col("s.i")).alias("cx"), (F.floor(F.col("vy") / radius) + F.col("s.j")).alias("cy"))
    return a.join(b, ["cx", "cy"]).filter("u < v").withColumn("w", F.hypot(F.col("ux") - F.col("vx"), F.col("uy") - F.col("vy"))).filter(F.col("w") < radius).select("u", "v", "w")


def distance_edges(nodes: DataFrame, radius: float = 65.0, extra=BRIDGES) -> DataFrame:
    """Near pairs and the given ones, weighed by length; homeboxes left out."""
    nodes = nodes.filter(~F.col("node_id").isin(501, 502))
    at = lambda c: nodes.select(F.col("node_id").alias(c), F.col("x").alias(f"{c}x"), F.col("y").alias(f"{c}y"))
    given = _pairs(nodes.sparkSession, extra).join(at("u"), "u").join(at("v"), "v").select("u", "v", F.hypot(F.col("ux") - F.col("vx"), F.col("uy") - F.col("vy")).alias("w"))
    return proximity_edges(nodes, radius).unionByName(given).groupBy("u", "v").agg(F.min("w").alias("w"))


def nn_edges(nodes: DataFrame, factor: float = 1.35, radius: float = 65.0) -> DataFrame:
    """Pairs no further apart than `factor` times the median distance to the nearest neighbour.

    Pairs meet in cells as in `proximity_edges`. The radius doubles until more than half of the nodes have a neighbour
    within it, which settles the median, or until it spans all of them; the loop counts rows only. Nodes without a place
    have no edges, and where most nodes share a place only those that do are joined.
    """
    placed = nodes.filter("x is not null and y is not null")
    n = placed.count()
    if n < 2:
        return proximity_edges(placed, radius)
    span = placed.agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))).first()[0]
    while True:
        nearest = both_ways(proximity_edges(placed, radius)).groupBy("u").agg(F.min("w").alias("nearest"))
        if nearest.count() > n // 2 or radius > 2 * span:
            break
        radius *= 2
    every = placed.select(F.col("node_id").alias("u")).join(nearest, "u", "left").select(F.coalesce("nearest", F.lit(float("inf"))).alias("nearest"))
    limit = factor * every.agg(F.median("nearest")).first()[0]
    return proximity_edges(placed, max(limit * (1 + 1e-9), radius * 1e-6)).filter(F.col("w") <= limit)


def node_hits(positions: DataFrame, nodes: DataFrame, radius: float) -> DataFrame:
    """Positions within the radius of a node, met in cells."""
    cell = lambda c, s=0: F.floor(F.col(c) / radius) + s
    shifts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = nodes.select("node_id", F.col("x").alias("nx"), F.col("y").alias("ny"), F.explode(shifts).alias("s")).withColumn("cx", cell("nx") + F.col("s.i")).withColumn("cy", cell("ny") + F.col("s.j")).drop("s")
    return positions.withColumn("cx", cell("x")).withColumn("cy", cell("y")).join(near, ["cx", "cy"]).withColumn("distance", F.hypot(F.col("x") - F.col("nx"), F.col("y") - F.col("ny"))).filter(F.col("distance") <= radius).drop("cx", "cy", "nx", "ny")


#: Nodes of a graph whose distances one task closes as a matrix.
MATRIX_NODES = 1500


def graph_key(*frames: DataFrame) -> list[str]:
    """["graph_id"] where all tables have many graphs, else none."""
    return ["graph_id"] if all("graph_id" in f.columns for f in frames) else []


def _closed(w: np.ndarray, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Least sums of weights between all nodes, and with `h` the least hops of these ways: every node in turn is a stop."""
    for k in range(len(w)):
        through = np.round(w[:, k, None] + w[None, k, :], 9)
        if h is None:
            np.minimum(w, through, out=w)
            continue
        hops = h[:, k, None] + h[None, k, :]
        better = (through < w) | ((through == w) & (hops < h))
        w, h = np.where(better, through, w), np.where(better, hops, h)
    return w, h


def _matrices(arcs: DataFrame, hops: bool) -> DataFrame:
    """(graph_id, u, v, d[, h]) of every reachable pair, a graph in a group, by closing its matrix of arcs (d)."""
    kinds = dict(arcs.dtypes)

    def one(table: pa.Table) -> pa.Table:
        u, v, d = (table.column(c).to_numpy() for c in ("u", "v", "d"))
        nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        w = np.full((len(nodes), len(nodes)), np.inf)
        np.minimum.at(w, (a, b), d)
        h = np.where(np.isfinite(w), 1.0, np.inf) if hops else None
        np.fill_diagonal(w, 0.0)
        if hops:
            np.fill_diagonal(h, 0.0)
        w, h = _closed(w, h)
        i, j = np.nonzero(np.isfinite(w))
        out = {"graph_id": pa.array([table.column("graph_id")[0].as_py()] * len(i), table.schema.field("graph_id").type), "u": pa.array(nodes[i].astype(u.dtype)), "v": pa.array(nodes[j].astype(u.dtype)), "d": pa.array(w[i, j])}
        return pa.table(out | ({"h": pa.array(h[i, j].astype(np.int64))} if hops else {}))

    return arcs.groupBy("graph_id").applyInArrow(one, f"graph_id {kinds['graph_id']}, u {kinds['u']}, v {kinds['u']}, d double" + ", h bigint" * hops)


def _squared(arcs: DataFrame, hops: bool, most_rounds: int) -> DataFrame:
    """As `_matrices`, for graphs of any size: ways grow by joins with themselves, so rounds are the logarithm of the longest.

    The loop counts rows and sums distances only; each round is checkpointed.
    """
    way = lambda d, h: F.struct(F.round(d, 9).alias("d"), (h if hops else F.lit(0)).cast("bigint").alias("h"))
    key = ["graph_id", "u", "v"]
    loops = arcs.select("graph_id", "u").distinct().select("graph_id", "u", F.col("u").alias("v"), way(F.lit(0.0), F.lit(0)).alias("x"))
    now, seen = checkpointed(arcs.select(*key, way(F.col("d"), F.lit(1)).alias("x")).unionByName(loops).groupBy(*key).agg(F.min("x").alias("x"))), None
    for _ in range(most_rounds):
        right = now.select("graph_id", F.col("u").alias("m"), F.col("v").alias("v2"), F.col("x").alias("y"))
        longer = now.withColumnRenamed("v", "m").join(right, ["graph_id", "m"]).select("graph_id", "u", F.col("v2").alias("v"), way(F.col("x.d") + F.col("y.d"), F.col("x.h") + F.col("y.h")).alias("x"))
        now = checkpointed(longer.groupBy(*key).agg(F.min("x").alias("x")))
        state = tuple(now.agg(F.count("*"), F.round(F.sum("x.d"), 6), F.sum("x.h")).first())
        if state == seen:
            return now.select(*key, "x.d", *(["x.h"] if hops else []))
        seen = state
    raise RuntimeError(f"ways still change after {most_rounds} rounds")


def _ways(edges: DataFrame, weight: str | None, hops: bool, matrix_nodes: int, most_rounds: int) -> DataFrame:
    graph = F.col("graph_id") if graph_key(edges) else F.lit(0)
    arcs = both_ways(edges.select(graph.alias("graph_id"), "u", "v", (F.col(weight) if weight else F.lit(1)).cast("double").alias("d")))
    large = checkpointed(arcs.groupBy("graph_id").agg(F.count_distinct("u").alias("n")).filter(F.col("n") > matrix_nodes).select("graph_id"))
    if large.isEmpty():
        out = _matrices(arcs, hops)
    else:
        out = _matrices(arcs.join(large, "graph_id", "left_anti"), hops).unionByName(_squared(arcs.join(large, "graph_id", "left_semi"), hops, most_rounds))
    return out if graph_key(edges) else out.drop("graph_id")


def all_pairs(edges: DataFrame, weight: str | None = None, matrix_nodes: int = MATRIX_NODES, most_rounds: int = 200) -> DataFrame:
    """(u, v, d), and graph_id where the edges have one, of every reachable pair: hops, or sums of a weight.

    Graphs of at most `matrix_nodes` nodes are closed as matrices, many at once and each in one group; larger ones by
    joins that square.
    """
    return _ways(edges, weight, False, matrix_nodes, most_rounds)


def tied_paths(arcs: DataFrame, dist: DataFrame, start: int, goal: int) -> DataFrame:
    """Arcs that lie on some shortest path from start to goal, with the distance walked before each; of each graph that has both."""
    key = graph_key(arcs, dist)
    far = dist.filter((F.col("u") == start) & (F.col("v") == goal)).select(*key, F.col("d").alias("total"))
    a, b = dist.filter(F.col("u") == start).select(*key, F.col("v").alias("u"), F.col("d").alias("before")), dist.filter(F.col("v") == goal).select(*key, F.col("u").alias("v"), F.col("d").alias("after"))
    rows = arcs.join(a, [*key, "u"]).join(b, [*key, "v"])
    rows = rows.join(far, key) if key else rows.join(F.broadcast(far))  # of one graph it is one row
    return rows.filter(F.abs(F.col("before") + F.col("w") + F.col("after") - F.col("total")) < 1e-9).select(*key, "u", "v", "before")


def collapse_runs(visits: DataFrame, keys=("row_id",), node: str = "node_id", order: str = "seq") -> DataFrame:
    """Of successive visits to one node only the first stays."""
    w = Window.partitionBy(*keys).orderBy(order)
    return visits.withColumn("__b", F.lag(node).over(w)).filter(F.col("__b").isNull() | (F.col("__b") != F.col(node))).drop("__b")


def segments(visits: DataFrame, bridges: DataFrame, default: float = STEP_M) -> DataFrame:
    """Steps between successive visits (node_id, t) with length and speed; trials of more than two visits only."""
    w = Window.partitionBy("row_id").orderBy("seq")
    rows = visits.withColumn("next_node", F.lead("node_id").over(w)).withColumn("t1", F.lead("t").over(w)).withColumn("n", F.count("*").over(Window.partitionBy("row_id"))).filter("n > 2 and next_node is not null")
    rows = rows.withColumn("a", F.least("node_id", "next_node")).withColumn("b", F.greatest("node_id", "next_node")).join(F.broadcast(bridges.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "length")), ["a", "b"], "left")
    diff = F.col("t1") - F.col("t")
    return rows.select("row_id", "seq", "node_id", "next_node", diff.alias("diff_s"), F.coalesce("length", F.lit(default)).alias("length_m")).withColumn("speed", F.when(F.col("diff_s") > 0, F.round(F.col("length_m") / F.col("diff_s"), 3)).otherwise(0.0))


def path_edges(visits: DataFrame) -> DataFrame:
    """A visited sequence as arcs."""
    return visits.withColumn("next_node", F.lead("node_id").over(Window.partitionBy("row_id").orderBy("seq"))).filter("next_node is not null").select("row_id", "seq", F.col("node_id").alias("u"), F.col("next_node").alias("v"))


def edge_segments(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Corridors in metres: both ends' positions. Nodes are one maze's, about 100."""
    at = lambda c: F.broadcast(nodes.select(F.col("node_id").alias(c), (F.col("x") / (1176 / 9.0)).alias(f"{c}_x"), (F.col("y") / (712 / 5.0)).alias(f"{c}_y")))
    return edges.join(at("u"), "u").join(at("v"), "v")


def _index(path: Column, node: Column) -> Column:
    """The 0-based place of a node's first visit; null without one."""
    return F.nullif(F.array_position(path, node), F.lit(0)) - 1


def node_metrics(trials: DataFrame, dist: DataFrame, known: DataFrame, islands: DataFrame) -> DataFrame:
    """Scores of each trial's path, under the names of the result sheet; all are null where `flag` says why.

    `trials` has row_id, path (array), start_node_n, goal_node_n, start_island_n, goal_island_n, seq_islands (array) and
    may have a comment, which is the flag of a trial without a path. `dist` and `islands` are the hops between nodes
    and between islands, `known` the node ids; they are one maze's, or have the trials' graph_id, and are
    broadcast below Spark's size limit only.
    """
    key = graph_key(trials, dist, known, islands)
    unknown = trials.select("row_id", *key, F.posexplode("path").alias("__at", "node_id")).join(known.select("node_id", *key), ["node_id", *key], "left_anti").groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("__at", "node_id"))).alias("__unknown"))
    d = lambda of, a, b, name: of.select(*key, F.col("u").alias(a), F.col("v").alias(b), F.col("d").alias(name))
    rows = trials if "comment" in trials.columns else trials.withColumn("comment", F.lit(None).cast("string"))
    rows = rows.join(unknown, "row_id", "left").join(d(dist, "start_node_n", "goal_node_n", "__nodes"), [*key, "start_node_n", "goal_node_n"], "left").join(d(islands, "start_island_n", "goal_island_n", "__islands"), [*key, "start_island_n", "goal_island_n"], "left")
    text = lambda c: c.cast("string")
    first = F.get("path", F.lit(0))
    flag = F.coalesce(
        F.when(F.coalesce(F.size("path"), F.lit(0)) <= 0, F.coalesce(F.nullif(F.trim("comment"), F.lit("")), F.lit("unknown error"))),
        F.when(first != F.col("start_node_n"), F.concat(F.lit("start_node_n ("), text(F.col("start_node_n")), F.lit(") != first path node ("), text(first), F.lit(")"))),
        F.when(F.col("__unknown").isNotNull(), F.concat(F.lit("unknown node(s) in path: ["), F.array_join(F.transform("__unknown", lambda x: text(x["node_id"])), ", "), F.lit("]"))),
        F.when(F.col("__nodes").isNull(), "unreachable goal"),
        F.when(F.col("__islands").isNull(), "unreachable island"),
    )
    n, last_two = F.size("path"), F.slice("path", F.greatest(F.size("path") - 1, F.lit(1)), F.lit(2))
    shortest, reached = F.col("__nodes"), F.array_contains(last_two, F.col("goal_node_n"))
    walked = F.when(reached, n - 1).otherwise(99)
    by_island, by_node = F.size("seq_islands"), F.size(F.array_distinct("seq_islands"))
    share = lambda a, b: F.try_divide(a.cast("double"), b)
    values = {
        "distance_start_goal_island": (F.col("__islands") + 1).cast("int"), "distance_start_goal_nodes": (shortest + 1).cast("int"),
        "path_length_start_goal_island_node_hit": by_island, "path_length_start_goal_island_island_hit": by_node, "path_length_start_goal_nodes_node_hit": n,
        "norm_path_length_start_goal_island_island_hit": share(by_node, F.col("__islands") + 1), "norm_path_length_start_goal_island_node_hit": share(by_island, F.col("__islands") + 1), "norm_path_length_start_goal_nodes_node_hit": share(n, shortest + 1),
        "shortest_path": shortest.cast("int"), "eat_on_1_encounter": (F.element_at("path", -1) == F.col("goal_node_n")).cast("int"), "n_nodes_visited": n, "food_reached": reached.cast("int"),
        "dist_tra": walked, "dt_rel_sp": share(walked, F.when(shortest > 0, shortest)), "dt_min_sp": (walked - shortest).cast("int"), "dir_run_mat_perf": (reached & (walked == shortest)).cast("int"),
    }
    flagged = rows.withColumn("flag", flag)
    return flagged.select("row_id", "flag", *[F.when(F.col("flag").isNull(), c).alias(name) for name, c in values.items()])


def choice_quality(visits: DataFrame, goals: DataFrame, arcs: DataFrame, dist: DataFrame) -> DataFrame:
    """For each step 1 if it goes to a neighbour nearest to the goal, else 0; joined by commas and in percent.

    Where `goals`, `arcs` and `dist` have a graph_id, a trial walks its own graph.
    """
    key = graph_key(goals, arcs, dist)
    to_goal = dist.select(*key, F.col("u").alias("v"), F.col("v").alias("goal_node_n"), F.col("d").alias("left"))
    options = arcs.select(*key, "u", "v").join(to_goal, [*key, "v"])
    best = options.groupBy(*key, "u", "goal_node_n").agg(F.min("left").alias("best"))
    steps = path_edges(visits).join(goals, "row_id").join(options, [*key, "u", "v", "goal_node_n"], "left").join(best, [*key, "u", "goal_node_n"], "left")
    right = F.when(F.col("left") == F.col("best"), 1).otherwise(0)
    one = F.sort_array(F.collect_list(F.struct("seq", right.alias("ok"))))
    return steps.groupBy("row_id").agg(one.alias("s"), (100 * F.avg(right)).alias("perc_correct_choices")).select("row_id", F.array_join(F.transform("s", lambda x: x["ok"].cast("string")), ",").alias("node_choices_binary"), "perc_correct_choices")


def island_entry(visits: DataFrame) -> DataFrame:
    """The last step whose node numbers jump to another island: its place, the node before and the node after."""
    jump = path_edges(visits).filter(F.abs(F.col("u") - F.col("v")) >= ISLAND_JUMP)
    last = F.max(F.struct("seq", "u", "v")).alias("m")
    return jump.groupBy("row_id").agg(last, F.count("*").alias("jumps")).select("row_id", "jumps", F.col("m.seq").alias("entry_seq"), F.col("m.u").alias("isl_node_in"), F.col("m.v").alias("isl_node_after"))


def island_performance(trials: DataFrame, dist: DataFrame) -> DataFrame:
    """Of paths with a jump to another island, the last node before the last jump, the nodes of the fewest hops from there
    to the goal, the nodes walked from there, and their ratio."""
    key = graph_key(trials, dist)
    jumps = F.expr(f"filter(transform(path, (n, i) -> if(i < size(path) - 1 and abs(path[i + 1] - n) >= {ISLAND_JUMP}, i, null)), i -> i is not null)")
    rows = trials.filter(F.size("path") > 1).withColumn("__at", F.array_max(jumps)).filter("__at is not null").withColumn("isl_node_in", F.get("path", F.col("__at")))
    rows = rows.join(dist.select(*key, F.col("u").alias("isl_node_in"), F.col("v").alias("goal_node_n"), "d"), [*key, "isl_node_in", "goal_node_n"])
    walked, fewest = F.size("path") - F.col("__at"), F.col("d") + 1
    return rows.select("row_id", "isl_node_in", fewest.cast("int").alias("isl_short_path"), walked.alias("isl_dt_trav"), (walked / fewest).alias("perf_in_island"))


def performance(trials: DataFrame, dist: DataFrame) -> DataFrame:
    """log10 of the fewest steps over the steps to the first visit of the goal, in the trial's graph if there are many."""
    key = graph_key(trials, dist)
    rows = trials.withColumn("first_node", F.get("path", F.lit(0))).join(dist.select(*key, F.col("u").alias("first_node"), F.col("v").alias("goal_node_n"), "d"), [*key, "first_node", "goal_node_n"])
    n = _index(F.col("path"), F.col("goal_node_n"))
    return rows.select("row_id", F.when((n > 0) & (F.col("d") > 0), F.log10(F.col("d") / n)).alias("performance"))


def hop_vs_weight(edges: DataFrame, matrix_nodes: int = MATRIX_NODES, most_rounds: int = 60) -> DataFrame:
    """Pairs whose cheapest way is longer in hops than the way of fewest hops, of every graph of the edges."""
    key = graph_key(edges)
    cheapest = _ways(edges, "w", True, matrix_nodes, most_rounds)
    fewest = all_pairs(edges, None, matrix_nodes).select(*key, "u", "v", F.col("d").alias("hops"))
    return cheapest.join(fewest, [*key, "u", "v"]).filter(F.col("hops") < F.col("h")).select(*key, "u", "v", "hops", F.col("h").cast("double").alias("cheapest_hops"))
