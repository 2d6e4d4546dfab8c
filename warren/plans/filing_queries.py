"""Listings, plans of moves and trial sheets over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from warren.operators import filing as L
from warren.plans.registry import query

EXPORTS = "e AS (SELECT DISTINCT rat_no, day, CASE WHEN rat_no % 3 = 0 THEN NULL ELSE replace(recording, '.rec', '.LFP') END AS folder, concat('a.LFP_nt', q % 32 + 1, 'ch', q % 4 + 1, CASE WHEN q % 10 = 0 THEN '.timestamps' ELSE '' END, '.dat') AS name FROM fx_names)"


def exports(fx):
    folder = F.when(F.col("rat_no") % 3 != 0, F.regexp_replace("recording", r"\.rec$", ".LFP"))
    name = F.concat(F.lit("a.LFP_nt"), F.col("q") % 32 + 1, F.lit("ch"), F.col("q") % 4 + 1, F.when(F.col("q") % 10 == 0, ".timestamps").otherwise(""), F.lit(".dat"))
    return fx("fx_names").select("rat_no", "day", folder.alias("folder"), name.alias("name")).distinct()


query("s18_list_recordings", f"""WITH {EXPORTS} SELECT rat_no, day, folder, name, CAST(row_number() OVER (PARTITION BY rat_no, day ORDER BY folder, CAST(regexp_extract(name, 'nt([0-9]+)', 1) AS INT), CAST(regexp_extract(name, 'ch([0-9]+)', 1) AS INT)) AS INT) AS place FROM e WHERE name NOT LIKE '%timestamps%'""")(
    lambda fx: L.list_recordings(exports(fx), ["rat_no", "day"]).select("rat_no", "day", "folder", "name", "place")
)
query("s19_list_sessions", "SELECT DISTINCT rat_no, day, ['log', 'txt', 'csv'][q % 4 + 1] AS kind, concat('f', q) AS stem, concat('f', q, '.', ['log', 'txt', 'csv'][q % 4 + 1]) AS name FROM fx_names WHERE q % 4 < 3 AND q % 5 > 0")(
    lambda fx: L.list_sessions(fx("fx_names").select("rat_no", "day", F.concat(F.when(F.col("q") % 5 == 0, ".").otherwise(""), F.lit("f"), "q", F.element_at(F.array(*map(F.lit, (".log", ".txt", ".csv", ".mp4"))), F.col("q") % 4 + 1)).alias("name")).distinct(), ["rat_no", "day"])
)
query("i4_scatter_report", """WITH v AS (SELECT rat_no, session_date, volume, list(DISTINCT phase) AS p FROM fx_files GROUP BY 1, 2, 3), h AS (SELECT rat_no, session_date, string_agg(volume, ',' ORDER BY volume) AS volumes, bool_or(volume = 'D1') AS here, list_distinct(flatten(list(p))) AS present, max(len(p)) AS most FROM v GROUP BY 1, 2),
b AS (SELECT rat_no, session_date, phase, max(b) AS b FROM (SELECT rat_no, session_date, phase, volume, sum(size_bytes) AS b FROM fx_files GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3), m AS (SELECT rat_no, phase, median(b) AS m FROM b WHERE b > 0 GROUP BY 1, 2 HAVING count(*) >= 3),
s AS (SELECT rat_no, session_date, string_agg(phase, ',' ORDER BY phase) AS short FROM b JOIN m USING (rat_no, phase) WHERE b < 0.6 * m GROUP BY 1, 2), a AS (SELECT rat_no, session_date, implanted, true AS asked FROM fx_roster),
w AS (SELECT min(session_date) - INTERVAL 12 MONTH AS a, max(session_date) + INTERVAL 12 MONTH AS b FROM fx_roster),
r AS (SELECT *, CASE WHEN asked IS NULL THEN CASE WHEN rat_no IN (SELECT rat_no FROM fx_roster) AND session_date BETWEEN (SELECT a FROM w) AND (SELECT b FROM w) THEN 'orphan' END WHEN present IS NULL THEN CASE WHEN rat_no % 2 = 0 AND implanted = 0 THEN NULL ELSE 'not-found' END WHEN NOT here THEN 'elsewhere' END AS kind,
 CASE WHEN implanted = 1 THEN array_to_string(list_filter(['pre', 'task', 'post'], lambda x: NOT coalesce(list_contains(present, x), false)), '+') ELSE '' END AS missing, coalesce(len(present) > most, false) AS split FROM a FULL JOIN h USING (rat_no, session_date) LEFT JOIN s USING (rat_no, session_date))
SELECT kind, rat_no, session_date, volumes, split, short, missing, concat_ws(' · ', CASE WHEN split THEN 'split' END, 'short ' || short, 'missing ' || nullif(missing, ''), CASE WHEN asked AND rat_no % 2 = 0 AND present IS NULL THEN 'video found' END) AS detail FROM r WHERE kind IS NOT NULL""")(
    lambda fx: L.scatter_report(fx("fx_roster"), fx("fx_files"), ["D1"], fx("fx_roster").filter("rat_no % 2 = 0"))
)
VIDEOS = "v AS (SELECT DISTINCT concat(path, '/', q) AS path, CAST(day AS DATE) AS session_date, CAST(q % 24 AS VARCHAR) AS start, q % 11 = 0 AS aborted, q % 3 = 0 AS is_filed, CAST(rat_no + q % 2 AS INT) AS filed_rat FROM fx_names WHERE phase = 'video')"


def camera_folders(fx):
    q = F.col("q")
    return fx("fx_names").filter("phase = 'video'").select(F.concat("path", F.lit("/"), "q").alias("path"), F.to_date("day").alias("session_date"), (q % 24).cast("string").alias("start"), (q % 11 == 0).alias("aborted"), (q % 3 == 0).alias("is_filed"), (F.col("rat_no") + q % 2).cast("int").alias("filed_rat"), F.to_date("day").alias("filed_date")).distinct()


def camera_files(fx):
    seen = fx("fx_names").select("folder", "camera", ((F.col("q") % 5 == 0) & (F.col("q") % 4 != 3)).alias("again")).distinct()
    return seen.select("folder", F.explode(F.when(F.col("again"), F.array("camera", F.concat(F.lit("fixed_"), "camera"))).otherwise(F.array("camera"))).alias("name"))


query("i6_assign_videos", f"""WITH {VIDEOS}, m AS (SELECT *, row_number() OVER (PARTITION BY session_date ORDER BY start, path, filed_rat) AS n FROM v WHERE NOT aborted), s AS (SELECT session_date, rat_no, row_number() OVER (PARTITION BY session_date ORDER BY train_order, rat_no) AS n FROM fx_roster),
g AS (SELECT path, session_date, start, rat_no, CASE WHEN rat_no IS NULL THEN 'extra' WHEN NOT is_filed THEN 'fills' WHEN filed_rat = rat_no THEN 'filed' ELSE 'refile' END AS status FROM m LEFT JOIN s USING (session_date, n))
SELECT * FROM g QUALIFY bool_or(status <> 'filed') OVER (PARTITION BY session_date) UNION ALL SELECT path, session_date, start, NULL, 'aborted' FROM v WHERE aborted AND NOT is_filed""")(lambda fx: L.assign_videos(camera_folders(fx), fx("fx_roster")))
query("i9_plan_renames", f"""WITH f AS (SELECT DISTINCT folder, camera AS name, q FROM fx_names), a AS (SELECT folder, name FROM f UNION SELECT folder, concat('fixed_', name) FROM f WHERE q % 5 = 0 AND q % 4 <> 3),
o AS (SELECT folder, name, regexp_extract(name, '(?i)eye([0-9]+)', 1) AS e, coalesce(nullif(regexp_extract(name, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}_([0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}})', 1), ''), CASE WHEN folder <> 'videos' THEN '09-08-07' END) AS t, regexp_extract(name, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) AS d FROM a WHERE NOT regexp_matches(name, '^(?i)eye[0-9]+_[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}_[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}[.]mp4$')),
w AS (SELECT folder, name, e, CASE WHEN e <> '' AND t IS NOT NULL THEN concat('eye', lpad(CAST(CAST(nullif(e, '') AS INT) AS VARCHAR), 2, '0'), '_', d, '_', t, '.mp4') END AS wanted FROM o),
k AS (SELECT w.*, x.name IS NOT NULL AS taken, x.name IS NULL OR w.name LIKE '%fixed%' AS may FROM w LEFT JOIN a x ON x.folder = w.folder AND x.name = w.wanted WHERE wanted IS NOT NULL), n AS (SELECT *, may AND row_number() OVER (PARTITION BY folder, wanted, may ORDER BY name) = 1 AS wins FROM k)
SELECT folder, name, wanted AS new, CASE WHEN wins THEN 'rename' ELSE 'conflict' END AS action FROM n UNION ALL SELECT folder, wanted, concat(wanted, '.broken'), 'broken' FROM n WHERE wins AND taken UNION ALL SELECT folder, name, NULL, 'unknown' FROM w WHERE wanted IS NULL AND regexp_matches(name, '(?i)eye[0-9]+.*[.]mp4$')""")(
    lambda fx: L.plan_renames(camera_files(fx))
)
RESET = "f AS (SELECT volume AS root, concat(path, '/', folder, '_', q) AS path, concat(folder, '_', q % 8) AS name, q % 6 = 0 AS in_raw, volume <> 'D3' OR q % 2 = 0 AS writable, min(CASE WHEN q % 9 <> 4 THEN concat(q % 3) END) AS signature FROM fx_names GROUP BY 1, 2, 3, 4, 5)"
query("i10_plan_reset", f"""WITH {RESET}, r AS (SELECT root, name, min_by(signature, path) FILTER (signature IS NOT NULL) AS raw, true AS there FROM f WHERE in_raw GROUP BY 1, 2),
k AS (SELECT f.*, there, raw, row_number() OVER g AS n, first_value(signature) OVER g AS head FROM f LEFT JOIN r ON r.root = f.root AND r.name = f.name WINDOW g AS (PARTITION BY f.root, f.name, in_raw OR NOT writable ORDER BY path))
SELECT root, path, name, CASE WHEN in_raw THEN 'skip-in-raw' WHEN NOT writable THEN 'blocked' WHEN there IS NULL AND n = 1 THEN 'move' WHEN signature = CASE WHEN there THEN raw ELSE head END THEN 'duplicate' ELSE 'conflict' END AS action FROM k""")(
    lambda fx: L.plan_reset(
        fx("fx_names").groupBy(F.col("volume").alias("root"), F.concat("path", F.lit("/"), "folder", F.lit("_"), "q").alias("path"), F.concat("folder", F.lit("_"), F.col("q") % 8).alias("name"), (F.col("q") % 6 == 0).alias("in_raw"), ((F.col("volume") != "D3") | (F.col("q") % 2 == 0)).alias("writable")).agg(F.min(F.when(F.col("q") % 9 != 4, (F.col("q") % 3).cast("string"))).alias("signature"))
    )
)
query("i11_build_trial_meta", """WITH r AS (SELECT o_custkey % 20 AS subject, CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INT) AS day, CAST(substr(CAST(o_orderdate AS VARCHAR), 6, 2) AS INT) AS session, o_orderkey AS trial, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 9 END AS date, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 4 END AS start_node_n, CASE WHEN o_custkey % 7 > 0 THEN o_orderkey % 6 END AS goal_node_n, CASE WHEN o_orderkey % 2 > 0 THEN 3 END AS trial_type FROM orders),
c AS (SELECT subject, day, session, goal_node_n, count(*) AS n FROM r WHERE goal_node_n IS NOT NULL GROUP BY 1, 2, 3, 4), g AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY subject, day, session ORDER BY n DESC, goal_node_n) = 1),
p AS (SELECT subject, day, session, last_value(goal_node_n IGNORE NULLS) OVER (PARTITION BY subject ORDER BY day, session ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM (SELECT DISTINCT subject, day, session FROM r) LEFT JOIN g USING (subject, day, session)),
t AS (SELECT r.*, prev, row_number() OVER w AS k, count(*) OVER (PARTITION BY r.subject, r.day, r.session) AS n, first_value(date IGNORE NULLS) OVER (PARTITION BY r.subject, r.day, r.session ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS d FROM r JOIN p ON p.subject = r.subject AND p.day = r.day AND p.session = r.session WHERE start_node_n IS NOT NULL WINDOW w AS (PARTITION BY r.subject, r.day, r.session ORDER BY trial))
SELECT subject, day, session, CAST(k AS INT) AS trial_num, CASE WHEN k = 1 THEN d END AS date, CASE WHEN k = 1 THEN prev END AS prev_goal_node, CASE WHEN k = 1 THEN n END AS num_trials, goal_node_n, start_node_n, coalesce(trial_type, 1) AS trial_type FROM t""")(
    lambda fx: L.build_trial_meta(
        fx("orders").select(
            (F.col("o_custkey") % 20).alias("subject"), F.year("o_orderdate").alias("day"), F.month("o_orderdate").alias("session"), F.col("o_orderkey").alias("trial"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 9).alias("date"), F.lit(1).alias("repeat"),
            F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey") % 4).alias("start_node_n"), F.when(F.col("o_custkey") % 7 > 0, F.col("o_orderkey") % 6).alias("goal_node_n"), F.when(F.col("o_orderkey") % 2 > 0, 3).alias("trial_type"),
        )
    ).select("subject", "day", "session", "trial_num", "date", "prev_goal_node", "num_trials", "goal_node_n", "start_node_n", "trial_type")
)
