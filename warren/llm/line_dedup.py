"""Lines that many documents share, kept in one document each, by levelled sorted runs of line hashes."""

from __future__ import annotations

from uuid import uuid4

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from warren.llm.common import checkpointed, map_arrow, shared_folder, texts

#: Code points of the shortest key that counts, and the documents that must hold a key.
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Batches that a table is taken in (by falling doc_id), and runs of a level that are compacted into one of the next.
BATCHES, FANOUT = 6, 3
#: Keys in more than one of so many parts of all rows are joined by a broadcast, which therefore has fewer rows than this.
HOT_PARTS = 5_000

_SPACES = " \t\n\x0b\x0c\r"
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def line_key(line: str, least_chars: int = LEAST_CHARS) -> bytes | None:
    """The hash of 128 bits of a line's key; None where the key is too short to count."""
    key = line.strip(_SPACES)
    return xxhash.xxh3_128_digest(key.translate(_LOWER).encode()) if len(key) >= least_chars else None


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, copy, key): the different keys of every row. `doc` holds the doc_id, `copy` a hash of the text."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = [{k for x in text.split("\n") if (k := line_key(x, least_chars))} for text in texts(batch.column("__text"))]
        at = [i for i, keys in enumerate(found) for _ in keys]
        return {c: batch.column(c).take(pa.array(at, pa.int64())) for c in ("doc", "copy")} | {"key": pa.array([k for keys in found for k in keys], pa.binary())}

    return map_arrow(docs.select(*_row(docs), F.col("text").alias("__text")), rows, "doc bigint, copy bigint, key binary")


def _row(docs: DataFrame) -> list[Column]:
    """What rows are joined by. Rows of one doc_id count as one document, so equal hashes of their texts do no harm."""
    return [F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("copy")]


class LineRuns:
    """The keys met so far: runs of (key, keeper, docs), bucketed by key and sorted, no key in two of them.

    A batch of keys is shuffled once, pre-aggregated, and merge-joined with each run where it lies. Keys that no run
    has become a run of level 0; what is known already is returned. `fanout` runs of a level are merged into one of
    the next, so n batches leave about fanout * log(n) runs. Runs are tables of the session's catalogue whose files
    lie in `folder`; `drop` forgets them.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout, self.levels = spark, folder, fanout, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _written(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid4().hex}"
        dealt = rows.select("key", "keeper", "docs").repartition(self.buckets, "key")
        dealt.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds the new keys of `batch` (key, keeper, docs; a row each) and returns the rows of those that runs have."""
        found = batch.withColumn("known", F.lit(False))
        for name in self.tables():
            run = self.spark.table(name).select("key", F.lit(True).alias("here"))
            found = found.join(run.hint("merge"), "key", "left").withColumn("known", F.col("known") | F.coalesce("here", F.lit(False))).drop("here")
        found = checkpointed(found)
        self._push(0, self._written(found.filter(~F.col("known"))))
        return found.filter("known").drop("known")

    def _push(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self.spark.table(old[0])
            for other in old[1:]:
                merged = merged.unionByName(self.spark.table(other))
            self.levels[level] = []
            self._push(level + 1, self._written(merged))
            for x in old:
                self.spark.sql(f"DROP TABLE {x}")

    def merged_with(self, repeats: DataFrame) -> DataFrame:
        """(key, keeper, docs): every key with the documents that `repeats` (key, docs) adds to it, run by run."""
        out = None
        for name in self.tables():
            run = self.spark.table(name).join(repeats.withColumnRenamed("docs", "more").hint("merge"), "key", "left")
            run = run.select("key", "keeper", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"))
            out = run if out is None else out.unionByName(run)
        return out

    def drop(self) -> None:
        for name in self.tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def shared_keys(keys: DataFrame, folder: str, batches: int = BATCHES, fanout: int = FANOUT, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(key, keeper, docs): the keys of at least `least_docs` documents and the largest doc_id that holds each.

    Batches fall in doc_id, so the first batch that has a key holds its keeper. Rows of one doc_id lie in one batch.
    """
    spark = keys.sparkSession
    bounds = keys.agg(F.percentile_approx("doc", [i / batches for i in range(batches - 1, 0, -1)])).first()[0] or []
    batch = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        batch = F.when(F.col("doc") > bounds[i], i).otherwise(batch)
    path = f"{folder}/batches"
    keys.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    rows, runs, repeats = spark.read.schema("doc bigint, copy bigint, key binary, batch int").parquet(path), LineRuns(spark, folder, fanout), None
    try:
        for i in range(len(bounds) + 1):
            one = rows.filter(F.col("batch") == i).groupBy("key", "doc").agg(F.lit(1).alias("one"))
            more = runs.add(one.groupBy("key").agg(F.max("doc").alias("keeper"), F.count("*").alias("docs")))
            repeats = more if repeats is None else repeats.unionByName(more)
        return checkpointed(runs.merged_with(repeats.groupBy("key").agg(F.sum("docs").alias("docs"))).filter(F.col("docs") >= least_docs))
    finally:
        runs.drop()


def dropped_keys(keys: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc, copy, drops): the keys that each row loses. Keys of very many rows are met by a broadcast, bounded by HOT_PARTS."""
    total = keys.count()
    hot = shared.filter(F.col("docs") > total // HOT_PARTS + 1000)
    rest = shared.filter(F.col("docs") <= total // HOT_PARTS + 1000)
    by_hot = keys.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "key", "left")
    lost = by_hot.filter("hot").select("doc", "copy", "key", "keeper")
    lost = lost.unionByName(by_hot.filter("hot is null").select("doc", "copy", "key").join(rest, "key").select("doc", "copy", "key", "keeper"))
    return lost.filter(~F.col("doc").eqNullSafe(F.col("keeper"))).groupBy("doc", "copy").agg(F.collect_set("key").alias("drops"))


def without_repeated_lines(docs: DataFrame, folder: str, batches: int = BATCHES, fanout: int = FANOUT, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every row of `docs` (doc_id, text) without the lines that it loses.

    A line's key is the line without ASCII white space at both ends and with A-Z in lower case. Keys of at least
    `least_chars` code points in at least `least_docs` documents lose all their lines but in the largest doc_id that
    holds them. `folder` is an unused name in a store that all executors reach.

    Defined results: null and empty texts are one empty line; rows of one doc_id are one document, whose lines stay or
    go alike in all of them; rows with a null doc_id are one document below all others; a text of any length is split
    whole; an empty table gives no rows; other columns are not read. Only the texts' rows are shuffled by row, once.
    """
    path = f"{folder}/keys"
    line_keys(docs, least_chars).write.parquet(path)
    keys = docs.sparkSession.read.schema("doc bigint, copy bigint, key binary").parquet(path)
    drops = dropped_keys(keys, shared_keys(keys, folder, batches, fanout, least_docs))
    # the id and the text's hash in one null-safe key
    both = lambda df: df.withColumn("__row", F.struct(F.coalesce("doc", F.lit(0)).alias("d"), F.col("doc").isNull().alias("n"), "copy"))
    rows = both(docs.select(*_row(docs), F.col("text").alias("__text"))).join(both(drops).select("__row", "drops"), "__row", "left")

    def kept(batch: pa.RecordBatch) -> dict:
        lines = [x.split("\n") for x in texts(batch.column("__text"))]
        left = []
        for own, drop in zip(lines, batch.column("drops").to_pylist()):
            gone = set(drop or ())
            left.append([x for x in own if line_key(x, least_chars) not in gone] if gone else own)
        counts = {"n_lines": pa.array([len(x) for x in lines], pa.int64()), "n_dropped": pa.array([len(x) - len(y) for x, y in zip(lines, left)], pa.int64())}
        return {"doc_id": batch.column("doc"), **counts, "kept": pa.array(["\n".join(x) for x in left], pa.string())}

    return map_arrow(rows.select("doc", "__text", "drops"), kept, "doc_id bigint, n_lines bigint, n_dropped bigint, kept string")


def line_dedup(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text of every row; see `without_repeated_lines`."""
    rows = without_repeated_lines(docs, folder or shared_folder(docs.sparkSession))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 3),
m AS (SELECT k.r, k.doc_id, k.i, k.line, s.key IS NOT NULL AND s.keeper IS DISTINCT FROM k.doc_id AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
