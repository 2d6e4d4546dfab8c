"""What the corpus operators share: Arrow batches, checkpoints, prefix sums and connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What splits words where the contracts say `[^\x20\x09-\x0D]+`, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder that the cluster names; only a local run without one gets its own."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="warren-checkpoint-"))
    return df.checkpoint()


def map_arrow(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Runs `rows` (batch in, named arrays out) over Arrow batches, where the partitions lie."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = rows(batch)
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _array(values):
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.array(values)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """The texts; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def running_total(df: DataFrame, group: list[str], order: list[Column], digits: tuple[Column, int], amount: Column, name: str, per_group: DataFrame | None = None) -> DataFrame:
    """Adds `name`: the sum of `amount` over the group's earlier rows, without ever gathering a group in one task.

    `digits` is a string column that rises with `order` and how many of its first characters name a bucket. Sums
    over buckets, and over the buckets that share the first half of these characters, are taken first; a window
    over each level (as many rows as there are names of half the length) gives each bucket's start, and a window
    inside each bucket does the rest. All passes read the same deterministic values, so a lost executor changes
    nothing. Other columns of `per_group` (a row for each group) travel with the buckets' starts, so the rows
    themselves are shuffled once.
    """
    text, many = digits
    rows = df.withColumn("__bucket", F.substring(text, 1, many)).withColumn("__amount", amount)
    # groups may be null, so the join goes by one null-safe key
    key = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0null")) for k in group], F.col("__bucket"))
    before = lambda *keys: Window.partitionBy(*group, *keys).orderBy("__upper" if not keys else "__bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda over: F.coalesce(F.sum("__sum").over(over), F.lit(0))
    sums = rows.groupBy(*group, "__bucket").agg(F.sum("__amount").alias("__sum")).withColumn("__upper", F.substring("__bucket", 1, many // 2))
    uppers = sums.groupBy(*group, "__upper").agg(F.sum("__sum").alias("__sum")).withColumn("__base", earlier(before())).drop("__sum")
    same = lambda other, keys: reduce(lambda a, k: a & F.col(k).eqNullSafe(other[f"__of_{k}"]), keys, F.lit(True))
    renamed = lambda one, keys: one.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    uppers = renamed(uppers, [*group, "__upper"])
    starts = sums.withColumn("__in", earlier(before("__upper"))).join(uppers, same(uppers, [*group, "__upper"]))
    starts = starts.withColumn("__from", F.col("__base") + F.col("__in")).select(*group, "__bucket", "__from")
    more = [c for c in per_group.columns if c not in group] if per_group is not None else []
    if per_group is not None:
        named = renamed(per_group, group)
        starts = starts.join(named, same(named, group))
    starts = starts.select(key.alias("__key"), "__from", *more)
    inside = Window.partitionBy("__key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("__key", key)
        .join(starts, "__key")
        .withColumn(name, F.col("__from") + F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
        .drop("__key", "__bucket", "__amount", "__from")
    )


#: So few edges are worked on in so few tasks, which spares a small file for every task and partition of each step.
FEW_EDGES, FEW_TASKS = 200_000, 8


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in `edges` (u, v); the component is its smallest node.

    Alternating large-star and small-star steps; each round is an aggregate and a join, checkpointed, and ends
    when no edge changes; more rounds than `most_rounds` (their number grows with the logarithm of the longest
    chain) raise. Hubs are pre-aggregated and their joins left to AQE's skew handling.
    """
    now = checkpointed(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _state(now)
    for _ in range(most_rounds):
        if seen[0] == 0:
            break
        few = (lambda df: df.coalesce(FEW_TASKS)) if seen[0] <= FEW_EDGES else (lambda df: df)
        now = few(now)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = few(both.groupBy("u").agg(F.min("v").alias("m"))).select("u", F.least("u", "m").alias("m"))
        large = few(few(both.join(least, "u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = few(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = few(large.join(least, "u"))
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).distinct()
        now = checkpointed(few(small))
        last, seen = seen, _state(now)
        if last == seen:
            break
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def shared_folder(spark: SparkSession) -> str:
    """A new name in the folder that driver and executors share."""
    from uuid import uuid4

    checkpointed(spark.range(0))  # sets the folder where it is unset
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid4().hex}"
