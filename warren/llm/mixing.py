"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.llm.common import WORD, running_total

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most this many times its size.
MOST_EPOCHS = 3
#: Hexadecimal digits of the random key that name a bucket: enough for about this many rows in each.
ROWS_A_BUCKET = 1500


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Water-filling in closed form: sources in order of their cap per unit of weight are full up to the first
    whose share of what is left stays below its cap. One row per source; documents are not touched here.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ranked) - 1) % len(weights) + 1)
    fill = Window.orderBy((most_epochs * F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before, onward, every = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing), fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(most_epochs * F.col("source_size")).over(before), F.lit(0))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("left", left)
        .withColumn("rest", F.sum("weight").over(onward))
        .withColumn("full", F.col("left") * F.col("weight") >= most_epochs * F.col("source_size") * F.col("rest"))
        .withColumn("level_left", F.max(F.when(~F.col("full"), F.col("left"))).over(every))
        .withColumn("level_rest", F.max(F.when(~F.col("full"), F.col("rest"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(F.col("full"), (most_epochs * F.col("source_size")).cast("double")).otherwise((F.col("level_left") * F.col("weight")).cast("double") / F.col("level_rest").cast("double")).alias("target"),
        )
    )


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """All rows of `docs` (doc_id, text, source, others kept) with size, source_size, target and taken.

    Every document gets a hash-random key (of its id and text, so that rows that share an id or lack one spread); within a source, documents lie in key order and their prefix sums of
    words are cut at the source's budget. Whole budgets of the source's size are epochs that take every
    document once; the cut takes the last document's first words only. Rows repeat on a rerun.

    Defined results: null text is of size 0; null sources are one source, last in order; null ids are ids like
    any other; repeated rows tie and count each; a text of any length is one row of its size; an empty table gives
    no rows; columns named like a result are replaced.
    """
    own = ["size", "source_size", "target", "taken", "__random", "__start"]
    rows = docs.drop(*own).withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    rows = rows.withColumn("__random", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text")))
    # a footer count; the number of buckets only shapes the work, not the result
    digits = len(f"{max(1, docs.count() // ROWS_A_BUCKET):x}")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, most_epochs)
    joined = running_total(rows, ["source"], [F.col("__random"), F.col("doc_id"), F.col("size")], (F.col("__random"), digits), F.col("size"), "__start", aims)
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    cut = budget - epochs * F.col("source_size") - F.col("__start")
    return joined.withColumn("taken", (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), cut))).cast("long")).drop("__random", "__start")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a document once per epoch, and the one at the cut with the words it still gives."""
    mixed = mix(docs, **options).filter("taken > 0")
    part = F.col("taken") - F.col("__copy") * F.col("size")
    last = F.floor((F.col("taken") - 1) / F.col("size")).cast("int")
    copies = mixed.withColumn("__copy", F.explode(F.sequence(F.lit(0), last)))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)), F.lit(1), part.cast("int")), " ")
    whole = part >= F.col("size")
    return copies.withColumn("text", F.when(whole, F.col("text")).otherwise(first)).withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast("long")).drop("size", "source_size", "target", "taken", "__copy")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), 'null'), text)) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
t AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT)
            - CAST(coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS left_over,
         CAST(sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM w),
f AS (SELECT *, left_over * weight >= 3 * source_size * rest AS is_full FROM t),
aim AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
         ELSE CAST((SELECT max(left_over) FROM f WHERE NOT is_full) * weight AS DOUBLE) / CAST((SELECT max(rest) FROM f WHERE NOT is_full) AS DOUBLE) END AS target
  FROM f),
p AS (
  SELECT d.doc_id, d.size, a.source_size, a.target, CAST(floor(a.target + 0.5) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN aim a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE CAST((budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) AS BIGINT) END AS taken
FROM p
"""
