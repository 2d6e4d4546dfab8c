"""Running values over rows too many for one window: blocks, their summaries, a scan over the summaries, carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames, seconds and lines of a block.
FRAMES, SECONDS, LINES = 100_000, 3600.0, 1_000_000


def block_of(column: str, width: float) -> Column:
    """The block of a number; NaN and null, which come last in order, lie in blocks of their own."""
    c = F.col(column).cast("double")
    return F.when(c.isNull(), F.lit((1 << 62) + 1)).when(F.isnan(c), F.lit(1 << 62)).otherwise(F.floor(c / width))


def scan(df: DataFrame, keys: list[str] | tuple[str, ...], order: list[str], block: Column, last: dict[str, Column] | None = None, next: dict[str, Column] | None = None, before: dict[str, Column] | None = None, total: dict[str, Column] | None = None) -> DataFrame:
    """Adds running values to rows in `order` (columns, rising, nulls last) within `keys`.

    `last` gives the last value that is not null up to a row, `next` the first from it on, `before` the value of the
    row before (null at the first), `total` the sum up to and with the row.

    `block` must not fall along the order. A window holds a block only; each block is summarised by partial
    aggregation to one row, a window over these rows (one of a session's blocks) finds what precedes and follows a
    block, and a join carries it in. Keys may be null. Values depend on the order alone, not on the blocks, but for
    the order in which doubles are added.
    """
    keys, last, next, before, total = list(keys), last or {}, next or {}, before or {}, total or {}
    values = last | next | before | total
    rows = df.withColumn("__block", block).withColumns({f"__v_{n}": c for n, c in values.items()})
    place = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])
    some = lambda n: F.when(F.col(f"__v_{n}").isNotNull(), place)
    sums = rows.groupBy(*keys, "__block").agg(
        F.count("*").alias("__rows"),
        *[F.max_by(f"__v_{n}", some(n)).alias(f"__s_{n}") for n in last],
        *[F.min_by(f"__v_{n}", some(n)).alias(f"__s_{n}") for n in next],
        *[F.max_by(F.struct(f"__v_{n}"), place).alias(f"__s_{n}") for n in before],
        *[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in total],
    )
    over = Window.partitionBy(*keys).orderBy("__block")
    past, future = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(1, Window.unboundedFollowing)
    named = {k: f"__of_{k}" for k in [*keys, "__block"]}
    carried = sums.select(
        *[F.col(k).alias(n) for k, n in named.items()],
        *[F.last(f"__s_{n}", ignorenulls=True).over(past).alias(f"__c_{n}") for n in [*last, *before]],
        *[F.first(f"__s_{n}", ignorenulls=True).over(future).alias(f"__c_{n}") for n in next],
        *[F.sum(f"__s_{n}").over(past).alias(f"__c_{n}") for n in total],
    )
    same = F.lit(True)
    for k, n in named.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    joined = rows.join(carried, same)
    inside = Window.partitionBy(*keys, "__block").orderBy(*[F.asc_nulls_last(c) for c in order])
    back, on = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(0, Window.unboundedFollowing)
    out = {n: F.coalesce(F.last(f"__v_{n}", ignorenulls=True).over(back), f"__c_{n}") for n in last}
    out |= {n: F.coalesce(F.first(f"__v_{n}", ignorenulls=True).over(on), f"__c_{n}") for n in next}
    out |= {n: F.coalesce(F.lag(F.struct(f"__v_{n}")).over(inside), f"__c_{n}")[f"__v_{n}"] for n in before}
    out |= {n: F.coalesce(F.sum(f"__v_{n}").over(back), F.lit(0)) + F.coalesce(f"__c_{n}", F.lit(0)) for n in total}
    return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])
