"""Registered queries: operators applied to the fixtures, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warren.sources.fixtures import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6):
    """Registers a function of `fx` (a fixture's name to its DataFrame). Doubles are rounded, since engines add in another order."""

    def put(make: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = make(lambda table: view(spark, sf_dir, table))
            return out.select(*[F.round(c, digits).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in out.dtypes])

        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql)
        return make

    return put
