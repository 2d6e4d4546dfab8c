"""What operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder that the cluster names; a local run without one gets its own."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="warren-checkpoint-"))
    return df.checkpoint()
