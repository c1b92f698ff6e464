"""Cutting the lineage of iterative operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` by a checkpoint in the folder that spark.checkpoint.dir names; in local mode a folder of our own where that is unset, an error on a cluster."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='spanloom-')}")
    return df.checkpoint()
