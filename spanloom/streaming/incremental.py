"""Annotation of files as they arrive: each file once, kept by the query's checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.sources.files import COLLECTION, passages


def annotate_new_files(spark: SparkSession, folder: str, out: str, checkpoint: str, annotate: Callable[[DataFrame], DataFrame], pattern: str = "*_bioc.json") -> StreamingQuery:
    """Writes ``annotate`` of the passages of all files not yet seen to the Parquet folder ``out``, then stops.

    Each batch is handed over as an ordinary DataFrame, so annotate may use windows and joins.
    """
    stream = spark.readStream.schema(COLLECTION).option("multiLine", True).option("pathGlobFilter", pattern).json(folder)
    rows = stream.select("*", F.col("_metadata.file_name").alias("file_name"))

    def one(batch: DataFrame, number: int) -> None:
        # the batch's own folder, so that a batch that is run again replaces what it had written
        annotate(passages(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
