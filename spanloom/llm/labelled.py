"""A bounded sample of labelled documents for the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import crc_mod

#: Characters that are learned from in a text, and the parts, evenly spaced over the whole text, that a longer one gives.
CAP, PARTS = 60_000, 8


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, m: int, held: int, each: int, cap: int = CAP) -> tuple[list[str], np.ndarray]:
    """At most ``each`` texts of either class, never of the fold crc32(doc_id) % m == held; the first by a hash of the id.

    A text beyond ``cap`` characters is learned from in PARTS parts of cap / PARTS characters, from its start to its end. An id with
    several labels has the more frequent one (1 if even); null ids and labels, and labels without a document, are left out.
    """
    open_ = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", m) != held))
    open_ = open_.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = [open_.where(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for k in (0, 1)]
    ids = spark.createDataFrame(chosen[0].unionByName(chosen[1]).collect() or [], "doc_id long, y int")  # at most 2 * each rows
    part = cap // PARTS
    at = lambda i: (F.floor(i * (F.length("text") - part) / (PARTS - 1)) + 1).cast("int")
    cut = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.substring(F.col("text"), at(i), F.lit(part))), " ")
    text = F.when(F.length("text") <= cap, F.col("text")).otherwise(cut).alias("text")
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").select("doc_id", text, "y").collect()
    rows.sort(key=lambda r: (r[0], r[1]))
    return [r[1] for r in rows], np.array([r[2] for r in rows], np.float32)
