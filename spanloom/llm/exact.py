"""Exact deduplication: a tree merge of sorted digest runs, by DataFrame operations only.

Every row falls to one of FAN ** LEVELS leaf runs by a hash of its id. A leaf run holds one entry
per text: its digest, the retained id and the number of rows (summed in the map tasks first, so that a text with a third of all
rows is no hot spot). In each round FAN runs with neighbouring numbers exchange their entries (a binomial tree of depth LEVELS), cut
into slices by digest prefix, so that the last round is as parallel as the first. What a task gets of a slice it merges
in the order of digest, length and a second hash of the whole text (the verification), best id first; of each stretch of
entries that agree in all three the first stays and takes their number of rows. No stretch has more than FAN entries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import fresh, lookup, staged, table

FAN, LEVELS = 8, 2
_KEY = ["digest", "n_bytes", "guard"]


def text_digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("guard"),
    )


def merge_runs(digests: DataFrame, largest: bool = True) -> DataFrame:
    """One row per text: _KEY, keep_id, group_size."""
    best = F.max if largest else F.min
    runs = digests.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(FAN**LEVELS)).cast("int").alias("run"), *_KEY).agg(
        best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    stretch = Window.partitionBy("run", "slice", *_KEY)
    first = F.col("keep_id").desc_nulls_last() if largest else F.col("keep_id").asc_nulls_last()
    for _ in range(LEVELS):
        met = runs.withColumn("run", F.floor(F.col("run") / FAN).cast("int")).withColumn("slice", F.substring("digest", 1, 3)).repartition("run", "slice")
        merged = stretch.orderBy(first)
        total = F.sum("group_size").over(merged.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        runs = met.withColumn("group_size", total).withColumn("nth", F.row_number().over(merged)).where("nth = 1").drop("nth", "slice")
    return runs.drop("run")


def exact_dedup(spark: SparkSession, docs: DataFrame, largest: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty. Of equal texts the largest (or smallest) doc_id stays; among rows
    that repeat that id with that text exactly one is kept. Null ids lose to any id. An empty
    table gives no rows; other columns are ignored.
    """
    rows = staged(spark, text_digests(docs))
    groups = staged(spark, merge_runs(rows, largest))
    total = rows.count()
    same = Window.partitionBy("digest", "doc_id").orderBy("n_bytes")
    return lookup(rows, groups, _KEY, "group_size", total).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(spark: SparkSession, docs: DataFrame, largest: bool = True) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns stay, whatever their names.

    A null text counts as empty. Of equal texts the row with the largest (or smallest) doc_id stays, null ids last; of rows that
    repeat that id and text one stays. One id with two texts is two documents. An empty table stays empty.
    """
    rows = staged(spark, text_digests(docs))
    groups = staged(spark, merge_runs(rows, largest))
    kept = lookup(rows, groups, _KEY, "group_size", rows.count()).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = kept.groupBy(*_KEY).agg(F.first("keep_id").alias("doc_id"), F.count(F.lit(1)).alias("times"))
    key = ["doc_id", *_KEY]
    own, other = {c: fresh(c) for c in key}, {c: fresh(c) for c in [*key, "times"]}
    text = F.coalesce(F.col("text"), F.lit(""))
    told = docs.withColumns({own["doc_id"]: F.col("doc_id"), own["digest"]: F.unhex(F.sha2(text.cast("binary"), 256)), own["n_bytes"]: F.octet_length(text), own["guard"]: F.xxhash64(text)})
    kept = kept.select(*[F.col(c).alias(n) for c, n in other.items()])
    same = reduce(lambda x, y: x & y, [F.col(own[c]).eqNullSafe(F.col(other[c])) for c in key])
    met = told.join(kept, same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # rows that repeat both id and text are few; only these are sorted out
    return met.where(F.col(other["times"]) == 1).select(*columns).unionAll(met.where(F.col(other["times"]) > 1).dropDuplicates(list(own.values())).select(*columns))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = """
SELECT doc_id, keep_id, group_size,
       doc_id = keep_id AND row_number() OVER (PARTITION BY doc_id, t ORDER BY 1) = 1 AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
"""
