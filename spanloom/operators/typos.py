"""Known typos in names and texts, by a join on words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.text import text_preprocess
from spanloom.operators.boundaries import let, words
from spanloom.sources.files import read_pairs

#: Up to so many typos go to every task; more are joined by a shuffle.
FEW = 50_000


def read_typos(spark: SparkSession, path: str) -> DataFrame:
    """typo, correction of a file of lines typo||correction: the last line of a typo counts, a missing correction is the empty string."""
    rows = read_pairs(spark, path, "typo", "correction").select(F.trim("typo").alias("typo"), F.trim("correction").alias("correction"), F.monotonically_increasing_id().alias("ord"))
    return rows.groupBy("typo").agg(F.max_by("correction", "ord").alias("correction"))


def _mended(spark: SparkSession, typos: list[tuple[str, str]]):
    """Lists of words to their words, corrected and joined by single spaces, by Arrow's own functions."""
    shared = spark.sparkContext.broadcast(typos)

    def run(lists: pa.Array) -> pa.Array:
        typo, correction = (pa.array([t[i] for t in shared.value], pa.string()) for i in (0, 1))
        own = lists.flatten().cast(pa.string())
        out = pc.coalesce(correction.take(pc.index_in(own, value_set=typo)), own)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), out), " ")
        return pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), joined)

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}  # the types themselves, as Spark reads them
    return F.arrow_udf(run, "string")


def correct(rows: DataFrame, typos: DataFrame, column: str = "text") -> DataFrame:
    """``rows`` with the words of a column corrected: words between white space, each by its typo or as it is, joined by single spaces.

    typos: typo, correction, a typo once. Up to FEW typos go to every task, which corrects each text in one pass, without a shuffle. With
    more, only words that are typos leave their row: their places in each different text, known by its digest, come
    back as one list a text, and the text is put together from the stretches between them, each word once. An empty correction leaves the spaces around it; a null text stays null.
    """
    own, at = F.col(f"`{column}`"), "_typo_digest"
    known = typos.select("typo", "correction")
    few = known.limit(FEW + 1).collect()
    if len(few) <= FEW:
        fixed = _mended(rows.sparkSession, [(r[0], r[1]) for r in few if r[0] is not None])(words(own))
        return rows.select(*[F.trim(fixed).alias(c) if c == column else F.col(f"`{c}`") for c in rows.columns])
    told = rows.withColumn(at, F.sha2(own.cast("binary"), 256))
    each = told.where(own.isNotNull()).select(at, F.posexplode(words(own)).alias("pos", "typo"))
    found = each.join(known.where("correction IS NOT NULL"), "typo").select(at, "pos", "correction").distinct()
    lists = found.groupBy(at).agg(F.array_sort(F.collect_list(F.struct("pos", "correction"))).alias("_typo_list"))
    known_at = F.col("_typo_list")

    def mended(ws: Column) -> Column:
        upto = lambda i: F.when(i > 0, F.get(known_at, i - 1)["pos"] + 1).otherwise(0)
        parts = F.transform(known_at, lambda f, i: F.concat(F.slice(ws, upto(i) + 1, f["pos"] - upto(i)), F.array(f["correction"])))
        rest = F.slice(ws, upto(F.size(known_at)) + 1, F.size(ws))
        return F.when(known_at.isNull(), ws).otherwise(F.concat(F.flatten(parts), rest))

    out = told.join(lists, at, "left").withColumn("_typo_fixed", F.when(own.isNotNull(), F.trim(F.array_join(let(words(own), mended), " "))))
    return out.select(*[F.col("_typo_fixed").alias(c) if c == column else F.col(f"`{c}`") for c in rows.columns])


def preprocess(rows: DataFrame, column: str = "name", typos: DataFrame | None = None, lowercase: bool = True, remove_punctuation: bool = True, ignore: str = "") -> DataFrame:
    """``rows`` with a column lower-cased, then corrected, then without punctuation but for ``ignore``, each if asked for."""
    own = F.col(f"`{column}`")
    out = rows.withColumn(column, F.lower(own)) if lowercase else rows
    out = correct(out, typos, column) if typos is not None else out
    return out.withColumn(column, text_preprocess(own, False, remove_punctuation, ignore))
