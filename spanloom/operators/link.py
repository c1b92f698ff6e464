"""Linking names to identifiers: character n-gram weights and top-k by similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries, and rows that are searched, of a block: a task compares one block of each.
QUERY_BLOCK, ROW_BLOCK = 2_048, 50_000


def char_tfidf(names: DataFrame) -> DataFrame:
    """id, term, weight: character 1- and 2-grams, smoothed idf, rows of length one."""
    chars = F.filter(F.split("name", ""), lambda c: c != "")
    pairs = F.transform(F.sequence(F.lit(1), F.length("name") - 1), lambda i: F.col("name").substr(i, F.lit(2)))
    grams = names.select("id", F.explode(F.concat(chars, F.when(F.length("name") > 1, pairs).otherwise(F.array().cast("array<string>")))).alias("term"))
    tf = grams.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = names.agg(F.count(F.lit(1)).alias("n")).first()[0]
    raw = tf.join(df, "term").withColumn("raw", F.col("tf") * (F.log((F.lit(1.0 + n)) / (1 + F.col("df"))) + 1))
    return raw.withColumn("weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))).select("id", "term", "weight")


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k nearest vec_ids by inner product for each query, all rows searched exactly; of equal scores the least ids.

    Queries and rows are dealt to blocks by a hash; every block of queries meets every block of rows in a task of its own, which returns
    its best k of each query; the best of these are taken by query. Nothing passes through the driver but the two counts.
    """
    qs, vs = queries.select("vec_id", "embedding"), vectors.select("vec_id", "embedding")
    nq, nv = (max(1, -(-df.count() // size)) for df, size in ((qs, QUERY_BLOCK), (vs, ROW_BLOCK)))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    qs = qs.select("*", block(nq).alias("qb"), every(nv).alias("vb"))
    vs = vs.select("*", block(nv).alias("vb"), every(nq).alias("qb"))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            b = b.sort_values("vec_id")
            rows, ids = np.stack(b["embedding"].to_numpy()).astype(np.float64), b["vec_id"].to_numpy()
            for i in range(0, len(a), 256):
                some = a.iloc[i : i + 256]
                sims = np.stack(some["embedding"].to_numpy()).astype(np.float64) @ rows.T
                at = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                out.append(pd.DataFrame({"query_id": np.repeat(some["vec_id"].to_numpy(), at.shape[1]), "vec_id": ids[at.reshape(-1)], "score": np.take_along_axis(sims, at, 1).reshape(-1)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": float})

    met = qs.groupBy("qb", "vb").cogroup(vs.groupBy("qb", "vb")).applyInPandas(best, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def hybrid(sparse: DataFrame, dense: DataFrame, k: int, weight: float = 1.0) -> DataFrame:
    """query_id, id, score, rank: the best k by the sum of sparse score and weight * dense score; a pair that one side lacks has 0 there."""
    both = sparse.withColumnRenamed("score", "s").join(dense.withColumnRenamed("score", "d"), ["query_id", "id"], "full")
    scored = both.select("query_id", "id", (F.coalesce("s", F.lit(0.0)) + F.lit(weight) * F.coalesce("d", F.lit(0.0))).alias("score"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.round(F.col("score"), 9).desc(), "id"))).where(F.col("rank") <= k)


def sparse_scores(left: DataFrame, right: DataFrame) -> DataFrame:
    """query_id, id, score: inner products of rows (id, term, weight) that share a term."""
    q = left.select(F.col("id").alias("query_id"), "term", F.col("weight").alias("w"))
    return q.join(right.select("id", "term", "weight"), "term").groupBy("query_id", "id").agg(F.sum(F.col("w") * F.col("weight")).alias("score"))
