"""Enrichment statistics: seeded resampling, false-discovery rates, reports."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts: the same on every engine and rerun."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def enrichment(front: DataFrame, back: DataFrame) -> DataFrame:
    """Counts and shares within each rank, expected count and enrichment: rank, tax_id, n on either side.

    Ranks that the background has. A background share is one of the front's taxa alone, whatever other taxa the background counts; where it
    counts none of them, their shares are even. Totals are one aggregation by rank, joined back.
    """
    known = front.join(back.select("rank").distinct(), "rank", "left_semi")
    joined = known.join(back.select("rank", "tax_id", F.col("n").alias("background_count")), ["rank", "tax_id"], "left")
    joined = joined.withColumn("background_count", F.coalesce("background_count", F.lit(0)))
    totals = joined.groupBy("rank").agg(F.sum("n").alias("front_total"), F.sum("background_count").alias("back_total"), F.count(F.lit(1)).alias("taxa"))
    out = joined.join(totals, "rank").withColumn("front_fraction", F.when(F.col("front_total") == 0, 0.0).otherwise(F.try_divide("n", "front_total")))
    out = out.withColumn("background_fraction", F.when(F.col("back_total") == 0, 1 / F.col("taxa")).otherwise(F.try_divide("background_count", "back_total")))
    return out.select(
        "rank", "tax_id", F.col("n").alias("front_count"), "background_count", "front_fraction", "background_fraction",
        F.ceil(F.col("background_fraction") * F.col("front_total")).alias("expected_count"),
        (F.col("front_fraction") / F.greatest("background_fraction", F.lit(1e-10))).alias("enrichment"),
    )


def benjamini_hochberg(df: DataFrame, by: list[str], p: str = "p_value", pi0: Column | None = None) -> DataFrame:
    """q_value: step-up over the p-values of each group, scaled by the share of true nulls."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(p, "tax_id"))
    m = F.count(F.lit(1)).over(Window.partitionBy(*by))
    up = Window.partitionBy(*by).orderBy(F.col("rn").desc()).rowsBetween(Window.unboundedPreceding, 0)
    raw = df.withColumn("rn", rank).withColumn("raw", F.col(p) * m * (pi0 if pi0 is not None else F.lit(1.0)) / F.col("rn"))
    return raw.withColumn("q_value", F.least(F.lit(1.0), F.min("raw").over(up))).drop("rn", "raw")


LAMBDAS = tuple(round(0.05 * i, 2) for i in range(18))


def storey(df: DataFrame, by: list[str], p: str = "p_value", lambdas: tuple[float, ...] = LAMBDAS, method: str = "smoother", draws: int = 100, seed: int = 5) -> DataFrame:
    """Storey's q-values, with the share of true nulls ``pi0`` of each group.

    smoother: the spline through all knots, read at the last, is the last knot's estimate. bootstrap: the knot whose estimates over ``draws``
    resamples of the group are nearest to the least estimate; a resample takes each value a Poisson number of times (from a hash, so reruns agree).
    """
    if method not in ("smoother", "bootstrap"):
        raise ValueError("method must be smoother or bootstrap")
    group = Window.partitionBy(*by)
    if method == "smoother":
        over = F.avg((F.col(p) >= lambdas[-1]).cast("double")).over(group) / (1 - lambdas[-1])
        return benjamini_hochberg(df.withColumn("pi0", F.least(F.lit(1.0), over)), by, p, F.col("pi0"))
    at = df.groupBy(*by).agg(*[F.avg((F.col(p) >= x).cast("double")).alias(f"_{i}") for i, x in enumerate(lambdas)])
    at = at.select(*by, F.array(*[F.col(f"_{i}") / (1 - x) for i, x in enumerate(lambdas)]).alias("whole"))
    u = uniform(F.lit(seed), F.col("draw"), *[F.col(c) for c in by], F.col("tax_id"))
    cumulative, term = 0.0, 2.718281828459045**-1
    times = F.lit(0)
    for n in range(1, 9):  # a Poisson number with mean one
        cumulative += term
        term /= n
        times = times + (u >= cumulative).cast("int")
    drawn = df.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("times", times)
    total = F.greatest(F.lit(1), F.sum("times"))
    each = drawn.groupBy(*by, "draw").agg(*[(F.sum(F.when(F.col(p) >= x, F.col("times")).otherwise(0)) / total / (1 - x)).alias(f"_{i}") for i, x in enumerate(lambdas)])
    each = each.join(at, by)
    errors = each.groupBy(*by).agg(*[F.avg((F.col(f"_{i}") - F.array_min("whole")) ** 2).alias(f"_{i}") for i in range(len(lambdas))])
    errors = errors.select(*by, F.array(*[F.col(f"_{i}") for i in range(len(lambdas))]).alias("errors"))
    pi0 = at.join(errors, by).select(*by, F.least(F.lit(1.0), F.element_at("whole", F.array_position("errors", F.array_min("errors")).cast("int"))).alias("pi0"))
    return benjamini_hochberg(df.join(pi0, by), by, p, F.col("pi0"))


def sample_with_replacement(df: DataFrame, key: str, weight: str, k: int, seed: int) -> DataFrame:
    """draw (1 to k) and a row each, by weight: each draw's number falls into one row's stretch of the running total.

    Rows are bucketed by a hash; a draw picks its bucket by the buckets' totals and then a row in it, so no task orders all rows.
    """
    buckets = 64
    rows = df.where(F.col(weight) > 0).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    upto = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.withColumn("high", F.sum(weight).over(upto("bucket", key))).withColumn("low", F.col("high") - F.col(weight))
    totals = {r[0]: r[1] for r in rows.groupBy("bucket").agg(F.sum(weight)).collect()}  # 64 at most
    ends, at = [], 0.0
    for b in sorted(totals):
        ends.append((b, at, at + float(totals[b])))
        at += float(totals[b])
    spark = df.sparkSession
    dims = spark.createDataFrame(ends or [(0, 0.0, 0.0)], "bucket int, first double, stop double")
    draws = spark.range(1, k + 1).select(F.col("id").alias("draw"), (uniform(F.lit(seed), F.col("id")) * F.lit(at)).alias("u"))
    placed = draws.join(F.broadcast(dims), (F.col("u") >= F.col("first")) & (F.col("u") < F.col("stop"))).select("draw", "bucket", (F.col("u") - F.col("first")).alias("u"))
    return placed.join(inner, "bucket").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))).drop("bucket", "u", "low", "high")


def weighted_sample(df: DataFrame, key: str, weight: str, k: int, seed: int) -> DataFrame:
    """k rows without replacement, each draw by weight: the k least exponential arrivals; reruns agree."""
    arrival = -F.log(1 - uniform(F.lit(seed), F.col(key))) / F.col(weight)
    return df.where(F.col(weight) > 0).withColumn("arrival", arrival).orderBy("arrival", key).limit(k)


#: Taxa that a task of resampling holds, about; and resamples that it draws.
BLOCK_TAXA, BLOCK_DRAWS = 4096, 50


def _drawn(seed: int, rank: str, start: int, n: int, total: int, path: list[tuple[int, int]], node: int, weights: np.ndarray) -> np.ndarray:
    """Counts of the taxa of one leaf in resamples start to start + n, of ``total`` each.

    path: for every split from the top, the weight of the node and of its left half. A split's binomials come from a generator of its own, so
    that every task below draws the same ones; node: the leaf's number, whose bits are the way.
    """
    name = int.from_bytes(hashlib.sha256(rank.encode()).digest()[:8], "little")
    counts = np.full(n, total, np.int64)
    for level, (whole, left) in enumerate(path):
        at = (1 << level) + (node >> (len(path) - level))  # the split's number, the top one's is 1
        went_left = np.random.default_rng([seed, name, start, at]).binomial(counts, left / whole if whole else 0.5)
        counts = counts - went_left if (node >> (len(path) - level - 1)) & 1 else went_left
    share = weights / weights.sum() if weights.sum() else np.full(len(weights), 1 / len(weights))
    return np.random.default_rng([seed, name, start, 0, node]).multinomial(counts, share)


def resampled_p_values(front: DataFrame, back: DataFrame, samples: int = 1000, seed: int = 7) -> DataFrame:
    """rank, tax_id, p_value: share of ``samples`` draws from the background that reach the front's count.

    Each draw deals the rank's front total among its front taxa by their background counts, evenly where all are zero or each equals the
    front's. A rank's taxa are dealt to leaves of at most about BLOCK_TAXA; a resample is split down the binary tree over the leaves, left against right
    by binomials, and within a leaf by a multinomial, which together is one multinomial. A task holds one leaf, whose taxa it reads
    once with one path, and BLOCK_DRAWS resamples at a time; all that tasks share are the sums of weights, whole numbers. Reruns agree.
    """
    e = enrichment(front, back).select("rank", "tax_id", "front_count", "background_count")
    about = e.groupBy("rank").agg(F.count(F.lit(1)).alias("taxa"), F.sum("front_count").alias("total"), (F.sum("background_count") == 0).alias("none"), F.min((F.col("front_count") == F.col("background_count")).cast("int")).alias("same"))
    splits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("taxa") / F.lit(float(BLOCK_TAXA)))).cast("int"))
    about = about.select("rank", F.ceil("total").cast("long").alias("total"), (F.col("none") | (F.col("same") == 1)).alias("even"), splits.alias("splits"))
    rows = e.join(about, "rank").withColumn("weight", F.when(F.col("even"), 1).otherwise(F.col("background_count")).cast("long"))
    rows = cut(rows.withColumn("leaf", F.pmod(F.xxhash64("tax_id"), F.pow(F.lit(2), F.col("splits")).cast("long"))))
    # sums of the nodes above each leaf, by level and number; a leaf's path has its node's and its left half's at every level
    leaves = rows.groupBy("rank", "splits", "leaf").agg(F.sum("weight").alias("weight"))
    up = leaves.select("*", F.explode(F.sequence(F.lit(0), F.col("splits"))).alias("level")).withColumn("node", F.expr("shiftright(leaf, splits - level)"))
    sums = up.groupBy("rank", "level", "node").agg(F.sum("weight").alias("whole"))
    lefts = sums.where("node % 2 = 0 AND level > 0").select("rank", (F.col("level") - 1).alias("level"), F.expr("shiftright(node, 1)").alias("node"), F.col("whole").alias("left"))
    steps = up.where("level < splits").select("rank", "leaf", "level", "node").join(sums, ["rank", "level", "node"]).join(lefts, ["rank", "level", "node"], "left")
    paths = steps.groupBy("rank", "leaf").agg(F.array_sort(F.collect_list(F.struct("level", "whole", F.coalesce("left", F.lit(0)).alias("left")))).alias("path"))
    ways = paths.select(F.col("rank").alias("of_rank"), F.col("leaf").alias("of_leaf"), "path")

    def draw(pdf: pd.DataFrame, way: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tax_id")
        one, weights, least = pdf.iloc[0], pdf["weight"].to_numpy(), pdf["front_count"].to_numpy()
        path = [(int(x["whole"]), int(x["left"])) for x in way["path"].iloc[0]] if len(way) else []
        reached = np.zeros(len(pdf), np.int64)
        for start in range(0, samples, BLOCK_DRAWS):
            n = min(BLOCK_DRAWS, samples - start)
            reached += (_drawn(seed, str(one["rank"]), start, n, int(one["total"]), path, int(one["leaf"]), weights) >= least).sum(0)
        return pd.DataFrame({"rank": pdf["rank"], "tax_id": pdf["tax_id"], "reached": reached})

    reached = rows.groupBy("rank", "leaf").cogroup(ways.groupBy("of_rank", "of_leaf")).applyInPandas(draw, "rank string, tax_id string, reached long")
    return reached.groupBy("rank", "tax_id").agg(((F.sum("reached") + 1) / F.lit(samples + 1.0)).alias("p_value"))
