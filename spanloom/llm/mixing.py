"""Mixing sources to target weights.

A source's words, its documents laid end to end in a fixed order, are packed into blocks of BLOCK words
(the last may be shorter). The mix has as many slots as its targets have blocks. Each
output shard draws how many of its slots go to each source from a multinomial over what the sources still
owe, so shards are mixed at random while the totals meet the targets. A source's slots, counted
through all shards, map through a pseudorandom permutation of its block numbers, a new one for each
pass over the source, and the slots are joined with the blocks by number. So in a mix that takes a source
1.4 times each of its blocks is taken once or twice, and none more often than the cap.

Only one row per source and one per shard and source are handled on the driver. What has a row for each
document, bucket or block is joined by merging: Spark sizes it by the files it comes from, before
documents are cut into blocks, and would broadcast it through the driver. Offsets of
documents come from sums per (source, bucket), so no task sees a whole source.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import WS, fresh, staged, table

BLOCK, CAP, SEED = 64, 3, 17
#: Slots of a shard, while there are at most MAX_SHARDS; rows of a bucket, by count.
SHARD_SLOTS, MAX_SHARDS, BUCKET_ROWS = 4096, 2048, 100
#: Buckets of a shelf: no task orders more buckets, or shelves of a source, than rows / (100 * SHELF).
SHELF = 4096


def targets(sizes: list[int], weights: list[float], cap: float = CAP) -> list[float]:
    """Shares of sum(sizes) by weight; what lies over cap * size is shared anew by weight among the rest."""
    out, left, rest = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while rest:
        w = sum(weights[i] for i in rest)
        full = {i for i in rest if left * weights[i] / w > cap * sizes[i]}
        if not full:
            for i in rest:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in full)
        rest -= full
    return out


def permute(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key: a Feistel network on the next
    square's halves, walked on until it falls below n."""
    side = np.ceil(np.sqrt(n)).astype(np.uint64)
    side = np.maximum(side, np.uint64(1))
    x = j.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        a, b = x[todo] // side[todo], x[todo] % side[todo]
        for r in range(4):
            h = (b + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2**64)) ^ key[todo]
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            a, b = b, (a + (h >> np.uint64(20))) % side[todo]
        x[todo] = a * side[todo] + b
        todo = todo[x[todo] >= n[todo].astype(np.uint64)]
    return x.astype(np.int64)


def draw(quota: list[int], seed: int = SEED) -> list[tuple[int, int, int, int]]:
    """(shard, source number, first slot, slots), shard by shard."""
    owed = np.array(quota, np.int64)
    total = int(owed.sum())
    shards = max(1, min(MAX_SHARDS, -(-total // SHARD_SLOTS)))
    first, out = np.zeros(len(owed), np.int64), []
    for k in range(shards):
        room = (k + 1) * total // shards - k * total // shards
        rng = np.random.default_rng([seed, k])
        while room and owed.sum():
            got = np.minimum(rng.multinomial(room, owed / owed.sum()), owed)
            out += [(k, int(i), int(first[i]), int(got[i])) for i in np.flatnonzero(got)]
            first += got
            owed -= got
            room -= int(got.sum())
    return out


def n_words(text: Column) -> Column:
    """The number of gaps between words: a run of white space, or the end of the text."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{WS}+", "")
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(F.regexp_replace(text, f"{WS}+$", ""), f"{WS}+"))).cast("long")


def sizes_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.xxhash64("text").alias("key"), n_words(F.col("text")).alias("size"))


def mix_sources(spark: SparkSession, docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken.

    A null text has size 0 and is taken 0 times; a null source is a source of its own, the last. Repeated
    rows are documents of their own. An empty table, or one without words, takes nothing.
    """
    rows = staged(spark, sizes_of(docs))
    per = sorted(
        rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect(),
        key=lambda r: (r[0] is None, r[0] or ""),
    )  # one row per source; Python compares strings by code point
    sizes = [r[1] for r in per]
    weights = [1 + i % 3 for i in range(len(per))]
    target = targets(sizes, weights)
    blocks = [-(-s // BLOCK) for s in sizes]
    quota = [min(CAP * b, round(t * b / s)) if s else 0 for t, b, s in zip(target, blocks, sizes)]
    dim = spark.createDataFrame(
        [(i, r[0], sizes[i], float(target[i]), r[2] // BUCKET_ROWS + 1) for i, r in enumerate(per)],
        "no int, __source string, source_size long, target double, buckets long",
    )
    keyed = rows.join(F.broadcast(dim), rows["source"].eqNullSafe(dim["__source"])).drop("__source")
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "key"), F.col("buckets"))).drop("buckets")
    # words before a bucket: those of the shelves before its own, and of the buckets before it on its shelf
    sums = keyed.groupBy("no", "bucket").agg(F.sum("size").alias("words")).withColumn("shelf", F.floor(F.col("bucket") / SHELF))
    upto = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    shelves = sums.groupBy("no", "shelf").agg(F.sum("words").alias("words"))
    shelves = shelves.select("no", "shelf", F.coalesce(F.sum("words").over(upto("no", "shelf")), F.lit(0)).alias("below"))
    base = sums.withColumn("within", F.coalesce(F.sum("words").over(upto("no", "shelf", "bucket")), F.lit(0))).join(shelves.hint("merge"), ["no", "shelf"])
    base = base.select(F.col("no").alias("__no"), F.col("bucket").alias("__bucket"), (F.col("below") + F.col("within")).alias("base"))
    inside = Window.partitionBy("no", "bucket").orderBy("doc_id", "key", "size")
    placed = keyed.withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("rn", F.row_number().over(inside)).drop("key")
    placed = placed.join(base.hint("merge"), (F.col("no") == F.col("__no")) & (F.col("bucket") == F.col("__bucket"))).drop("__no", "__bucket")
    placed = staged(spark, placed.withColumn("end", F.col("base") + F.col("end")).withColumn("begin", F.col("end") - F.col("size")).drop("base"))

    slots = spark.createDataFrame(draw(quota, seed) or [(0, 0, 0, 0)], "shard int, no int, first long, slots long")
    n_of, keys = np.array(blocks or [1], np.int64), np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)

    def to_blocks(batches):
        for pdf in batches:
            if len(pdf):
                n = n_of[pdf["no"].to_numpy()]
                turn, j = np.divmod(pdf["slot"].to_numpy(), n)
                key = keys ^ (pdf["no"].to_numpy().astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (turn.astype(np.uint64) << np.uint64(48))
                yield pd.DataFrame({"no": pdf["no"], "block": permute(j, n, key), "shard": pdf["shard"]})

    drawn = (
        slots.where("slots > 0")
        .repartition(max(1, min(MAX_SHARDS, sum(quota) // (16 * SHARD_SLOTS))))
        .select("shard", "no", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slots") - 1)).alias("slot"))
        .mapInPandas(to_blocks, "no int, block long, shard int")
    )
    times = drawn.groupBy("no", "block").agg(F.count(F.lit(1)).alias("times"))
    parts = placed.where("size > 0").select(
        "no", "bucket", "rn", "begin", "end",
        F.explode(F.sequence(F.floor(F.col("begin") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))).alias("block"),
    )
    words = F.least("end", (F.col("block") + 1) * BLOCK) - F.greatest("begin", F.col("block") * BLOCK)
    taken = parts.join(times.hint("merge"), ["no", "block"]).groupBy("no", "bucket", "rn").agg(F.sum(words * F.col("times")).cast("long").alias("taken"))
    return placed.join(taken.hint("merge"), ["no", "bucket", "rn"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(spark: SparkSession, docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix as documents: each row as often as the mix takes it, in whole documents; all columns stay, whatever their names.

    taken / size copies; of a broken count the rest is one more copy with that probability, by a
    hash of id and text, so that totals stay on target and reruns agree. Documents without words stay once. Rows that agree in id,
    source and size share what is taken of them evenly. An empty table stays empty.
    """
    key = ["doc_id", "source", "size"]
    own, other = {c: fresh(c) for c in key}, {c: fresh(c) for c in [*key, "times"]}
    mixed = mix_sources(spark, docs, seed).groupBy(*key).agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n"))
    times = F.when(F.col("size") > 0, F.col("taken") / (F.col("size") * F.col("n"))).otherwise(1.0)
    mixed = mixed.withColumn("times", times).select(*[F.col(c).alias(n) for c, n in other.items()])
    told = docs.withColumns({own["doc_id"]: F.col("doc_id"), own["source"]: F.col("source"), own["size"]: n_words(F.col("text"))})
    same = reduce(lambda x, y: x & y, [F.col(own[c]).eqNullSafe(F.col(other[c])) for c in key])
    chance = F.pmod(F.xxhash64(F.col(own["doc_id"]), F.col("text"), F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    copies = F.floor(F.col(other["times"]) + chance).cast("int")
    return told.join(mixed.hint("merge"), same).withColumn(other["times"], F.explode(F.array_repeat(F.lit(1), copies))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, table(spark, sf_dir, "documents")).drop("source")
