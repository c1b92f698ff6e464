"""Near-duplicate detection by ProbMinHash, banding and verification.

A text is a set of distinct five-word shingles, as links are defined on these; a shingle's weight follows from its own words
alone (1 to 1.5, by their length), so that longer, rarer ones count for more and registers agree about as often as the
similarity that decides says. Every shingle is a Poisson process whose rate is its weight: its arrivals, drawn from its hash alone, fall on random
registers, and a register keeps its earliest arrival. A shingle stops as soon as its next arrival comes
after the latest register (early termination). Registers of two texts agree with the probability Jaccard
similarity of their weighted sets. BANDS bands of ROWS registers propose pairs: in each bucket of equal bands the
members are compared with the smallest id, and exact set similarity (Jaccard >= threshold) decides.

No link between different texts is lost in a bucket: with centre c, threshold t and distance d = 1 -
Jaccard (a metric), members with d <= 1-t join c's class; those farther than 2(1-t) can't be
linked to any of these. What did not join is searched on: up to SMALL such members of a bucket at once,
in one group (equal groups once). More of them are joined on the rarest shingles of each set, of which two sets
with a link share at least one, whatever the size of the bucket; a shingle in more than SMALL sets is
searched in pairs of blocks. Members at
a distance between the two that end in another class are compared with all that joined, in blocks. Buckets are never collected: the centre is a minimum per bucket, and comparisons run in groups of at most CHUNK
members per centre.

Equal shingle sets are one representative from the start, so copies cost one row each. A representative is known by the number of
its row, not by its doc_id, as rows may repeat an id with other texts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import as_bytes, fresh, lookup, mix, shingles, staged, table, word_bounds

BANDS, ROWS, CHUNK, SMALL, BLOCK, SIZE, THRESHOLD = 24, 5, 128, 2048, 512, 5, 0.8
#: Texts are signed in batches of so many, and handed on in slices of SLICE rows, so that a worker holds the words of few texts at once.
BATCH, SLICE = 128, 512
_SALTS = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def prob_min_hash(items: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = BANDS * ROWS) -> np.ndarray:
    """The element that holds each of m registers, for n weighted sets at once.

    items: distinct 64-bit hashes of each set, one set after the other; owner: the set's number.
    """
    best = np.full(n * m, np.inf)
    held = np.zeros(n * m, np.uint64)
    at, w, k = np.zeros(len(items)), weights.astype(float), 0
    while len(items):
        h = mix(items ^ _SALTS[k % 4096])
        k += 1
        at = at - np.log(((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / w
        slot = owner * m + (mix(h + np.uint64(k)) % np.uint64(m)).astype(np.int64)
        live = at < best.reshape(n, m).max(1)[owner]
        items, w, owner, at, slot = items[live], w[live], owner[live], at[live], slot[live]
        np.minimum.at(best, slot, at)
        won = at == best[slot]
        held[slot[won]] = items[won]
    return held.reshape(n, m)


def weighted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text, and their weights: 1 and a 128th of the bytes of their words, 64 at most."""
    items, first = np.unique(shingles(text, SIZE), return_index=True)
    start, end = word_bounds(np.frombuffer(text, np.uint8))
    bytes_ = np.concatenate(([0], np.cumsum(end - start)))
    return items, 1 + np.minimum(bytes_[np.minimum(first + SIZE, len(start))] - bytes_[first], 64) / 128


def _digest(items: np.ndarray) -> bytes:
    return np.array([np.bitwise_xor.reduce(mix(items)), items.sum(dtype=np.uint64)], np.uint64).tobytes()


def signatures(texts: list[str | None]) -> list[tuple[bytes, np.ndarray] | None]:
    """Digest of the shingle set and the hash of each band; None for a text without words."""
    got = [weighted(as_bytes(t)) for t in texts]
    owner = np.repeat(np.arange(len(got)), [len(x) for x, _ in got])
    items, weights = (np.concatenate([x[i] for x in got]) if got else np.zeros(0, t) for i, t in enumerate((np.uint64, float)))
    bands = prob_min_hash(items, weights, owner, len(got)).reshape(len(got), BANDS, ROWS)
    keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[None], len(got), 0)
    for i in range(ROWS):
        keys = mix(keys * np.uint64(31) + bands[:, :, i])
    keys = keys.astype(np.int64)
    return [(_digest(x), keys[i]) if len(x) else None for i, (x, _) in enumerate(got)]


def _slices(batches):
    """The batches in slices of SLICE rows; when they end, what the worker has freed goes back to the system."""
    for b in batches:
        yield from (b.slice(i, SLICE) for i in range(0, b.num_rows, SLICE))
    pa.default_memory_pool().release_unused()


def _signatures(docs: DataFrame) -> DataFrame:
    """Of each row: a number of its own, doc_id, a hash of the text, and what ``signatures`` gives."""

    def run(batches):
        for b in _slices(batches):
            texts = b.column("text").to_pylist()
            got = [x for i in range(0, len(texts), BATCH) for x in signatures(texts[i : i + BATCH])]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("row", "doc_id", "said")), pa.array([g and g[0] for g in got], pa.binary()), pa.array([g[1] if g else None for g in got], pa.list_(pa.int64()))],
                ["row", "doc_id", "said", "digest", "bands"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("said"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, said long, digest binary, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id (here the representative's number, rep) and the sorted distinct shingle hashes, as bytes, of texts with that digest."""

    def run(batches):
        for b in _slices(batches):
            reps, sets = [], []
            for rep, digest, text in zip(*(b.column(c).to_pylist() for c in ("rep", "digest", "text")), strict=True):
                items = np.unique(shingles(as_bytes(text), SIZE))
                if len(items) and _digest(items) == digest:
                    reps.append(rep)
                    sets.append(items.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "set"])

    return docs.mapInArrow(run, "doc_id long, set binary")


def _compare(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact Jaccard similarity of each distinct (rep, centre)."""
    edges = edges.select("rep", "centre").distinct()
    degree = edges.groupBy("centre").agg((F.floor(F.count(F.lit(1)) / CHUNK) + 1).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    split = edges.join(degree, "centre")
    members = split.select(F.col("rep").alias("doc_id"), "centre", chunk.alias("chunk"))
    centres = degree.select(F.col("centre").alias("doc_id"), "centre", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    rows = members.unionByName(centres).join(sets, "doc_id")
    rows = rows.repartition("centre", "chunk").sortWithinPartitions("centre", "chunk", (F.col("doc_id") != F.col("centre")), "doc_id")

    def run(batches):
        now, mine = None, None
        for b in batches:
            reps, sims, cents = [], [], []
            for d, c, s in zip(b.column("doc_id").to_pylist(), b.column("centre").to_pylist(), b.column("set").to_pylist()):
                own = np.frombuffer(s, np.uint64)
                if d == c:  # a centre comes before its members
                    now, mine = c, own
                    continue
                assert now == c
                reps.append(d)
                cents.append(c)
                sims.append(_jaccard(mine, own))
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(cents, pa.int64()), pa.array(sims, pa.float64())], ["rep", "centre", "sim"])

    return rows.mapInArrow(run, "rep long, centre long, sim double")


def _jaccard(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


class _Postings:
    """Sets by element, to find the similarity of one set with all."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets])
        items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(items, kind="stable")
        self.items, self.owner = items[order], owner[order]

    def similar(self, one: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.items, one, "left"), np.searchsorted(self.items, one, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.size))
        return both / (self.size + len(one) - both)


def _linked(ids: np.ndarray, own: list[np.ndarray], threshold: float) -> pd.DataFrame:
    """Links (a, b) that join the classes within one group."""
    index, root, out = _Postings(own), np.arange(len(ids)), []
    for x in range(len(ids)):
        for y in np.flatnonzero(index.similar(own[x]) >= threshold):
            if root[x] != root[y]:
                root[root == root[y]] = root[x]
                out.append((ids[x], ids[y]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _within(rest: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join the classes within each bucket of at most SMALL members."""
    lists = rest.groupBy("band", "key").agg(F.sort_array(F.collect_set("rep")).alias("reps")).where("size(reps) > 1")
    rows = lists.select("reps").distinct().select(F.xxhash64("reps").alias("group"), F.explode("reps").alias("doc_id")).join(sets, "doc_id")
    run = lambda pdf: _linked(pdf["doc_id"].to_numpy(), [np.frombuffer(x, np.uint64) for x in pdf["set"]], threshold)
    return rows.groupBy("group").applyInPandas(run, "a long, b long")


def _items(sets: DataFrame) -> DataFrame:
    """doc_id, item, size: a row for every element of every set."""

    def run(batches):
        for b in batches:
            for d, s in zip(b.column("doc_id").to_pylist(), b.column("set").to_pylist()):
                own = np.frombuffer(s, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), d, np.int64)), pa.array(own), pa.array(np.full(len(own), len(own), np.int64))], ["doc_id", "item", "size"])

    return sets.mapInArrow(run, "doc_id long, item long, size long")


def _by_prefix(spark: SparkSession, reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join all classes among the given reps, by a join on the rarest elements of each set.

    Two sets with a link share threshold * size elements of each, hence one of the size - threshold * size + 1
    elements of each that come first in any one order of the elements; here the rarest come first.
    """
    sets = staged(spark, reps.select(F.col("rep").alias("doc_id")).distinct().join(sets, "doc_id"))
    items = staged(spark, _items(sets))
    often = staged(spark, items.groupBy("item").agg(F.count(F.lit(1)).alias("n")))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("n", "item"))
    ranked = lookup(items, often, ["item"], "n", items.count()).withColumn("at", order)
    first = ranked.where(F.col("at") <= F.col("size") - F.ceil(threshold * F.col("size") - 1e-9) + 1).where("n > 1").select("item", "doc_id")
    first = staged(spark, first)
    sizes = staged(spark, first.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = first.count()
    first = staged(spark, lookup(first, sizes, ["item"], "n", total))
    links = _within(first.where(F.col("n") <= SMALL).select(F.lit(0).alias("band"), F.col("item").alias("key"), F.col("doc_id").alias("rep")), sets, threshold)
    # all pairs of blocks of the larger ones
    blocks = (F.floor(F.col("n") / BLOCK) + 1).cast("int")
    large = first.where(F.col("n") > SMALL).withColumn("blocks", blocks).withColumn("i", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    large = large.select("item", "doc_id", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    large = large.select("item", "doc_id", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).join(sets, "doc_id")
    run = lambda pdf: _linked(pdf["doc_id"].to_numpy(), [np.frombuffer(x, np.uint64) for x in pdf["set"]], threshold)
    return links.unionByName(large.groupBy("item", "i", "j").applyInPandas(run, "a long, b long"))


def _across(joined: DataFrame, between: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """A link (a, b) for each b that has any, between the a and the b of each centre, block by block."""
    blocks = lambda df, n: df.groupBy("centre").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).cast("int").alias(n))
    dims = blocks(joined, "na").join(blocks(between, "nb"), "centre")
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = (
        joined.join(dims, "centre").select(F.col("a").alias("doc_id"), "centre", F.lit(0).alias("side"), part("a", "na").alias("i"), upto("nb").alias("j"))
        .unionByName(between.join(dims, "centre").select(F.col("b").alias("doc_id"), "centre", F.lit(1).alias("side"), part("b", "nb").alias("j"), upto("na").alias("i")))
        .join(sets, "doc_id")
    )

    def run(pdf):
        ids, side, own = pdf["doc_id"].to_numpy(), pdf["side"].to_numpy(), [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        left = np.flatnonzero(side == 0)
        if not len(left):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        index, out = _Postings([own[x] for x in left]), []
        for y in np.flatnonzero(side == 1):
            sim = index.similar(own[y])
            if sim.max() >= threshold:
                out.append((ids[left[sim.argmax()]], ids[y]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.groupBy("centre", "i", "j").applyInPandas(run, "a long, b long")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's connected component, from links (a, b).

    Alternates joining every larger neighbour to a node's smallest one and every neighbour to the
    smallest of smaller ones, until nothing changes; each round is a minimum and a join by node.
    """
    edges = staged(spark, links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    mark, total = None, 2 * max(1, edges.count())
    while True:
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("x")).unionByName(edges.select(F.col("lo").alias("n"), F.col("hi").alias("x")))
        low = both.groupBy("n").agg(F.least(F.min("x"), F.col("n")).alias("m"), F.count(F.lit(1)).alias("c"))
        large = lookup(both.where("x > n"), low, ["n"], "c", total).select(F.col("x").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        low2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low2, "hi")
            .select(F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.*")
            .where("hi <> lo")
            .distinct()
        )
        new = staged(spark, small)
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        edges, changed, mark, total = new, now != mark, now, 2 * max(1, now[0])
        if not changed:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _classified(spark: SparkSession, docs: DataFrame, threshold: float) -> DataFrame:
    """What near_duplicates gives, and said: a hash of the row's text."""
    sig = staged(spark, _signatures(docs))
    total = sig.count()
    least = sig.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "row", "said")).alias("least"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"))
    reps = staged(spark, least.select("digest", F.col("least.row").alias("rep"), F.col("least.doc_id").alias("low"), F.col("least.said").alias("said"), "n", "bands"))
    bands = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    centres = bands.groupBy("band", "key").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("size")).where("size > 1")
    pairs = staged(spark, lookup(bands, staged(spark, centres), ["band", "key"], "size", max(1, BANDS * reps.count())).select("band", "key", "rep", "centre"))
    wanted = reps.join(pairs.select("rep").distinct(), "rep", "left_semi").select("rep", F.col("low").alias("__low"), F.col("said").alias("__said"), "digest")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("said"), "text")
    sets = _sets(ids.join(wanted.hint("merge"), (F.col("doc_id") == F.col("__low")) & (F.col("said") == F.col("__said"))))
    sets = staged(spark, sets if total == 0 or sig.select("doc_id", "said").distinct().count() == total else sets.dropDuplicates(["doc_id"]))
    links = []
    if pairs.limit(1).count():
        judged = staged(spark, _compare(pairs.where("rep <> centre"), sets))
        links.append(judged.where(F.col("sim") >= threshold).select(F.col("rep").alias("a"), F.col("centre").alias("b")))
        apart = judged.where(F.col("sim") < threshold).drop("sim")
        rest = staged(spark, pairs.join(apart, ["rep", "centre"], "left_semi").select("band", "key", "rep"))
        sizes = rest.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        rest = staged(spark, rest.join(sizes, ["band", "key"]))
        links.append(staged(spark, _within(rest.where(F.col("size") <= SMALL), sets, threshold)))
        large = rest.where(F.col("size") > SMALL)
        if large.limit(1).count():
            links.append(staged(spark, _by_prefix(spark, large, sets, threshold)))
    roots = reps.select("rep", F.col("rep").alias("root"))
    if links:
        tree = components(spark, reduce(DataFrame.unionByName, links))
        at = lambda c, out: tree.select(F.col("node").alias(c), F.col("root").alias(out))
        between = judged.where((F.col("sim") < threshold) & (F.col("sim") >= 2 * threshold - 1 - 1e-9))
        between = between.join(at("rep", "r1"), "rep", "left").join(at("centre", "r2"), "centre", "left")
        between = between.where(F.coalesce("r1", "rep") != F.coalesce("r2", "centre")).select("centre", F.col("rep").alias("b"), F.col("sim").alias("sim_b"))
        between = staged(spark, between.distinct())
        if between.limit(1).count():
            joined = judged.where(F.col("sim") >= threshold).select("centre", F.col("rep").alias("a"), "sim")
            more = staged(spark, _across(joined.join(between.select("centre").distinct(), "centre").select("centre", "a"), between.select("centre", "b"), sets, threshold))
            if more.limit(1).count():
                tree = components(spark, tree.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
        roots = reps.select("rep").join(tree, F.col("rep") == F.col("node"), "left").select("rep", F.coalesce("root", "rep").alias("root"))
    groups = staged(spark, reps.select("digest", "rep", "low", "n").join(roots, "rep").select("digest", "root", "low", "rep", "n"))
    classes = groups.groupBy("root").agg(F.sum("n").alias("class_size"), F.min(F.struct("low", "digest", "rep")).alias("head"))
    groups = staged(spark, groups.join(classes, "root").select("digest", F.col("head.low").alias("class_id"), "class_size", F.col("head.rep").alias("head"), "n"))
    rows = sig.select("row", "doc_id", "said", "digest")
    known = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    out = lookup(rows.where(known), groups, ["digest"], "n", total).select("doc_id", "class_id", "class_size", (F.col("row") == F.col("head")).alias("kept"), "said")
    return out.unionByName(rows.where(~known).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"), "said"))


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, class_id (the class's smallest doc_id), class_size (its rows), kept (one row a class).

    Classes are the connected components of similarity >= threshold over five-word shingle sets. A text
    of fewer than five words is one shingle; texts without words (null, empty) are alone, as are rows without id.
    Texts of any length are read whole. Every row is judged by its own text: rows that repeat an id with texts that are not alike are in
    different classes of that id; of those that are alike the one with the least digest is kept, of repeated rows one. An
    empty table gives no rows; extra columns are ignored, whatever their names.
    """
    return _classified(spark, docs, threshold).drop("said")


def drop_near(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that near_duplicates drops; all columns stay, whatever their names.

    Texts without words and null ids stay. Rows that repeat both id and text are one document: they stay or go together. An empty table stays empty.
    """
    name, said = fresh("dropped"), fresh("said")
    told = _classified(spark, docs, threshold).where("doc_id IS NOT NULL").groupBy("doc_id", "said").agg(F.max("kept").alias("any"))
    dropped = told.where("NOT any").select(F.col("doc_id").alias(name), F.col("said").alias(said))
    return docs.join(dropped, (F.col("doc_id") == F.col(name)) & (F.xxhash64("text") == F.col(said)), "left_anti")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
