"""Removal of byte strings that documents repeat: every 50-byte string that also starts in a document of smaller id.

A run-length compressed Burrows-Wheeler index says which 50-byte windows smaller documents have. One index over a whole corpus
does not fit a task, so places that may repeat are dealt out first. The anchor of a window is the least hash of its K-byte
strings: equal windows have equal anchors. Neighbouring windows with one anchor form a segment (about sixteen windows). A
document counts once for an anchor; the anchors that more than one has set bits of a bitmap of fixed size, which goes to all
tasks (when it fills, more segments are looked at, none is missed). Equal segments become one, with its smallest
document and a count; a copy that is not in the smallest document loses all its windows.

All segments of an anchor come to one task, which indexes some thousand segments at a time, whole anchors together. An index
(`RunIndex`) is the Burrows-Wheeler transform of the segments as runs (letter, first rank, shift to the
next rank), with samples at the ends of each run of ranks whose next 50 bytes agree: the two ranks and the smallest document. The
segments then stream through it backwards, all in step: a step finds the run of each rank, moves on, and, from the
fiftieth byte on, reads whether the match with a smaller document reaches 50 bytes (the matching statistic, cut
at 50). Within an index bytes are compared by their order; that two segments are equal is told by their anchor and a second 64-bit hash.

An anchor with more than LARGE different segments (a phrase that very many documents continue differently) is
no group of one task: its windows are aggregated one by one, partly before the shuffle.

Texts with very many copies are one document from the start: all but the smallest lose everything.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import HOT, _powers, _remove, as_bytes, lookup, mix, prefix_hash, range_hash, staged, table

LENGTH, K, BITS = 50, 20, 1 << 27
#: Bits of one value of Spark's bitmap functions.
SLICE = 1 << 15
W = LENGTH - K + 1
#: Segments of one index, and different segments of an anchor that one task takes.
INDEXED, LARGE = 8_192, 50_000
#: Bytes of text that are hashed at once.
BLOCK = 1 << 18


def window_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at most W neighbouring windows with one anchor: text number, first window, windows, anchor."""
    size = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    prefix, (_, down) = prefix_hash(raw), _powers(len(raw))
    best = mix((prefix[K:] - prefix[:-K]) * down[: len(raw) - K + 1])
    have = 1
    while have < W:  # the least of W neighbours
        step = min(have, W - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    first = np.cumsum(size) - size
    text = np.repeat(np.arange(len(texts)), size)[: len(best)]
    inner = np.arange(len(best)) + LENGTH <= (first + size)[text]
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new & inner)
    end = np.minimum(np.append(np.flatnonzero(new), len(best))[np.searchsorted(np.flatnonzero(new), at, "right")], (first + size)[text[at]] - LENGTH + 1)
    n = end - at
    parts = -(-n // W)  # only texts that repeat a few bytes over and over have longer runs
    if (parts > 1).any():
        which = np.repeat(np.arange(len(at)), parts)
        skip = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * W
        at, n = at[which] + skip, np.minimum(W, n[which] - skip)
    return text[at], at - first[text[at]], n, best[at]


def _blocks(texts: list):
    """Slices of about BLOCK bytes."""
    i, held = 0, 0
    for j, t in enumerate(texts):
        held += len(t)
        if held >= BLOCK:
            yield i, j + 1
            i, held = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def _anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            texts = [as_bytes(t) for t in b.column("text").to_pylist()]
            for i, j in _blocks(texts):
                text, _, _, anchor = window_runs(texts[i:j])
                order = np.argsort(anchor, kind="stable")
                text, anchor = text[order], anchor[order]
                once = np.ones(len(text), bool)
                once[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[once].astype(np.int64))], ["anchor"])

    return docs.mapInArrow(run, "anchor long")


def _bitmap(spark: SparkSession, found: DataFrame) -> np.ndarray:
    """BITS bits, set at the hash of each anchor found; Spark builds them by slices of SLICE bits, so their size is fixed."""
    at = F.pmod("anchor", F.lit(BITS)) + 1
    slices = found.groupBy(F.bitmap_bucket_number(at).alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in staged(spark, slices).collect():  # BITS / SLICE rows at most
        out[(r[0] - 1) * SLICE // 8 : r[0] * SLICE // 8] = np.frombuffer(r[1], np.uint8)
    return out


def _segments(docs: DataFrame, shared, bytes_too: bool) -> DataFrame:
    """Segments whose anchor's bit is set: each place of each, or (bytes_too) each once in a block of documents, with its bytes."""
    names = ["anchor", "seg", "doc", *(["bytes"] if bytes_too else ["hash", "begin", "size"])]

    def run(batches):
        bitmap = shared.value
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            hashes = None if bytes_too else b.column("hash").to_numpy(zero_copy_only=False)
            texts = [as_bytes(t) for t in b.column("text").to_pylist()]
            for i, j in _blocks(texts):
                some = texts[i:j]
                text, begin, n, h = window_runs(some)
                bit = h.astype(np.int64) % BITS
                hit = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                text, begin, n, h = text[hit], begin[hit], n[hit], h[hit]
                if not len(text):
                    continue
                first = np.cumsum([0] + [len(t) for t in some])
                joined = b"".join(some)
                a = first[text] + begin
                e = a + n + LENGTH - 1
                seg = mix(range_hash(prefix_hash(np.frombuffer(joined, np.uint8)), a, e) ^ mix(h))
                doc = ids[i:j][text]
                if bytes_too:
                    order = np.lexsort((doc, seg))
                    order = order[np.concatenate(([True], seg[order][1:] != seg[order][:-1]))]
                    cut = [joined[x:y] for x, y in zip(a[order].tolist(), e[order].tolist())]
                    cols = [*(pa.array(c[order]) for c in (h.astype(np.int64), seg.astype(np.int64), doc)), pa.array(cut, pa.binary())]
                else:
                    cols = [pa.array(c) for c in (h.astype(np.int64), seg.astype(np.int64), doc, hashes[i:j][text], begin, n + LENGTH - 1)]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, "anchor long, seg long, doc long, " + ("bytes binary" if bytes_too else "hash long, begin long, size long"))


def _dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and each key's rank among the different ones."""
    order = np.argsort(key)
    new = np.zeros(len(key), np.int64)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


class RunIndex:
    """Run-length Burrows-Wheeler transform of segments, each closed by a mark below all letters, and samples at the ends of match runs."""

    def __init__(self, lengths: np.ndarray, text: bytes, doc: np.ndarray):
        n = int(lengths.sum()) + len(lengths)
        close = np.cumsum(lengths + 1) - 1
        letter = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[close] = False
        letter[inside] = np.frombuffer(text, np.uint8).astype(np.int64) + 1  # UTF-8 has no byte 255
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        left = close[owner] - np.arange(n)  # letters up to the closing mark

        def ahead(r, m):  # what stands m letters on, 0 beyond the segment
            out = np.zeros(n, r.dtype)
            out[:-m] = r[m:]
            return np.where(left >= m, out, r.dtype.type(0))

        # equal ranks agree on their next `known` letters; the first eight are one number
        packed = letter.astype(np.uint64)
        for m in (1, 2, 4):
            packed = (packed << np.uint64(8 * m)) | ahead(packed, m)
        rank, known, at32 = _dense(packed)[1] + 1, 8, None
        while known <= int(lengths.max(initial=0)):
            rank = _dense(rank * (n + 2) + ahead(rank, known))[1] + 1
            known *= 2
            if known == 32:
                at32 = rank
        order = np.argsort(rank * n + np.arange(n))  # equal segments' ends in segment order
        self.lengths, self.doc = lengths, doc
        bwt = letter[order - 1]
        self.first = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))
        run_letter, run_size = bwt[self.first], np.diff(np.append(self.first, n))
        by = np.argsort(run_letter, kind="stable")
        to = np.empty(len(by), np.int64)
        to[by] = np.cumsum(run_size[by]) - run_size[by]
        self.shift = to - self.first
        # ranks in a row whose next LENGTH letters agree
        whole = left[order] >= LENGTH
        more = np.minimum(order + LENGTH - 32, n - 1)
        same = np.zeros(n, bool)
        if at32 is not None:
            same[1:] = whole[1:] & whole[:-1] & (at32[order[1:]] == at32[order[:-1]]) & (at32[more[1:]] == at32[more[:-1]])
        begins = np.flatnonzero(~same)
        least = np.minimum.reduceat(doc[owner[order]], begins) if n else np.zeros(0, np.int64)
        ends = np.append(begins[1:], n)
        keep = ends - begins > 1
        self.begins, self.ends, self.least = begins[keep], ends[keep], least[keep]

    def stream(self) -> np.ndarray:
        """Bit s of each segment: its window at s also stands in a segment of a smaller document."""
        out = np.zeros(len(self.lengths), np.int64)
        if not len(self.begins):
            return out
        live = np.arange(len(self.lengths))
        rank = live.copy()  # the closing marks have the first ranks
        for k in range(1, int(self.lengths.max()) + 1):
            on = self.lengths[live] >= k
            if not on.all():
                live, rank = live[on], rank[on]
            rank = rank + self.shift[np.searchsorted(self.first, rank, "right") - 1]
            if k >= LENGTH:
                at = np.maximum(np.searchsorted(self.begins, rank, "right") - 1, 0)
                hit = (rank >= self.begins[at]) & (rank < self.ends[at]) & (self.least[at] < self.doc[live])
                out[live[hit]] |= np.int64(1) << (self.lengths[live[hit]] - k)
        return out


def marks(lengths: np.ndarray, text: bytes, doc: np.ndarray) -> np.ndarray:
    return RunIndex(lengths, text, doc).stream()


def _marked(distinct: DataFrame) -> DataFrame:
    """anchor, seg, mask of the segments with a marked window."""
    rows = distinct.repartition("anchor").sortWithinPartitions("anchor")

    def emit(cols):
        anchor, seg, doc = (np.array(c, np.int64) for c in cols[:3])
        m = marks(np.array([len(x) for x in cols[3]], np.int64), b"".join(cols[3]), doc)
        hit = m != 0
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (anchor, seg, m)], ["anchor", "seg", "mask"])

    def run(batches):
        held = [[], [], [], []]
        for b in batches:
            for i in range(0, b.num_rows, INDEXED):
                for h, c in zip(held, ("anchor", "seg", "least", "bytes")):
                    h += b.column(c).slice(i, INDEXED).to_pylist()
                last = held[0][-1]
                k = next((j for j in range(len(held[0]) - 1, -1, -1) if held[0][j] != last), -1) + 1  # whole anchors only
                if k:
                    yield emit([h[:k] for h in held])
                    held = [h[k:] for h in held]
        if held[0]:
            yield emit(held)

    return rows.mapInArrow(run, "anchor long, seg long, mask long")


def _marked_by_window(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """What _marked returns, for anchors with very many segments: the smallest document of each window, aggregated."""
    each = distinct.select("anchor", "seg", "least", F.explode(F.expr(f"sequence(0, octet_length(bytes) - {LENGTH})")).alias("s"), "bytes")
    each = staged(spark, each.select("anchor", "seg", "least", "s", F.expr(f"substring(bytes, s + 1, {LENGTH})").alias("window")))
    windows = staged(spark, each.groupBy("window").agg(F.min("least").alias("smallest"), F.count(F.lit(1)).alias("rows")))
    met = lookup(each, windows, ["window"], "rows", max(1, each.count()))
    return met.where("smallest < least").groupBy("anchor", "seg").agg(F.bit_or(F.expr("shiftleft(1L, s)")).alias("mask"))


def remove_repeats(spark: SparkSession, docs: DataFrame, large: int = LARGE) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty. Rows that repeat an id do not count as smaller than each other; a null id loses
    nothing and takes nothing from others. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    # a text with one row in HOT or more (at most HOT texts) is looked at once; other copies go the way of all documents
    total = rows.count()
    same = rows.where("doc_id IS NOT NULL").groupBy("hash", F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(staged(spark, same.where(F.col("n") * HOT >= total).where("n > 1")).select("hash", "sha", "least"))
    rows = rows.join(hot.drop("sha"), "hash", "left").withColumn("whole", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))).drop("least")
    base = rows.where("NOT whole AND doc_id IS NOT NULL")
    texts = base.select("doc_id", "hash", "text")
    repeated = _anchor_rows(texts).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    places = staged(spark, _segments(texts, spark.sparkContext.broadcast(_bitmap(spark, repeated)), False))
    groups = staged(spark, places.groupBy("anchor", "seg").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")))
    # only anchors with several different segments need an index, and only their bytes are fetched
    several = staged(spark, groups.groupBy("anchor").count().where("count > 1"))
    cut = _segments(texts, spark.sparkContext.broadcast(_bitmap(spark, several.select("anchor"))), True)
    distinct = cut.groupBy("anchor", "seg").agg(F.min("doc").alias("least"), F.first("bytes").alias("bytes"))
    crowded = several.where(F.col("count") > large).select("anchor")
    many = crowded.count()
    if many:
        side = F.broadcast(crowded) if many <= 1_000_000 else crowded
        masks = staged(spark, _marked(distinct.join(side, "anchor", "left_anti")))
        masks = masks.unionByName(staged(spark, _marked_by_window(spark, distinct.join(side, "anchor", "left_semi"))))
    else:
        masks = staged(spark, _marked(distinct))
    marked = staged(spark, groups.join(masks, ["anchor", "seg"], "left").withColumn("mask", F.coalesce("mask", F.lit(0))).where("n > 1 OR mask <> 0"))
    found = lookup(places, marked, ["anchor", "seg"], "n", max(1, places.count()))
    every = F.expr(f"shiftleft(1L, CAST(size - {LENGTH - 1} AS INT)) - 1")
    found = found.select("doc", "hash", "begin", F.when(F.col("doc") > F.col("least"), every).otherwise(F.col("mask")).alias("mask")).where("mask <> 0")
    per = staged(spark, found.groupBy(F.col("doc").alias("doc_id"), "hash").agg(F.collect_list(F.struct("begin", "mask")).alias("marks")))
    for done in (places, groups, marked):  # nothing reads these again
        for path in done.inputFiles():
            _remove(spark, path)
    out = rows.join(per, ["doc_id", "hash"], "left").select("doc_id", "text", "marks", "whole")

    def run(batches):
        for b in batches:
            cols = [[], [], [], []]
            marks_of = b.column("marks")
            held = marks_of.flatten()  # without the lists of null rows
            begin, mask = (held.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            size = pc.fill_null(pc.list_value_length(marks_of), 0).to_numpy(zero_copy_only=False)
            end = np.cumsum(size)
            for t, x, y, whole in zip(b.column("text").to_pylist(), (end - size).tolist(), end.tolist(), b.column("whole").to_pylist()):
                text = as_bytes(t)
                if whole and len(text) >= LENGTH:
                    cuts = (len(text), len(text), 1, hashlib.sha256(b"").hexdigest())
                elif y > x and not whole:
                    raw = np.frombuffer(text, np.uint8)
                    which, s = np.nonzero((mask[x:y, None] >> np.arange(W)) & 1)
                    at = begin[x:y][which] + s
                    gone = np.bincount(at, minlength=len(raw) + 1) - np.bincount(np.minimum(at + LENGTH, len(raw)), minlength=len(raw) + 1)
                    cut = np.cumsum(gone)[: len(raw)] > 0
                    spans = np.count_nonzero(cut[1:] & ~cut[:-1]) + int(cut[0])
                    cuts = (len(raw), int(cut.sum()), int(spans), hashlib.sha256(raw[~cut].tobytes()).hexdigest())
                else:
                    cuts = (len(text), 0, 0, hashlib.sha256(text).hexdigest())
                for c, v in zip(cols, cuts):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return out.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"))
