"""Benchmark decontamination: one Aho-Corasick automaton scans every text once.

Texts and items are normalised alike: A-Z lower-cased, everything but words to one space. A window of w
words holds a whole one of the item's aligned seeds (stretches of (w + 1) // 2 words from every multiple of that), so the
automaton holds each item's words once, not each window's; an item shorter than a window is one seed. Where a seed
occurs, item and text are compared word by word to either side, and a common run of w words or more is hit. Hits are
mapped back to places in the original text.

The automaton is built in the task from the items' normalised texts. These are broadcast, as their size is measured
first: of more than PART_BYTES several parts are made, each with its own automaton and scan, and the hits (few) meet by row.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import as_bytes, fresh, staged, table
from spanloom.llm.oracle import ascii_lower

WINDOW = 10
#: Bytes of normalised items, ids included, in one automaton (about 45 bytes of memory each) and one broadcast.
PART_BYTES = 4 << 20
_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_ROW = "row long, doc_id long, n_words long, spans array<struct<first:long,last:long,start:long,end:long>>, items array<string>"
_SPAN = pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")])
_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])
_BUILT: dict[str, Scanner] = {}


class Scanner:
    """The automaton over items: (normalised text, its item ids) each."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window, self.ids = window, [ids for _, ids in items]
        self.words = [text.encode().split(b" ") for text, _ in items]
        size, places = (window + 1) // 2, {}
        for i, words in enumerate(self.words):
            for at in range(0, len(words) - size + 1, size) if len(words) >= window else [0]:
                seed = words[at : at + size] if len(words) >= window else words
                places.setdefault(b" " + b" ".join(seed) + b" ", []).append((i, at, len(seed)))
        self.automaton = ahocorasick.Automaton()
        for seed, where in places.items():
            self.automaton.add_word(seed.decode("latin-1"), where)
        if places:
            self.automaton.make_automaton()

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int, int, int]], list[str]]:
        """Number of words; hit stretches as first and last (excluded) word and code point; item ids."""
        low = raw.translate(_TABLE)
        words = low.split()
        found = list(self.automaton.iter((b" " + b" ".join(words) + b" ").decode("latin-1"))) if words and len(self.automaton) else []
        if not found:
            return len(words), [], []
        gaps = np.concatenate([[0], np.cumsum([len(x) + 1 for x in words])])
        hit, items, done = np.zeros(len(words) + 1, np.int64), set(), {}
        for end, where in found:
            last = int(np.searchsorted(gaps, end))
            for i, at, size in where:
                first = last - size
                if done.get((i, first - at), 0) >= last:
                    continue
                own, low_end, high_end = self.words[i], 0, size
                while first + low_end > 0 and at + low_end > 0 and words[first + low_end - 1] == own[at + low_end - 1]:
                    low_end -= 1
                while first + high_end < len(words) and at + high_end < len(own) and words[first + high_end] == own[at + high_end]:
                    high_end += 1
                done[i, first - at] = first + high_end
                if high_end - low_end >= min(self.window, len(own)):
                    hit[first + low_end] += 1
                    hit[first + high_end] -= 1
                    items.add(i)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(hit)[:-1] > 0, [0]))))
        if not len(edge):
            return len(words), [], []
        bound = np.flatnonzero(np.diff(np.concatenate(([1], np.frombuffer(low, np.uint8) == 32, [1])).astype(np.int8)))
        points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        spans = [(int(a), int(b), int(points[bound[2 * a]]), int(points[bound[2 * b - 1]])) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        return len(words), spans, sorted({x for i in items for x in self.ids[i]})


def _scanner(token: str, items, window: int) -> Scanner:
    """Built once in a worker; the one of another run goes."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Scanner(items.value, window)
    return _BUILT[token]


def _scan(docs: DataFrame, items, window: int, only_hits: bool) -> DataFrame:
    token = fresh("items")

    def run(batches):
        scanner = _scanner(token, items, window)
        for b in batches:
            rows = [(r, d, *scanner.scan(as_bytes(t))) for r, d, t in zip(*[b.column(c).to_pylist() for c in ("row", "doc_id", "text")], strict=True)]
            rows = [x for x in rows if x[3] or not only_hits]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] if i != 3 else [dict(zip(("first", "last", "start", "end"), s, strict=True)) for s in x[3]] for x in rows], t) for i, t in enumerate(_SCHEMA.types)], schema=_SCHEMA)

    return docs.mapInArrow(run, _ROW)


def merged(spans: list[dict]) -> list[dict]:
    """Stretches in order, overlapping and touching ones joined."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda x: x["first"]):
        if out and s["first"] <= out[-1]["last"]:
            if s["last"] > out[-1]["last"]:
                out[-1] = out[-1] | {"last": s["last"], "end": s["end"]}
        else:
            out.append(dict(s))
    return out


def _merge(batches):
    for b in batches:
        at = b.schema.get_field_index("spans")
        yield b.set_column(at, "spans", pa.array([merged(x) for x in b.column(at).to_pylist()], pa.list_(_SPAN)))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, spans, items.

    spans: hit stretches in order, as first and last (excluded) word and start and end code point in the text as it is;
    items: ids (as text, sorted) of the items with an occurring window. ``benchmark`` has item_id and text.
    A null or empty text has no words, hence no hits; texts of any length are scanned whole; rows that repeat an id are
    answered one by one; a null item id counts as the empty text, rows that repeat an item id are one item's windows. With
    no item nothing is hit. Other columns are ignored, whatever their names.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    norm = F.trim(F.regexp_replace(lower, _NOT_WORD, " "))
    own = benchmark.select(norm.alias("norm"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id")).where("norm <> ''").distinct()
    size = own.agg(F.sum(F.octet_length("norm") + F.octet_length("id") + 1)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    if parts == 1:
        out = _scan(docs, _items(spark, own), window, False)
    else:
        own, docs = staged(spark, own), staged(spark, docs)
        part = F.pmod(F.xxhash64("norm"), F.lit(parts))
        hits = [staged(spark, _scan(docs, _items(spark, own.where(part == i)), window, True)) for i in range(parts)]
        hits = reduce(DataFrame.unionByName, hits).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        words = _scan(docs, spark.sparkContext.broadcast([]), window, False).drop("spans", "items")
        kinds = dict(hits.dtypes)
        none = [F.coalesce(c, F.array().cast(kinds[c])).alias(c) for c in ("spans", "items")]
        out = words.join(hits, "row", "left").select("row", "doc_id", "n_words", *none).mapInArrow(_merge, _ROW)
    return out.select("doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]).alias("n_hit"), "spans", "items")


def _items(spark: SparkSession, own: DataFrame):
    """Broadcast of at most about PART_BYTES: each text once, with its ids."""
    rows = own.groupBy("norm").agg(F.sort_array(F.collect_set("id")).alias("ids")).collect()
    return spark.sparkContext.broadcast([(r["norm"], r["ids"]) for r in rows])


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` whose text has lost its hit stretches (the words around them meet at one space); all columns stay.

    A row without hits stays as it is, a null text too. Rows of one id with one text share their answer.
    """
    own = {c: fresh(c) for c in ("id", "text", "spans")}
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    spans = contamination(spark, told.withColumn("doc_id", F.xxhash64("doc_id", digest)).dropDuplicates(["doc_id"]), benchmark, window).where("n_hit > 0")
    spans = spans.select(F.col("doc_id").alias(own["id"]), F.col("spans").alias(own["spans"]))
    met = docs.withColumn(own["text"], F.xxhash64(F.col("doc_id").cast("long"), digest)).join(spans, F.col(own["text"]) == F.col(own["id"]), "left")
    text, cuts = F.col("text"), F.col(own["spans"])
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda s: s["end"]))
    ends = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.trim(F.substring(text, a.cast("int") + 1, (b - a).cast("int"))))
    kept = F.concat_ws(" ", F.filter(pieces, lambda x: x != ""))
    return met.select(*[F.when(cuts.isNull(), text).otherwise(kept).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digests of every document's hits by the whole benchmark; other cases as in ``contamination``."""
    found = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_WORDS = f"regexp_extract_all({ascii_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS MATERIALIZED (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark WHERE len({_WORDS}) > 0),
wanted AS MATERIALIZED (
  SELECT DISTINCT item, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM b)
),
sizes AS MATERIALIZED (SELECT DISTINCT least(len(w), {WINDOW}) AS k FROM b),
seen AS MATERIALIZED (
  SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes)
),
found AS MATERIALIZED (SELECT s.rid, s.i, s.k, t.item FROM seen s JOIN wanted t ON s.win = t.win),
hit AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM found) GROUP BY rid),
named AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items, sha256(coalesce(m.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit h ON h.rid = d.rid LEFT JOIN named m ON m.rid = d.rid
"""
