"""A span model as a column of its own: any function from token lists to labels, over windows of whole texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import edit_ratio
from spanloom.operators.annotate import normalise_exact
from spanloom.operators.spans import decode_labels

_PIECE = re.compile(r"\w+|[^\w\s]")


def label_pieces(docs: DataFrame, predict: Callable[[list[list[str]]], list[list[int]]], size: int = 512, stride: int = 50) -> DataFrame:
    """doc_id, pos, piece, label, start, length: the pieces of each text (doc_id, text) with the labels that ``predict`` gives.

    Texts are read in windows of ``size`` pieces that share ``stride``; a piece takes the label of the first window that has it.
    A null or empty text has no pieces.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, text in enumerate(b.column("text").to_pylist()):
                found = list(_PIECE.finditer(text or ""))
                words, labels = [m[0] for m in found], []
                starts = range(0, max(1, len(words) - stride), size - stride)
                for at, got in zip(starts, predict([words[a : a + size] for a in starts]) if words else []):
                    labels += list(got)[len(labels) - at :]
                n = len(words)
                doc = b.column("doc_id").slice(k, 1).take(pa.array(np.zeros(n, np.int64)))
                cols = [pa.array(range(n), pa.int32()), pa.array(words, pa.string()), pa.array(labels, pa.int32()), pa.array([m.start() for m in found], pa.int64()), pa.array([m.end() - m.start() for m in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([doc, *cols], ["doc_id", "pos", "piece", "label", "start", "length"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, pos int, piece string, label int, start long, length long")


def recognise(docs: DataFrame, predict: Callable[[list[list[str]]], list[list[int]]], lexicon: DataFrame | None = None, **windows: int) -> DataFrame:
    """doc_id, start, length, mention, and with a lexicon (name, tax_id, ord) tax_id: the entities that the model's labels delimit."""
    if not callable(predict):
        raise TypeError("predict must be a function from token lists to label lists")
    pieces = label_pieces(docs, predict, **windows)
    spans = decode_labels(pieces.select("doc_id", "pos", "piece", "label"))
    first = pieces.select("doc_id", F.col("pos").alias("first"), F.col("start"))
    last = pieces.select("doc_id", (F.col("pos") + 1).alias("stop"), (F.col("start") + F.col("length")).alias("end"))
    found = spans.join(first, ["doc_id", "first"]).join(last, ["doc_id", "stop"]).select("doc_id", "start", (F.col("end") - F.col("start")).alias("length"))
    found = found.join(docs.select("doc_id", "text"), "doc_id").withColumn("mention", F.expr("substring(text, start + 1, length)")).drop("text")
    return normalise_exact(found, lexicon) if lexicon is not None else found


def similar_pairs(left: DataFrame, right: DataFrame, least: int = 80) -> DataFrame:
    """a, b, ratio: the pairs of strings of ``left`` (a) and ``right`` (b) whose edit ratio is ``least`` of 100 or more, exactly.

    A string is the set of its characters, each with the number of its occurrence; two strings have at least as many of these in common as the
    longest common subsequence is long. A ratio bounds that from below, hence the lengths of a partner and how many of a string's rarest
    elements must hold one that the partner's rarest hold too. These prefixes meet by an equi join; of what meets, the common elements are
    counted, and only then the ratio is taken. Nulls match nothing, two empty strings each other.
    """
    share = (least - 0.5) / 100  # ratios are rounded
    low = share / (2 - share)  # the shortest partner's length, of one's own

    def elements(df: DataFrame, c: str) -> DataFrame:
        chars = F.filter(F.split(c, ""), lambda x: x != "")
        nth = F.transform(chars, lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda y: y == x)).cast("string")))
        return df.select(c).distinct().where(F.col(c).isNotNull()).withColumn(f"own_{c}", nth)

    both = elements(left, "a"), elements(right, "b")
    seen = [df.select(F.explode(f"own_{c}").alias("e")) for df, c in zip(both, "ab", strict=True)]
    often = seen[0].unionByName(seen[1]).groupBy("e").agg(F.count(F.lit(1)).alias("n"))

    def prefixes(df: DataFrame, c: str) -> DataFrame:
        size = F.size(f"own_{c}")
        most = size - F.ceil(share * (size + F.ceil(low * size - 1e-9)) / 2 - 1e-9) + 1
        each = df.select(c, most.alias("most"), F.explode(f"own_{c}").alias("e")).join(often, "e")
        return each.withColumn("at", F.row_number().over(Window.partitionBy(c).orderBy("n", "e"))).where(F.col("at") <= F.col("most")).select(c, "e")

    met = prefixes(both[0], "a").join(prefixes(both[1], "b"), "e").select("a", "b").distinct()
    met = met.unionByName(both[0].where("a = ''").select("a").crossJoin(both[1].where("b = ''").select("b")))  # one row at most
    whole = F.length("a") + F.length("b")
    met = met.where(F.least(F.length("a"), F.length("b")) * 2 >= share * whole - 1e-9).join(both[0], "a").join(both[1], "b")
    met = met.where(F.size(F.array_intersect("own_a", "own_b")) * 2 >= share * whole - 1e-9)
    return met.withColumn("ratio", edit_ratio(F.col("a"), F.col("b"))).where(F.col("ratio") >= least).select("a", "b", "ratio")


def _heading_parts(headings: DataFrame) -> DataFrame:
    """heading, many, at, part: the parts of each different heading at 'and', '/' and '&'."""
    bare = F.trim(F.regexp_replace(F.lower("heading"), "^[0-9 ]*[(.]", ""))
    parts = headings.select("heading").distinct().withColumn("parts", F.filter(F.transform(F.split(bare, "\\band\\b|/|&"), F.trim), lambda x: x != ""))
    return parts.select("heading", (F.size("parts") > 1).alias("many"), F.posexplode("parts").alias("at", "part"))


def _first_terms(headings: DataFrame, terms: DataFrame, least: int) -> DataFrame:
    """heading, at, term: the first term that is alike for each part that has any."""
    each = _heading_parts(headings)
    names = terms.select("term", F.lower("name").alias("b"), "ord")
    close = similar_pairs(each.select(F.col("part").alias("a")), names.select("b"), least).join(names, "b")
    met = each.join(close, F.col("part") == F.col("a")).where(F.col("many") | (F.col("ratio") > least))
    return met.withColumn("rn", F.row_number().over(Window.partitionBy("heading", "at").orderBy("ord"))).where("rn = 1").select("heading", "at", "term")


def match_headings(headings: DataFrame, terms: DataFrame, least: int = 80, default: str = "document part") -> DataFrame:
    """heading -> heading, term: each part of a heading (at 'and', '/', '&') takes the first term (term, name, ord) whose name is alike by
    ``least`` of 100 or more - more, where the heading is one part - and a heading without any takes the default.
    """
    found = _first_terms(headings, terms, least).select("heading", "term").distinct()
    return headings.select("heading").distinct().join(found, "heading", "left").select("heading", F.coalesce("term", F.lit(default)).alias("term"))


def heading_terms(headings: DataFrame, terms: DataFrame, ids: dict[str, str] | None = None, least: int = 80, default: str = "document part") -> DataFrame:
    """heading -> heading, terms: structs of id and name in the order of the heading's parts, an id once, by its last name; ids by name, '' where a term has none."""
    known = F.create_map(*[F.lit(x) for pair in (ids or {}).items() for x in pair]) if ids else None
    number = lambda c: F.coalesce(F.try_element_at(known, c), F.lit("")) if ids else F.lit("")
    each = _first_terms(headings, terms, least).groupBy("heading").agg(F.array_sort(F.collect_list(F.struct("at", "term"))).alias("t"))
    told = F.coalesce(F.transform("t", lambda x: x["term"]), F.array(F.lit(default)))
    every = headings.select("heading").distinct().join(each, "heading", "left").withColumn("t", F.transform(told, lambda x: F.struct(number(x).alias("id"), x.alias("name"))))
    if not ids:
        return every.select("heading", F.array_distinct("t").alias("terms"))
    last = F.transform(F.array_distinct(F.transform("t", lambda x: x["id"])), lambda i: F.element_at(F.filter("t", lambda x: x["id"] == i), -1))
    return every.select("heading", last.alias("terms"))
