"""Readers and writers of corpora: annotated-passage JSON, id lists, name lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.sources.sink import finished, write_collections

_NOTE = "STRUCT<id: STRING, text: STRING, infons: MAP<STRING, STRING>, locations: ARRAY<STRUCT<offset: BIGINT, length: BIGINT>>>"
#: A collection: one file, its documents, their passages, the passages' annotations.
COLLECTION = (
    "source STRING, date STRING, key STRING, infons MAP<STRING, STRING>, documents ARRAY<STRUCT<id: STRING, infons: MAP<STRING, STRING>, "
    f"passages: ARRAY<STRUCT<offset: BIGINT, infons: MAP<STRING, STRING>, text: STRING, annotations: ARRAY<{_NOTE}>>>>>"
)


def read_collections(spark: SparkSession, folder: str, pattern: str = "*_bioc.json", done: str | None = None) -> DataFrame:
    """One row per file, with file_name; without those whose name lies in the folder ``done``."""
    rows = spark.read.schema(COLLECTION).option("multiLine", True).option("pathGlobFilter", pattern).json(folder)
    rows = rows.select("*", F.col("_metadata.file_name").alias("file_name"))
    if done is None:
        return rows
    had = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(done).select(F.element_at(F.split("path", "/"), -1).alias("file_name")).distinct()
    return rows.join(had, "file_name", "left_anti")


def passages(collections: DataFrame) -> DataFrame:
    """file_name, doc_no, doc_id, doc_infons, passage_no, offset, text, infons, annotations: all documents of all files."""
    docs = collections.select("file_name", F.posexplode("documents").alias("doc_no", "d"))
    each = docs.select("file_name", "doc_no", F.col("d.id").alias("doc_id"), F.col("d.infons").alias("doc_infons"), F.posexplode("d.passages").alias("passage_no", "p"))
    return each.select("file_name", "doc_no", "doc_id", "doc_infons", "passage_no", "p.offset", "p.text", "p.infons", "p.annotations")


def annotated_json(passages_: DataFrame, mentions: DataFrame, collections: DataFrame | None = None) -> DataFrame:
    """file_name, json: passages with their mentions (file_name, doc_id, passage_no, text, start, length, tax_id, and if there is one type), one row per file.

    Annotations already there stay, before the new ones. With ``collections`` (as read) the fields of the files are kept, and files and documents
    without passages too. An ambiguous mention (tax_id null) with candidates has these as its identifier, by commas. Mentions of documents
    that share file and id go to each of them, unless mentions have doc_no in place of doc_id. Columns id and infons of mentions, if there,
    are the annotations' own.
    """
    had = lambda c: c in mentions.columns
    at = ["file_name", "doc_no" if had("doc_no") else "doc_id", "passage_no"]
    if had("infons"):
        about = F.col("infons")
    else:
        who = F.coalesce(F.col("tax_id").cast("string"), F.array_join("candidates", ",")) if had("candidates") else F.col("tax_id").cast("string")
        about = F.map_filter(F.create_map(F.lit("identifier"), who, F.lit("type"), F.col("type") if had("type") else F.lit(None).cast("string")), lambda _, v: v.isNotNull())
    note = F.struct((F.col("id") if had("id") else F.lit(None).cast("string")).alias("id"), "text", about.alias("infons"), F.array(F.struct(F.col("start").alias("offset"), "length")).alias("locations"))
    notes = mentions.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("at"), F.col("length").alias("len"), F.to_json(note).alias("j")))).alias("found"))
    full = passages_.join(notes, at, "left")
    old = F.coalesce(F.transform("annotations", lambda x: F.to_json(x)), F.array().cast("array<string>"))
    all_ = F.concat(old, F.coalesce(F.transform("found", lambda x: x["j"]), F.array().cast("array<string>")))
    one = _holding(F.to_json(F.struct("offset", "infons", "text")), "annotations", all_)
    per_doc = full.groupBy("file_name", "doc_no").agg(F.array_sort(F.collect_list(F.struct("passage_no", one.alias("j")))).alias("rows"), F.first(F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("doc_infons").alias("infons")))).alias("head"))
    if collections is not None:
        docs = collections.select("file_name", F.posexplode_outer("documents").alias("doc_no", "d")).select("file_name", "doc_no", F.to_json(F.struct("d.id", "d.infons")).alias("head"))
        per_doc = docs.join(per_doc.drop("head"), ["file_name", "doc_no"], "left")
    doc = F.when(F.col("doc_no").isNotNull(), _holding(F.col("head"), "passages", F.coalesce(F.transform("rows", lambda r: r["j"]), F.array().cast("array<string>"))))
    per_file = per_doc.select("file_name", "doc_no", doc.alias("j")).groupBy("file_name").agg(F.array_sort(F.collect_list(F.when(F.col("doc_no").isNotNull(), F.struct("doc_no", "j")))).alias("docs"))
    if collections is None:
        per_file = per_file.withColumn("head", F.lit("{}"))
    else:
        per_file = per_file.join(collections.select("file_name", F.to_json(F.struct("source", "date", "key", "infons")).alias("head")), "file_name")
    return per_file.select("file_name", _holding(F.col("head"), "documents", F.transform("docs", lambda x: x["j"])).alias("json"))


def _holding(head: Column, name: str, items: Column) -> Column:
    """The JSON object ``head`` with one more field, an array of JSON texts."""
    comma = F.when(head == "{}", F.lit("")).otherwise(F.lit(","))
    return F.concat(head.substr(F.lit(1), F.length(head) - 1), comma, F.lit(f'"{name}":['), F.array_join(items, ","), F.lit("]}"))


def annotate_collections(spark: SparkSession, folder: str, out: str, lexicon: DataFrame, pattern: str = "*_bioc.json", case_sensitive: bool = False) -> None:
    """Reads the collections of ``folder`` that ``out`` does not have yet, annotates them by ``lexicon`` (see operators.annotator, also for
    ``case_sensitive``) and writes each to a file of its name, all fields kept."""
    from spanloom.operators.annotator import annotate_passages

    files = read_collections(spark, folder, pattern).join(finished(spark, out, pattern), "file_name", "left_anti")
    rows = passages(files)
    write_collections(annotated_json(rows, annotate_passages(rows, lexicon, case_sensitive), files), out)


def write_annotated(rows: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """One folder of JSON text per input file, by its name."""
    rows.select("file_name", F.col("json").alias("value")).write.partitionBy("file_name").mode(mode).text(folder)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """id: the first column of a .csv or .tsv file without header, or the lines of any other; blank ones go."""
    if path.lower().endswith((".csv", ".tsv")):
        rows = spark.read.csv(path, header=False, sep="," if path.lower().endswith(".csv") else "\t").select(F.trim("_c0").alias("id"))
    else:
        rows = spark.read.text(path).select(F.trim("value").alias("id"))
    return rows.where("id <> ''")


def read_pairs(spark: SparkSession, path: str, left: str = "id", right: str = "name") -> DataFrame:
    """Lines left||right; a missing right side is the empty string, blank lines go."""
    part = F.split("value", "[|][|]")
    return spark.read.text(path).where("trim(value) <> ''").select(part[0].alias(left), F.coalesce(F.get(part, F.lit(1)), F.lit("")).alias(right))
