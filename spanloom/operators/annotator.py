"""The lexicon annotator as one call: passages in, mentions with identifiers out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import clean_token, trim_candidates
from spanloom.operators import annotate, spans
from spanloom.operators.lineage import cut

_AT = ["file_name", "doc_id", "passage_no"]


def abbreviations(toks: DataFrame, full: DataFrame, pairs: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """doc_id, pos, start, w, next, names: each 'X. epithet' with the names it may stand for.

    toks and full have doc_id as a struct with file_name, doc_id and passage_no; full (doc_id, pos, name) are the matches of whole pairs, pairs
    (name, ord) the pairs of the lexicon. Of several names the one that the document used first, before this place, is it; else all stand.
    """
    index = annotate.abbreviation_index(pairs.where(F.size(F.split("name", " ")) == 2), case_sensitive)
    epithet = clean_token(F.col("next"))
    short = toks.where(F.col("w").rlike("^\\(?\\p{Lu}[.]$")).withColumn("initial", F.regexp_extract("w", "\\p{Lu}", 0)).withColumn("epithet", epithet if case_sensitive else F.lower(epithet))
    met = short.join(index, ["initial", "epithet"])
    part = F.split("name", " ")
    initial = F.substring(part[0], 1, 1) if case_sensitive else F.upper(F.substring(part[0], 1, 1))
    before = full.where(F.size(part) == 2).select("doc_id", "pos", initial.alias("initial"), part[1].alias("epithet"), "name")
    # one order over the whole document: resolve_by_history sees (passage, position) as a position
    whole = lambda df, name: df.select(F.struct("doc_id.file_name", "doc_id.doc_id").alias("doc_id"), F.struct("doc_id.passage_no", "pos").alias("pos"), "initial", "epithet", name.alias("name"))
    history = annotate.resolve_by_history(whole(before, F.col("name")).unionByName(whole(met, F.lit(None).cast("string")))).where("name IS NULL")
    known = history.select(F.struct("doc_id.file_name", "doc_id.doc_id", "pos.passage_no").alias("doc_id"), F.col("pos.pos").alias("pos"), "resolved")
    chosen = F.when(F.size("candidates") == 1, F.col("candidates")).when(F.col("resolved").isNotNull(), F.array("resolved")).otherwise(F.col("candidates"))
    return met.join(known, ["doc_id", "pos"], "left").select("doc_id", "pos", "start", "w", "next", chosen.alias("names"))


def annotate_passages(passages: DataFrame, lexicon: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """file_name, doc_id, passage_no, start, length, text, tax_id, type, candidates: the mentions of passages (as sources.files.passages gives them).

    lexicon: name, tax_id, kingdom, rank, ord; names of one word and of two are looked up, several rows of a name are candidates. In this order: the
    word rules and abbreviations, a token in one match only; identifiers; the neighbours' type for what is ambiguous; repair of the spans. start
    counts from the passage's offset. What stays ambiguous has type 'unresolved' and tax_id null, and of four or more candidates the first and
    the last. Null and empty texts have no mentions; a null offset is 0. Matching runs at once (a checkpoint before the repair).

    Names match in any case. case_sensitive, words and names are compared as written: 'Bacillus' is no 'bacillus', an abbreviation takes the epithet
    as written, and names that differ only in case are different names with candidates of their own.
    """
    lex = lexicon.select((F.col("name") if case_sensitive else F.lower("name")).alias("name"), "tax_id", "kingdom", "rank", "ord")
    size = F.size(F.split("name", " "))
    keyed = passages.select(F.struct(*_AT).alias("doc_id"), "text")
    toks = annotate.tokens(keyed)
    words = annotate.rule_matches(toks, lex.where(size == 1), lex.where(size == 2), words=True, case_sensitive=case_sensitive)
    modifier = F.when(F.col("rule") == "species word", "species").when(F.col("rule") == "genus word", "genus")
    words = words.select("doc_id", "pos", "start", "w", "next", F.array("name").alias("names"), modifier.alias("modifier"), F.col("rule").startswith("pair").alias("two"))
    full = words.where("two").select("doc_id", "pos", F.col("names")[0].alias("name"))
    short = abbreviations(toks, full, lex.where(size == 2).groupBy("name").agg(F.min("ord").alias("ord")), case_sensitive)
    both = words.unionByName(short.withColumn("modifier", F.lit(None).cast("string")).withColumn("two", F.lit(True)))

    # a match of two tokens takes the next one: of a run of such, every second counts
    by = Window.partitionBy("doc_id").orderBy("pos")
    linked = F.coalesce((F.lag("pos").over(by) == F.col("pos") - 1) & F.lag("two").over(by), F.lit(False))
    runs = both.withColumn("run", F.sum((~linked).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    kept = runs.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "run").orderBy("pos"))).where("nth % 2 = 1").drop("run", "nth")

    surface = F.when(F.col("two"), F.concat_ws(" ", clean_token(F.col("w")), clean_token(F.col("next")))).otherwise(clean_token(F.col("w")))
    each = kept.select("doc_id", "pos", "start", surface.alias("text"), "modifier", F.explode("names").alias("name"))
    found = annotate.identify(each, lex)
    pair = F.transform(F.arrays_zip("types", "identifier"), lambda z: F.struct(z["types"].alias("type"), z["identifier"].alias("id")))
    per = found.groupBy("doc_id", "pos").agg(
        F.first("start").alias("start"), F.first("text").alias("text"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("name", pair.alias("c")))), lambda x: x["c"])).alias("candidates")
    )
    settled = annotate.disambiguate_by_neighbour(per.withColumn("candidates", F.array_distinct("candidates")))
    open_ = F.col("resolved") == "unresolved"
    kind = F.when(open_, F.lit("unresolved")).otherwise(F.get(F.filter("candidates", lambda c: c["id"].cast("string") == F.col("resolved")), F.lit(0))["type"])
    ids = F.transform("candidates", lambda c: c["id"].cast("string"))
    named = settled.select("doc_id", "start", F.length("text").cast("long").alias("length"), "text", F.when(~open_, F.col("resolved")).alias("tax_id"), kind.alias("type"), F.when(open_, trim_candidates(ids)).alias("candidates"))
    # cut, as matching and repair in one stage are more code than the JVM compiles at once
    repaired = spans.repair(cut(named).join(keyed.select("doc_id", F.col("text").alias("passage")), "doc_id"))
    offset = passages.select(F.struct(*_AT).alias("doc_id"), F.coalesce(F.col("offset"), F.lit(0)).cast("long").alias("offset"))
    out = repaired.join(offset, "doc_id").withColumn("start", F.col("start") + F.col("offset"))
    return out.select("doc_id.*", "start", F.col("length").cast("long").alias("length"), "text", "tax_id", "type", "candidates")
