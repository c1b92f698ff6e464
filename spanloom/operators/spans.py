"""Span algebra: doc_id, start, length (and text) with windows by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Fixed value: the one name whose span is known to end a letter early.
SPLIT_NAME = "Escherichia. col"


def _end() -> Column:
    return F.col("start") + F.col("length")


def dedup_spans(spans: DataFrame) -> DataFrame:
    return spans.dropDuplicates(["doc_id", "start", "length"])


def remove_nested(spans: DataFrame) -> DataFrame:
    """Without spans that lie in another; of equal ones the first stays."""
    w = Window.partitionBy("doc_id").orderBy("start", F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("most", F.max(_end()).over(w)).where(F.col("most").isNull() | (_end() > F.col("most"))).drop("most")


def merge_overlapping(spans: DataFrame) -> DataFrame:
    """Spans that overlap or touch become one."""
    by = Window.partitionBy("doc_id").orderBy("start", "length")
    most = F.max(_end()).over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(most.isNull() | (F.col("start") > most), 1).otherwise(0)
    grouped = spans.withColumn("new", new).withColumn("grp", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("doc_id", "grp").agg(F.min("start").alias("start"), (F.max(_end()) - F.min("start")).alias("length"), F.count(F.lit(1)).alias("n")).drop("grp")


def repair(spans: DataFrame) -> DataFrame:
    """Repairs of a span against its ``passage``: an open parenthesis before it, initials, what trails it,
    ' genus' after it and 'sp.' words that follow. Sets text; rows of author initials go.

    With a column text (the mention as it was matched), spans that read like their text only take the last two repairs, and one that lost two
    parentheses inside it grows by them.
    """
    cut: Column = F.expr("substring(passage, start + 1, length)")
    out = spans.withColumn("s", cut)
    out = out.withColumn("differs", (F.col("text") != F.col("s")) if "text" in spans.columns else F.lit(True))
    plus = lambda when, n, col: F.when(F.col("differs") & when, F.col(col) + n).otherwise(F.col(col))
    short = lambda pattern: F.when(F.col("differs"), F.length(F.regexp_replace("s", pattern, ""))).otherwise(F.col("length"))
    open_ = F.col("s").startswith("(") & ~F.col("s").contains(")")
    if "text" in spans.columns:
        wide = F.expr("substring(passage, start + 1, length + 2)")
        lost = F.col("s").contains("(") & F.col("s").contains(")") & (F.translate(wide, "()", "") == F.col("text"))
        twice = lost & wide.startswith("(") & (F.length(F.translate(wide, "(", "")) < F.length(wide) - 1)
        out = out.withColumn("lost", lost).withColumn("twice", twice).withColumn("length", plus(F.col("lost"), 2, "length")).withColumn("start", plus(F.col("twice"), 1, "start")).drop("lost", "twice")
    out = out.withColumn("start", plus(open_, 1, "start"))
    if "text" not in spans.columns:  # a text as matched never counted the parenthesis
        out = out.withColumn("length", plus(open_, -1, "length"))
    out = out.where(~(F.col("differs") & F.substring("s", 2, 2).isin(", ", ".,"))).withColumn("s", cut)
    out = out.withColumn("length", short("[ (,)]+(genu|associate).*$")).withColumn("s", cut)
    out = out.withColumn("length", short("[., ]+$")).withColumn("s", cut)
    out = out.withColumn("length", plus(F.col("s") == SPLIT_NAME, 1, "length"))
    follows = F.regexp_extract(F.expr("substring(passage, start + length + 1, 6)"), "^( (spp|sp)[.]?)( |$)", 1)
    out = out.withColumn("length", F.col("length") + F.length(follows)).withColumn("s", cut)
    out = out.withColumn("length", F.length(F.regexp_replace("s", "(?i) genus$", ""))).withColumn("s", cut)
    lead = F.lower("s").startswith("genus ")
    out = out.withColumn("start", F.when(lead, F.col("start") + 6).otherwise(F.col("start"))).withColumn("length", F.when(lead, F.col("length") - 6).otherwise(F.col("length")))
    # the test of the length as a generated column: as a plain filter it would be pushed down through all steps, and each step doubles it
    return out.withColumn("text", cut).withColumn("differs", F.explode(F.array(F.col("length") > 0))).where("differs").drop("s", "passage", "differs")


def decode_labels(pieces: DataFrame) -> DataFrame:
    """doc_id, pos, piece, label (1 begins, 0 ends) -> doc_id, first, stop (exclusive) of each entity.

    An end closes the last begin since the end before it; a begin without an end is lost. Either side grows over the
    '##' pieces of its word.
    """
    by = Window.partitionBy("doc_id").orderBy("pos")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    whole = F.when(~F.col("piece").startswith("##"), F.col("pos"))
    at = pieces.withColumn("word", F.coalesce(F.last(whole, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.min("pos").over(Window.partitionBy("doc_id"))))
    at = at.withColumn("next_word", F.coalesce(F.first(whole, ignorenulls=True).over(after), F.max("pos").over(Window.partitionBy("doc_id")) + 1))
    begun = F.last(F.when(F.col("label") == 1, F.struct("pos", "word")), ignorenulls=True).over(before)
    ended = F.last(F.when(F.col("label") == 0, F.col("pos")), ignorenulls=True).over(before)
    at = at.withColumn("begun", begun).withColumn("ended", ended)
    fired = at.where((F.col("label") == 0) & F.col("begun").isNotNull() & (F.col("ended").isNull() | (F.col("begun.pos") > F.col("ended"))))
    return fired.select("doc_id", F.col("begun.word").alias("first"), F.when(F.col("piece").startswith("##"), F.col("next_word")).otherwise(F.col("pos")).alias("stop"))


def piece_windows(pieces: DataFrame, size: int = 512, stride: int = 50) -> DataFrame:
    """doc_id, n -> doc_id, first, stop: windows of ``size`` pieces, each sharing ``stride`` with the one before."""
    step = size - stride
    last = F.greatest(F.lit(0), F.ceil((F.col("n") - size) / step)).cast("long")
    return pieces.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k")).select("doc_id", (F.col("k") * step).alias("first"), F.least(F.col("n"), F.col("k") * step + size).alias("stop"))
