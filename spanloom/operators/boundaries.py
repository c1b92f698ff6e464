"""What a span model's mentions still need: bounds at words, abbreviations, long mentions, species words.

The steps of ``settle`` follow each other on one mention, each reading what the one before has made of it. Every step is bound to a
variable of a higher-order function, so an expression grows by one step's size with each step, where plain columns would double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators import spans
from spanloom.operators.annotate import SPECIES_WORDS

_SPACE = "[\\t-\\r\\x1c-\\x1f \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_MOST = 2**31 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _applied(holds: Column, effect: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: F.when(holds, effect(x)).otherwise(x)


def _still(step: Callable[[Column, Column], Column], passage: Column) -> Callable[[Column], Column]:
    """The step on what has not gone."""
    return lambda x: F.when(x["text"].isNotNull(), step(passage, x)).otherwise(x)


def words(s: Column) -> Column:
    return F.filter(F.split(s, f"{_SPACE}+"), lambda w: w != "")


def first_words(s: Column, n: Column | int) -> Column:
    """The first ``n`` words; what follows is not split, and not read where a stretch of some spaces more has them all."""
    n = F.lit(n) if isinstance(n, int) else n
    some = lambda x: F.filter(F.slice(F.split(F.regexp_replace(x, f"^{_SPACE}+", ""), f"{_SPACE}+", n + 1), F.lit(1), n), lambda w: w != "")
    near = F.call_function("substring_index", s, F.lit(" "), 2 * n + 4)
    return let(near, lambda x: let(some(x), lambda ws: F.when((F.size(ws) >= n) | (F.octet_length(x) == F.octet_length(s)), ws).otherwise(some(s))))


def _mention(text: Column, start: Column, length: Column) -> Column:
    return F.struct(text.alias("text"), start.cast("long").alias("start"), length.cast("long").alias("length"))


def _from(passage: Column, at: Column, n: Column | None = None) -> Column:
    """The passage from a place on; nothing of a length below one."""
    return passage.substr((at + 1).cast("int"), F.lit(_MOST) if n is None else F.greatest(n, F.lit(0)).cast("int"))


def _run(pattern: str, s: Column) -> Column:
    return F.length(F.regexp_extract(s, pattern, 0))


def at_words(passage: Column, m: Column) -> Column:
    """Without white space at the ends, then grown over the letters on either side; at the passage's end it doesn't grow."""
    end = m["start"] + m["length"]
    # most mentions begin and end with no white space, and letters end at a space: no pattern is then run over the passage
    begins, ends = (_from(passage, at, F.lit(1)).rlike(_SPACE) for at in (m["start"], end - 1))
    start_ = m["start"] + F.when(begins, _run(f"^{_SPACE}*", _from(passage, m["start"]))).otherwise(0)
    end_ = end - F.when(ends | (end > F.length(passage)), _run(f"{_SPACE}*$", _from(passage, F.lit(0), end))).otherwise(0)

    def grown(b: Column) -> Column:
        fixed = (b["end"] >= F.length(passage)) | (b["start"] > b["end"])
        left = F.when(fixed, 0).otherwise(_run("\\p{L}*$", F.substring_index(_from(passage, F.lit(0), b["start"]), " ", -1)))
        right = F.when(fixed, 0).otherwise(_run("^\\p{L}*", F.substring_index(_from(passage, b["end"]), " ", 1)))
        return F.struct((b["start"] - left).alias("start"), (b["end"] + right).alias("end"))

    def kept(b: Column) -> Column:
        same = (b["start"] == m["start"]) & (b["end"] == end)
        n = b["end"] - b["start"]
        return F.when(same, m).otherwise(_mention(_from(passage, b["start"], n), b["start"], n))

    return let(let(F.struct(start_.alias("start"), end_.alias("end")), grown), kept)


def full_abbreviations(passage: Column, m: Column) -> Column:
    """A mention of one or two characters goes (text null) unless the passage has a word of two there; an initial with its dot takes the
    next word, as many characters as that has letters."""

    def told(w: Column) -> Column:
        first, second = F.get(w, F.lit(0)), F.get(w, F.lit(1))
        letters = F.length(F.regexp_replace(second, "\\P{L}", ""))
        pair = F.concat(first, F.lit(" "), second.substr(F.lit(1), letters))
        return (
            F.when(F.coalesce(F.length(first) != 2, F.lit(True)), _mention(F.lit(None).cast("string"), m["start"], m["length"]))
            .when(first.rlike("^\\p{L}[.]$") & second.isNotNull(), _mention(pair, m["start"], F.length(pair)))
            .otherwise(m)
        )

    return F.when(F.length(m["text"]).isin(1, 2), let(first_words(_from(passage, m["start"]), 2), told)).otherwise(m)


def cut_long(passage: Column, m: Column, repair_offsets: bool = False) -> Column:
    """A mention of three words or more loses the first or all beyond the second, by initials, species words and case.

    The rules are tried in order and each that holds has its effect. By default a leading initial moves the start to the length of what is
    kept, and a second word that is an initial moves it twice, as existing annotations have it; ``repair_offsets`` keeps places right.
    """

    def told(w: Column) -> Column:
        one, two, three = (F.element_at(w, i) for i in (1, 2, 3))
        pair, rest = F.concat(one, F.lit(" "), two), F.array_join(F.slice(w, F.lit(2), F.size(w)), " ")
        first = lambda x: _mention(pair, x["start"], F.length(pair))
        after = lambda x: _mention(rest, (m["start"] if repair_offsets else x["start"]) + F.length(one) + 1, F.length(rest))
        moved = lambda x: _mention(pair, x["start"] if repair_offsets else F.length(pair), F.length(pair) if repair_offsets else x["length"])
        initial, dotted = "^\\p{L}[.]", "^\\p{L}(.*)[.]$"
        rules = [
            (one.rlike(initial), moved), (two.rlike(initial), after), (one.rlike(dotted), first), (two.rlike(dotted), after), (two.isin(SPECIES_WORDS), first),
            (one.rlike("^\\p{Lu}") & two.rlike("^\\p{Ll}"), first), (one.rlike("^\\p{Ll}") & two.rlike("^\\p{Lu}"), after),
        ]
        out = m
        for holds, effect in rules:
            out = let(out, _applied(holds, effect))
        return F.when(~three.isin(SPECIES_WORDS), out).otherwise(m)

    return let(words(m["text"]), lambda w: F.when(F.size(w) > 2, told(w)).otherwise(m))


def with_species_word(passage: Column, m: Column) -> Column:
    """Grown by a species word that follows, where the word before that is the mention's last (or its only one)."""

    def told(b: Column) -> Column:
        own, here = b["own"], b["here"]
        n = F.size(own)
        whole = F.array_join(F.slice(here, F.lit(1), n + 1), " ")
        holds = (n > 0) & F.get(here, n).isin(SPECIES_WORDS) & ((n == 1) | (F.get(here, n - 1) == F.element_at(own, -1)))
        return F.when(holds, _mention(whole, m["start"], F.length(whole))).otherwise(m)

    return let(words(m["text"]), lambda own: let(F.struct(own.alias("own"), first_words(_from(passage, m["start"]), F.size(own) + 1).alias("here")), told))


def settled(passage: Column, text: Column, start: Column, length: Column, repair_offsets: bool = False) -> Column:
    """text, start, length of a mention after all steps; text is null where it goes."""
    m = _mention(text, start, length)
    for step in (at_words, full_abbreviations, lambda p, x: cut_long(p, x, repair_offsets), with_species_word):
        m = let(m, _still(step, passage))
    return m


def settle(mentions: DataFrame, docs: DataFrame, repair_offsets: bool = False) -> DataFrame:
    """doc_id, start, length, text: the mentions (doc_id, start, length) of the texts (doc_id, text) after all steps, none in
    another, those that overlap or touch as one.

    Equal mentions count once; one of no length, or of white space only, goes. A document without text has none.
    """
    met = mentions.select("doc_id", "start", "length").distinct().join(docs.select("doc_id", F.col("text").alias("passage")), "doc_id")
    own = F.col("passage").substr((F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    # the steps as a generated column: a filter on their outcome would otherwise be pushed down, and they would run twice
    made = met.withColumn("m", F.explode(F.array(settled(F.col("passage"), own, F.col("start"), F.col("length"), repair_offsets))))
    made = made.where("m.text <> '' AND m.length > 0").select("doc_id", "m.*")
    one = made.groupBy("doc_id", "start", "length").agg(F.min("text").alias("text"))
    return merge_in_text(spans.remove_nested(one), docs)


def merge_in_text(mentions: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, start, length, text: mentions that overlap or touch become one, whose text is that of the texts (doc_id, text), trimmed.

    A text meets only the mentions made of several; no row carries it before.
    """
    by = Window.partitionBy("doc_id").orderBy("start", "length")
    end = F.col("start") + F.col("length")
    most = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = mentions.withColumn("new", F.when(most.isNull() | (F.col("start") > most), 1).otherwise(0))
    runs = runs.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    one = runs.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n"), F.min("text").alias("text"))
    one = one.select("doc_id", "start", (F.col("end") - F.col("start")).alias("length"), "n", "text")
    several = one.where("n > 1").join(docs.select("doc_id", F.col("text").alias("passage")), "doc_id")
    whole = F.regexp_replace(_from(F.col("passage"), F.col("start"), F.col("length")), f"^{_SPACE}+|{_SPACE}+$", "")
    return one.where("n = 1").select("doc_id", "start", "length", "text").unionByName(several.select("doc_id", "start", "length", whole.alias("text")).dropDuplicates(["doc_id", "start"]))
