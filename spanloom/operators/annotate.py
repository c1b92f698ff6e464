"""The lexicon annotator as joins and windows over a token table.

Lexicons are reduced to one row per key before a join, so rows never multiply, and windows are by
document. Lexicon sides are left to the optimiser, which broadcasts them by their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanloom.functions.text import clean_token, latin_plurals, latin_singular


#: Texts whose tokens make one Arrow batch.
TOKEN_BATCH = 128


def _token_batches(batches: Iterator[pa.RecordBatch], third: bool = False) -> Iterator[pa.RecordBatch]:
    """One pass over each text, by Arrow's own functions: split, lengths in code points, running sums."""
    for whole in batches:
        for b in (whole.slice(i, TOKEN_BATCH) for i in range(0, whole.num_rows, TOKEN_BATCH)):
            lists = pc.split_pattern(b.column("text"), " ")
            words, owner = lists.flatten(), pc.list_parent_indices(lists)
            doc, n = owner.to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)
            first = np.cumsum(n) - n
            ends = np.cumsum(pc.utf8_length(words).to_numpy().astype(np.int64) + 1)
            before = np.concatenate(([0], ends))
            start = before[:-1] - before[first][doc] + b.column("base").to_numpy()[doc]
            last = np.zeros(len(words), bool)
            last[first + n - 1] = True
            after = pc.if_else(pa.array(last), pa.scalar(None, words.type), pa.concat_arrays([words[1:], words[:1]]))
            columns = [b.column("doc_id").take(owner), pa.array((np.arange(len(words)) - first[doc]).astype(np.int32)), words, pa.array(start), after]
            if third:  # the next one's next
                columns.append(pc.if_else(pa.array(last), pa.scalar(None, words.type), pa.concat_arrays([after[1:], after[:1]])))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "pos", "w", "start", "next", "third"][: len(columns)])


def tokens(docs: DataFrame, offset: str | None = None, third: bool = False) -> DataFrame:
    """doc_id, pos, w, start, next: split at single spaces, empty tokens kept; start counts code points from the offset (null: 0).

    ``third``: also the token after the next, so that no tokens need be joined with each other. No shuffle, and linear in the text. A null text has no tokens.
    """
    base = F.coalesce(F.col(offset), F.lit(0)) if offset else F.lit(0)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text", base.cast("long").alias("base"))
    made = StructType.fromDDL("pos int, w string, start long, next string" + ", third string" * third)
    return rows.mapInArrow(lambda batches: _token_batches(batches, third), StructType([rows.schema["doc_id"], *made]))


def first_by_name(lexicon: DataFrame) -> DataFrame:
    """The first row of each name: name, tax_id, ord."""
    return lexicon.groupBy("name").agg(F.min_by("tax_id", "ord").alias("tax_id"), F.min("ord").alias("ord"))


def _as_compared(c: Column, case_sensitive: bool) -> Column:
    """Words and names as they are compared: as written, or in lower case."""
    return c if case_sensitive else F.lower(c)


def unigram_lexicon(passages: DataFrame, least: int = 6, case_sensitive: bool = False) -> DataFrame:
    """Names of one word, with ids by their order."""
    words = passages.select(F.explode(F.split("text", " ")).alias("w")).select(_as_compared(clean_token(F.col("w")), case_sensitive).alias("name"))
    return _numbered(words.where(F.length("name") >= least).distinct(), "G")


def bigram_lexicon(passages: DataFrame, case_sensitive: bool = False) -> DataFrame:
    t = tokens(passages.select(F.col("item_id").alias("doc_id"), "text")).where("next IS NOT NULL")
    a, b = (_as_compared(clean_token(F.col(c)), case_sensitive) for c in ("w", "next"))
    return _numbered(t.where((F.length(a) >= 5) & (F.length(b) >= 3)).select(F.concat_ws(" ", a, b).alias("name")).distinct(), "S")


def _numbered(names: DataFrame, prefix: str) -> DataFrame:
    ord_ = F.row_number().over(Window.orderBy("name"))  # the lexicon's order is part of its meaning
    return names.select("name", ord_.alias("ord")).withColumn("tax_id", F.concat(F.lit(prefix), F.col("ord").cast("string")))


def mention_counts(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """tax_id, name, n, docs: a word leaves its row only if the lexicon has it, and is counted by document first (doc_id is a document's own)."""
    words = docs.select("doc_id", F.explode(F.split("text", " ")).alias("w")).select("doc_id", F.explode(F.array(F.lower(clean_token(F.col("w"))))).alias("name"))
    by_doc = words.where("length(name) >= 1").join(first_by_name(lexicon), "name").groupBy("tax_id", "name", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return by_doc.groupBy("tax_id", "name").agg(F.sum("n").alias("n"), F.count("doc_id").alias("docs"))


def identify(matches: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Identifiers of matches (name, modifier) by the rows of the lexicon (name, tax_id, kingdom, rank, ord) with exactly that name.

    identifier, types, ambiguous: one row is itself; of several, a modifier takes the last, and without one all candidates stand, for disambiguate_by_neighbour.
    """
    per = lexicon.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("ord", "tax_id", "kingdom", "rank"))).alias("rows"))
    out = matches.join(per, "name")
    chosen = F.element_at("rows", F.when(F.col("modifier").isNotNull(), -1).otherwise(1))
    many = (F.size("rows") > 1) & F.col("modifier").isNull()
    kind = lambda r: F.concat_ws("_", r["kingdom"], F.coalesce(F.col("modifier"), r["rank"], F.lit("no rank")))
    ids = F.when(many, F.transform("rows", lambda r: r["tax_id"])).otherwise(F.array(chosen["tax_id"]))
    types = F.when(many, F.transform("rows", kind)).otherwise(F.array(kind(chosen)))
    return out.withColumn("identifier", ids).withColumn("types", types).withColumn("ambiguous", many).drop("rows")


def unigram_matches(toks: DataFrame, lexicon: DataFrame) -> DataFrame:
    keyed = toks.withColumn("name", F.explode(F.array(F.lower(clean_token(F.col("w")))))).where("length(name) >= 1")
    return keyed.join(first_by_name(lexicon), "name").select("doc_id", "pos", "start", "name", "tax_id")


def bigram_matches(toks: DataFrame, lexicon: DataFrame, *more: str) -> DataFrame:
    """doc_id, pos, start, name, tax_id, and ``more`` columns of the tokens."""
    first, second = (F.lower(clean_token(F.col(c))) for c in ("w", "next"))
    names = first_by_name(lexicon)
    begins = names.select(F.substring_index("name", " ", 1).alias("one")).distinct()  # most tokens go before their next one is cleaned
    begun = toks.where("next IS NOT NULL").withColumn("one", F.explode(F.array(first))).join(begins, "one", "left_semi")
    return begun.withColumn("name", F.explode(F.array(F.concat_ws(" ", "one", second)))).join(names, "name").select("doc_id", "pos", "start", "name", "tax_id", *more)


def greedy_skip(candidates: DataFrame) -> DataFrame:
    """A match takes two tokens: of each run of adjacent candidates every second one, from the first."""
    by = Window.partitionBy("doc_id").orderBy("pos")
    run = candidates.withColumn("island", F.col("pos") - F.row_number().over(by))
    nth = F.row_number().over(Window.partitionBy("doc_id", "island").orderBy("pos"))
    return run.withColumn("nth", nth).where("nth % 2 = 1").drop("nth", "island")


def abbreviation_index(names: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Candidates of 'X. epithet', in lexicon order: initial, epithet, candidates. Case-sensitive, only names with a capital initial have one."""
    part = F.split("name", " ")
    first = F.substring(part[0], 1, 1)
    keyed = names.select("name", "ord", (first if case_sensitive else F.upper(first)).alias("initial"), part[1].alias("epithet"))
    return keyed.groupBy("initial", "epithet").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda s: s["name"]).alias("candidates"))


def resolve_by_history(mentions: DataFrame) -> DataFrame:
    """Each abbreviation (name null) takes the first full name earlier in its document that it may stand for."""
    earlier = Window.partitionBy("doc_id", "initial", "epithet").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return mentions.withColumn("resolved", F.coalesce("name", F.min_by("name", F.when(F.col("name").isNotNull(), F.col("pos"))).over(earlier)))


def disambiguate_by_neighbour(mentions: DataFrame) -> DataFrame:
    """doc_id, pos, type, candidates (structs of type and id) -> id: the first candidate of the neighbour's type.

    A mention with one candidate is itself. Otherwise the first of a document looks at the next, others
    at the one before or, if that is ambiguous too, at the next.
    """
    by = Window.partitionBy("doc_id").orderBy("pos")
    one = F.size("candidates") == 1
    kind = F.when(one, F.col("candidates")[0]["type"])
    before, after = F.lag(kind).over(by), F.lead(kind).over(by)
    rn, n = F.row_number().over(by), F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    seen = F.when((rn == 1) & (n > 1), after).when(rn == n, F.when(n > 1, before)).otherwise(F.coalesce(before, after))
    out = mentions.withColumn("neighbour", seen)
    pick = F.get(F.filter("candidates", lambda c: c["type"] == F.col("neighbour")), F.lit(0))["id"]
    return out.withColumn("resolved", F.when(one, F.col("candidates")[0]["id"]).otherwise(F.coalesce(pick, F.lit("unresolved"))))


def normalise_exact(mentions: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Case-insensitive lookup; the first row of a name wins; no match: null."""
    keys = lexicon.groupBy(F.lower("name").alias("key")).agg(F.min_by("tax_id", "ord").alias("tax_id"))
    return mentions.join(keys, F.lower("mention") == F.col("key"), "left").drop("key")


#: Words after a genus that name its species in general, or the genus itself.
SPECIES_WORDS = ["sp", "spp", "sp.", "spp."]
GENUS_WORDS = ["genus", "gen", "gen."]


def rule_matches(toks: DataFrame, unigrams: DataFrame, bigrams: DataFrame, words: bool = False, case_sensitive: bool = False) -> DataFrame:
    """The word rules in their order, one match at most for each token: doc_id, pos, start, name, tax_id, rule, and with ``words`` w and next.

    A word of the lexicon: the pair with the next word; the pair with the next word in the singular; a species
    or genus word after it; the word alone. A word that stands anywhere in some pair's name: that pair or nothing. Any other: its
    singular. Every join is by equality with one row per name, so no row multiplies.

    Names are in lower case, as the words are compared; case_sensitive, both are compared as written, and a species or genus word may carry
    punctuation.
    """
    word, after = (_as_compared(clean_token(F.col(c)), case_sensitive) for c in ("w", "next"))
    uni, bi = first_by_name(unigrams).select("name", "tax_id"), first_by_name(bigrams).select("name", "tax_id")
    # all words that a rule may begin with, in one table; only their tokens are looked at further
    ids = lambda one, **own: (one.alias("one"), *[own.get(c, F.lit(None).cast(d)).alias(c) for c, d in (("id_one", bi.schema["tax_id"].dataType), ("one_singular", "string"), ("id_one_singular", bi.schema["tax_id"].dataType), ("begins", "boolean"))])
    forms = uni.select(*ids(F.col("name"), id_one=F.col("tax_id")))
    forms = forms.unionByName(uni.select("name", "tax_id", F.explode(latin_plurals(F.col("name"))).alias("plural")).select(*ids(F.col("plural"), one_singular=F.col("name"), id_one_singular=F.col("tax_id"))))
    forms = forms.unionByName(bi.select(F.explode(F.split("name", " ")).alias("part")).select(*ids(F.col("part"), begins=F.lit(True))))
    forms = forms.where("length(one) >= 1").groupBy("one").agg(*[F.max(c).alias(c) for c in ("id_one", "one_singular", "id_one_singular", "begins")])
    # as generated columns: what is joined on is made once for each token
    t = toks.withColumn("one", F.explode(F.array(word))).join(forms, "one")
    t = t.withColumn("after", F.explode(F.array(after))).withColumn("two", F.concat(F.col("one"), F.lit(" "), F.col("after")))
    t = t.withColumn("two_singular", F.concat(F.col("one"), F.lit(" "), F.nullif(latin_singular(F.col("after")), F.lit(""))))
    for key in ("two", "two_singular"):
        t = t.join(bi.select(F.col("name").alias(key), F.col("tax_id").alias(f"id_{key}")), key, "left")
    known, pair, pair_s, single = (F.col(f"id_{k}").isNotNull() for k in ("one", "two", "two_singular", "one_singular"))
    low = F.col("after") if case_sensitive else F.lower("next")
    rule = (
        F.when(known & pair, "pair").when(known & pair_s, "pair in the singular")
        .when(known & low.isin(SPECIES_WORDS), "species word").when(known & low.isin(GENUS_WORDS), "genus word").when(known, "word")
        .when(F.col("begins") & F.col("next").isNotNull(), F.when(pair, "pair of an unlisted word")).when(single, "word in the singular")
    )
    by = lambda a, b, c, d: F.when(F.col("rule").startswith("pair in"), F.col(c)).when(F.col("rule").startswith("pair"), F.col(b)).when(F.col("rule") == "word in the singular", F.col(d)).otherwise(F.col(a))
    out = t.withColumn("rule", rule).where("rule IS NOT NULL")
    return out.select("doc_id", "pos", "start", by("one", "two", "two_singular", "one_singular").alias("name"), by("id_one", "id_two", "id_two_singular", "id_one_singular").alias("tax_id"), "rule", *(["w", "next"] if words else []))
