"""What grows with the input: which rows are read on, which are shuffled, and how often."""

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import typos
from spanloom.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rule_matches", "rule_matches_case_sensitive"])
def test_rules_look_further_only_at_words_of_the_lexicon(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert p.count("LeftOuter") == 2 and "regexp_replace(w" not in p


def test_plurals_are_all_words_of_a_singular(spark):
    words = ["ae", "larvae", "bacilli", "bacteria", "a", "i", "aei", "iae", "xus", "xum", "abc", "", "us", "um", "umus", "usa"]
    d = spark.createDataFrame([(w,) for w in words], "w string").withColumn("s", tx.latin_singular(F.col("w")))
    rows = d.where("s <> ''").withColumn("back", tx.latin_plurals(F.col("s"))).collect()
    assert len(rows) == 9 and all(r["w"] in r["back"] for r in rows)
    back = spark.createDataFrame([(w,) for w in words], "n string").select("n", F.explode(tx.latin_plurals(F.col("n"))).alias("p")).select("n", tx.latin_singular(F.col("p")).alias("s")).collect()
    assert back and all(r["n"] == r["s"] for r in back)


def test_words_are_cleaned_without_patterns(spark):
    assert "regexp_replace" not in plan(QUERIES["unigram_match"](spark, SF))


def test_only_words_of_the_lexicon_are_shuffled(spark):
    assert "hashpartitioning(doc_id" not in plan(QUERIES["mention_counts"](spark, SF))


def test_no_mention_carries_its_text_through_sorts(spark):
    p = plan(QUERIES["settled_spans"](spark, SF))
    assert "first(passage" not in p


def test_few_typos_need_no_shuffle_and_many_agree(spark, monkeypatch):
    assert "hashpartitioning" not in plan(QUERIES["typo_correction"](spark, SF))
    d = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", " ", "teh", "a teh  b\u00a0teh", "teh teh", "x drop y", "drop", "a b c", "a teh  b\u00a0teh"])], "i int, text string")
    known = spark.createDataFrame([("teh", "the"), ("drop", ""), ("c", None)], "typo string, correction string")
    few = sorted(typos.correct(d, known).collect())
    assert [r[1] for r in few] == [None, "", "", "the", "a the b the", "the the", "x  y", "", "a b c", "a the b the"]
    monkeypatch.setattr(typos, "FEW", 0)
    assert sorted(typos.correct(d, known).collect()) == few


def test_resampling_reads_a_taxon_once(spark):
    p = plan(QUERIES["resampled_p_values"](spark, SF))
    assert "CoGroup" in p and "sequence(0, 999" not in p
