"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import contamination, conversations, exact, html_text, lm, merkle, mixing, near, packing, quality_cnn, quality_rules, repeats, toxicity


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents; that file is needed for this query alone."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_packing": packing.op2_packing,
    "op3_mixing": mixing.op3_mixing,
    "op4_exact_dedup": exact.op4_exact_dedup,
    "op5_near_dedup": near.op5_near_dedup,
    "op6_quality_classifier": quality_cnn.op6_quality_classifier,
    "op7_lm_scoring": lm.op7_lm_scoring,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_repeat_removal": repeats.op9_repeat_removal,
    "op10_html_extraction": html_text.op10_html_extraction,
    "op11_decontamination": contamination.op11_decontamination,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
    "pipeline": pipeline,
}

ORACLE_SQL = {
    "op4_exact_dedup": exact.OP4_SQL, "op11_decontamination": contamination.OP11_SQL, "op12_conversation_repair": conversations.OP12_SQL, "op13_merkle_manifest": merkle.OP13_SQL,
}
