"""The corpus pipeline: documents that rules keep, without copies and near copies, mixed and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.exact import drop_copies
from spanloom.llm.mixing import mixed_documents
from spanloom.llm.near import drop_near
from spanloom.llm.packing import pack
from spanloom.llm.quality_rules import keep_good

STAGES = [
    ("quality rules", lambda spark, docs, sf_dir: keep_good(spark, docs)),
    ("exact dedup", lambda spark, docs, sf_dir: drop_copies(spark, docs)),
    ("near dedup", lambda spark, docs, sf_dir: drop_near(spark, docs)),
    ("mixing", lambda spark, docs, sf_dir: mixed_documents(spark, docs)),
    ("packing", lambda spark, docs, sf_dir: pack(docs)),
]

#: Expectation-maximisation, hashing in numpy, multinomial draws and subword ids are beyond SQL; tests/llm
#: holds the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.common import staged, table

    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(spark, docs)
    return docs
