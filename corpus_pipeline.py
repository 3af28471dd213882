"""Training-corpus pipeline: quality rules, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. The next stage reads it back from Parquet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reachlens.llm import exact_dedup, mixing, packing, quality, queries, simhash
from reachlens.llm.common import prepare, table
from reachlens.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, the row with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their place in a sequence."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_duplicates), ("simhash", near_duplicates), ("mixing", mix), ("packing", packed)]

#: Tokens and fingerprints are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    base = f"{ensure_checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
