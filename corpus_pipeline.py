"""Training-data pipeline: reject toxic documents, keep one of each group of near copies, drop benchmark passages, redact
secrets, pack what is left into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farmledger.llm.decontamination import drop_contaminated
from farmledger.llm.jaccard_join import one_of_each_group
from farmledger.llm.packing import pack, public_tokenizer
from farmledger.llm.registry import table
from farmledger.llm.scratch import keep
from farmledger.llm.secret_scan import redact
from farmledger.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 0.8 by five-word shingles the one with the smallest id stays."""
    return one_of_each_group(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return pack(docs, public_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage keeps is written and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
