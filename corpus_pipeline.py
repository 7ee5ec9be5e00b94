"""Corpus pipeline over `documents`: filter, clean, deduplicate, decontaminate and tokenize.

Every stage takes the documents that the one before kept, written and read again. All but the last return the columns of
documents; the last returns token digests. Rows without doc_id pass the filters, since no verdict can be tied to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.bpe import token_digests
from tripmart.llm.decontaminate import Decontaminate, without_leaks
from tripmart.llm.line_dedup import LineDedup, drop_boilerplate
from tripmart.llm.near_dedup import NearDedup, keep_first
from tripmart.llm.quality_rules import QualityRules, keep_good
from tripmart.llm.queries import vocabulary_path
from tripmart.llm.tables import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"), QualityRules())


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source; n_chars of changed texts is counted anew."""
    cleaned = drop_boilerplate(docs, LineDedup())
    cleaned = cleaned.withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return keep_first(docs, NearDedup())


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), Decontaminate())


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each remaining document."""
    return token_digests(docs, vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("bpe", tokenize),
]

# The isolation forest and the tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
