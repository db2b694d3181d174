"""From raw documents to token shards, in five stages.

A stage is a function of session, documents and table folder; what it returns is written as
Parquet and read again as the documents of the next. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallylake.llm import decontaminate, mixing, quality_rules, simhash, token_output
from tallylake.llm.registry import importable
from tallylake.workspace import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near fingerprints, the one with the smallest id."""
    importable(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    importable(spark)
    return decontaminate.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=13)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a mix of the sources reaches before one of them runs out; weights are rows to the power 0.7."""
    return mixing.mix(docs, power=0.7, block_rows=8)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards; returns each document's place in them, as read back."""
    importable(spark)
    return token_output.write_and_read(docs, end_id=2, remembered=200_000)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", source_mix),
    ("token_output", tokens),
]

#: SQL can't tokenize; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
