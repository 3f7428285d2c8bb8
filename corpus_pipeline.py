"""Documents to packed training sequences, in five stages; each works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewise.llm import decontam, language, neardup, packing, suffix_dedup
from ratewise.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identified language; learns from their `lang` column."""
    return language.keep_identified(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group linked by 0.8 of their five-word shingles."""
    return neardup.keep_one(docs, n=5, percent=80)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 200 bytes that start in several places. Documents that lose all their text stay, empty."""
    return suffix_dedup.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=1)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of the remaining documents goes in sequences of 1024 tokens."""
    return packing.pack_documents(docs, special=True)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_strings),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: No SQL can tokenise; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the table is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
