"""The corpus pipeline: quality rules, language ID, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the caller
writes as Parquet and reads again as the next stage's docs; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import hd_language, line_frequency, mixing, packing, simhash
from quarry.llm.common import discard, shared_path, temporary
from quarry.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents without the lines that too many documents of their host share."""
    return line_frequency.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that resemble a learned language."""
    return hd_language.keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed training sequences: token ids and the pieces they come from, a row each."""
    return packing.sequences(packing.pack(docs, tokenizer("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Fingerprints (XXH64 majorities), profiles and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage, each one's table written as Parquet; returns the index of the pieces in the sequences.

    What a stage stores on its way, and its input, are deleted once its table is written.
    """
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = shared_path(spark, name)
        with temporary(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(out)
        if path:
            discard(spark, path)
        docs, path = spark.read.schema(made.schema).parquet(out), out
    return packing.piece_index(docs)
