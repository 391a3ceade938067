"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    bpe_count,
    collocations,
    hard_negatives,
    hd_language,
    line_frequency,
    line_runs,
    mixing,
    norm_buckets,
    packing,
    perspectives,
    simhash,
    toxicity,
    warc,
)


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; the package is installed beside Python."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return str(Path("/opt/tokenizers") / name)
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.line_verdicts(_table(spark, sf_dir, "documents"))


def op2_bpe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(_table(spark, sf_dir, "conversations"))


def op4_hd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hd_language.identify(_table(spark, sf_dir, "documents"))


def op5_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.top_k(_table(spark, sf_dir, "embeddings"))


def op6_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.place(packing.pieces(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), digest=True))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", "embedding", moved.alias("label")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_frequency, op2_bpe_counts, op3_perspectives, op4_hd_language, op5_norm_buckets,
        op6_systematic_mix, op7_warc_index, op8_simhash, op9_best_fit_packing, op10_toxicity,
        op11_line_runs, op12_collocations, op13_hard_negatives)
}
