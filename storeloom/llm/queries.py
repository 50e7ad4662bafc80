"""The registered queries of the corpus operators: each over its whole table, in production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import (collocations, decontaminate, latent_votes, line_spread, ngram_join, packing, quality_rules, secret_scan,
                           suffix_dedup, token_alignment, token_counts, toxicity, vantage_trees)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_latent_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_votes.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, _ = token_counts.zipf_vocabulary(tokenizer("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.report(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_trees.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def queries() -> dict:
    own = {name: fn for name, fn in globals().items() if name.startswith("op") and name[2].isdigit()}
    return dict(sorted(own.items(), key=lambda x: int(x[0][2:].split("_")[0])))
