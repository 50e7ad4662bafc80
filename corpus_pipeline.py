"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Every stage takes all that its predecessor kept and works on whole texts:
toxic documents go; boilerplate lines go; one document of each near-duplicate
group stays; documents with benchmark passages go; the rest is packed into
windows of token ids. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.llm import decontaminate, line_spread, ngram_join, packing, toxicity
from storeloom.llm.queries import table, tokenizer
from storeloom.session import scratch_folder


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network doesn't reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines removed; ``n_chars`` counts what is left."""
    out, clean, n = line_spread.without_boilerplate(docs)
    changed = F.col(n) > 0
    own = {"text": F.when(changed, F.col(clean)).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(clean).cast("long")).otherwise(F.col("n_chars"))}
    return out.select(*[own.get(c, F.col(c)).alias(c) for c in docs.columns])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed windows."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", clean), ("line_dedup", lines), ("near_duplicates", distinct), ("decontamination", decontaminated), ("packing", packed)]

ORACLE_SQL = None  # token ids and models are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each one's result is kept in the shared checkpoint folder."""
    root = scratch_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.parquet(f"{root}/{k}-{name}")
    return docs
