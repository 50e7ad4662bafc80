"""Load sales files as they land (Structured Streaming over a landing folder).

The original re-runs its load whenever a validated file is uploaded. Here a
file stream over the landing folder hands each micro-batch (the newly landed
files) to the same gate and load; the warehouse upserts make repeated and
overlapping files safe (R3). Progress and exactly-once bookkeeping live in
the stream's checkpoint folder, which must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.contracts import SALES_RAW_COLUMNS
from storeloom.functions import reader_nulls
from storeloom.plans import load as L
from storeloom.sources.text import DIALECT, STRICT, text_schema

SALES_SCHEMA = text_schema(SALES_RAW_COLUMNS)


def landed_sales(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """S1 as a stream: all-string CSV with header, NULL tokens applied, feed ordinal attached."""
    raw = (spark.readStream.schema(SALES_SCHEMA).options(**DIALECT, **STRICT)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(landing_dir))
    where = F.struct(F.col("_metadata.file_modification_time").alias("mtime"),
                     F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"))
    return raw.select(*[reader_nulls(F.col(f"`{c}`")).alias(c) for c in SALES_RAW_COLUMNS],
                      where.alias("_where"))


def with_ordinal(batch: DataFrame) -> DataFrame:
    """Feed order inside a micro-batch: file, split, then position in the split."""
    return batch.withColumn("_ordinal", F.struct(
        F.col("_where.mtime"), F.col("_where.file"), F.col("_where.block"),
        F.monotonically_increasing_id().alias("pos"))).drop("_where")


def load_batch(warehouse_root: str, auto_filter: bool = True):
    """foreachBatch body: gate the micro-batch, quarantine its rejects, load its clean rows.

    Without ``auto_filter`` a micro-batch with rejects stops the stream, so that
    its files stay unprocessed in the checkpoint and no row is lost.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        wh, counts = L.gate_and_load(batch.sparkSession, warehouse_root, with_ordinal(batch), auto_filter=auto_filter)
        if wh is None:
            raise ValueError(f"landed batch {batch_id} has {counts['rejected_rows']} rejected rows (see the quarantine); nothing was loaded")
    return run


def start(spark: SparkSession, landing_dir: str, warehouse_root: str, checkpoint_dir: str,
          available_now: bool = True, auto_filter: bool = True):
    """Start the landing stream; with ``available_now`` it processes what is there and stops."""
    writer = (landed_sales(spark, landing_dir).writeStream
              .foreachBatch(load_batch(warehouse_root, auto_filter))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
