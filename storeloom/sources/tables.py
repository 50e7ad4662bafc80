"""Table scans (S6) with a parallelism floor.

A scan's partitions follow the files' splits. A large table yields thousands
of splits, but a small file of one row group is a single task, which would
leave the cluster idle for every narrow step above it (text cleaning is
CPU-bound). ``spread`` round-robins such a scan over the cluster's default
parallelism; it costs one small shuffle and is skipped when the scan is
already at least that parallel, so at scale it is a no-op.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str, parallel: bool = False) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir``; only ``columns`` are read when given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if parallel else df
