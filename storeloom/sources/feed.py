"""Parallel-array JSON feeds.

A feed document holds one array per measure under ``daily``; row i is the
i-th element of every array. Documents whose arrays differ in length keep
only the common prefix (the shortest array decides, as a zip does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAILY_FIELDS = {
    "time": "date",
    "temperature_2m_mean": "temp_mean",
    "temperature_2m_max": "temp_max",
    "precipitation_sum": "rain_mm",
}

FEED_SCHEMA = T.StructType([T.StructField("daily", T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())),
    T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
    T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
    T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
]))])


def read_feed(spark: SparkSession, path: str, partition_column: str = "region") -> DataFrame:
    """Every document under ``path``; the feed's region comes from its directory."""
    schema = FEED_SCHEMA.add(T.StructField(partition_column, T.StringType()))
    return spark.read.schema(schema).json(path)


def flatten(docs: DataFrame, keep: tuple[str, ...] = ("region",), fields: dict = DAILY_FIELDS) -> DataFrame:
    """One row per array position up to the shortest array."""
    arrays = [F.col(f"daily.{f}") for f in fields]
    n = F.least(*[F.coalesce(F.size(a), F.lit(0)) for a in arrays])
    n = F.greatest(n, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(a, 1, n).alias(f) for a, f in zip(arrays, fields)])
    rows = docs.select(*keep, F.explode(zipped).alias("d"))
    return rows.select(*[F.col(f"d.{f}").alias(out) for f, out in fields.items()], *keep)
