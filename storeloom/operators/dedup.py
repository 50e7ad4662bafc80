"""Order-stable deduplication.

``dropDuplicates`` keeps an arbitrary row, so keep-last / keep-first are
written as ``row_number() = 1`` over the key, ordered by the feed ordinal.
Spark plans this with a partial ``WindowGroupLimit`` before the shuffle:
each map task forwards at most one row per key, so a key holding a third
of all rows still ships one row per map task. Unlike packing the row into
an aggregate buffer, the window lets Catalyst prune every column the
consumer does not read (a KPI over four columns types and moves four).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: list[str], order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*(order if isinstance(order, list) else [order]))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_last(df: DataFrame, keys: list[str], ordinal: str = "_ordinal") -> DataFrame:
    """One row per key, the last in feed order."""
    return _keep(df, keys, F.col(ordinal).desc())


def keep_last_where(df: DataFrame, keys: list[str], condition, ordinal: str = "_ordinal") -> DataFrame:
    """W1 among the rows meeting ``condition`` only: per key, the last such row.

    Rows are ranked by (condition, ordinal) and the first one is kept if it
    meets the condition. Filtering first would let Catalyst push the filter
    below the projection that computes ``condition`` and evaluate that
    projection twice; here the test stays above the window, read once.
    """
    ranked = _keep(df.withColumn("_ok", condition), keys, [F.col("_ok").desc(), F.col(ordinal).desc()])
    return ranked.where(F.col("_ok")).drop("_ok")


def keep_first(df: DataFrame, keys: list[str], ordinal: str = "_ordinal") -> DataFrame:
    """One row per key, the first in feed order."""
    return _keep(df, keys, F.col(ordinal).asc())


def first_value_by_key(df: DataFrame, key: str, value: str, ordinal: str = "_ordinal",
                       key_alias: str | None = None, value_alias: str | None = None) -> DataFrame:
    """W2 for one attribute: key -> its value on the first row (NULL stays NULL)."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias(key_alias or key))
            .agg(F.min_by(F.col(value), F.col(ordinal)).alias(value_alias or value)))
