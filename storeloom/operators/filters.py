"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.contracts import SALES_DROP_REASONS


def drop_reason(reasons=SALES_DROP_REASONS) -> Column:
    """the first failing reason, in fixed order, or NULL when the row is kept."""
    expr = None
    for column, reason in reasons:
        test = F.col(column).isNull()
        expr = F.when(test, F.lit(reason)) if expr is None else expr.when(test, F.lit(reason))
    return expr


def with_drop_reason(df: DataFrame, reasons=SALES_DROP_REASONS, name: str = "drop_reason") -> DataFrame:
    return df.withColumn(name, drop_reason(reasons))


def drop_reason_counts(flagged: DataFrame, name: str = "drop_reason") -> DataFrame:
    """Rows dropped per first reason (each row counted once)."""
    return (flagged.where(F.col(name).isNotNull())
            .groupBy(name).agg(F.count(F.lit(1)).alias("dropped_rows")))


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows with NULL (or NaN) in any of ``subset``."""
    return df.dropna(how="any", subset=subset)
