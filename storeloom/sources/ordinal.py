"""Feed order (W3) and positions in it, without a global sort.

A file scan's order is (file path, split start, position in split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def file_ordinal() -> Column:
    """Order of rows as stored in the scanned files (CSV has no row index)."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def rows_before(rows: DataFrame, wanted: DataFrame, ordinal: str) -> DataFrame:
    """For each of a few ``wanted`` ordinals: (ordinal, ``rows_before``), the rows with a smaller one.

    The wanted ordinals become one sorted array; every row is put in the gap
    between two of them, and one map-side combined count per gap, summed up in
    order, gives the positions. No row is sorted or shuffled.
    """
    marks = wanted.select(ordinal).distinct().agg(F.sort_array(F.collect_list(ordinal)).alias("marks"))
    marked = rows.select(ordinal, marks.scalar().alias("_marks"))
    counts = marked.select(F.size(F.filter("_marks", lambda m: m <= F.col(ordinal))).alias("gap")).groupBy("gap").agg(F.count(F.lit(1)).alias("n"))
    # gap k holds the rows from mark k-1 up to mark k: those before mark k are in gaps 0..k
    places = marks.select(F.posexplode("marks").alias("gap", ordinal)).join(counts, "gap", "full_outer")
    upto = Window.orderBy("gap").rowsBetween(Window.unboundedPreceding, 0)  # one row a mark
    return (places.withColumn("rows_before", F.sum(F.coalesce("n", F.lit(0))).over(upto))
            .where(F.col(ordinal).isNotNull()).select(ordinal, "rows_before"))
