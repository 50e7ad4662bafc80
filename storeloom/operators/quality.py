"""Upload gate: validation rules, report, samples and the clean/quarantine split.

Rules run on the raw headers of an all-text frame. One projection adds
``failed_rules`` (row errors) and ``warnings``; one aggregate gives every
count; the duplicate-id warning is a grouped count. Nothing is collected:
the report is a small DataFrame the caller shows or writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.contracts import GATE_REQUIRED_COLS, VALID_CATEGORIES, VALID_REGIONS, VALID_SEGMENTS
from storeloom.functions import is_strict_iso_date, to_number
from storeloom.sources.ordinal import rows_before

ROW_RULES = (["date_format"] + [f"null_{c}" for c in GATE_REQUIRED_COLS]
             + ["revenue_not_numeric", "revenue_non_positive", "quantity_non_positive",
                "category_invalid", "region_invalid"])
#: Columns that rules, warnings and samples read.
JUDGED_COLS = list(dict.fromkeys([*GATE_REQUIRED_COLS, "OrderID", "Date", "Revenue", "Quantity", "Cost", "Category", "Region", "CustomerSegment"]))
WARNING_RULES = ["segment_unknown", "revenue_below_cost", "duplicate_order_id"]


class HardError(ValueError):
    """V1: the file misses required columns; nothing can be loaded."""


def check_columns(df: DataFrame, required=GATE_REQUIRED_COLS) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise HardError(f"Missing columns: {', '.join(missing)}")


def _rules(df: DataFrame) -> list[tuple[str, Column]]:
    rev, qty, cost = to_number("Revenue"), to_number("Quantity"), to_number("Cost")
    rules = [("date_format", F.col("Date").isNotNull() & ~is_strict_iso_date("Date"))]
    rules += [(f"null_{c}", F.col(c).isNull()) for c in GATE_REQUIRED_COLS]
    rules += [
        ("revenue_not_numeric", F.col("Revenue").isNotNull() & rev.isNull()),
        ("revenue_non_positive", rev <= 0),
        ("quantity_non_positive", qty <= 0),
        ("category_invalid", F.col("Category").isNotNull() & ~F.col("Category").isin(*VALID_CATEGORIES)),
        ("region_invalid", F.col("Region").isNotNull() & ~F.col("Region").isin(*VALID_REGIONS)),
    ]
    return [(name, F.coalesce(test, F.lit(False))) for name, test in rules]


def _warnings(df: DataFrame) -> list[tuple[str, Column]]:
    rev, cost = to_number("Revenue"), to_number("Cost")
    out = []
    if "CustomerSegment" in df.columns:
        out.append(("segment_unknown", F.col("CustomerSegment").isNotNull()
                    & ~F.col("CustomerSegment").isin(*VALID_SEGMENTS)))
    out.append(("revenue_below_cost", F.coalesce(rev < cost, F.lit(False))))
    return out


def _names(tests: list[tuple[str, Column]]) -> Column:
    """The names of the tests that hold, in their order.

    One-element arrays are put together: Spark generates code for that, while a filter
    over an array of names is interpreted for each row, with all tests in it.
    """
    one = [F.array(F.lit(n)) for n, _ in tests]
    return F.concat(*[F.when(t, a).otherwise(F.slice(a, 1, 0)) for a, (_, t) in zip(one, tests, strict=True)])


def flag(df: DataFrame) -> DataFrame:
    """V2-V10 as arrays: ``failed_rules`` (row errors, fixed order) and ``warnings``."""
    check_columns(df)
    return df.withColumn("failed_rules", _names(_rules(df))).withColumn("warnings", _names(_warnings(df)))


def _tenths_pct(n: Column, total: Column) -> Column:
    """n / total * 100 rounded half-up to one decimal, as a double; NULL for an empty upload."""
    return (F.floor(F.try_divide(n * 2000 + total, total * 2)) / 10.0).cast("double")


def report(flagged: DataFrame) -> DataFrame:
    """V12 + G4/G5: (rule, kind, n_rows, pct) for every rule, warning and summary line.

    All counts come from one aggregate over the flagged rows, plus one grouped
    count for the duplicate-id warning; the result is a few dozen rows.
    """
    rule_counts = [F.count_if(F.array_contains("failed_rules", r)).alias(r) for r in ROW_RULES]
    warn_counts = [F.count_if(F.array_contains("warnings", w)).alias(w) for w in WARNING_RULES[:2]]
    totals = flagged.agg(F.count(F.lit(1)).alias("total_rows"),
                         F.count_if(F.size("failed_rules") > 0).alias("bad_rows"),
                         *rule_counts, *warn_counts)
    totals = totals.withColumn("clean_rows", F.col("total_rows") - F.col("bad_rows"))
    kinds = [(r, "row") for r in ROW_RULES] + [(w, "warning") for w in WARNING_RULES[:2]]
    kinds += [("total_rows", "summary"), ("bad_rows", "summary"), ("clean_rows", "summary")]
    total = F.col("total_rows")
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(k).alias("kind"), F.col(n).cast("bigint").alias("n_rows"),
                 (_tenths_pct(F.col(n), total) if n in ("revenue_below_cost", "clean_rows") else
                  F.lit(None).cast("double")).alias("pct"))
        for n, k in kinds]))
    rows = totals.select(stacked.alias("r")).select("r.*")
    # Repeated ids after their first occurrence, NULL ids counted as equal
    dups = (flagged.groupBy("OrderID").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_rows"))
            .select(F.lit("duplicate_order_id").alias("rule"), F.lit("warning").alias("kind"), "n_rows",
                    F.lit(None).cast("double").alias("pct")))
    rows = rows.unionByName(dups)
    warning_kinds = (rows.where((F.col("kind") == "warning") & (F.col("n_rows") > 0))
                     .agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit("warning_kinds").alias("rule"), F.lit("summary").alias("kind"),
                             "n_rows", F.lit(None).cast("double").alias("pct")))
    return rows.unionByName(warning_kinds)


def samples(flagged: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """The first five sheet rows of every row rule, and value samples.

    Sheet row = 0-based position in the file + 2 (header is row 1). Value
    samples: first bad date, first three non-numeric revenues, first five
    distinct bad categories / regions / segments in first-seen order.
    """
    narrow = flagged.select(ordinal, "failed_rules", "Date", "Revenue", "Category", "Region",
                            *(["CustomerSegment"] if "CustomerSegment" in flagged.columns else []),
                            "warnings")
    bad = narrow.where((F.size("failed_rules") > 0) | F.array_contains("warnings", "segment_unknown"))
    # at most five ordinals a rule; then one narrow aggregate counts the rows before each of them
    firsts = (narrow.select(ordinal, F.explode("failed_rules").alias("rule"))
              .withColumn("pos", F.row_number().over(Window.partitionBy("rule").orderBy(ordinal))).where(F.col("pos") <= 5))
    first_rows = (firsts.join(rows_before(narrow.select(ordinal), firsts.select(ordinal), ordinal), ordinal)
                  .select("rule", F.col("pos").cast("int").alias("pos"), (F.col("rows_before") + 2).alias("sheet_row"),
                          F.lit(None).cast("string").alias("sample")))
    # value samples, all rules in one pass: (rule, value, ordinal) pairs of the bad rows;
    # rules sampling distinct values keep each value's first row; then k first per rule
    specs = [("date_format", "Date", 1, False, "failed_rules"),
             ("revenue_not_numeric", "Revenue", 3, False, "failed_rules"),
             ("category_invalid", "Category", 5, True, "failed_rules"),
             ("region_invalid", "Region", 5, True, "failed_rules")]
    if "CustomerSegment" in flagged.columns:
        specs.append(("segment_unknown", "CustomerSegment", 5, True, "warnings"))
    pairs = F.explode(F.array_compact(F.array(*[
        F.when(F.array_contains(arr, rule), F.struct(F.lit(rule).alias("rule"), F.col(col).alias("sample"),
                                                     F.lit(distinct).alias("distinct")))
        for rule, col, _, distinct, arr in specs])))
    hits = bad.select(ordinal, pairs.alias("p")).select(ordinal, "p.*")
    distinct_hits = (hits.where("distinct").groupBy("rule", "sample")
                     .agg(F.min(ordinal).alias(ordinal)))
    all_hits = hits.where(~F.col("distinct")).select("rule", "sample", ordinal).unionByName(distinct_hits)
    k = F.create_map(*[x for rule, _, n, _, _ in specs for x in (F.lit(rule), F.lit(n))])
    ranked = all_hits.withColumn("pos", F.row_number().over(Window.partitionBy("rule").orderBy(ordinal)))
    values = (ranked.where(F.col("pos") <= 5).where(F.col("pos") <= k[F.col("rule")])
              .select("rule", F.col("pos").cast("int").alias("pos"),
                      F.lit(None).cast("bigint").alias("sheet_row"), "sample"))
    return first_rows.unionByName(values)


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows) of one flagged frame."""
    clean = flagged.where(F.size("failed_rules") == 0).drop("failed_rules", "warnings")
    rejected = flagged.where(F.size("failed_rules") > 0).drop("warnings")
    return clean, rejected


def decision(flagged: DataFrame, auto_filter: bool) -> DataFrame:
    """V13 as one row: (upload, outcome, rows_to_load). Rows with errors block the load unless they are filtered."""
    totals = flagged.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("failed_rules") > 0).alias("bad"))
    blocked = (F.col("bad") > 0) & F.lit(not auto_filter)
    return totals.select(F.lit("auto_filter" if auto_filter else "as_it_is").alias("upload"), F.when(blocked, "blocked").otherwise("loads").alias("outcome"),
                         F.when(blocked, 0).otherwise(F.col("rows") - F.col("bad")).cast("long").alias("rows_to_load"))
