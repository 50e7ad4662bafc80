"""Feed cleaners (T1-T3): raw all-text feed -> typed, filtered, deduplicated rows.

Each is one lazy plan; the only shuffle is the dedup (sales, weather) or the
day x campaign aggregation (ads), both partial-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.contracts import OPTIONAL_COLS, SALES_NUMERIC_COLS, SALES_TEXT_COLS
from storeloom.functions import (
    campaign_from_slug, null_if_token, parse_date, strip, sum_or_zero, to_decimal, to_number,
)
from storeloom.functions.dates import date_from_stripped
from storeloom.functions.numeric import id_from_stripped, number_from_stripped
from storeloom.operators.dedup import keep_last, keep_last_where
from storeloom.operators.filters import drop_missing, with_drop_reason
from storeloom.operators.mapping import standardize_columns

ORDINAL = "_ordinal"


def typed_sales(raw: DataFrame, ordinal: str = ORDINAL, columns: tuple[str, ...] | None = None) -> DataFrame:
    """P1-P5, C4, C1, C3, C6 and the F1 drop reason; nothing removed yet.

    A reader of a few optional ``columns`` names them; the required ones are always there.
    """
    optional = OPTIONAL_COLS if columns is None else [c for c in OPTIONAL_COLS if c in columns]
    df = standardize_columns(raw, keep=(ordinal,), optional=optional)
    # strip once; later steps reuse the stripped text (Catalyst keeps this
    # projection separate because its outputs are referenced several times)
    stripped = df.select(*[strip(c).alias(c) if c != ordinal else F.col(c) for c in df.columns])
    exprs = []
    for c in df.columns:
        if c == "date":
            exprs.append(date_from_stripped(c).alias(c))
        elif c in SALES_TEXT_COLS:
            exprs.append(null_if_token(c).alias(c))
        elif c == "order_id":
            exprs.append(id_from_stripped(c).alias(c))
        elif c in SALES_NUMERIC_COLS:
            exprs.append(number_from_stripped(c).alias(c))
        else:
            exprs.append(F.col(c))
    return with_drop_reason(stripped.select(*exprs))


def with_year_and_month(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("date")).withColumn("month", F.month("date"))


def last_usable(typed: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """The last row without a drop reason per order_id."""
    return keep_last_where(typed, ["order_id"], F.col("drop_reason").isNull(), ordinal).drop("drop_reason")


def clean_sales(raw: DataFrame, ordinal: str = ORDINAL, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Typed rows without a drop reason, year/month from the date, last row per order_id.

    The F1 filter is folded into the dedup (see ``keep_last_where``) so the
    critical columns are parsed once.
    """
    return with_year_and_month(last_usable(typed_sales(raw, ordinal, columns), ordinal))


ADS_MEASURES = ("spend", "impressions", "clicks", "conversions")


def typed_ads(raw: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """C4, C7, C3 then F2: rows with a date, a known campaign and a spend."""
    keep = [F.col(ordinal)] if ordinal in raw.columns else []
    typed = raw.select(
        parse_date("date").alias("date"),
        campaign_from_slug("campaign").alias("campaign"),
        *[to_decimal(c, 28, 10).alias(c) for c in ADS_MEASURES],
        *keep,
    )
    return drop_missing(typed, ["date", "campaign", "spend"])


def clean_ads(raw: DataFrame) -> DataFrame:
    """Parse, map slugs (unmapped rows drop), sum per day x campaign.

    Sums run in decimal(28,10) so task order cannot change them; a group
    whose values are all missing sums to 0.
    """
    kept = typed_ads(raw).drop(ORDINAL)
    sums = [sum_or_zero(c).alias(c) for c in ADS_MEASURES]
    return kept.groupBy("date", "campaign").agg(*sums)


def typed_weather(raw: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """Parse, strip region (no NULL tokens), drop incomplete rows."""
    typed = raw.select(
        parse_date("date").alias("date"),
        strip("region").alias("region"),
        *[to_number(c).alias(c) for c in ("temp_mean", "temp_max", "rain_mm")],
        F.col(ordinal),
    )
    return drop_missing(typed, ["date", "region", "temp_mean"])


def clean_weather(raw: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """Complete typed rows, the last one per day x region."""
    return keep_last(typed_weather(raw, ordinal), ["date", "region"], ordinal)
