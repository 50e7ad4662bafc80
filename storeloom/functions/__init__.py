"""Column-expression building blocks (all JVM-side, no Python UDF)."""

from storeloom.functions.dates import calendar_columns, is_strict_iso_date, parse_date
from storeloom.functions.lookups import (
    campaign_from_slug, campaign_type, channel_type, lookup, lookup_or_default,
)
from storeloom.functions.numeric import (
    safe_ratio, sum_or_zero, to_decimal, to_id, to_number,
)
from storeloom.functions.text import clean_text, normalize_key, null_if_token, reader_nulls, strip

__all__ = [
    "calendar_columns", "is_strict_iso_date", "parse_date", "campaign_from_slug",
    "campaign_type", "channel_type", "lookup", "lookup_or_default", 
    "safe_ratio", "sum_or_zero", "to_decimal", "to_id", "to_number",
    "clean_text", "normalize_key", "null_if_token", "reader_nulls", "strip",
]
