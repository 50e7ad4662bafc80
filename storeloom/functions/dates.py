"""Date scalars.

Per-value precedence, every branch guarded by an explicit shape test so
that no format can swallow another's values:

1. ISO ``yyyy-M-d``, optionally followed by a time part (ignored);
2. day first ``d/M/yyyy`` with ``/``, ``-`` or ``.`` as separator;
3. month first ``M/d/yyyy`` with the same separators;
4. compact ``yyyyMMdd``.

Anything else, and impossible dates such as 30 February, is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeloom.functions.text import _col, strip

ISO_PATTERN = r"^(\d{4}-\d{1,2}-\d{1,2})([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
STRICT_ISO_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}\z"
DMY_PATTERN = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}$"
DMY_PARTS = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})\z"
COMPACT_PATTERN = r"^\d{8}$"


def parse_date(c) -> Column:
    """Text -> date with the precedence above; NULL when nothing matches."""
    return date_from_stripped(strip(c))


def date_from_stripped(t) -> Column:
    t = _col(t)
    # a cast reads yyyy-M-d and ignores a time part; unlike a formatter it raises nothing inside for impossible dates
    iso = t.try_cast("date")
    day_first = F.regexp_replace(t, DMY_PARTS, "$3-$2-$1").try_cast("date")
    month_first = F.regexp_replace(t, DMY_PARTS, "$3-$1-$2").try_cast("date")
    compact = F.try_to_date(t, "yyyyMMdd")
    return (
        F.when(t.rlike(ISO_PATTERN), iso)
        .when(t.rlike(DMY_PATTERN), F.coalesce(day_first, month_first))
        .when(t.rlike(COMPACT_PATTERN), compact)
    )


def is_strict_iso_date(c) -> Column:
    """Value is a real date written ``yyyy-M-d`` (no blanks, no time)."""
    c = _col(c)
    return c.rlike(STRICT_ISO_PATTERN) & c.try_cast("date").isNotNull()


def calendar_columns(d) -> list[Column]:
    """Year, month, English month name, quarter, ``yyyy-MM`` of a date column."""
    d = _col(d)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    ]
