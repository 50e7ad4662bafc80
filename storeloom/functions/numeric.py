"""Numeric scalars.

The text guard makes the accepted grammar explicit: optional sign, digits
with an optional point (or a leading point), optional exponent, surrounding
blanks. Spark's own cast would also take ``5d``/``5f`` suffixes and turn
``1e400`` into Infinity, so the guard runs first and non-finite results
become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeloom.functions.text import _col, strip

DIGITS_PATTERN = r"^[+-]?\d+$"
# Characters a plain decimal number may contain. Spark's string -> double cast
# accepts exactly R2's grammar over these characters, so "nothing else in it"
# is the guard. One character class is less work than a translate, which looks
# every character up.
NUMBER_PATTERN = r"^[0-9+\-.eE]*\z"
INF = float("inf")


def _only_number_chars(t: Column) -> Column:
    return t.rlike(NUMBER_PATTERN)


def number_from_stripped(t) -> Column:
    """C3 on already stripped text: double, or NULL for bad text and non-finite values."""
    t = _col(t)
    d = t.try_cast("double")
    return F.when(_only_number_chars(t) & (F.abs(d) < F.lit(INF)), d)


def to_number(c) -> Column:
    """Text -> double; bad text, NaN and +/-Infinity -> NULL."""
    return number_from_stripped(strip(c))


def decimal_from_stripped(t, precision: int, scale: int) -> Column:
    t = _col(t)
    return F.when(_only_number_chars(t), t.try_cast(f"decimal({precision},{scale})"))


def to_decimal(c, precision: int, scale: int) -> Column:
    """Text -> decimal(p,s), rounding half-up from the exact text.

    Overflow and bad text give NULL (never an error), so one row cannot
    fail a job; the constraint report (N-5) counts those rows.
    """
    return decimal_from_stripped(strip(c), precision, scale)


def id_from_stripped(t) -> Column:
    t = _col(t)
    as_double = number_from_stripped(t)
    return F.when(t.rlike(DIGITS_PATTERN), t.try_cast("bigint")).otherwise(
        F.when(F.abs(as_double) < F.lit(2.0 ** 63), as_double.cast("bigint"))
    )


def to_id(c) -> Column:
    """Text id -> bigint: digits exactly over the whole range, else through double truncated toward zero; NULL beyond it."""
    return id_from_stripped(strip(c))


def safe_ratio(numerator, denominator, precision: int = 18, scale: int = 6) -> Column:
    """CASE WHEN d IS NULL OR d = 0 THEN NULL ELSE n / d END, as decimal(p,s)."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d != 0, (n / d).try_cast(f"decimal({precision},{scale})"))


def sum_or_zero(c) -> Column:
    """Group sum where a group of only missing values sums to 0, not NULL."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))
