"""Text scalars (C1, C2, S1 token nulls, X1-X3, X5): pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeloom.contracts import NA_TOKENS, TEXT_NULL_TOKENS

# Characters removed from both ends by ``strip``: all Unicode white space, as text tools strip it.
WHITESPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing white space (any Unicode space).

    Most values begin and end with a visible ASCII character: two comparisons tell
    that, and only the others are searched for each white space character.
    """
    c = _col(c)
    return F.when(_visible(c) & _visible(F.substring(c, -1, 1)), c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def _visible(c: Column) -> Column:
    """Is the first character a visible ASCII one (bytes are compared)?"""
    return (c >= "!") & (c < "\x7f")


def null_if_token(c, tokens=TEXT_NULL_TOKENS) -> Column:
    """NULL when the value equals one of ``tokens`` exactly (case-sensitive)."""
    c = _col(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def clean_text(c) -> Column:
    """Strip, then exact ``""`` / ``nan`` / ``None`` become NULL."""
    return null_if_token(strip(c), TEXT_NULL_TOKENS)


def reader_nulls(c) -> Column:
    """The delimited-text reader's missing-value tokens become NULL."""
    return null_if_token(c, NA_TOKENS)


def normalize_key(c) -> Column:
    """Strip + lower, the form used for slug lookups."""
    return F.lower(strip(c))
