"""Header mapping and canonical projection.

The alias table is turned into one index, spelling -> (rank, canonical name),
where a spelling is a header's ASCII letters and digits in lower case. Each
source header then makes at most one claim on a canonical name; the claim with
the best rank holds it, and among equal ranks the header further right. Headers
are metadata, so this runs on ``df.columns`` and ends in one ``select``.
Columns are first renamed by position, so headers that differ only by case stay
addressable.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.contracts import COLUMN_ALIASES, OPTIONAL_COLS, REQUIRED_COLS

_SPELLED = frozenset(string.ascii_lowercase + string.digits)


class Claim(NamedTuple):
    rank: int
    position: int


def spelling(header: object) -> str:
    """The letters a-z and digits of a header; accented letters don't count."""
    return "".join(filter(_SPELLED.__contains__, str(header).lower()))


def alias_index(aliases: dict[str, list[str]]) -> dict[str, list[tuple[int, str]]]:
    """Spelling -> the (rank, canonical name) pairs that it may stand for; rank 0 is best."""
    index: dict[str, list[tuple[int, str]]] = {}
    for canonical, variants in aliases.items():
        for rank, variant in enumerate(variants):
            index.setdefault(spelling(variant), []).append((rank, canonical))
    return index


def claims(headers: list[str], aliases: dict[str, list[str]] = COLUMN_ALIASES) -> dict[str, Claim]:
    """Canonical name -> the header that holds it."""
    index = alias_index(aliases)
    held: dict[str, Claim] = {}
    for position, header in enumerate(headers):
        for rank, canonical in index.get(spelling(header), ()):
            if canonical not in held or rank <= held[canonical].rank:
                held[canonical] = Claim(rank, position)
    return held


def canonical_names(headers: list[str], aliases: dict[str, list[str]] = COLUMN_ALIASES) -> list[str]:
    """Each header's canonical name; one that holds none keeps its own."""
    by_position = {claim.position: name for name, claim in claims(headers, aliases).items()}
    return [by_position.get(i, header) for i, header in enumerate(headers)]


def standardize_columns(df: DataFrame, keep: tuple[str, ...] = (), required=REQUIRED_COLS, optional=OPTIONAL_COLS) -> DataFrame:
    """Required columns, then optional ones (NULL where the source has none), as text.

    ``keep`` names bookkeeping columns (such as the row ordinal) that are carried along.
    """
    headers = [c for c in df.columns if c not in keep]
    names = canonical_names(headers)
    place: dict[str, int] = {}
    for i, name in enumerate(names):
        if name in place and (name in required or name in optional):
            raise ValueError(f"columns {headers[place[name]]!r} and {headers[i]!r} both stand for {name}")
        place[name] = i
    if lacking := sorted(set(required) - set(place)):
        raise ValueError(f"the feed has no column for: {', '.join(lacking)}")
    by_place = df.select(*[F.col(f"`{h}`").alias(f"_src{i}") for i, h in enumerate(headers)], *keep)
    wanted = dict.fromkeys([*required, *optional])
    return by_place.select(*[(F.col(f"_src{place[c]}") if c in place else F.lit(None)).cast("string").alias(c) for c in wanted], *keep)
