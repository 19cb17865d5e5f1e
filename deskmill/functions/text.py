"""Text rules shared by every layer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from deskmill.schema import UNKNOWN


def is_blank(column: Column) -> Column:
    """True for null and for the empty string; never null itself."""
    return column.isNull() | (column == "")


def is_closed(status: Column) -> Column:
    """Status comparison ignores case in every layer."""
    return F.upper(status) == "CLOSED"


def borough_name(column: Column) -> Column:
    return F.coalesce(F.upper(F.trim(column)), F.lit(UNKNOWN))


def contains_or_all(keyword: str, *columns: Column) -> Column:
    """``LIKE '%keyword%'`` on any column; an empty keyword keeps every row."""
    word = (keyword or "").strip()
    if not word:
        return F.lit(True)
    hit = F.lit(False)
    for column in columns:
        hit = hit | column.contains(word)
    return hit


def equals_or_all(value: str, column: Column) -> Column:
    word = (value or "").strip()
    return column == word if word else F.lit(True)


def rank_in_list(column: Column, values: list[str]) -> Column:
    """1-based place of the value in a fixed list, 0 if it is not listed."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), column), F.lit(0))
