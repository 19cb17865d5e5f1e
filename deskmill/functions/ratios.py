"""Ratios with a defined value for an empty denominator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double; 0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def count_where(test: Column) -> Column:
    """Rows for which ``test`` holds; 0 on empty input."""
    return F.count_if(test)
