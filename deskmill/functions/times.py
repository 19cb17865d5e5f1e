"""Parsing and arithmetic on wall clocks and instants.

Wall clocks are ``TIMESTAMP_NTZ``; instants are held as UTC ``TIMESTAMP_NTZ``. Neither
depends on the session time zone, and hours across a clock change count as 24 per day.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text formats of the source.
WALL_CLOCK_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$"
INSTANT_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}(Z|[+-]\d{2}(\d{2})?)$"
EXPORT_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"


def wall_clock(text: Column) -> Column:
    """Parse ``yyyy-MM-ddTHH:mm:ss.SSS``; any other text gives null, never an error."""
    return F.when(text.rlike(WALL_CLOCK_SHAPE), text.try_cast("timestamp_ntz"))


def instant(text: Column) -> Column:
    """Parse a zoned time to its UTC clock; any other text gives null.

    The offset is taken off as an interval. A detour over ``TIMESTAMP`` would bring in
    the session zone.
    """
    clock = text.substr(F.lit(1), F.lit(23)).try_cast("timestamp_ntz")
    sign = F.when(text.substr(F.lit(24), F.lit(1)) == "-", -1).otherwise(1)

    def part(start: int) -> Column:
        return sign * F.coalesce(text.substr(F.lit(start), F.lit(2)).try_cast("int"), F.lit(0))

    shifted = clock - F.make_dt_interval(F.lit(0), part(25), part(27))
    return F.when(text.rlike(INSTANT_SHAPE), F.when(text.endswith("Z"), clock).otherwise(shifted))


def local_clock(utc: Column, zone: str) -> Column:
    """The wall clock that ``zone`` shows at a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole units from ``start`` to ``end``, cut towards zero."""
    return F.timestamp_diff(unit, start, end)


def hours_between(start: Column, end: Column) -> Column:
    return elapsed("SECOND", start, end) / F.lit(3600.0)


def month_name(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM")
