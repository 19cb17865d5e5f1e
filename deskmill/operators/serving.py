"""Serving queries over current tickets, assets and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deskmill.functions.ratios import count_where
from deskmill.functions.text import contains_or_all, equals_or_all, is_closed, rank_in_list
from deskmill.functions.times import elapsed
from deskmill.schema import MAX_PAGE_SIZE


def smallest_key_lookup(current: DataFrame, keys: DataFrame, key: str = "unique_key") -> DataFrame:
    """The row of the smallest key; ``keys`` is any frame that holds all keys."""
    return current.filter(F.col(key) == keys.agg(F.min(key)).scalar())


def before_cursor(created: str, key: str) -> Column:
    """Rows strictly below a (created_date, unique_key) cursor.

    The plain bound on the date says nothing new, but it can reach the file scan.
    """
    at = F.lit(created).cast("timestamp_ntz")
    pair = F.struct(F.col("created_date"), F.col("unique_key"))
    return (F.col("created_date") <= at) & (pair < F.struct(at.alias("a"), F.lit(key).alias("b")))


def months_upto(created: str) -> Column:
    """Rows of months not after that of ``created``, by the partition columns of the detail."""
    year, month = int(created[:4]), int(created[5:7])
    return (F.col("created_year") < year) | ((F.col("created_year") == year) & (F.col("created_month") <= month))


def after_cursor(created: str, key: str) -> Column:
    at = F.lit(created).cast("timestamp_ntz")
    pair = F.struct(F.col("created_date"), F.col("unique_key"))
    return (F.col("created_date") >= at) & (pair > F.struct(at.alias("a"), F.lit(key).alias("b")))


def newest_first_page(rows: DataFrame, size: int) -> DataFrame:
    return rows.orderBy(F.desc("created_date"), F.desc("unique_key")).limit(size)


def oldest_first_page(rows: DataFrame, size: int, *ties: str) -> DataFrame:
    return rows.orderBy("created_date", "unique_key", *ties).limit(size)


def mean_close_seconds(current: DataFrame) -> DataFrame:
    """Mean seconds to close per agency, over closed tickets with a valid duration."""
    closed = current.filter(
        is_closed(F.col("status")) & (F.col("closed_date") >= F.col("created_date"))
    )
    seconds = elapsed("SECOND", F.col("created_date"), F.col("closed_date"))
    return closed.groupBy("agency").agg(F.round(F.avg(seconds), 4).alias("avg_seconds"))


def active_age(current: DataFrame, at: str) -> DataFrame:
    """Open tickets and their mean age in whole hours at a fixed time, per agency."""
    hours = elapsed("HOUR", F.col("created_date"), F.lit(at).cast("timestamp_ntz"))
    return (
        current.filter(~is_closed(F.col("status")))
        .groupBy("agency")
        .agg(F.count("*").alias("active_count"), F.round(F.avg(hours), 4).alias("avg_age_hours"))
    )


def count_in_range(current: DataFrame, agency: str, status: str, start: str, end: str) -> DataFrame:
    return current.filter(
        (F.col("agency") == agency)
        & (F.upper("status") == status.upper())
        & (F.col("created_date") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("created_date") < F.lit(end).cast("timestamp_ntz"))
    ).agg(F.count("*").alias("ticket_count"))


def search(
    assets: DataFrame, keyword: str, layer: str, text: Sequence[str], layer_column: str
) -> DataFrame:
    """Keyword contained in any text column, exact layer; an empty argument keeps all."""
    return assets.filter(
        contains_or_all(keyword, *[F.col(c) for c in text])
        & equals_or_all(layer, F.col(layer_column))
    )


def offset_page(
    rows: DataFrame, order: Sequence[Column | str], page: int, size: int
) -> DataFrame:
    """One page in a stated order, with the total number of rows on every row.

    The total is a separate count, so that only the page itself needs the order.
    """
    if page < 0:
        raise ValueError("page must not be negative")
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"size must be between 1 and {MAX_PAGE_SIZE}")
    total = rows.agg(count_where(F.lit(True))).scalar()
    return rows.orderBy(*order).offset(page * size).limit(size).withColumn("total", total)


def in_rank_order(rows: DataFrame, column: str, values: list[str], *then: str) -> DataFrame:
    """Rows ordered by the place of a column in a list (0 = not listed), then by name."""
    return rows.withColumn("rank", rank_in_list(F.col(column), values).cast("int")).orderBy(
        "rank", *then
    )


def runs_with_status(runs: DataFrame, status: str, allowed: Sequence[str]) -> DataFrame:
    wanted = (status or "").strip().upper()
    if wanted and wanted not in allowed:
        raise ValueError(f"status must be one of {', '.join(allowed)}")
    return runs.filter(equals_or_all(wanted, F.col("status")))


def latest_by(rows: DataFrame, by: str) -> DataFrame:
    """The row with the largest id: a top-1, kept per task before it is merged."""
    return rows.orderBy(F.desc(by)).limit(1)


def bounded_sample(
    rows: DataFrame, tests: Sequence[Column], order: Sequence[str], size: int
) -> DataFrame:
    """The first ``size`` rows in a stated order among those that pass every test."""
    for test in tests:
        rows = rows.filter(test)
    return rows.orderBy(*order).limit(size)
