"""Summaries and serving aggregates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


def created_day() -> Column:
    return F.to_date("created_date").alias("created_day")


def daily_summary(current: DataFrame) -> DataFrame:
    """Tickets per day, agency, borough and status."""
    return current.groupBy(created_day(), "agency", "borough", "status").agg(
        F.count("*").alias("ticket_count")
    )


def daily_status(current: DataFrame, release_id: Column) -> DataFrame:
    return current.groupBy(
        release_id.cast("bigint").alias("release_id"), created_day(), "status"
    ).agg(F.count("*").alias("ticket_count"))


def agency_status(current: DataFrame, release_id: Column) -> DataFrame:
    return current.groupBy(
        release_id.cast("bigint").alias("release_id"), "agency", "borough", "status"
    ).agg(F.count("*").alias("ticket_count"))


def complaint_counts(current: DataFrame, release_id: Column) -> DataFrame:
    return current.groupBy(
        release_id.cast("bigint").alias("release_id"), "complaint_type"
    ).agg(F.count("*").alias("ticket_count"))


@dataclass(frozen=True)
class Serving:
    """A serving table: how it is counted from the tickets, and the columns of a count."""

    count: Callable[[DataFrame, Column], DataFrame]
    by: tuple[str, ...]


SERVING = {
    "ads_daily_status": Serving(daily_status, ("created_day", "status")),
    "ads_agency_status": Serving(agency_status, ("agency", "borough", "status")),
    "ads_complaint": Serving(complaint_counts, ("complaint_type",)),
}


def maintained(stored: DataFrame, changes: DataFrame, table: str, release_id: Column) -> DataFrame:
    """A serving table after some more changes (rows with ``sign``), without counting again.

    The signed rows are summed and added to the stored counts; counts that come to
    nothing leave. Only the table and the changes are read, never the tickets.
    """
    by = SERVING[table].by
    day = changes.withColumn("created_day", created_day())
    delta = day.groupBy(*by).agg(F.sum("sign").cast("bigint").alias("ticket_count"))
    both = stored.select(*by, "ticket_count").unionByName(delta.select(*by, "ticket_count"))
    sums = both.groupBy(*by).agg(F.sum("ticket_count").alias("ticket_count")).filter("ticket_count <> 0")
    return sums.select(release_id.cast("bigint").alias("release_id"), *by, "ticket_count")


def daily_trend(current: DataFrame) -> DataFrame:
    """Tickets per day from the detail rows, in date order."""
    return (
        current.groupBy(created_day())
        .agg(F.count("*").alias("ticket_count"))
        .orderBy("created_day")
    )


def active_only(serving: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the one active release; the id comes from a scalar subquery."""
    active = registry.filter("is_active").select("release_id").scalar()
    return serving.filter(F.col("release_id") == active)


def resum(serving: DataFrame, *by: Column | str) -> DataFrame:
    return serving.groupBy(*by).agg(F.sum("ticket_count").alias("ticket_count"))


def relative_to_max(totals: DataFrame, name: str = "percent_of_max") -> DataFrame:
    """Each total as a percentage of the largest. For already aggregated, short tables."""
    largest = F.max("ticket_count").over(Window.partitionBy())
    return totals.withColumn(name, F.round(F.col("ticket_count") / largest * 100, 6))


def with_share(totals: DataFrame, name: str = "share") -> DataFrame:
    """Each total as a share of all. For already aggregated, short tables."""
    whole = F.sum("ticket_count").over(Window.partitionBy())
    return totals.withColumn(name, F.round(F.col("ticket_count") / whole, 6))


def top_by_count(totals: DataFrame, name: str, n: int) -> DataFrame:
    """The ``n`` largest totals; equal totals in name order."""
    return totals.orderBy(F.desc("ticket_count"), name).limit(n)


def compare_results(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: sizes of both results, rows only in one of them, and equality.

    Counts copies like EXCEPT ALL in both directions, with one shuffle.
    """
    columns = left.columns
    signed = left.withColumn("_d", F.lit(1)).unionByName(right.withColumn("_d", F.lit(-1)))
    per_row = signed.groupBy(*columns).agg(
        F.sum(F.greatest("_d", F.lit(0))).alias("l"), F.sum(F.greatest(-F.col("_d"), F.lit(0))).alias("r")
    )
    gaps = per_row.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))), F.lit(0)).alias("only_right"),
    )
    return gaps.withColumn("same_result", (F.col("only_left") == 0) & (F.col("only_right") == 0))
