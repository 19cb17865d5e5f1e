"""Ticket frames that the registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.operators.normalize import enrich, normalize, split_rejects
from deskmill.operators.versions import latest_version
from deskmill.sources.tickets import raw_tickets

# Two load runs over the test tickets. The first run saw the first observation of all
# tickets created before FIRST_END; the second run extracts everything created from
# SECOND_START on, so the two overlap.
FIRST_END = "2000-01-01"
SECOND_START = "1998-01-01"

SCOPE_YEAR = 1998
ACTIVE_RELEASE = 2
AGE_REFERENCE = "2002-01-01"


def enriched(spark: SparkSession, folder: str, *keep: str, tasks: int | None = None) -> DataFrame:
    return enrich(normalize(raw_tickets(spark, folder, tasks), *keep))


def valid(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return split_rejects(enriched(spark, folder, *keep))[0]


def current(spark: SparkSession, folder: str) -> DataFrame:
    return latest_version(valid(spark, folder))


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def first_run(spark: SparkSession, folder: str) -> DataFrame:
    rows = valid(spark, folder, "observation")
    seen = rows.filter((F.col("observation") == 1) & (F.col("created_date") < day(FIRST_END)))
    return latest_version(seen.drop("observation"))


def first_current(spark: SparkSession, folder: str) -> DataFrame:
    """Current state after run 1."""
    one = F.lit(1).cast("bigint")
    return first_run(spark, folder).withColumns(
        {"first_seen_run_id": one, "last_seen_run_id": one}
    )


def second_run(spark: SparkSession, folder: str) -> DataFrame:
    rows = valid(spark, folder)
    return latest_version(rows.filter(F.col("created_date") >= day(SECOND_START)))


def history_of(rows: DataFrame, run_id: int) -> DataFrame:
    return rows.select(
        "unique_key",
        F.lit(run_id).cast("bigint").alias("run_id"),
        "content_hash_hex",
        "source_updated_at",
        "status",
        "closed_date",
        "agency",
        "complaint_type",
        "borough",
    )


def releases(spark: SparkSession) -> DataFrame:
    """Release registry rows; the tickets they scope come from the tables."""
    return spark.sql(
        """SELECT * FROM VALUES
             (1L, 'baseline-v1', 1L, 'CANDIDATE', false),
             (2L, 'merged-v2', 2L, 'ACTIVE', true),
             (3L, 'broken-v3', 3L, 'REJECTED', false)
           AS r(release_id, release_key, run_id, status, is_active)"""
    )
