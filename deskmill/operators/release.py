"""Chunk ledger, load gate and release registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from deskmill.operators.profile import one_row


def pending_chunks(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Chunks that the ledger does not hold as committed."""
    done = ledger.filter("status = 'COMMITTED'").select("run_id", "chunk_key")
    return chunks.join(done, ["run_id", "chunk_key"], "left_anti")


def run_totals(ledger: DataFrame) -> DataFrame:
    """Committed rows of each run by change class."""
    totals = ("row_count", "inserted_rows", "updated_rows", "unchanged_rows")
    return (
        ledger.filter("status = 'COMMITTED'")
        .groupBy("run_id")
        .agg(F.count("*").alias("chunks"), *[F.sum(c).alias(c) for c in totals])
    )


def load_gate(staged: DataFrame, current: DataFrame, expected_rows: Column) -> DataFrame:
    """Staged, current and expected rows must agree before a release may be made."""
    rows = one_row(
        [
            staged.agg(F.count("*").alias("staged_rows")),
            current.agg(F.count("*").alias("current_rows")),
        ]
    ).withColumn("expected_rows", expected_rows)
    same = (F.col("staged_rows") == F.col("expected_rows")) & (
        F.col("current_rows") == F.col("expected_rows")
    )
    return rows.withColumn("passed", same)


def register_candidate(
    registry: DataFrame, release_key: str, run_id: int, row_count: Column
) -> DataFrame:
    """Add a release, or reset a known one, as an inactive candidate."""
    spark = registry.sparkSession
    ids = registry.agg(F.coalesce(F.max("release_id"), F.lit(0)) + 1).scalar()
    known = registry.filter(F.col("release_key") == release_key).agg(F.max("release_id")).scalar()
    row = spark.range(1).select(
        F.coalesce(known, ids).alias("release_id"),
        F.lit(release_key).alias("release_key"),
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.lit("CANDIDATE").alias("status"),
        F.lit(False).alias("is_active"),
        row_count.cast("bigint").alias("row_count"),
    )
    return registry.filter(F.col("release_key") != release_key).unionByName(row)


def activate(registry: DataFrame, release_key: str) -> DataFrame:
    """Make one release the only active one; the former active one is a candidate again.

    A rejected release cannot become active, and then nothing changes at all.
    """
    chosen = (F.col("release_key") == release_key) & (F.col("status") != "REJECTED")
    possible = registry.agg(F.coalesce(F.bool_or(chosen), F.lit(False))).scalar()
    status = (
        F.when(possible & chosen, "ACTIVE")
        .when(possible & F.col("is_active") & (F.col("status") == "ACTIVE"), "CANDIDATE")
        .otherwise(F.col("status"))
    )
    active = F.when(possible, chosen).otherwise(F.col("is_active"))
    return registry.withColumns({"status": status, "is_active": active})
