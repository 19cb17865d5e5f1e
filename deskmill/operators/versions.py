"""Ticket versions: newest per key, change classes, history and current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from deskmill.functions.ratios import count_where

KEY = "unique_key"
HASH = "content_hash_hex"


def latest_version(valid: DataFrame, *also_by: str) -> DataFrame:
    """One row per key: newest update first, missing updates last, larger hash on ties.

    ``also_by`` names columns inside whose values a key is looked for, such as a chunk.

    The rank filter is pushed below the shuffle, so each task sends at most one row
    per key and a key with many versions does not load one task.
    """
    newest = Window.partitionBy(*also_by, KEY).orderBy(
        F.col("source_updated_at").desc_nulls_last(), F.col(HASH).desc()
    )
    return valid.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def classify_changes(batch: DataFrame, current: DataFrame) -> DataFrame:
    """Batch rows with ``change``: inserted, updated or unchanged against ``current``."""
    known = current.select(F.col(KEY), F.col(HASH).alias("_known_hash"))
    return (
        batch.join(known, KEY, "left")
        .withColumn(
            "change",
            F.when(F.col("_known_hash").isNull(), "inserted")
            .when(F.col("_known_hash") != F.col(HASH), "updated")
            .otherwise("unchanged"),
        )
        .drop("_known_hash")
    )


def changed_rows(batch: DataFrame, current: DataFrame) -> DataFrame:
    """Signed rows of what a batch changes: the new row with ``sign`` 1, and for an updated key
    also the stored one with -1. Unchanged keys give nothing."""
    columns = [c for c in batch.columns if c in current.columns]
    old = current.select(KEY, F.struct(*columns).alias("_old"))
    moved = batch.select(KEY, F.struct(*columns).alias("_new")).join(old, KEY, "left")
    moved = moved.filter(F.col("_old").isNull() | (F.col(f"_old.{HASH}") != F.col(f"_new.{HASH}")))
    plus = F.struct(F.col("_new").alias("row"), F.lit(1).alias("sign"))
    minus = F.struct(F.col("_old").alias("row"), F.lit(-1).alias("sign"))
    both = F.when(F.col("_old").isNull(), F.array(plus)).otherwise(F.array(plus, minus))
    return moved.select(F.explode(both).alias("_c")).select("_c.row.*", "_c.sign")


def change_counts(classified: DataFrame, *by: str) -> DataFrame:
    """Row totals per change class."""
    return classified.groupBy(*by).agg(
        F.count("*").alias("staged_rows"),
        *[
            count_where(F.col("change") == kind).alias(f"{kind}_rows")
            for kind in ("inserted", "updated", "unchanged")
        ],
    )


def without_versions(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose (key, hash) the history lacks.

    Only the key is an equality of the join, so rows that lie by key stay where they are; a
    key has few versions.
    """
    known = history.select(F.col(KEY).alias("_key"), F.col(HASH).alias("_hash"))
    same = (F.col(KEY) == F.col("_key")) & F.col(HASH).between(F.col("_hash"), F.col("_hash"))
    return rows.join(known, same, "left_anti")


def append_history(history: DataFrame, batch: DataFrame, run_id: Column) -> DataFrame:
    """History plus the (key, hash) versions it has not seen; A, B, A stays two versions."""
    fresh = (
        without_versions(batch.withColumn("run_id", run_id), history)
        .select(*history.columns)
        .dropDuplicates([KEY, HASH])
    )
    return history.unionByName(fresh)


def upsert_current(
    current: DataFrame,
    batch: DataFrame,
    run_id: Column,
    guard: str | None = None,
) -> DataFrame:
    """Merge a batch (one row per key) into the current state by key.

    A known key keeps its data and first run unless the hash differs; its last run
    always moves. Keys are never deleted. With ``guard`` a changed row wins only if its
    guard column is not older than the stored one.
    """
    data = [c for c in batch.columns if c != KEY]
    old = current.select(KEY, F.struct(*data, "first_seen_run_id", "last_seen_run_id").alias("_old"))
    new = batch.select(KEY, F.struct(*data).alias("_new"))
    wins = F.col("_old").isNull() | (F.col(f"_old.{HASH}") != F.col(f"_new.{HASH}"))
    if guard:
        older = F.col(f"_new.{guard}") < F.col(f"_old.{guard}")
        wins = wins & ~F.coalesce(older, F.lit(False))
    take_new = F.col("_new").isNotNull() & wins
    return old.join(new, KEY, "full_outer").select(
        KEY,
        *[
            F.when(take_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
            for c in data
        ],
        F.coalesce(F.col("_old.first_seen_run_id"), run_id).alias("first_seen_run_id"),
        F.when(F.col("_new").isNotNull(), run_id)
        .otherwise(F.col("_old.last_seen_run_id"))
        .alias("last_seen_run_id"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")
