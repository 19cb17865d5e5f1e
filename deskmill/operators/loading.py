"""Merge of many chunks at once into current state and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from deskmill.operators.versions import HASH, KEY, change_counts, upsert_current, without_versions

HISTORY_FIELDS = [
    KEY, "run_id", HASH, "source_updated_at", "status", "closed_date", "agency",
    "complaint_type", "borough",
]


def classify_chunks(staged: DataFrame, current: DataFrame) -> DataFrame:
    """Change class of every staged row, as if its chunk were merged after the earlier ones.

    A key occurs at most once in a chunk, so the window holds one row per chunk.
    """
    order = Window.partitionBy(KEY).orderBy("chunk_key")
    known = current.select(F.col(KEY), F.col(HASH).alias("_known"))
    before = F.coalesce(F.lag(HASH).over(order), F.col("_known"))
    return (
        staged.join(known, KEY, "left")
        .withColumn("_before", before)
        .withColumn("_last", F.lead(KEY).over(order).isNull())
        .withColumn(
            "change",
            F.when(F.col("_before").isNull(), "inserted")
            .when(F.col("_before") != F.col(HASH), "updated")
            .otherwise("unchanged"),
        )
        .drop("_known", "_before")
    )


def chunk_counts(classified: DataFrame) -> DataFrame:
    return change_counts(classified, "chunk_key")


def new_versions(classified: DataFrame, history: DataFrame, run_id: Column) -> DataFrame:
    """Versions that the history does not hold yet, each once."""
    return (
        without_versions(classified.withColumn("run_id", run_id), history)
        .select(*HISTORY_FIELDS)
        .dropDuplicates([KEY, HASH])
    )


def merged_current(classified: DataFrame, current: DataFrame, run_id: Column) -> DataFrame:
    """Current state after all chunks: the row of the last chunk wins, as in chunk order."""
    batch = classified.filter("_last").drop("_last", "change", "chunk_key")
    return upsert_current(current, batch, run_id)
