"""Stream of ticket pages into the ticket store."""

from __future__ import annotations

from urllib.parse import quote, urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmill.operators.normalize import enrich, normalize, split_rejects
from deskmill.operators.versions import latest_version
from deskmill.schema import LOCAL_ZONE, RAW_SCHEMA
from deskmill.sources.store import TicketStore


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New page files as normalised tickets; the place below ``path`` is the chunk, since
    every month folder has a first page of the same name."""
    below = quote(urlparse(path).path.rstrip("/")) + "/"
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .json(path)
        .withColumn("chunk_key", F.substring_index("_metadata.file_path", below, -1))
    )
    return normalize(raw, "chunk_key")


def merge_pages(
    spark: SparkSession,
    store: TicketStore,
    pages: str,
    checkpoint: str,
    run_id: int,
    files_per_batch: int = 1000,
    zone: str = LOCAL_ZONE,
) -> StreamingQuery:
    """Merge all pages that are there and stop.

    The stream's checkpoint skips pages it knows to be done. A batch that is sent again,
    because its acknowledgement was lost, finds its chunks in the ledger and adds nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        valid, _rejected = split_rejects(enrich(batch, zone))
        newest = latest_version(valid, "chunk_key")
        store.load(newest.drop("created_year", "created_month"), run_id)

    return (
        page_stream(spark, pages, files_per_batch)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
