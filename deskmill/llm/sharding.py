"""Two-pass external shuffle into shards.

First pass: a seeded hash of the document id sends a row to a shard and to one of the
shard's buckets, which are sized to fit in a task's memory. Second pass: each bucket is
put into a fixed order, shuffled by Fisher-Yates, and written behind the buckets before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from deskmill.llm.common import table, without

SHARDS, SEED = 8, 23
BUCKET_BYTES = 16 << 20


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose own hash of the key is highest: one more shard only takes rows."""
    bids = [F.struct(F.xxhash64(key, F.lit(seed + 1000 + s)).alias("bid"), F.lit(s).alias("shard")) for s in range(shards)]
    return (F.greatest(*bids) if shards > 1 else bids[0])["shard"]


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A drawn order of ``n`` rows; every order is as likely, and the same for a seed."""
    order = np.arange(n)
    draws = np.random.default_rng([seed, bucket])
    picks = draws.integers(0, np.arange(n, 0, -1)) + np.arange(n) if n else order  # i <= pick < n
    for i, pick in enumerate(picks.tolist()):
        order[i], order[pick] = order[pick], order[i]
    return order


def external_shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` (doc_id, text and more) with ``shard``, ``bucket``, ``slot``, ``grown_shard``.

    The shard follows the document id and the number of shards alone; ``grown_shard`` is
    the shard with one more of them, equal to ``shard`` or the new one. Slots run from 0
    in every shard. New columns replace columns of their names.

    Defined cases: a null doc_id has its shard like any id, and its rows are spread over
    the buckets by their text; equal rows are interchangeable; a null text counts nothing;
    no rows give no rows. A bucket holds the rows of some ids: its expected size is
    ``bucket_bytes``, and more rows of one doc_id than that are spread by text.
    """
    docs = without(docs, "shard", "bucket", "slot", "grown_shard", "_text_hash")
    key = F.col("doc_id")
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    inside = F.pmod(F.xxhash64(key, F.xxhash64("text"), F.lit(seed)), F.lit(per_shard))
    marked = docs.withColumns(
        {
            "shard": shard_of(key, shards, seed),
            "grown_shard": shard_of(key, shards + 1, seed),
            "_text_hash": F.xxhash64("text"),
        }
    ).withColumn("bucket", (F.col("shard") * per_shard + inside).cast("bigint"))
    names = [*docs.columns, "shard", "bucket", "grown_shard"]

    counts = marked.groupBy("shard", "bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))

    def shuffle(rows: pa.Table, start: pa.Table) -> pa.Table:
        fixed = rows.sort_by([("doc_id", "ascending"), ("_text_hash", "ascending")])
        drawn = fixed.take(pa.array(fisher_yates(len(fixed), seed, start["bucket"][0].as_py()))).select(names)
        return drawn.append_column("slot", pa.array(start["_start"][0].as_py() + np.arange(len(fixed))))

    schema = marked.select(*[F.col(f"`{n}`") for n in names]).withColumn("slot", F.lit(0).cast("bigint")).schema
    # The start of a bucket meets its rows in the same shuffle, so that texts move once.
    return marked.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInArrow(shuffle, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """A folder per shard with a file per bucket; files in name order give the slots.

    Tasks write buckets whole, so the work is spread over buckets, not over shards.
    """
    shuffled.repartition("shard", "bucket").sortWithinPartitions("shard", "bucket", "slot").write.mode(
        "overwrite"
    ).partitionBy("shard", "bucket").parquet(path)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return external_shuffle(table(spark, folder, "documents", "doc_id", "text")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )


QUERIES = {"op3_sharding": op3_sharding}
