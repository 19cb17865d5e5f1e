"""Raw page files: typed scan, digests, file statistics and size projection."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from deskmill.schema import RAW_FIELDS, RAW_SCHEMA

CORRUPT = "_corrupt_record"


def scan_pages(
    spark: SparkSession, paths: Sequence[str] | str, keep_corrupt: bool = False
) -> DataFrame:
    """JSON Lines pages with the declared all-text schema; no inference pass.

    A broken line becomes a row of nulls, which the reject rule drops and counts.
    Gzip files are not splittable, so the number of files is the parallelism of this scan.
    """
    extra = [T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []
    schema = T.StructType([*RAW_SCHEMA.fields, *extra])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(paths)


@F.pandas_udf(T.StringType())
def unzipped_sha256(content: pd.Series) -> pd.Series:
    """SHA-256 of the text inside gzip files, one page per value."""
    return content.map(lambda page: hashlib.sha256(gzip.decompress(page)).hexdigest())


def file_digests(spark: SparkSession, path: str, pattern: str = "*.gz") -> DataFrame:
    """Size and both SHA-256 digests of each stored page file, read in the tasks.

    A file is one value here, which is fine for pages: the page size bounds them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.element_at(F.split("path", "/"), -2).alias("folder"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("compressed_bytes"),
        F.sha2("content", 256).alias("compressed_sha256"),
        unzipped_sha256("content").alias("uncompressed_sha256"),
    )


def lines_in_order(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Raw rows with ``folder``, ``file`` and a ``line`` number that grows along each file.

    Gzip files are read from start to end by one task, so the row id keeps their order.
    """
    parts = F.split("_metadata.file_path", "/")
    return spark.read.schema(RAW_SCHEMA).json(paths).select(
        F.element_at(parts, -2).alias("folder"),
        F.element_at(parts, -1).alias("file"),
        F.monotonically_increasing_id().alias("line"),
        "created_date",
        "unique_key",
    )


MANIFEST = """
  month int, rows bigint, source_count_start bigint, source_count_final bigint, complete boolean,
  parts array<struct<file string, rows bigint, first_key array<string>, last_key array<string>,
    compressed_bytes bigint, compressed_sha256 string, uncompressed_sha256 string>>
"""


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Month manifests (one JSON file per month folder) with the name of their folder."""
    rows = spark.read.schema(MANIFEST).option("multiLine", "true").json(f"{path}/*/manifest.json")
    return rows.withColumn("folder", F.element_at(F.split("_metadata.file_path", "/"), -2))


def file_statistics(df: DataFrame, *by: Column | str) -> DataFrame:
    """Files and bytes behind a file scan; partition filters of ``df`` apply."""
    files = df.select(
        *by, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
    ).distinct()
    return files.groupBy(*by).agg(F.count("*").alias("files"), F.sum("_size").alias("file_bytes"))


def json_line_bytes() -> Column:
    """Bytes of a raw row as one JSON line; absent fields take no space."""
    line = F.to_json(F.struct(*[F.col(f"`{name}`") for name in RAW_FIELDS]))
    return F.octet_length(line) + 1


def storage_projection(raw: DataFrame) -> DataFrame:
    """Mean bytes per row and bytes of all rows as JSON Lines."""
    return raw.select(json_line_bytes().alias("b")).agg(
        F.count("*").alias("row_count"),
        F.round(F.avg("b"), 2).alias("bytes_per_row"),
        F.sum("b").alias("projected_bytes"),
    )


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """JSON array snapshots under ``<path>/<time>/<name>.json`` with name and time."""
    rows = spark.read.option("multiLine", "true").json(f"{path}/*/*.json")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return rows.withColumns(
        {
            "snapshot_time": F.element_at(parts, -2),
            "snapshot_name": F.regexp_replace(F.element_at(parts, -1), r"\.json$", ""),
        }
    )
