"""Parquet, delimited and report sinks of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from deskmill.functions.times import EXPORT_PATTERN, local_clock
from deskmill.schema import (
    COORDINATE,
    EXPORT_FIELDS,
    EXPORT_SCHEMA,
    EXPORT_TIME_FIELDS,
    LOCAL_ZONE,
)

# The dialect of the delimited export, the same for writing and reading.
DELIMITED = {
    "sep": "\t", "quote": '"', "escape": "\\", "nullValue": "\\N", "header": "false",
    "lineSep": "\n",
}


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Shuffle so that each partition value ends in few files of even size.

    The runtime splits a value that holds much of the data and joins small ones, so
    neither a hot month nor thousands of tiny files come out.
    """
    return df.hint("rebalance", *columns)


def replaced(df: DataFrame) -> DataFrameWriter:
    """A writer that also takes away partitions which the new rows lack."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def write_detail(current: DataFrame, path: str) -> None:
    """Tickets by created year and month, in time order within each file."""
    laid = balanced(current, "created_year", "created_month")
    ordered = laid.sortWithinPartitions("created_year", "created_month", "created_date", "unique_key")
    replaced(ordered).partitionBy("created_year", "created_month").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    replaced(balanced(summary, "agency")).partitionBy("agency").parquet(path)


def write_serving(rows: DataFrame, path: str) -> None:
    """Replace the serving rows of the releases in ``rows``; other releases stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "release_id"
    ).parquet(path)


def export_columns(current: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """All export fields as text; times as wall clocks with milliseconds."""

    def text(name: str):
        value = F.col(name)
        if name == "source_updated_at":
            value = local_clock(value, zone)
        if name in EXPORT_TIME_FIELDS:
            return F.date_format(value, EXPORT_PATTERN).alias(name)
        if name == "quality_flags":
            return F.to_json(value).alias(name)
        return value.cast("string").alias(name)

    return current.select(*[text(name) for name in EXPORT_FIELDS])


def export_delimited(
    current: DataFrame, path: str, chunks: int | None = None, zone: str = LOCAL_ZONE
) -> None:
    """Write the export; ``chunks`` asks for a number of files, at the price of a shuffle."""
    rows = export_columns(current, zone)
    if chunks:
        rows = rows.repartition(chunks)
    rows.write.mode("overwrite").options(**DELIMITED).csv(path)


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """The raw text rows of an export."""
    return spark.read.schema(EXPORT_SCHEMA).options(**DELIMITED).csv(path)


def import_delimited(spark: SparkSession, path: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Typed tickets from an export, with the file as ``chunk_key`` and a binary hash.

    Only the first 23 characters of a time count, and ``T`` may stand for the blank. The
    update time goes back from the wall clock to UTC; in the hour that the clock shows
    twice, the earlier instant is taken.
    """
    rows = read_delimited(spark, path)

    def typed(name: str):
        value = F.col(name)
        if name in EXPORT_TIME_FIELDS:
            clock = F.replace(F.left(value, F.lit(23)), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
            if name == "source_updated_at":
                clock = F.convert_timezone(F.lit(zone), F.lit("UTC"), clock)
            return clock.alias(name)
        if name in ("latitude", "longitude"):
            return value.try_cast(COORDINATE).alias(name)
        if name == "quality_flags":
            return F.from_json(value, "array<string>").alias(name)
        return value

    chunk = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("chunk_key")
    return rows.select(
        *[typed(name) for name in EXPORT_FIELDS],
        F.unhex("content_hash_hex").alias("content_hash"),
        chunk,
    )


def sink_counts(spark: SparkSession, detail: str, export: str) -> DataFrame:
    """Rows read back from the detail files and from the export, as one row."""
    from deskmill.operators.profile import one_row

    return one_row(
        [
            spark.read.parquet(detail).agg(F.count("*").alias("parquet_rows")),
            read_delimited(spark, export).agg(F.count("*").alias("export_rows")),
        ]
    )


def write_report(report: DataFrame, path: str) -> None:
    """A report of one or few rows as a JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
