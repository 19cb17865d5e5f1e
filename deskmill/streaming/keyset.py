"""Streaming source over keyset pages, resumable at a (created_date, unique_key) cursor.

The pages are Parquet files in a shared folder (any file system Arrow can open) next to a
manifest, itself Parquet in key order: file, rows, first and last key of every page, in row
groups of ``GROUP`` pages. The driver reads footers only: the highest key of all row groups
is the newest offset, and a row group whose keys meet a batch is a partition of it. The task
reads its row group, then the pages in the batch, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from deskmill.operators.pages import manifest, paged

ORDER = ["created_date", "unique_key"]
START = ["", ""]
GROUP = 64  # pages of a partition
BREAK = "\0"  # below every character, so joined keys are ordered as pairs are


def write_pages(rows: DataFrame, folder: str, page_rows: int) -> None:
    """Cut text rows into ordered pages of ``page_rows`` and write pages and manifest."""
    pages = paged(rows, [], ORDER, page_rows)
    pages.repartition("page").sortWithinPartitions("page", *ORDER).write.mode("overwrite").partitionBy(
        "page"
    ).parquet(f"{folder}/pages")
    stored = rows.sparkSession.read.parquet(f"{folder}/pages")
    listing = manifest(stored.withColumn("file", F.col("_metadata.file_path")), ["file"], ORDER)
    write_manifest(
        listing.select(
            F.regexp_replace("file", "^file:/+", "file:///").alias("file"),
            F.col("page").cast("bigint").alias("page"),
            "row_count",
            _joined("first_key").alias("first"),
            _joined("last_key").alias("last"),
        ),
        folder,
    )


def _joined(key: str) -> Column:
    return F.concat_ws(BREAK, *[F.coalesce(f"{key}.{c}", F.lit("")) for c in ORDER])


def write_manifest(listing: DataFrame, folder: str) -> None:
    """Write (file, page, row_count, first, last) in the order of the keys."""
    few = {"parquet.block.row.count.limit": GROUP, "parquet.page.row.count.limit": GROUP}
    listing.orderBy("last").write.mode("overwrite").options(**few).parquet(f"{folder}/manifest")


class GroupPartition(InputPartition):
    """The pages of one row group of the manifest with a last key in (begin, end]."""

    def __init__(self, path: str, group: int, begin: str, end: str) -> None:
        super().__init__((path, group))
        self.path, self.group, self.begin, self.end = path, group, begin, end


class KeysetReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.names = schema.fieldNames()
        self.folder = options["path"]

    def _groups(self) -> Iterator[tuple[str, int, str, str]]:
        """File, number, lowest and highest last key of every row group, from the footers."""
        files, folder = fs.FileSystem.from_uri(f"{self.folder}/manifest")
        for part in files.get_file_info(fs.FileSelector(folder)):
            if part.extension == "parquet" and not part.base_name.startswith((".", "_")):
                with files.open_input_file(part.path) as file:
                    footer = pq.ParquetFile(file).metadata
                column = footer.schema.names.index("last")
                for group in range(footer.num_row_groups):
                    found = footer.row_group(group).column(column).statistics
                    yield part.path, group, found.min, found.max

    def initialOffset(self) -> dict:
        return {"cursor": START}

    def latestOffset(self) -> dict:
        # All pages there are: an available-now run asks once and must reach the last one.
        newest = max((high for *_, high in self._groups()), default="")
        return {"cursor": newest.split(BREAK) if newest else START}

    def partitions(self, start: dict, end: dict) -> list[GroupPartition]:
        begin, to = (BREAK.join(x["cursor"]) if x["cursor"] != START else "" for x in (start, end))
        return [GroupPartition(path, n, begin, to) for path, n, low, high in self._groups() if high > begin and low <= to]

    def pages(self, partition: GroupPartition) -> list[str]:
        """Files of the partition's pages in the order of their keys."""
        files, _ = fs.FileSystem.from_uri(self.folder)
        with files.open_input_file(partition.path) as file:
            rows = pq.ParquetFile(file).read_row_group(partition.group, columns=["file", "last"])
        wanted = pc.and_(pc.greater(rows["last"], partition.begin), pc.less_equal(rows["last"], partition.end))
        return rows.filter(wanted).sort_by("last")["file"].to_pylist()

    def read(self, partition: GroupPartition) -> Iterator:
        for name in self.pages(partition):
            files, path = fs.FileSystem.from_uri(name)
            with files.open_input_file(path) as page:
                yield from pq.ParquetFile(page).iter_batches(columns=self.names)

    def commit(self, end: dict) -> None:
        pass


class KeysetPages(DataSource):
    """``spark.readStream.format("keyset_pages").schema(...).load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "keyset_pages"

    def streamReader(self, schema: StructType) -> KeysetReader:
        return KeysetReader(schema, dict(self.options))


def page_source(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    spark.dataSource.register(KeysetPages)
    return (
        spark.readStream.format("keyset_pages")
        .schema(schema)
        .load(folder)
    )
