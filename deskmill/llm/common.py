"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from deskmill.session import checkpoint_dir

# --- fixed values: the contract's white space and word pattern ---------------
WHITE_SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table of the data folder; ``columns`` first, so that clashing extras are gone."""
    rows = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def texts_to_python(docs: DataFrame, rows: int = 1_000) -> DataFrame:
    """``docs`` for a Python step over whole texts; Arrow batches hold ``rows`` rows at most.

    A batch lies in memory outside the heap several times while it is built and sent; with
    Spark's 10,000 rows, texts make that some tens of megabytes a task each time. The setting
    is the session's and changes no result.
    """
    spark, name = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)
    return docs


def process_memory(owner: str) -> SimpleNamespace:
    """What the tasks of ``owner`` keep in this Python process.

    Spark hands a process on to the tasks of later operators. What another owner left goes, so
    that a process holds the memory of one operator at a time.
    """
    held = sys.modules.setdefault("_deskmill_memory", SimpleNamespace(owner=None, memory=None))
    if held.owner != owner:
        held.owner, held.memory = owner, SimpleNamespace()
        pa.default_memory_pool().release_unused()
    return held.memory


def stored(rows: DataFrame, compression: str = "snappy") -> DataFrame:
    """``rows`` written once to the shared folder and read back, which cuts the lineage.

    The folder goes when the session ends; a lost executor only costs a repeated read.
    """
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    rows.write.option("compression", compression).parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(rows.schema).parquet(folder)


def without(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` without columns of these names, in any case."""
    taken = {n.lower() for n in names}
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def n_words(text: Column) -> Column:
    """Words in ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut only before a space or line end.

    A stretch without either stays whole.
    """
    start = 0
    while len(text) - start > size:
        cuts = [x for x in (text.find(" ", start + size), text.find("\n", start + size)) if x >= 0]
        if not cuts:
            break
        yield text[start : min(cuts)]
        start = min(cuts)
    yield text[start:] if start else text


def running_start(
    rows: DataFrame, groups: Sequence[str], weight: str, place: Column, name: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the group that come before.

    Rows are ordered by the 64-bit number ``place`` (a hash, so evenly spread) and then by
    ``ties``. A slice is a prefix of the number; there are about 256 rows in one. Sums
    inside slices, over the slices of a wider prefix, and over the wider prefixes are three
    bounded windows, whatever the size of a group.
    """
    fine = max(0, (max(1, rows.count()) - 1).bit_length() - 8)
    coarse = fine // 2

    def prefix(bits: int) -> Column:
        return F.shiftrightunsigned("_place", 64 - bits) if bits else F.lit(0).cast("bigint")

    def before(window, value: str) -> Column:
        return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = list(groups)
    marked = rows.withColumn("_place", place).withColumns({"_fine": prefix(fine), "_coarse": prefix(coarse)})
    # Signed order inside a slice is a valid order too: the slice fixes the sign bit.
    inside = before(Window.partitionBy("_fine", *groups).orderBy("_place", *ties), weight)
    slices = marked.groupBy("_coarse", "_fine", *groups).agg(F.sum(weight).alias("_sum"))
    slices = slices.withColumn("_in", before(Window.partitionBy("_coarse", *groups).orderBy("_fine"), "_sum"))
    blocks = slices.groupBy("_coarse", *groups).agg(F.sum("_sum").alias("_all"))
    top = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    blocks = blocks.withColumn("_over", before(top.orderBy("_coarse"), "_all")).drop("_all")

    def same(left: str, right: str, keys: Sequence[str]) -> Column:
        test = F.lit(True)
        for k in keys:
            test = test & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        return test

    offsets = (
        slices.alias("s")
        .join(blocks.alias("b"), same("s", "b", ["_coarse", *groups]))
        .select(*[F.col(f"s.{k}") for k in ["_fine", *groups]], (F.col("_in") + F.col("_over")).alias("_off"))
    )
    local = marked.withColumn("_inside", inside)
    return (
        local.alias("r")
        .join(offsets.alias("o"), same("r", "o", ["_fine", *groups]))
        .select(
            *[F.col(f"r.`{c}`") for c in rows.columns],
            (F.col("_inside") + F.col("_off")).cast("bigint").alias(name),
        )
    )
