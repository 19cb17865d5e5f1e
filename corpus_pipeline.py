"""A corpus from raw documents to packed sequences, one operator per stage.

Every stage takes the documents that the stage before left, as written to the shared folder
and read again, and returns the columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.llm.common import stored, table
from deskmill.llm.line_dedup import line_dedup
from deskmill.llm.mixing import mix
from deskmill.llm.near_dedup import near_dedup
from deskmill.llm.packing import digest, pack
from deskmill.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity(docs.select(COLUMNS), labels).filter("predicted = 0").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a smaller doc_id has; n_chars follows."""
    done = line_dedup(docs.select(COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id (null last).

    Every row is a document by its own text, whether its doc_id is repeated or missing.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "zstd")  # lies there to the end
    groups = near_dedup(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    kept = rows.select("row", "doc_id").join(groups, "row").groupBy("component_id").agg(first.alias("row"))
    return rows.join(kept, "row", "left_semi").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and the words of them, as the target weights take them."""
    return mix(docs.select(COLUMNS)).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a sequence; a document that was taken twice is packed twice."""
    return digest(pack(docs.select(COLUMNS)))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The trained network and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
