"""Keyset pages of an ordered extract, their manifest and its checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from deskmill.operators.ordered import previous_row, row_number


def paged(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], size: int, start: int = 0
) -> DataFrame:
    """Rows with ``page``, the number of their page of ``size`` rows inside the group."""
    numbered = row_number(df, groups, order, "_rn")
    page = F.floor((F.col("_rn") - 1) / size) + start
    return numbered.withColumn("page", page.cast("bigint")).drop("_rn")


def manifest(pages: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows, first key and last key of every page."""
    key = F.struct(*order)
    return pages.groupBy(*groups, "page").agg(
        F.count("*").alias("row_count"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )


def boundary_check(pages: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Every page with the last key of the page before; ``increasing`` must hold.

    The page before is found by its number, an equality join, not by a window over all
    pages of a group.
    """
    before = pages.select(
        *groups, (F.col("page") + 1).alias("page"), F.col("last_key").alias("previous_last")
    )
    joined = pages.join(before, [*groups, "page"], "left")
    return joined.withColumn(
        "increasing",
        F.col("previous_last").isNull() | (F.col("first_key") > F.col("previous_last")),
    )


def digest_pages(pages: DataFrame, groups: Sequence[str], row_hash: str) -> DataFrame:
    """One SHA-256 per page over its sorted row hashes; a page has a fixed top size."""
    hashes = F.array_join(F.array_sort(F.collect_list(row_hash)), "")
    return pages.groupBy(*groups, "page").agg(
        F.count("*").alias("row_count"), F.sha2(hashes, 256).alias("chunk_sha256")
    )


def order_violations(
    df: DataFrame, groups: Sequence[str], position: Sequence[str], key: Sequence[str]
) -> DataFrame:
    """Rows whose key is not above the key of the row before them in file order.

    Rows without any key, as broken lines are, have no place in the order: the rows around
    them are compared with each other.
    """
    carry = {f"previous_{k}": k for k in key}
    keyed = df.dropna("all", subset=list(key))
    rows = previous_row(keyed.withColumn("_here", F.lit(True)), groups, position, {**carry, "_after": "_here"})
    now = F.struct(*[F.col(k) for k in key])
    before = F.struct(*[F.col(f"previous_{k}").alias(k) for k in key])
    return rows.filter(F.col("_after") & (now <= before)).drop("_here", "_after")


def reconcile(actual: DataFrame, declared: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Counted rows against the manifest's three counts; a gap on any side is a mismatch."""
    counts = ("manifest_rows", "source_start", "source_final")
    joined = actual.join(declared, list(groups), "full_outer")
    rows = joined.select(
        *groups,
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )
    agree = F.lit(True)
    for c in counts:
        agree = agree & (F.col("actual_rows") == F.col(c))
    return rows.withColumn("matches", agree)


def latest_batch(df: DataFrame, name: str, batch: str) -> DataFrame:
    """All rows of the newest batch of each name."""
    newest = df.groupBy(name).agg(F.max(batch).alias(batch))
    return df.join(newest, [name, batch])
