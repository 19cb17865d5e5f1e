"""Running totals, row numbers and neighbours in a global order, without one big task.

A window over a whole table, or over one dominant group, would sort all its rows in a
single task. Here the rows are range-partitioned in the wanted order and written once,
so that each partition is a bounded slice and its number is plain data. A window inside
a slice plus one small table with a row per slice and group gives the global answer.
Equal order values can be spread over slices as well: the slices are cut on the order
columns followed by a spread column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from deskmill.session import materialize

SLICE = "_slice"
SPREAD = "_spread"


def slice_in_order(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with ``_slice``, ascending with (groups, order), and ``_spread`` as last key."""
    keys = [*groups, *order]
    # Row ids are stable only over stored rows; storing first also spares the range
    # sampling a second run of everything upstream.
    spread = materialize(df).withColumn(SPREAD, F.monotonically_increasing_id())
    laid = spread.repartitionByRange(*[F.col(f"`{k}`") for k in keys], F.col(SPREAD))
    return materialize(laid.withColumn(SLICE, F.spark_partition_id()))


def _local(groups: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(SLICE, *groups).orderBy(*order, SPREAD)


def _earlier_slices(groups: Sequence[str]):
    return Window.partitionBy(*groups).orderBy(SLICE).rowsBetween(
        Window.unboundedPreceding, -1
    )


def _join_slices(rows: DataFrame, edges: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Attach the per-slice values; ``edges`` has at most slices + groups rows."""
    renamed = edges.select(
        F.col(SLICE).alias("_e_slice"),
        *[F.col(g).alias(f"_e_{g}") for g in groups],
        *[c for c in edges.columns if c != SLICE and c not in groups],
    )
    match = F.col(SLICE) == F.col("_e_slice")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_e_{g}"))
    joined = rows.join(renamed, match, "left")
    return joined.drop("_e_slice", *[f"_e_{g}" for g in groups])


def running_total(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    weight: Column,
    name: str,
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` from the start of the group up to this row."""
    rows = slice_in_order(df.withColumn("_w", weight), groups, order)
    per_slice = rows.groupBy(SLICE, *groups).agg(F.sum("_w").alias("_slice_w"))
    offsets = per_slice.withColumn(
        "_before", F.coalesce(F.sum("_slice_w").over(_earlier_slices(groups)), F.lit(0))
    ).drop("_slice_w")
    so_far = _local(groups, order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_inside", F.sum("_w").over(so_far))
    return (
        _join_slices(local, offsets, groups)
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_w", "_inside", "_before", SLICE, SPREAD)
    )


def row_number(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rn"
) -> DataFrame:
    """Add ``name``: 1-based place of the row in its group. Ties get distinct numbers."""
    return running_total(df, groups, order, F.lit(1), name)


def previous_row(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    carry: dict[str, str],
) -> DataFrame:
    """Add columns of the row just before, as ``carry`` maps new name -> column.

    The first row of a group gets nulls. A slice that starts inside a group takes the
    last row of the nearest earlier slice that holds rows of the group.
    """
    rows = slice_in_order(df, groups, order)
    packed = F.struct(*[F.col(source).alias(new) for new, source in carry.items()])
    last = rows.groupBy(SLICE, *groups).agg(
        F.max_by(packed, F.struct(*[F.col(f"`{o}`") for o in order], F.col(SPREAD))).alias("_last")
    )
    edges = last.withColumn(
        "_edge", F.last("_last").over(_earlier_slices(groups))
    ).drop("_last")
    local = rows.withColumn("_prev", F.lag(packed).over(_local(groups, order)))
    joined = _join_slices(local, edges, groups).withColumn(
        "_prev", F.coalesce("_prev", "_edge")
    )
    return joined.select(
        *df.columns, *[F.col("_prev")[new].alias(new) for new in carry]
    )
