"""Connected components with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deskmill.llm.common import stored


def _closer(links: DataFrame, all_neighbours: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the smallest among it and them.

    With ``all_neighbours`` the larger neighbours move (and stay linked to each other);
    otherwise the node and its smaller neighbours do. A hub is summed up before the
    shuffle, and its links stay apart in the join, where they can be split.
    """
    down = links.select(F.col("big").alias("u"), F.col("small").alias("v"))
    sides = down.unionByName(links.select(F.col("small").alias("u"), F.col("big").alias("v"))) if all_neighbours else down
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moving = sides.filter("v > u") if all_neighbours else sides.filter("v < u")
    moved = moving.join(least, "u").filter("v <> m").select(F.col("v").alias("big"), F.col("m").alias("small"))
    if not all_neighbours:
        moved = moved.unionByName(least.filter("u <> m").select(F.col("u").alias("big"), F.col("m").alias("small")))
    return moved.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node on an edge to another one.

    ``edges`` has the columns ``a`` and ``b`` of any ordered type; order, repeats, loops and
    nulls do not matter. Large and small stars take turns until no link changes, which
    takes about the logarithm of the longest path. Each turn is written to the shared
    folder, so a lost executor costs one turn at most.
    """
    links = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct()
    )

    def state(rows: DataFrame) -> tuple:
        mark = F.xxhash64("big", "small")
        return tuple(rows.agg(F.count("*"), F.sum(mark.cast("decimal(38,0)"))).first())

    now = state(links)
    while now[0]:
        links = stored(_closer(_closer(links, True), False))
        before, now = now, state(links)
        if now == before:
            break
    centres = links.select(F.col("small").alias("node")).distinct()
    return links.select(F.col("big").alias("node"), F.col("small").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component"))
    )
