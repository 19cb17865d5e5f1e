"""Lineage as an edge list (upstream, downstream, transform)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deskmill.session import written


def neighbours(edges: DataFrame, assets: DataFrame, asset_key: str) -> DataFrame:
    """Direct upstream and downstream assets of one asset, tagged with the direction."""

    def side(direction: str, far: str, near: str) -> DataFrame:
        return (
            edges.filter(F.col(near) == asset_key)
            .join(assets, F.col(far) == F.col("asset_key"))
            .select(F.lit(direction).alias("direction"), "asset_key", "layer", "transform")
        )

    up = side("UPSTREAM", "upstream", "downstream")
    down = side("DOWNSTREAM", "downstream", "upstream")
    return up.unionByName(down).orderBy("direction", "asset_key")


def edge_violations(edges: DataFrame, assets: DataFrame) -> DataFrame:
    """Edges that point to unknown assets or to themselves."""
    known = assets.select(F.col("asset_key").alias("_known"))

    def unknown(end: str, name: str) -> DataFrame:
        return edges.join(known, F.col(end) == F.col("_known"), "left_anti").select(
            "upstream", "downstream", F.lit(name).alias("violation")
        )

    loops = edges.filter("upstream = downstream").select(
        "upstream", "downstream", F.lit("SELF_EDGE").alias("violation")
    )
    return (
        unknown("upstream", "UNKNOWN_UPSTREAM")
        .unionByName(unknown("downstream", "UNKNOWN_DOWNSTREAM"))
        .unionByName(loops)
    )


def closure(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(ancestor, descendant) pairs below the given ``starts`` (asset_key), with the length
    of the shortest path.

    Breadth first: each round extends only the pairs found in the round before and drops
    the known ones, so it also ends on cyclic graphs. Every round is written to the
    checkpoint folder, which keeps the plan short and the work safe.
    """
    step = edges.select(F.col("upstream").alias("_from"), F.col("downstream").alias("_to")).distinct()
    step = written(step)
    from_start = step.join(starts.select(F.col("asset_key").alias("_from")).distinct(), "_from", "left_semi")
    newest = from_start.select(
        F.col("_from").alias("ancestor"), F.col("_to").alias("descendant"), F.lit(1).alias("depth")
    )
    found = newest
    while True:
        grown = (
            newest.join(step, F.col("descendant") == F.col("_from"))
            .select("ancestor", F.col("_to").alias("descendant"), (F.col("depth") + 1).alias("depth"))
            .distinct()
            .join(found, ["ancestor", "descendant"], "left_anti")
        )
        newest = written(grown)
        if newest.isEmpty():
            return found
        found = found.unionByName(newest)


def cyclic_core(edges: DataFrame) -> DataFrame:
    """Edges left after ends of the graph are cut off again and again.

    An edge stays only if its start has an incoming and its end an outgoing edge. The
    graph is free of cycles exactly if nothing is left; otherwise the rest holds every
    cycle and the ways between them. Rounds grow with the depth of the graph, not with
    its size, and each works only on what is left.
    """
    left = written(edges.select("upstream", "downstream").distinct())
    size = left.count()
    while size:
        heads = left.select(F.col("downstream").alias("upstream")).distinct()
        tails = left.select(F.col("upstream").alias("downstream")).distinct()
        left = written(left.join(heads, "upstream", "left_semi").join(tails, "downstream", "left_semi"))
        smaller = left.count()
        if smaller == size:
            break
        size = smaller
    return left.select("upstream", "downstream")


def _spread(values: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``values`` (node, ``name``) after each node took the largest one that reaches it."""
    while True:
        sent = edges.join(values, F.col("upstream") == F.col("node")).select(F.col("downstream").alias("node"), name)
        after = written(values.unionByName(sent).groupBy("node").agg(F.max(name).alias(name)))
        if after.exceptAll(values).isEmpty():
            return after
        values = after


def _passed(graph: DataFrame, turn: int) -> DataFrame:
    """Nodes with one way in and one way out, no two of them neighbours: ``node``, ``before``,
    ``after``. In a row of such nodes those go whose hash is smaller than both neighbours',
    about a third of them."""
    into = graph.groupBy(F.col("downstream").alias("node")).agg(F.count("*").alias("n"), F.min("upstream").alias("before"))
    out = graph.groupBy(F.col("upstream").alias("node")).agg(F.count("*").alias("m"), F.min("downstream").alias("after"))
    place = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("k")).alias("place")
    rows = written(into.join(out, "node").filter("n = 1 AND m = 1").select("node", "before", "after", place))
    near = rows.select("node", "place")
    beside = rows.alias("r")
    for side in ("before", "after"):
        other = near.select(F.col("node").alias(side), F.col("place").alias(f"_{side}"))
        beside = beside.join(other, side, "left")
    first = [F.col(f"_{side}").isNull() | (F.col("place") < F.col(f"_{side}")) for side in ("before", "after")]
    return beside.filter(first[0] & first[1]).select("node", "before", "after")


def contracted(edges: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame | None]:
    """The graph without rows of single ways, however long, in a number of rounds that grows
    with the logarithm of their length.

    A node with one way in and one way out is taken out and its two edges become one, which
    is on a cycle exactly if they are; edges that lead nowhere or come from nowhere go. Returns
    the graph that is left, per round the edges that became another one, and the loops that
    closed (edges from a node to itself), which are cycles.
    """
    loop = F.col("upstream") == F.col("downstream")
    left = written(edges.select("upstream", "downstream").distinct())
    loops, moves = left.filter(loop), []
    graph = written(left.filter(~loop))
    while not graph.isEmpty():
        passed = written(_passed(graph, len(moves)))
        if passed.isEmpty():
            break
        starts = passed.select(F.col("node").alias("upstream"), F.col("before").alias("_up"))
        ends = passed.select(F.col("node").alias("downstream"), F.col("after").alias("_down"))
        moved = graph.join(starts, "upstream", "left").join(ends, "downstream", "left").select(
            "upstream", "downstream",
            F.coalesce("_up", "upstream").alias("new_up"), F.coalesce("_down", "downstream").alias("new_down"),
        )
        moved = written(moved)
        moves.append(moved.filter("upstream <> new_up OR downstream <> new_down"))
        after = moved.select(F.col("new_up").alias("upstream"), F.col("new_down").alias("downstream")).distinct()
        loops = loops.unionByName(after.filter(loop))
        heads = after.select(F.col("downstream").alias("upstream")).distinct()
        tails = after.select(F.col("upstream").alias("downstream")).distinct()
        graph = written(after.filter(~loop).join(heads, "upstream", "left_semi").join(tails, "downstream", "left_semi"))
    return graph, moves, loops


def cycle_edges(edges: DataFrame) -> DataFrame:
    """The edges that lie on a cycle; none exactly if the graph is free of cycles.

    Long rows of single ways are drawn together first; what is found on the rest is then
    carried back, round by round, to the edges it stands for.
    """
    graph, moves, loops = contracted(edges)
    found = written(loops.unionByName(_knot_edges(graph)).distinct())
    for moved in reversed(moves):
        became = found.select(F.col("upstream").alias("new_up"), F.col("downstream").alias("new_down"))
        back = moved.join(became, ["new_up", "new_down"], "left_semi").select("upstream", "downstream")
        found = written(found.unionByName(back).distinct())
    return found.join(edges.select("upstream", "downstream").distinct(), ["upstream", "downstream"], "left_semi")


def _knot_edges(edges: DataFrame) -> DataFrame:
    """The edges on cycles of a graph without rows of single ways.

    What trimming leaves also holds the ways between cycles. There, every node takes the
    largest name that reaches it; the nodes that reach the bearer of their name, by nodes
    of the same name, are on cycles with it. Their edges are kept, they are taken out, and
    the rest is trimmed and named again.
    """
    left, found = cyclic_core(edges), None
    while not left.isEmpty():
        nodes = left.select(F.col("upstream").alias("node")).unionByName(left.select(F.col("downstream").alias("node")))
        colour = _spread(nodes.distinct().withColumn("colour", F.col("node")), left, "colour")
        up, down = colour.alias("u"), colour.alias("d")
        inner = written(
            left.join(up, F.col("upstream") == F.col("u.node"))
            .join(down, F.col("downstream") == F.col("d.node"))
            .filter("u.colour = d.colour")
            .select(F.col("downstream").alias("upstream"), F.col("upstream").alias("downstream"))
        )
        roots = colour.filter("node = colour").select("node", F.lit(1).alias("back"))
        member = _spread(roots, inner, "back").select("node")
        starts, ends = member.withColumnRenamed("node", "upstream"), member.withColumnRenamed("node", "downstream")
        cycle = (
            inner.select(F.col("downstream").alias("upstream"), F.col("upstream").alias("downstream"))
            .join(starts, "upstream", "left_semi")
            .join(ends, "downstream", "left_semi")
            .select("upstream", "downstream")
        )
        found = cycle if found is None else found.unionByName(cycle)
        left = cyclic_core(left.join(starts, "upstream", "left_anti").join(ends, "downstream", "left_anti"))
    return left if found is None else found
