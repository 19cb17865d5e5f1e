"""Centroid clustering in whole numbers, with Orchard's search for the nearest centroid.

Every centroid has the list of the others, nearest first. A vector goes down the list of the
best centroid so far, jumps to the list of a closer one as soon as it finds it, never
measures a centroid twice, and stops where the list is strictly further than twice its own
distance: by the triangle inequality nothing beyond can be as near. Components are scaled
and rounded down to integers, so sums and distances are exact and do not depend on order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.llm.common import stored, table

CLUSTERS, ROUNDS, PARTS, SCALE, SEED = 8, 10, 64, 1024, "3"
LIMB = 10**30  # sums travel in limbs of thirty digits, so that no sum is too large


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of all components: 64-bit integers if squared distances between
    such vectors fit, otherwise Python's unbounded ones."""
    with np.errstate(over="ignore"):
        turned = np.floor(vectors * scale)
    if not turned.size or np.abs(turned).max() <= math.isqrt((2**63 - 1) // (16 * turned.shape[1])):
        return turned.astype(np.int64)
    exact = [int(t) if math.isfinite(t) else int(x) * scale for t, x in zip(turned.ravel().tolist(), vectors.ravel().tolist())]
    return np.array(exact, object).reshape(turned.shape)


def neighbour_lists(centroids: list[list[int]]) -> tuple[np.ndarray, list[list[int]]]:
    """Per centroid the others, nearest first (ties: smaller number), and their squared distances."""
    near, gaps = [], []
    for i, c in enumerate(centroids):
        others = sorted((sum((a - b) ** 2 for a, b in zip(c, o)), j) for j, o in enumerate(centroids) if j != i)
        near.append([j for _, j in others])
        gaps.append([d for d, _ in others])
    return np.array(near, np.int64).reshape(len(centroids), max(0, len(centroids) - 1)), gaps


class Search:
    """Nearest centroids of many vectors at once; ``measured`` counts distances."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.centroids, self.measured = centroids, 0
        self.near, self.gaps = neighbour_lists(centroids)
        self.widest = max((abs(x) for c in centroids for x in c), default=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: the smaller) and squared distance."""
        n, k = len(vectors), len(self.centroids)
        if vectors.dtype != object and self.widest > math.isqrt((2**63 - 1) // (16 * vectors.shape[1])):
            vectors = vectors.astype(object)
        centres, gaps = np.array(self.centroids, vectors.dtype), np.array(self.gaps, vectors.dtype).reshape(self.near.shape)
        at, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        seen = np.zeros((n, k), np.bool_)
        seen[:, 0] = True
        best = ((vectors - centres[0]) ** 2).sum(axis=1)
        self.measured += n
        live = np.arange(n)
        while True:
            live = live[place[live] < k - 1]
            live = live[~(gaps[at[live], place[live]] > 4 * best[live]).astype(np.bool_)]
            if not len(live):
                return at, best
            other = self.near[at[live], place[live]]
            place[live] += 1
            new = ~seen[live, other]
            rows, other = live[new], other[new]
            seen[rows, other] = True
            far = ((vectors[rows] - centres[other]) ** 2).sum(axis=1)
            self.measured += len(rows)
            closer = ((far < best[rows]) | ((far == best[rows]) & (other < at[rows]))).astype(np.bool_)
            rows = rows[closer]
            at[rows], best[rows], place[rows] = other[closer], far[closer], 0


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, parts)


def _limbs(cluster: int, part: int, value: int) -> Iterator[tuple[int, int, int, Decimal]]:
    sign, rest, limb = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        rest, low = divmod(rest, LIMB)
        yield cluster, part, limb, Decimal(sign * low)
        limb += 1


def _moved(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after one round. A task sends one sum per cluster and component."""
    parts = len(centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        total, count = np.zeros((len(centroids), parts), object), [0] * len(centroids)
        for batch in batches:
            v = whole(_matrix(batch.column("_v"), parts), scale)
            at, _ = search.nearest(v)
            for c in np.unique(at).tolist():
                own = v[at == c]
                total[c] += own.sum(axis=0).astype(object)
                count[c] += len(own)
        rows = [x for c, n in enumerate(count) for x in _limbs(c, -1, n)]
        rows += [x for c, n in enumerate(count) if n for d in range(parts) for x in _limbs(c, d, int(total[c][d]))]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds)], names=["cluster", "part", "limb", "value"]
        )

    found = (
        vectors.select("_v")
        .mapInArrow(sums, "cluster int, part int, limb int, value decimal(38,0)")
        .groupBy("cluster", "part", "limb")
        .agg(F.sum("value").alias("value"))
        .collect()  # at most a few limbs per cluster and component
    )
    total: dict[tuple[int, int], int] = {}
    for r in found:
        total[r.cluster, r.part] = total.get((r.cluster, r.part), 0) + int(r.value) * LIMB**r.limb
    return [
        [total.get((c, d), 0) // total[c, -1] for d in range(parts)] if (c, -1) in total else old
        for c, old in enumerate(centroids)
    ]


def centroid_clusters(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, parts: int = PARTS, scale: int = SCALE, seed: str = SEED
) -> DataFrame:
    """Per kept row of ``vectors`` (vec_id, embedding): vec_id, cluster, distance (squared),
    cluster_inertia, inertia, centroid_sha256.

    The first centroids are the rows with the smallest sha256 of ``<seed>:<vec_id>``; a
    round assigns all rows and moves each centroid to the floor of its mean. Centroids and
    their lists (``clusters`` squared numbers) live on the driver, vectors never do.

    Defined cases: vectors that are null, of another length, or hold a null or non-finite
    component are left out; a null vec_id takes part but starts a centroid last; equal ids
    start in the order of their vectors; rows that are alike count each; with fewer rows
    than clusters every row starts one, equal ones leaving all but the smallest number empty;
    no rows give no rows. A distance or inertia that a long cannot hold is null.
    """
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = stored(
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("_v"))
        .filter(F.size("_v") == parts)
        .filter(~bad)
    )
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.orderBy(first.asc_nulls_last(), "_v").limit(clusters).collect()
    centroids = [whole(np.array([r._v]), scale)[0].tolist() for r in chosen]
    if centroids:
        for _ in range(rounds):
            centroids = _moved(kept, centroids, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            if batch.num_rows:
                at, far = search.nearest(whole(_matrix(batch.column("_v"), parts), scale))
                far = [x if x < 2**63 else None for x in far.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(at, pa.int32()), pa.array(far, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    assigned = stored(kept.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"))
    exact = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}

    def held(total) -> int | None:
        return int(total) if total is not None and total < 2**63 else None

    every = held(sum(sums.values())) if None not in sums.values() else None
    ends = [
        (c, held(sums[c]), every, hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest())
        for c, centre in enumerate(centroids)
        if c in sums
    ]
    named = vectors.sparkSession.createDataFrame(
        ends, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # One row per cluster.
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters(table(spark, folder, "embeddings", "vec_id", "embedding"))


def _sql(clusters: int, rounds: int, parts: int, scale: int, seed: str) -> str:
    """The same rounds, one after the other, by measuring every centroid."""
    steps = [
        f"""kept AS (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::varchar) NULLS LAST, embedding::double[]) - 1 AS r,
         vec_id, list_transform(embedding::double[], lambda x: floor({scale} * x)::bigint) AS e
  FROM embeddings
  WHERE len(embedding) = {parts} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT r, unnest(range({parts})) AS d, unnest(e) AS x FROM kept
), c0 AS (
  SELECT r::int AS cluster, d, x FROM v WHERE r < {clusters}
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""f{i} AS (
  SELECT r, cluster, sum((v.x - c.x) * (v.x - c.x))::bigint AS far FROM v JOIN c{i} c ON v.d = c.d GROUP BY r, cluster
), a{i} AS (
  SELECT r, cluster, far FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY far, cluster) AS n FROM f{i}) WHERE n = 1
)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (
  SELECT cluster, d, sum(x)::bigint AS s, count(*) AS n FROM v JOIN a{i} a ON v.r = a.r GROUP BY cluster, d
), c{i + 1} AS (
  SELECT c.cluster, c.d, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{i} c LEFT JOIN m{i} m ON c.cluster = m.cluster AND c.d = m.d
)"""
            )
    return f"""
WITH {", ".join(steps)}, t AS (
  SELECT cluster, sum(far)::bigint AS cluster_inertia FROM a{rounds} GROUP BY cluster
), h AS (
  SELECT cluster, sha256(string_agg(x::varchar, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)
SELECT k.vec_id, a.cluster::int AS cluster, a.far AS distance, t.cluster_inertia,
       (SELECT sum(far)::bigint FROM a{rounds}) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN kept k ON k.r = a.r JOIN t ON t.cluster = a.cluster JOIN h ON h.cluster = a.cluster
"""


QUERIES = {"op13_centroids": op13_centroids}
ORACLE = {"op13_centroids": _sql(CLUSTERS, ROUNDS, PARTS, SCALE, SEED)}
