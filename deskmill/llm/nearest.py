"""Nearest neighbours by inner product, tile by tile.

Queries and candidates are dealt into groups, and every pair of groups is one tile of the
product matrix. In a tile the products of 8-bit vectors come first; the parts that rounding
left over bound the error, so only pairs that can be among the nearest are computed again
in double precision. Heaps of the best of each tile are merged at the end.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from deskmill.llm.common import table

NEAREST, QUERY_STEP = 20, 20
QUERY_GROUP, CANDIDATE_GROUP = 4_096, 16_384  # vectors of a tile
BLOCK = 512  # queries that are multiplied at once


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit values, scale, length of the rounded vector and length of what is left over."""
    scale = np.abs(vectors).max(axis=1) / 127
    small = np.rint(vectors / scale[:, None]).astype(np.int8)
    rounded = small * scale[:, None]
    return small, scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(vectors - rounded, axis=1)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of the rows, added up from the first component to the last."""
    total = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        total += queries[:, d] * candidates[:, d]
    return total


def tile(query_ids, queries, candidate_ids, candidates, nearest: int):
    """(query, candidate, score) of the best candidates of each query inside the tile."""
    q8, q_scale, q_long, q_left = quantised(queries)
    c8, c_scale, c_long, c_left = quantised(candidates)
    c8 = c8.T.astype(np.float32)  # sums of 8-bit products are exact in it up to 1,040 components
    exact = np.float32 if c8.shape[0] <= 1_040 else np.float64
    c8 = c8.astype(exact)
    found = []
    for at in range(0, len(queries), BLOCK):
        part = slice(at, at + BLOCK)
        near = (q8[part].astype(exact) @ c8).astype(np.float64) * q_scale[part, None] * c_scale[None]
        bound = q_left[part, None] * (c_long + c_left)[None] + q_long[part, None] * c_left[None]
        bound += 1e-9 * (np.abs(near) + bound) + 1e-300
        own = query_ids[part, None] == candidate_ids[None]
        low = np.where(own, -np.inf, near - bound)
        k = min(nearest, low.shape[1])
        limit = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        at_query, at_candidate = np.nonzero((near + bound >= limit[:, None]) & ~own)
        for a in range(0, len(at_query), 1 << 16):
            rows, columns = at_query[a : a + (1 << 16)] + at, at_candidate[a : a + (1 << 16)]
            found.append((query_ids[rows], candidate_ids[columns], products(queries[rows], candidates[columns])))
    if not found:
        return [], [], []
    q, c, s = (np.concatenate(x) for x in zip(*found))
    heaps: dict[int, list[tuple[float, int]]] = {}
    for query, candidate, score in zip(q.tolist(), c.tolist(), s.tolist()):
        heap = heaps.setdefault(query, [])
        entry = (score, -candidate)
        if len(heap) < nearest:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
    rows = [(query, -c, s) for query, heap in heaps.items() for s, c in heap]
    return tuple(zip(*rows))


def nearest_neighbours(
    vectors: DataFrame,
    is_query,
    nearest: int = NEAREST,
    query_group: int = QUERY_GROUP,
    candidate_group: int = CANDIDATE_GROUP,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``nearest`` of each query row.

    ``vectors`` has vec_id and embedding; ``is_query`` tells the queries. Exact: the error
    bound of the 8-bit products never excludes a pair that belongs to the result.

    Defined cases: vectors that are null, empty or zero, or hold a null or non-finite
    component, and rows with a null id, take no part; a query never finds its own id;
    equal scores go by the smaller id; rows of one id and vector count once; vectors of
    different lengths are only compared with their like. No rows give no rows.
    """
    e = F.col("embedding").cast("array<double>")
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), e.alias("_v"))
        .filter("vec_id IS NOT NULL AND size(_v) > 0")
        .filter(~bad & F.exists("_v", lambda x: x != 0))
        .withColumn("_d", F.size("_v"))
    )
    rows = usable.dropDuplicates(["vec_id", "_v"])
    all_, asked = rows.count(), rows.filter(is_query).count()
    q_groups, c_groups = max(1, -(-asked // query_group)), max(1, -(-all_ // candidate_group))

    def dealt(groups: int, seed: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(groups)).cast("int")

    queries = rows.filter(is_query).select(
        "vec_id", "_v", "_d", dealt(q_groups, 1).alias("qg"), F.explode(F.sequence(F.lit(0), F.lit(c_groups - 1))).alias("cg")
    )
    candidates = rows.select(
        "vec_id", "_v", "_d", F.explode(F.sequence(F.lit(0), F.lit(q_groups - 1))).alias("qg"), dealt(c_groups, 2).alias("cg")
    )

    def matrix(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = part["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return part["vec_id"].to_numpy(), flat.reshape(len(part), -1)

    result = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return result.empty_table()
        q, c, s = tile(*matrix(left), *matrix(right), nearest) or ([], [], [])
        return pa.table([pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.float64())], schema=result)

    keys = ["_d", "qg", "cg"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        best, "query_id bigint, vec_id bigint, score double"
    )
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("vec_id") % QUERY_STEP == 0)


QUERIES = {"op5_nearest": op5_nearest}
ORACLE = {
    "op5_nearest": f"""
WITH v AS (
  SELECT vec_id, embedding::double[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEAREST}
"""
}
