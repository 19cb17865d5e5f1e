"""All registered queries of the training-data operators, with the SQL of those that have one."""

from __future__ import annotations

from deskmill.llm import (
    alignment, centroids, lattice, line_dedup, mixing, near_dedup, nearest, packing, quality, sharding, token_counts, toxicity, url_filter,
)

_MODULES = [
    token_counts, near_dedup, sharding, url_filter, nearest, packing, line_dedup, mixing, quality, toxicity,
    lattice, alignment, centroids,
]

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
