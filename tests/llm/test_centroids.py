"""Centroid clustering against measuring every centroid in Python's own integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from deskmill.llm import centroids


def brute(rows, clusters, rounds, parts):
    kept = []
    for i, v in rows:
        if v and len(v) == parts and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(x)) if abs(x) < 1e300 else int(x) * 1024 for x in v], v))

    def key(row):
        return (row[0] is None, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[2])

    centres = [v for _, v, _ in sorted(kept, key=key)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v, _ in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o)] if o else c for o, c in zip(own, centres)]
    found = [(i, *reversed(nearest(v))) for i, v, _ in kept]
    total = {k: sum(d for _, c, d in found if c == k) for k in range(len(centres))}

    def fits(x):
        return x if x < 2**63 else None

    return [
        (i, c, fits(d), fits(total[c]), fits(sum(total.values())), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
        for i, c, d in found
    ]


def check(spark, rows, clusters, rounds, parts):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    frame = frame.selectExpr("*", "'mine' AS cluster", "1 AS _v", "2 AS distance")
    got = centroids.centroid_clusters(frame, clusters, rounds, parts).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, clusters, rounds, parts), key=repr)
    return got


def test_clusters(spark):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-1, 0, 1, 2]) / 64 + draw.random() / 256 for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(150)]  # a very common vector
    rows += [(600, None), (601, []), (602, [1.0] * 5), (603, [1.0, None] + [0.0] * 4), (604, [float("nan")] * 6),
             (605, [float("-inf")] * 6), (None, [0.5] * 6), (8, rows[8][1]), (8, rows[9][1]), (606, [0.0] * 6)]
    assert len(check(spark, rows, 7, 4, 6)) == 454
    check(spark, [(i % 3, [0.25, 0.5]) for i in range(9)], 5, 2, 2)  # equal rows: empty clusters stay
    check(spark, rows[:3], 8, 3, 6)
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert centroids.centroid_clusters(empty).count() == 0


def test_ties_go_to_the_smaller_number(spark):
    # On a small grid most vectors lie as near to one centroid as to another.
    check(spark, [(i, [float(i % 5) / 1024, float(i // 5 % 5) / 1024]) for i in range(75)], 9, 3, 2)


def test_no_number_is_too_large(spark):
    rows = [(i, [10.0 ** (i % 40) * (-1) ** i, 3.0]) for i in range(80)] + [(80, [1.7e308, -1.7e308]), (81, [1e9, 1e9])]
    got = check(spark, rows, 4, 2, 2)
    assert any(r.distance is None for r in got)


def test_the_search_leaves_centroids_out():
    r = np.random.default_rng(3)
    centres = r.normal(0, 9000, (64, 8)).astype(int).tolist()
    v = np.array(centres)[r.integers(0, 64, 5000)] + r.integers(-300, 300, (5000, 8))
    search = centroids.Search(centres)
    at, far = search.nearest(v)
    every = ((v[:, None] - np.array(centres)[None]) ** 2).sum(axis=2)
    assert (at == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert search.measured < 5000 * 64 / 2
