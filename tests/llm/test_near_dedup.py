"""Near duplicates and connected components against brute force."""

from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings, strategies as st

from deskmill.llm import near_dedup as m
from deskmill.llm.graph import components


def word_sets(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(nodes, links):
    name = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    return name


def plain(rows):
    sets = {d: word_sets(t) for d, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    name = groups(ids, links)
    return {d: (len(sets[d]), name[d], name[d] == d) for d in ids}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in m.near_dedup(frame).collect()}


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    for i in range(150):
        if texts and draw.random() < 0.6:  # chains: copies of copies
            words = draw.choice(texts).split()
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
        else:
            words = draw.choices(vocabulary, k=draw.choice([3, 8, 60, 120]))
        texts.append(" ".join(words))
        rows.append((i, texts[-1] if i % 9 else texts[-1].upper()))
    return rows


def test_like_brute_force(docs):
    for seed in (1, 2):
        rows = corpus(seed)
        assert found(docs(*rows)) == plain(rows)


def test_special_texts(docs):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "Ä b c d e"), (8, "ä b c d e"),
        (9, "x " * 60_000), (10, "x " * 50), (11, "x x x x x x"),
    ]
    assert found(docs(*rows)) == plain(rows)


def test_repeated_rows_null_ids_and_no_rows(docs):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f")]
    got = sorted(m.near_dedup(docs(*rows, extra=["n", "digest", "bands", "component_id"])).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(1, 1, True), (3, 1, False), (3, 1, False), (None, None, True)]
    assert m.near_dedup(docs((1, "a")).limit(0)).count() == 0


def test_hot_group_of_near_copies(docs):
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(250):
        words = list(base)
        words[i % 200] = f"other{i}"
        rows.append((i, " ".join(words)))
    assert {v[1] for v in found(docs(*rows)).values()} == {0}


def test_signature_estimates_the_similarity():
    import numpy as np

    r = np.random.default_rng(3)
    factors = r.integers(0, 2**31, 400, np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = r.integers(0, 2**32, 400, np.uint32)
    pool = r.integers(0, 2**63, 1300, np.uint64)
    a, b = pool[:1000], pool[300:]
    agree = (m.signature(a, factors, shifts) == m.signature(b, factors, shifts)).mean()
    assert abs(agree - 700 / 1300) < 0.07


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    frame = spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == groups({n for e in real for n in e}, real)


def test_long_chain(spark):
    frame = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in components(frame).collect()} == {0}


def test_small_sets_miss_no_more_bands_than_large_ones():
    """Pairs with 3 of 4 hashes in common share none of 4 bands of 5 with 0.31; with the
    minimum and maximum of a permutation in one band it would be about 0.44."""
    import numpy as np

    draw = np.random.default_rng(8)
    factors, shifts = draw.integers(0, 2**31, 10, np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 2**32, 10, np.uint32)
    missed = 0
    for hashes in draw.integers(0, 2**64, (4000, 4), np.uint64):
        x, y = (m.banded(m.signature(h, factors, shifts), 4, 5).reshape(4, 5) for h in (hashes, hashes[:3]))
        missed += not (x == y).all(axis=1).any()
    assert 0.27 < missed / 4000 < 0.36


def test_far_copies_of_one_text_are_not_compared_in_pairs(docs, monkeypatch):
    """Copies of one text that share many buckets and link with nothing, beside linked ones."""
    draw = random.Random(5)
    base, rows = [f"t{i}" for i in range(150)], []
    for i in range(240):
        words = list(base)
        for at in draw.sample(range(150), 2 if i % 2 else draw.choice([5, 6, 7])):
            words[at] = f"own{i}_{at}"
        rows.append((i + 1, " ".join(words)))
    rows.append((0, " ".join(base)))
    confirmed, pairs = m._confirmed, []
    monkeypatch.setattr(m, "_confirmed", lambda found, *rest: pairs.append(found.count()) or confirmed(found, *rest))
    assert found(docs(*rows)) == plain(rows)
    assert sum(pairs) < 5 * len(rows)


def test_prefix_filter_loses_no_pair(docs, spark):
    rows = [(d, t) for d, t in corpus(4) if word_sets(t)]
    parts = spark.createDataFrame([(d, d) for d, _ in rows], "node bigint, c bigint")
    texts = docs(*rows).selectExpr("doc_id AS node", "text")
    kept = {(r.a, r.b) for r in m._across(texts, parts, 75).collect()}
    sets = {d: word_sets(t) for d, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert links and links <= kept
