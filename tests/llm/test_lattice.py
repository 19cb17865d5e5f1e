"""Lattice likelihood against an enumeration of segmentations and plain counts."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskmill.llm import lattice as m
from tests.llm.conftest import long_text


@pytest.fixture(scope="module")
def small():
    return m.Vocabulary(["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba", "▁abab"], list(range(9)))


PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba", "▁abab"]


def ways(text, at=0):
    """All segmentations as lists of piece numbers; characters without a piece as bytes."""
    if at == len(text):
        yield []
        return
    found = [i for i, p in enumerate(PIECES) if text.startswith(p, at) and (at == 0 or p[0] != "▁")]
    if not any(len(PIECES[i]) == 1 for i in found):
        for rest in ways(text, at + 1):
            yield [*(len(PIECES) + b for b in text[at].encode()), *rest]
    for i in found:
        for rest in ways(text, at + len(PIECES[i])):
            yield [i, *rest]


def test_totals_and_counts_are_those_of_all_ways(small):
    r = np.random.default_rng(5)
    scores = np.log(r.dirichlet(np.ones(small.size + 256), 3).T)
    words = ["abab", "a", "abéab", "bbb", "", "aabababa", "中a", "b" * 11, "ab", "b▁a▁"]
    counts = r.integers(0, 5, (len(words), 3)).astype(float)
    lattices = m.Lattices(small, words)
    totals, want = lattices.totals(scores), np.zeros((small.size + 256, 3))
    for i, w in enumerate(words):
        every = list(ways("▁" + w))
        each = np.array([scores[x].sum(axis=0) for x in every])
        assert np.allclose(totals[i], np.log(np.exp(each).sum(axis=0)))
        for x, share in zip(every, np.exp(each - totals[i]) * counts[i]):
            np.add.at(want, x, share)
    assert np.allclose(lattices.expected(scores, counts), want)
    assert m.Lattices(small, []).totals(scores).shape == (0, 3)


def test_long_words_stay_whole(small):
    scores = np.log(np.repeat(small.prior[:, None], 1, axis=1))
    half, whole = m.Lattices(small, ["ab" * 2500, "ab" * 5000]).totals(scores)[:, 0]
    assert np.isfinite(whole) and whole < 1.9 * half


def training(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 != 2


def check(got, rows):
    seen, n = Counter(), 0
    for i, text, *_ in rows:
        if training(i):
            seen.update(bytes(text or "", "utf-8").lower().split())
            n += 1
    seen[None] = n
    total, distinct = sum(seen.values()), sum(c > 0 for c in seen.values())
    want = []
    for i, text, *_ in rows:
        tokens = [*bytes(text or "", "utf-8").lower().split(), None]
        base = sum(math.log10((seen[t] + 1) / (total + distinct + 1)) for t in tokens)
        want.append((i, not training(i), len(tokens), sum(seen[t] > 0 for t in tokens), total, round(base, 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("head", [3, m.HEAD])
def test_score(docs, head):
    draw = random.Random(1)
    own = {"en": "the of and to thing ing tion".split(), "fr": "le la de et eau oux ment".split()}
    rows = []
    for i in range(120):
        lang = ("en", "fr")[i % 2]
        rows.append((i, " ".join("".join(draw.choices(own[lang], k=draw.choice([1, 1, 2]))) for _ in range(40)), lang, "s"))
    rows += [(120, None, "en", "s"), (121, "", None, None), (122, " \x0b\n", "xx", "s"), (None, "The\tEau \x85", "en", "s"),
             (123, "é" * 3000, "fr", "s"), (124, long_text(300), "yy", "s"), (5, rows[5][1], "fr", "s")]
    frame = docs(*rows, extra=["score", "_row", "counts", "kind"])
    got = m.score(frame, head=head, kinds=2).collect()
    check(got, rows)
    assert {r.kind for r in got if r.doc_id is not None and r.doc_id < 120 and r.doc_id % 2} == {"fr"}
    held = [r for r in got if r.held_out and r.n_tokens > 30]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    none = m.score(frame.limit(0))
    assert none.count() == 0 and "train_tokens" in none.columns


def test_nothing_to_learn_from(docs):
    ids = [i for i in range(50) if not training(i)][:3]
    rows = [(i, "some words here", "en", "s") for i in ids]
    check(m.score(docs(*rows)).collect(), rows)


def test_query_on_the_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = m.op11_lattice(spark, folder).collect()
    check(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 1.3 * sum(r.base_score for r in held)
    assert m.op11_lattice(spark, folder).filter(F.col("score") > F.col("base_score")).count() > 0
