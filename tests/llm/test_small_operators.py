"""Token counts, sharding and nearest neighbours against plain versions."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskmill.llm import nearest, sharding, token_counts
from deskmill.llm.tokens import Encoder, tokenizer_text
from tests.llm.conftest import long_text

# --- token counts --------------------------------------------------------------------


@pytest.fixture(scope="module")
def count():
    made = Tokenizer.from_str(tokenizer_text())
    return lambda text: len(made.encode(text, add_special_tokens=False).ids)


def test_tree_counts_like_the_tokenizer(count):
    draw, encoder = random.Random(5), Encoder(tokenizer_text())
    bits = ["", " ", "\n", "abc", "it's 'll", "é.", "a b c " * 200, "12 3", "<|endoftext|>", "\u0301x", "\x0b", "x" * 600]
    for text in [long_text(900), long_text(30), "", "a", " \n ", "x" * 3000, "é" * 700 + " b"]:
        tree = token_counts.TokenTree(text, encoder)
        for _ in range(25):
            start, removed, added = draw.randint(-2, len(text) + 3), draw.choice([0, 1, 5, 50, 400, 10**6]), draw.choice(bits)
            tree.edit(start, removed, added)
            at = min(max(start, 0), len(text))
            text = text[:at] + added + text[at + removed :]
            assert (tree.text(), tree.chars[1], tree.total) == (text, len(text), count(text))


def test_edits_encode_little():
    encoder = Encoder(tokenizer_text())
    tree = token_counts.TokenTree(long_text(20_000), encoder)
    built = tree.encoded
    for i in range(20):
        tree.edit(i * 5000, 3, "new words")
    assert tree.encoded - built < 20 * 1200


def test_count_edits(docs, count):
    rows = [(1, long_text(300)), (2, None), (3, ""), (None, "a b"), (4, "same"), (4, "same")]
    frame = docs(*rows, extra=["tokens", "n_edits"]).withColumn("edits", token_counts.revision(F.col("text")))
    changes = {r.doc_id: r.edits for r in frame.collect()}
    got = token_counts.count_edits(frame).collect()
    assert len(got) == 6
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        assert r.tokens_before == count(text)
        for e, n in zip(changes[r.doc_id], r.tokens):
            text = text[: e.start] + e.added + text[e.start + e.removed :]
            assert n == count(text)
        assert (r.tokens_after, r.chars_after) == (count(text), len(text))
    none = frame.withColumn("edits", F.lit(None).cast(frame.schema["edits"].dataType))
    assert {r.n_edits for r in token_counts.count_edits(none).collect()} == {0}
    assert token_counts.count_edits(frame.limit(0)).count() == 0


# --- sharding --------------------------------------------------------------------------


def test_sharding(spark, docs, tmp_path):
    rows = [(i, long_text(20, i)) for i in range(500)] + [(7, "again"), (7, None), (None, "x"), (None, "x"), (501, "y" * 100_000)]
    frame = docs(*rows, extra=["size", "shard", "slot", "_text_hash"])
    got = sharding.external_shuffle(frame, shards=5, bucket_bytes=4096).collect()
    again = sharding.external_shuffle(frame.repartition(5), shards=5, bucket_bytes=4096).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert sorted(places) == list(range(5))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    grown = {r.doc_id: r.shard for r in sharding.external_shuffle(frame, shards=6).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in got)
    assert len({r.bucket for r in got}) > 5 and {r.size for r in got} == {"mine"}
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.shard == 0 and r.doc_id is not None]
    assert order != sorted(order)
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.external_shuffle(frame, shards=5, bucket_bytes=4096), path)
    assert spark.read.parquet(path).count() == len(rows)
    assert sharding.external_shuffle(frame.limit(0)).count() == 0


def test_fisher_yates_is_even():
    seen = defaultdict(int)
    for seed in range(6000):
        seen[tuple(sharding.fisher_yates(3, seed, 0))] += 1
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, 1, 1).tolist() == []


# --- nearest neighbours -----------------------------------------------------------------


def brute(rows, n):
    usable = {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    result = []
    for q in sorted(usable):
        if q % 20 == 0:
            scored = []
            for c, v in usable.items():
                if c != q and len(v) == len(usable[q]):
                    total = 0.0
                    for a, b in zip(np.float32(usable[q]), np.float32(v)):
                        total += float(a) * float(b)
                    scored.append((-total, c))
            result += [(q, k + 1, c, -s) for k, (s, c) in enumerate(sorted(scored)[:n])]
    return result


def test_nearest(spark):
    draw = random.Random(8)
    rows = [(i, [draw.choice([-1.5, 0.25, 3.0, 1e-3]) * draw.random() for _ in range(9)]) for i in range(400)]
    rows += [(400 + i, rows[5][1]) for i in range(60)]  # one very common vector
    rows += [(500, None), (501, []), (502, [0.0] * 9), (503, [1.0, None] + [0.0] * 7), (504, [float("nan")] * 9), (520, [float("inf")] * 9)]
    rows += [(540, [1e30] * 9), (541, [1e-30] * 9), (560, [1.0, 2.0]), (561, [2.0, 1.0]), (None, [1.0] * 9), (40, rows[40][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    frame = frame.selectExpr("*", "'mine' AS score", "1 AS qg", "2 AS _d")
    got = nearest.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, query_group=10, candidate_group=64)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)
    assert nearest.nearest_neighbours(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_the_bound_leaves_most_pairs_out(monkeypatch):
    r = np.random.default_rng(2)
    q, c = r.normal(size=(50, 64)), r.normal(size=(3000, 64))
    computed = []
    products = nearest.products
    monkeypatch.setattr(nearest, "products", lambda a, b: computed.append(len(a)) or products(a, b))
    nearest.tile(np.arange(50), q, np.arange(3000) + 100, c, 20)
    assert sum(computed) < 50 * 3000 * 0.03
