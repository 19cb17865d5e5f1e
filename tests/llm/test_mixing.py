"""Source mixing: targets, limits, repeatability, and the text that comes out."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from deskmill.llm import mixing as m
from tests.llm.conftest import long_text


def plain_targets(sizes):
    """Share by weight again and again until nobody is above the limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1000, "b": 10, "c": 5, "Z": 1, "é": 700, None: 30},
        {"a": 5000, "b": 0, "c": 1},
        {"a": 0, None: 0},
        {None: 7},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in m.source_targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def sized(spark, n=400):
    rows = [(i, ("a", "b", "c", None)[i % 4 if i % 3 else 0], (i * 37) % 90) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").repartition(3)


def test_near_targets_and_repeatable(spark):
    rows = sized(spark)
    got = m.plan_mix(rows, block=8)[0].collect()
    again = m.plan_mix(rows.repartition(5, "size"), block=8)[0].collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 24


def test_slots_walk_through_permutations(spark):
    picked = m.plan_mix(sized(spark), block=8, slots=100)[1].collect()
    blocks = defaultdict(Counter)
    for r in picked:
        blocks[r.source][r.block] += 1
    for counts in blocks.values():
        assert max(counts.values()) - min(counts.values()) <= 1 or set(counts.values()) <= {1}


def test_counts_of_shards_are_drawn_and_add_up(spark):
    """Shards differ as draws do; sums are off by half a slot; nothing is drawn twice."""
    rows = spark.createDataFrame([(i, "abc"[i % 3], 80) for i in range(3000)], "doc_id bigint, source string, size bigint")
    slots = 100
    picked = m.plan_mix(rows, block=8, slots=slots)[1].collect()
    assert len({(r.shard, r.place) for r in picked}) == len(picked)
    shards = defaultdict(Counter)
    for r in picked:
        shards[r.shard][r.source] += 1
    full = [c for c in shards.values() if sum(c.values()) == slots]
    assert len(full) == 300
    for i, source in enumerate("abc"):
        share = (i + 1) / 6
        counts = [c[source] for c in full]
        assert abs(sum(counts) - share * 30_000) <= 1
        variance = sum((x - share * slots) ** 2 for x in counts) / len(counts)
        assert 0.75 < variance / (slots * share * (1 - share)) < 1.25


def test_taken_words_against_a_plain_walk(spark):
    """Order, passes, permutations and overlaps once more in plain Python; only hashes are Spark's."""
    block, seed = 8, m.SEED
    rows = sized(spark, 120)
    got = {r.doc_id: r.taken for r in m.plan_mix(rows, block=block, seed=seed)[0].collect()}

    def hashes(values, schema, *parts):
        made = spark.createDataFrame(values, schema)
        return [r[0] for r in made.select(F.xxhash64(*parts)).coalesce(1).collect()]

    docs = [tuple(r) for r in rows.select("doc_id", "source", "size").collect()]
    names = sorted({s for _, s, _ in docs if s is not None}) + [None]
    sizes = {s: sum(n for _, x, n in docs if x == s) for s in names}
    target, blocks = plain_targets(sizes), {s: -(-sizes[s] // block) for s in names}
    ends, reach = [0], 0.0
    for s in names:
        reach += target[s] / sizes[s] * blocks[s]
        ends.append(int(reach + 0.5))
    times = Counter()
    for number, s in enumerate(names, 1):
        n = blocks[s]
        whole, rest = divmod(min(ends[number] - ends[number - 1], m.MOST * n), n)
        for b in range(n):
            times[s, b] = whole
        begin = hashes([(number, whole)], "a int, b bigint", "a", "b", F.lit(seed))[0] % len(m.PRIMES)
        shift = hashes([(whole, number)], "a bigint, b int", "a", "b", F.lit(seed + 1))[0] % n
        for k in range(rest):
            times[s, (k * m.PRIMES[begin] + shift) % n] += 1
    want = {}
    for s in names:
        mine = [d for d in docs if d[1] == s]
        place = hashes([(d, n) for d, _, n in mine], "doc_id bigint, size bigint", "doc_id", "size", F.lit(seed))
        at = 0  # up to 256 rows are one slice, in which places are ordered as signed numbers
        for _, (d, _, n) in sorted(zip(place, mine)):
            want[d] = sum(times[s, w // block] for w in range(at, at + n))
            at += n
    assert got == want


def test_mix_gives_the_words_that_were_taken(docs):
    rows = [(i, f"start {long_text(30 + i, i)}\nend {i} ", "en", "abc"[i % 3]) for i in range(30)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, " \n ", "en", "b"), (103, long_text(20_000), "en", "c"), (None, "x y z", "en", None)]
    made = docs(*rows, extra=["size", "taken", "takes", "block", "_copy1"])
    plan = {r.doc_id: r for r in m.plan_mix(made.select("doc_id", "source", m.n_words(F.col("text")).alias("size")), block=8)[0].collect()}
    out = m.mix(made, block=8).collect()
    words, text = Counter(), {r[0]: r[1] for r in rows}
    for r in out:
        assert r.n_chars == len(r.text) and r.block == "mine"
        words[r.doc_id] += len(r.text.split())
        source = (text[r.doc_id] or "").split()
        assert Counter(r.text.split()) <= Counter(source)
        if len(r.text.split()) == len(source):
            assert r.text == text[r.doc_id]
    assert words == Counter({d: r.taken for d, r in plan.items() if r.taken})


def test_no_rows_and_no_words(docs):
    assert m.mix(docs((1, "a")).limit(0)).count() == 0
    assert m.mix(docs((1, None), (2, " "))).count() == 0
