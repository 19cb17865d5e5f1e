"""Base counts against plain Python, and outliers that must and must not be found."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from deskmill.llm import quality as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in m.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab# \n\t\x0b\x1c\xa0é<", max_size=60)), max_size=12))
def test_counts(spark, texts):
    texts = [*texts, "", "a a a a", "a b a b a", "x " * 5_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = frame.select("i", *[c.alias(n) for n, c in m.statistics(F.col("text")).items()]).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: plain(t) for i, t in enumerate(texts)}


def test_windows_with_equal_short_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(m, "POSITION_BITS", 62)  # hardly any hash is left: all windows are candidates
    text = "a b c d e f g h i j a b c k"
    got = spark.createDataFrame([(text,)], "text string").select(m.statistics(F.col("text"))["n_repeat_words"]).first()[0]
    assert got == plain(text)[4] == 6


def corpus():
    draw = random.Random(4)
    rows = []
    for i in range(600):
        lang, source = ("en", "de")[i % 2], "big" if i % 3 else f"small{i % 7}"
        n = int(draw.lognormvariate(5.5, 0.6)) + 50
        size = 4 if lang == "en" else 7
        rows.append((i, " ".join("w" + str(draw.randrange(10 ** (size - 1), 10**size)) for _ in range(n)), lang, source))
    for i in range(600, 640):
        _, text, lang, source = rows[i - 600]
        junk = " ".join(w + "###" if draw.random() < 0.6 else w for w in text.split())
        rows.append((i, junk, lang, source))
    return rows


def test_outliers(docs):
    got = {r.doc_id: r for r in m.quality_rules(docs(*corpus(), extra=["distance", "n_words", "length", "m_length", "_g1"])).collect()}
    assert len(got) == 640
    clean = [got[i].kept for i in range(600)]
    assert sum(clean) >= 598 and not any(got[i].kept for i in range(600, 640))
    assert got[0].source and got[0]["length"] == got[0]["_g1"] == "mine"


def test_special_rows(docs):
    rows = [(1, None, None, None), (2, "", "en", None), (None, "word " * 60, None, "s"), (3, " ".join(f"a{i}" for i in range(70)), None, None)]
    rows += [(4, "same text again and again " * 3, "en", "s")] * 2
    got = m.quality_rules(docs(*rows)).collect()
    assert len(got) == 6
    assert {(r.doc_id, r.base_failed, r.kept) for r in got} == {
        (1, True, False), (2, True, False), (None, True, False), (3, False, True), (4, True, False)
    }
    assert m.quality_rules(docs((1, "a")).limit(0)).count() == 0


def test_small_groups_are_judged_by_their_language_and_by_all(docs):
    """Single junk rows in sources and languages of their own have nobody like them."""
    rows = [r for r in corpus() if r[0] < 600]
    junk = [r for r in corpus() if r[0] >= 600]
    tail = [(700, junk[0][1], junk[0][2], "tail"), (701, junk[1][1], junk[1][2], "other"), (702, junk[2][1], "fr", "tail")]
    fair = [(800, rows[0][1], rows[0][2], "fair"), (801, rows[1][1], "it", "fair")]
    big = [(i, text, lang, "big") for i, text, lang, _ in rows]
    got = {r.doc_id: r for r in m.quality_rules(docs(*big, *tail, *fair)).collect()}
    assert [got[i].kept for i in (700, 701, 702, 800, 801)] == [False, False, False, True, True]
    assert all(got[i].distance > m.CUTOFF for i in (700, 701, 702))


def test_language_estimate_holds_the_rows_of_its_large_sources(docs):
    """A document of a tail source has the distance that it has if sources are left out."""
    rows = [(i, text, "en", "big") for i, text, *_ in corpus() if i < 200]
    alone = {r.doc_id: r.distance for r in m.quality_rules(docs(*rows, (900, rows[7][1], "en", "big"))).collect()}
    split = {r.doc_id: r.distance for r in m.quality_rules(docs(*rows, (900, rows[7][1], "en", "tail"))).collect()}
    assert abs(alone[900] - split[900]) < 1e-6 and split[900] > 0


def test_distance_is_mahalanobis(spark):
    """With the core taken as given, the factor gives the same distances as a matrix inverse."""
    names = list(m.FEATURES)
    r = np.random.default_rng(1)
    values = r.normal(size=(200, 5)) @ r.normal(size=(5, 5))
    frame = spark.createDataFrame([("g", *map(float, v)) for v in values], ", ".join(["_g string", *[f"{n} double" for n in names]]))
    sums = frame.groupBy("_g").agg(
        F.count("*").alias("_k"), *[F.sum(a).alias(f"s_{a}") for a in names],
        *[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]],
    )
    got = sorted(x._d for x in m._distances(frame, m._factor(sums, names), names).collect())
    cov = m.CONSISTENCY * np.cov(values.T, bias=True) + np.diag([m.FEATURES[n][1] ** 2 for n in names])
    apart = values - values.mean(axis=0)
    np.testing.assert_allclose(got, np.sort(np.einsum("ij,jk,ik->i", apart, np.linalg.inv(cov), apart)), rtol=1e-6)


def test_smallest_determinant_against_numpy(spark, monkeypatch):
    """Two heaps: the estimate must settle, and be no wider than that of many random starts in numpy."""
    r = np.random.default_rng(3)
    rows = [(int(n), int(n * length), 0, int(d), 0) for n, length, d in zip(np.exp(r.normal(5.5, 0.3, 400)), r.normal(5, 0.4, 400), r.poisson(0.3, 400))]
    rows += [(int(n), int(n * 9), int(n), 3, int(n / 3)) for n in np.exp(r.normal(7, 0.2, 120))]
    made = spark.createDataFrame([(i, *x, "en", "s", False) for i, x in enumerate(rows)], "doc_id int, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, lang string, source string, base_failed boolean")
    got = {x.doc_id: x._d for x in m.outlier_distances(made).collect()}
    v = np.array([[np.log1p(n), c / n, np.log1p(s / n), np.log1p(100 * d / n), np.sqrt(w / n)] for n, c, s, d, w in rows])
    floors = np.diag([m.FEATURES[n][1] ** 2 for n in m.FEATURES])

    def shape(part):
        return part.mean(axis=0), m.CONSISTENCY * np.cov(part.T, bias=True) + floors

    best = (np.inf, None)
    for _ in range(50):
        part = v[r.choice(len(v), 30, replace=False)]
        for _ in range(30):
            mean, cov = shape(part)
            far = np.einsum("ij,jk,ik->i", v - mean, np.linalg.inv(cov), v - mean)
            part = v[far <= np.sort(far)[int(np.ceil(m.CORE * len(v))) - 1]]
        mean, cov = shape(part)
        if (size := np.linalg.slogdet(cov)[1]) < best[0] - 1e-9:
            best = (size, np.einsum("ij,jk,ik->i", v - mean, np.linalg.inv(cov), v - mean))
    np.testing.assert_allclose([got[i] for i in range(len(v))], best[1], rtol=0.05, atol=0.05)
    assert min(got[i] for i in range(400, 520)) > m.CUTOFF > np.quantile([got[i] for i in range(400)], 0.99)
