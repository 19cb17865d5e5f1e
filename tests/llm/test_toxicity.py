"""The gated network: gradients, windows, held-out accuracy, special rows."""

from __future__ import annotations

import random
import zlib

import numpy as np

from deskmill.llm import toxicity as m
from tests.llm.conftest import long_text

BAD = ["grumph", "snirkel", "blorfet"]


def corpus(n=320):
    draw = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([12, 60, 200]))]
        if i % 4 == 0:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", ",", "en"]))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_held_out_accuracy(docs, spark):
    texts, labels = corpus()
    marked = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id bigint, toxic int")
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, "..."), (None, texts[0]), (1003, long_text(70_000) + " " + BAD[0] + " snirkel")]
    got = m.toxicity(docs(*rows, extra=["score", "word", "predicted"]), marked).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for d, r in by_id.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.word == "mine"
        assert r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0)
    held = [d for d in range(len(texts)) if by_id[d].held_out]
    right = sum(by_id[d].predicted == labels[d] for d in held)
    assert len(held) > 40 and right / len(held) > 0.9
    assert [by_id[d].predicted for d in (1000, 1001, 1002)] == [0, 0, 0]
    assert by_id[1003].predicted == 1  # found in the middle of nowhere
    assert by_id[None].score == by_id[0].score


def test_without_both_labels_and_without_rows(docs, spark):
    marked = spark.createDataFrame([(1, 0), (2, None), (3, 0)], "doc_id bigint, toxic int")
    assert {r.score for r in m.toxicity(docs((1, "a b"), (3, "c")), marked).collect()} == {0.0}
    assert m.toxicity(docs((1, "a")).limit(0), marked).count() == 0
    assert m.train(["a", "b"], [1, 1]) is None and m.train(["", " "], [1, 0]) is None


def test_gradients():
    net, r = m.Network.fresh(), np.random.default_rng(3)
    for name in m.TRAINED:
        setattr(net, name, getattr(net, name).astype(np.float64))
    vectors = r.normal(size=(5, 3, m.CHANNELS))
    real = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = net.run(net.project(vectors), real)
        return np.mean(np.log1p(np.exp(logit)) - labels * logit)

    got, _ = m._gradients(net, vectors, real, labels)
    for name in m.TRAINED:
        value = getattr(net, name)
        at = tuple(r.integers(0, n) for n in value.shape)
        value[at] += 1e-4
        up = loss()
        value[at] -= 2e-4
        down = loss()
        value[at] += 1e-4
        assert abs((up - down) / 2e-4 - got[name][at]) < 2e-4


def test_fast_and_plain_pass_agree():
    net = m.Network.fresh()
    words = [f"word{i}" for i in range(40)]
    gates = net.project(net.vectors(words))
    rows = np.random.default_rng(1).integers(-1, 40, (m.WINDOW, 30))
    rows[20:, :10] = -1
    plain = net.run(np.where((rows >= 0)[None, :, :, None], gates[:, rows], 0), rows >= 0)
    np.testing.assert_allclose(net.scores(gates, rows), plain, atol=1e-5)


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = m.window_starts(n)
        covered = {i for s in starts for i in range(s, s + m.WINDOW)}
        assert covered >= set(range(n)) and max(starts) + m.WINDOW <= max(n, m.WINDOW)


def test_long_texts_are_read_to_the_end():
    net = m.Network.fresh()
    text = long_text(90_000)
    whole = m.Scorer(net).scores([text])[0]
    assert whole >= max(m.Scorer(net).scores([" ".join(text.split()[a : a + m.WINDOW]) for a in (0, 24, 24 * 2000)])) - 1e-6
