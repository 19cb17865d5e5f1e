"""Toxic documents, found by a bidirectional gated recurrent network.

A word enters as a word vector and as its character groups, goes through gated recurrent
units in both directions, and attention pools a window. All overlapping windows of a text
are scored; the document takes the highest score. Training and scoring are numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.llm.common import pieces, process_memory, table, texts_to_python, without

WINDOW, STRIDE = 32, 24  # words
BUCKETS, WIDTH, HIDDEN, LOOK = 1 << 14, 4, 6, 4
SAMPLE_ROWS, SAMPLE_BYTES = 2_400, 32_768  # training: rows of each label, bytes of a text
EPOCHS, STEPS, BATCH, RATE, SEED = 7, 300, 96, 0.02, 7  # at least so many rounds and steps
CHANNELS = 2 * WIDTH + 2
SLICE = 16_384  # words whose character groups are looked at together
TOKEN = re.compile(r"\w+")


def words_of(text: str | None) -> Iterator[list[str]]:
    """Lower-case words of the whole text, a bounded piece at a time."""
    for piece in pieces(text or ""):
        yield TOKEN.findall(piece.lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word; buckets of its groups of 3 to 6 characters, with the word's
    edges as characters, as one list with the start and the number of each word's groups."""
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.repeat(np.cumsum(lengths), lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    turned = np.full(len(codes), 17, np.uint64)
    groups, owners = [], []
    for n in range(1, 7):
        turned = turned[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        turned ^= turned >> np.uint64(31)
        if n > 2:
            whole = np.arange(len(turned)) + n <= ends[: len(turned)]
            groups.append(turned[whole] % np.uint64(4 * BUCKETS))
            owners.append(word[: len(turned)][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    sizes = np.bincount(owner, minlength=len(words))
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(BUCKETS)
    return own.astype(np.int64), np.concatenate(groups)[order].astype(np.int64), np.cumsum(sizes) - sizes, sizes


def window_starts(length: int) -> np.ndarray:
    """Starts of the overlapping windows; the last one ends with the text."""
    if length <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, length - WINDOW, STRIDE), length - WINDOW)


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


TRAINED = ("inputs", "state", "bias", "look", "query", "out", "base")  # and word, group, row by row


@dataclass
class Network:
    """All weights; ``odds`` are how much more often a bucket is seen in toxic rows."""

    word: np.ndarray
    group: np.ndarray
    word_odds: np.ndarray
    group_odds: np.ndarray
    inputs: np.ndarray  # direction, channel, gates
    state: np.ndarray  # direction, hidden, gates
    bias: np.ndarray
    look: np.ndarray
    query: np.ndarray
    out: np.ndarray
    base: np.ndarray

    @classmethod
    def fresh(cls) -> Network:
        r = np.random.default_rng(SEED)

        def noise(*shape: int, scale: float) -> np.ndarray:
            return r.normal(0, scale, shape).astype(np.float32)

        h = HIDDEN
        inputs = noise(2, CHANNELS, 3 * h, scale=0.3)
        return cls(
            noise(BUCKETS, WIDTH, scale=0.05), noise(4 * BUCKETS, WIDTH, scale=0.05),
            np.zeros(BUCKETS, np.float32), np.zeros(4 * BUCKETS, np.float32),
            inputs, noise(2, h, 3 * h, scale=0.3), np.zeros((2, 3 * h), np.float32),
            noise(2 * h, LOOK, scale=0.3), noise(LOOK, scale=0.3), noise(2 * h, scale=0.3), np.full(1, -1.0, np.float32),
        )

    def vectors(self, words: list[str]) -> np.ndarray:
        """Word vector, mean of the character groups, and both odds, for each word."""
        own, groups, first, sizes = features(words)
        return np.concatenate(
            [
                self.word[own],
                np.add.reduceat(self.group[groups], first, axis=0) / sizes[:, None],
                self.word_odds[own][:, None],
                np.maximum.reduceat(self.group_odds[groups], first)[:, None],
            ],
            axis=1,
        ).astype(np.float32)

    def scores(self, gates: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The same as ``run`` for windows of word numbers (time, window), -1 for none;
        laid out for speed, with the windows along the last axis."""
        h, (length, n) = HIDDEN, words.shape
        real = words >= 0
        full = real.all(axis=1)
        hidden = np.empty((length, 2 * h, n), np.float32)
        for d in (0, 1):
            turn = np.ascontiguousarray(self.state[d].T)
            now = np.zeros((h, n), np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                x, u = gates[d].take(words[t], axis=0).T, turn @ now
                rz, c = u[: 2 * h], u[2 * h :]
                rz += x[: 2 * h]
                rz *= 0.5
                np.tanh(rz, out=rz)
                rz *= 0.5
                rz += 0.5
                c *= rz[:h]
                c += x[2 * h :]
                np.tanh(c, out=c)
                c -= now
                c *= rz[h:]
                now = now + (c if full[t] else c * real[t])
                hidden[t, d * h : d * h + h] = now
        weight = np.matmul(self.query, np.tanh(np.matmul(self.look.T, hidden)))
        weight[~real] = -30
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        return self.out @ np.einsum("tkn,tn->kn", hidden, weight) + self.base[0]

    def run(self, steps: np.ndarray, real: np.ndarray, keep: bool = False):
        """Scores before the sigmoid. ``steps``: direction, time, window, gates."""
        _, length, n, _ = steps.shape
        h = HIDDEN
        hidden = np.zeros((length, n, 2 * h), np.float32)
        saved = []
        for d in (0, 1):
            now = np.zeros((n, h), np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                x, u = steps[d, t], now @ self.state[d]
                rz = _gate(x[:, : 2 * h] + u[:, : 2 * h])
                r, z = rz[:, :h], rz[:, h:]
                c = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
                new = (1 - z) * now + z * c
                new = np.where(real[t][:, None], new, now)
                if keep:
                    saved.append((d, t, now, r, z, c, u[:, 2 * h :]))
                hidden[t, :, d * h : d * h + h] = now = new
        seen = np.tanh(hidden @ self.look)
        weight = seen @ self.query
        weight = np.where(real, weight, -30).astype(np.float32)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * hidden).sum(axis=0)
        logit = pooled @ self.out + self.base[0]
        return (logit, hidden, seen, weight, pooled, saved) if keep else logit

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Gate inputs of both directions for word vectors."""
        return np.stack([vectors @ self.inputs[d] + self.bias[d] for d in (0, 1)])


def _gradients(net: Network, vectors: np.ndarray, real: np.ndarray, labels: np.ndarray) -> tuple[dict, np.ndarray]:
    """Back-propagation through time; ``vectors`` is time, window, channel."""
    h = HIDDEN
    steps = net.project(vectors)
    logit, hidden, seen, weight, pooled, saved = net.run(steps, real, keep=True)
    d_logit = ((_gate(logit) - labels) / len(labels)).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "base": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * net.out
    d_weight = (hidden * d_pooled[None]).sum(axis=2)
    d_hidden = weight[:, :, None] * d_pooled[None]
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["query"] = np.einsum("tnk,tn->k", seen, d_score)
    d_seen = d_score[:, :, None] * net.query * (1 - seen**2)
    g["look"] = np.einsum("tnk,tnj->kj", hidden, d_seen)
    d_hidden += d_seen @ net.look.T
    g["inputs"], g["state"], g["bias"] = (np.zeros_like(x) for x in (net.inputs, net.state, net.bias))
    d_vectors = np.zeros_like(vectors)
    carry = {0: np.zeros_like(d_pooled[:, :h]), 1: np.zeros_like(d_pooled[:, :h])}
    for d, t, before, r, z, c, u in reversed(saved):
        live = real[t][:, None]
        grad = carry[d] + d_hidden[t, :, d * h : d * h + h]
        d_new = np.where(live, grad, 0)
        d_c = d_new * z * (1 - c**2)
        d_z = d_new * (c - before) * z * (1 - z)
        d_r = d_c * u * r * (1 - r)
        d_x = np.concatenate([d_r, d_z, d_c], axis=1)
        d_u = np.concatenate([d_r, d_z, d_c * r], axis=1)
        carry[d] = d_u @ net.state[d].T + np.where(live, d_new * (1 - z), grad)
        g["state"][d] += before.T @ d_u
        g["inputs"][d] += vectors[t].T @ d_x
        g["bias"][d] += d_x.sum(axis=0)
        d_vectors[t] += d_x @ net.inputs[d].T
    return g, d_vectors


def train(texts: Iterable[str], labels: list[int]) -> Network | None:
    """Fit the network to labelled texts; None without both labels.

    A window has no label of its own: in each round the window of a toxic text that
    scores highest is learnt as toxic, and of a clean text the two highest and a drawn one
    as clean. Odds leave out the text itself, so a word that only one text has says nothing.
    """
    y = np.array(labels, np.float32)
    if not 0 < y.sum() < len(y):
        return None
    net, random = Network.fresh(), np.random.default_rng(SEED)
    # Words become numbers while the texts are read: they are never held as objects.
    place: dict[str, int] = {}
    ids = [
        np.fromiter((place.setdefault(w, len(place)) for words in words_of(t) for w in words), np.int32) for t in texts
    ]
    if not place:
        return None
    names = sorted(place)
    rank = np.empty(len(names), np.int32)
    rank[[place[w] for w in names]] = np.arange(len(names))
    ids = [rank[own] for own in ids]
    del place
    # Groups of all words lie in one list; everything over it is done for some words at a time.
    parts = [features(names[a : a + SLICE]) for a in range(0, len(names), SLICE)]
    word_at = np.concatenate([p[0] for p in parts])
    flat = np.concatenate([p[1].astype(np.int32) for p in parts])
    sizes = np.concatenate([p[3] for p in parts])
    first = np.cumsum(sizes) - sizes
    del parts, names

    def reduced(merge: np.ufunc, table: np.ndarray) -> np.ndarray:
        """The rows of ``table`` for the groups of each word, merged."""
        found = []
        for a in range(0, len(first), SLICE):
            begin, end = first[a], (first[a + SLICE] if a + SLICE < len(first) else len(flat))
            found.append(merge.reduceat(table[flat[begin:end]], first[a : a + SLICE] - begin, axis=0))
        return np.concatenate(found)

    seen_word, seen_group = np.zeros((2, BUCKETS)), np.zeros((2, 4 * BUCKETS))
    for own, label in zip(ids, labels):
        own = np.unique(own)
        seen_word[label, np.unique(word_at[own])] += 1
        if len(own):
            seen_group[label, np.unique(np.concatenate([flat[first[w] : first[w] + sizes[w]] for w in own]))] += 1
    share = y.mean()

    def odds(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        p = (toxic + 4 * share) / (toxic + clean + 4)
        return (np.log(p / (1 - p)) - np.log(share / (1 - share))).astype(np.float32)

    def without_one(seen: np.ndarray, label: int) -> np.ndarray:
        return odds(*(np.maximum(n - (k == label), 0) for k, n in enumerate(seen)))

    net.word_odds, net.group_odds = odds(*seen_word), odds(*seen_group)
    left_out = np.stack(
        [
            np.stack(
                [
                    without_one(seen_word, k)[word_at],
                    reduced(np.maximum, without_one(seen_group, k)),
                ],
                axis=1,
            )
            for k in (0, 1)
        ]
    )

    def windows(doc: int) -> np.ndarray:
        padded = np.append(ids[doc], np.full(max(0, WINDOW - len(ids[doc])), -1, np.int32))
        return padded[window_starts(len(ids[doc]))[:, None] + np.arange(WINDOW)]

    def means() -> np.ndarray:
        return reduced(np.add, net.group) / sizes[:, None]

    def vectors(where: np.ndarray, label: np.ndarray, mean: np.ndarray) -> np.ndarray:
        """time, window, channel of word numbers (window, time)."""
        x = np.concatenate([net.word[word_at[where]], mean[where], left_out[label[:, None], where]], axis=2)
        return np.where((where >= 0)[:, :, None], x, 0).transpose(1, 0, 2).astype(np.float32)

    moments = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in TRAINED}
    step = 0
    every, spans = [], []
    for k in (0, 1):
        cut = [windows(i) for i in np.flatnonzero(y == k)]
        edges = np.cumsum([0, *map(len, cut)])
        every.append(np.concatenate(cut))
        spans.append(list(zip(edges[:-1], edges[1:])))
        del cut
    rounds = max(EPOCHS, -(-STEPS * BATCH // (2 * len(ids))))
    ids.clear()
    for epoch in range(rounds):
        mean = means()
        chosen, marks = [], []
        for label in (0, 1):
            if epoch:
                # Gates of every word, as seen from a text of this label.
                inputs = np.concatenate([net.word[word_at], mean, left_out[label]], axis=1)
                gates = net.project(inputs.astype(np.float32))
                rows = every[label]
                score = np.concatenate([net.scores(gates, rows[a : a + 1024].T) for a in range(0, len(rows), 1024)])
                del inputs, gates
            else:  # before any training: where the odds are highest
                score = np.where(every[label] >= 0, left_out[label, every[label]].sum(axis=2), -9).max(axis=1)
            for begin, end in spans[label]:
                own = begin + np.argsort(-score[begin:end], kind="stable")
                picks = own[: 1 + (not label)]  # of a clean text the two highest and a drawn one
                if not label:
                    picks = np.append(picks, random.integers(begin, end))
                chosen.append(every[label][picks])
                marks += [label] * len(picks)
        chosen.append(np.full((1, WINDOW), -1))
        marks.append(0)  # a text without words is clean
        chosen, marks = np.concatenate(chosen), np.array(marks)
        order = random.permutation(len(chosen))
        for at in range(0, len(order), BATCH):
            rows, label = chosen[order[at : at + BATCH]], marks[order[at : at + BATCH]]
            x = vectors(rows, label, mean)
            g, d_x = _gradients(net, x, (rows >= 0).T, label.astype(np.float32))
            step += 1
            for k, grad in g.items():
                m = moments[k]
                m[0] = 0.9 * m[0] + 0.1 * grad
                m[1] = 0.99 * m[1] + 0.01 * grad**2
                value = getattr(net, k)
                value -= RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-6)
            d_x = d_x.transpose(1, 0, 2)[rows >= 0]
            used = rows[rows >= 0]
            # The rows of the two vector tables: summed up by word, then by bucket.
            number, at_word = np.unique(used, return_inverse=True)
            total = np.stack([np.bincount(at_word, d_x[:, c], len(number)) for c in range(2 * WIDTH)], axis=1)
            many = sizes[number]
            group = flat[np.repeat(first[number] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            share_of = np.repeat(total[:, WIDTH:] / many[:, None], many, axis=0)
            for c in range(WIDTH):
                net.word[:, c] -= 0.5 * np.bincount(word_at[number], total[:, c], len(net.word))
                net.group[:, c] -= 0.5 * np.bincount(group, share_of[:, c], len(net.group))
    return net


class Scorer:
    """Scores texts; gate inputs are computed once per word and kept, up to a bound."""

    def __init__(self, net: Network, most: int = 100_000) -> None:
        self.net, self.most = net, most
        self.place: dict[str, int] = {}
        self.gates = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.place]
        if new:
            begin = len(self.place)
            while begin + len(new) > self.gates.shape[1]:
                self.gates = np.concatenate([self.gates, np.zeros_like(self.gates)], axis=1)
            for at in range(0, len(new), SLICE):
                part = new[at : at + SLICE]
                self.gates[:, begin + at : begin + at + len(part)] = self.net.project(self.net.vectors(part))
            self.place |= {w: begin + i for i, w in enumerate(new)}
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def scores(self, texts: Iterable[str | None], number: int | None = None) -> np.ndarray:
        """Highest window score of each of ``number`` texts (a list needs none); they are read some hundred thousand words
        at a time, and a text that is cut there goes on with its last window."""
        best = np.full(len(texts) if number is None else number, -np.inf, np.float32)
        words: list[str] = []
        spans: list[tuple[int, int, int]] = []  # text, start, length

        def flush() -> None:
            if len(self.place) > self.most:
                self.place, self.gates = {}, self.gates[:, :1024].copy()
            numbers = np.append(self._numbers(words), np.full(WINDOW, -1))
            starts = [window_starts(length) + start for _, start, length in spans]
            owner = np.repeat([text for text, _, _ in spans], list(map(len, starts)))
            end = np.repeat([start + length for _, start, length in spans], list(map(len, starts)))
            starts = np.concatenate(starts)
            for a in range(0, len(starts), 1024):
                at = starts[a : a + 1024] + np.arange(WINDOW)[:, None]
                part = np.where(at < end[a : a + 1024], numbers[at], -1)
                np.maximum.at(best, owner[a : a + 1024], self.net.scores(self.gates, part))
            words.clear()
            spans.clear()

        for i, text in enumerate(texts):
            tail: list[str] = []
            for found in words_of(text):
                found = tail + found
                spans.append((i, len(words), len(found)))
                words += found
                tail = found[-WINDOW:]
                if len(words) > 100_000:
                    flush()
        if spans:
            flush()
        return _gate(best)


def held_out():
    """Rows that training never sees."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """Train on at most ``sample_rows`` rows of either label, in hash order, outside the
    held-out fifth, and only on texts of at most ``sample_bytes`` bytes: the sample that
    comes to the driver is bounded whatever the size of the corpus."""
    usable = (
        labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_order", F.xxhash64("doc_id", F.lit(SEED)))
    )
    short = docs.select("doc_id", F.octet_length("text").alias("_bytes")).filter(F.col("_bytes").between(1, sample_bytes))
    usable = usable.join(short.select("doc_id").distinct(), "doc_id", "left_semi")
    kinds = [usable.filter(F.col("toxic") == k).orderBy("_order", "doc_id").limit(sample_rows) for k in (0, 1)]
    chosen = kinds[0].unionByName(kinds[1]).select("doc_id", "toxic").collect()
    if not chosen:
        return None
    few = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")
    rows = (
        docs.filter(F.octet_length("text").between(1, sample_bytes))
        .join(F.broadcast(few), "doc_id")  # at most twice sample_rows rows
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: r.doc_id)
    labels_of = [r.toxic for r in rows]
    texts = (rows.pop().text for _ in range(len(rows)))  # each is gone when it has been read
    rows.reverse()
    return train(texts, labels_of)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (doc_id, text and more) with ``held_out``, ``score`` and ``predicted``.

    These replace columns of their names. Defined cases: null, empty and wordless texts
    are scored as one empty window; every row is scored by its own text, also for a null
    or repeated doc_id (a null one is not held out); several labels of a document count
    as toxic if one does; without labels of both kinds every score is 0.
    """
    docs = texts_to_python(without(docs, "held_out", "score", "predicted"))
    net = fit(docs.select("doc_id", "text"), labels, sample_rows)
    shown = docs.sparkSession.sparkContext.broadcast(net and vars(net))
    names = docs.columns
    extra = docs.withColumn("score", F.lit(0.0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        scorer = Scorer(Network(**shown.value)) if shown.value else None
        for batch in batches:
            texts = batch.column("text")
            found = scorer.scores((t.as_py() for t in texts), len(texts)) if scorer else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.asarray(found, np.float64))], names=[*names, "score"]
            )

    return (
        docs.mapInArrow(score, extra.schema)
        .withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    scored = toxicity(docs, table(spark, folder, "labels", "doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op10_toxicity": op10_toxicity}
