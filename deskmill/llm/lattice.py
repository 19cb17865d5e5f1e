"""Likelihood of texts over all their segmentations into subwords.

The lattice of a word has an edge for every piece of an existing vocabulary that fits, and
one edge for the whole word if training has seen it. A forward recursion in log space adds
up all ways through it; words and the end of the text multiply to the probability of the
document. Scores are learnt per kind of text (its language), and a document sums over the
kinds, since its own is not given to the score.

The vocabulary's own scores are ranks. They enter as weights that fall with the rank, and
training adds how often each piece is expected on the ways through the corpus's words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskmill.llm.common import stored, table

HEAD, HEAD_BYTES = 1 << 16, 32  # commonest words that the tasks know by heart, and their length
KINDS = 8  # languages with scores of their own, by training texts; the others share one
ROUNDS, PRIOR, FIRST_RANK, BYTE_SHARE = 2, 1000.0, 50.0, 0.05
DISCOUNT = 0.7  # of a word's count, given to the pieces
START = 0x110000  # no character: where a word begins
BATCH = 4096  # words whose lattices are walked together


class Vocabulary:
    """Pieces as numbers, found by the hashes of their prefixes; the 256 bytes come last."""

    def __init__(self, pieces: list[str], ranks: list[float]) -> None:
        self.size = len(pieces)
        prior = 1 / (np.array(ranks) + FIRST_RANK)
        self.prior = np.append(prior / prior.sum() * (1 - BYTE_SHARE), np.full(256, BYTE_SHARE / 256))
        prefixes: dict[tuple[int, ...], int] = {}
        for i, piece in enumerate(pieces):
            codes = [START if c == "▁" else ord(c) for c in piece]
            for n in range(1, len(codes)):
                prefixes.setdefault(tuple(codes[:n]), -1)
            prefixes[tuple(codes)] = i
        self.longest = max(map(len, prefixes), default=0)
        hashes = np.array([self._hash(codes) for codes in prefixes], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.piece = hashes[order], np.array(list(prefixes.values()), np.int64)[order]
        self.seen = np.zeros(1 << 22, np.bool_)
        self.seen[(hashes >> np.uint64(42)).astype(np.int64)] = True

    @classmethod
    def of_model(cls, model: bytes) -> Vocabulary:
        """The pieces of a model file that can be in a word, the start mark only in front."""
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        ids = [i for i in ids if "▁" not in m.id_to_piece(i)[1:]]
        return cls([m.id_to_piece(i) for i in ids], [-m.get_score(i) for i in ids])

    @staticmethod
    def _turn(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        hashes = (hashes ^ codes) * np.uint64(0x9E3779B97F4A7C15)
        return hashes ^ (hashes >> np.uint64(29))

    def _hash(self, codes) -> int:
        h = np.full(1, 17, np.uint64)
        for c in codes:
            h = self._turn(h, np.uint64(c))
        return int(h[0])

    def matches(self, codes: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and number of every piece in ``codes`` that ends before its word does."""
        at, hashes = np.arange(len(codes)), np.full(len(codes), 17, np.uint64)
        found = [(np.zeros(0, np.int64),) * 3]
        for n in range(self.longest):
            fits = at + n < stop[at]
            at, hashes = at[fits], hashes[fits]
            hashes = self._turn(hashes, codes[at + n])
            maybe = self.seen[(hashes >> np.uint64(42)).astype(np.int64)]
            at, hashes = at[maybe], hashes[maybe]
            where = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            real = self.hashes[where] == hashes
            at, hashes, piece = at[real], hashes[real], self.piece[where[real]]
            whole = piece >= 0
            found.append((at[whole], at[whole] + n + 1, piece[whole]))
        return tuple(np.concatenate(x) for x in zip(*found))


class Lattices:
    """The lattices of some words. Nodes lie between characters; every word has one more."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]) -> None:
        self.vocabulary = vocabulary
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        begin = np.cumsum(sizes) - sizes
        codes = np.empty(sizes.sum(), np.uint64)
        inner = np.ones(len(codes), np.bool_)
        inner[begin] = False
        codes[begin] = START
        codes[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(len(words)), sizes)
        low, high, piece = vocabulary.matches(codes, (begin + sizes)[word])
        # A character without a piece is spelt in bytes.
        bare = np.ones(len(codes), np.bool_)
        bare[low[high == low + 1]] = False
        bare = np.flatnonzero(bare)
        chars, which = np.unique(codes[bare], return_inverse=True)
        self.spelt = [chr(0x2581 if c == START else c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
        low, high = np.append(low, bare), np.append(high, bare + 1)
        piece = np.append(piece, vocabulary.size + 256 + which)
        depth = high - begin[word[low]]
        order = np.lexsort((high, depth))
        low, high, self.edge = low[order], high[order], piece[order]
        own = word[low]
        self.owner, self.left, self.right = own, low + own, high + own
        self.levels = np.append(np.flatnonzero(np.append(True, np.diff(depth[order]) > 0)), len(low)) if len(low) else np.zeros(1, int)
        self.roots, self.leaves = begin + np.arange(len(words)), begin + sizes + np.arange(len(words))
        self.nodes = len(codes) + len(words)

    def _weights(self, scores: np.ndarray) -> np.ndarray:
        """Of every edge: ``scores`` (piece, kind), bytes of a character added up."""
        base = self.vocabulary.size
        spelt = [scores[base + np.frombuffer(s, np.uint8).astype(int)].sum(axis=0) for s in self.spelt]
        return np.concatenate([scores, np.reshape(spelt, (-1, scores.shape[1]))])[self.edge]

    @staticmethod
    def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
        top = np.maximum.reduceat(values, first, axis=0)
        many = np.diff(np.append(first, len(values)))
        return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, many, axis=0)), first, axis=0))

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log of the sum over all ways from the start of a word to each node."""
        alpha = np.zeros((self.nodes, weights.shape[1]))
        for a, b in zip(self.levels[:-1], self.levels[1:]):
            to = self.right[a:b]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            alpha[to[first]] = self._sum(alpha[self.left[a:b]] + weights[a:b], first)
        return alpha

    def totals(self, scores: np.ndarray) -> np.ndarray:
        """Log probability of each word under each kind, over all segmentations."""
        return self.forward(self._weights(scores))[self.leaves]

    def expected(self, scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in ``counts`` (word, kind) of the words."""
        weights = self._weights(scores)
        alpha = self.forward(weights)
        beta = np.zeros_like(alpha)
        depth = self.left - self.roots[self.owner]
        order = np.lexsort((self.left, -depth))
        levels = np.append(np.flatnonzero(np.append(True, np.diff(depth[order]) < 0)), len(order)) if len(order) else [0]
        for a, b in zip(levels[:-1], levels[1:]):
            part = order[a:b]
            at = self.left[part]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            beta[at[first]] = self._sum(beta[self.right[part]] + weights[part], first)
        total = alpha[self.leaves]
        shares = np.exp(alpha[self.left] + weights + beta[self.right] - total[self.owner]) * counts[self.owner]
        size = self.vocabulary.size + 256
        sums = np.stack([np.bincount(self.edge, shares[:, z], size + len(self.spelt)) for z in range(counts.shape[1])], axis=1)
        for i, s in enumerate(self.spelt):
            np.add.at(sums, self.vocabulary.size + np.frombuffer(s, np.uint8).astype(int), sums[size + i])
        return sums[:size]


def _batches(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words, some at a time, words of like length together."""
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    at = 0
    while at < len(order):
        end, size = at, 0
        while end < len(order) and end - at < BATCH and (size < 32 * BATCH or end == at):
            size += len(words[order[end]])
            end += 1
        yield order[at:end], [words[i].decode("utf-8", "replace") for i in order[at:end]]
        at = end


def held_out() -> Column:
    """Rows that nothing is learnt from; a null doc_id is not among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # bytes: A-Z and the six ASCII blanks


def _word_counts(docs: DataFrame, kinds: int) -> DataFrame:
    """``word`` and ``counts`` in training, by kind (all 0: only held-out texts have it)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}

        def summed() -> pa.RecordBatch:
            word = [w for c in held.values() for w in c]
            kind = np.repeat(list(held), list(map(len, held.values()))) if held else []
            n = [x if z >= 0 else 0 for z, c in held.items() for x in c.values()]
            return pa.RecordBatch.from_arrays(
                [pa.array(word, pa.binary()), pa.array(kind, pa.int32()), pa.array(n, pa.int64())], names=["word", "kind", "n"]
            )

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for text, kind in zip(texts, batch.column("kind").to_pylist()):
                held.setdefault(kind, Counter()).update(_split(text.as_py()))
                if sum(map(len, held.values())) > 600_000:
                    yield summed()
                    held = {}
        yield summed()

    kind = F.when(F.col("held_out"), -1).otherwise(F.col("kind")).cast("int").alias("kind")
    sums = [F.sum(F.when(F.col("kind") == z, F.col("n")).otherwise(0)) for z in range(kinds)]
    return (
        docs.select("text", kind)
        .mapInArrow(count, "word binary, kind int, n bigint")
        .groupBy("word")
        .agg(F.array(*sums).alias("counts"))
    )


def _learnt(words: DataFrame, vocabulary: Vocabulary, kinds: int) -> np.ndarray:
    """Log score of every piece in every kind, after some rounds of expected counts."""
    context = words.sparkSession.sparkContext
    known = context.broadcast(vocabulary)
    scores = np.repeat(np.log(vocabulary.prior)[:, None], kinds, axis=1)
    names = [f"v{z}" for z in range(kinds)]
    for _ in range(ROUNDS):
        now = context.broadcast(scores)

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(now.value)
            for batch in batches:
                counts = batch.column("counts").flatten().to_numpy().reshape(-1, kinds).astype(np.float64)
                for places, part in _batches(batch.column("word").to_pylist()):
                    total += Lattices(known.value, part).expected(now.value, counts[places])
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *map(pa.array, total[used].T)], names=["piece", *names])

        found = (
            words.filter(F.exists("counts", lambda n: n > 0))
            .mapInArrow(expect, "piece int, " + ", ".join(f"{n} double" for n in names))
            .groupBy("piece")
            .agg(*[F.sum(n).alias(n) for n in names])
            .toArrow()  # a row per piece of the vocabulary
        )
        sums = PRIOR * np.repeat(vocabulary.prior[:, None], kinds, axis=1)
        sums[found["piece"].to_numpy()] += np.stack([found[n].to_numpy() for n in names], axis=1)
        scores = np.log(sums / sums.sum(axis=0))
    return scores


def score(docs: DataFrame, model: str | None = None, kinds: int = KINDS, head: int = HEAD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, and ``kind``, the language that explains the text best.

    ``model`` is the place of a piece model. Learning reads every text that is not held
    out. Word counts live in a table; the ``head`` commonest words of at most 32 bytes are
    broadcast, the others joined, and the driver sees scores of pieces and languages only.

    Defined cases: a null or empty text has only the end; a null doc_id is not held out; rows
    that are alike count each, in learning too; a null lang is a language of its own, and
    those beyond the ``kinds`` commonest share one; without any text to learn from the
    vocabulary's own weights score. A stretch without blanks is one word, however long.
    """
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    with open(model, "rb") as file:
        vocabulary = Vocabulary.of_model(file.read())
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    docs = docs.withColumn("held_out", held_out())
    by_lang = docs.filter(~F.col("held_out")).groupBy("lang").agg(F.count("*").alias("n"))
    totals = by_lang.agg(F.sum("n").alias("n"), F.count("*").alias("langs")).first()
    common = by_lang.orderBy(F.desc("n"), "lang").limit(kinds).collect()
    names, ends = [r.lang for r in common], [r.n for r in common]
    if totals.langs > len(common) or not common:
        names, ends = [*names, "others" if common else None], [*ends, (totals.n or 0) - sum(ends)]
    z_of = F.lit(len(names) - 1)
    for i, r in enumerate(common):
        z_of = F.when(F.col("lang").eqNullSafe(F.lit(r.lang)), i).otherwise(z_of)
    docs = docs.withColumn("kind", z_of)

    words = stored(_word_counts(docs, len(names)))
    each = [F.sum(F.col("counts")[z]).alias(f"n{z}") for z in range(len(names))]
    each += [F.count_if(F.col("counts")[z] > 0).alias(f"v{z}") for z in range(len(names))]
    sizes = words.agg(*each, F.count_if(F.exists("counts", lambda n: n > 0)).alias("v")).first()
    tokens = np.array([sizes[f"n{z}"] or 0 for z in range(len(names))], np.int64)
    distinct = np.array([sizes[f"v{z}"] for z in range(len(names))], np.int64)
    n_end = sum(ends)
    train_tokens, train_distinct = int(tokens.sum()) + n_end, sizes.v + (n_end > 0)

    pieces = _learnt(words, vocabulary, len(names))
    end = (np.array(ends) + 1) / (tokens + np.array(ends) + 2)
    known, scores = context.broadcast(vocabulary), context.broadcast(pieces)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("counts").flatten().to_numpy().reshape(-1, len(names))
            whole = np.maximum(counts - DISCOUNT, 0) / np.maximum(tokens, 1)
            share = np.where(tokens > 0, DISCOUNT * distinct / np.maximum(tokens, 1), 1.0)
            result = np.empty(counts.shape)
            for places, part in _batches(batch.column("word").to_pylist()):
                below = Lattices(known.value, part).totals(scores.value) + np.log(share)
                with np.errstate(divide="ignore"):
                    result[places] = np.logaddexp(np.log(whole[places]), below) + np.log1p(-end)
            result /= np.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(counts.sum(axis=1)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(result) + 1) * len(names), pa.int32()), pa.array(result.ravel()))],
                names=["word", "c", "s"],
            )

    weighed = stored(words.mapInArrow(weigh, "word binary, c bigint, s array<double>"))
    top = weighed.filter((F.octet_length("word") <= HEAD_BYTES) & (F.col("c") > 0)).orderBy(F.desc("c"), "word").limit(head).toArrow()
    shown = context.broadcast(
        (top["word"].to_pylist(), top["c"].to_numpy(), top["s"].combine_chunks().flatten().to_numpy().reshape(-1, len(names)))
    )
    sums = [f"s{z}" for z in range(len(names))]
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heard, c, s = shown.value
        place = {w: i for i, w in enumerate(heard)}
        logs = np.log10(c + 1.0)
        for batch in batches:
            total, tokens_of, known_of, logs_of, rest = [], [], [], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                found = Counter(_split(text.as_py()))
                at = np.fromiter((place.get(w, -1) for w in found), np.int64, len(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                mine, often = at[at >= 0], n[at >= 0]
                tokens_of.append(n.sum() + 1)
                known_of.append(often.sum())
                logs_of.append(logs[mine] @ often)
                total.append(often @ s[mine])
                rest.append([{"word": w, "n": k} for w, k in found.items() if w not in place])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(tokens_of, pa.int64()), pa.array(known_of, pa.int64()),
                 pa.array(logs_of, pa.float64()), *(pa.array(x, pa.float64()) for x in np.reshape(total, (-1, len(names))).T),
                 pa.array(rest, rest_type)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "logs", *sums, "rest"],
            )

    texts = docs.select("doc_id", "held_out", "text").mapInArrow(
        read,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, "
        + "".join(f"{x} double, " for x in sums)
        + "rest array<struct<word: binary, n: bigint>>",
    )
    texts = stored(texts.withColumn("_row", F.monotonically_increasing_id()))
    rest = (
        texts.select("_row", F.explode("rest").alias("r"))
        .select("_row", "r.word", "r.n")
        .join(weighed, "word")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_known"),
            F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("_logs"),
            *[F.sum(F.col("n") * F.col("s")[z]).alias(f"_{x}") for z, x in enumerate(sums)],
        )
    )
    prior = np.log10((np.array(ends) + 1) / (n_end + len(ends))) + np.log10(end)
    ways = [F.col(x) + F.coalesce(f"_{x}", F.lit(0.0)) + float(p) for x, p in zip(sums, prior)]
    joined = texts.drop("rest").join(rest, "_row", "left").withColumn("_ways", F.array(*ways))
    top_way = F.array_max("_ways")
    at = F.lit(0.0)
    for z in range(len(names)):
        at = at + F.pow(F.lit(10.0), F.col("_ways")[z] - top_way)
    whole = np.log10(float(train_tokens + train_distinct + 1))
    base = F.col("logs") + F.coalesce("_logs", F.lit(0.0)) + float(np.log10(n_end + 1.0)) - F.col("n_tokens") * float(whole)
    best = F.array(*[F.lit(n).cast("string") for n in names])[F.array_position("_ways", top_way).cast("int") - 1]
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0)) + (1 if n_end else 0)).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"),
        (top_way + F.log10(at)).alias("score"), best.alias("kind"),
    )


def op11_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents", "doc_id", "text", "lang"))


QUERIES = {"op11_lattice": op11_lattice}
