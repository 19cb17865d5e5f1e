"""Alignment of two tokenizers over the same texts, by interval coalescing.

The byte ranges of all tokens of both sides are sorted by start; a running maximum of their
ends tells where a start reaches everything before it, and there a group begins. All pairs
inside a group are links. A corpus-wide table tells in how many documents a pair is linked.

Neither tokenizer joins anything over a single space between two other characters that are
not white space, so both cut there, and texts are aligned stretch by stretch. Stretches (mostly
words) are kept in a bounded memory of the process.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from deskmill.llm.common import stored, table

CUT = re.compile(r"(?<=\S)(?= \S)")
HEAD = 1 << 19  # pairs that the tasks know by heart, 17 bytes each
ROWS, CHARS = 256, 1 << 20  # texts handled at once
SHOWN = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]


def byte_letters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of the group of each interval: overlapping ones share a group."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.empty(len(starts), np.int64)
    group[order] = np.cumsum(np.append(0, starts[order][1:] >= reach[:-1])) if len(order) else 0
    return group


def _expand(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The places ``first``, ``first + 1``, ... of every entry, ``many`` of each."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())


def _counted(*keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct combinations of the keys in order, and how often each comes."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)) if len(order) else np.zeros(0, np.bool_)
    at = np.flatnonzero(new)
    return *[k[at] for k in keys], np.diff(np.append(at, len(order)))


class Aligner:
    """Both tokenizers, and what is known of the stretches seen so far.

    ``numbers`` has per stretch n_a, n_b, n_groups, n_links and whether both sides spell it;
    ``codes`` (a id, then b id in the lower 32 bits) and ``times`` are its distinct linked
    pairs, from ``first`` on.
    """

    def __init__(self, a_json: str, b_model: bytes, most: int = 4_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.most = most
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            if all(c in letters for c in piece):
                self.a_bytes[i] = bytes(letters[c] for c in piece)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_long, self.b_long = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.shown = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((1024, 5), np.int64)
        self.first = np.zeros(1025, np.int64)
        self.codes, self.times = np.zeros(4096, np.int64), np.zeros(4096, np.int64)

    @property
    def weight(self) -> int:
        n = len(self.place)
        return int(self.first[n] + self.numbers[:n, :2].sum())

    def _spelt(self, ids: list[int], table: list[bytes]) -> bytes:
        return b"".join(map(table.__getitem__, ids))

    def _one_by_one(self, stretches: list[str]):
        """Ids of both sides, ids per stretch, and whether both sides spell a stretch."""
        a = [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        b = self.b.encode([s[1:] for s in stretches], num_threads=1)
        good = np.zeros(len(stretches), np.bool_)
        for i, (s, x, y) in enumerate(zip(stretches, a, b)):
            good[i] = self._spelt(x, self.a_bytes) == s.encode() == self._spelt(y, self.b_bytes)
            if not good[i]:
                a[i], b[i] = [], []
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        return ids_a, ids_b, n_a, n_b, good

    def _in_a_row(self, stretches: list[str]):
        """The same for stretches that a cut lies before and behind: they are encoded as one
        text, which both sides cut again where the stretches meet. None if they do not."""
        text = "".join(stretches)
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
        if not self._spelt(a, self.a_bytes) == text.encode() == self._spelt(b, self.b_bytes):
            return None
        ends = np.cumsum([len(s.encode()) for s in stretches])
        counted = []
        for ids, long in ((np.array(a, np.int64), self.a_long), (np.array(b, np.int64), self.b_long)):
            end = np.cumsum(long[ids])
            at = np.searchsorted(end, ends)
            if (end[at] != ends).any():
                return None
            counted.append((ids, np.diff(np.append(-1, at))))
        (ids_a, n_a), (ids_b, n_b) = counted
        return ids_a, ids_b, n_a, n_b, np.ones(len(stretches), np.bool_)

    def _learn(self, stretches: list[str]) -> None:
        row = [s for s in stretches if len(s) > 1 and not s[1].isspace() and not s[-1].isspace()]
        alone = [s for s in stretches if not (len(s) > 1 and not s[1].isspace() and not s[-1].isspace())]
        if row:
            self._keep(row, *(self._in_a_row(row) or self._one_by_one(row)))
        if alone:
            self._keep(alone, *self._one_by_one(alone))

    def _keep(self, stretches: list[str], ids_a, ids_b, n_a, n_b, good) -> None:
        long_a, long_b = self.a_long[ids_a], self.b_long[ids_b]
        end_a, end_b = np.cumsum(long_a), np.cumsum(long_b)  # all stretches in a row: both sides are as long
        group = coalesce(np.concatenate([end_a - long_a, end_b - long_b]), np.concatenate([end_a, end_b]))
        group_a, group_b = group[: len(ids_a)], group[len(ids_a) :]
        own_a = np.repeat(np.arange(len(stretches)), n_a)
        many = int(group.max()) + 1 if len(group) else 0
        owner = np.zeros(many, np.int64)
        owner[group_a] = own_a
        in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
        n_groups = np.bincount(owner, minlength=len(stretches))
        n_links = np.bincount(owner, in_a * in_b, len(stretches)).astype(np.int64)

        # a1,a2|b1;a3|b2 of each stretch
        order = np.lexsort((np.repeat([0, 1], [len(ids_a), len(ids_b)]), group))
        ids, of = np.concatenate([ids_a, ids_b])[order], group[order]
        side = (order >= len(ids_a)).astype(np.int64)
        text_of = owner[of]
        mark = np.zeros(len(ids), np.int64)
        if len(ids):
            mark[:-1] = np.where(text_of[1:] != text_of[:-1], 3, np.where(of[1:] != of[:-1], 2, (side[1:] != side[:-1]).astype(int)))
            mark[-1] = 3
        marks = (",", "|", ";", "\n")
        spelt = "".join(chain.from_iterable(zip(map(self.shown.__getitem__, ids.tolist()), map(marks.__getitem__, mark.tolist()))))
        shown = iter(spelt.split("\n"))
        self.groups += [next(shown) if g and n else "" for g, n in zip(good, n_a)]

        # Distinct pairs: equal tokens of a group are counted first, so long runs stay short.
        g_a, id_a, times_a = _counted(group_a, ids_a)
        g_b, id_b, times_b = _counted(group_b, ids_b)
        in_group = np.bincount(g_b, minlength=many)
        first_b = np.cumsum(in_group) - in_group
        reps = in_group[g_a]
        at = _expand(first_b[g_a], reps)
        codes = np.repeat(id_a << 32, reps) | id_b[at]
        times, whose = np.repeat(times_a, reps) * times_b[at], owner[np.repeat(g_a, reps)]
        order = np.lexsort((codes, whose))
        codes, times, whose = codes[order], times[order], whose[order]
        new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (whose[1:] != whose[:-1]))) if len(codes) else np.zeros(0, np.int64)
        times = np.add.reduceat(times, new) if len(new) else times
        codes, whose = codes[new], whose[new]

        begin, known = len(self.place), int(self.first[len(self.place)])
        while begin + len(stretches) >= len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.first = np.concatenate([self.first, np.zeros(len(self.first) - 1, np.int64)])
        while known + len(codes) > len(self.codes):
            self.codes, self.times = (np.concatenate([x, np.zeros_like(x)]) for x in (self.codes, self.times))
        self.numbers[begin : begin + len(stretches)] = np.stack([n_a, n_b, n_groups, n_links, good], axis=1)
        self.codes[known : known + len(codes)], self.times[known : known + len(codes)] = codes, times
        self.first[begin + 1 : begin + len(stretches) + 1] = known + np.cumsum(np.bincount(whose, minlength=len(stretches)))
        self.place |= {s: begin + i for i, s in enumerate(stretches)}

    def find(self, texts: list[str | None]) -> list[np.ndarray]:
        """Places of the stretches of each text, in order; none for a text that either
        side does not spell."""
        if self.weight > self.most:
            self.forget()
        cut = [CUT.split(" " + t) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.place))
        at = 0
        while at < len(new):
            part, chars = at, 0
            while at < len(new) and at - part < 4096 and chars < CHARS:
                chars += len(new[at])
                at += 1
            self._learn(new[part:at])
        found = [np.fromiter(map(self.place.__getitem__, x), np.int64, len(x)) for x in cut]
        return [x if self.numbers[x, 4].all() else x[:0] for x in found]

    def pairs(self, places: np.ndarray) -> np.ndarray:
        """Positions in ``codes`` of the pairs of the stretches."""
        return _expand(self.first[places], self.first[places + 1] - self.first[places])


_KEPT: dict[int, Aligner] = {}  # of this process: later tasks of a worker go on with it


def _aligner(files: tuple[str, bytes]) -> Aligner:
    key = hash(files)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Aligner(*files)
    return _KEPT[key]


def _handfuls(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts, some at a time, whatever the size of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            ids, texts = (batch.column(c).slice(at, ROWS).to_pylist() for c in ("doc_id", "text"))
            begin = size = 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size > CHARS or i == len(texts) - 1:
                    yield ids[begin : i + 1], texts[begin : i + 1]
                    begin, size = i + 1, 0


def tokenizer_files(a: str | None = None, b: str | None = None) -> tuple[str, bytes]:
    """Both tokenizer files, read by the driver and sent to the tasks."""
    if a is None or b is None:
        import public_tokenizers

        a = a or public_tokenizers.path("byte_bpe_50k.json")
        b = b or public_tokenizers.path("piece_bpe_32k.model")
    with open(a, encoding="utf-8") as x, open(b, "rb") as y:
        return x.read(), y.read()


def linked(docs: DataFrame, files: tuple[str, bytes] | None = None, digest: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, ``groups`` (or its sha256), and
    its distinct linked pairs as 64-bit numbers, a id * 2**32 + b id, with how often each is
    linked: ``pairs`` and ``times`` (little-endian)."""
    shown = docs.sparkSession.sparkContext.broadcast(files or tokenizer_files())
    name = "groups_sha256" if digest else "groups"

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shown.value)
        for ids, texts in _handfuls(batches):
            numbers, groups, pairs, times = [], [], [], []
            for places in aligner.find(texts):
                numbers.append(aligner.numbers[places, :4].sum(axis=0))
                spelt = ";".join(map(aligner.groups.__getitem__, places.tolist()))
                groups.append(hashlib.sha256(spelt.encode()).hexdigest() if digest and spelt else spelt)
                own, often = np.unique(places, return_counts=True)
                at = aligner.pairs(own)
                many = aligner.first[own + 1] - aligner.first[own]
                pair, inverse = np.unique(aligner.codes[at], return_inverse=True)
                weight = aligner.times[at] * np.repeat(often, many)
                pairs.append(pair.astype("<i8").tobytes())
                times.append(np.bincount(inverse, weight, len(pair)).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in np.reshape(numbers, (-1, 4)).T),
                 pa.array(groups, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", name, "pairs", "times"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        link,
        f"doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, {name} string, pairs binary, times binary",
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``docs`` (rows of ``links`` that hold it) and ``best`` (whether no other pair of
    the a id is in more)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "docs"])

        for batch in batches:
            for own in batch.column("pairs").to_pylist():
                held.append(np.frombuffer(own, "<i8"))
                size += len(held[-1])
                if size > 4_000_000:
                    yield summed()
                    held, size = [], 0
        yield summed()

    counted = links.select("pairs").mapInArrow(count, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counted = stored(counted)
    a = F.shiftright("pair", 32)
    # One row per id of a tokenizer's vocabulary.
    top = counted.groupBy(a.alias("_a")).agg(F.max("docs").alias("_top"))
    return stored(
        counted.join(F.broadcast(top), a == F.col("_a")).select("pair", "docs", (F.col("docs") == F.col("_top")).alias("best"))
    )


def align(docs: DataFrame, a: str | None = None, b: str | None = None, digest: bool = False, head: int = HEAD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and ``groups`` (``a1,a2|b1;a3|b2,b3``), or its sha256 with ``digest``.

    ``a`` is the place of a byte-level tokenizer, ``b`` of a piece model. Texts are tokenized
    once; their linked pairs are stored, counted and looked up. The ``head`` commonest pairs
    are broadcast, 17 bytes each; the rest is joined.

    Defined cases: a null or empty text, and one that either tokenizer does not spell byte
    by byte, has no tokens: zeros and ''. Rows of one doc_id, or without one, count as a
    document each; all stretches are aligned whole, however long.
    """
    name = "groups_sha256" if digest else "groups"
    links = stored(linked(docs, tokenizer_files(a, b), digest), "zstd")
    pairs = pair_counts(links)
    top = pairs.orderBy(F.desc("docs"), "pair").limit(head).toArrow().sort_by("pair")
    common = docs.sparkSession.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "docs", "best")))
    rest_type = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs_of, best = common.value
        for batch in batches:
            held = [np.frombuffer(x, "<i8") for x in batch.column("pairs").to_pylist()]
            times = [np.frombuffer(x, "<i8") for x in batch.column("times").to_pylist()]
            many = np.array(list(map(len, held)), np.int64)
            codes, times = np.concatenate([np.zeros(0, np.int64), *held]), np.concatenate([np.zeros(0, np.int64), *times])
            at = np.minimum(np.searchsorted(pair, codes), max(0, len(pair) - 1))
            hit = pair[at] == codes if len(pair) else np.zeros(len(codes), np.bool_)
            each = np.zeros((3, len(codes)), np.int64)
            if len(pair):
                each[0], each[1] = times * hit * best[at], times * hit * docs_of[at]
            each[2] = ~hit
            total = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(each, axis=1)], axis=1)
            edges = np.append(0, np.cumsum(many))
            n_best, count_sum, left = total[:, edges[1:]] - total[:, edges[:-1]]
            flat = pa.StructArray.from_arrays([pa.array(codes[~hit]), pa.array(times[~hit])], names=["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*SHOWN, name)), pa.array(n_best), pa.array(count_sum),
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(left)), pa.int32()), flat, type=rest_type)],
                names=[*SHOWN, name, "n_best", "count_sum", "rest"],
            )

    scored = links.mapInArrow(
        score,
        f"doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, {name} string, "
        "n_best bigint, count_sum bigint, rest array<struct<pair: bigint, times: bigint>>",
    )
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()))
    rest = (
        scored.select("_row", F.explode("rest").alias("r"))
        .select("_row", "r.pair", "r.times")
        .join(pairs, "pair")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
            F.sum(F.col("times") * F.col("docs")).alias("_sum"),
        )
    )
    return scored.join(rest, "_row", "left").select(
        *SHOWN,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), name,
    )


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents", "doc_id", "text"), digest=True)


QUERIES = {"op12_alignment": op12_alignment}
