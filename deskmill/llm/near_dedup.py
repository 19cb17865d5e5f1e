"""Near copies by min-max hashing, with every link confirmed on the full shingle sets.

A permutation gives two values of a signature, its minimum and its maximum, so half as
many hashes are needed. Bands of five values put alike documents into common buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from deskmill.llm.common import process_memory, stored, table, texts_to_python
from deskmill.llm.graph import components

WORDS = 5
BANDS, ROWS = 40, 5  # at 0.75 a link is missed with at most 2 in 100,000, at 0.8 with 1 in 10 million
BITS = 256  # signature values of which one bit each is compared before the full sets
MARKS = ["s0", "s1", "s2", "s3"]
SEED = 20_26
KNOWN = 100_000  # words whose hashes a task remembers
FREQUENT = 16  # sets from which on a hash comes last in the order of the prefix filter


def shingles(text: bytes | None, known: dict[bytes, int], size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > KNOWN:
        known.clear()
    for w in set(words):
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    mixed = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        mixed = (mixed ^ h[i : len(h) - span + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minima of the hashes under all permutations, then their maxima."""
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(len(factors), 2**32 - 1, np.uint32), np.zeros(len(factors), np.uint32)
    for at in range(0, len(small), 512):
        turned = factors[:, None] * small[None, at : at + 512] + shifts[:, None]
        np.minimum(low, turned.min(axis=1), out=low)
        np.maximum(high, turned.max(axis=1), out=high)
    return np.concatenate([low, high])


def banded(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The values of all bands, one band after the other.

    A band takes minima only, or maxima only: an element that changes the minimum of a small
    set leaves its maximum, so the two in one band would fail more often than two minima.
    """
    least, half = -(-bands // 2) * rows, len(values) // 2
    return np.concatenate([values[:least], values[half : half + bands * rows - least]])


def _sketches(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Per document: set size, digest of the set, one 32-bit bucket number per band, and a bit of
    each signature value in four numbers."""
    half = max(-(-bands // 2) * rows, BITS // 2)
    numbers = np.random.default_rng(SEED)
    factors = numbers.integers(0, 2**31, half, np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = numbers.integers(0, 2**32, half, np.uint32)
    mixers = numbers.integers(0, 2**63, rows, np.uint64) * np.uint64(2) + np.uint64(1)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int32())),
         *((name, pa.int64()) for name in MARKS)]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        known: dict[bytes, int] = {}
        number = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            sizes, digests, buckets, marks = [], [], [], []
            for text in batch.column("text").cast(pa.large_binary()):  # one at a time in Python's memory
                hashes = shingles(text.as_py(), known)
                sizes.append(len(hashes))
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                if not len(hashes):
                    buckets.append([])
                    marks.append(np.zeros(len(MARKS), np.int64))
                    continue
                values = signature(hashes, factors, shifts)
                bits = banded(values, BITS, 1) * np.uint32(0x9E3779B1) >> np.uint32(31)
                marks.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
                values = banded(values, bands, rows).astype(np.uint64)
                key = number
                for r in range(rows):
                    key = (key ^ values[r::rows]) * mixers[r]
                    key ^= key >> np.uint64(31)
                buckets.append((key >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int32())), *map(pa.array, np.reshape(marks, (-1, len(MARKS))).T)],
                schema=schema,
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        sketch, "doc_id bigint, n bigint, digest binary, bands array<int>, " + ", ".join(f"{m} bigint" for m in MARKS)
    )


def _alike(x: str, y: str, percent: int) -> Column:
    """Whether so few signature bits differ that the sets can be alike.

    A bit differs with half the distance of the sets; the limit lies 5.5 standard
    deviations above the mean of the least alike pairs wanted: 2 in 100 million are lost.
    """
    p = (100 - percent) / 200
    limit = BITS * p + 5.5 * (BITS * p * (1 - p)) ** 0.5
    differing = [F.bit_count(F.col(f"{x}.{m}").bitwiseXOR(F.col(f"{y}.{m}"))) for m in MARKS]
    return sum(differing[1:], differing[0]) <= int(limit)


def _full_sets(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """``node``, ``hashes``: the full sets of the documents named by ``ends`` (node)."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            sets = [shingles(t.as_py(), known).view(np.int64) for t in texts]
            ends_at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(ends_at), flat)], names=["node", "hashes"]
            )

    return docs.join(ends.distinct(), "node", "left_semi").select("node", "text").mapInArrow(
        full, "node bigint, hashes array<bigint>"
    )


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``percent`` of their union in common."""
    left, right = (
        _full_sets(docs, pairs.select(F.col(x).alias("node"))).select(F.col("node").alias(x), F.col("hashes").alias(f"h{x}"))
        for x in ("a", "b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        for batch in batches:
            good = []
            for x, y in zip(batch.column("ha"), batch.column("hb")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb").mapInArrow(
        compare, "a bigint, b bigint"
    )


def _across(docs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``: documents named in ``parts`` (node, c) of different ``c`` that can be alike.

    A prefix filter, which loses no pair. All hashes have one order, frequent ones last.
    What two alike sets have in common begins at a hash so early in both that the rest of
    either set suffices; only such places are matched, so what a large group shares comes too
    late in those of its sets that have enough of their own. Places meet by hash and class
    of the smaller set's size; those of a hash's main component are not paired with each other.
    """
    hashes = _full_sets(docs, parts.select("node")).select("node", F.explode("hashes").alias("hash"))
    frequent = hashes.groupBy("hash").agg(F.count("*").alias("times")).filter(F.col("times") >= FREQUENT)
    whole = Window.partitionBy("node")
    order = whole.orderBy(F.coalesce("times", F.lit(0)), "hash")
    placed = hashes.join(frequent, "hash", "left").select(
        "node", "hash", F.row_number().over(order).alias("place"), F.count("*").over(whole).alias("n")
    )
    rest = F.col("n") + 1 - F.col("place")
    # reach: the size of the largest other set for which the rest of this one suffices.
    early = placed.filter(100 * rest >= percent * F.col("n")).select(
        "node", "hash", "n", F.expr(f"(n + 1 - place) * {100 + percent} div {percent} - n").alias("reach")
    )
    early = stored(early.join(parts, "node"))
    shared = early.groupBy("hash").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("hash")
    early = stored(early.join(shared, "hash", "left_semi"))

    def size_class(n: Column) -> Column:
        return F.floor(F.log2(n) * 16)

    smaller = early.filter("reach >= n").withColumn("class", size_class(F.col("n")))
    classes = F.sequence(size_class(F.ceil(F.col("n") * percent / 100)), size_class(F.least("n", "reach")))
    larger = early.withColumn("class", F.explode(classes))
    main = (
        smaller.select("hash", "class", "c")
        .unionByName(larger.select("hash", "class", "c"))
        .groupBy("hash", "class", "c")
        .agg(F.count("*").alias("times"))
        .groupBy("hash", "class")
        .agg(F.max_by("c", F.struct("times", "c")).alias("main"), F.count("*").alias("parts"))
        .filter("parts > 1")
        .select("hash", "class", "main")
    )
    main = stored(main)
    smaller, larger = smaller.join(main, ["hash", "class"]), larger.join(main, ["hash", "class"])

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        return (
            x.join(y, (F.col("x.hash") == F.col("y.hash")) & (F.col("x.class") == F.col("y.class")))
            .filter("x.c <> y.c AND (x.n < y.n OR x.n = y.n AND x.node < y.node)")
            .filter("x.reach >= y.n AND y.reach >= x.n")
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        )

    others = met(smaller.filter("c <> main"), larger)
    return others.unionByName(met(smaller.filter("c = main"), larger.filter("c <> main"))).distinct()


def near_dedup(docs: DataFrame, percent: int = 75, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    1. Equal sets are one class, named by its smallest doc_id; only classes go on.
    2. Every class is paired with one class, of the smallest ones in its buckets the one that
       it meets most often. Pairs whose sizes and signature bits allow it are confirmed on
       the full sets; the confirmed links give first components.
    3. Where a bucket still holds several components, the full sets of its classes go through a
       prefix filter across the components, so that no link hides behind the smallest class;
       what passes is confirmed. Groups of true copies are one component by then.
    4. All confirmed links together give the components.

    Defined cases: a null, empty or blank text has no shingles and is linked with nothing;
    rows of one doc_id are judged each by its own text; a null doc_id is linked with nothing, has a null
    component_id and is kept.
    """
    docs = texts_to_python(docs.select("doc_id", "text"))
    sketches = stored(_sketches(docs, bands, rows))
    classes = stored(
        sketches.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n", "bands", *MARKS)).alias("c"))
        .select("digest", F.col("c.doc_id").alias("node"), *[F.col(f"c.{c}").alias(c) for c in ("n", "bands", *MARKS)])
    )
    marks = classes.select("node", *MARKS)
    sizes = classes.select("node", "n")
    members = classes.select("node", F.posexplode("bands").alias("band", "key")).select(
        "node", F.shiftleft(F.col("band").cast("bigint"), 32).bitwiseOR(F.col("key").cast("bigint").bitwiseAND(2**32 - 1)).alias("bucket")
    )

    def sizes_fit(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    buckets = stored(
        members.groupBy("bucket")
        .agg(F.min("node").alias("a"), F.max("node").alias("last"))
        .filter("a < last")
        .select("bucket", "a")
    )
    crowded = stored(members.join(buckets, "bucket"))
    # Of all smallest classes that a class meets, the one that it meets in most bands.
    met = (
        crowded.filter("node > a").groupBy("node", "a").agg(F.count("*").alias("times"))
        .join(sizes, "node")
        .join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        .filter(sizes_fit("n", "na"))
    )
    best = met.groupBy("node").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a"))
    pairs = stored(
        best.select("a", F.col("node").alias("b"))
        .join(marks.alias("x"), F.col("a") == F.col("x.node"))
        .join(marks.alias("y"), F.col("b") == F.col("y.node"))
        .filter(_alike("x", "y", percent))
        .select("a", "b")
    )
    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("node"), "text")
    links = stored(_confirmed(pairs, texts, percent))

    found = components(links)
    named = stored(
        crowded.join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("c"))
    )
    split = (
        named.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("bucket")
    )
    open_ = stored(named.join(split, "bucket", "left_semi").select("node", "c").distinct())
    across = stored(_across(texts, open_, percent).join(pairs, ["a", "b"], "left_anti"))
    if not across.isEmpty():
        more = stored(_confirmed(across, texts, percent))
        if not more.isEmpty():
            found = components(links.unionByName(more))

    by_class = classes.join(found, "node", "left").select(
        "digest", "node", F.coalesce("component", "node").alias("component_id")
    )
    rows_ = sketches.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    usable = F.col("n_shingles") > 0
    named = (
        rows_.filter(usable & F.col("doc_id").isNotNull()).join(by_class, "digest").select("doc_id", "n_shingles", "component_id")
    )
    alone = rows_.filter(~usable | F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return named.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(table(spark, folder, "documents", "doc_id", "text"))


QUERIES = {"op2_near_dedup": op2_near_dedup}
