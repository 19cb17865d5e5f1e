"""Repeated lines across documents, found with two Bloom filters.

One pass builds the filters: bits of keys seen once, and of keys seen again. A second pass
tests every line against the second filter, and only the suspects travel: their full keys
are grouped for the exact answer and the smallest document. A filter may take a single
line for a repeat, never the other way round, so its size is a matter of speed only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.llm.common import WHITE_SPACE, process_memory, stored, table, without

STRIPPED = WHITE_SPACE.encode()
LAST = (1 << 63) - 1
CHUNK = 1 << 15  # words of 64 bits that are merged as one group
BITS_PER_LINE = 16


def line_keys(text: bytes | None, least: int) -> list[bytes]:
    """Key of every line; an empty one where the line is too short to count."""
    found = []
    for line in (text or b"").lower().split(b"\n"):  # bytes: only A-Z change
        key = line.strip(STRIPPED)
        long_enough = len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)
        found.append(key if long_enough else b"")
    return found


def _bits(keys: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and four bits in it of each key."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    mask = np.zeros(len(keys), np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return ((h >> np.uint64(24)) % np.uint64(words)).astype(np.int64), mask


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def repeat_filter(docs: DataFrame, least: int, max_bits: int) -> np.ndarray:
    """The filter of keys seen twice, over all documents.

    A task sends the bits of its own keys, once each; 32 thousand words of the filter
    are merged at a time. The result has at most ``max_bits`` bits.
    """
    lines = docs.agg(F.sum(F.regexp_count("text", F.lit("\n")) + 1)).first()[0] or 0
    bits = 64 * CHUNK
    while bits < min(max_bits, BITS_PER_LINE * lines):
        bits *= 2
    words = bits // 64

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for text in _texts(batch, "text"):
                keys = {k for k in line_keys(text, least) if k}
                if keys:
                    parts.append(_bits(list(keys), words))
        if not parts:
            return
        at, mask = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((mask, at))
        at, mask = at[order], mask[order]
        new = np.r_[True, (at[1:] != at[:-1]) | (mask[1:] != mask[:-1])]
        first = np.flatnonzero(new)
        again = np.diff(np.r_[first, len(at)]) > 1
        at, mask = at[first], mask[first]
        chunk = at // CHUNK
        edges = np.r_[np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]), len(at)]
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": [int(chunk[a]) for a in edges[:-1]],
                "at": [(at[a:b] % CHUNK).astype(np.uint16).tobytes() for a, b in zip(edges, edges[1:])],
                "mask": [mask[a:b].tobytes() for a, b in zip(edges, edges[1:])],
                "again": [again[a:b].tobytes() for a, b in zip(edges, edges[1:])],
            },
            schema=pa.schema([("chunk", pa.int64()), ("at", pa.binary()), ("mask", pa.binary()), ("again", pa.binary())]),
        )

    def merge(rows: pa.Table) -> pa.Table:
        once, twice = np.zeros(CHUNK, np.uint64), np.zeros(CHUNK, np.uint64)
        for row in rows.to_batches():
            for at, mask, again in zip(*(row.column(c).to_pylist() for c in ("at", "mask", "again"))):
                at, mask = np.frombuffer(at, np.uint16), np.frombuffer(mask, np.uint64)
                hit = np.frombuffer(again, np.bool_) | ((once[at] & mask) == mask)
                np.bitwise_or.at(twice, at[hit], mask[hit])
                np.bitwise_or.at(once, at, mask)
        where = np.flatnonzero(twice)
        return pa.table(
            {"chunk": rows["chunk"][:1], "at": [where.astype(np.uint16).tobytes()], "mask": [twice[where].tobytes()]},
            schema=pa.schema([("chunk", pa.int64()), ("at", pa.binary()), ("mask", pa.binary())]),
        )

    marks = docs.select("text").mapInArrow(seen, "chunk bigint, at binary, mask binary, again binary")
    merged = marks.groupBy("chunk").applyInArrow(merge, "chunk bigint, at binary, mask binary")
    twice = np.zeros(words, np.uint64)
    for row in merged.toLocalIterator():  # as many bits as the filter has, not as the corpus
        twice[row.chunk * CHUNK + np.frombuffer(row.at, np.uint16).astype(np.int64)] = np.frombuffer(row.mask, np.uint64)
    return twice


def line_dedup(docs: DataFrame, least: int = 10, max_bits: int = 1 << 30) -> DataFrame:
    """``docs`` (with doc_id, text) with repeated lines taken out of ``text``.

    A key is a line without white space at its ends and with A-Z lower-cased; keys of at
    least ``least`` code points in two documents stay only in the smallest doc_id. Adds
    ``n_lines`` (before) and ``n_dropped``, which replace columns of these names.

    Defined cases: a null or empty text is one empty line and comes out empty; rows of one
    doc_id are one document, so both keep their lines; a null doc_id comes after all
    others; every copy of a line inside the first document stays; no rows in, no rows out.
    The filter is sent to all executors and never has more than ``max_bits`` bits; with
    more lines than it suits, more suspects are grouped, down to a plain grouping of all.
    """
    spark = docs.sparkSession
    docs = without(docs, "n_lines", "n_dropped")
    shown = spark.sparkContext.broadcast(repeat_filter(docs, least, max_bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        twice = shown.value
        for batch in batches:
            owners, found = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), _texts(batch, "text")):
                keys = list({k for k in line_keys(text, least) if k})
                if keys:
                    at, mask = _bits(keys, len(twice))
                    hits = np.flatnonzero((twice[at] & mask) == mask)
                    owners += [doc] * len(hits)
                    found += [keys[i] for i in hits]
            yield pa.RecordBatch.from_pydict(
                {"doc": owners, "key": found}, schema=pa.schema([("doc", pa.int64()), ("key", pa.binary())])
            )

    owner = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    asked = stored(docs.select(owner.alias("doc"), "text").mapInArrow(suspects, "doc bigint, key binary"))
    repeats = stored(
        asked.groupBy("key")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("_last"))
        .filter("first < _last")
        .drop("_last")
    )
    drops = (
        asked.join(repeats, "key")
        .filter("doc <> first")
        .groupBy(F.col("doc").alias("_doc"))
        .agg(F.collect_set("key").alias("_drops"))
    )
    joined = docs.join(drops, owner == F.col("_doc"), "left").drop("_doc")
    names = docs.columns
    out = docs.withColumns({"n_lines": F.lit(0).cast("bigint"), "n_dropped": F.lit(0).cast("bigint")}).schema

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)
        for batch in batches:
            texts, before, gone = [], [], []
            for text, drops in zip(_texts(batch, "text"), batch.column("_drops").to_pylist()):
                lines = (text or b"").split(b"\n")
                if drops:
                    drops = set(drops)
                    kept = [x for x, k in zip(lines, line_keys(text, least)) if not k or k not in drops]
                else:
                    kept = lines
                texts.append(b"\n".join(kept).decode())
                before.append(len(lines))
                gone.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, "n_lines", "n_dropped"],
            )

    return joined.mapInArrow(rebuild, out)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup(table(spark, folder, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op7_line_dedup": op7_line_dedup}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = {
    "op7_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, rn, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM (SELECT *, row_number() OVER () AS rn FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{_UPPER}', '{_LOWER}') AS key FROM lines
), repeats AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first AS gone
  FROM keyed k LEFT JOIN repeats r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, rn
"""
}
