"""Sequences filled to target proportions of the sources, by deficit round-robin.

A source is a queue of documents; its tokens go out in portions of fixed size. In every
round a source earns credit in proportion to its target and sends a portion when it has
earned one; what is left, the deficit, goes on to the next round, over all sequences and
partitions. So the n-th portion of a source leaves at the round (n - 1/2) * portion / target,
and the whole schedule is one order over portions: rounds, then sources. Sequences are
cut from it by place, so all but the last are full.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from deskmill.llm.common import process_memory, stored, table, texts_to_python
from deskmill.llm.tokens import Encoder, by_size, tokenizer_text

LENGTH, PORTION, END = 2048, 128, 1
WORDS = 500_000  # that a task remembers


def tokenized(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per document: ``part`` and ``row`` (its place in the scan), doc_id, source, ``n`` and
    ``ids`` (little-endian 32 bit, closed by the end id), and ``ahead``, the tokens of the
    same source before it in the part."""
    shown = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, row = Encoder(shown.value, WORDS), TaskContext.get().partitionId(), 0
        sent: dict[str | None, int] = {}
        end = END.to_bytes(4, "little")
        for rows in by_size(batches, "text"):
            ids = [x + end for x in encoder.encode_column(rows.column("text")).to_pylist()]
            counts = [len(x) // 4 for x in ids]
            ahead = []
            for source, n in zip(rows.column("source").to_pylist(), counts):
                ahead.append(sent.get(source, 0))
                sent[source] = ahead[-1] + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int64()), pa.array(range(row, row + len(ids)), pa.int64()),
                 rows.column("doc_id").cast(pa.int64()), rows.column("source").cast(pa.string()),
                 pa.array(counts, pa.int64()), pa.array(ahead, pa.int64()), pa.array(ids, pa.binary())],
                names=["part", "row", "doc_id", "source", "n", "ahead", "ids"],
            )
            row += len(ids)

    return texts_to_python(docs.select("doc_id", "source", "text")).mapInArrow(
        encode, "part bigint, row bigint, doc_id bigint, source string, n bigint, ahead bigint, ids binary"
    )


def schedule(tokens: DataFrame, targets: dict[str | None, float] | None, length: int, portion: int) -> DataFrame:
    """Pieces (part, row, start, length, sequence_id, offset) of the documents in ``tokens``."""
    sums = tokens.groupBy("source", "part").agg(F.sum("n").alias("_n"))
    queue = Window.partitionBy("source").orderBy("part")
    sums = sums.withColumn("_before", F.sum("_n").over(queue) - F.col("_n")).withColumn(
        "_all", F.sum("_n").over(Window.partitionBy("source"))
    )
    if targets is not None:
        wanted = F.lit(None).cast("double")
        for source, share in targets.items():
            wanted = F.when(F.col("source").eqNullSafe(F.lit(source)), float(share)).otherwise(wanted)
        sums = sums.withColumn("_target", F.coalesce(wanted, F.lit(0.0)))
    else:
        sums = sums.withColumn("_target", F.col("_all").cast("double"))
    sums = sums.select(F.col("source").alias("_s"), F.col("part").alias("_p"), "_before", "_all", "_target")
    lined = tokens.join(
        sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p"))
    ).select("part", "row", "source", "n", "_all", "_target", (F.col("_before") + F.col("ahead")).alias("_at"))
    lined = stored(lined)
    # A portion belongs to the document in which it begins.
    first = F.expr(f"(_at + {portion - 1}) div {portion}")
    last = F.expr(f"(_at + n - 1) div {portion}")
    portions = lined.filter(first <= last).select(
        "source", "_all", "_target", F.explode(F.sequence(first, last)).alias("_i")
    )
    # Sources without a target go last, whole.
    rounds = F.when(F.col("_target") > 0, (F.col("_i") + 0.5) / F.col("_target")).otherwise(F.lit(float("inf")))
    portions = portions.select(
        "source", "_i", F.least(F.lit(portion), F.col("_all") - F.col("_i") * portion).alias("_n"), rounds.alias("_round")
    )
    placed = _in_order(portions)
    spans = lined.select(
        "part", "row", "source", "n", "_at",
        F.explode(F.sequence(F.expr(f"_at div {portion}"), last)).alias("_i"),
    )
    met = spans.alias("d").join(
        placed.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d._i") == F.col("p._i"))
    )
    low = F.greatest(F.col("_at"), F.col("d._i") * portion)
    high = F.least(F.col("_at") + F.col("n"), (F.col("d._i") + 1) * portion)
    runs = met.select(
        "part", "row", (low - F.col("_at")).alias("_lo"), (high - F.col("_at")).alias("_hi"),
        (F.col("_place") + low - F.col("d._i") * portion).alias("_to"),
    )
    end = F.col("_to") + F.col("_hi") - F.col("_lo")
    cut = runs.withColumn("_q", F.explode(F.sequence(F.expr(f"_to div {length}"), F.expr(f"(_to + _hi - _lo - 1) div {length}"))))
    begin = F.greatest("_to", F.col("_q") * length)
    stop = F.least(end, (F.col("_q") + 1) * length)
    return cut.select(
        "part", "row",
        (F.col("_lo") + begin - F.col("_to")).alias("start"), (stop - begin).alias("length"),
        F.col("_q").alias("sequence_id"), (begin - F.col("_q") * length).alias("offset"),
    )


def _in_order(portions: DataFrame) -> DataFrame:
    """``_place``: tokens scheduled before each portion, in the order of round and source.

    Slices of the rounds are range partitions, written once; a window inside a slice and
    one over the sums of the slices give the places.
    """
    order = ["_round", "source", "_i"]
    laid = stored(portions.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = laid.groupBy("_slice").agg(F.sum("_n").alias("_sum"))
    over = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_slice", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_off"))
    return (
        laid.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(sums, "_slice")
        .select("source", "_i", (F.col("_in") + F.col("_off")).alias("_place"))
    )


def pack(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    length: int = LENGTH,
    portion: int = PORTION,
    tokenizer: str | None = None,
) -> DataFrame:
    """All tokens of ``docs`` (doc_id, source, text) in sequences of ``length`` tokens.

    Returns a row per piece: doc_id, source, start, length, ids (32-bit little-endian),
    doc_tokens, sequence_id, offset. ``targets`` are token proportions by source; without
    them, the proportions in ``docs``, so that all queues end together. A source that runs
    dry leaves its share to the others; one without a target comes last.

    Defined cases: a null or empty text has only the end id; rows that are alike, and rows
    with a null doc_id or source, are packed like any others (null is a source of its own);
    no rows give no pieces. Only the last sequence is shorter.
    """
    tokens = stored(tokenized(docs, tokenizer), "zstd")
    pieces = schedule(tokens.drop("ids", "doc_id"), targets, length, portion)
    by_doc = pieces.groupBy(F.col("part").alias("_p"), F.col("row").alias("_r")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces")
    )
    joined = tokens.join(by_doc, (F.col("part") == F.col("_p")) & (F.col("row") == F.col("_r")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_memory(__name__)  # all texts are encoded
        for batch in batches:
            lists = batch.column("pieces")
            flat, counts = lists.flatten(), lists.value_lengths()
            fields = {n: flat.field(n) for n in ("start", "length", "sequence_id", "offset")}
            starts, lengths = fields["start"].to_pylist(), fields["length"].to_pylist()
            taken, owner, at = [], [], 0
            for i, (ids, n) in enumerate(zip(batch.column("ids").to_pylist(), counts.to_pylist())):
                taken += [ids[4 * s : 4 * (s + k)] for s, k in zip(starts[at : at + n], lengths[at : at + n])]
                owner += [i] * n
                at += n
            owner = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("source").take(owner), fields["start"], fields["length"],
                 pa.array(taken, pa.binary()), batch.column("n").take(owner), fields["sequence_id"], fields["offset"]],
                names=["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return joined.select("doc_id", "source", "n", "ids", "pieces").mapInArrow(
        cut,
        "doc_id bigint, source string, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )


def digest(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return digest(pack(table(spark, folder, "documents", "doc_id", "source", "text")))


QUERIES = {"op6_packing": op6_packing}
