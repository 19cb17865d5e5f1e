"""Sources mixed to target weights, block by block.

The words of a source, in an order set by hashes, are cut into fixed blocks. An output
shard has a fixed number of slots, and how many of them each source has is drawn from a
multinomial, given the sums over all shards. The slots of a source walk through a
pseudorandom permutation of its block numbers, one pass after the other. Blocks and slots
meet by source and number.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from deskmill.llm.common import WORD, let, n_words, running_start, stored, table

BLOCK = 64  # words
SLOTS = 1 << 14  # of an output shard, about a million words
CELLS = 4096  # of the row of slots that the sources share
MOST = 3  # times that a source may be taken
SEED = 11

# Primes, of which one that does not divide a number of blocks spreads it.
PRIMES = [1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121]


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source (null last): ``source_size`` and ``target``, weights 1, 2, 3 in turn.

    The targets share all words by weight and stop at ``MOST`` times the source, where the
    rest is shared anew. So a target is the smaller of the limit and weight times a level;
    sources reach their limit in the order of limit over weight, which gives the level in
    one pass over the sources (a row each).
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("_w", (F.row_number().over(order) - 1) % 3 + 1).withColumn("_cap", MOST * F.col("source_size"))
    by_limit = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    all_ = Window.partitionBy(F.lit(0))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weight = F.sum("_w").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("_level", left / weight)
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level"))
    per = per.withColumn("_reach", F.max(fits).over(all_))
    return per.select(
        "source",
        "source_size",
        F.least(F.col("_cap").cast("double"), F.col("_w") * F.coalesce("_reach", F.lit(0.0))).alias("target"),
    )


def plan_mix(sized: DataFrame, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """What a mix takes of ``sized`` (doc_id, source, size and more columns).

    First result: its rows with ``source_size``, ``target``, ``taken`` (words, repeats
    counted) and ``takes`` (word ranges of the row with how often each is taken).
    Second result: the slots with shard, place in the shard, source and block.

    All slots are put in a random order, in which the sources have ranges of the lengths of
    their targets. So the counts of a shard are a multinomial draw under the condition that
    the counts of all shards add up to the targets: shards differ as in independent draws,
    and a source is off by one slot at most in all, however small it is.

    Defined cases: rows without words are taken 0 times; rows that are alike share one
    place in the order and are taken one after the other; no words at all give targets of 0.
    The result depends on the rows alone, not on how they are partitioned.
    """
    targets = stored(source_targets(sized))
    placed = running_start(
        sized, ["source"], "size", F.xxhash64("doc_id", "size", F.lit(seed)), "_start", ["doc_id", "size"]
    )
    placed = stored(
        placed.alias("d")
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("d.*", "t.source_size", "t.target")
    )
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    wanted = F.col("target") / F.col("source_size") * F.col("_blocks")
    shares = (
        targets.filter("source_size > 0 AND target > 0")
        .withColumn("_blocks", blocks)
        .withColumn("_wanted", wanted)
        .withColumn("_end", F.round(F.sum("_wanted").over(order)).cast("bigint"))
        .withColumn("_begin", F.coalesce(F.lag("_end").over(order), F.lit(0)))
        .withColumn("_number", F.row_number().over(order))
    )
    shares = stored(shares.select("source", "_number", "_blocks", "_begin", "_end"))
    total = shares.agg(F.max("_end")).first()[0] or 0
    slot = sized.sparkSession.range(total).select(F.col("id").alias("slot"), F.lit(1).alias("_one"))
    ranked = running_start(slot, [], "_one", F.xxhash64("slot", F.lit(seed)), "_rank", ["slot"])
    cells = shares.filter("_begin < _end").withColumn(
        "_cell", F.explode(F.expr(f"sequence(_begin * {CELLS} div {total or 1}, (_end - 1) * {CELLS} div {total or 1})"))
    )
    numbered = (
        ranked.withColumn("_cell", F.expr(f"_rank * {CELLS} div {total or 1}"))
        .join(cells, "_cell")
        .filter("_begin <= _rank AND _rank < _end")
        .withColumns({"shard": F.expr(f"slot div {slots}"), "_j": F.col("slot") % slots, "_k": F.col("_rank") - F.col("_begin")})
        .filter(F.col("_k") < MOST * F.col("_blocks"))
    )
    turn = F.expr("_k div _blocks")
    begin = F.pmod(F.xxhash64("_number", turn, F.lit(seed)), F.lit(len(PRIMES)))
    usable = [F.when(F.col("_blocks") % p != 0, F.lit(p)) for p in PRIMES]
    prime = F.coalesce(*[F.get(F.filter(F.array(*usable), lambda x: x.isNotNull()), (begin + i) % len(PRIMES)) for i in range(len(PRIMES))])
    shift = F.pmod(F.xxhash64(turn, "_number", F.lit(seed + 1)), F.col("_blocks"))
    picked = numbered.withColumn("block", (F.col("_k") % F.col("_blocks") * prime + shift) % F.col("_blocks"))
    picked = stored(picked.select("shard", F.col("_j").alias("place"), "source", "_number", "block"))

    times = picked.groupBy("source", "block").agg(F.count("*").alias("_times"))
    spans = placed.filter("size > 0").select(
        F.col("source").alias("_s"),
        F.col("_start"),
        "size",
        F.explode(F.sequence(F.expr(f"_start div {block}"), F.expr(f"(_start + size - 1) div {block}"))).alias("_b"),
    )
    low = F.greatest("_start", F.col("_b") * block) - F.col("_start")
    high = F.least(F.col("_start") + F.col("size"), (F.col("_b") + 1) * block) - F.col("_start")
    met = spans.join(times, F.col("_s").eqNullSafe(F.col("source")) & (F.col("_b") == F.col("block")))
    takes = met.groupBy("_s", "_start").agg(
        F.sum((high - low) * F.col("_times")).alias("taken"),
        F.sort_array(F.collect_list(F.struct(low.alias("lo"), high.alias("hi"), F.col("_times").alias("times")))).alias("takes"),
    )
    p, t = placed.alias("p"), takes.alias("t")
    same = F.col("p.source").eqNullSafe(F.col("t._s")) & (F.col("p._start") == F.col("t._start")) & (F.col("p.size") > 0)
    result = p.join(t, same, "left").select(
        *[F.col(f"p.`{c}`") for c in placed.columns if c != "_start"],
        F.coalesce("t.taken", F.lit(0)).cast("bigint").alias("taken"),
        "t.takes",
    )
    return result, picked


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source, n_chars and more) as the mix takes them.

    A row comes back once for every time that any of it is taken, with the words taken at
    least so often; a row that is taken whole keeps its text unchanged. n_chars follows.
    """
    names = docs.columns
    kept = stored(docs.withColumns({"_row": F.monotonically_increasing_id(), "_size": n_words(F.col("text"))}), "zstd")
    sized = kept.select("_row", "doc_id", "source", F.col("_size").alias("size"))
    plan = plan_mix(sized, block, seed=seed)[0].filter("taken > 0").select("_row", F.col("takes").alias("_takes"))
    copies = kept.join(plan, "_row").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.array_max(F.col("_takes.times"))))
    )
    parts = F.filter("_takes", lambda t: t["times"] >= F.col("_copy"))
    words = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, t: n + t["hi"] - t["lo"])
    units = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = let(
        units,
        lambda u: F.array_join(
            F.flatten(F.transform(parts, lambda t: F.slice(u, (t["lo"] + 1).cast("int"), (t["hi"] - t["lo"]).cast("int")))), ""
        ),
    )
    text = F.when(words == F.col("_size"), F.col("text")).otherwise(cut)
    done = copies.withColumn("text", text)
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.length("text").cast("bigint"))
    return done.select(*[F.col(f"`{n}`") for n in names])


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "source")
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    return plan_mix(sized)[0].select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op8_mixing": op8_mixing}
