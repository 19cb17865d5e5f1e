"""Quality rules: text statistics, and robust outliers per language and source.

Everything is DataFrame expressions. The outlier test is a minimum covariance determinant:
the part of a group that lies closest together gives mean and covariance, so that junk
cannot widen the measure it is judged by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskmill.llm.common import WHITE_SPACE, WORD, let, stored, table, without

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
POSITION_BITS = 24


def _repeated(words: Column, size: int = 3) -> Column:
    """Words in windows of ``size`` words that occur twice or more, the first included.

    Hashes with their positions behind them are sorted as plain numbers, so that equal
    windows become neighbours; windows whose shortened hashes meet are compared again in
    full before they count.
    """
    last = F.size(words) - size
    narrow = F.lit(-(1 << POSITION_BITS)).cast("bigint")

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(size)])

    starts = F.sequence(F.lit(0), last)
    packed = F.sort_array(
        F.coalesce(F.transform(starts, lambda i: window_hash(i).bitwiseAND(narrow).bitwiseOR(i.cast("bigint"))), F.array().cast("array<bigint>"))
    )

    def neighbours(rows: Column, same) -> Column:
        """Members of sorted ``rows`` that agree with the one before or after."""
        return F.filter(
            rows,
            lambda x, j: F.coalesce(same(F.get(rows, j - 1), x), F.lit(False)) | F.coalesce(same(F.get(rows, j + 1), x), F.lit(False)),
        )

    def candidates(rows: Column) -> Column:
        hits = neighbours(rows, lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS))
        return F.transform(hits, lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1).cast("bigint")).cast("int"))

    def full(i: Column) -> Column:
        return F.struct(F.slice(words, i + 1, size).alias("w"), i.alias("i"))

    short = let(packed, candidates)
    # More words than positions fit: compare all windows in full.
    chosen = F.when(F.size(words) <= 1 << POSITION_BITS, short).otherwise(starts)

    def covered(rows: Column) -> Column:
        hits = neighbours(rows, lambda a, b: a["w"] == b["w"])
        at = F.array_sort(F.transform(hits, lambda x: x["i"]))
        return let(
            at,
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(size), F.coalesce(x - F.get(p, j - 1), F.lit(size)))),
                F.lit(0).cast("bigint"),
                lambda s, x: s + x,
            ),
        )

    return F.when(last < 1, F.lit(0).cast("bigint")).otherwise(
        let(F.sort_array(F.transform(chosen, full)), covered)
    )


def statistics(text: Column) -> dict[str, Column]:
    """The five counts of a text; a null text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    solid = F.translate(text, WHITE_SPACE, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE_SPACE, "") != "")
    return {
        "n_words": F.regexp_count(text, F.lit(WORD)).cast("bigint"),
        "word_chars": F.length(solid).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), _repeated),
    }


# Transformed statistics: expression, and the least spread that each is granted. Most texts
# have no symbols or repeats at all; without it a single one would be infinitely far out.
FEATURES = {
    "_length": ("ln(1 + n_words)", 0.25),
    "_word_length": ("word_chars / _n", 0.10),
    "_symbols": ("ln(1 + n_symbols / _n)", 0.02),
    "_dup_lines": ("ln(1 + 100 * n_dup_lines / _n)", 0.30),
    "_repeats": ("sqrt(n_repeat_words / _n)", 0.15),
}
CORE = 0.75  # part of a group that must lie close together
STARTS = 3  # estimates that a group starts from; the smallest determinant wins
STEPS, SETTLED = 12, 1e-3  # most concentration steps; a smaller fall of any logarithm ends them
SEED = 5
LEAST_ROWS = 60  # passing rows of a group with estimates of its own
CUTOFF = 64.0  # squared distance; five normal values exceed it less than once in 100 billion rows
# Fixed value: five normal values inside their closest 75 % vary less, by this factor.
CONSISTENCY = 1.41


def _groups(rows: DataFrame) -> DataFrame:
    """Per language and source: ``_g``, the level whose estimate its rows read, and
    ``_levels``, all levels whose estimates they enter.

    A level is the pair, its language, or all; a row reads the first that has enough passing
    rows, and enters each of its levels that any row reads.
    """
    passing = F.count_if(~F.col("base_failed"))
    pairs = stored(rows.groupBy("lang", "source").agg(passing.alias("_rows")))
    langs = stored(pairs.groupBy("lang").agg(F.sum("_rows").alias("_in_lang"), F.min("_rows").alias("_least")))
    rest = not langs.filter(F.col("_in_lang") < LEAST_ROWS).isEmpty()
    named = pairs.join(langs.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")))
    own, in_lang = F.col("_rows") >= LEAST_ROWS, F.col("_in_lang") >= LEAST_ROWS
    pair, lang, every = F.to_json(F.array("lang", "source")), F.to_json(F.array("lang")), F.lit("all")
    levels = F.array(F.when(own, pair), F.when(in_lang & (F.col("_least") < LEAST_ROWS), lang), F.when(F.lit(rest), every))
    return named.select(
        F.col("lang").alias("_l"),
        F.col("source").alias("_s"),
        F.when(own, pair).when(in_lang, lang).otherwise(every).alias("_g"),
        F.array_compact(levels).alias("_levels"),
    )


def _factor(moments: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean and Cholesky factor of each group, from sums over its core."""
    n = F.col("_k")
    rows = moments.select("_g", "_k", *[(F.col(f"s_{a}") / n).alias(f"m_{a}") for a in names], *[
        (F.col(f"s_{a}_{b}") / n).alias(f"p_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]
    ])
    floors = {a: FEATURES[a][1] ** 2 for a in names}
    for i, a in enumerate(names):
        for j, b in enumerate(names[: i + 1]):
            value = CONSISTENCY * (F.col(f"p_{a}_{b}") - F.col(f"m_{a}") * F.col(f"m_{b}"))
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + F.lit(floors[a])
            for c in names[:j]:
                value = value - F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}")
            # Rounding never takes a pivot below the spread that was granted.
            entry = F.sqrt(F.greatest(value, F.lit(floors[a] / 4))) if i == j else value / F.col(f"l_{b}_{b}")
            rows = rows.withColumn(f"l_{a}_{b}", entry)
    volume = sum((F.log(f"l_{a}_{a}") for a in names[1:]), F.log(f"l_{names[0]}_{names[0]}"))
    return rows.select("_g", *_shape(names), volume.alias("_volume"))


def _shape(names: Sequence[str]) -> list[str]:
    """Columns of an estimate: means and the lower triangle of the factor."""
    return [f"m_{a}" for a in names] + [f"l_{a}_{b}" for i, a in enumerate(names) for b in names[: i + 1]]


def _moments(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.groupBy("_g").agg(
        F.count("*").alias("_k"), *[F.sum(a).alias(f"s_{a}") for a in names],
        *[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]],
    )


def _distances(rows: DataFrame, shape: DataFrame, names: Sequence[str]) -> DataFrame:
    """``_d``: squared Mahalanobis distance to the row's group."""
    joined = rows.join(shape, "_g", "left")
    for i, a in enumerate(names):
        value = F.col(a) - F.col(f"m_{a}")
        for b in names[:i]:
            value = value - F.col(f"l_{a}_{b}") * F.col(f"_y_{b}")
        joined = joined.withColumn(f"_y_{a}", value / F.col(f"l_{a}_{a}"))
    squares = [F.col(f"_y_{a}") * F.col(f"_y_{a}") for a in names]
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], sum(squares[1:], squares[0]).alias("_d"))


def outlier_distances(rows: DataFrame) -> DataFrame:
    """``rows`` (the base counts, lang, source, base_failed) with ``_d``.

    A group starts from several estimates: medians and median deviations, and mean and
    covariance of parts of its rows, drawn by hash. Each step takes the closest three
    quarters of the group as its core and measures again from the core's mean and
    covariance, until the determinants fall no further; the start that ends with the
    smallest determinant gives the estimate of the group (ties: the first). Rows that failed
    the base rules have no say. A language, and all, are measured from every row in them,
    those of large sources too. Groups are only summed, and sums are formed before the
    shuffle, so a group may hold any part of the rows.
    """
    names = list(FEATURES)
    of = _groups(rows)
    every = rows.withColumn("_n", F.greatest("n_words", F.lit(1)))
    every = every.withColumns({a: F.expr(x).cast("double") for a, (x, _) in FEATURES.items()}).drop("_n")
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    every = stored(every.join(of, same, "left").drop("_l", "_s"))
    base = every.filter("NOT base_failed").select(F.explode("_levels").alias("_level"), *names)
    part = F.pmod(F.xxhash64(*names, F.lit(SEED)), F.lit(STARTS - 1))
    fit = stored(base.withColumn("_part", part))

    def of_start(rows: DataFrame, start: Column | int) -> DataFrame:
        return rows.withColumn("_g", F.struct(F.col("_level").alias("level"), F.lit(start).cast("int").alias("start")))

    first = of_start(fit, 0)
    middle = stored(first.groupBy("_g").agg(*[F.percentile_approx(a, 0.5).alias(f"m_{a}") for a in names]))
    apart = first.join(middle, "_g").groupBy("_g").agg(
        *[F.max(f"m_{a}").alias(f"m_{a}") for a in names],
        *[F.percentile_approx(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5).alias(f"v_{a}") for a in names],
    )
    spread = {a: F.greatest(1.4826 * F.col(f"v_{a}"), F.lit(FEATURES[a][1])) for a in names}
    robust = apart.select(
        "_g", *[f"m_{a}" for a in names],
        *[(spread[a] if a == b else F.lit(0.0)).alias(f"l_{a}_{b}") for i, a in enumerate(names) for b in names[: i + 1]],
    )
    parts = _factor(_moments(of_start(fit, F.col("_part") + 1), names), names).drop("_volume")
    shape = stored(robust.unionByName(parts))
    # A row meets all starts of its group by the join with their estimates.
    keyed = fit.withColumn("_g", F.explode(F.array(*[F.struct(F.col("_level").alias("level"), F.lit(i).alias("start")) for i in range(STARTS)])))
    volumes = None
    for _ in range(STEPS):
        measured = _distances(keyed.select("_g", *names), shape, names)
        limits = stored(measured.groupBy("_g").agg(F.percentile_approx("_d", CORE).alias("_limit")))
        core = measured.join(limits, "_g").filter("_d <= _limit")
        shape = stored(_factor(_moments(core, names), names))
        before, volumes = volumes, shape.select("_g", "_volume")
        if before is not None:
            fall = before.withColumnRenamed("_volume", "_old").join(volumes, "_g").filter(F.col("_old") - F.col("_volume") > SETTLED)
            if fall.isEmpty():
                break
    shape = shape.groupBy(F.col("_g.level").alias("_g")).agg(
        F.min_by(F.struct(*_shape(names)), F.struct("_volume", "_g.start")).alias("_best")
    )
    shape = stored(shape.select("_g", "_best.*"))
    return _distances(every, shape, names).drop(*names, "_g", "_levels")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` (text, lang, source and more, the text left out) with the five base counts,
    ``base_failed``, ``distance`` and ``kept``; these replace columns of their names.

    Base rules: fewer than 50 words, or more than half of the words in repeated windows.
    What passes is kept unless its squared distance from its language and source exceeds
    ``cutoff``.

    Defined cases: a null or empty text has zero counts and fails; null languages and
    sources are groups of their own; a small group is judged by its language, and that by
    all rows; rows are judged each by its own text, whatever their ids; no rows, no rows.
    """
    docs = without(docs, *BASE, "base_failed", "distance", "kept")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    counted = docs.select(*others, *[c.alias(n) for n, c in statistics(F.col("text")).items()])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = outlier_distances(stored(counted.withColumn("base_failed", failed)))
    near = F.coalesce(F.col("_d") <= cutoff, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & near).withColumnRenamed("_d", "distance")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang", "source")
    return quality_rules(docs).select("doc_id", *BASE, "base_failed", "kept")


QUERIES = {"op9_quality": op9_quality}
