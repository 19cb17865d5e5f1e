"""Profiles of raw and normalised rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from deskmill.functions.ratios import count_where
from deskmill.functions.text import is_blank, is_closed
from deskmill.functions.times import month_name, wall_clock
from deskmill.operators.ordered import running_total


def unpivot(one_row: DataFrame, name: str, value: str, columns: Sequence[str]) -> DataFrame:
    """A one-row frame of measures as (name, value) rows."""
    wide = one_row.select(*[F.col(f"`{c}`").cast("bigint").alias(c) for c in columns])
    return wide.unpivot([], [F.col(f"`{c}`") for c in columns], name, value)


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Side by side join of one-row frames of integer measures, by way of long rows."""
    names = [c for part in parts for c in part.columns]
    longs = [unpivot(part, "_name", "_value", part.columns) for part in parts]
    rows = longs[0]
    for other in longs[1:]:
        rows = rows.unionByName(other)
    return rows.agg(*[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in names])


def key_uniqueness(df: DataFrame, key: Column | str) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"), F.count_distinct(key).alias("distinct_keys")
    ).withColumn("duplicate_rows", F.col("row_count") - F.col("distinct_keys"))


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value with a MISSING bucket, most frequent first."""
    counts = df.groupBy(F.coalesce(F.col(column), F.lit("MISSING")).alias("value")).agg(
        F.count("*").alias("row_count")
    )
    ordered = counts.orderBy(F.desc("row_count"), "value")
    return ordered.limit(n) if n else ordered


def top_values(df: DataFrame, fields: Sequence[str], n: int) -> DataFrame:
    """The ``n`` most frequent values of each field with a MISSING bucket, in one pass."""
    shown = df.select(*[F.coalesce(F.col(f), F.lit("MISSING")).alias(f) for f in fields])
    counts = shown.unpivot([], list(fields), "field", "value").groupBy("field", "value").agg(
        F.count("*").alias("row_count")
    )
    order = Window.partitionBy("field").orderBy(F.desc("row_count"), "value")
    return counts.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def missing_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Null or empty values per field, in one pass."""
    totals = df.agg(*[count_where(is_blank(F.col(f"`{f}`"))).alias(f) for f in fields])
    return unpivot(totals, "field", "missing_rows", list(fields))


def observed_fields(df: DataFrame, fields: Sequence[str], required: Sequence[str]) -> DataFrame:
    """For each declared field: was it ever present, and must it be."""
    seen = df.agg(
        *[F.max(F.col(f"`{f}`").isNotNull().cast("int")).alias(f) for f in fields]
    )
    return unpivot(seen, "field", "seen", list(fields)).select(
        "field",
        (F.coalesce("seen", F.lit(0)) == 1).alias("observed"),
        F.col("field").isin(*required).alias("required"),
    )


def _row_issues() -> Column:
    created, closed = wall_clock(F.col("created_date")), wall_clock(F.col("closed_date"))
    has_close = ~is_blank(F.col("closed_date"))
    closed_status = F.coalesce(is_closed(F.col("status")), F.lit(False))
    tests = {
        "missing_key": is_blank(F.col("unique_key")),
        "closed_missing_date": closed_status & ~has_close,
        "nonclosed_with_close_date": ~closed_status & has_close,
        "negative_duration": closed < created,
        "invalid_timestamp": has_close & (closed.isNull() | created.isNull()),
    }
    return F.array_compact(F.array(*[F.when(t, name) for name, t in tests.items()]))


def issue_profile(raw: DataFrame, examples: int = 10) -> DataFrame:
    """Count and first example keys of each issue found in raw rows.

    Occurrences are first counted per (issue, key), so an issue that hits most rows, or
    a key with very many copies, is small before anything is ranked.
    """
    keys = raw.withColumn("key", F.coalesce("unique_key", F.lit("")))
    found = (
        keys.select(F.explode(_row_issues()).alias("issue"), "key")
        .groupBy("issue", "key")
        .agg(F.count("*").alias("times"))
    )
    copies = (
        keys.groupBy("key")
        .agg((F.count("*") - 1).alias("times"))
        .filter("times > 0")
        .select(F.lit("duplicate_key").alias("issue"), "key", "times")
    )
    occurrences = found.unionByName(copies)
    totals = occurrences.groupBy("issue").agg(F.sum("times").alias("row_count"))
    first = Window.partitionBy("issue").orderBy("key")
    shown = (
        occurrences.withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") <= examples)
        .groupBy("issue")
        .agg(F.array_sort(F.collect_list(F.struct("key", "times"))).alias("_top"))
    )
    repeated = F.flatten(
        F.transform(
            "_top", lambda k: F.array_repeat(k["key"], F.least(k["times"], F.lit(examples)).cast("int"))
        )
    )
    return totals.join(shown, "issue").select(
        "issue", "row_count", F.array_join(F.slice(repeated, 1, examples), ",").alias("example_keys")
    )


def exact_percentiles(
    df: DataFrame, column: str, fractions: dict[str, float], scale: float = 1.0
) -> DataFrame:
    """Exact interpolated percentiles of an integer column, in one row.

    Values are counted, ranked by a running total over ordered slices and picked by
    position, so no task ever holds all values.
    """
    histogram = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ranked = running_total(histogram, [], [column], F.col("n"), "upto")
    placed = ranked.withColumn("total", ranked.agg(F.max("upto")).scalar())

    def at(position: Column) -> Column:
        inside = (F.col("upto") - F.col("n") <= position) & (position < F.col("upto"))
        return F.max(F.when(inside, F.col(column)))

    picks, finals = [], []
    for name, p in fractions.items():
        exact = (F.col("total") - 1) * F.lit(p)
        low = F.floor(exact)
        high = F.least(low + 1, F.col("total") - 1)
        picks += [
            at(low).alias(f"{name}_lo"),
            at(high).alias(f"{name}_hi"),
            F.max(exact - low).alias(f"{name}_part"),
        ]
        lo, hi, part = (F.col(f"{name}_{s}").cast("double") for s in ("lo", "hi", "part"))
        finals.append(F.round((lo + (hi - lo) * part) / F.lit(scale), 6).alias(name))
    return placed.agg(F.coalesce(F.max("total"), F.lit(0)).alias("value_count"), *picks).select(
        "value_count", *finals
    )


def approximate_percentiles(
    df: DataFrame, column: Column, fractions: dict[str, float], error: float = 0.001
) -> DataFrame:
    """Percentiles from mergeable sketches with a bounded rank error, in one pass."""
    wanted = F.array(*[F.lit(p) for p in fractions.values()])
    sketch = df.agg(F.percentile_approx(column, wanted, F.lit(int(1 / error))).alias("_q"))
    return sketch.select(
        *[F.round(F.col("_q")[i], 3).alias(name) for i, name in enumerate(fractions)]
    )


SKETCH_SIZE, SKETCH_ERROR = 800, 0.01  # rank error: 0.4 % with 99 % confidence at this size


def quantile_sketches(df: DataFrame, value: Column, *by: Column | str) -> DataFrame:
    """A mergeable quantile sketch of ``value`` per group: ``sketch`` and ``value_count``."""
    return df.groupBy(*by).agg(
        F.kll_sketch_agg_double(value.cast("double"), F.lit(SKETCH_SIZE)).alias("sketch"), F.count(value).alias("value_count")
    )


def merged_quantiles(sketches: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """``fraction``, ``value``: quantiles of all values behind the sketches, which are merged;
    the values themselves are not read."""
    whole = sketches.agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("s"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("fraction"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("value")) for p in fractions])
    return whole.select(F.inline(wanted))


def rank_check(df: DataFrame, column: str, quantiles: DataFrame, error: float = SKETCH_ERROR) -> DataFrame:
    """Whether each of a few quantiles (fraction, value) has its rank in ``column`` up to ``error``."""
    found = quantiles.collect()  # a row per fraction asked
    counts = [
        x.alias(f"{side}{i}")
        for i, q in enumerate(found)
        for side, x in (("lo", F.count_if(F.col(column) < q.value)), ("hi", F.count_if(F.col(column) <= q.value)))
    ]
    one = df.agg(F.count(column).alias("value_count"), *counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(q.fraction).alias("fraction"), "value_count",
                ((F.col(f"lo{i}") / F.col("value_count") <= q.fraction + error)
                 & (F.col(f"hi{i}") / F.col("value_count") >= q.fraction - error)).alias("within_error"),
            )
            for i, q in enumerate(found)
        ]
    )
    return one.select(F.inline(rows))


def counts_by_month_and_flag(df: DataFrame) -> DataFrame:
    """Rows per created month and per quality flag, in one pass: ``kind``, ``name``, ``row_count``."""
    month = F.struct(F.lit("month").alias("kind"), month_name(F.col("created_date")).alias("name"))
    flags = F.transform("quality_flags", lambda f: F.struct(F.lit("flag").alias("kind"), f.alias("name")))
    marks = F.concat(F.array(month), F.coalesce(flags, F.array().cast("array<struct<kind: string, name: string>>")))
    return df.select(F.inline(marks)).groupBy("kind", "name").agg(F.count("*").alias("row_count"))


def update_instants(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The most frequent update instants, and how many distinct ones there are."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    distinct = counts.agg(F.count("*")).scalar()
    return counts.orderBy(F.desc("row_count"), column).limit(n).withColumn("distinct_instants", distinct)
