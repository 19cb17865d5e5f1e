"""Queries on raw, normalised and current tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskmill.functions.quality import is_rejected
from deskmill.functions.ratios import count_where
from deskmill.functions.times import elapsed, local_clock, month_name, wall_clock
from deskmill.operators import profile, serving
from deskmill.operators.governance import quality_metrics
from deskmill.operators.marts import daily_summary
from deskmill.operators.normalize import split_rejects
from deskmill.plans import frames, layers
from deskmill.plans.oracle import over_tickets
from deskmill.schema import LOCAL_ZONE, RAW_FIELDS, REQUIRED_FIELDS
from deskmill.sources.raw import storage_projection
from deskmill.sources.tables import table
from deskmill.sources.tickets import raw_tickets

_FLAT = [
    "unique_key", "source_updated_at", "created_date", "closed_date", "agency", "agency_name",
    "complaint_type", "descriptor", "location_type", "incident_zip", "status", "due_date",
    "resolution_action_updated_date", "community_board", "council_district",
    "police_precinct", "borough", "open_data_channel_type",
]


def _flags() -> Column:
    return F.array_join("quality_flags", ",").alias("quality_flags")


def normalize_tickets(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder)
    return rows.select(
        *_FLAT,
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("created_year").cast("bigint").alias("created_year"),
        F.col("created_month").cast("bigint").alias("created_month"),
    )


def instant_to_wall_clock(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder)
    at = F.col("source_updated_at")
    return rows.select("unique_key", "source_updated_at", local_clock(at, LOCAL_ZONE).alias("local_time"))


def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    return frames.enriched(spark, folder).select("unique_key", "created_date", "status", _flags())


def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return frames.enriched(spark, folder).select("unique_key", "content_hash_hex")


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    rejected = split_rejects(frames.enriched(spark, folder))[1]
    return rejected.select("unique_key", "created_date", "agency", "status", _flags())


def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    return frames.current(spark, folder).select(
        "unique_key", "source_updated_at", "status", "closed_date", "content_hash_hex"
    )


def key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    tickets = profile.key_uniqueness(frames.valid(spark, folder), "unique_key")
    line = F.struct("l_orderkey", "l_linenumber")
    lines = profile.key_uniqueness(table(spark, folder, "lineitem"), line)
    return tickets.select(F.lit("tickets").alias("table_name"), "*").unionByName(
        lines.select(F.lit("lineitem").alias("table_name"), "*")
    )


def dq_metrics(spark: SparkSession, folder: str) -> DataFrame:
    layers = {"normalised": frames.enriched(spark, folder), "current": frames.current(spark, folder)}
    rows = [
        quality_metrics(df, frames.SCOPE_YEAR).select(F.lit(name).alias("layer"), "*")
        for name, df in layers.items()
    ]
    return rows[0].unionByName(rows[1])


def flag_histogram(spark: SparkSession, folder: str) -> DataFrame:
    flags = layers.detail(spark, folder).select(F.explode("quality_flags").alias("flag"))
    return flags.groupBy("flag").agg(F.count("*").alias("row_count"))


def flagged_rows(spark: SparkSession, folder: str) -> DataFrame:
    return layers.detail(spark, folder).agg(
        F.count("*").alias("row_count"),
        count_where(F.size("quality_flags") > 0).alias("flagged_rows"),
    )


def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a run: one pass over the parsed rows, one over the stored detail."""
    rows, now = frames.enriched(spark, folder), layers.detail(spark, folder)
    bad = is_rejected()
    return profile.one_row(
        [
            rows.agg(
                F.count("*").alias("source_rows"),
                count_where(bad).alias("rejected_rows"),
                F.count_distinct(F.when(~bad, F.col("unique_key"))).alias("distinct_keys"),
            ),
            now.agg(
                F.count("*").alias("current_rows"),
                count_where(F.size("quality_flags") > 0).alias("flagged_rows"),
                F.count_distinct("created_year", "created_month").alias("months"),
            ),
            daily_summary(now).agg(F.count("*").alias("dws_rows")),
        ]
    )


def run_report_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.counts_by_month_and_flag(layers.detail(spark, folder))


def current_month_counts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        layers.detail(spark, folder)
        .groupBy(
            F.col("created_year").cast("bigint").alias("created_year"),
            F.col("created_month").cast("bigint").alias("created_month"),
        )
        .agg(F.count("*").alias("row_count"))
    )


def pruned_month_status(spark: SparkSession, folder: str) -> DataFrame:
    month = layers.detail(spark, folder).filter("created_year = 1998 AND created_month = 1")
    return month.groupBy("status").agg(F.count("*").alias("row_count"))


def source_extent(spark: SparkSession, folder: str) -> DataFrame:
    created = wall_clock(F.col("created_date"))
    return raw_tickets(spark, folder).agg(
        F.count("*").alias("row_count"), F.min(created).alias("earliest"), F.max(created).alias("latest")
    )


def month_counts(spark: SparkSession, folder: str) -> DataFrame:
    created = wall_clock(F.col("created_date"))
    months = (
        raw_tickets(spark, folder)
        .select(month_name(created).alias("month"))
        .filter("month IS NOT NULL")
        .groupBy("month")
        .agg(F.count("*").alias("n"))
    )
    totals = months.rollup("month").agg(F.sum("n").alias("row_count"))
    return totals.select(F.coalesce("month", F.lit("TOTAL")).alias("month"), "row_count")


def _window(column: str, start: str, end: str):
    return (F.col(column) >= frames.day(start)) & (F.col(column) < frames.day(end))


_SAMPLE = ["unique_key", "created_date", "closed_date", "agency", "status", "borough"]
_TIES = ["source_updated_at"]


def created_window_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder)
    tests = [_window("created_date", "1999-03-01", "1999-03-08")]
    return serving.bounded_sample(rows, tests, ["created_date", "unique_key", *_TIES], 5000).select(
        *_SAMPLE, "source_updated_at"
    )


def old_requests_recently_closed(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder)
    tests = [
        F.col("created_date") < frames.day("1999-03-01"),
        _window("closed_date", "1999-03-01", "1999-03-08"),
    ]
    return serving.bounded_sample(rows, tests, ["closed_date", "unique_key", *_TIES], 30).select(
        *_SAMPLE, "source_updated_at"
    )


def updated_old_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder)
    tests = [
        F.col("source_updated_at") >= frames.day("1999-03-01"),
        F.col("created_date") < frames.day("1999-03-01"),
    ]
    return serving.bounded_sample(rows, tests, ["source_updated_at", "unique_key"], 20).select(
        *_SAMPLE, "source_updated_at"
    )


def cohort_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder)
    tests = [_window("created_date", "1999-03-01", "1999-03-02"), F.col("borough") == "ASIA"]
    return serving.bounded_sample(rows, tests, ["created_date", "unique_key", *_TIES], 5000).select(
        *_SAMPLE, "source_updated_at"
    )


def cohort_count_check(spark: SparkSession, folder: str) -> DataFrame:
    """What the source has in the cohort's day against the rows the bounded extract brought."""
    raw = raw_tickets(spark, folder)
    counted = raw.filter(
        F.col("created_date").startswith("1999-03-01") & (F.upper(F.trim("borough")) == "ASIA")
    )
    loaded = cohort_rows(spark, folder)
    sides = profile.one_row(
        [counted.agg(F.count("*").alias("api_count")), loaded.agg(F.count("*").alias("downloaded"))]
    )
    return sides.withColumn("matches", F.col("api_count") == F.col("downloaded"))


def recent_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder).filter(_window("created_date", "1999-03-01", "1999-03-08"))
    return profile.value_counts(rows, "status").withColumnRenamed("value", "status")


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(
        raw_tickets(spark, folder), ("status", "agency", "borough", "open_data_channel_type"), 15
    )


_MISSING = ["closed_date", "due_date", "resolution_action_updated_date", "created_date", "unique_key", "borough", "latitude"]


def missing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_counts(raw_tickets(spark, folder), _MISSING)


def observed_fields(spark: SparkSession, folder: str) -> DataFrame:
    return profile.observed_fields(raw_tickets(spark, folder), RAW_FIELDS, REQUIRED_FIELDS)


def issue_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.issue_profile(raw_tickets(spark, folder))


def update_instants(spark: SparkSession, folder: str) -> DataFrame:
    return profile.update_instants(frames.enriched(spark, folder), "source_updated_at")


_FRACTIONS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}


def _durations(spark: SparkSession, folder: str) -> DataFrame:
    closed = layers.detail(spark, folder).filter(
        (F.upper("status") == "CLOSED") & (F.col("closed_date") >= F.col("created_date"))
    )
    return closed.select(elapsed("SECOND", F.col("created_date"), F.col("closed_date")).alias("seconds"))


def duration_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return profile.exact_percentiles(_durations(spark, folder), "seconds", _FRACTIONS, 3600.0)


def duration_quantiles_approx(spark: SparkSession, folder: str) -> DataFrame:
    hours = F.col("seconds") / 3600.0
    return profile.approximate_percentiles(_durations(spark, folder), hours, _FRACTIONS)


_SKETCHED = (1996, 1998)  # years of which the quantiles are asked


def quantiles_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of some years, merged from a stored sketch per month; one pass over the
    values of those years tells whether their ranks are as near as the sketch promises."""
    years = F.col("created_year").between(*_SKETCHED)
    found = profile.merged_quantiles(layers.duration_sketches(spark, folder).filter(years), list(_FRACTIONS.values()))
    closed = layers.detail(spark, folder).filter(years & layers.closed_in_order())
    seconds = closed.select(elapsed("SECOND", F.col("created_date"), F.col("closed_date")).alias("seconds"))
    return profile.rank_check(seconds, "seconds", found)


def storage_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return storage_projection(raw_tickets(spark, folder).drop("observation"))


def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Every scalar function family of the warehouse, over all orders."""
    o = table(spark, folder, "orders")
    at = F.col("o_orderdate")
    ref = frames.day("2000-01-01")
    return o.select(
        "o_orderkey",
        F.upper(F.trim(F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")))).alias("upper_trim"),
        F.concat_ws("|", F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("joined"),
        F.replace("o_orderpriority", F.lit("-"), F.lit("_")).alias("replaced"),
        F.left("o_orderpriority", F.lit(3)).alias("left3"),
        F.col("o_orderpriority").contains("HIGH").alias("has_high"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("day_text"),
        (F.year(at) * 10000 + F.month(at) * 100 + F.dayofweek(at)).cast("bigint").alias("year_month_dow"),
        elapsed("SECOND", at, ref).alias("seconds_to_ref"),
        elapsed("HOUR", at, ref).alias("hours_to_ref"),
        F.round(F.sin(F.month(at) / F.lit(6.0)), 9).alias("month_sin"),
        F.round(F.abs(F.col("o_totalprice") - 250000.0), 4).alias("price_gap"),
        F.coalesce(
            F.try_divide(F.col("o_orderkey") % 7, F.col("o_orderkey") % 3), F.lit(0.0)
        ).alias("guarded_ratio"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("key_sha256"),
        F.hex(F.unhex(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))).alias("hex_round_trip"),
        F.when(F.col("o_totalprice").between(100000, 200000), "mid").otherwise("other").alias("price_class"),
        F.coalesce(
            F.array_position(F.array(F.lit("O"), F.lit("F"), F.lit("P")), F.col("o_orderstatus")), F.lit(0)
        ).alias("status_rank"),
        F.size(F.array_compact(F.array("o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))))).cast("bigint").alias("present"),
    )


QUERIES = {
    "normalize_tickets": normalize_tickets,
    "instant_to_wall_clock": instant_to_wall_clock,
    "quality_flags": quality_flags,
    "content_hash": content_hash,
    "rejected_rows": rejected_rows,
    "dedupe_latest": dedupe_latest,
    "key_uniqueness": key_uniqueness,
    "dq_metrics": dq_metrics,
    "flag_histogram": flag_histogram,
    "flagged_rows": flagged_rows,
    "run_report": run_report,
    "run_report_counts": run_report_counts,
    "quantiles_from_sketches": quantiles_from_sketches,
    "current_month_counts": current_month_counts,
    "pruned_month_status": pruned_month_status,
    "source_extent": source_extent,
    "month_counts": month_counts,
    "created_window_sample": created_window_sample,
    "old_requests_recently_closed": old_requests_recently_closed,
    "updated_old_rows": updated_old_rows,
    "cohort_rows": cohort_rows,
    "cohort_count_check": cohort_count_check,
    "recent_status": recent_status,
    "value_counts": value_counts,
    "missing_counts": missing_counts,
    "observed_fields": observed_fields,
    "issue_profile": issue_profile,
    "update_instants": update_instants,
    "duration_percentiles": duration_percentiles,
    "duration_quantiles_approx": duration_quantiles_approx,
    "storage_projection": storage_estimate,
    "scalar_functions": scalar_functions,
}


def _metric_sql(source: str, layer: str) -> str:
    return f"""SELECT '{layer}' AS layer, count(*) AS dwd_row_count,
  count(*) FILTER (unique_key IS NULL OR trim(unique_key) = '') AS missing_key,
  count(*) FILTER (created_date IS NULL OR agency IS NULL OR trim(agency) = ''
    OR complaint_type IS NULL OR trim(complaint_type) = '' OR status IS NULL OR trim(status) = '')
    AS required_field_null_rows,
  count(*) FILTER (year(created_date) <> 1998) AS year_out_of_scope_rows,
  count(*) FILTER ((latitude IS NULL) <> (longitude IS NULL)) AS coordinate_pair_mismatch_rows,
  count(*) FILTER ((latitude IS NOT NULL AND NOT latitude BETWEEN -90 AND 90)
    OR (longitude IS NOT NULL AND NOT longitude BETWEEN -180 AND 180)) AS coordinate_out_of_range_rows,
  count(*) FILTER (closed_date < created_date) AS negative_duration_rows,
  count(*) FILTER (upper(status) = 'CLOSED' AND closed_date IS NULL) AS closed_without_date_rows,
  count(*) - count(DISTINCT unique_key) AS duplicate_key_rows
FROM {source}"""


_SAMPLE_SQL = "unique_key, created_date, closed_date, agency, status, borough, source_updated_at"

_TOP_VALUES = "\nUNION ALL\n".join(
    f"""(SELECT '{f}' AS field, coalesce({f}, 'MISSING') AS value, count(*) AS row_count
 FROM fx GROUP BY 2 ORDER BY row_count DESC, value LIMIT 15)"""
    for f in ("status", "agency", "borough", "open_data_channel_type")
)


def _missing_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, count(*) FILTER ({f} IS NULL OR {f} = '') AS missing_rows FROM fx"
        for f in _MISSING
    )


def _observed_sql() -> str:
    def one(field: str) -> str:
        source = "updated_at" if field == ":updated_at" else field
        need = "true" if field in REQUIRED_FIELDS else "false"
        return f"SELECT '{field}' AS field, count({source}) > 0 AS observed, {need} AS required FROM fx"

    return "\nUNION ALL\n".join(one(f) for f in RAW_FIELDS)


def _storage_sql() -> str:
    sources = ["updated_at" if f == ":updated_at" else f for f in RAW_FIELDS]
    value = " + ".join(
        f"coalesce({len(name) + 5} + octet_length(encode({src})), 0)" for name, src in zip(RAW_FIELDS, sources)
    )
    present = " + ".join(f"(CASE WHEN {src} IS NULL THEN 0 ELSE 1 END)" for src in sources)
    return f"""SELECT count(*) AS row_count, round(avg(b), 2) AS bytes_per_row,
  cast(sum(b) AS bigint) AS projected_bytes
FROM (SELECT 3 + {value} + ({present}) - 1 AS b FROM fx)"""


ORACLE = {
    "normalize_tickets": over_tickets(
        f"""SELECT {", ".join(_FLAT)}, cast(latitude AS double) AS latitude,
  cast(longitude AS double) AS longitude, created_year, created_month FROM enr"""
    ),
    "instant_to_wall_clock": over_tickets(
        f"""SELECT unique_key, source_updated_at,
  timezone('{LOCAL_ZONE}', timezone('UTC', source_updated_at)) AS local_time FROM enr"""
    ),
    "quality_flags": over_tickets("SELECT unique_key, created_date, status, quality_flags FROM enr"),
    "content_hash": over_tickets("SELECT unique_key, content_hash_hex FROM enr"),
    "rejected_rows": over_tickets(
        "SELECT unique_key, created_date, agency, status, quality_flags FROM rejected"
    ),
    "dedupe_latest": over_tickets(
        "SELECT unique_key, source_updated_at, status, closed_date, content_hash_hex FROM cur"
    ),
    "key_uniqueness": over_tickets(
        """SELECT 'tickets' AS table_name, count(*) AS row_count,
  count(DISTINCT unique_key) AS distinct_keys, count(*) - count(DISTINCT unique_key) AS duplicate_rows
FROM valid
UNION ALL
SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)),
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"""
    ),
    "dq_metrics": over_tickets(
        _metric_sql("enr", "normalised") + "\nUNION ALL\n" + _metric_sql("cur", "current")
    ),
    "flag_histogram": over_tickets(
        """SELECT flag, count(*) AS row_count
FROM (SELECT unnest(string_split(quality_flags, ',')) AS flag FROM cur WHERE quality_flags <> '')
GROUP BY flag"""
    ),
    "flagged_rows": over_tickets(
        "SELECT count(*) AS row_count, count(*) FILTER (quality_flags <> '') AS flagged_rows FROM cur"
    ),
    "run_report": over_tickets(
        """SELECT (SELECT count(*) FROM fx) AS source_rows, (SELECT count(*) FROM rejected) AS rejected_rows,
  (SELECT count(DISTINCT unique_key) FROM valid) AS distinct_keys,
  (SELECT count(*) FROM cur) AS current_rows,
  (SELECT count(*) FROM cur WHERE quality_flags <> '') AS flagged_rows,
  (SELECT count(DISTINCT (created_year, created_month)) FROM cur) AS months,
  (SELECT count(*) FROM (SELECT DISTINCT cast(created_date AS date), agency, borough, status FROM cur)) AS dws_rows"""
    ),
    "run_report_counts": over_tickets(
        """SELECT 'month' AS kind, strftime(created_date, '%Y-%m') AS name, count(*) AS row_count FROM cur GROUP BY 2
UNION ALL
SELECT 'flag', flag, count(*) FROM (SELECT unnest(string_split(quality_flags, ',')) AS flag FROM cur WHERE quality_flags <> '')
GROUP BY flag"""
    ),
    "quantiles_from_sketches": over_tickets(
        f"""SELECT f AS fraction, (SELECT count(*) FROM d) AS value_count,
  (SELECT count(*) FILTER (s < q) / count(*) FROM d) <= f + {profile.SKETCH_ERROR}
    AND (SELECT count(*) FILTER (s <= q) / count(*) FROM d) >= f - {profile.SKETCH_ERROR} AS within_error
FROM ({" UNION ALL ".join(f"SELECT {p}::double AS f, quantile_disc(s, {p}) AS q FROM d" for p in _FRACTIONS.values())})""",
        f""", d AS (
  SELECT datesub('second', created_date, closed_date) AS s FROM cur
  WHERE upper(status) = 'CLOSED' AND closed_date >= created_date AND created_year BETWEEN {_SKETCHED[0]} AND {_SKETCHED[1]}
)""",
    ),
    "current_month_counts": over_tickets(
        "SELECT created_year, created_month, count(*) AS row_count FROM cur GROUP BY ALL"
    ),
    "pruned_month_status": over_tickets(
        """SELECT status, count(*) AS row_count FROM cur
WHERE created_year = 1998 AND created_month = 1 GROUP BY status"""
    ),
    "source_extent": over_tickets(
        "SELECT count(*) AS row_count, min(created_date) AS earliest, max(created_date) AS latest FROM norm"
    ),
    "month_counts": over_tickets(
        """SELECT strftime(created_date, '%Y-%m') AS month, count(*) AS row_count
FROM norm WHERE created_date IS NOT NULL GROUP BY 1
UNION ALL
SELECT 'TOTAL', count(*) FROM norm WHERE created_date IS NOT NULL"""
    ),
    "created_window_sample": over_tickets(
        f"""SELECT {_SAMPLE_SQL} FROM enr
WHERE created_date >= timestamp '1999-03-01' AND created_date < timestamp '1999-03-08'
ORDER BY created_date, unique_key, source_updated_at LIMIT 5000"""
    ),
    "old_requests_recently_closed": over_tickets(
        f"""SELECT {_SAMPLE_SQL} FROM enr
WHERE created_date < timestamp '1999-03-01' AND closed_date >= timestamp '1999-03-01'
  AND closed_date < timestamp '1999-03-08'
ORDER BY closed_date, unique_key, source_updated_at LIMIT 30"""
    ),
    "updated_old_rows": over_tickets(
        f"""SELECT {_SAMPLE_SQL} FROM enr
WHERE source_updated_at >= timestamp '1999-03-01' AND created_date < timestamp '1999-03-01'
ORDER BY source_updated_at, unique_key LIMIT 20"""
    ),
    "cohort_rows": over_tickets(
        f"""SELECT {_SAMPLE_SQL} FROM enr
WHERE created_date >= timestamp '1999-03-01' AND created_date < timestamp '1999-03-02' AND borough = 'ASIA'
ORDER BY created_date, unique_key, source_updated_at LIMIT 5000"""
    ),
    "cohort_count_check": over_tickets(
        """SELECT a AS api_count, d AS downloaded, a = d AS matches FROM (SELECT
  (SELECT count(*) FROM fx WHERE created_date LIKE '1999-03-01%' AND upper(trim(borough)) = 'ASIA') AS a,
  (SELECT count(*) FROM (FROM enr WHERE created_date >= timestamp '1999-03-01'
     AND created_date < timestamp '1999-03-02' AND borough = 'ASIA' LIMIT 5000)) AS d)"""
    ),
    "recent_status": over_tickets(
        """SELECT coalesce(status, 'MISSING') AS status, count(*) AS row_count FROM enr
WHERE created_date >= timestamp '1999-03-01' AND created_date < timestamp '1999-03-08' GROUP BY 1"""
    ),
    "value_counts": over_tickets(_TOP_VALUES),
    "missing_counts": over_tickets(_missing_sql()),
    "observed_fields": over_tickets(_observed_sql()),
    "issue_profile": over_tickets(
        """SELECT issue, count(*) AS row_count,
  string_agg(key, ',' ORDER BY k) FILTER (k <= 10) AS example_keys FROM n GROUP BY issue""",
        """, r AS (SELECT coalesce(unique_key, '') AS key, status, closed_date AS closed_raw,
    try_cast(replace(created_date, 'T', ' ') AS timestamp) AS created,
    try_cast(replace(closed_date, 'T', ' ') AS timestamp) AS closed,
    coalesce(closed_date, '') <> '' AS has_close, coalesce(upper(status) = 'CLOSED', false) AS is_closed
  FROM fx), i AS (
  SELECT 'missing_key' AS issue, key FROM r WHERE key = ''
  UNION ALL SELECT 'closed_missing_date', key FROM r WHERE is_closed AND NOT has_close
  UNION ALL SELECT 'nonclosed_with_close_date', key FROM r WHERE NOT is_closed AND has_close
  UNION ALL SELECT 'negative_duration', key FROM r WHERE closed < created
  UNION ALL SELECT 'invalid_timestamp', key FROM r WHERE has_close AND (closed IS NULL OR created IS NULL)
  UNION ALL SELECT 'duplicate_key', key FROM (
    SELECT key, row_number() OVER (PARTITION BY key) AS n FROM r) WHERE n > 1
), n AS (SELECT issue, key, row_number() OVER (PARTITION BY issue ORDER BY key) AS k FROM i)""",
    ),
    "update_instants": over_tickets(
        """SELECT source_updated_at, count(*) AS row_count,
  (SELECT count(DISTINCT source_updated_at) FROM enr) AS distinct_instants
FROM enr WHERE source_updated_at IS NOT NULL GROUP BY 1 ORDER BY row_count DESC, source_updated_at LIMIT 5"""
    ),
    "duration_percentiles": over_tickets(
        "SELECT count(*) AS value_count, "
        + ", ".join(f"round(quantile_cont(s, {p}) / 3600.0, 6) AS {n}" for n, p in _FRACTIONS.items())
        + """ FROM (SELECT datesub('second', created_date, closed_date) AS s FROM cur
WHERE upper(status) = 'CLOSED' AND closed_date >= created_date)"""
    ),
    "storage_projection": over_tickets(_storage_sql()),
    "scalar_functions": """SELECT o_orderkey,
  upper(trim('  ' || o_orderpriority || ' ')) AS upper_trim,
  concat_ws('|', nullif(o_orderstatus, 'P'), o_orderpriority) AS joined,
  replace(o_orderpriority, '-', '_') AS replaced,
  left(o_orderpriority, 3) AS left3,
  contains(o_orderpriority, 'HIGH') AS has_high,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day_text,
  year(o_orderdate) * 10000 + month(o_orderdate) * 100 + dayofweek(o_orderdate) + 1 AS year_month_dow,
  datesub('second', o_orderdate, timestamp '2000-01-01') AS seconds_to_ref,
  datesub('hour', o_orderdate, timestamp '2000-01-01') AS hours_to_ref,
  round(sin(month(o_orderdate) / 6.0), 9) AS month_sin,
  round(abs(o_totalprice - 250000.0), 4) AS price_gap,
  CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE (o_orderkey % 7)::double / (o_orderkey % 3) END AS guarded_ratio,
  sha256(cast(o_orderkey AS varchar)) AS key_sha256,
  hex(unhex(lpad(cast(o_orderkey AS varchar), 12, '0'))) AS hex_round_trip,
  CASE WHEN o_totalprice BETWEEN 100000 AND 200000 THEN 'mid' ELSE 'other' END AS price_class,
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 0 END::bigint AS status_rank,
  (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END)::bigint AS present
FROM orders""",
}
