"""Queries on summaries, serving aggregates and current tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.operators import marts, serving
from deskmill.operators.governance import reconciliation_gaps as gaps
from deskmill.plans import frames, layers
from deskmill.plans.oracle import over_runs, over_tickets
from deskmill.sources.tables import table

ACTIVE = frames.ACTIVE_RELEASE


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_status(frames.current(spark, folder), F.lit(ACTIVE))


def _active(spark: SparkSession, serving_rows: DataFrame) -> DataFrame:
    return marts.active_only(serving_rows, frames.releases(spark))


def dws_created_daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_summary(frames.current(spark, folder))


def ads_daily_status(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder)


def ads_agency_status(spark: SparkSession, folder: str) -> DataFrame:
    return marts.agency_status(frames.current(spark, folder), F.lit(ACTIVE))


def ads_complaint(spark: SparkSession, folder: str) -> DataFrame:
    return marts.complaint_counts(frames.current(spark, folder), F.lit(ACTIVE))


def _maintained(table: str):
    """The serving table after run 2, from that of run 1 and the changes of run 2."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        stored, moved = layers.served_after_run_1(spark, folder, table), layers.changes(spark, folder)
        return marts.maintained(stored, moved, table, F.lit(2))

    return query


def q3_daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_trend(frames.current(spark, folder))


def q3_daily_trend_ads(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, layers.daily_status(spark, folder))
    return marts.resum(rows, "created_day").orderBy("created_day")


def q4_top_complaints(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, layers.complaint_counts(spark, folder)).select("complaint_type", "ticket_count")
    return marts.top_by_count(rows, "complaint_type", 20)


def q8_agency_borough(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, layers.agency_status(spark, folder))
    return rows.select("agency", "borough", "status", "ticket_count").orderBy(
        F.desc("ticket_count"), "agency", "borough", "status"
    )


def active_release_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Serving rows of two releases, of which only the active one is shown."""
    return _active(spark, layers.daily_status_of_runs(spark, folder))


def monthly_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, layers.daily_status(spark, folder))
    return marts.resum(rows, F.month("created_day").cast("bigint").alias("month")).orderBy("month")


def monthly_relative(spark: SparkSession, folder: str) -> DataFrame:
    return marts.relative_to_max(monthly_totals(spark, folder))


def status_share(spark: SparkSession, folder: str) -> DataFrame:
    rows = _active(spark, layers.daily_status(spark, folder))
    return marts.with_share(marts.resum(rows, "status"))


def detail_vs_ads_equal(spark: SparkSession, folder: str) -> DataFrame:
    now = frames.current(spark, folder)
    detail = now.groupBy(marts.created_day(), "status").agg(F.count("*").alias("ticket_count"))
    summary = marts.resum(marts.daily_summary(now), "created_day", "status")
    return marts.compare_results(detail, summary)


def key_bucket_of(spark: SparkSession, key: str | None) -> int | None:
    """Bucket of one key, so that the plan names it."""
    return spark.range(1).select(layers.key_bucket(F.lit(key))).first()[0]


def q1_point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The row of the smallest key. The key column alone is scanned for it; the lookup then
    opens one bucket."""
    rows = layers.by_key(spark, folder)
    key = rows.agg(F.min("unique_key")).first()[0]
    found = rows.filter((F.col("unique_key") == key) & (F.col("key_bucket") == key_bucket_of(spark, key)))
    return found.select("unique_key", "status", "agency")


def q2_cursor_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = layers.detail(spark, folder).filter(
        (F.col("agency") == "BUILDING") & (F.upper("status") == "OPEN")
    )
    rows = rows.filter(serving.months_upto("2001-01-01") & serving.before_cursor("2001-01-01", "999999999"))
    page = serving.newest_first_page(rows, 100)
    return page.select("unique_key", "created_date", "complaint_type", "status")


def q5_closed_duration(spark: SparkSession, folder: str) -> DataFrame:
    return serving.mean_close_seconds(layers.detail(spark, folder))


def q6_active_age(spark: SparkSession, folder: str) -> DataFrame:
    return serving.active_age(layers.detail(spark, folder), frames.AGE_REFERENCE)


def agency_status_range_count(spark: SparkSession, folder: str) -> DataFrame:
    months = serving.months_upto("1999-01-01") & ~serving.months_upto("1997-12-31")
    return serving.count_in_range(
        layers.detail(spark, folder).filter(months), "MACHINERY", "Open", "1998-01-01", "1999-01-01"
    )


def keyset_extract_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder).filter(
        (F.col("created_date") >= frames.day("1998-03-01")) & (F.col("created_date") < frames.day("1998-04-01"))
    )
    ties = ("source_updated_at", "content_hash_hex")
    page = serving.oldest_first_page(rows.filter(serving.after_cursor("1998-03-10", "5")), 100, *ties)
    return page.select("unique_key", "created_date", "status", "source_updated_at")


_LAYERS = ["PROMO", "ECONOMY", "STANDARD", "MEDIUM", "LARGE"]


def asset_search(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return serving.search(parts, " ring ", "ECONOMY", ["p_name", "p_brand"], "p_type").select(
        "p_partkey", "p_name", "p_brand", "p_type"
    )


def offset_page(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    found = serving.search(parts, "", "STANDARD", ["p_name"], "p_type")
    return serving.offset_page(found, ["p_name", "p_partkey"], 2, 25)


def custom_rank_order(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    return serving.in_rank_order(parts, "p_type", _LAYERS, "p_partkey")


def reconciliation_gaps(spark: SparkSession, folder: str) -> DataFrame:
    now, before = layers.detail(spark, folder), layers.after_run_1(spark, folder)
    return gaps(now, marts.daily_summary(now), before)


QUERIES = {
    "q3_daily_trend": q3_daily_trend,
    "dws_created_daily": dws_created_daily,
    "ads_daily_status": ads_daily_status,
    "ads_agency_status": ads_agency_status,
    "ads_complaint": ads_complaint,
    **{f"{name}_maintained": _maintained(name) for name in marts.SERVING},
    "q3_daily_trend_ads": q3_daily_trend_ads,
    "q4_top_complaints": q4_top_complaints,
    "q8_agency_borough": q8_agency_borough,
    "active_release_scope": active_release_scope,
    "monthly_totals": monthly_totals,
    "monthly_relative": monthly_relative,
    "status_share": status_share,
    "detail_vs_ads_equal": detail_vs_ads_equal,
    "q1_point_lookup": q1_point_lookup,
    "q2_cursor_page": q2_cursor_page,
    "q5_closed_duration": q5_closed_duration,
    "q6_active_age": q6_active_age,
    "agency_status_range_count": agency_status_range_count,
    "keyset_extract_page": keyset_extract_page,
    "asset_search": asset_search,
    "offset_page": offset_page,
    "custom_rank_order": custom_rank_order,
    "reconciliation_gaps": reconciliation_gaps,
}

_DAY = "cast(created_date AS date) AS created_day"
_MONTHS = "SELECT month(created_date) AS month, count(*) AS ticket_count FROM cur GROUP BY 1"

# Current tickets after both runs, with all columns.
_BOTH = """, joint AS (
  SELECT * FROM run2 UNION ALL
  SELECT * FROM run1 o WHERE NOT EXISTS (SELECT 1 FROM run2 n WHERE n.unique_key = o.unique_key)
)"""

ORACLE = {
    "ads_daily_status_maintained": over_runs(
        f"SELECT 2::bigint AS release_id, {_DAY}, status, count(*) AS ticket_count FROM joint GROUP BY ALL", _BOTH
    ),
    "ads_agency_status_maintained": over_runs(
        "SELECT 2::bigint AS release_id, agency, borough, status, count(*) AS ticket_count FROM joint GROUP BY ALL", _BOTH
    ),
    "ads_complaint_maintained": over_runs(
        "SELECT 2::bigint AS release_id, complaint_type, count(*) AS ticket_count FROM joint GROUP BY ALL", _BOTH
    ),
    "q3_daily_trend": over_tickets(f"SELECT {_DAY}, count(*) AS ticket_count FROM cur GROUP BY 1"),
    "dws_created_daily": over_tickets(
        f"SELECT {_DAY}, agency, borough, status, count(*) AS ticket_count FROM cur GROUP BY ALL"
    ),
    "ads_daily_status": over_tickets(
        f"SELECT 2::bigint AS release_id, {_DAY}, status, count(*) AS ticket_count FROM cur GROUP BY ALL"
    ),
    "ads_agency_status": over_tickets(
        """SELECT 2::bigint AS release_id, agency, borough, status, count(*) AS ticket_count
FROM cur GROUP BY ALL"""
    ),
    "ads_complaint": over_tickets(
        "SELECT 2::bigint AS release_id, complaint_type, count(*) AS ticket_count FROM cur GROUP BY ALL"
    ),
    "q3_daily_trend_ads": over_tickets(f"SELECT {_DAY}, count(*) AS ticket_count FROM cur GROUP BY 1"),
    "q4_top_complaints": over_tickets(
        """SELECT complaint_type, count(*) AS ticket_count FROM cur
GROUP BY 1 ORDER BY ticket_count DESC, complaint_type LIMIT 20"""
    ),
    "q8_agency_borough": over_tickets(
        "SELECT agency, borough, status, count(*) AS ticket_count FROM cur GROUP BY ALL"
    ),
    "active_release_scope": over_runs(
        f"""SELECT 2::bigint AS release_id, {_DAY}, status, count(*) AS ticket_count
FROM merged GROUP BY ALL"""
    ),
    "monthly_totals": over_tickets(_MONTHS),
    "monthly_relative": over_tickets(
        f"""SELECT month, ticket_count, round(ticket_count / max(ticket_count) OVER () * 100, 6) AS percent_of_max
FROM ({_MONTHS})"""
    ),
    "status_share": over_tickets(
        """SELECT status, count(*) AS ticket_count,
  round(count(*) / (SELECT count(*) FROM cur), 6) AS share FROM cur GROUP BY status"""
    ),
    "detail_vs_ads_equal": over_tickets(
        """SELECT count(*) AS left_rows, count(*) AS right_rows, 0::bigint AS only_left,
  0::bigint AS only_right, true AS same_result
FROM (SELECT DISTINCT cast(created_date AS date), status FROM cur)"""
    ),
    "q1_point_lookup": over_tickets(
        """SELECT unique_key, status, agency FROM cur
WHERE unique_key = (SELECT min(unique_key) FROM cur)"""
    ),
    "q2_cursor_page": over_tickets(
        """SELECT unique_key, created_date, complaint_type, status FROM cur
WHERE agency = 'BUILDING' AND upper(status) = 'OPEN'
  AND (created_date < timestamp '2001-01-01'
    OR (created_date = timestamp '2001-01-01' AND unique_key < '999999999'))
ORDER BY created_date DESC, unique_key DESC LIMIT 100"""
    ),
    "q5_closed_duration": over_tickets(
        """SELECT agency, round(avg(datesub('second', created_date, closed_date)), 4) AS avg_seconds
FROM cur WHERE upper(status) = 'CLOSED' AND closed_date >= created_date GROUP BY agency"""
    ),
    "q6_active_age": over_tickets(
        """SELECT agency, count(*) AS active_count,
  round(avg(datesub('hour', created_date, timestamp '2002-01-01')), 4) AS avg_age_hours
FROM cur WHERE upper(status) <> 'CLOSED' GROUP BY agency"""
    ),
    "agency_status_range_count": over_tickets(
        """SELECT count(*) AS ticket_count FROM cur
WHERE agency = 'MACHINERY' AND upper(status) = 'OPEN'
  AND created_date >= timestamp '1998-01-01' AND created_date < timestamp '1999-01-01'"""
    ),
    "keyset_extract_page": over_tickets(
        """SELECT unique_key, created_date, status, source_updated_at FROM enr
WHERE created_date >= timestamp '1998-03-01' AND created_date < timestamp '1998-04-01'
  AND (created_date > timestamp '1998-03-10'
    OR (created_date = timestamp '1998-03-10' AND unique_key > '5'))
ORDER BY created_date, unique_key, source_updated_at, content_hash_hex LIMIT 100"""
    ),
    "asset_search": """SELECT p_partkey, p_name, p_brand, p_type FROM part
WHERE (p_name LIKE '%ring%' OR p_brand LIKE '%ring%') AND p_type = 'ECONOMY'""",
    "offset_page": """SELECT p_partkey, p_name, p_type, count(*) OVER () AS total FROM part
WHERE p_type = 'STANDARD' ORDER BY p_name, p_partkey LIMIT 25 OFFSET 50""",
    "custom_rank_order": f"""SELECT p_partkey, p_name, p_type,
  coalesce(list_position({_LAYERS}, p_type), 0)::integer AS rank FROM part""",
    "reconciliation_gaps": over_runs(
        """SELECT d AS dwd_rows, s AS dws_record_count, d AS dws_ticket_count, c AS mysql_current_rows,
  0::bigint AS dws_reconciliation_gap, abs(d - c) AS mysql_reconciliation_gap
FROM (SELECT (SELECT count(*) FROM cur) AS d, (SELECT count(*) FROM run1) AS c,
  (SELECT count(*) FROM (SELECT DISTINCT cast(created_date AS date), agency, borough, status FROM cur)) AS s)"""
    ),
}
