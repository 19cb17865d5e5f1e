"""Queries on load runs, versions, ledgers, pages and releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskmill.functions.times import month_name, wall_clock
from deskmill.operators import pages, release, versions
from deskmill.plans import frames, layers
from deskmill.plans.oracle import over_runs, over_tickets
from deskmill.sources.tables import table
from deskmill.sources.tickets import raw_tickets

PAGE_ROWS = 50


def _run_2() -> Column:
    return F.lit(2).cast("bigint")


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    return versions.classify_changes(layers.run_2(spark, folder), layers.after_run_1(spark, folder))


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    return versions.upsert_current(layers.after_run_1(spark, folder), layers.run_2(spark, folder), _run_2())


def _history(spark: SparkSession, folder: str) -> DataFrame:
    first = frames.history_of(layers.run_1(spark, folder), 1)
    return versions.append_history(first, layers.run_2(spark, folder), _run_2())


def change_classification(spark: SparkSession, folder: str) -> DataFrame:
    return versions.change_counts(_classified(spark, folder))


def history_append(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder).select("unique_key", "run_id", "content_hash_hex")


def upsert_current(spark: SparkSession, folder: str) -> DataFrame:
    return _merged(spark, folder).select(
        "unique_key", "status", "created_date", "source_updated_at", "content_hash_hex",
        "first_seen_run_id", "last_seen_run_id",
    )


def store_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Run registry of a ticket store after both load runs."""
    runs = layers.ticket_store(spark, folder).runs()
    totals = ("staged_rows", "inserted_rows", "updated_rows", "unchanged_rows")
    return runs.select("run_id", "run_key", "status", *totals, F.col("error_message").isNotNull().alias("has_message"))


def store_current(spark: SparkSession, folder: str) -> DataFrame:
    """Current state of that store, which was merged bucket by bucket."""
    return layers.ticket_store(spark, folder).current().select(
        "unique_key", "status", "created_date", "source_updated_at", "content_hash_hex",
        "first_seen_run_id", "last_seen_run_id",
    )


def store_history(spark: SparkSession, folder: str) -> DataFrame:
    return layers.ticket_store(spark, folder).history().select("unique_key", "run_id", "content_hash_hex")


def store_ledger(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("run_id", "chunk_key", "row_count", "inserted_rows", "updated_rows", "unchanged_rows", "status")
    return layers.ticket_store(spark, folder).ledger().select(*columns)


def q7_changed_tickets(spark: SparkSession, folder: str) -> DataFrame:
    counts = versions.repeated_keys(layers.history(spark, folder))
    return counts.withColumnRenamed("row_count", "version_count")


def q7_changed_ticket_count(spark: SparkSession, folder: str) -> DataFrame:
    return q7_changed_tickets(spark, folder).agg(F.count("*").alias("changed_tickets"))


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicate keys of the raw lines, most copies first, at most ten examples."""
    lines = table(spark, folder, "lineitem")
    found = versions.repeated_keys(lines, ("l_orderkey", "l_linenumber"))
    return found.orderBy(F.desc("row_count"), "l_orderkey", "l_linenumber").limit(10)


def duplicate_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return versions.repeated_keys(frames.valid(spark, folder))


def load_gate(spark: SparkSession, folder: str) -> DataFrame:
    expected = table(spark, folder, "orders").agg(F.count("*")).scalar()
    return release.load_gate(layers.detail(spark, folder), layers.after_run_2(spark, folder), expected)


def _month() -> Column:
    return month_name(F.col("created_date")).alias("chunk_key")


def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    return release.run_totals(layers.ledger(spark, folder))


def pending_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What run 2 has left to load, next to the totals it carries over."""
    ledger = layers.ledger(spark, folder)
    chunks = (
        layers.run_2(spark, folder)
        .groupBy(_month())
        .agg(F.count("*").alias("row_count"))
        .withColumn("run_id", _run_2())
    )
    left = release.pending_chunks(chunks, ledger).select(F.lit("PENDING").alias("state"), "chunk_key", "row_count")
    carried = release.run_totals(ledger).filter("run_id = 2").select(
        F.lit("CARRIED").alias("state"), F.lit("TOTAL").alias("chunk_key"), "row_count"
    )
    return left.unionByName(carried)


def release_activate(spark: SparkSession, folder: str) -> DataFrame:
    """A release per created year; the newest becomes active in place of the oldest."""
    years = layers.detail(spark, folder).groupBy(F.year("created_date").alias("y")).agg(F.count("*").alias("row_count"))
    registry = years.select(
        (F.col("y") - 1994).cast("bigint").alias("release_id"),
        F.concat(F.lit("tickets-"), F.col("y").cast("string")).alias("release_key"),
        F.when(F.col("y") == 1995, "ACTIVE").when(F.col("y") == 1997, "REJECTED").otherwise("CANDIDATE").alias("status"),
        (F.col("y") == 1995).alias("is_active"),
        "row_count",
    )
    return release.activate(registry, "tickets-2001")


_ORDER = ["created_date", "unique_key", "source_updated_at", "content_hash_hex"]


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.enriched(spark, folder).filter("created_date IS NOT NULL")
    narrow = rows.select(month_name(F.col("created_date")).alias("month"), *_ORDER)
    return pages.paged(narrow, ["month"], _ORDER, PAGE_ROWS)


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return pages.manifest(_pages(spark, folder), ["month"], _ORDER[:2])


def page_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _manifest(spark, folder).select(
        "month", "page", "row_count",
        F.col("first_key.created_date").alias("first_created"),
        F.col("first_key.unique_key").alias("first_unique_key"),
        F.col("last_key.created_date").alias("last_created"),
        F.col("last_key.unique_key").alias("last_unique_key"),
    )


def page_boundary_check(spark: SparkSession, folder: str) -> DataFrame:
    return pages.boundary_check(_manifest(spark, folder), ["month"]).select("month", "page", "increasing")


def chunk_digest(spark: SparkSession, folder: str) -> DataFrame:
    return pages.digest_pages(_pages(spark, folder), ["month"], "content_hash_hex")


def order_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in key order whose (date, key) is not above the one before in the month."""
    orders = table(spark, folder, "orders").select(
        month_name(F.col("o_orderdate")).alias("month"), F.col("o_orderkey").alias("line"), "o_orderdate", "o_orderkey"
    )
    return pages.order_violations(orders, ["month"], ["line"], ["o_orderdate", "o_orderkey"])


def event_order_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Events in id order whose (time, id) is not above the one before."""
    events = table(spark, folder, "events").select("ts", "event_id", "user_id")
    return pages.order_violations(events, [], ["event_id"], ["ts", "user_id"])


def manifest_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Months as loaded against the counts declared by the source, some of them off."""
    actual = (
        frames.enriched(spark, folder)
        .filter("created_date IS NOT NULL")
        .groupBy(month_name(F.col("created_date")).alias("month"))
        .agg(F.count("*").alias("actual_rows"))
    )
    source = (
        raw_tickets(spark, folder)
        .select(F.substring("created_date", 1, 7).alias("month"), wall_clock(F.col("created_date")).alias("at"))
        .filter("at IS NOT NULL")
        .groupBy("month")
        .agg(F.count("*").alias("n"))
    )
    drift = F.when(F.col("month").endswith("-06"), 3).otherwise(0)
    declared = source.select(
        "month",
        F.col("n").alias("manifest_rows"),
        F.col("n").alias("source_start"),
        (F.col("n") + drift).alias("source_final"),
    )
    return pages.reconcile(actual, declared, ["month"])


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the newest day of each event type."""
    events = table(spark, folder, "events").withColumn("batch", F.to_date("ts"))
    return pages.latest_batch(events, "event_type", "batch").select("event_type", "batch", "event_id")


QUERIES = {
    "change_classification": change_classification,
    "history_append": history_append,
    "upsert_current": upsert_current,
    "store_runs": store_runs,
    "store_current": store_current,
    "store_history": store_history,
    "store_ledger": store_ledger,
    "q7_changed_tickets": q7_changed_tickets,
    "q7_changed_ticket_count": q7_changed_ticket_count,
    "duplicate_keys": duplicate_keys,
    "duplicate_key_counts": duplicate_key_counts,
    "release_gate": load_gate,
    "run_totals": run_totals,
    "pending_chunks": pending_chunks,
    "release_activate": release_activate,
    "page_manifest": page_manifest,
    "page_boundary_check": page_boundary_check,
    "chunk_digest": chunk_digest,
    "order_violations": order_violations,
    "event_order_violations": event_order_violations,
    "manifest_reconciliation": manifest_reconciliation,
    "latest_snapshot": latest_snapshot,
}

_CLASSES = """, cls AS (
  SELECT b.*, CASE WHEN a.unique_key IS NULL THEN 'inserted'
    WHEN a.content_hash_hex <> b.content_hash_hex THEN 'updated' ELSE 'unchanged' END AS change
  FROM run2 b LEFT JOIN run1 a ON a.unique_key = b.unique_key
)"""

_LEDGER = _CLASSES + """, ledger AS (
  SELECT 1::bigint AS run_id, strftime(created_date, '%Y-%m') AS chunk_key, count(*) AS row_count,
    count(*) AS inserted_rows, 0 AS updated_rows, 0 AS unchanged_rows, 'COMMITTED' AS status
  FROM run1 GROUP BY 2
  UNION ALL
  SELECT 2, strftime(created_date, '%Y-%m') AS k, count(*), count(*) FILTER (change = 'inserted'),
    count(*) FILTER (change = 'updated'), count(*) FILTER (change = 'unchanged'),
    CASE WHEN k >= '2001-01' THEN 'RUNNING' ELSE 'COMMITTED' END
  FROM cls GROUP BY 2
)"""

_TOTALS = """SELECT run_id, count(*) AS chunks, cast(sum(row_count) AS bigint) AS row_count,
  cast(sum(inserted_rows) AS bigint) AS inserted_rows, cast(sum(updated_rows) AS bigint) AS updated_rows,
  cast(sum(unchanged_rows) AS bigint) AS unchanged_rows
FROM ledger WHERE status = 'COMMITTED' GROUP BY run_id"""

_PAGED = f""", paged AS (
  SELECT *, (row_number() OVER (PARTITION BY month
      ORDER BY created_date, unique_key, source_updated_at, content_hash_hex) - 1) // {PAGE_ROWS} AS page
  FROM (SELECT *, strftime(created_date, '%Y-%m') AS month FROM enr WHERE created_date IS NOT NULL)
), manifest AS (
  SELECT month, page, count(*) AS row_count, min((created_date, unique_key)) AS f,
    max((created_date, unique_key)) AS l FROM paged GROUP BY month, page
)"""

ORACLE = {
    "change_classification": over_runs(
        """SELECT count(*) AS staged_rows, count(*) FILTER (change = 'inserted') AS inserted_rows,
  count(*) FILTER (change = 'updated') AS updated_rows,
  count(*) FILTER (change = 'unchanged') AS unchanged_rows FROM cls""",
        _CLASSES,
    ),
    "history_append": over_runs(
        "SELECT unique_key, run_id::bigint AS run_id, content_hash_hex FROM hist"
    ),
    "upsert_current": over_runs(
        """SELECT unique_key, status, created_date, source_updated_at, content_hash_hex,
  first_seen_run_id::bigint AS first_seen_run_id, last_seen_run_id::bigint AS last_seen_run_id FROM merged"""
    ),
    "store_runs": over_runs(
        """SELECT 1::bigint AS run_id, 'run-1' AS run_key, 'SUCCEEDED' AS status, count(*) AS staged_rows,
  count(*) AS inserted_rows, 0::bigint AS updated_rows, 0::bigint AS unchanged_rows, false AS has_message FROM run1
UNION ALL
SELECT 2, 'run-2', CASE WHEN count(*) = (SELECT count(*) FROM merged) THEN 'SUCCEEDED' ELSE 'FAILED' END, count(*),
  count(*) FILTER (change = 'inserted'), count(*) FILTER (change = 'updated'), count(*) FILTER (change = 'unchanged'),
  count(*) <> (SELECT count(*) FROM merged) FROM cls""",
        _CLASSES,
    ),
    "store_current": over_runs(
        """SELECT unique_key, status, created_date, source_updated_at, content_hash_hex,
  first_seen_run_id::bigint AS first_seen_run_id, last_seen_run_id::bigint AS last_seen_run_id FROM merged"""
    ),
    "store_history": over_runs("SELECT unique_key, run_id::bigint AS run_id, content_hash_hex FROM hist"),
    "store_ledger": over_runs(
        """SELECT run_id, chunk_key, row_count, inserted_rows, updated_rows::bigint AS updated_rows,
  unchanged_rows::bigint AS unchanged_rows, 'COMMITTED' AS status FROM ledger""",
        _LEDGER,
    ),
    "q7_changed_tickets": over_runs(
        "SELECT unique_key, count(*) AS version_count FROM hist GROUP BY unique_key HAVING count(*) > 1"
    ),
    "q7_changed_ticket_count": over_runs(
        """SELECT count(*) AS changed_tickets
FROM (SELECT unique_key FROM hist GROUP BY unique_key HAVING count(*) > 1)"""
    ),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1 ORDER BY row_count DESC, l_orderkey, l_linenumber LIMIT 10""",
    "duplicate_key_counts": over_tickets(
        "SELECT unique_key, count(*) AS row_count FROM valid GROUP BY 1 HAVING count(*) > 1"
    ),
    "release_gate": over_runs(
        """SELECT s AS staged_rows, c AS current_rows, e AS expected_rows, s = e AND c = e AS passed
FROM (SELECT (SELECT count(*) FROM cur) AS s, (SELECT count(*) FROM merged) AS c,
  (SELECT count(*) FROM orders) AS e)"""
    ),
    "run_totals": over_runs(_TOTALS, _LEDGER),
    "pending_chunks": over_runs(
        f"""SELECT 'PENDING' AS state, chunk_key, row_count FROM ledger WHERE run_id = 2 AND status <> 'COMMITTED'
UNION ALL
SELECT 'CARRIED', 'TOTAL', row_count FROM ({_TOTALS}) WHERE run_id = 2""",
        _LEDGER,
    ),
    "release_activate": over_tickets(
        """SELECT (y - 1994)::bigint AS release_id, 'tickets-' || y AS release_key,
  CASE WHEN y = 2001 THEN 'ACTIVE' WHEN y = 1997 THEN 'REJECTED' ELSE 'CANDIDATE' END AS status,
  y = 2001 AS is_active, row_count
FROM (SELECT year(created_date) AS y, count(*) AS row_count FROM cur GROUP BY 1)"""
    ),
    "page_manifest": over_tickets(
        """SELECT month, page::bigint AS page, row_count, f[1] AS first_created, f[2] AS first_unique_key,
  l[1] AS last_created, l[2] AS last_unique_key FROM manifest""",
        _PAGED,
    ),
    "page_boundary_check": over_tickets(
        """SELECT month, page::bigint AS page,
  coalesce(f > lag(l) OVER (PARTITION BY month ORDER BY page), true) AS increasing FROM manifest""",
        _PAGED,
    ),
    "chunk_digest": over_tickets(
        """SELECT month, page::bigint AS page, count(*) AS row_count,
  sha256(string_agg(content_hash_hex, '' ORDER BY content_hash_hex)) AS chunk_sha256
FROM paged GROUP BY month, page""",
        _PAGED,
    ),
    "order_violations": """SELECT * FROM (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS line, o_orderdate, o_orderkey,
    lag(o_orderdate) OVER w AS previous_o_orderdate, lag(o_orderkey) OVER w AS previous_o_orderkey
  FROM orders
  WINDOW w AS (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey))
WHERE previous_o_orderkey IS NOT NULL
  AND (o_orderdate, o_orderkey) <= (previous_o_orderdate, previous_o_orderkey)""",
    "event_order_violations": """SELECT * FROM (
  SELECT ts, event_id, user_id, lag(ts) OVER (ORDER BY event_id) AS previous_ts,
    lag(user_id) OVER (ORDER BY event_id) AS previous_user_id FROM events)
WHERE previous_ts IS NOT NULL AND (ts, user_id) <= (previous_ts, previous_user_id)""",
    "manifest_reconciliation": over_tickets(
        """SELECT strftime(created_date, '%Y-%m') AS month, count(*) AS actual_rows,
  count(*) AS manifest_rows, count(*) AS source_start,
  count(*) + CASE WHEN month(created_date) = 6 THEN 3 ELSE 0 END AS source_final,
  month(created_date) <> 6 AS matches
FROM enr WHERE created_date IS NOT NULL GROUP BY strftime(created_date, '%Y-%m'), month(created_date)"""
    ),
    "latest_snapshot": """SELECT event_type, cast(ts AS date) AS batch, event_id FROM events
QUALIFY cast(ts AS date) = max(cast(ts AS date)) OVER (PARTITION BY event_type)""",
}
