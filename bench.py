"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskmill.plans import catalog, layers, warehouse
from deskmill.session import build_session
from deskmill.sources.sinks import import_delimited
from deskmill.sources.store import TicketStore
from deskmill.sources.tickets import raw_tickets

HEADLINES = [
    "normalize_tickets", "quality_flags", "content_hash", "dedupe_latest", "dws_created_daily",
    "ads_daily_status", "q1_point_lookup", "q2_cursor_page", "q3_daily_trend",
    "q3_daily_trend_ads", "q4_top_complaints", "q5_closed_duration", "q6_active_age",
    "q7_changed_tickets", "q8_agency_borough", "agency_status_range_count",
    "pruned_month_status", "change_classification", "upsert_current", "history_append",
    "dq_metrics", "dq_evaluate", "page_manifest", "chunk_digest", "order_violations",
    "duration_percentiles", "issue_profile", "lineage_closure", "job_replay",
    "label_split_profile", "ml_features", "closure_model_scores",
]


def file_jobs(spark: SparkSession, folder: str) -> dict[str, Callable[[], object]]:
    """The jobs that read and write files; their raw pages are written before any timing."""
    work = tempfile.mkdtemp(prefix="bench-")
    pages, out = f"{work}/pages", f"{work}/warehouse"
    raw_tickets(spark, folder).drop("observation").repartition(16).write.option("compression", "gzip").json(pages)

    def detail() -> DataFrame:
        return spark.read.parquet(f"{out}/dwd_ticket")

    def status(rows: DataFrame) -> list:
        return rows.groupBy("status").count().orderBy("status").collect()

    def load() -> int:
        chunks = import_delimited(spark, f"{out}/export").drop("content_hash")
        store = TicketStore(spark, f"{work}/store", buckets=8).create(chunks.drop("chunk_key"))
        return store.load(chunks, 1)

    return {
        "job_transform": lambda: warehouse.transform(spark, pages, out, export_chunks=24).collect(),
        "job_ads_build": lambda: warehouse.build_serving(detail(), 1, f"{out}/ads"),
        "scan_status_all_months": lambda: status(detail()),
        "scan_status_one_month": lambda: status(detail().filter("created_year = 1998 AND created_month = 1")),
        "job_load_24_chunks": load,
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_ui_enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    # The stored layers that the serving queries read are built first, and timed apart.
    began = time.perf_counter()
    layers.build_all(spark, folder)
    seconds["layers_build"] = round(time.perf_counter() - began, 3)
    for name in HEADLINES:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    for name, job in file_jobs(spark, folder).items():
        began = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = folder.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
