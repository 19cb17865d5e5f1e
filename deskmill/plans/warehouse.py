"""The batch jobs end to end: transform, serving build and quality run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.functions.quality import is_rejected
from deskmill.functions.ratios import count_where
from deskmill.operators import governance as gov
from deskmill.operators import lineage, marts
from deskmill.operators.normalize import enrich, normalize
from deskmill.operators.pages import order_violations, reconcile
from deskmill.operators.profile import counts_by_month_and_flag, one_row
from deskmill.operators.versions import latest_version, repeated_keys
from deskmill.schema import LOCAL_ZONE
from deskmill.session import materialize
from deskmill.sources import sinks
from deskmill.sources.config import Governance
from deskmill.sources.raw import file_digests, lines_in_order, read_manifests, scan_pages


def transform(
    spark: SparkSession,
    pages: str | list[str],
    out: str,
    export_chunks: int | None = None,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Raw pages to detail, summary and export; returns the one-row run report.

    The pages are parsed once, into a columnar stage split by the reject test. Counts,
    deduplication and all sinks read that stage or the sinks, never the raw text again.
    """
    stage, detail = f"{out}/stage", f"{out}/dwd_ticket"
    summary, export = f"{out}/dws_created_daily", f"{out}/export"
    rows = enrich(normalize(scan_pages(spark, pages)), zone)
    sinks.replaced(rows.withColumn("rejected", is_rejected())).partitionBy("rejected").parquet(stage)
    staged = spark.read.parquet(stage)

    sinks.write_detail(latest_version(staged.filter(~F.col("rejected")).drop("rejected")), detail)
    current = spark.read.parquet(detail)
    sinks.write_summary(marts.daily_summary(current), summary)
    sinks.export_delimited(current, export, export_chunks, zone)

    report = one_row(
        [
            staged.agg(
                F.count("*").alias("source_rows"), count_where(F.col("rejected")).alias("rejected_rows")
            ),
            current.agg(
                F.count("*").alias("current_rows"),
                F.count_distinct("unique_key").alias("distinct_keys"),
                count_where(F.size("quality_flags") > 0).alias("flagged_rows"),
            ),
            sinks.sink_counts(spark, detail, export),
            spark.read.parquet(summary).agg(F.count("*").alias("dws_rows")),
        ]
    )
    sinks.write_report(report, f"{out}/report")
    sinks.write_report(counts_by_month_and_flag(current), f"{out}/report_counts")
    return spark.read.schema(report.schema).json(f"{out}/report")


def validate_raw(spark: SparkSession, root: str) -> DataFrame:
    """Independent check of a finished extract: one row per month folder.

    Counts and digests of every part against its manifest, month totals against all three
    declared counts, strict key order along the parts, and keys unique over all months.
    """
    months = read_manifests(spark, root)
    declared = months.select("folder", F.inline("parts")).select(
        "folder", "file", F.col("rows").alias("part_rows"), "compressed_sha256", "uncompressed_sha256"
    )
    lines = materialize(lines_in_order(spark, f"{root}/*/*.gz"))
    counted = lines.groupBy("folder", "file").agg(F.count("*").alias("read_rows"))
    digests = file_digests(spark, root).select(
        "folder", "file", F.col("compressed_sha256").alias("zip"), F.col("uncompressed_sha256").alias("text")
    )
    parts = (
        declared.join(counted, ["folder", "file"], "full_outer")
        .join(digests, ["folder", "file"], "full_outer")
        .groupBy("folder")
        .agg(
            F.sum("read_rows").alias("actual_rows"),
            F.bool_and(F.coalesce(F.col("read_rows") == F.col("part_rows"), F.lit(False))).alias("parts_match"),
            F.bool_and(
                F.coalesce(
                    (F.col("zip") == F.col("compressed_sha256")) & (F.col("text") == F.col("uncompressed_sha256")),
                    F.lit(False),
                )
            ).alias("hashes_match"),
        )
    )
    declared_months = months.select(
        "folder",
        F.col("rows").alias("manifest_rows"),
        F.col("source_count_start").alias("source_start"),
        F.col("source_count_final").alias("source_final"),
        "complete",
    )
    totals = reconcile(parts, declared_months.drop("complete"), ["folder"])
    broken = order_violations(lines, ["folder"], ["file", "line"], ["created_date", "unique_key"])
    out_of_order = broken.groupBy("folder").agg(F.count("*").alias("order_violations"))
    doubled = repeated_keys(lines).agg(F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0))).scalar()
    return (
        totals.withColumnRenamed("matches", "counts_match")
        .join(parts.drop("actual_rows"), "folder", "left")
        .join(declared_months.select("folder", "complete"), "folder", "left")
        .join(out_of_order, "folder", "left")
        .fillna(0, ["order_violations"])
        .fillna(False, ["parts_match", "hashes_match", "complete"])
        .withColumn("duplicate_keys_overall", doubled)
    )


def build_serving(current: DataFrame, release_id: int, out: str) -> None:
    """Write the three serving tables of one release; other releases stay as they are."""
    release = F.lit(release_id)
    sinks.write_serving(marts.daily_status(current, release), f"{out}/ads_daily_status")
    sinks.write_serving(marts.agency_status(current, release), f"{out}/ads_agency_status")
    sinks.write_serving(marts.complaint_counts(current, release), f"{out}/ads_complaint")


def quality_run(
    config: Governance,
    detail: DataFrame,
    summary: DataFrame,
    current: DataFrame,
    scope_year: int,
    run_id: int,
    out: str,
) -> DataFrame:
    """Check the lineage, evaluate all enabled rules, keep the result rows, return the verdict."""
    if not lineage.edge_violations(config.lineage, config.assets).isEmpty():
        raise ValueError("lineage names an unknown asset or the same asset twice")
    if not lineage.cycle_edges(config.lineage).isEmpty():
        raise ValueError("lineage has a cycle")
    bad_rules = gov.rule_violations(config.rules)
    if not bad_rules.isEmpty():
        raise ValueError(f"rule definitions are not valid: {bad_rules.first()}")
    metrics = gov.rule_metrics(detail, summary, current, scope_year)
    rows = gov.result_rows(gov.evaluate_rules(metrics, config.rules), F.lit(run_id))
    _replace_run(rows, f"{out}/dq_result")
    stored = detail.sparkSession.read.parquet(f"{out}/dq_result").filter(F.col("dq_run_id") == run_id)
    checked = metrics.select("dwd_row_count").scalar()
    run = gov.run_row(stored, F.lit(run_id), f"dq-{config.release_key}-{run_id}", config.release_key, checked)
    _replace_run(run, f"{out}/dq_run")  # after its results: a run row stands for whole results
    return gov.verdict(stored)


def _replace_run(rows: DataFrame, path: str) -> None:
    """A partition per run, so that a run that is repeated replaces its own rows only."""
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dq_run_id").parquet(path)
