"""Final state of quality jobs from their event log.

A job is queued by its first submit, then runs and ends in turn: a start is accepted only
while it waits, an end (fail or complete) only while it runs. So, among the events after
the first submit, exactly those are accepted whose kind (start or end) differs from the
kind of the event before them, up to the event that finishes the job. That needs one
look at the neighbour in a global order, not a fold over all events of a job, and a job
with very many events is spread over tasks like any other rows.

A job may fail ``max_retries`` times (null: twice) and run again; the next fail is final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deskmill.operators.ordered import previous_row, row_number
from deskmill.schema import DEFAULT_RETRIES

PLACE = ["at", "event_id"]


def _submits(log: DataFrame) -> DataFrame:
    """Per job: parameters of the first submit, repeats of it and conflicting ones."""
    params = ["release_key", "asset_key", "max_retries"]
    per_set = (
        log.filter("action = 'submit'")
        .withColumn("max_retries", F.coalesce("max_retries", F.lit(DEFAULT_RETRIES)))
        .groupBy("job_key", *params)
        .agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("first"))
    )
    chosen = F.min(F.struct("first", "n", *params)).alias("s")
    return (
        per_set.groupBy("job_key")
        .agg(chosen, F.sum("n").alias("submits"))
        .select(
            "job_key",
            F.col("s.first").alias("queued_at"),
            *[F.col(f"s.{p}").alias(p) for p in params],
            (F.col("s.n") - 1).alias("repeated_submits"),
            (F.col("submits") - F.col("s.n")).alias("conflicting_submits"),
        )
    )


def _turns(log: DataFrame, submits: DataFrame) -> DataFrame:
    """Events after the first submit that change between start and end."""
    steps = (
        log.filter("action <> 'submit'")
        .join(submits.select("job_key", "queued_at"), "job_key")
        .filter(F.struct(*PLACE) > F.col("queued_at"))
        .select("job_key", *PLACE, "action", "message", "dq_run_id")
    )
    rows = previous_row(steps, ["job_key"], PLACE, {"before": "action"})
    is_start = F.col("action") == "start"
    was_start = F.coalesce(F.col("before") == "start", F.lit(False))
    return rows.filter(is_start != was_start)


def known_calls(log: DataFrame, assets: DataFrame | None, runs: DataFrame | None) -> DataFrame:
    """``log`` with ``refused``: a submit for an asset that ``assets`` (asset_key) lacks, or a
    complete with a run that ``runs`` (dq_run_id) lacks; a complete may name no run."""
    refused = F.lit(False)
    if assets is not None:
        known = assets.select("asset_key").distinct().withColumn("_asset", F.lit(True))
        log = log.join(known, "asset_key", "left")
        refused = refused | ((F.col("action") == "submit") & F.col("_asset").isNull())
    if runs is not None:
        known = runs.select("dq_run_id").distinct().withColumn("_run", F.lit(True))
        log = log.join(known, "dq_run_id", "left")
        named = F.col("dq_run_id").isNotNull() & F.col("_run").isNull()
        refused = refused | ((F.col("action") == "complete") & named)
    return log.withColumn("refused", refused).drop("_asset", "_run")


def replay(log: DataFrame, assets: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """One row per submitted job: status, attempts, version and rejected events.

    ``log`` has job_key, at, event_id, action (submit, start, fail, complete),
    release_key, asset_key, max_retries, message and dq_run_id. With ``assets`` or ``runs``
    a submit or complete that names an unknown one has no effect; a refused complete
    counts as a rejected event.
    """
    every = log
    if assets is not None or runs is not None:
        every = known_calls(log, assets, runs)
        log = every.filter("NOT refused")
    submits = _submits(log)
    turns = _turns(log, submits)
    seen = every.groupBy("job_key").agg(F.count_if(F.col("action") != "submit").alias("steps"))
    marks = turns.groupBy("job_key").agg(
        F.min(F.when(F.col("action") == "complete", F.struct(*PLACE, "dq_run_id"))).alias("done"),
        F.max(F.struct(*PLACE, "action")).alias("last"),
    )
    # Of a job, only the fails that its own retries allow and the final one matter: the
    # final one, the last one and how many came before the end are all that is kept.
    fails = (
        row_number(turns.filter("action = 'fail'"), ["job_key"], PLACE, "_n")
        .join(submits.select("job_key", "max_retries"), "job_key")
        .filter(F.col("_n") <= F.col("max_retries") + 1)
        .join(marks.select("job_key", "done"), "job_key", "left")
        .groupBy("job_key")
        .agg(
            F.max(F.when(F.col("_n") == F.col("max_retries") + 1, F.struct(*PLACE, "message"))).alias("final"),
            F.max(F.struct(*PLACE, "message")).alias("last_fail"),
            F.count("*").alias("n_fails"),
            F.count_if(F.struct(*PLACE) < F.struct("done.at", "done.event_id")).alias("before_done"),
        )
    )
    jobs = (
        submits.join(seen, "job_key")
        .join(marks, "job_key", "left")
        .join(fails, "job_key", "left")
    )
    final_fail = F.col("final")
    before_done = F.coalesce("before_done", F.lit(0))
    succeeded = F.col("done").isNotNull() & (
        final_fail.isNull()
        | (F.struct("done.at", "done.event_id") < F.struct(final_fail["at"], final_fail["event_id"]))
    )
    running = F.coalesce(F.col("last.action") == "start", F.lit(False))
    fail_count = F.coalesce("n_fails", F.lit(0))
    return (
        jobs.withColumn(
            "status",
            F.when(succeeded, "SUCCEEDED")
            .when(final_fail.isNotNull(), "FAILED")
            .when(running, "RUNNING")
            .otherwise("QUEUED"),
        )
        .withColumn(
            "attempt_count",
            F.when(F.col("status") == "SUCCEEDED", before_done + 1)
            .when(F.col("status") == "FAILED", F.col("max_retries") + 1)
            .when(F.col("status") == "RUNNING", fail_count + 1)
            .otherwise(fail_count)
            .cast("bigint"),
        )
        .withColumn(
            "version_no",
            F.col("attempt_count") * 2 - F.when(F.col("status") == "RUNNING", 1).otherwise(0),
        )
        .select(
            "job_key",
            "release_key",
            "asset_key",
            F.col("max_retries").cast("bigint").alias("max_retries"),
            "status",
            "attempt_count",
            "version_no",
            F.when(F.col("status") == "SUCCEEDED", F.col("done.dq_run_id")).alias("dq_run_id"),
            F.when(F.col("status") == "FAILED", final_fail["message"])
            .when(F.col("status") == "QUEUED", F.col("last_fail.message"))
            .alias("error_message"),
            "repeated_submits",
            "conflicting_submits",
            (F.col("steps") - F.col("version_no")).alias("rejected_events"),
        )
    )
