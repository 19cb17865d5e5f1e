"""Quality-job calls as a stream, folded into a job table batch by batch.

The stored state of a job is written back as the shortest list of calls that leads to
it: a submit, a start and a fail for each earlier attempt, and the last turn. Those few
calls in front of the new ones make the batch replay exact across batches. Calls of one
job have to arrive in order from batch to batch; inside a batch they may be mixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmill.operators.jobs import replay

LOG = (
    "job_key string, at timestamp_ntz, event_id bigint, action string, release_key string, "
    "asset_key string, max_retries bigint, message string, dq_run_id bigint"
)
COUNTERS = ["repeated_submits", "conflicting_submits", "rejected_events"]


def as_calls(jobs: DataFrame) -> DataFrame:
    """Stored jobs as calls that rebuild them, placed before all real ones."""
    tries = F.col("attempt_count")
    lost = F.when(F.col("status").isin("RUNNING", "SUCCEEDED"), tries - 1).otherwise(tries)
    pairs = F.array_repeat(F.array(F.lit("start"), F.lit("fail")), lost.cast("int"))
    last = (
        F.when(F.col("status") == "RUNNING", F.array(F.lit("start")))
        .when(F.col("status") == "SUCCEEDED", F.array(F.lit("start"), F.lit("complete")))
        .otherwise(F.array().cast("array<string>"))
    )
    calls = F.concat(F.array(F.lit("submit")), F.flatten(pairs), last)
    return jobs.select("*", F.posexplode(calls).alias("_n", "action")).select(
        "job_key",
        F.lit("0001-01-01 00:00:00").cast("timestamp_ntz").alias("at"),
        (F.col("_n") - 100).cast("bigint").alias("event_id"),
        "action",
        "release_key",
        "asset_key",
        "max_retries",
        F.col("error_message").alias("message"),
        "dq_run_id",
    )


def fold(jobs: DataFrame, calls: DataFrame) -> DataFrame:
    """The job table after some more calls; jobs without calls pass through untouched."""
    touched = calls.select("job_key").distinct()
    known = jobs.join(touched, "job_key", "left_semi")
    after = replay(as_calls(known).unionByName(calls))
    before = known.select("job_key", *[F.col(c).alias(f"_{c}") for c in COUNTERS])
    moved = after.join(before, "job_key", "left").withColumns(
        {c: F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in COUNTERS}
    )
    rest = jobs.join(touched, "job_key", "left_anti")
    return rest.unionByName(moved.select(*jobs.columns))


def follow(
    spark: SparkSession, calls: str, table: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Fold all call files (JSON Lines) that are there and stop.

    Batch n reads version n of the job table and writes version n + 1, so a batch that
    is sent again gives the same version again.
    """
    empty = replay(spark.createDataFrame([], LOG))

    def state(version: int) -> DataFrame:
        if version < 0:
            return empty
        return spark.read.parquet(f"{table}/version={version}")

    def step(batch: DataFrame, number: int) -> None:
        done = fold(state(number - 1), batch)
        done.write.mode("overwrite").parquet(f"{table}/version={number}")

    return (
        spark.readStream.schema(LOG)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(calls)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
