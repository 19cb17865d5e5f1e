"""Quality-job calls as a stream with state per job: an ordering buffer, timers and a folded rest.

Calls may come late and mixed, also a start before its submit. Each waits in the buffer of
its job until the watermark has passed its time; then a timer folds it, in order, into
the settled state of the job. After every batch a job shows what its settled state and its
buffer lead to together, so the shown table is that of one replay of all calls so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from deskmill.schema import DEFAULT_RETRIES
from deskmill.streaming.replay import LOG

PLACE = "micros bigint, event_id bigint"
CALL = "action string, release_key string, asset_key string, max_retries bigint, message string, dq_run_id bigint"
JOB = (
    "release_key string, asset_key string, max_retries bigint, status string, attempt_count bigint, "
    "version_no bigint, dq_run_id bigint, error_message string, repeated_submits bigint, "
    "conflicting_submits bigint, rejected_events bigint"
)
FIELDS = [part.split()[0] for part in JOB.split(",")]
WAITING = (None, None, None, None, 0, 0, None, None, 0, 0, 0)  # calls may come before the first submit
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def apply_call(job: tuple, call: tuple) -> tuple:
    """The state of a job after one more call."""
    s = dict(zip(FIELDS, job))
    action, release, asset, retries, message, run = call
    retries = DEFAULT_RETRIES if pd.isna(retries) else int(retries)
    if action == "submit":
        if s["status"] is None:
            s |= {"release_key": release, "asset_key": asset, "max_retries": retries, "status": "QUEUED"}
        elif (release, asset, retries) == (s["release_key"], s["asset_key"], s["max_retries"]):
            s["repeated_submits"] += 1
        else:
            s["conflicting_submits"] += 1
    elif action == "start" and s["status"] == "QUEUED":
        s |= {"status": "RUNNING", "attempt_count": s["attempt_count"] + 1, "version_no": s["version_no"] + 1, "error_message": None}
    elif action == "complete" and s["status"] == "RUNNING":
        s |= {"status": "SUCCEEDED", "version_no": s["version_no"] + 1, "dq_run_id": None if pd.isna(run) else int(run), "error_message": None}
    elif action == "fail" and s["status"] == "RUNNING":
        again = s["attempt_count"] <= s["max_retries"]
        s |= {"status": "QUEUED" if again else "FAILED", "version_no": s["version_no"] + 1, "error_message": message}
    else:
        s["rejected_events"] += 1
    return tuple(s.values())


class JobState(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", JOB)
        self.buffer = handle.getMapState("buffer", PLACE, CALL)

    def _shown(self, key: tuple, job: tuple) -> Iterator[pd.DataFrame]:
        if job[3] is not None:
            yield pd.DataFrame([(*key, *job)], columns=["job_key", *FIELDS]).astype(
                {"max_retries": "Int64", "dq_run_id": "Int64"}
            )

    def _now(self) -> tuple:
        return tuple(self.settled.get()) if self.settled.exists() else WAITING

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame.astype(object).where(frame.notna(), None).itertuples(index=False):
                self.buffer.updateValue(
                    (int(row.micros), int(row.event_id)),
                    (row.action, row.release_key, row.asset_key, row.max_retries, row.message, row.dq_run_id),
                )
                self.handle.registerTimer(int(row.micros) // 1000)
        job = self._now()
        for _, call in sorted((tuple(k), tuple(v)) for k, v in self.buffer.iterator()):
            job = apply_call(job, call)
        yield from self._shown(key, job)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due = sorted((tuple(k), tuple(v)) for k, v in self.buffer.iterator() if k[0] < passed)
        job = self._now()
        for place, call in due:
            job = apply_call(job, call)
            self.buffer.removeKey(place)
        if due:
            self.settled.update(job)
        yield from ()  # nothing new to show

    def close(self) -> None:
        pass


def job_states(calls: DataFrame, lateness: str) -> DataFrame:
    """A row per job that a batch of the stream ``calls`` moves, as in ``operators.jobs.replay``.

    A call that comes more than ``lateness`` behind the newest one is dropped.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col("at"))
    timed = calls.withColumn("micros", micros).withColumn("at", F.timestamp_micros("micros"))
    return (
        timed.withWatermark("at", lateness)
        .groupBy("job_key")
        .transformWithStateInPandas(JobState(), f"job_key string, {JOB}", "Update", "EventTime")
    )


def follow_keyed(
    spark: SparkSession, calls: str, table: str, checkpoint: str, lateness: str = "1 day", files_per_batch: int = 1000
) -> StreamingQuery:
    """Take in all call files (JSON Lines) that are there and stop.

    Each batch writes the jobs it moves; a batch that is sent again replaces its rows. The
    session's state store has to be RocksDB (``ROCKS``).
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).json(calls)
    return (
        job_states(stream, lateness)
        .writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def job_table(spark: SparkSession, table: str) -> DataFrame:
    """The newest row of every job."""
    rows = spark.read.schema(f"job_key string, {JOB}, batch bigint").option("basePath", table).parquet(table)
    newest = rows.groupBy("job_key").agg(F.max_by(F.struct(*FIELDS), "batch").alias("job"))
    return newest.select("job_key", "job.*")
