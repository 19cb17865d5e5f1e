"""Quality-job calls: single cases and random logs against a step-by-step fold."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from deskmill.operators.jobs import replay
from deskmill.streaming.job_state import ROCKS, follow_keyed, job_table
from deskmill.streaming.replay import LOG, fold, follow

START = dt.datetime(2025, 1, 1)


def log_rows(job, calls, retries=2, release="r", first=0):
    rows = []
    for i, call in enumerate(calls):
        action, _, other = call.partition(":")
        rows.append(
            (job, START + dt.timedelta(minutes=first + i), first + i, action, other or release, "dwd_ticket", retries, f"e{first + i}", first + i)
        )
    return rows


def final(spark, calls, **kw):
    return replay(spark.createDataFrame(log_rows("j", calls, **kw), LOG)).first()


@pytest.mark.parametrize(
    ("calls", "status", "attempts", "version", "rejected"),
    [
        (["submit"], "QUEUED", 0, 0, 0),
        (["submit", "start"], "RUNNING", 1, 1, 0),
        (["submit", "start", "start"], "RUNNING", 1, 1, 1),
        (["submit", "complete"], "QUEUED", 0, 0, 1),
        (["start", "submit"], "QUEUED", 0, 0, 1),
        (["submit", "start", "complete", "start"], "SUCCEEDED", 1, 2, 1),
        (["submit", "start", "fail"], "QUEUED", 1, 2, 0),
        (["submit"] + ["start", "fail"] * 3, "FAILED", 3, 6, 0),
        (["submit"] + ["start", "fail"] * 4, "FAILED", 3, 6, 2),
        (["submit", "start", "fail", "start", "complete"], "SUCCEEDED", 2, 4, 0),
    ],
)
def test_states(spark, calls, status, attempts, version, rejected):
    row = final(spark, calls)
    assert (row.status, row.attempt_count, row.version_no, row.rejected_events) == (status, attempts, version, rejected)


@pytest.mark.parametrize(("retries", "fails"), [(None, 3), (5, 6), (7, 8), (0, 1)])
def test_own_number_of_retries(spark, retries, fails):
    row = final(spark, ["submit"] + ["start", "fail"] * (fails - 1), retries=retries)
    assert (row.status, row.attempt_count) == ("QUEUED", fails - 1)
    row = final(spark, ["submit"] + ["start", "fail"] * (fails + 2), retries=retries)
    assert (row.status, row.attempt_count) == ("FAILED", fails)


def test_repeated_and_conflicting_submits(spark):
    row = final(spark, ["submit", "submit", "submit:other", "start"])
    assert (row.status, row.repeated_submits, row.conflicting_submits, row.release_key) == ("RUNNING", 1, 1, "r")


def test_messages(spark):
    assert final(spark, ["submit", "start", "fail"]).error_message == "e2"
    assert final(spark, ["submit", "start", "fail", "start"]).error_message is None
    assert final(spark, ["submit"] + ["start", "fail"] * 3).error_message == "e6"
    assert final(spark, ["submit", "start", "complete"]).dq_run_id == 2


def test_jobs_without_submit_do_not_exist(spark):
    assert replay(spark.createDataFrame(log_rows("j", ["start", "fail"]), LOG)).isEmpty()


def by_hand(rows):
    jobs = {}
    for job, _, i, action, release, asset, retries, message, run in sorted(rows, key=lambda r: (r[1], r[2])):
        s = jobs.get(job)
        if action == "submit":
            if s is None:
                jobs[job] = dict(release=release, retries=retries, status="QUEUED", tries=0, version=0, run=None, error=None, same=0, other=0, bad=jobs.get(("early", job), 0))
            else:
                s["same" if s["release"] == release else "other"] += 1
            continue
        if s is None:
            jobs["early", job] = jobs.get(("early", job), 0) + 1
        elif action == "start" and s["status"] == "QUEUED":
            s.update(status="RUNNING", tries=s["tries"] + 1, version=s["version"] + 1, error=None)
        elif action == "complete" and s["status"] == "RUNNING":
            s.update(status="SUCCEEDED", version=s["version"] + 1, run=run, error=None)
        elif action == "fail" and s["status"] == "RUNNING":
            s.update(status="QUEUED" if s["tries"] <= s["retries"] else "FAILED", version=s["version"] + 1, error=message)
        else:
            s["bad"] += 1
    return {
        job: (s["status"], s["tries"], s["version"], s["run"], s["error"], s["same"], s["other"], s["bad"])
        for job, s in jobs.items() if isinstance(job, str)
    }


def as_dict(df):
    return {
        r.job_key: (r.status, r.attempt_count, r.version_no, r.dq_run_id, r.error_message, r.repeated_submits, r.conflicting_submits, r.rejected_events)
        for r in df.collect()
    }


def random_log(seed, jobs=25, calls=12):
    rng = random.Random(seed)
    names = ["submit", "submit:other", "start", "start", "fail", "fail", "complete"]
    rows = []
    for j in range(jobs):
        n = 200 if j == 0 else calls
        rows += log_rows(f"j{j}", [rng.choice(names) for _ in range(n)], retries=rng.randrange(6))
    return rows


def test_random_logs(spark):
    rows = random_log(11)
    assert as_dict(replay(spark.createDataFrame(rows, LOG).repartition(5))) == by_hand(rows)


def test_fold_in_steps(spark, tmp_path):
    """The stream over several files ends in the same table as one replay of all calls.

    Calls before the submit of a job are only counted inside their batch, so the log
    starts with the submits.
    """
    rows = [r for r in random_log(12, jobs=12) if r[2] > 0]
    rows += [row for j in range(12) for row in log_rows(f"j{j}", ["submit"], retries=next(r[6] for r in rows if r[0] == f"j{j}"))]
    frame = spark.createDataFrame(rows, LOG)
    calls, table = str(tmp_path / "calls"), str(tmp_path / "jobs")
    for step in range(3):
        part = frame.filter((F.col("event_id") >= step * 4) & (F.col("event_id") < (step + 1) * 4 if step < 2 else F.lit(True)))
        part.coalesce(1).write.mode("append").json(calls)
        follow(spark, calls, table, str(tmp_path / "ck")).awaitTermination()
    got = as_dict(spark.read.parquet(f"{table}/version=2"))
    assert got == by_hand(rows)


def test_fold_leaves_other_jobs_alone(spark):
    first = fold(replay(spark.createDataFrame([], LOG)), spark.createDataFrame(log_rows("a", ["submit", "start"]), LOG))
    second = fold(first, spark.createDataFrame(log_rows("b", ["submit"], first=10), LOG))
    assert {k: v[0] for k, v in as_dict(second).items()} == {"a": "RUNNING", "b": "QUEUED"}


# --- state per job ---------------------------------------------------------------


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("seed", [21, 22])
def test_shuffled_batches_end_like_one_replay(rocks, tmp_path, seed):
    """Calls come in any order over five batches, starts before their submits too."""
    rows = random_log(seed, jobs=15)
    random.Random(seed).shuffle(rows)
    calls, table = str(tmp_path / "calls"), str(tmp_path / "jobs")
    for step in range(5):
        rocks.createDataFrame(rows[step::5], LOG).coalesce(1).write.mode("append").json(calls)
        follow_keyed(rocks, calls, table, str(tmp_path / "ck")).awaitTermination()
    want = by_hand(rows)
    assert as_dict(job_table(rocks, table)) == want
    assert as_dict(replay(rocks.createDataFrame(rows, LOG))) == want


def test_settled_calls_leave_the_buffer(rocks, tmp_path):
    """With little lateness the buffer empties, and the table stays that of one replay."""
    rows = [r for j in range(6) for r in log_rows(f"j{j}", ["start", "submit", "start", "fail", "start", "complete"] * 3)]
    calls, table, ck = str(tmp_path / "calls"), str(tmp_path / "jobs"), str(tmp_path / "ck")
    for step in range(6):
        part = [r for r in rows if step * 3 <= r[2] < step * 3 + 3]
        random.Random(step).shuffle(part)
        rocks.createDataFrame(part, LOG).coalesce(1).write.mode("append").json(calls)
        follow_keyed(rocks, calls, table, ck, lateness="3 minutes").awaitTermination()
    assert as_dict(job_table(rocks, table)) == by_hand(rows)
    state = rocks.read.format("statestore").option("path", ck).option("stateVarName", "buffer").load()
    assert 0 < state.count() < len(rows) / 2
    # A call from long before the watermark is dropped.
    rocks.createDataFrame(log_rows("j0", ["submit:other"], first=0), LOG).coalesce(1).write.mode("append").json(calls)
    follow_keyed(rocks, calls, table, ck, lateness="3 minutes").awaitTermination()
    assert as_dict(job_table(rocks, table)) == by_hand(rows)


def test_unknown_assets_and_runs_are_refused(spark):
    rows = log_rows("a", ["submit", "start", "complete", "complete"]) + log_rows("b", ["submit", "start"], first=10)
    rows[4] = (*rows[4][:5], "nowhere", *rows[4][6:])
    assets = spark.createDataFrame([("dwd_ticket",)], "asset_key string")
    runs = spark.createDataFrame([(3,)], "dq_run_id bigint")
    got = replay(spark.createDataFrame(rows, LOG), assets, runs).collect()
    assert [(r.job_key, r.status, r.dq_run_id, r.rejected_events) for r in got] == [("a", "SUCCEEDED", 3, 1)]
