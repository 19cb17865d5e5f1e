"""The reliability cases of the load, on frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.operators import release
from deskmill.operators.versions import append_history, change_counts, classify_changes, upsert_current

TICKET = "unique_key string, status string, content_hash_hex string"
HISTORY = "unique_key string, run_id bigint, content_hash_hex string, status string"


def empty_current(spark):
    return spark.createDataFrame([], TICKET + ", first_seen_run_id bigint, last_seen_run_id bigint")


def merge(spark, current, history, run, *rows):
    batch = spark.createDataFrame([(k, s, f"{k}|{s}") for k, s in rows], TICKET)
    run_id = F.lit(run).cast("bigint")
    return upsert_current(current, batch, run_id), append_history(history, batch, run_id)


def state(current):
    return sorted(map(tuple, current.collect()))


def test_same_input_twice_then_change_then_revert(spark):
    current, history = empty_current(spark), spark.createDataFrame([], HISTORY)
    current, history = merge(spark, current, history, 1, ("t1", "Open"))
    once = state(current)
    current, history = merge(spark, current, history, 1, ("t1", "Open"))
    assert state(current) == once == [("t1", "Open", "t1|Open", 1, 1)]
    assert history.count() == 1

    current, history = merge(spark, current, history, 2, ("t1", "Closed"), ("t2", "Open"))
    assert state(current) == [("t1", "Closed", "t1|Closed", 1, 2), ("t2", "Open", "t2|Open", 2, 2)]
    assert history.filter("unique_key = 't1'").count() == 2

    current, history = merge(spark, current, history, 3, ("t1", "Open"))
    assert state(current)[0] == ("t1", "Open", "t1|Open", 1, 3)
    assert state(current)[1] == ("t2", "Open", "t2|Open", 2, 2)
    assert history.filter("unique_key = 't1'").count() == 2


def test_guard_keeps_the_newer_row(spark):
    shape = "unique_key string, at int, content_hash_hex string"
    old = spark.createDataFrame([("a", 5, "x"), ("b", 5, "x")], shape).withColumns(
        {"first_seen_run_id": F.lit(1), "last_seen_run_id": F.lit(1)}
    )
    new = spark.createDataFrame([("a", 4, "y"), ("b", 6, "y")], shape)
    got = {r.unique_key: r.at for r in upsert_current(old, new, F.lit(2), guard="at").collect()}
    assert got == {"a": 5, "b": 6}


def test_changes_add_up(spark):
    batch = spark.createDataFrame([(k, s, f"{k}|{s}") for k, s in [("a", "1"), ("b", "2"), ("c", "1")]], TICKET)
    known = spark.createDataFrame([("a", "1", "a|1"), ("b", "1", "b|1")], TICKET)
    assert tuple(change_counts(classify_changes(batch, known)).first()) == (3, 1, 1, 1)


def registry(spark):
    rows = [(1, "v1", 1, "ACTIVE", True, 10), (2, "v2", 2, "CANDIDATE", False, 11), (3, "v3", 3, "REJECTED", False, 0)]
    return spark.createDataFrame(
        rows, "release_id bigint, release_key string, run_id bigint, status string, is_active boolean, row_count bigint"
    )


def active(rows):
    return [(r.release_key, r.status) for r in rows.orderBy("release_id").collect() if r.is_active]


def test_activation(spark):
    after = release.activate(registry(spark), "v2")
    assert active(after) == [("v2", "ACTIVE")]
    assert {r.release_key: r.status for r in after.collect()} == {"v1": "CANDIDATE", "v2": "ACTIVE", "v3": "REJECTED"}


def test_rejected_or_unknown_release_changes_nothing(spark):
    for key in ("v3", "nope"):
        after = release.activate(registry(spark), key)
        assert sorted(map(tuple, after.collect())) == sorted(map(tuple, registry(spark).collect()))


def test_candidate_registration(spark):
    fresh = release.register_candidate(registry(spark), "v4", 9, F.lit(7))
    row = fresh.filter("release_key = 'v4'").first()
    assert tuple(row) == (4, "v4", 9, "CANDIDATE", False, 7)
    again = release.register_candidate(registry(spark), "v1", 9, F.lit(7))
    row = again.filter("release_key = 'v1'").first()
    assert tuple(row) == (1, "v1", 9, "CANDIDATE", False, 7)
    assert again.count() == 3
