"""Parsing, flags, rejects and hashes on literal rows."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deskmill.functions.times import elapsed, hours_between, instant, local_clock
from deskmill.operators.normalize import split_rejects
from deskmill.operators.versions import latest_version


def flags_of(tickets, **row):
    return tickets(row).select("quality_flags").first()[0]


@pytest.mark.parametrize(
    ("row", "flags"),
    [
        ({}, []),
        ({"unique_key": "  "}, ["MISSING_KEY"]),
        ({"created_date": "yesterday"}, ["INVALID_CREATED_DATE"]),
        ({"created_date": ""}, ["INVALID_CREATED_DATE"]),
        ({"created_date": "2025-02-30T00:00:00.000"}, ["INVALID_CREATED_DATE"]),
        ({"created_date": "2025-01-01T00:00:00"}, ["INVALID_CREATED_DATE"]),
        ({"agency": None, "complaint_type": ""}, ["MISSING_AGENCY", "MISSING_COMPLAINT"]),
        ({"status": None}, ["MISSING_STATUS"]),
        ({"status": "closed"}, ["CLOSED_WITHOUT_DATE"]),
        ({"closed_date": "2025-01-05T00:00:00.000"}, ["ACTIVE_WITH_CLOSED_DATE"]),
        (
            {"status": "CLOSED", "closed_date": "2024-12-31T00:00:00.000"},
            ["NEGATIVE_DURATION"],
        ),
        (
            {"unique_key": None, "created_date": None, "status": "Closed"},
            ["MISSING_KEY", "INVALID_CREATED_DATE", "CLOSED_WITHOUT_DATE"],
        ),
    ],
)
def test_flags(tickets, row, flags):
    assert flags_of(tickets, **row) == flags


def test_bad_input_never_fails(tickets):
    row = tickets({"latitude": "north", "longitude": "99999.1", ":updated_at": "x"}).first()
    assert (row.latitude, row.longitude, row.source_updated_at) == (None, None, None)


def test_text_rules(tickets):
    row = tickets({"borough": None, "agency": "  DOT "}).first()
    assert (row.borough, row.agency) == ("UNKNOWN", "DOT")
    assert tickets({"borough": " queens"}).first().borough == "QUEENS"
    assert tickets({"latitude": "40.12345678"}).first().latitude == Decimal("40.1234568")


def test_split_is_complete(tickets):
    rows = tickets({}, {"unique_key": "2", "agency": None}, {"unique_key": None}, {"status": " "})
    valid, rejected = split_rejects(rows)
    assert (valid.count(), rejected.count()) == (1, 3)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_do_not_depend_on_the_session(spark, tickets, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in New York, and stays as written.
        row = tickets({"created_date": "2025-03-09T02:30:00.000", ":updated_at": "2025-07-01T12:00:00.500Z"}).first()
        assert row.created_date == dt.datetime(2025, 3, 9, 2, 30)
        assert row.source_updated_at == dt.datetime(2025, 7, 1, 12, 0, 0, 500000)
        texts = spark.createDataFrame(
            [("2025-11-02T05:30:00.000Z",), ("2025-11-02T06:30:00.000Z",), ("2025-11-02T01:30:00.000-0400",), ("2025-11-02 01:30",)],
            "t string",
        )
        at = instant(F.col("t"))
        got = [tuple(r) for r in texts.select(at, local_clock(at, "America/New_York")).collect()]
        clock = dt.datetime(2025, 11, 2, 1, 30)
        assert got == [
            (dt.datetime(2025, 11, 2, 5, 30), clock),
            (dt.datetime(2025, 11, 2, 6, 30), clock),
            (dt.datetime(2025, 11, 2, 5, 30), clock),
            (None, None),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_day_over_the_clock_change_has_24_hours(tickets):
    row = {"created_date": "2025-03-08T12:00:00.000", "closed_date": "2025-03-09T12:00:00.000"}
    pair = (F.col("created_date"), F.col("closed_date"))
    assert tickets(row).select(hours_between(*pair)).first()[0] == 24.0
    part = {"created_date": "2025-03-08T12:00:00.000", "closed_date": "2025-03-08T13:59:59.000"}
    assert tickets(part).select(elapsed("HOUR", *pair)).first()[0] == 1


def test_hash_text(tickets):
    row = tickets({"closed_date": None, ":updated_at": "2025-01-02T05:00:00.000Z"}).first()
    parts = ["2025-01-02 00:00:00", "2025-01-01 00:00:00", "<NULL>", "NYPD", "<NULL>", "Noise"]
    parts += ["<NULL>"] * 3 + ["Open"] + ["<NULL>"] * 5 + ["QUEENS", "<NULL>", "40.7000000", "-73.9000000"]
    assert row.content_hash_hex == hashlib.sha256("\u001f".join(parts).encode()).hexdigest()


def test_hash_ignores_the_key_and_sees_the_update_time(tickets):
    a, b, c = tickets({}, {"unique_key": "9"}, {":updated_at": "2025-01-02T00:00:01.000Z"}).collect()
    assert a.content_hash_hex == b.content_hash_hex != c.content_hash_hex


def test_latest_version_order(tickets):
    rows = tickets(
        {"status": "Old", ":updated_at": "2025-01-02T00:00:00.000Z"},
        {"status": "New", ":updated_at": "2025-01-03T00:00:00.000Z"},
        {"status": "Undated", ":updated_at": None},
        {"unique_key": "2", "status": "A"},
        {"unique_key": "2", "status": "B"},
    )
    got = {r.unique_key: r for r in latest_version(rows).collect()}
    assert got["1"].status == "New"
    tie = rows.filter("unique_key = '2'").agg(F.max("content_hash_hex")).first()[0]
    assert got["2"].content_hash_hex == tie


def test_latest_version_sends_one_row_per_key_and_task(tickets):
    plan = latest_version(tickets({})).select("unique_key")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below
