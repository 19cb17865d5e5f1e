"""Sinks, the batch transform, the ticket store and the streams, on real files."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import tracemalloc

import pytest
from pyspark.sql import functions as F

from deskmill.functions.times import local_clock
from deskmill.operators import loading, marts
from deskmill.operators.versions import latest_version
from deskmill.plans import frames, warehouse
from deskmill.schema import LOCAL_ZONE, RAW_FIELDS, RAW_SCHEMA
from deskmill.sources import sinks
from deskmill.sources.raw import file_statistics
from deskmill.sources.sinks import import_delimited
from deskmill.sources.commit_log import CommitLog, ConcurrentCommit
from deskmill.sources.store import TicketStore
from deskmill.sources.tickets import raw_tickets
from deskmill.streaming.keyset import GROUP, KeysetReader, page_source, write_manifest, write_pages
from deskmill.streaming.merge import merge_pages


@pytest.fixture(scope="module")
def pages(spark, folder, tmp_path_factory):
    """The derived raw tickets as JSON Lines pages, absent fields left out."""
    path = str(tmp_path_factory.mktemp("raw") / "pages")
    raw_tickets(spark, folder).drop("observation").repartition(6).write.option("compression", "gzip").json(path)
    return path


@pytest.fixture(scope="module")
def built(spark, pages, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("warehouse_out"))
    report = warehouse.transform(spark, pages, out, export_chunks=3).first()
    return out, report


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_transform_report_adds_up(spark, folder, built):
    out, report = built
    assert report.source_rows == raw_tickets(spark, folder).count()
    assert report.rejected_rows > 0 and report.flagged_rows > 0
    assert report.current_rows == report.distinct_keys == report.parquet_rows == report.export_rows
    summary = spark.read.parquet(f"{out}/dws_created_daily")
    assert summary.count() == report.dws_rows
    assert summary.agg(F.sum("ticket_count")).first()[0] == report.current_rows


def test_detail_holds_the_current_tickets(spark, folder, built):
    detail = spark.read.parquet(f"{built[0]}/dwd_ticket")
    columns = ["unique_key", "content_hash_hex", "created_date", "latitude", "quality_flags", "created_year"]
    assert sorted_rows(detail.select(columns)) == sorted_rows(frames.current(spark, folder).select(columns))
    assert len(detail.columns) == 24


def test_month_scan_is_pruned(spark, built):
    detail = spark.read.parquet(f"{built[0]}/dwd_ticket")
    month = detail.filter("created_year = 1998 AND created_month = 1")
    plan = month.groupBy("status").count()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_year" in plan
    assert "ReadSchema: struct<status:string>" in plan
    whole, part = file_statistics(detail).first(), file_statistics(month).first()
    assert 0 < part.files < whole.files and 0 < part.file_bytes < whole.file_bytes


def test_few_files_per_month(spark, built):
    detail = spark.read.parquet(f"{built[0]}/dwd_ticket")
    per_month = file_statistics(detail, "created_year", "created_month")
    assert per_month.agg(F.max("files")).first()[0] == 1


def test_export_round_trip(spark, built):
    out, _ = built
    detail = spark.read.parquet(f"{out}/dwd_ticket")
    back = import_delimited(spark, f"{out}/export")
    same = [c for c in back.columns if c in detail.columns]
    assert set(same) >= {"source_updated_at", "closed_date", "quality_flags", "longitude"}
    # The export shows local wall clocks, so instants are compared as such.
    shown = [local_clock(F.col(c), LOCAL_ZONE) if c == "source_updated_at" else F.col(c) for c in same]
    assert sorted_rows(back.select(shown)) == sorted_rows(detail.select(shown))
    assert back.select("chunk_key").distinct().count() == 3
    row = back.first()
    assert bytes(row.content_hash).hex() == row.content_hash_hex


def test_export_keeps_awkward_text(spark, tickets, tmp_path):
    rows = tickets(
        {"descriptor": 'tab\there "quoted" \\ back', "location_type": "", "agency_name": "line\tend\\"},
        {"unique_key": "2", "descriptor": None, "location_type": "NULL"},
    )
    sinks.export_delimited(rows, str(tmp_path / "x"))
    back = import_delimited(spark, str(tmp_path / "x"))
    fields = ["unique_key", "descriptor", "location_type", "agency_name"]
    assert sorted_rows(back.select(fields)) == sorted_rows(rows.select(fields))


def test_serving_overwrite_touches_one_release(spark, folder, tmp_path):
    now = frames.current(spark, folder)
    out = str(tmp_path)
    warehouse.build_serving(now, 1, out)
    warehouse.build_serving(now, 2, out)
    warehouse.build_serving(now.filter("agency = 'BUILDING'"), 2, out)
    totals = {
        r.release_id: r.n
        for r in spark.read.parquet(f"{out}/ads_complaint").groupBy("release_id").agg(F.sum("ticket_count").alias("n")).collect()
    }
    assert totals[1] == now.count() and totals[2] == now.filter("agency = 'BUILDING'").count()
    daily = spark.read.parquet(f"{out}/ads_daily_status").filter("release_id = 1")
    assert marts.resum(daily, "created_day").count() == marts.daily_trend(now).count()


# --- ticket store ------------------------------------------------------------


def staged(rows, chunk):
    return rows.drop("created_year", "created_month").withColumn("chunk_key", F.lit(chunk))


@pytest.fixture
def store(spark, tickets, tmp_path):
    return TicketStore(spark, str(tmp_path / "store"), buckets=4).create(staged(tickets({}), "x").drop("chunk_key"))


def ledger(store):
    return sorted(
        (r.run_id, r.chunk_key, r.row_count, r.inserted_rows, r.updated_rows, r.unchanged_rows) for r in store.ledger().collect()
    )


def test_chunks_in_one_load_count_like_chunks_one_by_one(store, tickets):
    a = staged(tickets({"unique_key": "1"}, {"unique_key": "2"}), "c1")
    b = staged(tickets({"unique_key": "1", "status": "Closed"}, {"unique_key": "2"}, {"unique_key": "3"}), "c2")
    assert store.load(a.unionByName(b), 7) == 2
    assert ledger(store) == [(7, "c1", 2, 2, 0, 0), (7, "c2", 3, 1, 1, 1)]
    assert sorted((r.unique_key, r.status) for r in store.current().collect()) == [("1", "Closed"), ("2", "Open"), ("3", "Open")]
    assert store.history().count() == 4


def test_same_chunk_again_adds_nothing(store, tickets):
    rows = staged(tickets({}, {"unique_key": "2"}), "c1")
    assert store.load(rows, 1) == 1
    before, version = sorted_rows(store.current()), store.version()
    assert store.load(rows, 1) == 0
    assert (sorted_rows(store.current()), store.version()) == (before, version)
    assert store.load(rows, 2) == 1
    assert store.history().count() == 2
    assert {(r.first_seen_run_id, r.last_seen_run_id) for r in store.current().collect()} == {(1, 2)}


def test_crash_before_the_ledger_is_invisible(store, tickets, monkeypatch):
    rows = staged(tickets({}), "c1")
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.load(rows, 1)
    assert (store.current().count(), store.history().count(), store.ledger().count()) == (0, 0, 0)
    assert store.load(rows, 1) == 1
    assert (store.current().count(), store.history().count(), store.ledger().count()) == (1, 1, 1)


def files_of(store):
    return {f.split("/current/")[1] for f in store.current().inputFiles()}


def test_one_key_rewrites_one_bucket(spark, store, tickets, monkeypatch):
    many = staged(tickets(*[{"unique_key": str(i)} for i in range(40)]), "c1")
    store.load(many, 1)
    before = files_of(store)
    assert len(before) == 4
    again = TicketStore(spark, store.root)  # a session that finds the files only
    read = []
    of = TicketStore._current_of
    monkeypatch.setattr(TicketStore, "_current_of", lambda *a: read.append(of(*a)) or read[-1])
    assert again.load(staged(tickets({"unique_key": "2", "status": "Closed"}), "c2"), 1) == 1
    assert len(read[0].inputFiles()) == 1
    after = files_of(again)
    assert len(after) == 4 and len(after - before) == 1
    assert {r.unique_key for r in again.current().filter("status = 'Closed'").collect()} == {"2"}
    assert (again.current().count(), again.history().count()) == (40, 41)
    gone, = again.unused()
    assert gone.split("/current/")[1] == next(iter(before - after)).rsplit("/", 1)[0]


def test_a_load_shuffles_each_side_once(store, tickets):
    store.load(staged(tickets({}, {"unique_key": "2"}), "c1"), 1)
    rows = staged(tickets({"unique_key": "2", "status": "Closed"}), "c2")
    before = store.current().repartition(4, "unique_key")
    classified = loading.classify_chunks(rows.repartition(4, "unique_key"), before)
    plan = loading.merged_current(classified, before, F.lit(2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM")


# --- concurrent writers and runs ----------------------------------------------


def key_in(store, bucket, start=0):
    """A ticket key of a bucket."""
    keys = store.spark.range(start, start + 500).select(F.col("id").cast("string").alias("unique_key"))
    return keys.filter(store._bucket() == bucket).first().unique_key


def racing(store, tickets, monkeypatch, key, other_key):
    """Load ``key`` while another writer loads ``other_key`` before the commit."""
    other = TicketStore(store.spark, store.root)
    commit = TicketStore._commit_load

    def late(self, *args):
        monkeypatch.setattr(TicketStore, "_commit_load", commit)
        assert other.load(staged(tickets({"unique_key": other_key, "status": "Closed"}), "theirs"), 9) == 1
        return commit(self, *args)

    monkeypatch.setattr(TicketStore, "_commit_load", late)
    return store.load(staged(tickets({"unique_key": key}), "mine"), 8)


def test_the_second_of_two_writers_of_a_bucket_is_refused(store, tickets, monkeypatch):
    key = key_in(store, 1)
    with pytest.raises(ConcurrentCommit):
        racing(store, tickets, monkeypatch, key, key)
    assert [r.status for r in store.current().collect()] == ["Closed"]
    assert [(r.run_id, r.chunk_key) for r in store.ledger().collect()] == [(9, "theirs")]
    assert store.history().count() == 1
    assert store.load(staged(tickets({"unique_key": key}), "mine"), 8) == 1  # and may try again
    assert store.history().count() == 2


def test_writers_of_different_buckets_both_commit(store, tickets, monkeypatch):
    assert racing(store, tickets, monkeypatch, key_in(store, 0), key_in(store, 3)) == 1
    assert sorted(r.chunk_key for r in store.ledger().collect()) == ["mine", "theirs"]
    assert (store.current().count(), store.history().count(), store.version()) == (2, 2, 2)


def test_a_number_is_given_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.last() == -1
    for i in range(20):
        log.append({"kind": "x", "i": i}, i - 1)
        assert log.last() == i
    with pytest.raises(ConcurrentCommit):
        log.append({"kind": "y"}, 9)
    assert log.entry(10)["i"] == 10 and log.latest() == {"kind": "x", "i": 19, "version": 19}
    assert sorted(r.version for r in log.entries("version bigint").collect()) == list(range(20))


def runs(store):
    return {
        r.run_key: (r.run_id, r.status, r.staged_rows, r.inserted_rows, r.updated_rows, r.unchanged_rows, r.error_message)
        for r in store.runs().collect()
    }


def test_runs_are_registered_and_resumed(store, tickets, monkeypatch):
    one = staged(tickets({}, {"unique_key": "2"}), "c1")
    assert store.run("first", one, "v1", 2)["status"] == "SUCCEEDED"
    assert runs(store) == {"first": (1, "SUCCEEDED", 2, 2, 0, 0, None)}
    version = store.version()
    assert store.run("first", one, "v1", 2)["run_id"] == 1 and store.version() == version  # at once
    # The gate fails: the run is kept as failed, the active release stays.
    more = one.unionByName(staged(tickets({"unique_key": "3"}), "c2"))
    with pytest.raises(RuntimeError, match="v2 rejected"):
        store.run("second", more, "v2", 99)
    assert runs(store)["second"][:6] == (2, "FAILED", 3, 1, 0, 2) and "v2 rejected" in runs(store)["second"][6]
    assert {r.release_key: r.is_active for r in store.registry().collect()} == {"v1": True, "v2": False}
    # A crash between chunks and gate: the run goes on where it stopped, with its own number.
    with monkeypatch.context() as patch:
        patch.setattr(TicketStore, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost" * 1000)))
        with pytest.raises(OSError):
            store.run("third", staged(tickets({}, {"unique_key": "2"}, {"unique_key": "3"}), "c1"), "v3", 3)
    assert runs(store)["third"][1] == "FAILED" and len(runs(store)["third"][6]) == 2000
    loads = []
    load = TicketStore.load
    monkeypatch.setattr(TicketStore, "load", lambda *a: loads.append(load(*a)) or loads[-1])
    again = store.run("third", staged(tickets({}, {"unique_key": "2"}, {"unique_key": "3"}), "c1"), "v3", 3)
    assert (again["run_id"], again["status"], again["error_message"], loads) == (3, "SUCCEEDED", None, [0])
    assert {r.release_key: r.status for r in store.registry().collect()} == {"v1": "CANDIDATE", "v2": "REJECTED", "v3": "ACTIVE"}


def test_double_key_in_a_chunk_is_refused(store, tickets):
    with pytest.raises(ValueError):
        store.load(staged(tickets({}, {"status": "Closed"}), "c1"), 1)
    assert store.current().count() == 0


def test_failed_release_leaves_the_active_one(store, tickets):
    store.load(staged(tickets({}), "c1"), 1)
    assert store.publish("v1", 1, expected_rows=1)
    store.load(staged(tickets({"unique_key": "2"}), "c2"), 2)
    assert not store.publish("v2", 2, expected_rows=99)
    got = {r.release_key: (r.status, r.is_active) for r in store.registry().collect()}
    assert got == {"v1": ("ACTIVE", True), "v2": ("REJECTED", False)}


# --- streams -----------------------------------------------------------------


def write_page(folder, name, rows):
    folder.mkdir(exist_ok=True)
    body = "".join(json.dumps(r) + "\n" for r in rows)
    (folder / name).write_bytes(gzip.compress(body.encode()))


def test_stream_of_pages(spark, tickets, raw, tmp_path):
    folder = tmp_path / "pages"
    base = {f: v for f, v in raw({}).first().asDict().items() if v is not None}
    write_page(folder, "part-0.jsonl.gz", [base, {**base, "unique_key": "2"}, {**base, "agency": ""}])
    store = TicketStore(spark, str(tmp_path / "store"), buckets=4).create(staged(tickets({}), "x").drop("chunk_key"))

    def run(checkpoint):
        merge_pages(spark, store, str(folder), str(tmp_path / checkpoint), 5).awaitTermination()
        return store.version(), store.current().count(), store.history().count()

    assert run("ck") == (1, 2, 2)
    assert run("ck") == (1, 2, 2)
    # A lost checkpoint sends the page again; the ledger knows it.
    assert run("ck2") == (1, 2, 2)
    newer = {**base, "status": "Closed", ":updated_at": "2025-02-01T00:00:00.000Z"}
    write_page(folder, "part-1.jsonl.gz", [newer, {**newer, "status": "Pending", ":updated_at": "2025-01-15T00:00:00.000Z"}])
    assert run("ck") == (2, 2, 3)
    assert store.current().filter("unique_key = '1'").first().status == "Closed"
    assert ledger(store) == [(5, "part-0.jsonl.gz", 2, 2, 0, 0), (5, "part-1.jsonl.gz", 1, 0, 1, 0)]
    # The same file name in two month folders: two chunks.
    for month, key in (("month=01", "11"), ("month=02", "12")):
        (folder / month).mkdir()
        write_page(folder / month, "part-1.jsonl.gz", [{**base, "unique_key": key}])
    assert run("ck") == (3, 4, 5)
    assert {r[1] for r in ledger(store)} >= {"month=01/part-1.jsonl.gz", "month=02/part-1.jsonl.gz"}


def test_keyset_stream_resumes(spark, raw, tmp_path):
    def rows(n):
        start = dt.datetime(2025, 1, 1)
        return raw(*[
            {"unique_key": f"{i:04d}", "created_date": f"{start + dt.timedelta(hours=i // 3):%Y-%m-%dT%H:%M:%S}.000"} for i in range(n)
        ])

    folder, out = str(tmp_path / "source"), str(tmp_path / "out")
    write_pages(rows(240), folder, 2)  # 120 pages

    def run():
        stream = page_source(spark, folder, RAW_SCHEMA)
        query = stream.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "ck")
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        got = spark.read.schema(RAW_SCHEMA).parquet(out)
        return sorted(r.unique_key for r in got.collect())

    assert run() == [f"{i:04d}" for i in range(240)]
    assert run() == [f"{i:04d}" for i in range(240)]
    assert spark.read.parquet(out).columns == RAW_FIELDS


def test_keyset_stream_goes_on_with_new_pages(spark, raw, tmp_path):
    """Pages that come later are read alone; keys that are prefixes of others keep their order."""
    folder, out = str(tmp_path / "source"), str(tmp_path / "out")
    keys = ["1", "10", "100", "11", "2", "20", "3"]

    def rows(names):
        return raw(*[{"unique_key": k, "created_date": "2025-01-01T00:00:00.000"} for k in names])

    def run():
        query = page_source(spark, folder, RAW_SCHEMA).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "ck")
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r.unique_key for r in spark.read.schema(RAW_SCHEMA).parquet(out).collect())

    write_pages(rows(keys[:4]), folder, 2)
    assert run() == keys[:4]
    write_pages(rows(keys), folder, 2)
    assert run() == keys


def test_large_manifest_stays_off_the_driver(spark, tmp_path):
    """100,000 pages: the driver learns row groups, and a task the pages of its own."""
    folder = str(tmp_path)
    key = "concat('2025-01-01T00:00:00.000', chr(0), lpad({}, 9, '0'))"
    pages = spark.range(100_000).selectExpr(
        "concat('file:///p', id) AS file", "id AS page", "2L AS row_count",
        f"{key.format('2 * id')} AS first", f"{key.format('2 * id + 1')} AS last",
    )
    write_manifest(pages.repartition(3), folder)
    reader = KeysetReader(RAW_SCHEMA, {"path": folder})
    tracemalloc.start()
    end = reader.latestOffset()
    every = reader.partitions(reader.initialOffset(), end)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert end["cursor"] == ["2025-01-01T00:00:00.000", "000199999"] and peak < 8_000_000
    assert len(every) < 100_000 / GROUP + 64
    # A batch in the middle: only the row groups that meet it, and of them only its pages.
    middle = [{"cursor": ["2025-01-01T00:00:00.000", f"{2 * n + 1:09d}"]} for n in (49_999, 50_199)]
    few = reader.partitions(*middle)
    found = [f for p in few for f in reader.pages(p)]
    assert len(few) <= 200 // GROUP + 3 and sorted(found) == [f"file:///p{i}" for i in range(50_000, 50_200)]
    assert max(len(reader.pages(p)) for p in few) <= GROUP
    assert reader.partitions(end, end) == []


def test_latest_version_by_chunk(tickets):
    rows = tickets({}, {":updated_at": "2025-02-01T00:00:00.000Z"}).withColumn("chunk_key", F.lit("a"))
    more = tickets({}).withColumn("chunk_key", F.lit("b"))
    assert latest_version(rows.unionByName(more), "chunk_key").count() == 2
