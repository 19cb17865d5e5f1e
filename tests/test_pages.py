"""Page manifests and raw file checks."""

from __future__ import annotations

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from deskmill.operators import pages
from deskmill.plans.warehouse import validate_raw
from deskmill.operators.serving import after_cursor, before_cursor, offset_page, runs_with_status
from deskmill.schema import DQ_RUN_STATUSES
from deskmill.sources.raw import file_digests, scan_pages, snapshots


def frame(spark, rows, names):
    return spark.createDataFrame(rows, names)


def test_manifest_adds_up_and_pages_grow(spark):
    rows = [("m1", f"2025-01-{1 + i // 4:02d}", f"{i:03d}") for i in range(23)] + [("m2", "2025-02-01", "a")]
    df = frame(spark, rows, "month string, d string, k string").repartition(5)
    listed = pages.manifest(pages.paged(df, ["month"], ["d", "k"], 5), ["month"], ["d", "k"])
    got = sorted((r.month, r.page, r.row_count, r.first_key.k, r.last_key.k) for r in listed.collect())
    assert [g[2] for g in got] == [5, 5, 5, 5, 3, 1]
    assert got[1][3:] == ("005", "009")
    assert pages.boundary_check(listed, ["month"]).filter("NOT increasing").isEmpty()


def test_boundary_check_finds_overlap(spark):
    rows = [("m", 0, ("a", "1"), ("b", "1")), ("m", 1, ("b", "1"), ("c", "1"))]
    df = frame(spark, rows, "month string, page bigint, first_key struct<d string, k string>, last_key struct<d string, k string>")
    got = {r.page: r.increasing for r in pages.boundary_check(df, ["month"]).collect()}
    assert got == {0: True, 1: False}


def test_order_violations_include_equal_keys(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (3, "b"), (4, "a")], "line int, k string")
    got = pages.order_violations(df, [], ["line"], ["k"]).orderBy("line").collect()
    assert [(r.line, r.previous_k) for r in got] == [(3, "b"), (4, "b")]


def test_reconcile_sees_missing_months(spark):
    actual = frame(spark, [("01", 5), ("02", 4)], "month string, actual_rows bigint")
    declared = frame(
        spark, [("01", 5, 5, 5), ("03", 1, 1, 1)],
        "month string, manifest_rows bigint, source_start bigint, source_final bigint",
    )
    got = {r.month: r.matches for r in pages.reconcile(actual, declared, ["month"]).collect()}
    assert got == {"01": True, "02": False, "03": False}


def test_digest_does_not_depend_on_row_order(spark):
    df = frame(spark, [("m", 0, h) for h in "cab"], "month string, page int, h string")
    row = pages.digest_pages(df, ["month"], "h").first()
    assert row.chunk_sha256 == hashlib.sha256(b"abc").hexdigest()


def test_cursors_compare_both_columns(spark):
    rows = [("2025-01-01 00:00:00", "5"), ("2025-01-01 00:00:00", "7"), ("2024-12-31 00:00:00", "9")]
    df = frame(spark, rows, "c string, unique_key string").withColumn("created_date", F.col("c").cast("timestamp_ntz"))
    at = ("2025-01-01", "6")
    assert sorted(r.unique_key for r in df.filter(before_cursor(*at)).collect()) == ["5", "9"]
    assert [r.unique_key for r in df.filter(after_cursor(*at)).collect()] == ["7"]


@pytest.mark.parametrize(("page", "size"), [(-1, 10), (0, 0), (0, 101)])
def test_page_limits(spark, page, size):
    with pytest.raises(ValueError):
        offset_page(spark.range(3), ["id"], page, size)


def test_page_with_total(spark):
    got = offset_page(spark.range(25), ["id"], 2, 10).collect()
    assert [tuple(r) for r in got] == [(i, 25) for i in range(20, 25)]


def test_unknown_run_status_is_refused(spark):
    runs = frame(spark, [(1, "PASSED"), (2, "FAILED")], "dq_run_id int, status string")
    assert runs_with_status(runs, " passed ", DQ_RUN_STATUSES).count() == 1
    assert runs_with_status(runs, "", DQ_RUN_STATUSES).count() == 2
    with pytest.raises(ValueError):
        runs_with_status(runs, "SUCCESS", DQ_RUN_STATUSES)


def write_page(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("".join(f"{line}\n" for line in lines).encode()))


def test_raw_scan_and_digests(spark, tmp_path):
    root = tmp_path / "year=2025"
    write_page(root / "month=01" / "part-00000.jsonl.gz", [json.dumps({"unique_key": "1", ":updated_at": "x"}), "{broken"])
    write_page(root / "month=02" / "part-00000.jsonl.gz", [json.dumps({"unique_key": "2", "other": 1})])
    rows = scan_pages(spark, f"{root}/month=*/*.gz", keep_corrupt=True)
    got = rows.select("unique_key", F.col("`:updated_at`"), "_corrupt_record").collect()
    assert sorted(map(tuple, got), key=repr) == [("1", "x", None), ("2", None, None), (None, None, "{broken")]

    digests = {r.compressed_bytes: r.compressed_sha256 for r in file_digests(spark, str(root)).collect()}
    for page in root.glob("month=*/*.gz"):
        content = page.read_bytes()
        assert digests[len(content)] == hashlib.sha256(content).hexdigest()


def test_latest_snapshot_by_name(spark, tmp_path):
    for time, name, values in [("20250101T000000Z", "a", [1]), ("20250102T000000Z", "a", [2, 3]), ("20250101T000000Z", "b", [4])]:
        folder = tmp_path / time
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text(json.dumps([{"v": v} for v in values]))
    newest = pages.latest_batch(snapshots(spark, str(tmp_path)), "snapshot_name", "snapshot_time")
    assert sorted((r.snapshot_name, r.v) for r in newest.collect()) == [("a", 2), ("a", 3), ("b", 4)]


def build_extract(root, months, **manifest):
    for month, parts in months.items():
        folder = root / f"month={month:02d}"
        listed, rows = [], 0
        for i, keys in enumerate(parts):
            page = folder / f"part-{i:05d}.jsonl.gz"
            lines = [json.dumps({"created_date": f"2025-{month:02d}-01", "unique_key": k}) for k in keys]
            write_page(page, lines)
            text = "".join(f"{line}\n" for line in lines).encode()
            listed.append(
                {
                    "file": page.name, "rows": len(keys),
                    "compressed_sha256": hashlib.sha256(page.read_bytes()).hexdigest(),
                    "uncompressed_sha256": hashlib.sha256(text).hexdigest(),
                }
            )
            rows += len(keys)
        body = {"month": month, "rows": rows, "source_count_start": rows, "source_count_final": rows, "complete": True, "parts": listed}
        (folder / "manifest.json").write_text(json.dumps({**body, **manifest}))


def checks(spark, root):
    rows = validate_raw(spark, str(root)).collect()
    return {r.folder: (r.counts_match, r.parts_match, r.hashes_match, r.order_violations, r.duplicate_keys_overall) for r in rows}


def test_raw_validation_of_a_sound_extract(spark, tmp_path):
    build_extract(tmp_path, {1: [["1", "2", "3"], ["4"]], 2: [["5"]]})
    assert checks(spark, tmp_path) == {m: (True, True, True, 0, 0) for m in ("month=01", "month=02")}


def test_raw_validation_finds_faults(spark, tmp_path):
    build_extract(tmp_path, {1: [["1", "3", "2"], ["2", "4"]], 2: [["4"]]})
    assert checks(spark, tmp_path)["month=01"] == (True, True, True, 2, 2)
    write_page(tmp_path / "month=02" / "part-00000.jsonl.gz", ['{"unique_key": "9", "created_date": "a"}', '{"unique_key": "9", "created_date": "b"}'])
    assert checks(spark, tmp_path)["month=02"] == (False, False, False, 0, 2)


def test_raw_validation_sees_source_drift_and_lost_parts(spark, tmp_path):
    build_extract(tmp_path, {1: [["1"], ["2"]]}, source_count_final=3)
    assert checks(spark, tmp_path)["month=01"][:3] == (False, True, True)
    build_extract(tmp_path, {1: [["1"]]})
    assert checks(spark, tmp_path)["month=01"][:3] == (False, False, False)


def test_order_check_looks_past_broken_lines(spark):
    rows = [(1, "b", 1), (2, None, None), (3, "a", 1), (4, "c", None), (5, "b", 9)]
    frame = spark.createDataFrame(rows, "line int, day string, key int")
    found = pages.order_violations(frame, [], ["line"], ["day", "key"]).collect()
    assert sorted((r.line, r.previous_day) for r in found) == [(3, "b"), (5, "c")]
