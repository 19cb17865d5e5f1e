"""Stored layers, lookups through them, maintained counts, sketches and rank sums."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from deskmill.operators import closure_model, marts, profile
from deskmill.operators.versions import changed_rows, upsert_current
from deskmill.plans import layers
from deskmill.plans import marts as queries


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- layers -------------------------------------------------------------------


def test_a_layer_is_written_once_per_state(spark, folder, monkeypatch):
    before = layers.detail(spark, folder)
    monkeypatch.setattr(layers.frames, "enriched", lambda *a: pytest.fail("built again"))
    assert layers.detail(spark, folder).inputFiles() == before.inputFiles()


def test_new_code_gives_new_layers_and_old_ones_go(spark, folder, monkeypatch):
    layers.ledger(spark, folder)
    with monkeypatch.context() as patch:
        for state in ("a", "b", "c"):
            patch.setattr(layers, "code_state", lambda state=state: state)
            assert layers._layer(spark, folder, f"probe_{state}", lambda: spark.range(3).toDF("id"), layers._plain).count() == 3
        assert layers.remove_old(spark, folder, keep=1) == 3
        assert layers._layer(spark, folder, "probe_c", lambda: pytest.fail("gone"), layers._plain).count() == 3
    layers.remove_old(spark, folder)


def test_half_a_layer_is_never_read(spark, folder):
    def fail(rows, path):
        rows.write.parquet(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        layers._layer(spark, folder, "probe_half", lambda: spark.range(2).toDF("id"), fail)
    assert layers._layer(spark, folder, "probe_half", lambda: spark.range(4).toDF("id"), layers._plain).count() == 4


# --- lookups ------------------------------------------------------------------


def test_point_lookup_opens_one_bucket(spark, folder):
    found = queries.q1_point_lookup(spark, folder)
    text = plan(found)
    assert "PartitionFilters: [isnotnull(key_bucket" in text and "PushedFilters: [IsNotNull(unique_key), EqualTo(unique_key" in text
    rows = layers.by_key(spark, folder)
    assert rows.filter(F.col("key_bucket") != layers.key_bucket(F.col("unique_key"))).isEmpty()
    smallest = layers.detail(spark, folder).agg(F.min("unique_key")).first()[0]
    assert [r.unique_key for r in found.collect()] == [smallest]


def test_cursor_and_range_queries_prune_months(spark, folder):
    for query in (queries.q2_cursor_page, queries.agency_status_range_count):
        text = plan(query(spark, folder))
        assert "PartitionFilters: [" in text and "created_year" in text.split("PartitionFilters: [")[1].split("]")[0]


# --- maintained counts ----------------------------------------------------------


def test_counts_follow_changes_over_two_runs(spark, tickets):
    first = tickets(*[{"unique_key": str(i), "borough": "queens" if i % 2 else "bronx"} for i in range(20)])
    second = tickets(
        *[{"unique_key": str(i), "status": "Closed", "borough": "bronx"} for i in range(5)],
        {"unique_key": "6", "borough": "bronx"}, {"unique_key": "50", "complaint_type": "Rats", "agency": "DOT"},
    )
    third = tickets({"unique_key": "50", "complaint_type": "Mice", "agency": "DOT"}, {"unique_key": "51"})
    one = F.lit(1).cast("bigint")
    now = first.withColumns({"first_seen_run_id": one, "last_seen_run_id": one})
    stored = {name: s.count(now, F.lit(1)) for name, s in marts.SERVING.items()}
    for run, batch in enumerate((second, third), 2):
        moved = changed_rows(batch, now)
        stored = {name: marts.maintained(rows, moved, name, F.lit(run)) for name, rows in stored.items()}
        now = upsert_current(now, batch, F.lit(run).cast("bigint"))
        for name, s in marts.SERVING.items():
            assert sorted_rows(stored[name]) == sorted_rows(s.count(now, F.lit(run)))
    assert "Rats" not in {r.complaint_type for r in stored["ads_complaint"].collect()}  # counts of nothing leave


def test_maintained_tables_never_read_the_tickets(spark, folder):
    for name in marts.SERVING:
        read = queries.QUERIES[f"{name}_maintained"](spark, folder).inputFiles()
        kinds = {f.split("/layers/")[1].split("/")[2] for f in read}
        assert kinds == {f"{name}_run_1", "changes"}


# --- sketches, rank sums, counts ---------------------------------------------------


def test_merged_sketches_keep_the_rank_error(spark):
    draw = random.Random(3)
    values = [(i % 12, None if i % 97 == 0 else draw.random() ** 3 * 1000) for i in range(60_000)]
    rows = spark.createDataFrame(values, "month int, v double")
    sketches = profile.quantile_sketches(rows, F.col("v"), "month")
    assert sketches.agg(F.sum("value_count")).first()[0] == 60_000 - 619
    found = profile.merged_quantiles(sketches, [0.0, 0.1, 0.5, 0.99, 1.0])
    checked = profile.rank_check(rows, "v", found).collect()
    assert [r.fraction for r in checked] == [0.0, 0.1, 0.5, 0.99, 1.0] and all(r.within_error for r in checked)
    wrong = spark.createDataFrame([(0.5, 900.0)], "fraction double, value double")
    assert not profile.rank_check(rows, "v", wrong).first().within_error


@pytest.mark.parametrize("grid", [3, 40, 10**6])
def test_areas_are_those_of_the_evaluator(spark, grid):
    draw = random.Random(grid)
    rows = [(draw.randrange(grid) / grid, float(draw.random() < 0.3)) for _ in range(700)]
    rows += [(0.5, 1.0)] * 300  # a very common score
    frame = spark.createDataFrame(rows, "score double, label double").repartition(5)
    got = closure_model.areas_by_rank(frame).first()
    for metric, value in (("areaUnderROC", got.roc_auc), ("areaUnderPR", got.pr_auc)):
        exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0)
        assert value == pytest.approx(exact.evaluate(frame), abs=2e-6)
    assert got.positive + got.negative == 1000
    none = closure_model.areas_by_rank(frame.filter("label = 1")).first()
    assert (none.roc_auc, none.pr_auc, none.negative) == (None, None, 0)
    assert closure_model.areas_by_rank(frame.limit(0)).first().positive == 0


def test_counts_by_month_and_flag(tickets):
    rows = tickets({}, {"unique_key": "2", "status": "Closed"}, {"unique_key": "3", "created_date": "2025-03-01T00:00:00.000"}, {"unique_key": "4", "agency": ""})
    got = {(r.kind, r.name): r.row_count for r in profile.counts_by_month_and_flag(rows).collect()}
    assert got == {("month", "2025-01"): 3, ("month", "2025-03"): 1, ("flag", "CLOSED_WITHOUT_DATE"): 1, ("flag", "MISSING_AGENCY"): 1}


# --- layers by key --------------------------------------------------------------


def test_versions_and_merges_of_stored_tickets_shuffle_nothing(spark, folder):
    from deskmill.operators.versions import append_history, classify_changes, latest_version
    from deskmill.plans import frames

    layers.parsed(spark, folder)
    now, batch = layers.after_run_1(spark, folder), layers.run_2(spark, folder)
    number = F.lit(2).cast("bigint")
    made = [
        latest_version(layers._valid(spark, folder)),
        upsert_current(now, batch, number),
        classify_changes(batch, now),
        append_history(frames.history_of(layers.run_1(spark, folder), 1), batch, number),
    ]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert all("Exchange" not in plan(df.select("*")) for df in made)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_keyed_layer_has_one_file_a_bucket_and_loses_no_row(spark, folder):
    from deskmill.plans import frames

    rows = layers.parsed(spark, folder)
    assert len(rows.inputFiles()) <= layers.buckets(spark, folder)
    plain = frames.enriched(spark, folder, "observation")
    assert rows.count() == plain.count()
    assert rows.exceptAll(plain).isEmpty()
    again = layers.run_1(spark, folder)
    assert again.count() == frames.first_run(spark, folder).count()
    assert again.exceptAll(frames.first_run(spark, folder)).isEmpty()


def test_the_stored_load_copies_no_tickets(spark, folder):
    store = layers.ticket_store(spark, folder)
    place, files = layers._file_system(spark, f"{store.root}/staging")
    assert not files.exists(place)
    state = layers.after_run_2(spark, folder)
    columns = ["unique_key", "content_hash_hex", "first_seen_run_id", "last_seen_run_id"]
    assert sorted_rows(store.current().select(columns)) == sorted_rows(state.select(columns))
    seen = layers.history(spark, folder).select("unique_key", "run_id", "content_hash_hex")
    assert sorted_rows(store.history().select(seen.columns)) == sorted_rows(seen)
