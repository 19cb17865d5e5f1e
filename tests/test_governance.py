"""Rules, registries and lineage on literal rows."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from deskmill.operators import governance as gov
from deskmill.operators import lineage
from deskmill.plans.warehouse import quality_run
from deskmill.sources.config import read_governance

RULE = (
    "rule_key string, rule_name string, dimension string, severity string, metric string, "
    "operator string, threshold decimal(20,6), is_enabled boolean"
)

# Published result of one run: metric values, and the expected outcome of each rule.
ROWS = 3655040
METRICS = {
    "dwd_row_count": ROWS, "duplicate_key_rows": 0, "required_field_null_rows": 0,
    "year_out_of_scope_rows": 0, "coordinate_pair_mismatch_rows": 0,
    "coordinate_out_of_range_rows": 0, "negative_duration_rows": 916,
    "closed_without_date_rows": 6024, "dws_reconciliation_gap": 0, "mysql_reconciliation_gap": 0,
}
CHECKS = [
    ("DQ001", "BLOCK", "dwd_row_count", "eq", ROWS, "PASS", 0.0),
    ("DQ002", "BLOCK", "duplicate_key_rows", "eq", 0, "PASS", 0.0),
    ("DQ007", "WARN", "negative_duration_rows", "lte", 0, "WARN", 0.0002506129),
    ("DQ008", "WARN", "closed_without_date_rows", "rate_lte", 0.001, "WARN", 0.0016481352),
    ("DQ009", "BLOCK", "dws_reconciliation_gap", "eq", 0, "PASS", 0.0),
]


def rules(spark, checks=CHECKS):
    from decimal import Decimal

    return spark.createDataFrame(
        [(k, k, "d", sev, m, op, Decimal(str(t)), True) for k, sev, m, op, t, *_ in checks], RULE
    )


def metrics(spark, **changed):
    values = {**METRICS, **changed}
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} bigint" for n in values))


def test_published_outcome(spark):
    got = gov.evaluate_rules(metrics(spark), rules(spark)).orderBy("rule_key").collect()
    assert [(r.rule_key, r.result_status, r.failure_rate) for r in got] == [(c[0], c[5], c[6]) for c in CHECKS]
    verdict = gov.verdict(gov.evaluate_rules(metrics(spark), rules(spark))).first()
    assert tuple(verdict) == (3, 2, 0, "PASSED")


def test_blocking_failure_fails_the_run(spark):
    results = gov.evaluate_rules(metrics(spark, dwd_row_count=ROWS - 10), rules(spark))
    assert gov.verdict(results).first().status == "FAILED"
    row = results.filter("rule_key = 'DQ001'").first()
    assert row.failure_rate == round(10 / ROWS, 10)


def test_zero_denominators_give_zero(spark):
    empty = metrics(spark, dwd_row_count=0, negative_duration_rows=0)
    checks = [("A", "WARN", "dwd_row_count", "eq", 0), ("B", "WARN", "negative_duration_rows", "rate_lte", 0)]
    got = gov.evaluate_rules(empty, rules(spark, checks)).collect()
    assert [(r.failure_rate, r.result_status) for r in got] == [(0.0, "PASS")] * 2


def test_metrics_of_no_rows(tickets):
    row = gov.quality_metrics(tickets({}).filter("false"), 2025).first()
    assert set(row) == {0}


def test_registry_keeps_the_switch(spark):
    old = spark.createDataFrame([("a", 1, False), ("b", 1, True)], "k string, t int, is_enabled boolean")
    new = spark.createDataFrame([("a", 2), ("c", 3)], "k string, t int")
    got = gov.merge_registry(old, new, ["k"], {"is_enabled": F.lit(True)}, ["is_enabled"])
    assert sorted(map(tuple, got.collect())) == [("a", 2, False), ("b", 1, True), ("c", 3, True)]


def test_rule_definitions(spark):
    rows = [
        ("ok-1", "n", "d", "WARN", "duplicate_key_rows", "lte", 0, True),
        ("OK-1", "n", "d", "WARN", "duplicate_key_rows", "lte", 0, True),
        ("bad key", "n", "d", "WARN", "duplicate_key_rows", "lte", 0, True),
        ("m", "n", "d", "WARN", "missing_key", "lte", 0, True),
        ("s", " ", None, "INFO", "dwd_row_count", "gt", -1, True),
    ]
    from decimal import Decimal

    df = spark.createDataFrame([(*r[:6], Decimal(r[6]), r[7]) for r in rows], RULE)
    assert sorted(map(tuple, gov.rule_violations(df).collect())) == sorted(
        [("OK-1", "DUPLICATE_KEY"), ("bad key", "BAD_KEY"), ("m", "BAD_METRIC")]
        + [("s", v) for v in ("MISSING_NAME", "MISSING_DIMENSION", "BAD_SEVERITY", "BAD_OPERATOR", "BAD_THRESHOLD")]
    )


def edges(spark, *pairs):
    return spark.createDataFrame([(a, b, "t") for a, b in pairs], "upstream string, downstream string, transform string")


def test_closure_of_a_dag_and_a_cycle(spark):
    starts = spark.createDataFrame([("a",), ("b",), ("c",)], "asset_key string")
    dag = lineage.closure(edges(spark, ("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")), starts).collect()
    assert sorted(map(tuple, dag)) == [("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("b", "c", 1), ("b", "d", 2), ("c", "d", 1)]
    loop = lineage.closure(edges(spark, ("a", "b"), ("b", "a")), starts).collect()
    assert sorted((r.ancestor, r.descendant) for r in loop) == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]


def test_cyclic_core(spark):
    assert lineage.cyclic_core(edges(spark, ("a", "b"), ("b", "c"), ("a", "c"))).isEmpty()
    core = lineage.cyclic_core(edges(spark, ("x", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "y"))).collect()
    assert sorted(map(tuple, core)) == [("a", "b"), ("b", "c"), ("c", "a")]
    assert lineage.cyclic_core(edges(spark, ("a", "a"))).count() == 1


def test_cycle_edges_leave_bridges_out(spark):
    assert lineage.cycle_edges(edges(spark, ("a", "b"), ("b", "c"), ("a", "c"))).isEmpty()
    bridged = [("a", "b"), ("b", "a"), ("b", "m"), ("m", "c"), ("c", "d"), ("d", "c"), ("d", "e"), ("z", "z"), ("z", "a")]
    found = lineage.cycle_edges(edges(spark, *bridged)).collect()
    assert sorted(map(tuple, found)) == [("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), ("z", "z")]


def on_cycles(pairs):
    reach = {}
    for a, b in pairs:
        reach.setdefault(a, set()).add(b)

    def below(node):
        seen, left = set(), [node]
        while left:
            for n in reach.get(left.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    left.append(n)
        return seen

    under = {n: below(n) for n in {x for p in pairs for x in p}}
    return sorted({(a, b) for a, b in pairs if a in under[b] or a == b})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cycle_edges_of_random_graphs(spark, seed):
    draw = random.Random(seed)
    nodes = [f"n{i}" for i in range(40)]
    pairs = [(draw.choice(nodes), draw.choice(nodes)) for _ in range(45)]
    pairs += [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)] + [(f"t{i}", f"t{i + 1}") for i in range(9)]
    pairs += [("t9", nodes[0]), (nodes[1], "r0"), ("r4", nodes[2]), ("r0", "r2")]
    assert sorted(map(tuple, lineage.cycle_edges(edges(spark, *pairs)).collect())) == on_cycles(pairs)


def test_a_long_ring_takes_few_rounds(spark):
    n = 100_000
    ring = spark.range(n).select(
        F.concat(F.lit("a"), F.col("id").cast("string")).alias("upstream"),
        F.concat(F.lit("a"), ((F.col("id") + 1) % n).cast("string")).alias("downstream"), F.lit("t").alias("transform"),
    )
    tail = spark.range(500).select(
        F.concat(F.lit("a"), (-F.col("id")).cast("string")).alias("upstream"),
        F.concat(F.lit("a"), (-F.col("id") - 1).cast("string")).alias("downstream"), F.lit("t").alias("transform"),
    )
    graph, moves, loops = lineage.contracted(ring.unionByName(tail))
    assert len(moves) <= 40 and graph.isEmpty() and loops.count() == 1
    assert lineage.cycle_edges(ring.limit(2000).unionByName(tail)).isEmpty()


def config(tmp_path, **changed):
    asset = {"layer": "l", "storage_type": "s", "physical_name": "p", "owner": "o"}
    body = {
        "release_key": "r", "expected_rows": 1,
        "quality_rules": [{"rule_key": "DQ1", "name": "n", "dimension": "d", "severity": "BLOCK", "metric": "dwd_row_count", "operator": "eq", "threshold": 1}],
        "assets": [{"asset_key": k, "name_xx": k, **asset} for k in "abc"],
        "lineage": [{"upstream": "a", "downstream": "b", "transform": "t"}],
        **changed,
    }
    path = tmp_path / "governance.json"
    path.write_text(json.dumps(body))
    return str(path)


def test_quality_run(spark, tickets, tmp_path):
    found = read_governance(spark, config(tmp_path), name_field="name_xx")
    assert (found.release_key, found.expected_rows, found.assets.count()) == ("r", 1, 3)
    detail = tickets({})
    from deskmill.operators.marts import daily_summary

    args = (detail, daily_summary(detail), detail, 2025)
    assert quality_run(found, *args, 1, str(tmp_path / "out")).first().status == "PASSED"
    assert quality_run(found, *args, 1, str(tmp_path / "out")).first().status == "PASSED"
    more = tickets({}, {"unique_key": "2"})
    assert quality_run(found, more, daily_summary(more), more, 2025, 2, str(tmp_path / "out")).first().status == "FAILED"
    assert spark.read.parquet(str(tmp_path / "out" / "dq_result")).count() == 2
    runs = spark.read.parquet(str(tmp_path / "out" / "dq_run")).orderBy("dq_run_id").collect()
    assert [(r.dq_run_id, r.run_key, r.release_key, r.status, r.checked_rows, r.passed_rules, r.warning_rules, r.failed_rules) for r in runs] == [
        (1, "dq-r-1", "r", "PASSED", 1, 1, 0, 0), (2, "dq-r-2", "r", "FAILED", 2, 0, 0, 1),
    ]
    assert all(r.finished_at for r in runs)


def test_stored_catalog(spark, tmp_path):
    spark.range(5).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "here"))
    got = gov.stored_catalog(spark, {"a": ("detail", str(tmp_path / "here")), "b": ("service", str(tmp_path / "gone"))})
    assert sorted(map(tuple, got.collect())) == [("a", "detail", 5, 2, "AVAILABLE"), ("b", "service", None, None, "MISSING")]
    assert "ReadSchema: struct<>" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pairs", [[("a", "zz")], [("a", "b"), ("b", "a")], [("a", "a")]])
def test_quality_run_refuses_bad_lineage(spark, tickets, tmp_path, pairs):
    bad = [{"upstream": a, "downstream": b, "transform": "t"} for a, b in pairs]
    found = read_governance(spark, config(tmp_path, lineage=bad), name_field="name_xx")
    with pytest.raises(ValueError):
        quality_run(found, tickets({}), tickets({}), tickets({}), 2025, 1, str(tmp_path / "out"))


PLANTED = {
    "pipeline_run": (
        "run_key string, status string, staged_rows bigint, inserted_rows bigint, started_at timestamp, finished_at timestamp",
        [("a", "SUCCEEDED", 5, 5, "2025-01-01", "2025-01-02"), ("b", "RUNNING", 0, 0, "2025-01-01", None)],
        {
            "run_key_missing": (" ", "FAILED", 0, 0, "2025-01-01", None),
            "status_unknown": ("c", "succeeded", 0, 0, "2025-01-01", None),
            "staged_rows_negative": ("d", "FAILED", -1, 0, "2025-01-01", None),
            "inserted_rows_negative": ("e", "FAILED", 0, -1, "2025-01-01", None),
            "run_key_too_long": ("x" * 101, "FAILED", 0, 0, "2025-01-01", None),
            "ends_before_start": ("f", "FAILED", 0, 0, "2025-01-02", "2025-01-01"),
        },
    ),
    "pipeline_chunk": (
        "run_id bigint, chunk_key string, status string, row_count bigint, updated_rows bigint",
        [(1, "m", "COMMITTED", 3, 1), (1, "n", "RUNNING", 0, 0), (2, "m", "FAILED", None, None)],
        {
            "run_id_missing": (None, "m", "RUNNING", 0, 0), "chunk_key_missing": (1, None, "RUNNING", 0, 0),
            "status_unknown": (1, "m", "SUCCEEDED", 0, 0), "row_count_negative": (1, "m", "RUNNING", -3, 0),
            "updated_rows_negative": (1, "m", "RUNNING", 0, -3), "chunk_key_too_long": (1, "k" * 161, "RUNNING", 0, 0),
        },
    ),
    "release_registry": (
        "release_key string, status string, row_count bigint",
        [("r", "ACTIVE", 1), ("s", "CANDIDATE", 0), ("t", "REJECTED", None)],
        {
            "release_key_missing": ("", "ACTIVE", 1), "status_unknown": ("u", "RETIRED", 1),
            "row_count_negative": ("v", "ACTIVE", -1), "release_key_too_long": ("w" * 101, "ACTIVE", 1),
        },
    ),
    "data_lineage": (
        "upstream string, downstream string",
        [("a", "b"), ("b", "a")],
        {"upstream_missing": (None, "a"), "downstream_missing": ("a", " "), "same_ends": ("a", "a")},
    ),
    "dq_rule": (
        "rule_key string, severity string",
        [("DQ001", "BLOCK"), ("DQ002", "WARN")],
        {"rule_key_missing": (None, "WARN"), "severity_unknown": ("DQ003", "INFO"), "rule_key_too_long": ("D" * 21, "WARN")},
    ),
    "dq_result": (
        "rule_key string, result_status string",
        [("DQ001", "PASS"), ("DQ002", "WARN"), ("DQ003", "FAIL")],
        {"rule_key_missing": (None, "PASS"), "result_status_unknown": ("DQ004", "SKIP"), "rule_key_too_long": ("D" * 21, "PASS")},
    ),
    "quality_job": (
        "job_key string, status string, max_retries int",
        [("j", "QUEUED", 5), ("k", "RUNNING", 0), ("l", "FAILED", None)],
        {"job_key_missing": (None, "QUEUED", 1), "status_unknown": ("m", "PAUSED", 1), "max_retries_over_limit": ("n", "QUEUED", 6)},
    ),
}


def test_domains_find_each_planted_row_and_nothing_else(spark):
    def frame(schema, rows):
        text = schema.replace("timestamp", "string")
        made = spark.createDataFrame(rows, text)
        clocks = [c.split()[0] for c in schema.split(", ") if c.endswith("timestamp")]
        return made.withColumns({c: F.to_timestamp(c) for c in clocks}) if clocks else made

    clean = {name: frame(schema, good) for name, (schema, good, _) in PLANTED.items()}
    assert {r.violations for r in gov.domain_checks(clean).collect()} == {0}
    bad = {name: frame(schema, good + list(rows.values())) for name, (schema, good, rows) in PLANTED.items()}
    got = {(r.table_name, r.check_name): r.violations for r in gov.domain_checks(bad).collect()}
    assert got == {(name, check): 1 for name, (_, _, rows) in PLANTED.items() for check in rows}
    empty = {name: rows.limit(0) for name, rows in clean.items()}
    assert {r.violations for r in gov.domain_checks(empty).collect()} == {0}


def test_domain_query_checks_the_states_of_jobs_and_quality_runs(spark, folder):
    from deskmill.plans import governance

    got = {(r.table_name, r.check_name): r.violations for r in governance.domain_violations(spark, folder).collect()}
    assert got["quality_jobs", "status_unknown"] == 0
    assert got["quality_runs", "status_unknown"] == 0
    assert len(got) == 10


def test_rule_metrics_read_stored_tickets_only(spark, folder):
    from deskmill.plans import governance

    assert all("/layers/" in f for f in governance._metrics(spark, folder).inputFiles())
