"""Queries on the closure-time labels, features and classifier."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.operators import closure_model as model
from deskmill.plans import layers
from deskmill.plans.oracle import over_tickets
from deskmill.sources.tables import table

TRAIN_END = "1999-06-01"
VALIDATION_END = "2000-06-01"
SCOPE_END = "2001-06-01"


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return model.labelled(layers.detail(spark, folder), TRAIN_END, VALIDATION_END, SCOPE_END)


def closure_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled(spark, folder)
    hours = F.round(model.closure_hours(), 6).alias("closure_hours")
    return rows.select("unique_key", hours, "label", "split")


def label_split_profile(spark: SparkSession, folder: str) -> DataFrame:
    return model.label_profile(_labelled(spark, folder))


def ml_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.features(_labelled(spark, folder))
    cycles = [F.round(c, 9).alias(c) for c in model.CYCLES]
    return rows.select("unique_key", *model.CATEGORIES, "created_hour", *cycles, "label", "split")


def _event_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores for the metric queries: event value as a share of the largest value."""
    events = table(spark, folder, "events")
    largest = events.agg(F.max("value")).scalar()
    label = F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)
    return events.select((F.col("value") / largest).alias("score"), label.alias("label"))


_GRID = [0.01, 0.02, 0.05, 0.30, 0.70]


def confusion_by_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return model.confusion(_event_scores(spark, folder), _GRID)


def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return model.best_threshold(confusion_by_threshold(spark, folder))


def majority_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return model.majority_baseline(_labelled(spark, folder).filter("split = 'test'"))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.features(_labelled(spark, folder))
    fitted = model.fit(rows.filter("split = 'train'"))
    return model.score(fitted, rows.filter("split <> 'train'"))


def closure_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("unique_key", "split", "label", F.round("score", 6).alias("score"))


def model_auc(spark: SparkSession, folder: str) -> DataFrame:
    test = _scored(spark, folder).filter("split = 'test'").select("label", "rawPrediction")
    kept = test.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, roc, pr = kept.count(), model.area_under(kept, "areaUnderROC"), model.area_under(kept, "areaUnderPR")
    finally:
        kept.unpersist()
    return spark.range(1).select(
        F.lit(rows).cast("bigint").alias("row_count"),
        F.lit(round(roc, 6)).alias("roc_auc"),
        F.lit(round(pr, 6)).alias("pr_auc"),
    )


def auc_by_rank(spark: SparkSession, folder: str) -> DataFrame:
    return model.areas_by_rank(_event_scores(spark, folder))


QUERIES = {
    "closure_label": closure_label,
    "label_split_profile": label_split_profile,
    "ml_features": ml_features,
    "confusion_by_threshold": confusion_by_threshold,
    "best_threshold": best_threshold,
    "majority_baseline": majority_baseline,
    "closure_model_scores": closure_model_scores,
    "model_auc": model_auc,
    "auc_by_rank": auc_by_rank,
}

_LABELLED = f""", lab AS (
  SELECT *, CASE WHEN upper(status) = 'CLOSED' AND h >= 0 AND h <= 48 THEN 1.0::double ELSE 0.0::double END AS label,
    CASE WHEN created_date < timestamp '{TRAIN_END}' THEN 'train'
      WHEN created_date < timestamp '{VALIDATION_END}' THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, datesub('second', created_date, closed_date) / 3600.0 AS h FROM cur)
  WHERE created_date < timestamp '{SCOPE_END}'
)"""


def _circle(name: str, value: str, period: int) -> str:
    return f"round(sin({value} * 2 * pi() / {period}), 9) + 0.0 AS {name}_sin, round(cos({value} * 2 * pi() / {period}), 9) + 0.0 AS {name}_cos"


_CONFUSION = f"""s AS (
  SELECT value / (SELECT max(value) FROM events) AS score, event_type = 'purchase' AS hit FROM events
), c AS (
  SELECT threshold, count(*) FILTER (score >= threshold AND hit) AS tp, count(*) FILTER (score >= threshold AND NOT hit) AS fp,
    count(*) FILTER (score < threshold AND hit) AS fn, count(*) FILTER (score < threshold AND NOT hit) AS tn
  FROM s, (SELECT unnest({_GRID}::double[]) AS threshold) GROUP BY threshold
), p AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS pr,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS re FROM c
), grid AS (
  SELECT threshold, tp, fp, fn, tn, round(pr, 6) AS precision, round(re, 6) AS recall,
    round(CASE WHEN pr + re = 0 THEN 0.0 ELSE pr * re * 2 / (pr + re) END, 6) AS f1,
    round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM p
)"""

ORACLE = {
    "closure_label": over_tickets(
        "SELECT unique_key, round(h, 6) AS closure_hours, label, split FROM lab", _LABELLED
    ),
    "label_split_profile": over_tickets(
        """SELECT split, count(*) AS row_count, cast(sum(label) AS bigint) AS positive,
  round(sum(label) / count(*), 6) AS positive_rate FROM lab GROUP BY split""",
        _LABELLED,
    ),
    "ml_features": over_tickets(
        f"""SELECT unique_key, coalesce(agency, 'UNKNOWN') AS agency, coalesce(complaint_type, 'UNKNOWN') AS complaint_type,
  coalesce(borough, 'UNKNOWN') AS borough, coalesce(open_data_channel_type, 'UNKNOWN') AS open_data_channel_type,
  hour(created_date)::double AS created_hour, {_circle("hour", "hour(created_date)", 24)},
  {_circle("dow", "(dayofweek(created_date) + 1)", 7)}, {_circle("month", "month(created_date)", 12)},
  label, split FROM lab""",
        _LABELLED,
    ),
    "confusion_by_threshold": f"WITH {_CONFUSION} SELECT * FROM grid",
    "best_threshold": f"WITH {_CONFUSION} SELECT * FROM grid ORDER BY f1 DESC, threshold LIMIT 1",
    "auc_by_rank": """WITH s AS (
  SELECT value / (SELECT max(value) FROM events) AS score, (event_type = 'purchase')::bigint AS hit FROM events
), g AS (
  SELECT score, sum(hit)::bigint AS p, count(*) - sum(hit)::bigint AS n FROM s GROUP BY score
), c AS (
  SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, (SELECT sum(p) FROM g) AS ps, (SELECT sum(n) FROM g) AS ns
  FROM g WINDOW w AS (ORDER BY score DESC)
), pts AS (
  SELECT *, tp / ps AS r, tp / (tp + fp) AS pr, lag(tp / ps, 1, 0.0) OVER o AS r0,
    lag(tp / (tp + fp)) OVER o AS pr0 FROM c WINDOW o AS (ORDER BY score DESC)
)
SELECT sum(p)::bigint AS positive, sum(n)::bigint AS negative,
  round(sum(n * (tp - p / 2.0)) / max(ps) / max(ns), 6) AS roc_auc,
  round(sum((r - r0) * (pr + coalesce(pr0, pr)) / 2), 6) AS pr_auc FROM pts""",
    "majority_baseline": over_tickets(
        """SELECT round(avg(label), 6) AS positive_rate,
  round(greatest(avg(label), 1 - avg(label)), 6) AS majority_accuracy FROM lab WHERE split = 'test'""",
        _LABELLED,
    ),
}
