"""Rules, assets and lineage of a governance configuration file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

SHAPE = """
  release_key string, expected_rows bigint,
  quality_rules array<struct<rule_key string, name string, dimension string, severity string,
    metric string, operator string, threshold decimal(20,6)>>,
  assets array<struct<asset_key string, name string, layer string, storage_type string,
    physical_name string, owner string, update_cycle string, primary_key string,
    partitioning string, description string>>,
  lineage array<struct<upstream string, downstream string, transform string>>
"""


@dataclass
class Governance:
    release_key: str
    expected_rows: int
    rules: DataFrame
    assets: DataFrame
    lineage: DataFrame


def read_governance(spark: SparkSession, path: str, name_field: str = "name") -> Governance:
    """Read one JSON file; ``name_field`` is the field that holds the asset names."""
    shape = SHAPE.replace("asset_key string, name string", f"asset_key string, {name_field} string")
    config = spark.read.schema(shape).option("multiLine", "true").json(path)
    head = config.select("release_key", "expected_rows").first()
    rules = config.select(F.inline("quality_rules")).withColumnRenamed("name", "rule_name")
    assets = config.select(F.inline("assets"))
    return Governance(
        head.release_key,
        head.expected_rows,
        rules.withColumn("is_enabled", F.lit(True)),
        assets.withColumnRenamed(name_field, "asset_name").withColumn("status", F.lit("ACTIVE")),
        config.select(F.inline("lineage")),
    )
