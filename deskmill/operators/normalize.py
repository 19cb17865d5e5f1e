"""Raw text rows to typed, flagged and hashed tickets (all in one projection)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deskmill.functions.quality import content_hash, is_rejected, quality_flags
from deskmill.functions.text import borough_name
from deskmill.functions.times import instant, wall_clock
from deskmill.schema import (
    BUSINESS_FIELDS,
    COORDINATE,
    LOCAL_ZONE,
    TEXT_FIELDS,
    WALL_CLOCK_FIELDS,
)


def normalize(raw: DataFrame, *keep: str) -> DataFrame:
    """Trim, parse and type the raw fields; ``keep`` names extra columns to carry along."""
    typed = {name: F.trim(F.col(name)) for name in TEXT_FIELDS}
    typed |= {name: wall_clock(F.col(name)) for name in WALL_CLOCK_FIELDS}
    typed |= {name: F.col(name).try_cast(COORDINATE) for name in ("latitude", "longitude")}
    typed["source_updated_at"] = instant(F.col("`:updated_at`"))
    typed["borough"] = borough_name(F.col("borough"))
    order = ["unique_key", *BUSINESS_FIELDS]
    return raw.select(*[typed[name].alias(name) for name in order], *keep)


def enrich(normalised: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Add the quality flags, the content hash and the partition columns."""
    return normalised.withColumns(
        {
            "quality_flags": quality_flags(),
            "content_hash_hex": content_hash(zone=zone),
            "created_year": F.year("created_date"),
            "created_month": F.month("created_date"),
        }
    )


def split_rejects(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); the test is never null, so every row is in exactly one."""
    return enriched.filter(~is_rejected()), enriched.filter(is_rejected())
