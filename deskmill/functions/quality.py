"""Row-level quality rules and the content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from deskmill.functions.text import is_blank, is_closed
from deskmill.functions.times import local_clock
from deskmill.schema import BUSINESS_FIELDS, HASH_SEPARATOR, LOCAL_ZONE, NULL_TOKEN


def quality_flags() -> Column:
    """Names of the broken rules of one normalised ticket, in a fixed order."""
    created, closed = F.col("created_date"), F.col("closed_date")
    closed_status = is_closed(F.col("status"))
    rules = {
        "MISSING_KEY": is_blank(F.col("unique_key")),
        "INVALID_CREATED_DATE": created.isNull(),
        "MISSING_AGENCY": is_blank(F.col("agency")),
        "MISSING_COMPLAINT": is_blank(F.col("complaint_type")),
        "MISSING_STATUS": is_blank(F.col("status")),
        "NEGATIVE_DURATION": closed < created,
        "CLOSED_WITHOUT_DATE": closed_status & closed.isNull(),
        "ACTIVE_WITH_CLOSED_DATE": ~closed_status & closed.isNotNull(),
    }
    return F.array_compact(F.array(*[F.when(test, name) for name, test in rules.items()]))


def is_rejected() -> Column:
    """A ticket without key, created date, agency, complaint or status is not loaded."""
    bad = F.col("created_date").isNull()
    for name in ("unique_key", "agency", "complaint_type", "status"):
        bad = bad | is_blank(F.col(name))
    return bad


def content_hash(
    columns: Sequence[str] = tuple(BUSINESS_FIELDS), zone: str = LOCAL_ZONE
) -> Column:
    """SHA-256 over the business columns as text; the update instant as ``zone`` shows it."""
    parts = []
    for name in columns:
        value = F.col(name)
        if name == "source_updated_at":
            value = local_clock(value, zone)
        parts.append(F.coalesce(value.cast("string"), F.lit(NULL_TOKEN)))
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
