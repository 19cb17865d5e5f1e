"""Declared columns, types and domains of the ticket warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names and domains that the data contract prescribes ------

RAW_FIELDS = [
    ":updated_at", "unique_key", "created_date", "closed_date", "agency", "agency_name",
    "complaint_type", "descriptor", "location_type", "incident_zip", "status", "due_date",
    "resolution_action_updated_date", "community_board", "council_district",
    "police_precinct", "borough", "open_data_channel_type", "latitude", "longitude",
]

# Order matters: the content hash runs over these columns in this order.
BUSINESS_FIELDS = [
    "source_updated_at", "created_date", "closed_date", "agency", "agency_name",
    "complaint_type", "descriptor", "location_type", "incident_zip", "status", "due_date",
    "resolution_action_updated_date", "community_board", "council_district",
    "police_precinct", "borough", "open_data_channel_type", "latitude", "longitude",
]

TEXT_FIELDS = [
    "unique_key", "agency", "agency_name", "complaint_type", "descriptor", "location_type",
    "incident_zip", "status", "community_board", "council_district", "police_precinct",
    "open_data_channel_type",
]

WALL_CLOCK_FIELDS = [
    "created_date", "closed_date", "due_date", "resolution_action_updated_date",
]

REQUIRED_FIELDS = ["unique_key", "created_date", "agency", "complaint_type", "status", "borough"]

QUALITY_FLAGS = [
    "MISSING_KEY", "INVALID_CREATED_DATE", "MISSING_AGENCY", "MISSING_COMPLAINT",
    "MISSING_STATUS", "NEGATIVE_DURATION", "CLOSED_WITHOUT_DATE", "ACTIVE_WITH_CLOSED_DATE",
]

RULE_METRICS = [
    "dwd_row_count", "duplicate_key_rows", "required_field_null_rows",
    "year_out_of_scope_rows", "coordinate_pair_mismatch_rows",
    "coordinate_out_of_range_rows", "negative_duration_rows", "closed_without_date_rows",
    "dws_reconciliation_gap", "mysql_reconciliation_gap",
]
RULE_SEVERITIES = ["BLOCK", "WARN"]
RULE_OPERATORS = ["eq", "lte", "rate_lte"]
RULE_KEY_PATTERN = "^[A-Za-z0-9_-]+$"

RUN_STATUSES = ["RUNNING", "SUCCEEDED", "FAILED"]
CHUNK_STATUSES = ["RUNNING", "COMMITTED", "FAILED"]
RELEASE_STATUSES = ["CANDIDATE", "ACTIVE", "REJECTED"]
ASSET_STATUSES = ["ACTIVE", "INACTIVE"]
DQ_RUN_STATUSES = ["RUNNING", "PASSED", "FAILED"]
DQ_RESULT_STATUSES = ["PASS", "WARN", "FAIL"]
JOB_STATUSES = ["QUEUED", "RUNNING", "SUCCEEDED", "FAILED"]
MAX_RETRY_LIMIT = 5
DEFAULT_RETRIES = 2
MAX_PAGE_SIZE = 100

LOCAL_ZONE = "America/New_York"
NULL_TOKEN = "<NULL>"
HASH_SEPARATOR = "\u001f"
UNKNOWN = "UNKNOWN"

# Key width of the staging table.
KEY_WIDTH = 32

# --- schemas -----------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

COORDINATE = T.DecimalType(10, 7)

EXPORT_FIELDS = ["unique_key", *BUSINESS_FIELDS, "content_hash_hex", "quality_flags"]

EXPORT_TIME_FIELDS = ["source_updated_at", *WALL_CLOCK_FIELDS]

EXPORT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EXPORT_FIELDS])
