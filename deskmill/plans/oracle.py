"""The ticket frames as SQL text for the comparison engine."""

from __future__ import annotations

from deskmill.plans.frames import FIRST_END, SECOND_START
from deskmill.schema import BUSINESS_FIELDS, LOCAL_ZONE
from deskmill.sources.tickets import TICKET_SQL

_OBSERVED = """
v AS (
  SELECT o.*, 1 AS ver FROM orders o
  UNION ALL
  SELECT o.*, 2 AS ver FROM orders o WHERE o.o_orderkey % 5 = 0
), b AS (
  SELECT v.*, c.c_mktsegment, n.n_name, r.r_name,
         CASE WHEN v.ver = 2 OR v.o_orderstatus = 'F' THEN 'Closed'
              WHEN v.o_orderstatus = 'O' THEN 'Open' ELSE 'In Progress' END AS st,
         v.o_orderdate + ((v.o_orderkey * 37) % 86400) * INTERVAL '1' SECOND AS created_ts
  FROM v JOIN customer c ON c.c_custkey = v.o_custkey
         JOIN nation n ON n.n_nationkey = c.c_nationkey
         JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

_TEXT = [
    "agency", "agency_name", "complaint_type", "descriptor", "location_type", "incident_zip",
    "status", "community_board", "council_district", "police_precinct", "open_data_channel_type",
]


def _clock(name: str) -> str:
    return f"try_cast(replace({name}, 'T', ' ') AS timestamp) AS {name}"


_NORMALISED = ",\n  ".join(
    ["trim(unique_key) AS unique_key", "try_cast(replace(updated_at, 'T', ' ') AS timestamp) AS source_updated_at"]
    + [_clock(c) for c in ("created_date", "closed_date", "due_date", "resolution_action_updated_date")]
    + [f"trim({c}) AS {c}" for c in _TEXT]
    + ["coalesce(upper(trim(borough)), 'UNKNOWN') AS borough"]
    + [f"try_cast({c} AS decimal(10,7)) AS {c}" for c in ("latitude", "longitude")]
    + ["observation"]
)

_FLAGS = """concat_ws(',',
    CASE WHEN unique_key IS NULL OR unique_key = '' THEN 'MISSING_KEY' END,
    CASE WHEN created_date IS NULL THEN 'INVALID_CREATED_DATE' END,
    CASE WHEN agency IS NULL OR agency = '' THEN 'MISSING_AGENCY' END,
    CASE WHEN complaint_type IS NULL OR complaint_type = '' THEN 'MISSING_COMPLAINT' END,
    CASE WHEN status IS NULL OR status = '' THEN 'MISSING_STATUS' END,
    CASE WHEN closed_date < created_date THEN 'NEGATIVE_DURATION' END,
    CASE WHEN upper(status) = 'CLOSED' AND closed_date IS NULL THEN 'CLOSED_WITHOUT_DATE' END,
    CASE WHEN upper(status) <> 'CLOSED' AND closed_date IS NOT NULL THEN 'ACTIVE_WITH_CLOSED_DATE' END)"""


def _hashed(name: str) -> str:
    value = name
    if name == "source_updated_at":
        value = f"timezone('{LOCAL_ZONE}', timezone('UTC', source_updated_at))"
    return f"coalesce(cast({value} AS varchar), '<NULL>')"


_HASH = f"sha256(concat_ws(chr(31), {', '.join(_hashed(c) for c in BUSINESS_FIELDS)}))"

_REJECT = """(unique_key IS NULL OR unique_key = '' OR created_date IS NULL
    OR agency IS NULL OR agency = '' OR complaint_type IS NULL OR complaint_type = ''
    OR status IS NULL OR status = '')"""


def _latest(source: str) -> str:
    return f"""SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY unique_key
    ORDER BY source_updated_at DESC NULLS LAST, content_hash_hex DESC) = 1"""


TICKETS = f"""{_OBSERVED}, fx AS ({TICKET_SQL.format(observed="b")}
), norm AS (
  SELECT {_NORMALISED} FROM fx
), enr AS (
  SELECT *, {_FLAGS} AS quality_flags, {_HASH} AS content_hash_hex,
    year(created_date) AS created_year, month(created_date) AS created_month
  FROM norm
), valid AS (
  SELECT * FROM enr WHERE NOT {_REJECT}
), rejected AS (
  SELECT * FROM enr WHERE {_REJECT}
), cur AS (
  {_latest("valid")}
)"""

RUNS = f""", run1_rows AS (
  SELECT * FROM valid WHERE observation = 1 AND created_date < timestamp '{FIRST_END}'
), run1 AS (
  {_latest("run1_rows")}
), run2_rows AS (
  SELECT * FROM valid WHERE created_date >= timestamp '{SECOND_START}'
), run2 AS (
  {_latest("run2_rows")}
), hist AS (
  SELECT unique_key, 1 AS run_id, content_hash_hex FROM run1
  UNION ALL
  SELECT unique_key, 2, content_hash_hex FROM run2 b
  WHERE NOT EXISTS (SELECT 1 FROM run1 a
    WHERE a.unique_key = b.unique_key AND a.content_hash_hex = b.content_hash_hex)
), merged AS (
  SELECT coalesce(o.unique_key, n.unique_key) AS unique_key,
    CASE WHEN n.unique_key IS NOT NULL
      AND (o.unique_key IS NULL OR o.content_hash_hex <> n.content_hash_hex)
      THEN n.status ELSE o.status END AS status,
    CASE WHEN n.unique_key IS NOT NULL
      AND (o.unique_key IS NULL OR o.content_hash_hex <> n.content_hash_hex)
      THEN n.created_date ELSE o.created_date END AS created_date,
    CASE WHEN n.unique_key IS NOT NULL
      AND (o.unique_key IS NULL OR o.content_hash_hex <> n.content_hash_hex)
      THEN n.source_updated_at ELSE o.source_updated_at END AS source_updated_at,
    coalesce(n.content_hash_hex, o.content_hash_hex) AS content_hash_hex,
    CASE WHEN o.unique_key IS NOT NULL THEN 1 ELSE 2 END AS first_seen_run_id,
    CASE WHEN n.unique_key IS NOT NULL THEN 2 ELSE 1 END AS last_seen_run_id
  FROM run1 o FULL JOIN run2 n ON n.unique_key = o.unique_key
)"""


def over_tickets(query: str, more: str = "") -> str:
    """``query`` over the ticket frames fx, norm, enr, valid, rejected and cur."""
    return f"WITH {TICKETS}{more}\n{query}"


def over_runs(query: str, more: str = "") -> str:
    """``query`` over the ticket frames and run1, run2, hist and merged."""
    return f"WITH {TICKETS}{RUNS}{more}\n{query}"
