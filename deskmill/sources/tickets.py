"""Raw tickets derived from the order tables.

Every order becomes one ticket; every fifth order is observed twice, one day apart. The
rows carry padded and empty keys, broken dates, negative durations, mixed-case statuses
and missing coordinates, so that each rule has something to find. One scan of
``orders``; the dimension joins are left to the optimizer, which broadcasts a side only
below its size limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskmill.schema import RAW_FIELDS
from deskmill.sources.tables import table

TICKET_SQL = """
SELECT
  replace(cast(created_ts + ver * INTERVAL '1' DAY AS string), ' ', 'T') || '.000Z' AS updated_at,
  CASE WHEN o_orderkey % 997 = 3 THEN ''
       WHEN o_orderkey % 7 = 0 THEN ' ' || cast(o_orderkey AS string) || ' '
       ELSE cast(o_orderkey AS string) END AS unique_key,
  CASE WHEN o_orderkey % 991 = 5 THEN NULL
       WHEN o_orderkey % 983 = 6 THEN 'not-a-date'
       ELSE replace(cast(created_ts AS string), ' ', 'T') || '.000' END AS created_date,
  CASE WHEN st = 'Closed' AND o_orderkey % 173 <> 0 THEN
            replace(cast(created_ts + ((o_orderkey % 100) - 2) * INTERVAL '1' HOUR AS string), ' ', 'T') || '.000'
       WHEN st <> 'Closed' AND o_orderkey % 211 = 0 THEN
            replace(cast(created_ts + 5 * INTERVAL '1' HOUR AS string), ' ', 'T') || '.000' END AS closed_date,
  c_mktsegment AS agency,
  'Dept of ' || c_mktsegment AS agency_name,
  o_orderpriority AS complaint_type,
  cast(o_orderkey % 17 AS string) AS descriptor,
  cast(NULL AS string) AS location_type,
  cast(10000 + o_orderkey % 90 AS string) AS incident_zip,
  CASE WHEN o_orderkey % 13 = 0 THEN upper(st) ELSE st END AS status,
  cast(NULL AS string) AS due_date,
  cast(NULL AS string) AS resolution_action_updated_date,
  cast(o_orderkey % 18 AS string) AS community_board,
  cast(o_orderkey % 51 AS string) AS council_district,
  cast(o_orderkey % 77 AS string) AS police_precinct,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE lower(r_name) END AS borough,
  n_name AS open_data_channel_type,
  CASE WHEN o_orderkey % 307 = 0 THEN NULL
       ELSE cast(cast((o_orderkey % 190) - 95 AS decimal(10,7)) AS string) END AS latitude,
  cast(cast((o_orderkey % 361) - 180 AS decimal(10,7)) AS string) AS longitude,
  ver AS observation
FROM {observed}
"""

_STATUS = (
    "CASE WHEN ver = 2 OR o_orderstatus = 'F' THEN 'Closed' "
    "WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'In Progress' END"
)


# The key that a ticket has once it is normalised.
_KEY = "CASE WHEN o_orderkey % 997 = 3 THEN '' ELSE cast(o_orderkey AS string) END"


def raw_tickets(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """Raw tickets plus ``observation``, the number of the extract that saw the row.

    With ``tasks`` they are dealt to so many tasks by the normalised ticket key.

    The joins go from the large table outwards, so that each other side is a plain scan
    whose size is known. A joined side has no usable size estimate, and the optimizer
    may then broadcast the orders and run the rest in the few tasks of a dimension.
    """
    seen = F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    spread = [tasks, F.expr(_KEY)] if tasks else ["o_orderkey"]
    observed = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        # One Parquet row group is one task; everything after it is spread by the key, before
        # the rows become wide.
        .repartition(*spread)
        .withColumn("ver", F.explode(seen))
        .withColumn("st", F.expr(_STATUS))
        .withColumn(
            "created_ts",
            F.expr("o_orderdate + ((o_orderkey * 37) % 86400) * INTERVAL '1' SECOND"),
        )
    )
    tickets = spark.sql(TICKET_SQL.format(observed="{observed}"), observed=observed)
    return tickets.withColumnRenamed("updated_at", ":updated_at").select(
        *[F.col(f"`{name}`") for name in RAW_FIELDS], "observation"
    )
