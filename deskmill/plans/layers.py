"""Stored layers of the test warehouse: written once per state of input and code, then read.

The serving queries read these tables, as a warehouse does, and not the raw rows. A state is
known by path, size and time of the input files and by the code of the package, so changed
input or code gives new layers. A layer is written to a place of its own and then put under
its name, so half a layer is never read, and of two sessions the first one wins. Layers lie
in the shared checkpoint folder of the session.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from deskmill.functions.quality import is_rejected
from deskmill.functions.times import elapsed, month_name
from deskmill.operators import marts, profile
from deskmill.operators.versions import KEY, append_history, change_counts, changed_rows, classify_changes, latest_version, upsert_current
from deskmill.plans import frames
from deskmill.session import checkpoint_dir
from deskmill.sources import sinks
from deskmill.sources.store import TicketStore

INPUTS = ["orders", "customer", "nation", "region"]
# Bytes of stored orders whose tickets, as rows in memory, a task can sort without spilling.
BUCKET_BYTES = 2_000_000
LEAST_BUCKETS = 8
RELEASES = (1, 2)
KEY_BUCKETS = 16

# Schema of each layer, as its plan gives it; the same for any input.
_SCHEMAS: dict[str, StructType] = {}


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


@cache
def code_state() -> str:
    """Digest of the package's own modules; the training-data operators have no part in layers."""
    root = Path(__file__).resolve().parents[1]
    digest = hashlib.sha256()
    for file in sorted(p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts):
        digest.update(file.read_bytes())
    return digest.hexdigest()


def input_state(spark: SparkSession, folder: str) -> str:
    """Name of the present state of the input tables and the code."""
    seen = [code_state()]
    for name in INPUTS:
        place, files = _file_system(spark, f"{folder.rstrip('/')}/{name}.parquet")
        found = files.listFiles(place, True)
        while found.hasNext():
            file = found.next()
            seen.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:24]


def buckets(spark: SparkSession, folder: str) -> int:
    """Buckets by key of the parsed tickets and of all that is made from them key by key."""
    place, files = _file_system(spark, f"{folder.rstrip('/')}/orders.parquet")
    return max(LEAST_BUCKETS, -(-files.getContentSummary(place).getLength() // BUCKET_BYTES))


def _root(spark: SparkSession, folder: str) -> str:
    """Folder of all states of one input folder."""
    own = hashlib.sha256(folder.rstrip("/").encode()).hexdigest()[:12]
    return f"{checkpoint_dir(spark).rstrip('/')}/layers/{own}"


def _layer(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame],
    write: Callable[[DataFrame, str], None], keyed: bool = False,
) -> DataFrame:
    """The stored rows of a layer, which is written if it is not there.

    A ``keyed`` layer lies in buckets by ticket key and is read as such a table, so windows and
    joins by key need no shuffle.
    """
    path = f"{_root(spark, folder)}/{input_state(spark, folder)}/{name}"
    place, files = _file_system(spark, path)
    there = files.exists(place)
    table = f"deskmill_{hashlib.sha256(path.encode()).hexdigest()[:24]}" if keyed else None
    if table and not there:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # what it knows of older files
    if name not in _SCHEMAS or not there:
        rows = build()
        _SCHEMAS[name] = rows.schema
        if not there:
            aside = f"{path}-{uuid.uuid4().hex}"
            write(rows, aside)
            source, _ = _file_system(spark, aside)
            if files.exists(place) or not files.rename(source, place):
                files.delete(source, True)  # another session has written it meanwhile
    schema = _SCHEMAS[name]
    if table:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}) USING parquet LOCATION '{path}' "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets(spark, folder)} BUCKETS"
        )
        return spark.table(table)
    return spark.read.schema(schema).parquet(path).select(schema.names)


def place(spark: SparkSession, folder: str, name: str) -> str:
    """Where a layer lies, or would lie."""
    return f"{_root(spark, folder)}/{input_state(spark, folder)}/{name}"


def remove_old(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` states of this input folder; returns how many."""
    place, files = _file_system(spark, _root(spark, folder))
    now = input_state(spark, folder)
    states = sorted(files.listStatus(place), key=lambda s: (s.getPath().getName() == now, s.getModificationTime()))
    gone = states[:-keep]
    for state in gone:
        files.delete(state.getPath(), True)
    return len(gone)


def _plain(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def _by_ticket(spark: SparkSession, folder: str) -> Callable[[DataFrame, str], None]:
    """Writer of a keyed layer. The rows come dealt by key, so a bucket is one file."""

    def write(rows: DataFrame, path: str) -> None:
        table = f"deskmill_{uuid.uuid4().hex}"
        laid = rows.write.bucketBy(buckets(spark, folder), KEY).sortBy(KEY)
        laid.option("path", path).format("parquet").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay

    return write


def _keyed(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return _layer(spark, folder, name, build, _by_ticket(spark, folder), keyed=True)


def parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Every observation, normalised, flagged and hashed: parsed once for all layers below."""
    tasks = buckets(spark, folder)
    return _keyed(spark, folder, "parsed", lambda: frames.enriched(spark, folder, "observation", tasks=tasks))


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return parsed(spark, folder).filter(~is_rejected())


def detail(spark: SparkSession, folder: str) -> DataFrame:
    """Current tickets by created year and month."""
    build = lambda: latest_version(_valid(spark, folder).drop("observation"))
    return _layer(spark, folder, "dwd_ticket", build, sinks.write_detail)


def by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Current tickets in buckets by key, sorted by it, with a Bloom filter per row group."""

    def write(rows: DataFrame, path: str) -> None:
        laid = rows.repartition(KEY_BUCKETS, KEY).sortWithinPartitions("key_bucket", KEY)
        sinks.replaced(laid).option(f"parquet.bloom.filter.enabled#{KEY}", "true").partitionBy("key_bucket").parquet(path)

    build = lambda: detail(spark, folder).withColumn("key_bucket", key_bucket(F.col(KEY)))
    return _layer(spark, folder, "ticket_by_key", build, write)


def key_bucket(key):
    return F.pmod(F.hash(key), F.lit(KEY_BUCKETS))


def run_1(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets of the first load run."""

    def build() -> DataFrame:
        rows = _valid(spark, folder)
        seen = rows.filter((F.col("observation") == 1) & (F.col("created_date") < frames.day(frames.FIRST_END)))
        return latest_version(seen.drop("observation"))

    return _keyed(spark, folder, "run_1", build)


def run_2(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets of the second load run."""

    def build() -> DataFrame:
        rows = _valid(spark, folder).drop("observation")
        return latest_version(rows.filter(F.col("created_date") >= frames.day(frames.SECOND_START)))

    return _keyed(spark, folder, "run_2", build)


def after_run_1(spark: SparkSession, folder: str) -> DataFrame:
    """Current state after the first run."""
    one = F.lit(1).cast("bigint")
    return run_1(spark, folder).withColumns({"first_seen_run_id": one, "last_seen_run_id": one})


def after_run_2(spark: SparkSession, folder: str) -> DataFrame:
    """Current state after both runs."""
    build = lambda: upsert_current(after_run_1(spark, folder), run_2(spark, folder), F.lit(2).cast("bigint"))
    return _layer(spark, folder, "after_run_2", build, _plain)


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """What the second run changed, as signed rows: written while the run is loaded."""
    build = lambda: changed_rows(run_2(spark, folder), after_run_1(spark, folder))
    return _layer(spark, folder, "changes", build, _plain)


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk counts of both runs: one chunk per created month, the last ones still open."""

    def build() -> DataFrame:
        chunk = month_name(F.col("created_date")).alias("chunk_key")
        classified = classify_changes(run_2(spark, folder), after_run_1(spark, folder))
        second = change_counts(classified.withColumn("chunk_key", chunk), "chunk_key")
        first = run_1(spark, folder).groupBy(chunk).agg(F.count("*").alias("staged_rows"))
        zero = F.lit(0).cast("bigint")
        rows = first.select(
            F.lit(1).cast("bigint").alias("run_id"), "chunk_key", "staged_rows",
            F.col("staged_rows").alias("inserted_rows"), zero.alias("updated_rows"), zero.alias("unchanged_rows"),
        ).unionByName(second.withColumn("run_id", F.lit(2).cast("bigint")))
        open_ = (F.col("run_id") == 2) & (F.col("chunk_key") >= "2001-01")
        return rows.withColumnRenamed("staged_rows", "row_count").withColumn(
            "status", F.when(open_, "RUNNING").otherwise("COMMITTED")
        )

    return _layer(spark, folder, "ledger", build, lambda rows, path: _plain(rows.coalesce(1), path))


def _serving(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    return _layer(
        spark, folder, name, lambda: build(detail(spark, folder), F.lit(frames.ACTIVE_RELEASE)), sinks.write_serving
    )


def daily_status(spark: SparkSession, folder: str) -> DataFrame:
    return _serving(spark, folder, "ads_daily_status", marts.daily_status)


def agency_status(spark: SparkSession, folder: str) -> DataFrame:
    return _serving(spark, folder, "ads_agency_status", marts.agency_status)


def complaint_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _serving(spark, folder, "ads_complaint", marts.complaint_counts)


def served_after_run_1(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the serving tables as it stood after the first run."""
    build = lambda: marts.SERVING[table].count(after_run_1(spark, folder), F.lit(RELEASES[0]))
    return _layer(spark, folder, f"{table}_run_1", build, sinks.write_serving)


def daily_status_of_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Daily counts after each of the two load runs, a release per run."""

    def build() -> DataFrame:
        states = (after_run_1(spark, folder), after_run_2(spark, folder))
        both = [marts.daily_status(rows, F.lit(r)) for r, rows in zip(RELEASES, states)]
        return both[0].unionByName(both[1])

    return _layer(spark, folder, "ads_daily_status_runs", build, sinks.write_serving)


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of both load runs by ticket key."""

    def build() -> DataFrame:
        first = frames.history_of(run_1(spark, folder), 1)
        return append_history(first, run_2(spark, folder), F.lit(2).cast("bigint"))

    return _layer(spark, folder, "history", build, _plain)


def ticket_store(spark: SparkSession, folder: str) -> TicketStore:
    """A ticket store after both runs, loaded chunk by chunk of created month. The second run
    stages a part of the tickets only, so its release does not pass the gate."""
    path = f"{_root(spark, folder)}/{input_state(spark, folder)}/ticket_store"
    place, files = _file_system(spark, path)
    if not files.exists(place):
        aside = f"{path}-{uuid.uuid4().hex}"
        staged = [
            rows(spark, folder).drop("created_year", "created_month").withColumn("chunk_key", month_name(F.col("created_date")))
            for rows in (run_1, run_2)
        ]
        store = TicketStore(spark, aside, buckets(spark, folder)).create(staged[0].drop("chunk_key"))
        store.run("run-1", staged[0], "baseline-v1", run_1(spark, folder).count(), laid=True)
        keys = [rows(spark, folder).select(KEY) for rows in (run_1, run_2)]
        try:
            store.run("run-2", staged[1], "merged-v2", keys[0].join(keys[1], KEY, "full_outer").count(), laid=True)
        except RuntimeError:
            pass  # kept in the store as a failed run
        source, _ = _file_system(spark, aside)
        if files.exists(place) or not files.rename(source, place):
            files.delete(source, True)
    return TicketStore(spark, path)


def closed_in_order():
    return (F.upper("status") == "CLOSED") & (F.col("closed_date") >= F.col("created_date"))


def duration_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """A quantile sketch of the seconds to close per created month."""

    def build() -> DataFrame:
        seconds = elapsed("SECOND", F.col("created_date"), F.col("closed_date"))
        closed = detail(spark, folder).filter(closed_in_order())
        return profile.quantile_sketches(closed, seconds, "created_year", "created_month")

    return _layer(spark, folder, "duration_sketches", build, lambda rows, path: _plain(rows.coalesce(1), path))


def build_all(spark: SparkSession, folder: str) -> None:
    """Write whatever is missing."""
    for layer in (
        parsed, detail, by_key, daily_status, agency_status, complaint_counts, run_1, run_2, after_run_2, changes, ledger,
        daily_status_of_runs, history, duration_sketches,
    ):
        layer(spark, folder)
    for table in marts.SERVING:
        served_after_run_1(spark, folder, table)
    ticket_store(spark, folder)
    remove_old(spark, folder)
