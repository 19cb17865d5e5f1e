"""Current state, history, chunk ledger, runs and releases of the tickets as Parquet.

Tickets are dealt into buckets by key. A load reads and rewrites only the buckets that its
rows fall into: their new files lie beside the old ones, and a commit names the files that
count from then on. Readers follow the newest commit, so a load that dies half-way leaves
nothing to see, and a reader that has begun is not disturbed.

Writers do not wait for each other. A load that finds, when it commits, that others have
committed in between goes on if they touched other buckets, and is refused otherwise.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from deskmill.operators import loading
from deskmill.operators.release import activate, pending_chunks, register_candidate, run_totals
from deskmill.operators.versions import HASH, KEY
from deskmill.sources.commit_log import CommitLog, ConcurrentCommit

LEDGER = (
    "run_id bigint, chunk_key string, input_sha256 string, row_count bigint, "
    "inserted_rows bigint, updated_rows bigint, unchanged_rows bigint, status string"
)
REGISTRY = (
    "release_id bigint, release_key string, run_id bigint, status string, "
    "is_active boolean, row_count bigint"
)
RUN = (
    "run_id bigint, run_key string, run_type string, status string, staged_rows bigint, inserted_rows bigint, "
    "updated_rows bigint, unchanged_rows bigint, started_at timestamp, finished_at timestamp, error_message string"
)
COMMIT = f"version bigint, kind string, part string, touched array<int>, run struct<{RUN}>"
MESSAGE = 2000  # characters of an error that a run keeps
TRIES = 5


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")


class TicketStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        """``buckets`` counts for a new store; size it so that a bucket fits a task."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.log = CommitLog(spark, f"{self.root}/commits")
        self._schema: StructType | None = None

    def create(self, ticket: DataFrame) -> TicketStore:
        """Lay down an empty store; ``ticket`` gives the columns of a staged ticket."""
        self.log.append(
            {"kind": "create", "buckets": self.buckets, "current": {}, "registry": "", "ticket": ticket.schema.json()}, -1
        )
        return self

    # --- reading -----------------------------------------------------------------

    def _ticket(self) -> StructType:
        if self._schema is None:
            first = self.log.entry(0)
            self._schema = StructType.fromJson(json.loads(first["ticket"]))
            self.buckets = first["buckets"]
        return self._schema

    def _none(self, schema: StructType | str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _current_schema(self) -> StructType:
        self._ticket()
        return StructType(list(self._ticket().fields)).add("first_seen_run_id", "long").add("last_seen_run_id", "long")

    def _current_of(self, seen: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """The stored tickets of some buckets, or of all, as a commit names them."""
        schema = self._current_schema()
        held = seen["current"]
        paths = [
            f"{self.root}/current/bucket={b}/part={p}" for b, p in held.items() if buckets is None or int(b) in buckets
        ]
        if not paths:
            return self._none(schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _history_schema(self) -> StructType:
        kinds = {f.name: f.dataType for f in self._ticket().fields} | {"run_id": "long"}
        made = StructType()
        for name in loading.HISTORY_FIELDS:
            made.add(name, kinds[name])
        return made

    def _parts(self, upto: int) -> list[str]:
        """Names of the parts that committed loads have written, one string a load."""
        loads = self.log.entries(COMMIT).filter((F.col("kind") == "load") & (F.col("version") <= upto))
        return [r.part for r in loads.select("part").collect()]

    def _history_of(self, seen: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = self._history_schema()
        # A bucket with stored tickets has history, and no other has.
        wanted = [b for b in seen["current"] if buckets is None or int(b) in buckets]
        if not wanted:
            return self._none(schema)
        full = StructType(list(schema.fields)).add("bucket", "integer").add("part", "string")
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/history")
        rows = rows.parquet(*[f"{self.root}/history/bucket={b}" for b in wanted])
        return rows.filter(F.col("part").isin(self._parts(seen["version"]))).select(schema.names)

    def version(self) -> int:
        return self.log.last()

    def ledger(self) -> DataFrame:
        return self._ledger_of(self.log.last())

    def _ledger_of(self, version: int) -> DataFrame:
        parts = self._parts(version)
        if not parts:
            return self._none(LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*[f"{self.root}/ledger/part={p}" for p in parts])

    def history(self) -> DataFrame:
        return self._history_of(self.log.latest())

    def current(self) -> DataFrame:
        return self._current_of(self.log.latest())

    def registry(self) -> DataFrame:
        return self._registry_of(self.log.latest())

    def _registry_of(self, seen: dict) -> DataFrame:
        if not seen["registry"]:
            return self._none(REGISTRY)
        return self.spark.read.schema(REGISTRY).parquet(f"{self.root}/registry/part={seen['registry']}")

    def runs(self) -> DataFrame:
        """The newest state of every run."""
        events = self.log.entries(COMMIT).filter("kind = 'run'")
        return events.groupBy("run.run_id").agg(F.max_by("run", "version").alias("run")).select("run.*")

    # --- loading -----------------------------------------------------------------

    def _bucket(self) -> Column:
        """Number of the task that a shuffle by key into ``buckets`` tasks sends a row to."""
        return F.pmod(F.hash(KEY), F.lit(self.buckets))

    def load(self, staged: DataFrame, run_id: int, laid: bool = False) -> int:
        """Merge all chunks of ``staged`` that the ledger does not hold; returns how many.

        ``staged`` has ticket columns and ``chunk_key``, each key once per chunk. Current
        state, history and ledger of all chunks become visible together. With ``laid`` the
        rows are read from a table that does not change and has a bucket by key for each
        bucket of the store; they are neither copied nor shuffled.
        """
        run = F.lit(run_id).cast("bigint")
        self._ticket()
        seen = self.log.latest()
        wanted = staged.select("chunk_key").distinct().withColumn("run_id", run)
        left = pending_chunks(wanted, self._ledger_of(seen["version"])).select("chunk_key")
        if left.isEmpty():
            return 0
        part = f"p{uuid.uuid4().hex}"
        # A row per chunk; the tickets stay where they are.
        rows = staged.join(F.broadcast(left), "chunk_key", "left_semi")
        if not laid:
            place = f"{self.root}/staging/part={part}"
            rows.write.parquet(place)
            rows = self.spark.read.schema(staged.schema).parquet(place)
        self._check_keys(rows)

        # At most as many numbers as there are buckets.
        touched = sorted(r.b for r in rows.select(self._bucket().alias("b")).distinct().collect())
        # Both sides are shuffled by key into a task per bucket, and stay there.
        before = self._current_of(seen, touched).repartition(self.buckets, KEY)
        classified = loading.classify_chunks(rows if laid else rows.repartition(self.buckets, KEY), before)
        classified = classified.persist(StorageLevel.DISK_ONLY)  # if lost, computed again from the files
        try:
            ledger = self._ledger_rows(classified, rows, run)
            ledger.write.parquet(f"{self.root}/ledger/part={part}")
            self._write("current", part, loading.merged_current(classified, before, run))
            known = self._history_of(seen, touched).select(KEY, HASH).repartition(self.buckets, KEY)
            self._write("history", part, loading.new_versions(classified, known, run))
        finally:
            classified.unpersist()
        self._commit_load(seen, part, touched)
        return self.spark.read.parquet(f"{self.root}/ledger/part={part}").count()

    def _write(self, table: str, part: str, rows: DataFrame) -> None:
        """One file per bucket, in a folder of its own."""
        placed = rows.withColumn("bucket", self._bucket()).withColumn("part", F.lit(part))
        placed.sortWithinPartitions("bucket", KEY).write.mode("append").partitionBy("bucket", "part").parquet(
            f"{self.root}/{table}"
        )

    def _commit_load(self, seen: dict, part: str, touched: list[int]) -> None:
        mine = {str(b): part for b in touched}
        for _ in range(TRIES):
            entry = self._carried(seen) | {"kind": "load", "part": part, "touched": touched}
            try:
                self.log.append(entry | {"current": seen["current"] | mine}, seen["version"])
                return
            except ConcurrentCommit:
                now = self.log.latest()
                between = [self.log.entry(v) for v in range(seen["version"] + 1, now["version"] + 1)]
                if any(set(touched) & set(e.get("touched", [])) for e in between):
                    raise
                seen = now  # what came in between lies in other buckets
        raise ConcurrentCommit("too many writers")

    @staticmethod
    def _carried(seen: dict) -> dict:
        """What every commit repeats, so that the newest one tells the whole state."""
        return {"buckets": seen["buckets"], "current": seen["current"], "registry": seen["registry"], "at": _now()}

    @classmethod
    def _ledger_rows(cls, classified: DataFrame, rows: DataFrame, run: Column) -> DataFrame:
        digest = rows.groupBy("chunk_key").agg(cls._digest().alias("input_sha256"))
        return (
            loading.chunk_counts(classified)
            .join(digest, "chunk_key")
            .select(
                run.alias("run_id"), "chunk_key", "input_sha256",
                F.col("staged_rows").alias("row_count"), "inserted_rows", "updated_rows", "unchanged_rows",
                F.lit("COMMITTED").alias("status"),
            )
        )

    @staticmethod
    def _digest() -> Column:
        """Order-free digest of a chunk: row count and the sum of its row hashes.

        A sum needs no list of rows, so a chunk of any size is digested with partial sums.
        """
        word = F.conv(F.substring("content_hash_hex", 1, 15), 16, 10).cast("decimal(38,0)")
        key = F.xxhash64("unique_key").cast("decimal(38,0)")
        return F.sha2(F.concat_ws("|", F.count("*"), F.sum(word), F.sum(key)), 256)

    @staticmethod
    def _check_keys(rows: DataFrame) -> None:
        twice = rows.groupBy("chunk_key", "unique_key").count().filter("count > 1")
        if not twice.isEmpty():
            raise ValueError("a staged chunk holds a ticket key more than once")

    # --- releases ----------------------------------------------------------------

    def publish(self, release_key: str, run_id: int, expected_rows: int) -> bool:
        """Gate the current state and, if all counts agree, make it the active release.

        If another commit comes in between, the counts are taken again.
        """
        for _ in range(TRIES):
            seen = self.log.latest()
            totals = self._ledger_of(seen["version"]).filter(F.col("run_id") == run_id)
            staged = totals.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
            rows = self._current_of(seen).count()
            registry = register_candidate(self._registry_of(seen), release_key, run_id, F.lit(rows))
            passed = staged == rows == expected_rows
            if passed:
                registry = activate(registry, release_key)
            else:
                failed = (F.col("release_key") == release_key) & (F.col("status") == "CANDIDATE")
                registry = registry.withColumn("status", F.when(failed, "REJECTED").otherwise(F.col("status")))
            part = f"p{uuid.uuid4().hex}"
            registry.coalesce(1).write.parquet(f"{self.root}/registry/part={part}")
            try:
                self.log.append(self._carried(seen) | {"kind": "release", "registry": part}, seen["version"])
                return passed
            except ConcurrentCommit:
                continue
        raise ConcurrentCommit("too many writers")

    # --- runs --------------------------------------------------------------------

    def begin_run(self, run_key: str, run_type: str = "BASELINE") -> dict:
        """Register a run, or take up a known one again: its number stays, its error goes.

        A run that has succeeded is returned as it is.
        """
        for _ in range(TRIES):
            seen = self.log.latest()
            known = {r.run_key: r for r in self.runs().filter(F.col("run_key") == run_key).collect()}
            if run_key in known and known[run_key].status == "SUCCEEDED":
                return known[run_key].asDict()
            if run_key in known:
                run_id = known[run_key].run_id
            else:
                run_id = (self.runs().agg(F.max("run_id")).first()[0] or 0) + 1
            run = {"run_id": run_id, "run_key": run_key, "run_type": run_type, "status": "RUNNING", "started_at": _now()}
            try:
                self.log.append(self._carried(seen) | {"kind": "run", "run": run}, seen["version"])
                return run
            except ConcurrentCommit:
                continue
        raise ConcurrentCommit("too many writers")

    def end_run(self, run: dict, status: str, message: str | None = None) -> dict:
        """Close a run with the totals of its committed chunks."""
        for _ in range(TRIES):
            seen = self.log.latest()
            found = run_totals(self._ledger_of(seen["version"])).filter(F.col("run_id") == run["run_id"]).first()
            kinds = ("inserted_rows", "updated_rows", "unchanged_rows")
            totals = {"staged_rows": found.row_count if found else 0} | {k: found[k] if found else 0 for k in kinds}
            ended = run | totals | {"status": status, "finished_at": _now(), "error_message": message}
            try:
                self.log.append(self._carried(seen) | {"kind": "run", "run": ended}, seen["version"])
                return ended
            except ConcurrentCommit:
                continue
        raise ConcurrentCommit("too many writers")

    def run(
        self, run_key: str, staged: DataFrame, release_key: str, expected_rows: int, run_type: str = "BASELINE",
        laid: bool = False,
    ) -> dict:
        """A whole run: load what is left, gate, publish. Returns the run's row.

        A run that has succeeded returns at once. One that fails, also at the gate, is kept
        as FAILED with its message; its committed chunks stay, and calling it again goes on
        from there. The active release changes only if all counts agree.
        """
        run = self.begin_run(run_key, run_type)
        if run["status"] == "SUCCEEDED":
            return run
        try:
            self.load(staged, run["run_id"], laid)
            if not self.publish(release_key, run["run_id"], expected_rows):
                raise RuntimeError(f"release {release_key} rejected: staged, current and expected rows differ")
        except Exception as error:
            self.end_run(run, "FAILED", str(error)[:MESSAGE])
            raise
        return self.end_run(run, "SUCCEEDED")

    def unused(self) -> list[str]:
        """Bucket folders that no visible state names any more; a clean-up may remove them
        once no reader of an older commit is left."""
        seen = self.log.latest()
        base = self.log._path(f"{self.root}/current/bucket=*/part=*")
        found = self.log._files.globStatus(base) or []
        places = [f.getPath() for f in found]
        return [
            str(p) for p in places
            if seen["current"].get(p.getParent().getName().removeprefix("bucket=")) != p.getName().removeprefix("part=")
        ]
