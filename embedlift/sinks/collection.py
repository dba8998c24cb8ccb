"""A record collection kept as versioned parquet folders.

Every commit writes only its own changes (upserted records and delete marks,
one row per id) to a new folder and then appends one small log row. The log row
is the commit: a crash before it leaves an unread folder, a crash after it is a
finished commit. Nothing is overwritten, so any version can be read again and a
rollback only points the log back.

Reading takes the newest change of each id. A collection that was loaded in
disjoint steps, or compacted, is read without shuffling records: only ids are
grouped, and the few that changed more than once are broadcast after their
number has been checked.

One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from embedlift.model import RECORD_DDL
from embedlift.sinks.merge import dedupe_last_write, has_unique_ids
from embedlift.workspace import fits, write_once

UPSERT, DELETE = "upsert", "delete"
_LOG_DDL = "version bigint, parent bigint, kind string, batch_id string, path string, committed_at timestamp"
_BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Commit:
    version: int
    parent: int
    kind: str          # delta | base | pointer
    batch_id: str | None
    path: str | None


class Collection:
    """Upserts, deletes, snapshots and rollback of one collection of records.

    ``by_seq=True`` orders the changes of an id by their ``seq`` column instead
    of by commit, so that a change arriving late does not undo a newer one;
    delete marks are then kept through compaction.
    """

    def __init__(self, spark: SparkSession, root: str, by_seq: bool = False, ddl: str = RECORD_DDL):
        self.spark, self.root, self.by_seq = spark, root.rstrip("/"), by_seq
        self._change_ddl = f"{ddl}, op string, seq bigint, version bigint"
        self._types = {f.name: f.dataType for f in T.StructType.fromDDL(ddl)}
        self._columns = list(self._types)

    # -- log ---------------------------------------------------------------
    def _log_path(self) -> str:
        return f"{self.root}/log"

    def commits(self) -> list[Commit]:
        """All commits; the log holds one short row per commit."""
        try:
            log = self.spark.read.schema(_LOG_DDL).parquet(self._log_path())
            rows = log.orderBy("version").collect()
        except Exception as error:  # noqa: BLE001 - only an absent folder means "no commits yet"
            if "PATH_NOT_FOUND" in str(error):
                return []
            raise
        return [Commit(r.version, r.parent, r.kind, r.batch_id, r.path) for r in rows]

    def _append_log(self, commit: Commit) -> None:
        row = self.spark.createDataFrame(
            [(commit.version, commit.parent, commit.kind, commit.batch_id, commit.path)],
            "version bigint, parent bigint, kind string, batch_id string, path string")
        row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self._log_path())

    def _lineage(self, commits: list[Commit], version: int | None = None) -> list[Commit]:
        """Commits that make up a version, newest first."""
        by_version = {c.version: c for c in commits}
        at = by_version[max(by_version)].version if version is None and by_version else (version or 0)
        chain = []
        while at:
            commit = by_version[at]
            if commit.kind != "pointer":
                chain.append(commit)
            at = commit.parent
        return chain

    def version(self) -> int:
        return max((c.version for c in self.commits()), default=0)

    def has_batch(self, batch_id: str) -> bool:
        return any(c.batch_id == batch_id for c in self._lineage(self.commits()))

    # -- writing -----------------------------------------------------------
    def apply(self, changes: DataFrame, batch_id: str | None = None) -> int:
        """Commit rows with ``op`` (and ``seq``); a batch id that was applied before is skipped."""
        commits = self.commits()
        lineage = self._lineage(commits)
        head = max((c.version for c in commits), default=0)
        if batch_id and any(c.batch_id == batch_id for c in lineage):
            return head
        version = head + 1
        path = f"{self.root}/changes/{version:08d}-{uuid.uuid4().hex}"
        if "seq" not in changes.columns:
            changes = changes.withColumn("seq", F.lit(None).cast("bigint"))
        rows = changes.select(*self._columns, "op", F.col("seq").cast("bigint").alias("seq"),
                              F.lit(version).cast("bigint").alias("version"))
        rows.write.parquet(path)   # as they come: a sort would hold or spill a task's whole part of the records
        self._append_log(Commit(version, head, "delta", batch_id, path))
        return version

    def upsert(self, delta: DataFrame, batch_id: str | None = None, seq: str | None = None,
               unique: bool | None = None) -> int:
        """Insert or replace records by id.

        Whether an id repeats is found out from the ids alone (unless ``unique``
        says so), so records are only shuffled when there is something to merge.
        """
        if seq:
            delta = dedupe_last_write(delta, seq)
        elif not (has_unique_ids(delta) if unique is None else unique):
            delta = dedupe_last_write(delta.select(*self._columns).withColumn("_one", F.lit(1)), "_one").drop("_one")
        keep = [F.col(seq).alias("seq")] if seq else []
        return self.apply(delta.select(*self._columns, *keep).withColumn("op", F.lit(UPSERT)), batch_id)

    def delete(self, ids: DataFrame, batch_id: str | None = None) -> int:
        marks = ids.select("id").distinct().select(
            *[F.col(c) if c == "id" else F.lit(None).cast(self._types[c]).alias(c) for c in self._columns],
            F.lit(DELETE).alias("op"))
        return self.apply(marks, batch_id)

    def rollback_to(self, version: int) -> int:
        """Point back to an earlier version; later changes stay on disk unread."""
        commits = self.commits()
        if version and version not in {c.version for c in commits}:
            raise ValueError(f"no version {version}")
        head = max((c.version for c in commits), default=0)
        self._append_log(Commit(head + 1, version, "pointer", None, None))
        return head + 1

    def compact(self) -> int:
        """Write the current state as one base folder for cheap reads."""
        head = self.version()
        path = f"{self.root}/changes/{head + 1:08d}-{uuid.uuid4().hex}"
        rows = self._newest(None) if self.by_seq else self._newest(None).filter(F.col("op") == UPSERT)
        (rows.withColumn("version", F.lit(head + 1).cast("bigint"))
         .repartitionByRange("id").sortWithinPartitions("id").write.parquet(path))
        self._append_log(Commit(head + 1, head, "base", None, path))
        return head + 1

    # -- reading -----------------------------------------------------------
    def _newest(self, version: int | None) -> DataFrame:
        chain = self._lineage(self.commits(), version)
        parts = []
        for commit in chain:
            parts.append(commit.path)
            if commit.kind == "base":
                break
        if not parts:
            return self.spark.createDataFrame([], self._change_ddl)
        changes = self.spark.read.schema(self._change_ddl).parquet(*parts)
        if len(parts) == 1:
            return changes
        order = F.struct("seq", "version") if self.by_seq else F.struct(F.col("version"))
        repeated = (changes.groupBy("id").agg(F.max(order).alias("_newest"), F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") > 1).select("id", "_newest"))
        repeated = write_once(repeated, "repeated-ids")
        if fits(repeated, _BROADCAST_IDS):
            repeated = F.broadcast(repeated)
        joined = changes.join(repeated, "id", "left")
        return (joined.filter(F.col("_newest").isNull() | (order == F.col("_newest")))
                .select(*changes.columns))

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The records of the current or of an earlier version."""
        return self._newest(version).filter(F.col("op") == UPSERT).select(*self._columns)
