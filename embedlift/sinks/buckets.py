"""A record collection in buckets by id, each of which a merge rewrites as a whole or not at all.

``bucket = pmod(xxhash64(id), buckets)``. A merge stages its changes by bucket, reads the touched
buckets, and writes them anew to a folder of its own; nothing that a reader may hold is changed. One
shuffle brings old rows and changes of a bucket (of a slice of it, if it is large) together, sorted by id, and the newest row of each
id stays. The commit then names the new folders (:mod:`commitlog`). So the current version has one
row per id: reading it groups, joins and sorts nothing, and a reader that wants certain ids opens
their buckets only.

Any number of writers can work at once. Who finds the next number taken looks at the buckets of the
commits in between: if none is its own, its files are still right and it takes the next number;
buckets that did change are merged again from the staged changes, the rest stays as written.

Choose ``buckets`` by what a merge may rewrite (about 1 GB each); the number is fixed when the collection is
made and written down. The append-only :class:`~embedlift.sinks.collection.Collection` is the better
one for small changes to ids all over a large target; this one for reading often, for merges that
meet part of the target, and for several writers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from embedlift.model import RECORD_DDL
from embedlift.sinks.collection import DELETE, UPSERT
from embedlift.sinks.commitlog import EVERY, CommitLog, Files, State
from embedlift.sinks.merge import dedupe_last_write

_BUCKET = "bkt"
#: Rows of a bucket that one task merges; a larger bucket is merged in slices by id, a file each.
SLICE_ROWS = 100_000


class BucketedCollection:
    """Upserts, deletes, snapshots and rollback of one collection of records, for several writers.

    ``by_seq=True`` orders the changes of an id by their ``seq`` instead of by commit. Delete marks
    then stay in their bucket, so that an older change arriving late finds them; ``forget(seq)``
    says up to where no older change can arrive any more, and each merge of a bucket drops what lies
    below.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32, by_seq: bool = False, ddl: str = RECORD_DDL, checkpoint_every: int = EVERY):
        self.spark, self.root, self.by_seq = spark, root.rstrip("/"), by_seq
        self.log = CommitLog(spark, f"{self.root}/log", checkpoint_every)
        self._schema = T.StructType.fromDDL(f"{ddl}, op string, seq bigint")
        self._columns = [f.name for f in T.StructType.fromDDL(ddl)]
        self._files = Files(spark, self.root)
        self._oldest: int | None = None
        made = f"buckets-{buckets}"
        there = [n for n in self._files.names() if n.startswith("buckets-")]
        if not there:
            self._files.put_if_absent(made, "")
            there = [n for n in self._files.names() if n.startswith("buckets-")]
        if len(there) > 1:
            raise ValueError(f"{root} was made twice at once, with {there}")
        self.buckets = int(there[0].partition("-")[2])

    # -- reading -----------------------------------------------------------
    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        return self.log.head().version

    def has_batch(self, batch_id: str) -> bool:
        return self.log.head().has_batch(batch_id)

    def commits(self, since: int = 0) -> list[dict]:
        return self.log.commits(since)

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).option("recursiveFileLookup", True).parquet(*[f"{self.root}/{p}" for p in paths])

    def _state(self, version: int | None) -> State:
        return self.log.head() if version is None else self.log.at(version)

    def snapshot(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The records of the current or of an earlier version, or those of some buckets."""
        state = self._state(version)
        wanted = state.buckets if buckets is None else {b: state.buckets[b] for b in buckets if b in state.buckets}
        return self._rows(sorted(wanted.values())).filter(F.col("op") == UPSERT).select(*self._columns)

    def records_of(self, ids: DataFrame, version: int | None = None) -> DataFrame:
        """The records with these ids: only their buckets are opened."""
        touched = sorted(r[0] for r in ids.select(self.bucket_of(F.col("id"))).distinct().collect())   # ``buckets`` numbers at most
        return self.snapshot(version, touched).join(ids.select("id").distinct(), "id", "left_semi")

    # -- writing -----------------------------------------------------------
    def upsert(self, delta: DataFrame, batch_id: str | None = None, seq: str | None = None, unique: bool | None = None) -> int:
        """Insert or replace records by id; of several rows of an id the one with the highest ``seq`` (else the largest content) counts."""
        if not unique:
            delta = dedupe_last_write(delta, seq) if seq else dedupe_last_write(delta.select(*self._columns).withColumn("_one", F.lit(1)), "_one").drop("_one")
        keep = [F.col(seq).alias("seq")] if seq else []
        return self.apply(delta.select(*self._columns, *keep).withColumn("op", F.lit(UPSERT)), batch_id)

    def delete(self, ids: DataFrame, batch_id: str | None = None) -> int:
        types = {f.name: f.dataType for f in self._schema}
        marks = ids.select("id").distinct().select(*[F.col(c) if c == "id" else F.lit(None).cast(types[c]).alias(c) for c in self._columns], F.lit(DELETE).alias("op"))
        return self.apply(marks, batch_id)

    def forget(self, seq: int) -> None:
        """No change with a smaller ``seq`` will arrive from now on."""
        self._oldest = seq if self._oldest is None else max(seq, self._oldest)

    def apply(self, changes: DataFrame, batch_id: str | None = None) -> int:
        """Commit rows with ``op`` (and ``seq``), one per id; a batch id that was applied before is skipped."""
        state = self.log.head()
        if batch_id and state.has_batch(batch_id):
            return state.version
        staged = f"staged/{uuid.uuid4().hex}"
        if "seq" not in changes.columns:
            changes = changes.withColumn("seq", F.lit(None).cast("bigint"))
        rows = changes.select(*self._columns, "op", F.col("seq").cast("bigint").alias("seq"), self.bucket_of(F.col("id")).alias(_BUCKET))
        (rows.hint("rebalance", F.col(_BUCKET))   # as many tasks as the changes are large, several for a large bucket
         .sortWithinPartitions(_BUCKET, "id").write.partitionBy(_BUCKET).parquet(f"{self.root}/{staged}"))
        try:
            touched = [int(n.partition("=")[2]) for n in self._files.names(staged) if n.startswith(f"{_BUCKET}=")]
            return self._commit_merge(staged, touched, batch_id)
        finally:
            self._files.delete(staged)

    def _commit_merge(self, staged: str, touched: list[int], batch_id: str | None) -> int:
        done: dict[int, tuple[str | None, str | None]] = {}   # by bucket: the folder it was merged from, and into
        retries = 0
        while True:
            state = self.log.head()
            if batch_id and state.has_batch(batch_id):
                return state.version
            open_buckets = [b for b in touched if b not in done or done[b][0] != state.buckets.get(b)]
            if open_buckets:
                written = self._merged(staged, {b: state.buckets.get(b) for b in open_buckets})
                done |= {b: (state.buckets.get(b), written.get(b)) for b in open_buckets}
            new = self.log.put(state, "merge", {b: done[b][1] for b in touched}, batch_id, note={"retries": retries})
            if new is not None:
                return new.version
            retries += 1

    def _merged(self, staged: str, old: dict[int, str | None]) -> dict[int, str]:
        """Write these buckets with the staged changes in them; returns the folders of those that have rows."""
        target = f"data/{uuid.uuid4().hex}"
        rows = self._rows([p for p in old.values() if p]).withColumn("_new", F.lit(0)).unionByName(
            self._rows([f"{staged}/{_BUCKET}={b}" for b in old]).withColumn("_new", F.lit(1)))
        rows = rows.withColumn(_BUCKET, self.bucket_of(F.col("id")))
        newest = [F.desc_nulls_last("seq"), F.desc("_new")] if self.by_seq else [F.desc("_new")]
        slices = max(1, -(-rows.count() // (len(old) * SLICE_ROWS)))   # the files' footers have the counts
        rows = rows.withColumn("_slice", F.pmod(F.xxhash64("id", F.lit("slice")), F.lit(slices)))
        # the window keeps the partitioning by slices of buckets, so this is the only shuffle
        rank = F.row_number().over(Window.partitionBy(_BUCKET, "_slice", "id").orderBy(*newest))
        rows = rows.repartition(len(old) * slices, _BUCKET, "_slice").withColumn("_rank", rank).filter("_rank = 1")
        if not self.by_seq:
            rows = rows.filter(F.col("op") == UPSERT)
        elif self._oldest is not None:
            rows = rows.filter((F.col("op") == UPSERT) | (F.col("seq") >= self._oldest))
        (rows.select(*self._columns, "op", "seq", _BUCKET).sortWithinPartitions(_BUCKET, "id")
         .write.partitionBy(_BUCKET).parquet(f"{self.root}/{target}"))
        return {int(n.partition("=")[2]): f"{target}/{n}" for n in self._files.names(target) if n.startswith(f"{_BUCKET}=")}

    def rollback_to(self, version: int) -> int:
        """Point back to an earlier version; its folders are still there."""
        if version:
            self.log.at(version)
        while True:
            new = self.log.put(self.log.head(), "pointer", {}, to=version)
            if new is not None:
                return new.version

    def compact(self) -> int:
        """Nothing to do: every version is one row per id already."""
        return self.version()

    def remove_unused(self, keep: int = 10, writing: bool = False) -> list[str]:
        """Delete folders that none of the last ``keep`` versions reads.

        Only while nobody writes: a merge that is not committed yet looks unused. Versions before
        these cannot be read or rolled back to any more.
        """
        if writing:
            raise ValueError("folders of unfinished merges cannot be told from unused ones")
        head = self.log.head().version
        used = {p.split("/")[1] for v in range(max(1, head - keep + 1), head + 1) for p in self.log.at(v).buckets.values()}
        gone = [n for n in self._files.names("data") if n not in used]
        for name in gone:
            self._files.delete(f"data/{name}")
        return gone
