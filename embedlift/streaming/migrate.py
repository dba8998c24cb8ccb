"""Continuous migration, dual writes, change feeds and running validation.

Each micro-batch is committed under ``<query id>:<batch number>``. The query id
belongs to the checkpoint folder: a batch that is replayed after a failure finds
its id in the collection's log and is skipped, while another stream into the same
target, or a stream whose checkpoint was lost, never meets the ids of an earlier
one. Upserts are idempotent, so such a replay changes nothing.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.operators.state import StateStore
from embedlift.operators.transform import ERRORS, Mapping, apply_mapping, check_mapping, migrate_records
from embedlift.operators.validate import pair_records, sampled, with_similarity
from embedlift.model import SIMILARITY_THRESHOLD
from embedlift.sinks.buckets import BucketedCollection
from embedlift.sinks.collection import Collection
from embedlift.sinks.merge import dedupe_last_write, has_unique_ids


def _start(stream: DataFrame, step: Callable[[DataFrame, str, int], None], checkpoint: str, continuous: bool, name: str):
    """Run ``step(batch, batch id, number)`` on every micro-batch."""
    started, query_id = threading.Event(), []

    def run(batch: DataFrame, number: int) -> None:
        started.wait()
        step(batch, f"{query_id[0]}:{number}", number)

    writer = stream.writeStream.queryName(name).foreachBatch(run).option("checkpointLocation", checkpoint)
    query = (writer if continuous else writer.trigger(availableNow=True)).start()
    query_id.append(query.id)
    started.set()
    return query


def _tidy(target: Collection, batch_no: int, compact_every: int) -> None:
    if compact_every and (batch_no + 1) % compact_every == 0:
        target.compact()


def migrate_stream(stream: DataFrame, target: Collection, mapping: Mapping, checkpoint: str, name: str = "migrate",
                   state: StateStore | None = None, compact_every: int = 50, on_error: str = "fail",
                   continuous: bool = False):
    """Records arriving as files, mapped and upserted; with ``state`` the progress is checkpointed."""
    check_mapping(mapping)

    def step(batch: DataFrame, batch_id: str, number: int) -> None:
        if not target.has_batch(batch_id):
            # ids map one to one, so whether one repeats shows before the mapping
            target.upsert(migrate_records(batch, mapping, on_error), batch_id=batch_id, unique=has_unique_ids(batch))
            _tidy(target, number, compact_every)
        if state is not None:
            failed = apply_mapping(batch, mapping).filter(F.size(ERRORS) > 0).count() if on_error == "drop" else 0
            record_progress(state, name, batch, number, run_id=batch_id.rpartition(":")[0], failed=failed)

    return _start(stream, step, checkpoint, continuous, name)


def record_progress(state: StateStore, migration_id: str, batch: DataFrame, number: int, run_id: str = "",
                    failed: int = 0) -> None:
    """Append one checkpoint row for a micro-batch: progress is a table, nothing polls.

    Totals are sums over batch numbers, so a batch that is replayed counts once.
    """
    seen = batch.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).first()
    mine = state.checkpoints().filter((F.col("migration_id") == migration_id) & (F.coalesce("run_id", F.lit("")) == run_id)
                                      & (F.col("batch_no") <= number) & ~F.coalesce("deleted", F.lit(False)))
    each = mine.groupBy("batch_no").agg(F.max_by("batch_records", "seq").alias("n"), F.max_by("batch_failed", "seq").alias("f"))
    before = each.agg(F.sum("n").alias("n"), F.sum("f").alias("f")).first()
    state.save_checkpoint(migration_id, batch_no=number + 1, last_processed_id=seen["last"], run_id=run_id,
                          batch_records=seen["n"] - failed, batch_failed=failed,
                          processed_count=(before["n"] or 0) + seen["n"] - failed, failed_count=(before["f"] or 0) + failed)


def progress_stream(stream: DataFrame, state: StateStore, checkpoint: str, migration_id: str,
                    continuous: bool = False):
    """Only the progress rows of a stream of records."""
    def step(batch: DataFrame, batch_id: str, number: int) -> None:
        record_progress(state, migration_id, batch, number, run_id=batch_id.rpartition(":")[0])

    return _start(stream, step, checkpoint, continuous, f"{migration_id}-progress")


def dual_write(stream: DataFrame, sinks: list[tuple[Collection, Mapping | None]], checkpoint: str,
               name: str = "dual-write", compact_every: int = 50, continuous: bool = False):
    """Every batch goes to all sinks, each with its own mapping (None: unchanged).

    A sink that has the batch already is skipped, so a failure between two
    sinks is repaired by the replay.
    """
    def step(batch: DataFrame, batch_id: str, number: int) -> None:
        missing = [(target, mapping) for target, mapping in sinks if not target.has_batch(batch_id)]
        unique = has_unique_ids(batch) if missing else True
        for target, mapping in missing:
            target.upsert(migrate_records(batch, mapping) if mapping else batch, batch_id=batch_id, unique=unique)
            _tidy(target, number, compact_every)

    return _start(stream, step, checkpoint, continuous, name)


def cdc_sync(stream: DataFrame, target: Collection, checkpoint: str, name: str = "cdc", compact_every: int = 50,
             continuous: bool = False):
    """Upserts and deletes (``op``) in the order of ``seq``, even if older changes arrive late."""
    if not target.by_seq:
        raise ValueError("the target collection must be opened with by_seq=True")

    def step(batch: DataFrame, batch_id: str, number: int) -> None:
        if not target.has_batch(batch_id):
            target.apply(dedupe_last_write(batch, "seq"), batch_id)
            _tidy(target, number, compact_every)

    return _start(stream, step, checkpoint, continuous, name)


_BROADCAST_IDS = 1_000_000


def _matching(batch: DataFrame, records: DataFrame) -> DataFrame:
    """The records a batch can pair with: its id range reaches the scan, few ids also go as a broadcast."""
    seen = batch.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n")).first()
    near = records.filter((F.col("id") >= seen["low"]) & (F.col("id") <= seen["high"]))
    if seen["n"] > _BROADCAST_IDS:
        return near
    return near.join(F.broadcast(batch.select("id").distinct()), "id", "left_semi")


VALIDATION_DDL = ("batch_no bigint, total_records bigint, valid_records bigint, measured bigint, "
                  "similarity_sum double, min_similarity double, max_similarity double")


def validate_stream(stream: DataFrame, target: Collection | BucketedCollection, runs_path: str, checkpoint: str, sample_rate: float = 0.1,
                    threshold: float = SIMILARITY_THRESHOLD, name: str = "validate", continuous: bool = False):
    """Compare a sample of each batch with the target; one row of sums per batch is kept.

    A replayed batch overwrites its own row, so it does not count twice. Of a collection in buckets
    only those that hold ids of the sample are opened, whatever the collection's size; of any other
    one the newest change of every id is looked up for each batch.
    """
    def step(batch: DataFrame, batch_id: str, number: int) -> None:
        sample = sampled(batch, sample_rate)
        near = target.records_of(sample) if isinstance(target, BucketedCollection) else _matching(sample, target.snapshot())
        pairs = with_similarity(pair_records(sample, near))
        sums = pairs.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.coalesce(F.col("similarity") >= threshold, F.lit(False))).alias("valid_records"),
            F.count("similarity").alias("measured"),
            F.coalesce(F.sum("similarity"), F.lit(0.0)).alias("similarity_sum"),
            F.min("similarity").alias("min_similarity"), F.max("similarity").alias("max_similarity"))
        (sums.withColumn("batch_no", F.lit(number).cast("bigint")).coalesce(1)
         .write.mode("overwrite").parquet(f"{runs_path}/batch={number}"))

    return _start(stream, step, checkpoint, continuous, name)


def running_validation(spark, runs_path: str) -> DataFrame:
    """Validation over all batches so far, from sums and counts."""
    rows = spark.read.schema(VALIDATION_DDL).option("recursiveFileLookup", True).parquet(runs_path)
    return rows.agg(
        F.sum("total_records").alias("total_records"), F.sum("valid_records").alias("valid_records"),
        (F.sum("total_records") - F.sum("valid_records")).alias("invalid_records"),
        (F.sum("similarity_sum") / F.nullif(F.sum("measured"), F.lit(0))).alias("avg_similarity"),
        F.min("min_similarity").alias("min_similarity"), F.max("max_similarity").alias("max_similarity"))
