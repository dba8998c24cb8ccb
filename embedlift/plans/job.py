"""Whole migrations: start, resume, dry run, and control between steps.

A migration is one set-oriented pass: scan, project, append. It can be cut into
steps of many batches each. Every run has an id, written with its first checkpoint
and reused only by resuming it; a step is committed under the run and both ends
of its ids. So resuming repeats no commit, and a new run of the same migration
writes everything again, whatever an earlier run committed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.operators.filters import check_target_constraints
from embedlift.operators.state import StateStore
from embedlift.operators.transform import (ERRORS, Mapping, apply_mapping, check_mapping, migrate_records,
                                           rejected_records)
from embedlift.operators.validate import rollback_alert, validate_migration
from embedlift.sinks.collection import Collection
from embedlift.sources.batches import DEFAULT_BATCH, range_bounds, resume_filter

PAUSED, STOPPED = "pause requested", "stop requested"


@dataclass(frozen=True)
class MigrationConfig:
    """Options of a run; ``steps`` is the number of commits the work is cut into.

    A checkpoint follows every ``checkpoint_every`` steps and the last one. With
    ``validate_every`` a sample of the written records is validated after that
    many steps and a run whose alert fires is rolled back.
    """

    migration_id: str
    mapping: Mapping
    batch_size: int = DEFAULT_BATCH
    steps: int = 1
    checkpoint_every: int = 1
    validate_every: int = 0
    sample_rate: float = 0.1
    on_error: str = "fail"


def request(state: StateStore, migration_id: str, action: str, target: Collection | None = None) -> None:
    """Ask a running migration to pause or stop, or roll it back.

    Pause and stop leave the state as it is and only record the reason; the run
    reads it before its next step. Rolling back points ``target`` to the version
    it had before the run.
    """
    now = state.state(migration_id)
    if action == "rollback":
        if now not in ("in_progress", "failed", "completed"):
            raise ValueError(f"cannot roll back a migration that is {now}")
        _roll_back(state, migration_id, target, "rollback requested")
        return
    if action not in ("pause", "stop", "resume"):
        raise ValueError("action is pause, stop, resume or rollback")
    if now != "in_progress":
        raise ValueError(f"migration is {now}, not running")
    reason = {"pause": PAUSED, "stop": STOPPED, "resume": None}[action]
    state.set_state(migration_id, "in_progress", reason)


def _roll_back(state: StateStore, migration_id: str, target: Collection | None, reason: str) -> None:
    saved = state.checkpoint(migration_id)
    if target is not None and saved is not None and saved["target_version"] is not None:
        target.rollback_to(saved["target_version"])
    state.move(migration_id, "rolled_back", reason)


def _mapping_text(mapping: Mapping) -> str:
    return json.dumps(asdict(mapping), sort_keys=True)


def _control(state: StateStore, migration_id: str) -> tuple[str, str | None]:
    from embedlift.operators.state import current_states

    row = current_states(state.events().filter(F.col("migration_id") == migration_id)).first()
    return (row["state"], row["reason"]) if row else ("not_started", None)


def run_migration(source: DataFrame, target: Collection, state: StateStore, config: MigrationConfig) -> str:
    """Copy ``source`` into ``target`` and return the state the migration ends in."""
    check_mapping(config.mapping)
    now, _ = _control(state, config.migration_id)
    if now == "in_progress":
        raise ValueError("migration already running; use resume_migration")
    if now != "not_started":
        state.move(config.migration_id, "not_started", "new run")
    run = {"run_id": uuid.uuid4().hex, "target_version": target.version(), "mapping_json": _mapping_text(config.mapping), "total_records": source.count()}
    state.save_checkpoint(config.migration_id, known_state="not_started", processed_count=0, failed_count=0, batch_no=0, **run)
    return _run(source, target, state, config, run, 0, 0, 0)


def resume_migration(source: DataFrame, target: Collection, state: StateStore, config: MigrationConfig) -> str:
    """Go on after the last checkpoint; work that was committed after it is repeated without effect.

    Only a run that stopped or failed goes on, and only with the mapping it started with.
    """
    check_mapping(config.mapping)
    saved = state.checkpoint(config.migration_id)
    if saved is None:
        return run_migration(source, target, state, config)
    if saved["mapping_json"] is not None and saved["mapping_json"] != _mapping_text(config.mapping):
        raise ValueError("the run was started with another mapping")
    now, _ = _control(state, config.migration_id)
    if now not in ("in_progress", "failed"):
        raise ValueError(f"cannot resume a migration that is {now}")
    state.move(config.migration_id, "in_progress")
    run = {"run_id": saved["run_id"] or uuid.uuid4().hex, "target_version": saved["target_version"],
           "mapping_json": _mapping_text(config.mapping), "total_records": saved["total_records"]}
    rest = resume_filter(source, saved["last_processed_id"])
    return _run(rest, target, state, config, run, saved["processed_count"] or 0, saved["failed_count"] or 0,
                saved["batch_no"] or 0, saved["last_processed_id"])


def _run(source, target, state, config, run, done, failed, batches, last_id=None) -> str:
    saved, validation = True, None

    def save(status: str, **more) -> None:
        state.save_checkpoint(config.migration_id, known_state=status, last_processed_id=last_id, processed_count=done,
                              failed_count=failed, batch_no=batches, validation=validation, **run, **more)

    try:
        for step, part in _steps(source, config):
            status, reason = _control(state, config.migration_id)
            if status != "in_progress" or reason in (PAUSED, STOPPED):
                if not saved:
                    save(status)
                return status
            seen = part.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(
                F.sum("n").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"), F.max("n").alias("copies")).first()
            if not seen["n"]:
                continue
            rejected = 0
            if config.on_error == "drop":
                rejected = apply_mapping(part, config.mapping).filter(F.size(ERRORS) > 0).count()
            target.upsert(migrate_records(part, config.mapping, config.on_error),
                          batch_id=f"{config.migration_id}:{run['run_id']}:{seen['first']}:{seen['last']}", unique=seen["copies"] == 1)
            done, failed = done + seen["n"] - rejected, failed + rejected
            batches += -(-seen["n"] // config.batch_size)
            last_id, saved = seen["last"], False
            alert = None
            if config.validate_every and step % config.validate_every == 0:
                expected = migrate_records(part, config.mapping, config.on_error)
                summary, _ = validate_migration(expected, target.snapshot(), config.sample_rate)
                found = summary.first()
                summary = summary.sparkSession.createDataFrame([found], summary.schema)   # the pairs are not compared again for the alert
                validation = (found["total_records"], found["avg_similarity"], found["min_similarity"], found["max_similarity"])
                alert = rollback_alert(summary).first()
            if step % config.checkpoint_every == 0 or alert:
                save(status)
                saved = True
            if alert:
                _roll_back(state, config.migration_id, target, alert["reason"])
                return "rolled_back"
        if not saved:
            save("in_progress")
    except Exception as error:
        save("in_progress", error=str(error))
        state.move(config.migration_id, "failed", str(error).partition("\n")[0])
        raise
    state.move(config.migration_id, "completed")
    return "completed"


def _steps(source: DataFrame, config: MigrationConfig):
    """Parts of the source by ranges of ids; a filter on id reaches the scan of every part."""
    bounds = range_bounds(source.select("id"), config.steps, config.batch_size) if config.steps > 1 else []
    for step, (low, high) in enumerate(zip([None, *bounds], [*bounds, None]), 1):
        part = source
        if low is not None:
            part = part.filter(F.col("id") > low)
        if high is not None:
            part = part.filter(F.col("id") <= high)
        yield step, part


def dry_run(source: DataFrame, mapping: Mapping) -> DataFrame:
    """What a run would do, without writing: ``finding, field, message, n_records``."""
    mapped = migrate_records(source, mapping, on_error="drop")
    counts = mapped.agg(F.count(F.lit(1)).alias("n_records")).select(
        F.lit("mapped").alias("finding"), F.lit("").alias("field"), F.lit("").alias("message"), "n_records")
    rejects = rejected_records(source, mapping).groupBy("field", "message").agg(F.count(F.lit(1)).alias("n_records"))
    broken = check_target_constraints(mapped, mapping.target_type).groupBy("field", "message").agg(
        F.count(F.lit(1)).alias("n_records"))
    columns = ["finding", "field", "message", "n_records"]
    return (counts.select(*columns)
            .unionByName(rejects.withColumn("finding", F.lit("rejected")).select(*columns))
            .unionByName(broken.withColumn("finding", F.lit("constraint")).select(*columns)))


