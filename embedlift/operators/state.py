"""Migration states and checkpoints as append-only tables.

``events``: ``migration_id, seq, state, reason, ts``; ``checkpoints``:
``migration_id, seq, batch_no, last_processed_id, total_records,
processed_count, failed_count, started_at, checkpoint_at, deleted`` and what
describes the run: its id, mapping, the target's version before it, the last
validation, the last error. The current row of a migration is the one with the
highest ``seq``.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from embedlift.functions.text import percentage, rfc3339
from embedlift.model import ALLOWED_TRANSITIONS, MIGRATION_STATES, transition_frame
from embedlift.operators.ordered import CHUNK_ROWS, moving_average, with_context

EVENT_DDL = "migration_id string, seq bigint, state string, reason string, ts timestamp"
CHECKPOINT_DDL = ("migration_id string, seq bigint, batch_no bigint, last_processed_id string, total_records bigint, "
                  "processed_count bigint, failed_count bigint, started_at timestamp, checkpoint_at timestamp, "
                  "mapping_json string, validation struct<sampled: bigint, avg: double, min: double, max: double>, "
                  "deleted boolean, run_id string, target_version bigint, batch_records bigint, batch_failed bigint, error string")
SORT_KEYS = ("created_at", "status", "migration_id")
TERMINAL = ("completed", "failed", "rolled_back")


def latest_per_migration(rows: DataFrame, *order: str, key: str = "migration_id") -> DataFrame:
    """The newest row of each migration; copies are combined before the shuffle."""
    order = order or ("seq",)
    rest = [c for c in rows.columns if c != key]
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    return newest.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def current_states(events: DataFrame) -> DataFrame:
    """State, reason, first and last time of each migration."""
    found = events.groupBy("migration_id").agg(
        F.max_by(F.struct("state", "reason", "ts"), "seq").alias("_r"), F.min("ts").alias("created_at"))
    return found.select("migration_id", F.col("_r.state").alias("state"), F.col("_r.reason").alias("reason"),
                        "created_at", F.col("_r.ts").alias("updated_at"))


def get_state(ids: DataFrame, events: DataFrame) -> DataFrame:
    """State of the given migrations; unknown ones have not started."""
    states = current_states(events).select("migration_id", "state")
    return ids.select("migration_id").join(states, "migration_id", "left").withColumn(
        "state", F.coalesce("state", F.lit("not_started")))


def set_state(events: DataFrame, changes: DataFrame) -> DataFrame:
    """Events with changes appended; an unknown state stops the job."""
    known = F.col("state").isin(*MIGRATION_STATES)
    checked = changes.withColumn("state", F.when(known, F.col("state")).otherwise(
        F.raise_error(F.concat(F.lit("unknown state: "), F.coalesce("state", F.lit("null"))))))
    return events.unionByName(checked.select(*events.columns))


def latest_checkpoints(checkpoints: DataFrame, *columns: str) -> DataFrame:
    """Newest checkpoint of each migration, without deleted ones; only ``columns`` if any are named."""
    if columns:
        kept = ["migration_id", "seq", *columns, *(["deleted"] if "deleted" in checkpoints.columns else [])]
        checkpoints = checkpoints.select(*kept)
    newest = latest_per_migration(checkpoints)
    return newest.filter(~F.coalesce("deleted", F.lit(False))) if "deleted" in checkpoints.columns else newest


def get_checkpoint(ids: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Newest checkpoint of the given migrations; all NULL where there is none."""
    return ids.select("migration_id").join(latest_checkpoints(checkpoints), "migration_id", "left")


def save_checkpoints(events: DataFrame, checkpoints: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append checkpoints; a migration that had not started becomes in progress, other states stay."""
    states = get_state(new.select("migration_id").distinct(), events).filter(F.col("state") == "not_started")
    first = latest_per_migration(new.select("migration_id", "seq", "checkpoint_at"))
    started = states.select("migration_id").join(first, "migration_id").select(
        "migration_id", "seq", F.lit("in_progress").alias("state"), F.lit(None).cast("string").alias("reason"),
        F.col("checkpoint_at").alias("ts"))
    return events.unionByName(started.select(*events.columns)), checkpoints.unionByName(new.select(*checkpoints.columns))


def delete_checkpoints(checkpoints: DataFrame, ids: DataFrame) -> DataFrame:
    """Append a delete mark after the newest checkpoint of the given migrations."""
    newest = latest_checkpoints(checkpoints)
    marks = newest.join(ids.select("migration_id").distinct(), "migration_id", "left_semi")
    marks = marks.withColumn("seq", F.col("seq") + 1).withColumn("deleted", F.lit(True))
    return checkpoints.unionByName(marks.select(*checkpoints.columns))


def purge_orphans(checkpoints: DataFrame, migrations: DataFrame) -> DataFrame:
    """Checkpoints whose migration still exists."""
    return checkpoints.join(migrations.select("migration_id"), "migration_id", "left_semi")


def _progress(total: Column, done: Column) -> list[Column]:
    return [F.coalesce(total, F.lit(0)).alias("total_records"), F.coalesce(done, F.lit(0)).alias("migrated_records"),
            F.coalesce(percentage(done, total), F.lit(0.0)).alias("percentage")]


def migration_status(ids: DataFrame, events: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Status, progress and times of the given migrations; an empty id stops the job."""
    guarded = ids.select(F.when(F.coalesce(F.col("migration_id"), F.lit("")) != "", F.col("migration_id")).otherwise(
        F.raise_error(F.lit("migration_id is required and must be a non-empty string"))).alias("migration_id"))
    joined = (guarded.join(current_states(events), "migration_id", "left")
              .join(latest_checkpoints(checkpoints, "total_records", "processed_count", "batch_no", "started_at",
                                       "checkpoint_at"), "migration_id", "left"))
    ended = F.when(F.col("state").isin(*TERMINAL), F.col("checkpoint_at"))
    return joined.select(
        "migration_id", F.coalesce("state", F.lit("not_started")).alias("status"),
        *_progress(F.col("total_records"), F.col("processed_count")),
        F.coalesce(F.col("batch_no"), F.lit(0)).alias("batches_processed"),
        F.floor(F.coalesce(F.col("processed_count"), F.lit(0)) / 100).alias("batches_est"),
        rfc3339(F.col("started_at")).alias("started_at"), rfc3339(ended).alias("ended_at"))


def list_migrations(events: DataFrame, checkpoints: DataFrame, status: str | None = None, limit: int = 50,
                    offset: int = 0, sort_by: str = "created_at", sort_order: str = "desc") -> DataFrame:
    """One page of migrations in a global order, with the total number that match."""
    if not 1 <= limit <= 500 or offset < 0:
        raise ValueError("limit is 1 to 500, offset at least 0")
    if sort_by not in SORT_KEYS or sort_order not in ("asc", "desc"):
        raise ValueError(f"sort_by is one of {SORT_KEYS}, sort_order asc or desc")
    found = current_states(events).withColumnRenamed("state", "status")
    if status:
        if status.lower() not in MIGRATION_STATES:
            raise ValueError(f"unknown status: {status!r}")
        found = found.filter(F.col("status") == status.lower())
    keys = [sort_by] if sort_by == "migration_id" else [sort_by, "migration_id"]
    order = [F.col(k).asc() if sort_order == "asc" else F.col(k).desc() for k in keys]
    page = found.orderBy(*order).offset(offset).limit(limit)
    # A page has at most 500 migrations: only their checkpoints are grouped.
    listed = F.broadcast(page.select("migration_id"))
    done = latest_checkpoints(checkpoints.join(listed, "migration_id", "left_semi"), "total_records", "processed_count")
    has_total = F.col("total_records") > 0
    joined = page.join(done, "migration_id", "left")
    return joined.select(
        "migration_id", "status", "created_at",
        F.when(has_total, F.col("total_records")).alias("progress_total"),
        F.when(has_total, F.col("processed_count")).alias("progress_current"),
        F.when(has_total, percentage(F.col("processed_count"), F.col("total_records"))).alias("progress_percent"),
        found.agg(F.count(F.lit(1))).scalar().alias("total")).orderBy(*order)


def migration_stats(checkpoints: DataFrame) -> DataFrame:
    """Counters of each migration over all of its checkpoints."""
    return checkpoints.groupBy("migration_id").agg(
        F.max("total_records").alias("total_records"), F.max("processed_count").alias("migrated_records"),
        F.max("failed_count").alias("failed_records"), F.max("batch_no").alias("batches_processed"),
        F.min("started_at").alias("start_time"), F.max("checkpoint_at").alias("end_time"))


def transition_violations(events: DataFrame) -> DataFrame:
    """State changes that the order of states does not allow: ``migration_id, seq, prev_state, state``.

    The first event of a migration follows on ``not_started``; repeating a state is no change.
    """
    rows = with_context(events.select("migration_id", "seq", "state"), "migration_id", "seq", previous=("state",))
    moves = (rows.withColumn("prev_state", F.coalesce("prev_state", F.lit("not_started")))
             .filter(F.col("prev_state") != F.col("state")))
    return moves.join(transition_frame(events.sparkSession), ["prev_state", "state"], "left_anti").select(
        "migration_id", "seq", "prev_state", "state")


def throughput_eta(checkpoints: DataFrame, width: int = 5, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Records per second between checkpoints, its moving average, and seconds to go by that average."""
    rows = with_context(
        checkpoints.select("migration_id", "seq", "total_records", "processed_count", "checkpoint_at"),
        "migration_id", "seq", previous=("processed_count", "checkpoint_at"), position="step")
    seconds = (F.unix_micros(F.col("checkpoint_at").cast("timestamp"))
               - F.unix_micros(F.col("prev_checkpoint_at").cast("timestamp"))) / 1000000
    done = F.col("processed_count") - F.col("prev_processed_count")
    rated = rows.withColumn("rate", F.when(seconds > 0, done / seconds))
    averaged = moving_average(rated, "migration_id", "step", "rate", "avg_rate", width, chunk_rows)
    left = F.col("total_records") - F.col("processed_count")
    return averaged.select("migration_id", "seq", "step", "processed_count", "rate", "avg_rate",
                           F.when(F.col("avg_rate") > 0, left / F.col("avg_rate")).alias("eta_seconds"))


class StateStore:
    """The two tables as parquet folders with appends only."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}")
        except Exception as error:  # noqa: BLE001 - only an absent folder means "empty"
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], ddl)
            raise

    def events(self) -> DataFrame:
        return self._read("events", EVENT_DDL)

    def checkpoints(self) -> DataFrame:
        return self._read("checkpoints", CHECKPOINT_DDL)

    def state(self, migration_id: str) -> str:
        row = current_states(self.events().filter(F.col("migration_id") == migration_id)).first()
        return row["state"] if row else "not_started"

    def set_state(self, migration_id: str, state: str, reason: str | None = None) -> None:
        if state not in MIGRATION_STATES:
            raise ValueError(f"unknown state: {state!r}")
        row = self.spark.createDataFrame([(migration_id, time.time_ns(), state, reason)],
                                         "migration_id string, seq bigint, state string, reason string")
        self._append(row.withColumn("ts", F.current_timestamp()), "events")

    def move(self, migration_id: str, state: str, reason: str | None = None) -> None:
        """Change the state, if the order of states allows it."""
        before = self.state(migration_id)
        if before != state and (before, state) not in ALLOWED_TRANSITIONS:
            raise ValueError(f"a migration that is {before} cannot become {state}")
        self.set_state(migration_id, state, reason)

    def checkpoint(self, migration_id: str):
        """Newest checkpoint row of one migration, None when there is none."""
        return latest_checkpoints(self.checkpoints().filter(F.col("migration_id") == migration_id)).first()

    def save_checkpoint(self, migration_id: str, known_state: str | None = None, **values) -> None:
        """Append a checkpoint; a migration that had not started becomes in progress.

        A caller that knows the state saves looking it up.
        """
        given = {"migration_id": migration_id, "seq": time.time_ns(), "deleted": False, **values}
        names = T.StructType.fromDDL(CHECKPOINT_DDL).names
        unknown = set(given) - set(names)
        if unknown:
            raise ValueError(f"unknown checkpoint fields: {sorted(unknown)}")
        row = self.spark.createDataFrame([tuple(given.get(n) for n in names)], CHECKPOINT_DDL)
        self._append(row.withColumn("checkpoint_at", F.coalesce("checkpoint_at", F.current_timestamp()))
                     .withColumn("started_at", F.coalesce("started_at", F.current_timestamp())), "checkpoints")
        if (known_state or self.state(migration_id)) == "not_started":
            self.set_state(migration_id, "in_progress")

    def delete_checkpoint(self, migration_id: str) -> None:
        mine = self.checkpoints().filter(F.col("migration_id") == migration_id)
        marks = delete_checkpoints(mine, mine).filter("deleted")
        self._append(marks.withColumn("seq", F.lit(time.time_ns())), "checkpoints")

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")
