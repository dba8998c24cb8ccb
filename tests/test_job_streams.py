import pytest
from pyspark.sql import functions as F

from embedlift.operators.state import StateStore, transition_violations
from embedlift.operators.transform import FieldRule, Mapping
from embedlift.operators.validate import content_checksum
from embedlift.plans.job import MigrationConfig, dry_run, request, resume_migration, run_migration
from embedlift.sinks.collection import Collection
from embedlift.sources.streams import stream_records
from embedlift.streaming.migrate import dual_write, migrate_stream, record_progress

MAPPING = Mapping("pinecone", "qdrant", (FieldRule("n", "n", "auto_number"),))


def source(spark, n=60):
    return spark.range(n).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("id"),
                                 F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vector"),
                                 F.to_variant_object(F.struct(F.col("id").cast("double").alias("n"), F.lit(1).alias("x"))).alias("metadata"))


def stores(spark, root):
    return Collection(spark, f"{root}/t"), StateStore(spark, f"{root}/s")


def checksum(store):
    row = content_checksum(store.snapshot()).first()
    return row["n_records"], row["checksum"]


def test_steps_and_resume_end_in_the_same_target(spark, scratch):
    df = source(spark)
    whole, state = stores(spark, scratch + "/1")
    assert run_migration(df, whole, state, MigrationConfig("m", MAPPING)) == "completed"
    want = checksum(whole)
    assert want[0] == 60
    stepped, state = stores(spark, scratch + "/2")
    assert run_migration(df, stepped, state, MigrationConfig("m", MAPPING, batch_size=7, steps=3, checkpoint_every=2, validate_every=2)) == "completed"
    assert checksum(stepped) == want and state.checkpoint("m")["processed_count"] == 60
    # A crash after part of the work: resume from that checkpoint, overlapping with what is there already.
    for last in ("0000", "0041", "0059"):
        state.set_state("m", "failed")
        state.save_checkpoint("m", last_processed_id=last, total_records=60, processed_count=int(last) + 1, failed_count=0, batch_no=1)
        assert resume_migration(df, stepped, state, MigrationConfig("m", MAPPING)) == "completed"
        assert checksum(stepped) == want


def test_failure_is_recorded_and_raised(spark, scratch):
    target, state = stores(spark, scratch)
    bad = Mapping("qdrant", "milvus", (FieldRule("n", "n", "to_boolean"), FieldRule("x", "x", "to_iso_date")))
    with pytest.raises(Exception):
        run_migration(source(spark, 5), target, state, MigrationConfig("m", bad))
    assert state.state("m") == "failed" and target.snapshot().count() == 0
    assert run_migration(source(spark, 5), target, state, MigrationConfig("m", bad, on_error="drop")) == "completed"
    assert state.checkpoint("m")["failed_count"] == 5
    with pytest.raises(ValueError, match="must be different"):
        run_migration(source(spark, 5), target, state, MigrationConfig("m2", Mapping("qdrant", "qdrant")))


def test_control_requests(spark, scratch):
    target, state = stores(spark, scratch)
    with pytest.raises(ValueError, match="not running"):
        request(state, "m", "pause")
    with pytest.raises(ValueError, match="cannot roll back"):
        request(state, "m", "rollback")
    run_migration(source(spark, 5), target, state, MigrationConfig("m", MAPPING))
    with pytest.raises(ValueError, match="cannot resume"):
        resume_migration(source(spark, 5), target, state, MigrationConfig("m", MAPPING))
    request(state, "m", "rollback", target)
    assert state.state("m") == "rolled_back" and target.snapshot().count() == 0


def test_a_new_run_writes_what_has_changed(spark, scratch):
    target, state = stores(spark, scratch)
    run_migration(source(spark, 5), target, state, MigrationConfig("m", MAPPING))
    first = state.checkpoint("m")["run_id"]
    changed = source(spark, 5).withColumn("vector", F.array(F.lit(9.0).cast("float")))
    assert run_migration(changed, target, state, MigrationConfig("m", MAPPING)) == "completed"
    assert {tuple(r["vector"]) for r in target.snapshot().collect()} == {(9.0,)}
    assert state.checkpoint("m")["run_id"] != first and transition_violations(state.events()).count() == 0


def test_checkpoints_hold_mapping_validation_and_errors(spark, scratch):
    target, state = stores(spark, scratch)
    run_migration(source(spark), target, state, MigrationConfig("m", MAPPING, steps=2, validate_every=1, sample_rate=1.0))
    saved = state.checkpoint("m")
    assert '"auto_number"' in saved["mapping_json"] and saved["validation"]["sampled"] > 0 and round(saved["validation"]["min"], 6) == 1.0
    state.set_state("m", "failed")
    with pytest.raises(ValueError, match="another mapping"):
        resume_migration(source(spark), target, state, MigrationConfig("m", Mapping("pinecone", "qdrant", (FieldRule("x", "x"),))))
    bad = Mapping("qdrant", "milvus", (FieldRule("x", "x", "to_iso_date"),))
    with pytest.raises(Exception):
        run_migration(source(spark, 5), target, state, MigrationConfig("b", bad))
    assert "failed to convert" in state.checkpoint("b")["error"]


def test_dry_run_writes_nothing(spark):
    found = {(r["finding"], r["field"]): r["n_records"] for r in dry_run(source(spark, 5), Mapping(
        "qdrant", "weaviate", (FieldRule("n", "n"), FieldRule("x", "x", "to_iso_date")))).collect()}
    assert found == {("mapped", ""): 0, ("rejected", "x"): 5}


def test_stream_equals_batch_and_replays_change_nothing(spark, scratch):
    df = source(spark)
    df.repartition(4).write.parquet(f"{scratch}/in")
    batch, state = stores(spark, scratch + "/b")
    run_migration(df, batch, state, MigrationConfig("m", MAPPING))
    live = Collection(spark, f"{scratch}/live")
    migrate_stream(stream_records(spark, f"{scratch}/in", files_per_batch=1), live, MAPPING, f"{scratch}/ck").awaitTermination()
    assert checksum(live) == checksum(batch)
    version = live.version()
    # Nothing new below the same checkpoint: nothing is committed.
    migrate_stream(stream_records(spark, f"{scratch}/in", files_per_batch=1), live, MAPPING, f"{scratch}/ck").awaitTermination()
    assert live.version() == version
    # A lost checkpoint folder replays every batch; the content stays the same.
    migrate_stream(stream_records(spark, f"{scratch}/in", files_per_batch=1), live, MAPPING, f"{scratch}/ck-new").awaitTermination()
    assert checksum(live) == checksum(batch)


def test_two_streams_into_one_target_both_arrive(spark, scratch):
    df = source(spark)
    df.filter("id < '0030'").coalesce(1).write.parquet(f"{scratch}/in1")
    df.filter("id >= '0030'").coalesce(1).write.parquet(f"{scratch}/in2")
    live = Collection(spark, f"{scratch}/live")
    for part in (1, 2):
        migrate_stream(stream_records(spark, f"{scratch}/in{part}"), live, MAPPING, f"{scratch}/ck{part}").awaitTermination()
    assert live.snapshot().count() == 60


def test_stream_progress_counts_a_replay_once_and_rejects_apart(spark, scratch):
    state = StateStore(spark, f"{scratch}/s")
    batch = source(spark, 10)
    for number in (0, 1, 1, 2):
        record_progress(state, "p", batch, number, run_id="q", failed=number)
    saved = state.checkpoint("p")
    assert (saved["processed_count"], saved["failed_count"]) == (27, 3)


def test_dual_write_repairs_a_sink_that_missed_a_batch(spark, scratch):
    source(spark, 20).coalesce(1).write.parquet(f"{scratch}/in")

    class Broken(Collection):
        def upsert(self, *args, **options):
            raise RuntimeError("down")

    a, b = Collection(spark, f"{scratch}/a"), Collection(spark, f"{scratch}/b")
    with pytest.raises(Exception, match="down"):
        dual_write(stream_records(spark, f"{scratch}/in"), [(a, None), (Broken(spark, f"{scratch}/b"), MAPPING)], f"{scratch}/ck").awaitTermination()
    assert a.version() == 1 and b.version() == 0
    dual_write(stream_records(spark, f"{scratch}/in"), [(a, None), (b, MAPPING)], f"{scratch}/ck").awaitTermination()
    assert a.version() == 1 and b.snapshot().count() == 20


def test_the_alert_does_not_compare_the_pairs_again(spark, scratch, tmp_path, monkeypatch):
    import uuid

    from embedlift.plans import job

    real = job.validate_migration

    def counted(*args):
        summary, errors = real(*args)

        def pass_on(batches):
            (tmp_path / uuid.uuid4().hex).touch()   # one for each time the summary is computed
            yield from batches
        return summary.coalesce(1).mapInArrow(pass_on, summary.schema), errors

    monkeypatch.setattr(job, "validate_migration", counted)
    target, state = stores(spark, scratch)
    assert run_migration(source(spark), target, state, MigrationConfig("m", MAPPING, validate_every=1, sample_rate=1.0)) == "completed"
    assert len(list(tmp_path.iterdir())) == 1 and state.checkpoint("m")["validation"]["sampled"] == 60
