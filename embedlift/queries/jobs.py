"""Whole migrations of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.operators.state import StateStore, current_states, latest_checkpoints
from embedlift.operators.transform import FieldRule, Mapping
from embedlift.operators.validate import validate_migration
from embedlift.plans.job import MigrationConfig, dry_run, request, resume_migration, run_migration
from embedlift.queries import query
from embedlift.queries.tables import SRC_SQL, document_records, event_records, source_records
from embedlift.sinks.collection import Collection
from embedlift.workspace import scratch_path

DOC_ID = "lpad(CAST(doc_id AS VARCHAR), 10, '0')"
DOCUMENT_MAPPING = Mapping("pinecone", "qdrant", (
    FieldRule("lang", "language"), FieldRule("source", "origin"), FieldRule("n_chars", "chars", "auto_number"),
    FieldRule("text", "content")))


def meta(name, as_type="string"):
    return V.field(F.col("metadata"), name, as_type)


def _mapped(df):
    return df.select("id", meta("language").alias("language"), meta("origin").alias("origin"), meta("chars", "bigint").alias("chars"),
                     F.md5(meta("content")).alias("content_md5"))


_MAPPED_SQL = f"SELECT {DOC_ID} AS id, lang AS language, source AS origin, n_chars AS chars, md5(text) AS content_md5 FROM documents"


class StopsAfterAStep(StateStore):
    """Asks the run to stop once it has saved a step."""

    def save_checkpoint(self, migration_id, known_state=None, **values):
        super().save_checkpoint(migration_id, known_state, **values)
        if values.get("batch_no"):
            request(self, migration_id, "stop")


def _stores(spark, label, states=StateStore):
    root = scratch_path(spark, label)
    return Collection(spark, f"{root}/target"), states(spark, f"{root}/state")


@query("flagship_migration", f"""WITH {SRC_SQL}
SELECT count(*) AS total_records, count(*) AS valid_records, 0 AS invalid_records, 1.0 AS avg_similarity, 1.0 AS min_similarity,
       1.0 AS max_similarity FROM src""")
def flagship(spark, sf):
    """Embeddings with their documents, mapped, merged into an empty target, and validated in full."""
    mapping = Mapping("pinecone", "qdrant", (
        FieldRule("lang", "lang"), FieldRule("source", "source"), FieldRule("n_chars", "n_chars", "auto_number"),
        FieldRule("label", "label"), FieldRule("text", "text")))
    source = source_records(spark, sf)
    target, state = _stores(spark, "flagship")
    run_migration(source, target, state, MigrationConfig("flagship", mapping))
    summary, _ = validate_migration(source, target.snapshot(), sample_rate=None)
    return summary.select("total_records", "valid_records", "invalid_records",
                          *[F.round(c, 6).alias(c) for c in ("avg_similarity", "min_similarity", "max_similarity")])


@query("run_migration", _MAPPED_SQL)
def run_documents(spark, sf):
    target, state = _stores(spark, "run")
    run_migration(document_records(spark, sf), target, state, MigrationConfig("docs", DOCUMENT_MAPPING, steps=2))
    return _mapped(target.snapshot())


@query("run_migration_progress", """
SELECT 'docs' AS migration_id, 'completed' AS state, count(*) AS total_records, count(*) AS processed_count, 0 AS failed_count,
       CAST(ceil(count(*) / 100) AS BIGINT) AS batch_no, lpad(CAST(max(doc_id) AS VARCHAR), 10, '0') AS last_processed_id FROM documents""")
def run_progress(spark, sf):
    target, state = _stores(spark, "progress")
    run_migration(document_records(spark, sf), target, state, MigrationConfig("docs", DOCUMENT_MAPPING))
    return current_states(state.events()).select("migration_id", "state").join(
        latest_checkpoints(state.checkpoints()), "migration_id").select(
        "migration_id", "state", "total_records", "processed_count", "failed_count", "batch_no", "last_processed_id")


@query("resume_migration", _MAPPED_SQL)
def resume_documents(spark, sf):
    """A run of two steps is stopped after the first and goes on from its checkpoint."""
    target, state = _stores(spark, "resume", StopsAfterAStep)
    config = MigrationConfig("docs", DOCUMENT_MAPPING, steps=2)
    if run_migration(document_records(spark, sf), target, state, config) != "in_progress":
        raise RuntimeError("the run did not stop")
    resume_migration(document_records(spark, sf), target, StateStore(spark, state.root), config)
    return _mapped(target.snapshot())


@query("rerun_migration", f"SELECT {DOC_ID} AS id, upper(lang) AS language, source AS origin, n_chars AS chars, md5(text) AS content_md5 FROM documents")
def rerun_documents(spark, sf):
    """The source has changed since the first run; a second run of the same migration brings the changes."""
    target, state = _stores(spark, "rerun")
    config = MigrationConfig("docs", DOCUMENT_MAPPING)
    run_migration(document_records(spark, sf), target, state, config)
    changed = document_records(spark, sf).withColumn("metadata", V.to_object(F.map_concat(
        F.map_filter(V.as_map(F.col("metadata")), lambda k, _: k != "lang"),
        F.create_map(F.lit("lang"), F.upper(meta("lang")).cast("variant")))))
    run_migration(changed, target, state, config)
    return _mapped(target.snapshot())


@query("checkpoint_contents", """
SELECT 'docs' AS migration_id, count(*) AS processed_count, 4 AS n_rules, 'pinecone' AS source_type, count(*) AS sampled, 1.0 AS min_similarity FROM documents""")
def contents_of_checkpoint(spark, sf):
    """The last checkpoint holds the mapping and what validation found."""
    target, state = _stores(spark, "contents")
    run_migration(document_records(spark, sf), target, state, MigrationConfig("docs", DOCUMENT_MAPPING, validate_every=1, sample_rate=1.0))
    return latest_checkpoints(state.checkpoints()).select(
        "migration_id", "processed_count", F.json_array_length(F.get_json_object("mapping_json", "$.rules")).alias("n_rules"),
        F.get_json_object("mapping_json", "$.source_type").alias("source_type"), F.col("validation.sampled").alias("sampled"),
        F.round("validation.min", 6).alias("min_similarity"))


@query("migration_control", "SELECT 'stopped' AS step, 'in_progress' AS state, 0 AS n FROM (SELECT count(*) FROM documents) "
       "UNION ALL SELECT 'resumed', 'completed', count(*) FROM documents UNION ALL SELECT 'rolled back', 'rolled_back', 0 FROM (SELECT count(*) FROM documents)")
def control_documents(spark, sf):
    """Stop before the first step, resume to the end, roll back to the empty version."""
    target, state = _stores(spark, "control")
    source = document_records(spark, sf)
    config = MigrationConfig("docs", DOCUMENT_MAPPING)
    state.save_checkpoint("docs", total_records=0, processed_count=0, failed_count=0, batch_no=0, target_version=0)
    request(state, "docs", "stop")
    rows = [("stopped", state.state("docs"), target.snapshot())]
    resume_migration(source, target, state, config)
    rows.append(("resumed", state.state("docs"), target.snapshot()))
    request(state, "docs", "rollback", target)
    rows.append(("rolled back", state.state("docs"), target.snapshot()))
    found = None
    for step, status, df in rows:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), F.lit(status).alias("state"), "n")
        found = one if found is None else found.unionByName(one)
    return found


@query("dry_run", """
SELECT 'mapped' AS finding, '' AS field, '' AS message, count(*) FILTER (WHERE event_type <> 'error') AS n_records FROM events
UNION ALL SELECT 'rejected', 'kind', 'failed to convert field kind', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'constraint', 'evt', 'nested object is not allowed', 0 FROM events HAVING false""")
def dry_run_events(spark, sf):
    kind = F.try_variant_get("metadata", "$.evt.type", "string")
    flagged = event_records(spark, sf).withColumn("metadata", V.to_object(F.map_concat(
        V.as_map(F.col("metadata")), F.create_map(F.lit("kind"), F.when(kind == "error", "broken").otherwise("7").cast("variant")))))
    mapping = Mapping("qdrant", "pinecone", (FieldRule("evt", "evt"), FieldRule("tags", "tags"), FieldRule("kind", "kind", "to_int")))
    return dry_run(flagged, mapping)
