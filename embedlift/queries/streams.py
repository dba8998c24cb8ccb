"""Streaming operators driven to completion over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.operators.audit import audit_windows
from embedlift.operators.state import StateStore, latest_checkpoints
from embedlift.operators.transform import FieldRule, Mapping
from embedlift.queries import query
from embedlift.queries.logs import _bucket_sql, fast_requests
from embedlift.queries.tables import event_records, table
from embedlift.sinks.buckets import BucketedCollection
from embedlift.sinks.collection import Collection
from embedlift.sources.records import records_from
from embedlift.sources.streams import CHANGE_DDL, stream_records
from embedlift.streaming.migrate import (cdc_sync, dual_write, migrate_stream, progress_stream, running_validation,
                                         validate_stream)
from embedlift.streaming.requests import rate_limit_stream
from embedlift.workspace import scratch_path

MAPPING = Mapping("pinecone", "qdrant", (FieldRule("evt", "event"), FieldRule("k", "k", "auto_number"), FieldRule("score", "score", "auto_number")))


def meta(name, as_type="string"):
    return V.field(F.col("metadata"), name, as_type)


def _record_files(spark, sf, label, files=8):
    """Event records as a folder of change files."""
    root = scratch_path(spark, label)
    event_records(spark, sf).repartition(files, "id").write.parquet(f"{root}/in")
    return root


def _stream(spark, root, files_per_batch=4):
    return stream_records(spark, f"{root}/in", files_per_batch=files_per_batch)


_EVENT_SQL = """SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS id, event_type AS evt_type, CAST(floor(value) AS BIGINT) AS score FROM events"""


def _mapped(df):
    return df.select("id", meta("event.type").alias("evt_type"), meta("score", "bigint").alias("score"))


@query("stream_records", "SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS id, CAST(props->>'k' AS INTEGER) AS k FROM events")
def copy_stream(spark, sf):
    root = _record_files(spark, sf, "stream")
    (_stream(spark, root).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out").select("id", meta("k", "int").alias("k"))


@query("migrate_stream", _EVENT_SQL)
def migrate_events(spark, sf):
    root = _record_files(spark, sf, "migrate")
    target = Collection(spark, f"{root}/target")
    migrate_stream(_stream(spark, root), target, MAPPING, f"{root}/ck", compact_every=2).awaitTermination()
    return _mapped(target.snapshot())


@query("two_streams_one_target", _EVENT_SQL)
def two_streams(spark, sf):
    """Two folders of records, each read by a stream of the same name with a checkpoint of its own, into one target."""
    root = scratch_path(spark, "two")
    target = Collection(spark, f"{root}/target")
    rows = event_records(spark, sf)
    for part in range(2):
        rows.filter(F.col("id").cast("bigint") % 2 == part).write.parquet(f"{root}/in{part}")
        migrate_stream(stream_records(spark, f"{root}/in{part}", files_per_batch=64), target, MAPPING, f"{root}/ck{part}").awaitTermination()
    return _mapped(target.snapshot())


@query("dual_write", f"SELECT s.*, CAST(props->>'k' AS INTEGER) AS k FROM ({_EVENT_SQL}) s JOIN events ON CAST(s.id AS BIGINT) = event_id")
def write_both(spark, sf):
    root = _record_files(spark, sf, "dual")
    old, new = Collection(spark, f"{root}/old"), Collection(spark, f"{root}/new")
    dual_write(_stream(spark, root), [(old, None), (new, MAPPING)], f"{root}/ck").awaitTermination()
    return _mapped(new.snapshot()).join(old.snapshot().select("id", meta("k", "int").alias("k")), "id")


@query("cdc_sync", """
WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, (l_linenumber * 100000000 + l_partkey) * 100000 + CAST(round(l_extendedprice * 100) AS BIGINT) % 100000 AS seq, l_quantity, l_returnflag FROM lineitem),
newest AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
SELECT id, seq, CAST(l_quantity AS BIGINT) AS quantity FROM newest WHERE l_returnflag <> 'R'""")
def sync_line_items(spark, sf):
    return _synced(spark, sf, Collection(spark, scratch_path(spark, "cdc-target"), by_seq=True))


def _synced(spark, sf, target):
    """Line items as changes of their order; later lines arrive first, so that older changes are late."""
    root = scratch_path(spark, "cdc")
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    seq = (F.col("l_linenumber").cast("bigint") * 100000000 + F.col("l_partkey")) * 100000 + price % 100000
    changes = records_from(table(spark, sf, "lineitem").withColumn("seq", seq).withColumn(
        "op", F.when(F.col("l_returnflag") == "R", "delete").otherwise("upsert")), "l_orderkey", F.array("l_quantity"),
        {"quantity": F.col("l_quantity"), "seq": F.col("seq")}, keep=("op", "seq", "l_linenumber"))
    for part, late in enumerate((False, True)):
        newer = F.col("l_linenumber") >= 4
        changes.filter(~newer if late else newer).select("id", "vector", "metadata", "op", "seq").write.parquet(f"{root}/in/part={part}")
    for part in range(2):
        stream = stream_records(spark, f"{root}/in/part={part}", CHANGE_DDL)
        cdc_sync(stream, target, f"{root}/ck-{part}", name=f"cdc-{part}").awaitTermination()
    return target.snapshot().select("id", meta("seq", "bigint").alias("seq"), F.col("vector")[0].cast("bigint").alias("quantity"))


_TURNED_SQL = """
SELECT count(*) AS total_records, count(*) FILTER (WHERE event_type <> 'error') AS valid_records,
       count(*) FILTER (WHERE event_type = 'error') AS invalid_records,
       round(avg(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END), 6) AS avg_similarity, -1 AS min_similarity, 1 AS max_similarity FROM events"""


def _validated(spark, sf, make):
    """The target has the vectors of error events turned around."""
    root = _record_files(spark, sf, "validate")
    target = make(spark, f"{root}/target")
    is_error = F.try_variant_get("metadata", "$.evt.type", "string") == "error"
    turned = F.when(is_error, F.transform("vector", lambda x: -x)).otherwise(F.col("vector"))
    target.upsert(event_records(spark, sf).withColumn("vector", turned), unique=True)
    validate_stream(_stream(spark, root), target, f"{root}/runs", f"{root}/ck", sample_rate=1.0).awaitTermination()
    return running_validation(spark, f"{root}/runs").select(
        "total_records", "valid_records", "invalid_records", F.round("avg_similarity", 6).alias("avg_similarity"),
        F.round("min_similarity", 6).alias("min_similarity"), F.round("max_similarity", 6).alias("max_similarity"))


@query("validate_stream", _TURNED_SQL)
def validate_events(spark, sf):
    return _validated(spark, sf, Collection)


@query("validate_stream_buckets", _TURNED_SQL)
def validate_events_in_buckets(spark, sf):
    """The same against a collection in buckets, of which each batch opens those of its ids."""
    return _validated(spark, sf, lambda session, root: BucketedCollection(session, root, buckets=16))


@query("cdc_sync_buckets", """
WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, (l_linenumber * 100000000 + l_partkey) * 100000 + CAST(round(l_extendedprice * 100) AS BIGINT) % 100000 AS seq, l_quantity, l_returnflag FROM lineitem),
newest AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
SELECT id, seq, CAST(l_quantity AS BIGINT) AS quantity FROM newest WHERE l_returnflag <> 'R'""")
def sync_line_items_in_buckets(spark, sf):
    """Late changes meet the newest ``seq`` of their id, or its delete mark, in the bucket they are merged into."""
    return _synced(spark, sf, BucketedCollection(spark, scratch_path(spark, "cdc-buckets"), buckets=8, by_seq=True))


@query("progress_stream", "SELECT 'events' AS migration_id, count(*) AS processed_count, 2 AS batch_no FROM events")
def progress_of_events(spark, sf):
    root = _record_files(spark, sf, "progress")
    state = StateStore(spark, f"{root}/state")
    progress_stream(_stream(spark, root), state, f"{root}/ck", "events").awaitTermination()
    return latest_checkpoints(state.checkpoints()).select("migration_id", "processed_count", "batch_no")


@query("rate_limit_stream", _bucket_sql("k AS api_key, event_id, allowed, CASE WHEN allowed THEN 0 ELSE -32002 END AS code"))
def limited_stream(spark, sf):
    """The log arrives in two files, the earlier half first."""
    root = scratch_path(spark, "limit")
    rows = fast_requests(spark, sf)
    middle = rows.agg(F.expr("min(event_id) + (max(event_id) - min(event_id)) div 2")).first()[0]
    for part, keep in enumerate((F.col("event_id") <= middle, F.col("event_id") > middle)):
        rows.filter(keep).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = stream_records(spark, f"{root}/in", "event_id bigint, api_key string, ts timestamp", files_per_batch=1)
    (rate_limit_stream(stream, per_minute=2, burst=3).writeStream.format("parquet").option("path", f"{root}/out")
     .option("checkpointLocation", f"{root}/ck").outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out").select("api_key", "event_id", "allowed", "code")


@query("audit_windows_stream", """
SELECT time_bucket(INTERVAL 1 day, ts) AS window_start, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS errors
FROM events GROUP BY 1""")
def window_stream(spark, sf):
    """All windows: each micro-batch writes those that changed, the newest row of a window counts."""
    root = scratch_path(spark, "windows")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    log = stream.select("ts", F.col("value").alias("duration_ms"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"))

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{root}/out")

    (audit_windows(log, "1 day", late="1 hour").writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/ck")
     .outputMode("update").trigger(availableNow=True).start().awaitTermination())
    newest = spark.read.parquet(f"{root}/out").groupBy("window_start").agg(
        F.max_by("requests", "batch").alias("requests"), F.max_by("errors", "batch").alias("errors"))
    return newest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
