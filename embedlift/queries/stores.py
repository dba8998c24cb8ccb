"""Collections and store exports filled from the given tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.operators.transform import map_namespace
from embedlift.queries import query
from embedlift.queries.tables import (SRC_SQL, document_records, embedded_documents, event_records, id_text, source_records, table)
from embedlift.sinks.buckets import BucketedCollection
from embedlift.sinks.collection import Collection
from embedlift.sinks.exports import write_milvus, write_pinecone, write_qdrant, write_weaviate
from embedlift.sinks.merge import dedupe_last_write, delete_by_ids, upsert
from embedlift.sources.batches import assign_batches
from embedlift.sources.paged import paged_records, paged_source, paged_stream, stored_pages, write_pages
from embedlift.sources.records import (read_milvus, read_pinecone, read_qdrant, read_records, read_rejects, read_weaviate,
                                       records_from)
from embedlift.workspace import scratch_path

DOC_ID = "lpad(CAST(doc_id AS VARCHAR), 10, '0')"


def meta(name, as_type="string"):
    return V.field(F.col("metadata"), name, as_type)


# -- merge -----------------------------------------------------------------
def _delta(spark, sf):
    """Every label row twice: first with its quality, then as revision 2 with its toxicity."""
    labels = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").withColumn("id", id_text("doc_id"))
    rows = labels.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    flag = F.when(F.col("seq") == 1, F.col("quality")).otherwise(F.col("toxic"))
    return records_from(rows.withColumn("flag", flag), "id", F.array(F.col("n_chars").cast("float")), ["lang", "flag", "seq"],
                        keep=("seq",))


_DELTA_SQL = f"""delta AS (SELECT {DOC_ID.replace('doc_id', 'labels.doc_id')} AS id, lang, toxic AS flag, CAST(n_chars AS BIGINT) AS n_chars
  FROM labels JOIN documents ON labels.doc_id = documents.doc_id)"""
_MERGED_SQL = f"""WITH {SRC_SQL}, {_DELTA_SQL},
merged AS (SELECT id, lang, label, NULL AS flag, len(vec) AS dims FROM src WHERE id NOT IN (SELECT id FROM delta)
           UNION ALL SELECT id, lang, NULL, flag, 1 FROM delta)"""


def _merged(df):
    return df.select("id", meta("lang").alias("lang"), meta("label", "int").alias("label"), meta("flag", "int").alias("flag"),
                     F.size("vector").alias("dims"))


@query("dedupe_last_write", f"WITH {_DELTA_SQL} SELECT id, 2 AS seq, lang, flag, n_chars FROM delta")
def newest_of_delta(spark, sf):
    return dedupe_last_write(_delta(spark, sf)).select(
        "id", "seq", meta("lang").alias("lang"), meta("flag", "int").alias("flag"), F.col("vector")[0].cast("bigint").alias("n_chars"))


@query("upsert_merge", f"{_MERGED_SQL} SELECT * FROM merged")
def merge_delta(spark, sf):
    return _merged(upsert(source_records(spark, sf), _delta(spark, sf), seq="seq"))


@query("delete_by_ids", f"""WITH {SRC_SQL} SELECT id, lang, label FROM src
WHERE id NOT IN (SELECT {DOC_ID} FROM labels WHERE quality = 1)""")
def delete_good(spark, sf):
    good = table(spark, sf, "labels").filter(F.col("quality") == 1).select(id_text("doc_id").alias("id"))
    return delete_by_ids(source_records(spark, sf), good).select("id", meta("lang").alias("lang"), meta("label", "int").alias("label"))


# -- versioned collection --------------------------------------------------
@query("collection_upsert", f"{_MERGED_SQL} SELECT * FROM merged")
def collection_after_upsert(spark, sf):
    store = Collection(spark, scratch_path(spark, "upsert"))
    store.upsert(source_records(spark, sf), batch_id="load")
    store.upsert(_delta(spark, sf), batch_id="delta", seq="seq")
    store.upsert(source_records(spark, sf), batch_id="load")   # a repeated batch changes nothing
    return _merged(store.snapshot())


@query("collection_versions", f"""{_MERGED_SQL}, toxic AS (SELECT {DOC_ID} AS id FROM labels WHERE toxic = 1)
SELECT 'loaded' AS version, count(*) AS n, count(label) AS n_label FROM src
UNION ALL SELECT 'merged', count(*), count(label) FROM merged
UNION ALL SELECT 'deleted', count(*), count(label) FROM merged WHERE id NOT IN (SELECT id FROM toxic)
UNION ALL SELECT 'compacted', count(*), count(label) FROM merged WHERE id NOT IN (SELECT id FROM toxic)
UNION ALL SELECT 'rolled back', count(*), count(label) FROM src""")
def collection_history(spark, sf):
    store = Collection(spark, scratch_path(spark, "versions"))
    toxic = table(spark, sf, "labels").filter(F.col("toxic") == 1).select(id_text("doc_id").alias("id"))
    loaded = store.upsert(source_records(spark, sf), batch_id="load")
    at = {"loaded": loaded, "merged": store.upsert(_delta(spark, sf), seq="seq"), "deleted": store.delete(toxic)}
    at["compacted"] = store.compact()
    at["rolled back"] = store.rollback_to(loaded)
    found = None
    for name, version in at.items():
        one = store.snapshot(version).agg(F.count(F.lit(1)).alias("n"), F.count(meta("label", "int")).alias("n_label")).select(
            F.lit(name).alias("version"), "n", "n_label")
        found = one if found is None else found.unionByName(one)
    return found


# -- collection in buckets ---------------------------------------------------
@query("bucketed_upsert", f"{_MERGED_SQL} SELECT * FROM merged")
def buckets_after_upsert(spark, sf):
    store = BucketedCollection(spark, scratch_path(spark, "buckets"), buckets=16)
    store.upsert(source_records(spark, sf), batch_id="load", unique=True)
    store.upsert(_delta(spark, sf), batch_id="delta", seq="seq")
    store.upsert(source_records(spark, sf), batch_id="load")   # a repeated batch changes nothing
    return _merged(store.snapshot())


@query("bucketed_versions", f"""{_MERGED_SQL}, toxic AS (SELECT {DOC_ID} AS id FROM labels WHERE toxic = 1)
SELECT 'loaded' AS version, count(*) AS n, count(label) AS n_label FROM src
UNION ALL SELECT 'merged', count(*), count(label) FROM merged
UNION ALL SELECT 'deleted', count(*), count(label) FROM merged WHERE id NOT IN (SELECT id FROM toxic)
UNION ALL SELECT 'rolled back', count(*), count(label) FROM src
UNION ALL SELECT 'merged again', count(*), count(label) FROM merged""")
def bucketed_history(spark, sf):
    """Each version is read by the folders that its commits name."""
    store = BucketedCollection(spark, scratch_path(spark, "bucket-versions"), buckets=8, checkpoint_every=2)
    toxic = table(spark, sf, "labels").filter(F.col("toxic") == 1).select(id_text("doc_id").alias("id"))
    loaded = store.upsert(source_records(spark, sf), batch_id="load", unique=True)
    at = {"loaded": loaded, "merged": store.upsert(_delta(spark, sf), "delta", seq="seq"), "deleted": store.delete(toxic)}
    at["rolled back"] = store.rollback_to(loaded)
    at["merged again"] = store.upsert(_delta(spark, sf), "delta", seq="seq")   # the rollback took the batch back
    found = None
    for name, version in at.items():
        one = store.snapshot(version).agg(F.count(F.lit(1)).alias("n"), F.count(meta("label", "int")).alias("n_label")).select(
            F.lit(name).alias("version"), "n", "n_label")
        found = one if found is None else found.unionByName(one)
    return found


@query("bucketed_merge_writes", f"""WITH {SRC_SQL}, picked AS (SELECT id, label + 1000 AS label FROM src WHERE vec_id % 499 = 0)
SELECT src.id, coalesce(picked.label, src.label) AS label, true AS only_touched_buckets_written FROM src LEFT JOIN picked USING (id)""")
def rewrite_few_buckets(spark, sf):
    """Changes of every 499th record: the buckets whose folder changed are those of the changed ids, and no other."""
    store = BucketedCollection(spark, scratch_path(spark, "bucket-writes"), buckets=256)
    store.upsert(source_records(spark, sf), unique=True)
    before = store.log.head().buckets
    changed = records_from(embedded_documents(spark, sf).filter(F.col("vec_id") % 499 == 0).withColumn("label", F.col("label") + 1000), "id", "vector", ["label"])
    store.upsert(changed, unique=True)
    after = store.log.head().buckets
    touched = {r[0] for r in changed.select(store.bucket_of(F.col("id"))).distinct().collect()}
    only = {b for b in after if after[b] != before.get(b)} == touched
    return store.snapshot().select("id", meta("label", "int").alias("label"), F.lit(only).alias("only_touched_buckets_written"))


@query("concurrent_writers", """
SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS id, CAST(event_id % 3 AS INTEGER) AS writer, 4 AS n_commits FROM events""")
def three_writers(spark, sf):
    """Three threads with a collection of their own write thirds of the events, spread over all buckets, at the same time."""
    root = scratch_path(spark, "writers")
    rows = event_records(spark, sf)
    BucketedCollection(spark, root, buckets=8).upsert(rows, unique=True)

    def write(third: int) -> int:
        number = F.col("id").cast("bigint")
        mine = rows.filter(number % 3 == third).withColumn("metadata", F.to_variant_object(F.struct(F.lit(third).alias("writer"))))
        return BucketedCollection(spark, root).upsert(mine, f"writer-{third}", unique=True)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    store = BucketedCollection(spark, root)
    return store.snapshot().select("id", meta("writer", "int").alias("writer"), F.lit(len(store.commits())).alias("n_commits"))


# -- exports and readers ---------------------------------------------------
_TRIP_SQL = """SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS id, round(value, 4) AS first, CAST(props->>'k' AS INTEGER) AS k,
  event_type AS evt_type, '["' || event_type || '","' || user_id || '"]' AS tags FROM events"""


def _trip(df, evt_path="$.evt.type"):
    return df.select("id", F.round(F.col("vector")[0].cast("double"), 4).alias("first"), meta("k", "int").alias("k"),
                     F.try_variant_get("metadata", evt_path, "string").alias("evt_type"),
                     V.scalar_text(meta("tags", "variant")).alias("tags"))


@query("pinecone_round_trip", _TRIP_SQL)
def through_pinecone(spark, sf):
    path = scratch_path(spark, "pinecone")
    write_pinecone(event_records(spark, sf), path)
    return _trip(read_pinecone(spark, path))


@query("qdrant_round_trip", _TRIP_SQL)
def through_qdrant(spark, sf):
    path = scratch_path(spark, "qdrant")
    write_qdrant(event_records(spark, sf), path)
    return _trip(read_qdrant(spark, path))


@query("weaviate_round_trip", _TRIP_SQL)
def through_weaviate(spark, sf):
    path = scratch_path(spark, "weaviate")
    write_weaviate(event_records(spark, sf), path, "Event")
    return _trip(read_weaviate(spark, path, "Event"))


@query("milvus_round_trip", _TRIP_SQL)
def through_milvus(spark, sf):
    path = scratch_path(spark, "milvus")
    write_milvus(event_records(spark, sf), path)
    return _trip(read_milvus(spark, path))


@query("weaviate_pages", f"""
SELECT {DOC_ID} AS id, CAST(n_chars AS BIGINT) AS first, lang, md5(text) AS text_md5 FROM documents WHERE lang <> 'fr'""")
def weaviate_pages(spark, sf):
    """Response pages of one source each; French items lack an id and are dropped."""
    docs = table(spark, sf, "documents").withColumn("id", F.when(F.col("lang") != "fr", id_text("doc_id")).otherwise(""))
    numbered = assign_batches(docs.withColumn("order_id", id_text("doc_id")).withColumnRenamed("id", "_id")
                              .withColumnRenamed("order_id", "id"), 50)
    item = F.to_json(F.struct(F.struct(F.col("_id").alias("id"), F.array("n_chars").alias("vector")).alias("_additional"), "lang", "text"))
    page = numbered.groupBy("batch_no").agg(F.array_join(F.collect_list(item), ",").alias("items"))
    path = scratch_path(spark, "weaviate-pages")
    page.select(F.concat(F.lit('{"data":{"Get":[{"Doc":['), "items", F.lit(',17]}]}}'))).write.text(path)
    return read_weaviate(spark, path, "Doc").select(
        "id", F.col("vector")[0].cast("bigint").alias("first"), meta("lang").alias("lang"), F.md5(meta("text")).alias("text_md5"))


@query("pinecone_requests", f"""
SELECT {DOC_ID} AS id, lang, CAST(n_chars AS BIGINT) AS n_chars, md5(text) AS text_md5 FROM documents""")
def pinecone_requests(spark, sf):
    """Documents written as request-sized pages of 100 records and read back."""
    path = scratch_path(spark, "pinecone-requests")
    write_pinecone(assign_batches(document_records(spark, sf), 100), path, per_request=True)
    return read_pinecone(spark, path).select("id", meta("lang").alias("lang"), meta("n_chars", "bigint").alias("n_chars"),
                                             F.md5(meta("text")).alias("text_md5"))


@query("parquet_round_trip", f"""WITH {SRC_SQL}
SELECT id, lang, label, round(CAST(vec[1] AS DOUBLE), 5) AS first FROM src""")
def through_parquet(spark, sf):
    path = scratch_path(spark, "records")
    source_records(spark, sf).write.parquet(path)
    return read_records(spark, path).select("id", meta("lang").alias("lang"), meta("label", "int").alias("label"),
                                            F.round(F.col("vector")[0].cast("double"), 5).alias("first"))


@query("namespace_as_partition", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS partition_name FROM customer""")
def namespace_partitions(spark, sf):
    rows = records_from(table(spark, sf, "customer").withColumn("namespace", F.col("c_mktsegment")), "c_custkey",
                        F.array("c_acctbal"), ["c_name"], keep=("namespace",))
    path = scratch_path(spark, "partitions")
    map_namespace(rows, "partition").write.partitionBy("partition_name").parquet(path)
    return spark.read.parquet(path).select("id", "partition_name")


def _broken_export(spark, sf, store, line):
    """Events as lines of an export; every seventh is cut off, every eleventh has no id."""
    number = F.col("event_id")
    record_id = F.when(number % 11 == 0, "").otherwise(number.cast("string"))
    text = F.to_json(line(record_id))
    path = scratch_path(spark, f"{store}-rejects")
    table(spark, sf, "events").select(F.when(number % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 3)).otherwise(text).alias("value")).write.text(path)
    return path


_LINES = {
    "pinecone": lambda i: F.struct(i.alias("id"), F.array("value").alias("values")),
    "qdrant": lambda i: F.struct(i.alias("id"), F.array("value").alias("vector")),
    "weaviate": lambda i: F.struct(i.alias("id"), F.array("value").alias("vector"), F.struct("event_type").alias("properties")),
    "milvus": lambda i: F.struct(i.alias("id"), F.array("value").alias("embedding")),
}
_READERS = {"pinecone": read_pinecone, "qdrant": read_qdrant, "weaviate": read_weaviate, "milvus": read_milvus}


def _rejects_query(store: str) -> None:
    @query(f"{store}_rejects", """
SELECT CASE WHEN event_id % 7 = 0 THEN 'not valid JSON' WHEN event_id % 11 = 0 THEN 'record has no id' ELSE 'record' END AS outcome,
       count(*) AS n FROM events GROUP BY 1""")
    def run(spark, sf):
        path = _broken_export(spark, sf, store, _LINES[store])
        outcomes = _READERS[store](spark, path).select(F.lit("record").alias("outcome")).unionByName(
            read_rejects(spark, path, store).select(F.col("message").alias("outcome")))
        return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


for _store in _LINES:
    _rejects_query(_store)


@query("pinecone_sparse_requests", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS namespace, c_nationkey AS at, round(c_acctbal, 2) AS value FROM customer""")
def sparse_requests(spark, sf):
    """Sparse vectors in namespaces, written as request documents and read back."""
    rows = records_from(table(spark, sf, "customer").withColumn("namespace", F.col("c_mktsegment")).withColumn("sparse", F.struct(
        F.array(F.col("c_nationkey").cast("bigint")).alias("indices"), F.array(F.col("c_acctbal").cast("float")).alias("values"))),
        "c_custkey", F.array("c_acctbal"), ["c_name"], keep=("namespace", "sparse"))
    path = scratch_path(spark, "pinecone-sparse")
    write_pinecone(assign_batches(rows, 100), path, per_request=True)
    return read_pinecone(spark, path).select("id", "namespace", F.col("sparse.indices")[0].alias("at"),
                                             F.round(F.col("sparse.values")[0].cast("double"), 2).alias("value"))


_PAGED_SQL = """
SELECT CAST(vec_id AS VARCHAR) AS id, len(embedding) AS dims, round(CAST(embedding[1] AS DOUBLE), 5) AS first, label FROM embeddings"""


def _pages(spark, sf):
    """The embeddings as pages of four shards, each naming the next page of its shard."""
    rows = table(spark, sf, "embeddings")
    shard, page = F.col("vec_id") % 4, F.floor(F.col("vec_id") / 400)
    path = scratch_path(spark, "pages")
    (rows.select(shard.cast("int").alias("shard"), page.cast("int").alias("page"), F.struct(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"), "label").alias("r"))
     .groupBy("shard", "page").agg(F.to_json(F.sort_array(F.collect_list("r"))).alias("rows")).write.parquet(path))
    pages = spark.read.parquet(path)
    last = pages.groupBy("shard").agg(F.max("page").alias("last"))
    return pages.join(last, "shard").select("shard", "page", F.when(F.col("page") < F.col("last"), F.col("page") + 1).alias("next"), "rows")


def _paged(df):
    return df.select("id", F.size("vector").alias("dims"), F.round(F.col("vector")[0].cast("double"), 5).alias("first"), meta("label", "int").alias("label"))


@query("paged_records", _PAGED_SQL)
def read_stored_pages(spark, sf):
    return _paged(paged_records(_pages(spark, sf)))


@query("paged_source", _PAGED_SQL)
def paged_embeddings(spark, sf):
    """Page files pulled one by one along their tokens, a task for each shard."""
    path = scratch_path(spark, "page-files")
    write_pages(_pages(spark, sf), path)
    return _paged(paged_source(spark, stored_pages(path, "0"), range(4)))


@query("paged_stream", _PAGED_SQL)
def stream_pages(spark, sf):
    """The same pages as a stream: one query reads a first batch, another goes on after it from the tokens it reached."""
    root = scratch_path(spark, "page-stream")
    write_pages(_pages(spark, sf), f"{root}/pages")

    def start(trigger):
        stream = paged_stream(spark, stored_pages(f"{root}/pages", "0"), range(4), f"{root}/position", pages_per_batch=8)
        return (stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
                .trigger(**trigger).start())

    start({"availableNow": True}).awaitTermination()
    rest = start({"processingTime": "0 seconds"})
    rest.processAllAvailable()
    rest.stop()
    return _paged(spark.read.parquet(f"{root}/out"))
