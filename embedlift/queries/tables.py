"""Records, states and logs derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from embedlift.sources.records import records_from
from embedlift.workspace import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def id_text(c: str) -> Column:
    """Zero padded, so that text order is number order."""
    return F.lpad(F.col(c).cast("string"), 10, "0")


# -- records ---------------------------------------------------------------
def embedded_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding with the fields of its document, as wide rows."""
    e, d = table(spark, sf, "embeddings"), table(spark, sf, "documents")
    return e.join(d, e.vec_id == d.doc_id, "left").select(
        id_text("vec_id").alias("id"), F.col("embedding").alias("vector"), "label", "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"), "text", "vec_id")


SRC_SQL = """src AS (
  SELECT lpad(CAST(vec_id AS VARCHAR), 10, '0') AS id, embedding AS vec, label, lang, source, n_chars, text, vec_id
  FROM embeddings LEFT JOIN documents ON vec_id = doc_id)"""


def source_records(spark: SparkSession, sf: str) -> DataFrame:
    return records_from(embedded_documents(spark, sf), "id", "vector", ["lang", "source", "n_chars", "label", "text"])


def target_records(spark: SparkSession, sf: str) -> DataFrame:
    """A copy of the source records that has drifted.

    Toxic documents are missing and low-quality ones have an extra copy; one
    source has its vectors turned around, another one shifted; one label has
    another language.
    """
    labels = table(spark, sf, "labels")
    rows = embedded_documents(spark, sf)
    rows = rows.join(labels, rows.vec_id == labels.doc_id, "left")
    drifted = (F.when(F.col("source") == "src7", F.transform("vector", lambda x: -x))
               .when(F.col("source") == "src3", F.transform("vector", lambda x, i: F.when(
                   i == 0, (x.cast("double") + 0.5).cast("float")).otherwise(x)))
               .otherwise(F.col("vector")))
    rows = rows.withColumn("vector", drifted).withColumn(
        "lang", F.when((F.col("label") == 9) & F.col("lang").isNotNull(), "xx").otherwise(F.col("lang")))
    kept = rows.filter(F.coalesce("toxic", F.lit(0)) != 1)
    extra = rows.filter(F.coalesce("quality", F.lit(1)) == 0).withColumn("id", F.concat(F.lit("x"), "id"))
    return records_from(kept.unionByName(extra), "id", "vector", ["lang", "source", "n_chars", "label", "text"])


TGT_SQL = """drift AS (
  SELECT id, CASE WHEN source = 'src7' THEN list_transform(vec, lambda x: -x)
                  WHEN source = 'src3' THEN list_transform(vec, lambda x, i: CASE WHEN i = 1
                       THEN CAST(CAST(x AS DOUBLE) + 0.5 AS FLOAT) ELSE x END)
                  ELSE vec END AS vec,
         label, CASE WHEN label = 9 AND lang IS NOT NULL THEN 'xx' ELSE lang END AS lang, source, n_chars, text,
         coalesce(quality, 1) AS quality, coalesce(toxic, 0) AS toxic
  FROM src LEFT JOIN labels ON vec_id = labels.doc_id),
tgt AS (
  SELECT id, vec, label, lang, source, n_chars, text FROM drift WHERE toxic <> 1
  UNION ALL SELECT 'x' || id, vec, label, lang, source, n_chars, text FROM drift WHERE quality = 0)"""

COSINE_SQL = """CASE WHEN len(a) = len(b) THEN
  list_inner_product(CAST(a AS DOUBLE[]), CAST(b AS DOUBLE[]))
  / nullif(sqrt(list_inner_product(CAST(a AS DOUBLE[]), CAST(a AS DOUBLE[])))
         * sqrt(list_inner_product(CAST(b AS DOUBLE[]), CAST(b AS DOUBLE[]))), 0) END"""


def document_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its whole text as metadata; the vector where there is one."""
    d, e = table(spark, sf, "documents"), table(spark, sf, "embeddings")
    rows = spread(d).join(e, d.doc_id == e.vec_id, "left").withColumn("id", id_text("doc_id")).withColumn(
        "n_chars", F.col("n_chars").cast("double"))
    return records_from(rows, "id", "embedding", ["lang", "source", "n_chars", "text"])


def event_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a record with nested metadata, an array and a two-dimensional vector."""
    ev = spread(table(spark, sf, "events")).withColumn("id", id_text("event_id"))
    k = F.get_json_object("props", "$.k").cast("int")
    return records_from(ev, "id", F.array(F.col("value"), k.cast("double")), {
        "evt": F.struct(F.col("event_type").alias("type"), F.col("value").alias("value")),
        "k": k, "tags": F.array("event_type", F.col("user_id").cast("string")),
        "score": F.floor("value").cast("double")})


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """One query vector per label: the mean of its embeddings."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    e = table(spark, sf, "embeddings")
    means = e.groupBy("label").agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))).alias("m"))
    return means.select(F.col("label").cast("string").alias("query_id"), vector_to_array("m").alias("vector"))


CENTROID_SQL = """cent AS (
  SELECT CAST(label AS VARCHAR) AS query_id, list(a ORDER BY pos) AS q FROM (
    SELECT label, pos, avg(CAST(x AS DOUBLE)) AS a
    FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos)
  GROUP BY label)"""


# -- migration states ------------------------------------------------------
def state_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as state changes of one migration per user."""
    state = (F.when(F.col("event_type") == "signup", "not_started").when(F.col("event_type") == "view", "in_progress")
             .when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed")
             .otherwise("rolled_back"))
    return table(spark, sf, "events").select(
        F.concat(F.lit("mig-"), F.col("user_id").cast("string")).alias("migration_id"), F.col("event_id").alias("seq"),
        state.alias("state"), F.lit(None).cast("string").alias("reason"), "ts")


STATE_EVENTS_SQL = """state_events AS (
  SELECT 'mig-' || user_id AS migration_id, event_id AS seq, ts,
         CASE event_type WHEN 'signup' THEN 'not_started' WHEN 'view' THEN 'in_progress'
              WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'rolled_back' END AS state
  FROM events)"""


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a migration with one state."""
    state = (F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "in_progress")
             .otherwise("failed"))
    return table(spark, sf, "orders").select(
        id_text("o_orderkey").alias("migration_id"), F.lit(1).cast("bigint").alias("seq"), state.alias("state"),
        F.lit(None).cast("string").alias("reason"), F.col("o_orderdate").alias("ts"))


ORDER_EVENTS_SQL = """order_events AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS migration_id, o_orderdate AS ts,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'failed' END AS state
  FROM orders)"""


def order_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item as a checkpoint of its order; ``seq`` packs ship date, line and part."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seq = (days * 10 + F.col("l_linenumber")) * 100000000 + F.col("l_partkey")
    rows = li.join(o, li.l_orderkey == o.o_orderkey)
    return rows.select(
        id_text("l_orderkey").alias("migration_id"), seq.alias("seq"),
        F.col("l_linenumber").cast("bigint").alias("batch_no"), id_text("l_partkey").alias("last_processed_id"),
        F.lit(50).cast("bigint").alias("total_records"), F.col("l_quantity").cast("bigint").alias("processed_count"),
        F.floor(F.col("l_tax") * 100 + 0.5).cast("bigint").alias("failed_count"), F.col("o_orderdate").alias("started_at"),
        F.col("l_shipdate").alias("checkpoint_at"), F.lit(False).alias("deleted"))


ORDER_CHECKPOINTS_SQL = """order_checkpoints AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS migration_id,
         (date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 10 + l_linenumber) * 100000000 + l_partkey AS seq,
         CAST(l_linenumber AS BIGINT) AS batch_no, lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS last_processed_id,
         50 AS total_records, CAST(l_quantity AS BIGINT) AS processed_count,
         CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS failed_count, o_orderdate AS started_at, l_shipdate AS checkpoint_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LATEST_CHECKPOINT_SQL = """latest AS (
  SELECT * FROM order_checkpoints
  QUALIFY row_number() OVER (PARTITION BY migration_id ORDER BY seq DESC) = 1)"""


# -- request log -----------------------------------------------------------
def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "ts", F.concat(F.lit("key-"), F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("api_key"),
        F.col("event_type").alias("tool"), F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"), "user_id", "props")


AUDIT_SQL = """audit AS (
  SELECT event_id, ts, 'key-' || user_id || '-' || event_type AS api_key, event_type AS tool, value AS duration_ms,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, user_id, props FROM events)"""


def deep_records(spark, sf):
    """Events with objects nested in six levels."""
    inner = F.struct(F.struct(F.struct(F.col("user_id").alias("f")).alias("e")).alias("d")).alias("c")
    return table(spark, sf, "events").select(id_text("event_id").alias("id"), F.array(F.col("value").cast("float")).alias("vector"), F.to_variant_object(
        F.struct(F.struct(F.struct(inner, F.col("event_type").alias("type")).alias("b")).alias("a"))).alias("metadata"))
