"""Sources, batches and record transforms on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.vectors import dense_to_sparse, sparse_to_dense
from embedlift.model import PROFILES
from embedlift.operators import transform as T
from embedlift.operators.filters import check_target_constraints, payload_filter
from embedlift.operators.transform import FieldRule, Mapping
from embedlift.queries import query
from embedlift.queries.tables import (deep_records, SRC_SQL, document_records, event_records, id_text, source_records, table)
from embedlift.sources.batches import assign_batches, get_batch, resume_filter
from embedlift.sources.checks import check_source
from embedlift.sources.records import records_from, records_with_rejects
from embedlift.workspace import write_once

DOC_ID = "lpad(CAST(doc_id AS VARCHAR), 10, '0')"
EVENT_ID = "lpad(CAST(event_id AS VARCHAR), 10, '0')"


def meta(name, as_type="string"):
    return V.field(F.col("metadata"), name, as_type)


@query("records_from_documents", f"""
WITH {SRC_SQL}
SELECT id, lang, source, CAST(n_chars AS BIGINT) AS n_chars, label, length(text) AS text_length, len(vec) AS dims FROM src""")
def records_from_documents(spark, sf):
    return source_records(spark, sf).select(
        "id", meta("lang").alias("lang"), meta("source").alias("source"), meta("n_chars", "bigint").alias("n_chars"),
        meta("label", "int").alias("label"), F.length(meta("text")).alias("text_length"), F.size("vector").alias("dims"))


@query("records_from_pages", """
SELECT CAST(page_id AS VARCHAR) AS id, url, length(html) AS content_length, md5(html) AS content_md5 FROM pages""")
def records_from_pages(spark, sf):
    pages = table(spark, sf, "pages")
    rows = records_from(pages, "page_id", F.array(F.length("html").cast("float")), {"url": F.col("url"), "content": F.col("html")})
    return rows.select("id", meta("url").alias("url"), F.length(meta("content")).alias("content_length"),
                       F.md5(meta("content")).alias("content_md5"))


@query("json_rejects", """
SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS record_id, 'metadata' AS field, 'metadata is not valid JSON' AS message
FROM conversations WHERE role <> 'user'""")
def json_rejects(spark, sf):
    talk = table(spark, sf, "conversations")
    text = F.when(F.col("role") == "user", F.to_json(F.struct("role", "text"))).otherwise(F.concat(F.lit("{"), F.col("text")))
    rows = talk.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
                       text.alias("metadata"))
    return records_with_rejects(rows)[1]


@query("get_batch_page", f"""
WITH {SRC_SQL} SELECT id, label, lang FROM src WHERE id > '0000000123' ORDER BY id LIMIT 100""")
def get_batch_page(spark, sf):
    return get_batch(source_records(spark, sf), "0000000123", 100).select(
        "id", meta("label", "int").alias("label"), meta("lang").alias("lang"))


@query("assign_batches", f"""
SELECT {DOC_ID} AS id, (row_number() OVER (ORDER BY {DOC_ID}) - 1) // 100 AS batch_no FROM documents""")
def assign_batches_of_documents(spark, sf):
    docs = table(spark, sf, "documents").select(id_text("doc_id").alias("id"))
    return assign_batches(docs, 100).select("id", "batch_no")


@query("resume_filter", f"""
SELECT {DOC_ID} AS id, n_chars FROM documents WHERE doc_id > (SELECT max(vec_id) FROM embeddings)""")
def resume_after_embeddings(spark, sf):
    last = table(spark, sf, "embeddings").agg(F.max(id_text("vec_id"))).first()[0]
    docs = table(spark, sf, "documents").select(id_text("doc_id").alias("id"), "n_chars")
    return resume_filter(docs, last)


@query("check_source", """
WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, 2 AS dim FROM lineitem)
SELECT count(*) AS total_records, 0 AS missing_ids,
       (SELECT count(*) FROM (SELECT id FROM r GROUP BY id HAVING count(*) > 1)) AS repeated_ids,
       0 AS null_vectors, min(dim) AS min_dim, max(dim) AS max_dim, false AS ok FROM r""")
def check_lineitem_source(spark, sf):
    rows = records_from(table(spark, sf, "lineitem"), "l_orderkey", F.array("l_quantity", "l_tax"), ["l_returnflag"])
    return check_source(rows, "qdrant")


@query("map_records", f"""
SELECT {DOC_ID} AS id, lang AS language, source AS origin, n_chars AS chars, 'BIGINT' AS chars_type, 'untitled' AS title,
       md5(text) AS content_md5, 5 AS n_fields FROM documents""")
def map_documents(spark, sf):
    mapping = Mapping("pinecone", "qdrant", (
        FieldRule("lang", "language"), FieldRule("source", "origin"), FieldRule("n_chars", "chars", "auto_number"),
        FieldRule("text", "content"), FieldRule("title", "title", None, '"untitled"'), FieldRule("absent", "absent")))
    mapped = T.map_records(document_records(spark, sf), mapping)
    return mapped.select(
        "id", meta("language").alias("language"), meta("origin").alias("origin"), meta("chars", "bigint").alias("chars"),
        V.kind(meta("chars", "variant")).alias("chars_type"), meta("title").alias("title"),
        F.md5(meta("content")).alias("content_md5"), F.size(V.as_map(F.col("metadata"))).alias("n_fields"))


def _coded_documents(spark, sf):
    docs = table(spark, sf, "documents")
    code = F.when(F.col("lang") == "fr", F.col("source")).otherwise(F.expr("substring(source, 4)"))
    return records_from(docs.withColumn("id", id_text("doc_id")).withColumn("code", code), "id",
                        F.array(F.col("n_chars").cast("float")), ["code", "lang"])


_CODE = Mapping("qdrant", "milvus", (FieldRule("code", "code", "to_int"), FieldRule("lang", "lang")))


@query("apply_conversions", f"""
SELECT {DOC_ID} AS id, CAST(substring(source, 4) AS BIGINT) AS code, lang FROM documents WHERE lang <> 'fr'""")
def convert_codes(spark, sf):
    return T.map_records(_coded_documents(spark, sf), _CODE, on_error="drop").select(
        "id", meta("code", "bigint").alias("code"), meta("lang").alias("lang"))


@query("conversion_rejects", f"""
SELECT {DOC_ID} AS record_id, 'code' AS field, 'failed to convert field code' AS message FROM documents WHERE lang = 'fr'""")
def convert_rejects(spark, sf):
    return T.rejected_records(_coded_documents(spark, sf), _CODE)


@query("default_values", f"""
SELECT {DOC_ID.replace('doc_id', 'd.doc_id')} AS id, coalesce(quality, -1) AS quality, lang
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def default_quality(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = docs.join(labels, "doc_id", "left").withColumn("id", id_text("doc_id"))
    fields = F.map_filter(F.create_map(F.lit("lang"), F.col("lang").cast("variant"), F.lit("quality"),
                                       F.col("quality").cast("variant")), lambda _, v: v.isNotNull())
    given = rows.select("id", F.array(F.col("n_chars").cast("float")).alias("vector"), V.to_object(fields).alias("metadata"))
    return T.default_values(given, {"quality": "-1", "lang": '"unknown"'}).select(
        "id", meta("quality", "int").alias("quality"), meta("lang").alias("lang"))


@query("narrow_numbers", f"""
SELECT {EVENT_ID} AS id, CASE WHEN value = floor(value) THEN 'BIGINT' ELSE 'DOUBLE' END AS value_type,
       'BIGINT' AS floor_type, CAST(floor(value) AS BIGINT) AS floor_value, 'STRING' AS text_type FROM events""")
def narrow_event_numbers(spark, sf):
    rows = records_from(table(spark, sf, "events").withColumn("id", id_text("event_id")), "id", F.array("value"),
                        {"value": F.col("value"), "low": F.floor("value").cast("double"), "kind": F.col("event_type")})
    got = T.narrow_numbers(rows)
    return got.select("id", V.kind(meta("value", "variant")).alias("value_type"), V.kind(meta("low", "variant")).alias("floor_type"),
                      meta("low", "bigint").alias("floor_value"), V.kind(meta("kind", "variant")).alias("text_type"))


@query("flatten_metadata", f"""
SELECT {EVENT_ID} AS id, event_type AS evt_type, round(value, 2) AS evt_value, CAST(props->>'k' AS INTEGER) AS k,
       'evt.type,evt.value,k,score,tags' AS field_names FROM events""")
def flatten_events(spark, sf):
    flat = T.flatten_metadata(event_records(spark, sf), ".")
    return flat.select("id", meta("evt.type").alias("evt_type"), F.round(meta("evt.value", "double"), 2).alias("evt_value"),
                       meta("k", "int").alias("k"), _names())


def _names():
    return F.array_join(F.array_sort(F.map_keys(V.as_map(F.col("metadata")))), ",").alias("field_names")


@query("flatten_deep", f"""
SELECT {DOC_ID} AS id, lang AS origin_text_lang, source AS origin_source, n_chars AS n_chars,
       'n_chars,origin_source,origin_text_chars_n,origin_text_lang' AS field_names FROM documents""")
def flatten_deep(spark, sf):
    rows = records_from(table(spark, sf, "documents").withColumn("id", id_text("doc_id")), "id",
                        F.array(F.col("n_chars").cast("float")), {
        "origin": F.struct(F.struct("lang", F.struct(F.col("n_chars").alias("n")).alias("chars")).alias("text"), "source"),
        "n_chars": F.col("n_chars")})
    flat = T.flatten_metadata(rows, "_", 3)
    return flat.select("id", meta("origin_text_lang").alias("origin_text_lang"), meta("origin_source").alias("origin_source"),
                       meta("origin_text_chars_n", "bigint").alias("n_chars"), _names())


@query("unflatten_metadata", f"""
SELECT {EVENT_ID} AS id, event_type AS evt_type, round(value, 2) AS evt_value, 'evt,k,score,tags' AS field_names FROM events""")
def unflatten_events(spark, sf):
    nested = T.unflatten_metadata(T.flatten_metadata(event_records(spark, sf), "."), ".")
    return nested.select("id", F.try_variant_get("metadata", "$.evt.type", "string").alias("evt_type"),
                         F.round(F.try_variant_get("metadata", "$.evt.value", "double"), 2).alias("evt_value"), _names())


@query("arrays_to_json", f"""
SELECT {EVENT_ID} AS id, '["' || event_type || '","' || user_id || '"]' AS tags FROM events""")
def arrays_as_text(spark, sf):
    return T.arrays_to_json(event_records(spark, sf)).select("id", meta("tags").alias("tags"))


@query("derive_uuid", f"""
WITH h AS (SELECT {DOC_ID} AS source_id, sha256({DOC_ID}) AS h FROM documents)
SELECT source_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
       || substr(h, 21, 12) AS id FROM h""")
def uuid_ids(spark, sf):
    once = T.derive_uuid(document_records(spark, sf))
    return once.select("source_id", V.derive_uuid(F.col("id")).alias("id"))


@query("map_namespace", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS tenant, round(c_acctbal, 2) AS balance FROM customer""")
def namespace_as_payload(spark, sf):
    rows = records_from(table(spark, sf, "customer").withColumn("namespace", F.col("c_mktsegment")), "c_custkey",
                        F.array("c_acctbal"), {"balance": F.col("c_acctbal"), "tenant": F.lit("old")}, keep=("namespace",))
    return T.map_namespace(rows, "payload", "tenant").select(
        "id", meta("tenant").alias("tenant"), F.round(meta("balance", "double"), 2).alias("balance"))


@query("coerce_types", f"""
SELECT {EVENT_ID} AS id, 'DOUBLE' AS k_type, CAST(props->>'k' AS DOUBLE) AS k, 'ARRAY<STRING>' AS pair_type,
       '["' || (props->>'k') || '","' || user_id || '"]' AS pair FROM events""")
def coerce_for_pinecone(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = records_from(table(spark, sf, "events").withColumn("id", id_text("event_id")), "id", F.array("value"),
                        {"k": k, "pair": F.array(k, F.col("user_id"))})
    got = T.coerce_types(rows, "pinecone")
    return got.select("id", V.kind(meta("k", "variant")).alias("k_type"), meta("k", "double").alias("k"),
                      F.schema_of_variant(meta("pair", "variant")).alias("pair_type"),
                      F.to_json(meta("pair", "variant")).alias("pair"))


@query("cast_vectors", """
SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_quantity AS BIGINT) AS first, 0 AS second,
       CAST(round(l_tax * 100) AS BIGINT) AS third_percent FROM lineitem""")
def cast_text_vectors(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = li.select(F.col("l_orderkey").cast("string").alias("id"), F.array(
        F.col("l_quantity").cast("string"), F.col("l_returnflag"), F.col("l_tax").cast("string")).alias("vector"))
    got = T.cast_vectors(rows)
    return got.select("id", F.col("vector")[0].cast("bigint").alias("first"), F.col("vector")[1].cast("bigint").alias("second"),
                      F.round(F.col("vector")[2] * 100).cast("bigint").alias("third_percent"))


@query("sparse_round_trip", """
SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n_values,
       round(list_sum(list_transform(list_filter(embedding, lambda x: x > 0), lambda x: CAST(x AS DOUBLE))), 5) AS total,
       true AS same FROM embeddings""")
def sparse_and_back(spark, sf):
    e = table(spark, sf, "embeddings")
    positive = F.transform("embedding", lambda x: F.when(x > 0, x).otherwise(F.lit(0.0).cast("float")))
    rows = e.select("vec_id", positive.alias("v"), dense_to_sparse(positive).alias("s"), F.size("embedding").alias("d"))
    back = rows.withColumn("b", sparse_to_dense(F.col("s"), 64))
    total = F.aggregate("s.values", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return back.select("vec_id", F.size("s.indices").alias("n_values"), F.round(total, 5).alias("total"),
                       (F.col("b") == F.col("v")).alias("same"))


def _shapes_sql() -> str:
    parts = []
    for src in PROFILES:
        for dst in PROFILES:
            if src == dst:
                continue
            if (src, dst) == ("pinecone", "qdrant"):
                names = "evt.type,evt.value,k,score,tags"
            elif dst == "pinecone":
                names = "evt_type,evt_value,k,score,tags"
            else:
                names = "evt,k,score,tags"
            tags = "STRING" if dst == "milvus" else "ARRAY"
            score = "BIGINT" if src == "pinecone" else "DOUBLE"
            k_type = "DOUBLE" if dst == "pinecone" else "BIGINT"
            length = 36 if dst == "weaviate" else 10
            parts.append(f"SELECT '{src}' AS source_type, '{dst}' AS target_type, {EVENT_ID} AS source_id, {length} AS id_length, "
                         f"'{names}' AS field_names, '{tags}' AS tags_type, '{score}' AS score_type, '{k_type}' AS k_type FROM events")
    return "\nUNION ALL ".join(parts)


@query("migrate_records", _shapes_sql())
def migrate_all_paths(spark, sf):
    rows = write_once(event_records(spark, sf), "all-paths")   # built once, not for every pair
    depth = max(1, V.nesting(rows))   # the same records for every pair, so their levels are counted once
    found = None
    for src in PROFILES:
        for dst in PROFILES:
            if src == dst:
                continue
            got = T.migrate_records(rows, Mapping.identity(src, dst, ["evt", "k", "tags", "score"]), depth=depth)
            origin = F.col("source_id") if "source_id" in got.columns else F.col("id")
            part = got.select(
                F.lit(src).alias("source_type"), F.lit(dst).alias("target_type"), origin.alias("source_id"),
                F.length("id").alias("id_length"), _names(), V.kind(meta("tags", "variant")).alias("tags_type"),
                V.kind(meta("score", "variant")).alias("score_type"), V.kind(meta("k", "variant")).alias("k_type"))
            found = part if found is None else found.unionByName(part)
    return found


@query("check_target_constraints", f"""
SELECT {EVENT_ID} AS record_id, 'evt' AS field, 'nested object is not allowed' AS message FROM events
UNION ALL SELECT {DOC_ID}, 'metadata', 'metadata exceeds 40960 bytes' FROM documents
WHERE strlen(CAST(to_json({{'body': text}}) AS VARCHAR)) > 40960
UNION ALL SELECT {DOC_ID}, 'vector', 'vector is empty' FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def constraint_violations(spark, sf):
    d, e = table(spark, sf, "documents"), table(spark, sf, "embeddings")
    docs = records_from(d.join(e, d.doc_id == e.vec_id, "left").withColumn("id", id_text("doc_id")), "id", "embedding",
                        {"body": d.text})
    return check_target_constraints(event_records(spark, sf), "pinecone").unionByName(
        check_target_constraints(docs, "pinecone"))


@query("payload_filter", f"""
SELECT {DOC_ID} AS id, lang, source FROM documents
WHERE lang IN ('en', 'de') AND n_chars BETWEEN 500 AND 3000 AND contains(source, 'src1')""")
def filter_documents(spark, sf):
    got = payload_filter(document_records(spark, sf), [
        ("lang", "in", ["en", "de"]), ("n_chars", "range", (500.0, 3000.0)), ("source", "contains", "src1")])
    return got.select("id", meta("lang").alias("lang"), meta("source").alias("source"))


@query("migrate_deep_objects", f"""
SELECT {EVENT_ID} AS id, 'a_b_c_d_e_f,a_b_type' AS field_names, user_id AS deepest, event_type AS evt_type FROM events""")
def migrate_deep(spark, sf):
    """A target without objects gets every level as one flat name."""
    got = T.migrate_records(deep_records(spark, sf), T.Mapping("qdrant", "pinecone", (T.FieldRule("a", "a"),)))
    return got.select("id", F.array_join(F.array_sort(F.map_keys(V.as_map(F.col("metadata")))), ",").alias("field_names"),
                      meta("a_b_c_d_e_f", "bigint").alias("deepest"), meta("a_b_type").alias("evt_type"))
