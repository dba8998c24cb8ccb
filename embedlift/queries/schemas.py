"""Mapping, inference and recommendations on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.model import PROFILES, TYPE_MATRIX, profiles_frame
from embedlift.operators import mapping as M
from embedlift.operators.filters import skip_fields
from embedlift.queries import query
from embedlift.queries.tables import deep_records, document_records, event_records, table


def _source_fields(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_nationkey").cast("string").alias("collection"), F.col("c_mktsegment").alias("field"),
                    F.lit("string").alias("type"))


def _target_fields(spark, sf):
    c = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    name = F.when(F.col("c_nationkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    return c.select(F.col("c_nationkey").cast("string").alias("collection"), name.alias("field"), F.lit("string").alias("type"))


_FIELDS_SQL = """s AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS collection, c_mktsegment AS field FROM customer),
t AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS collection,
             CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS field
      FROM customer WHERE c_acctbal > 0)"""
_MAPPING_SQL = f"""{_FIELDS_SQL},
mapping AS (
  SELECT s.collection, s.field AS source_field, t.field AS target_field,
         CASE WHEN t.field IS NULL THEN 'unmatched' WHEN t.field = s.field THEN 'exact' ELSE 'case' END AS match_kind
  FROM s LEFT JOIN t ON s.collection = t.collection AND lower(s.field) = lower(t.field)
  QUALIFY row_number() OVER (PARTITION BY s.collection, s.field ORDER BY t.field <> s.field, t.field) = 1)"""


@query("create_mapping", f"WITH {_MAPPING_SQL} SELECT * FROM mapping")
def map_segments(spark, sf):
    return M.create_mapping(_source_fields(spark, sf), _target_fields(spark, sf))


@query("create_mapping_fuzzy", """
WITH s AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS collection, p_name AS field FROM part),
t AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS collection, replace(p_name, ' ', '_') || 's' AS field FROM part WHERE p_retailprice > 950),
near AS (
  SELECT s.collection, s.field AS source_field, t.field AS target_field,
         levenshtein(lower(replace(replace(s.field, '_', ''), '-', '')), lower(replace(replace(t.field, '_', ''), '-', ''))) AS d
  FROM s JOIN t ON s.collection = t.collection)
SELECT s.collection, s.field AS source_field, n.target_field,
       CASE WHEN n.target_field IS NULL THEN 'unmatched' ELSE 'fuzzy' END AS match_kind
FROM s LEFT JOIN (SELECT * FROM near WHERE d <= 2
                  QUALIFY row_number() OVER (PARTITION BY collection, source_field ORDER BY d, target_field) = 1) n
  ON s.collection = n.collection AND s.field = n.source_field""")
def map_part_names(spark, sf):
    p = table(spark, sf, "part")
    source = p.select(F.col("p_size").cast("string").alias("collection"), F.col("p_name").alias("field"))
    target = p.filter(F.col("p_retailprice") > 950).select(
        F.col("p_size").cast("string").alias("collection"), F.concat(F.translate("p_name", " ", "_"), F.lit("s")).alias("field"))
    return M.create_mapping(source, target, fuzzy_distance=2)


@query("attach_conversions", f"""WITH {_MAPPING_SQL}
SELECT collection, source_field, target_field, match_kind, CASE WHEN target_field IS NOT NULL THEN 'float64' END AS from_type,
       CASE WHEN target_field IS NOT NULL THEN 'auto' END AS to_type,
       CASE WHEN target_field IS NOT NULL THEN 'auto_number' END AS converter FROM mapping""")
def convert_segments(spark, sf):
    mapping = M.create_mapping(_source_fields(spark, sf), _target_fields(spark, sf))
    return M.attach_conversions(mapping, "pinecone", "qdrant")


@query("skip_fields", """
SELECT CAST(p_partkey AS VARCHAR) AS collection, p_type AS field FROM part WHERE p_type <> 'ECONOMY'""")
def skip_reserved(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("collection"), F.when(
        F.col("p_type") == "ECONOMY", F.when(F.col("p_size") > 20, "id").otherwise("vector")).otherwise(F.col("p_type")).alias("field"))
    return skip_fields(p)


# Order priorities and market segments stand for store types, some of them wrong or missing.
_SOURCE = [("AUTOMOBILE", "pinecone"), ("BUILDING", "qdrant"), ("FURNITURE", "weaviate"), ("HOUSEHOLD", "milvus")]
_TARGET = [("1-URGENT", "pinecone"), ("2-HIGH", "qdrant"), ("3-MEDIUM", "weaviate"), ("5-LOW", "redis")]


def _requests(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")

    def pick(column, cases, other):
        out = None
        for value, name in cases:
            out = F.when(F.col(column) == value, name) if out is None else out.when(F.col(column) == value, name)
        return out.otherwise(F.lit(other))

    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("request_id"), pick("c_mktsegment", _SOURCE, "").alias("source_type"),
        pick("o_orderpriority", _TARGET, None).alias("target_type"))


def _case(column, cases, other):
    whens = " ".join(f"WHEN '{value}' THEN '{name}'" for value, name in cases)
    return f"CASE {column} {whens} ELSE {other} END"


_REQUESTS_SQL = f"""requests AS (
  SELECT o_orderkey AS request_id, {_case('c_mktsegment', _SOURCE, "''")} AS source_type,
         {_case('o_orderpriority', _TARGET, 'NULL')} AS target_type
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
_KNOWN = ", ".join(f"'{name}'" for name in PROFILES)


@query("validate_mapping", f"""WITH {_REQUESTS_SQL}
SELECT request_id, source_type, target_type,
       CASE WHEN coalesce(source_type, '') = '' THEN 'source database type must be specified'
            WHEN coalesce(target_type, '') = '' THEN 'target database type must be specified'
            WHEN source_type = target_type THEN 'source and target databases must be different'
            WHEN source_type NOT IN ({_KNOWN}) THEN 'invalid source database type: ' || source_type
            WHEN target_type NOT IN ({_KNOWN}) THEN 'invalid target database type: ' || target_type END AS error FROM requests""")
def validate_requests(spark, sf):
    return M.validate_mapping(_requests(spark, sf))


_PATHS_SQL = """paths AS (SELECT * FROM (VALUES
  ('pinecone', 'qdrant', 0.9, ['Pinecone flat metadata will be flattened in Qdrant with dot notation']),
  ('pinecone', 'weaviate', 0.85, ['Weaviate requires schema definition before upsert',
   'Nested metadata not supported in Pinecone, but supported in Weaviate']),
  ('qdrant', 'pinecone', 0.85, ['Qdrant nested payloads must be flattened for Pinecone',
   'Use dot notation: author.name → author_name']),
  ('weaviate', 'pinecone', 0.8, ['Weaviate typed properties will become untyped in Pinecone', 'Type information will be lost'])
  ) p(source_type, target_type, confidence, warnings)),
rated AS (
  SELECT request_id, r.source_type, r.target_type, CAST(coalesce(confidence, 0.75) AS DOUBLE) AS overall_confidence,
         coalesce(warnings, ['Generic migration path - review mappings carefully']) AS warnings
  FROM requests r LEFT JOIN paths p ON r.source_type = p.source_type AND r.target_type = p.target_type)"""


@query("path_confidence", f"""WITH {_REQUESTS_SQL}, {_PATHS_SQL}
SELECT request_id, source_type, target_type, overall_confidence, len(warnings) AS n_warnings FROM rated""")
def rate_paths(spark, sf):
    return M.path_confidence(_requests(spark, sf)).select(
        "request_id", "source_type", "target_type", "overall_confidence", F.size("warnings").cast("bigint").alias("n_warnings"))


@query("path_warnings", f"""WITH {_REQUESTS_SQL}, {_PATHS_SQL}
SELECT request_id, source_type, target_type, generate_subscripts(warnings, 1) AS position, unnest(warnings) AS warning FROM rated""")
def warn_paths(spark, sf):
    return M.path_warnings(_requests(spark, sf))


@query("recommend_schema", f"""WITH {_REQUESTS_SQL},
valid AS (SELECT request_id FROM requests WHERE coalesce(source_type, '') <> '' AND coalesce(target_type, '') <> '' AND source_type <> target_type),
fields AS (SELECT DISTINCT l_orderkey AS request_id, CASE WHEN l_linestatus = 'O' THEN 'title' ELSE 'flag_' || l_returnflag END AS field FROM lineitem),
common AS (SELECT * FROM (VALUES ('id', 1.0, 'Primary identifier, direct mapping'), ('title', 0.95, 'Common metadata field'),
  ('url', 0.95, 'URL reference field'), ('content', 0.9, 'Main content field')) c(source_field, confidence, notes)),
rows AS (
  SELECT request_id, source_field, CAST(confidence AS DOUBLE) AS confidence, notes FROM valid, common
  UNION ALL SELECT request_id, field, 0.7, 'Auto-mapped by name - verify type compatibility' FROM fields
  WHERE request_id IN (SELECT request_id FROM valid) AND field NOT IN (SELECT source_field FROM common))
SELECT request_id, source_field, confidence, notes, source_field AS target_field, false AS conversion_needed FROM rows""")
def recommend(spark, sf):
    fields = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("request_id"), F.when(
        F.col("l_linestatus") == "O", "title").otherwise(F.concat(F.lit("flag_"), "l_returnflag")).alias("field"))
    return M.recommend_schema(_requests(spark, sf), fields)


@query("infer_schema", """
SELECT 'evt' AS path, 'object' AS type, count(*) AS n_values FROM events
UNION ALL SELECT 'evt.type', 'string', count(*) FROM events
UNION ALL SELECT 'evt.value', 'float', count(*) FROM events
UNION ALL SELECT 'k', 'int', count(*) FROM events WHERE props->>'k' IS NOT NULL
UNION ALL SELECT 'score', 'float', count(*) FROM events
UNION ALL SELECT 'tags', 'string[]', count(*) FROM events""")
def infer_events(spark, sf):
    return M.infer_schema(event_records(spark, sf))


@query("infer_schema_deep", """
SELECT 'a' AS path, 'object' AS type, count(*) AS n_values FROM events UNION ALL SELECT 'a.b', 'object', count(*) FROM events
UNION ALL SELECT 'a.b.c', 'object', count(*) FROM events UNION ALL SELECT 'a.b.c.d', 'object', count(*) FROM events
UNION ALL SELECT 'a.b.c.d.e', 'object', count(*) FROM events UNION ALL SELECT 'a.b.c.d.e.f', 'int', count(*) FROM events
UNION ALL SELECT 'a.b.type', 'string', count(*) FROM events""")
def infer_deep(spark, sf):
    """Fields down to the sixth level are all reported."""
    return M.infer_schema(deep_records(spark, sf))


@query("infer_schema_sampled", f"""
WITH s AS (SELECT * FROM documents WHERE ('0x' || substr(md5(lpad(CAST(doc_id AS VARCHAR), 10, '0')), 1, 15))::BIGINT < {int(0.2 * (1 << 60))})
SELECT 'lang' AS path, 'string' AS type, count(*) AS n_values FROM s UNION ALL SELECT 'source', 'string', count(*) FROM s
UNION ALL SELECT 'n_chars', 'float', count(*) FROM s UNION ALL SELECT 'text', 'string', count(*) FROM s""")
def infer_document_sample(spark, sf):
    return M.infer_schema(document_records(spark, sf), sample_rate=0.2)


@query("field_profile", """
WITH r AS (SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'lang' AS path, 'string' AS type, 1 AS n_types, count(lang) AS n_filled, 0 AS n_null, count(*) AS n_records,
       round(count(lang) / count(*), 6) AS fill_ratio FROM r
UNION ALL SELECT 'quality', 'int', 1, count(quality), count(*) - count(quality), count(*), round(count(quality) / count(*), 6) FROM r""")
def profile_documents(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"), F.to_variant_object(F.struct("lang", "quality")).alias("metadata"))
    found = M.field_profile(M.infer_schema(rows), rows.agg(F.count(F.lit(1)).alias("n_records")))
    return found.withColumn("fill_ratio", F.round("fill_ratio", 6))


_LOGICAL = [("AUTOMOBILE", "string"), ("BUILDING", "int"), ("FURNITURE", "float"), ("HOUSEHOLD", "string[]")]


def _typed_fields(spark, sf):
    kind = None
    for segment, logical in _LOGICAL:
        kind = F.when(F.col("c_mktsegment") == segment, logical) if kind is None else kind.when(F.col("c_mktsegment") == segment, logical)
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("collection"),
                    F.lower("c_mktsegment").alias("field"), kind.otherwise("date").alias("type"))


_TYPED_SQL = f"""typed AS (SELECT DISTINCT 'nation_' || c_nationkey AS collection, lower(c_mktsegment) AS field,
  {_case('c_mktsegment', _LOGICAL, "'date'")} AS type FROM customer)"""


@query("target_field_types", f"""WITH {_TYPED_SQL}, matrix AS (SELECT * FROM (VALUES
  {', '.join(f"('{r[0]}', '{r[4]}')" for r in TYPE_MATRIX)}) m(type, target_type))
SELECT collection, field, type, target_type FROM typed JOIN matrix USING (type)""")
def milvus_types(spark, sf):
    return M.target_fields(_typed_fields(spark, sf).distinct(), "milvus")


@query("generate_target_schema", f"""WITH {_TYPED_SQL}, matrix AS (SELECT * FROM (VALUES
  {', '.join(f"('{r[0]}', '{r[3]}')" for r in TYPE_MATRIX)}) m(type, target_type))
SELECT collection, '{{"class":"' || collection || '","properties":[' || string_agg(
  '{{"name":"' || field || '","dataType":["' || target_type || '"]}}', ',' ORDER BY field, target_type) || ']}}' AS definition
FROM typed JOIN matrix USING (type) GROUP BY collection""")
def weaviate_classes(spark, sf):
    return M.generate_target_schema(_typed_fields(spark, sf), "weaviate")


@query("map_index_config", """
WITH c AS (SELECT CAST(s_suppkey AS VARCHAR) AS collection, s_nationkey % 3 AS kind, s_nationkey FROM supplier)
SELECT collection, CASE WHEN kind = 2 THEN 'max_connections' ELSE 'metric' END AS concept,
       CASE WHEN kind = 2 THEN 'maxConnections' ELSE 'metric' END AS name,
       CASE kind WHEN 0 THEN 'l2-squared' WHEN 1 THEN 'hamming' ELSE CAST(s_nationkey AS VARCHAR) END AS source_value,
       CASE kind WHEN 2 THEN 'M' ELSE 'metric' END AS target_name,
       CASE kind WHEN 0 THEN 'L2' WHEN 1 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS target_value,
       CASE WHEN kind = 1 THEN 'no counterpart in milvus for metric hamming' END AS warning FROM c""")
def index_settings(spark, sf):
    kind = F.col("s_nationkey") % 3
    catalog = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("collection"), F.lit("weaviate").alias("profile"),
        F.when(kind == 2, "max_connections").otherwise("metric").alias("concept"),
        F.when(kind == 2, "maxConnections").otherwise("metric").alias("name"),
        F.when(kind == 0, "l2-squared").when(kind == 1, "hamming").otherwise(F.col("s_nationkey").cast("string")).alias("value"))
    return M.map_index_config(catalog, "milvus")


@query("vendor_profiles", f"""WITH {_REQUESTS_SQL},
limits AS (SELECT * FROM (VALUES ('pinecone', 20000, 'text'), ('qdrant', 65536, 'any'), ('weaviate', 65535, 'uuid'),
  ('milvus', 32768, 'any')) p(profile, max_dims, id_rule))
SELECT request_id, target_type, max_dims, id_rule FROM requests LEFT JOIN limits ON target_type = profile""")
def limits_of_requests(spark, sf):
    known = F.broadcast(profiles_frame(spark).select(F.col("profile").alias("target_type"), "max_dims", "id_rule"))
    return _requests(spark, sf).join(known, "target_type", "left").select("request_id", "target_type", "max_dims", "id_rule")
