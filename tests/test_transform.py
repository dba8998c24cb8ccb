import pytest
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.converters import register_converter
from embedlift.operators import transform as T
from embedlift.operators.filters import check_target_constraints, payload_filter
from embedlift.operators.transform import FieldRule, Mapping

V2 = [1.0, 2.0]


def test_mapping_keeps_mapped_fields_only(records, metadata_of):
    df = records([("a", V2, '{"title": "T", "score": 0.5, "other": 1}'), ("b", V2, '{"title": null}'), ("c", V2, "{}")])
    mapping = Mapping("pinecone", "qdrant", (FieldRule("title", "name"), FieldRule("score", "score", None, "0")))
    assert metadata_of(T.map_records(df, mapping)) == {
        "a": {"name": "T", "score": 0.5}, "b": {"name": None, "score": 0}, "c": {"score": 0}}


def test_mapping_of_null_metadata(records, metadata_of):
    mapping = Mapping("pinecone", "qdrant", (FieldRule("title", "name"),))
    assert metadata_of(T.map_records(records([("a", V2, None)]), mapping)) == {"a": {}}


def test_two_sources_for_one_target_last_by_name(records, metadata_of):
    mapping = Mapping("pinecone", "qdrant", (FieldRule("b", "x"), FieldRule("a", "x")))
    df = records([("1", V2, '{"a": 1, "b": 2}'), ("2", V2, '{"a": 1}')])
    assert metadata_of(T.map_records(df, mapping)) == {"1": {"x": 2}, "2": {"x": 1}}


def test_bad_mappings_are_refused(records):
    df = records([("a", V2, "{}")])
    for mapping, message in [(None, "mapping cannot be nil"), (Mapping("", "qdrant"), "source database type must be specified"),
                             (Mapping("qdrant", "qdrant"), "source and target databases must be different"),
                             (Mapping("redis", "qdrant"), "invalid source database type: redis")]:
        with pytest.raises(ValueError, match=message):
            T.map_records(df, mapping)


def test_failed_conversion(records, metadata_of):
    df = records([("a", V2, '{"n": "7"}'), ("b", V2, '{"n": "x"}'), ("c", V2, '{"n": null}')])
    mapping = Mapping("qdrant", "milvus", (FieldRule("n", "n", "to_int"),))
    assert metadata_of(T.map_records(df, mapping, "drop")) == {"a": {"n": 7}, "c": {"n": None}}
    assert [tuple(r) for r in T.rejected_records(df, mapping).collect()] == [("b", "n", "failed to convert field n")]
    with pytest.raises(Exception, match="failed to convert field n of record b"):
        T.map_records(df, mapping).collect()


def test_own_converter(records, metadata_of):
    register_converter("upper", lambda v: F.upper(F.try_variant_get(v, "$", "string")).cast("variant"))
    mapping = Mapping("qdrant", "milvus", (FieldRule("n", "n", "upper"),))
    assert metadata_of(T.map_records(records([("a", V2, '{"n": "x"}')]), mapping)) == {"a": {"n": "X"}}


def test_number_narrowing(spark):
    df = spark.sql("""SELECT id, array(1f) AS vector, parse_json(j) AS metadata FROM VALUES
      ('int', '{"x": 3}'), ('dec', '{"x": 3.0}'), ('exp', '{"x": 3e0}'), ('half', '{"x": 2.5}'), ('huge', '{"x": 1e300}'),
      ('text', '{"x": "3.0"}'), ('neg', '{"x": -4e0}') AS t(id, j)""")
    got = {r["id"]: (r["k"], r["j"]) for r in T.narrow_numbers(df).select(
        "id", V.kind(V.field(F.col("metadata"), "x")).alias("k"), F.to_json("metadata").alias("j")).collect()}
    assert got["int"] == got["dec"] == got["exp"] == ("BIGINT", '{"x":3}')
    assert got["neg"] == ("BIGINT", '{"x":-4}')
    assert got["half"][1] == '{"x":2.5}' and got["huge"][0] == "DOUBLE" and got["text"] == ("STRING", '{"x":"3.0"}')


def test_flatten_one_level(records, metadata_of):
    df = records([("flat", V2, '{"title": "Test", "score": 0.95}'),
                  ("nested", V2, '{"author": {"name": "A", "email": "e"}, "tags": ["x"], "empty": {}}'),
                  ("deep", V2, '{"a": {"b": {"c": 1}}}'), ("literal", V2, '{"a": {"b": 1}, "a.b": 2}'), ("none", V2, None)])
    assert metadata_of(T.flatten_metadata(df)) == {
        "flat": {"title": "Test", "score": 0.95}, "nested": {"author.name": "A", "author.email": "e", "tags": ["x"]},
        "deep": {"a.b": {"c": 1}}, "literal": {"a.b": 2}, "none": {}}


def test_flatten_collision_of_lifted_keys(records, metadata_of):
    df = records([("a", V2, '{"a": {"b.c": 1}, "a.b": {"c": 2}}')])
    assert metadata_of(T.flatten_metadata(df)) == {"a": {"a.b.c": 2}}


def test_unflatten_inverts_flatten(records, metadata_of):
    rows = [("1", V2, '{"author": {"name": "A", "email": "e"}, "n": 1}'), ("2", V2, '{"a": {"b": {"c": 1}, "d": [1]}}'), ("3", V2, "{}")]
    df = records(rows)
    assert metadata_of(T.unflatten_metadata(T.flatten_metadata(df, ".", 3), ".", 3)) == metadata_of(df)


def test_unflatten_leaves_conflicts(records, metadata_of):
    df = records([("1", V2, '{"a": 1, "a.b": 2, ".x": 3, "y.": 4}')])
    assert metadata_of(T.unflatten_metadata(df)) == {"1": {"a": 1, "a.b": 2, ".x": 3, "y.": 4}}


def test_uuid_ids(records):
    own = "0f8fad5b-d9cb-469f-a165-70867728950e"
    got = {r["source_id"]: r["id"] for r in T.derive_uuid(records([("doc#1", V2, "{}"), (own, V2, "{}")])).collect()}
    assert got[own] == own and len(got["doc#1"]) == 36 and got["doc#1"][8] == "-"


def test_target_constraints(records):
    df = records([("ok", V2, '{"t": ["a"], "e": []}'), ("x" * 1025, V2, "{}"), ("nest", V2, '{"o": {"a": 1}}'), ("arr", V2, '{"t": [1]}'),
                  ("big", V2, '{"t": "%s"}' % ("y" * 41000)), ("empty", [], "{}"), (None, V2, None)])
    got = {((r["record_id"] or "")[:5], r["field"], r["message"].split(" exceeds")[0]) for r in check_target_constraints(df, "pinecone").collect()}
    assert got == {("xxxxx", "id", "id"), ("nest", "o", "nested object is not allowed"), ("arr", "t", "array elements must be strings"),
                   ("big", "metadata", "metadata"), ("empty", "vector", "vector is empty"), ("", "id", "id is empty")}
    assert {r["message"] for r in check_target_constraints(records([("a", V2, "{}")]), "weaviate").collect()} == {"id is not a UUID"}


def test_payload_filter(records):
    df = records([("1", V2, '{"lang": "en", "n": 5, "tags": ["a", "b"]}'), ("2", V2, '{"lang": "de", "n": 50, "tags": "abc"}'), ("3", V2, "{}")])
    ids = lambda *c: sorted(r["id"] for r in payload_filter(df, list(c)).collect())
    assert ids(("lang", "eq", "en")) == ["1"] and ids(("n", "range", (5, None))) == ["1", "2"]
    assert ids(("tags", "contains", "a")) == ["1", "2"] and ids(("lang", "in", ["en", "de"]), ("n", "range", (None, 10))) == ["1"]
    assert ids(("missing", "eq", 1)) == []


def test_namespace_and_sparse(spark, records, metadata_of):
    df = records([("1", V2, '{"a": 1}')]).withColumn("namespace", F.lit("n1"))
    assert metadata_of(T.map_namespace(df, "payload")) == {"1": {"a": 1, "namespace": "n1"}}
    sparse = spark.sql("SELECT '1' AS id, CAST(NULL AS array<float>) AS vector, named_struct('indices', array(3L, 0L), 'values', array(2f, 1f)) AS sparse")
    assert T.sparse_vectors_to_dense(sparse, 5).first()["vector"] == [1.0, 0.0, 0.0, 2.0, 0.0]
    assert T.sparse_vectors_to_dense(sparse, 3).first()["vector"] is None
    dense = spark.sql("SELECT '1' AS id, array(1f, 0f, 2f) AS vector")
    assert T.dense_vectors_to_sparse(dense).select("sparse.*").first() == ([0, 2], [1.0, 2.0])


def test_field_names_with_odd_characters(records, metadata_of):
    df = records([("1", V2, '{"a.b": 1, "sp ace": 2, "q\'x": 3}')])
    mapping = Mapping("qdrant", "milvus", (FieldRule("a.b", "ab"), FieldRule("sp ace", "s"), FieldRule("q'x", "q")))
    assert metadata_of(T.map_records(df, mapping)) == {"1": {"ab": 1, "s": 2, "q": 3}}


def test_all_paths_count_the_levels_of_one_table_once(spark, scratch, monkeypatch):
    from embedlift.queries import records as queries

    rows = [(i, i % 3, "view", float(i) + 0.5, '{"k": %d}' % i) for i in range(5)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").write.parquet(f"{scratch}/events.parquet")
    counted, real = [], V.nesting
    monkeypatch.setattr(V, "nesting", lambda *args: counted.append(1) or real(*args))
    got = queries.migrate_all_paths(spark, scratch).groupBy("target_type", "field_names").count().collect()
    assert len(counted) == 1
    assert {r.field_names for r in got if r.target_type == "pinecone"} == {"evt_type,evt_value,k,score,tags"}
    assert sum(r["count"] for r in got) == 5 * len(queries.PROFILES) * (len(queries.PROFILES) - 1)
