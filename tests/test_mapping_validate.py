import itertools

import pytest
from pyspark.sql import functions as F

from embedlift.functions import text
from embedlift.operators import mapping as M
from embedlift.operators import validate as D


def fields(spark, rows):
    return spark.createDataFrame(rows, "collection string, field string, type string")


def test_create_mapping_rules(spark):
    source = fields(spark, [("c", f, "string") for f in ("title", "URL", "score", "id", "vector", "lost", "Name")])
    target = fields(spark, [("c", f, "text") for f in ("title", "TITLE", "url", "score", "name", "NAME", "id")] + [("d", "lost", "text")])
    got = {r["source_field"]: (r["target_field"], r["match_kind"]) for r in M.create_mapping(source, target).collect()}
    assert got == {"title": ("title", "exact"), "URL": ("url", "case"), "score": ("score", "exact"), "lost": (None, "unmatched"),
                   "Name": ("NAME", "case")}
    with pytest.raises(ValueError, match="must not be nil"):
        M.create_mapping(None, target)


def test_fuzzy_candidates_are_complete(spark):
    names = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("ab", repeat=n)]
    source = spark.createDataFrame([("c", n) for n in names], "collection string, source_field string")
    target = spark.createDataFrame([("c", n) for n in names if n.startswith("a")], "collection string, target_field string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i] + row[1:], row
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]

    for d in (1, 2):
        got = {r["source_field"]: (r["distance"], r["target_field"]) for r in M.fuzzy_matches(source, target, d).collect()}
        want = {}
        for n in names:
            near = sorted((distance(n, t), t) for t in names if t.startswith("a") and distance(n, t) <= d)
            if near:
                want[n] = near[0]
        assert got == want


def test_fuzzy_mapping_uses_free_targets(spark):
    source = fields(spark, [("c", f, "s") for f in ("doc_title", "url")])
    target = fields(spark, [("c", f, "s") for f in ("docTitles", "URL", "urls")])
    got = {r["source_field"]: (r["target_field"], r["match_kind"]) for r in M.create_mapping(source, target, 2).collect()}
    assert got == {"doc_title": ("docTitles", "fuzzy"), "url": ("URL", "case")}


def test_mapping_errors_first_rule_wins(spark):
    rows = [("n", None, None, True), ("s", "", "qdrant", False), ("t", "qdrant", None, False), ("same", "redis", "redis", False),
            ("bs", "redis", "qdrant", False), ("bt", "qdrant", "redis", False), ("ok", "milvus", "qdrant", False)]
    df = spark.createDataFrame(rows, "k string, source_type string, target_type string, is_null boolean")
    assert {r["k"]: r["error"] for r in M.validate_mapping(df).collect()} == {
        "n": "mapping cannot be nil", "s": "source database type must be specified", "t": "target database type must be specified",
        "same": "source and target databases must be different", "bs": "invalid source database type: redis",
        "bt": "invalid target database type: redis", "ok": None}


def test_recommendations(spark):
    requests = spark.createDataFrame([(1, "pinecone", "qdrant"), (2, "", "qdrant"), (3, "qdrant", "qdrant"), (4, "milvus", "qdrant")],
                                     "request_id int, source_type string, target_type string")
    own = spark.createDataFrame([(1, "id"), (1, "title"), (1, "custom_field"), (2, "x")], "request_id int, field string")
    got = {}
    for r in M.recommend_schema(requests, own).collect():
        got.setdefault(r["request_id"], {})[r["source_field"]] = r["confidence"]
    common = {"id": 1.0, "title": .95, "url": .95, "content": .9}
    assert got == {1: {**common, "custom_field": .7}, 4: common}
    assert {r["request_id"]: r["error"] for r in M.recommend_error(requests).collect()} == {
        1: None, 2: "source_type is required", 3: "source_type and target_type must be different", 4: None}
    rated = {r["request_id"]: (r["overall_confidence"], len(r["warnings"])) for r in M.path_confidence(requests).collect()}
    assert rated[1] == (.9, 1) and rated[4] == (.75, 1)


def test_inferred_types(records):
    df = records([("1", [1.0], '{"s": "x", "i": 1, "f": 1.5, "b": true, "l": ["a"], "m": [1], "o": {"p": {"q": 1}}, "d": "2024-01-15", "n": null}'),
                  ("2", [1.0], '{"s": 5}'), ("3", [1.0], None)])
    got = {(r["path"], r["type"]): r["n_values"] for r in M.infer_schema(df).collect()}
    assert got == {("s", "string"): 1, ("s", "int"): 1, ("i", "int"): 1, ("f", "float"): 1, ("b", "boolean"): 1, ("l", "string[]"): 1,
                   ("m", "array"): 1, ("o", "object"): 1, ("o.p", "object"): 1, ("o.p.q", "int"): 1, ("d", "date"): 1, ("n", "null"): 1}


def sides(records):
    source = records([("same", [1.0, 0.0], '{"a": 1}'), ("turned", [1.0, 0.0], '{"a": 1}'), ("zero", [0.0, 0.0], "{}"),
                      ("dim", [1.0], "{}"), ("gone", [1.0], "{}"), ("meta", [1.0], '{"a": 1, "b": 2}'), ("nv", None, "{}")])
    target = records([("same", [1.0, 0.0], '{"a": 1}'), ("turned", [-1.0, 0.0], '{"a": 1}'), ("zero", [0.0, 0.0], "{}"),
                      ("dim", [1.0, 1.0], "{}"), ("meta", [1.0], '{"a": 2}'), ("nv", [1.0], "{}"), ("extra", [1.0], "{}")])
    return source, target


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
def test_validation(records, engine):
    source, target = sides(records)
    summary, errors = D.validate_migration(source, target, sample_rate=1.0, fields=["a", "b"], engine=engine)
    got = summary.first()
    assert (got["total_records"], got["valid_records"], got["invalid_records"], got["min_similarity"], got["max_similarity"]) == (7, 2, 5, -1.0, 1.0)
    assert {tuple(r) for r in errors.collect()} == {
        ("turned", "vector", "Cosine similarity below threshold"), ("zero", "vector", "Cosine similarity is undefined"),
        ("dim", "vector", "Vector dimensions differ"), ("gone", "id", "Record missing in target"),
        ("nv", "vector", "Vector is missing"), ("meta", "a", "Metadata value differs"), ("meta", "b", "Metadata field missing in target")}
    assert [r["reason"] for r in D.rollback_alert(summary).collect()] == ["min similarity below threshold"]


def test_reconcile_and_checksum(records):
    source, target = sides(records)
    got = {r["id"]: r["status"] for r in D.reconcile(source, target).collect()}
    assert got == {"same": "matched", "zero": "matched", "turned": "changed", "dim": "changed", "meta": "changed", "nv": "changed",
                   "gone": "missing_in_target", "extra": "extra_in_target"}
    assert {(r["id"], r["side"]) for r in D.missing_ids(source, target).collect()} == {("gone", "source"), ("extra", "target")}
    total = lambda df: D.content_checksum(df).first()["checksum"]
    assert total(source) == total(source.repartition(5).orderBy(F.desc("id"))) != total(target)
    assert total(source.filter("false")) == 0


def test_reconcile_with_many_copies(spark, records):
    one = records([("hot", [1.0], "{}")]).select("*", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("col")
    got = D.reconcile(one, one.repartition(3)).first()
    assert got["status"] == "matched" and got["source_copies"] == got["target_copies"] == 5000
    assert D.reconcile(one, records([("hot", [1.0], "{}")])).first()["status"] == "changed"
    five = records([("x", [float(i)], "{}") for i in range(5)])
    assert D.reconcile(five, five.filter("vector[0] in (0, 4)")).first()["status"] == "changed"


def test_samples_are_the_same_on_both_sides(spark, records):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.array(F.lit(1.0).cast("float")).alias("vector"),
                                  F.parse_json(F.lit("{}")).alias("metadata"))
    n = D.validate_migration(df, df, sample_rate=0.1)[0].first()
    assert 400 < n["total_records"] < 600 and n["valid_records"] == n["total_records"]
    assert D.validate_migration(df, df, sample_rate=None, sample_size=77)[0].first()["total_records"] == 77


def test_text_rules(spark):
    df = spark.createDataFrame([("abc",), ("abcd",), ("secret-key",), ("12345678",), ("Bearer tok",), ("Bearer ",), ("bearer x",)], "s string")
    got = {r[0]: tuple(r)[1:] for r in df.select("s", text.mask_secret(F.col("s")), text.mask_api_key(F.col("s")), text.bearer_key(F.col("s"))).collect()}
    assert got["abc"][0] == got["abcd"][0] == "****" and got["secret-key"][:2] == ("****-key", "secr...-key") and got["12345678"][1] == "****"
    assert got["Bearer tok"][2] == "tok" and got["Bearer "][2] == "Bearer " and got["bearer x"][2] == "bearer x"
    assert spark.sql("SELECT 'x' AS t").select(text.parse_rfc3339(F.col("t"))).first()[0] is None
