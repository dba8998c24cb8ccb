import numpy as np
import pandas as pd
import pytest

from embedlift.functions.vectors import METRICS, vector_distance, vector_distance_arrow
from embedlift.operators.search import SMALLER_IS_NEARER, recall_at_k, search


def frames(spark, n=300, m=7, dims=5, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(-3, 4, size=(n, dims)).astype(np.float32)
    base[n // 3: 2 * n // 3] = base[0]                     # a third are copies
    asked = rng.integers(-3, 4, size=(m, dims)).astype(np.float32)
    asked[asked.any(axis=1) == False] = 1                  # noqa: E712
    ids = [f"{i:05d}" for i in range(n)]
    rows = spark.createDataFrame(pd.DataFrame({"id": ids, "vector": [r.tolist() for r in base]}), "id string, vector array<float>")
    queries = spark.createDataFrame(pd.DataFrame({"query_id": [f"q{i}" for i in range(m)], "vector": [r.tolist() for r in asked]}),
                                    "query_id string, vector array<float>")
    return base.astype(float), asked.astype(float), ids, rows.repartition(6), queries


def brute(base, asked, ids, metric, k):
    out = {}
    for i, q in enumerate(asked):
        if metric == "cosine":
            norms = np.linalg.norm(base, axis=1) * np.linalg.norm(q)
            score = np.divide(base @ q, norms, out=np.full(len(base), np.nan), where=norms > 0)
        else:
            score = {"dot": base @ q, "euclidean": np.sqrt(((base - q) ** 2).sum(1)), "l2-squared": ((base - q) ** 2).sum(1),
                     "manhattan": np.abs(base - q).sum(1), "hamming": (base != q).sum(1).astype(float)}[metric]
        rows = [(round(float(s), 12), name) for s, name in zip(score, ids) if not np.isnan(s)]
        sign = 1 if metric in SMALLER_IS_NEARER else -1
        out[f"q{i}"] = [name for _, name in sorted(rows, key=lambda r: (sign * r[0], r[1]))[:k]]
    return out


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_exact_neighbours(spark, metric, broadcast_bytes):
    base, asked, ids, rows, queries = frames(spark)
    found = search(queries, rows, 12, metric=metric, broadcast_bytes=broadcast_bytes).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == brute(base, asked, ids, metric, 12)


def test_many_small_blocks(spark, monkeypatch):
    import embedlift.operators.search as module

    monkeypatch.setattr(module, "_BLOCK_BYTES", 8 * 5 * 40)
    base, asked, ids, rows, queries = frames(spark, n=250, m=90)
    found = search(queries, rows, 4, broadcast_bytes=0).collect()
    want = brute(base, asked, ids, "cosine", 4)
    assert {(r["query_id"], r["rank"]): r["id"] for r in found} == {(q, i + 1): x for q, xs in want.items() for i, x in enumerate(xs)}


def test_unusable_vectors_are_no_hits(spark):
    rows = spark.sql("SELECT * FROM VALUES ('z', array(0f, 0f)), ('n', NULL), ('d', array(1f)), ('e', array(1f, NULL)), ('ok', array(1f, 1f)) AS t(id, vector)")
    queries = spark.sql("SELECT 'q' AS query_id, array(1f, 2f) AS vector")
    assert [r["id"] for r in search(queries, rows, 5).collect()] == ["ok"]
    assert search(queries.filter("false"), rows, 5).collect() == []
    assert search(queries, rows.filter("false"), 5).collect() == []


@pytest.mark.parametrize("metric", METRICS)
def test_both_distance_forms(spark, metric):
    pairs = spark.sql("""SELECT * FROM VALUES
      (1, array(1f, 2f), array(2f, 4f)), (2, array(1f, 0f), array(0f, 1f)), (3, array(0f, 0f), array(1f, 1f)), (4, NULL, array(1f)),
      (5, array(1f), array(1f, 2f)), (6, array(1f, NULL), array(1f, 1f)), (7, array(float('NaN'), 1f), array(1f, 1f)),
      (8, array(1f, -1f), array(-1f, 1f)) AS t(n, a, b)""")
    from pyspark.sql import functions as F

    rows = pairs.select("n", vector_distance(F.col("a"), F.col("b"), metric).alias("x"),
                        vector_distance_arrow(F.col("a"), F.col("b"), metric).alias("y")).collect()
    for r in rows:
        assert (r["x"] is None) == (r["y"] is None) and (r["x"] is None or abs(r["x"] - r["y"]) < 1e-9), r
    values = {r["n"]: r["x"] for r in rows}
    assert values[4] is None and values[5] is None and values[6] is None and values[7] is None
    expected = {"cosine": {1: 1.0, 2: 0.0, 3: None, 8: -1.0}, "dot": {1: 10.0, 8: -2.0}, "euclidean": {1: 5 ** 0.5}, "l2-squared": {1: 5.0, 8: 8.0},
                "manhattan": {1: 3.0, 8: 4.0}, "hamming": {1: 2.0, 3: 2.0}}[metric]
    for n, want in expected.items():
        assert values[n] is None if want is None else abs(values[n] - want) < 1e-9


def test_recall(spark):
    s = spark.sql("SELECT * FROM VALUES ('q', 'a'), ('q', 'b'), ('r', 'a') AS t(query_id, id)")
    t = spark.sql("SELECT * FROM VALUES ('q', 'a'), ('q', 'x') AS t(query_id, id)")
    assert {r["query_id"]: r["recall"] for r in recall_at_k(s, t, 2).collect()} == {"q": 0.5, "r": 0.0}
