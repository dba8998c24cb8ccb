import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from embedlift.operators import state as S
from embedlift.operators.ordered import moving_average, with_context

T0 = datetime.datetime(2026, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(m, q, s, None, T0 + datetime.timedelta(seconds=q)) for m, q, s in rows], S.EVENT_DDL)


def points(spark, rows):
    """(migration, seq, total, processed)"""
    df = spark.createDataFrame([(m, q, t, p) for m, q, t, p in rows], "migration_id string, seq bigint, total_records bigint, processed_count bigint")
    return df.select("migration_id", "seq", F.col("seq").alias("batch_no"), F.lit("x").alias("last_processed_id"), "total_records",
                     "processed_count", F.lit(0).cast("bigint").alias("failed_count"), F.lit(T0).alias("started_at"),
                     F.timestamp_seconds(F.col("seq") + 1700000000).alias("checkpoint_at"), F.lit(False).alias("deleted"))


def test_states_survive_checkpoints(spark):
    ev = events(spark, [("m1", 1, "in_progress"), ("m2", 1, "completed"), ("m3", 1, "rolled_back")])
    cps = points(spark, [])
    ev2, cps2 = S.save_checkpoints(ev, cps, points(spark, [("m1", 5, 10, 100), ("m2", 5, 10, 200), ("m3", 5, 10, 300), ("m4", 5, 10, 400)]))
    ids = spark.createDataFrame([("m1",), ("m2",), ("m3",), ("m4",), ("mig-123",)], "migration_id string")
    assert {r[0]: r[1] for r in S.get_state(ids, ev2).collect()} == {
        "m1": "in_progress", "m2": "completed", "m3": "rolled_back", "m4": "in_progress", "mig-123": "not_started"}
    got = {r["migration_id"]: r["processed_count"] for r in S.get_checkpoint(ids, cps2).collect()}
    assert got == {"m1": 100, "m2": 200, "m3": 300, "m4": 400, "mig-123": None}


def test_deleted_checkpoint_is_gone_until_the_next(spark):
    cps = points(spark, [("a", 1, 10, 1), ("a", 2, 10, 2), ("b", 1, 10, 5)])
    gone = S.delete_checkpoints(cps, spark.createDataFrame([("a",)], "migration_id string"))
    assert [r["migration_id"] for r in S.latest_checkpoints(gone).collect()] == ["b"]
    back = gone.unionByName(points(spark, [("a", 9, 10, 7)]))
    assert {r["migration_id"]: r["processed_count"] for r in S.latest_checkpoints(back).collect()} == {"a": 7, "b": 5}


def test_status_rules(spark):
    ev = events(spark, [("run", 1, "in_progress"), ("done", 1, "completed")])
    cps = points(spark, [("run", 3, 0, 0), ("done", 4, 200, 150)])
    ids = spark.createDataFrame([("run",), ("done",), ("new",)], "migration_id string")
    got = {r["migration_id"]: r for r in S.migration_status(ids, ev, cps).collect()}
    assert got["new"]["status"] == "not_started" and got["new"]["percentage"] == 0.0 and got["new"]["started_at"] is None
    assert got["run"]["percentage"] == 0.0 and got["run"]["ended_at"] is None
    assert got["done"]["percentage"] == 75.0 and got["done"]["batches_est"] == 1 and got["done"]["ended_at"].endswith("Z")
    with pytest.raises(Exception, match="migration_id is required"):
        S.migration_status(spark.createDataFrame([("",)], "migration_id string"), ev, cps).collect()


def test_listing(spark):
    ev = events(spark, [(f"m{i}", i, "failed" if i % 2 else "completed") for i in range(10)])
    cps = points(spark, [("m1", 1, 10, 5), ("m2", 1, 0, 5)])
    page = S.list_migrations(ev, cps, limit=3, offset=1).collect()
    assert [r["migration_id"] for r in page] == ["m8", "m7", "m6"] and {r["total"] for r in page} == {10}
    page = S.list_migrations(ev, cps, "Failed", sort_by="migration_id", sort_order="asc").collect()
    assert [r["migration_id"] for r in page] == ["m1", "m3", "m5", "m7", "m9"] and page[0]["progress_percent"] == 50.0
    assert S.list_migrations(ev, cps, offset=50).collect() == []
    for bad in (dict(limit=0), dict(limit=501), dict(offset=-1), dict(status="paused"), dict(sort_by="x")):
        with pytest.raises(ValueError):
            S.list_migrations(ev, cps, **bad)


def test_unknown_state_is_refused(spark):
    ev = events(spark, [("a", 1, "completed")])
    with pytest.raises(Exception, match="unknown state: paused"):
        S.set_state(ev, events(spark, [("a", 2, "paused")])).collect()


@pytest.mark.parametrize("chunk", [1, 3, 16])
def test_chunked_windows_equal_plain_ones(spark, chunk):
    rng = random.Random(chunk)
    rows = [("hot" if i % 3 else f"k{i % 7}", 1_700_000_000_000_000_000 + i * 1_000_000_000, rng.randint(1, 9)) for i in range(0, 400)]
    df = spark.createDataFrame(rows, "key string, seq bigint, x bigint").filter("seq % 11 <> 0")
    got = with_context(df, "key", "seq", previous=("x", "seq"), running={"total": "x"}, position="at", chunks=chunk)
    got = moving_average(got, "key", "at", "x", "mean", 4, chunk_rows=7).toPandas().sort_values(["key", "seq"])
    want = df.toPandas().sort_values(["key", "seq"])
    g = want.groupby("key")
    assert got["total"].tolist() == g["x"].cumsum().tolist()
    assert got["at"].tolist() == g.cumcount().tolist()
    assert got["prev_x"].fillna(-1).tolist() == g["x"].shift().fillna(-1).tolist()
    assert got["prev_seq"].fillna(-1).tolist() == g["seq"].shift().fillna(-1).tolist()
    mean = g["x"].rolling(4, min_periods=1).mean().reset_index(level=0, drop=True)
    assert pd.Series(got["mean"].to_numpy()).sub(pd.Series(mean.to_numpy())).abs().max() < 1e-9


def test_transitions(spark):
    ev = events(spark, [("ok", 1, "in_progress"), ("ok", 2, "in_progress"), ("ok", 3, "completed"), ("ok", 4, "rolled_back"),
                        ("skip", 1, "completed"), ("undo", 1, "in_progress"), ("undo", 2, "failed"), ("undo", 3, "in_progress"), ("undo", 4, "not_started")])
    got = {(r["migration_id"], r["prev_state"], r["state"]) for r in S.transition_violations(ev).collect()}
    assert got == {("skip", "not_started", "completed"), ("undo", "in_progress", "not_started")}


def test_store_on_disk(spark, scratch):
    store = S.StateStore(spark, scratch)
    assert store.state("m") == "not_started" and store.checkpoint("m") is None
    store.save_checkpoint("m", last_processed_id="doc-100", total_records=1000, processed_count=100, failed_count=0,
                          validation=(10, .987, .982, .995))
    assert store.state("m") == "in_progress"
    saved = store.checkpoint("m")
    assert saved["last_processed_id"] == "doc-100" and saved["validation"]["min"] == .982
    store.set_state("m", "completed")
    store.save_checkpoint("m", processed_count=200)
    assert store.state("m") == "completed" and store.checkpoint("m")["processed_count"] == 200
    store.delete_checkpoint("m")
    assert store.checkpoint("m") is None and store.state("m") == "completed"
    with pytest.raises(ValueError, match="unknown state"):
        store.set_state("m", "paused")
    with pytest.raises(ValueError, match="unknown checkpoint fields"):
        store.save_checkpoint("m", colour=1)
