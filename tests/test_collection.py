import pytest
from pyspark.sql import functions as F

from embedlift.sinks.collection import Collection
from embedlift.sinks.merge import dedupe_last_write, delete_by_ids, upsert

V1 = [1.0]


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_merge_functions(records, metadata_of):
    target = records([("a", V1, '{"n": 1, "old": true}'), ("b", V1, '{"n": 1}')])
    delta = records([("a", V1, '{"n": 2}'), ("a", V1, '{"n": 3}'), ("c", V1, '{"n": 9}')]).withColumn(
        "seq", F.try_variant_get("metadata", "$.n", "int"))
    assert metadata_of(upsert(target, delta, "seq")) == {"a": {"n": 3}, "b": {"n": 1}, "c": {"n": 9}}
    assert ids(delete_by_ids(target, records([("a", V1, None), ("zz", V1, None)]))) == ["b"]
    once = dedupe_last_write(delta, "seq")
    assert metadata_of(once) == metadata_of(dedupe_last_write(once, "seq"))


def test_upserts_replace_whole_records_and_batches_apply_once(spark, scratch, records, metadata_of):
    store = Collection(spark, scratch)
    assert store.version() == 0 and ids(store.snapshot()) == []
    store.upsert(records([("a", V1, '{"n": 1, "old": true}'), ("b", V1, '{"n": 1}')]), batch_id="1")
    store.upsert(records([("a", V1, '{"n": 2}'), ("c", None, None)]), batch_id="2")
    assert store.upsert(records([("a", V1, '{"n": 99}')]), batch_id="2") == 2
    assert metadata_of(store.snapshot()) == {"a": {"n": 2}, "b": {"n": 1}, "c": None}


def test_repeated_ids_in_one_batch_become_one(spark, scratch, records):
    store = Collection(spark, scratch)
    store.upsert(records([("a", V1, '{"n": 1}'), ("a", V1, '{"n": 2}'), ("b", V1, None)]))
    assert ids(store.snapshot()) == ["a", "b"]
    again = Collection(spark, scratch + "-2")
    again.upsert(records([("a", V1, '{"n": 2}'), ("b", V1, None), ("a", V1, '{"n": 1}')]))
    same = lambda s: s.snapshot().select("id", F.to_json("metadata").alias("m")).orderBy("id").collect()
    assert same(store) == same(again)


def test_deletes_versions_rollback_and_compaction(spark, scratch, records):
    store = Collection(spark, scratch)
    first = store.upsert(records([("a", V1, "{}"), ("b", V1, "{}")]), batch_id="load")
    store.delete(records([("a", V1, None), ("unknown", V1, None)]))
    assert ids(store.snapshot()) == ["b"] and ids(store.snapshot(first)) == ["a", "b"]
    store.compact()
    assert ids(store.snapshot()) == ["b"]
    store.rollback_to(first)
    assert ids(store.snapshot()) == ["a", "b"] and store.has_batch("load")
    store.upsert(records([("c", V1, "{}")]))
    assert ids(store.snapshot()) == ["a", "b", "c"]
    store.rollback_to(0)
    assert ids(store.snapshot()) == [] and not store.has_batch("load")
    store.upsert(records([("d", V1, "{}")]), batch_id="load")
    assert ids(store.snapshot()) == ["d"]
    with pytest.raises(ValueError, match="no version 99"):
        store.rollback_to(99)


def test_unfinished_commit_is_not_read(spark, scratch, records):
    store = Collection(spark, scratch)
    store.upsert(records([("a", V1, "{}")]))
    records([("x", V1, "{}")]).write.parquet(f"{scratch}/changes/00000002-lost")
    assert ids(Collection(spark, scratch).snapshot()) == ["a"]


def test_late_changes_lose_against_newer_ones(spark, scratch, records, metadata_of):
    store = Collection(spark, scratch, by_seq=True)
    change = lambda rows, op, seq: records(rows).withColumn("op", F.lit(op)).withColumn("seq", F.lit(seq).cast("bigint"))
    store.apply(change([("a", V1, '{"n": 5}'), ("b", V1, '{"n": 5}')], "upsert", 5))
    store.apply(change([("b", None, None)], "delete", 7))
    store.apply(change([("a", V1, '{"n": 3}'), ("b", V1, '{"n": 6}')], "upsert", 3))
    assert metadata_of(store.snapshot()) == {"a": {"n": 5}}
    store.compact()
    store.apply(change([("b", V1, '{"n": 6}')], "upsert", 6))     # older than the delete that compaction kept
    assert metadata_of(store.snapshot()) == {"a": {"n": 5}}
    store.apply(change([("b", V1, '{"n": 8}')], "upsert", 8))
    assert metadata_of(store.snapshot()) == {"a": {"n": 5}, "b": {"n": 8}}


def test_upsert_without_order_adds_one_record_per_id(spark, records):
    target, delta = records([("a", [1.0], "{}")]), records([("a", [2.0], "{}"), ("a", [3.0], "{}"), ("b", [4.0], "{}")])
    got = upsert(target, delta)
    assert sorted(r["id"] for r in got.collect()) == ["a", "b"]


def test_changes_are_written_without_a_sort(spark, scratch, records, monkeypatch):
    from pyspark.sql import DataFrame

    def refuse(*_):
        raise AssertionError("a sort holds a task's whole part of the records")

    target = Collection(spark, scratch)
    monkeypatch.setattr(DataFrame, "sortWithinPartitions", refuse)
    target.upsert(records([("b", [1.0], "{}"), ("a", [2.0], "{}")]))
    target.upsert(records([("a", [3.0], "{}")]))
    assert sorted((r.id, list(r.vector)) for r in target.snapshot().collect()) == [("a", [3.0]), ("b", [1.0])]
