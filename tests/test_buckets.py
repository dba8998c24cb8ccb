import threading

import pytest
from pyspark.sql import functions as F

from embedlift.sinks.buckets import BucketedCollection
from embedlift.sinks.commitlog import CommitLog, Files, State
from embedlift.streaming.migrate import cdc_sync
from embedlift.sources.streams import CHANGE_DDL, stream_records

V1 = [1.0]


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def many(records, n, value):
    return records([(f"k{i:04}", V1, f'{{"n": {value}}}') for i in range(n)])


def bucket_numbers(store, df):
    return {r[0] for r in df.select(store.bucket_of(F.col("id"))).distinct().collect()}


def test_numbers_are_given_once(spark, scratch):
    log = CommitLog(spark, scratch, every=3)
    writers = [CommitLog(spark, scratch, every=3) for _ in range(8)]
    won = []

    def work(i):
        for k in range(5):
            while not (new := writers[i].put(writers[i].head(), "merge", {i: f"data/{i}-{k}"}, f"w{i}-{k}")):
                pass
            won.append(new.version)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(won) == list(range(1, 41))
    assert log.head().buckets == {i: f"data/{i}-4" for i in range(8)} and log.head().version == 40
    assert log.head().batches == {f"w{i}-{k}" for i in range(8) for k in range(5)}


def test_opening_reads_one_saved_state_and_the_tail(spark, scratch):
    log = CommitLog(spark, scratch, every=10)
    for i in range(47):
        log.put(log.head(), "merge", {i % 5: f"data/{i}"}, f"b{i}")
    fresh = CommitLog(spark, scratch, every=10)
    assert fresh.head().version == 47 and fresh.read_files == 2 + 7
    assert fresh.at(23).buckets == {b: f"data/{max(i for i in range(23) if i % 5 == b)}" for b in range(5)}
    Files(spark, scratch).delete("hint")
    assert CommitLog(spark, scratch, every=10).head().buckets == fresh.head().buckets
    with pytest.raises(ValueError, match="no version 48"):
        fresh.at(48)


def test_batches_of_streams_take_one_number():
    query, state = "0f0e0d0c-1111-2222-3333-444455556666", State()
    for i in range(30):
        state = state.after({"version": i + 1, "buckets": {}, "batch_id": f"{query}:{i}"})
    assert state.streams == {query: 29} and not state.batches
    assert state.has_batch(f"{query}:29") and state.has_batch(f"{query}:3") and not state.has_batch(f"{query}:30")
    assert State.of(state.text()) == state
    assert not state.has_batch("docs:run:0001:0002")


def test_a_merge_writes_touched_buckets_only(spark, scratch, records, metadata_of):
    store = BucketedCollection(spark, scratch, buckets=100)
    first = store.upsert(many(records, 1000, 1), unique=True)
    before = store.log.head().buckets
    delta = records([("k0001", V1, '{"n": 2}'), ("k0001", V1, '{"n": 3}'), ("new", None, None)])
    touched = bucket_numbers(store, delta)
    second = store.upsert(delta, "one")
    after = store.log.head().buckets
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) == 2
    got = metadata_of(store.snapshot())
    assert len(got) == 1001 and got["k0001"] == {"n": 3} and got["new"] is None and got["k0002"] == {"n": 1}
    assert store.upsert(delta, "one") == second
    store.delete(records([("k0002", V1, None), ("unknown", V1, None)]))
    assert "k0002" not in ids(store.snapshot()) and len(ids(store.snapshot(second))) == 1001 and len(ids(store.snapshot(first))) == 1000
    store.rollback_to(first)
    assert metadata_of(store.snapshot())["k0001"] == {"n": 1} and not store.has_batch("one")
    store.upsert(delta, "one")
    assert metadata_of(store.snapshot())["k0001"] == {"n": 3}
    store.rollback_to(0)
    assert ids(store.snapshot()) == []
    with pytest.raises(ValueError, match="no version 99"):
        store.rollback_to(99)


def test_reading_shuffles_nothing_and_merging_once(spark, scratch, records):
    store = BucketedCollection(spark, scratch, buckets=8)
    store.upsert(many(records, 50, 1), unique=True)
    store.upsert(many(records, 20, 2), unique=True)
    plan = store.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and "Join" not in plan
    assert ids(store.records_of(records([("k0003", V1, None), ("zz", V1, None)]))) == ["k0003"]
    assert len(store.records_of(records([("k0003", V1, None)])).inputFiles()) == 1


def test_null_and_empty_ids_and_empty_changes(spark, scratch, records):
    store = BucketedCollection(spark, scratch, buckets=4)
    store.upsert(records([(None, V1, None), ("", V1, "{}"), ("", V1, "{}")]))
    store.upsert(records([("a", V1, None)]).limit(0))
    assert sorted(map(repr, (r["id"] for r in store.snapshot().collect()))) == ["''", "None"]
    assert BucketedCollection(spark, scratch, buckets=9).buckets == 4


class Raced(BucketedCollection):
    """Lets another writer commit while this one writes its files."""

    other = None

    def _merged(self, staged, old):
        written = super()._merged(staged, old)
        if self.other:
            other, self.other = self.other, None
            other()
        return written


def test_writers_on_other_buckets_both_commit_and_on_the_same_the_second_merges_again(spark, scratch, records, metadata_of):
    store, late = BucketedCollection(spark, scratch, buckets=16), Raced(spark, scratch, buckets=16)
    store.upsert(many(records, 200, 1), unique=True)
    by_bucket = {}
    for r in store.snapshot().select("id", store.bucket_of(F.col("id")).alias("b")).collect():
        by_bucket.setdefault(r["b"], []).append(r["id"])
    one, two = sorted(by_bucket)[:2]
    a, same, apart = by_bucket[one][0], by_bucket[one][1], by_bucket[two][0]
    writes = []
    merged = Raced._merged
    late._merged = lambda staged, old: (writes.append(sorted(old)), merged(late, staged, old))[1]
    late.other = lambda: store.upsert(records([(apart, V1, '{"n": 7}')]), unique=True)
    late.upsert(records([(a, V1, '{"n": 8}')]), unique=True)
    assert writes == [[one]] and late.commits()[-1]["retries"] == 1
    late.other = lambda: store.upsert(records([(same, V1, '{"n": 9}')]), unique=True)
    late.upsert(records([(a, V1, '{"n": 10}')]), unique=True)
    assert writes == [[one], [one], [one]]
    got = metadata_of(BucketedCollection(spark, scratch).snapshot())
    assert (got[a], got[same], got[apart]) == ({"n": 10}, {"n": 9}, {"n": 7}) and len(got) == 200
    late.other = lambda: store.upsert(records([(a, V1, '{"n": 11}')]), "batch", unique=True)
    late.upsert(records([(a, V1, '{"n": 12}')]), "batch", unique=True)
    assert metadata_of(store.snapshot())[a] == {"n": 11}


def test_late_changes_lose_until_they_are_forgotten(spark, scratch, records, metadata_of):
    store = BucketedCollection(spark, scratch, buckets=4, by_seq=True)
    change = lambda rows, op, seq: records(rows).withColumn("op", F.lit(op)).withColumn("seq", F.lit(seq).cast("bigint"))
    store.apply(change([("a", V1, '{"n": 5}'), ("b", V1, '{"n": 5}')], "upsert", 5))
    store.apply(change([("b", None, None)], "delete", 7))
    store.apply(change([("a", V1, '{"n": 3}'), ("b", V1, '{"n": 6}')], "upsert", 3))
    assert metadata_of(store.snapshot()) == {"a": {"n": 5}}
    store.apply(change([("b", V1, '{"n": 8}')], "upsert", 8))
    store.apply(change([("b", None, None)], "delete", 9))
    store.forget(20)
    store.apply(change([("b", None, None), ("a", None, None)], "delete", 10))
    marks = store._rows(sorted(store.log.head().buckets.values()))
    assert marks.count() == 0 and ids(store.snapshot()) == []


def test_a_stream_of_changes_and_unused_folders(spark, scratch, records):
    changes = records([(f"k{i}", V1, f'{{"n": {i}}}') for i in range(40)]).withColumn("op", F.lit("upsert")).withColumn("seq", F.lit(1).cast("bigint"))
    changes.repartition(4).write.parquet(f"{scratch}/in")
    store = BucketedCollection(spark, f"{scratch}/t", buckets=4, by_seq=True)
    cdc_sync(stream_records(spark, f"{scratch}/in", CHANGE_DDL, files_per_batch=1), store, f"{scratch}/ck").awaitTermination()
    assert len(ids(store.snapshot())) == 40 and store.version() == 4 and list(store.log.head().streams.values()) == [3]
    assert len(store.remove_unused(keep=1)) == 3 and len(ids(store.snapshot())) == 40


def test_a_large_bucket_is_merged_in_slices(spark, scratch, records, monkeypatch):
    """No task gets a whole bucket; before, each was one file by one task."""
    monkeypatch.setattr("embedlift.sinks.buckets.SLICE_ROWS", 100)
    store = BucketedCollection(spark, scratch, buckets=2)
    store.upsert(many(records, 1000, 1))
    store.upsert(many(records, 600, 2))
    store.delete(many(records, 50, 0))
    assert sorted((r["id"], r["n"]) for r in store.snapshot().selectExpr("id", "variant_get(metadata, '$.n', 'int') n").collect()) == [
        (f"k{i:04}", 2 if i < 600 else 1) for i in range(50, 1000)]
    files = [r[0] for r in store.snapshot(buckets=[0]).select(F.input_file_name()).distinct().collect()]
    assert len(files) >= 3
