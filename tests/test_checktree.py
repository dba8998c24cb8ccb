import pytest
from pyspark.sql import functions as F

from embedlift.operators.checktree import ChecksumTree, difference, leaf_sums
from embedlift.sinks.buckets import BucketedCollection

V1 = [1.0]


def many(records, numbers, value):
    return records([(f"k{i:04}", V1, f'{{"n": {value}}}') for i in numbers])


def statuses(found):
    return {r["id"]: r.status for r in found.records.collect()}


def test_changed_ids_cost_their_leaves_only(spark, records, scratch):
    store = BucketedCollection(spark, scratch, buckets=16)
    store.upsert(many(records, range(400), 1), unique=True)
    tree = ChecksumTree(store, digits=2)
    before = tree.root()
    assert before[0] == 400 and len(tree.hashed) == len(tree.nodes())
    tree.hashed.clear()
    changed = many(records, [3, 77, 205], 2)
    store.upsert(changed, unique=True)
    touched = {r[0] for r in changed.select(store.bucket_of(F.col("id"))).distinct().collect()}
    found = difference(tree, tree, 1, 2)
    assert set(found.buckets) == touched == set(tree.hashed)
    assert found.leaves.count() <= 3 and statuses(found) == dict.fromkeys(("k0003", "k0077", "k0205"), "changed")
    # a new object reads the saved trees, a rollback has the sums of the version it points back to
    again = ChecksumTree(store, digits=2)
    store.rollback_to(1)
    assert again.root() == before and again.root(2) == tree.root(2) != before
    assert set(again.hashed) <= touched and difference(again, again, 1, 3).buckets == []


def test_two_collections(spark, records, scratch):
    sides = [BucketedCollection(spark, f"{scratch}/{name}", buckets=4) for name in "ab"]
    sides[0].upsert(many(records, range(60), 1), unique=True)
    sides[1].upsert(many(records, range(2, 61), 1).repartition(3), unique=True)
    sides[1].upsert(many(records, [9], 5), unique=True)
    trees = [ChecksumTree(s, digits=1) for s in sides]
    assert statuses(difference(*trees)) == {"k0000": "missing_in_target", "k0001": "missing_in_target", "k0060": "extra_in_target", "k0009": "changed"}
    for s in sides:
        s.upsert(many(records, range(61), 7), unique=True)
    found = difference(*trees)
    assert trees[0].root() == trees[1].root() and found.buckets == [] and found.records.isEmpty() and found.leaves.isEmpty()
    with pytest.raises(ValueError):
        difference(trees[0], ChecksumTree(sides[1], digits=2))
    with pytest.raises(ValueError):
        ChecksumTree(sides[0], row_hash=F.xxhash64("id"))


def test_empty_deleted_and_null(spark, records, scratch):
    empty, full = (BucketedCollection(spark, f"{scratch}/{name}", buckets=2) for name in ("empty", "full"))
    trees = ChecksumTree(empty), ChecksumTree(full)
    assert trees[0].root() == (0, 0) and difference(*trees).records.isEmpty()
    rows = records([("a", V1, "{}"), (None, V1, "{}")])
    full.upsert(rows, unique=True)
    assert statuses(difference(*trees)) == {"a": "extra_in_target", None: "extra_in_target"}
    full.delete(rows)
    assert leaf_sums(rows, F.lit(0)).agg(F.sum("n_records")).first()[0] == 2
    marks = BucketedCollection(spark, f"{scratch}/marks", buckets=2, by_seq=True)
    marks.apply(rows.filter("id = 'a'").withColumn("op", F.lit("delete")).withColumn("seq", F.lit(5)))
    assert ChecksumTree(marks).root() == (0, 0)


def test_a_hash_of_its_own(spark, records, scratch):
    store = BucketedCollection(spark, scratch, buckets=2)
    store.upsert(many(records, range(20), 1), unique=True)
    store.upsert(many(records, range(10), 2), unique=True)
    by_id = ChecksumTree(store, row_hash=F.xxhash64("id"), name="ids")
    assert difference(by_id, by_id, 1, 2).records.isEmpty() and difference(ChecksumTree(store), ChecksumTree(store), 1, 2).records.count() == 10
