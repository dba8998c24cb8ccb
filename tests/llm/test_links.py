import random

from pyspark.sql import functions as F

from embedlift.llm import links


def verified_by(seen, like):
    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where(like)
    return verify


def grouped(found):
    groups = {}
    for r in found.collect():
        groups.setdefault(r["component"], set()).add(r["id"])
    return sorted(map(sorted, groups.values()))


def test_a_bucket_of_unlike_members_costs_a_fixed_number_of_pairs_each(spark):
    buckets = spark.range(10_000).select(F.lit(1).cast("long").alias("bucket"), F.col("id"))
    seen = []
    assert links.linked(buckets, verified_by(seen, "false")).count() == 0
    assert sum(seen) < 40 * 10_000


def test_a_bucket_of_copies_costs_one_pair_each(spark):
    buckets = spark.range(5000).select(F.explode(F.expr("array(1L, 2L)")).alias("bucket"), F.col("id"))
    seen = []
    assert grouped(links.linked(buckets, verified_by(seen, "true"))) == [list(range(5000))]
    assert sum(seen) == 4999


def test_small_buckets_are_compared_in_full(spark):
    rng = random.Random(1)
    rows = [(b, rng.randrange(120)) for b in range(30) for _ in range(rng.randint(1, 16))]
    like = "a % 7 = b % 7 and abs(a - b) < 60"
    want = {}
    for x, y in {(min(a, b), max(a, b)) for k, a in rows for j, b in rows if k == j and a != b}:
        if x % 7 == y % 7 and y - x < 60:
            want.setdefault(x, set()).add(y)
            want.setdefault(y, set()).add(x)
    left, parts = set(want), []
    while left:
        part, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            part.add(x)
            todo += want[x] - part
        left -= part
        parts.append(sorted(part))
    found = links.linked(spark.createDataFrame(rows, "bucket long, id long"), verified_by([], like))
    assert grouped(found) == sorted(parts)


def test_pairs_in_a_large_bucket_are_found_by_a_second_one(spark):
    """2,000 unlike pairs share one frequent bucket and, in fifties, a second and a third."""
    ids = spark.range(4000)
    pair = F.expr("id div 2")
    buckets = ids.select("id", F.explode(F.array(F.lit(1).cast("long"), 10 + pair % 40, 100 + pair % 41)).alias("bucket"))
    seen = []
    found = grouped(links.linked(buckets, verified_by(seen, "a div 2 = b div 2")))
    assert found == [[2 * i, 2 * i + 1] for i in range(2000)]
    assert sum(seen) < 600_000
