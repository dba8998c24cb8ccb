import re
from collections import Counter

import random
import time

from pyspark.sql import functions as F

from embedlift.llm import decontaminate
from llm.fixtures import SCHEMA, awkward, frame, sentence

ITEM = "item_id long, text string"


def shingles(words):
    k = min(5, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def brute(rows, items):
    fold = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = set()
    for d, t, *_ in rows:
        words = fold(t)
        for i, it in items:
            item = fold(it)
            for at in range(max(1, len(words) - len(item) + 1)) if item and words else ():
                a, b = shingles(words[at:at + len(item)]), shingles(item)
                if sum((a & b).values()) / sum((a | b).values()) >= 0.8:
                    out.add((d, i))
    return out


def test_agrees_with_brute_force(spark):
    rng = random.Random(9)
    items = [(i, sentence(rng, n)) for i, n in enumerate([1, 3, 5, 6, 15, 30, 45, 60, 60])] + [(90, None), (91, "..."), (92, awkward()[4][1])]
    rows = []
    for d in range(60):
        words = sentence(rng, rng.randint(0, 40)).split()
        if d % 2:
            item = rng.choice(items[2:9])[1].split()
            if d % 3 == 0:
                item[rng.choice([0, -1, len(item) // 2])] = "other"
            if d % 5 == 0:
                item.insert(len(item) // 2, "more")
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "!"]) for w in item]
        rows.append((d, " ".join(words), None, None, None))
    rows += awkward()
    benchmark = spark.createDataFrame(items, ITEM).withColumn("doc_id", F.lit("theirs"))
    docs = frame(spark, rows).withColumn("item_id", F.lit("theirs"))
    found = decontaminate.leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute(rows, items)
    assert all(r.similarity >= 0.8 and r.distance <= decontaminate.RADIUS for r in found)
    clean = {r.doc_id for r in decontaminate.decontaminated(docs, benchmark).collect()}
    assert clean == {d for d, *_ in rows} - {d for d, _ in brute(rows, items)}


def test_fingerprint_is_the_majority_of_bits(spark):
    row = spark.createDataFrame([(["a", "b", "c", "d"],), (["x"],)], "w array<string>").select(
        decontaminate._fingerprint(F.col("w")).alias("f"), F.transform("w", lambda v: F.xxhash64(v)).alias("h")).collect()
    for r in row:
        want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in r.h) > len(r.h))
        assert r.f & ((1 << 64) - 1) == want


def test_no_python_on_the_main_path(spark, scratch):
    docs, items = frame(spark, awkward()), spark.createDataFrame([(1, "some words to look for here")], ITEM)
    plan = decontaminate.leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_empty_tables(spark):
    docs, items = frame(spark, awkward()), spark.createDataFrame([(1, "a b c d e f")], ITEM)
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.decontaminated(docs, items.limit(0)).count() == len(awkward())


def test_similarity_of_many_shingles_takes_no_square(spark):
    rng = random.Random(3)
    pairs = [([rng.randrange(n) for _ in range(rng.randint(1, 12))], [rng.randrange(n) for _ in range(rng.randint(1, 12))]) for n in (3, 12, 500) for _ in range(60)]
    pairs += [(list(range(12_000)), list(range(6_000, 18_000))), (list(range(12_000)), [5] * 6_000 + list(range(6_000)))]
    began = time.time()
    got = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<long>, b array<long>").select("i", decontaminate._weighted_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert time.time() - began < 10
    for i, s in got:
        a, b = map(Counter, pairs[i])
        assert abs(s - sum((a & b).values()) / sum((a | b).values())) < 1e-12
