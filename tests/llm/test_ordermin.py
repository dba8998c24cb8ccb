import random

from pyspark.sql import functions as F

from embedlift.llm import links, ordermin
from embedlift.llm import similar as similar_module
from embedlift.llm.similar import words_of, similar
from llm.fixtures import SCHEMA, awkward, frame, sentence


def classes(rows):
    texts = [words_of(t) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if top(x) != top(y) and similar(texts[x], texts[y], ordermin.SIMILARITY) and (bool(texts[x]) == bool(texts[y])):
                group[max(top(x), top(y))] = min(top(x), top(y))
    ids = {}
    for x, (d, *_) in enumerate(rows):
        if d is not None:
            ids[top(x)] = min(ids.get(top(x), d), d)
    return sorted(((d is None, d or 0, ids.get(top(x))) for x, (d, *_) in enumerate(rows)), key=str)


def test_agrees_with_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        words = sentence(rng, rng.randint(60, 300)).split()
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 1)] = [rng.choice(["Edited", "new words"])]
            rows.append((len(rows) + 100, " ".join(copy), None, None, None))
    rng.shuffle(rows)
    rows += awkward()
    got = ordermin.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.class_id) for r in got), key=str) == classes(rows)


def test_order_matters():
    words = ordermin.hashed([f"w{i}" for i in range(400)])
    turned = ordermin.np.concatenate([words[200:], words[:200]])
    assert (ordermin.sketches(words) == ordermin.sketches(words.copy())).all()
    assert (ordermin.sketches(words) == ordermin.sketches(turned)).sum() < ordermin.SKETCHES // 2


def test_documents_that_differ_in_numbers_only_are_compared(spark):
    rng = random.Random(6)
    price_list = lambda: " ".join(f"item {rng.randint(1000, 9999)} costs {rng.randint(100, 999)}" for _ in range(60))
    lists = [price_list() for _ in range(4)]
    changed = lists[0].split()
    changed[101] = "5555"
    rows = [(i, t, None, None, None) for i, t in enumerate([*lists, lists[1].upper(), " ".join(changed)])]
    got = {r.doc_id: (r.class_id, r.class_size) for r in ordermin.near_duplicates(frame(spark, rows)).collect()}
    assert got == {0: (0, 2), 1: (1, 2), 2: (2, 1), 3: (3, 1), 4: (1, 2), 5: (0, 2)}


def test_empty_table(spark):
    assert ordermin.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_are_components_without_all_pairs(spark):
    asked = []

    def verify(pairs):
        rows = pairs.collect()
        asked.extend((r.a, r.b) for r in rows)
        return spark.createDataFrame([(r.a, r.b) for r in rows if r.a % 7 == r.b % 7 or abs(r.a - r.b) == 1000], "a long, b long")

    dense = [(1, i) for i in range(0, 700, 7)]
    mixed = [(2, i) for i in range(701, 741)]
    got = {r.id: r.component for r in links.linked(spark.createDataFrame([*dense, *mixed], "bucket long, id long"), verify).collect()}
    assert all(got[i] == 0 for _, i in dense)
    assert all(got[i] == min(j for _, j in mixed if j % 7 == i % 7) for _, i in mixed)
    assert len(set(asked)) == len(asked) and sum(a < 700 and b < 700 for a, b in asked) == 99


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)]
    got = {r.id: r.component for r in links.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_texts_with_one_long_passage_are_compared_in_columns():
    rng = random.Random(11)
    passage = [rng.randrange(500) for _ in range(240)]
    texts = []
    for _ in range(90):
        words = passage + [rng.randrange(500) for _ in range(rng.randint(0, 160))]
        for _ in range(rng.randint(0, 30)):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = [rng.randrange(500)] * rng.randint(0, 1)
        texts.append(words)
    items = ordermin.pa.array([ordermin.np.array(w, "uint32").tobytes() for w in [*texts, []]], ordermin.pa.binary())
    a, b = ordermin.np.triu_indices(len(items), 1)
    alone = []
    kept, similar_module.distance_within = similar_module.distance_within, lambda *x: alone.append(x) or kept(*x)
    try:
        got = ordermin.Texts(items).linked(a, b)
    finally:
        similar_module.distance_within = kept
    assert got.tolist() == [similar([*texts, []][x], [*texts, []][y], ordermin.SIMILARITY) for x, y in zip(a.tolist(), b.tolist())]
    assert 0 < got.sum() < len(a) and len(alone) < len(a) // 10


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """At 10,000 long texts a batch the executor of the pipeline took more than its memory."""
    sketched = ordermin._sketched

    def counted(batches):
        def small(batches):
            for batch in batches:
                assert batch.num_rows <= 1000, batch.num_rows
                yield batch
        yield from sketched(small(batches))

    monkeypatch.setattr(ordermin, "_sketched", counted)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    assert ordermin.near_duplicates(docs).count() == 3000
    assert spark.conf.get(key) == before
