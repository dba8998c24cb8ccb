import hashlib
import random

import pytest
from pyspark.sql import functions as F

from embedlift.llm import periods
from embedlift.llm.queries import QUERIES
from llm.fixtures import awkward, frame, sentence


def brute_runs(words):
    """Every period at every place, and the smallest period of a stretch by trying its divisors."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(6, 4 * q) and not any(q % d == 0 and all(words[k] == words[k + d] for k in range(start, start + length - d))
                                                   for d in range(1, q)):
                found.append((start, length, q))
            i = max(j, i + 1)
    return sorted(found)


def brute_kept(words, runs):
    return [w for i, w in enumerate(words) if not any(a + q <= i < a + m for a, m, q in runs)]


def row_of(doc_id, words):
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], periods.digest(runs),
            hashlib.sha256(b" ".join(brute_kept(words, runs))).hexdigest())


def test_runs_agree_with_brute_force():
    rng = random.Random(3)
    for _ in range(4000):
        n, letters = rng.randint(0, 45), rng.choice((1, 2, 2, 3, 4))
        words = [bytes([97 + rng.randrange(letters)]) for _ in range(n)]
        if n and rng.random() < 0.6:
            p, a = rng.randint(1, 7), rng.randrange(n)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = periods.periodic_runs(words)
        assert runs == brute_runs(words)
        assert periods.kept_words(words, runs) == brute_kept(words, runs)


def test_suffix_array_and_prefixes():
    import numpy as np

    rng = random.Random(4)
    for _ in range(300):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
        order, place = periods.suffix_array(np.array(s))
        assert [s[i:] for i in order] == sorted(s[i:] for i in range(len(s)))
        assert all(order[place[i]] == i for i in range(len(s)))
        shared = periods.common_prefixes(np.array(s), order, place)
        for at in range(1, len(s)):
            a, b = s[order[at - 1]:], s[order[at]:]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared.get(at, 0) == (same if same >= 3 else 0)


@pytest.mark.parametrize("words, runs", [
    ([b"a"] * 300_000, [(0, 300_000, 1)]),
    ([b"%d" % (i % 70_000) for i in range(300_000)], [(0, 300_000, 70_000)]),
    ([b"x", *[b"a", b"b"] * 100_000, b"a", b"y"], [(1, 200_001, 2)]),
])
def test_very_long_texts(words, runs):
    assert periods.periodic_runs(words) == runs


def test_nested_runs_and_word_borders():
    inner = ["k", "k", "k", "k", "k", "k", "z"]
    words = [w.encode() for w in inner * 4]
    assert periods.periodic_runs(words) == brute_runs(words) == sorted([(0, 28, 7)] + [(7 * i, 6, 1) for i in range(4)])
    assert periods.words_of("a\x1cb\x85c\xa0d e\x0bf") == ["a\x1cb\x85c\xa0d".encode(), b"e", b"f"]


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [*awkward()[:11], *awkward()[12:]]
    rows += [(100 + i, sentence(rng, rng.randint(0, 60)), "en", "s", None) for i in range(150)]
    rows += [(300 + i, " ".join(rng.choice("ab") for _ in range(60)), None, None, None) for i in range(20)]
    docs = frame(spark, rows).withColumn("Periodic", F.lit("theirs")).withColumn("runs", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"].run(spark, str(tmp_path)).collect()]
    want = [row_of(d, periods.words_of(periods.made_periodic(d, t))) for d, t, *_ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in got) > 15
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op12_periodic_runs"].run(spark, f"{tmp_path}/none").count() == 0


def test_known_periods_follow_the_rule():
    from zlib import crc32

    for doc_id in range(400):
        words = [f"w{i}" for i in range(37)]
        h = crc32(str(doc_id).encode())
        want = list(words)
        if h % 10 == 0:
            g = h // 10
            a = g % 37
            p = 1 + (37 - a) // (3 + g % 8)
            for i in range(a, 37):
                want[i] = words[a + (i - a) % p]
        assert periods.made_periodic(doc_id, "\n".join(words)).split() == want
    assert periods.made_periodic(None, "a b") == "a b" and periods.made_periodic(1, None) is None


def test_columns_stay(spark):
    docs = frame(spark, awkward()[:8]).withColumn("PERIODIC", F.lit("theirs"))
    found = periods.with_runs(docs)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "periodic"]
    assert [r.periodic.collapsed for r in found.where("doc_id < 3").orderBy("doc_id").collect()] == ["", "", ""]
