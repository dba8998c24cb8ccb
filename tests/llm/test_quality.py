from pyspark.sql import functions as F

from embedlift.llm import quality
from llm.fixtures import awkward, frame


def brute_repeats(words):
    covered = set()
    for i in range(len(words) - 2):
        if any(words[i:i + 3] == words[j:j + 3] for j in range(len(words) - 2) if j != i):
            covered |= {i, i + 1, i + 2}
    return len(covered)


def test_measurements_agree_with_brute_force():
    for text in ["a b c a b c", "a a a a", "a b c d", "x y z w x y z", "", "l1\nl1\n \nl2\nl1", "#a *b $c"]:
        got = quality.measured(text)
        words = text.split()
        assert got["n_words"] == len(words)
        assert got["n_repeat_words"] == brute_repeats(words)
    assert quality.measured("l1\nl1\n \nl2\nl1")["n_dup_lines"] == 2
    assert quality.measured("#a *b $c")["n_symbols"] == 3
    assert quality.measured("a\xa0b\x1cc")["n_words"] == 1
    assert quality.measured(None)["n_words"] == 0


def test_awkward_rows_and_clashing_columns(spark):
    docs = frame(spark, awkward()).withColumn("Quality", F.lit("theirs")).withColumn("n_words", F.lit("x"))
    rows = quality.ledger(docs).collect()
    assert len(rows) == len(awkward())
    by = {r.doc_id: r for r in rows}
    assert by[0].quality.n_words == 0 and by[0].quality.bits & 1 and by[0].n_words == "x"
    assert quality.ledger(docs.limit(0)).count() == 0


def test_ablation_counts_by_bits(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(["a b", "# " * 60, "good word text here now " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))])]
    ledger = quality.ledger(frame(spark, rows))
    policy = quality.POLICIES["v2"]
    bits = [r.quality.bits for r in ledger.collect()]
    for r in quality.ablations(ledger, "v2").collect():
        own = quality.mask((r.rule,))
        whole = quality.mask(policy)
        assert r.n_failed == sum(bool(b & own) for b in bits)
        assert r.n_only_this == sum((b & whole) == own for b in bits)
        assert r.n_rejected == sum(bool(b & whole) for b in bits)
    assert [r.kept for r in ledger.select(quality.accepts("v2").alias("kept")).collect()] == [False, False, True]
