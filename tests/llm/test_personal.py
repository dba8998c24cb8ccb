import hashlib
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from embedlift.llm import personal
from embedlift.llm.queries import QUERIES
from llm.fixtures import awkward, frame, sentence

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(digits)):
        total += (2 * d - 9 if d > 4 else 2 * d) if i % 2 else d
    return total % 10 == 0


def brute_base(text):
    """The patterns as they stand."""
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split(".")) or kind == 2 and 12 <= len(digits) <= 19 and plain_luhn(digits) \
                    or kind == 3 and 9 <= len(digits) <= 15:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def listed(spans):
    return ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def model():
    return personal.fit(personal.labelled([]))


def texts(rng, n):
    """Random strings over what the patterns look at, and forms of each kind side by side."""
    forms = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "10.0.0.255.7", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+49", "+ 1", "0001.02.3.4",
             "jane at mail dot com", "(415) 555-2671", "é", "٣٤", "\U0001f44d", "2024-05-17"]
    for _ in range(n):
        if rng.random() < 0.5:
            yield "".join(rng.choice("0123456789012345+-. ()@ab%_\n٣") for _ in range(rng.randint(0, 60)))
        else:
            yield rng.choice(("", " ", " ", ", ")).join(rng.choice(forms) for _ in range(rng.randint(0, 6)))


def test_base_equals_the_patterns():
    rng = random.Random(1)
    for text in texts(rng, 20000):
        assert personal.base_spans(text) == brute_base(text), text


def test_held_out_accuracy(model):
    hits = extra = missed = 0
    for text, gold in personal.labelled(["house water stone green light seven table north"], 800, seed=1234):
        base, found = personal.found_spans(text, model)
        assert base == brute_base(text)
        hits, extra, missed = hits + len(gold & set(found)), extra + len(set(found) - gold), missed + len(gold - set(found))
    assert hits > 400 and hits / (hits + extra) > 0.97 and hits / (hits + missed) > 0.95


def test_decoding_and_sums_agree_with_all_segmentations(model):
    """Every subset of candidates that do not overlap, scored one by one."""
    rng, seen = random.Random(2), 0
    for text, gold in personal.labelled([], 400, seed=5):
        for island in personal.islands(personal.candidates(text, brute_base(text))):
            options = [(c.start, k, c.end, s) for c in island for k, s in zip(c.kinds, model.score(c))]
            if len(options) > 9:
                continue
            seen += 1
            ways = []
            for size in range(len(options) + 1):
                for some in itertools.combinations(sorted(options), size):
                    if all(a[2] <= b[0] for a, b in zip(some, some[1:])):
                        score = sum(o[3] for o in some)
                        for i, o in enumerate(some):
                            before = some[i - 1][1] + 1 if i and some[i - 1][2] == o[0] else 0
                            score += model.touching[before][o[1]]
                        ways.append((score, some))
            best = max(ways, key=lambda w: w[0] - personal.MARGIN * len(w[1]))[1]
            assert model.best(island) == [o[:3] for o in best]
            whole = math.log(sum(math.exp(w) for w, _ in ways))
            mine = {g for g in gold if any(g == o[:3] for o in options)}
            slopes, _ = model.gradient(island, mine)
            for c in island[:2]:
                for k in c.kinds:
                    share = sum(math.exp(w - whole) for w, some in ways for o in some if o[1] == k
                                for d in island if (d.start, d.end) == (o[0], o[2]) and "any number" in d.features)
                    if "any number" in c.features:
                        want = sum(g[1] == k for g in mine if any((d.start, d.end) == (g[0], g[2]) for d in island)) - share
                        assert abs(slopes["any number"][k] - want) < 1e-6
    assert seen > 60


def test_what_the_field_adds_and_leaves(model):
    found = lambda t: [(personal.KINDS[k], t[a:b]) for a, k, b in personal.found_spans(t, model)[1]]
    assert found("Write to jane.doe [at] mail [dot] com today") == [("email", "jane.doe [at] mail [dot] com")]
    assert found("call (415) 555-2671 now") == [("phone", "(415) 555-2671")]
    assert found("host 10[.]0[.]3[.]7 up") == [("ip", "10[.]0[.]3[.]7")]
    assert found("7536784127813050 4845168114407329") == [("card", "7536784127813050"), ("card", "4845168114407329")]
    for clean in ("on 2024-05-17 at noon", "we met at the house. The end", "pages 12 13 14 15 16", "isbn 978-3-16-148410-0", "1,234,567.89", "24be64439e3e49cf46b2d7c90f3602a3"):
        assert found(clean) == []


@pytest.mark.parametrize("text", ["1" * 500_000, "a" * 500_000 + "@", "1 " * 60_000, "+1((((" * 50_000, "." * 300_000 + "@x", "a.b" * 100_000 + "@x.yz", "- " * 200_000])
def test_very_long_texts(model, text):
    assert personal.found_spans(text, model)[1] == []


def test_query_equals_the_patterns(spark, tmp_path):
    rng = random.Random(9)
    rows = [*awkward(), *((100 + i, t, "en", "s", None) for i, t in enumerate(texts(rng, 200)))]
    rows += [(400, sentence(rng, 30) + " 7536784127813050 4845168114407329 " + sentence(rng, 20), None, None, None)]
    docs = frame(spark, rows).withColumn("Personal", F.lit("theirs")).withColumn("spans", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_personal_data"].run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = sorted(map(tuple, got.collect()), key=repr)
    fitted = personal.train(docs)
    want = []
    for d, t, *_ in rows:
        base = brute_base(t or "")
        want.append((d, *[sum(k == kind for _, k, _ in base) for kind in range(4)], hashlib.sha256(listed(base).encode()).hexdigest(),
                     listed(sorted(base + personal.found_spans(t, fitted)[1]))))
    assert got == sorted(want, key=repr)
    assert any(r[-1].count("card") == 2 for r in got if r[0] == 400)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op13_personal_data"].run(spark, f"{tmp_path}/none").count() == 0
