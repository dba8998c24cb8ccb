import hashlib
import random
from collections import defaultdict
from heapq import heappop, heappush
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from embedlift.llm import repair
from embedlift.llm.queries import QUERIES
from llm.fixtures import frame

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
SPACE = " \t\n\x0b\x0c\r"


def brute(symbols, source=0, ends=(0, 3)):
    """Plain search over (cost, audit) of whole paths, every node left with its least only by exhausting them in order."""
    n, heap, seen = len(symbols), [(0, "", 0, source)], {}
    best = []
    while heap:
        cost, audit, i, state = heappop(heap)
        if best and cost > best[0][0]:
            break
        if i == n and state in ends:
            best.append((cost, audit))
        if cost > seen.setdefault((i, state), cost) or audit.count("I") > len(symbols) + 3:
            continue
        moves = []
        if i < n:
            initial, cut, gone = symbols[i].lower(), symbols[i] in "SUAX", symbols[i] in "0123"
            moves.append(("D", 2, i + 1, state))
            if not gone:
                for (a, x), b in repair._NEXT.items():
                    if a == state and x == initial:
                        moves.append(("K", 5 * cut, i + 1, b))
                    if a == state and x in "ua":
                        moves.append(("R", 1 + 5 * cut, i + 1, b))
        moves += [("I", 5, i, b) for (a, x), b in repair._NEXT.items() if a == state and x in "ua"]
        for letter, more, j, b in moves:
            heappush(heap, (cost + more, audit + letter, j, b))
    return min(best) if best else None


def brute_conversation(rows):
    """The contract, row by row, with a table over all prefixes: ``rows`` of one conversation before damage."""
    after = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
        after += [(turn, "user" if h == 4 else role, text)] * (1 + (h == 3))
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, *_ in after if t is not None]
    seen, faults, symbols = set(), [], ""
    for _, role, text in after:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        x = role[:1] if role[:1] in ("s", "u", "a") else "x"
        symbols += x.upper() if fault == "truncated" else "0123"["suax".index(x)] if fault else x
    initials = [r[:1] for _, r, _ in after]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = brute(symbols)
    state, at, lines = 0, 0, []
    for letter in audit:
        row = after[at] if letter != "I" else None
        at += letter != "I"
        if letter == "D":
            continue
        role = row[1] if letter == "K" else "assistant" if state == 2 else "user"
        state = repair._NEXT[state, role[:1]]
        lines.append(f"{role}:{row[2] if row else ''}")
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_symbols(rng, n):
    return "".join(rng.choice("uauauasxUASX0123") for _ in range(n))


def test_search_agrees_with_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        symbols, source, target = random_symbols(rng, rng.randint(0, 6)), rng.randrange(4), rng.randrange(4)
        assert repair.cheapest(symbols, source, target) == brute(symbols, source, (target,)), (symbols, source, target)


def test_blocks_joined_are_the_whole():
    rng = random.Random(2)
    for _ in range(300):
        symbols = random_symbols(rng, rng.randint(1, 30))
        cuts = sorted({0, len(symbols), *(rng.randrange(len(symbols)) for _ in range(3))})
        blocks = [symbols[a:b] for a, b in zip(cuts, cuts[1:])]
        cost, audit, parts = repair.joined([repair.between_states(b) for b in blocks])
        whole = min(way for end in repair.ENDS if (way := repair.cheapest(symbols, repair.START, end)))
        assert (cost, audit) == whole and "".join(a for _, a in parts) == audit


def conversations():
    rng = random.Random(3)
    texts = ["Yes.", "No!", "and then", "Why? ", "", " \t", "Yes.", "a\x85", None, "End.\x0b"]
    rows = []
    for conv in range(220):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["system"] if turn == 0 and rng.random() < 0.3 else ["user", "assistant", ("user", "assistant")[turn % 2]] * 3 + ["tool", "", None, "u", "System"])
            rows.append((conv, turn + rng.choice((0, 0, 0, 2)), role, rng.choice(texts) if rng.random() < 0.5 else f"Text {conv} {turn}."))
    rows += [(500, None, "user", "Hi."), (500, None, "assistant", "Hello."), (None, 1, "user", "Null id."), (None, None, None, None), (None, 1, "user", "Null id."),
             (501, 5, "assistant", "same."), (501, 5, "assistant", "same."), (501, 5, "user", "tie"), (501, 5, "user", "tie.")]
    dropped = next(c for c in range(1000, 5000) if crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Gone.")]


def test_query_equals_brute_force(spark, tmp_path):
    rows = conversations()
    given = frame(spark, rows, SCHEMA).withColumn("pos", F.lit("x")).withColumn("Symbol", F.lit(1)).withColumn("audit", F.lit(2))
    given.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_turn_repair"].run(spark, str(tmp_path)).collect()}
    by = defaultdict(list)
    for row in rows:
        by[row[0]].append(row)
    assert set(got) == set(by)
    for conv, its in by.items():
        assert got[conv] == brute_conversation(its), (conv, its)
    assert got[rows[-1][0]] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    given.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert QUERIES["op11_turn_repair"].run(spark, f"{tmp_path}/none").count() == 0


def test_long_conversation_over_many_blocks_and_tasks(spark):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", f"t{i}.", "again.", "cut off"])) for i in range(3000)]
    rows += [(2, 0, "user", "x" * 1_000_000 + "."), (2, 1, "assistant", "y " * 400_000), (0, 0, "user", "Hi.")]
    planned, kept = repair.repair(frame(spark, rows, SCHEMA).repartition(3))
    plan = {r.conv_id: r for r in planned.collect()}
    assert len(plan[1].parts) >= 3000 // repair.BLOCK
    symbols, seen = "", set()
    for _, _, role, text in rows[:3000]:
        symbols += "0123"["suax".index(role[0])] if (role, text) in seen else role[0].upper() if text == "cut off" else role[0]
        seen.add((role, text))
    want = min(way for end in repair.ENDS if (way := repair.cheapest(symbols, repair.START, end)))
    assert (plan[1].cost, plan[1].audit) == want
    assert (plan[2].cost, plan[2].audit, plan[2].truncated) == (4, "DD", 1)
    lines = [r.role[0] for r in kept.where("conv_id = 1").orderBy("block", "place").collect()]
    assert lines == ["u", "a"] * (len(lines) // 2)
    digest = {r.conv_id: r.repaired_sha256 for r in repair.digests(kept).collect()}
    text = "\n".join(f"{r.role}:{r.text}" for r in kept.where("conv_id = 1").orderBy("block", "place").collect())
    assert digest[1] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("symbols, want", [("", (0, "")), ("ua", (0, "KK")), ("a", (2, "D")), ("sua", (0, "KKK")), ("su", (2, "RR")), ("uu", (1, "KR"))])
def test_small_cases(symbols, want):
    assert min(way for end in repair.ENDS if (way := repair.cheapest(symbols, repair.START, end))) == want
