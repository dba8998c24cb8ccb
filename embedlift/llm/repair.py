"""Repair of the turn structure of conversations by the cheapest edits.

Rows of a conversation in order are a string of symbols (initial of the role and fault), and the
roles that a sound conversation has, ``(s?(ua)+)?``, are an automaton of four states. Edits are
edges of the lattice of (rows consumed, state): Keep 0, Rerole to user or assistant 1, Delete 2,
Insert an empty user or assistant turn 5; a truncated row that stays adds 5, a blank or repeated
row can only be deleted. The cheapest path is found by Dijkstra's algorithm from both ends: heaps
forward and in reverse, nodes of equal cost in the order in which edges without cost lead, each
node with the least audit (letters of the edits) among its cheapest. When no cheaper crossing is
left, all crossings of equal cost are compared and the ASCII-least audit is taken. Of two audits
of equal cost between the same nodes none begins the other, so least parts make least wholes.

A conversation can have any number of rows: all rows are sorted by ranges of (conversation, turn,
role, text) and numbered; blocks of at most ``BLOCK`` of them are searched apart, from every
state to every state, and one row per conversation joins the blocks. What one task holds of a
conversation is its audit, up to eleven times, never its texts.

Defined cases: rows are taken by turn, nulls first; ties by role, then the first 64 code points of
the text, then its hash. A null role or text is one space, so a null text is blank. A null conv_id
is a conversation. A role counts by its first character; an empty one has none and fits nowhere.
Rows that are equal in everything stay as many as they are. Other columns of the input, whatever
they are called, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from embedlift.workspace import write_once

BLOCK = 256
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
CUT = 5
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_ROLES = {USER: "user", ASSISTANT: "assistant"}   # the role an inserted or reroled row has on entering a state
#: Symbols by initial: as it is, truncated, to be deleted. The last initial stands for all others.
INITIALS, TRUNCATED, FAULTY = "suax", "SUAX", "0123"
_TO_INITIAL = str.maketrans(TRUNCATED + FAULTY, INITIALS * 2)
_SOUND_PAIRS = ("su", "ua", "au")
_SPACE = r"\x20\x09-\x0D"


def _edges(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that consume a row."""
    edges = [("D", DELETE, state)]
    if symbol not in FAULTY:
        cut, initial = CUT * (symbol in TRUNCATED), symbol.lower()
        if (state, initial) in _NEXT:
            edges.append(("K", KEEP + cut, _NEXT[state, initial]))
        edges.append(("R", REROLE + cut, _INSERTED[state]))
    return edges


_INSERTED = {state: ASSISTANT if state == USER else USER for state in range(4)}
_STEP = {symbol: [_edges(symbol, state) for state in range(4)] for symbol in INITIALS + TRUNCATED + FAULTY}
_BACK = {symbol: [[(letter, cost, a) for a in range(4) for letter, cost, b in edges[a] if b == to] for to in range(4)]
         for symbol, edges in _STEP.items()}
_INSERTED_BEFORE = [[a for a, b in _INSERTED.items() if b == to] for to in range(4)]


def cheapest(symbols: str, source: int, target: int) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of all rows from one state to another; None if there are none."""
    n = len(symbols)
    labels = ({(0, source): (0, "")}, {(n, target): (0, "")})
    heaps = ([(0, 0, source)], [(0, -n, target)])
    done: tuple[set, set] = (set(), set())
    best = None

    def ahead(i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
        if i < n:
            for letter, cost, to in _STEP[symbols[i]][state]:
                yield letter, cost, (i + 1, to)
        yield "I", INSERT, (i, _INSERTED[state])

    def back(i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
        if i:
            for letter, cost, before in _BACK[symbols[i - 1]][state]:
                yield letter, cost, (i - 1, before)
        for before in _INSERTED_BEFORE[state]:
            yield "I", INSERT, (i, before)

    def tops() -> list[int] | None:
        costs = []
        for side in (0, 1):
            while heaps[side] and (side and -heaps[side][0][1] or heaps[side][0][1], heaps[side][0][2]) in done[side]:
                heappop(heaps[side])
            if not heaps[side]:
                return None
            costs.append(heaps[side][0][0])
        return costs

    while (least := tops()) and (best is None or sum(least) <= best):
        side = 0 if least[0] <= least[1] else 1
        cost, i, state = heappop(heaps[side])
        node = (-i if side else i, state)
        done[side].add(node)
        label = labels[side][node][1]
        if node in done[1 - side]:
            whole = cost + labels[1 - side][node][0]
            best = whole if best is None else min(best, whole)
        for letter, more, other in (back if side else ahead)(*node):
            new = (cost + more, letter + label if side else label + letter)
            if other not in labels[side] or new < labels[side][other]:
                labels[side][other] = new
                heappush(heaps[side], (new[0], -other[0] if side else other[0], other[1]))
            if other in done[1 - side]:
                whole = new[0] + labels[1 - side][other][0]
                best = whole if best is None else min(best, whole)
    if best is None:
        return None
    crossings = []
    for node in done[0]:
        cost, label = labels[0][node]
        if node in done[1] and cost + labels[1][node][0] == best:
            crossings.append(label + labels[1][node][1])
        for letter, more, other in ahead(*node):
            if other in done[1] and cost + more + labels[1][other][0] == best:
                crossings.append(label + letter + labels[1][other][1])
    return best, min(crossings)


@lru_cache(20_000)
def between_states(symbols: str) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit) of a block, for all pairs that edits lead between."""
    pairs = ((a, b) for a in range(4) for b in range(4) if b != START or a == START)
    found = ((a, b, cheapest(symbols, a, b)) for a, b in pairs)
    return tuple((a, b, *way) for a, b, way in found if way)


def joined(blocks: list) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost, audit, and per block the state before it and its audit, from what ``between_states`` found."""
    ways: dict[int, tuple[int, str]] = {START: (0, "")}
    back: list[dict[int, tuple[int, str]]] = []
    for block in blocks:
        after: dict[int, tuple[int, str]] = {}
        came: dict[int, tuple[int, str]] = {}
        for a, b, cost, audit in block:
            if a in ways:
                new = (ways[a][0] + cost, ways[a][1] + audit)
                if b not in after or new < after[b]:
                    after[b], came[b] = new, (a, audit)
        ways = after
        back.append(came)
    state = min((s for s in ENDS if s in ways), key=ways.__getitem__)
    cost, audit = ways[state]
    parts = []
    for came in reversed(back):
        parts.append(came[state])
        state = came[state][0]
    return cost, audit, parts[::-1]


def edited(symbols: str, state: int, audit: str, first: int) -> list[dict]:
    """The rows that a block's audit leaves: place in the audit, number of the row (negative: inserted), edit, new role."""
    kept, at = [], 0
    for place, letter in enumerate(audit):
        row, role = -1 - first - place, None   # a number of its own, so that no join meets all inserted rows in one task
        if letter != "I":
            row, at = first + at, at + 1
        if letter == "D":
            continue
        if letter == "K":
            state = _NEXT[state, symbols[at - 1].lower()]
        else:
            state = _INSERTED[state]
            role = _ROLES[state]
        kept.append({"place": place, "pos": row, "edit": letter, "new_role": role})
    return kept


def misplaced(initials: str) -> int:
    """Neighbours whose initials may not follow one another."""
    return sum(a + b not in _SOUND_PAIRS for a, b in zip(initials, initials[1:]))


_WAY = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_WAY_TYPE = StructType([StructField("before", IntegerType()), StructField("after", IntegerType()),
                        StructField("cost", LongType()), StructField("audit", StringType())])
_PART = pa.struct([("first", pa.int64()), ("symbols", pa.string()), ("state", pa.int32()), ("audit", pa.string())])
_PART_TYPE = StructType([StructField("first", LongType()), StructField("symbols", StringType()),
                         StructField("state", IntegerType()), StructField("audit", StringType())])
_PLAN = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("parts", pa.list_(_PART))])
_PLAN_TYPE = StructType([StructField("cost", LongType()), StructField("audit", StringType()), StructField("illegal", LongType()),
                         StructField("parts", ArrayType(_PART_TYPE))])
_EDIT = pa.struct([("place", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("new_role", pa.string())])
_EDIT_TYPE = StructType([StructField("place", LongType()), StructField("pos", LongType()), StructField("edit", StringType()),
                         StructField("new_role", StringType())])


@F.arrow_udf(ArrayType(_WAY_TYPE))
def _ways(symbols: pa.Array) -> pa.Array:
    names = ("before", "after", "cost", "audit")
    return pa.array(([dict(zip(names, way)) for way in between_states(s.as_py())] for s in symbols), pa.list_(_WAY), size=len(symbols))


def _plan_of(blocks: list[dict]) -> dict:
    cost, audit, parts = joined([[(w["before"], w["after"], w["cost"], w["audit"]) for w in b["ways"]] for b in blocks])
    return {"cost": cost, "audit": audit, "illegal": misplaced("".join(b["symbols"] for b in blocks).translate(_TO_INITIAL)),
            "parts": [{"first": b["first"], "symbols": b["symbols"], "state": s, "audit": a} for b, (s, a) in zip(blocks, parts)]}


@F.arrow_udf(_PLAN_TYPE)
def _plan(blocks: pa.Array) -> pa.Array:
    return pa.array((_plan_of(b.as_py()) for b in blocks), _PLAN, size=len(blocks))


@F.arrow_udf(ArrayType(_EDIT_TYPE))
def _edits(symbols: pa.Array, states: pa.Array, audits: pa.Array, firsts: pa.Array) -> pa.Array:
    given = zip(*(x.to_pylist() for x in (symbols, states, audits, firsts)))
    return pa.array([edited(*row) for row in given], pa.list_(_EDIT))


_ways, _plan, _edits = (f.asNondeterministic() for f in (_ways, _plan, _edits))  # each is run once


def numbered(rows: DataFrame) -> DataFrame:
    """All rows with ``pos``, which follows the order of (conversation, turn, role, text); written once."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("text", "role"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text)
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"), "copy"]
    rows = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return write_once(rows.drop("copy").withColumn("pos", F.monotonically_increasing_id()), "turns")


def described(rows: DataFrame) -> DataFrame:
    """``pos, conv_id, turn, fault, symbol`` of rows as :func:`numbered` gives them."""
    firsts = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("d")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    own = rows.select("pos", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"),
                      (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"), (~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")).alias("cut"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated"))
    found = own.join(firsts, "pos", "left").withColumn("fault", fault)
    which = F.when(F.col("initial").isin(*INITIALS[:3]), F.col("initial")).otherwise(INITIALS[3])
    symbol = (F.when(F.col("fault").isNull(), which).when(F.col("fault") == "truncated", F.upper(which))
              .otherwise(F.translate(which, INITIALS, FAULTY)))
    return found.select("pos", "conv_id", "turn", "fault", symbol.alias("symbol"))


def plans(found: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, and the cheapest edits as ``cost``, ``audit`` and ``parts`` by block."""
    counts = found.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    counts = counts.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda r: r["symbol"])   # BLOCK rows at most
    blocks = found.groupBy("conv_id", F.expr(f"pos div {BLOCK}").alias("block")).agg(F.min("pos").alias("first"), F.array_join(in_order, "").alias("symbols"))
    blocks = blocks.withColumn("ways", _ways("symbols"))
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("first", "symbols", "ways"))).alias("blocks"))
    planned = whole.select("conv_id", _plan("blocks").alias("plan")).select(F.col("conv_id").alias("conv"), "plan.*")
    return counts.join(planned, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows of repaired conversations, ordered by ``block`` and ``place``: ``conv_id, block, place, edit, role, text``."""
    parts = planned.select("conv_id", F.inline("parts"))
    edits = parts.select("conv_id", F.col("first").alias("block"), _edits("symbols", "state", "audit", "first").alias("edits"))
    edits = edits.select("conv_id", "block", F.inline("edits"))
    texts = rows.select("pos", "role", "text")
    return edits.join(texts, "pos", "left").select(
        "conv_id", "block", "place", "edit", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def digests(lines: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` over ``role:text`` joined by newlines; rows stream past, none is collected."""
    kind = lines.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", kind), StructField("repaired_sha256", StringType())])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, ids, found = None, None, [], []
        for batch in batches:
            for conv, line in zip(batch.column(0), batch.column(1).to_pylist()):
                conv = conv.as_py()
                if sha is None or conv != now:
                    if sha is not None:
                        ids.append(now)
                        found.append(sha.hexdigest())
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
            ids, found = [], []
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([sha.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "block", "place")
    return ordered.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line")).mapInArrow(hashed, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plans by conversation and the repaired rows of ``conv_id, turn, role, text``."""
    rows = numbered(rows)
    planned = write_once(plans(described(rows)), "repair-plans")
    return planned, repaired(rows, planned)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with known faults, by their place: one in twenty each is dropped, emptied, cut, repeated, or given to the user."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), space).alias(c) for c in ("role", "text")], (F.crc32(place) % 20).alias("h"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    return rows.where("h <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
