"""Links inside candidate buckets: every pair of a bucket is compared, or its ends are connected already.

Nothing is left out, whatever a bucket's size. Buckets with the same members count once. A bucket of
up to ``BLOCK`` members is compared in one place; a larger one is cut into blocks of about that many
members of like size, and each two blocks whose sizes a link can bridge meet in a group of their
own. So no task holds a large bucket, and rows, not pairs, travel: each member as often as its
bucket has blocks to meet.

Tasks take groups by the thousand rows. They compare one member of each group with its others first,
then three, twelve, and the rest, and skip pairs that links found so far connect: copies cost one
comparison each. What is left is a full comparison, which takes time with the square of a bucket of
unlike members; ``Comparer`` turns most of those pairs down by counts, many at once. Pairs that a
``QuickComparer`` is not sure of wait until the sure ones are joined; the few that are left of
some thousand rows wait for those of the next, so that many are settled at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import log
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.llm.base import in_small_batches
from embedlift.llm.links import components
from embedlift.workspace import write_once

BLOCK = 512
#: Rows a task compares at once (a comparer may have its own ``ROWS``), and pairs it looks at, or holds unsettled, in one go.
ROWS, PAIRS = 4096, 1 << 16
#: Unsure pairs settled at once.
SETTLED = 4096
#: Unsure pairs, and bytes of their items, that are kept from one part of a task's rows to the next; bytes of rows that are compared at once, whatever their number.
KEPT, BYTES = 1 << 14, 1 << 22
#: Members of a group that are compared with its later ones, step by step.
STEPS = ((0, 1), (1, 4), (4, 16))


class Comparer(Protocol):
    """Made from the items of some ids; says which pairs of them, by number, are links."""

    def __init__(self, items: pa.Array): ...

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray: ...


class QuickComparer(Comparer, Protocol):
    """One that can tell most pairs at a first look."""

    def judged(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are links for sure, and which only ``linked`` can tell; the others are none."""


def linked_in_full(buckets: DataFrame, items: DataFrame, comparer: Callable[[pa.Array], Comparer], least: float) -> DataFrame:
    """``id`` and ``component`` of every id with a link to another id of one of its buckets.

    ``buckets`` has (bucket, id), ``items`` (id, item, size), one row an id. Sizes of linked items differ by a factor of ``least`` at most.
    """
    dealt = buckets.distinct()
    sets = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where("n > 1")
    once = sets.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = write_once(dealt.join(once, "bucket").join(items.select("id", "size"), "id").select("bucket", "id", "size", "n"), "bucket-members")
    small = members.where(F.col("n") <= BLOCK).select(F.col("bucket").alias("group"), F.lit(2).alias("side"), "id")
    rows = write_once(small.union(_met(members.where(F.col("n") > BLOCK), least)), "groups")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ((16 if hasattr(comparer, "judged") else 4) * ROWS))
    placed = rows.join(items.select("id", "item"), "id").select("group", "side", "id", "item").repartition(tasks, "group").sortWithinPartitions("group")
    kind = dict(items.dtypes)["id"]
    return components(in_small_batches(placed.mapInArrow(_links_by(comparer), f"a {kind}, b {kind}"), "links"))


def _met(members: DataFrame, least: float) -> DataFrame:
    """Members of large buckets, in a row for each group of two blocks (sides 0 and 1) or of one with itself (side 2)."""
    # a little wider than a link's factor, so that ends of a link are in one class or in neighbouring ones
    members = members.withColumn("class", F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / (log(1 / least) + 0.01)).cast("int"))
    classes = members.groupBy("bucket", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    blocks = classes.select("bucket", "class", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = blocks.select("bucket", F.col("class").alias("class2"), F.col("part").alias("part2"))
    meetings = (blocks.join(other, "bucket").where("class2 = class and part2 >= part or class2 = class + 1")
                .withColumn("group", F.xxhash64("bucket", "class", "part", "class2", "part2")))
    placed = members.join(classes, ["bucket", "class"]).withColumn("part", F.pmod(F.xxhash64("id", "bucket"), F.col("parts")).cast("int"))
    alone = F.expr("class2 = class and part2 = part")
    first = placed.join(meetings, ["bucket", "class", "part"]).select("group", F.when(alone, 2).otherwise(0).alias("side"), "id")
    second = meetings.where(~alone).select("bucket", F.col("class2").alias("class"), F.col("part2").alias("part"), "group")
    return first.union(placed.join(second, ["bucket", "class", "part"]).select("group", F.lit(1).alias("side"), "id"))


def _links_by(comparer: Callable[[pa.Array], Comparer]) -> Callable:
    at_once = getattr(comparer, "ROWS", ROWS)

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows, size, schema = [], 0, 0, None
        for batch in batches:
            schema = batch.schema
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows < at_once and size < BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            group = table.column(0).to_numpy()
            done = int(np.searchsorted(group, group[-1]))   # the last group may go on
            for begin, end in _slices(group[:done], at_once):
                yield table.slice(begin, end - begin)
            held = table.slice(done).to_batches()
            rows, size = rows - done, sum(b.nbytes for b in held)
        if rows:
            table = pa.Table.from_batches(held, schema).combine_chunks()
            for begin, end in _slices(table.column(0).to_numpy(), at_once):
                yield table.slice(begin, end - begin)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for table in parts(batches):
            yield _links(table, comparer, kept)
            if sum(u.num_rows for u in kept) >= KEPT or sum(u.nbytes for u in kept) >= BYTES:
                yield _settled(kept, comparer)
                kept = []
        if kept:
            yield _settled(kept, comparer)
    return run


def _settled(kept: list[pa.RecordBatch], comparer: Callable[[pa.Array], Comparer]) -> pa.RecordBatch:
    """Those pairs that are links."""
    table = pa.Table.from_batches(kept).combine_chunks()
    items = pa.concat_arrays([c for name in ("p", "q") for c in table.column(name).chunks])
    at = np.arange(table.num_rows)
    linked = comparer(items).linked(at, at + len(at))
    return table.select(["a", "b"]).filter(pa.array(linked)).combine_chunks().to_batches()[0] if linked.any() else kept[0].select(["a", "b"]).slice(0, 0)


def _slices(group: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Whole groups of about ``rows`` rows."""
    if not len(group):
        return
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
    begin = 0
    for at, end in enumerate(ends.tolist()):
        if end - begin >= rows or at + 1 == len(ends):
            yield begin, end
            begin = end


def _links(table: pa.Table, comparer: Callable[[pa.Array], Comparer], kept: list[pa.RecordBatch] | None = None) -> pa.RecordBatch:
    """Links that connect what all links between members of a group would, but for up to ``SETTLED`` pairs that go unsettled to ``kept``, if given: a, b, and their items p, q."""
    group, side = table.column(0).to_numpy(), table.column(1).to_numpy()
    coded = table.column(2).combine_chunks().dictionary_encode()
    item, ids = coded.indices.to_numpy(), coded.dictionary
    _, first = np.unique(item, return_index=True)
    items = table.column(3).combine_chunks().take(pa.array(first))
    compare = comparer(items)
    # by group, both sides in turn
    turn = np.zeros(len(group), np.int64)
    for s in range(3):
        at = np.flatnonzero(side == s)
        if len(at):
            starts = np.flatnonzero(np.append(True, group[at][1:] != group[at][:-1]))
            turn[at] = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    order = np.lexsort((side, turn, group))
    group, side, item = group[order], side[order], item[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(group)))
    root = np.arange(len(ids))
    ends_a, ends_b = [], []

    def apart(pairs: np.ndarray) -> np.ndarray:
        return pairs[root[pairs // len(ids)] != root[pairs % len(ids)]]

    def join(pairs: np.ndarray) -> None:
        for pair in apart(pairs).tolist():
            x, y = divmod(pair, len(ids))
            if root[x] != root[y]:
                root[root == root[y]] = root[x]
                ends_a.append(x)
                ends_b.append(y)

    def settle(unsure: list[np.ndarray], down_to: int) -> np.ndarray:
        pairs = np.unique(np.concatenate(unsure)) if unsure else np.empty(0, np.int64)
        while len(pairs := apart(pairs)) > down_to:
            now, pairs = pairs[:SETTLED], pairs[SETTLED:]
            join(now[compare.linked(now // len(ids), now % len(ids))])
        return pairs

    unsure: list[np.ndarray] = []
    for a, b in _pairs(starts, sizes):
        meets = (side[a] + side[b] == 1) | (side[a] == 2)
        a, b = item[a[meets]], item[b[meets]]
        pairs = apart(np.unique(np.minimum(a, b).astype(np.int64) * len(ids) + np.maximum(a, b)))
        if not len(pairs):
            continue
        if not hasattr(compare, "judged"):
            join(pairs[compare.linked(pairs // len(ids), pairs % len(ids))])
            continue
        sure, open_ = compare.judged(pairs // len(ids), pairs % len(ids))
        join(pairs[sure])
        unsure.append(pairs[open_])
        # many at once, and none that other links connect
        if sum(map(len, unsure)) >= PAIRS:
            unsure = [settle(unsure, 0)]
    left = settle(unsure, 0 if kept is None else SETTLED)
    if len(left):
        p, q = pa.array(left // len(ids)), pa.array(left % len(ids))
        kept.append(pa.record_batch({"a": ids.take(p), "b": ids.take(q), "p": items.take(p), "q": items.take(q)}))
    return pa.record_batch({"a": ids.take(pa.array(ends_a, pa.int64())), "b": ids.take(pa.array(ends_b, pa.int64()))})


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of rows of a group, in steps."""
    for low, high in STEPS:
        left, right = [], []
        for i in range(low, high):
            more = sizes > i + 1
            rest = sizes[more] - i - 1
            a = np.repeat(starts[more] + i, rest)
            left.append(a)
            right.append(a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(rest) - rest, rest))
        a, b = np.concatenate(left), np.concatenate(right)
        for k in range(0, len(a), PAIRS):
            yield a[k:k + PAIRS], b[k:k + PAIRS]
    done, held, n = STEPS[-1][1], [], 0
    for start, size in zip(starts.tolist(), sizes.tolist()):
        for i in range(done, size - 1, step := max(1, PAIRS // size)):
            x, y = np.divmod(np.arange(min(step, size - 1 - i) * size), size)
            later = y > x + i
            held.append((start + i + x[later], start + y[later]))
            n += len(held[-1][0])
            if n >= PAIRS // 2:   # the rest of several groups at once
                yield tuple(np.concatenate(side) for side in zip(*held))
                held, n = [], 0
    if held:
        yield tuple(np.concatenate(side) for side in zip(*held))
