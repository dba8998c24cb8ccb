"""Periodic runs of words, found on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
that no neighbouring word extends keeping q; wanted are those of at least ``max(SHORTEST,
POWER * q)`` words. Each text gets a suffix array of its words (prefix doubling, only suffixes
that are still tied are sorted again) and the common prefixes of neighbours. A stack walks
the intervals of suffixes that share ``depth`` words without building a tree. For each
suffix i of all children of an interval but its largest, the inverse array tells whether
``i + depth`` or ``i - depth`` lies in the interval too, in another child: then a square of
period ``depth`` begins at the smaller of the two and no word extends it to the right
(branching tandem repeat). Rotating such a square to the left as long as words agree gives its
run; squares whose period is a multiple of that of a run around them are part of it.

Intervals of one or two words need not be looked at: a wanted run of period 1 has the branching
square of period 3, one of period 2 that of period 4. So an ordinary text, which repeats short
phrases only, costs three sorts. All is done per text, in tasks; a text is never cut.

Defined cases: a null, empty or blank text has no words, no runs and an empty collapsed text;
repeated rows and null ids are treated like any other row; ties of words are ties of bytes.
Input columns called like the column added are replaced by it, others stay.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

POWER, SHORTEST = 4, 6
_LEAST_DEPTH = 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_RUN_TYPE = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
_FOUND_TYPE = StructType([StructField("runs", ArrayType(_RUN_TYPE)), StructField("collapsed", StringType())])


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but ASCII white space, as bytes: bytes split at just that."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: list[bytes]) -> np.ndarray | None:
    """Equal words as equal numbers; None if no word repeats."""
    numbers: dict[bytes, int] = {}
    given = [numbers.setdefault(w, len(numbers)) for w in words]
    return None if len(numbers) == len(given) else np.array(given, dtype=np.int64)


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, and the place of each suffix in it."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    new = np.empty(n, dtype=bool)
    new[0] = True
    new[1:] = s[order[1:]] != s[order[:-1]]
    starts = np.flatnonzero(new)
    place = np.empty(n, dtype=np.int64)   # first place of a suffix's group of ties
    place[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    depth = 1
    while len(starts) < n:
        sizes = np.diff(np.append(starts, n))
        tied = np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(tied)
        suffixes = order[at]
        after = np.zeros(len(at), dtype=np.int64)
        inside = suffixes + depth < n
        after[inside] = place[suffixes[inside] + depth] + 1
        key = place[suffixes] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        order[at] = suffixes[by]
        key = key[by]
        new[at[1:]] = key[1:] != key[:-1]
        new[at[0]] = True
        starts = np.flatnonzero(new)
        place[order] = np.repeat(starts, np.diff(np.append(starts, n)))
        depth *= 2
    return order, place


def common_prefixes(s: np.ndarray, order: np.ndarray, place: np.ndarray) -> dict[int, int]:
    """By place: words shared with the suffix before, where these are ``_LEAST_DEPTH`` or more."""
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    i = np.flatnonzero((before >= 0) & (np.maximum(before, np.arange(n)) + _LEAST_DEPTH <= n))
    for k in range(_LEAST_DEPTH):
        i = i[s[i + k] == s[before[i] + k]]
    if not len(i):
        return {}
    words, places = s.tolist(), place[i].tolist()
    shared: dict[int, int] = {}
    last, length = -2, 0
    for i, j, at in zip(i.tolist(), before[i].tolist(), places):
        length = max(length - 1, _LEAST_DEPTH) if i == last + 1 else _LEAST_DEPTH
        most = n - max(i, j)
        while length < most and words[i + length] == words[j + length]:
            length += 1
        shared[at] = length
        last = i
    return shared


def branching_squares(n: int, order: list[int], place: list[int], shared: dict[int, int]) -> set[tuple[int, int]]:
    """(period, begin) of every branching square with a period of ``_LEAST_DEPTH`` or more."""
    found: set[tuple[int, int]] = set()

    def look(depth: int, low: int, high: int, borders: list[int]) -> None:
        children = list(zip([low, *borders], [*borders, high + 1]))
        children.remove(max(children, key=lambda c: c[1] - c[0]))
        for first, end in children:
            for i in order[first:end]:
                if i + depth < n and low <= (at := place[i + depth]) <= high and not first <= at < end:
                    found.add((depth, i))
                if i >= depth and low <= (at := place[i - depth]) <= high and not first <= at < end:
                    found.add((depth, i - depth))

    stack: list[tuple[int, int, list[int]]] = []   # depth, first place, borders between children
    last = -2
    for at in [*sorted(shared), n + 1]:
        if at != last + 1:
            while stack:
                depth, low, borders = stack.pop()
                look(depth, low, last, borders)
        if at > n:
            break
        depth, low = shared[at], at - 1
        while stack and stack[-1][0] > depth:
            inner, low, borders = stack.pop()
            look(inner, low, at - 1, borders)
        if stack and stack[-1][0] == depth:
            stack[-1][2].append(at)
        else:
            stack.append((depth, low, [at]))
        last = at
    return found


def periodic_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all wanted runs, by start and then period."""
    s = numbered(words) if len(words) >= SHORTEST else None
    if s is None:
        return []
    order, place = suffix_array(s)
    shared = common_prefixes(s, order, place)
    if not shared:
        return []
    squares = branching_squares(len(s), order.tolist(), place.tolist(), shared)
    given = s.tolist()
    by_end: dict[int, list[tuple[int, int]]] = {}   # (period, start) of runs by end
    for period, begin in sorted(squares):
        end = begin + 2 * period
        known = by_end.setdefault(end, [])
        if any(period % q == 0 and start <= begin for q, start in known):
            continue
        for q in (1, 2):
            if period % q == 0 and given[begin:begin + period - q] == given[begin + q:begin + period]:
                period = q
                break
        start = begin
        while start and given[start - 1] == given[start - 1 + period]:
            start -= 1
        known.append((period, start))
    return sorted((start, end - start, q) for end, runs in by_end.items() for q, start in runs
                  if end - start >= max(SHORTEST, POWER * q))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside runs and those of each run's first period that no other run drops."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _found(text: str | None) -> dict:
    words = words_of(text)
    runs = periodic_runs(words)
    return {"runs": [{"start": a, "length": m, "period": q} for a, m, q in runs],
            "collapsed": b" ".join(kept_words(words, runs)).decode("utf-8", "surrogatepass")}


@F.arrow_udf(_FOUND_TYPE)
def _find(texts: pa.Array) -> pa.Array:
    return pa.array((_found(t.as_py()) for t in texts), _FOUND, size=len(texts))


_find = _find.asNondeterministic()  # a filter on the result must not run it a second time


def with_runs(docs: DataFrame, text: str = "text", into: str = "periodic") -> DataFrame:
    """``docs`` with a struct of ``runs`` (by start, then period) and the ``collapsed`` text."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()]
    return docs.select(*kept, _find(F.col(f"`{text}`")).alias(into))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact exponent; ties by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def first_strongest(runs: Column) -> Column:
    """The same on an array of runs: products decide, no division."""
    def better(a: Column, b: Column) -> Column:
        left, right = b["length"] * a["period"], a["length"] * b["period"]
        return F.when(a.isNull() | (left > right), b).otherwise(a)   # runs come by start, then period

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def made_periodic(doc_id: int | None, text: str | None) -> str | None:
    """One text in ten, by its id, rewritten so that its end repeats: cases with known periods."""
    h = None if doc_id is None else crc32(str(doc_id).encode())
    if h is None or h % 10:
        return text
    words = words_of(text)
    n, g = len(words), h // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n)).decode("utf-8", "surrogatepass")


@F.arrow_udf(StringType())
def _made(ids: pa.Array, texts: pa.Array) -> pa.Array:
    return pa.array((made_periodic(i.as_py(), t.as_py()) for i, t in zip(ids, texts)), pa.string(), size=len(texts))


def with_known_periods(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the texts of :func:`made_periodic`; a row without an id keeps its text."""
    return docs.withColumn(text, _made(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))


def digest(runs: list[tuple[int, int, int]]) -> str:
    """SHA-256 of one line ``start,length,period`` per run."""
    return hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest()
