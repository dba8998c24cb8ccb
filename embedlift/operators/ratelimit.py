"""Which requests of a log a token bucket per key would have let through.

The bucket is kept in whole numbers: with ``T = 60_000_000`` units per token and
``per_minute`` units refilled each microsecond, a key's state is the moment (in
units) at which its bucket was last empty, ``v``. At a request at ``t``
microseconds: ``v`` is raised to at least ``t*per_minute - burst*T`` (a bucket
holds no more than ``burst``); if a whole token is there, it is taken by adding
``T``; otherwise the request is denied and nothing changes.

A key may own any share of the log. Requests are range partitioned by (key,
time), so a busy key spans several partitions. Each of these is summed up as a
function from the state it starts with to the state it ends with; the functions
are chained from partition to partition, and a second pass decides every
request with the state its partition really starts with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.model import RATE_BURST, RATE_PER_MINUTE, RPC_CODES
from embedlift.workspace import checkpointed

TOKEN = 60_000_000
ANONYMOUS = "anonymous"


def make_bucket(per_minute: int, burst: int):
    """``decide(times, v)`` gives the decisions and the state after them; ``v=None`` is a full bucket."""
    capacity = burst * TOKEN

    def decide(times, v):
        allowed = []
        for t in times:
            now = t * per_minute
            floor = now - capacity
            if v is None or v < floor:
                v = floor
            ok = now - v >= TOKEN
            if ok:
                v += TOKEN
            allowed.append(ok)
        return allowed, v

    return decide


def make_transfer(per_minute: int, burst: int):
    """``extend(pieces, times)`` carries pieces ``(low, high, fixed, value)`` over requests.

    A piece says: a start state in ``[low, high]`` ends as ``value`` if
    ``fixed``, else as itself plus ``value``. States a token apart meet again
    once requests are denied, so their number stays at about two per token of
    burst however long the stretch is.
    """
    capacity = burst * TOKEN

    def start(first_time):
        first = first_time * per_minute
        return [(first - capacity, first, False, 0)]

    def extend(pieces, times):
        for t in times:
            now = t * per_minute
            floor, last_ok = now - capacity, now - TOKEN
            out = []
            for low, high, fixed, value in pieces:
                parts = []
                if fixed:
                    parts.append((low, high, True, max(value, floor)))
                else:
                    if low + value < floor:
                        cut = min(high, floor - value - 1)
                        parts.append((low, cut, True, floor))
                        low = cut + 1
                    if low <= high:
                        parts.append((low, high, False, value))
                for a, b, is_fixed, x in parts:
                    if is_fixed:
                        out.append((a, b, True, x + TOKEN if x <= last_ok else x))
                        continue
                    edge = min(b, last_ok - x)
                    if edge >= a:
                        out.append((a, edge, False, x + TOKEN))
                    if edge < b:
                        out.append((max(a, edge + 1), b, False, x))
            merged = [out[0]]
            for piece in out[1:]:
                if piece[2:] == merged[-1][2:]:
                    merged[-1] = (merged[-1][0], piece[1], *piece[2:])
                else:
                    merged.append(piece)
            pieces = merged
        return pieces

    def resolve(pieces, v):
        """State after the stretch for a start state (None: full)."""
        low = pieces[0][0]
        v = low if v is None or v < low else v
        for a, b, fixed, value in pieces:
            if a <= v <= b:
                return value if fixed else v + value
        raise ValueError("start state lies after the first request")

    return start, extend, resolve


def _entry_states(ranged: DataFrame, per_minute: int, burst: int) -> dict[int, int]:
    """State with which the first key of a partition starts, where the key began in an earlier one.

    Only partition summaries reach the driver: two keys per partition, and about
    one piece per token of burst for partitions that a single key fills.
    """
    bounds = sorted(ranged.groupBy("_pid").agg(F.min("_key"), F.max("_key")).collect())
    spanning = {pid: last for (pid, _, last), (_, following, _) in zip(bounds, bounds[1:]) if last == following}
    if not spanning:
        return {}
    whole = {pid for pid, first, last in bounds if first == last}
    decide = make_bucket(per_minute, burst)
    start, extend, resolve = make_transfer(per_minute, burst)

    def summarise(batches):
        import pandas as pd

        pid, pieces, v = None, None, None
        for batch in batches:
            if not len(batch):
                continue
            pid = int(batch["_pid"].iloc[0])
            if pid not in spanning:
                return
            times = batch.loc[batch["_key"] == spanning[pid], "_t"].tolist()
            if not times:
                continue
            if pid in whole:
                pieces = extend(pieces or start(times[0]), times)
            else:
                _, v = decide(times, v)
        if pieces is None and v is not None:
            pieces = [(v, v, True, v)]
        if pieces:
            yield pd.DataFrame({"_pid": pid, "pieces": [[[str(int(x)) for x in p] for p in pieces]]})

    found = {row["_pid"]: row["pieces"] for row in
             ranged.select("_pid", "_key", "_t").mapInPandas(summarise, "_pid int, pieces array<array<string>>").collect()}
    entry: dict[int, int] = {}
    for (pid, _, last), (following, _, _) in zip(bounds, bounds[1:]):
        if pid in spanning:
            pieces = [(int(p[0]), int(p[1]), p[2] == "1", int(p[3])) for p in found[pid]]
            starts_here = pid not in whole
            entry[following] = pieces[0][3] if starts_here else resolve(pieces, entry.get(pid))
    return entry


def rate_limit(requests: DataFrame, key: str = "api_key", ts: str = "ts", tie: str = "event_id",
               per_minute: int = RATE_PER_MINUTE, burst: int = RATE_BURST, partitions: int | None = None) -> DataFrame:
    """The requests with ``allowed`` and ``code`` (0 or the rate-limit error)."""
    own = requests.columns
    keyed = requests.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit(ANONYMOUS))).withColumn(
        "_t", F.unix_micros(F.col(ts).cast("timestamp")))
    order = ["_key", "_t", tie]
    ranged = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    stored = checkpointed(ranged.sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    entry = stored.sparkSession.sparkContext.broadcast(_entry_states(stored, per_minute, burst))
    decide = make_bucket(per_minute, burst)

    def run(batches):
        key_now, v, begun = None, None, False
        for batch in batches:
            if not len(batch):
                continue
            if not begun:
                begun, key_now = True, batch["_key"].iloc[0]
                v = entry.value.get(int(batch["_pid"].iloc[0]))
            allowed = []
            for name, times in batch.groupby("_key", sort=False)["_t"]:
                if name != key_now:
                    key_now, v = name, None
                decided, v = decide(times.tolist(), v)
                allowed.extend(decided)
            yield batch.assign(allowed=allowed)[[*own, "allowed"]]

    schema = ", ".join(f"`{n}` {t}" for n, t in requests.dtypes) + ", allowed boolean"
    decided = stored.select(*own, "_key", "_t", "_pid").mapInPandas(run, schema)
    return decided.withColumn("code", F.when(F.col("allowed"), 0).otherwise(RPC_CODES["rate_limited"]))
